"""The operators that give back documents: all columns kept, on odd and on empty tables."""

import pytest
from conftest import rows_of

from asterism.llm.decontaminate import clean_documents
from asterism.llm.jaccard_join import distinct_documents
from asterism.llm.mixing import mixed_documents
from asterism.llm.quality_cnn import good_documents


@pytest.fixture(scope="module")
def filters(labels, spark):
    benchmark = spark.createDataFrame([(1, "old river bank the quick"), (2, None)], "item_id long, text string")
    return {
        "mix": mixed_documents,
        "good": lambda docs: good_documents(docs, labels, 0.0),
        "distinct": distinct_documents,
        "clean": lambda docs: clean_documents(docs, benchmark),
    }


@pytest.mark.parametrize("name", ["mix", "good", "distinct", "clean"])
def test_rows_and_columns_are_kept(filters, messy, name):
    kept = filters[name](messy)
    assert kept.dtypes == messy.dtypes
    assert set(rows_of(kept)) <= set(rows_of(messy))
    if name == "good":  # a threshold of 0 rejects nothing
        assert rows_of(kept) == rows_of(messy)


@pytest.mark.parametrize("name", ["mix", "good", "distinct", "clean"])
def test_an_empty_table_gives_an_empty_one(filters, messy, name):
    kept = filters[name](messy.limit(0))
    assert kept.dtypes == messy.dtypes
    assert kept.count() == 0


def test_one_of_each_component_stays(messy):
    texts = [r["text"] for r in distinct_documents(messy).collect()]
    words = [t for t in texts if (t or "").strip()]
    assert len(words) == len(set(words)) == 5  # repeated rows and equal texts once
    assert len(texts) - len(words) == 3  # those without words all stay


def test_leaking_documents_go(filters, messy):
    texts = {r["text"] for r in filters["clean"](messy).collect()}
    assert not any("lazy dog" in (t or "") for t in texts)
    assert len(texts) == 7
