import public_tokenizers
import pytest

from asterism.llm.common import share_package

LONG = "wide river " * 20_000
PLAIN = "The quick brown fox jumps over the lazy dog near the old river bank. " * 3

# extra columns with names that the operators use inside
CLASHING = ("row", "size", "copies", "score", "leaks", "m1", "n", "digest", "_there", "place", "first")


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    share_package(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """(doc_id, text) pairs, and None for either, as a table like ``documents``; more columns at will."""

    def make(rows, extra=()):
        schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(
            f", `{name}` string" for name in extra
        )
        whole = [
            (doc_id, text, "en", source[0] if source else "src", len(text or ""), *["x"] * len(extra))
            for doc_id, text, *source in rows
        ]
        return spark.createDataFrame(whole, schema)

    return make


@pytest.fixture(scope="session")
def messy(documents):
    """Nulls, empty, blank and long texts, ties, repeated rows and clashing names."""
    return documents(
        [
            (1, PLAIN),
            (1, PLAIN),
            (2, PLAIN, None),
            (None, None, None),
            (None, "One two three.", "b"),
            (None, "One two three.", "b"),
            (3, "", "b"),
            (4, " \t\n", "c"),
            (5, LONG, "c"),
            (6, "naïve Ünicode ΣΑΣ 日本語 <|endoftext|> \u0085 end", "d"),
            (7, "x" * 3000, "d"),
        ],
        CLASHING,
    )


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, 0) for i in range(1, 8)] + [(None, 1, 0), (9, None, 0), (1, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def byte_bpe():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def word_bpe():
    return public_tokenizers.path("word_bpe_49k.json")


def rows_of(df):
    """Rows in a fixed order, nulls and all."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
