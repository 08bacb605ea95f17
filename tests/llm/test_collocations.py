import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm.conftest import rows_of

from asterism.llm import collocations as co
from asterism.llm.collocations import bitmap_of, collocations, mine_shards, phrase_counts


def brute(rows, best=2000, longest=3, support=10, percent=50):
    """Straight from the definition."""
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) >= 2 and a >= support}
        rows = []
        for p, a in cands.items():
            cuts = [(1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            covered = any(
                len(q) > len(p) and 100 * b >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, b in cands.items()
            )
            if not covered:
                rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:best], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.fixture
def texts(spark):
    def make(rows):
        schema = "doc_id long, text string, lang string, phrase string, words string, f string"
        return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], schema)

    return make


def corpus(seed, docs=150, vocabulary=25):
    rng = np.random.default_rng(seed)
    words = np.array([f"W{i}" if i % 3 else f"w{i}é" for i in range(vocabulary)] + [".", ",", "\n", "a!b", "\t", "New York city"])
    rows = []
    for i in range(docs):
        text = " ".join(words[rng.zipf(1.4, rng.integers(0, 60)) % len(words)])
        rows.append((i, text, ["en", "de", None, ""][i % 4]))
    return rows


@pytest.mark.parametrize("options", [{}, {"longest": 4, "support": 4}, {"longest": 2, "best": 3}, {"support": 3, "shards": 7}, {"shards": 16}, {"percent": 90, "shards": 1}])
def test_equals_brute_force(spark, texts, options):
    rows = corpus(1)
    plain = {k: v for k, v in options.items() if k != "shards"}
    want = brute(rows, **plain)
    assert want
    assert sorted(tuple(r) for r in collocations(texts(rows), **options).collect()) == want


def test_without_bitmaps_and_in_small_blocks(spark, texts, monkeypatch):
    rows = corpus(2)
    want = brute(rows)
    monkeypatch.setattr(co, "BLOCK_BYTES", 50)
    monkeypatch.setattr(co, "ROWS", 7)
    monkeypatch.setattr(co, "bitmap_of", lambda keys: None)
    assert sorted(tuple(r) for r in collocations(texts(rows)).collect()) == want


def test_a_shard_is_mined_at_its_share(spark, texts):
    """A phrase at the support is found whichever shards its occurrences fall into."""
    rows = [(i, f"rare pair{j}", "en") for j in range(8) for i in range(j * 100, j * 100 + 10)]
    got = {(r["phrase"], r["f"]) for r in phrase_counts(texts(rows)).where("words = 2").collect()}
    assert got == {(f"rare pair{j}", 10) for j in range(8)}
    for shards in (1, 2, 4, 9, 16):
        assert mine_shards(texts(rows), range(2, 3), 10, shards, None).count() == 8
    # one occurrence less in every shard than its share asks for gives no candidate
    few = [(i, "once only", "en") for i in range(2)]
    assert mine_shards(texts(few), range(2, 3), 12, 4, None).count() == 0


def test_bitmap_has_all_its_keys(spark, monkeypatch):
    monkeypatch.setattr(co, "SEGMENT_BITS", 10)
    keys = np.random.default_rng(5).integers(-(1 << 63), 1 << 63, 5000)
    df = spark.createDataFrame([(int(k),) for k in keys], "key long")
    bitmap = bitmap_of(df)
    assert bitmap.has(keys.view(np.uint64)).all()
    others = np.random.default_rng(6).integers(0, 1 << 64, 5000, np.uint64)
    assert bitmap.has(others).mean() < 0.15
    monkeypatch.setattr(co, "BITMAP_BITS", 12)
    assert bitmap_of(df) is None  # too many for a bitmap of that size


def test_scores_beyond_64_bits(spark):
    big = 4_000_000_000_000
    counts = spark.createDataFrame(
        [("en", "", 0, big), ("en", "a", 1, big), ("en", "b", 1, big - 1), ("en", "a b", 2, big - 2)],
        "lang string, phrase string, words int, f long",
    )
    row = co.score_phrases(counts).first()
    assert row["score"] == 1_000_000 * (big - 2) ** 2 // (big * (big - 1))


def test_ties_go_to_the_smallest_cut_and_bytes_order(spark, texts):
    rows = [(i, "x y z", "en") for i in range(12)] + [(i, "é q, z q, \U0001f600 q, ￮ q", "en") for i in range(12)]
    assert sorted(tuple(r) for r in collocations(texts(rows)).collect()) == brute(rows)


def test_messy_and_empty_tables(spark, messy):
    got = rows_of(collocations(messy, support=2))
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in messy.collect()]
    assert got == sorted(brute(rows, support=2), key=repr)
    assert collocations(messy.limit(0)).count() == 0
