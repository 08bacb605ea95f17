import random

import numpy as np
import pytest

from asterism.llm import decontaminate as D


def distance(a, b):
    """Edit distance of sequences."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def nearest(item, text):
    return min(distance(item, text[i:j]) for i in range(len(text) + 1) for j in range(i, len(text) + 1))


def words(rng, n, of=400):
    return [f"w{rng.randrange(of)}" for _ in range(n)]


def changed(rng, item, edits):
    out = list(item)
    for _ in range(edits):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        out[at : at + (kind != 1)] = [] if kind == 2 else [f"q{rng.randrange(99)}"]
    return out


def test_best_passage_is_exact():
    rng = random.Random(1)
    for _ in range(150):
        item, text = words(rng, rng.randint(1, 6), 4), words(rng, rng.randint(0, 9), 4)
        ids = {w: i for i, w in enumerate(sorted({*item, *text}))}
        a, b = (np.array([ids[w] for w in x], np.int64) for x in (item, text))
        found, first, last = D.best_passage(a, b)
        assert found == nearest(item, text) == distance(item, text[first:last])


def test_recall_of_few_long_items_among_many_short_ones():
    rng = random.Random(5)
    items = [words(rng, rng.randint(15, 30)) for _ in range(400)] + [words(rng, 600, 4000) for _ in range(3)]
    found = D.Items([(i, " ".join(x)) for i, x in enumerate(items)])
    want = [400 + i % 3 for i in range(120)]
    leaks = found.search([" ".join(changed(rng, items[i], D.allowed_edits(600))) for i in want])
    assert sum(any(x["item_id"] == i for x in of) for of, i in zip(leaks, want)) >= 0.97 * len(want)


def test_a_class_beyond_the_most_walks_is_searched_exactly(monkeypatch):
    monkeypatch.setattr(D, "MOST_WALKS", 1)
    rng = random.Random(6)
    items = [words(rng, n, 4000) for n in (600, 600, 9, 14, 30, 45, 45)]
    items += [items[5][:20] + items[6][20:], ["a", "b"] * 20]
    found = D.Items([(i, " ".join(x)) for i, x in enumerate(items)])
    assert found.walks[10] == 0
    texts, want = [], []
    for n in range(150):
        item = items[n % len(items)]
        passage = changed(rng, item, D.allowed_edits(len(item)))
        texts.append(words(rng, rng.randint(0, 40)) + passage + words(rng, rng.randint(0, 40)))
        want.append(n % len(items))
    leaks = found.search([" ".join(t) for t in texts])
    assert all(any(x["item_id"] == i for x in of) for of, i in zip(leaks, want))
    monkeypatch.setattr(D, "STARTS_AT_ONCE", 7)
    assert found.search([" ".join(t) for t in texts]) == leaks


def test_exact_search_finds_what_brute_force_finds(monkeypatch):
    monkeypatch.setattr(D.Items, "_walks_of", staticmethod(lambda bits, items, recall: 0))
    rng = random.Random(8)
    items = [words(rng, n, 12) for n in (1, 1, 2, 2, 3, 6, 10, 10, 16)]
    found = D.Items([(i, " ".join(x)) for i, x in enumerate(items)])
    texts = [changed(rng, rng.choice(items) + words(rng, 4, 12), rng.randint(0, 3)) for _ in range(80)]
    for text, of in zip(texts, found.search([" ".join(t) for t in texts])):
        want = {i: nearest(item, text) for i, item in enumerate(items)}
        want = {(i, d) for i, d in want.items() if d <= D.allowed_edits(len(items[i]))}
        assert {(x["item_id"], x["distance"]) for x in of} == want


@pytest.mark.parametrize("size", [15, 40, 100, 300, 900])
def test_recall_by_class_of_sizes(size):
    rng = random.Random(size)
    items = [words(rng, rng.randint(size, size + size // 4), 5000) for _ in range(12)]
    found = D.Items([(i, " ".join(x)) for i, x in enumerate(items)])
    texts = [" ".join(words(rng, 20) + changed(rng, items[n % 12], D.allowed_edits(len(items[n % 12])))) for n in range(120)]
    got = sum(any(x["item_id"] == n % 12 for x in of) for n, of in enumerate(found.search(texts)))
    assert got >= 0.97 * len(texts)


def test_short_items_and_scripts_without_spaces():
    items = [
        "Paris France", "Paris", "unheard", "東京は日本の首都です。人口は多い", "東京", "กรุงเทพ", "ᄒ",
        "the capital of 日本 is 東京", "", "...",
    ]
    found = D.Items([*enumerate(items), (99, None), (98, "PARIS, france!")])
    texts = [
        "in Paris France now", "paris. Paris", "France Paris", "昔から東京は日本の首都です。人口は多いと言う", "東 京", "x",
        "We say the capital of 日本 is 東京都.", "อยู่กรุงเทพ", "", None, "comparis",
    ]
    got = [[(x["item_id"], x["start"], x["n_words"]) for x in of] for of in found.search(texts)]
    assert got[0] == [(0, 1, 2), (98, 1, 2), (1, 1, 1)] and got[1] == [(1, 0, 1)] and got[2] == [(1, 1, 1)]
    assert {x[0] for x in got[3]} == {3, 4} and got[4] == [(4, 0, 2)] and {x[0] for x in got[6]} == {4, 7}
    assert [x[0] for x in got[7]] == [5] and not any(got[i] for i in (5, 8, 9, 10))


def test_recall_at_the_limit_and_precision():
    rng = random.Random(2)
    items = [words(rng, rng.randint(15, 60)) for _ in range(60)]
    found = D.Items([(i, " ".join(x)) for i, x in enumerate(items)])
    texts, want = [], []
    for i in range(300):
        item = items[i % 60]
        edits = rng.randint(0, D.allowed_edits(len(item)))
        passage = changed(rng, item, edits)
        texts.append(" ".join(words(rng, rng.randint(0, 80)) + passage + words(rng, rng.randint(0, 80))))
        want.append(i % 60)
    texts += [" ".join(words(rng, 300)) for _ in range(100)]
    leaks = found.search(texts)
    assert sum(any(x["item_id"] == i for x in of) for of, i in zip(leaks, want)) >= 0.99 * len(want)
    assert not any(leaks[300:])
    for text, of in zip(texts, leaks):
        for x in of:  # what is reported is true
            passage = text.split(" ")[x["start"] : x["start"] + x["n_words"]]
            assert distance(items[x["item_id"]], passage) == x["distance"] <= D.allowed_edits(x["item_words"])


def test_brute_force_on_small_texts():
    rng = random.Random(3)
    items = [words(rng, n, 12) for n in (3, 6, 10, 10)]
    texts = [changed(rng, rng.choice(items), rng.randint(0, 3)) + words(rng, 5, 12) for _ in range(60)]
    found = D.Items([(i, " ".join(x)) for i, x in enumerate(items)])
    for text, of in zip(texts, found.search([" ".join(t) for t in texts])):
        want = {i for i, item in enumerate(items) if nearest(item, text) <= D.allowed_edits(len(item))}
        assert {x["item_id"] for x in of} <= want
        assert {i for i in want if nearest(items[i], text) == 0} <= {x["item_id"] for x in of}


def test_hamming_distance_follows_edits():
    rng = random.Random(4)
    rows, near = [], []
    for _ in range(40):
        item = [rng.randrange(1, 999) for _ in range(40)]
        rows.append(item)
        near.append((item[:20] + [0] + item[20:])[:40])
    a, b = D.embed(np.array(rows), 8), D.embed(np.array(near), 8)
    far = D.embed(np.array(rows[::-1]), 8)
    assert (a == b).mean() > 0.6 > 0.3 > (a == far).mean()


@pytest.mark.parametrize("item", ["Old, RIVER bank. The quick!", "old river bank the quick"])
def test_rows(spark, messy, item):
    benchmark = spark.createDataFrame(
        [(1, item), (1, item), (2, None), (3, ""), (4, "two words"), (None, item), (5, "not there at all anywhere")],
        "item_id long, text string",
    )
    rows = D.find_leaks(messy, benchmark).collect()
    assert {r["doc_id"] for r in rows} == {1, 2}
    assert len(rows) == 3 * 3  # three documents, and three items with these words
    assert all((r["distance"], r["item_words"]) == (0, 5) for r in rows)


def test_empty_tables(spark, messy):
    benchmark = spark.createDataFrame([(1, "old river bank the quick")], "item_id long, text string")
    assert D.find_leaks(messy.limit(0), benchmark).count() == 0
    assert D.find_leaks(messy, benchmark.limit(0)).count() == 0


def test_blocks_of_items_find_the_same(spark, messy, monkeypatch):
    items = [(i, f"alpha beta gamma item {i} delta") for i in range(20)] + [(99, "old river bank the quick")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(map(tuple, D.find_leaks(messy, benchmark).collect()))
    monkeypatch.setattr(D, "ITEMS_LIMIT", 4 << 20)  # the table of bits takes two thirds
    assert sorted(map(tuple, D.find_leaks(messy, benchmark).collect())) == want
    monkeypatch.setattr(D, "ITEMS_LIMIT", 1)
    monkeypatch.setattr(D, "BLOCK_BYTES", 200)
    assert sorted(map(tuple, D.find_leaks(messy, benchmark).collect())) == want
