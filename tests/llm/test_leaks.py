import random

import pytest

from fablens.llm import decontamination
from tests.llm import brute

R = random.Random(8)
COMMON = ["the", "of", "and", "to", "in", "a", "is", "it"]
RARE = [f"term{i}" for i in range(3000)]


def prose(n):
    return " ".join(R.choice(COMMON) if R.random() < 0.5 else R.choice(RARE) for _ in range(n))


def test_equals_brute_force(documents, spark):
    items = [(i, prose(R.randrange(8, 70)).capitalize() + ".") for i in range(60)]
    items += [(60, None), (61, ""), (62, "too short"), (63, items[0][1]), (64, prose(400)), (None, prose(20))]
    docs = []
    for i in range(300):
        text = prose(R.randrange(0, 300))
        if i % 3 == 0:
            item = items[i % 60][1]
            if i % 2:
                item = item.upper().replace(" ", "  ")
            if i % 5 == 0:
                words = item.split()
                words[len(words) // 3] = "changed"
                item = " ".join(words)
            text += "\n" + item + ", " + prose(R.randrange(0, 100))
        docs.append((i, text))
    docs += [(400, items[64][1] + " " + prose(30)), (401, None), (402, ""), (403, items[1][1]), (403, items[1][1]), (404, prose(60000) + " " + items[2][1])]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc string")
    found = decontamination.find_leaks(documents(docs), bench)
    got = [(r["doc_id"], r["item_id"]) for r in found.collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute.leaks(docs, items)
    kept = decontamination.remove_leaks(documents(docs), bench)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in docs} - {d for d, _ in got}
    assert kept.columns == documents(docs).columns


def test_blocks_of_items_give_the_same(documents, spark):
    items = [(i, prose(30)) for i in range(40)]
    docs = [(i, prose(40) + " " + items[i % 40][1]) for i in range(80)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    whole = {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(documents(docs), bench).collect()}
    blocks = list(decontamination.indexes(bench, "item_id", "text", 200))
    assert len(blocks) > 3
    real = decontamination.indexes.__defaults__
    decontamination.indexes.__defaults__ = (200,)
    try:
        again = {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(documents(docs), bench).collect()}
    finally:
        decontamination.indexes.__defaults__ = real
    assert again == whole == {(i, i % 40) for i in range(80)}


def test_empty_tables(documents, spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, prose(20))], "item_id bigint, text string")
    assert decontamination.find_leaks(documents([(1, prose(9))]), none).count() == 0
    assert decontamination.find_leaks(documents([(1, "x")]).limit(0), some).count() == 0


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
def test_rows_that_share_an_id_or_have_none(documents, spark, kind):
    """Equally long texts under one id are items of their own, and each is found."""
    shared = "7" if kind == "string" else 7
    texts = [[prose(n) for _ in range(2)] for n in (20, 120)]
    for key in (shared, None):
        for a, b in texts:
            bench = spark.createDataFrame([(key, a), (key, b), (key, a)], f"item_id {kind}, text string")
            docs = [(1, prose(30) + " " + a), (2, b + " " + prose(30)), (3, prose(200))]
            found = decontamination.find_leaks(documents(docs), bench).collect()
            assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(1, key), (2, key)]
            assert all(min(r["question_overlap"], r["answer_overlap"]) == 1 for r in found)


def test_blocks_deal_rows_without_an_id(spark):
    bench = spark.createDataFrame([(None, prose(30)) for _ in range(40)], "item_id bigint, text string")
    assert len(list(decontamination.indexes(bench, "item_id", "text", 200))) > 3


def test_short_items_and_scripts_without_spaces(documents, spark):
    han = "".join(chr(0x4E00 + 37 * k % 20000) for k in range(150))
    items = {
        1: "What is six times seven? 42",
        2: "Capital? Paris",
        3: "\u6c34\u7684\u6cb8\u70b9\u662f\u591a\u5c11\uff1f\u4e00\u767e\u5ea6",
        4: "\u5317\u4eac",
        5: han,
        6: "\u0e20\u0e32\u0e29\u0e32\u0e44\u0e17\u0e22",
        7: "\u3002\uff01",
        8: "\U00020000\U00020001\U00020002",
    }
    docs = [
        (1, prose(40) + " what is SIX times seven 42 " + prose(40)),
        (2, prose(40) + ". Capital: paris! " + prose(40)),
        (3, "\u6211\u95ee" + items[3] + "\u5de6\u53f3\uff0c" + prose(9)),
        (4, "\u5728\u5317\u4eac\u8bfb\u4e66"),
        (5, prose(60) + han[100:] + " " + "x" + han + "y"),
        (6, "abc\u0e04" + items[6] + "\u0e04"),
        (7, "capital of paris, \u5317\u3002\u4eac \u5317 \u4eac \u4eac\u5317 \U00020000\U00020001"),
        (8, "\u4e00" + items[8] + "z"),
        (9, han[:60]),
        (10, "Capital"),
        (11, "Paris is the capital"),
    ]
    bench = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    found = decontamination.find_leaks(documents(docs), bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6), (7, 4), (8, 8)]
    few = bench.filter("item_id in (2, 4, 7)")
    found = decontamination.find_leaks(documents(docs), few).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(2, 2), (4, 4), (7, 4)]
    assert all(r["score"] == r["question_overlap"] == r["answer_overlap"] == 1 for r in found)


def test_scores_equal_plain_bm25():
    """All segments above the threshold, and only those, with their full scores."""
    import numpy as np

    rows = [(i, 0, [R.randrange(1, 60) for _ in range(12)], 6) for i in range(50)]
    frequency = {}
    for r in rows:
        for t in set(r[2]):
            frequency[t] = frequency.get(t, 0) + 1
    index = decontamination.Index(rows, frequency, 50, 12.0)
    for _ in range(50):
        query = np.unique([R.randrange(1, 60) for _ in range(30)]).astype(np.uint64)
        terms = np.sort(index.find(query)[index.find(query) >= 0])
        passage, segment, score = index.search(np.zeros(len(terms), np.int64), terms)
        want = {}
        for t in terms.tolist():
            for k in range(index.first[t], index.first[t + 1]):
                want[index.segment[k]] = want.get(index.segment[k], 0) + index.impact[k]
        want = {s: w for s, w in want.items() if w >= decontamination.SCORE}
        assert {s: round(x, 9) for s, x in zip(segment.tolist(), score.tolist())} == {s: round(x, 9) for s, x in want.items()}
