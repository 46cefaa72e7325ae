import random

import pytest

from fablens.llm import near_dedup
from fablens.llm.components import connected_components
from tests.llm import brute

R = random.Random(3)
WORDS = [f"w{i}" for i in range(4000)]


def text(n):
    return " ".join(R.choice(WORDS) for _ in range(n))


def edited(base, k):
    words = base.split(" ")
    for _ in range(k):
        words[R.randrange(len(words))] = R.choice(WORDS)
    return " ".join(words)


def check(documents, rows):
    want = brute.near_classes(rows)
    out = near_dedup.near_duplicates(documents(rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        if r["doc_id"] is None:
            assert (r["component_id"], r["kept"]) == (None, True)
        else:
            assert r["component_id"] == want[r["doc_id"]], r
            assert r["kept"] == (r["doc_id"] == want[r["doc_id"]])
    sizes = {i: len(brute.shingles(t)) for i, t in rows}
    assert all(r["n_shingles"] == sizes[r["doc_id"]] for r in out if [i for i, _ in rows].count(r["doc_id"]) == 1)


@pytest.mark.parametrize("cell", [2048, 16])
def test_groups_chains_and_odd_rows(documents, monkeypatch, cell):
    """Edits from none to many, so that members link to some copies and not to others."""
    monkeypatch.setattr(near_dedup, "CELL", cell)
    rows, base = [], text(150)
    for k in range(120):
        rows.append((5000 - k * 7, edited(base, k // 6)))
    chain = text(120)
    for k in range(20):
        rows.append((7000 + k, chain))
        chain = edited(chain, 2)
    rows += [(100 + k, text(60)) for k in range(30)]
    rows += [(1, "a b c"), (2, "A\tb  C"), (3, "a b d"), (4, ""), (6, None), (8, " \n "), (9, "a"), (10, "a")]
    rows += [(11, base.upper()), (11, base.upper()), (None, base), (None, base), (12, " ".join(["x"] * 40000))]
    check(documents, rows)


def test_threshold_is_inclusive(documents):
    words = [f"t{i}" for i in range(200)]
    full = " ".join(words)
    shingles = 196
    # A prefix of a full set: intersection over union is its share.
    for k in (146, 147, 148):
        rows = [(1, full), (2, " ".join(words[: k + 4]))]
        linked = 100 * k >= 75 * shingles
        found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(documents(rows)).collect()}
        assert (found[2] == 1) == linked


def test_repeated_ids_and_empty_table(documents, spark):
    a, b = text(80), text(80)
    rows = [(1, a), (2, a), (2, b), (3, b), (4, text(50)), (4, text(50))]
    check(documents, rows)
    kept = near_dedup.remove_near_duplicates(documents(rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4]
    assert kept.columns == documents(rows).columns
    assert near_dedup.near_duplicates(documents(rows).limit(0)).count() == 0


@pytest.mark.parametrize("case", ["random", "path", "star", "none"])
def test_components(spark, case):
    r = random.Random(case)
    edges = {
        "random": [(r.randrange(300), r.randrange(300)) for _ in range(220)],
        "path": [(i, i + 1) for i in range(60)],
        "star": [(59, i) for i in range(60)],
        "none": [],
    }[case]
    df = spark.createDataFrame([*edges, (None, 4), (5, 5)], "a bigint, b bigint")
    got = {x["node"]: x["component"] for x in connected_components(df).collect()}
    linked = [(a, b) for a, b in edges if a != b]
    assert got == brute.components({n for e in linked for n in e}, linked)
