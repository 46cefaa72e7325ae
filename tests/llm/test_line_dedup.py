import random

import numpy as np
import pytest

from fablens.llm import line_dedup
from tests.llm import brute

LONG = "this line is long enough to count"


def got(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in df.collect()), key=str)


def test_equals_the_plain_version(documents):
    r = random.Random(5)
    pool = [f"Line number {i} of the pool, ä {'x' * (i % 9)}" for i in range(30)] + ["short", "", "  "]
    rows = []
    for i in range(200):
        lines = [r.choice(pool) for _ in range(r.randrange(8))]
        rows.append((i, "\n".join(r.choice((x, x.upper(), f"\t{x} \r")) for x in lines)))
    rows += [(900, None), (901, ""), (902, "\n\n"), (None, LONG), (None, LONG), (903, LONG), (904, LONG)]
    rows += [(905, f"own\n{LONG}\nend"), (905, f"own\n{LONG}\nend"), (906, "z" * 300_000 + "\n" + LONG)]
    assert got(line_dedup.dedup_lines(documents(rows))) == sorted(brute.drop_lines(rows), key=str)


def test_three_documents_and_twenty_code_points(documents):
    key = "é" * 20
    rows = [(1, key), (2, key), (3, f"{key}\n{key}"), (4, "é" * 19), (5, "é" * 19), (6, "é" * 19), (7, LONG), (8, LONG)]
    found = {r["doc_id"]: (r["n_dropped"], r["text"]) for r in line_dedup.dedup_lines(documents(rows)).collect()}
    assert found[1] == (1, "") and found[2] == (1, "")
    assert found[3] == (0, f"{key}\n{key}")
    assert all(found[i][0] == 0 for i in (4, 5, 6, 7, 8))


def test_a_folded_filter_only_suspects_more(documents, monkeypatch):
    rows = [(i, f"{LONG} {i % 7}\nunique line of document number {i}") for i in range(60)]
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", 16)
    monkeypatch.setattr(line_dedup.Layout.__init__, "__defaults__", (16,))
    assert line_dedup.Layout(120).folded_bits < line_dedup.Layout(120).slice_bits
    assert got(line_dedup.dedup_lines(documents(rows))) == sorted(brute.drop_lines(rows), key=str)


def test_columns_and_empty_table(documents):
    df = documents([(1, "a"), (2, None)])
    out = line_dedup.dedup_lines(df.withColumnRenamed("source", "n_lines"))
    assert out.columns == ["doc_id", "text", "lang", "n_chars", "doc", "line", "kept", "n_lines", "n_dropped"]
    assert {r["text"] for r in out.collect()} == {"a", None}
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["", "abc", "a\nb\n", "\n", "  x  \n\ty"])
def test_keys_of_one_text(text):
    data = np.frombuffer(text.encode(), np.uint8)
    rows, begin, end, _ = line_dedup.line_keys(data, np.array([0, len(data)]), 1)
    assert [text.encode()[a:b].decode() for a, b in zip(begin, end)] == [x.strip() for x in text.split("\n") if x.strip()]
