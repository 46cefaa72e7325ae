"""Every stage against a plain version of it, on the smallest tables."""

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from fablens.llm import toxicity
from fablens.llm.queries import ORACLES, QUERIES
from fablens.llm.token_counts import TOKENIZER, load_tokenizer
from fablens.sources.shared import materialize
from tests import oracle
from tests.llm import brute


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], folder), f"test-{name}"))
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_all_but_the_last_keep_the_columns(stages):
    assert all(s.columns == stages[0].columns and s.dtypes == stages[0].dtypes for s in stages[:-1])


def test_toxicity(spark, folder, stages):
    judged = toxicity.judge_toxicity(stages[0], spark.read.parquet(f"{folder}/labels.parquet"))
    assert sorted(r["doc_id"] for r in stages[1].collect()) == sorted(r["doc_id"] for r in judged.filter("not rejected").collect())


def test_line_dedup(stages):
    rows = pairs(stages[1])
    want = {i: (text if n else dict(rows)[i]) for i, _, n, text in brute.drop_lines(rows)}
    assert dict(pairs(stages[2])) == want
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2].collect())


def test_near_duplicates(stages):
    classes = brute.near_classes(pairs(stages[2]))
    assert sorted(i for i, _ in pairs(stages[3])) == sorted(set(classes.values()))


def test_decontamination(spark, folder, stages):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    leaking = {d for d, _ in brute.leaks(pairs(stages[3]), items)}
    assert {i for i, _ in pairs(stages[4])} == {i for i, _ in pairs(stages[3])} - leaking


def test_tokens(stages):
    library = load_tokenizer(TOKENIZER)
    texts = dict(pairs(stages[4]))
    rows = stages[5].collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert np.frombuffer(bytes(r["token_ids"]), "<u4").tolist() == library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["decoded"] == (texts[r["doc_id"]] or "")


def test_queries_are_registered(spark, folder):
    numbers = {n.split("_")[0] for n in QUERIES}
    assert numbers == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_check(spark, folder, name):
    assert oracle.differences(QUERIES[name](spark, folder), oracle.connect(folder), ORACLES[name]) == ""
