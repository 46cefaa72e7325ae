import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fablens.llm import quality, toxicity

R = random.Random(2)
PLAIN = [f"word{i}" for i in range(800)]
RUDE = ["idiot", "moron", "dummkopf"]


def prose(n):
    return " ".join(R.choice(PLAIN) for _ in range(n)) + "."


def rude(n):
    words = prose(n).split(" ")
    for _ in range(3):
        words.insert(R.randrange(len(words)), R.choice(RUDE))
    return " ".join(words)


def junk(n):
    return "!! ".join(R.choice(PLAIN).upper() for _ in range(n)) + "!!"


@pytest.fixture(scope="module")
def corpus(spark, documents):
    rows, labels = [], []
    for i in range(600):
        kind = i % 6
        text = rude(60) if kind == 0 else junk(50) if kind == 1 else prose(R.randrange(20, 120))
        rows.append((i, text))
        if i < 400:
            labels.append((i, int(kind != 1), int(kind == 0)))
    labels += [(None, 1, 1), (401, None, 1), (3, 1, 0), (3, 1, 0), (9999, 1, 0)]
    rows += [(700, None), (701, ""), (None, rude(30)), (702, prose(20_000)), (2, rows[2][1])]
    return documents(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), rows


def test_toxicity_on_unseen_documents(corpus):
    docs, labels, rows = corpus
    out = toxicity.judge_toxicity(docs, labels).collect()
    assert len(out) == len(rows)
    seen = {r["doc_id"]: r for r in out if r["doc_id"] is not None and 400 <= r["doc_id"] < 600}
    wrong = [i for i, r in seen.items() if r["rejected"] != (i % 6 == 0)]
    assert len(wrong) <= 2
    by_id = {r["doc_id"]: r for r in out}
    assert not by_id[700]["rejected"] and not by_id[701]["rejected"] and not by_id[702]["rejected"]
    assert by_id[None]["rejected"]
    assert all(0 <= r["p_junk"] <= 1 and 0 <= r["p_toxic"] <= 1 for r in out)
    kept = toxicity.remove_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r["rejected"] for r in out)


def test_later_models_see_earlier_odds(corpus):
    docs, labels, _ = corpus
    chain = toxicity.fit_chain(docs, toxicity.toxicity_labels(labels), toxicity.CATEGORIES)
    assert [len(w) for _, w in chain.models] == [11 + len(chain.selection), 11 + len(chain.selection) + 1]


def test_without_labels(corpus):
    docs, labels, rows = corpus
    assert toxicity.judge_toxicity(docs, labels.limit(0)).filter("rejected").count() == 0
    assert toxicity.remove_toxic(docs, labels.limit(0)).count() == len(rows)
    assert toxicity.judge_toxicity(docs.limit(0), labels).count() == 0
    assert quality.judge_quality(docs, labels.limit(0)).filter("not kept").count() == 0
    assert quality.judge_quality(docs.limit(0), labels).count() == 0


def test_quality_on_unseen_documents(corpus):
    docs, labels, rows = corpus
    out = quality.judge_quality(docs, labels).collect()
    assert len(out) == len(rows)
    seen = {r["doc_id"]: r for r in out if r["doc_id"] is not None and 400 <= r["doc_id"] < 600}
    assert [i for i, r in seen.items() if r["kept"] != (i % 6 != 1)] == []


def nested(hosts, paths, docs, host_sd, path_sd, doc_sd, seed=1):
    r = np.random.default_rng(seed)
    rows = []
    for h in range(hosts):
        own = r.normal(0.5, host_sd)
        for p in range(paths(h)):
            site = own + r.normal(0, path_sd)
            rows += [(f"h{h}", f"p{p}", float(site + r.normal(0, doc_sd))) for _ in range(docs(h, p))]
    return rows


def expected_squares(rows):
    """The same variances from plain loops over the documents."""
    sites, hosts = {}, {}
    for h, p, v in rows:
        sites.setdefault((h, p), []).append(v)
        hosts.setdefault(h, []).append(v)
    n, mean = len(rows), np.mean([v for _, _, v in rows])
    within = sum(((np.array(v) - np.mean(v)) ** 2).sum() for v in sites.values()) / (n - len(sites))
    between_paths = sum(len(v) * (np.mean(v) - np.mean(hosts[h])) ** 2 for (h, _), v in sites.items())
    share = sum(len(v) ** 2 / len(hosts[h]) for (h, _), v in sites.items())
    paths = (between_paths - (len(sites) - len(hosts)) * within) / (n - share)
    between_hosts = sum(len(v) * (np.mean(v) - mean) ** 2 for v in hosts.values())
    rest = (len(hosts) - 1) * within + (share - sum(len(v) ** 2 for v in sites.values()) / n) * paths
    return mean, within, paths, (between_hosts - rest) / (n - sum(len(v) ** 2 for v in hosts.values()) / n)


SCORED = "host string, path string, p double"


def test_variances_are_those_of_the_nested_model(spark):
    rows = nested(60, lambda h: 1 + h % 7, lambda h, p: 1 + (h * 3 + p * 5) % 11, 0.1, 0.07, 0.05)
    _, found = quality.site_statistics(spark.createDataFrame(rows, SCORED))
    assert (found.mean, found.within, found.paths, found.hosts) == pytest.approx(expected_squares(rows), rel=1e-9)
    assert (found.hosts**0.5, found.paths**0.5, found.within**0.5) == pytest.approx((0.1, 0.07, 0.05), rel=0.35)


def test_posteriors_are_those_of_the_full_covariance(spark):
    """Each document's site, without the document: conditional mean of a normal model with all covariances written out."""
    rows = nested(8, lambda h: 1 + h % 3, lambda h, p: 1 + (h + 2 * p) % 5, 0.1, 0.05, 0.08, seed=4) + [("lone", "only", 0.9), (None, None, 0.2)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, " + SCORED)
    sites, spread = quality.site_statistics(df)
    joined = df.join(sites, df["host"].eqNullSafe(sites["site_host"]) & df["path"].eqNullSafe(sites["site_path"]))
    found = {r["k"]: (r["loo"], r["whole"]) for r in joined.select("k", quality.site_posterior(spread, F.col("p")).alias("loo"), quality.site_posterior(spread).alias("whole")).collect()}
    y = np.array([r[2] for r in rows])
    host = np.array([[a[0] == b[0] for b in rows] for a in rows])
    path = np.array([[a[:2] == b[:2] for b in rows] for a in rows])
    shared = host * spread.hosts + path * spread.paths
    full = shared + np.eye(len(rows)) * spread.within
    for k in range(len(rows)):
        for own, got in ((np.arange(len(rows)) != k, found[k][0]), (np.ones(len(rows), bool), found[k][1])):
            want = spread.mean + shared[k, own] @ np.linalg.solve(full[np.ix_(own, own)], y[own] - spread.mean)
            assert got == pytest.approx(want, abs=1e-9)


def test_sparse_sites_are_shrunk(spark):
    """Hosts of one path each that differ by their paths alone: a host is hardly known from it, and its sites go to the global mean."""
    rows = nested(50, lambda h: 2, lambda h, p: 200 if p == 0 else 1, 0.0, 0.15, 0.05, seed=6)
    sites, spread = quality.site_statistics(spark.createDataFrame(rows, SCORED))
    assert spread.hosts < 0.15**2 / 4
    moved = sites.where("docs = 1").select(F.abs(quality.site_posterior(spread) - spread.mean), F.abs(F.col("total") - spread.mean)).collect()
    large = sites.where("docs = 200").select(F.abs(quality.site_posterior(spread) - F.col("total") / 200)).collect()
    assert max(r[0] for r in large) < 0.01
    assert sum(r[0] for r in moved) < 1.1 * sum(r[1] for r in moved)


def test_no_sites(spark):
    sites, spread = quality.site_statistics(spark.createDataFrame([], SCORED))
    assert sites.count() == 0 and spread.mean == 0.5
    one, spread = quality.site_statistics(spark.createDataFrame([("a", "b", 0.7)], SCORED))
    assert one.select(quality.site_posterior(spread, F.lit(0.7))).first()[0] == pytest.approx(0.7)


def plain_logistic(x, y, penalty=1e-3, steps=60):
    """Newton's method for the mean log loss plus half the squared weights of scaled features; (intercept, weights)."""
    deviation = x.std(0, ddof=1)
    used = deviation > 0
    z = np.column_stack([np.ones(len(x)), x[:, used] / deviation[used]])
    ridge = np.diag([0.0] + [penalty] * int(used.sum()))
    w = np.zeros(z.shape[1])
    loss = lambda v: np.mean(np.logaddexp(0, z @ v) - y * (z @ v)) + 0.5 * v @ ridge @ v
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(z @ w)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z / len(x) + ridge + 1e-12 * np.eye(len(w)), z.T @ (p - y) / len(x) + ridge @ w)
        scale = 1.0
        while loss(w - scale * step) > loss(w) and scale > 1e-6:
            scale /= 2
        w = w - scale * step
    weights = np.zeros(x.shape[1])
    weights[used] = w[1:] / deviation[used]
    return w[0], weights


def test_the_chain_equals_a_plain_one(spark, corpus):
    """Same features, own folds loop and own fits: junk from shape and terms, toxic from terms and the odds that models of other folds give."""
    docs, labels, _ = corpus
    chain = toxicity.fit_chain(docs, toxicity.toxicity_labels(labels), toxicity.CATEGORIES)
    known = toxicity.labelled_sample(docs, toxicity.toxicity_labels(labels), "doc_id", "text", toxicity.CATEGORIES, toxicity.SAMPLE)
    table = toxicity.feature_table(known, chain.selection, toxicity.CATEGORIES)
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.col("doc")), F.lit(toxicity.FOLDS))
    rows = table.select("values", "junk", "toxic", fold.alias("fold")).collect()
    x, junk, toxic, folds = (np.array([r[c] for r in rows], float) for c in ("values", "junk", "toxic", "fold"))
    shapes = len(toxicity.SHAPES)
    clip = lambda v: np.clip(v, -toxicity.LIMIT, toxicity.LIMIT)
    first = plain_logistic(x, junk)
    odds = np.zeros(len(x))
    for k in range(toxicity.FOLDS):
        intercept, weights = plain_logistic(x[folds != k], junk[folds != k])
        odds[folds == k] = clip(intercept + x[folds == k] @ weights)
    second = plain_logistic(np.column_stack([x[:, shapes:], odds]), toxic)
    own_odds = clip(first[0] + x @ first[1])
    want = 1 / (1 + np.exp(-clip(second[0] + np.column_stack([x[:, shapes:], own_odds]) @ second[1])))
    (i1, w1), (i2, w2) = chain.models
    got_odds = clip(i1 + x @ w1)
    got = 1 / (1 + np.exp(-clip(i2 + np.column_stack([x, got_odds]) @ w2)))
    assert np.abs(1 / (1 + np.exp(-got_odds)) - 1 / (1 + np.exp(-own_odds))).max() < 0.02
    assert np.abs(got - want).max() < 0.02
    assert ((got >= toxicity.THRESHOLD) == (want >= toxicity.THRESHOLD)).all()
