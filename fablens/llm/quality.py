"""Document quality by hierarchical empirical Bayes: the text's own evidence, its path's and its host's.

A linear classifier gives every document the probability of being good. Grouped sums of it per host and path give each site
a mean; sites with few documents are shrunk towards their host, and hosts with few or unlike paths towards the whole corpus, by
variances estimated from the same sums (expected mean squares of a nested model). A document's odds are its own, moved by
how far its site's posterior, without the document itself, lies from the global mean.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fablens.llm import textarrays as T
from fablens.llm.features import SHAPES, Chunk, Selection, feature_table, labelled_sample, select_terms
from fablens.sources.shared import discard, materialize

SAMPLE = 20_000
TERMS = 128
LEAST_SHARE = 0.002
THRESHOLD = 0.5
LIMIT = 8.0
LEAST_VARIANCE = 1e-6


class Classifier:
    def __init__(self, selection: Selection, intercept: float, weights: np.ndarray):
        self.selection, self.intercept, self.weights = selection, intercept, weights

    def odds(self, buffer: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        chunk = Chunk(buffer, offsets)
        rows, number, weight = chunk.selected(self.selection)
        own = self.intercept + chunk.shapes() @ self.weights[: len(SHAPES)]
        own += np.bincount(rows, weight * self.weights[len(SHAPES) + number], chunk.rows)
        return np.clip(own, -LIMIT, LIMIT)


def fit_classifier(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE
) -> Classifier | None:
    """Fit on at most about ``sample`` labelled documents; None without any."""
    known = labelled_sample(docs, labels, id_col, text_col, [label_col], sample)
    selection = select_terms(known, [label_col], TERMS, LEAST_SHARE)
    rows = feature_table(known, selection, [label_col]).select(label_col, array_to_vector("values").alias("features"))
    rows = materialize(rows, "features")
    if not rows.limit(1).count():
        return None
    model = LogisticRegression(featuresCol="features", labelCol=label_col, maxIter=60, regParam=1e-3).fit(rows)
    found = Classifier(selection, float(np.clip(model.intercept, -1e6, 1e6)), model.coefficients.toArray())
    discard(known, rows)
    return found


@dataclass(frozen=True)
class Spread:
    """The global mean and the variances of documents in a path, of paths in a host and of hosts."""

    mean: float
    within: float
    paths: float
    hosts: float


def _spread(sites: DataFrame, hosts: DataFrame) -> Spread:
    """Variances of the nested model document = mean + host + path + rest, by equating sums of squares to their expectations."""
    n, total, squares, parts, cells, docs_2 = sites.agg(
        F.sum("docs"), F.sum("total"), F.sum("squares"), F.sum(F.col("total") ** 2 / F.col("docs")), F.count("*"), F.sum(F.col("docs") ** 2)
    ).first()
    if not n:
        return Spread(0.5, 1.0, 1.0, 1.0)
    groups, host_parts, path_share, host_docs_2 = hosts.agg(
        F.count("*"), F.sum(F.col("host_total") ** 2 / F.col("host_docs")), F.sum(F.col("host_docs_2") / F.col("host_docs")), F.sum(F.col("host_docs") ** 2)
    ).first()

    def solved(found: float, expected: float, factor: float) -> float:
        return max(LEAST_VARIANCE, (found - expected) / factor) if factor > 0 else LEAST_VARIANCE

    within = solved(squares - parts, 0.0, n - cells)
    paths = solved(parts - host_parts, (cells - groups) * within, n - path_share)
    expected = (groups - 1) * within + (path_share - docs_2 / n) * paths
    return Spread(total / n, within, paths, solved(host_parts - total**2 / n, expected, n - host_docs_2 / n))


def site_statistics(scored: DataFrame) -> tuple[DataFrame, Spread]:
    """``site_host``, ``site_path``, ``docs``, ``total`` of p, and ``host_weight``, ``host_sum`` of the host's paths; and the variances.

    ``scored`` has ``host``, ``path`` (nulls are values of their own) and ``p``. All statistics are sums per site. A path's mean weighs in its
    host by its precision, 1 / (path variance + document variance / documents), so a host of one large path is not a well-known host.
    """
    p = F.col("p")
    sites = scored.groupBy(F.col("host").alias("site_host"), F.col("path").alias("site_path")).agg(
        F.count("*").alias("docs"), F.sum(p).alias("total"), F.sum(p * p).alias("squares")
    )
    sites = materialize(sites, "sites")
    per_host = sites.groupBy(F.col("site_host").alias("of_host")).agg(
        F.sum("docs").alias("host_docs"), F.sum("total").alias("host_total"), F.sum(F.col("docs") ** 2).alias("host_docs_2")
    )
    spread = _spread(sites, materialize(per_host, "hosts"))
    weight = _weight(F.col("docs"), spread)
    weighed = sites.groupBy(F.col("site_host").alias("of_host")).agg(
        F.sum(weight).alias("host_weight"), F.sum(weight * F.col("total") / F.col("docs")).alias("host_sum")
    )
    joined = sites.join(weighed, sites["site_host"].eqNullSafe(weighed["of_host"]))
    return joined.select("site_host", "site_path", "docs", "total", "host_weight", "host_sum"), spread


def _weight(docs: Column, spread: Spread) -> Column:
    """Precision of a path's mean as a measurement of its host; none without documents."""
    return F.when(docs > 0, docs / (spread.within + docs * spread.paths)).otherwise(0.0)


def site_posterior(spread: Spread, own: Column | None = None) -> Column:
    """Posterior mean of a site from its statistics, without a document of evidence ``own`` where one is given.

    The host's mean is shrunk to the global one, the path's to the host's; without the document both are as if it did not exist.
    """
    docs, total = F.col("docs"), F.col("total")
    left, sum_left = (docs, total) if own is None else (docs - 1, total - own)
    before, now = _weight(docs, spread), _weight(left, spread)
    mine = F.when(left > 0, now * sum_left / left).otherwise(0.0)
    host_weight = F.col("host_weight") - before + now + 1 / spread.hosts
    host = (F.col("host_sum") - before * total / docs + mine + spread.mean / spread.hosts) / host_weight
    strength = spread.within / spread.paths
    return (sum_left + strength * host) / (left + strength)


def _odds(probability: Column) -> Column:
    held = F.greatest(F.least(probability, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(held / (1 - held))


def judge_quality(
    docs: DataFrame,
    labels: DataFrame,
    host_col: str = "source",
    path_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``id``, ``p_text``, ``p_site``, ``quality`` (combined probability) and ``kept`` (quality >= threshold) of every row.

    A null text counts as empty; its evidence is neutral (probability 1/2), as is everything without labelled
    rows, and neutral documents of neutral sites are kept. Null hosts and paths are sites of their own. Null and repeated ids stay as
    they are; an empty table gives no rows; other columns are not read. A very long text is worked whole, as one chunk, in about 30 times its size of memory.
    """
    model = fit_classifier(docs, labels, label_col, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.select(F.col(id_col).alias("doc"), F.col(host_col).alias("host"), F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    kinds = [names.schema[c].dataType.simpleString() for c in ("doc", "host", "path")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, buffer, offsets in T.chunks(batch.column(3)):
                odds = np.zeros(end - at)
                if shared.value is not None:
                    odds = np.where(np.diff(offsets) > 0, shared.value.odds(buffer, offsets), 0.0)
                columns = [batch.column(i).slice(at, end - at) for i in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(odds), pa.array(1 / (1 + np.exp(-odds)))], names=["doc", "host", "path", "odds", "p"]
                )

    schema = f"doc {kinds[0]}, host {kinds[1]}, path {kinds[2]}, odds double, p double"
    scored = materialize(names.mapInArrow(score, schema), "scored")
    sites, spread = site_statistics(scored)
    sites = materialize(sites, "site-posteriors")
    same = scored["host"].eqNullSafe(sites["site_host"]) & scored["path"].eqNullSafe(sites["site_path"])
    joined = scored.join(sites, same)
    # The document's own evidence does not count twice.
    joined = joined.withColumn("p_site", site_posterior(spread, F.col("p")))
    odds = F.col("odds") + _odds(F.col("p_site")) - _odds(F.lit(spread.mean))
    combined = 1 / (1 + F.exp(-odds))
    return joined.select(
        F.col("doc").alias(id_col), F.col("p").alias("p_text"), "p_site", combined.alias("quality"), (combined >= threshold - 1e-9).alias("kept")
    )
