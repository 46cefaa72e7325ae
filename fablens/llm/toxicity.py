"""Toxicity by a classifier chain of linear models.

The categories are predicted one after the other. Each later model also sees the log-odds
of the earlier categories; it is trained on out-of-fold predictions, which look like those that unseen documents get.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fablens.llm import textarrays as T
from fablens.llm.features import SHAPES, Chunk, Selection, feature_table, labelled_sample, select_terms
from fablens.sources.shared import discard, materialize

SAMPLE = 20_000
TERMS = 384
LEAST_SHARE = 0.002
FOLDS = 3
THRESHOLD = 0.4
# Categories that the text's shape tells about; the others see terms only.
SHAPED = ("junk",)
LIMIT = 8.0


class Chain:
    """Coefficients of the chain: per category an intercept, weights of shapes, terms and earlier log-odds."""

    def __init__(self, categories: list[str], selection: Selection, models: list[tuple[float, np.ndarray]]):
        self.categories, self.selection, self.models = categories, selection, models

    def predict(self, buffer: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probabilities of the categories, one row per text."""
        chunk = Chunk(buffer, offsets)
        shapes, (rows, number, weight) = chunk.shapes(), chunk.selected(self.selection)
        odds = np.zeros((chunk.rows, len(self.categories)))
        base = len(SHAPES) + len(self.selection)
        for k, (intercept, weights) in enumerate(self.models):
            own = intercept + shapes @ weights[: len(SHAPES)] + odds[:, :k] @ weights[base:]
            own += np.bincount(rows, weight * weights[len(SHAPES) + number], chunk.rows)
            odds[:, k] = np.clip(own, -LIMIT, LIMIT)
        return 1 / (1 + np.exp(-odds))


def _odds(probability):
    raw = F.log(F.greatest(probability, F.lit(1e-12)) / F.greatest(1 - probability, F.lit(1e-12)))
    return F.greatest(F.least(raw, F.lit(LIMIT)), F.lit(-LIMIT))


def _vectors():
    shape, terms = F.slice("values", 1, len(SHAPES)), F.slice("values", len(SHAPES) + 1, 1 << 20)
    return array_to_vector(shape).alias("shape"), array_to_vector(terms).alias("terms")


def _fit(rows: DataFrame, label: str):
    return LogisticRegression(featuresCol="features", labelCol=label, maxIter=40, regParam=1e-3).fit(rows)


def fit_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
) -> Chain | None:
    """Fit on at most about ``sample`` labelled documents; None without any. ``categories`` are 0/1 columns of ``labels``."""
    known = labelled_sample(docs, labels, id_col, text_col, categories, sample)
    selection = select_terms(known, categories, TERMS, LEAST_SHARE)
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.col("doc")), F.lit(FOLDS)).cast("int")
    rows = feature_table(known, selection, categories)
    rows = rows.select("doc", *categories, fold.alias("fold"), *_vectors())
    rows = materialize(rows, "features")
    if not rows.limit(1).count():
        return None
    models, earlier = [], []
    for category in categories:
        used = ["shape"] * (category in SHAPED) + ["terms"] * bool(len(selection)) + earlier
        inputs = VectorAssembler(inputCols=used, outputCol="features").transform(rows).cache()
        whole = _fit(inputs, category)
        weights = whole.coefficients.toArray()
        if category not in SHAPED:
            weights = np.concatenate([np.zeros(len(SHAPES)), weights])
        models.append((float(np.clip(whole.intercept, -LIMIT, LIMIT)), weights))
        if category != categories[-1]:
            odds, parts = f"odds_{len(earlier)}", []
            for k in range(FOLDS):
                train = inputs.filter(F.col("fold") != k)
                held = inputs.filter(F.col("fold") == k)
                model = _fit(train, category) if train.limit(1).count() else whole
                parts.append(model.transform(held).withColumn(odds, _odds(vector_to_array("probability")[1])))
            kept = [*rows.columns, odds]
            after = materialize(reduce(DataFrame.unionByName, [p.select(*kept) for p in parts]), "features")
            inputs.unpersist()
            discard(rows)
            rows = after
            earlier.append(odds)
        else:
            inputs.unpersist()
    discard(known, rows)
    return Chain(categories, selection, models)


def score_documents(docs: DataFrame, chain: Chain | None, categories: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``p_<category>`` of each category; without a chain all are 0.

    A null text counts as empty and gets 0. Columns of the same names are replaced.
    """
    names = [f"p_{c}" for c in categories]
    kept = [c for c in docs.columns if c not in names]
    if chain is None:
        return docs.select(*[F.col(f"`{c}`") for c in kept], *[F.lit(0.0).alias(n) for n in names])
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    at_text = kept.index(text_col)
    fields = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in kept)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, buffer, offsets in T.chunks(batch.column(at_text)):
                found = shared.value.predict(buffer, offsets)
                found[np.diff(offsets) == 0] = 0
                columns = [c.slice(at, end - at) for c in batch.columns]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(p) for p in found.T]], names=[*kept, *names])

    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(score, fields + ", ".join(f"`{n}` double" for n in names))


def toxicity_labels(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The chain's categories from the labels: junk (quality 0) first, then toxic. Other columns are dropped."""
    return labels.select(id_col, (1 - F.col("quality")).alias("junk"), F.col("toxic").alias("toxic"))


CATEGORIES = ["junk", "toxic"]


def judge_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``id``, ``p_junk``, ``p_toxic`` and ``rejected`` (p_toxic >= threshold) of every row.

    ``labels`` has ``quality`` and ``toxic`` as 0/1. Null and empty texts are never rejected, nor is anything without
    labelled rows. Null and repeated ids stay as they are; an empty table gives no rows. A very long text is worked whole, as one chunk, in about 30 times its size of memory.
    """
    chain = fit_chain(docs, toxicity_labels(labels, id_col), CATEGORIES, id_col, text_col)
    scored = score_documents(docs.select(id_col, text_col), chain, CATEGORIES, id_col, text_col)
    return scored.select(id_col, "p_junk", "p_toxic", (F.col("p_toxic") >= threshold).alias("rejected"))


def remove_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that are not rejected; ``p_junk`` and ``p_toxic`` columns of the table's own stay.

    Repeated rows and ids are judged row by row; without labelled rows all stay; an empty table stays empty.
    """
    chain = fit_chain(docs, toxicity_labels(labels, id_col), CATEGORIES, id_col, text_col)
    if chain is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    at_text = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, buffer, offsets in T.chunks(batch.column(at_text)):
                clean = (shared.value.predict(buffer, offsets)[:, -1] < threshold) | (np.diff(offsets) == 0)
                yield batch.slice(at, end - at).filter(pa.array(clean))

    return docs.mapInArrow(keep, docs.schema)
