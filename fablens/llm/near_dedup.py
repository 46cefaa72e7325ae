"""Near-duplicate classes by min-max hashing, confirmed on full shingle sets.

Every permutation of the shingle hashes gives two signature values, its minimum and its maximum: half
the hash evaluations of a minimum each. A band takes both values of ``BAND_HASHES`` permutations.

1. One pass over the texts writes, per document, the set's size, its digest and the band keys.
2. Documents with equal sets are one class; only its smallest id goes on.
3. Documents that share a band key are candidates. In each bucket all members are compared with its
   pivot, the smallest one. Only buckets whose other members then lie in several components stay.
4. There, every pair of members of different components is estimated by longer min-max sketches, inside
   the tasks that hold the bucket (a large bucket is dealt to cells of bounded size). First each
   member's best partners are confirmed; then all pairs still in different components whose estimate
   allows the similarity, with a margin of over four standard deviations.
5. Links are confirmed on the whole texts and joined to components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fablens.llm import textarrays as T
from fablens.llm.components import connected_components
from fablens.sources.shared import materialize

WORDS = 5
PERCENT = 75
BANDS = 32
BAND_HASHES = 2
PIVOT_SHARE = 64
SKETCH_HASHES = 256
# 0.75 less 4.2 standard deviations of an estimate from 512 values.
ESTIMATE = 0.67
BEST = 2
CELL = 2048

_PERMUTATIONS = np.random.default_rng(61).integers(0, 1 << 63, BANDS * BAND_HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_SKETCH = np.random.default_rng(62).integers(0, 1 << 63, SKETCH_HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(buffer: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct shingle hashes, sorted within the row, and each row's first."""
    starts, _, firsts = T.words(buffer, offsets)
    hashes, first = T.shingle_hashes(T.word_hashes(buffer, starts), firsts, words)
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.uint64), np.diff(first))
    if len(offsets) <= 1 << 16:
        key = (row << np.uint64(48)) | (hashes >> np.uint64(16))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        if (hashes[order][1:] != hashes[order][:-1])[same].any():
            order = np.lexsort((hashes, row))
    else:
        order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    hashes, row = hashes[new], row[new]
    return hashes, np.searchsorted(row, np.arange(len(offsets)))


def band_keys(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Band keys (rows with shingles only) from minima and maxima under each permutation."""
    at = firsts[:-1][np.diff(firsts) > 0]
    keys = np.empty((len(at), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(at), band + 1, np.uint64)
        for factor in _PERMUTATIONS[band * BAND_HASHES : (band + 1) * BAND_HASHES]:
            values = hashes * factor
            for extreme in (np.minimum.reduceat(values, at), np.maximum.reduceat(values, at)):
                key = T.mix(key * np.uint64(0xA24BAED4963EE407) + extreme)
        keys[:, band] = key
    return keys


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc``, ``n_shingles``, ``digest`` of the set and ``bands`` (null without shingles)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, buffer, offsets in T.chunks(batch.column(1)):
                hashes, firsts = shingle_sets(buffer, offsets)
                sizes = np.diff(firsts)
                full = sizes > 0
                keys = band_keys(hashes, firsts) if full.any() else np.zeros((0, BANDS), np.uint64)
                digests = [
                    hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() if b > a else None
                    for a, b in zip(firsts[:-1], firsts[1:])
                ]
                ends = np.concatenate([[0], np.cumsum(full * BANDS)]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at), pa.array(sizes), pa.array(digests, pa.binary()), bands],
                    names=["doc", "n_shingles", "digest", "bands"],
                )

    return docs.select(id_col, text_col).mapInArrow(
        sign, f"doc {kind}, n_shingles long, digest binary, bands array<long>"
    )


def confirmed_links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) whose sets meet the similarity.

    Texts meet by the first id, whose own text comes first; an id with many partners is dealt to many tasks.
    """
    spark = pairs.sparkSession
    kind = pairs.schema["a"].dataType.simpleString()
    shares = materialize(pairs.groupBy("a").agg(F.ceil(F.count("*") / PIVOT_SHARE).alias("shares")), "shares")
    # Only ids with many partners are dealt; they are few, so that pairs need not meet by a hot id to learn its shares.
    many = materialize(shares.filter("shares > 1"), "many-shares")
    part = F.coalesce(F.pmod(F.xxhash64("b"), F.col("shares")), F.lit(0)).cast("int")
    dealt = pairs.join(many, "a", "left").select("a", "b", part.alias("part"))
    members = dealt.join(texts, dealt["b"] == texts["doc"]).select("a", "part", "b", "text")
    heads = shares.join(texts, shares["a"] == texts["doc"]).select(
        "a",
        F.explode(F.sequence(F.lit(0), (F.col("shares") - 1).cast("int"))).alias("part"),
        F.lit(None).cast(kind).alias("b"),
        "text",
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = heads.unionByName(members).repartition(n, "a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, own = None, []
        for batch in batches:
            firsts, parts, seconds = (batch.column(i).to_pylist() for i in (0, 1, 2))
            found_a, found_b = [], []
            for at, end, buffer, offsets in T.chunks(batch.column(3)):
                hashes, first = shingle_sets(buffer, offsets)
                for i in range(at, end):
                    mine = hashes[first[i - at] : first[i - at + 1]]
                    if pivot != (firsts[i], parts[i]):
                        pivot, own = (firsts[i], parts[i]), []
                    if seconds[i] is None:
                        own.append(mine.copy())
                    elif any(_linked(mine, other) for other in own):
                        found_a.append(firsts[i])
                        found_b.append(seconds[i])
            yield pa.RecordBatch.from_arrays(
                [pa.array(found_a, batch.schema.field(0).type), pa.array(found_b, batch.schema.field(2).type)], names=["a", "b"]
            )

    return met.mapInArrow(compare, f"a {kind}, b {kind}")


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def sketches(texts: DataFrame) -> DataFrame:
    """``doc`` and ``sketch``: one byte of the minimum and the maximum under each sketch permutation."""
    kind = texts.schema["doc"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, buffer, offsets in T.chunks(batch.column(1)):
                hashes, firsts = shingle_sets(buffer, offsets)
                full = np.flatnonzero(np.diff(firsts) > 0)
                out = np.zeros((end - at, 2 * SKETCH_HASHES), np.uint8)
                if len(full):
                    for i, factor in enumerate(_SKETCH):
                        values = hashes * factor
                        for k, extreme in enumerate((np.minimum, np.maximum)):
                            out[full, 2 * i + k] = T.mix(extreme.reduceat(values, firsts[full])) & np.uint64(255)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at), pa.array([r.tobytes() for r in out], pa.binary())], names=["doc", "sketch"]
                )

    return texts.mapInArrow(sign, f"doc {kind}, sketch binary")


def likely_pairs(members: DataFrame, best: int | None) -> DataFrame:
    """Pairs (``a`` < ``b``) of a bucket's members in different components whose sketches allow the similarity.

    ``members`` has ``band``, ``doc``, ``size``, ``component``, ``bands`` and ``sketch``. With ``best`` only each member's most similar
    partners; otherwise all, each in the first band that the two share.
    """
    spark = members.sparkSession
    kind = members.schema["doc"].dataType.simpleString()
    cells = members.groupBy("band").agg(F.ceil(F.count("*") / CELL).cast("int").alias("cells"))
    cells = materialize(cells, "cells")
    block = F.pmod(F.xxhash64("doc"), F.col("cells")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("cells") - 1))
    dealt = members.join(cells, "band").withColumn("block", block).withColumn("other", other)
    dealt = dealt.select(
        "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "doc", "size", "component", "bands", "sketch"
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(n, "band", "i", "j").sortWithinPartitions("band", "i", "j")

    def pairs(group: pa.Table) -> pa.RecordBatch:
        group = group.combine_chunks()
        column = lambda name: group.column(name).combine_chunks()
        i, j, band = (group.column(c)[0].as_py() for c in ("i", "j", "band"))
        docs, rows = column("doc"), group.num_rows
        size, side = column("size").to_numpy(), column("block").to_numpy()
        component = column("component").dictionary_encode().indices.to_numpy()
        sketch = np.frombuffer(b"".join(column("sketch").to_pylist()), np.uint8).reshape(rows, -1)
        keys = column("bands").flatten().to_numpy().reshape(rows, -1)
        near: list[tuple] = []
        for p in range(rows):
            if i == j:
                q = np.arange(p + 1, rows)
            elif side[p] == i:
                q = np.flatnonzero(side == j)
            else:
                continue
            small, large = np.minimum(size[q], size[p]), np.maximum(size[q], size[p])
            q = q[(component[q] != component[p]) & (100 * small >= PERCENT * large)]
            if len(q):
                agree = np.count_nonzero(sketch[q] == sketch[p], axis=1) / sketch.shape[1]
                estimate = (agree - 1 / 256) / (1 - 1 / 256)
                fits = estimate >= ESTIMATE
                near += [(p, x, e) for x, e in zip(q[fits].tolist(), estimate[fits].tolist())]
        left, right = (np.array([x[k] for x in near], np.int64) for k in (0, 1))
        if best is None:
            first = (keys[left] == keys[right]).argmax(axis=1) if len(near) else left
            kept = np.flatnonzero(keys[left, first] == band)
        else:
            score = np.array([x[2] for x in near])
            both, whose = np.concatenate([left, right]), np.tile(np.arange(len(near)), 2)
            order = np.lexsort((-score[whose], both))
            begin = np.searchsorted(both[order], both[order])
            kept = np.unique(whose[order][np.arange(len(order)) - begin < best])
        return pa.RecordBatch.from_arrays([docs.take(pa.array(left[kept])), docs.take(pa.array(right[kept]))], names=["a", "b"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            key = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if last is not None and tuple(key[a]) != last:
                    yield pairs(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
                last = tuple(key[a])
        if held:
            yield pairs(pa.Table.from_batches(held))

    found = dealt.mapInArrow(search, f"a {kind}, b {kind}")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Words are runs without white space, A-Z lower-cased; a set holds the distinct shingles of five words, or the
    whole sequence where there are fewer. Two documents are linked if 100 * shared >= 75 * united;
    ``component_id`` is the smallest id reachable over links; ``kept`` marks that document. A null or empty text, or one of white
    space, has no shingles, is linked with nothing and kept. A null id takes no part: its
    component is null and it is kept. Rows that repeat an id are one document, linked by any of their
    texts. An empty table gives no rows; other columns are not read. A very long text is worked whole, as one chunk, in about 30 times its size of memory.
    """
    signed = materialize(signatures(docs, id_col, text_col), "signatures")
    sets = signed.filter(F.col("doc").isNotNull() & F.col("digest").isNotNull())
    classes = sets.groupBy("digest").agg(F.min("doc").alias("rep"), F.first("bands").alias("bands"), F.first("n_shingles").alias("size"))
    classes = materialize(classes, "classes")
    banded = classes.select(F.col("rep").alias("doc"), "size", F.explode("bands").alias("band")).distinct()
    # The pivot's size travels with its bucket: the least and the greatest, should its id have several texts.
    least = F.min(F.struct("doc", "size"))
    most = F.min(F.struct("doc", (-F.col("size")).alias("size")))
    buckets = banded.groupBy("band").agg(F.count("*").alias("n"), least.alias("least"), most.alias("most")).filter("n > 1")
    buckets = buckets.select("band", F.col("least.doc").alias("pivot"), F.col("least.size").alias("low"), (-F.col("most.size")).alias("high"))
    members = materialize(banded.join(materialize(buckets, "buckets"), "band").select("band", "doc", "size", "pivot", "low", "high"), "members")

    wanted = members.select("doc").distinct()
    named = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).filter("doc is not null and text is not null")
    texts = materialize(named.join(wanted, "doc", "left_semi").distinct(), "candidate-texts")

    fits = (100 * F.col("size") >= PERCENT * F.col("low")) & (100 * F.col("high") >= PERCENT * F.col("size"))
    pairs = members.filter((F.col("doc") != F.col("pivot")) & fits).select(F.col("pivot").alias("a"), F.col("doc").alias("b"))
    tested = materialize(pairs.distinct(), "pairs")
    same = sets.select("doc", "digest").join(classes.select("digest", "rep"), "digest").filter(F.col("doc") != F.col("rep"))
    same = same.select(F.col("rep").alias("a"), F.col("doc").alias("b"))
    links = materialize(confirmed_links(tested, texts).unionByName(same), "links")
    found = materialize(connected_components(links), "components")

    # What the pivots have not settled: buckets whose other members lie in several components.
    others = members.filter(F.col("doc") != F.col("pivot")).select("band", "doc", "size")
    own = F.coalesce("component", "doc").alias("component")
    rest = others.join(found, others["doc"] == found["node"], "left").select("band", "doc", "size", own)
    mixed = rest.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    rest = materialize(rest.join(materialize(mixed.select("band"), "buckets"), "band"), "members")
    wanted = rest.select("doc").distinct()
    sketched = sketches(texts.join(wanted, "doc", "left_semi")).groupBy("doc").agg(F.first("sketch").alias("sketch"))
    keyed = classes.groupBy(F.col("rep").alias("doc")).agg(F.first("bands").alias("bands"))
    sketched = materialize(sketched.join(keyed, "doc"), "sketches")
    for best in (BEST, None):
        now = rest.select("band", "doc", "size").join(found, F.col("doc") == F.col("node"), "left").select("band", "doc", "size", own)
        pairs = likely_pairs(now.join(sketched, "doc"), best).join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        tested = tested.unionByName(pairs)
        new = materialize(confirmed_links(pairs, texts), "links")
        if new.limit(1).count():
            # Components so far are single nodes of the next graph.
            ends = found.select("node", "component")
            step = new.join(ends, new["a"] == ends["node"], "left").select(F.coalesce("component", "a").alias("x"), "b")
            step = step.join(ends, step["b"] == ends["node"], "left").select("x", F.coalesce("component", "b").alias("y"))
            merged = materialize(connected_components(step), "components")
            merged = merged.select(F.col("node").alias("part"), F.col("component").alias("whole"))
            whole = found.join(merged, F.col("component") == F.col("part"), "left")
            whole = whole.select("node", F.coalesce("whole", "component").alias("component"))
            found = materialize(whole.unionByName(merged.select(F.col("part").alias("node"), F.col("whole").alias("component"))).distinct(), "components")
    joined = signed.select("doc", "n_shingles").join(found, F.col("doc") == F.col("node"), "left")
    component = F.coalesce("component", "doc")
    return joined.select(
        F.col("doc").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"),
    )


def remove_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, of the document that each class keeps.

    Of rows that repeat an id one stays; rows with a null id all stay.
    """
    judged = materialize(near_duplicates(docs, id_col, text_col).select(F.col(id_col).alias("judged"), "kept"), "judged")
    gone = materialize(judged.filter(~F.col("kept")).select("judged").distinct(), "dropped")
    again = judged.filter(F.col("judged").isNotNull()).groupBy("judged").count().filter("count > 1").select("judged")
    again = materialize(again, "repeated-ids")
    rest = docs.join(gone, docs[id_col] == gone["judged"], "left_anti")
    if not again.limit(1).count():
        return rest
    once = rest.join(again, rest[id_col] == again["judged"], "left_anti")
    many = rest.join(again, rest[id_col] == again["judged"], "left_semi").dropDuplicates([id_col])
    return once.unionByName(many)
