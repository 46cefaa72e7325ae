"""Key checks that grow by a batch: most keys of a batch are cleared by a summary, and only suspects meet the stored history.

The summary is a Bloom filter cut in pieces: a key's hash names a piece, further hashes four bits in it. Pieces are bitmaps of 4 KB that are
built, merged and read by key, so a batch touches the pieces of its own keys and neither the whole summary nor the history
passes through one task. History is stored in folders by piece, so suspects read the folders of their pieces.
A clear answer is certain (the key is not there); a suspected key is looked up, so results are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fablens.sources.shared import materialize
from fablens.sources.sinks import write_table

BITS = 8 * 4096
HASHES = 4
#: Keys of a piece: about 1 % of other keys are then suspected.
PIECE_KEYS = 3000
#: History folders; a folder holds the pieces of equal remainder.
FOLDERS = 64

SUMMARY = "piece bigint, bitmap binary"


def pieces_for(keys: int) -> int:
    """Pieces for a history of so many keys; fixed when the summary is first built, so leave room to grow."""
    return max(1, -(-keys // PIECE_KEYS))


def _piece(key: Column, pieces: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(pieces)).cast("bigint")


def _bits(key: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BITS)).cast("bigint") for i in range(HASHES)])


def summarise(keys: DataFrame, key: str, pieces: int) -> DataFrame:
    """The summary of the keys: one bitmap per piece. NULL keys are left out. Folded in each task before the shuffle."""
    set_bits = keys.where(F.col(key).isNotNull()).select(_piece(F.col(key), pieces).alias("piece"), F.explode(_bits(F.col(key))).alias("bit"))
    return set_bits.groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def merge_summaries(*summaries: DataFrame) -> DataFrame:
    """Bits of any of them. Only pieces that several have are combined."""
    first, *rest = summaries
    for other in rest:
        first = first.unionByName(other)
    return first.groupBy("piece").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def _has(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), bit % 8)) % 2 == 1


def suspects(keys: DataFrame, key: str, summary: DataFrame, pieces: int) -> DataFrame:
    """The keys (one row each) that the summary may hold, with their ``piece``; all others are certainly not there."""
    asked = keys.where(F.col(key).isNotNull()).select(F.col(key).alias("key")).distinct().withColumn("piece", _piece(F.col("key"), pieces))
    met = asked.join(summary, "piece")
    hit = F.forall(_bits(F.col("key")), lambda b: _has(F.col("bitmap"), b))
    return met.where(hit).select("key", "piece")


def store_history(rows: DataFrame, key: str, path: str, pieces: int, mode: str = "append") -> None:
    """Append rows (the key suffices for checks) to the history folders."""
    placed = rows.withColumn("folder", F.pmod(_piece(F.col(key), pieces), F.lit(FOLDERS)).cast("int"))
    write_table(placed, path, mode, ["folder"])


def found_in_history(spark: SparkSession, suspected: DataFrame, key: str, path: str, schema: str, pieces: int) -> DataFrame:
    """The suspected keys that history really holds, with their ``copies``. Reads the suspects' folders and no others."""
    held = materialize(suspected, "suspected-keys")
    folders = [r[0] for r in held.select(F.pmod("piece", F.lit(FOLDERS)).cast("int")).distinct().collect()]
    history = spark.read.schema(f"{schema}, folder int").parquet(path).where(F.col("folder").isin(*folders) if folders else F.lit(False))
    hits = history.select(F.col(key).alias("key")).join(held.select("key"), "key", "left_semi")
    return hits.groupBy("key").agg(F.count("*").alias("copies"))


def repeated_in_batch(spark: SparkSession, batch: DataFrame, key: str, summary: DataFrame, path: str, schema: str, pieces: int) -> DataFrame:
    """``key`` and ``copies`` (in batch and history together) of keys of the batch that are not unique."""
    own = materialize(batch.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count("*").alias("here")), "batch-keys")
    before = found_in_history(spark, suspects(own, "key", summary, pieces), key, path, schema, pieces)
    both = own.join(before, "key", "left").withColumn("copies", F.col("here") + F.coalesce("copies", F.lit(0)))
    return both.where("copies > 1").select("key", "copies")


def orphans_in_batch(spark: SparkSession, child: DataFrame, child_key: str, parents: DataFrame, parent_key: str, summary: DataFrame, path: str, schema: str, pieces: int) -> DataFrame:
    """``key`` and ``rows`` of child keys without a parent in the batch or in history.

    Children of the batch's own parents are settled first; of the others the summary clears most as orphans, and the rest are looked up.
    """
    keys = child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("key")).agg(F.count("*").alias("rows"))
    late = materialize(keys.join(parents.select(F.col(parent_key).alias("key")), "key", "left_anti"), "late-keys")
    known = found_in_history(spark, suspects(late, "key", summary, pieces), parent_key, path, schema, pieces)
    return late.join(known, "key", "left_anti")
