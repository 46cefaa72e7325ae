import zlib

import numpy as np

from fablens.llm import sharding


def jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & (2**64 - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_equals_its_definition():
    keys = np.random.default_rng(1).integers(0, 2**64, 3000, dtype=np.uint64)
    for shards in (1, 2, 40, 41):
        assert sharding.jump_hash(keys.copy(), shards).tolist() == [jump(int(k), shards) for k in keys]


def test_shards_slots_and_growth(documents):
    rows = [(i, f"text {i} é") for i in range(2000)] + [(None, None), (None, "x"), (5, "again"), (5, "again"), (6, "")]
    out = sharding.assign_shards(documents(rows).repartition(7)).collect()
    assert len(out) == len(rows)
    slots = {}
    for r in out:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(40)) and len(slots) == 40
    assert all(r["grown_shard"] in (r["shard"], 40) for r in out)
    moved = sum(r["grown_shard"] == 40 for r in out)
    assert 0 < moved < 2000 * 3 / 41
    want = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in out) == want
    assert len({r["shard"] for r in out if r["doc_id"] == 5}) == 1
    assert {r["law"] for r in out} == {"key"}


def test_same_shards_whatever_the_partitions(documents):
    rows = [(i, "t") for i in range(300)]
    one = {r["doc_id"]: r["shard"] for r in sharding.assign_shards(documents(rows).coalesce(1)).collect()}
    many = {r["doc_id"]: r["shard"] for r in sharding.assign_shards(documents(rows).repartition(9)).collect()}
    assert one == many
    assert sharding.assign_shards(documents(rows).limit(0)).count() == 0


def test_written_shards(documents, spark, tmp_path):
    rows = [(i, f"t{i}") for i in range(100)]
    sharding.write_shards(documents(rows), str(tmp_path / "o"), "doc_id")
    back = spark.read.parquet(str(tmp_path / "o"))
    want = {r["doc_id"]: r["shard"] for r in sharding.assign_shards(documents(rows)).collect()}
    assert {r["doc_id"]: r["shard"] for r in back.collect()} == want
