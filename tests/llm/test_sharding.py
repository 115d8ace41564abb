import zlib

from pyspark.sql import functions as F

from phenoloom.llm import sharding
from phenoloom.llm.frames import stored
from phenoloom.llm.registry import QUERIES

import phenoloom.llm.queries  # noqa: F401


def test_query(spark, sf, documents):
    df = QUERIES["op2_sharding"](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
    rows = df.collect()
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    assert len(rows) == len(texts)
    assert all(r["size"] == len(texts[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    load, places = {}, {}
    for r in rows:
        load[r.shard] = load.get(r.shard, 0) + r["size"]
        places.setdefault(r.shard, []).append(r.slot)
    assert sorted(load) == list(range(24)) and all(sorted(p) == list(range(len(p))) for p in places.values())
    largest = max(r["size"] for r in rows)
    assert max(load.values()) <= sum(load.values()) / 24 + largest and max(load.values()) - min(load.values()) <= largest


def test_rebalancing_edits_the_map(spark, tmp_path):
    records = stored(spark.range(20_000).select(sharding.virtual_slot("id", slots=1024).alias("virtual_slot"), (F.col("id") % 97 + 1).alias("size")))
    weights = sharding.slot_bytes(records)
    path = str(tmp_path / "map")
    sharding.write_version(sharding.rebalance(sharding.first_map(spark, 8, 1024), weights, 8), path)
    sharding.write_version(sharding.rebalance(sharding.read_version(spark, path), weights, 9), path)
    versions = {v: dict((r.virtual_slot, r.shard) for r in sharding.read_version(spark, path, v).collect()) for v in (2, 3)}
    assert sharding.read_version(spark, path).first().version == 3
    size = {r.virtual_slot: r.bytes for r in weights.collect()}
    moved = [s for s in range(1024) if versions[2][s] != versions[3][s]]
    assert {versions[3][s] for s in range(1024)} == set(range(9))
    assert sum(size.get(s, 0) for s in moved) <= 1.1 * sum(size.values()) / 9  # hardly more than the new share
    back = sharding.rebalance(sharding.read_version(spark, path, 3), weights, 8).collect()
    assert {r.shard for r in back} == set(range(8)) and len(back) == 1024
    for shards, found in ((8, versions[2]), (9, versions[3]), (8, {r.virtual_slot: r.shard for r in back})):
        load = [sum(size.get(s, 0) for s in range(1024) if found[s] == k) for k in range(shards)]
        assert max(load) - min(load) <= max(size.values())


def test_odd_rows(spark, odd_documents):
    text = F.coalesce("text", F.lit(""))
    facts = odd_documents.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    records = stored(facts.withColumn("virtual_slot", sharding.virtual_slot("doc_id", "text_crc32", slots=64)))
    weights = sharding.slot_bytes(records)
    slot_map = sharding.rebalance(sharding.first_map(spark, 4, 64), weights, 4)
    rows = sharding.placed(records, slot_map, weights, ["doc_id", "text_crc32"]).collect()
    assert len(rows) == 17
    for shard in {r.shard for r in rows}:
        places = sorted(r.slot for r in rows if r.shard == shard)
        assert places == list(range(len(places)))
    none = records.limit(0)
    empty = sharding.slot_bytes(none)
    assert sharding.placed(none, sharding.rebalance(sharding.first_map(spark, 4, 64), empty, 4), empty, ["doc_id"]).count() == 0
