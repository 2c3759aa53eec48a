from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomstream.llm import sharding as sh
from loomstream.llm.common import scratch_dir

SMALL = sh.Params(target=40_000, smallest=1_000, fanout=3, keep_seconds=0)


def rows(n, seed):
    rng = random.Random(seed)
    return [(i, rng.randbytes(50).hex() if i % 7 else None, "x") for i in range(n)]


def test_store_keeps_every_row_and_compacts(spark):
    store = sh.ShardStore(spark, scratch_dir(spark), SMALL)
    want = Counter()
    for k in range(7):
        part = rows(60 * (k + 1), k)
        want.update(part)
        df = spark.createDataFrame(part, "doc_id long, text string, tier string").repartition(3)
        before = store.manifest()[0]
        assert store.append(df) == before + 1
        store.compact()
        assert not sh.plan(store.manifest()[1], SMALL)
    version, shards, _ = store.manifest()
    assert Counter(tuple(r) for r in store.spark.read.parquet(*[f"{store.root}/{s.file}" for s in shards]).collect()) == want
    assert sum(s.rows for s in shards) == sum(want.values()) and len(shards) < 9
    assert store.versions() == [version]


def test_conflicting_commit_fails_and_append_recovers(spark):
    store = sh.ShardStore(spark, scratch_dir(spark), SMALL)
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    store.append(df)
    version, shards, schema = store.manifest()
    store.commit(version + 1, shards, schema)
    with pytest.raises(sh.CommitConflict):
        store.commit(version + 1, [], schema)
    assert store.manifest()[1] == shards
    store.append(df)
    assert store.read().count() == 2


def test_plan_by_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        shards = [sh.Shard(str(i), 1, rng.choice([10, 900, 1_500, 2_900, 3_100, 8_000, 19_999, 20_000, 50_000])) for i in range(rng.randint(0, 25))]
        runs = sh.plan(shards, SMALL)
        merged = {s.file for r in runs for s in r}
        for s in shards:
            like = [t for t in shards if t.bytes < 20_000 and sh.tier_of(t.bytes, SMALL) == sh.tier_of(s.bytes, SMALL)]
            assert (s.file in merged) == (s.bytes < 20_000 and len(like) >= 3)


def test_query_against_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sh.placements(docs)
    want = docs.select("doc_id", F.length("text").cast("long"), F.sha2("text", 256))
    assert sorted(map(tuple, got.select("doc_id", "n_chars", "text_sha256").collect())) == sorted(map(tuple, want.collect()))
    assert sh.placements(docs.limit(0)).count() == 0


def test_clashing_names(spark):
    store = sh.ShardStore(spark, scratch_dir(spark), SMALL)
    store.append(spark.createDataFrame([(1, "a", 9, 9)], "doc_id long, text string, tier int, shard int"))
    assert [tuple(r)[:4] for r in store.read().collect()] == [(1, "a", 9, 9)]


def data_files(store):
    return {s.getPath().getName() for f in store.fs.listStatus(store.hadoop.Path(f"{store.root}/data")) for s in store.fs.listStatus(f.getPath()) if s.getPath().getName().endswith(".parquet")}


def test_open_reader_outlives_compaction(spark):
    store = sh.ShardStore(spark, scratch_dir(spark), sh.Params(target=40_000, smallest=1_000, fanout=3))
    store.append(spark.createDataFrame(rows(300, 1), "doc_id long, text string, tier string").repartition(6))
    version, shards, _ = store.manifest()
    reader = store.read()
    assert store.compact() > version and store.manifest()[1] != shards
    assert reader.count() == 300 and store.read(version).count() == 300


def test_vacuum_removes_what_no_manifest_names(spark):
    store = sh.ShardStore(spark, scratch_dir(spark), SMALL)
    df = spark.createDataFrame(rows(300, 1), "doc_id long, text string, tier string").repartition(6)
    store.write(df)  # a writer that is lost before its commit
    store.append(df)
    store.compact()
    store.vacuum()
    assert data_files(store) == {s.file.rsplit("/", 1)[1] for s in store.manifest()[1]} and store.read().count() == 300


def test_beaten_compaction_leaves_nothing(spark, monkeypatch):
    store = sh.ShardStore(spark, scratch_dir(spark), sh.Params(target=40_000, smallest=1_000, fanout=3))
    store.append(spark.createDataFrame(rows(300, 1), "doc_id long, text string, tier string").repartition(6))
    before, commit, calls = data_files(store), store.commit, []

    def beaten(version, shards, schema):
        calls.append(version)
        if len(calls) == 1:
            commit(version, store.manifest()[1], schema)  # another writer's version of the same number
        return commit(version, shards, schema)

    monkeypatch.setattr(store, "commit", beaten)
    store.compact()
    assert len(calls) == 2 and data_files(store) == before | {s.file.rsplit("/", 1)[1] for s in store.manifest()[1]} and store.read().count() == 300
