from collections import Counter

import pytest
from pyspark.sql import functions as F

from wirelens.llm.sharding import Conflict, ShardedTable, arrive, op8_sharding


@pytest.fixture
def table(spark, tmp_path):
    return ShardedTable(spark, f"file://{tmp_path}/shards")


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_append_compact_vacuum(spark, table):
    parts = []
    for k in range(6):
        part = spark.range(k * 100, k * 100 + 100, 1, 2).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 7 > 0, F.repeat(F.lit("text "), 40)).alias("text"), F.lit(None).cast("string").alias("shard"))
        assert table.append(part)["version"] == k + 1
        parts.append(part)
    whole = sum((rows(p) for p in parts), Counter())
    before = table.manifest()
    assert len(before["shards"]) == 12 and rows(table.read()) == whole
    after = table.compact(target=1 << 20)
    assert after["version"] > 6 and len(after["shards"]) < 4
    assert rows(table.read()) == whole == rows(table.read(version=6))
    assert rows(table.read(version=2)) == rows(parts[0]) + rows(parts[1])
    again = table.compact(target=1 << 20)
    assert again == after
    table.vacuum()
    assert rows(table.read()) == whole
    kept = {f"{f}/{n}" for f, _ in table._list("data") for n, _ in table._list(f"data/{f}") if n.endswith(".parquet")}
    assert {f"data/{k}" for k in kept} == {s["name"] for s in after["shards"]}


def test_tiers(table):
    shards = [{"name": str(i), "bytes": b} for i, b in enumerate([10, 11, 12, 13, 100, 120, 900, 1000, 0, 70, 80])]
    assert [[s["bytes"] for s in tier] for tier in table.plan({"shards": shards}, 1000, 4)] == [[10, 11, 12, 13], [100, 120, 70, 80]]
    assert table.plan({"shards": shards[4:9]}, 1000, 4) == []


def test_tiers_are_merged_apart(spark, table):
    """Tiny shards aren't merged with large ones; what they become fills the next tier."""
    large = spark.range(0, 40_000, 1, 4).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    tiny = spark.range(40_000, 40_040, 1, 4).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    table.append(large)
    table.append(tiny)
    big = {s["name"] for s in table.manifest()["shards"] if s["bytes"] > 100_000}
    assert len(big) == 4
    done = table.compact(target=2 * max(s["bytes"] for s in table.manifest()["shards"]))
    first = table.manifest(3)["shards"]
    assert big <= {s["name"] for s in first} and len(first) < 8
    assert done["version"] == 4 and not big & {s["name"] for s in done["shards"]}
    assert rows(table.read()) == rows(large.unionByName(tiny))


def test_null_and_very_long_texts(spark, table, tmp_path):
    docs = [(1, "x" * 3_000_000), (None, None), (None, None), (2, ""), (2, "")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    arrive(table, f"{tmp_path}/docs")
    assert rows(table.read()) == Counter(docs)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/none")
    empty = ShardedTable(spark, f"file://{tmp_path}/empty")
    arrive(empty, f"{tmp_path}/none")
    assert empty.read().count() == 0 and empty.read().columns == ["doc_id", "text"]


def test_many_writers(spark, table):
    """Writers that start from one version at the same time: one commits each version, none is lost."""
    from concurrent.futures import ThreadPoolExecutor

    table.append(spark.range(1))

    def write(k):
        shards = table._write(spark.range(100 * k, 100 * k + 3))
        while True:
            try:
                base = table.manifest()
                return table.commit(base, shards, set(), base["schema"])["version"]
            except Conflict:
                pass

    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(write, range(1, 9)))
    assert table.version() == 1 + len(set(versions)) and table.read().count() == 1 + 3 * len(set(versions))
    assert not [n for n, _ in table._list("manifest") if n.startswith(".draft")]


def test_one_of_two_writers_commits(spark, table):
    table.append(spark.range(5))
    base = table.manifest()
    first, second = table._write(spark.range(5, 7)), table._write(spark.range(7, 9))
    table.commit(base, first, set(), base["schema"])
    with pytest.raises(Conflict):
        table.commit(base, second, set(), base["schema"])
    assert sorted(r.id for r in table.read().collect()) == list(range(7))
    assert table.version() == 2


def test_empty(spark, table):
    with pytest.raises(ValueError):
        table.read()
    table.append(spark.range(3).where("id < 0"))
    table.compact()
    assert table.read().columns == ["id"] and table.read().count() == 0


def test_shards_near_the_target(spark, table, tmp_path):
    """An input of many times the target, in row groups that can be split."""
    docs = spark.range(0, 40_000, 1, 2).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    docs.write.option("parquet.block.size", 64 << 10).parquet(f"{tmp_path}/docs")
    target, docs = 256 << 10, spark.read.parquet(f"{tmp_path}/docs")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    done = arrive(table, f"{tmp_path}/docs", split=target // 4, target=target)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    first = [table.manifest(v)["shards"] for v in (1, 2, 3, 4)]
    assert 0 < len(first[0]) < len(first[1]) < len(first[2]) < len(first[3])
    assert all(2 * s["bytes"] <= target for s in first[3])
    assert done["version"] > 4 and len(done["shards"]) > 8
    near = [s for s in done["shards"] if target / 2 <= s["bytes"] <= 1.5 * target]
    assert sum(s["bytes"] for s in near) > 0.75 * sum(s["bytes"] for s in done["shards"])
    assert rows(table.read()) == rows(docs)


def test_query_against_the_table(spark):
    out = op8_sharding(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert Counter((r.doc_id, r.source, r.n_chars) for r in out) == rows(docs.select("doc_id", "source", "n_chars"))
    assert {r.version for r in out} == {out[0].version} and out[0].version > 4
    shards = {r.shard: r.shard_bytes for r in out}
    assert all(0 < n < 64 << 20 for n in shards.values()) and len(shards) < 4 * 4
