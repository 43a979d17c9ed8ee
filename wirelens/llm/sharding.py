"""Sharding: small immutable shards, size-tiered compaction, and a manifest that is committed atomically."""

from __future__ import annotations

import json
import math
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirelens.llm.common import shared_folder

TARGET_BYTES = 64 << 20
#: A tier holds shards of sizes within this factor; so many of them are merged.
FANOUT = 4
#: op8's table arrives in so many versions, read in splits of so many bytes, one small shard of each.
ARRIVALS, SPLIT_BYTES = 4, 8 << 20


class Conflict(Exception):
    """Another writer has committed this version first."""


class ShardedTable:
    """A table of Parquet shards in a folder, read through the newest manifest.

    A version is a file ``manifest/v<number>.json`` that lists the shards, their bytes and rows. It is written whole
    under another name and then renamed to its own by the file system, in one step that fails if the name is taken; so
    of several writers one commits, the others see :class:`Conflict`, and their shards stay unlisted. (HDFS and object
    stores with conditional writes rename so; the local file system, for tests, looks before it renames.) Shards are
    never changed; a reader of an old version isn't disturbed until :meth:`vacuum`, which also removes what lost writers
    have left. Files are read in splits of other sizes by sessions of the table's own, so the caller's settings stay.

    Cases: an empty frame makes an empty version that keeps its columns. Nulls, repeated rows and any columns pass as
    they are. Rows stay in one shard's order; shards have none.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _list(self, name: str) -> list[tuple[str, int]]:
        if not self.fs.exists(self._path(name)):
            return []
        return sorted((s.getPath().getName(), s.getLen()) for s in self.fs.listStatus(self._path(name)))

    def version(self) -> int:
        """The newest committed version, 0 for none."""
        return max((int(n[1:-5]) for n, _ in self._list("manifest") if n.startswith("v") and n.endswith(".json")), default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if not version:
            return {"version": 0, "schema": None, "shards": []}
        lines = self.spark.read.text(f"{self.path}/manifest/v{version:08d}.json", wholetext=True).first()[0]
        return json.loads(lines)

    def commit(self, base: dict, added: list[dict], removed: set[str], schema: str) -> dict:
        """The version after ``base``: its shards without ``removed``, and ``added``."""
        new = {"version": base["version"] + 1, "schema": schema, "shards": [s for s in base["shards"] if s["name"] not in removed] + added}
        self.fs.mkdirs(self._path("manifest"))
        draft, final = self._path(f"manifest/.draft-{uuid.uuid4().hex}"), self._path(f"manifest/v{new['version']:08d}.json")
        out = self.fs.create(draft, False)
        out.write(json.dumps(new).encode())
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.spark._jsc.hadoopConfiguration())
        never_replace = self.spark._sc._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(draft, final, never_replace)
        except Py4JJavaError as error:
            self.fs.delete(draft, False)
            if "FileAlreadyExistsException" in str(error.java_exception.toString()):
                raise Conflict(f"version {new['version']} of {self.path} is taken") from error
            raise
        return new

    def session(self, split: int, **others: str) -> SparkSession:
        """A session that reads files in splits of at most ``split`` bytes."""
        own = self.spark.newSession()
        for name, value in {"maxPartitionBytes": str(split), "openCostInBytes": "0", **others}.items():
            own.conf.set(f"spark.sql.files.{name}", value)
        return own

    def _write(self, df: DataFrame) -> list[dict]:
        """Each task's rows as a shard; a failed attempt leaves nothing, as Spark commits files by task."""
        folder = f"data/{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(f"{self.path}/{folder}")
        return [{"name": f"{folder}/{n}", "bytes": size} for n, size in self._list(folder) if n.endswith(".parquet")]

    def append(self, arrivals: DataFrame) -> dict:
        """Arrivals as small shards, one of each task, in a new version. No shuffle."""
        base = self.manifest()
        shards = self._write(arrivals)
        return self.commit(base, shards, set(), arrivals.schema.json())

    def plan(self, manifest: dict, target: int, fanout: int) -> list[list[dict]]:
        """The tiers to merge, smallest shards first: those that have ``fanout`` shards or more, below half the target.

        Tier k holds shards from ``target / fanout ** (k + 1)`` to ``target / fanout ** k`` bytes.
        """
        tiers: dict[int, list[dict]] = {}
        for shard in manifest["shards"]:
            if shard["bytes"] * 2 <= target:
                tiers.setdefault(int(math.log(target / max(1, shard["bytes"]), fanout)), []).append(shard)
        return [tiers[k] for k in sorted(tiers, reverse=True) if len(tiers[k]) >= fanout]

    def compact(self, target: int = TARGET_BYTES, fanout: int = FANOUT) -> dict:
        """Merges tiers of similarly sized shards into files of up to about ``target`` bytes until no tier is full.

        A job merges one tier, the one of the smallest shards that is due, and commits; what it makes may fill a higher
        tier. Spark's reader packs the small files into partitions of the target size, and each becomes a shard. Nothing
        is shuffled, and a row is rewritten once for each tier it passes.
        """
        now, reader = self.manifest(), self.session(target, minPartitionNum="1")
        while due := self.plan(now, target, fanout):
            merged = self._write(self._read(now["schema"], due[0], reader))
            now = self.commit(now, merged, {s["name"] for s in due[0]}, now["schema"])
            if len(merged) >= len(due[0]):  # nothing got larger
                break
        return now

    def _read(self, schema: str | None, shards: list[dict], reader: SparkSession | None = None) -> DataFrame:
        from pyspark.sql.types import StructType

        if schema is None:
            raise ValueError(f"{self.path} has no version")
        kind = StructType.fromJson(json.loads(schema))
        reader = reader or self.spark
        if not shards:
            return reader.createDataFrame([], kind)
        return reader.read.schema(kind).parquet(*[f"{self.path}/{s['name']}" for s in shards])

    def read(self, version: int | None = None) -> DataFrame:
        manifest = self.manifest(version)
        return self._read(manifest["schema"], manifest["shards"])

    def vacuum(self) -> None:
        """Removes shard files that the newest version doesn't list, and drafts; not to be run beside writers."""
        for name, _ in self._list("manifest"):
            if name.startswith(".draft-"):
                self.fs.delete(self._path(f"manifest/{name}"), False)
        listed = {s["name"] for s in self.manifest()["shards"]}
        for folder, _ in self._list("data"):
            own = [f"data/{folder}/{n}" for n, _ in self._list(f"data/{folder}")]
            if not listed.intersection(own):
                self.fs.delete(self._path(f"data/{folder}"), True)
            else:
                for name in own:
                    if name.endswith(".parquet") and name not in listed:
                        self.fs.delete(self._path(name), False)


def arrive(table: ShardedTable, path: str, arrivals: int = ARRIVALS, split: int = SPLIT_BYTES, target: int = TARGET_BYTES) -> dict:
    """The Parquet table at ``path`` appended in ``arrivals`` versions by a hash of doc_id, in shards of bounded size, and
    then compacted.

    A split of the input makes a shard in each version, so a shard's size doesn't depend on the input's. The table is
    read once for each arrival. Cases: rows with null doc_id arrive together; an empty table makes empty versions.
    Returns the last manifest.
    """
    docs, part = table.session(split).read.parquet(path), F.pmod(F.xxhash64("doc_id"), F.lit(arrivals))
    for k in range(arrivals):
        table.append(docs.where(part == k))
    return table.compact(target)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents appended in several arrivals and compacted: where each one lies, and what its shard holds."""
    table = ShardedTable(spark, f"{shared_folder(spark)}/shards-{uuid.uuid4().hex}")
    done = arrive(table, f"{sf_dir}/documents.parquet")
    table.vacuum()
    table.fs.deleteOnExit(table._path(""))
    rows = table.read().select("doc_id", "source", "n_chars", F.col("_metadata.file_name").alias("shard"), F.col("_metadata.file_size").alias("shard_bytes"))
    return rows.withColumn("version", F.lit(done["version"]))
