"""Collections whose versions share files: a batch writes only the buckets it touches.

Documents lie in buckets by the hash of their key, each bucket in a folder of its own. A version is a list that names
one folder per bucket; the next one names new folders for the buckets that a batch touched and the same
ones for all others. A batch reads, shuffles and writes the documents of its buckets alone, so its cost follows the
batch. Lists are small: one row per bucket.

A version that was published never changes; :meth:`BucketStore.vacuum` removes the folders that neither the
newest versions nor snapshots name, such as those of a write that failed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspan.operators.writes import KEY, BulkResult, bulk_apply
from quillspan.plans.durable import delete_folder, materialize, release
from quillspan.sources.store import _VERSIONS, SnapshotRepository, Store, _manifest

BUCKETS = 256
#: One row per bucket that has documents, and one without a folder that carries the schema.
_LIST = "bucket int, folder string, rows bigint, schema string, buckets int"


class BucketStore(Store):
    """A :class:`Store` that is written bucket by bucket; the number of buckets is fixed by its first commit."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        super().__init__(spark, path)
        latest = self.latest()
        self.buckets = buckets if latest is None else self._listed(latest)[1]

    def _listed(self, version: int | None = None) -> tuple[dict[int, tuple[str, int]], int, T.StructType]:
        """``{bucket: (folder, rows)}``, the number of buckets and the schema of a version."""
        rows = self.spark.read.schema(_LIST).parquet(self.folder(version)).collect()  # one per bucket
        head = next(r for r in rows if r["folder"] is None)
        return {r["bucket"]: (r["folder"], r["rows"]) for r in rows if r["folder"]}, head["buckets"], T.StructType.fromJson(json.loads(head["schema"]))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*KEY), F.lit(self.buckets)).cast("int")

    def _read(self, listed: dict[int, tuple[str, int]], schema: T.StructType) -> DataFrame:
        folders = [folder for folder, _ in listed.values()]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        listed, _, schema = self._listed(version)
        return self._read(listed, schema)

    def _write(self, df: DataFrame) -> dict[int, tuple[str, int]]:
        """Write documents to new folders by bucket."""
        top = f"{self.path}/data/{uuid.uuid4().hex}"
        rows = df.withColumn("bucket", self._bucket()).hint("rebalance", "bucket")
        rows.write.partitionBy("bucket").parquet(top)
        counts = self.spark.read.schema(rows.schema).parquet(top).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()
        return {r["bucket"]: (f"{top}/bucket={r['bucket']}", r["n"]) for r in counts}

    def _note(self, number: int, listed: dict[int, tuple[str, int]], schema: T.StructType, stream: str | None, batch: int | None) -> None:
        """Write a version's list, then publish it with one row of the manifest."""
        folder = f"{self.path}/lists/{number}-{uuid.uuid4().hex}"
        rows = [(b, name, n, None, None) for b, (name, n) in sorted(listed.items())]
        rows.append((None, None, None, schema.json(), self.buckets))
        self.spark.createDataFrame(rows, _LIST).coalesce(1).write.parquet(folder)
        entry = [(number, sum(n for _, n in listed.values()), stream, batch, folder)]
        self.spark.createDataFrame(entry, _VERSIONS).coalesce(1).write.mode("append").parquet(f"{self.path}/_manifest")

    def commit(
        self,
        df: DataFrame,
        version: int | None = None,
        partition_by: list[str] | None = None,
        stream: str | None = None,
        batch: int | None = None,
    ) -> int:
        """Write all of ``df`` as the next version; ``partition_by`` is for other stores."""
        if partition_by:
            raise ValueError("these documents are laid out by bucket")
        if "bucket" in df.columns:
            raise ValueError("a column named bucket would clash with the layout")
        newest = self.latest()
        number = (newest or 0) + 1 if version is None else version
        if newest is not None and number <= newest:
            return number
        self._note(number, self._write(df), df.schema, stream, batch)
        return number

    def adopt(self, folder: str) -> int:
        """Make an older version's list the next version; no document is copied."""
        number = (self.latest() or 0) + 1
        rows = self.spark.read.schema(_LIST).parquet(folder)
        entry = rows.agg(F.lit(number).cast("bigint").alias("version"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
        entry = entry.select("version", "rows", F.lit(None).cast("string").alias("stream"), F.lit(None).cast("bigint").alias("batch"), F.lit(folder).alias("folder"))
        entry.coalesce(1).write.mode("append").parquet(f"{self.path}/_manifest")
        return number

    def apply(
        self,
        actions: DataFrame,
        version: int | None = None,
        scripts=None,
        apply=bulk_apply,
        stream: str | None = None,
        batch: int | None = None,
    ) -> BulkResult:
        """Apply a batch to the newest version; buckets without an action are neither read nor written."""
        listed, _, schema = self._listed()
        keyed = actions.where(" and ".join(f"{k} is not null" for k in KEY))
        touched = {r["bucket"] for r in keyed.select(self._bucket().alias("bucket")).distinct().collect()}  # at most one per bucket
        cuts: list[DataFrame] = []

        def cut(df: DataFrame) -> DataFrame:
            cuts.append(materialize(df))
            return cuts[-1]

        current = self._read({b: named for b, named in listed.items() if b in touched}, schema)
        outcome = apply(current, actions, scripts=scripts, cut=cut)
        results = materialize(outcome.results, "results")
        newest = self.latest() or 0
        number = newest + 1 if version is None else version
        if number > newest:
            fresh = self._write(outcome.docs.select(*schema.names)) if touched else {}
            kept = {b: named for b, named in listed.items() if b not in touched}
            self._note(number, kept | fresh, schema, stream, batch)
        release(*cuts)
        return BulkResult(self.read(number), results)

    def vacuum(self, keep: int = 1, repositories: list[SnapshotRepository] = ()) -> list[str]:
        """Remove what the newest ``keep`` versions and the snapshots of ``repositories`` do not name; returns those folders.

        Older versions can't be read afterwards. Not while a batch is being written.
        """
        versions = _manifest(self.spark, f"{self.path}/_manifest", _VERSIONS).orderBy(F.desc("version"))
        named = [r["folder"] for r in versions.limit(keep).collect()]
        for repository in repositories:
            held = repository._latest().where("state = 'SUCCESS'").select(F.explode(F.map_values("folders")).alias("folder"))
            named += [r["folder"] for r in held.where(F.startswith("folder", F.lit(f"{self.path}/lists/"))).collect()]
        live = set(named)
        if named:
            lists = self.spark.read.schema(_LIST).parquet(*sorted(live)).where("folder is not null")
            live |= {r["folder"] for r in lists.select("folder").distinct().collect()}
        gone = [f for top in self._children(f"{self.path}/data") for f in self._children(top) if f.rsplit("/", 1)[1].startswith("bucket=")]
        gone = [f for f in [*gone, *self._children(f"{self.path}/lists")] if f not in live]
        for folder in gone:
            delete_folder(self.spark, folder)
        return gone

    def _children(self, folder: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        return [f"{folder}/{s.getPath().getName()}" for s in files.listStatus(path)]
