"""Collections as numbered versions of Parquet files, and snapshots of them.

A version is written to a folder of its own and becomes visible by one row in the manifest,
so readers keep what they read and a failed write leaves nothing behind that counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quillspan.operators.writes import BulkResult, bulk_apply
from quillspan.plans.durable import materialize

_VERSIONS = "version bigint, rows bigint, stream string, batch bigint, folder string"
_SNAPSHOTS = "entry bigint, snapshot string, indices array<string>, state string, folders map<string,string>"


def _manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class Store:
    """One collection under ``path``; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def folder(self, version: int | None = None) -> str:
        """Where a version, by default the newest, has its files; they are never written again."""
        number = self.latest() if version is None else version
        if number is None:
            raise ValueError(f"nothing has been committed under {self.path}")
        rows = _manifest(self.spark, f"{self.path}/_manifest", _VERSIONS)
        named = rows.where((F.col("version") == number) & F.col("folder").isNotNull()).first()
        return named["folder"] if named else self._own_folder(number)

    def _own_folder(self, version: int) -> str:
        return f"{self.path}/v={version}"

    def latest(self) -> int | None:
        """The newest version, or ``None`` before the first commit."""
        return _manifest(self.spark, f"{self.path}/_manifest", _VERSIONS).agg(F.max("version")).first()[0]

    def has_batch(self, stream: str, batch: int) -> bool:
        """Whether that micro-batch of that stream is in some version."""
        rows = _manifest(self.spark, f"{self.path}/_manifest", _VERSIONS)
        return not rows.where((F.col("stream") == stream) & (F.col("batch") == batch)).isEmpty()

    def commit(
        self,
        df: DataFrame,
        version: int | None = None,
        partition_by: list[str] | None = None,
        stream: str | None = None,
        batch: int | None = None,
    ) -> int:
        """Write ``df`` as the next version; a version that is already there is left alone.

        Naming the version makes a repeated write harmless; ``stream`` and ``batch`` note where it came from.
        """
        newest = self.latest()
        number = (newest or 0) + 1 if version is None else version
        if newest is not None and number <= newest:
            return number
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self._own_folder(number))
        self._publish(number, self._own_folder(number), stream, batch)
        return number

    def adopt(self, folder: str) -> int:
        """Make the files of a folder, such as an older version's, the next version without copying them."""
        number = (self.latest() or 0) + 1
        self._publish(number, folder)
        return number

    def _publish(self, number: int, folder: str, stream: str | None = None, batch: int | None = None) -> None:
        rows = self.spark.read.parquet(folder).count()
        entry = self.spark.createDataFrame([(number, rows, stream, batch, folder)], _VERSIONS)
        entry.coalesce(1).write.mode("append").parquet(f"{self.path}/_manifest")

    def read(self, version: int | None = None) -> DataFrame:
        """One version, by default the newest."""
        return self.spark.read.parquet(self.folder(version))

    def apply(
        self,
        actions: DataFrame,
        version: int | None = None,
        scripts=None,
        apply=bulk_apply,
        stream: str | None = None,
        batch: int | None = None,
    ) -> BulkResult:
        """Apply a batch to the newest version and commit the outcome.

        The followed actions and the results are written down first, so that they are worked out
        once and describe the same run as the commit.
        """
        outcome = apply(self.read(), actions, scripts=scripts, cut=materialize)
        results = materialize(outcome.results, "results")
        number = self.commit(outcome.docs, version, stream=stream, batch=batch)
        return BulkResult(self.read(number), results)


class SnapshotRepository:
    """Named states of stores: a snapshot names the folders of versions, which no later write changes."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _log(self, snapshot: str, indices: list[str], state: str, folders: dict[str, str] | None = None) -> None:
        number = (_manifest(self.spark, f"{self.path}/_manifest", _SNAPSHOTS).agg(F.max("entry")).first()[0] or 0) + 1
        entry = self.spark.createDataFrame([(number, snapshot, indices, state, folders)], _SNAPSHOTS)
        entry.coalesce(1).write.mode("append").parquet(f"{self.path}/_manifest")

    def _latest(self) -> DataFrame:
        entries = _manifest(self.spark, f"{self.path}/_manifest", _SNAPSHOTS)
        return (
            entries.groupBy("snapshot")
            .agg(F.max_by(F.struct("indices", "state", "folders"), "entry").alias("s"))
            .select("snapshot", "s.*")
        )

    def list(self) -> DataFrame:
        """Rows ``snapshot, indices, state`` with the latest state of each snapshot."""
        return self._latest().drop("folders")

    def _state(self, snapshot: str):
        return self._latest().where(F.col("snapshot") == snapshot).first()

    def create(self, snapshot: str, stores: dict[str, Store], indices: list[str] | None = None) -> None:
        """Note the newest version of the named stores, or of all if none is named; nothing is copied."""
        if self._state(snapshot) is not None:
            raise ValueError(f"snapshot {snapshot!r} exists")
        names = indices or list(stores)
        self._log(snapshot, names, "SUCCESS", {name: stores[name].folder() for name in names})

    def read(self, snapshot: str, index: str) -> DataFrame:
        """The documents of one index as a snapshot holds them; no store changes."""
        entry = self._state(snapshot)
        if entry is None or entry["state"] != "SUCCESS" or index not in entry["indices"]:
            raise ValueError(f"no complete snapshot {snapshot!r} of {index!r}")
        return self.spark.read.parquet(entry["folders"][index])

    def restore(self, snapshot: str, stores: dict[str, Store]) -> dict[str, int]:
        """Commit every index of a snapshot as the next version of its store."""
        entry = self._state(snapshot)
        if entry is None or entry["state"] != "SUCCESS":
            raise ValueError(f"no complete snapshot {snapshot!r}")
        return {name: stores[name].adopt(entry["folders"][name]) for name in entry["indices"]}

    def delete(self, snapshot: str) -> None:
        """Mark a snapshot as deleted; it can no longer be restored."""
        entry = self._state(snapshot)
        if entry is None:
            raise ValueError(f"no snapshot {snapshot!r}")
        self._log(snapshot, list(entry["indices"]), "DELETED")


def create_index(spark: SparkSession, name: str, schema, settings: dict[str, str] | None = None) -> None:
    """An empty Parquet table with free-form settings as its properties."""
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    properties = ", ".join(
        "'" + k.replace("'", "\\'") + "'='" + str(v).replace("'", "\\'") + "'" for k, v in (settings or {}).items()
    )
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet" + (f" TBLPROPERTIES ({properties})" if properties else ""))


def delete_index(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE {name}")
