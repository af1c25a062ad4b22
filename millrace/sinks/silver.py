"""Silver table on plain files: current rows in hash buckets, closed rows, and a small commit table.

Current rows lie in buckets by a hash of their key.  An upsert reads, joins and
writes only the buckets that its batch touches; its commit names these, and a
reader takes every bucket from the newest commit that wrote it.  Rows that an
upsert closes go to a folder of its own and are never rewritten.  A job that
dies half way leaves the table as it was, since readers follow commits alone,
and a batch that is already committed is not applied again.  When the buckets
have grown to several times their intended size, the next upsert deals all
current rows into more of them.  One writer at a time: commits are not arbitrated.

The commit carries the table's schema, so that reads open no footers to learn
it; files written before a column came give NULL for it.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass
from datetime import timedelta
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.config import SilverSpec
from millrace.operators.dedup import latest_by_null_pattern
from millrace.operators.upsert import CURRENT, align_types, compare_versions, misfits, outcome_counts, versions
from millrace.session import stage

# ``written``: the buckets that a commit wrote; ``closed``: its folder, if it closed rows; ``n_rows``: current rows after it.
_COMMIT = (
    "version bigint, batch_id string, folder string, buckets int, written array<int>, closed array<string>, "
    "n_rows bigint, table_schema string"
)
_BUCKET, _FOLDER = "_bucket", "_folder"
#: Buckets are dealt anew at so many times their intended rows.
GROWTH = 4


@dataclass
class SilverTable:
    spark: SparkSession
    root: str
    spec: SilverSpec
    #: Current rows that a bucket is meant to hold.
    bucket_rows: int = 250_000

    def commits(self) -> DataFrame:
        return self.spark.read.schema(_COMMIT).json(f"{self.root}/commits")

    def last_commit(self) -> dict | None:
        """The newest commit, with the folders that it and all earlier ones closed."""
        newest = self._newest()
        if newest is None:
            return None
        closed = self.commits().orderBy("version").select(F.explode("closed")).collect()
        return {**newest.asDict(), "closed": [r[0] for r in closed]}

    def _newest(self) -> Row | None:
        try:
            return self.commits().orderBy(F.desc("version")).first()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def exists(self) -> bool:
        return self._newest() is not None

    def has_batch(self, batch_id: str) -> bool:
        return self.exists() and not self.commits().where(F.col("batch_id") == batch_id).isEmpty()

    def directory(self) -> dict[int, str]:
        """The folder that holds each bucket's current rows."""
        return self._directory(self._committed())

    def current(self) -> DataFrame:
        commit = self._committed()
        return self._rows(commit, self._directory(commit)).withColumn(CURRENT, F.lit(True))

    def read(self) -> DataFrame:
        """All versions; closed rows of older schemas get NULL in newer columns."""
        commit = self._committed()
        table = self._rows(commit, self._directory(commit)).withColumn(CURRENT, F.lit(True))
        folders = self.commits().select(F.explode("closed").alias("folder")).distinct()
        if folders.isEmpty():
            return table
        # The commits choose the folders of closed rows; those of jobs that died are not among them.
        path = f"{self.root}/rows/{CURRENT}=false"
        placed = T.StructType([*_schema(commit).fields, T.StructField(_FOLDER, T.StringType())])
        closed = self.spark.read.schema(placed).option("basePath", path).parquet(path)
        closed = closed.join(folders, F.col(_FOLDER) == F.col("folder"), "left_semi").select(*[f"`{n}`" for n in _schema(commit).names])
        return table.unionByName(closed.withColumn(CURRENT, F.lit(False)))

    def upsert(self, incoming: DataFrame, batch_id: str, policy: str = "on_change") -> dict | bool:
        """Apply a batch of cleaned rows; False when that batch was committed before.

        Else returns what became of the batch, counted by the writes themselves:
        inserted, replaced and skipped keys, and ``misfits``, the values per column
        that the table's type cannot hold and that became NULL.
        """
        commit = self._newest()
        if commit is not None and not self.commits().where(F.col("batch_id") == batch_id).isEmpty():
            return False
        keys = list(self.spec.primary_keys)
        fresh = latest_by_null_pattern(incoming, keys, self.spec.dedup_timestamp)
        lost: dict[str, int] = {}
        if commit is None:
            fresh = stage(fresh, "batch")
            n = fresh.count()
            buckets = self._buckets(n)
            rows = fresh.withColumns({CURRENT: F.lit(True), _BUCKET: _bucket(keys, buckets)})
            counts = {"inserted": n, "replaced": 0, "skipped": 0}
        else:
            counted = Observation("misfits")
            fits = misfits(fresh, _schema(commit))
            fresh = fresh.observe(counted, F.count("*").alias("rows"), *[c.alias(f"lost_{i}") for i, c in enumerate(fits.values())])
            # Written once: it names the buckets to read, and then meets their rows.
            fresh = stage(align_types(fresh, _schema(commit)), "batch")
            lost = {name: counted.get[f"lost_{i}"] for i, name in enumerate(fits)}
            directory, buckets = self._directory(commit), commit["buckets"]
            if commit["n_rows"] > GROWTH * self.bucket_rows * buckets:
                before, buckets = self._rows(commit, directory), self._buckets(commit["n_rows"])
            else:
                # At most as many numbers as there are buckets.
                touched = [r["b"] for r in fresh.select(_bucket(keys, buckets).alias("b")).distinct().collect()]
                before = self._rows(commit, {b: directory[b] for b in touched if b in directory})
            outcome = Observation("outcome")
            compared = compare_versions(before, fresh, keys, policy).observe(outcome, *outcome_counts())
            rows = versions(compared).withColumn(_BUCKET, _bucket(keys, buckets))
        folder = uuid4().hex[:12]
        # A task holds one bucket, whatever their number; by a hash of the bucket some would hold several.
        placed = rows.withColumn(_FOLDER, F.lit(folder)).repartitionById(buckets, _BUCKET)
        placed.write.mode("append").partitionBy(CURRENT, _FOLDER, _BUCKET).parquet(f"{self.root}/rows")
        if commit is not None:
            counts = {c: outcome.get[c] for c in ("inserted", "replaced", "skipped")}
        written = sorted(int(p.getPath().getName().partition("=")[2]) for p in self._listed(self._current_path(folder)))
        schema = T.StructType([f for f in rows.schema.fields if f.name not in (CURRENT, _BUCKET)])
        n_rows = (commit["n_rows"] if commit else 0) + counts["inserted"]
        closed = [folder] if counts["replaced"] else []
        version = commit["version"] + 1 if commit else 1
        self._commit(version, batch_id, folder, buckets, written, closed, n_rows, schema.json())
        return {**counts, "misfits": {name: n for name, n in lost.items() if n}}

    def remove_unreferenced(self, older_than: timedelta = timedelta(days=7)) -> list[str]:
        """Delete buckets that a newer commit has replaced, and folders of jobs that died; returns their paths.

        What is younger than ``older_than`` stays, for readers that began before it was replaced.
        """
        live = {self._bucket_path(folder, b) for b, folder in self.directory().items()}
        live |= {f"{self.root}/rows/{CURRENT}=false/{_FOLDER}={r[0]}" for r in self.commits().select(F.explode("closed")).collect()}
        seen = [(b, f"{f.getPath().getName()}/{b.getPath().getName()}") for f in self._listed(self._current_path()) for b in self._listed(f.getPath())]
        found = [(b, f"{self.root}/rows/{CURRENT}=true/{name}") for b, name in seen]
        found += [(f, f"{self.root}/rows/{CURRENT}=false/{f.getPath().getName()}") for f in self._listed(f"{self.root}/rows/{CURRENT}=false")]
        before = (time.time() - older_than.total_seconds()) * 1000
        gone = [(f.getPath(), name) for f, name in found if name not in live and f.getModificationTime() < before]
        for path, _ in gone:
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return [name for _, name in gone]

    def _current_path(self, folder: str | None = None) -> str:
        path = f"{self.root}/rows/{CURRENT}=true"
        return f"{path}/{_FOLDER}={folder}" if folder else path

    def _bucket_path(self, folder: str, bucket: int) -> str:
        return f"{self._current_path(folder)}/{_BUCKET}={bucket}"

    def _listed(self, path) -> list:
        """The folders below a path."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path) if isinstance(path, str) else path
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s for s in files.listStatus(folder) if s.isDirectory()] if files.exists(folder) else []

    def _committed(self) -> Row:
        commit = self._newest()
        if commit is None:
            raise ValueError(f"no table at {self.root}")
        return commit

    def _directory(self, commit: Row) -> dict[int, str]:
        """One entry a bucket, whatever the number of commits."""
        each = self.commits().where(F.col("buckets") == commit["buckets"])
        each = each.select("version", "folder", F.explode("written").alias("bucket"))
        newest = each.groupBy("bucket").agg(F.max_by("folder", "version").alias("folder"))
        return {r["bucket"]: r["folder"] for r in newest.collect()}

    def _rows(self, commit: Row, directory: dict[int, str]) -> DataFrame:
        if not directory:
            return self.spark.createDataFrame([], _schema(commit))
        return self.spark.read.schema(_schema(commit)).parquet(*[self._bucket_path(folder, b) for b, folder in directory.items()])

    def _buckets(self, n_rows: int) -> int:
        return max(1, -(-n_rows // self.bucket_rows))

    def _commit(self, *values) -> None:
        row = self.spark.createDataFrame([values], _COMMIT)
        row.coalesce(1).write.mode("append").json(f"{self.root}/commits")


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def _schema(commit: Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(commit["table_schema"]))
