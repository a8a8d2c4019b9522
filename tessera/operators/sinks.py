"""Sinks: materialised intermediates, versioned tables, partitioned facts,
append-only logs (S14-S16, S18-S20).

Intermediates are written as Parquet under the session's shared
``spark.checkpoint.dir`` and read back: that cuts lineage and survives the
loss of the executors that computed them (unlike caching or local
checkpoints).

Versioned tables: each new state goes to ``<table>/v=<n>``; it becomes the
current one when its write job commits (``_SUCCESS`` marker), so readers
never see a partial state and a job that dies mid-write leaves the previous
version current.  A state is never written over the files it reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import path_exists, scratch_path, scratch_root

#: Stored tables and landed text are written by every step of a load.
TABLE_CODEC, TEXT_CODEC = "zstd", "gzip"


#: Stored rows are worked through in turns of this size, but in no more than are asked for.
TURN_BYTES = 8 << 20

#: The shuffle files of a write go when it ends; otherwise they stay until the
#: driver collects its garbage, so the disk holds those of every step of a load at
#: once.  And a join does without sorting its larger side where every partition of
#: the smaller one turns out to be small enough for a hash table.
STEP_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
             "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32MB"}


@contextmanager
def load_step(spark: SparkSession) -> Iterator[None]:
    """``STEP_CONF`` for the writes within: each is a step of a load, what it read
    is stored when it ends."""
    before = {k: spark.conf.get(k, None) for k in STEP_CONF}
    for k, v in STEP_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def store(df: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """``materialize`` for a step of a load: into the folder given, so that it
    can be discarded, and without leaving shuffle files."""
    spark = df.sparkSession
    with load_step(spark):
        df.write.mode(mode).option("compression", TABLE_CODEC).parquet(path)
    return spark.read.parquet(path)


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to a fresh folder in the shared scratch space, read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write.mode("errorifexists").option("compression", TABLE_CODEC)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Add rows to an intermediate that is written in turns."""
    df.write.mode("append").option("compression", TABLE_CODEC).parquet(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove intermediates, or files of them, that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """The data files of a stored intermediate with their bytes."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [(st.getPath(), st.getLen()) for st in fs.listStatus(p) if st.isFile()]
    return sorted((f.toString(), n) for f, n in found if not f.getName().startswith(("_", ".")))


def turns(spark: SparkSession, path: str, most: int) -> int:
    """In how many turns the rows stored in a folder are worked through, so that
    the shuffle files of a turn are a part of what all rows would need."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stored = fs.getContentSummary(p).getLength() if fs.exists(p) else 0
    return max(1, min(most, stored // TURN_BYTES))


def dealt_files(spark: SparkSession, path: str, most: int) -> list[list[str]]:
    """The files of an intermediate dealt out to its turns, about evenly."""
    dealt: list[tuple[int, list[str]]] = [(0, []) for _ in range(turns(spark, path, most))]
    for name, n in sorted(_files(spark, path), key=lambda f: -f[1]):
        least = min(range(len(dealt)), key=lambda i: dealt[i][0])
        dealt[least] = (dealt[least][0] + n, [*dealt[least][1], name])
    return [names for _, names in dealt if names]


def in_turn(keys: list[Column], i: int, of: int) -> Column:
    """Whether a row's turn is ``i``, by its keys: rows with equal keys, null
    being a value, are of one turn."""
    return F.pmod(F.xxhash64(*[k.cast("string") for k in keys]), F.lit(of)) == i


def land_text(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One column of lines as landed text files, one per task, compressed."""
    with load_step(lines.sparkSession):
        lines.write.mode(mode).option("compression", TEXT_CODEC).text(path)


# ── versioned table ───────────────────────────────────────────────────────
class VersionedTable:
    """A table whose every state is a complete, immutable version directory
    ``v=<n>``.  A version is current once Spark's job commit has written its
    ``_SUCCESS`` marker; readers take the highest committed version.  There
    is no pointer to update, so a job that dies mid-write leaves only an
    uncommitted directory that readers ignore."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _versions(self, committed: bool = True) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        out = []
        for st in fs.listStatus(root):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith("v=") and name[2:].isdigit():
                if not committed or fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                    out.append(int(name[2:]))
        return sorted(out)

    def current_version(self) -> int | None:
        versions = self._versions()
        return versions[-1] if versions else None

    def read(self) -> DataFrame | None:
        v = self.current_version()
        return None if v is None else self.spark.read.parquet(f"{self.root}/v={v}")

    def commit(self, df: DataFrame, partition_by: list[str] | None = None) -> int:
        return self._write(df, partition_by, True)

    def _write(self, df: DataFrame, partition_by: list[str] | None, mark: bool) -> int:
        # Past every folder that exists: a dead writer's number is not reused.
        v = max(self._versions(committed=False), default=0) + 1
        w = (df.write.mode("errorifexists").option("compression", TABLE_CODEC)
             .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(mark).lower()))
        if partition_by:
            w = w.partitionBy(*partition_by)
        with load_step(df.sparkSession):
            w.parquet(f"{self.root}/v={v}")
        return v

    def commit_parts(self, parts: Iterable[DataFrame]) -> int:
        """One state out of several frames, written one after the other; it is
        current once the last is there."""
        v = None
        for df in parts:
            if v is None:
                v = self.stage(df)
            else:
                with load_step(df.sparkSession):
                    (df.write.mode("append").option("compression", TABLE_CODEC)
                     .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{self.root}/v={v}"))
        self.publish(v)
        return v

    # Write, audit, publish: a staged version is whole but has no marker, so
    # it is nobody's current state until ``publish`` puts the marker there.
    def stage(self, df: DataFrame, partition_by: list[str] | None = None) -> int:
        return self._write(df, partition_by, False)

    def read_version(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/v={version}")

    def publish(self, version: int) -> None:
        jvm = self.spark.sparkContext._jvm
        marker = jvm.org.apache.hadoop.fs.Path(f"{self.root}/v={version}/_SUCCESS")
        fs = marker.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        fs.create(marker, True).close()


def versioned_table(spark: SparkSession, name: str) -> VersionedTable:
    return VersionedTable(spark, f"{scratch_root(spark)}/tables/{name}-{uuid.uuid4().hex[:8]}")


# ── partitioned, clustered fact layout (S14 / S15 / S16) ─────────────────
def write_clustered(df: DataFrame, path: str, partition_cols: list[str],
                    cluster_cols: list[str], mode: str = "append") -> None:
    """Partition directories by ``partition_cols`` (coarse: year/month, not
    day, to avoid tiny files), rows sorted by ``cluster_cols`` inside each
    file so Parquet min/max statistics skip row groups on those filters.

    A rebalance by the partition columns gathers the rows of a partition value,
    and AQE splits values that are larger than its target size.
    """
    (df.hint("rebalance", *partition_cols)
     .sortWithinPartitions(*partition_cols, *cluster_cols)
     .write.mode(mode).partitionBy(*partition_cols).parquet(path))


def append_log(df: DataFrame, path: str, partition_col: str | None = None) -> None:
    """Append-only log (quality results, run ledgers)."""
    w = df.write.mode("append")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.parquet(path)


def write_batch_log(df: DataFrame, path: str, batch_id: int) -> None:
    """Per-micro-batch log rows, idempotent under replay: the batch's rows
    live in their own ``batch_id`` partition, replaced when the batch runs
    again."""
    (df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def remove_partitions(spark: SparkSession, path: str, partition_col: str, upto: int) -> int:
    """Remove the folders ``<partition_col>=<n>`` with n <= ``upto``."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = 0
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        value = name.removeprefix(f"{partition_col}=")
        if st.isDirectory() and value != name and value.isdigit() and int(value) <= upto:
            gone += bool(fs.delete(st.getPath(), True))
    return gone


# ── partitioned table with partition-scoped rewrites ─────────────────────
class PartitionedTable:
    """A Parquet table partitioned by ``partition_cols`` whose updates
    rewrite only the partitions they touch.

    ``replace_partitions(rows)`` first materialises ``rows`` in the scratch
    space, then overwrites with dynamic partition overwrite: partitions absent
    from ``rows`` keep their files.  New files are written beside the table and
    each partition directory is swapped as a unit when all are there, so rows
    that are read from this very table need no staging.
    """

    def __init__(self, spark: SparkSession, path: str, partition_cols: list[str]):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_cols = list(partition_cols)

    # The schema lives in its own folder beside the data, one file per change:
    # a new column then shows in partitions written before it, and an empty
    # table has one.
    @property
    def _schemas(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.path}-schema")

    def exists(self) -> bool:
        return self._schemas.current_version() is not None

    def read(self) -> DataFrame:
        schema = self._schemas.read().schema
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path).select(*schema.names)

    def in_partitions(self, df: DataFrame, values: list[tuple]) -> DataFrame:
        """The rows of ``df`` in the listed partitions, nulls being a value.  A
        filter on the partition columns alone: a table's other folders are not
        read.  Its size is the number of partitions."""
        return df.where(self._listed(df, values))

    def not_in_partitions(self, df: DataFrame, values: list[tuple]) -> DataFrame:
        return df.where(~self._listed(df, values))

    def _listed(self, df: DataFrame, values: list[tuple]) -> Column:
        *outer, last = self.partition_cols
        by_outer: dict[tuple, list] = {}
        for v in dict.fromkeys(map(tuple, values)):
            by_outer.setdefault(v[:-1], []).append(v[-1])
        kind = dict(df.dtypes)
        out = F.lit(False)
        for head, tails in by_outer.items():
            # Null-safe, and never null itself: it is negated, too.
            given = [F.lit(x).cast(kind[last]) for x in tails if x is not None]
            term = F.coalesce(F.col(last).isin(given), F.lit(False)) if given else F.lit(False)
            if None in tails:
                term = term | F.col(last).isNull()
            for c, x in zip(outer, head):
                term = term & F.col(c).eqNullSafe(F.lit(x).cast(kind[c]))
            out = out | term
        return out

    def read_partitions(self, values: list[tuple]) -> DataFrame:
        return self.in_partitions(self.read(), values)

    def replace_partitions(self, rows: DataFrame, stored: bool = False) -> None:
        """``stored``: the rows come from written tables, so they need no
        staging."""
        staged = rows if stored else materialize(rows, "partition_rewrite")
        if self._schemas.read().schema.simpleString() != staged.schema.simpleString():
            self._schemas.commit(staged.limit(0))
        with load_step(staged.sparkSession):
            (self._gathered(staged).write.mode("overwrite").option("compression", TABLE_CODEC)
             .option("partitionOverwriteMode", "dynamic")
             .partitionBy(*self.partition_cols).parquet(self.path))

    def _gathered(self, rows: DataFrame) -> DataFrame:
        """Rows of a partition together, so that it gets few files; AQE splits
        partitions that are larger than its target size over tasks."""
        return rows.hint("rebalance", *self.partition_cols)

    def replace_all(self, rows: DataFrame) -> None:
        staged = materialize(rows, "partition_rewrite")
        self._schemas.commit(staged.limit(0))
        (self._gathered(staged).write.mode("overwrite").option("compression", TABLE_CODEC)
         .option("partitionOverwriteMode", "static")
         .partitionBy(*self.partition_cols).parquet(self.path))

    def create(self, rows: DataFrame) -> None:
        self._schemas.commit(rows.limit(0))
        with load_step(rows.sparkSession):
            (self._gathered(rows).write.mode("errorifexists").option("compression", TABLE_CODEC)
             .partitionBy(*self.partition_cols).parquet(self.path))


def partitioned_table(spark: SparkSession, name: str, partition_cols: list[str]) -> PartitionedTable:
    return PartitionedTable(spark, f"{scratch_root(spark)}/tables/{name}-{uuid.uuid4().hex[:8]}",
                            partition_cols)


# ── materialisation modes (S21) ──────────────────────────────────────────
def materialize_model(df: DataFrame, mode: str, name: str, table: VersionedTable | None = None):
    """Apply a model's materialisation:

    * ``ephemeral`` - the lazy DataFrame itself (inlined into consumers);
    * ``view`` - a temporary view over the lazy plan (Catalyst still
      optimises across it);
    * ``table`` - a full rebuild committed as a new version of ``table``.
    Incremental models go through ``operators.incremental.refresh``.
    """
    if mode == "ephemeral":
        return df
    if mode == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if mode == "table":
        target = table or versioned_table(df.sparkSession, name)
        target.commit(df)
        return target.read()
    raise ValueError(f"unknown materialisation {mode!r}")

