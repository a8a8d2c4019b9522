"""Continuously maintained aggregate (X10): event counts per day and type.

Counts and sums add up, so each micro-batch is aggregated on its own and its
partial rows are kept in a partition of their own (replaced if the batch runs
again); reading sums the partials.  There is no streaming state and no
watermark: a file that lands late, for any day, counts like any other.

Partials are folded: every ``fold_every`` batches all partials up to the batch
before are summed into one table version that names the last batch it holds.
Readers take the newest version and the partials of later batches, so a read
sees at most one row per key and ``fold_every`` partials, however long the
stream has run.  A batch that runs again after it was folded rewrites a
partial that no reader takes: the fold already has it.  Partials that the
version before already held are removed; readers of that version do not read
them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.sinks import VersionedTable, remove_partitions, write_batch_log
from tessera.session import path_exists

AGG_KEYS = ["event_date", "event_type"]
FOLD_EVERY = 24


def event_counts(events: DataFrame) -> DataFrame:
    return (events.groupBy(F.to_date("ts").alias("event_date"), "event_type")
            .agg(F.count(F.lit(1)).alias("events"),
                 F.sum(F.col("value").cast("decimal(14,2)")).cast("decimal(18,2)").alias("value_sum")))


def _added_up(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*AGG_KEYS).agg(F.sum("events").alias("events"),
                                       F.sum("value_sum").cast("decimal(18,2)").alias("value_sum"))


def _folded(spark: SparkSession, partials: str) -> tuple[VersionedTable, DataFrame | None, int]:
    table = VersionedTable(spark, f"{partials}-folded")
    rows = table.read()
    # Every row names the last batch; the file statistics answer this.
    last = -1 if rows is None else rows.agg(F.max("upto_batch")).first()[0]
    return table, rows, last


def _since(spark: SparkSession, partials: str, folded: DataFrame | None, last: int) -> DataFrame:
    later = spark.read.parquet(partials).where(F.col("batch_id") > last).select(*AGG_KEYS, "events", "value_sum")
    return later if folded is None else later.unionByName(folded.select(*later.columns))


def read_event_counts(spark: SparkSession, partials: str) -> DataFrame:
    _, folded, last = _folded(spark, partials)
    return _added_up(_since(spark, partials, folded, last))


def fold(spark: SparkSession, partials: str, upto: int) -> None:
    """Sum the partials up to batch ``upto``, which must be complete."""
    table, folded, last = _folded(spark, partials)
    if upto <= last or not path_exists(spark, partials):
        return
    rows = spark.read.parquet(partials).where(F.col("batch_id").between(last + 1, upto))
    rows = rows.select(*AGG_KEYS, "events", "value_sum")
    if folded is not None:
        rows = rows.unionByName(folded.select(*rows.columns))
    table.commit(_added_up(rows).withColumn("upto_batch", F.lit(upto).cast("long")))
    remove_partitions(spark, partials, "batch_id", last)


def run_event_counts(spark: SparkSession, events_dir: str, checkpoint: str, partials: str,
                     file_glob: str = "*.parquet", available_now: bool = True,
                     processing_time: str = "1 hour", max_files_per_trigger: int | None = None,
                     fold_every: int = FOLD_EVERY):
    """Stream the Parquet files under ``events_dir`` matching ``file_glob``
    (new files are picked up as they land)."""
    schema = spark.read.option("pathGlobFilter", file_glob).parquet(events_dir).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def process(batch: DataFrame, batch_id: int) -> None:
        write_batch_log(event_counts(batch), partials, batch_id)
        if batch_id and batch_id % fold_every == 0:
            # The batches before this one are complete; this one may run again.
            fold(batch.sparkSession, partials, batch_id - 1)

    writer = reader.parquet(events_dir).writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time))
    return writer.start()
