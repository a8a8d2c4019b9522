"""Continuous claims load (T1-T5, M8 stream form).

Landing files arrive in a folder; a Structured Streaming file source is the
append-only change stream (its checkpoint is the consumed offset, T1).  Each
micro-batch is parsed (VARIANT), resolved against the current dimension
rows and merged into the claims fact; the merged state is committed as a new
table version (T4).  Empty triggers run nothing (T2).  A replayed batch
(at-least-once delivery after a failure) re-applies the same key matches,
so the result is unchanged (idempotent on the merge keys).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import sinks
from tessera.operators.sinks import PartitionedTable, VersionedTable, write_batch_log
from tessera.plans import loads
from tessera.session import scratch_path
from tessera.sources import ingest


def claims_batch_processor(target: VersionedTable, dims: dict[str, DataFrame],
                           rejects_path: str | None = None, ledger_path: str | None = None,
                           checks_path: str | None = None):
    """foreachBatch body: landing rows -> typed -> resolved -> merged; then
    (T8) the claim checks on the new state, one result set per batch."""

    def process(batch: DataFrame, batch_id: int) -> None:
        landing, malformed = ingest.landing_from_text(batch)
        # Parsed and joined once: the merge and the rejects read the result.
        # Without rejects only what is merged is stored.
        spark = batch.sparkSession
        parsed, stored = (scratch_path(spark, f"claims_{step}_{batch_id}") for step in ("parsed", "batch"))
        sinks.store(ingest.project_claims(landing).withColumn(loads.CLAIM_ROW, F.monotonically_increasing_id()), parsed)
        joined = loads.store_claim_join(spark, parsed, dims, stored, None if rejects_path else loads.resolved_claims)
        resolved = loads.resolved_claims(joined) if rejects_path else joined
        if rejects_path:
            write_batch_log(loads.claim_rejects(malformed, joined), rejects_path, batch_id)
        if isinstance(target, PartitionedTable):
            # Only the service months this batch touches are read and rewritten.
            loads.merge_claims_partitions(target, resolved, batch_path=stored)
        else:
            loads.commit_merged_claims(target, resolved, stored)
        sinks.discard(spark, stored)
        if checks_path:
            from tessera.plans import quality
            state = target.read()
            results = quality.run_suite_on({"fact_claim": state}, f"claims-batch-{batch_id}",
                                           _batch_time(batch))
            write_batch_log(results, checks_path, batch_id)
        if ledger_path:
            version = target.current_version() if isinstance(target, VersionedTable) else None
            write_batch_log(batch.sparkSession.createDataFrame(
                [(version,)], "table_version long"), ledger_path, batch_id)

    return process


def _batch_time(batch: DataFrame):
    """Check time of a batch: its newest landing time (deterministic on replay)."""
    import datetime as dt
    t = batch.agg(F.max("loaded_at")).first()[0]
    return t or dt.datetime(1970, 1, 1)


def run_claims_stream(spark: SparkSession, landing_dir: str, checkpoint: str,
                      target: VersionedTable, dims: dict[str, DataFrame],
                      available_now: bool = True, processing_time: str = "15 minutes",
                      max_files_per_trigger: int | None = None,
                      rejects_path: str | None = None,
                      ledger_path: str | None = None, checks_path: str | None = None):
    """Start the stream.  ``available_now`` drains what has landed and stops
    (batch-style scheduling); otherwise it triggers every
    ``processing_time`` and skips empty intervals."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = (reader.load(landing_dir)
           .select("value",
                   F.col("_metadata.file_path").alias("file_name"),
                   F.col("_metadata.file_modification_time").cast("timestamp_ntz")
                   .alias("loaded_at")))
    writer = (raw.writeStream
              .foreachBatch(claims_batch_processor(target, dims, rejects_path, ledger_path,
                                                   checks_path))
              .option("checkpointLocation", checkpoint))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time))
    return writer.start()
