"""Table maintenance without a table format: upsert (S7), SCD2 (S8),
incremental append with dedup (S10), schema sync (S26) and distributed
surrogate keys (S23).

Every operator is a pure DataFrame -> DataFrame function returning the next
state (or the rows to append).  Persisting it is the job of
``tessera.operators.sinks`` (new version directory + pointer), so a failed
write never leaves a half-updated table, and a rerun of the same batch
produces the same state (idempotent on the key match).

The merge is one full outer join on the keys; the join strategy is left to the
planner (AQE splits hot keys).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.exprs import ts_lit
from tessera.operators import sinks
from tessera.operators.dedup import latest_per_key
from tessera.operators.sinks import materialize

# ── S26: schema sync ──────────────────────────────────────────────────────
def sync_schema(target: DataFrame, source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``sync_all_columns``: new source columns are added to the target as
    typed NULLs, columns gone from the source are dropped from the target."""
    cols = source.columns
    src_types = dict(source.dtypes)
    t = target.select(*[F.col(c) if c in target.columns else
                        F.lit(None).cast(src_types[c]).alias(c) for c in cols])
    return t, source.select(*cols)


# ── S7: conditional upsert ────────────────────────────────────────────────
def changed_any(cols: Sequence[str], null_safe: bool = False) -> Callable[[Column, Column], Column]:
    """Change predicate ``OR`` of ``tgt.c <> src.c``.

    The default is NULL-unsafe like the source (a NULL on either side is
    "no change", ruling R9); ``null_safe`` treats NULL -> value as a change.
    """
    def pred(t: Callable[[str], Column], s: Callable[[str], Column]) -> Column:
        out = None
        for c in cols:
            d = ~t(c).eqNullSafe(s(c)) if null_safe else (t(c) != s(c))
            out = d if out is None else (out | d)
        return F.coalesce(out, F.lit(False))
    return pred


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           change_predicate=None, update_cols: Sequence[str] | None = None,
           insert_cols: Sequence[str] | None = None, dedup_order: Sequence[str] | None = None,
           allow_schema_sync: bool = False, stats: dict | None = None,
           action_col: str | None = None, how: str = "full_outer") -> DataFrame:
    """MERGE: matched rows update ``update_cols`` (all non-key columns by
    default) when ``change_predicate`` holds (always by default); unmatched
    source rows are inserted; other target rows are kept.

    ``dedup_order`` collapses duplicate source keys first (latest wins,
    ruling R10).  ``stats``, if given, is filled with lazy frames of the
    updated and inserted rows.  ``action_col`` adds a column saying what
    happened to each row (``updated`` / ``inserted`` / ``kept``), so counts
    can be taken with ``DataFrame.observe`` during the write itself.  ``how``
    "left" updates only.
    """
    keys = list(keys)
    if allow_schema_sync:
        target, source = sync_schema(target, source)
    if dedup_order:
        source = latest_per_key(source, keys, list(dedup_order), descending=True)
    tcols = target.columns
    upd = list(update_cols) if update_cols is not None else [c for c in tcols if c not in keys]
    src_cols = [c for c in source.columns if c not in keys]
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in src_cols],
                      F.lit(True).alias("_s_hit"))
    t = target.select("*", F.lit(True).alias("_t_hit"))
    j = t.join(s, keys, how)
    t_hit = F.coalesce(F.col("_t_hit"), F.lit(False))
    s_hit = F.coalesce(F.col("_s_hit"), F.lit(False))
    changed = t_hit & s_hit
    if change_predicate is not None:
        changed = changed & change_predicate(lambda c: F.col(c), lambda c: F.col(f"_s_{c}"))
    ins = list(insert_cols) if insert_cols is not None else tcols
    types = dict(target.dtypes)

    def insert_value(c):
        return _insert_value(c, types, keys, ins, src_cols, "_s_")

    def kept_value(c):
        if c in upd and c not in keys:
            return F.when(changed, F.col(f"_s_{c}")).otherwise(F.col(c))
        return F.col(c)

    out = [F.when(t_hit, kept_value(c)).otherwise(insert_value(c)).alias(c) for c in tcols]
    if action_col:
        out.append(F.when(~t_hit, "inserted").when(changed, "updated").otherwise("kept")
                   .alias(action_col))
    if stats is not None:
        stats["updated"] = j.where(changed)
        stats["inserted"] = j.where(~t_hit).select(*[insert_value(c).alias(c) for c in tcols])
    return j.select(*out)


def _insert_value(c: str, types: dict[str, str], keys, ins, src_cols, prefix: str = "") -> Column:
    if c in keys:
        return F.col(c)
    if c in ins and c in src_cols:
        return F.col(f"{prefix}{c}").cast(types[c])
    return F.lit(None).cast(types[c])


def inserted_rows(target: DataFrame, new: DataFrame, keys: Sequence[str], insert_cols: Sequence[str] | None = None,
                  surrogate_key: str | None = None) -> DataFrame:
    """Rows of the batch without a match as the merge inserts them, with the
    surrogate key that they were given."""
    types = dict(target.dtypes)
    ins = [*(target.columns if insert_cols is None else insert_cols), surrogate_key]
    return new.select(*[_insert_value(c, types, keys, ins, new.columns).alias(c) for c in target.columns])


# ── S23: distributed surrogate keys ──────────────────────────────────────
def assign_keys(df: DataFrame, key_col: str, start_after: int | Column = 0, path: str | None = None) -> DataFrame:
    """Dense keys ``start_after + 1 ..`` without a global window.

    Per-partition row counts (one row per partition) give each partition an
    offset; the key is offset + position within the partition.  Only the
    count table, bounded by the partition count, is broadcast.  The tagged
    rows are written (shared checkpoint folder) so the counting and the
    assigning branch see the same partition ids and positions even if the
    input would be re-executed differently; counting reads one column.  With
    ``path`` they are stored there, for the caller to discard.
    """
    tagged = materialize(_tagged(df), "keyed") if path is None else sinks.store(_tagged(df), path)
    return _numbered(tagged, df.columns, key_col, start_after)


def _tagged(df: DataFrame) -> DataFrame:
    return df.select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid"))


def _numbered(tagged: DataFrame, columns: Sequence[str], key_col: str, start_after: int | Column) -> DataFrame:
    """Keys of written rows that have their partition and position in it."""
    counts = tagged.groupBy("_pid").agg(F.count("*").alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    base = start_after if isinstance(start_after, Column) else F.lit(start_after)
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    out = tagged.join(F.broadcast(offsets), "_pid")
    kept = [F.col("`" + c.replace("`", "``") + "`") for c in columns]
    return out.select(*kept, (base + F.col("_off") + pos + 1).cast("long").alias(key_col))


# ── S8: SCD type 2 ────────────────────────────────────────────────────────
def scd2_merge(dim: DataFrame, staging: DataFrame, natural_key: str, hash_col: str,
               staged_hash: Column, effective_date, now, surrogate_key: str | None = None,
               stats: dict | None = None) -> DataFrame:
    """Expire current rows whose tracked-attribute hash changed
    (expiration = effective - 1 day), then insert a current row for every
    staged key without a current row (changed or new).

    One full outer join of the current rows with the (deduplicated) staging
    rows decides everything: current-only rows are kept, changed keys give
    an expired old row plus a new current row, staging-only keys give a new
    row.  Kept as written (ruling R12): a NULL stored hash never expires;
    keys absent from staging stay current.
    """
    eff = F.lit(effective_date).cast("date")
    ts = ts_lit(now)
    stg = staging.select("*", staged_hash.alias("_new_hash"))
    stg = latest_per_key(stg, [natural_key], [c for c in ["extracted_at"] if c in stg.columns]
                         or ["_new_hash"])
    cols = dim.columns
    dtypes = dict(dim.dtypes)
    cur = dim.where(F.col("is_current_record")).select("*", F.lit(True).alias("_cur"))
    old = dim.where(~F.col("is_current_record"))
    staged_cols = [c for c in stg.columns if c != natural_key]
    s = stg.select(natural_key, *[F.col(c).alias(f"_n_{c}") for c in staged_cols],
                   F.lit(True).alias("_stg"))
    # Both branches below read the join: run it once.
    j = materialize(cur.join(s, natural_key, "full_outer"), "scd2_join")
    has_cur = F.coalesce(F.col("_cur"), F.lit(False))
    has_stg = F.coalesce(F.col("_stg"), F.lit(False))
    expire = has_cur & has_stg & F.coalesce(F.col(hash_col) != F.col("_n__new_hash"), F.lit(False))
    insert = (has_stg & ~has_cur) | expire
    settings = {"expiration_date": F.date_sub(eff, 1), "is_current_record": F.lit(False),
                "updated_at": ts}
    cur_out = j.where(has_cur).select(*[
        (F.when(expire, settings[c]).otherwise(F.col(c)).alias(c) if c in settings else F.col(c))
        for c in cols], expire.alias("_expired"))
    fixed = {"effective_date": eff, "expiration_date": F.lit("9999-12-31").cast("date"),
             "is_current_record": F.lit(True), hash_col: F.col("_n__new_hash"),
             "created_at": ts, "updated_at": ts}

    def new_value(c):
        if c in fixed:
            return fixed[c]
        if c == natural_key:
            return F.col(c)
        return F.col(f"_n_{c}") if c in staged_cols else F.lit(None)

    ins = j.where(insert).select(*[new_value(c).cast(dtypes[c]).alias(c)
                                   for c in cols if c != surrogate_key])
    if surrogate_key:
        top = dim.agg(F.coalesce(F.max(surrogate_key), F.lit(0))).first()[0]
        ins = assign_keys(ins, surrogate_key, start_after=int(top)).select(*cols)
    if stats is not None:
        stats["expired"] = cur_out.where(F.col("_expired"))
        stats["inserted"] = ins
    return old.unionByName(cur_out.drop("_expired")).unionByName(ins)


# ── S10: incremental append with dedup ───────────────────────────────────
def append_new(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows of ``source`` whose ``key`` is not in ``target`` (NOT EXISTS).
    Only the key column of the target is scanned."""
    return source.join(target.select(key), key, "left_anti")


# ── partition-scoped upsert ───────────────────────────────────────────────
def upsert_partitions(table, batch: DataFrame, keys: Sequence[str],
                      surrogate_key: str | None = None,
                      update_cols: Sequence[str] | None = None, batch_path: str | None = None, **upsert_args) -> int:
    """Upsert ``batch`` into a ``sinks.PartitionedTable``, rewriting only the
    partitions the batch touches: those its rows name and those that hold its
    keys (a key's partition value may differ from the batch's; a key-only
    semi-join finds them).  A matched row stays in its partition: partition
    columns are never updated.

    ``batch_path``: where the batch is stored, discarded as soon as it is not read
    any more; a large one is looked up in two turns by its keys.  A large table is
    rewritten in two turns, each with its own partitions.  So half of the shuffle
    files is on disk at a time.  Each partition is swapped once; a run that dies in
    between is repeated with the batch.

    The first batch goes through the same merge, against an empty table of its
    own columns.  ``surrogate_key`` numbers inserted rows upwards from the
    table's greatest key.  Returns the number of partitions rewritten."""
    pcols = table.partition_cols
    dropped = [c for c in upsert_args.get("dedup_order") or [] if table.exists() and c not in table.read().columns]
    if not table.exists():
        dropped = list(upsert_args.get("dedup_order") or [])
        empty = batch.drop(*dropped).limit(0)
        if surrogate_key and surrogate_key not in empty.columns:
            empty = empty.withColumn(surrogate_key, F.lit(None).cast("long"))
        table.create(empty)
    target = table.read()
    if upsert_args.pop("allow_schema_sync", False):
        target, _ = sync_schema(target, batch.drop(*dropped))
    spark = batch.sparkSession
    named = [tuple(r) for r in batch.select(*pcols).distinct().collect()]
    if not named:
        return 0
    if update_cols is None:
        update_cols = [c for c in target.columns if c not in (*keys, *pcols, surrogate_key)]
    # The batch once by its keys, with whether the table holds them: written,
    # so numbers and rewrites read the same rows.  New rows come first in a
    # task's file, their positions are without gaps.
    order = upsert_args.pop("dedup_order", None)
    path = sinks.scratch_path(spark, "partition_batch")
    turns = 1 if batch_path is None else sinks.turns(spark, batch_path, 2)
    for i in range(turns):
        part, held = batch, target.select(*keys)
        if turns > 1:
            part = part.where(sinks.in_turn([F.col(k) for k in keys], i, turns))
            held = held.where(sinks.in_turn([F.col(k).try_cast(dict(batch.dtypes)[k]) for k in keys], i, turns))
        if order:
            part = latest_per_key(part, keys, list(order), descending=True)
        # A key in the table or not, however often: an existence join.  Names of
        # its own: one that the table has, too, would not be the batch's column.
        part = part.select("*", *[F.col(k).alias(f"_batch_{n}") for n, k in enumerate(keys)])
        same = [F.col(f"_table_{n}") == F.col(f"_batch_{n}").outer() for n, _ in enumerate(keys)]
        held = held.toDF(*[f"_table_{n}" for n, _ in enumerate(keys)]).where(reduce(and_, same)).exists()
        part = part.select(*batch.columns, held.alias("_held"), F.lit(i).alias("_turn"))
        sinks.store(_tagged(part.sortWithinPartitions("_held")), path, "append")
    if batch_path is not None:
        sinks.discard(spark, batch_path)
    rows = spark.read.parquet(path)
    new = rows.where(~F.col("_held"))
    if surrogate_key:
        top = target.agg(F.coalesce(F.max(surrogate_key), F.lit(0))).first()[0]
        # A partition's number is its own in its turn only.
        own = (F.col("_pid").cast("long") * turns + F.col("_turn"))
        pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
        new = new.select(*batch.columns, own.alias("_pid"), (pos + F.shiftleft(own, 33)).alias("_mid"))
        new = _numbered(new, [c for c in batch.columns if c != surrogate_key], surrogate_key, int(top))
    known = rows.where("_held").select(*batch.columns)
    # The partitions that the batch names, and others that hold its keys.
    others = table.not_in_partitions(target, named).select(*keys, *pcols)
    others = others.join(known.select(*keys).distinct(), list(keys), "left_semi").select(*pcols)
    with sinks.load_step(spark):
        holding = [tuple(r) for r in others.distinct().collect()]
    touched = sorted({*named, *holding}, key=lambda v: [(x is not None, x) for x in v])
    groups = min(len(touched), max(sinks.turns(spark, p, 2) for p in (table.path, path)))
    for i in range(groups):
        some = touched[i * len(touched) // groups:(i + 1) * len(touched) // groups]
        # Known rows only: those whose key is in other partitions change nothing here.
        merged = upsert(table.in_partitions(target, some), known, keys, update_cols=[c for c in update_cols if c not in pcols],
                        how="left", **upsert_args)
        added = inserted_rows(target, table.in_partitions(new, some), keys, upsert_args.get("insert_cols"), surrogate_key)
        table.replace_partitions(merged.unionByName(added), stored=True)
    sinks.discard(spark, path)
    return len(touched)
