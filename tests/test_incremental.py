"""The incremental driver: keys, lookback, schema policies."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import sinks
from tessera.operators.incremental import Incremental, SchemaChange, refresh

D = dt.date


def model(spark, rows, schema="k string, d date, v int"):
    df = spark.createDataFrame(rows, schema)
    return lambda since: df if since is None else df.where(F.col("d") >= F.lit(since))


def rows(table):
    return sorted(map(tuple, table.read().select("k", "d", "v").collect()), key=str)


FIRST = [("a", D(2024, 1, 1), 1), ("a", D(2024, 1, 5), 2), (None, D(2024, 1, 5), 3), ("b", D(2024, 1, 4), 4)]
LATER = [("a", D(2024, 1, 1), 99), ("a", D(2024, 1, 5), 20), (None, D(2024, 1, 5), 30), ("c", D(2024, 1, 6), 5)]


@pytest.mark.parametrize("kind", ["versioned", "partitioned"])
def test_merge_replaces_keys_from_the_lookback_on(spark, kind):
    table = sinks.versioned_table(spark, "m") if kind == "versioned" else sinks.partitioned_table(spark, "m", ["d"])
    spec = Incremental(["k", "d"], "d", dt.timedelta(days=2))
    assert refresh(table, model(spark, FIRST), spec)["mode"] == "full"
    assert refresh(table, model(spark, LATER), spec) == {"mode": "merge", "since": D(2024, 1, 3)}
    want = sorted([FIRST[0], LATER[1], LATER[2], FIRST[3], LATER[3]], key=str)  # the null key once, the old day kept
    assert rows(table) == want
    refresh(table, model(spark, LATER), spec)
    assert rows(table) == want
    refresh(table, model(spark, LATER), spec, full_refresh=True)
    assert rows(table) == sorted(LATER, key=str)


def test_replace_window_drops_vanished_keys(spark):
    table = sinks.versioned_table(spark, "m")
    spec = Incremental(["k", "d"], "d", dt.timedelta(days=2), strategy="replace_window")
    refresh(table, model(spark, FIRST), spec)
    refresh(table, model(spark, LATER), spec)
    assert rows(table) == sorted([FIRST[0], *LATER[1:]], key=str)


def test_only_touched_partitions_are_rewritten(spark):
    table = sinks.partitioned_table(spark, "m", ["d"])
    spec = Incremental(["k", "d"], "d")
    refresh(table, model(spark, FIRST), spec)
    before = {r[0] for r in table.read().where("d < '2024-01-05'").select(F.input_file_name()).collect()}
    refresh(table, model(spark, LATER), spec)
    assert {r[0] for r in table.read().where("d < '2024-01-05'").select(F.input_file_name()).collect()} == before


def test_schema_policies(spark):
    wider = [(*r, "x") for r in LATER]
    schema = "k string, d date, v int, extra string"
    for policy in ("fail", "ignore", "append_new_columns", "sync_all_columns"):
        table = sinks.versioned_table(spark, "m")
        spec = Incremental(["k", "d"], "d", on_schema_change=policy)
        refresh(table, model(spark, FIRST), spec)
        if policy == "fail":
            with pytest.raises(SchemaChange, match="added"):
                refresh(table, model(spark, wider, schema), spec)
            assert rows(table) == sorted(FIRST, key=str)
            continue
        refresh(table, model(spark, wider, schema), spec)
        assert ("extra" in table.read().columns) == (policy != "ignore")
        narrow = model(spark, [(r[0], r[1]) for r in LATER], "k string, d date")
        if policy == "sync_all_columns":
            refresh(table, narrow, spec)
            assert table.read().columns == ["k", "d"]
        elif policy == "append_new_columns":
            refresh(table, narrow, spec)
            assert table.read().where("d = '2024-01-06'").first().v is None
        else:
            with pytest.raises(SchemaChange, match="gone"):
                refresh(table, narrow, spec)
    with pytest.raises(SchemaChange, match="changed"):
        refresh(table, model(spark, [("a", D(2024, 1, 9), "t")], "k string, d date, v string"), Incremental(["k", "d"], "d",
                                                                                                         on_schema_change="fail"))


def test_a_repeated_key_is_an_error(spark):
    table = sinks.versioned_table(spark, "m")
    with pytest.raises(ValueError, match="not unique"):
        refresh(table, model(spark, [*FIRST, FIRST[2]]), Incremental(["k", "d"], "d"))
    assert table.read() is None
