"""Queries with an oracle against it on the smallest fixture."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from parity import digest, duck  # noqa: E402

from tessera.llm import registry  # noqa: E402


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_oracle(spark, small_dir, name):
    df = registry.QUERIES[name](spark, small_dir)
    found = duck(small_dir).execute(registry.ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(columns, found.fetchall())[0]


def test_every_dealt_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))
