"""Registered queries against their reference SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql
from __spark_entry__ import queries as all_queries
from checks.catalog import QUERIES, oracles
from checks.compare import compare, reference

SF = "/root/testdata/sf0.001"
ORACLES = oracles()
STREAMS = [n for n in QUERIES if n.endswith(("_stream", "_updates")) or n.startswith(("t10", "t14", "k05"))]
# Streams take seconds each; one of every kind runs here, all of them in checks.compare.
SHOWN_STREAMS = ["t02_seismic_tumbling_stream", "k02_replace_snapshot_stream", "t07_weather_tumbling_updates", "t10_late_rows"]


@pytest.fixture(scope="module")
def con():
    return reference(SF)


def test_every_query_has_reference_sql():
    assert set(ORACLES) == set(QUERIES)
    assert ORACLES.items() <= oracle_sql().items() and QUERIES.keys() <= all_queries().keys()


def test_streams_are_known():
    assert set(SHOWN_STREAMS) <= set(STREAMS)


def test_entry(spark):
    assert entry(spark).count() > 0


# At this size the newest day or window may leave a result empty, so only equality is asked for.
@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STREAMS] + SHOWN_STREAMS)
def test_query_equals_its_sql(spark, con, name):
    good, note = compare(spark, con, name, QUERIES[name], ORACLES[name], SF, allow_empty=True)
    assert good, note
