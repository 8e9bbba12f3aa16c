"""Every registered batch query against its SQL, on the smallest tables.

Stream queries: ``test_streams_unordered``.
"""

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from tidemark.plans import registry

DIRECTORY = "/root/testdata/sf0.001"
#: An estimate has no SQL; it is held against the exact count instead.
ESTIMATES = {"a12_uv_sketch_slide"}
BATCH = [n for n in [*registry.APPLICATIONS, *registry.PRIMITIVES] if n not in ESTIMATES]


@pytest.fixture(scope="module")
def con():
    return connect(DIRECTORY)


def test_every_query_has_sql():
    assert set(registry.queries()) - ESTIMATES == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 2254


@pytest.mark.parametrize("name", BATCH)
def test_query(spark, con, name):
    df = entry.queries()[name](spark, DIRECTORY)
    rows, problems = compare(df, con, entry.oracle_sql()[name])
    assert not problems
    assert rows > 0


def test_estimates_are_within_their_error(spark, con):
    exact = dict(
        con.execute(
            """SELECT w // 1000, count(DISTINCT user_id) FROM (
                 SELECT user_id, unnest(range((us // 300000000 + 1) * 300000000,
                   (us // 300000000 + 1) * 300000000 + 3600000000, 300000000)) AS w
                 FROM (SELECT user_id, epoch_us(ts) AS us FROM events WHERE event_type = 'view'))
               GROUP BY w"""
        ).fetchall()
    )
    found = entry.queries()["a12_uv_sketch_slide"](spark, DIRECTORY).collect()
    assert {r.window_end for r in found} == set(exact)
    assert all(abs(r.uv - exact[r.window_end]) <= 1 + 0.08 * exact[r.window_end] for r in found)
