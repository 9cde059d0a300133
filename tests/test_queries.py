"""Every registered query against its SQL on the smallest tables, those on page texts on larger ones too."""

import duckdb
import pytest

import __spark_entry__ as entry
from lexistat.plans import publications

FOLDER = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def connected(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def sql():
    return connected(FOLDER)


@pytest.fixture(scope="module")
def larger_sql():
    return connected(LARGER)


def ordered(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def matches(spark, connection, folder, name):
    ours = QUERIES[name](spark, folder)
    cursor = connection.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(ours.columns) == sorted(columns)
    theirs = ordered(cursor.fetchall(), columns)
    assert ordered([tuple(r) for r in ours.collect()], ours.columns) == theirs


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_sql(spark, sql, name):
    matches(spark, sql, FOLDER, name)


# Texts of all kinds are needed to tell readers apart: the smallest tables have too few.
@pytest.mark.parametrize("name", [*publications.QUERIES, "publications_json", "site_url_allowed", "landed_urls"])
def test_reading_matches_sql_on_more_pages(spark, larger_sql, name):
    matches(spark, larger_sql, LARGER, name)


def test_entry_gives_rows(spark):
    assert entry.entry(spark).take(1)
