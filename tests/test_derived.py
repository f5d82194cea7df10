"""Queries over derived texts against their SQL, on the smallest tables."""

import duckdb
import pytest

from lexloom.plans import catalog, derived

SF = "/root/testdata/sf0.001"
NAMES = [n for n, f in catalog.QUERIES.items() if f.__module__ == derived.__name__]


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in ("lineitem", "part", "supplier"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_there_are_some():
    assert len(NAMES) == 14


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, tables, name):
    df, rel = catalog.QUERIES[name](spark, SF), tables.sql(catalog.ORACLES[name])
    names = sorted(df.columns)
    assert names == sorted(rel.columns)
    said = lambda rows, columns: sorted(str([r[columns.index(n)] for n in names]) for r in rows)
    assert said(df.collect(), df.columns) == said(rel.fetchall(), rel.columns)


@pytest.mark.parametrize("n,words", [(0, "nol"), (10, "sepuluh"), (11, "sebelas"), (17, "tujuh belas"), (40, "empat puluh"), (99, "sembilan puluh sembilan"), (100, "seratus"), (111, "seratus sebelas"), (205, "dua ratus lima")])
def test_number_words(n, words):
    assert derived.number_words(n) == words
