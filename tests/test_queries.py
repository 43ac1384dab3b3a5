"""Every registered query of the library runs on the smallest tables and matches its SQL."""

import math
import os

import duckdb
import pytest

from ledgerline.plans import adapters, composites, form_queries, function_queries, more, pass_queries, queries, round_trips, submission_queries  # noqa: F401

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(x):
        return ("nan" if math.isnan(x) else repr(round(x, 9))) if isinstance(x, float) else repr(x)

    return sorted(tuple(text(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    if name in queries.ORACLES:
        cursor = duck.execute(queries.ORACLES[name])
        want = canonical(cursor.fetchall(), [c[0] for c in cursor.description])
        assert got == want
    else:
        assert got


def test_announcement_texts_hold_whole_pages(spark, duck):
    texts = {r.accession: r.text for r in adapters.load(spark, SF, "announcement_texts").collect()}
    pages = dict(duck.execute("SELECT 'p-' || page_id, html FROM pages").fetchall())
    assert all(pages[k] in t for k, t in texts.items()) and len(texts) == len(pages)
