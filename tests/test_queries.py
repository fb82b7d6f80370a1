"""Each registered query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from siltmark.plans import content, core, reading

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES = core.QUERIES | content.QUERIES | reading.QUERIES
ORACLES = core.ORACLES | content.ORACLES | reading.ORACLES

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    got = sorted(map(repr, map(tuple, df.select(*names).collect())))
    relation = duck.sql(ORACLES[name])
    assert sorted(relation.columns) == names
    want = sorted(map(repr, duck.sql(f"SELECT {', '.join(chr(34) + n + chr(34) for n in names)} FROM ({ORACLES[name]})").fetchall()))
    assert got == want


def test_pages_are_read(spark):
    items = reading.QUERIES["read_documents"](spark, SF)
    assert items.filter("error IS NOT NULL").isEmpty() and items.select("rel_path").distinct().count() == 50
    chunks = reading.QUERIES["chunk_pages"](spark, SF)
    assert chunks.select("rel_path").distinct().count() == 50 and chunks.filter("error IS NOT NULL").isEmpty()


def test_plans_push_down_and_stay_in_the_jvm(spark):
    for name in ("canonical_paths", "reconcile_plan", "split_prose", "flagship"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    labels = core.table(spark, SF, "labels").filter("toxic = 1")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(toxic,1)" in labels


def test_chunk_pages_reads_and_shuffles_once(spark):
    plan = QUERIES["chunk_pages"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1 and plan.count("Exchange ") == 1 and "Join" not in plan


@pytest.mark.parametrize("name", ["read_documents", "chunk_pages"])
def test_titles_cut_within_a_reference(spark, duck, tmp_path, name):
    cuts = ["&", "&a", "&am", "&amp", "&amp;", "&quo", "&quot", "&copy", "&amp;amp;", "&&amp", "AT&T", "&ampx"]
    html = [f"<!DOCTYPE html><html><head><title>{c}</title></head><body><article><h1>A {c}</h1><p><b>A {c}</b> &amp;&quot; b</p></article><footer>&copy; m &middot; {c}</footer></body></html>" for c in cuts]
    spark.createDataFrame(list(enumerate(html)), "page_id long, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    duck.sql(f"CREATE OR REPLACE TEMP VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    try:
        got = QUERIES[name](spark, str(tmp_path))
        want = duck.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in got.columns)} FROM ({ORACLES[name]})").fetchall()
    finally:
        duck.sql("DROP VIEW temp.pages")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want)) and len(want) >= 2 * len(cuts)


@pytest.mark.parametrize("name", ["read_documents", "chunk_pages"])
def test_pages_without_identifier_and_other_white_space(spark, duck, tmp_path, name):
    pages = [(None, "a"), (1, "a\u00a0\u00a0b"), (2, "\u00a0"), (3, "\u3000x \t\n y\u2003"), (4, None), (5, "")]
    html = [(k, p and f"<html><body><article><h1>H{k}</h1><p>{p}</article></body></html>") for k, p in pages]
    spark.createDataFrame(html, "page_id long, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    duck.sql(f"CREATE OR REPLACE TEMP VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    try:
        got = QUERIES[name](spark, str(tmp_path))
        want = duck.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in got.columns)} FROM ({ORACLES[name]})").fetchall()
    finally:
        duck.sql("DROP VIEW temp.pages")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want)) and len(want) == 3
