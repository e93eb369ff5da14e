"""Registered queries against their SQL in DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from grovespark.plans import curation_queries, division_queries, growth_queries, import_queries, join_queries, lookup_queries, tree_queries

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()
NAMES = ["clade_summary", "h6_pair_mrca", "h20_brackets", "f3_extinct_up", "f5_sibling_ranks", "a13_release_diff", "a17_contributions", "i5_mint", "m18_smush", "s21_lineage_nodes", "c4_articulations", "a1_event_counts", "a6_homonyms", "a7_homonym_report", *lookup_queries.QUERIES, *curation_queries.QUERIES, *growth_queries.QUERIES, *division_queries.QUERIES, *import_queries.QUERIES]


def rows(frame):
    cols = sorted(frame.columns)
    return sorted(str(tuple(None if v is None or v != v else (round(float(v), 6) if isinstance(v, float) else v) for v in r)) for r in frame[cols].astype(object).itertuples(index=False, name=None))


@pytest.fixture
def compiled(spark):
    """The session as it runs in production, with code generation."""
    had = {k: spark.conf.get(k) for k in ("spark.sql.codegen.wholeStage", "spark.sql.codegen.factoryMode")}
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    spark.conf.set("spark.sql.codegen.factoryMode", "FALLBACK")
    yield spark
    for k, v in had.items():
        spark.conf.set(k, v)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
@pytest.mark.parametrize("name", NAMES)
def test_query(compiled, name):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    queries, oracles = tree_queries.QUERIES | join_queries.QUERIES | lookup_queries.QUERIES | curation_queries.QUERIES | growth_queries.QUERIES | division_queries.QUERIES | import_queries.QUERIES, tree_queries.ORACLES | join_queries.ORACLES | lookup_queries.ORACLES | curation_queries.ORACLES | growth_queries.ORACLES | division_queries.ORACLES | import_queries.ORACLES
    assert rows(queries[name](compiled, DATA).toPandas()) == rows(c.execute(oracles[name]).df())
