"""Driver contract, oracle parity at sf0.001, and plan shape checks."""

import duckdb
import pytest

import __spark_entry__ as E
from lectio.plans.oracle import ORACLES
from lectio.plans.queries import QUERIES
from lectio.sources.tables import DRIVER_TABLES

from .conftest import SF001

CORE = ["daily_allocation", "genre_summary", "enrich_left", "bib_record", "keyword_classify",
        "typed_clean", "lookup_resolve"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["username", "date", "est_pages_read", "n_books", "book_titles"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(E.queries())
    assert all(E.oracle_sql()[k] == ORACLES[k] for k in ORACLES)


@pytest.mark.parametrize("name", CORE)
def test_no_python_udf_in_core_plans(spark, name):
    plan = E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan


def test_pushdown_and_pruning(spark):
    df = E.queries()["daily_allocation"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert "o_totalprice" not in plan


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _norm(v):
    return repr(v) if isinstance(v, float) else v  # exact: both sides round through DECIMAL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_oracle_parity_small(spark, con, name):
    df = E.queries()[name](spark, SF001)
    cols = df.columns
    got = sorted(tuple(_norm(x) for x in r) for r in df.collect())
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    idx = [ocols.index(c) for c in cols]
    want = sorted(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert got == want


@pytest.mark.parametrize("name", ["daily_allocation", "rolling_mean_7", "lookup_plan", "genre_summary",
                                  "enrich_left", "dense_matrix"])
def test_no_single_partition_exchange(spark, name):
    """No global sort / un-partitioned window / single-task shuffle in the
    plans that carry data volume."""
    lines = E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString().splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            # only a global scalar aggregate (e.g. the newest-batch max) may
            # gather to one task, and only its partial results (one row/task)
            assert "HashAggregate(keys=[], functions=[partial_" in lines[i + 1], line


TYPE_NAMES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
              "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_oracle_types_match(spark, con, name):
    df = E.queries()[name](spark, SF001)
    spark_types = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    rel = con.sql(E.oracle_sql()[name])
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}


@pytest.mark.parametrize("name", ["genre_summary", "genre_view", "genre_unmatched", "genre_coverage", "metric_long",
                                  "dense_matrix"])
def test_classifier_is_not_pushed_into_a_filter(spark, name):
    """In a filter every string test would normalise the subjects again."""
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" in plan
    filters = [line for line in plan.splitlines() if "Filter " in line]
    assert not [line for line in filters if "regexp_replace" in line]


def test_rolling_mean_shuffles_totals_once(spark):
    """The rolling mean moves day totals to their user, nothing else."""
    def shuffles(name):
        plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")

    assert shuffles("rolling_mean_7") <= shuffles("daily_allocation") + 1


def test_titles_never_move_by_user_alone(spark):
    plan = QUERIES["daily_allocation"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    by_user = [line for line in plan.splitlines() if "Exchange hashpartitioning(username#" in line and ", date#" not in line
               and "started_reading#" not in line and "_b_day" not in line]
    assert by_user  # the gap search
    lines = plan.splitlines()
    for line in by_user:
        below = lines[lines.index(line) + 1:lines.index(line) + 4]
        assert not any("collect_list" in x for x in below), line
