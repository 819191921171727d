import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402
from check import _normal  # noqa: E402
from docflow.functions import content  # noqa: E402
from docflow.operators import crawl, outcome  # noqa: E402
from docflow.plans import derived  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_statement(spark, db, name):
    mine = _normal(contract.queries()[name](spark, DATA).toPandas())
    want = _normal(db.execute(contract.oracle_sql()[name]).df())
    assert list(mine.columns) == list(want.columns)
    assert len(mine) > 0
    assert mine.equals(want)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["extract_links", "change_decision", "outcome_status", "page_profile",
                                  "fold_attempts", "sustained_breach"])
def test_core_operators_stay_in_the_jvm(spark, name):
    plan = _plan(contract.queries()[name](spark, DATA))
    for node in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_attempt_ranks_are_limited_before_the_shuffle(spark):
    items = derived.item_attempts(spark, DATA)
    plan = _plan(outcome.first_attempts(items, ["l_orderkey"], derived.ATTEMPT_ORDER))
    before_exchange = plan[plan.index("Exchange"):]
    assert f"row_number(), {content.MAX_ATTEMPTS}, Partial" in before_exchange


def test_link_extraction_runs_once_per_page(spark):
    pages = derived.conform(derived.table(spark, DATA, "pages"), derived.schemas.PAGES)
    assert _plan(crawl.page_links(pages, "https://h/")).count("regexp_extract_all(html") == 1


def test_scans_read_only_what_is_needed(spark):
    plan = _plan(derived.all_hosts(spark, DATA).select("url"))
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan
    plan = _plan(derived.event_log(spark, DATA).filter(F.col("event_type") == "download_error").select("file"))
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan
