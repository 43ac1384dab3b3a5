"""Facts, contexts and units of a filing are placed once; what follows stays there."""

import os
import re
import time

import pytest

from ledgerline.operators import composites, facts
from ledgerline.plans import adapters, queries
from ledgerline.plans import composites as plans
from ledgerline.plans import more, round_trips, submission_queries  # noqa: F401

from .test_operators import VALUE, value

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


@needs_tables
def test_joins_of_a_filing_shuffle_no_facts_again(spark):
    for name in ("a04_statements", "c07_taxonomy_report"):
        dealt = [x for x in plan(queries.QUERIES[name](spark, SF)) if "Exchange hashpartitioning(accession" in x]
        assert dealt and all("REPARTITION_BY_COL" in x for x in dealt)


@needs_tables
def test_placed_tables_hold_the_same_rows(spark):
    for name in adapters.PLACED:
        sql = adapters.ADAPTERS[name]
        plain = spark.sql(sql, **{t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("orders", "lineitem") if "{" + t + "}" in sql})
        placed = adapters.load(spark, SF, name)
        assert placed.schema == plain.schema and placed.count() == plain.count() and placed.exceptAll(plain).isEmpty()


def reads(df):
    return sum("Scan" in x for x in plan(df))


def test_lint_and_identities_read_their_values_once(spark):
    rows = [value("assets", "100"), value("assets", "1", unit="EUR"), value("liabilities", "60"), value("equity", "", period="in spring"), value("cash", "1", nil=True)]
    values = spark.createDataFrame(rows, VALUE)
    assert reads(facts.lint(values)) == 1 and reads(facts.identities(values)) == 1
    assert sorted(r.issue for r in facts.lint(values).collect()) == ["invalid period in spring: equity", "no values: cash", "no values: equity", "several units: assets"]


@needs_tables
def test_a_page_is_made_of_its_companys_facts(spark):
    f, g = (adapters.load(spark, SF, n) for n in ("facts", "filings"))
    mine, own = plans._of_company(f, g, "0000000007")
    assert mine.count() == f.where("accession like '0000000007-%'").count() > 0 and {r.cik for r in own.collect()} == {"0000000007"}
    lines = plan(queries.QUERIES["c02_company_page"](spark, SF))
    assert any("LeftSemi" in x for x in lines)


@needs_tables
def test_what_a_sort_reads_twice_is_stored(spark):
    assert not any("lineitem" in x or "orders" in x for x in queries.QUERIES["t08_statement_order"](spark, SF).inputFiles())


def test_statements_are_sorted_once_for_their_windows(spark):
    made = facts.stated(spark.createDataFrame([value("assets", "100")], VALUE).repartition("accession"))
    assert sum(x.strip(" :+-").startswith("Sort [") for x in plan(made)) == 1


def test_coverage_report_takes_a_row_for_each_filing(spark):
    status = spark.createDataFrame([("1", "a", "parsed"), ("1", "b", "missing"), ("2", "c", "parsed")], "cik string, accession string, status string").selectExpr("*", "date '2024-01-01' AS filing_date")
    listed = spark.createDataFrame([("a", {"core": ["cash", "equity"], "supplemental": ["eps_basic"]}), ("b", {"core": ["cash"]}), ("c", {})], "accession string, by_tier map<string,array<string>>")
    assert [(r.accession, r.missing) for r in composites.coverage_report(status, listed).collect()] == [("a", "cash,equity"), ("b", ""), ("c", "")]


@needs_tables
def test_views_map_facts_once(spark):
    view = queries.QUERIES["c01_filing_view"](spark, SF)
    assert any("/best-" in x for x in view.inputFiles()) and not any("classify" in x or "'Quarterly'" in x for x in plan(view))
    assert sum("lineitem" in x and "Scan" in x for x in plan(view)) <= 2


@needs_tables
@pytest.mark.parametrize("name", ["c06_filings", "c06_totals"])
def test_a_report_is_made_once(spark, name):
    made = queries.QUERIES[name](spark, SF).inputFiles()
    assert made and all("/report-" in x for x in made)


def test_a_report_reads_its_lists_once(spark):
    listed = spark.createDataFrame([("a", {"eps_diluted": "missing"}, ["eps_diluted"], {"core": ["eps_diluted"]}, {})], "accession string, metrics map<string,string>, missing array<string>, by_tier map<string,array<string>>, related map<string,array<string>>")
    status = spark.range(2).selectExpr("'1' AS cik", "if(id = 0, 'a', 'b') AS accession", "date '2024-01-01' AS filing_date", "'parsed' AS status")
    f = spark.range(2).selectExpr("if(id = 0, 'a', 'b') AS accession", "'i' AS instance", "'EarningsPerShareBasic' AS local", "'1' AS value", "'c' AS context_ref")
    report = composites.coverage_filings(status, listed, f, f.selectExpr("accession", "instance", "context_ref AS context_id"))
    assert sum("ExistingRDD" in x for x in plan(report)) == 1
    assert {r.accession: r.dimensional for r in report.collect()} == {"a": {"eps_diluted": ["eps_basic"]}, "b": None}


@needs_tables
def test_validation_makes_its_statements_once(spark):
    made = queries.QUERIES["c08_validation"](spark, SF)
    assert any("/stated-" in x for x in made.inputFiles()) and not any("min_by" in x for x in plan(made))


@needs_tables
def test_instances_are_composed_where_their_parts_lie(spark):
    made = submission_queries._instances(*[adapters.load(spark, SF, n) for n in ("facts", "contexts", "dimensions", "units")])
    dealt = [x for x in plan(made) if "Exchange hashpartitioning" in x]
    assert sum("REPARTITION_BY_COL" not in x for x in dealt) == 1  # texts of contexts and units, not those of facts
    assert not any("REPARTITION_BY_NUM" in x for x in dealt)


@needs_tables
def test_only_kinds_that_are_read_are_landed(spark):
    landed = {x.split("/kind=")[1].split("/")[0] for x in queries.QUERIES["s08_contexts"](spark, SF).inputFiles()}
    assert landed == {"context", "dimension"}


@needs_tables
def test_parts_of_a_view_share_one_exchange(spark):
    lines = plan(queries.QUERIES["c01_filing_view"](spark, SF))
    dealt = [i for i, x in enumerate(lines) if "REPARTITION_BY_COL" in x and "/best-" in lines[i + 1] + lines[i + 2]]
    assert len(dealt) == 4 and len({re.sub(r"#\d+L?|plan_id=\d+|^[ :+-]*", "", y) for i in dealt for y in lines[i : i + 2]}) == 2


def test_stored_rows_leave_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {x for x in disk.getAllFiles().mkString(" ").split() if "/shuffle_" in x}

    before, was = files(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    rows = round_trips._stored(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), "kept")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before and rows.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == was
