"""Plans that must hold at any scale."""

import re

import pytest
from support import SMALL

from contract.adapter import SOURCE_TABLES, DriverTables
from contract.queries import QUERIES
from regiostat.plans.catalogue import VIEWS

HEAVY = ["V1_sector_credit", "V5_credit_detail", "V13_income_statement", "V22_place_credit", "V24_place_credit_per_capita",
         "V25_credit_penetration", "V26_sector_jobs", "V31_sector_crosswalk", "V32_state_scorecard", "V36_place_ranking",
         "D8_place_panel", "D17_statement_history", "N9_rate_history", "J6_list_membership", "S15_catalogue_first_search",
         "W5_global_rank", "W5_rank_per_year"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", HEAVY)
def test_no_products_no_python_no_forced_broadcast(spark, key):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES[key](DriverTables(spark, SMALL, staging=False)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange", "InPandas", "ArrowEval", "BatchEval"):
        assert node not in text, node
    assert not re.search(r"Window \[.*?\n.*?Sort.*?\n.*?Exchange SinglePartition", text)


def test_scans_read_only_the_columns_they_need(spark):
    text = plan(DriverTables(spark, SMALL)["credit_value"])
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in text


def test_filters_reach_the_scan(spark, tmp_path):
    from regiostat.sources.sinks import write_table

    t = DriverTables(spark, SMALL)
    write_table(t["place_balance"], str(tmp_path / "b"), "period")
    t.repoint("place_balance", spark.read.parquet(str(tmp_path / "b")))
    text = plan(t["place_balance"].filter("period = 199901 AND account = 160"))
    assert "PartitionFilters: [isnotnull(period" in text and "EqualTo(account,160)" in text


def test_partial_aggregation_before_the_shuffle(spark):
    text = plan(DriverTables(spark, SMALL)["place_balance"])
    assert text.count("partial_sum") == 1 and text.index("partial_sum") > text.index("Exchange")


def test_top_per_group_is_limited_before_the_shuffle(spark):
    text = plan(QUERIES["T3_top_per_group"](DriverTables(spark, SMALL)))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_planning_a_view_starts_no_job(spark):
    """Without a work folder nothing is staged; only the schemas of the source files are read."""
    t = DriverTables(spark, SMALL, staging=False)
    for name in SOURCE_TABLES:
        t[name].columns  # noqa: B018
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    for name in VIEWS:
        assert t[name].columns
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before


@pytest.mark.parametrize("view", ["state_scorecard", "section_scorecard"])
def test_latest_positions_prune_the_periods_of_written_tables(spark, tmp_path, view):
    """On written tables the latest position is a filter on the folders, and nothing is staged."""
    from regiostat.sources.sinks import period_column, write_table

    t = DriverTables(spark, SMALL, staging=False)
    facts = ["place_gdp", "place_company", "place_jobs", "place_balance", "series_value"]
    wanted = rows_of(t, view)
    for name in facts:
        write_table(t[name], str(tmp_path / name), period_column(t[name]))
    for name in facts:
        t.repoint(name, spark.read.parquet(str(tmp_path / name)))
    t.work = str(tmp_path / "work")
    scans = [line for line in plan(t[view]).splitlines() if "FileScan" in line]
    scans = [line for line in scans if re.search(r"ReadSchema: struct<[^>]*\b(companies|net):", line)]
    assert len(scans) >= 2
    assert all(re.search(r"PartitionFilters: \[[^]]*(year|period)[^]]*Subquery", line) for line in scans)
    assert not [p.name for p in (tmp_path / "work").glob("*") if p.name.rsplit("-", 1)[0] in facts]
    assert rows_of(t, view) == wanted


def rows_of(t, name):
    return sorted(map(str, t[name].collect()))
