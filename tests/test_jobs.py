import random

import pytest
from support import SMALL, rows
from pyspark.sql import functions as F

from contract.adapter import DriverTables
from regiostat.plans.catalogue import MATERIALISED
from regiostat.plans.datasets import place_panel
from regiostat.plans.reports import WORKBOOKS, sheets
from regiostat.sources import sinks
from regiostat.sources.movements import signed_jobs
from regiostat.streaming import incremental as I
from regiostat.tables import TableSet

MOVE = "period int, division string, movement long, wage double, kind string"
KEYS = ["period", "division"]


def some_moves(n=400, seed=3):
    rng = random.Random(seed)
    return [
        (202401 + rng.randint(0, 5), f"0{rng.randint(1, 4)}", rng.choice([1, -1, 0]),
         rng.choice([None, 1000.25, 1500.5]), rng.choice(["MOV", "MOV", "FOR", "EXC"]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_arrival_order_gives_the_batch_result(spark, tmp_path, seed):
    moves = some_moves()
    expected = rows(signed_jobs(spark.createDataFrame(moves, MOVE), KEYS))
    random.Random(seed).shuffle(moves)
    landing, out, checkpoint = (f"{tmp_path}/{d}" for d in ("in", "out", "checkpoint"))
    for i in range(3):
        chunk = spark.createDataFrame(moves[i::3], MOVE).coalesce(1)
        chunk.write.mode("append").parquet(landing)
        stream = I.file_stream(spark, landing, "*.parquet")
        result = I.stream_signed_totals(stream, KEYS, out, checkpoint)
    assert rows(result) == expected


def test_only_new_files_are_read(spark, tmp_path):
    landing, out, checkpoint = (f"{tmp_path}/{d}" for d in ("in", "out", "checkpoint"))
    seen = []

    def reduce(batch):
        seen.append(batch.count())
        return batch.groupBy("k").agg(F.sum("v").alias("v"))

    for i in range(2):
        spark.createDataFrame([("a", i), ("b", 1)], "k string, v long").coalesce(1).write.mode("append").parquet(landing)
        partials = I.aggregate_new_files(I.file_stream(spark, landing, "*.parquet"), reduce, out, checkpoint)
    assert seen == [2, 2]
    assert rows(I.add_up(partials, ["k"])) == [("a", 1), ("b", 2)]


def test_streamed_months_equal_batch_months(spark, tmp_path):
    stream = I.file_stream(spark, SMALL, "events.parquet")
    days = I.stream_daily_counts(stream, "ts", "event_type", f"{tmp_path}/o", f"{tmp_path}/c")
    batch = I.monthly_counts(spark.read.parquet(f"{SMALL}/events.parquet"), "ts", "event_type")
    assert rows(I.months_of_days(days)) == rows(batch)


def test_an_old_file_that_comes_late_counts(spark, tmp_path):
    landing, seen = f"{tmp_path}/landing", f"{tmp_path}/seen"
    for day in ("2024-06-03 10:00:00", "2024-06-20 09:00:00", "2024-01-05 08:00:00"):
        row = spark.createDataFrame([(day, "a")], "ts string, kind string").select(F.to_timestamp("ts").alias("ts"), "kind")
        row.coalesce(1).write.mode("append").parquet(landing)
        stream = I.file_stream(spark, landing, "*.parquet")
        days = I.stream_daily_counts(stream, "ts", "kind", seen, f"{tmp_path}/checkpoint")
    assert rows(I.months_of_days(days)) == rows(I.monthly_counts(spark.read.parquet(landing), "ts", "kind"))
    assert rows(I.months_of_days(days)) == [(202401, "a", 1), (202406, "a", 2)]


def test_revised_period_replaces_the_old_one(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.write_table(spark.createDataFrame([(1, "a"), (2, "b")], "period int, v string"), path, "period")
    sinks.replace_periods(spark.createDataFrame([(2, "c")], "period int, v string"), path)
    assert rows(spark.read.parquet(path), "period", "v") == [(1, "a"), (2, "c")]
    newest = I.newest_release(spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "k int, r int, v string"), ["k"], "r")
    assert rows(newest) == [(1, 2, "y")]


def test_base_tables_reject_duplicate_keys(spark, tmp_path):
    t = TableSet(spark, {"series_value": lambda _: spark.sql("SELECT 1 code, 202401 period, '' date, 1.0D value FROM range(2)")})
    with pytest.raises(ValueError, match="series_value"):
        sinks.write_base_tables(t, str(tmp_path))


def test_a_failed_check_leaves_the_current_table(spark, tmp_path):
    folder = str(tmp_path)
    one = TableSet(spark, {"series_value": lambda _: spark.sql("SELECT 1 code, 202401 period, '' date, 1.0D value")})
    sinks.write_base_tables(one, folder)
    before = sinks.current_version(spark, folder, "series_value")
    two = TableSet(spark, {"series_value": lambda _: spark.sql("SELECT 1 code, 202401 period, '' date, 2.0D value FROM range(2)")})
    with pytest.raises(ValueError, match="series_value"):
        sinks.write_base_tables(two, folder)
    assert sinks.current_version(spark, folder, "series_value") == before
    assert spark.read.parquet(before).select("value").collect() == [(1.0,)]


def test_a_table_written_twice_stays(spark, tmp_path):
    t = TableSet(spark, {"v": lambda _: spark.range(5).toDF("n")})
    for _ in range(3):
        sinks.materialise(t, str(tmp_path), ["v"])
        assert rows(t["v"]) == [(k,) for k in range(5)]
    current = sinks.current_version(spark, str(tmp_path), "v")
    assert rows(spark.read.parquet(current)) == [(k,) for k in range(5)]


def test_views_are_the_same_on_written_tables(spark, tmp_path):
    lazy = DriverTables(spark, SMALL)
    expected = {n: rows(lazy[n]) for n in ("state_scorecard", "sector_crosswalk")}
    stored = DriverTables(spark, SMALL)
    sinks.write_base_tables(stored, f"{tmp_path}/base")
    sinks.materialise(stored, f"{tmp_path}/views")
    assert "FileScan" in stored["place_ranking"]._jdf.queryExecution().toString()
    for name, want in expected.items():
        assert rows(stored[name]) == want
    assert (tmp_path / "views" / MATERIALISED[-1]).exists()
    stored.register(["place_ranking"])
    assert spark.sql("SELECT count(*) FROM place_ranking").first()[0] == stored["place"].count()


def test_sheets_payload_and_seed_sinks(spark, tmp_path):
    t = DriverTables(spark, SMALL)
    counts = sinks.write_sheets(t, WORKBOOKS["R1"], f"{tmp_path}/r1")
    assert counts["credit panel"] == t["credit_macro"].count() and len(counts) == 4
    assert len(sheets()) == 47
    sinks.write_payload(place_panel(t), f"{tmp_path}/places")
    back = spark.read.json(f"{tmp_path}/places")
    assert back.count() == t["place"].count()
    assert back.filter("size(hist_gdp) <> 7").count() == 0
    sinks.write_seed(t["credit_series"], f"{tmp_path}/seed", "code")
    first = spark.read.csv(f"{tmp_path}/seed", sep=";", header=True).first()
    assert first["code"] == "0"
    done = spark.createDataFrame([("a",)], "path string")
    assert rows(sinks.unprocessed(spark.createDataFrame([("a",), ("b",)], "path string"), done)) == [("b",)]


def test_states_add_up_to_the_nation(spark):
    t = DriverTables(spark, SMALL)
    states = t["state_employment"].groupBy("period").agg(F.sum("net").alias("s"))
    nation = t["place_jobs"].groupBy("period").agg(F.sum("net").alias("n"))
    assert states.join(nation, "period").filter("s <> n").count() == 0
    shares = t["insolvency_state"].groupBy("period").agg(F.sum("judicial").alias("s"))
    assert shares.join(t["insolvency_national"], "period").filter("s <> judicial").count() == 0
    gdp = t["place_gdp_profile"].groupBy("state", "year").agg(F.sum("state_share_pct").alias("p"))
    assert gdp.filter("abs(p - 100) > 0.1").count() == 0
