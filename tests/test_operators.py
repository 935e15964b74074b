import random

import pytest
from support import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from regiostat import constants as C
from regiostat.operators import crosswalk, latest, pivot, population, quality, ranking, statements
from regiostat.operators import series as S
from regiostat.operators import titles as T
from regiostat.operators import windows as W

col = F.col


def plain_rank(df, metric, group):
    w = Window.partitionBy(*group).orderBy(col(metric).desc_nulls_last())
    return df.withColumn("r", F.rank().over(w).cast("long"))


@pytest.mark.parametrize("group", [[], ["g"]])
def test_rank_equals_the_window_function(spark, group):
    rng = random.Random(7)
    data = []
    for i in range(3000):
        # a third of all rows share one value, a tenth are NULL, most fall in one group
        v = None if i % 10 == 0 else (42.0 if i % 3 == 0 else float(rng.randint(0, 400)))
        data.append((i, "big" if i % 5 else f"g{i % 7}", v))
    df = spark.createDataFrame(data, "i int, g string, v double").repartition(6)
    got = ranking.with_rank(df, "v", "r", group, buckets=9)
    assert rows(got, "i", "r") == rows(plain_rank(df, "v", group), "i", "r")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3), st.floats(-1e6, 1e6)), min_size=1, max_size=40))
def test_rank_property(spark, values):
    data = [(i, None if v is None else float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "i int, v double")
    assert rows(ranking.with_rank(df, "v", "r", buckets=4), "i", "r") == rows(plain_rank(df, "v", []), "i", "r")


def test_no_bucket_of_a_dominant_group_is_large(spark):
    """All rows in one group: the rows of a window are about a part of all, however many share a value."""
    df = spark.range(60_000).selectExpr("id AS i", "'a' AS g", "CAST(IF(id % 3 = 0, 7, id * 7919 % 50021) AS DOUBLE) AS v")
    cuts = df.agg(F.percentile_approx("v", [k / 1024 for k in range(1, 1024)]).alias("c"))
    last = F.filter("c", lambda _, i: i % ranking.RUN == ranking.RUN - 1)
    cuts = cuts.select(F.struct(F.col("c").alias("all"), last.alias("last")).alias("cuts")).scalar()
    sizes = ranking._bucketed(df, "v", cuts, 1024).groupBy("_bucket", "_tie").count()
    assert sizes.filter("NOT _tie").agg(F.max("count")).first()[0] < 2 * 60_000 / 1024
    assert sizes.filter("_tie").agg(F.max("count")).first()[0] >= 20_000
    got = ranking.with_rank(df, "v", "r", ["g"])
    assert got.exceptAll(plain_rank(df, "v", ["g"]).select(got.columns)).isEmpty()


def test_top_per_group_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 5.0), ("a", 3, 4.0), ("b", 4, None)], "g string, k int, v double")
    got = ranking.top_per_group(df, 2, ["g"], col("v").desc_nulls_last(), col("k"))
    assert rows(got, "g", "k", "position") == [("a", 1, 1), ("a", 2, 2), ("b", 4, 1)]


def test_top_and_rest_counts_missing_as_zero(spark):
    values = spark.createDataFrame([(1, 1, 10.0), (1, 2, 20.0), (2, 1, 5.0)], "code int, period int, value double")
    total = spark.createDataFrame([(1, 100.0), (2, 200.0), (3, None)], "period int, value double")
    chosen = spark.createDataFrame([(1, "x"), (2, "y")], "code int, label string")
    got = ranking.top_series_and_rest(values, total, chosen).filter("kind = 'rest'")
    assert rows(got, "period", "value") == [(1, 85.0), (2, 180.0), (3, None)]


def test_rows_and_periods_differ_on_gaps(spark):
    periods = [202301, 202303] + [202400 + m for m in range(1, 13)]
    df = spark.createDataFrame([("k", p, float(i + 1)) for i, p in enumerate(periods)], "k string, period int, v double")
    lagged = df.withColumn("x", W.row_lag("v", 12, ["k"])).filter("period = 202411").first()["x"]
    ago = W.with_year_ago(df, ["k"], "v", "x").filter("period = 202403").first()["x"]
    assert (lagged, ago) == (1.0, 2.0)
    rolled = df.withColumn("x", W.rolling_sum("v", ["k"])).orderBy("period").collect()
    assert rolled[0]["x"] == 1.0 and rolled[-1]["x"] == sum(range(3, 15))


def test_share_is_null_safe_on_the_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 0.0)], "g string, v double")
    assert rows(W.share_of_group(df, "v", ["g"], "s"), "v", "s") == [(0.0, None), (1.0, 25.0), (3.0, 75.0)]


def test_population_fills_forward_then_backward(spark):
    a = spark.createDataFrame([("p", 2000, 10.0), ("p", 2003, 13.0), ("q", 2002, 5.0)], "place_id string, year int, population double")
    b = spark.createDataFrame([("p", 2000, 99.0), ("p", 1999, 9.0), ("r", 2001, 7.0)], "place_id string, year int, population double")
    got = rows(population.reference_population(a, b), "place_id", "year", "population")
    assert [v for p, _, v in got if p == "p"] == [9.0, 10.0, 10.0, 10.0, 13.0]
    assert [v for p, _, v in got if p == "q"] == [5.0] * 5
    assert [v for p, _, v in got if p == "r"] == [7.0] * 5


def test_pivot_first_drops_unknown_codes_and_empty_keys(spark):
    df = spark.createDataFrame(
        [("a", 1, 5.0), ("a", 1, 6.0), ("a", 9, 1.0), ("b", 1, None), ("c", 9, 2.0)], "k string, c int, v double"
    ).withColumn("_order", F.monotonically_increasing_id())
    got = pivot.pivot_first(df.coalesce(1), ["k"], "c", "v", {"x": 1, "y": 2})
    assert rows(got) == [("a", 5.0, None)]


def test_pivot_without_match_is_null_or_zero(spark):
    df = spark.createDataFrame([("k", 1, 5.0)], "k string, c int, v double")
    assert rows(pivot.pivot_sum(df, ["k"], "c", "v", {"x": [1], "y": [2]})) == [("k", 5.0, None)]
    assert rows(pivot.pivot_count(df, ["k"], "c", "v", {"x": [1], "y": [2]})) == [("k", 5.0, 0.0)]


def test_unpivot_sum_drops_empty_cells(spark):
    df = spark.createDataFrame([(1, 1.0, None), (1, 2.0, None), (2, None, 4.0)], "k int, a double, b double")
    assert rows(pivot.unpivot_sum(df, ["k"], ["a", "b"], "c", "v")) == [(1, "a", 3.0), (2, "b", 4.0)]


def test_latest_positions(spark):
    df = spark.createDataFrame(
        [(1, 202312, "TRIMESTRAL"), (2, 202401, "MENSAL"), (3, 202312, "MENSAL")], "k int, period int, frequency string"
    )
    assert rows(latest.at_latest(df), "k") == [(2,)]
    got = latest.at_latest_per_frequency(df, C.MONTHLY, C.QUARTERLY)
    assert rows(got, "k") == [(1,), (2,), (3,)]
    rates = spark.createDataFrame([("2024-02", "IMOBILI x"), ("2024-01", "imobili y"), ("2024-03", "other"), ("2024-02", "other")], "d string, m string")
    assert rows(latest.at_two_latest(rates, "d", col("m").ilike("%imobili%"))) == [("2024-02", "IMOBILI x"), ("2024-03", "other")]


def test_fallback_never_replaces_delivered_groups(spark):
    main = spark.createDataFrame([(1, "a", 1.0)], "p int, r string, v double")
    other = spark.createDataFrame([(1, "a", 9.0), (1, "b", 2.0)], "p int, r string, v double")
    assert rows(latest.fill_missing_groups(main, other, ["p", "r"])) == [(1, "a", 1.0), (1, "b", 2.0)]


def test_code_lists_and_code_extension(spark):
    lists = spark.createDataFrame([("s", "B, C,D"), ("t", "E")], "k string, m string")
    facts = spark.createDataFrame([("C", 2), ("D", 3), ("Z", 9)], "x string, n int")
    got = crosswalk.totals_by_list(lists, "k", "m", facts, "x", [F.sum("n").alias("n")])
    assert rows(got) == [("s", 5)]
    place = spark.createDataFrame([("123456", "1234567")], "place_id6 string, place_id string")
    moves = spark.createDataFrame([("123456", 1), ("999999", 2)], "place_id6 string, n int")
    known, unknown = crosswalk.extend_code(moves, place)
    assert rows(known, "place_id", "n") == [("1234567", 1)] and rows(unknown, "n") == [(2,)]


def test_align_keeps_gaps_and_axis_length(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 3, 3.0), ("b", 2, 2.0), ("b", 9, 9.0)], "k string, period int, v double")
    got = {r["k"]: r["h"] for r in S.align(df, ["k"], {"v": "h"}, F.array(F.lit(1), F.lit(2), F.lit(3))).collect()}
    assert got == {"a": [1.0, None, 3.0], "b": [None, 2.0, None]}


def test_position_changes(spark):
    df = spark.createDataFrame([([4, 0, 5, None, 7],)], "h array<int>")
    got = df.select(*[v.alias(k) for k, v in S.position_changes(col("h")).items()]).first()
    assert got["step"] == [None, -4, 5, None, None]
    assert got["step_pct"] == [None, -100.0, None, None, None]


def test_extremes_and_record(spark):
    df = spark.createDataFrame([("b", 3.0), ("a", 3.0), ("c", None), ("d", -1.0)], "k string, m double")
    assert tuple(S.best_and_worst(df, "k", "m").first()) == ("a", 3.0, "d", -1.0)
    s = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, None)], "period int, v double")
    assert tuple(s.agg(S.record_high("v").alias("r")).first()["r"]) == (5.0, 1)
    assert s.agg(S.last_known("v")).first()[0] == 5.0


def test_every_title_prefix_and_edge_titles(spark):
    data = [(i, p[0] + (" " if p[0].endswith("-") else " - ") + "Vendor") for i, p in enumerate(T.TITLE_PATTERNS)]
    got = {r["code"]: r for r in T.parse_titles(spark.createDataFrame(data, "code int, title string")).collect()}
    for i, (_, metric, client, origin, modality) in enumerate(T.TITLE_PATTERNS):
        r = got[i]
        assert (r["metric"], r["client"], r["origin"]) == (metric, client or None, origin or None)
        assert r["modality"] == (modality or "Vendor") and r["parse_status"] == C.PARSED
    edge = [
        (1, "Saldo de crédito pessoa jurídica por modalidade de crédito - pequeno porte - ARO - adiantamento de receitas"),
        (2, "Spread do ICC - Recursos livres - Pessoas físicas - Total"),
        (3, "Saldo de crédito por região - MEI - Centro-Oeste - Total"),
        (4, "Prazo médio da carteira de crédito com recursos livres - Pessoas jurídicas - Desconto de cheques"),
        (5, "Outra coisa"),
        (6, "Saldo da carteira de crédito com recursos livres - Norteamento"),
    ]
    cols = ["metric", "client", "size", "origin", "region", "modality", "parse_status"]
    got = {r["code"]: tuple(r[c] for c in cols) for r in T.parse_titles(spark.createDataFrame(edge, "code int, title string")).collect()}
    assert got[1] == ("SALDO", "PJ", "PEQUENO", None, None, "ARO - adiantamento de receitas", "OK")
    assert got[2] == ("SPREAD_ICC", "PF", None, "LIVRE", None, None, "OK")
    assert got[3] == ("SALDO", "MEI", None, None, "CENTRO_OESTE", None, "OK")
    assert got[4] == ("PRAZO_MEDIO_CARTEIRA", "PJ", None, "LIVRE", None, "Desconto de cheques", "OK")
    assert got[5] == (None, None, None, None, None, None, "NAO_PARSEADO")
    assert got[6][4:6] == (None, "Norteamento")


def test_catalogue_first_search_wins_and_static_rows_override(spark):
    hits = spark.createDataFrame(
        [(1, "Spread do ICC - Total", "Mensal", "%", "b", 2), (1, "Outra", "Mensal", "%", "a", 1), (27701, "x", "y", "%", "a", 1)],
        "code int, title string, frequency string, unit string, search string, search_order int",
    )
    got = {r["code"]: r for r in T.build_catalogue(hits, T.size_series(spark)).collect()}
    assert got[1]["parse_status"] == C.UNPARSED and got[1]["search"] == "a"
    assert got[27701]["size"] == "MPME" and len(got) == 5
    audit = quality.unparsed_titles(T.build_catalogue(hits, T.size_series(spark)))
    assert rows(audit, "code") == [(1,)]


def statement(spark, **values):
    columns = list(C.STATEMENT_COLUMNS)
    schema = "inst_id string, period int, " + ", ".join(f"{c} double" for c in columns)
    return spark.createDataFrame([("x", 202506, *[values.get(c) for c in columns])], schema)


def test_statement_totals(spark):
    full = statement(
        spark, interbank_income=10.0, credit_income=5.0, expected_loss=-4.0, derivatives_result=-2.0,
        equity_result=3.0, net_income=12.0, total_assets=0.0, credit_expected_loss=-1.0,
    )
    r = statements.with_statement_metrics(full).first()
    assert (r["total_revenue"], r["total_cost"], r["roa"], r["credit_expected_loss"]) == (18.0, 6.0, None, 1.0)
    old = statements.with_statement_metrics(statement(spark, credit_income=5.0, net_income=1.0, total_assets=100.0)).first()
    assert (old["total_revenue"], old["total_cost"], old["roa"]) == (None, None, 2.0)


def test_checks_fire_on_planted_defects_only(spark):
    good = statements.with_statement_metrics(statement(spark, interbank_income=10.0, net_income=9.5))
    bad = statements.with_statement_metrics(statement(spark, interbank_income=10.0, net_income=3.0))
    assert statements.broken_totals(good).count() == 0
    assert rows(statements.broken_totals(bad), "gap") == [(7.0,)]
    broken = statement(spark, interbank_income=10.0, intermediation_result=9.0, result_before_tax=9.0, net_income=9.0)
    assert rows(statements.broken_identities(broken), "total", "gap") == [("intermediation_result", 1.0)]
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "k string, p int")
    assert rows(quality.duplicate_keys(df, ["k", "p"])) == [("a", 1, 2)]
    dim = spark.createDataFrame([("a",)], "k string")
    assert rows(quality.without_partner(df, dim, "k")) == [("b", 1)]
    assert rows(quality.unclassified(df, dim, "k")) == [("b",)]
    assert tuple(quality.load_summary(df, "k", "p").first()) == (3, 1, 1, 2)


def test_rows_of_the_null_group_are_ranked(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 5.0), (None, 3.0), (None, None)], "g string, v double")
    got = rows(ranking.with_rank(df, "v", "r", ["g"], 4))
    assert sorted((r for g, _, r in got if g is None)) == [1, 2, 3]
    assert len(got) == 5


def test_one_dominant_group_ranks_like_the_window(spark):
    df = spark.range(6000).selectExpr("IF(id % 50 = 0, id % 7, 99) AS g", "CAST(hash(id) % 1000 AS DOUBLE) AS v", "id")
    got = rows(ranking.with_rank(df, "v", "r", ["g"]), "id", "r")
    assert got == rows(df.selectExpr("id", "rank() OVER (PARTITION BY g ORDER BY v DESC NULLS LAST) AS r"), "id", "r")


def test_first_of_several_values_of_a_cell(spark):
    from regiostat.operators.series import align

    df = spark.createDataFrame([("k", 2, 5.0, 2), ("k", 2, 9.0, 1), ("k", 1, 4.0, 1), ("k", None, 7.0, 1)], "key string, period int, v double, place int")
    axis = F.array(F.lit(1), F.lit(2), F.lit(3))
    assert align(df, ["key"], {"v": "v"}, axis, first_by=["place"]).first()["v"] == [4.0, 9.0, None]
    assert align(df, ["key"], {"v": "v"}, axis).first()["v"] == [4.0, 5.0, None]
