from support import rows
from pyspark.sql import functions as F

from regiostat.functions import clean as X
from regiostat.functions import metrics as M
from regiostat.functions import periods as P

col = F.col


def one(spark, value, schema, expr):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("x")).first()["x"]


def test_text_cleaning(spark):
    fold = X.fold_accents(col("v"))
    assert one(spark, "São João d'Aliança – ção", "v string", fold) == "Sao Joao d'Alianca  cao"
    assert one(spark, "  Açaí  ", "v string", X.name_key(col("v"))) == "ACAI"
    assert one(spark, "a1-2b3", "v string", X.digits_only(col("v"))) == "123"
    assert one(spark, None, "v string", X.digits_only(col("v"))) == ""
    assert one(spark, "", "v string", X.null_if_blank(col("v"))) is None
    assert one(spark, " A Agricultura", "v string", X.section_of_label(col("v"))) == "A"


def test_lenient_numbers(spark):
    df = spark.createDataFrame([(v,) for v in ["1.5", " 2 ", "...", "-", "", None]], "v string")
    assert [r[0] for r in df.select(X.lenient_number(col("v"))).collect()] == [1.5, 2.0, None, None, None, None]
    assert one(spark, "1234,56", "v string", X.decimal_comma(col("v"))) == 1234.56
    assert one(spark, "x", "v string", X.count_or_zero(col("v"))) == 0
    assert one(spark, "-1", "v string", X.count_or_zero(col("v"))) == -1


def test_labels(spark):
    assert one(spark, 5, "v int", X.region_label(col("v"))) == "Centro-Oeste"
    assert one(spark, 9, "v int", X.region_label(col("v"))) is None
    assert one(spark, "Centro-Oeste", "v string", X.region_code(col("v"))) == "CENTRO_OESTE"
    df = spark.createDataFrame([("Mensal ",), ("Trimestral",), (None,)], "v string")
    got = [r[0] for r in df.select(X.monthly_quarterly(col("v"))).collect()]
    assert got == ["MENSAL", "TRIMESTRAL", "TRIMESTRAL"]


def test_periods(spark):
    assert one(spark, "07/03/2024", "v string", P.month_of_dmy(col("v"))) == 202403
    assert one(spark, "07/03/2024", "v string", P.iso_of_dmy(col("v"))) == "2024-03-07"
    assert one(spark, "bad", "v string", P.month_of_dmy(col("v"))) is None
    assert one(spark, "2024-03-01T00:00", "v string", P.month_of_iso(col("v"))) == 202403
    assert one(spark, 202401, "v int", P.previous_month(col("v"))) == 202312
    assert one(spark, 202405, "v int", P.december_before(col("v"))) == 202312
    assert str(one(spark, 202405, "v int", P.month_start(col("v")))) == "2024-05-01"


def test_month_list_respects_lag_and_year_end(spark):
    bounds = spark.sql("SELECT date'2023-11-15' AS a, date'2024-04-02' AS b")
    months = [r[0] for r in P.month_list(bounds, "a", "b", 2).collect()]
    assert months == [202311, 202312, 202401, 202402]
    assert [r[0] for r in P.quarter_ends(P.month_list(bounds, "a", "b", 0)).collect()] == [202312, 202403]
    assert P.month_list(bounds, "a", "b", 12).count() == 0


def test_rounding_is_half_up_on_the_printed_decimal(spark):
    df = spark.createDataFrame([(v,) for v in [1.005, 0.285, 0.145, 2.5, 50.125]], "v double")
    got = [r[0] for r in df.select(M.ratio(col("v"), F.lit(1.0), 1, 2)).collect()]
    assert got == [1.01, 0.29, 0.15, 2.5, 50.13]


def test_zero_and_missing_denominators(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (None, 2.0), (3.0, 2.0), (0.0, 2.0)], "a double, b double")
    a, b = col("a"), col("b")
    assert [r[0] for r in df.select(M.pct_change(a, b)).collect()] == [None, None, None, 50.0, -100.0]
    assert [r[0] for r in df.select(M.pct_change_nonzero(a, b)).collect()][-1] is None
    assert [r[0] for r in df.select(M.point_change(a, b)).collect()] == [1.0, None, None, 1.0, -2.0]


def test_annual_factor_and_return(spark):
    df = spark.createDataFrame([(202403,), (202406,), (202409,), (202412,), (202405,)], "p int")
    got = [r[0] for r in df.select(M.annual_factor(col("p"))).collect()]
    assert got == [4.0, 2.0, 4 / 3, 1.0, None]
    assert one(spark, 202403, "p int", M.return_on_assets(F.lit(1.0), F.lit(0.0), col("p"))) is None


def test_weighted_mean_ignores_rows_without_a_mean(spark):
    df = spark.createDataFrame([(100.0, 1), (200.0, 3), (None, 50)], "m double, w long")
    assert df.agg(M.weighted_mean(col("m"), col("w")).alias("x")).first()["x"] == 175.0


def test_sums_do_not_depend_on_order(spark):
    values = [(0.1 * i,) for i in range(1000)]
    a = spark.createDataFrame(values, "v double").agg(M.money_sum(col("v"))).first()[0]
    b = spark.createDataFrame(values[::-1], "v double").repartition(7).agg(M.money_sum(col("v"))).first()[0]
    assert a == b == 49950.0


def test_bands(spark):
    df = spark.createDataFrame([(None,), (1e7,), (99_999.0,), (1e6,)], "v double")
    got = [r[0][0] for r in df.select(M.gdp_band(col("v"))).collect()]
    assert got == ["4", "1", "4", "2"]
    assert rows(df.select(M.population_band(F.lit(20_000)).alias("b")).distinct()) == [("4. 20 mil a 100 mil",)]


def test_numbers_that_are_none_and_numbers_that_do_not_fit(spark):
    texts = ["10d", "NaN", "Infinity", "1e400", "1e30", "99999999999", " 7.9 ", "-.5", "1_0", "0x1", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, c string").orderBy("n")
    c = F.col("c")
    got = [tuple(r) for r in df.select(X.lenient_number(c), X.lenient_int(c), X.count_or_zero(c)).collect()]
    assert got == [
        (None, None, 0), (None, None, 0), (None, None, 0), (None, None, 0), (1e30, None, 0),
        (99999999999.0, None, 99999999999), (7.9, 7, 7), (-0.5, 0, 0), (None, None, 0),
        (None, None, 0), (None, None, 0), (None, None, 0),
    ]
