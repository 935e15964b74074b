"""Lending rates by institution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostat import constants as C
from regiostat.functions import clean as X
from regiostat.operators.latest import first_by_precedence
from regiostat.sources.files import read_envelope

# Fields of the weekly and of the monthly (property loan) files.
WEEKLY_FIELDS = {
    "InicioPeriodo": "start_date", "cnpj8": "tax_id8", "InstituicaoFinanceira": "institution",
    "Segmento": "segment", "Modalidade": "modality", "TaxaJurosAoMes": "month_rate",
    "TaxaJurosAoAno": "year_rate",
}
MONTHLY_FIELDS = ["anoMes", "cnpj8", "InstituicaoFinanceira", "Modalidade", "TaxaJurosAoMes", "TaxaJurosAoAno"]


def housing_rates(raw: DataFrame) -> DataFrame:
    """Monthly files carry no segment: all their products are household loans."""
    return raw.select(
        F.concat("anoMes", F.lit("-01")).alias("start_date"), F.col("cnpj8").alias("tax_id8"),
        F.col("InstituicaoFinanceira").alias("institution"),
        F.lit(C.SEGMENT_HOUSEHOLD).alias("segment"), F.col("Modalidade").alias("modality"),
        F.col("TaxaJurosAoMes").alias("month_rate"), F.col("TaxaJurosAoAno").alias("year_rate"),
    )


def read_lending_rates(spark: SparkSession, weekly: str, monthly: str) -> DataFrame:
    week = read_envelope(spark, weekly, WEEKLY_FIELDS)
    month = read_envelope(spark, monthly, {f: f for f in MONTHLY_FIELDS})
    housing = housing_rates(month).withColumn("stem", F.lit("~"))
    rows = week.unionByName(housing).withColumns(
        {c: X.lenient_number(F.col(c)) for c in ("month_rate", "year_rate")}
    )
    kept = first_by_precedence(
        rows.filter(F.col("month_rate").isNotNull()),
        ["start_date", "tax_id8", "segment", "modality"],
        [F.col("stem"), F.col("month_rate"), F.col("year_rate"), F.col("institution")],
    )
    return kept.drop("stem")
