"""Title grammar of the detailed credit catalogue, as native column expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat import constants as C
from regiostat.functions.clean import label_of, monthly_quarterly

# Title prefix, metric, client, origin, modality ("" = read it from the title).
TITLE_PATTERNS = [
    ("Saldo de crédito pessoa jurídica por modalidade de crédito", "SALDO", "PJ", None, None),
    ("Saldo de crédito do MEI pessoa jurídica por modalidade de crédito", "SALDO", "MEI_PJ", None, None),
    ("Saldo de crédito do MEI pessoa física por modalidade de crédito", "SALDO", "MEI_PF", None, None),
    ("Saldo de crédito por origem dos recursos e modalidade de crédito", "SALDO", "MEI", None, None),
    ("Taxa de juros de pessoa jurídica por origem dos recursos e modalidade de crédito", "TAXA_JUROS", "PJ", None, None),
    ("Taxa de juros por origem dos recursos e modalidade de crédito", "TAXA_JUROS", "MEI", None, None),
    ("Taxa de inadimplência de pessoa jurídica por origem dos recursos e modalidade de crédito", "TAXA_INADIMPLENCIA", "PJ", None, None),
    ("Taxa de inadimplência por origem dos recursos e modalidade de crédito", "TAXA_INADIMPLENCIA", "MEI", None, None),
    ("Indicador de Custo do Crédito - ICC", "ICC", None, None, None),
    ("Spread do ICC", "SPREAD_ICC", None, None, None),
    ("Prazo médio da carteira de crédito com recursos livres", "PRAZO_MEDIO_CARTEIRA", None, "LIVRE", None),
    ("Prazo médio da carteira de crédito com recursos direcionados", "PRAZO_MEDIO_CARTEIRA", None, "DIRECIONADO", None),
    ("Prazo médio das concessões de crédito com recursos livres", "PRAZO_MEDIO_CONCESSAO", None, "LIVRE", None),
    ("Prazo médio das concessões de crédito com recursos direcionados", "PRAZO_MEDIO_CONCESSAO", None, "DIRECIONADO", None),
    ("Saldo de crédito por região - MEI", "SALDO", "MEI", None, None),
    ("Saldo de crédito pessoa jurídica por região", "SALDO", "PJ", None, None),
    ("Saldo da carteira de crédito com recursos livres rotativo -", "SALDO", None, "LIVRE", "Rotativo"),
    ("Saldo da carteira de crédito com recursos livres não rotativo -", "SALDO", None, "LIVRE", "Não rotativo"),
    ("Saldo da carteira de crédito com recursos livres - Pessoas jurídicas -", "SALDO", "PJ", "LIVRE", None),
    ("Saldo da carteira de crédito com recursos livres - Pessoas físicas -", "SALDO", "PF", "LIVRE", None),
    ("Saldo da carteira de crédito com recursos direcionados - Pessoas jurídicas -", "SALDO", "PJ", "DIRECIONADO", None),
    ("Saldo da carteira de crédito com recursos direcionados - Pessoas físicas -", "SALDO", "PF", "DIRECIONADO", None),
    ("Saldo da carteira de crédito com recursos livres -", "SALDO", None, "LIVRE", None),
    ("Saldo da carteira de crédito com recursos direcionados -", "SALDO", None, "DIRECIONADO", None),
    ("Saldo da carteira de crédito -", "SALDO", None, None, None),
    ("Concessões de crédito com recursos livres rotativo -", "CONCESSAO", None, "LIVRE", "Rotativo"),
    ("Concessões de crédito com recursos livres não rotativo -", "CONCESSAO", None, "LIVRE", "Não rotativo"),
    ("Concessões de crédito com recursos livres - Pessoas jurídicas -", "CONCESSAO", "PJ", "LIVRE", None),
    ("Concessões de crédito com recursos livres - Pessoas físicas -", "CONCESSAO", "PF", "LIVRE", None),
    ("Concessões de crédito com recursos direcionados - Pessoas jurídicas -", "CONCESSAO", "PJ", "DIRECIONADO", None),
    ("Concessões de crédito com recursos direcionados - Pessoas físicas -", "CONCESSAO", "PF", "DIRECIONADO", None),
    ("Concessões de crédito com recursos livres -", "CONCESSAO", None, "LIVRE", None),
    ("Concessões de crédito com recursos direcionados -", "CONCESSAO", None, "DIRECIONADO", None),
    ("Concessões de crédito -", "CONCESSAO", None, None, None),
    ("Prazo médio das concessões de crédito -", "PRAZO_MEDIO_CONCESSAO", None, None, None),
]

# Title segments and what they stand for.
SIZE_TOKENS = {"microempresa": "MICRO", "pequeno porte": "PEQUENO"}
CLIENT_TOKENS = {"pessoas jurídicas": "PJ", "pessoas físicas": "PF"}
ORIGIN_TOKENS = {
    "recursos livres": "LIVRE",
    "recursos direcionados": "DIRECIONADO",
    "crédito livre": "LIVRE",
    "crédito direcionado": "DIRECIONADO",
}
REGION_TOKENS = {
    "norte": "NORTE",
    "nordeste": "NORDESTE",
    "centro-oeste": "CENTRO_OESTE",
    "sudeste": "SUDESTE",
    "sul": "SUL",
}

# Series published per company size without a title of that grammar.
SIZE_SERIES = [
    (27701, "SALDO", "PJ", "MPME", "R$ milhões"),
    (27702, "SALDO", "PJ", "GRANDE", "R$ milhões"),
    (27703, "TAXA_INADIMPLENCIA", "PJ", "MPME", "%"),
    (27704, "TAXA_INADIMPLENCIA", "PJ", "GRANDE", "%"),
]
SIZE_SERIES_SEARCH = "por porte da empresa (agregado)"

_PATTERN_TYPE = "array<struct<prefix:string,metric:string,client:string,origin:string,modality:string>>"


def match_prefix(df: DataFrame, title: str = "title") -> DataFrame:
    """Add ``metric, client, origin, modality`` of the longest matching prefix and the ``rest``.

    The 35 patterns are one literal array, longest first; the first hit is taken in place, so
    there is no join and no row multiplication.
    """
    ordered = sorted(TITLE_PATTERNS, key=lambda p: -len(p[0]))
    names = ("prefix", "metric", "client", "origin", "modality")
    patterns = F.array(
        *[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, p)]) for p in ordered]
    ).cast(_PATTERN_TYPE)
    text = F.col(title)
    hit = F.get(F.filter(patterns, lambda p: F.startswith(text, p["prefix"])), F.lit(0))
    after = F.substr(text, F.length(F.col("_hit.prefix")) + 1)
    fixed = [F.col(f"_hit.{n}").alias(n) for n in names[1:]]
    return (
        df.withColumn("_hit", hit)
        .select(*df.columns, *fixed, F.ltrim(after, F.lit(" -")).alias("rest"))
    )


def _leading_segment(tokens: Mapping[str, str]) -> str:
    return "(?iu)^(" + "|".join(re.escape(t) for t in tokens) + ")(?: - |$)"


def token_value(rest: Column, tokens: Mapping[str, str]) -> Column:
    """Value of the token that is the whole first segment of ``rest``, else NULL."""
    return label_of(F.lower(F.regexp_extract(rest, _leading_segment(tokens), 1)), tokens)


def after_token(rest: Column, tokens: Mapping[str, str]) -> Column:
    """``rest`` without its leading token."""
    return F.regexp_replace(rest, _leading_segment(tokens), "")


def parse_titles(df: DataFrame, title: str = "title") -> DataFrame:
    """Split titles into metric, client, size, origin, region and modality.

    Segments are consumed in a fixed order (size, client, origin, client again, region); client
    and origin only where the prefix did not fix them. What remains is the modality, embedded
    dashes included. A title without a known prefix is kept and marked.
    """
    rows = match_prefix(df, title).withColumn("size", F.lit(None).cast("string")).withColumn(
        "region", F.lit(None).cast("string")
    ).withColumn("fixed_modality", F.col("modality"))
    order = [
        ("size", SIZE_TOKENS), ("client", CLIENT_TOKENS), ("origin", ORIGIN_TOKENS),
        ("client", CLIENT_TOKENS), ("region", REGION_TOKENS),
    ]
    for column, tokens in order:
        open_ = F.col(column).isNull()
        rows = rows.withColumns(
            {
                column: F.coalesce(F.col(column), token_value(F.col("rest"), tokens)),
                "rest": F.when(open_, after_token(F.col("rest"), tokens)).otherwise(F.col("rest")),
            }
        )
    remainder = F.nullif(F.trim(F.col("rest"), F.lit(" -")), F.lit(""))
    modality = F.when(F.lower(remainder) != "total", remainder)
    known = F.col("metric").isNotNull()
    return rows.select(
        *df.columns, "metric", "client", "size", "origin", "region",
        F.when(known, F.coalesce("fixed_modality", modality)).alias("modality"),
        F.when(known, C.PARSED).otherwise(C.UNPARSED).alias("parse_status"),
    )


def build_catalogue(hits: DataFrame, static_rows: DataFrame) -> DataFrame:
    """Catalogue of series: the first search that finds a code wins, static rows override.

    ``hits`` is (code, title, frequency, unit, search, search_order).
    """
    first = hits.groupBy("code").agg(
        F.min_by(
            F.struct(F.trim("title").alias("title"), "frequency", "unit", "search"),
            F.struct("search_order", "title"),
        ).alias("r")
    ).select("code", "r.*")
    parsed = parse_titles(first.withColumn("frequency", monthly_quarterly(F.col("frequency"))))
    kept = parsed.join(static_rows.select("code"), "code", "left_anti")
    return kept.unionByName(static_rows)


def size_series(spark) -> DataFrame:
    """The four static rows of the catalogue."""
    rows = [
        (code, f"[agregado por porte] {metric} - {size}", C.MONTHLY, unit, SIZE_SERIES_SEARCH,
         metric, client, size, None, None, None, C.PARSED)
        for code, metric, client, size, unit in SIZE_SERIES
    ]
    return spark.createDataFrame(
        rows,
        "code int, title string, frequency string, unit string, search string, metric string, "
        "client string, size string, origin string, region string, modality string, "
        "parse_status string",
    )
