"""Cleaning expressions for raw text columns (all run inside the JVM)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Latin letters with marks and their plain forms, position by position.
ACCENTED = "ÁÀÂÃÄÅáàâãäåÇçÉÈÊËéèêëÍÌÎÏíìîïÑñÓÒÔÕÖóòôõöÚÙÛÜúùûüÝýÿ"
PLAIN = "AAAAAAaaaaaaCcEEEEeeeeIIIIiiiiNnOOOOOoooooUUUUuuuuYyy"

#: Decimal notation; suffixes, names of special values and separators are no numbers.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# Region code -> label and label -> code used by the regional credit series.
REGION_LABELS = {"1": "Norte", "2": "Nordeste", "3": "Sudeste", "4": "Sul", "5": "Centro-Oeste"}
REGION_CODES = {
    "Norte": "NORTE",
    "Nordeste": "NORDESTE",
    "Centro-Oeste": "CENTRO_OESTE",
    "Sudeste": "SUDESTE",
    "Sul": "SUL",
}


def digits_only(c: Column) -> Column:
    return F.coalesce(F.regexp_replace(c, r"\D", ""), F.lit(""))


def fold_accents(c: Column) -> Column:
    """Strip marks, then drop whatever is still outside ASCII."""
    return F.regexp_replace(F.translate(c, ACCENTED, PLAIN), r"[^\x00-\x7F]", "")


def name_key(c: Column) -> Column:
    return F.trim(F.upper(fold_accents(c)))


def lenient_number(c: Column) -> Column:
    """Text to double, NULL where the text is no finite decimal number."""
    text = F.trim(c)
    number = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.when(F.abs(number) < float("inf"), number)


def lenient_int(c: Column) -> Column:
    """Text to int by way of a number, NULL where it does not fit."""
    return lenient_number(c).try_cast("int")


def decimal_comma(c: Column) -> Column:
    return lenient_number(F.replace(c, F.lit(","), F.lit(".")))


def count_or_zero(c: Column) -> Column:
    return F.coalesce(lenient_number(c).try_cast("long"), F.lit(0).cast("long"))


def null_if_blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def section_of_label(c: Column) -> Column:
    """Activity section: the first letter of a label such as ``"A Agriculture"``."""
    return F.substring(F.trim(c), 1, 1)


def prefix(c: Column, length: int) -> Column:
    return F.substring(c, 1, length)


def label_of(c: Column, labels: Mapping[str, str]) -> Column:
    """Label of a code; NULL for a code outside the map."""
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), c)


def region_label(code: Column) -> Column:
    return label_of(code.cast("string"), REGION_LABELS)


def region_code(label: Column) -> Column:
    return label_of(label, REGION_CODES)


def thousands(c: Column, digits: int | None = None) -> Column:
    scaled = c / F.lit(1000.0)
    return scaled if digits is None else F.round(scaled, digits)


def monthly_quarterly(c: Column) -> Column:
    monthly = F.lower(F.trim(c.cast("string"))) == "mensal"
    return F.when(monthly, "MENSAL").otherwise("TRIMESTRAL")
