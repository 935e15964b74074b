"""Spark results equal the SQL results. ``CONTRACT=all`` runs every key, the default one per kind."""

import os

import pytest
from support import SMALL

import __spark_entry__ as entry_module
from contract.compare import connect, difference
from contract.oracle_queries import oracle_sql
from contract.oracle_views import VIEW_NAMES
from contract.queries import spark_queries

QUERIES = spark_queries()
ORACLES = oracle_sql()
CHOSEN = [
    "S15", "C12", "C16", "C17_month", "C19", "C20", "P3", "P8", "P11", "J6", "J10", "A4", "A9", "A13",
    "W5_global", "W5_rank_per", "W7", "W9", "W10", "T3", "T4", "F6", "N5", "N8", "N9", "V1_", "V5_", "V8_",
    "V13", "V19", "V23", "V25", "V26", "V27", "V29", "V30", "V31", "V32", "V34", "V36", "R5_4", "R8_2",
    "R9_3", "R10_1", "R10_5", "D1_credit_h", "D5", "D7_axes", "D8_place_h", "D9_regional", "D14",
    "S1_", "S3_", "S6_", "S7_", "S8_", "S9_", "S10_rej", "S11", "S13", "S14", "S16", "S17", "S18", "D13", "K1_", "K2_", "K5_", "D16_e", "D17_statement_h", "D20_f", "Q3", "Q6", "ST1", "ST2", "ST3_s",
]
KEYS = list(QUERIES) if os.environ.get("CONTRACT") == "all" else [
    k for k in QUERIES if any(k.startswith(c) for c in CHOSEN)
]


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_its_sql_and_every_item_a_query():
    assert set(QUERIES) == set(ORACLES)
    assert {k.split("_")[0] for k in QUERIES} >= {f"V{n}" for n in VIEW_NAMES}
    for letter, n in (("C", 25), ("P", 13), ("J", 14), ("A", 19), ("W", 13), ("T", 8), ("U", 5), ("F", 10), ("N", 11), ("Q", 7), ("S", 18), ("K", 6), ("D", 20), ("ST", 5)):
        assert {k.split("_")[0] for k in QUERIES} >= {f"{letter}{i}" for i in range(1, n + 1)}


def test_entry(spark):
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert entry_module.entry(spark).count() == 25


@pytest.mark.parametrize("key", KEYS)
def test_same_result(spark, con, key):
    assert difference(QUERIES[key](spark, SMALL), con, ORACLES[key]) is None
