"""The raw layouts that the contract writes: files and pieces stay small while the tables grow."""

import datetime
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from contract import round_trips as R
from contract.adapter import DriverTables
from contract.compare import difference
from regiostat.sources import banks, movements


def below(folder):
    """(folders, files) at or below a folder that hold files."""
    found = [(at, names) for at, _, names in os.walk(folder.removeprefix("file:")) if names]
    return [at for at, _ in found], [f"{at}/{n}" for at, names in found for n in names]


def save(spark, folder, **tables):
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return DriverTables(spark, str(folder))


def agrees(key, t):
    con = duckdb.connect()
    for name in os.listdir(t.folder):
        con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{t.folder}/{name}/*.parquet'")
    return difference(R.ROUND_TRIPS[key](t), con, R.SQL[key]) is None


def test_many_texts_need_no_folder_and_no_checksum_file_each(spark, tmp_path):
    rows = spark.range(1000).withColumn("file", F.when(F.col("id") < 990, F.col("id") * R.FILE_ROWS))
    folder = f"{tmp_path}/texts"
    path = R._write_texts(rows, "file", F.col("id"), F.to_json("entries"), folder)
    folders, files = below(folder)
    assert len(folders) == 1 and len(files) == 991
    assert spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "array<int>"))).count() == 1000


def test_one_outline_a_file(spark, tmp_path):
    supplier = spark.range(300).select(F.col("id").alias("s_suppkey"), (F.col("id") % 25).cast("int").alias("s_nationkey"))
    t = save(spark, tmp_path, supplier=supplier)
    assert agrees("S12_first_outlines", t)


def test_blocks_get_more_files_with_more_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "PART_ROWS", 100)
    key = F.col("id")
    orders = spark.range(2000).select(
        key.alias("o_orderkey"), (key % 40 * 4).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        (key / 4).alias("o_totalprice"), F.lit(datetime.date(1995, 2, 3)).alias("o_orderdate"),
    )
    t = save(spark, tmp_path, orders=orders)
    put, seen = R._put_texts, []
    monkeypatch.setattr(R, "_put_texts", lambda named, folder: seen.append(folder) or put(named, folder))
    assert agrees("S18_files_by_state_and_years", t)
    # All customers are divisible by four: one file of all rows before.
    sizes = [os.path.getsize(f) for f in below(seen[0])[1]]
    assert len(sizes) == 20 and max(sizes) < sum(sizes) / 10


def lineitem(spark, n):
    key = F.col("id")
    return spark.range(n).select(
        (key / 4).cast("long").alias("l_orderkey"), (key % 37).alias("l_partkey"), (key % 11).alias("l_suppkey"),
        (key % 7 + 1).cast("int").alias("l_linenumber"), (key % 50).cast("double").alias("l_quantity"),
        (key % 90 + F.lit(0.25)).alias("l_extendedprice"), (key % 9 / 100).alias("l_tax"),
        F.lit(datetime.date(1995, 2, 3)).alias("l_shipdate"),
    )


def test_microdata_come_in_more_pieces_with_more_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "PIECE_LINES", 1000)
    t = save(spark, tmp_path / "tables", lineitem=lineitem(spark, 5000))
    sizes = [os.path.getsize(f) for f in below(R._microdata(t))[1]]
    assert len([s for s in sizes if s > 100]) > 2 * 18 and max(sizes) < sum(sizes) / 18
    assert agrees("S10_rejects", t) and agrees("K5_ledger_of_files", t)


def test_streamed_pieces_of_microdata_add_up(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "PIECE_LINES", 1000)
    t = save(spark, tmp_path, lineitem=lineitem(spark, 3000))
    assert agrees("ST1_text_files", t)


def test_lines_are_split_once(spark, put):
    put("CAGEDMOV.txt", 'competênciamov;município;subclasse;saldomovimentação;salário\n200001;1;0111301;1;"1,5"\n')
    rows = movements.read_movements(spark, os.path.dirname(put("CAGEDFOR.txt", "")))
    assert rows.count() == 1
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(value") == 2  # with and without quotes


def test_archives_are_more_with_more_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "ARCHIVE_LINES", 100)
    t = save(spark, tmp_path, lineitem=lineitem(spark, 5000))
    given, seen = banks.unzipped, []
    monkeypatch.setattr(banks, "unzipped", lambda files: seen.append(files) or given(files))
    assert agrees("S9_zipped_amounts", t) and agrees("S9_rejects", t)
    sizes = [r["n"] for r in seen[0].select(F.length("content").alias("n")).collect()]
    assert len(sizes) == 4 * 16 and max(sizes) < sum(sizes) / 16


def test_presence_of_archives_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "ARCHIVE_LINES", 50)
    assert agrees("S9_zipped_presence", save(spark, tmp_path, lineitem=lineitem(spark, 2000)))


def orders(spark, n):
    key = F.col("id")
    return spark.range(n).select(
        key.alias("o_orderkey"), (key % 40).alias("o_custkey"), (key / 4).alias("o_totalprice"),
        F.lit(datetime.date(1995, 2, 3)).alias("o_orderdate"),
    )


@pytest.mark.parametrize("key", ["S5_names_beside_codes", "S17_corrupt_files"])
def test_files_of_orders_lie_in_one_folder(spark, tmp_path, monkeypatch, key):
    given, seen = R._folder, []
    monkeypatch.setattr(R, "_folder", lambda t, name: seen.append(given(t, name)) or seen[-1])
    assert agrees(key, save(spark, tmp_path, orders=orders(spark, 5000)))
    folders, files = below(seen[0])
    assert len(folders) == 1 and len(files) == 25
