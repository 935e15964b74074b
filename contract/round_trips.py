"""Driver tables written in the raw layouts and read back by the real readers, and the sinks.

Every query writes a whole driver table below the work folder, as the raw source would deliver it, and
returns what the reader or sink makes of it. Files hold about ``FILE_ROWS`` entries each.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contract.adapter import DriverTables
from regiostat.functions import clean as X
from regiostat.functions import metrics as M
from regiostat.functions import periods as P
from regiostat.plans.datasets import outlines
from regiostat.session import work_folder
from regiostat.sources import banks, files, institutions, load, movements, sinks
from regiostat.sources.versions import names_in, rename
from regiostat.streaming import incremental as I
from regiostat.tables import TableSet

col = F.col
FILE_ROWS = 200
#: A source cuts a table, a month of microdata or an archive into more parts where it has more rows, so that no part
#: grows with the table: rows a part of all blocks, lines a piece of all microdata, lines an archive.
PART_ROWS, PIECE_LINES, ARCHIVE_LINES = 100_000, 6_000_000, 100_000
ROUND_TRIPS = {}


def round_trip(f):
    ROUND_TRIPS[f.__name__] = f
    return f


def _folder(t: DriverTables, name: str) -> str:
    return work_folder(t.spark, name)


def _put_texts(named: DataFrame, folder: str) -> str:
    """One file for each row (name, text), put below the folder by the task that has the row.

    Spark's writer makes a folder, a checksum file and calls of ``chmod`` for every file, which many small
    files do not bear. A file gets its name when it is whole, so a repeated task changes nothing.
    """

    def put(rows):
        system, base = FileSystem.from_uri(folder)
        made = set()
        for row in rows:
            parent, _, name = f"{base}/{row['name']}".rpartition("/")
            if parent not in made:
                system.create_dir(parent)
                made.add(parent)
            part = f"{parent}/.{name}-{uuid.uuid4().hex}"
            with system.open_output_stream(part) as out:
                out.write(f"{row['text']}\n".encode())
            system.move(part, f"{parent}/{name}")

    named.foreachPartition(put)
    return folder


def _write_texts(rows: DataFrame, number: str, entry: Column, text: Column, folder: str) -> str:
    """One text file for each ``FILE_ROWS`` numbers; ``text`` builds it from the array ``entries``."""
    files_ = (
        rows.groupBy(F.floor(col(number) / FILE_ROWS).alias("file"))
        .agg(F.collect_list(entry).alias("entries"))
        .withColumn("text", text)
    )
    name = F.concat(F.coalesce(col("file").cast("string"), F.lit("none")), F.lit(".txt")).alias("name")
    return _put_texts(files_.select(name, "text"), folder)


@round_trip
def S1_seed_reader(t):
    folder = _folder(t, "seed")
    t["part"].select(
        col("p_partkey").cast("string").alias("code"), col("p_name").alias("name"),
        F.concat_ws(";", "p_brand", "p_type").alias("family"),
        F.when(col("p_size") > 25, col("p_size")).cast("string").alias("size"),
    ).write.csv(folder, sep=";", header=True, quoteAll=True)
    return files.read_seed(t.spark, folder, "code string, name string, family string, size string")


@round_trip
def S2_coordinates(t):
    folder = _folder(t, "coordinates")
    key = col("c_custkey")
    flag = F.when(key % 3 == 0, "1.0").when(key % 3 == 1, "true").otherwise("0")
    t["customer"].select(
        F.lpad(key.cast("string"), 7, "0").alias("codigo_ibge"), col("c_acctbal").alias("latitude"),
        (-col("c_acctbal")).alias("longitude"), flag.alias("capital"),
    ).write.csv(folder, header=True)
    return files.read_coordinates(t.spark, folder)


def _header_files(t) -> str:
    """Tables with labels in the first element; every seventh file lacks the year."""
    row = F.struct(
        col("o_custkey").cast("string").alias("D1C"), F.concat(F.lit("Place "), "o_custkey").alias("D1N"),
        F.year("o_orderdate").cast("string").alias("D2C"), col("o_totalprice").cast("string").alias("V"),
    )
    year = F.when(col("file") % 7 == 0, "Outro (Código)").otherwise("ANO (código)")
    header = F.struct(
        F.lit("Município (Código)").alias("D1C"), F.lit("Município").alias("D1N"), year.alias("D2C"),
        F.lit("Valor").alias("V"),
    )
    text = F.to_json(F.concat(F.array(header), col("entries")))
    return _write_texts(t["orders"], "o_orderkey", row, text, _folder(t, "labelled"))


WANTED = {"place_id": load.PLACE_LABEL, "year": load.YEAR_LABEL}


@round_trip
def S3_header_row_tables(t):
    rows, _ = files.read_header_row_json(t.spark, _header_files(t), WANTED)
    return rows.groupBy("place_id", "year").agg(M.exact_sum(col("value")).alias("value"))


@round_trip
def S4_files_without_label(t):
    _, left_out = files.read_header_row_json(t.spark, _header_files(t), WANTED)
    return left_out.groupBy("reason").agg(F.count(F.lit(1)).alias("files"))


@round_trip
def S5_names_beside_codes(t):
    wanted = {"name": load.PLACE_LABEL, "year": load.YEAR_LABEL}
    rows, _ = files.read_header_row_json(t.spark, _header_files(t), wanted, as_label=("name",))
    return rows.groupBy("name").agg(F.count(F.lit(1)).alias("rows"))


@round_trip
def S6_flat_arrays_of_places(t):
    key = col("c_custkey").cast("string")
    place = F.struct(
        F.lpad(key, 7, "0").alias("municipio-id"), col("c_name").alias("municipio-nome"),
        col("c_nationkey").cast("string").alias("UF-id"), F.concat(F.lit("N"), "c_nationkey").alias("UF-sigla"),
        (col("c_custkey") % 6).cast("string").alias("regiao-id"),
    )
    folder = _folder(t, "places")
    path = _write_texts(t["customer"], "c_custkey", place, F.to_json("entries"), folder)
    spots = _folder(t, "coordinates")
    t["customer"].filter("c_custkey % 2 = 0").select(
        F.lpad(key, 7, "0").alias("codigo_ibge"), col("c_acctbal").alias("latitude"),
        col("c_acctbal").alias("longitude"), F.lit("0").alias("capital"),
    ).write.csv(spots, header=True)
    return load.read_places(t.spark, path, spots).select(
        "place_id", "place_id6", "name_key", "state", "region", "lat"
    )


@round_trip
def S7_envelopes(t):
    record = F.struct(col("s_suppkey").alias("Codigo"), col("s_acctbal").cast("string").alias("Saldo"))
    text = F.to_json(F.struct(col("entries").alias("value")))
    path = _write_texts(t["supplier"], "s_suppkey", record, text, _folder(t, "envelopes"))
    rows = files.read_envelope(t.spark, path, {"Codigo": "code", "Saldo": "balance"})
    return rows.select("code", X.lenient_number(col("balance")).alias("balance"))


@round_trip
def S11_nested_buckets(t):
    month = P.month_of(col("o_orderdate")).cast("string")
    # The last code is no known class.
    kind = F.element_at(F.array(*map(F.lit, (128, 129, 108, 999))), (col("o_custkey") % 4 + 1).cast("int"))
    counts = t["orders"].groupBy(month.alias("key"), kind.alias("class")).agg(
        F.count(F.lit(1)).alias("n")
    )
    buckets = counts.groupBy("key").agg(
        F.struct(F.collect_list(F.struct(col("class").alias("key"), col("n").alias("doc_count"))).alias("buckets")).alias("por_classe")
    )
    numbered = buckets.withColumn("file", col("key").cast("int"))
    inner = F.struct(F.struct(col("entries").alias("buckets")).alias("por_mes")).alias("aggregations")
    path = _write_texts(numbered, "file", F.struct("key", "por_classe"), F.to_json(F.struct(inner)), _folder(t, "buckets"))
    return load.read_insolvency(t.spark, path).groupBy("period", "class").agg(F.sum("cases").alias("cases"))


@round_trip
def S12_first_outlines(t):
    geometry = F.struct(F.lit("Point").alias("type"), F.array("s_suppkey", "s_nationkey").alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"))
    none = F.array().cast("array<struct<type:string,geometry:struct<type:string,coordinates:array<bigint>>>>")
    single = t["supplier"].withColumn("file", col("s_suppkey") * FILE_ROWS)
    features = F.when(col("file") % 5 == 0, none).otherwise(col("entries"))
    text = F.to_json(F.struct(features.alias("features")))
    path = _write_texts(single, "file", feature, text, _folder(t, "outlines"))
    return load.read_outlines(t.spark, path).select("geometry")


@round_trip
def S17_corrupt_files(t):
    record = F.struct(col("o_orderkey").alias("data"), col("o_totalprice").cast("string").alias("valor"))
    text = F.when(col("file") % 4 == 0, "<html>error</html>").otherwise(F.to_json("entries"))
    path = _write_texts(t["orders"], "o_orderkey", record, text, _folder(t, "corrupt"))
    bad = files.rejects(t.spark, path).groupBy("reason").agg(F.count(F.lit(1)).alias("files"))
    rows = files.good(files.read_json(t.spark, path, "data string, valor string"))
    return bad.withColumn("rows", rows.agg(F.count("data")).scalar())


def _monthly(t) -> DataFrame:
    return t["orders"].groupBy(P.month_of(col("o_orderdate")).alias("period"), "o_orderstatus").agg(
        M.cents_sum(col("o_totalprice")).alias("cents")
    )


@round_trip
def K1_current_version(t):
    folder = _folder(t, "versions")
    sinks.write_version(_monthly(t).limit(1), folder, "monthly", ["period", "o_orderstatus"], "period")
    sinks.write_version(_monthly(t), folder, "monthly", ["period", "o_orderstatus"], "period")
    return t.spark.read.parquet(sinks.current_version(t.spark, folder, "monthly"))


@round_trip
def K2_written_views(t):
    folder = _folder(t, "views")
    views = TableSet(t.spark, {
        "monthly": lambda _: _monthly(t),
        "yearly": lambda v: v["monthly"].groupBy(F.floor(col("period") / 100).alias("year")).agg(F.sum("cents").alias("cents")),
    })
    for _ in range(2):
        sinks.materialise(views, folder, ["monthly", "yearly"])
    return views["yearly"]


@round_trip
def K3_report_sheets(t):
    folder = _folder(t, "sheets")
    sheets = {"months": _monthly, "parts": lambda v: v["part"].select("p_partkey", "p_name")}
    counts = sinks.write_sheets(t, sheets, folder)
    read = t.spark.read.csv(f"{folder}/parts", header=True)
    return read.select(
        col("p_partkey").cast("long").alias("p_partkey"), "p_name", F.lit(counts["months"]).cast("long").alias("months")
    )


@round_trip
def K4_payload(t):
    folder = _folder(t, "payload")
    nested = _monthly(t).groupBy("o_orderstatus").agg(
        F.sort_array(F.collect_list(F.struct("period", "cents"))).alias("months")
    )
    sinks.write_payload(nested, folder)
    read = t.spark.read.schema(nested.schema).json(folder)
    return read.select("o_orderstatus", F.explode("months").alias("m")).select("o_orderstatus", "m.*")


@round_trip
def K5_new_inputs_only(t):
    """First the old inputs, then only those that no earlier run has: the newest period is replaced."""
    folder = _folder(t, "periods")
    rows = _monthly(t).withColumnRenamed("o_orderstatus", "path")
    old = rows.filter((col("period") < 199801) & (col("path") != "P"))
    sinks.write_table(old.withColumn("cents", F.lit(0).cast("long")), folder, "period")
    done = t.spark.read.parquet(folder).select("path").distinct()
    sinks.write_table(sinks.unprocessed(rows, done), f"{folder}-new", "period")
    sinks.replace_periods(rows.filter(col("period") >= 199601), folder)
    new = t.spark.read.parquet(f"{folder}-new").select("path", "period", "cents")
    whole = t.spark.read.parquet(folder).select("path", "period", "cents")
    return whole.withColumn("new", F.lit(False)).union(new.withColumn("new", F.lit(True)))


@round_trip
def K6_sorted_seed(t):
    folder = _folder(t, "seed")
    sinks.write_seed(t["part"].select(col("p_partkey").alias("code"), col("p_name").alias("name")), folder, "code")
    return files.read_seed(t.spark, folder, "code string, name string")


# --- raw files under their own names -----------------------------------------------------------


def _write_named(lines: DataFrame, folder: str, ending: str) -> str:
    """Files ``<stem>.<ending>`` of rows (stem, place, value), the lines of each in ascending place."""
    ordered = lines.repartition("stem").sortWithinPartitions("stem", "place").select("stem", "value")
    ordered.write.partitionBy("stem").text(f"{folder}/parts")
    spark = lines.sparkSession
    for part in names_in(spark, f"{folder}/parts"):
        if part.startswith("stem="):
            (file,) = [n for n in names_in(spark, f"{folder}/parts/{part}") if n.startswith("part-")]
            rename(spark, f"{folder}/parts/{part}/{file}", f"{folder}/named/{part[5:]}.{ending}")
    return f"{folder}/named"


@round_trip
def S8_series_by_file_name(t):
    """One file a series; every third holds an error body, every fifth an empty list."""
    day = F.date_format("o_orderdate", "dd/MM/yyyy").alias("data")
    value = F.when(col("o_orderkey") % 10 > 0, col("o_totalprice").cast("string")).otherwise("...").alias("valor")
    one = t["orders"].groupBy((col("o_custkey") % 20).alias("stem")).agg(F.collect_list(F.struct(day, value)).alias("entries"))
    text = F.when(col("stem") % 3 == 0, '{"erro":{"detail":"none"}}').when(col("stem") % 5 == 0, "[]")
    named = one.select("stem", F.lit(0).alias("place"), F.coalesce(text, F.to_json("entries")).alias("value"))
    path = _write_named(named, _folder(t, "series"), "json")
    rows = load.read_series_values(t.spark, f"{path}/*.json")
    return rows.groupBy("code", "period").agg(M.exact_sum(col("value")).alias("value"), F.count(F.lit(1)).alias("rows"))


BALANCE_HEADER = "#DATA_BASE;CODMUN_IBGE;CNPJ;AGEN_PROCESSADAS;VERBETE_160_A;VERBETE_399_B"


def _zipper():
    """Step that makes an archive of the lines of one group; those to be damaged have a changed byte."""

    def zipped(key, rows):
        path, damaged = key
        text = "\n".join([f"x\nx\n{BALANCE_HEADER}", *rows["line"].dropna()])
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("a.csv", text.encode("latin-1"))
        content = bytearray(buffer.getvalue())
        if damaged:
            content[len(content) // 2] ^= 0xFF
        return pd.DataFrame({"path": [path], "content": [bytes(content)]})

    return zipped


def _archive_lines(t) -> DataFrame:
    """Archives of sixteen numbers, one number damaged; every thirteenth line lacks its last cell."""
    number = (col("l_orderkey") % 16).cast("string")
    pieces = t["lineitem"].count() // (16 * ARCHIVE_LINES) + 1
    path = F.concat(F.coalesce(number, F.lit("")), _piece(t, pieces)) if pieces > 1 else number
    cells = F.concat_ws(
        ";", P.month_of(col("l_shipdate")).cast("string"), F.lpad(col("l_suppkey").cast("string"), 7, "0"),
        (col("l_partkey") % 50).cast("string"), F.when(col("l_linenumber") > 1, col("l_linenumber").cast("string")).otherwise(""),
        col("l_quantity").cast("string"),
    )
    line = F.when(col("l_orderkey") % 13 > 0, F.concat(cells, F.lit(";"), col("l_tax").cast("string"))).otherwise(cells)
    damaged = F.coalesce(number == "5", F.lit(False)).alias("damaged")
    lines = t["lineitem"].select(path.alias("path"), damaged, line.alias("line"))
    zips = _folder(t, "zips")
    lines.groupBy("path", "damaged").applyInPandas(_zipper(), "path string, content binary").write.parquet(zips)
    return banks.unzipped(t.spark.read.parquet(zips))


@round_trip
def S9_zipped_amounts(t):
    return banks.place_amounts(banks.balance_cells(_archive_lines(t)))


@round_trip
def S9_zipped_presence(t):
    return banks.place_presence(banks.balance_cells(_archive_lines(t)))


@round_trip
def S9_rejects(t):
    """A number that cannot be read counts once, whatever its pieces."""
    bad = banks.balance_rejects(_archive_lines(t))
    rows = F.when(col("reason") == banks.BAD_ARCHIVE, F.lit(1).cast("long")).otherwise(F.sum("rows"))
    return bad.groupBy(F.nullif(_whole(col("file")), F.lit("")).alias("file"), "reason").agg(rows.alias("rows"))


def _piece(t, pieces: int) -> Column:
    """Ending of the piece that a line falls into, empty where there is one piece only."""
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return F.concat(F.lit("p"), F.pmod(F.xxhash64(*keys), F.lit(pieces))) if pieces > 1 else F.lit("")


def _whole(name: Column) -> Column:
    """Name without the piece."""
    return F.regexp_replace(name, r"p\d+(\.txt)?$|\.txt$", "")


def _microdata(t) -> str:
    """Text files by kind, number and piece, with two layouts; some lines have a cell too many or no month."""
    number, part = col("l_linenumber"), col("l_partkey")
    kind = F.when(number <= 4, "MOV").when(number <= 6, "FOR").otherwise("EXC")
    stem = F.concat_ws("_", kind, (col("l_orderkey") % 6).cast("string"))
    piece = _piece(t, t["lineitem"].count() // PIECE_LINES + 1)
    month = F.when(col("l_orderkey") % 17 > 0, P.month_of(col("l_shipdate")).cast("string")).otherwise("")
    activity = F.concat(F.lpad((part % 99 + 1).cast("string"), 2, "0"), F.lit("11301"))
    wage = F.when(part % 11 != 0, F.replace(col("l_extendedprice").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(",")))
    cells = [month, F.lit("1"), F.lpad(col("l_suppkey").cast("string"), 6, "0"), activity, F.when(part % 2 == 0, "1").otherwise("-1"),
             F.concat(F.lit('"'), F.coalesce(wage, F.lit("")), F.lit('"'))]
    first = ["competênciamov", "região", "município", "subclasse", "saldomovimentação", "salário"]
    second = [4, 0, 5, 2, 3]
    extra = F.when(col("l_orderkey") % 13 == 0, ";x").otherwise("")
    odd = col("l_orderkey") % 2 == 1
    line = F.when(odd, F.concat_ws(";", *cells)).otherwise(F.concat_ws(";", *[cells[k] for k in second]))
    rows = t["lineitem"].select(F.concat(stem, piece).alias("stem"), F.lit(1).alias("place"), F.concat(line, extra).alias("value"), odd.alias("odd"))
    header = F.when(col("odd"), ";".join(first)).otherwise(";".join(first[k] for k in second))
    heads = rows.select("stem", "odd").distinct().select("stem", F.lit(0).alias("place"), header.alias("value"))
    return _write_named(heads.union(rows.drop("odd")), _folder(t, "microdata"), "txt")


@round_trip
def S10_microdata_lines(t):
    rows = movements.read_movements(t.spark, f"{_microdata(t)}/*.txt")
    return rows.groupBy("period", "division", "kind").agg(
        F.sum("movement").alias("movement"), M.cents_sum(col("wage")).alias("cents"),
        F.count(F.lit(1)).alias("rows"), F.count_distinct("place_id6").alias("places"),
    )


@round_trip
def S10_rejects(t):
    bad = movements.movement_rejects(t.spark, f"{_microdata(t)}/*.txt")
    whole = bad.groupBy(_whole(col("file")).alias("file"), "reason").agg(F.sum("rows").alias("rows"))
    return whole.select(F.regexp_extract("file", r"([A-Z]+_\d)$", 1).alias("file"), "reason", "rows")


@round_trip
def S13_sharded_values(t):
    cell = F.struct((col("o_orderkey") % 7).cast("string").alias("i"), col("o_totalprice").cast("double").alias("v"))
    shard = t["orders"].groupBy("o_custkey").agg(F.collect_list(cell).alias("v"))
    text = F.to_json(F.struct(col("entries").alias("values")))
    path = _write_texts(shard, "o_custkey", F.struct(col("o_custkey").alias("e"), "v"), text, _folder(t, "shards"))
    customers = t["customer"].filter("c_nationkey < 12").select(col("c_custkey").cast("string").alias("inst_id"))
    accounts = t.spark.createDataFrame([("1",), ("4",), ("9",)], "account string")
    cells = institutions.read_shards(t.spark, path, customers, accounts)
    return cells.groupBy("inst_id", "account").agg(M.exact_sum(col("value")).alias("value"))


@round_trip
def S14_column_dictionary(t):
    """Brands are columns with the parts as sub-columns; brands without large parts are flat."""
    part, top = col("p_partkey") + 1000, F.dense_rank().over(Window.orderBy("p_brand"))
    numbered = t["part"].join(t["part"].select("p_brand").distinct().withColumn("top", top), "p_brand")
    large = F.collect_list(F.when(col("p_size") > 25, F.struct(part.cast("int").alias("ifd"))))
    columns = numbered.groupBy("top").agg(large.alias("sc")).select(col("top").cast("int").alias("ifd"), "sc")
    report, names = _folder(t, "report"), _folder(t, "names")
    columns.agg(F.collect_list(F.struct("ifd", "sc")).alias("c")).write.json(report)
    entry = numbered.select(
        part.alias("id"), col("p_name").alias("n"), F.when(col("p_partkey") % 3 > 0, col("p_partkey")).otherwise(-1).alias("lid")
    ).union(numbered.select("top", "p_brand", F.lit(-1)).distinct())
    entry.agg(F.to_json(F.collect_list(F.struct("id", "n", "lid"))).alias("value")).write.text(names)
    return institutions.column_dictionary(institutions.read_report(t.spark, report), institutions.read_names(t.spark, names))


@round_trip
def S16_absent_sources(t):
    """An absent source is an empty table of its type and the others go on."""
    named = t["nation"].select(
        F.concat(F.lit("s"), "n_nationkey").alias("stem"), F.lit(0).alias("place"),
        F.concat(F.lit('{"features":[{"geometry":{"type":"'), "n_name", F.lit('"}}]}')).alias("value"),
    )
    folder = _folder(t, "raw")
    raw = _write_named(named, folder, "json")
    tables = load.raw_tables(t.spark, folder, f"{folder}/seeds", layout={"outlines": "named/*.json"}, state=f"{folder}/state")
    absent = ["place_jobs", "place_balance", "place_presence", "series_value", "institution", "place_gdp"]
    none = reduce(DataFrame.union, [tables[n].select(F.lit(n).alias("name")) for n in absent])
    found = tables["state_outline"].select(F.lit("state_outline").alias("name"))
    assert raw.endswith("named")
    return none.union(found).groupBy("name").agg(F.count(F.lit(1)).alias("rows"))


@round_trip
def S18_files_by_state_and_years(t):
    """Labelled tables in nested folders, read by one pattern."""
    row = F.struct(col("o_custkey").cast("string").alias("D1C"), F.year("o_orderdate").cast("string").alias("D2C"), col("o_totalprice").cast("string").alias("V"))
    header = F.struct(F.lit(load.PLACE_LABEL).alias("D1C"), F.lit(load.YEAR_LABEL).alias("D2C"), F.lit("Valor").alias("V"))
    block = F.floor(F.year("o_orderdate") / 7).alias("years")
    parts = max(4, t["orders"].count() // PART_ROWS)
    part = F.pmod(F.xxhash64("o_orderkey", "o_custkey", "o_totalprice"), F.lit(parts)).alias("part")
    one = t["orders"].groupBy(col("o_orderstatus").alias("state"), block, part).agg(F.collect_list(row).alias("entries"))
    text = F.to_json(F.concat(F.array(header), "entries")).alias("text")
    levels = [F.concat(F.lit(f"{c}="), F.coalesce(col(c).cast("string"), F.lit("none"))) for c in ("state", "years", "part")]
    folder = _put_texts(one.select(F.concat_ws("/", *levels, F.lit("values.json")).alias("name"), text), _folder(t, "blocks"))
    return load.read_population(t.spark, f"{folder}/*/*/*/*").groupBy("place_id", "year").agg(
        M.exact_sum(col("population")).alias("population")
    )


@round_trip
def D13_outlines_by_state(t):
    geometry = F.struct(F.lit("Point").alias("type"), F.array("n_nationkey", "n_regionkey").alias("coordinates"))
    none = F.lit('{"features":[]}')
    text = F.to_json(F.struct(F.array(F.struct(geometry.alias("geometry"))).alias("features")))
    named = t["nation"].select(
        F.concat(F.lit("N"), "n_nationkey").alias("stem"), F.lit(0).alias("place"),
        F.when(col("n_nationkey") % 6 == 5, none).otherwise(text).alias("value"),
    )
    folder = _folder(t, "outlines")
    _write_named(named, folder, "json")
    return outlines(load.raw_tables(t.spark, folder, f"{folder}/seeds", layout={"outlines": "named/*.json"}))


def _arrivals(t) -> tuple[str, str, str]:
    """(folder that files come to, folder with all of them, work folder)."""
    work = _folder(t, "arrivals")
    return f"{work}/landing", _microdata(t), work


def _arrive(t, source: str, landing: str, wanted: Callable[[str], bool]) -> None:
    for name in names_in(t.spark, source):
        if name.endswith(".txt") and wanted(name):
            rename(t.spark, f"{source}/{name}", f"{landing}/{name}")


@round_trip
def ST1_text_files(t):
    """Text files that come in two lots; the second run reads the second lot only."""
    landing, source, work = _arrivals(t)
    keys = ["period", "division"]

    def reduce_(batch: DataFrame) -> DataFrame:
        return batch.groupBy(*keys).agg(F.sum("movement").alias("movement"), F.count(F.lit(1)).alias("rows"))

    for wanted in (lambda n: "_1" in n or "_2" in n, lambda n: True):
        _arrive(t, source, landing, wanted)
        parts = I.aggregate_new_text(t.spark, landing, "*.txt", reduce_, f"{work}/out", f"{work}/checkpoint")
    return I.add_up(parts, keys)


@round_trip
def ST2_text_files(t):
    """Late and retracted text files come first; the ledger has the sums of the whole at the end."""
    landing, source, work = _arrivals(t)
    for wanted in (lambda n: not n.startswith("MOV"), lambda n: True):
        _arrive(t, source, landing, wanted)
        jobs = I.stream_raw_jobs(t.spark, landing, "*.txt", f"{work}/state", f"{work}/checkpoint")
    return jobs


@round_trip
def K5_ledger_of_files(t):
    """Two calls, the second with more files; a third finds none and nothing is read again."""
    landing, source, work = _arrivals(t)
    for wanted in (lambda n: "_3" in n, lambda n: True, lambda n: True):
        _arrive(t, source, landing, wanted)
        movements.update_jobs(t.spark, f"{landing}/*.txt", f"{work}/state")
    ledger = movements.jobs_ledger(t.spark, f"{work}/state")
    return ledger.part("cells").groupBy("problem").agg(
        F.sum("rows").alias("rows"), F.count_distinct(_whole(col("file"))).alias("files"),
        ledger.files().agg(F.count_distinct("batch")).scalar().alias("loads"),
    )


# --- the same results in DuckDB SQL ----------------------------------------------------------

_MONTHLY = """
SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period, o_orderstatus,
       CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
FROM orders GROUP BY 1, 2"""
_LABELLED = f"SELECT * FROM orders WHERE (o_orderkey // {FILE_ROWS}) % 7 <> 0"
_ZIPPED = """
SELECT *, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS period,
       lpad(CAST(l_suppkey AS VARCHAR), 7, '0') AS place_id
FROM lineitem WHERE l_orderkey % 16 <> 5 AND l_orderkey % 13 > 0"""
_MOVED = """
SELECT l_orderkey, l_suppkey, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS period,
       lpad(CAST(l_partkey % 99 + 1 AS VARCHAR), 2, '0') AS division,
       CASE WHEN l_linenumber <= 4 THEN 'MOV' WHEN l_linenumber <= 6 THEN 'FOR' ELSE 'EXC' END AS kind,
       CASE WHEN l_linenumber > 6 THEN -1 ELSE 1 END AS sign, CASE WHEN l_partkey % 2 = 0 THEN 1 ELSE -1 END AS movement,
       CASE WHEN l_partkey % 11 <> 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) END AS cents,
       l_orderkey % 13 > 0 AND l_orderkey % 17 > 0 AS good FROM lineitem"""

SQL = {
    "S1_seed_reader": """
SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS name, p_brand || ';' || p_type AS family,
       CASE WHEN p_size > 25 THEN CAST(p_size AS VARCHAR) END AS size FROM part""",
    "S2_coordinates": """
SELECT lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS place_id, CAST(c_acctbal AS DOUBLE) AS lat,
       -CAST(c_acctbal AS DOUBLE) AS lng, c_custkey % 3 <> 2 AS is_capital FROM customer""",
    "S3_header_row_tables": f"""
SELECT CAST(o_custkey AS VARCHAR) AS place_id, CAST(year(o_orderdate) AS VARCHAR) AS year,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(28,6))) AS DOUBLE) AS value
FROM ({_LABELLED}) GROUP BY 1, 2""",
    "S4_files_without_label": f"""
SELECT 'label missing' AS reason, count(DISTINCT o_orderkey // {FILE_ROWS}) AS files
FROM orders WHERE (o_orderkey // {FILE_ROWS}) % 7 = 0""",
    "S5_names_beside_codes": f"""
SELECT 'Place ' || o_custkey AS name, count(*) AS rows FROM ({_LABELLED}) GROUP BY 1""",
    "S6_flat_arrays_of_places": """
SELECT lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS place_id,
       substr(lpad(CAST(c_custkey AS VARCHAR), 7, '0'), 1, 6) AS place_id6, upper(trim(c_name)) AS name_key,
       'N' || c_nationkey AS state,
       CASE c_custkey % 6 WHEN 1 THEN 'Norte' WHEN 2 THEN 'Nordeste' WHEN 3 THEN 'Sudeste' WHEN 4 THEN 'Sul'
            WHEN 5 THEN 'Centro-Oeste' END AS region,
       CASE WHEN c_custkey % 2 = 0 THEN CAST(c_acctbal AS DOUBLE) END AS lat FROM customer""",
    "S7_envelopes": """
SELECT CAST(s_suppkey AS VARCHAR) AS code, CAST(s_acctbal AS DOUBLE) AS balance FROM supplier""",
    "S11_nested_buckets": """
SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period, k.label AS class,
       CAST(count(*) AS BIGINT) AS cases
FROM orders JOIN (VALUES (0, 'RECUPERACAO_EXTRAJUDICIAL'), (1, 'RECUPERACAO_JUDICIAL'), (2, 'FALENCIA'))
  k(code, label) ON k.code = o_custkey % 4 GROUP BY 1, 2""",
    "S12_first_outlines": """
SELECT '{"type":"Point","coordinates":[' || s_suppkey || ',' || s_nationkey || ']}' AS geometry
FROM supplier WHERE s_suppkey % 5 <> 0""",
    "S17_corrupt_files": f"""
SELECT 'corrupt' AS reason, count(DISTINCT CASE WHEN (o_orderkey // {FILE_ROWS}) % 4 = 0
       THEN o_orderkey // {FILE_ROWS} END) AS files,
       count(CASE WHEN (o_orderkey // {FILE_ROWS}) % 4 <> 0 THEN 1 END) AS rows FROM orders""",
    "K1_current_version": _MONTHLY,
    "K2_written_views": f"""
SELECT CAST(period // 100 AS BIGINT) AS year, CAST(SUM(cents) AS BIGINT) AS cents FROM ({_MONTHLY}) GROUP BY 1""",
    "K3_report_sheets": f"""
SELECT p_partkey, p_name, (SELECT count(*) FROM ({_MONTHLY})) AS months FROM part""",
    "K4_payload": _MONTHLY,
    "K5_new_inputs_only": f"""
WITH m AS ({_MONTHLY})
SELECT o_orderstatus AS path, period, CASE WHEN period >= 199601 THEN cents ELSE 0 END AS cents, false AS new
FROM m WHERE period >= 199601 OR (period < 199801 AND o_orderstatus <> 'P')
UNION ALL SELECT o_orderstatus, period, cents, true FROM m
WHERE o_orderstatus NOT IN (SELECT o_orderstatus FROM m WHERE period < 199801 AND o_orderstatus <> 'P')""",
    "K6_sorted_seed": "SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS name FROM part",
    "S8_series_by_file_name": """
SELECT CAST(o_custkey % 20 AS INTEGER) AS code, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(28,6))) AS DOUBLE) AS value, count(*) AS rows
FROM orders WHERE (o_custkey % 20) % 3 <> 0 AND (o_custkey % 20) % 5 <> 0 AND o_orderkey % 10 > 0 GROUP BY 1, 2""",
    "S9_zipped_amounts": f"""
SELECT period, place_id, account, round(CAST(SUM(CAST(x AS DECIMAL(28,6))) AS DOUBLE) / 1000, 1) AS amount FROM (
  SELECT period, place_id, 160 AS account, l_quantity AS x FROM ({_ZIPPED})
  UNION ALL SELECT period, place_id, 399, l_tax FROM ({_ZIPPED})) GROUP BY 1, 2, 3""",
    "S9_zipped_presence": f"""
SELECT period, place_id, count(DISTINCT l_partkey % 50) AS institutions,
       CAST(SUM(CASE WHEN l_linenumber > 1 THEN l_linenumber ELSE 0 END) AS DOUBLE) AS branches
FROM ({_ZIPPED}) GROUP BY 1, 2""",
    "S9_rejects": """
SELECT CAST(l_orderkey % 16 AS VARCHAR) AS file, 'other number of cells than the header' AS reason, count(*) AS rows
FROM lineitem WHERE l_orderkey % 16 <> 5 AND l_orderkey % 13 = 0 GROUP BY 1
UNION ALL SELECT '5', 'bad archive', 1 FROM (SELECT 1 FROM lineitem WHERE l_orderkey % 16 = 5 LIMIT 1)""",
    "S10_microdata_lines": f"""
SELECT period, division, kind, CAST(SUM(movement) AS BIGINT) AS movement, CAST(SUM(cents) AS BIGINT) AS cents,
       count(*) AS rows, count(DISTINCT l_suppkey) AS places FROM ({_MOVED}) WHERE good GROUP BY 1, 2, 3""",
    "S10_rejects": f"""
SELECT kind || '_' || l_orderkey % 6 AS file, CASE WHEN l_orderkey % 13 = 0 THEN 'other number of cells than the header'
       ELSE 'period, place or activity missing' END AS reason, count(*) AS rows
FROM ({_MOVED}) WHERE NOT good GROUP BY 1, 2""",
    "S13_sharded_values": """
SELECT CAST(o_custkey AS VARCHAR) AS inst_id, CAST(o_orderkey % 7 AS VARCHAR) AS account,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(28,6))) AS DOUBLE) AS value
FROM orders JOIN customer ON c_custkey = o_custkey
WHERE c_nationkey < 12 AND o_orderkey % 7 IN (1, 4) GROUP BY 1, 2""",
    "S14_column_dictionary": """
WITH tops AS (SELECT p_brand, count(*) FILTER (p_size > 25) AS large FROM part GROUP BY 1)
SELECT CAST(p_partkey AS VARCHAR) AS account, p_brand AS "group", p_name AS column_name
FROM part JOIN tops USING (p_brand) WHERE large > 0 AND p_size > 25 AND p_partkey % 3 > 0""",
    "S16_absent_sources": "SELECT 'state_outline' AS name, count(*) AS rows FROM nation",
    "S18_files_by_state_and_years": """
SELECT CAST(o_custkey AS VARCHAR) AS place_id, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(28,6))) AS DOUBLE) AS population FROM orders GROUP BY 1, 2""",
    "D13_outlines_by_state": """
SELECT 'N' || n_nationkey AS state, '{"type":"Point","coordinates":[' || n_nationkey || ',' || n_regionkey || ']}' AS geometry
FROM nation WHERE n_nationkey % 6 <> 5""",
    "ST1_text_files": f"""
SELECT period, division, CAST(SUM(movement) AS BIGINT) AS movement, count(*) AS rows
FROM ({_MOVED}) WHERE good GROUP BY 1, 2""",
    "ST2_text_files": f"""
SELECT period, lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS place_id6, division,
       CAST(SUM(CASE WHEN movement > 0 THEN sign ELSE 0 END) AS BIGINT) AS hires,
       CAST(SUM(CASE WHEN movement < 0 THEN sign ELSE 0 END) AS BIGINT) AS leavers,
       CAST(SUM(sign * movement) AS BIGINT) AS net,
       CAST(COALESCE(SUM(CASE WHEN movement > 0 THEN sign * cents END), 0) AS DOUBLE) / 100 AS wage_sum,
       CAST(SUM(CASE WHEN movement > 0 AND cents IS NOT NULL THEN sign ELSE 0 END) AS BIGINT) AS wage_count
FROM ({_MOVED}) WHERE good GROUP BY 1, 2, 3""",
    "K5_ledger_of_files": f"""
SELECT CASE WHEN good THEN NULL WHEN l_orderkey % 13 = 0 THEN 'other number of cells than the header'
       ELSE 'period, place or activity missing' END AS problem, count(*) AS rows,
       count(DISTINCT kind || l_orderkey % 6) AS files, 2::BIGINT AS loads FROM ({_MOVED}) GROUP BY 1""",
}
