"""Files read once and whole: heads, damaged archives, counted lines, ledgers, text streams, versions."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F
from support import rows

from regiostat.sources import banks, files, ledger, load, movements, sinks, versions
from regiostat.sources.job import run_load
from regiostat.streaming import incremental as I

HEAD = "competênciamov;região;município;seção;subclasse;saldomovimentação;salário"
BALANCE = "x\nx\n#DATA_BASE;CODMUN_IBGE;CNPJ;AGEN_PROCESSADAS;VERBETE_160_A\n"


def archive(folder, name, lines, head=BALANCE):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.csv", head + "".join(f"{x}\n" for x in lines))
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(buffer.getvalue())
    return folder / name


def move(place, movement, wage="", month="202401"):
    return f"{month};1;{place};A;0111301;{movement};{wage}"


def test_a_header_costs_the_same_in_a_file_of_any_size(spark, put, tmp_path):
    put("m/MOV1.txt", "title\n" + HEAD + "\n" + move("123456", 1) + "\n")
    put("m/MOV2.txt", HEAD + "\n" + (move("123456", 1) + "\n") * 300_000)
    put("m/MOV4.txt", "x\n" * 1000 + HEAD + "\n")
    found = movements.files_of(spark, f"{tmp_path}/m/*.txt")
    heads = {r["file"][-8:]: (r["header"], r["lines"]) for r in movements.first_lines(spark, found).collect()}
    assert heads == {"MOV1.txt": (HEAD, 3), "MOV2.txt": (HEAD, movements.HEAD_LINES), "MOV4.txt": (None, movements.HEAD_LINES)}
    assert movements.read_movements(spark, f"{tmp_path}/m/*.txt").count() == 300_001
    bad = {f[-8:]: (r, n) for f, r, n in rows(movements.movement_rejects(spark, f"{tmp_path}/m/*.txt"))}
    assert set(bad) == {"MOV1.txt", "MOV4.txt"}
    assert bad["MOV1.txt"] == (movements.RAGGED, 1)


def test_every_line_is_a_row_or_a_reject(spark, put, tmp_path):
    lines = [
        move("110001", 1, "1000,50"), move("110001", 1) + ";one more", "202401;1;110001;A",
        '202401;1;"110001;A;0111301;1;1', '202401;1;"110;001";A;0111301;1;"7,5"', ";1;110001;A;0111301;1;1", "  ",
    ]
    put("m/MOV202401.txt", "\n".join([HEAD, *lines]) + "\n")
    path = f"{tmp_path}/m/*.txt"
    good = rows(movements.read_movements(spark, path))
    assert good == [(202401, "110001", "01", 1, 1000.5, "MOV"), (202401, "110;001", "01", 1, 7.5, "MOV")]
    bad = [(r, n) for _, r, n in rows(movements.movement_rejects(spark, path))]
    assert sorted(bad) == [(movements.RAGGED, 3), (movements.INCOMPLETE, 1)]
    cells = movements.movement_cells(spark, movements.files_of(spark, path))["cells"]
    assert cells.agg(F.sum("rows")).first()[0] == 6


def test_a_damaged_archive_gives_a_reject_and_no_row(spark, tmp_path):
    lines = [f"202401;1234567;{k};1;{k}" for k in range(120_000)]
    sound = archive(tmp_path / "z", "sound.zip", lines[:10])
    content = bytearray(archive(tmp_path / "z", "damaged.zip", lines).read_bytes())
    content[len(content) * 9 // 10] ^= 0xFF
    (tmp_path / "z" / "damaged.zip").write_bytes(bytes(content))
    (tmp_path / "z" / "cut.zip").write_bytes(sound.read_bytes()[:-30])
    archive(tmp_path / "z", "other.zip", ["1;2"], head="x\nx\nA;B\n")
    lines_read = banks.read_zipped_lines(spark, f"{tmp_path}/z/*.zip")
    assert banks.balance_cells(lines_read).count() == 10
    bad = [(f.rsplit("/", 1)[1], r, n) for f, r, n in rows(banks.balance_rejects(lines_read))]
    assert sorted(bad) == [
        ("cut.zip", banks.BAD_ARCHIVE, 1), ("damaged.zip", banks.BAD_ARCHIVE, 1), ("other.zip", banks.NO_COLUMN, 1)
    ]


def test_archives_are_unpacked_once_and_add_up_to_the_full_load(spark, tmp_path, monkeypatch):
    folder, state, path = tmp_path / "z", f"{tmp_path}/state", f"{tmp_path}/z/*.zip"
    unpacked = []
    real = banks.balance_parts

    def spy(spark, files, work):
        unpacked.extend(f.rsplit("/", 1)[1] for f in files)
        return real(spark, files, work)

    monkeypatch.setattr(banks, "balance_parts", spy)

    def check():
        state_of = banks.update_balances(spark, path, state, changed=True)
        whole = banks.balance_cells(banks.read_zipped_lines(spark, path))
        assert rows(banks.ledger_amounts(state_of)) == rows(banks.place_amounts(whole))
        assert rows(banks.ledger_presence(state_of)) == rows(banks.place_presence(whole))
        want = rows(banks.balance_rejects(banks.read_zipped_lines(spark, path)))
        assert rows(banks.ledger_rejects(state_of)) == want
        lines = state_of.part("presence").agg(F.sum("rows")).first()[0]
        assert lines == whole.count() + sum(r[2] for r in want)

    archive(folder, "a.zip", ["202401;1;A;1;10", "202401;1;B;;5.25", "202401;2;A;1;x", "202401;1"])
    check()
    archive(folder, "b.zip", ["202401;1;B;2;7", "202402;1;C;1;1", ";1;C;1;1"])
    (folder / "c.zip").write_bytes(b"no archive")
    check()
    assert unpacked == ["a.zip", "b.zip", "c.zip"]
    archive(folder, "c.zip", ["202402;1;C;1;4", "202402;1;D;1;4"])
    monkeypatch.setattr(ledger, "MOST_BATCHES", 2)
    check()
    check()
    assert unpacked == ["a.zip", "b.zip", "c.zip", "c.zip"]
    assert banks.balance_ledger(spark, state).files().select("batch").distinct().count() == 1


def test_text_streams_read_new_files_only_and_by_their_own_header(spark, put, tmp_path, monkeypatch):
    monkeypatch.setattr(I, "MOST_BATCHES", 2)
    folder, path = f"{tmp_path}/m", f"{tmp_path}/m/*.txt"
    other = "salário;novo;competênciamov;município;subclasse;saldomovimentação"
    content = {
        "MOV1.txt": f"{HEAD}\n{move('1', 1, '5,25')}\n{move('1', -1)}\nbad\n",
        "MOV2.txt": f"{other}\n3,5;x;202402;1;0111302;1\n",
        "FOR3.txt": f"{HEAD}\n{move('1', 1, '8')}\n",
        "EXC4.txt": f"{HEAD}\n{move('1', 1, '5,25')}\n",
        "notes.txt": "no microdata\n",
    }
    seen = []

    def reduce(batch):
        seen.append(batch.count())
        return movements.signed_jobs(batch, movements.SUM_KEYS)

    for name, text in content.items():
        put(f"m/{name}", text)
        partial = I.aggregate_new_text(spark, folder, "*.txt", reduce, f"{tmp_path}/out", f"{tmp_path}/c1")
        jobs = I.stream_raw_jobs(spark, folder, "*.txt", f"{tmp_path}/state", f"{tmp_path}/c2")
    assert seen == [2, 1, 1, 1, 0]
    want = rows(movements.signed_jobs(movements.read_movements(spark, path), movements.SUM_KEYS))
    assert rows(jobs) == want == rows(I.add_up(partial, movements.SUM_KEYS).select(jobs.columns))
    bad = movements.ledger_rejects(movements.jobs_ledger(spark, f"{tmp_path}/state"))
    assert rows(bad, "reason", "rows") == [("other number of cells than the header", 1), ("unknown kind of file", 1)]


def test_many_batches_are_put_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(I, "MOST_BATCHES", 4)
    batches = I.Batches(spark, f"{tmp_path}/out")
    for number in range(14):
        batches.write(spark.createDataFrame([("a", number), ("b", 1)], "k string, v long").coalesce(1), number)
    assert rows(I.add_up(batches.read(), ["k"])) == [("a", 91), ("b", 14)]
    assert len(list((tmp_path / "out").rglob("part-*.parquet"))) <= 20
    assert batches.read().select("batch").distinct().count() == 14
    # A batch that is repeated after its rows were put together does not count twice.
    batches.write(spark.createDataFrame([("a", 0), ("b", 1)], "k string, v long"), 0)
    assert rows(I.add_up(batches.read(), ["k"])) == [("a", 91), ("b", 14)]


def test_of_two_writers_one_wins_and_old_versions_go(spark, tmp_path):
    folder = str(tmp_path)
    table = lambda n: spark.range(n).toDF("n")
    sinks.write_version(table(1), folder, "t", ["n"])
    base = versions.latest(spark, f"{folder}/t")[0]
    sinks.write_version(table(2), folder, "t", ["n"], after=base)
    with pytest.raises(versions.VersionConflict):
        sinks.write_version(table(3), folder, "t", ["n"], after=base)
    read = lambda: spark.read.parquet(sinks.current_version(spark, folder, "t")).count()
    assert read() == 2
    # A commit under way is no version yet, and its number is not used again.
    (tmp_path / "t" / "_versions" / "000000000003.json").write_text("")
    assert read() == 2
    for n in range(4, 9):
        before = sinks.current_version(spark, folder, "t")
        sinks.write_version(table(n), folder, "t", ["n"])
        assert spark.read.parquet(before).count() and read() == n
    # The versions kept, and the data of the write that lost.
    assert len(list((tmp_path / "t").glob("v-*"))) == versions.KEPT + 1
    with pytest.raises(FileNotFoundError):
        sinks.current_version(spark, folder, "none")


def test_only_decimal_numbers_count_in_labelled_tables(spark, put):
    header = {"D1C": load.PLACE_LABEL, "D2C": load.YEAR_LABEL, "V": "Valor"}
    values = ["10", "1.5", "10d", "NaN", "Infinity", "1e400", "-", None]
    body = [header, *[{"D1C": str(k), "D2C": "2020", "V": v} for k, v in enumerate(values)]]
    path = put("p/a.json", body)
    got, _ = files.read_header_row_json(spark, path, {"place_id": load.PLACE_LABEL})
    assert rows(got, "place_id", "value") == [("0", 10.0), ("1", 1.5), *[(str(k), None) for k in range(2, 8)]]
    assert rows(load.read_population(spark, path)) == [("0", 2020, 10.0), ("1", 2020, 1.5)]


def test_the_load_job_writes_tables_datasets_and_rejects(spark, put, tmp_path):
    put("raw/places.json", [{"municipio-id": 1234567, "municipio-nome": "A", "UF-id": 35, "UF-sigla": "SP", "regiao-id": 3}])
    put("seeds/coordinates.csv", "codigo_ibge,latitude,longitude,capital\n1234567,-23.5,-46.6,0\n")
    put("seeds/account.csv", "verbete;nome;grupo\n160;C;CREDITO\n")
    put("seeds/division.csv", "divisao;secao;secao_nome;nome\n01;A;Agro;Agricultura\n")
    put("raw/movements/MOV202401.txt", f"{HEAD}\n{move('123456', 1, '9')}\n{move('999999', 1)}\nbad\n")
    archive(tmp_path / "raw" / "balances", "a.zip", ["202401;1234567;1;1;5000", "202401;7;1;1;5", "x"])
    lake = f"{tmp_path}/lake"
    raw, seeds = f"{tmp_path}/raw", f"{tmp_path}/seeds"
    t = run_load(spark, raw, seeds, lake, datasets=["default_ranking"], workbooks=["R7"])
    bad = spark.read.parquet(sinks.current_version(spark, lake, "rejects"))
    assert rows(bad, "source", "reason", "rows") == [
        ("balances", banks.RAGGED, 1), ("balances", "unknown place", 1),
        ("movements", movements.RAGGED, 1), ("movements", "unknown place", 1),
    ]
    assert rows(t["place_jobs"], "place_id", "hires", "mean_wage") == [("1234567", 1, 9.0)]
    assert rows(t["place_balance"], "account", "amount") == [(160, 5.0)]
    assert (tmp_path / "lake/datasets/default_ranking").exists() and len(list((tmp_path / "lake/sheets/R7").iterdir())) == 3
    again = load.raw_tables(spark, raw, seeds, state=f"{lake}/state")
    assert rows(again["place_jobs"]) == rows(t["place_jobs"])
    assert len(list((tmp_path / "lake/state/movements").glob("batch-*"))) == 1
