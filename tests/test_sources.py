import io
import zipfile

import pytest
from support import rows
from pyspark.sql import functions as F

from regiostat.sources import banks, files, institutions, load, movements, rates

SEED = """# a comment before the header
# another one
sector;series_sector;sections;value_added_sector
INDUSTRIA;INDÚSTRIA;"B,C,D";INDUSTRIA
ADM;;"O,P";
"""


def test_seed_with_comments_quotes_and_empty_cells(spark, put):
    path = put("sector_map.csv", SEED)
    df = files.read_seed(spark, path, load.SEED_SCHEMAS["sector_map"])
    assert rows(df) == [("ADM", None, "O,P", None), ("INDUSTRIA", "INDÚSTRIA", "B,C,D", "INDUSTRIA")]
    codes = files.read_seed(spark, put("d.csv", "division;section;section_name;name\n01;A;x;y\n"), load.SEED_SCHEMAS["division"])
    assert codes.first()["division"] == "01"


def test_header_row_json(spark, put, tmp_path):
    header = {"D1C": "Município (Código)", "D1N": "Município", "D2C": "Ano (Código)", "V": "Valor"}

    def row(place, year, value):
        return {"D1C": place, "D1N": "n", "D2C": year, "V": value}

    put("pop/pop_1.json", [header, row("1100015", "2020", "10"), row("1100023", "2020", "...")])
    put("pop/pop_2.json", [header, row("1100015", "2021", "11"), row("1100031", "2021", "-")])
    put("pop/pop_3.json", [{"X": "renamed"}, {"X": "1"}])
    put("pop/pop_4.json", "<html>busy</html>")
    put("pop/pop_5.json", [header])
    wanted = {"place_id": "MUNICÍPIO (código)", "year": load.YEAR_LABEL}
    good, bad = files.read_header_row_json(spark, f"{tmp_path}/pop/*.json", wanted)
    assert good.count() == 4
    assert rows(bad) == [("pop_3", "label missing"), ("pop_4", "corrupt")]
    assert rows(load.read_population(spark, f"{tmp_path}/pop/*.json")) == [("1100015", 2020, 10.0), ("1100015", 2021, 11.0)]


def test_header_row_json_to_wide_table(spark, put, tmp_path):
    header = {
        "A": "Município (Código)", "B": "Variável (Código)", "C": "Ano (Código)",
        "D4C": "Classificação Nacional de Atividades Econômicas (Código)",
        "D4N": "Classificação Nacional de Atividades Econômicas",
    }

    def row(place, variable, value, label="A Agricultura"):
        return {"A": place, "B": variable, "C": "2021", "D4C": "117", "D4N": label, "V": value}

    put("c/companies_1.json", [header, row("1", "2585", "7"), row("1", "2585", "8"), row("1", "707", "3"),
                                  row("1", "9999", "1"), row("2", "707", "..."), row("3", "662", "4", "  Total")])
    df = load.read_companies(spark, f"{tmp_path}/c/*.json")
    assert rows(df) == [("1", 2021, "A", 7.0, 3.0, None, None), ("3", 2021, "T", None, None, None, 4.0)]


def test_quarterly_sector_is_read_from_the_label_column(spark, put, tmp_path):
    header = {"D1C": "Variável (Código)", "D2C": "Trimestre (Código)", "D3C": "Setores e subsetores (Código)", "D3N": "Setores e subsetores"}
    put("q/quarters_1.json", [header, {"D1C": "583", "D2C": "202401", "D3C": "90707", "D3N": "Construção", "V": "101.5"}])
    got = load.read_quarter_gdp(spark, f"{tmp_path}/q/*.json").first()
    assert (got["sector"], got["quarter"], got["volume_index"], got["rate_4q"]) == ("Construção", 202401, 101.5, None)


def test_series_files_by_stem(spark, put, tmp_path):
    put("series/20539.json", [{"data": "01/01/2024", "valor": "1.5"}, {"data": "01/02/2024", "valor": "x"}])
    put("series/20540.json", [])
    put("series/20541.json", {"erro": {"detail": "no data"}})
    put("series/20542.json", "<html>busy</html>")
    path = f"{tmp_path}/series/*.json"
    assert rows(load.read_series_values(spark, path)) == [(20539, 202401, "2024-01-01", 1.5)]
    found = load.raw_rejects(spark, str(tmp_path)).collect()
    assert [(r["file"].split("/")[-1], r["reason"]) for r in found] == [("20542.json", "corrupt")]
    assert (tmp_path / "series/20542.json").exists()


def test_zipped_balance(spark, tmp_path):
    text = (
        "junk\r\njunk\r\n#DATA_BASE;UF;CODMUN_IBGE;CNPJ;AGEN_PROCESSADAS;VERBETE_160_OPER;VERBETE_399_TOTAL\r\n"
        "202401;SP;1234567;1;2;1000;bad\r\n202401;SP;1234567;2;;500;99950\r\n"
        "202401;SP;;3;;7;7\r\n202401;SP;7654321;1;;;\r\n"
    )
    for month in ("202401", "202402"):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as z:
            z.writestr("x.csv", text.replace("202401", month).encode("latin-1"))
        (tmp_path / f"{month}.csv.zip").write_bytes(buffer.getvalue())
    cells = banks.balance_cells(banks.read_zipped_lines(spark, f"{tmp_path}/*.csv.zip"))
    amounts = rows(banks.place_amounts(cells).filter("period = 202401 AND place_id <> ''"), "place_id", "account", "amount")
    assert amounts == [("1234567", 160, 1.5), ("1234567", 399, 100.0)]
    presence = rows(banks.place_presence(cells).filter("period = 202402"), "place_id", "institutions", "branches")
    assert presence == [("", 1, 0.0), ("1234567", 2, 2.0), ("7654321", 1, 0.0)]


MOVES = {
    "MOV202401.txt": [("202401", "123456", "0111301", "1", "1000,50"), ("202401", "123456", "0111302", "-1", "900,00"),
                           ("202401", "123456", "0111301", "1", ""), ("202401", "123456", "0111301", "0", "5,00")],
    "FOR202402.txt": [("202401", "123456", "0111301", "1", "2000,00")],
    "EXC202403.txt": [("202401", "123456", "0111301", "1", "1000,50")],
}


def write_moves(put, names):
    head = "competênciamov;região;município;seção;subclasse;saldomovimentação;salário"
    for name in names:
        lines = [f"{p};1;{m};A;{s};{b};{w}" for p, m, s, b, w in MOVES[name]]
        put(f"moves/{name}", "\n".join([head, *lines]) + "\n")


def test_movements_with_late_and_retracted_files(spark, put, tmp_path):
    write_moves(put, MOVES)
    raw = movements.read_movements(spark, f"{tmp_path}/moves/*.txt")
    assert raw.count() == 6
    got = movements.finish_jobs(movements.signed_jobs(raw, ["period", "place_id6", "division"])).collect()
    assert [tuple(r) for r in got] == [(202401, "123456", "01", 2, 1, 1, 2000.0)]


def test_institutions_codes_and_duplicates(spark, put, tmp_path):
    base = {"NomeInstituicao": "Banco", "Sr": "S1", "Uf": "SP", "Municipio": "X", "Situacao": "A", "Tc": 1,
            "CodConglomeradoFinanceiro": None, "CodConglomeradoPrudencial": "C1"}
    put("if/registry_202403.json", {"value": [{"CodInst": "0012", "Data": "202403", **base}]})
    put("if/registry_202406.json", {"value": [{"CodInst": 12, "Data": 202406, **base}, {"CodInst": 12, "Data": 202406, **base}]})
    put("if/statement_202403.json", {"value": [{"CodInst": 12, "AnoMes": 202403, "Conta": 78187, "Saldo": 5000.0},
                                         {"CodInst": 12, "AnoMes": 202403, "Conta": 78203, "Saldo": None}]})
    registry = institutions.read_registry(spark, f"{tmp_path}/if/registry_*.json")
    assert rows(registry, "inst_id", "period") == [("0012", 202403), ("12", 202406)]
    assert rows(institutions.read_statements(spark, f"{tmp_path}/if/statement_*.json")) == [("12", 202403, "78187", 5.0)]


def test_fallback_shards_and_dictionary(spark, put):
    report = institutions.read_report(spark, put("report.json", {"c": [{"ifd": 1, "sc": [{"ifd": 2}, {"ifd": 3}]}, {"ifd": 4, "sc": []}, {"ifd": 5}]}))
    names = institutions.read_names(spark, put("names.json", [
        {"id": 1, "n": "Capital de Giro", "lid": -1}, {"id": 2, "n": "Total", "lid": 100},
        {"id": 3, "n": "Nome", "lid": -1}, {"id": 4, "n": "Micro", "lid": 200}, {"id": 5, "n": "UF"}]))
    dictionary = institutions.column_dictionary(report, names)
    assert rows(dictionary, "account", "group", "column_name") == [("100", "Capital de Giro", "Total"), ("200", None, "Micro")]
    shard = put("shard.json", {"values": [{"e": 7, "v": [{"i": 100, "v": 1000.0}, {"i": 999, "v": 1.0}]}, {"e": 8, "v": [{"i": 200, "v": 5.0}]}]})
    entities = spark.createDataFrame([("7",)], "inst_id string")
    cells = institutions.read_shards(spark, shard, entities, dictionary)
    dictionary = dictionary.withColumn("report", F.lit("13"))
    got = institutions.fallback_portfolio(cells, dictionary, 202506)
    assert rows(got, "inst_id", "group", "column_name", "value") == [("7", "Capital de Giro", "Total", 1.0)]
    main = got.withColumn("value", F.lit(9.0))
    assert rows(institutions.fill_from_fallback(main, got, "period", "report"), "value") == [(9.0,)]
    reg = institutions.read_fallback_registry(spark, put("registry.json", [{"c0": 7, "c2": "B", "c12": "", "c10": "SP", "c11": "X", "c4": "C"}]), 202506)
    assert rows(reg, "inst_id", "period", "segment", "status") == [("7", 202506, None, "A")]


def test_fallback_fills_only_missing_quarters(spark, put, tmp_path):
    def value(period, amount):
        return {"CodInst": 7, "AnoMes": period, "Conta": "141870", "Saldo": amount}

    put("raw/institutions/statements/a.json", {"value": [value(202503, 1000.0)]})
    for q in (202503, 202506):
        put(f"spare/{q}/registry.json", [{"c0": 7, "c2": "B", "c12": "S1", "c10": "SP", "c11": "X", "c4": "C"}])
        put(f"spare/{q}/names.json", [{"id": 4, "n": "Micro", "lid": 200}])
        put(f"spare/{q}/statements.json", {"values": [{"e": 7, "v": [{"i": 141870, "v": 9000.0}, {"i": 5, "v": 1.0}]},
                                                      {"e": 8, "v": [{"i": 141870, "v": 1.0}]}]})
        put(f"spare/{q}/portfolios.json", {"values": [{"e": 7, "v": [{"i": 200, "v": 2000.0}]}]})
        for report in ("11", "12", "13"):
            put(f"spare/{q}/report_{report}.json", {"c": []})
        put(f"spare/{q}/report_14.json", {"c": [{"ifd": 4}]})
    t = load.with_fallback(load.raw_tables(spark, f"{tmp_path}/raw", f"{tmp_path}/seeds"), f"{tmp_path}/spare", [202503, 202506])
    assert rows(t["statement_value"]) == [("7", 202503, "141870", 1.0), ("7", 202506, "141870", 9.0)]
    assert rows(t["portfolio_size"], "inst_id", "period", "size", "value") == [("7", 202503, "Micro", 2.0), ("7", 202506, "Micro", 2.0)]
    assert rows(t["income_statement"], "period", "net_income") == [(202503, 1.0), (202506, 9.0)]


def test_lending_rates_weekly_and_monthly(spark, put, tmp_path):
    week = {"InicioPeriodo": "2024-01-02", "cnpj8": "1", "InstituicaoFinanceira": "B", "Segmento": "Pessoa Jurídica",
            "Modalidade": "Giro", "TaxaJurosAoMes": 1.5, "TaxaJurosAoAno": 19.6}
    put("t/weekly_1.json", {"value": [week, week, {**week, "cnpj8": "2", "TaxaJurosAoMes": None}]})
    put("t/monthly_1.json", {"value": [{"anoMes": "2024-01", "cnpj8": "1", "InstituicaoFinanceira": "B",
                                                 "Modalidade": "Financiamento imobiliário", "TaxaJurosAoMes": 0.9, "TaxaJurosAoAno": 11.0}]})
    got = rates.read_lending_rates(spark, f"{tmp_path}/t/weekly_*.json", f"{tmp_path}/t/monthly_*.json")
    assert rows(got, "start_date", "segment", "month_rate") == [("2024-01-01", "Pessoa Física", 0.9), ("2024-01-02", "Pessoa Jurídica", 1.5)]


def test_search_buckets(spark, put, tmp_path):
    def month(key, *classes):
        return {"key": key, "por_classe": {"buckets": [{"key": k, "doc_count": n} for k, n in classes]}}

    put("d/SP.json", {"aggregations": {"por_mes": {"buckets": [month("202401", (129, 5), (999, 7)), month("202402")]}}})
    put("d/DF.json", {"aggregations": {"por_mes": {"buckets": [month("202401", (108, 1))]}}})
    put("d/XX.json", "<html/>")
    assert rows(load.read_insolvency(spark, f"{tmp_path}/d/*.json")) == [
        ("DF", "tjdft", 202401, "FALENCIA", 1), ("SP", "tjsp", 202401, "RECUPERACAO_JUDICIAL", 5)]


def test_outlines(spark, put, tmp_path):
    put("m/SP.json", {"features": [{"geometry": {"type": "Polygon", "coordinates": [[1, 2]]}}]})
    put("m/RJ.json", {"features": []})
    put("m/AC.json", "{broken")
    assert rows(load.read_outlines(spark, f"{tmp_path}/m/*.json")) == [("SP", '{"type":"Polygon","coordinates":[[1,2]]}')]


def test_places_with_coordinates(spark, put):
    raw = put("places.json", [{"municipio-id": 1100015, "municipio-nome": "Alta Floresta D'Oeste", "UF-id": 11, "UF-sigla": "RO", "regiao-id": 1},
                                  {"municipio-id": 3550308, "municipio-nome": "São Paulo", "UF-id": 35, "UF-sigla": "SP", "regiao-id": 3}])
    coord = put("coordinates.csv", "codigo_ibge,latitude,longitude,capital\n3550308,-23.5,-46.6,1\n")
    got = load.read_places(spark, raw, coord)
    assert rows(got, "place_id", "place_id6", "name_key", "region", "lat", "is_capital") == [
        ("1100015", "110001", "ALTA FLORESTA D'OESTE", "Norte", None, None),
        ("3550308", "355030", "SAO PAULO", "Sudeste", -23.5, True)]


def test_national_jobs(spark, put, tmp_path):
    def body(*cells):
        return {"value": [{"TERCODIGO": "0", "NIVNOME": "Brasil", "VALDATA": d, "VALVALOR": v} for d, v in cells]}

    put("ipea/CAGED12_ADMIS.json", body(("2019-12-01T00:00:00-03:00", 5), ("2020-01-01T00:00:00-03:00", None)))
    put("ipea/CAGED12_SALDON12.json", body(("2020-01-01T00:00:00-03:00", 2)))
    got = load.read_national_jobs(spark, f"{tmp_path}/ipea/CAGED12_*.json")
    assert rows(got) == [(201912, "CAGED_ANTIGO", 5.0, None, None), (202001, "NOVO_CAGED", None, None, 2.0)]


def test_absent_sources_become_empty_tables_and_views_still_plan(spark, put, tmp_path):
    put("seeds/sector_map.csv", SEED)
    put("raw/series/20539.json", [{"data": "01/01/2024", "valor": "1.5"}])
    t = load.raw_tables(spark, f"{tmp_path}/raw", f"{tmp_path}/seeds")
    assert t["place_jobs"].count() == 0
    assert t["credit_macro"].first()["balance_total"] == 1.5
    from regiostat.plans.catalogue import VIEWS

    for name in VIEWS:
        assert t[name].columns
    assert t["state_scorecard"].count() == 0 and t["credit_penetration"].count() == 0


def test_missing_path_is_the_only_error_that_is_tolerated(spark):
    with pytest.raises(Exception):
        files.or_empty(spark, "place", lambda: spark.sql("SELECT no_such_column FROM range(1)"))


def test_raw_folder_to_place_views(spark, put, tmp_path):
    """Raw files of five sources through the load job, the key check and two views."""
    from regiostat.sources.sinks import write_base_tables

    places = [(1234567, "Vila Nova", 35, "SP", 3), (7654321, "São José", 33, "RJ", 3)]
    put("raw/places.json", [dict(zip(["municipio-id", "municipio-nome", "UF-id", "UF-sigla", "regiao-id"], p)) for p in places])
    put("seeds/coordinates.csv", "codigo_ibge,latitude,longitude,capital\n1234567,-23.5,-46.6,0\n")
    put("seeds/account.csv", "verbete;nome;grupo\n160;Crédito;CREDITO\n174;Provisão;PROVISAO\n")
    put("seeds/division.csv", "divisao;secao;secao_nome;nome\n01;A;Agro;Agricultura\n")
    head = "x\nx\n#DATA_BASE;CODMUN_IBGE;CNPJ;AGEN_PROCESSADAS;VERBETE_160_A;VERBETE_174_B;VERBETE_999_C\n"
    for month in ("202401", "202501"):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as z:
            z.writestr("a.csv", head + f"{month};1234567;1;3;{month}000;-5000;1\n{month};9999999;1;1;1;1;1\n")
        path = tmp_path / "raw" / "balances" / f"{month}.zip"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(buffer.getvalue())
    for name in MOVES:
        lines = [f"{p};1;{m};A;{s};{b};{w}" for p, m, s, b, w in MOVES[name]]
        put(f"raw/movements/{name}", "\n".join(["competênciamov;região;município;seção;subclasse;saldomovimentação;salário", *lines]) + "\n")
    t = load.raw_tables(spark, f"{tmp_path}/raw", f"{tmp_path}/seeds")
    write_base_tables(t, f"{tmp_path}/base")
    credit = rows(t["place_credit"], "period", "place_id", "credit_total", "provision_pct", "branches")
    assert credit == [(202401, "1234567", 202401.0, 0.0, 3.0), (202501, "1234567", 202501.0, 0.0, 3.0)]
    jobs = rows(t["place_employment"], "period", "place_id", "state", "hires", "net_12m")
    assert jobs == [(202401, "1234567", "SP", 2, 1)]
    assert rows(t["sector_jobs"], "section", "mean_wage") == [("A", 2000.0)]
    assert t["place_ranking"].count() == 2
    assert rows(load.raw_rejects(spark, f"{tmp_path}/raw")) == []


def test_microdata_files_are_read_by_their_own_header(spark, put, tmp_path):
    head = "competênciamov;região;município;seção;subclasse;saldomovimentação;salário"
    other = "salário;novo;competênciamov;município;subclasse;saldomovimentação"
    put("m/CAGEDMOV202401.txt", f"{head}\n202401;1;123456;A;0111301;1;1000,50\n")
    put("m/CAGEDMOV202402.txt", f'{other}\n"7,25";x;202402;123456;0111302;-1\n')
    put("m/CAGEDEXC202403.txt", "competênciamov;município\n202403;123456\n")
    put("m/notes.txt", f"{head}\n202401;1;123456;A;0111301;1;1\n")
    put("m/CAGEDFOR202404.txt", "no header\n")
    got = rows(movements.read_movements(spark, f"{tmp_path}/m/*.txt"))
    assert got == [(202401, "123456", "01", 1, 1000.5, "MOV"), (202402, "123456", "01", -1, 7.25, "MOV")]
    bad = {f.rsplit("/", 1)[1]: r for f, r, _ in rows(movements.movement_rejects(spark, f"{tmp_path}/m/*.txt"))}
    assert set(bad) == {"CAGEDEXC202403.txt", "notes.txt", "CAGEDFOR202404.txt"}
    assert bad["notes.txt"] == "unknown kind of file"


def test_bad_archives_ragged_lines_and_quotes(spark, tmp_path):
    text = (
        "x\nx\n#DATA_BASE;CODMUN_IBGE;CNPJ;AGEN_PROCESSADAS;VERBETE_160_A\n"
        '202401;"1234567";"a;b";"9";"1000"\n202401;1234567;2;3\n202401;1234567;2;3;4;5\n202401;1234567;3;1;10d\n'
    )
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("a.csv", text)
    (tmp_path / "good.zip").write_bytes(buffer.getvalue())
    (tmp_path / "broken.zip").write_bytes(b"no archive")
    lines = banks.read_zipped_lines(spark, f"{tmp_path}/*.zip")
    cells = banks.balance_cells(lines)
    got = rows(cells, "period", "place_id", "tax_id", "branches")
    assert got == [(202401, "1234567", "3", 1.0), (202401, "1234567", "a;b", 9.0)]
    assert rows(banks.place_amounts(cells), "account", "amount") == [(160, 1.0)]
    bad = sorted((f.rsplit("/", 1)[1], r, n) for f, r, n in rows(banks.balance_rejects(lines)))
    assert bad == [("broken.zip", banks.BAD_ARCHIVE, 1), ("good.zip", banks.RAGGED, 2)]


def test_the_load_reports_what_it_leaves_out(spark, put, tmp_path):
    put("raw/places.json", [{"municipio-id": 1234567, "municipio-nome": "A", "UF-id": 35, "UF-sigla": "SP", "regiao-id": 3}])
    put("seeds/coords.csv", "codigo_ibge,latitude,longitude,capital\n1234567,-23.5,-46.6,0\n")
    put("seeds/accounts.csv", "verbete;nome;grupo\n160;C;CREDITO\n")
    put("raw/population/2020.json", [{"D1C": "no such label", "V": "Valor"}, {"D1C": "1", "V": "2"}])
    put("raw/place_gdp/page.json", "<html>")
    head = "competênciamov;região;município;seção;subclasse;saldomovimentação;salário"
    put("raw/movements/MOV202401.txt", f"{head}\n202401;1;123456;A;0111301;1;1\n202401;1;999999;A;0111301;1;1\n;1;123456;A;0111301;1;1\n")
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("a.csv", "x\nx\n#DATA_BASE;CODMUN_IBGE;CNPJ;AGEN_PROCESSADAS;VERBETE_160_A;VERBETE_999_B\n202401;1234567;1;1;5;6\n202401;7777777;1;1;5;\n202401\n")
    (tmp_path / "raw" / "balances").mkdir()
    (tmp_path / "raw" / "balances" / "a.zip").write_bytes(buffer.getvalue())
    names = {"account": "accounts.csv", "coordinates": "coords.csv"}
    found = load.load_rejects(spark, f"{tmp_path}/raw", f"{tmp_path}/seeds", seed_files=names)
    got = sorted((r["source"], r["reason"], r["rows"]) for r in found.collect())
    assert got == [
        ("balances", "other number of cells than the header", 1),
        ("balances", "unknown account", 1),
        ("balances", "unknown place", 1),
        ("json", "corrupt", 1),
        ("movements", "period, place or activity missing", 1),
        ("movements", "unknown place", 1),
        ("population", "label missing", 1),
    ]
    t = load.raw_tables(spark, f"{tmp_path}/raw", f"{tmp_path}/seeds", seed_files=names)
    assert rows(t["account"], "account") == [(160,)]


def test_an_update_reads_new_files_only(spark, put, tmp_path):
    path, folder = f"{tmp_path}/moves/*.txt", f"{tmp_path}/sums"
    keys = ["period", "place_id6", "division"]
    write_moves(put, ["MOV202401.txt"])
    first = movements.update_jobs(spark, path, folder)
    assert rows(first) == rows(movements.signed_jobs(movements.read_movements(spark, path), keys))
    write_moves(put, ["FOR202402.txt", "EXC202403.txt"])
    wanted = rows(movements.signed_jobs(movements.read_movements(spark, path), keys))
    (tmp_path / "moves" / "MOV202401.txt").write_text("competênciamov;município;subclasse;saldomovimentação;salário\n")
    assert rows(movements.update_jobs(spark, path, folder)) == wanted
    assert len(list((tmp_path / "sums").glob("batch-*"))) == 2
    assert rows(movements.update_jobs(spark, path, folder)) == wanted
    assert len(list((tmp_path / "sums").glob("batch-*"))) == 2


def test_labelled_tables_are_parsed_once(spark, put):
    path = put("p/a.json", [{"D1C": load.PLACE_LABEL, "V": "Valor"}, {"D1C": "1", "V": "2"}])
    put("p/b.json", "<html>busy</html>")
    got, bad = files.read_header_row_json(spark, path[:-6], {"place_id": load.PLACE_LABEL})
    assert rows(got, "place_id", "value") == [("1", 2.0)] and rows(bad) == [("b", "corrupt")]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def bytes_read(spark):
    found = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(s.getBytesRead() for s in found if s.getScheme() == "file")


def test_numbers_read_as_text_cost_no_second_reading(spark, put):
    path = put("n/a.json", [{"data": n, "valor": n / 4} for n in range(2000)])
    size, before = len(open(path).read()), bytes_read(spark)
    got = files.read_json(spark, path, "data string, valor string").agg(F.sum("data"), F.sum("valor")).first()
    assert tuple(got) == (1999000.0, 499750.0)
    # Some hundred bytes for each of the 4000 numbers before.
    assert bytes_read(spark) - before < 5 * size


ODD_FILES = [
    "", " \n", "[]", "null", "<html>busy\n</html>\n", '[{"a": 1.10, "b": {"x":  [1, 2]}},\n {"a": "t", "b": null}]\n',
    '{\r\n "a": 100000000000000000000.50,\r\n "b": true}', '[{"a": "1"}', '{"a": "1"}\n{"a": "2"}\n', '[{"a": "1"}] x', "7",
    '["x", {"a": 1e3}]', '﻿[{"a": 12, "b": "é\\u0000\\n"}]', '[{"a": "\x01"}]', b'[{"a": "\xff"}]', '[{"n": "x", "a": "k"}]',
    '[[{"a": 1}]]', '[{"a": 1}, {"n": 2.5}, 3]', '[{"a": "é", "n": 3}]'.encode("utf-16"), "x\0y",
]


@pytest.mark.parametrize("split", [None, "64"])
def test_whole_json_files_keep_their_rows(spark, put, tmp_path, split):
    for k, content in enumerate(ODD_FILES):
        put(f"odd/{k}.json", content)
    put("odd/long.json", [{"a": n, "b": "x" * 50, "n": n} for n in range(100)])
    schema = "a string, b string, n int"
    multi = spark.read.schema(f"{schema}, corrupt string").json(
        f"{tmp_path}/odd", multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="corrupt"
    )
    want = multi.select("*", files.file_stem().alias("stem")).collect()
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = files.read_json(spark, f"{tmp_path}/odd", schema).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(got, key=repr) == sorted(want, key=repr) and len(want) > 110
