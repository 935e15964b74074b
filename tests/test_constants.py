"""Expected values written out, since the SQL of the contract imports the same constants."""

from regiostat import constants as C
from regiostat.operators.titles import TITLE_PATTERNS
from regiostat.sources.load import COMPANY_VARIABLES, GDP_VARIABLES, QUARTER_VARIABLES, STATE_COURTS


def test_accounts():
    assert C.BALANCE_ACCOUNTS == [160, 161, 162, 163, 164, 165, 166, 167, 169, 171, 174, 180, 399, 420, 432, 610]
    assert C.PLACE_CREDIT_COLUMNS["credit_total"] == [160]
    assert C.PLACE_CREDIT_COLUMNS["rural_credit"] == [163, 164, 165, 166, 167]
    assert C.PLACE_CREDIT_COLUMNS["provision"] == [174]
    assert C.PLACE_CREDIT_COLUMNS["total_assets"] == [399]
    assert len(C.STATEMENT_COLUMNS) == 32
    assert C.STATEMENT_COLUMNS["credit_income"] == ["141835", "78203"]
    assert C.STATEMENT_COLUMNS["credit_expected_loss"] == ["141840", "78213"]
    assert C.STATEMENT_COLUMNS["net_income"] == ["141870", "78187"]
    assert C.TOTAL_ASSETS_ACCOUNT == "140220" and C.NEW_SCHEME_MARKER == "interbank_income"


def test_series():
    assert C.CREDIT_MACRO_SERIES["balance_total"] == 20539 and C.CREDIT_MACRO_SERIES["credit_gdp_pct"] == 20622
    assert C.CREDIT_MACRO_SERIES["default_total"] == 21082 and C.CREDIT_MACRO_SERIES["rate_total"] == 20714
    assert (C.TOTAL_BALANCE_SERIES, C.INVOICE_RATE_YEARLY) == (20539, 20719)
    assert (C.INVOICE_RATE_MONTHLY, C.TOTAL_RATE_MONTHLY) == (25438, 25433)
    assert C.PULSE_SERIES["activity"] == 24363 and C.PULSE_SERIES["activity_adjusted"] == 24364


def test_labels():
    assert C.INSOLVENCY_CLASSES == {128: "RECUPERACAO_EXTRAJUDICIAL", 129: "RECUPERACAO_JUDICIAL", 108: "FALENCIA"}
    assert (C.ERA_OLD, C.ERA_NEW, C.NEW_ERA_START) == ("CAGED_ANTIGO", "NOVO_CAGED", 202001)
    assert (C.REPORT_HOUSEHOLD_AGING, C.REPORT_FIRM_ACTIVITY) == ("11", "12")
    assert (C.REPORT_FIRM_AGING, C.REPORT_FIRM_SIZE) == ("13", "14")
    assert C.BUCKET_OVERDUE == "Vencido a Partir de 15 Dias" and C.HOUSING_PATTERN == "%imobili%"
    assert C.FULL_COVERAGE_STATES == ["MA", "PI", "CE", "RN", "PB", "PE", "AL", "SE", "BA"]


def test_variables_and_courts():
    assert GDP_VARIABLES["gdp"] == 37 and GDP_VARIABLES["va_services"] == 6575
    assert QUARTER_VARIABLES["rate_4q"] == 6562 and COMPANY_VARIABLES["companies"] == 2585
    assert len(STATE_COURTS) == 27
    assert (STATE_COURTS["DF"], STATE_COURTS["SP"], STATE_COURTS["TO"]) == ("tjdft", "tjsp", "tjto")


def test_title_patterns():
    by_prefix = {p[0]: p[1:] for p in TITLE_PATTERNS}
    assert by_prefix["Indicador de Custo do Crédito - ICC"] == ("ICC", None, None, None)
    prefix = "Saldo de crédito pessoa jurídica por modalidade de crédito"
    assert by_prefix[prefix] == ("SALDO", "PJ", None, None)
    assert len(by_prefix) == len(TITLE_PATTERNS)
