"""Fixed values that published results depend on: codes, labels and series numbers."""

from __future__ import annotations

# Bank balance-sheet accounts kept per place.
BALANCE_ACCOUNTS = [160, 161, 162, 163, 164, 165, 166, 167, 169, 171, 174, 180, 399, 420, 432, 610]

# Output column -> balance-sheet accounts summed into it.
PLACE_CREDIT_COLUMNS = {
    "credit_total": [160],
    "loans": [161],
    "financing": [162],
    "rural_credit": [163, 164, 165, 166, 167],
    "housing_credit": [169],
    "other_credit": [171],
    "provision": [174],
    "savings": [420],
    "time_deposits": [432],
    "total_assets": [399],
}

# Label shown for each credit product column.
PRODUCT_LABELS = {
    "loans": "Empréstimos",
    "financing": "Financiamentos",
    "rural_credit": "Crédito rural",
    "housing_credit": "Crédito imobiliário",
    "other_credit": "Outras operações",
    "savings": "Poupança",
    "time_deposits": "Depósito a prazo",
}

# Output column -> series code of the national credit panel.
CREDIT_MACRO_SERIES = {
    "balance_total": 20539,
    "balance_firms": 20540,
    "balance_households": 20541,
    "free_total": 20542,
    "free_firms": 20543,
    "free_households": 20570,
    "directed_total": 20593,
    "directed_firms": 20594,
    "directed_households": 20606,
    "credit_gdp_pct": 20622,
    "default_total": 21082,
    "default_firms": 21083,
    "default_households": 21084,
    "lending_total": 20631,
    "lending_firms": 20632,
    "lending_households": 20633,
    "rate_total": 20714,
    "rate_firms": 20715,
    "rate_households": 20716,
}

# Series of the national monthly pulse.
PULSE_SERIES = {
    "activity": 24363,
    "activity_adjusted": 24364,
    "credit_balance": 20539,
    "lending": 20631,
    "default_rate": 21082,
    "credit_gdp_pct": 20622,
}

# Total balance and the same rates in yearly and monthly units.
TOTAL_BALANCE_SERIES = 20539
INVOICE_RATE_YEARLY = 20719
INVOICE_RATE_MONTHLY = 25438
TOTAL_RATE_MONTHLY = 25433

# Series families and levels.
FAMILY_SECTOR = "CREDITO_SETOR"
FAMILY_ACTIVITY = "ATIVIDADE"
LEVEL_SECTOR = "SETOR"
LEVEL_SUBSECTOR = "SUBSETOR"

# Output column -> statement accounts (new scheme first, old scheme where it exists).
STATEMENT_COLUMNS = {
    "total_assets": ["140220"],
    "credit_interest_income": ["141831"],
    "credit_income": ["141835", "78203"],
    "credit_expected_loss": ["141840", "78213"],
    "expected_loss": ["141842"],
    "interbank_income": ["141825"],
    "securities_income": ["141830"],
    "leasing_income": ["141836"],
    "other_lending_income": ["141837"],
    "funding_cost": ["141847"],
    "capital_debt_cost": ["141848"],
    "derivatives_result": ["141849"],
    "other_intermediation_result": ["141850"],
    "intermediation_result": ["141851"],
    "payment_services_result": ["141852"],
    "payment_expected_loss": ["141853"],
    "other_payment_result": ["141854"],
    "payment_result": ["141855"],
    "bank_fees": ["141856"],
    "other_service_income": ["141857"],
    "staff_cost": ["141858"],
    "administrative_cost": ["141859"],
    "other_expected_loss": ["141860"],
    "tax_cost": ["141862"],
    "equity_result": ["141863"],
    "other_income": ["141864"],
    "other_cost": ["141865"],
    "other_income_and_cost": ["141866"],
    "result_before_tax": ["141867"],
    "income_tax": ["141868"],
    "profit_sharing": ["141869"],
    "net_income": ["141870", "78187"],
}
TOTAL_ASSETS_ACCOUNT = "140220"

# Income-statement columns by nature.
REVENUE_COLUMNS = [
    "interbank_income", "securities_income", "credit_income", "leasing_income",
    "other_lending_income", "payment_services_result", "bank_fees", "other_service_income",
    "other_income",
]
COST_COLUMNS = [
    "expected_loss", "funding_cost", "capital_debt_cost", "payment_expected_loss", "staff_cost",
    "administrative_cost", "other_expected_loss", "tax_cost", "other_cost",
]
EITHER_COLUMNS = [
    "derivatives_result", "other_intermediation_result", "other_payment_result", "equity_result",
    "income_tax", "profit_sharing",
]
# A statement without this column follows the old scheme and gets no totals.
NEW_SCHEME_MARKER = "interbank_income"

# Identities of the statement tree (total -> parts).
STATEMENT_IDENTITIES = {
    "intermediation_result": [
        "interbank_income", "securities_income", "credit_income", "leasing_income",
        "other_lending_income", "expected_loss", "funding_cost", "capital_debt_cost",
        "derivatives_result", "other_intermediation_result",
    ],
    "result_before_tax": ["intermediation_result", "payment_result", "other_income_and_cost"],
    "net_income": ["result_before_tax", "income_tax", "profit_sharing"],
}

# Portfolio report numbers and labels.
REPORT_HOUSEHOLD_AGING = "11"
REPORT_FIRM_ACTIVITY = "12"
REPORT_FIRM_AGING = "13"
REPORT_FIRM_SIZE = "14"
BUCKET_TOTAL = "Total"
BUCKET_OVERDUE = "Vencido a Partir de 15 Dias"
FIRM_PORTFOLIO_TOTAL = "Total da Carteira de Pessoa Jurídica"
CLIENT_FIRM = "PJ"
CLIENT_HOUSEHOLD = "PF"
SEGMENT_HOUSEHOLD = "Pessoa Física"
HOUSING_PATTERN = "%imobili%"

# Insolvency class code -> class, and output column -> class.
INSOLVENCY_CLASSES = {
    128: "RECUPERACAO_EXTRAJUDICIAL",
    129: "RECUPERACAO_JUDICIAL",
    108: "FALENCIA",
}
INSOLVENCY_COLUMNS = {
    "judicial": "RECUPERACAO_JUDICIAL",
    "extrajudicial": "RECUPERACAO_EXTRAJUDICIAL",
    "bankruptcy": "FALENCIA",
}

# Eras of the national employment series and the first month of the new one.
ERA_OLD = "CAGED_ANTIGO"
ERA_NEW = "NOVO_CAGED"
NEW_ERA_START = 202001

# Frequency and parse status.
MONTHLY = "MENSAL"
QUARTERLY = "TRIMESTRAL"
PARSED = "OK"
UNPARSED = "NAO_PARSEADO"

# Catalogue searches that feed the balance and the new-lending families.
SEARCH_BALANCE = "Saldo da carteira de crédito"
SEARCH_LENDING = "Concessões de crédito"
CHAINED_SERIES = "Série encadeada"

# Products that are part of another product, or cut the same total another way.
NESTED_PRODUCTS = [
    "Rotativo",
    "Não rotativo",
    "Capital de giro rotativo",
    "Capital de giro com prazo de até 365 dias",
    "Capital de giro com prazo superior a 365 dias",
    "Cartão de crédito rotativo",
    "Cartão de crédito parcelado",
    "Cartão de crédito à vista",
    "Aquisição de veículos",
    "Aquisição de outros bens",
    "Arrendamento mercantil de veículos",
    "Arrendamento mercantil de outros bens",
    "Crédito rural com taxas de mercado",
    "Crédito rural com taxas reguladas",
    "Financiamento imobiliário com taxas de mercado",
    "Financiamento imobiliário com taxas reguladas",
    "Financiamento de investimentos com recursos do BNDES",
    "Financiamento agroindustrial com recursos do BNDES",
    "Capital de giro com recursos do BNDES",
    "Crédito pessoal consignado total",
    "Crédito pessoal consignado para trabalhadores do setor público",
    "Crédito pessoal consignado para trabalhadores do setor privado",
    "Crédito pessoal consignado para aposentados e pensionistas do INSS",
    "Crédito pessoal não consignado",
    "Crédito pessoal não consignado vinculado à composição de dívidas",
    "Microcrédito destinado a consumo",
    "Microcrédito destinado a microempreendedores",
]

# GDP sector -> (group, level).
GDP_SECTORS = {
    "PIB a preços de mercado": ("AGREGADO", "TOTAL"),
    "Valor adicionado a preços básicos": ("AGREGADO", "TOTAL"),
    "Impostos líquidos sobre produtos": ("AGREGADO", "TOTAL"),
    "Agropecuária - total": ("OFERTA", "GRANDE_GRUPO"),
    "Indústria - total": ("OFERTA", "GRANDE_GRUPO"),
    "Indústrias extrativas": ("OFERTA", "SUBSETOR"),
    "Indústrias de transformação": ("OFERTA", "SUBSETOR"),
    "Eletricidade e gás, água, esgoto, atividades de gestão de resíduos": ("OFERTA", "SUBSETOR"),
    "Construção": ("OFERTA", "SUBSETOR"),
    "Serviços - total": ("OFERTA", "GRANDE_GRUPO"),
    "Comércio": ("OFERTA", "SUBSETOR"),
    "Transporte, armazenagem e correio": ("OFERTA", "SUBSETOR"),
    "Informação e comunicação": ("OFERTA", "SUBSETOR"),
    "Atividades financeiras, de seguros e serviços relacionados": ("OFERTA", "SUBSETOR"),
    "Atividades imobiliárias": ("OFERTA", "SUBSETOR"),
    "Administração, saúde e educação públicas e seguridade social": ("OFERTA", "SUBSETOR"),
    "Outras atividades de serviços": ("OFERTA", "SUBSETOR"),
    "Despesa de consumo das famílias": ("DEMANDA", "TOTAL"),
    "Despesa de consumo da administração pública": ("DEMANDA", "TOTAL"),
    "Formação bruta de capital fixo": ("DEMANDA", "TOTAL"),
    "Exportação de bens e serviços": ("DEMANDA", "TOTAL"),
    "Importação de bens e serviços (-)": ("DEMANDA", "TOTAL"),
}
GDP_HEADLINE = "PIB a preços de mercado"

# States and cities whose institutions are all kept in the statement history.
FULL_COVERAGE_STATES = ["MA", "PI", "CE", "RN", "PB", "PE", "AL", "SE", "BA"]
FULL_COVERAGE_CITIES = [("PR", "Curitiba")]

# Value-added component names of the sector crosswalk.
VALUE_ADDED_SECTORS = {
    "AGRO": "va_agri",
    "INDUSTRIA": "va_industry",
    "SERVICOS": "va_services",
    "ADM_PUBLICA": "va_public",
}
