"""Names, rules and lookup values used across the package.

Everything here is passed on as a default argument, so a caller can replace it.
"""

from __future__ import annotations

# --- fixed values: they must equal the source system's, do not edit -------------------

# contract number in the grant system -> contract id in the ledger
CONTRACT_BY_SIT = {
    "57884": "6373",
    "63377": "6729",
    "66270": "6822",
    "67303": "6893",
    "67669": "6932",
    "71199": "26478",
    "74699": "26672",
}

# substring of the expense type -> expense class, first match wins
EXPENSE_CLASSES = (
    ("PESSOAL CIVIL", "PESSOAL"),
    ("OBRIGAÇÕES PATRONAIS", "ENCARGOS"),
    ("MATERIAIS DE CONSUMO", "MATERIAIS DE CONSUMO"),
    ("SERVIÇOS DE TERCEIROS", "SERVIÇOS DE TERCEIROS"),
)
OTHER_CLASS = "OUTROS"

# column order of an expense
EXPENSE_COLUMNS = (
    "id_codigo_sit",
    "termo",
    "rubrica",
    "tipo_despesa",
    "cpf_cnpj",
    "favorecido",
    "tipo_doc_despesa",
    "descricao_despesa",
    "tipo_doc_pagamento",
    "data_pagamento",
    "data_debito_convenio",
    "valor",
    "id_termo_rubrica",
)

# workbook headers
H_CODE = "Código"
H_TYPE = "Tipo de Despesa"
H_TAX_ID = "CPF/CNPJ"
H_PAYEE = "Favorecido"
H_EXPENSE_DOC = "Tipo Documento Despesa"
H_DESCRIPTION = "Descrição da Despesa"
H_PAYMENT_DOC = "Tipo Documento Pagamento"
H_PAID_ON = "Data do Pagamento"
H_DEBITED_ON = ("Data Débito Conta Convêvio", "Data Débito Conta Convênio")
H_AMOUNT = "Valor"

# markers in a summary report
MARK_SIT = "Nº SIT"
MARK_INCOME = "Detalhes dos Rendimentos de Aplicações Financeiras"
MARK_EXPENSES = "Detalhe das Despesas"
MARK_TOTAL = "T O T A L"
MARK_HEADER = "Despesa;"

# words in expense descriptions
SALARY = "SALÁRIO"
SALARY_PAYMENT = "PAGAMENTO SALÁRIO"
VACATION = "FÉRIAS"
CHARGES = "REEMBOLSO RECOLHIMENTO"
PERSONNEL_CODES = ("3.1.90.11.99", "3.1.90.13.99")

# substring of the description -> job title, first match wins; each report has its own list
ROSTER_JOBS = (
    ("AUXILIAR SERVIÇOS GERAIS", "AUXILIAR SERVIÇOS GERAIS"),
    ("CUIDADORA AUXILIAR", "CUIDADORA AUXILIAR"),
    ("CUIDADORA", "CUIDADORA"),
    ("NUTRICIONISTA", "NUTRICIONISTA"),
    ("PSICÓLOGA", "PSICÓLOGA"),
    ("ASSISTENTE SOCIAL", "ASSISTENTE SOCIAL"),
    ("COORDENADOR", "COORDENADOR"),
    ("COZINHEIRA", "COZINHEIRA"),
    ("PROFESSORA NÃO REGENTE", "PROFESSORA NÃO REGENTE"),
    ("PROFESSORA REGENTE", "PROFESSORA REGENTE"),
    ("MOTORISTA", "MOTORISTA"),
)
SPEND_JOBS = (
    ("CUIDADORA AUXILIAR", "CUIDADORA AUXILIAR"),
    ("CUIDADORA", "CUIDADORA"),
    ("AUXILIAR SERVIÇOS GERAIS", "AUXILIAR SERVIÇOS GERAIS"),
    ("NUTRICIONISTA", "NUTRICIONISTA"),
    ("PSICÓLOGA", "PSICÓLOGA"),
    ("ASSISTENTE SOCIAL", "ASSISTENTE SOCIAL"),
    ("COORDENADOR", "COORDENADOR(A)"),
    ("COZINHEIRA", "COZINHEIRA"),
    ("PROFESSORA REGENTE", "PROFESSORA REGENTE"),
)
VACATION_JOBS = (
    ("AUXILIAR SERVIÇOS GERAIS", "AUXILIAR SERVIÇOS GERAIS"),
    ("CUIDADORA AUXILIAR", "CUIDADORA AUXILIAR"),
    ("CUIDADORA", "CUIDADORA"),
    ("NUTRICIONISTA", "NUTRICIONISTA"),
    ("PSICÓLOGA", "PSICÓLOGA"),
    ("ASSISTENTE SOCIAL", "ASSISTENTE SOCIAL"),
    ("COORDENADOR", "COORDENADOR"),
    ("COZINHEIRA", "COZINHEIRA"),
    ("PROFESSORA", "PROFESSORA"),
)
INSTALMENT_JOBS = (
    ("AUXILIAR SERVIÇOS GERAIS", "AUXILIAR SERVIÇOS GERAIS"),
    ("CUIDADORA AUXILIAR", "CUIDADORA AUXILIAR"),
    ("CUIDADORA", "CUIDADORA"),
    ("NUTRICIONISTA", "NUTRICIONISTA"),
    ("PSICÓLOGA", "PSICÓLOGA"),
    ("ASSISTENTE SOCIAL", "ASSISTENTE SOCIAL"),
    ("COORDENADOR", "COORDENADOR"),
    ("COZINHEIRA", "COZINHEIRA"),
)
OTHER_JOB = "OUTRO"
SPEND_KINDS = (
    (CHARGES, "ENCARGOS (INSS / FGTS / IRRF)"),
    (SALARY_PAYMENT, "SALÁRIO"),
    (VACATION, "FÉRIAS"),
)
INSTALMENTS = (("1ª PARCELA", "1ª PARCELA"), ("2ª PARCELA", "2ª PARCELA"))
NO_INSTALMENT = "NÃO IDENTIFICADA"

# seat states
SEAT_FREE = "DISPONÍVEL"
SEAT_TAKEN = "OCUPADA"

# roster states
ACTIVE = "ATIVO"
INACTIVE = "INATIVO"
UNDEFINED = "INDEFINIDO"

# change actions
INSERT = "INSERT"
UPDATE = "UPDATE"
IGNORE = "IGNORE"

# titles of the two change logs
LINE_LOG_TITLE = "Relatório Completo - Rubricas"
CONTRACT_LOG_TITLE = "Relatório Completo - Termos"

# average days of a month in the runway text, and the reconcile tolerance
DAYS_PER_MONTH = "30.4375"
TOLERANCE = "0.01"
