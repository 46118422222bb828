"""DuckDB SQL for the queries in ``catalog``, written from the rules and not from the plans.

Money is handled in whole cents or millionths as integers, so that quotients round exactly
as the ledger's (38,6) decimals do.
"""

from __future__ import annotations

from .settings import INSTALMENT_JOBS, ROSTER_JOBS, SPEND_JOBS, VACATION_JOBS
from .standins import AS_OF, JOBS_BY_MONTH, JOBS_BY_PRIORITY, LOADED_BEFORE, SEATS_AS_OF

ORACLE: dict[str, str] = {}


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _like(column: str, words) -> str:
    return "(" + " OR ".join(f"upper({column}) LIKE '%{w}%'" for w in words) + ")"


def _case(column: str, rules, default: str) -> str:
    tests = " ".join(f"WHEN upper({column}) LIKE '%{w}%' THEN '{label}'" for w, label in rules)
    return f"CASE {tests} ELSE {default} END"


def _round_div(a: str, b: str) -> str:
    """Integer a / b rounded half away from zero."""
    return (
        f"(CASE WHEN ({a} < 0) <> ({b} < 0) THEN -1 ELSE 1 END"
        f" * ((2 * abs(CAST({a} AS HUGEINT)) + abs(CAST({b} AS HUGEINT))) // (2 * abs(CAST({b} AS HUGEINT)))))"
    )


def _brl(x: str) -> str:
    return f"translate(format('{{:,.2f}}', {x}), ',.', '.,')"


def _brl_cents(x: str) -> str:
    """Brazilian money text of a whole number of cents."""
    return (
        f"(CASE WHEN {x} < 0 THEN '-' ELSE '' END || replace(format('{{:,}}', abs({x}) // 100), ',', '.')"
        f" || ',' || lpad(CAST(abs({x}) % 100 AS VARCHAR), 2, '0'))"
    )


# --- tables of the ledger -------------------------------------------------------------

EXPENSES = """despesas AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id_codigo_sit, CAST(o_custkey AS VARCHAR) AS termo,
    o_orderpriority AS rubrica, 'OUTROS' AS tipo_despesa,
    lpad(CAST(o_custkey AS VARCHAR), 11, '0') AS cpf_cnpj, 'PESSOA ' || o_custkey AS favorecido,
    '' AS tipo_doc_despesa, 'PEDIDO ' || o_orderstatus AS descricao_despesa, '' AS tipo_doc_pagamento,
    strftime(o_orderdate, '%Y-%m-%d') AS data_pagamento, strftime(o_orderdate, '%Y-%m-%d') AS data_debito_convenio,
    CAST(o_totalprice AS DECIMAL(18,2)) AS valor, o_custkey || '-' || o_orderpriority AS id_termo_rubrica
  FROM orders)"""

STORED = f"""guardadas AS (
  WITH antes AS (
    SELECT * REPLACE (CAST(valor + CASE WHEN descricao_despesa = 'PEDIDO P' THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS valor,
      CASE WHEN rubrica = '2-HIGH' THEN 'PEDIDO ANTIGO' ELSE descricao_despesa END AS descricao_despesa)
    FROM despesas WHERE data_pagamento < '{LOADED_BEFORE}')
  SELECT * FROM antes
  UNION ALL SELECT * REPLACE ('X' || id_codigo_sit AS id_codigo_sit, 'X' AS termo, 'X-' || rubrica AS id_termo_rubrica)
  FROM antes WHERE CAST(id_codigo_sit AS BIGINT) % 50 = 0)"""

CLASSIFIED = """comparadas AS (
  SELECT d.*, CASE WHEN g.id_codigo_sit IS NULL THEN 'INSERT'
    WHEN g.valor <> d.valor OR g.descricao_despesa <> d.descricao_despesa THEN 'UPDATE' ELSE 'IGNORE' END AS acao
  FROM despesas d LEFT JOIN guardadas g USING (id_codigo_sit))"""

CONTRACTS = """termos AS (
  SELECT CAST(c_custkey AS INTEGER) AS id_termo, c_mktsegment AS situacao_atual,
    CAST(DATE '1994-06-15' + to_months(c_nationkey) AS DATE) AS inicio,
    CAST(DATE '2001-06-15' + to_months(c_nationkey) AS DATE) AS fim,
    CASE WHEN c_acctbal >= 0 THEN CAST(round(c_acctbal * 100) AS BIGINT) END AS rendimento,
    CAST(c_custkey + 50000 AS INTEGER) AS nro_sit
  FROM customer)"""

# amounts in cents
LINES = """linhas AS (
  SELECT o_custkey || '-' || o_orderpriority AS id_termo_rubrica, CAST(o_custkey AS INTEGER) AS id_termo,
    CAST(max(o_orderdate) AS DATE) AS fim_linha,
    CASE o_orderpriority WHEN '1-URGENT' THEN 2 * max(cents) WHEN '2-HIGH' THEN max(cents)
      WHEN '3-MEDIUM' THEN min(cents) WHEN '4-NOT SPECIFIED' THEN 0
      ELSE (max(cents) * 5 + 50) // 100 END AS previsto,
    min(cents) AS saldo_antigo,
    CASE WHEN o_orderpriority <> '3-MEDIUM' THEN (min(cents) + 50) // 100 END AS estornado
  FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
  GROUP BY o_custkey, o_orderpriority)"""

PAID = """pagas AS (
  SELECT o_custkey || '-' || o_orderpriority AS id_termo_rubrica,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS gasto, max(o_orderdate) AS ultimo
  FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)"""

# burn in millionths
METRICS = f"""medidas AS (
  SELECT id_termo_rubrica, gasto, restantes,
    CASE WHEN meses <> 0 THEN {_round_div("gasto * 10000", "meses")} END AS media
  FROM (
    SELECT l.id_termo_rubrica, coalesce(p.gasto, 0) AS gasto, date_diff('day', DATE '{AS_OF}', t.fim) AS restantes,
      (year(p.ultimo) - year(t.inicio)) * 12 + month(p.ultimo) - month(t.inicio) + 1 AS meses
    FROM linhas l JOIN termos t ON t.id_termo = CAST(split_part(l.id_termo_rubrica, '-', 1) AS INTEGER)
    LEFT JOIN pagas p ON p.id_termo_rubrica = l.id_termo_rubrica))"""

_REFRESHED = f"""atuais AS (
  SELECT *, CASE WHEN media > 0 THEN {_round_div("CAST(saldo AS HUGEINT) * 10000 * 1000000", "media")} END AS folego,
    CASE WHEN previsto > 0 THEN {_round_div(_round_div("CAST(gasto AS HUGEINT) * 100000000", "previsto"), "10000")} END AS pct
  FROM (
    SELECT l.*, m.gasto, m.restantes, m.media, l.previsto - m.gasto + coalesce(l.estornado, 0) AS saldo
    FROM linhas l JOIN medidas m USING (id_termo_rubrica)))"""

LEDGER = (CONTRACTS, LINES, PAID, METRICS)
REFRESHED = (*LEDGER, _REFRESHED)


def _floor_div(a: str, b: str) -> str:
    return f"CAST(floor(CAST({a} AS DOUBLE) / {b}) AS BIGINT)"


_DAYS_MICRO = _round_div("CAST(folego AS HUGEINT) * 304375", "10000")
_RUNWAY_TEXT = f"""CASE WHEN folego IS NOT NULL THEN
    {_floor_div("folego", "12000000")} || ' anos, ' || ({_floor_div("folego", "1000000")} % 12) || ' meses e ' ||
    {_floor_div(f"({_DAYS_MICRO} % 30437500)", "1000000")} || ' dias' END"""

ROLLUP = f"""totais AS (
  SELECT id_termo, max(fim_linha) AS fim, CAST(sum(gasto) AS BIGINT) AS gasto, CAST(sum(saldo) AS BIGINT) AS saldo,
    CAST(sum(CASE WHEN saldo < 0 AND previsto > 0 AND pct > 10000 THEN -saldo ELSE 0 END) AS BIGINT) AS usado,
    CAST(sum(CASE WHEN saldo < 0 AND previsto > 0 AND pct > 10000 AND pct < 100000 THEN -saldo ELSE 0 END) AS BIGINT) AS usado_texto
  FROM atuais GROUP BY id_termo)"""

ORACLE["burn_rate"] = _with(*LEDGER) + f"""SELECT id_termo_rubrica, '{AS_OF}' AS data_atual,
  CAST(restantes AS INTEGER) AS dias_restantes, gasto / 100.0::DOUBLE AS saldo_total_gasto,
  CAST(media AS DOUBLE) / 1000000 AS media_mensal_gastos FROM medidas"""

ORACLE["line_refresh"] = _with(*REFRESHED) + f"""SELECT id_termo_rubrica, '{AS_OF}' AS data_atual,
  CAST(restantes AS INTEGER) AS dias_restantes, CAST(previsto AS DOUBLE) / 100 AS saldo_inicial_previsto,
  CAST(estornado AS DOUBLE) / 100 AS valor_estornado, CAST(gasto AS DOUBLE) / 100 AS saldo_total_gasto,
  CAST(saldo AS DOUBLE) / 100 AS saldo_atual, {_brl_cents("pct")} || '%' AS executado,
  CAST({_round_div("media", "10000")} AS DOUBLE) / 100 AS media_mensal_gastos,
  trunc(CAST(folego AS DOUBLE) / 1000000) + 0.0 AS previsao_mensal_saldo,
  {_RUNWAY_TEXT} AS previsao_mensal_saldo_texto FROM atuais"""

ORACLE["line_change_log"] = _with(*REFRESHED) + """SELECT 'Relatório Completo - Rubricas' AS "TIPO",
  id_termo_rubrica AS "Id", CAST(saldo_antigo AS DOUBLE) / 100 AS "SaldoAntigo", CAST(saldo AS DOUBLE) / 100 AS "SaldoNovo",
  CAST(restantes AS INTEGER) AS "DiasRestantes" FROM atuais"""

ORACLE["contract_rollup"] = _with(*REFRESHED, ROLLUP) + f"""SELECT id_termo,
  strftime(fim, '%Y-%m-%d') AS data_fim_vigencia, '{AS_OF}' AS data_atual,
  CAST(date_diff('day', DATE '{AS_OF}', fim) AS INTEGER) AS dias_restantes,
  CAST(gasto AS DOUBLE) / 100 AS saldo_total_gasto, CAST(saldo AS DOUBLE) / 100 AS saldo_atual FROM totais"""

_CONTRACT_AFTER = f"""SELECT t.id_termo, CASE WHEN s.id_termo IS NOT NULL THEN '{AS_OF}' END AS data_atual,
  CAST(CASE WHEN s.id_termo IS NOT NULL THEN date_diff('day', DATE '{AS_OF}', t.fim) ELSE 999 END AS INTEGER) AS dias_restantes,
  CAST(s.gasto AS DOUBLE) / 100 AS saldo_total_gasto,
  CAST(s.saldo + coalesce(t.rendimento, 0) AS DOUBLE) / 100 AS saldo_atual"""

ORACLE["contract_refresh"] = (
    _with(*REFRESHED, ROLLUP) + _CONTRACT_AFTER + " FROM termos t LEFT JOIN totais s USING (id_termo)"
)

ORACLE["contract_change_log"] = _with(*REFRESHED, ROLLUP) + f"""SELECT 'Relatório Completo - Termos' AS "TIPO",
  t.id_termo AS "Id", CAST(999 AS INTEGER) AS "DiasAntigos",
  CAST(date_diff('day', DATE '{AS_OF}', t.fim) AS INTEGER) AS "DiasNovos",
  CAST(s.saldo + coalesce(t.rendimento, 0) AS DOUBLE) / 100 AS "SaldoNovo"
  FROM termos t JOIN totais s USING (id_termo)"""

ORACLE["consumed_income"] = _with(*REFRESHED, ROLLUP) + """SELECT t.id_termo,
  CAST(t.rendimento AS DOUBLE) / 100 AS rendimento_financeiro_total,
  CAST(coalesce(t.rendimento, 0) - coalesce(s.usado, 0) AS DOUBLE) / 100 AS rendimento_financeiro_atual
  FROM termos t LEFT JOIN totais s USING (id_termo)"""

ORACLE["consumed_income_text_percent"] = _with(*REFRESHED, ROLLUP) + """SELECT t.id_termo,
  CAST(coalesce(t.rendimento, 0) - coalesce(s.usado_texto, 0) AS DOUBLE) / 100 AS rendimento_financeiro_atual
  FROM termos t LEFT JOIN totais s USING (id_termo)"""

ORACLE["key_split_join"] = """SELECT DISTINCT o_custkey || '-' || o_orderpriority AS id_termo_rubrica,
  CAST(c_custkey AS INTEGER) AS id_termo, CAST(c_custkey + 50000 AS INTEGER) AS nro_sit, c_mktsegment AS situacao_atual
  FROM orders JOIN customer ON o_custkey = c_custkey"""

# --- change detection -----------------------------------------------------------------

CHANGES = (EXPENSES, STORED, CLASSIFIED)
_COLS = """id_codigo_sit, termo, rubrica, tipo_despesa, cpf_cnpj, favorecido, tipo_doc_despesa, descricao_despesa,
  tipo_doc_pagamento, data_pagamento, data_debito_convenio, CAST(valor AS DOUBLE) AS valor, id_termo_rubrica"""

ORACLE["row_fingerprint"] = _with(EXPENSES) + """SELECT id_codigo_sit, md5(concat_ws('|', termo, rubrica, tipo_despesa,
  cpf_cnpj, favorecido, tipo_doc_despesa, descricao_despesa, tipo_doc_pagamento, data_pagamento, data_debito_convenio,
  CAST(valor AS VARCHAR), id_termo_rubrica)) AS impressao FROM despesas"""

ORACLE["change_detect"] = _with(*CHANGES) + f"SELECT {_COLS}, acao FROM comparadas WHERE acao <> 'IGNORE'"

ORACLE["change_counts"] = _with(*CHANGES) + "SELECT acao, count(*) AS registros FROM comparadas GROUP BY acao"

ORACLE["change_preview"] = _with(*CHANGES) + """SELECT acao, id_codigo_sit, termo, CAST(valor AS DOUBLE) AS valor
  FROM comparadas WHERE acao <> 'IGNORE' ORDER BY acao, id_codigo_sit LIMIT 3"""

ORACLE["new_expenses"] = _with(*CHANGES) + """SELECT id_codigo_sit, CAST(valor AS DOUBLE) AS valor
  FROM comparadas WHERE acao = 'INSERT'"""

# each stored row takes the last of the incoming rows that differ from it; unknown keys are added with their copies
ORACLE["apply_changes"] = _with(EXPENSES, STORED, """entradas AS (
  SELECT *, 1 AS vez FROM despesas
  UNION ALL SELECT * REPLACE (CAST(valor + 2 AS DECIMAL(18,2)) AS valor), 2 FROM despesas WHERE CAST(id_codigo_sit AS BIGINT) % 7 = 0)""",
  """ultimas AS (
  SELECT e.* FROM entradas e JOIN guardadas g USING (id_codigo_sit)
  WHERE e.valor <> g.valor OR e.descricao_despesa <> g.descricao_despesa
  QUALIFY row_number() OVER (PARTITION BY id_codigo_sit ORDER BY e.vez DESC) = 1)""") + f"""SELECT {_COLS} FROM ultimas
  UNION ALL SELECT {_COLS} FROM guardadas WHERE id_codigo_sit NOT IN (SELECT id_codigo_sit FROM ultimas)
  UNION ALL SELECT {_COLS} FROM entradas WHERE id_codigo_sit NOT IN (SELECT id_codigo_sit FROM guardadas)"""

ORACLE["diff_idempotent"] = "SELECT 'IGNORE' AS acao, count(*) AS registros FROM orders"

ORACLE["dedup_keep_last"] = """SELECT user_id, event_id, event_type, "value" FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""

ORACLE["last_value_map"] = """SELECT user_id, event_type FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""

# --- reports and reconcile ------------------------------------------------------------

_MARKED = """relatos AS (
  SELECT o_orderkey, CAST(o_custkey + 50000 AS VARCHAR) AS nro_sit, o_orderstatus, o_orderdate,
    CAST(o_totalprice AS DECIMAL(18,2)) AS valor, 'R$ ' || translate(format('{:,.2f}', CAST(o_totalprice AS DECIMAL(18,2))), ',.', '.,') AS escrito,
    '3.3.90.30.0' || left(o_orderpriority, 1) AS codigo
  FROM orders)"""

# the written lines of a report as rows: order, section, text; two lines shift with the status
_LINES_OF = """partes AS (
  SELECT o_orderkey, nro_sit, o_orderstatus, 0 AS pos, 'none' AS secao, 'lixo;1' AS linha, false AS numerada FROM relatos
  UNION ALL SELECT o_orderkey, nro_sit, o_orderstatus, 1, 'none', 'Nº SIT;' || nro_sit, false FROM relatos WHERE o_orderstatus <> 'P'
  UNION ALL SELECT o_orderkey, nro_sit, o_orderstatus, 2, 'income', 'Detalhes dos Rendimentos de Aplicações Financeiras', true FROM relatos WHERE o_orderstatus = 'O'
  UNION ALL SELECT o_orderkey, nro_sit, o_orderstatus, 3, 'none', 'T O T A L;R$ 7,00', true FROM relatos WHERE o_orderstatus = 'O'
  UNION ALL SELECT o_orderkey, nro_sit, o_orderstatus, 4, 'none', 'T O T A L;R$ 8,00', true FROM relatos WHERE o_orderstatus = 'O'
  UNION ALL SELECT o_orderkey, nro_sit, o_orderstatus, inicio + i, secao, linha, o_orderstatus <> 'P' FROM (
    SELECT *, CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'F' THEN 2 ELSE 5 END AS inicio FROM relatos) r,
    LATERAL (VALUES
      (0, 'income', 'Detalhes dos Rendimentos de Aplicações Financeiras'),
      (1, 'income', '01/2025;R$ 10,00'),
      (2, 'none', 'T O T A L;' || r.escrito),
      (3, 'none', 'Detalhe das Despesas'),
      (4, 'expenses', 'Despesa;Previsto;Pago;Saldo;Estornado'),
      (5, 'expenses', r.codigo || ' - MATERIAL;1.000,00;500,00;500,00;' || r.escrito),
      (6, 'expenses', '3.1.90.11.99 - PESSOAL;2.000,00;900,00;1.100,00;-'),
      (7, 'expenses', 'curta;1;2'),
      (9, 'expenses', 'T O T A L;3.000,00;1.400,00;1.600,00;25,10')) v(i, secao, linha))"""

ORACLE["section_parse"] = _with(_MARKED, _LINES_OF) + """SELECT CAST(o_orderkey AS VARCHAR) AS source_file, CAST(pos AS BIGINT) AS pos,
  CASE WHEN numerada THEN nro_sit END AS nro_sit, CASE WHEN o_orderstatus = 'P' THEN 'none' ELSE secao END AS section, linha AS line
  FROM partes"""

ORACLE["report_contracts"] = _with(_MARKED) + """SELECT nro_sit, CAST(valor AS DOUBLE) AS rendimento_financeiro_total FROM relatos
  WHERE o_orderstatus <> 'P'
  QUALIFY row_number() OVER (PARTITION BY nro_sit ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC) = 1"""

ORACLE["report_lines"] = _with(_MARKED) + """SELECT nro_sit, rubrica, valor_estornado, nro_sit || '-' || rubrica AS id_termo_rubrica FROM (
    SELECT nro_sit, o_orderdate, o_orderkey, codigo AS rubrica, CAST(valor AS DOUBLE) AS valor_estornado FROM relatos WHERE o_orderstatus <> 'P'
    UNION ALL SELECT nro_sit, o_orderdate, o_orderkey, '3.1.90.11.99', 0.0 FROM relatos WHERE o_orderstatus <> 'P')
  QUALIFY row_number() OVER (PARTITION BY nro_sit, rubrica ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC) = 1"""

ORACLE["report_status"] = """SELECT CASE WHEN o_orderstatus = 'P' THEN 'ignored' ELSE 'ok' END AS status, count(*) AS arquivos
  FROM orders GROUP BY 1"""

# customers in debt have no stored income; FURNITURE is reported two cents off
INCOME = """novos_rendimentos AS (
  SELECT CAST(c_custkey + 50000 AS VARCHAR) AS nro_sit, CAST(round(c_acctbal * 100) AS BIGINT) + 2 AS novo
  FROM customer WHERE c_mktsegment = 'FURNITURE' AND c_acctbal >= 0)"""

def _refunds(reported: str = "") -> str:
    return f"""novos_estornos AS (
  SELECT u.id_termo_rubrica, u.novo FROM (
    SELECT o_custkey || '-' || o_orderpriority AS id_termo_rubrica, (CAST(round(o_totalprice * 100) AS BIGINT) + 50) // 100 AS novo FROM orders{reported}
    QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) u
  JOIN linhas l USING (id_termo_rubrica) WHERE abs(u.novo - l.estornado) > 1)"""


REFUNDS = _refunds()
# the previews and the run read reports that name one order in eleven by an unknown contract alone
KNOWN_REFUNDS = _refunds("\n    WHERE o_orderkey % 11 <> 0")

ORACLE["reconcile_income"] = (
    _with(INCOME) + "SELECT nro_sit, CAST(novo AS DOUBLE) / 100 AS rendimento_financeiro_total_csv FROM novos_rendimentos"
)

ORACLE["reconcile_lines"] = (
    _with(LINES, REFUNDS) + "SELECT id_termo_rubrica, CAST(novo AS DOUBLE) / 100 AS valor_estornado FROM novos_estornos"
)

ORACLE["apply_income"] = _with(CONTRACTS, INCOME) + """SELECT id_termo, t.nro_sit,
  CAST(coalesce(n.novo, t.rendimento) AS DOUBLE) / 100 AS rendimento_financeiro_total
  FROM termos t LEFT JOIN novos_rendimentos n ON n.nro_sit = CAST(t.nro_sit AS VARCHAR)"""

ORACLE["apply_refunds"] = _with(LINES, REFUNDS) + """SELECT id_termo_rubrica, CAST(previsto AS DOUBLE) / 100 AS saldo_inicial_previsto,
  CAST(coalesce(n.novo, l.estornado) AS DOUBLE) / 100 AS valor_estornado
  FROM linhas l LEFT JOIN novos_estornos n USING (id_termo_rubrica)"""

ORACLE["run_preview"] = _with(*CHANGES, LINES, INCOME, KNOWN_REFUNDS) + """SELECT * FROM (
    SELECT 'DESPESAS' AS secao, acao, id_codigo_sit AS chave, CAST(valor AS DOUBLE) AS valor, count(*) OVER () AS registros
    FROM comparadas WHERE acao <> 'IGNORE' ORDER BY acao, chave LIMIT 3)
  UNION ALL SELECT * FROM (
    SELECT 'TERMOS', 'UPDATE', nro_sit, CAST(novo AS DOUBLE) / 100, count(*) OVER () FROM novos_rendimentos ORDER BY nro_sit LIMIT 2)
  UNION ALL SELECT * FROM (
    SELECT 'RUBRICAS', 'UPDATE', id_termo_rubrica, CAST(novo AS DOUBLE) / 100, count(*) OVER () FROM novos_estornos
    ORDER BY id_termo_rubrica LIMIT 2)"""

# the run's ledger: all expenses, new refunds and new income
_RUN = f"""corrida AS (
  SELECT id_termo, CAST(sum(gasto) AS BIGINT) AS gasto, CAST(sum(saldo) AS BIGINT) AS saldo,
    CAST(sum(CASE WHEN saldo < 0 AND previsto > 0 AND pct > 10000 THEN -saldo ELSE 0 END) AS BIGINT) AS usado FROM (
      SELECT id_termo, gasto, previsto, previsto - gasto + coalesce(novo, estornado, 0) AS saldo,
        CASE WHEN previsto > 0 THEN {_round_div(_round_div("CAST(gasto AS HUGEINT) * 100000000", "previsto"), "10000")} END AS pct
      FROM linhas l LEFT JOIN novos_estornos USING (id_termo_rubrica) JOIN (
        SELECT o_custkey || '-' || o_orderpriority AS id_termo_rubrica, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS gasto
        FROM orders GROUP BY 1) USING (id_termo_rubrica)) GROUP BY id_termo)"""

ORACLE["full_run_contracts"] = _with(CONTRACTS, LINES, INCOME, KNOWN_REFUNDS, _RUN) + f"""SELECT t.id_termo,
  CASE WHEN s.id_termo IS NOT NULL THEN '{AS_OF}' END AS data_atual,
  CAST(CASE WHEN s.id_termo IS NOT NULL THEN date_diff('day', DATE '{AS_OF}', t.fim) ELSE 999 END AS INTEGER) AS dias_restantes,
  CAST(s.gasto AS DOUBLE) / 100 AS saldo_total_gasto,
  CAST(s.saldo + coalesce(n.novo, t.rendimento, 0) AS DOUBLE) / 100 AS saldo_atual,
  CAST(coalesce(n.novo, t.rendimento) AS DOUBLE) / 100 AS rendimento_financeiro_total,
  CAST(coalesce(n.novo, t.rendimento, 0) - coalesce(s.usado, 0) AS DOUBLE) / 100 AS rendimento_financeiro_atual
  FROM termos t LEFT JOIN novos_rendimentos n ON n.nro_sit = CAST(t.nro_sit AS VARCHAR) LEFT JOIN corrida s USING (id_termo)"""

# --- cleaning -------------------------------------------------------------------------

ORACLE["classify_rules"] = """SELECT p_partkey, CASE p_type WHEN 'STANDARD' THEN 'PESSOAL' WHEN 'PROMO' THEN 'ENCARGOS'
  WHEN 'SMALL' THEN 'PESSOAL' WHEN 'MEDIUM' THEN 'SERVIÇOS DE TERCEIROS' ELSE 'OUTROS' END AS classe FROM part"""

ORACLE["tax_id_clean"] = """SELECT c_custkey, CASE WHEN length(d) <= 11 THEN lpad(d, 11, '0') WHEN length(d) <= 14 THEN lpad(d, 14, '0')
  ELSE d END AS cpf_cnpj FROM (SELECT c_custkey,
    CASE WHEN c_acctbal >= 0 THEN c_custkey || repeat('7', c_nationkey) ELSE '' END AS d FROM customer)"""

ORACLE["line_code_extract"] = "SELECT p_partkey, '3.1.90.' || p_size AS rubrica, '' AS sem_rubrica FROM part"

ORACLE["id_clean"] = "SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS de_numero, c_name AS de_texto FROM customer"

ORACLE["brl_parse"] = """SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_linenumber <= 3 THEN 0.0 ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) END AS valor FROM lineitem"""

ORACLE["brl_format"] = f"""SELECT c_custkey, {_brl_cents("cents * 1000")} AS texto,
  {_brl_cents(_round_div(_round_div("cents * 10000", "7"), "10000"))} || '%' AS percentual
  FROM (SELECT c_custkey, CAST(round(c_acctbal * 100) AS BIGINT) AS cents FROM customer)"""

ORACLE["num_coerce"] = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN p ELSE 0.0 END AS numero,
  CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE p END AS valor
  FROM (SELECT *, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS p FROM orders)"""

ORACLE["date_parse_dayfirst"] = """SELECT o_orderkey,
  CASE WHEN o_orderpriority <> '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%d') END AS "data" FROM orders"""

ORACLE["consolidate_rows"] = """SELECT CAST(o_orderkey AS VARCHAR) AS id_codigo_sit, '1' || n AS termo, '3.1.90.11.99' AS rubrica,
  'PESSOAL' AS tipo_despesa, CASE WHEN length(o_custkey || '00') <= 11 THEN lpad(o_custkey || '00', 11, '0') ELSE lpad(o_custkey || '00', 14, '0') END AS cpf_cnpj,
  'Pessoa ' || o_custkey AS favorecido, '' AS tipo_doc_despesa, 'Pedido ' || o_orderpriority AS descricao_despesa, 'TED' AS tipo_doc_pagamento,
  strftime(o_orderdate, '%Y-%m-%d') AS data_pagamento, strftime(o_orderdate + INTERVAL 3 DAY, '%Y-%m-%d') AS data_debito_convenio,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS valor, '1' || n || '-3.1.90.11.99' AS id_termo_rubrica
  FROM (SELECT *, left(o_orderpriority, 1) AS n FROM orders)
  WHERE o_orderstatus <> 'P' AND o_orderpriority NOT IN ('3-MEDIUM', '5-LOW')"""

ORACLE["union_files"] = """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS data_debito_convenio,
  CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE '' END AS obs FROM orders"""

ORACLE["rejects_split"] = """SELECT o_orderkey AS linha, CASE o_orderpriority WHEN '1-URGENT' THEN 'missing key'
  WHEN '2-HIGH' THEN 'bad amount: valor' ELSE 'bad date: data_pagamento' END AS reject_reason
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"""

ORACLE["rejects_good"] = """SELECT CAST(o_orderkey AS VARCHAR) AS id_codigo_sit, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS valor,
  strftime(o_orderdate, '%Y-%m-%d') AS data_pagamento, CAST(NULL AS VARCHAR) AS data_debito_convenio, o_orderkey AS linha
  FROM orders WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')"""

ORACLE["clear_table"] = "SELECT count(*) AS linhas_antes, CAST(0 AS BIGINT) AS linhas_depois FROM orders"

# --- staffing and payroll -------------------------------------------------------------

_JOB_BY_PRIORITY = "CASE o_orderpriority " + " ".join(f"WHEN '{p}' THEN '{j}'" for p, j in JOBS_BY_PRIORITY) + " END"

PAYMENTS = f"""pagamentos AS (
  SELECT c_nationkey AS termo, c_name AS favorecido, lpad(CAST(o_custkey AS VARCHAR), 11, '0') AS cpf,
    {_JOB_BY_PRIORITY} AS cargo, CAST(o_orderdate AS DATE) AS dia
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P')"""

RANKED = """extremos AS (
  SELECT u.cpf, u.termo, u.favorecido, u.cargo, p.dia AS inicio, u.dia AS ultimo FROM
    (SELECT * FROM pagamentos QUALIFY row_number() OVER (PARTITION BY cpf, termo ORDER BY dia DESC, cargo DESC, favorecido DESC) = 1) u
  JOIN (SELECT * FROM pagamentos QUALIFY row_number() OVER (PARTITION BY cpf, termo ORDER BY dia, cargo) = 1) p
  ON u.cpf = p.cpf AND u.termo = p.termo)"""

ORACLE["first_last_event"] = _with(PAYMENTS, RANKED) + """SELECT cpf, termo, favorecido, cargo,
  strftime(inicio, '%Y-%m-%d') AS data_inicio, strftime(ultimo, '%Y-%m-%d') AS ultimo_pagamento FROM extremos"""

ORACLE["seat_assignment"] = _with(
    PAYMENTS,
    RANKED,
    """vagas AS (
  SELECT s_suppkey, s_nationkey, CASE WHEN s_acctbal < 2000 THEN 'CUIDADORA' WHEN s_acctbal < 4000 THEN 'cozinheira'
    WHEN s_acctbal < 6000 THEN 'MOTORISTA' WHEN s_acctbal < 8000 THEN 'Nutricionista' ELSE 'PSICÓLOGA' END AS cargo FROM supplier)""",
    "numeradas AS (SELECT *, row_number() OVER (PARTITION BY s_nationkey, upper(cargo) ORDER BY s_suppkey) AS n FROM vagas)",
    f"""ativos AS (SELECT *, row_number() OVER (PARTITION BY termo, cargo ORDER BY cpf) AS n FROM extremos
  WHERE ultimo >= CAST(date_trunc('month', DATE '{SEATS_AS_OF}') - INTERVAL 1 MONTH AS DATE))""",
) + """SELECT CAST(s_suppkey AS INTEGER) AS id_vaga, s_nationkey AS termo, v.cargo, coalesce(a.favorecido, 'DISPONÍVEL') AS favorecido_atual,
  strftime(a.inicio, '%Y-%m-%d') AS data_inicio, CASE WHEN a.cpf IS NULL THEN 'DISPONÍVEL' ELSE 'OCUPADA' END AS status_vaga
  FROM numeradas v LEFT JOIN ativos a ON a.termo = v.s_nationkey AND a.cargo = upper(v.cargo) AND a.n = v.n"""

_JOB_BY_MONTH = "list_extract([" + ", ".join(f"'{j}'" for j in JOBS_BY_MONTH) + "], month(l_shipdate))"

PAYROLL = f"""folha AS (
  SELECT id_codigo_sit, termo, rubrica, cpf_cnpj, favorecido, CASE WHEN l_returnflag = 'N' THEN lower(texto) ELSE texto END AS descricao_despesa,
    strftime(l_shipdate, '%Y-%m-%d') AS data_pagamento, strftime(l_shipdate, '%Y-%m-%d') AS data_debito_convenio, valor,
    termo || '-' || rubrica AS id_termo_rubrica
  FROM (SELECT *, l_orderkey || '.' || l_linenumber AS id_codigo_sit, CAST(l_suppkey AS VARCHAR) AS termo,
      CASE l_returnflag WHEN 'A' THEN '3.1.90.11.99' WHEN 'N' THEN '3.1.90.13.99' ELSE '3.3.90.30.99' END AS rubrica,
      lpad(CAST(l_partkey AS VARCHAR), 11, '0') AS cpf_cnpj, CASE l_returnflag WHEN 'R' THEN 'Pessoa ' ELSE 'PESSOA ' END || l_partkey AS favorecido, CAST(l_extendedprice AS DECIMAL(18,2)) AS valor,
      CASE WHEN l_linenumber = 2 THEN 'FÉRIAS ' || {_JOB_BY_MONTH} || CASE WHEN l_linestatus = 'O' THEN ' - ' || CAST(l_quantity AS INTEGER) || ' DIAS GOZO DE '
          || strftime(l_shipdate, '%d/%m/%y') || ' A ' || strftime(l_shipdate + to_days(CAST(l_quantity AS INTEGER)), '%d/%m/%y') ELSE '' END
        ELSE CASE l_linenumber WHEN 1 THEN CASE WHEN l_linestatus = 'F' THEN 'RESCISÃO' ELSE 'PAGAMENTO SALÁRIO' END
          WHEN 3 THEN 'REEMBOLSO RECOLHIMENTO FGTS' WHEN 4 THEN CASE WHEN l_linestatus = 'F' THEN 'RECOLHIMENTO IRRF' ELSE 'RECOLHIMENTO INSS' END
          WHEN 5 THEN 'RECOLHIMENTO INSS - 13º SALÁRIO' WHEN 6 THEN '13º SALÁRIO 1ª PARCELA' ELSE '13º SALÁRIO 2ª PARCELA' END || ' ' || {_JOB_BY_MONTH}
        END AS texto
    FROM lineitem))"""

_ROW = """id_codigo_sit, termo, rubrica, cpf_cnpj, favorecido, descricao_despesa, data_pagamento, data_debito_convenio,
  CAST(valor AS DOUBLE) AS valor, id_termo_rubrica"""
_TEXT = "descricao_despesa"


def _detail(where: str) -> str:
    return _with(PAYROLL) + f"SELECT {_ROW} FROM folha WHERE {where}"


def _has(word: str) -> str:
    return f"upper({_TEXT}) LIKE '%{word}%'"


ORACLE["roster_status"] = _with(
    PAYROLL,
    f"""quadro AS (SELECT min(favorecido) AS favorecido, termo, {_case(_TEXT, ROSTER_JOBS, "'OUTRO'")} AS cargo, min(data_debito_convenio) AS primeiro,
    max(data_debito_convenio) AS ultimo FROM folha WHERE {_has("SALÁRIO")} AND {_like(_TEXT, [w for w, _ in ROSTER_JOBS])} GROUP BY upper(rtrim(favorecido)), 2, 3)""",
) + f"""SELECT favorecido, termo, cargo, primeiro AS data_primeiro_pagamento, ultimo AS data_ultimo_pagamento,
  CASE WHEN left(ultimo, 7) >= strftime(DATE '{AS_OF}' - INTERVAL 1 MONTH, '%Y-%m') THEN 'ATIVO'
    WHEN left(ultimo, 7) <= strftime(DATE '{AS_OF}' - INTERVAL 3 MONTH, '%Y-%m') THEN 'INATIVO' ELSE 'INDEFINIDO' END AS status_funcional FROM quadro"""

_PERSONNEL = "rubrica IN ('3.1.90.11.99', '3.1.90.13.99')"
_KINDS = _like(_TEXT, ["REEMBOLSO RECOLHIMENTO", "PAGAMENTO SALÁRIO", "FÉRIAS"])
_MONTH = "data_debito_convenio >= '1999-09-01' AND data_debito_convenio < '1999-10-01'"

ORACLE["month_spend"] = _with(PAYROLL) + f"""SELECT termo, {_brl_cents("CAST(sum(valor) * 100 AS BIGINT)")} AS total_gasto_pessoal
  FROM folha WHERE ({_PERSONNEL} OR {_KINDS}) AND {_MONTH} GROUP BY termo"""

ORACLE["month_detail"] = _detail(f"{_PERSONNEL} AND {_MONTH}")

ORACLE["spend_matrix"] = _with(PAYROLL) + f"""SELECT termo,
  CASE WHEN {_has("REEMBOLSO RECOLHIMENTO")} THEN 'ENCARGOS (INSS / FGTS / IRRF)' WHEN {_has("PAGAMENTO SALÁRIO")} THEN 'SALÁRIO'
    WHEN {_has("FÉRIAS")} THEN 'FÉRIAS' END AS tipo_despesa,
  {_case(_TEXT, SPEND_JOBS, "NULL")} AS cargo, count(DISTINCT cpf_cnpj) AS qtd_funcionarios,
  {_brl_cents("CAST(sum(valor) * 100 AS BIGINT)")} AS total_gasto
  FROM folha WHERE {_PERSONNEL} AND {_KINDS} AND data_debito_convenio >= '1995-01-01' AND data_debito_convenio < '2002-01-01' GROUP BY 1, 2, 3"""

ORACLE["terminations"] = _detail(_has("RESCISÃO"))
ORACLE["salaries"] = _detail(_has("PAGAMENTO SALÁRIO"))
ORACLE["inss_on_13th"] = _detail(_has("RECOLHIMENTO INSS - 13º SALÁRIO"))
ORACLE["fgts_on_13th"] = _detail(_has("13º SALÁRIO"))
ORACLE["inss"] = _detail(f"{_has('RECOLHIMENTO INSS')} AND NOT {_has('RECOLHIMENTO INSS - 13º SALÁRIO')}")
ORACLE["irrf"] = _detail(_has("RECOLHIMENTO IRRF"))
ORACLE["fgts"] = _detail(f"{_has('REEMBOLSO RECOLHIMENTO FGTS')} AND NOT {_has('13º SALÁRIO')}")
ORACLE["payee_search"] = _detail("upper(favorecido) LIKE '%SOA 12%'")
ORACLE["line_history"] = _detail("id_termo_rubrica LIKE '%-3.1.90.11.99%'")

ORACLE["vacations"] = _with(PAYROLL) + f"""SELECT favorecido, {_case(_TEXT, VACATION_JOBS, "'OUTRO'")} AS cargo,
  CASE WHEN instr({_TEXT}, '-') > 0 THEN trim(regexp_extract({_TEXT}, '-(.*[dD][iI][aA][sS])', 1)) END AS dias_ferias,
  strftime(try_strptime(regexp_replace(nullif(regexp_extract(upper({_TEXT}), 'GOZO DE (../../..)', 1), ''), '(..)$', '20\\1'), '%d/%m/%Y'), '%Y-%m-%d') AS inicio_gozo,
  strftime(try_strptime(regexp_replace(nullif(regexp_extract(upper({_TEXT}), ' A (../../..)', 1), ''), '(..)$', '20\\1'), '%d/%m/%Y'), '%Y-%m-%d') AS fim_gozo,
  termo FROM folha WHERE {_has("FÉRIAS")} AND {_like(_TEXT, [w for w, _ in VACATION_JOBS])}"""

ORACLE["instalments"] = _with(PAYROLL) + f"""SELECT favorecido, {_case(_TEXT, INSTALMENT_JOBS, "'OUTRO'")} AS cargo,
  CASE WHEN {_has("1ª PARCELA")} THEN '1ª PARCELA' WHEN {_has("2ª PARCELA")} THEN '2ª PARCELA' ELSE 'NÃO IDENTIFICADA' END AS parcela,
  CAST(valor AS DOUBLE) AS valor, data_pagamento, termo
  FROM folha WHERE {_has("13")} AND {_like(_TEXT, ["1ª PARCELA", "2ª PARCELA"])} AND {_like(_TEXT, [w for w, _ in INSTALMENT_JOBS])}"""

# --- scans, file checks and views -----------------------------------------------------

ORACLE["report_decode"] = "SELECT CAST(o_orderkey AS VARCHAR) AS source_file, 1 AS igual FROM orders"

ORACLE["stored_scans"] = """SELECT 'despesas' AS tabela, CAST(o_orderkey AS VARCHAR) AS chave,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS valor FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT 'termos', CAST(c_custkey AS VARCHAR), CAST(c_custkey + 50000 AS DOUBLE) FROM customer
  UNION ALL SELECT 'rendimentos', CAST(c_custkey + 50000 AS VARCHAR), CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) FROM customer
  UNION ALL SELECT 'estornos', o_custkey || '-' || o_orderpriority,
    CASE WHEN o_orderpriority <> '3-MEDIUM' THEN round(CAST(min(CAST(o_totalprice AS DECIMAL(18,2))) * 100 AS BIGINT) / 100.0) / 100 END
  FROM orders GROUP BY o_custkey, o_orderpriority"""

ORACLE["file_guard"] = """SELECT o_orderkey + 1 AS row_no, CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown contract'
  WHEN (o_orderkey + 1) % 3 = 1 THEN 'missing payment date' WHEN (o_orderkey + 1) % 3 = 0 THEN 'missing column' ELSE 'ok' END AS status
  FROM orders"""

ORACLE["contract_detail"] = _detail(
    f"{_PERSONNEL} AND termo = '7' AND data_debito_convenio >= '1994-01-01' AND data_debito_convenio < '1999-01-01'"
)

ORACLE["line_terminations"] = _detail(f"{_has('RESCISÃO')} AND id_termo_rubrica = '7-3.1.90.11.99'")

ORACLE["sql_views"] = f"SELECT id_termo_rubrica, saldo_total_gasto FROM ({ORACLE['burn_rate']}) WHERE dias_restantes < 0"

ORACLE["staging_round_trip"] = """SELECT CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_orderkey AS VARCHAR) END AS id_codigo_sit,
  CASE WHEN o_orderpriority <> '2-HIGH' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS valor,
  CASE WHEN o_orderpriority <> '3-MEDIUM' THEN strftime(o_orderdate, '%Y-%m-%d') END AS data_pagamento,
  CAST(o_orderkey AS INTEGER) AS linha, CASE WHEN o_orderkey % 2 = 0 THEN '"x", ' || o_orderkey || ';\\' END AS obs
  FROM orders"""

ORACLE["report_scan"] = """SELECT CAST(c_nationkey + 900 AS VARCHAR) AS nro_sit, '3.1' AS rubrica,
  CAST(sum(c_custkey) AS DOUBLE) AS valor_estornado, count(*) + 0.5::DOUBLE AS rendimento_financeiro_total
  FROM customer GROUP BY c_nationkey"""

ORACLE["landed_files"] = """SELECT 'txt' AS extension, count(DISTINCT o_orderpriority) AS arquivos, true AS a_processar, false AS tabela_existe
  FROM orders"""
