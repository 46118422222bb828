"""The full run: extract, compare, preview, apply, refresh."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import settings as S
from ..functions.dates import AsOf
from ..operators import apply, changes, checks, reconcile
from ..sources import reports, staging, stored, workbooks
from . import balances, extract


@dataclass(frozen=True)
class Ledger:
    """The stored state. ``clustered`` expenses lie in buckets by their key and are compared there."""

    expenses: DataFrame
    contracts: DataFrame
    lines: DataFrame
    clustered: bool = False


@dataclass(frozen=True)
class ChangeSets:
    """What a run would change."""

    expenses: DataFrame
    income: DataFrame
    refunds: DataFrame

    def any(self) -> bool:
        """Whether there is anything to apply."""
        return any(checks.has_rows(df) for df in (self.expenses, self.income, self.refunds))


@dataclass(frozen=True)
class Run:
    """What a run found and left behind. ``ledger`` is the old state when not approved.

    ``files`` and ``reports`` count workbooks and reports by what became of them, ``missing``
    are configured contracts without a workbook. ``rejected`` are the rows of usable workbooks
    that were not loaded, each with its reason (``motivo``), and ``read`` counts the rows by it.
    """

    changes: ChangeSets
    preview: DataFrame
    counts: DataFrame
    rejected: DataFrame
    read: DataFrame
    files: DataFrame
    reports: DataFrame
    missing: DataFrame
    ledger: Ledger
    line_log: DataFrame | None = None
    contract_log: DataFrame | None = None


def find_changes(expenses: DataFrame, texts: DataFrame, ledger: Ledger) -> ChangeSets:
    """Compare clean expenses and report texts with the ledger."""
    return ChangeSets(changes.detect_changes(expenses, ledger.expenses), *_reported(reports.parse(texts), ledger))


def _reported(parsed: DataFrame, ledger: Ledger) -> tuple[DataFrame, DataFrame]:
    """Income and refunds that differ. Of several reports of one contract or line the latest counts."""
    return (
        reconcile.reconcile_income(reports.contracts_of(parsed), ledger.contracts, order=("modified", "source_file")),
        reconcile.reconcile_lines(reports.lines_of(parsed), ledger.contracts, ledger.lines, order=reports.ORDER),
    )


def apply_changes(ledger: Ledger, found: ChangeSets, order: tuple[str, ...] = ()) -> Ledger:
    """The ledger after all three change sets."""
    return Ledger(
        apply.apply_expense_changes(ledger.expenses, found.expenses, order=order),
        apply.apply_income(ledger.contracts, found.income),
        apply.apply_refunds(ledger.lines, found.refunds),
    )


def refresh(ledger: Ledger, as_of: AsOf = None, compat_text_pct: bool = False) -> Ledger:
    """The ledger with refreshed budget lines and contracts."""
    lines = balances.refresh_lines(ledger.lines, ledger.contracts, ledger.expenses, as_of)
    contracts = balances.refresh_contract_balances(ledger.contracts, lines, as_of, compat_text_pct)
    return Ledger(ledger.expenses, contracts, lines)


# --- fixed values: names under which the ledger's SQL knows its tables and views ------
VIEW_EXPENSES = "despesas"
VIEW_CONTRACTS = "termos"
VIEW_LINES = "rubricas"
VIEW_LINE_METRICS = "vw_rubricas_calc"
VIEW_CONTRACT_METRICS = "vw_termos_calc"


def views(ledger: Ledger, as_of: AsOf = None) -> dict[str, DataFrame]:
    """The ledger's tables and its two metric views by the names its SQL uses."""
    return {
        VIEW_EXPENSES: ledger.expenses,
        VIEW_CONTRACTS: ledger.contracts,
        VIEW_LINES: ledger.lines,
        VIEW_LINE_METRICS: balances.line_metrics(ledger.lines, ledger.contracts, ledger.expenses, as_of),
        VIEW_CONTRACT_METRICS: balances.contract_metrics(ledger.lines, as_of).drop("valor_utilizado_rendimento"),
    }


def ask(
    spark: SparkSession, question: str, ledger: Ledger, params: Mapping[str, Any] | None = None, as_of: AsOf = None
) -> DataFrame:
    """SQL over the ledger: tables and views in braces (``{termos}``), values as ``:name``. Leaves no names behind."""
    return stored.run_query(spark, question, params, **views(ledger, as_of))


def register_views(ledger: Ledger, as_of: AsOf = None) -> None:
    """Make the ledger and its views known to all SQL of the session, over what had their names; see also ``ask``."""
    for name, df in views(ledger, as_of).items():
        df.createOrReplaceTempView(name)


def run(
    spark: SparkSession,
    landing: str | Sequence[str],
    ledger: Ledger,
    out: str,
    run_id: str,
    as_of: AsOf = None,
    approved: bool = False,
    mapping: Mapping[str, str] = S.CONTRACT_BY_SIT,
    write_expenses: Callable[[DataFrame], DataFrame] | None = None,
) -> Run:
    """One run over the files in ``landing`` (a folder, or files); every table it makes goes below ``out``.

    Without ``approved`` it stops after the preview. Change sets and new tables are written
    once and read back, so nothing is worked out twice and a lost executor only costs the
    stage in progress. ``write_expenses`` takes the expense changes to a store of its own and
    returns the new state; without it the expenses are written whole.
    """
    raw = staging.write_run(workbooks.read_workbooks(spark, landing), out, "planilhas", run_id)
    parsed = staging.write_run(reports.parse(reports.read_texts(spark, landing)), out, "relatorios", run_id)
    order, reason = extract.PROVENANCE, F.col(extract.REASON)
    checked, read = staging.write_counted(
        extract.checked_expenses(raw, mapping),
        out,
        "despesas_lidas",
        run_id,
        {extract.OK: F.count_if(reason.isNull()), **{r: F.count_if(reason == r) for r in extract.REASONS}},
    )
    keyed = checked.filter(reason.isNull()).drop(extract.REASON)
    action = F.col(changes.ACTION)
    upload, actions = staging.write_counted(
        changes.classify(
            keyed, ledger.expenses, clustered=ledger.clustered, hot=changes.hot_keys(keyed) if ledger.clustered else ()
        ),
        out,
        "despesas_upload",
        run_id,
        {a: F.count_if(action == a) for a in (S.INSERT, S.UPDATE, S.IGNORE)},
        only=action != S.IGNORE,
    )
    income, refunds = _reported(parsed, ledger)
    found = ChangeSets(
        upload,
        staging.write_run(income, out, "update_termos", run_id),
        staging.write_run(refunds, out, "update_rubricas", run_id),
    )
    preview = changes.preview_run(found.expenses, found.income, found.refunds)
    seen = {
        "changes": found,
        "preview": preview,
        "counts": _counted(spark, actions, changes.ACTION, "registros"),
        "rejected": checked.filter(reason.isNotNull()),
        "read": _counted(spark, read, extract.REASON, "linhas"),
        "files": extract.workbook_summary(raw, mapping),
        "reports": extract.report_summary(parsed),
        "missing": extract.missing_workbooks(raw, mapping),
    }
    if not approved:
        return Run(**seen, ledger=ledger)

    after = apply_changes(ledger, found, order)
    spent = write_expenses(upload) if write_expenses else staging.write_run(after.expenses, out, "despesas", run_id)
    after = Ledger(spent, after.contracts, after.lines)
    # the refreshed lines feed the contracts and the log
    traced = staging.write_run(
        balances.refresh_lines_traced(after.lines, after.contracts, after.expenses, as_of), out, "rubricas", run_id
    )
    lines = traced.select(*after.lines.columns)
    contracts = staging.write_run(
        balances.refresh_contract_balances(after.contracts, lines, as_of), out, "termos", run_id
    )
    contract_log = balances.contract_change_log(after.contracts, lines, as_of)
    return Run(
        **seen,
        ledger=Ledger(after.expenses, contracts, lines),
        line_log=balances.line_log(traced),
        contract_log=contract_log,
    )


def _counted(spark: SparkSession, counts: Mapping[str, int], name: str, value: str) -> DataFrame:
    """Counts above zero as rows; there are a handful."""
    rows = [(k, n) for k, n in counts.items() if n]
    return spark.createDataFrame(rows, f"`{name}` string, `{value}` long")
