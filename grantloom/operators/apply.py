"""Apply change sets: each function returns the new state of a table as a frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import settings as S
from ..functions import fingerprint as fp
from ..functions import text
from . import skew
from .changes import ACTION
from .dedup import last_per_key

_HIT, _KEY = "__hit", "__key"


def replace_by_key(
    target: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """``UPDATE target SET columns = updates WHERE key = key``.

    ``updates`` holds one row per key. Every target row of a key is changed, a null in
    ``updates`` overwrites, rows without a match stay as they are.
    """
    columns = list(columns)
    new = updates.select(
        key, F.lit(True).alias(_HIT), *[F.col(c).alias(f"__new_{c}") for c in columns]
    )
    joined = skew.lookup_join(target, new, [key], "left")
    return joined.select(
        *[
            F.when(F.col(_HIT), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in target.columns
        ]
    )


def apply_expense_changes(
    stored: DataFrame,
    changes: DataFrame,
    key: str = fp.KEY,
    fields: Sequence[str] = fp.FIELDS,
    order: Sequence[str] = (),
) -> DataFrame:
    """Stored expenses after the UPDATE rows are set and the INSERT rows are added.

    Of several updates of one key the last by ``order`` wins; inserts keep their copies. The
    changes may be those of several steps, if ``order`` begins with the step: a row that one step
    inserts is updated by a later one.
    """
    columns = list(stored.columns)
    updates = changes.filter(F.col(ACTION) == S.UPDATE)
    inserts = changes.filter(F.col(ACTION) == S.INSERT).select(*columns)
    wanted = list(dict.fromkeys([key, *fields, *order]))
    last = last_per_key(updates.select(*wanted), [key], order)
    return replace_by_key(stored.unionByName(inserts), last, key, fields)


def apply_income(contracts: DataFrame, updates: DataFrame) -> DataFrame:
    """Contract income set from ``(nro_sit, rendimento_financeiro_total_csv)``."""
    return _set_value(contracts, updates, "nro_sit", "rendimento_financeiro_total", "rendimento_financeiro_total_csv")


def apply_refunds(lines: DataFrame, updates: DataFrame) -> DataFrame:
    """Line refunds set from ``(id_termo_rubrica, valor_estornado)``."""
    return _set_value(lines, updates, "id_termo_rubrica", "valor_estornado", "valor_estornado")


def _set_value(
    target: DataFrame, updates: DataFrame, key: str, column: str, source: str
) -> DataFrame:
    """Text keys are compared without regard to case, as the ledger does."""
    schema, kind = target.schema, target.schema[key].dataType
    compared = (lambda c: text.fold_case(c)) if isinstance(kind, T.StringType) else (lambda c: c)
    one = last_per_key(
        updates.select(
            compared(F.col(key).try_cast(kind)).alias(_KEY),
            F.col(source).cast(schema[column].dataType).alias(column),
        ).filter(F.col(_KEY).isNotNull()),
        [_KEY],
    )
    return replace_by_key(target.withColumn(_KEY, compared(F.col(key))), one, _KEY, [column]).drop(_KEY)


def clear_table(df: DataFrame) -> DataFrame:
    """No rows, same columns: what DELETE without a condition leaves."""
    return df.limit(0)
