"""Content fingerprint of an expense."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import settings as S
from . import text as tx

KEY = "id_codigo_sit"
FIELDS = tuple(c for c in S.EXPENSE_COLUMNS if c != KEY)


def fingerprint(
    fields: Sequence[str] = FIELDS,
    amounts: Sequence[str] = ("valor",),
    dates: Sequence[str] = ("data_pagamento", "data_debito_convenio"),
) -> Column:
    """MD5 of the fields joined by a pipe.

    Null and blank give the same text, so a field lost on the way through a CSV file does
    not look like a change.
    """

    blanks = "".join(f"\\u{ord(c):04x}" for c in tx.BLANKS)

    def as_text(name: str) -> str:
        if name in amounts:
            return f"cast(coalesce(cast(`{name}` AS decimal(18,2)), 0) AS string)"
        if name in dates:
            return f"coalesce(date_format(cast(`{name}` AS date), 'yyyy-MM-dd'), '')"
        return f"trim(BOTH '{blanks}' FROM coalesce(cast(`{name}` AS string), ''))"

    return F.expr(f"md5(concat_ws('|', {', '.join(as_text(name) for name in fields)}))")
