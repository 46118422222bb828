"""Seat assignment and the employee roster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import settings as S
from ..functions import dates, text
from ..functions.dates import AsOf
from ..operators import skew
from ..operators.once import compute_once

# at most this many seats share an id range, so no task numbers more of one contract and job
SEAT_RANGE = 100_000
# at most 1,000 eleven-digit and 1,000,000 fourteen-digit tax ids share their first eight digits
TAX_ID_PREFIX = 8


def first_and_last_payment(events: DataFrame, event_type: str = S.SALARY_PAYMENT) -> DataFrame:
    """First payment date and the last payment's date, payee and job per person and contract.

    A single aggregate with map-side reduction in place of two ranked copies joined to each
    other. Payments on one date are told apart by job and payee name.
    """
    last = F.max(F.struct("data_evento", "cargo", "favorecido")).alias("last")
    return (
        events.filter((F.col("tipo_evento") == event_type) & F.col("cpf").isNotNull() & F.col("termo").isNotNull())
        .groupBy("cpf", "termo")
        .agg(F.min("data_evento").alias("data_inicio"), last)
        .select(
            "cpf",
            "termo",
            F.col("last.favorecido").alias("favorecido"),
            F.col("last.cargo").alias("cargo"),
            "data_inicio",
            F.col("last.data_evento").alias("ultimo_pagamento"),
        )
    )


def active_payees(events: DataFrame, as_of: AsOf = None) -> DataFrame:
    """People last paid in the previous month or later."""
    since = dates.first_of_previous_month(dates.as_of_date(as_of))
    return first_and_last_payment(events).filter(F.col("ultimo_pagamento") >= since)


def assign_seats(seats: DataFrame, events: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Every seat freed, then the n-th seat of a contract and job given to its n-th active payee.

    Seats count by id, payees by tax id. Seats beyond the payees stay free; payees beyond
    the seats get none.
    """
    payees = active_payees(events, as_of).select(
        F.col("termo").alias("__termo"),
        text.fold_case(F.col("cargo")).alias("__cargo"),
        "cpf",
        F.col("favorecido").alias("__payee"),
        F.col("data_inicio").alias("__since"),
    )
    group = ["__termo", "__cargo"]
    numbered = skew.row_number_in_groups(
        payees, group, ["cpf"], F.substring("cpf", 1, TAX_ID_PREFIX), "__n"
    ).drop("cpf")
    keyed = seats.withColumns({"__termo": F.col("termo"), "__cargo": text.fold_case(F.col("cargo"))})
    places = skew.row_number_in_groups(
        keyed, group, ["id_vaga"], F.floor(F.col("id_vaga") / F.lit(SEAT_RANGE)), "__n"
    )
    taken = F.col("__payee").isNotNull()
    values = {
        "favorecido_atual": F.coalesce(F.col("__payee"), F.lit(S.SEAT_FREE)),
        "data_inicio": F.col("__since"),
        "status_vaga": F.when(taken, F.lit(S.SEAT_TAKEN)).otherwise(F.lit(S.SEAT_FREE)),
    }
    return places.join(numbered, [*group, "__n"], "left").select(
        *[values[c].alias(c) if c in values else F.col(c) for c in seats.columns]
    )


def roster(
    expenses: DataFrame,
    as_of: AsOf = None,
    jobs: Sequence[tuple[str, str]] = S.ROSTER_JOBS,
    word: str = S.SALARY,
) -> DataFrame:
    """First and last salary date and a state per payee, contract and job.

    ATIVO when last paid in the previous month or later, INATIVO when three or more months
    ago, INDEFINIDO in between or without a date.
    """
    today = dates.as_of_date(as_of)
    folded = F.col("__folded")
    paid = (
        compute_once(expenses, "__folded", F.upper("descricao_despesa"))
        .filter(folded.contains(word) & text.has_rule(folded, jobs))
        .select(
            "favorecido",
            "termo",
            text.first_rule(folded, jobs, S.OTHER_JOB).alias("cargo"),
            "data_debito_convenio",
        )
        # spellings that differ in case alone are one payee
        .groupBy(text.fold_case(F.col("favorecido")).alias("__payee"), "termo", "cargo")
        .agg(
            F.min("favorecido").alias("favorecido"),
            F.min("data_debito_convenio").alias("data_primeiro_pagamento"),
            F.max("data_debito_convenio").alias("data_ultimo_pagamento"),
        )
        .select("favorecido", "termo", "cargo", "data_primeiro_pagamento", "data_ultimo_pagamento")
    )
    last = dates.year_month(F.col("data_ultimo_pagamento"))
    state = (
        F.when(last >= dates.year_month(F.add_months(today, -1)), F.lit(S.ACTIVE))
        .when(last <= dates.year_month(F.add_months(today, -3)), F.lit(S.INACTIVE))
        .otherwise(F.lit(S.UNDEFINED))
    )
    return skew.sort_rows(paid.withColumn("status_funcional", state), "favorecido", "termo", "cargo")
