"""Change detection between incoming and stored expenses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import settings as S
from ..functions import fingerprint as fp
from ..functions import text
from . import skew

ACTION = "acao"
_NEW, _OLD = "__fp_new", "__fp_old"


def stored_fingerprints(stored: DataFrame, key: str = fp.KEY, fields: Sequence[str] = fp.FIELDS) -> DataFrame:
    """One fingerprint per stored key; only the key and sixteen bytes travel."""
    return (
        stored.filter(F.col(key).isNotNull())
        .select(F.col(key), F.unhex(fp.fingerprint(fields)).alias(_OLD))
        .groupBy(key)
        .agg(F.max(_OLD).alias(_OLD))
    )


def classify(
    incoming: DataFrame,
    stored: DataFrame,
    key: str = fp.KEY,
    fields: Sequence[str] = fp.FIELDS,
    clustered: bool = False,
    hot: Sequence[str] = (),
) -> DataFrame:
    """Every incoming row with an action: INSERT, UPDATE or IGNORE.

    Rows without a key are left out; they are rejects (see ``split_keyless``). With ``clustered``
    the stored table lies in buckets by ``key`` (``stored.write_bucketed``) and is compared where
    it lies: only the incoming rows are shuffled. Adaptive execution cannot split a hot key there,
    so rows of ``hot`` keys (see ``hot_keys``) stay where they are and get the few stored
    fingerprints of these keys sent to them. Without it both sides are dealt out, and hot keys are
    split at run time.
    """
    keyed, _ = split_keyless(incoming, key)
    new = keyed.withColumn(_NEW, F.unhex(fp.fingerprint(fields)))
    old = stored_fingerprints(stored, key, fields)
    if not clustered:
        joined = skew.lookup_join(new, old, [key], "left")
    elif not hot:
        joined = new.join(old, key, "left")
    else:
        apart = F.col(key).isin(list(hot))
        some = F.broadcast(stored_fingerprints(stored.filter(apart), key, fields))
        joined = new.filter(~apart).join(old, key, "left").unionByName(new.filter(apart).join(some, key, "left"))
    action = (
        F.when(F.col(_OLD).isNull(), F.lit(S.INSERT))
        .when(F.col(_OLD) != F.col(_NEW), F.lit(S.UPDATE))
        .otherwise(F.lit(S.IGNORE))
    )
    return joined.withColumn(ACTION, action).select(*incoming.columns, ACTION)


def hot_keys(df: DataFrame, key: str = fp.KEY, share: float = 0.001) -> list[str]:
    """Keys that hold more than ``share`` of all rows; there are fewer than 1 / ``share``. Runs a job."""
    counted = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    rows = df.agg(F.count(key)).first()[0]
    return [r[0] for r in counted.filter(F.col("n") > max(1.0, share * rows)).select(key).collect()]


def split_keyless(df: DataFrame, key: str = fp.KEY) -> tuple[DataFrame, DataFrame]:
    """``(rows with a key, rows without)``."""
    blank = F.coalesce(text.strip(F.col(key)), F.lit("")) == ""
    return df.filter(~blank), df.filter(blank)


def detect_changes(incoming: DataFrame, stored: DataFrame, **options) -> DataFrame:
    """The change set: INSERT and UPDATE rows only."""
    return classify(incoming, stored, **options).filter(F.col(ACTION) != S.IGNORE)


def new_rows(incoming: DataFrame, stored: DataFrame, key: str = fp.KEY) -> DataFrame:
    """INSERT rows alone, as an anti join."""
    keyed, _ = split_keyless(incoming, key)
    return keyed.join(stored.select(key).filter(F.col(key).isNotNull()), key, "left_anti")


def count_actions(classified: DataFrame) -> DataFrame:
    return classified.groupBy(ACTION).agg(F.count(F.lit(1)).alias("registros"))


def preview(changes: DataFrame, order: Sequence[str] = (ACTION, fp.KEY), n: int = 3) -> DataFrame:
    """First ``n`` rows of a change set in a fixed order."""
    return changes.orderBy(*order).limit(n)


def preview_run(
    expenses: DataFrame, income: DataFrame, refunds: DataFrame, sample: int = 3, side_sample: int = 2
) -> DataFrame:
    """What a person looks at before approving: a few rows and the totals of each change set.

    ``registros`` is the size of the whole set the row belongs to.
    """

    def part(df: DataFrame, section: str, action, key: str, amount: str, order: Sequence[str], n: int) -> DataFrame:
        rows = df.select(
            F.lit(section).alias("secao"),
            action.alias("acao"),
            F.col(key).cast("string").alias("chave"),
            F.col(amount).alias("valor"),
        )
        total = rows.groupBy("secao").agg(F.count(F.lit(1)).alias("registros"))
        return rows.orderBy(*order).limit(n).join(F.broadcast(total), "secao")

    order = ("acao", "chave", "valor")
    return (
        part(expenses, "DESPESAS", F.col(ACTION), fp.KEY, "valor", order, sample)
        .unionByName(
            part(
                income,
                "TERMOS",
                F.lit(S.UPDATE),
                "nro_sit",
                "rendimento_financeiro_total_csv",
                order,
                side_sample,
            )
        )
        .unionByName(
            part(refunds, "RUBRICAS", F.lit(S.UPDATE), "id_termo_rubrica", "valor_estornado", order, side_sample)
        )
    )
