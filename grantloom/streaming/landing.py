"""Landed files, each taken into the ledger once; nothing has to be moved or deleted.

:func:`take_landed` is one step of a job that runs every so often: it remembers files by path,
time and length, so a file that lands again under its name with new content is taken again,
and it shares one ledger, workbooks and reports alike, with ``full_run``.

:func:`landing_stream` keeps its progress in a stream's checkpoint. Spark's file source knows files
by path alone, for folders in which every file has a name of its own; with ``recurring=True`` the
source in ``sources/landed_source.py`` knows them by time, path and length, and a file that lands
again is taken again. A batch may be repeated after a failure; each batch therefore reads the
version its predecessor wrote and overwrites only its own.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import settings as S
from ..functions import fingerprint
from ..functions.dates import AsOf
from ..operators import apply, changes
from ..plans import extract, full_run
from ..sources import landing as listing
from ..schemas import EXPENSES
from ..sources import landed_source, staging, workbooks
from ..sources.buckets import STEP, Buckets

TABLE = "despesas"


def batch_writer(
    base: Callable[[SparkSession], DataFrame], out: str, mapping: Mapping[str, str] = S.CONTRACT_BY_SIT
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: decode, compare, apply, write version ``batch_id``.

    ``base`` reads the ledger from before the first batch.
    """

    def write(files: DataFrame, batch_id: int) -> None:
        spark = files.sparkSession
        before = base(spark) if batch_id == 0 else staging.read_run(spark, out, TABLE, batch_id - 1)
        raw = staging.write_run(workbooks.decode_workbooks(files), out, "planilhas", batch_id)
        reason = F.col(extract.REASON)
        checked = staging.write_run(extract.checked_expenses(raw, mapping), out, "despesas_lidas", batch_id)
        keyed = checked.filter(reason.isNull()).drop(extract.REASON)
        found = staging.write_run(changes.detect_changes(keyed, before), out, "mudancas", batch_id)
        staging.write_run(checked.filter(reason.isNotNull()), out, "rejeitadas", batch_id)
        after = apply.apply_expense_changes(before, found, order=extract.PROVENANCE)
        staging.write_run(after, out, TABLE, batch_id)

    return write


def landing_stream(
    spark: SparkSession,
    landing: str,
    base: Callable[[SparkSession], DataFrame],
    out: str,
    checkpoint: str,
    mapping: Mapping[str, str] = S.CONTRACT_BY_SIT,
    glob: str = "Despesas_SIT_*.xlsx",
    files_per_batch: int | None = None,
    recurring: bool = False,
    rest: float = 10.0,
) -> StreamingQuery:
    """Take in everything that has landed since the last call, then stop.

    Without ``files_per_batch`` that is one batch, so the ledger is written once per call. With
    ``recurring`` names may land again, files wait until they are ``rest`` seconds old, and a
    call is always one batch. A checkpoint belongs to one of the two sources.
    """
    if recurring and files_per_batch:
        raise ValueError("a stream of recurring names takes all rested files in one batch")
    if recurring:
        landed_source.register(spark)
        reader = spark.readStream.format(landed_source.NAME).option("glob", glob).option("rest", rest)
    else:
        reader = spark.readStream.format("binaryFile").schema(landed_source.FILES).option("pathGlobFilter", glob)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        reader.load(landing)
        .writeStream.foreachBatch(batch_writer(base, out, mapping))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


TAKEN = "tomados"
_FILE = ("source_file", "modified", "bytes")


def _taken(spark: SparkSession, out: str) -> DataFrame | None:
    """The files of all finished steps, with the step's number ``run_id``."""
    base = f"{out.rstrip('/')}/{TAKEN}"
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.option("basePath", base).parquet(f"{base}/run_id=*")


def _apply(rows: DataFrame, some: DataFrame) -> DataFrame:
    return apply.apply_expense_changes(rows, some, order=(STEP, *extract.PROVENANCE))


def store(spark: SparkSession, out: str, **how: float) -> Buckets:
    """The expenses below ``out``, in buckets by key."""
    return Buckets(spark, f"{out.rstrip('/')}/{TABLE}", fingerprint.KEY, EXPENSES, _apply, **how)


def latest_ledger(spark: SparkSession, out: str, base: full_run.Ledger) -> tuple[int, full_run.Ledger]:
    """Number and state of the last finished step; -1 and ``base`` before the first."""
    taken = _taken(spark, out)
    last = None if taken is None else taken.agg(F.max("run_id")).first()[0]
    if last is None:
        return -1, base
    lines, contracts = (staging.read_run(spark, out, name, last) for name in ("rubricas", "termos"))
    return last, full_run.Ledger(store(spark, out).read(last), contracts, lines.select(*base.lines.columns))


def take_landed(
    spark: SparkSession,
    landing: str,
    base: full_run.Ledger,
    out: str,
    as_of: AsOf = None,
    mapping: Mapping[str, str] = S.CONTRACT_BY_SIT,
    files_per_step: int = 100_000,
) -> full_run.Run | None:
    """Run over the files not taken yet, oldest first; None if there are none.

    A step ends with the list of its files. One that fails before that is done again from the
    same ledger under the same number, and overwrites what it left. Expenses are kept in buckets
    by key; a step writes its changes, which are folded in on reading (``sources/buckets.py``).
    """
    files = listing.landed_files(spark, landing).select(*_FILE)
    taken = _taken(spark, out)
    if taken is not None:
        files = files.join(taken.select(*_FILE), list(_FILE), "left_anti")
    # names alone, as many as a step is allowed
    new = files.orderBy("modified", "source_file").limit(files_per_step).collect()
    if not new:
        return None
    last, ledger = latest_ledger(spark, out, base)
    expenses = store(spark, out)
    if last < 0:
        expenses.write(base.expenses, last)

    def write(found: DataFrame) -> DataFrame:
        return expenses.change(found, last, last + 1)

    paths = [r["source_file"] for r in new]
    done = full_run.run(
        spark, paths, ledger, out, str(last + 1), as_of, approved=True, mapping=mapping, write_expenses=write
    )
    staging.write_run(spark.createDataFrame(new, files.schema), out, TAKEN, last + 1)
    return done
