"""A stored table in key-hash buckets, merged on read: a change set is written as it is.

Below the table's folder lie ``files/version=<v>/bucket=<b>`` with whole buckets,
``changes/version=<v>/bucket=<b>`` with the changes of one step, and ``manifest/version=<v>``:
for each bucket the version that holds its rows, the steps that changed it since, and how many
rows both have. Reading folds the changes in, in the buckets that have any. A bucket whose changes
exceed ``share`` of its rows is written whole again, so a step writes in proportion to its changes
and a read folds at most that share. A version is written under its own names, so one that failed
half way is simply written again, and readers of older versions are not disturbed. ``keep``
versions stay readable; files that none of them names are deleted.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: In the changes that :class:`Buckets` hands to ``apply``: the step each row belongs to.
STEP = "_step"


class Held(NamedTuple):
    """What a bucket consists of."""

    version: int
    steps: tuple[int, ...]
    rows: int
    changed: int


_MANIFEST = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("held_by", T.LongType()),
        T.StructField("steps", T.ArrayType(T.LongType())),
        T.StructField("rows", T.LongType()),
        T.StructField("changed", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Buckets:
    """Where a table lies and how it is cut. ``buckets`` is set once, for the table's whole life.

    ``apply(rows, changes)`` gives the rows after the changes of several steps, which it tells
    apart by the column ``STEP``.
    """

    spark: SparkSession
    path: str
    key: str
    schema: T.StructType
    apply: Callable[[DataFrame, DataFrame], DataFrame]
    buckets: int = 1024
    keep: int = 10
    share: float = 0.25

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def _fs(self, path: str):
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark._jsc.hadoopConfiguration()), found

    def _numbers(self, folder: str, name: str) -> list[int]:
        fs, path = self._fs(f"{self.path}/{folder}")
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{name}="))

    def versions(self) -> list[int]:
        """Readable versions, the oldest first."""
        return self._numbers("manifest", "version")

    def manifest(self, version: int) -> dict[int, Held]:
        """What each bucket consists of; never more than ``buckets`` entries."""
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest/version={version}").collect()
        return {r["bucket"]: Held(r["held_by"], tuple(r["steps"]), r["rows"], r["changed"]) for r in rows}

    def read(self, version: int) -> DataFrame:
        """The table at ``version``."""
        return self._rows(self.manifest(version))

    def _rows(self, held: dict[int, Held]) -> DataFrame:
        def files(some: dict[int, Held]) -> DataFrame:
            paths = [f"{self.path}/files/version={h.version}/bucket={b}" for b, h in some.items() if h.rows]
            if not paths:
                return self.spark.createDataFrame([], self.schema)
            return self.spark.read.schema(self.schema).parquet(*paths)

        changed = {b: h for b, h in held.items() if h.steps}
        if not changed:
            return files(held)
        steps = [f"{self.path}/changes/version={v}/bucket={b}" for b, h in changed.items() for v in h.steps]
        after = self.apply(files(changed), self.spark.read.parquet(*steps)).select(*self.schema.fieldNames())
        rest = {b: h for b, h in held.items() if not h.steps}
        return files(rest).unionByName(after) if rest else after

    def write(self, df: DataFrame, version: int) -> DataFrame:
        """All rows of ``df`` as ``version``."""
        return self._publish(self._whole(df, version), version)

    def change(self, changes: DataFrame, before: int, version: int) -> DataFrame:
        """``version``: version ``before`` and the changes."""
        counts = self._store(changes.withColumn(STEP, F.lit(version).cast("long")), "changes", version)
        held = self.manifest(before)
        for b, n in counts.items():
            old = held.get(b, Held(version, (), 0, 0))
            held[b] = Held(old.version, (*old.steps, version), old.rows, old.changed + n)
        full = {b: h for b, h in held.items() if h.steps and h.changed > self.share * h.rows}
        if full:
            held |= dict.fromkeys(full, Held(version, (), 0, 0)) | self._whole(self._rows(full), version)
        return self._publish(held, version)

    def _whole(self, df: DataFrame, version: int) -> dict[int, Held]:
        counts = self._store(df.select(*self.schema.fieldNames()), "files", version)
        return {b: Held(version, (), n, 0) for b, n in counts.items()}

    def _store(self, df: DataFrame, folder: str, version: int) -> dict[int, int]:
        """Write rows by bucket; their number in each."""
        path = f"{self.path}/{folder}/version={version}"
        # rebalancing cuts a bucket that holds a hot key into several files
        dealt = df.withColumn("bucket", self.bucket()).hint("rebalance", "bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(path)
        if not self._numbers(f"{folder}/version={version}", "bucket"):
            return {}
        return {r[0]: r[1] for r in self.spark.read.parquet(path).groupBy("bucket").count().collect()}

    def _publish(self, held: dict[int, Held], version: int) -> DataFrame:
        rows = [(b, h.version, list(h.steps), h.rows, h.changed) for b, h in sorted(held.items())]
        listed = self.spark.createDataFrame(rows, _MANIFEST)
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/version={version}")
        self._forget()
        return self.read(version)

    def _forget(self) -> None:
        """Delete what only versions before the last ``keep`` name."""
        versions = self.versions()
        old, kept = versions[: -self.keep], versions[-self.keep :]
        if not old:
            return
        held = [(b, h) for version in kept for b, h in self.manifest(version).items()]
        named = {("files", h.version, b) for b, h in held} | {("changes", v, b) for b, h in held for v in h.steps}
        for version in old:
            fs, path = self._fs(f"{self.path}/manifest/version={version}")
            fs.delete(path, True)
        for folder in ("files", "changes"):
            for version in self._numbers(folder, "version"):
                if version not in kept:
                    for bucket in self._numbers(f"{folder}/version={version}", "bucket"):
                        if (folder, version, bucket) not in named:
                            fs, path = self._fs(f"{self.path}/{folder}/version={version}/bucket={bucket}")
                            fs.delete(path, True)
