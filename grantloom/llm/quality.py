"""Quality rules: counts of each text, base limits, and robust outliers by language and source.

The counts are turned into a vector of statistics. For every (language, source), every
language, and the whole table, a minimum-covariance-determinant estimate is fitted: each step
takes the share ``SUPPORT`` of rows nearest to the current centre and recomputes centre and
covariance from them, as sums over the whole table. Steps begin from three starts (medians and
spreads; the same with the correlations of the statistics bent by tanh; plain mean and
covariance); after ``FIRST_STEPS`` the start of least determinant goes on, until a step lowers
the determinant's logarithm by less than ``SETTLED``. A text is
rejected where its Mahalanobis distance is beyond a chi-square limit; the estimate is that of
its language and source, or of its language, or of all, whichever first has enough rows.

Steps are grouped sums, reduced in each task before anything is shuffled, so a source with a
third of all rows costs no task more than others. Null text: no words, so the base limits
reject it. A null language or source is a group of its own. Repeated rows are judged row by
row. An empty table, or one with too few rows for any estimate, has no outliers.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared, texts

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
#: Base limits: fewest words, largest share (percent) of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 20, 30
#: Share of rows that an estimate rests on, fewest rows of an estimate.
SUPPORT, LEAST_ROWS = 0.75, 100
#: Steps taken from every start, and the least fall of the log determinant that asks for one more.
FIRST_STEPS, SETTLED = 2, 1e-3
#: Parts into which the rows of one estimate are dealt, and tasks that work on the estimates, one row each.
PARTS, FEW = 64, 8
#: Chance of a normal vector beyond the limit: one sound document in a million is given up.
BEYOND = 1e-6
#: Least spread of each statistic: differences below are never remarkable.
SPREADS = {"size": 0.4, "length": 0.05, "symbols": 0.35, "lines": 0.5, "repeats": 0.5, "capitals": 0.35, "digits": 0.35}

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_digits")
_BLANKS = b" \t\n\r\x0b\x0c"
_CAPITALS = bytes(range(0x41, 0x5B))
_DIGITS = bytes(range(0x30, 0x3A))
_CONTINUES = bytes(range(0x80, 0xC0))
_POWERS = np.array([pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(WINDOW)], np.uint64)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows of ``window`` words that occur twice or more, the first occurrence included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    hashes = np.array(list(map(hash, words)), np.int64).view(np.uint64)
    rolled = np.zeros(n, np.uint64)
    for i in range(window):
        rolled += hashes[i : i + n] * _POWERS[i]
    order = np.argsort(rolled, kind="stable")
    same = rolled[order[1:]] == rolled[order[:-1]]
    if not same.any():
        return 0
    both = np.zeros(n, bool)
    both[order[1:][same]] = True
    both[order[:-1][same]] = True
    # equal hashes only point to windows; the words decide
    seen: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(both).tolist():
        seen.setdefault(tuple(words[i : i + window]), []).append(i)
    covered = np.zeros(len(words) + 1, np.int64)
    for places in seen.values():
        if len(places) > 1:
            np.add.at(covered, places, 1)
            np.add.at(covered, np.array(places) + window, -1)
    return int((np.cumsum(covered) > 0).sum())


def counts(text: bytes) -> tuple[int, ...]:
    """The numbers named in ``COUNTS``."""
    words = text.split()
    lines = text.split(b"\n")
    real = [x for x in lines if x.strip()]
    inner = 0 if text.isascii() else len(text) - len(text.translate(None, delete=_CONTINUES))
    return (
        len(words),
        len(text) - inner - sum(text.count(b) for b in _BLANKS),
        sum(text.count(b) for b in SYMBOLS),
        len(real) - len(set(real)),
        repeated_words(words),
        len(real),
        len(text) - len(text.translate(None, delete=_CAPITALS)),
        len(text) - len(text.translate(None, delete=_DIGITS)),
    )


def with_counts(df: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``df`` with the counts of each text, and the names that they got."""
    names = {c: texts.fresh(c, df.columns) for c in COUNTS}

    def work(batches):
        for batch in batches:
            rows = [counts(t) for t in texts.each_text(batch, text)]
            columns = zip(*rows) if rows else [[]] * len(COUNTS)
            yield batch, [pa.array(c, pa.int64()) for c in columns]

    added = T.StructType([T.StructField(names[c], T.LongType()) for c in COUNTS])
    return texts.extend(df, added, work), names


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < LEAST_WORDS) | (n_repeat_words * 100 > n_words * MOST_REPEATED)


def statistics(names: dict[str, str]) -> dict[str, Column]:
    """The transformed statistics, near to symmetric in ordinary text."""
    c = {k: F.col(f"`{v}`").cast("double") for k, v in names.items()}
    chars, words = F.greatest(c["word_chars"], F.lit(1.0)), F.greatest(c["n_words"], F.lit(1.0))
    return {
        "size": F.log1p(c["n_words"]),
        "length": F.log(F.greatest(c["word_chars"], F.lit(1.0)) / words),
        "symbols": F.log1p(c["n_symbols"] / chars * 100),
        "lines": F.log1p(c["n_dup_lines"] / F.greatest(c["n_lines"], F.lit(1.0)) * 10),
        "repeats": F.log1p(c["n_repeat_words"] / words * 10),
        "capitals": F.log1p(c["n_capitals"] / chars * 20),
        "digits": F.log1p(c["n_digits"] / chars * 20),
    }


def _keys(lang: Column, source: Column) -> list[Column]:
    """Names of a row's estimates, the narrowest first."""
    lang, source = (F.coalesce(F.concat(F.lit("="), x.cast("string")), F.lit("-")) for x in (lang, source))
    return [F.to_json(F.array(lang, source)), F.to_json(F.array(lang)), F.lit("[]")]


def chi_square_cdf(x: float, p: int) -> float:
    """Chance that a chi-square of ``p`` degrees is at most ``x``."""
    if x <= 0:
        return 0.0
    a, half = p / 2, x / 2
    term = total = math.exp(-half + a * math.log(half) - math.lgamma(a + 1))
    k = 1
    while term > total * 1e-17 and k < 10_000:
        term *= half / (a + k)
        total += term
        k += 1
    return min(1.0, total)


def chi_square_limit(chance: float, p: int) -> float:
    """The value that a chi-square of ``p`` degrees exceeds with this chance."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if 1 - chi_square_cdf(middle, p) > chance else (low, middle)
    return high


def _distance(values: list[Column], centre: Column, inverse: Column) -> Column:
    """Squared Mahalanobis distance; the inverse covariance is laid out row by row."""
    p, off = len(values), [v - F.element_at(centre, i + 1) for i, v in enumerate(values)]
    total = F.lit(0.0)
    for i in range(p):
        for j in range(i, p):
            total = total + off[i] * off[j] * F.element_at(inverse, i * p + j + 1) * (1.0 if i == j else 2.0)
    return total


def estimates(rows: DataFrame, x: list[str], support: float = SUPPORT, settled: float = SETTLED) -> DataFrame:
    """``key, centre, inverse, logdet`` for each key of ``rows (key, *x)`` that has enough rows.

    Every step that is not the last lowers a log determinant by ``settled``, and the spreads added
    to the covariance bound it from below, so the steps come to an end.
    """
    p = len(x)
    spread = np.array([SPREADS[c] for c in x])
    limit = chi_square_limit(1 - support, p)
    # the nearest part of a normal sample has too small a covariance, by this factor
    factor = support / chi_square_cdf(limit, p + 2)
    names = ["key", "start", "centre", "inverse", "root", "logdet"]
    schema = "key string, start int, centre array<double>, inverse array<double>, root array<double>, logdet double"

    def moments(row) -> tuple[np.ndarray, np.ndarray]:
        centre = np.array(row.sums) / row.n
        upper = np.zeros((len(centre), len(centre)))
        upper[np.triu_indices(len(centre))] = np.array(row.products) / row.n
        return centre, upper + np.triu(upper, 1).T - np.outer(centre, centre)

    def estimate(key: str, start: int, centre: np.ndarray, covariance: np.ndarray) -> tuple:
        covariance = covariance + np.diag(np.square(spread))
        inverse, logdet = np.linalg.inv(covariance), float(np.linalg.slogdet(covariance)[1])
        # the distance is a sum of squares of the rows of this triangle
        root = np.linalg.cholesky(inverse).T[np.triu_indices(p)]
        return key, start, centre.tolist(), inverse.ravel().tolist(), root.tolist(), logdet

    def starts(frames):
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                middle, scale = np.array(row.middle), np.array(row.scale)
                centre, covariance = moments(row)
                bent = covariance[p:, p:]
                width = np.sqrt(np.maximum(np.diag(bent), 1e-12))
                correlation = bent / np.outer(width, width)
                np.fill_diagonal(correlation, 1.0)
                out += [
                    estimate(row.key, 0, middle, np.diag(np.square(scale))),
                    estimate(row.key, 1, middle, correlation * np.outer(scale, scale)),
                    estimate(row.key, 2, centre[:p], covariance[:p, :p]),
                ]
            yield pd.DataFrame(out, columns=names)

    def fitted(frames):
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                centre, covariance = moments(row)
                out.append(estimate(row.key, row.start, centre, factor * covariance))
            yield pd.DataFrame(out, columns=names)

    # one key holds all rows: they are dealt out by part as well, and meet again as partial sums
    parts = F.explode(F.array(*map(F.lit, range(PARTS)))).alias("part")
    dealt = shared.keep(rows.select("key", F.pmod(F.xxhash64(*x), F.lit(PARTS)).cast("int").alias("part"), *x))

    quartiles = F.array(*[F.percentile_approx(c, [0.25, 0.5, 0.75], 1000) for c in x]).alias("q")
    ranged = dealt.groupBy("key").agg(F.count("*").alias("rows"), quartiles).filter(F.col("rows") >= LEAST_ROWS)
    middle = F.array(*[F.col("q")[i][1] for i in range(p)]).alias("middle")
    scale = [F.greatest((F.col("q")[i][2] - F.col("q")[i][0]) / 1.349, F.lit(float(spread[i]))) for i in range(p)]
    plain = shared.keep(ranged.select("key", middle, F.array(*scale).alias("scale")).coalesce(FEW))
    flat = [F.col(c)[i].alias(f"{c}{i}") for c in ("middle", "scale") for i in range(p)]
    bent = [F.tanh((F.col(x[i]) - F.col(f"middle{i}")) / F.col(f"scale{i}")).alias(f"bent{i}") for i in range(p)]
    both = dealt.join(plain.select("key", parts, *flat), ["key", "part"]).select("key", F.lit(0).alias("start"), *x, *bent)
    begun = _sums(both, [*x, *[f"bent{i}" for i in range(p)]]).drop("start")
    now = shared.keep(plain.join(begun, "key").coalesce(FEW).mapInPandas(starts, schema))
    shared.drop(plain)

    def step(here: DataFrame) -> DataFrame:
        flat = [F.col(c)[i].alias(f"{c}{i}") for c, n in (("centre", p), ("root", p * (p + 1) // 2)) for i in range(n)]
        off = [F.col(c) - F.col(f"centre{i}") for i, c in enumerate(x)]
        distance, at = F.lit(0.0), 0
        for i in range(p):
            side = F.lit(0.0)
            for j in range(i, p):
                side, at = side + off[j] * F.col(f"root{at}"), at + 1
            distance = distance + side * side
        centres = here.select("key", "start", parts, *flat)
        measured = dealt.join(centres, ["key", "part"]).select("key", "start", "part", *x, distance.alias("distance"))
        near = measured.groupBy("key", "start").agg(F.percentile_approx("distance", support, 2000).alias("reach"))
        inner = measured.join(near.select("key", "start", "reach", parts), ["key", "start", "part"]).filter("distance <= reach")
        return _sums(inner, x).coalesce(FEW).mapInPandas(fitted, schema)

    for _ in range(FIRST_STEPS):
        last, now = now, shared.keep(step(now))
        shared.drop(last)
    last, found = now, F.struct(*names[1:])
    least = now.groupBy("key").agg(F.min_by(found, F.struct("logdet", "start")).alias("found"))
    now = shared.keep(least.select("key", "found.*", F.lit(False).alias("done")).coalesce(FEW))
    shared.drop(last)
    while not now.filter("not done").isEmpty():
        after = step(now.filter("not done")).select("key", found.alias("after"))
        lower = F.col("after.logdet") < F.col("logdet")
        going = F.coalesce(F.col("after.logdet") < F.col("logdet") - settled, F.lit(False))
        chosen = F.when(lower, F.col("after")).otherwise(found).alias("found")
        both = now.join(after, "key", "left").select("key", chosen, (~going).alias("done"))
        last, now = now, shared.keep(both.select("key", "found.*", "done").coalesce(FEW))
        shared.drop(last)
    shared.drop(dealt)
    return now.select("key", "centre", "inverse", "logdet")


def _sums(rows: DataFrame, x: list[str]) -> DataFrame:
    """``key, start, n, sums, products`` of ``rows (key, start, *x)``; each batch is summed where it lies."""
    p = len(x)
    pairs = np.triu_indices(p)
    fields = [f"m{i}" for i in range(p + len(pairs[0]))]

    def work(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("key").dictionary_encode()
            start = batch.column("start").to_numpy()
            group = keys.indices.to_numpy().astype(np.int64) * 8 + start
            values = np.column_stack([batch.column(c).to_numpy() for c in x])
            order = np.argsort(group, kind="stable")
            edges = np.flatnonzero(np.diff(group[order], prepend=-1))
            out = []
            for a, b in zip(edges, [*edges[1:], len(order)]):
                some = values[order[a:b]]
                out.append(np.concatenate([some.sum(0), (some.T @ some)[pairs]]))
            first = order[edges]
            yield pa.RecordBatch.from_arrays(
                [
                    keys.dictionary.take(keys.indices.take(pa.array(first))),
                    pa.array(start[first], pa.int32()),
                    pa.array(np.diff([*edges, len(order)]), pa.int64()),
                    *[pa.array(c) for c in np.array(out).T],
                ],
                names=["key", "start", "n", *fields],
            )

    schema = ", ".join(["key string, start int, n long", *[f"{f} double" for f in fields]])
    partial = rows.select("key", "start", *x).mapInArrow(work, schema)
    sums, products = (F.array(*map(F.sum, some)) for some in (fields[:p], fields[p:]))
    return partial.groupBy("key", "start").agg(F.sum("n").alias("n"), sums.alias("sums"), products.alias("products"))


def _verdicts(counted: DataFrame, sample: DataFrame, names: dict[str, str], lang: str, source: str, beyond: float):
    """Verdicts for ``counted`` by estimates over ``sample``, the same rows in a cheaper form."""
    values = statistics(names)
    x = list(values)
    failed = base_failed(*(F.col(f"`{names[c]}`") for c in ("n_words", "n_repeat_words")))
    rows = (
        sample.filter(~failed)
        .select(F.explode(F.array(*_keys(F.col(f"`{lang}`"), F.col(f"`{source}`")))).alias("key"), *[v.alias(k) for k, v in values.items()])
    )
    found = estimates(rows, x)

    # the estimate of each language and source is settled on their names alone, then joined once
    own, wider, widest = _keys(F.col(f"`{lang}`"), F.col(f"`{source}`"))
    names_of = sample.select(own.alias("key"), wider.alias("wider"), widest.alias("widest")).distinct()
    for place in ("key", "wider", "widest"):
        estimate = F.struct("centre", "inverse").alias(f"by_{place}")
        names_of = names_of.join(found.select(F.col("key").alias(place), estimate), place, "left")
    taken = [*counted.columns]
    out = {k: texts.fresh(k, taken) for k in ("base_failed", "distance", "kept")}
    at, chosen = (texts.fresh(c, taken) for c in ("_key", "_estimate"))
    best = names_of.select(F.col("key").alias(at), F.coalesce("by_key", "by_wider", "by_widest").alias(chosen))
    wide = counted.join(best, own == F.col(at), "left")
    distance = _distance(list(values.values()), F.col(chosen)["centre"], F.col(chosen)["inverse"])
    wide = wide.withColumn(out["distance"], distance).withColumn(out["base_failed"], failed).drop(at, chosen)
    p = len(x)
    limit = chi_square_limit(beyond, p)
    kept = ~F.col(out["base_failed"]) & ~F.coalesce(F.col(out["distance"]) > limit, F.lit(False))
    return wide.withColumn(out["kept"], kept), {**names, **out}


def verdicts(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Counts and verdict of every row; the texts are read once."""
    narrow = df.select(*[df[f"`{a}`"].alias(b) for a, b in ((doc_id, "doc_id"), (text, "text"), (lang, "lang"), (source, "source"))])
    counted, names = with_counts(narrow)
    counted = shared.keep(counted.drop("text"))
    judged, _ = _verdicts(counted, counted, names, "lang", "source", BEYOND)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


def kept_rows(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``df`` that pass. The estimates rest on a table of counts, the texts stay where they are."""
    small = df.select(*[df[f"`{a}`"].alias(b) for a, b in ((text, "text"), (lang, "lang"), (source, "source"))])
    sample, names = with_counts(small)
    sample = shared.keep(sample.drop("text"))
    counted, own = with_counts(df, text)
    if own != names:
        sample = sample.select("lang", "source", *[F.col(names[c]).alias(own[c]) for c in COUNTS])
    sample = sample.select(*[F.col(a).alias(b) for a, b in (("lang", lang), ("source", source))], *[F.col(f"`{own[c]}`") for c in COUNTS])
    judged, found = _verdicts(counted, sample, own, lang, source, BEYOND)
    return judged.filter(F.col(f"`{found['kept']}`")).select(*[F.col(f"`{c}`") for c in df.columns])
