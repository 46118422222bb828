"""Approximate nearest neighbours: a graph by NN-descent, and greedy search along it.

Equal vectors are one node, so copies of a vector, however many, cost one. The first graph
comes from a few random orders: nodes are sorted by the signs of random projections and
compared within runs of the order. Then every round brings each node's neighbours, and
the nearest of those that list it, to the node, compares there all pairs that have a new end, and
offers each pair to both ends: neighbours of neighbours become neighbours. Rounds end when one
replaces less than the share ``SETTLED`` of all neighbours.

A query starts at a node and keeps a beam of the nearest nodes seen. Every hop looks at the
neighbours of all nodes of the beam not yet looked at, for all queries at once, until nothing
is left to look at: every node is met once by a query, so this ends. Distances are Euclidean, in double precision.

Nodes lie in parts, runs of the first order of at most ``PART``. A part is one row that holds its
vectors and lists as arrays, and an id tells a node's part. What a round or a hop sends goes from
part to part in one row for each pair of parts that have to do with one another, a vector once
for each part that needs it: Spark deals out these rows (four shuffles a round, two a hop, however
many came before), and a task works on one part at a time.

Vectors that are null, zero, hold nulls or non-finite components, or differ from the most
common length take no part, neither do rows without an id. Rows that repeat an id count once
(the least vector). Of equally near rows the smaller id comes first. Fewer candidates than
wanted: all of them. An empty table gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from functools import partial
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared

NEAREST = 10
#: Neighbours of a node, and of those that list it how many join in a round.
DEGREE, REVERSE = 30, 20
#: Random orders of the first graph, nodes compared in a run, projections of an order.
ORDERS, RUN, SIGNS, SEED = 6, 2048, 24, 11
#: Rounds go on until one replaces less than this share of all neighbours.
SETTLED = 0.01
#: Nodes that a query keeps.
BEAM = 220
#: Most nodes of a part, least parts that a large table is cut into, and bits of an id that tell a node within its part.
PART, PARTS, BITS = 4096, 24, 13
#: Queries that walk together.
TOGETHER = 64

#: A part's row (kind 0), or what another part sends it. ``open``, ``total``: counts that end a loop.
#: The body comes in pieces, as arrays of megabytes are a burden to the JVM's memory.
_MAIL = "part long, kind int, sender long, body array<binary>, open long, total long"
PIECE = 1 << 18
_NONE = np.iinfo(np.int64).min


def usable(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, vector`` of the rows that take part; components keep their type if it is float or double."""
    kind = rows.schema[vector].dataType.elementType
    kept = kind.simpleString() if isinstance(kind, (T.FloatType, T.DoubleType)) else "double"
    values = F.col("vector")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = rows.select(
        rows[f"`{vec_id}`"].cast("long").alias("vec_id"), rows[f"`{vector}`"].cast(f"array<{kept}>").alias("vector")
    ).filter(F.col("vec_id").isNotNull() & values.isNotNull() & ~bad & F.exists(values, lambda x: x != 0))
    length = sound.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if length is None:
        return sound
    return sound.filter(F.size("vector") == length["n"]).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _top(edges: DataFrame, by: str, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows of each group; tasks cut their own rows before the shuffle."""
    window = Window.partitionBy(by).orderBy(*order)
    return edges.withColumn("_at", F.row_number().over(window)).filter(F.col("_at") <= n).drop("_at")


def _raw(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _list_array(matrix: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]), pa.array(matrix.ravel()))


def _codes(x: np.ndarray, nodes: np.ndarray, number: int, seed: int) -> np.ndarray:
    """Signs of projections as one number, the first the most significant, behind the order's own; equal ones are told apart by the node."""
    bits = (x @ np.random.default_rng(seed).normal(size=(x.shape[1], SIGNS)) > 0).astype(np.int64)
    mixed = (nodes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)
    return (bits << np.arange(SIGNS)[::-1]).sum(axis=1) + (number << SIGNS) + mixed / 2.0**20


def _nearest_within(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of the ``k`` nearest of each row among the others, the nearest first."""
    m = len(x)
    k = min(k, m - 1)
    squares = np.square(x).sum(axis=1)
    places, found = np.zeros((m, k), np.int64), np.zeros((m, k))
    for at in range(0, m if k else 0, 512):
        far = x[at : at + 512] @ x.T
        far *= -2
        far += squares
        far[np.arange(len(far)), np.arange(at, at + len(far))] = np.inf
        near = np.argpartition(far, k - 1, axis=1)[:, :k]
        d = np.sqrt(np.maximum(np.take_along_axis(far, near, 1) + squares[at : at + 512, None], 0.0))
        order = np.argsort(d, axis=1, kind="stable")
        places[at : at + 512], found[at : at + 512] = np.take_along_axis(near, order, 1), np.take_along_axis(d, order, 1)
    return places, found


def _ranks(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by the last key, then by the one before and so on, and each entry's place among equal last keys."""
    order = np.lexsort(keys)
    group = keys[-1][order]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
    return order, np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))


def _best_offers(u: np.ndarray, v: np.ndarray, d: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each pair once, of a ``u`` the nearest ``keep``, by ``u``."""
    order = np.lexsort((v, u))
    u, v, d = u[order], v[order], d[order]
    once = np.r_[True, (u[1:] != u[:-1]) | (v[1:] != v[:-1])] if len(u) else np.zeros(0, bool)
    u, v, d = u[once], v[once], d[once]
    order, rank = _ranks(d, u)
    order = order[rank < keep]
    return u[order], v[order], d[order]


def _stretches(parts: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Stretches of equal values."""
    cuts = np.flatnonzero(parts[1:] != parts[:-1]) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(parts)]):
        if b > a:
            yield int(parts[a]), slice(a, b)


Row = tuple[int, int, int, dict[str, Any], int, int]
#: From a part, its own row's content (if it has a row) and what it was sent, by kind and sender.
Step = Callable[[int, dict | None, list[tuple[int, int, dict]]], Iterator[Row]]


def _written(rows: Iterator[Row], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        types = pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.binary()), pa.int64(), pa.int64()
        names = "part", "kind", "sender", "body", "open", "total"
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)

    for part, kind, sender, body, *counts in rows:
        whole = pickle.dumps(body, 5)
        held.append((part, kind, sender, [whole[at : at + PIECE] for at in range(0, len(whole), PIECE)], *counts))
        size += len(whole)
        if size > most or len(held) >= 10_000:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _content(body: pa.ListScalar) -> dict:
    return pickle.loads(b"".join(piece.as_buffer() for piece in body.values))


def _part_by_part(step: Step, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[Row]:
        now, own, mail = None, None, []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("part", "kind", "sender"))
            for part, kind, sender, body in zip(*columns, batch.column("body")):
                if part != now:
                    if now is not None:
                        yield from step(now, own, mail)
                    now, own, mail = part, None, []
                content = _content(body)
                if kind == 0:
                    own = content
                else:
                    mail.append((kind, sender, content))
        if now is not None:
            yield from step(now, own, mail)

    return _written(rows())


def _alone(step: Step, parts: DataFrame) -> DataFrame:
    return parts.mapInArrow(partial(_part_by_part, step), _MAIL)


def _met(step: Step, parts: DataFrame, mail: DataFrame) -> DataFrame:
    """``step`` for each part with what it was sent; tasks by the number of parts, for mail may be far larger than the parts."""
    n = parts.count()
    every = parts.unionByName(mail).repartition(max(1, min(n, max(1000, n // 4))), "part")
    return _alone(step, every.sortWithinPartitions("part", "kind", "sender"))


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Node, vector and reach of the rows of one ``key``, at most ``most``."""
    for _, batch in _groups(batches, most):
        yield batch.column("node").to_numpy(), _raw(batch.column("vector")), batch.column("reach").to_numpy()


def _in_order(rows: DataFrame, content: Callable[[pa.RecordBatch], Iterator[tuple]], seeds: dict[int, int], kind: str, runs: int) -> DataFrame:
    """``key, code, node, vector, reach`` of what ``content`` finds in the rows, by key: each order cut into runs of like size.

    ``runs``: of all orders. Where to cut is found from quantiles, so that many nodes with one
    code are no single run, and runs do not depend on the number of tasks.
    """

    def coded(bounds: list[float] | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for nodes, x, reach in content(batch):
                wide = x.astype(np.float64)
                for number, seed in seeds.items():
                    code = _codes(wide, nodes, number, seed)
                    if bounds is None:
                        yield pa.RecordBatch.from_arrays([pa.array(code)], names=["code"])
                    else:
                        key = np.searchsorted(bounds, code, "right") + (number << 40)
                        columns = [pa.array(key), pa.array(code), pa.array(nodes), _list_array(x), pa.array(reach)]
                        yield pa.RecordBatch.from_arrays(columns, names=["key", "code", "node", "vector", "reach"])

    codes = rows.mapInArrow(partial(coded, None), "code double")
    bounds = codes.approxQuantile("code", [n / runs for n in range(1, runs)], 0.1 / runs) if runs > 1 else []
    keyed = rows.mapInArrow(partial(coded, bounds), f"key long, code double, node long, vector {kind}, reach double")
    return keyed.repartition("key").sortWithinPartitions("key", "code", "node")


def _offered(sender: int, u: np.ndarray, v: np.ndarray, d: np.ndarray) -> Iterator[Row]:
    """``u``, sorted, is told of ``v`` at ``d``."""
    for part, own in _stretches(u >> BITS):
        yield part, 1, sender, {"u": u[own], "v": v[own], "d": d[own]}, 0, 0


def _take(degree: int, aged: bool, part: int, own: dict, mail: list) -> Iterator[Row]:
    """A part's lists with what it was offered; ``aged``: what stood there before is no longer new."""
    v, d, new = own["v"], own["d"], own["new"] & (not aged)
    if mail:
        u, offered, far = (np.concatenate([m[c] for _, _, m in mail]) for c in ("u", "v", "d"))
        at = np.searchsorted(own["ids"], u)
        nearer = far < d[at, -1] if degree else np.zeros(0, bool)
        at, offered, far = at[nearer], offered[nearer], far[nearer]
        rows, back = np.unique(at, return_inverse=True)
        listed = np.isfinite(d[rows])
        u = np.concatenate([np.nonzero(listed)[0], back])
        every = [np.concatenate(x) for x in ((v[rows][listed], offered), (d[rows][listed], far), (new[rows][listed], np.ones(len(far), bool)))]
        order = np.lexsort((every[0], u))  # stable: the listed come before the offered
        u, every = u[order], [x[order] for x in every]
        once = np.r_[True, (u[1:] != u[:-1]) | (every[0][1:] != every[0][:-1])] if len(u) else np.zeros(0, bool)
        u, every = u[once], [x[once] for x in every]
        order, rank = _ranks(every[1], u)
        order, rank = order[rank < degree], rank[rank < degree]
        v, d, new = v.copy(), d.copy(), new.copy()
        for whole, found in zip((v, d, new), every):
            whole[rows[u[order]], rank] = found[order]
    yield part, 0, part, own | {"v": v, "d": d, "new": new}, int(new.sum()), int(np.isfinite(d).sum())


def _first_graph(nodes: DataFrame, degree: int, orders: int, run: int) -> DataFrame:
    rng = np.random.default_rng(SEED)
    seeds = [int(s) for s in rng.integers(1 << 30, size=orders)]
    n = nodes.count()
    most = min(PART, max(n // PARTS, 256))
    kind = nodes.schema["vector"].dataType.simpleString()

    def plain(batch: pa.RecordBatch) -> Iterator[tuple]:
        if batch.num_rows:
            yield batch.column("node").to_numpy(), _raw(batch.column("vector")), np.full(batch.num_rows, np.inf)

    def packed(batch: pa.RecordBatch) -> Iterator[tuple]:
        for body in batch.column("body"):
            own = _content(body)
            yield own["ids"], own["x"], own["d"][:, -1]

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Parts, each node with its nearest within the part."""

        def parts() -> Iterator[Row]:
            task = TaskContext.get().partitionId()
            for number, (names, x, _) in enumerate(_runs(batches, 1 << BITS)):
                part = (task << 20) + number
                ids = (part << BITS) + np.arange(len(names))
                places, found = _nearest_within(x.astype(np.float64), degree)
                v, d = np.full((len(names), degree), _NONE), np.full((len(names), degree), np.inf)
                v[:, : places.shape[1]], d[:, : places.shape[1]] = ids[places], found
                own = {"ids": ids, "names": names, "x": x, "v": v, "d": d, "new": np.isfinite(d)}
                yield part, 0, part, own, int(np.isfinite(d).sum()), int(np.isfinite(d).sum())

        return _written(parts())

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def offers() -> Iterator[Row]:
            task = TaskContext.get().partitionId()
            for number, (ids, x, reach) in enumerate(_runs(batches, 2 * run)):
                places, found = _nearest_within(x.astype(np.float64), degree)
                at, column = np.nonzero(found < reach[:, None])
                order = np.argsort(ids[at], kind="stable")
                at, column = at[order], column[order]
                yield from _offered((task << 20) + number, ids[at], ids[places[at, column]], found[at, column])

        return _written(offers())

    dealt = _in_order(nodes.select("node", "vector"), plain, {0: seeds[0]}, kind, -(-n // most))
    graph = shared.keep(dealt.mapInArrow(numbered, _MAIL))
    if orders < 2:
        return graph
    others = {number: seeds[number] for number in range(1, orders)}
    offers = _in_order(graph, packed, others, kind, -(-n * len(others) // run)).mapInArrow(compared, _MAIL)
    return _replaced(graph, _met(partial(_take, degree, False), graph, offers))


def _replaced(last: DataFrame, now: DataFrame) -> DataFrame:
    """``now`` kept, ``last`` and the shuffles that made ``now`` gone."""
    kept = shared.keep(now)
    shared.drop(last)
    shared.sweep(last.sparkSession)
    return kept


def _tell(reverse: int, part: int, own: dict, mail: list) -> Iterator[Row]:
    """To the parts of a part's neighbours: the nearest that list each."""
    at, column = np.nonzero(np.isfinite(own["d"]))
    v, d, new = own["v"][at, column], own["d"][at, column], own["new"][at, column]
    order, rank = _ranks(d, v)
    order = order[rank < reverse]
    v, u, d, new = v[order], own["ids"][at[order]], d[order], new[order]
    for to, here in _stretches(v >> BITS):
        yield to, 1, part, {"v": v[here], "u": u[here], "d": d[here], "new": new[here]}, 0, 0


def _ask(reverse: int, part: int, own: dict, mail: list) -> Iterator[Row]:
    """To itself: the nearest that list each of a part's nodes. To other parts: whose vectors the comparisons need."""
    listing, fresh = np.full((len(own["ids"]), reverse), _NONE), np.zeros((len(own["ids"]), reverse), bool)
    if mail:
        v, u, d, new = (np.concatenate([m[c] for _, _, m in mail]) for c in ("v", "u", "d", "new"))
        order, rank = _ranks(u, d, v)
        order, rank = order[rank < reverse], rank[rank < reverse]
        at = np.searchsorted(own["ids"], v[order])
        listing[at, rank], fresh[at, rank] = u[order], new[order]
    yield part, 2, part, {"listing": listing, "fresh": fresh}, 0, 0
    active = own["new"].any(axis=1) | fresh.any(axis=1)
    ids = np.unique(np.concatenate([own["v"][active].ravel(), listing[active].ravel()]))
    for to, here in _stretches((ids := ids[ids != _NONE]) >> BITS):
        if to != part:
            yield to, 1, part, {"ids": ids[here]}, 0, 0


def _answer(part: int, own: dict, mail: list) -> Iterator[Row]:
    """To the parts that asked: vectors."""
    for kind, sender, m in mail:
        if kind == 2:
            yield part, 2, part, m, 0, 0
        else:
            at = np.searchsorted(own["ids"], m["ids"])
            yield sender, 1, part, {"ids": m["ids"], "x": own["x"][at], "reach": own["d"][at, -1]}, 0, 0


def _compare(degree: int, part: int, own: dict, mail: list) -> Iterator[Row]:
    """Pairs around each node of a part, those with a new end, offered to the ends that they are near enough for."""
    mine = next(m for kind, _, m in mail if kind == 2)
    sent = [m for kind, _, m in mail if kind == 1]
    ids = np.concatenate([own["ids"], *(m["ids"] for m in sent)])
    at = np.argsort(ids)
    ids = ids[at]
    x = np.concatenate([own["x"], *(m["x"] for m in sent)])[at]
    reach = np.square(np.concatenate([own["d"][:, -1], *(m["reach"] for m in sent)])[at])
    listing, fresh = mine["listing"], mine["fresh"]
    mail.clear()
    sent.clear()
    active = np.flatnonzero(own["new"].any(axis=1) | fresh.any(axis=1))
    u, v, d, n = [], [], [], 0
    for start in range(0, len(active), 256):
        rows = active[start : start + 256]
        forward, backward, new, newer = own["v"][rows], listing[rows], own["new"][rows], fresh[rows]
        twice = forward[:, :, None] == backward[:, None, :]
        # a node on both sides stands on the first, and is new if it is new on either
        new = new | (twice & newer[:, None, :]).any(axis=2)
        backward = np.where(twice.any(axis=1), _NONE, backward)
        members = np.concatenate([own["ids"][rows][:, None], forward, backward], axis=1)
        there = members != _NONE
        new = np.concatenate([np.zeros((len(rows), 1), bool), new, newer], axis=1) & there
        at = np.where(there, np.searchsorted(ids, members), 0)
        vectors = x[at].astype(np.float64)
        squares = np.square(vectors).sum(axis=2)
        far = vectors @ vectors.transpose(0, 2, 1)
        far *= -2
        far += squares[:, :, None]
        far += squares[:, None, :]
        ok = far < np.where(there, reach[at], -np.inf)[:, :, None]
        ok &= new[:, :, None] | new[:, None, :]
        ok &= there[:, None, :]
        ok[:, np.arange(ok.shape[1]), np.arange(ok.shape[1])] = False
        row, i, j = np.nonzero(ok)
        u.append(members[row, i])
        v.append(members[row, j])
        d.append(np.sqrt(np.maximum(far[row, i, j], 0.0)))
        n += len(row)
        if n > 1_000_000:
            best = _best_offers(*(np.concatenate(c) for c in (u, v, d)), degree)
            (u, v, d), n = ([c] for c in best), 0
    if u:
        yield from _offered(part, *_best_offers(*(np.concatenate(c) for c in (u, v, d)), degree))


def build_graph(
    nodes: DataFrame, degree: int = DEGREE, reverse: int = REVERSE, orders: int = ORDERS, run: int = RUN, settled: float = SETTLED
) -> DataFrame:
    """Parts that hold ``nodes (node, vector)`` and of each about the ``degree`` nearest; :func:`edges` gives them as rows."""
    graph = _first_graph(nodes, degree, orders, run)
    while True:
        # of each centre: itself, its neighbours, and the nearest of those that list it
        asked = _met(partial(_ask, reverse), graph, _alone(partial(_tell, reverse), graph))
        offers = _met(partial(_compare, degree), graph, _met(_answer, graph, asked))
        graph = _replaced(graph, _met(partial(_take, degree, True), graph, offers))
        new, every = graph.agg(F.sum("open"), F.sum("total")).first()
        # lists only ever get nearer, so a settled graph replaces nothing
        if (new or 0) <= settled * (every or 0):
            return graph


def _named(parts: DataFrame) -> DataFrame:
    """``id, node`` of all nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column("body"):
                own = _content(body)
                yield pa.RecordBatch.from_arrays([pa.array(own["ids"]), pa.array(own["names"])], names=["id", "node"])

    return parts.mapInArrow(run, "id long, node long")


def edges(graph: DataFrame) -> DataFrame:
    """``u, v, d`` of a graph that :func:`build_graph` made."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column("body"):
                own = _content(body)
                at, column = np.nonzero(np.isfinite(own["d"]))
                columns = own["names"][at], own["v"][at, column], own["d"][at, column]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["u", "id", "d"])

    return graph.mapInArrow(run, "u long, id long, d double").join(_named(graph).withColumnRenamed("node", "v"), "id").select("u", "v", "d")


def _places(graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """Parts with ``ids, names, x`` and ``v``, the neighbours; of a graph in rows ``u, v`` a node's number is its id."""

    def lean(part: int, own: dict, mail: list) -> Iterator[Row]:
        yield part, 0, part, {c: own[c] for c in ("ids", "names", "x", "v")}, 0, 0

    if "body" in graph.columns:
        return _alone(lean, graph)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[Row]:
            for part, batch in _groups(batches, 1 << BITS):
                ids, lists = batch.column("node").to_numpy(), batch.column("nexts").to_pylist()
                v = np.full((len(ids), max((len(n) for n in lists if n), default=0)), _NONE)
                for at, n in enumerate(lists):
                    v[at, : len(n or ())] = n or ()
                yield part, 0, part, {"ids": ids, "names": ids, "x": _raw(batch.column("vector")), "v": v}, 0, 0

        return _written(parts())

    nexts = graph.groupBy(F.col("u").alias("node")).agg(F.collect_list("v").alias("nexts"))
    rows = nodes.select(F.shiftright("node", BITS).alias("key"), "node", "vector").join(nexts, "node", "left")
    return rows.repartition("key").sortWithinPartitions("key", "node").mapInArrow(packed, _MAIL)


def _groups(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Rows of one ``key``, at most ``most`` at once."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        for key, own in _stretches(batch.column("key").to_numpy()):
            rows = batch.slice(own.start, own.stop - own.start)
            while rows.num_rows:
                size = sum(b.num_rows for b in held)
                if held and (key != now or size == most):
                    yield now, pa.concat_batches(held)
                    held, size = [], 0
                now = key
                held.append(rows.slice(0, most - size))
                rows = rows.slice(most - size)
    if held:
        yield now, pa.concat_batches(held)


def _asking(part: int, own: dict, mail: list) -> Iterator[Row]:
    """To the parts of the nodes that a group's queries look at next: the pairs, and the queries' vectors."""
    order = np.argsort(own["ahead_id"], kind="stable")
    q, ids = own["ahead_q"][order], own["ahead_id"][order]
    for to, here in _stretches(ids >> BITS):
        some, at = np.unique(q[here], return_inverse=True)
        yield to, 1, part, {"q": some, "x": own["x"][some], "worst": own["worst"][some], "at": at, "ids": ids[here]}, 0, 0


def _measured(part: int, own: dict | None, mail: list) -> Iterator[Row]:
    """To a group: distances to a part's nodes, and the neighbours of those that are near enough for the beam."""
    if own is None:
        return
    for _, sender, m in mail:
        at = np.minimum(np.searchsorted(own["ids"], m["ids"]), len(own["ids"]) - 1)
        here = own["ids"][at] == m["ids"]
        at, q = at[here], m["at"][here]
        d = np.sqrt(np.square(m["x"][q].astype(np.float64) - own["x"][at].astype(np.float64)).sum(axis=1))
        near = np.flatnonzero(d <= m["worst"][q])
        nexts = own["v"][at[near]]
        row, column = np.nonzero(nexts != _NONE)
        found = {"q": m["q"][q], "id": own["ids"][at], "name": own["names"][at], "d": d}
        yield sender, 1, part, found | {"from": near[row], "next": nexts[row, column]}, 0, 0


def _walked(beam: int, part: int, own: dict, mail: list) -> Iterator[Row]:
    """A group after a hop: its beams, all that its queries met, and what they look at next."""
    got = [m for _, _, m in mail]
    fresh = {c: np.concatenate([own["beam_" + c][:0], *(m[c] for m in got)]) for c in ("q", "id", "name", "d")}
    starts = np.cumsum([0, *(len(m["q"]) for m in got)])
    came = np.concatenate([np.zeros(0, np.int64), *(m["from"] + s for m, s in zip(got, starts))])
    nexts = np.concatenate([np.zeros(0, np.int64), *(m["next"] for m in got)])
    both = {c: np.concatenate([own["beam_" + c], fresh[c]]) for c in fresh}
    order, rank = _ranks(both["name"], both["d"], both["q"])
    last = order[rank == beam - 1]
    worst = np.full(len(own["q"]), np.inf)
    worst[both["q"][last]] = both["d"][last]
    order = order[rank < beam]
    kept = np.zeros(len(both["q"]), bool)
    kept[order] = True
    # neighbours of the nodes that came into a beam, each once, without those met before
    into = kept[len(own["beam_q"]) :][came]
    q, ids = fresh["q"][came[into]], nexts[into]
    met_q, met_id = np.concatenate([own["met_q"], fresh["q"]]), np.concatenate([own["met_id"], fresh["id"]])
    every_q, every_id = np.concatenate([met_q, q]), np.concatenate([met_id, ids])
    order2 = np.lexsort((every_id, every_q))  # stable: those met come first
    a, b = every_q[order2], every_id[order2]
    once = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
    ahead = order2[once & (order2 >= len(met_q))]
    now = {"q": own["q"], "x": own["x"], "worst": worst, "met_q": met_q, "met_id": met_id, "ahead_q": every_q[ahead], "ahead_id": every_id[ahead]}
    yield part, 0, part, now | {"beam_" + c: both[c][order] for c in both}, len(ahead), len(met_q)


def search(graph: DataFrame, nodes: DataFrame, queries: DataFrame, beam: int = BEAM) -> DataFrame:
    """``q, node, d``: the nearest ``beam`` nodes found for each of ``queries (q, vector, start)``.

    ``graph``: from :func:`build_graph`, or rows ``u, v`` over ``nodes (node, vector)``.
    """
    places = shared.keep(_places(graph, nodes))
    started = queries.join(_named(places).withColumnRenamed("node", "start"), "start")

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups() -> Iterator[Row]:
            task = TaskContext.get().partitionId()
            for number, (_, batch) in enumerate(_groups(batches, TOGETHER)):
                part, m = (task << 32) + number, batch.num_rows
                none, ids = np.zeros(0, np.int64), batch.column("id").to_numpy()
                own = {"q": batch.column("q").to_numpy(), "x": _raw(batch.column("vector")), "worst": np.full(m, np.inf), "met_q": none, "met_id": none}
                own |= {"ahead_q": np.arange(m), "ahead_id": ids, "beam_q": none, "beam_id": none, "beam_name": none, "beam_d": np.zeros(0)}
                yield part, 0, part, own, m, 0

        return _written(groups())

    near = started.select(F.shiftright("id", BITS).alias("key"), "q", "vector", "id").repartition("key").sortWithinPartitions("key", "q")
    groups = shared.keep(near.mapInArrow(grouped, _MAIL))
    while groups.agg(F.sum("open")).first()[0]:
        replies = _met(_measured, places, _alone(_asking, groups))
        groups = _replaced(groups, _met(partial(_walked, beam), groups, replies))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column("body"):
                own = _content(body)
                columns = own["q"][own["beam_q"]], own["beam_name"], own["beam_d"]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["q", "node", "d"])

    return groups.mapInArrow(rows, "q long, node long, d double")


def nearest(
    rows: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = NEAREST
) -> DataFrame:
    """``query_id, rank, vec_id, score``: of each row with ``is_query`` (over ``vec_id``) the ``k`` nearest others."""
    all_rows = shared.keep(usable(rows, vec_id, vector))
    nodes = shared.keep(all_rows.groupBy("vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")))
    # a vector that stands once is a node by its own id, and needs no join
    copied = shared.keep(nodes.filter("copies > 1").select("vector", "node"))
    member = shared.keep(all_rows.join(copied, "vector", "left").select("vec_id", F.coalesce("node", "vec_id").alias("node")))
    graph = build_graph(nodes)
    chosen = member.filter(is_query)
    starts = chosen.select("node").distinct()
    queries = shared.keep(starts.join(nodes, "node").select(F.col("node").alias("q"), "vector", F.col("node").alias("start")))
    # equal query rows share one search
    found = _top(search(graph, nodes, queries), "q", k + 1, "d", "node")
    # of a node's rows only the first few can be among the nearest
    few = _top(member, "node", k + 1, "vec_id")
    rows_found = found.join(few, "node").select("q", "vec_id", "d")
    best = shared.keep(_top(rows_found, "q", k + 1, "d", "vec_id"))
    answers = chosen.select(F.col("vec_id").alias("query_id"), F.col("node").alias("q")).join(best, "q").filter("vec_id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("d", "vec_id"))
    return answers.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", F.col("d").alias("score"))


def brute_force(rows: list[tuple[int, list[float]]], queries: list[int], k: int = NEAREST) -> pd.DataFrame:
    """Exact answers for small tables, to measure recall against."""
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float64)
    out = []
    for q in queries:
        d = np.sqrt(np.square(x - x[ids == q][0]).sum(axis=1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:k]
        out += [(q, r + 1, int(ids[i]), float(d[i])) for r, i in enumerate(order)]
    return pd.DataFrame(out, columns=["query_id", "rank", "vec_id", "score"])
