from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from grantloom.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def answers(df, is_query):
    return {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in neighbours.nearest(df, is_query).collect()}


def exact(rows, queries):
    found = neighbours.brute_force([(i, np.float32(v)) for i, v, _ in rows], queries)
    return {(r.query_id, r.rank): (r.vec_id, r.score) for r in found.itertuples(index=False)}


def test_recall(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(5, 16))
    x = (centres[rng.integers(0, 5, 1500)] + rng.normal(size=(1500, 16))).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    got = answers(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0)
    want = exact(rows, list(range(0, 1500, 20)))
    assert got.keys() == want.keys()
    hits = sum(len({v for (q, _), (v, _) in got.items() if q == a} & {v for (q, _), (v, _) in want.items() if q == a}) for a in range(0, 1500, 20))
    assert hits / len(want) >= 0.9
    for (q, _), (v, score) in got.items():
        assert score == pytest.approx(math.sqrt(((x[q].astype(float) - x[v]) ** 2).sum()), rel=1e-12)


def test_few_copies_and_bad_vectors(spark):
    rows = [(i, [1.0, float(i // 30)], 0) for i in range(60)] + [(100, [0.0, -1.0], 0), (101, [5.0, 5.0], 0)]
    bad = [
        (200, None, 0), (201, [0.0, 0.0], 0), (202, [1.0, None], 0), (203, [float("nan"), 1.0], 0), (204, [float("inf"), 1.0], 0),
        (205, [1.0, 2.0, 3.0], 0), (None, [1.0, 1.0], 0), (206, [], 0),
    ]
    df = spark.createDataFrame([*rows, *bad, rows[0]], SCHEMA).selectExpr("*", "1 as node", "2 as vector", "3 as u", "4 as score")
    got = answers(df, F.col("vec_id") % 10 == 0)
    assert got == exact(rows, [*range(0, 60, 10), 100])


def test_fewer_candidates_than_asked(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [2.0, 0.0], 0)]
    got = neighbours.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0).collect()
    assert sorted((r["rank"], r.vec_id) for r in got) == [(1, 2), (2, 1)]
    assert neighbours.nearest(spark.createDataFrame(rows[:1], SCHEMA), F.col("vec_id") == 0).collect() == []
    assert neighbours.nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") == 0).collect() == []


def test_search_until_nothing_is_open(spark):
    """A chain far longer than ten hops: the query walks it to its end."""
    n = 16
    nodes = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(n)], "node long, vector array<double>")
    graph = spark.createDataFrame([(i, i + 1, 1.0) for i in range(n - 1)], "u long, v long, d double")
    query = spark.createDataFrame([(0, [float(n), 1.0], 0)], "q long, vector array<double>, start long")
    found = neighbours.search(graph, nodes, query, beam=3).collect()
    assert {r.node for r in found} == {n - 1, n - 2, n - 3}


def test_a_late_hop_joins_no_more_than_an_early_one(spark, monkeypatch):
    """What is kept reads the nodes once, however many hops came before."""
    joins, keep = [], neighbours.shared.keep

    def counted(df):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return keep(df)

    monkeypatch.setattr(neighbours.shared, "keep", counted)
    n = 6
    nodes = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(n)], "node long, vector array<double>")
    graph = spark.createDataFrame([(i, i + 1, 1.0) for i in range(n - 1)], "u long, v long, d double")
    query = spark.createDataFrame([(0, [float(n), 1.0], 0)], "q long, vector array<double>, start long")
    neighbours.search(graph, nodes, query, beam=3).collect()
    assert len(joins) > n and max(joins) <= 2


def test_rows_kept_are_parts_and_not_edges(spark, monkeypatch):
    """No step keeps a row for each edge, however many tasks there are; the graph is near the exact one."""
    rows, keep, n = [], neighbours.shared.keep, 700

    def counted(df):
        kept = keep(df)
        rows.append(kept.count())
        return kept

    monkeypatch.setattr(neighbours.shared, "keep", counted)
    x = np.random.default_rng(3).normal(size=(n, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        nodes = neighbours.usable(df).withColumnRenamed("vec_id", "node")
        graph = neighbours.build_graph(nodes)
        # -(-n // 256) runs, whatever the number of tasks
        assert graph.count() <= 2 * -(-n // 256)
        near = {}
        for u, v, d in neighbours.edges(graph).collect():
            near.setdefault(u, {})[v] = d
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert max(rows) <= n
    assert all(len(v) == neighbours.DEGREE and u not in v for u, v in near.items()) and len(near) == n
    far = np.sqrt(np.square(x[:, None].astype(float) - x[None]).sum(axis=2))
    hits = sum(len(near[u].keys() & set(np.argsort(far[u])[1 : neighbours.DEGREE + 1].tolist())) for u in range(n))
    assert hits / (n * neighbours.DEGREE) > 0.95
    assert all(d == pytest.approx(far[u, v], abs=1e-6) for u, found in near.items() for v, d in found.items())


def test_large_and_negative_ids(spark):
    """What numbers the nodes is not their ids."""
    ids = [-(2**62), -5, 0, 7, 2**62]
    rows = [(i, [1.0, float(at)], 0) for at, i in enumerate(ids)]
    got = answers(spark.createDataFrame(rows, SCHEMA), F.col("vec_id").isNotNull())
    assert got == exact(rows, ids)
