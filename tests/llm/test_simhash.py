from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from grantloom.llm import components, simhash

from .helpers import ODD, PROSE, clash, doc_rows, docs


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, bits=3):
    """Least id reachable, by comparing all pairs."""
    ids = list(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_fingerprints():
    for text in ODD:
        assert simhash.fingerprint((text or "").encode()) == plain_fingerprint(text)


def variants(n, seed=3):
    rng = random.Random(seed)
    words = PROSE.split() * 3
    out = []
    for _ in range(n):
        own = words[:]
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = rng.choice("abcdef")
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("chunk", [4096, 8])
def test_near_duplicates(spark, chunk):
    rows = doc_rows([*ODD, *variants(120)])
    got = {r[0]: (r[1] % (1 << 64), r[2]) for r in simhash.near_duplicates(clash(docs(spark, rows)), chunk=chunk).collect()}
    prints = {i: plain_fingerprint(t) for i, t, *_ in rows}
    groups = plain_groups(prints)
    assert got == {i: (prints[i], groups[i]) for i in prints}


def test_hex(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(0,), (-1,), (255,)], "x long").select(simhash.hex_of(F.col("x")).alias("h"))
    assert [r.h for r in df.collect()] == ["0" * 16, "f" * 16, "0" * 14 + "ff"]


def test_forest_spans_what_is_linked():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    prints = np.unique(np.concatenate([b ^ (np.uint64(1) << rng.integers(0, 20, 40).astype(np.uint64)) for b in base]))
    groups = plain_groups({i: int(p) for i, p in enumerate(prints)})
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    edges = simhash.forest(prints)
    for i, j in edges:
        assert int(prints[i] ^ prints[j]).bit_count() <= 3
        root[find(i)] = find(j)
    assert len({find(i) for i in root}) == len(set(groups.values()))
    assert len(edges) == len(prints) - len(set(groups.values()))


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(300, 300), (None, 5)]
    edges += [(rng.randint(400, 500), rng.randint(400, 500)) for _ in range(70)]
    got = {r[0]: r[1] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    near = {}
    for a, b in edges:
        if a is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for node in sorted(near):
        if node not in want:
            todo = [node]
            while todo:
                x = todo.pop()
                if x not in want:
                    want[x] = node
                    todo += near[x]
    assert got == want
    assert components.components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_one_of_each(spark):
    rows = [(5, PROSE, "en", "s", 1), (5, PROSE, "en", "s", 1), (3, PROSE + " ", "en", "s", 1), (9, "quite other words here", "en", "s", 1),
            (9, "quite other words here", "en", "s", 1), (None, "no id at all", "en", "s", 1), (None, "no id at all", "en", "s", 1)]
    got = simhash.one_of_each(clash(docs(spark, rows)))
    assert sorted(str(r.doc_id) for r in got.collect()) == ["3", "9", "None"]
    assert got.columns == clash(docs(spark, rows)).columns
    assert simhash.one_of_each(docs(spark, [])).collect() == []
    assert simhash.near_duplicates(docs(spark, [])).collect() == []


def test_one_of_each_of_edited_copies(spark):
    """Those within three bits of another go, chains of them too; those beyond stay."""
    rows = doc_rows([*variants(60), *ODD])
    groups = plain_groups({i: plain_fingerprint(t) for i, t, *_ in rows})
    assert 1 < len(set(groups.values())) < len(rows)
    kept = simhash.one_of_each(docs(spark, rows)).collect()
    assert {r.doc_id for r in kept} == set(groups.values())
