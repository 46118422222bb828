from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from grantloom.llm import centroids, infill, token_counts

from .helpers import ODD, PROSE, clash, doc_rows, docs

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PLAIN = sentencepiece.SentencePieceProcessor(model_file=MODEL)
MORE = ["  two  blanks ", "▁mark ▁▁", "<s> </s> <unk> <0x0A>", "word\n\n\tword", "ééé́", "aaa bbb" * 3000, "日本語" * 4000]


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="abe 's\n\t<s>/unk▁_1é😀\x00 ", max_size=80))
def test_counts_like_the_library(text):
    assert token_counts.count_text(text, MODEL) == len(PLAIN.encode(text))


@pytest.mark.parametrize("frequent", [0, 30, 65_536])
def test_token_counts(spark, frequent):
    texts = [*ODD, *MORE, PROSE, PROSE]
    rows = [*doc_rows(texts), (None, "no id", None, None, 5), (3, "again", "en", "s", 5), (3, "again", "en", "s", 5)]
    found = token_counts.counts(clash(docs(spark, rows)), MODEL, 100, frequent=frequent)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = []
    for i, text, *_ in rows:
        n = len(PLAIN.encode(text or ""))
        want.append((i, len((text or "").encode()), n, n > 100))
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(want, key=key)
    assert token_counts.counts(docs(spark, []), MODEL, 100, frequent=frequent).collect() == []


def test_blocks_of_characters(monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK", 7)
    for text in [*ODD[:8], *ODD[11:], *MORE[:5]]:
        assert token_counts.count_text(text or "", MODEL) == len(PLAIN.encode(text or ""))


def plain_infill(doc_id, text, cut=90, first=20, marks=infill.MARKS):
    """Form, prefix, middle and output, character by character."""
    text = text or ""
    p, s, m = marks
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted(x % (len(text) + 1) for x in h[:2])
    if not text or any(x in text for x in marks) or h[2] % 100 >= cut:
        return "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < first:
        return "spm", a, b - a, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return "psm", a, b - a, f"{p}{prefix}{s}{suffix}{m}{middle}"


MARKED = ["<P>", "a<S>b", "<M", "<<P", "x<", ">P", "<P><S><M>", "S> <", "é<M>é"]


@pytest.mark.parametrize("block", [5, 1 << 20])
@pytest.mark.parametrize("cut, first", [(90, 20), (100, 0), (100, 100), (0, 50)])
def test_infill(spark, block, cut, first):
    texts = [*ODD, *MARKED, *MORE] if block > 5 else [*ODD[:8], *MARKED, *MORE[:5]]
    rows = [*doc_rows(texts), *[(1000 + i, "日本 text é😀" * (i % 5), "x", "y", 1) for i in range(150)], (None, "no id", None, None, 5), (4, "x", "en", "s", 1)]

    def run(batch_rows):
        df, names = infill.transform(clash(docs(spark, batch_rows)).withColumnRenamed("score", "Output"), cut=cut, suffix_first=first)
        back, text = infill.restore(df, names.output, names.form)
        assert names.output == "_output" and {"Output", "lang"} <= set(back.columns)
        return back.select("doc_id", "text", *names, text).collect()

    # small blocks inside the tasks: the worker's own copy of the module is asked for them
    if block == 5:
        for rows_ in [rows[:30], rows[30:]]:
            check_blocks(rows_, cut, first)
        return
    for row in run(rows):
        form, prefix, middle, output = plain_infill(row[0], row[1], cut, first)
        assert tuple(row[2:]) == (len(row[1] or ""), form, prefix, middle, output, row[1] or "")
    assert run([]) == []


def check_blocks(rows, cut, first):
    """The steps on one buffer, in blocks of a few bytes."""
    old, infill.BLOCK = infill.BLOCK, 5
    try:
        want = [plain_infill(i, t, cut, first) for i, t, *_ in rows]
        raw = [(t or "").encode() for _, t, *_ in rows]
        data = np.frombuffer(b"".join(raw), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        before = infill._points_before(data, offsets)
        assert np.diff(before).tolist() == [len(t or "") for _, t, *_ in rows]
        cuts = np.array([[a or 0, (a or 0) + (b or 0)] for _, a, b, _ in want])
        cuts = infill._bytes_of(data, (before[:-1, None] + cuts).ravel()).reshape(-1, 2)
        cuts = np.minimum(cuts, offsets[1:, None])
        form = np.array([infill.FORMS.index(f) for f, *_ in want])
        marks = infill._checked(infill.MARKS)
        out, at = infill.arrange(data, offsets, form, cuts, marks)
        assert [out[a:b].tobytes().decode() for a, b in zip(at[:-1], at[1:])] == [w[3] for w in want]
        back, back_at = infill.rearrange(out, at, form, marks)
        assert back.tobytes() == data.tobytes() and (back_at == offsets).all()
    finally:
        infill.BLOCK = old


def test_infill_marks():
    assert infill._checked(("[p]", "[s]", "[m]")) == [b"[p]", b"[s]", b"[m]"]
    for marks in [("ab", "bc", "x"), ("a", "xay", "z"), ("aba", "x", "y"), ("a", "a", "b"), ("", "a", "b")]:
        with pytest.raises(ValueError):
            infill._checked(marks)


def test_damaged_output(spark):
    df = spark.createDataFrame([("<P>a<S>b", "psm")], "output string, form string")
    with pytest.raises(Exception, match="each mark once"):
        infill.restore(df)[0].collect()
    assert infill.restore(spark.createDataFrame([(None, None)], "output string, form string"))[0].first().restored == ""


def plain_clusters(rows, clusters, rounds, size, scale=256):
    """``(vec_id, cluster, distance)`` with Python's whole numbers, and the centroids."""
    kept = []
    for i, x in rows:
        if x is not None and len(x) == size and all(c is not None and math.isfinite(c) for c in x):
            kept.append((i, [math.floor(scale * c) for c in x]))
    name = lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centres = [v for _, v in sorted(kept, key=name)[:clusters]]
    away = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    for number in range(rounds + 1):
        found = [(i, *min((k, away(v, c)) for k, c in enumerate(centres) if away(v, c) == min(away(v, d) for d in centres)), v) for i, v in kept]
        if number < rounds:
            for k in range(len(centres)):
                mine = [v for _, c, _, v in found if c == k]
                if mine:
                    centres[k] = [sum(x) // len(mine) for x in zip(*mine)]
    return [(i, k, d) for i, k, d, _ in found] if kept else [], centres


@pytest.mark.parametrize("n, clusters, size, spread", [(60, 7, 6, 1), (5, 9, 3, 1), (40, 4, 2, 100_000), (0, 3, 4, 1)])
def test_centroids(spark, n, clusters, size, spread):
    rng = random.Random(n)
    rows = [(i, [round(rng.uniform(-spread, spread), 2) for _ in range(size)]) for i in range(n)]
    rows += rows[:3] * 4 + [(None, x) for _, x in rows[:2]]
    rows += [(900, None), (901, [1.0] * (size - 1)), (902, [None] * size), (903, [float("nan")] * size), (904, [float("inf")] * size), (905, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as cluster", "'x' as V", "2 as distance", "3 as dots")
    found, centres = centroids.clusters(df, size=size, clusters=clusters, rounds=4)
    want, want_centres = plain_clusters(rows, clusters, 4, size)
    key = lambda r: (r[0] is None, r)
    got = [(r.vec_id, r.cluster, r.distance) for r in found.collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert centres.tolist() == want_centres
    total = sum(d for *_, d in want)
    for row in centroids.with_inertia(found, centres).collect():
        assert row.inertia == total and row.cluster_inertia == sum(d for _, k, d in want if k == row.cluster)
        assert row.centroid_sha256 == hashlib.sha256(",".join(map(str, want_centres[row.cluster])).encode()).hexdigest()


def test_components_too_large(spark):
    df = spark.createDataFrame([(1, [1e9, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="exceeds"):
        centroids.clusters(df, size=2)


def test_products_follow_moves():
    rng = np.random.default_rng(3)
    vectors, centres = rng.integers(-500, 500, (50, 8)), rng.integers(-500, 500, (6, 8))
    dots = vectors @ centres.T
    moves = np.where(rng.random((6, 8)) < 0.3, rng.integers(-9, 9, (6, 8)), 0)
    moves[2] = 0
    centroids.add_products(dots, vectors, moves)
    assert (dots == vectors @ (centres + moves).T).all()
