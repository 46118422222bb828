from __future__ import annotations

import gc
import hashlib
import tracemalloc
import weakref
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from grantloom.llm import bpe, packing, pretokens, toxicity

from .helpers import ODD, PROSE, clash, doc_rows, docs

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


def exact(path):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})


EXACT = exact(RANKS)


@settings(max_examples=500, deadline=None)
@given(st.text(max_size=40) | st.text(alphabet="ab 's\n\tre've.!é😀1٣\u00a0 ", max_size=60))
def test_encode_like_the_library(text):
    ids = bpe.encode_text(text, RANKS)
    assert ids == EXACT.encode_ordinary(text)
    assert bpe.decode_ids(ids, RANKS) == text.encode()


@pytest.mark.parametrize("path", [RANKS, MULTI])
def test_encode_odd_texts(path):
    other = exact(path)
    for text in ODD:
        if text is not None:
            assert bpe.encode_text(text, path) == other.encode_ordinary(text)


def test_long_texts_are_divided_where_words_begin():
    text = (PROSE + " 'tis  ") * 50
    raw = text.encode()
    words = bpe.loaded(RANKS)[1]
    cut = [words.of(p, o)[0].tolist() for p, o, _ in pretokens.pieces(raw, np.array([0, len(raw)]), 500)]
    assert len(cut) > 10 and sum(cut, []) == EXACT.encode_ordinary(text)


def test_a_full_word_table_is_emptied():
    words = pretokens.WordIds(bpe.loaded(RANKS)[0].words, limit=10)
    raw = PROSE.encode()
    for _ in range(3):
        assert words.of(raw, np.array([0, len(raw)]))[0].tolist() == EXACT.encode_ordinary(PROSE)


def test_digests(spark):
    df = docs(spark, doc_rows(ODD) + doc_rows(["again"]) + [(None, "no id", None, None, None)])
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(df.select("doc_id", "text"), RANKS).collect())
    want = []
    for doc_id, text, *_ in doc_rows(ODD) + doc_rows(["again"]) + [(None, "no id")]:
        ids = EXACT.encode_ordinary(text or "")
        shown = " ".join(map(str, ids)).encode()
        want.append((str(doc_id), len(ids), hashlib.sha256(shown).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want)


def test_encode_and_decode_columns(spark):
    df = clash(docs(spark, doc_rows(ODD[:9])))
    both = bpe.decode(bpe.encode(df, RANKS, ids="ids"), RANKS, ids="_ids", text="decoded")
    for row in both.collect():
        assert row["ids"] == "x-ids" and row["_decoded"] == (row["text"] or "").encode()
    assert bpe.encode(docs(spark, []), RANKS).collect() == []


# --- packing


def pieces(df, **how):
    return packing.pack(df, JSON, **how).collect()


def check(rows, found, window):
    """Every id in one piece, sequences gapless and within the window."""
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    want = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t, *_ in rows}
    sequences = {}
    for doc in want:
        own = sorted((r for r in found if r.doc_id == doc), key=lambda r: r.start)
        at = 0
        for r in own:
            assert r.start == at and r.length > 0 and r.doc_tokens == len(want[doc])
            assert r.ids_crc32 == zlib.crc32(np.array(want[doc][at : at + r.length], "<u4").tobytes())
            at += r.length
            sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert at == len(want[doc])
    sizes = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        sizes.append(at)
    return sizes


def test_pack(spark):
    rows = doc_rows([*ODD, *[PROSE * (1 + i % 7) for i in range(60)]])
    sizes = check(rows, pieces(clash(docs(spark, rows)).coalesce(1), window=256, block=3000), 256)
    padded = sum(256 - s for s in sizes if s & (s - 1))
    assert padded < 0.04 * sum(sizes)


def test_added_tokens_like_the_tokenizer_as_loaded(spark):
    end = "<|endoftext|>"
    texts = [*ODD, end, end * 3, f"a.{end} B {end}\n", "<|endoftext", "|>" + end[2:], f"{PROSE}{end}{PROSE}", f"it{end}'s é{end}é"]
    rows = doc_rows(texts)
    tokenizer = Tokenizer.from_file(JSON)
    want = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t, *_ in rows}
    assert want[texts.index("<|endoftext|> is text")][0] == 50256
    for found in (pieces(docs(spark, rows).coalesce(1), added=True, window=64), pieces(docs(spark, rows).repartition(3), added=True)):
        for i, ids in want.items():
            at = 0
            for r in sorted((r for r in found if r.doc_id == i), key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(ids)
                assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
                at += r.length
            assert at == len(ids)


def test_queries_pack_with_added_tokens(spark, tmp_path):
    import corpus_pipeline
    from grantloom.llm import queries

    df = docs(spark, doc_rows(["<|endoftext|> is text"]))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    crc = zlib.crc32(np.array([50256, 318, 2420, 1], "<u4").tobytes())
    for found in (queries.op3_packing(spark, str(tmp_path)), corpus_pipeline.pack(spark, df, str(tmp_path))):
        assert [r.ids_crc32 for r in found.collect()] == [crc]


def test_pack_null_ids_and_equal_rows(spark):
    rows = [(None, "a b", "en", "s", 3), (7, "a b", "en", "s", 3), (7, "a b", "en", "s", 3)]
    found = pieces(docs(spark, rows))
    assert sorted((str(r.doc_id), r.length) for r in found) == [("7", 3), ("7", 3), ("None", 3)]
    assert pieces(docs(spark, [])) == []


def brute_plan(ends, penalties, window, least):
    points = [0, *ends]
    cost, came = [0.0], [0]
    for j in range(1, len(points)):
        options = []
        for i in range(j):
            n = points[j] - points[i]
            if n <= window:
                full = n >= least and n & (n - 1) == 0
                options.append((cost[i] + (0 if full else window - n) + penalties[j - 1], i))
        best = min(options)
        cost.append(best[0])
        came.append(best[1])
    return cost[-1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.sampled_from([0.0, 2.0, 24.0])), min_size=1, max_size=60))
def test_plan_is_least(steps):
    ends = np.cumsum([n for n, _ in steps])
    penalties = np.array([p for _, p in steps])
    chosen = packing.plan(ends, penalties, 64, 8)
    cuts = [0, *ends[chosen].tolist()]
    assert cuts[-1] == ends[-1]
    total = 0.0
    for a, b, k in zip(cuts, cuts[1:], chosen):
        n = b - a
        assert 0 < n <= 64
        total += (0 if n >= 8 and n & (n - 1) == 0 else 64 - n) + penalties[k]
    assert total == pytest.approx(brute_plan(ends.tolist(), penalties.tolist(), 64, 8))


def test_a_long_word_takes_little_memory():
    rng = np.random.default_rng(2)
    word = bytes(rng.integers(97, 123, 1_000_000, dtype=np.uint8)).decode()
    encoder = bpe.loaded(RANKS)[0]
    encoder.word(word)  # what is remembered of pairs has a bound of its own
    tracemalloc.start()
    ids = encoder.word(word)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert list(ids[:1000]) == EXACT.encode_ordinary(word[:20_000])[:1000]
    assert "".join(EXACT.decode([*ids])) == word and peak < 25_000_000


def test_a_worker_keeps_one_stage_s_table():
    model = toxicity.Model(b"bad word", b"good word", b"frame", 1.0)
    words = packing.word_table(public_tokenizers.path("byte_bpe_50k.json"))
    assert packing.word_table(public_tokenizers.path("byte_bpe_50k.json")) is words
    assert toxicity.windows_of(model) is toxicity.windows_of(model)
    freed = weakref.ref(words)
    del words
    gc.collect()
    assert freed() is None


def test_class_table_takes_little_memory():
    tracemalloc.start()
    pretokens.classes.__wrapped__()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 40e6
