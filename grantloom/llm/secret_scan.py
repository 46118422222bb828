"""Secrets in text: fixed patterns, and values that stand where a credential stands and are hard to guess.

The patterns find assignments, access keys and hex strings. Besides, a value in a credential's
place (``pwd: ...``, ``passphrase is ...``, ``Bearer ...``) is priced by the cheapest way to
guess it: dynamic programming over its characters, where a stretch may be a known word, a date,
a repeated character, a walk along the keyboard or through the alphabet, or brute force. Known
are common parts of passwords and the ``MOST_WORDS`` most frequent words of the corpus, counted over
all its rows outside credential places; a word of rank r costs ``log2(r + 1)`` bits. The cost is in bits; a value of at least ``LEAST_BITS`` becomes a span of kind ``guess``, unless
spans of the patterns cover it whole. The place's name may be part of a longer one
(``DB_PASSWORD``, ``aws_secret_access_key``, ``clientSecret``). A value is the whole run of visible characters, however long,
or what stands up to the closing quote where it opens with one; pricing takes time in proportion to it and stops once no way can stay below ``LEAST_BITS``.

Offsets are code points, ends exclusive. Null text: no spans. Texts are scanned whole, row by
row, so repeated rows give equal results; only word counts are shuffled. Words are runs of 4 to 24
ASCII letters, in any case, that occur twice or more; of equally frequent ones the first by name ranks first.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared, texts

ASSIGN, ACCESS, HEX, GUESS = "assign", "access", "hex", "guess"
KINDS = (ASSIGN, ACCESS, HEX, GUESS)
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
#: A value counts as a secret from this many bits on.
LEAST_BITS = 40.0
MASK = "[SECRET]"
#: Most words of the corpus that have a price, and different words that a task counts before it passes them on.
MOST_WORDS, COUNTED = 65_536, 300_000
#: Equal characters that a word, a date or a walk may share with a run beside it, at most.
EDGE = 8

_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]{%d,}" % (LEAST_ACCESS - 4))
_HEX = re.compile(rb"[0-9a-f]{%d,}" % LEAST_HEX)
# a place is found by its whole name, so that each name is read once; then the name is looked at
_PLACE = re.compile(
    rb"""(?<![A-Za-z0-9_-])(?:([A-Za-z0-9_-]++)["']?\x20*(?:[:=]|\x20is\x20)|[A-Za-z0-9_-]*?(?<![A-Za-z0-9])bearer\x20)\x20*["']?""",
    re.I,
)
_NAME = re.compile(
    rb"""(?:(?<![A-Za-z0-9])|(?-i:(?<=[a-z0-9])(?=[A-Z])))"""
    rb"""(?:pass(?:word|wd|phrase|code)|pwd|secret|token|credentials?|api[_-]?key|auth[_-]?key|access[_-]?key|private[_-]?key)"""
    rb"""(?:$|(?=[_0-9])|(?-i:(?<=[a-z])(?=[A-Z]))|(?=-(?:key|secret|token|value)))""",
    re.I,
)
_VALUE = re.compile(rb"[!-~]{6,}")
LEAST_VALUE = 6
_WORD = re.compile(rb"(?<![a-z])[a-z]{4,24}(?![a-z])")
_ASSIGN_WORDS = (b"passw", b"secret", b"token", b"api")
_PLACE_WORDS = (b"passw", b"passphrase", b"passcode", b"pwd", b"secret", b"token", b"credential", b"key", b"bearer")

# fixed values: common parts of passwords, and keyboard rows
WORDS = (
    "password pass admin root user login welcome master secret token test guest demo default changeme letmein "
    "monkey dragon shadow sunshine princess football baseball superman batman iloveyou love hello freedom whatever "
    "trustno ninja mustang access flower summer winter spring autumn computer internet server service company "
    "example sample dummy value none null true false your here"
).split()
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
_DATES = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d")
_WALKS = tuple(way for row in ROWS for way in (row, row[::-1]))


class Words:
    """Bits of known words: the fixed ones, and those of a corpus by their rank."""

    def __init__(self, ranked: Sequence[str] = ()):
        self.bits = dict.fromkeys(WORDS, math.log2(len(WORDS)))
        for rank, word in enumerate(ranked, 1):
            self.bits[word] = min(math.log2(rank + 1), self.bits.get(word, math.inf))
        self.sizes = sorted({len(w) for w in self.bits}, reverse=True)


FIXED = Words()


def _brute(value: str) -> float:
    """Bits of one character under brute force, by the alphabet that the value draws on."""
    kinds = ((str.islower, 26), (str.isupper, 26), (str.isdigit, 10))
    size = sum(n for test, n in kinds if any(map(test, value)))
    if any(not c.isalnum() for c in value):
        size += 33
    return math.log2(max(size, 10))


@lru_cache(100_000)
def guess_bits(value: str, enough: float = math.inf, words: Words = FIXED) -> float:
    """Least bits it takes to guess ``value``, over all ways to divide it.

    Where every way costs ``enough`` before its end, a lower bound of at least that is returned.
    """
    n, low = len(value), value.lower()
    brute = _brute(value)
    cost = [0.0] + [math.inf] * n
    first = last = far = 0  # the run of one character around i, and the furthest place reached
    for i in range(n):
        here = cost[i]
        # every division goes on from a place ahead that has been reached
        if here >= enough and far - i <= 64 and min(cost[i : far + 1]) >= enough:
            return min(cost[i : far + 1])
        reach = [(i + 1, brute)]
        for size in words.sizes:
            part = low[i : i + size]
            if len(part) == size and part in words.bits:
                reach.append((i + size, words.bits[part] + (0 if value[i : i + size] == part else 1)))
        date = _DATES.match(value, i)
        if date:
            reach.append((date.end(), math.log2(365 * 100)))
        if i == last:
            first = i
            while last < n and value[last] == value[i]:
                last += 1
        # inside a run, words, dates and walks hold few equal characters, and to break it up otherwise costs more
        if i - first <= EDGE:
            for j in range(max(i + 3, last - EDGE), last + 1):
                reach.append((j, brute + math.log2(j - i)))
        for walk in _WALKS:
            at, j = walk.find(low[i]), i + 1
            while at >= 0 and j < n and walk[at + j - i : at + j - i + 1] == low[j]:
                j += 1
                if j - i >= 3:
                    reach.append((j, math.log2(2 * sum(map(len, ROWS))) + math.log2(j - i)))
        for j, bits in reach:
            # one bit for each seam
            cost[j] = min(cost[j], here + bits + (1.0 if bits != brute or j > i + 1 else 0.0))
            far = max(far, j)
    return cost[n]


def hard_to_guess(value: str, words: Words = FIXED) -> bool:
    # the table of known prices holds no long values
    price = guess_bits if len(value) <= 200 else guess_bits.__wrapped__
    return price(value, LEAST_BITS, words) >= LEAST_BITS


def _value(text: bytes, place: re.Match) -> tuple[int, int] | None:
    """The value in a credential's place: up to its closing quote, else the run of visible characters."""
    if place[1] is not None and not _NAME.search(place[1]):
        return None
    run = _VALUE.match(text, place.end())
    if not run:
        return None
    a, b = run.span()
    quote = text[a - 1 : a]
    if quote in (b'"', b"'"):
        end = text.find(quote, a, b)
        while end > a and text[end - 1 : end] == b"\\":
            end = text.find(quote, end + 1, b)
        if end >= 0:
            return (a, end) if end - a >= LEAST_VALUE else None
    return a, a + len(run[0].rstrip(b".,;:!?)\"'"))


def _guesses(text: bytes, base: list[tuple[int, int, int]], words: Words) -> list[tuple[int, int]]:
    """Values that are hard to guess and that the spans ``base`` do not cover whole."""
    covered: list[list[int]] = []
    for a, b, _ in sorted(base):
        if covered and a <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], b)
        else:
            covered.append([a, b])
    found, at = [], 0
    while place := _PLACE.search(text, at):
        at = place.end()
        value = _value(text, place)
        if value is None:
            continue
        a, b = value
        k = bisect.bisect_right(covered, a, key=lambda x: x[0]) - 1
        if k >= 0 and covered[k][1] >= b:
            at = max(at, b)
        elif hard_to_guess(text[a:b].decode("latin-1"), words):
            found.append((a, b))
            at = b
    return found


def spans(text: bytes, words: Words = FIXED) -> list[tuple[int, str, int]]:
    """``(start, kind, end)`` in code points, by start, then kind as listed."""
    low = text.lower()
    found: list[tuple[int, int, int]] = []
    if any(w in low for w in _ASSIGN_WORDS):
        found += [(*m.span(), 0) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if b"AKIA" in text:
        found += [(*m.span(), 1) for m in _ACCESS.finditer(text)]
    found += [(*m.span(), 2) for m in _HEX.finditer(text)]
    if any(w in low for w in _PLACE_WORDS):
        found += [(a, b, 3) for a, b in _guesses(text, found, words)]
    found.sort(key=lambda x: (x[0], x[2], x[1]))
    if text.isascii() or not found:
        return [(a, KINDS[k], b) for a, b, k in found]
    at = {}
    done, points = 0, 0
    for place in sorted({p for a, b, _ in found for p in (a, b)}):
        points += len(text[done:place].decode())
        done, at[place] = place, points
    return [(at[a], KINDS[k], at[b]) for a, b, k in found]


def plain_words(text: bytes) -> list[bytes]:
    """The words of a text, in lower case, without the values in credential places."""
    low = text.lower()
    if any(w in low for w in _PLACE_WORDS):
        parts, done, at = [], 0, 0
        while place := _PLACE.search(text, at):
            at = place.end()
            value = _value(text, place)
            if value is not None:
                parts.append(low[done : value[0]])
                done = at = value[1]
        low = b" ".join([*parts, low[done:]])
    return _WORD.findall(low)


def frequent_words(df: DataFrame, text: str = "text", most: int = MOST_WORDS) -> Words:
    """Prices by the words of all rows; of the frequent ones those above the level that leaves at most ``most``.

    Levels are eighths of a doubling, so the driver gets their sizes and no more than ``most`` words.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = pa.array([w.decode() for w in found], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(found.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for row in texts.each_text(batch, text):
                found.update(plain_words(row))
                if len(found) >= COUNTED:
                    yield out()
                    found.clear()
        yield out()

    each = texts.narrow(df, text).mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    known = shared.keep(each.filter("n >= 2"))
    level = F.floor(F.log2("n") * 8).cast("int")
    sizes = known.groupBy(level.alias("level")).count().collect()  # at most 512 levels
    least, total = math.inf, 0
    for row in sorted(sizes, key=lambda r: -r["level"]):
        total += row["count"]
        if total > most:
            break
        least = row["level"]
    rows = known.filter(level >= least).collect() if least < math.inf else []
    shared.drop(known)
    return Words([r["word"] for r in sorted(rows, key=lambda r: (-r["n"], r["word"]))])


def mask(text: str, found: list[tuple[int, str, int]], by: str = MASK) -> str:
    """``text`` with every span, overlapping ones as one, replaced."""
    out, at = [], 0
    merged: list[list[int]] = []
    for a, _, b in sorted(found):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    for a, b in merged:
        out += [text[at:a], by]
        at = b
    return "".join([*out, text[at:]])


def _joined(found: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in found)


_FIELDS = (("n_assign", T.LongType()), ("n_access", T.LongType()), ("n_hex", T.LongType()), ("base_sha256", T.StringType()), ("spans", T.StringType()))


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, counts of the patterns, a digest of their spans, and all spans, of every row."""
    known = df.sparkSession.sparkContext.broadcast(frequent_words(df, text))

    def work(batches):
        words = known.value
        for batch in batches:
            rows = []
            for t in texts.each_text(batch, text):
                found = spans(t, words)
                base = [x for x in found if x[1] != GUESS]
                n = [sum(x[1] == k for x in base) for k in (ASSIGN, ACCESS, HEX)]
                rows.append((*n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(found)))
            columns = list(zip(*rows)) if rows else [[]] * len(_FIELDS)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield batch, [pa.array(c, k) for c, k in zip(columns, kinds)]

    found = texts.extend(texts.narrow(df, doc_id, text), T.StructType([T.StructField(n, t) for n, t in _FIELDS]), work)
    return found.drop(text)


def redact(df: DataFrame, text: str = "text", count: str | None = None) -> DataFrame:
    """``df`` with every secret in ``text`` masked; null stays null, other columns stay as they are.

    ``count`` names a column that holds the number of characters; it is counted anew.
    """
    name = texts.fresh("_masked", df.columns)
    known = df.sparkSession.sparkContext.broadcast(frequent_words(df, text))

    def work(batches):
        words = known.value
        for batch in batches:
            missing = batch.column(text).is_null().to_pylist()
            out = []
            for t, none in zip(texts.each_text(batch, text), missing):
                found = [] if none else spans(t, words)
                out.append(None if none else mask(t.decode(), found) if found else t.decode())
            yield batch, [pa.array(out, pa.string())]

    masked = texts.extend(df, T.StructType([T.StructField(name, T.StringType())]), work)
    new = {text: F.col(f"`{name}`")}
    if count in df.columns:
        new[count] = F.length(f"`{name}`").cast(df.schema[count].dataType)
    return masked.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns])
