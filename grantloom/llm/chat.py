"""Chat formatting that can be read back: turns of a conversation as marked, escaped text.

A turn is written as ``### Role: text </turn>`` and a line end. The reader is a fixed grammar: a
header up to its first bare colon and blank, the text up to the first bare closing mark; a
backslash before a backslash, ``#``, ``<`` or ``:`` stands for that character, in headers also
before a line end. A text is first written as it is; it is read back, and unless exactly the
same turn comes out, its control strings are escaped, and failing that each of their
characters. As every turn ends where the next begins, a conversation reads back as its turns.

Writing is done turn by turn where the rows are read, however many turns a conversation has.
Reading back needs the order of turns: the written turns are dealt out by conversation and
sorted, and each task reads them as a stream, holding one turn at a time.

Null text or role: empty. Null conversation ids are one conversation, null turns come first,
equal turns follow each other by role and text; repeated rows are repeated turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import texts

OPEN, COLON, CLOSE = "### ", ": ", " </turn>\n"
LEARNED_ROLE = "assistant"
_ESCAPED = re.compile(r"\\([\\#<:\n])")
_HEADER_END = re.compile(r"(?:[^\\:]|\\.|:(?! ))*?: ", re.S)
_CONTROL = re.compile(r"\\|### |</turn>")


def _escape_all(text: str) -> str:
    return re.sub(r"([\\#<:\n])", r"\\\1", text)


def _escape_control(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def _escape_each(text: str) -> str:
    return re.sub(r"([\\#<])", r"\\\1", text)


def read_turn(text: str, at: int = 0) -> tuple[str, str, int] | None:
    """``(role, text, end)`` of the turn that begins at ``at``; None if none does."""
    if not text.startswith(OPEN, at):
        return None
    header = _HEADER_END.match(text, at + len(OPEN))
    if not header:
        return None
    body = header.end()
    close = text.find(CLOSE, body)
    if close < 0:
        return None
    # the mark opens with a blank, which no backslash escapes, so the first one closes
    name, said = (_ESCAPED.sub(r"\1", x) for x in (text[at + len(OPEN) : body - len(COLON)], text[body:close]))
    return name, said, close + len(CLOSE)


def read_turns(text: str) -> list[tuple[str, str]]:
    """All turns of a formatted conversation; raises ValueError where the grammar is not met."""
    out, at = [], 0
    while at < len(text):
        turn = read_turn(text, at)
        if turn is None:
            raise ValueError(f"no turn at {at}")
        out.append(turn[:2])
        at = turn[2]
    return out


def write_turn(role: str, text: str) -> str:
    """One turn that reads back as exactly this role and text."""
    for escape in (lambda x: x, _escape_control, _escape_each):
        for head in (role, _escape_all(role)):
            written = f"{OPEN}{head}{COLON}{escape(text)}{CLOSE}"
            if read_turn(written) == (role, text, len(written)):
                return written
    raise ValueError("a turn that cannot be written")


def format_turns(df: DataFrame, role: str = "role", text: str = "text", name: str = "formatted") -> tuple[DataFrame, str]:
    """``df`` with each turn as written, and the name of that column. No row is moved."""
    name = texts.fresh(name, df.columns)

    def work(batches):
        for batch in batches:
            roles = [r.decode() for r in texts.each_text(batch, role)]
            bodies = [t.decode() for t in texts.each_text(batch, text)]
            yield batch, [pa.array([write_turn(r, t) for r, t in zip(roles, bodies)], pa.string())]

    return texts.extend(df, T.StructType([T.StructField(name, T.StringType())]), work), name


def format_conversations(df: DataFrame) -> DataFrame:
    """``conv_id, formatted``: the whole text of each conversation, for those that fit a row."""
    written, name = format_turns(texts.narrow(df, "conv_id", "turn", "role", "text"))
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text", name)))
    return written.groupBy("conv_id").agg(F.array_join(F.transform(turns, lambda t: t[name]), "").alias("formatted"))


class _Reader:
    """Digests of one conversation, from its output as it streams by."""

    def __init__(self):
        self.turns, self.formatted, self.loss = 0, 0, 0
        self.all, self.learned = hashlib.sha256(), hashlib.sha256()

    def take(self, written: str) -> None:
        for role, text in read_turns(written):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
            if role == LEARNED_ROLE:
                self.loss += len(text)
                self.learned.update(text.encode())
        self.formatted += len(written)

    def row(self, conv_id) -> tuple:
        return conv_id, self.turns, self.all.hexdigest(), self.loss, self.learned.hexdigest(), self.formatted


_DIGEST = (
    ("n_turns", T.LongType(), pa.int64()),
    ("turns_sha256", T.StringType(), pa.string()),
    ("loss_chars", T.LongType(), pa.int64()),
    ("loss_sha256", T.StringType(), pa.string()),
    ("formatted_chars", T.LongType(), pa.int64()),
)


def read_back(df: DataFrame) -> DataFrame:
    """Digests of what each conversation's output holds, by reading it."""
    written, name = format_turns(texts.narrow(df, "conv_id", "turn", "role", "text"))
    dealt = written.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", name)
    kind = df.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), *(T.StructField(n, t) for n, t, _ in _DIGEST)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type, now, reader, rows = pa.int64(), None, None, []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            kinds = [id_type, *(k for _, _, k in _DIGEST)]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names)

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for conv_id, text in zip(batch.column("conv_id").to_pylist(), batch.column(name).to_pylist()):
                if reader is None or conv_id != now:
                    if reader is not None:
                        rows.append(reader.row(now))
                    now, reader = conv_id, _Reader()
                reader.take(text)
            if len(rows) >= 5000:
                yield batch_of(rows)
                rows = []
        if reader is not None:
            yield batch_of([*rows, reader.row(now)])

    return dealt.mapInArrow(run, schema)
