from __future__ import annotations

import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names operators also use for their results.
CLASHING = (
    "score", "SCORE2", "predicted", "held_out", "print", "fingerprint", "component_id", "kept", "base_failed", "distance",
    "n_words", "key", "centre", "lang_pred", "spans", "n_hex", "length", "start", "ids", "decoded", "formatted", "address", "block",
)


def docs(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def doc_rows(texts, lang="en", source="s"):
    return [(i, t, lang, source, None if t is None else len(t)) for i, t in enumerate(texts)]


def clash(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(f"x-{c}").alias(c) for c in CLASHING])


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


PROSE = (
    "The river ran past the old mill and the children watched it from the bridge. Nobody spoke for a while.\n"
    "Later the miller came out, shook the dust from his coat, and told them that the wheel would turn again in spring. "
    "They did not believe him; the stones were cracked and the roof had fallen in years ago! Still they waited."
)
ODD = [
    None, "", " ", "a", "one two", "one two three", PROSE, PROSE, PROSE.replace("river", "stream"),
    "x" * 50_000, "word " * 20_000, "日本語のテキスト é ß 😀 ٣ ½", "it's we'll don't 'S they're", "a\u00a0b\u2028c\x1c d\x85",
    "   lead  and trail   ", "tab\tand\n\n\nlines\r\n", "<|endoftext|> is text", "ZERO\x00BYTE",
]
