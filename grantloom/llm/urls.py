"""URL verdicts: host and path rules, else an exact list behind a blocked Bloom filter.

The list holds canonical addresses. A filter of blocks, each of eight 32-bit words, gets one bit
in every word for each address; it is built by a grouped bitwise or. It has a block for about
``LISTED`` addresses, which lets about one in a hundred others through, and never more than
``BLOCKS`` rows: these are what is broadcast. A list beyond ``BLOCKS * LISTED`` addresses lets
more through. Those that pass go to an exact join with the list, all others are allowed
without a shuffle.

Null urls and urls without ``://`` have an empty host and path, no rule and the verdict allow.
Repeated rows are judged row by row. An empty list blocks nothing by itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared, texts

#: (host, path, verdict)
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Addresses that share a block, and most blocks of 36 bytes: at most 19 MB for 8 million addresses.
LISTED, BLOCKS = 16, 1 << 19
_WORDS = 8
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without www. or m., path without index page, .html and closing slashes; null without a host."""
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"(/index)?(\.html?)?/*$", "")
    return F.when(host != "", F.concat(host, path))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _block(address: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(address), F.lit(blocks)).cast("int")


def _bits(address: Column) -> list[Column]:
    """One bit for each word of the block, from a second hash."""
    second = F.xxhash64(address, F.lit("bits"))
    return [
        F.call_function("shiftleft", F.lit(1), F.shiftrightunsigned(second, 5 * i).bitwiseAND(F.lit(31)).cast("int"))
        for i in range(_WORDS)
    ]


def bloom_filter(listed: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """``block, w0 .. w7`` for the column ``address`` of a list; at most ``blocks`` rows."""
    bits = _bits(F.col("address"))
    set_bits = listed.filter("address is not null").select(_block(F.col("address"), blocks).alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(bits)])
    return set_bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(_WORDS)])


def verdicts(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    page_id: str = "page_id",
    url: str = "url",
    blocks: int | None = None,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, listed`` of every page; ``listed`` has a column ``url``."""
    known = shared.keep(listed.select(canonical(F.col("url")).alias("address")).filter("address is not null").distinct())
    blocks = blocks or min(BLOCKS, known.count() // LISTED + 1)
    narrow = texts.narrow(pages, page_id, url).toDF("page_id", "url")
    named = narrow.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), canonical(F.col("url")).alias("address")
    ).withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    filter_rows = F.broadcast(bloom_filter(known, blocks))
    hit = F.lit(True)
    for i, bit in enumerate(_bits(F.col("address"))):
        hit = hit & (F.col(f"w{i}").bitwiseAND(bit) != 0)
    met = named.withColumn("block", _block(F.col("address"), blocks)).join(filter_rows, "block", "left")
    met = met.withColumn("possible", F.coalesce(hit, F.lit(False)) & F.col("address").isNotNull())
    columns = ["page_id", "host", "path", "address", "_rule"]
    possible, others = (met.filter(F.col("possible") == x).select(*columns) for x in (True, False))
    exact = known.withColumn("listed", F.lit(True))
    checked = possible.join(exact, "address", "left").select(*columns, F.coalesce("listed", F.lit(False)).alias("listed"))
    both = checked.unionByName(others.withColumn("listed", F.lit(False)))
    return both.select(
        "page_id",
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
        "listed",
    )
