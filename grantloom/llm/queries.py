"""The operators over their whole tables, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, chat, infill, langid, neighbours, packing, quality, secret_scan, simhash, token_counts, toxicity, urls

Query = Callable[[SparkSession, str], DataFrame]

#: A conversation that quotes the template itself.
TRICKY = r"\### Assistant: </turn> ok"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and -7, formatted and read back."""
    extra = spark.createDataFrame(
        [(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], "conv_id long, turn long, role string, text string"
    )
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(turns.unionByName(extra))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")).drop("text")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 2048 tokens."""
    return packing.pack(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), added=True)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    found = simhash.near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of(F.col("print")).alias("fingerprint"), "component_id")


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth vector."""
    return neighbours.nearest(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality.verdicts(_read(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page. Listed are the addresses that pages were reached at through tracking links."""
    pages = _read(spark, sf_dir, "pages")
    return urls.verdicts(pages, pages.filter(F.col("url").contains("utm_")).select("url"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return langid.predictions(_read(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secret_scan.scan(_read(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether they are over 4096."""
    return token_counts.counts(_read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), 4096)


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut for filling in the middle, and restored from that."""
    cut, names = infill.transform(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    back, text = infill.restore(cut, names.output, names.form)
    digest = lambda name: F.sha2(F.col(name), 256)
    return back.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digest(names.output).alias("output_sha256"), digest(text).alias("restored_sha256"),
    )


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding with its cluster."""
    return centroids.with_inertia(*centroids.clusters(_read(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_chat_formatting,
        op2_byte_bpe,
        op3_packing,
        op4_toxicity,
        op5_simhash,
        op6_neighbours,
        op7_quality,
        op8_url_filter,
        op9_language,
        op10_secrets,
        op11_token_counts,
        op12_infill,
        op13_centroids,
    )
}

def _rounds(rounds: int = centroids.ROUNDS) -> str:
    """The rounds of op13: assignments ``a<i>`` to centroids ``c<i>``, one pair of tables a round."""
    assign = """
a{i} as materialized (
  select vec_id, v, k as cluster, d as distance from (
    select vec_id, v, k, list_sum(list_transform(list_zip(v, c), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) as d,
      row_number() over (partition by n order by d, k) as place
    from kept cross join c{i})
  where place = 1)"""
    move = """,
c{j} as materialized (
  select k, coalesce(m, c) as c from c{i} left join (
    select cluster, list(mean order by i) as m from (
      select cluster, i, cast(floor(sum(x) / count(*)) as bigint) as mean
      from (select cluster, unnest(v) as x, generate_subscripts(v, 1) as i from a{i})
      group by cluster, i)
    group by cluster) on cluster = k),"""
    return "".join(assign.format(i=i) + (move.format(i=i, j=i + 1) if i < rounds else "") for i in range(rounds + 1))


ORACLE: dict[str, str] = {
    "op8_url_filter": r"""
with parts as (
  select page_id, url,
    translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 2), '') as path
  from pages),
named as (
  select *, case when regexp_replace(host, '^(www|m)\.', '') <> ''
    then regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(/index)?(\.html?)?/*$', '') end as address
  from parts),
known as (select distinct address from named where url like '%utm\_%' escape '\' and address is not null),
ruled as (
  select n.page_id, n.host, n.path, k.address is not null as listed,
    case
      when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/en/1') then 'example.org/en/1'
      when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/es/') then 'example.org/es/'
      when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/fr/') then 'com/fr/'
      when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/de/') then 'com/de/'
      when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/') then 'org/'
    end as rule
  from named n left join known k using (address))
select page_id, host, path, rule,
  case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block'
    when listed then 'block' else 'allow' end as verdict,
  listed
from ruled
""",
    "op12_infill": """
with drawn as (
  select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n, sha256('1:' || coalesce(doc_id::varchar, '')) as h
  from documents),
numbers as (
  select *, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2, ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4
  from drawn),
cut as (
  select doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when n = 0 or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
      when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from numbers),
parts as (
  select *, substr(text, 1, a) as prefix, substr(text, a + 1, b - a) as middle, substr(text, b + 1) as suffix from cut)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from parts
""",
    "op13_centroids": """
with kept as materialized (
  select vec_id, row_number() over () as n, list_transform(embedding, lambda x: cast(floor(256 * x::double) as bigint)) as v
  from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: isfinite(x))) = 64),
c0 as materialized (
  select row_number() over (order by name, v) - 1 as k, v as c
  from (select sha256('2:' || coalesce(vec_id::varchar, '')) as name, v from kept order by name, v limit 40)),"""
    + _rounds()
    + """
select vec_id, cluster::int as cluster, distance::bigint as distance, sum(distance) over (partition by cluster)::bigint as cluster_inertia,
  sum(distance) over ()::bigint as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
from a5 join c5 on k = cluster
""",
}
