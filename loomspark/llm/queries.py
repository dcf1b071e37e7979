"""Registered queries of the operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.session import table

from . import secrets
from .ann import search
from .decontamination import overlaps
from .line_dedup import drop_spread_lines
from .sharding import contiguous_shards
from .sentencepiece_codec import encode_decode
from .simhash import near_duplicates
from .surrogates import replace_checked
from .toxicity import held_out, score, train
from .url_filter import Rule, judge_urls


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Fixed values of the query.
URL_RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's overlaps with items of the benchmark; documents without any have no row."""
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SHARDS = 40


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard among 40 of nearly equal size, and its slot in it."""
    found = contiguous_shards(table(spark, sf_dir, "documents"), SHARDS)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL. Listed: the URLs of pages whose id `labels` marks as toxic or of low quality."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    marked = table(spark, sf_dir, "labels").where("toxic = 1 or quality = 0").select(F.col("doc_id").alias("page_id"))
    return judge_urls(pages, pages.join(marked, "page_id", "left_semi"), URL_RULES)


_CANON = """regexp_replace({host}, '^www\\.', '') || regexp_replace({path}, '/+$', '')
  || regexp_replace(regexp_replace(regexp_replace(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(\\?[^#]*)?', 3), ''),
     '([?&])(?:(?:utm_[a-z]+|ref|fbclid|gclid)=[^&]*(?:&|$))+', '\\1', 'g'), '[?&]$', ''), '^$', '')"""
OP4_SQL = f"""
with u as (
  select page_id, url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages),
c as (select *, {_CANON.format(host="host", path="path")} as canonical from u),
l as (select distinct canonical from c where canonical <> '' and page_id in (select doc_id from labels where toxic = 1 or quality = 0)),
r(verdict, rhost, rpath) as (values ('allow','org','/'), ('block','example.org','/es/'), ('block','example.org','/en/1'), ('allow','com','/fr/'), ('block','com','/de/')),
f as (
  select page_id, url, rhost || rpath as rule, verdict, row_number() over (partition by page_id, url order by length(rhost || rpath) desc) as k
  from c join r on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath))
select c.page_id, c.host, c.path, f.rule,
  coalesce(f.verdict, case when l.canonical is not null then 'block' else 'allow' end) as verdict, c.canonical
from c left join f on f.page_id = c.page_id and f.url = c.url and f.k = 1 left join l on l.canonical = c.canonical
"""


#: Secret of the query's surrogates. Production passes its own.
PII_KEY = b"surrogate key of the registered query"


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by surrogates."""
    found = replace_checked(table(spark, sf_dir, "documents"), PII_KEY)
    kinds = F.array_join(F.array_sort(F.array_distinct("entities.kind")), ",")
    return found.select("doc_id", "text", F.size("entities").alias("n_entities"), kinds.alias("kinds"))


TOXIC_AT = 0.7


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, from labels of documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"), "worst"
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint (hexadecimal) and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and decoded text."""
    found = encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    forest = secrets.train(secrets.labelled_findings(spark))
    return secrets.scan(table(spark, sf_dir, "documents"), forest)


MIN_SITES = 5


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that spread over 5 sites or more and that another document owns."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return drop_spread_lines(docs, min_sites=MIN_SITES).select("doc_id", "text", "removed_lines")


OP10_SQL = f"""
with l as (
  select doc_id, coalesce(source, '') as site, i as pos, parts[i] as raw, trim(parts[i], ' ' || chr(9) || chr(13)) as line
  from (select doc_id, source, parts, unnest(range(1, len(parts) + 1)) as i
        from (select doc_id, source, string_split(text, chr(10)) as parts from documents where text is not null))),
s as (select line, min(doc_id) as owner from l where line <> '' group by line having count(distinct site) >= {MIN_SITES}),
m as (
  select l.doc_id, l.pos, l.raw,
    s.line is not null and (l.doc_id <> s.owner or row_number() over (partition by l.doc_id, l.line order by l.pos) > 1) as gone
  from l left join s on l.line = s.line),
t as (
  select doc_id, string_agg(raw, chr(10) order by pos) filter (where not gone) as text, cast(count(*) filter (where gone) as integer) as removed_lines
  from m group by doc_id)
select d.doc_id, case when d.text is null then null else coalesce(t.text, '') end as text, coalesce(t.removed_lines, 0) as removed_lines
from documents d left join t using (doc_id)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ann": op1_ann,
    "op2_decontamination": op2_decontamination,
    "op3_sharding": op3_sharding,
    "op4_url_filter": op4_url_filter,
    "op5_pii": op5_pii,
    "op6_toxicity": op6_toxicity,
    "op7_simhash": op7_simhash,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_secrets": op9_secrets,
    "op10_line_dedup": op10_line_dedup,
}
ORACLES: dict[str, str] = {"op4_url_filter": OP4_SQL, "op10_line_dedup": OP10_SQL}
