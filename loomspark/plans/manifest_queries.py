"""Manifests, joins, routing, timelines, sampling and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.operators import manifest as M
from loomspark.operators import metrics as K
from loomspark.operators import prepare as Q
from loomspark.operators import review as R
from loomspark.operators import sampling as S
from loomspark.operators import timeline as L
from loomspark.operators import transcripts as T
from loomspark.plans.registry import register
from loomspark.session import table


@register(
    "manifest_union_merge",
    """select 'documents' as manifest, 'd' || doc_id as id, length(text) as chars, source from documents
union all select 'benchmark', 'b' || item_id, length(text), null from benchmark""",
)
def manifest_union_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.col("doc_id")).alias("id"), F.length("text").cast("long").alias("chars"), "source")
    bench = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("b"), F.col("item_id")).alias("id"), F.length("text").cast("long").alias("chars"))
    return M.merge({"documents": docs, "benchmark": bench}, required=["chars"], unique=["id"]).select("manifest", "id", "chars", "source")


@register("duplicate_report", "select md5(text) as text_md5, count(*) as copies, min(doc_id) as first_at, max(doc_id) as last_at from documents where text is not null group by text having count(*) > 1")
def duplicate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("text_md5"))
    return M.duplicates(docs, "text_md5", "doc_id")


@register("shard_roundtrip", "select o_orderkey, cast((row_number() over (order by o_orderkey) - 1) % 7 as integer) as shard, o_totalprice from orders")
def shard_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    # Row numbers by bucket of the key, with offsets from the buckets' counts: no task sorts the whole table.
    low, high = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    bucket = F.floor((F.col("o_orderkey") - F.lit(low)) * 255 / F.lit(max(1, high - low)))
    numbered = S.ranked(orders, [F.col("o_orderkey")], bucket)
    sharded = numbered.withColumn("shard", M.stride_shard(F.col("pos"), 7)).withColumn("seq", F.lit(0))
    return M.restore_order(numbered.select("o_orderkey", "pos"), sharded.drop("pos"), "o_orderkey", "pos").select("o_orderkey", "shard", "o_totalprice")


@register(
    "contiguous_shards",
    """with n as (select count(*) as n from customer), r as (select c_custkey, row_number() over (order by c_custkey) - 1 as i from customer)
select cast(floor(i / ceil(n / 7.0)) as integer) as shard, count(*) as rows, min(c_custkey) as first_key, max(c_custkey) as last_key from r, n group by 1""",
)
def contiguous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    n, low, high = customers.agg(F.count("*"), F.min("c_custkey"), F.max("c_custkey")).first()
    bucket = F.floor((F.col("c_custkey") - F.lit(low)) * 255 / F.lit(max(1, high - low)))
    placed = S.ranked(customers, [F.col("c_custkey")], bucket)
    shard = M.contiguous_shard(F.col("pos"), n, 7)
    return placed.groupBy(shard.alias("shard")).agg(F.count("*").alias("rows"), F.min("c_custkey").alias("first_key"), F.max("c_custkey").alias("last_key"))


@register(
    "skip_histogram",
    """select skip_reason, count(*) as rows from (select case when coalesce(trim(text), '') = '' then 'empty_text' when n_chars < 64 then 'too_short'
  when n_chars > 20000 then 'too_long' end as skip_reason from documents) where skip_reason is not null group by 1""",
)
def skip_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    reason = Q.skip_reason(F.col("text"), none, F.lit(1), F.lit(1)).when(F.col("n_chars") < 64, "too_short").when(F.col("n_chars") > 20000, "too_long")
    return M.skip_histogram(table(spark, sf_dir, "documents").select(reason.alias("skip_reason")))


@register(
    "text_replacement",
    """select d.doc_id, md5(case when coalesce(l.quality = 1 and 'fixed: ' || d.text <> '', false) then 'fixed: ' || d.text else d.text end) as text_md5,
  case when coalesce(l.quality = 1 and 'fixed: ' || d.text <> '', false) then md5(d.text) end as before_md5,
  case when coalesce(l.quality = 1 and 'fixed: ' || d.text <> '', false) then '' else 'aw_transcript_unusable' end as reasons
from documents d left join labels l using (doc_id)""",
)
def text_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    new = M.replace_text(F.col("text"), F.concat(F.lit("fixed: "), "text"), F.col("quality") == 1, F.array().cast("array<string>"), F.lit(None).cast("string"))
    return rows.select("doc_id", F.md5(new["text"]).alias("text_md5"), F.md5(new["text_before_asr"]).alias("before_md5"), F.array_join(new["review_reasons"], ",").alias("reasons"))


@register(
    "cache_hit_split",
    """select d.doc_id, coalesce(c.status <> 'error' and c.fingerprint = md5(d.text), false) as hit from documents d left join
(select l.doc_id, case when toxic = 1 then 'error' else 'ok' end as status, case when l.doc_id % 5 = 0 then 'stale' else md5(text) end as fingerprint
 from labels l join documents using (doc_id)) c using (doc_id)""",
)
def cache_hit_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("stamp"))
    cache = table(spark, sf_dir, "labels").join(docs, "doc_id").select(
        "doc_id", F.when(F.col("toxic") == 1, "error").otherwise("ok").alias("status"), F.when(F.col("doc_id") % 5 == 0, "stale").otherwise(F.col("stamp")).alias("fingerprint")
    )
    return M.cache_split(docs, cache, "doc_id", F.col("stamp")).select("doc_id", "hit")


@register(
    "status_routing",
    """select status, count(*) as rows, count(*) filter (where status = 'error') as errors, round(sum(n_chars / 15.0::double) filter (where status = 'train'), 3) as train_seconds
from (select n_chars, case when text is null or text = '' then 'error' when n_chars < 64 or n_chars > 20000 then 'review' else 'train' end as status from documents) group by status""",
)
def status_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.coalesce("text", F.lit("")) == "", "error").otherwise(R.status(R.clip_reasons(F.col("n_chars").cast("double"), 64, 20000 - R.DURATION_SLACK)))
    rows = table(spark, sf_dir, "documents").select("n_chars", status.alias("status"))
    seconds = F.round(F.sum(F.when(F.col("status") == "train", F.col("n_chars") / 15.0)), 3)
    return rows.groupBy("status").agg(F.count("*").alias("rows"), F.count_if(F.col("status") == "error").alias("errors"), seconds.alias("train_seconds"))


@register(
    "timeline_batches",
    """select conv_id, turn, cast(row_number() over (partition by conv_id order by turn, role) - 1 as integer) as pos,
  cast((row_number() over (partition by conv_id order by turn, role) - 1) // 3 as integer) as ordinal from conversations""",
)
def timeline_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = L.positions(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), "conv_id", ["turn", "role"])
    return placed.select("conv_id", "turn", "pos", L.ordinal(3).alias("ordinal"))


@register(
    "context_windows",
    """with p as (select conv_id, turn, row_number() over (partition by conv_id order by turn, role) - 1 as pos, count(*) over (partition by conv_id) as n from conversations),
o as (select distinct conv_id, n, pos // 3 as ordinal from p)
select p.conv_id, p.turn, cast(o.ordinal as integer) as ordinal, case when p.pos // 3 = o.ordinal then 'target' else 'context_only' end as role
from p join o on p.conv_id = o.conv_id and p.pos >= o.ordinal * 3 - 2 and p.pos < least(o.ordinal * 3 + 3, p.n) + 2""",
)
def context_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = L.positions(table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("speaker")), "conv_id", ["turn", "speaker"])
    return L.windows(placed, "conv_id", target=3, context=2).select("conv_id", "turn", "ordinal", "role")


@register(
    "outcome_resolution",
    """select role, outcome, count(*) as rows from (select role, case when turn % 5 = 4 then 'missing' when turn % 5 = 3 then 'uncertain'
  when turn % 5 = 2 or text = upper(text) then 'unchanged' when length(text) % 7 > 0 then 'accepted' else 'rejected_unsafe' end as outcome from conversations) group by all""",
)
def outcome_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    made = turns.where("turn % 5 <> 4").select(
        "conv_id", "turn", F.upper("text").alias("after"), F.lit(True).alias("found"), (F.length("text") % 7 > 0).alias("safe"),
        F.when(F.col("turn") % 5 == 3, "uncertain").when(F.col("turn") % 5 == 2, "unchanged").otherwise("corrected").alias("proposed"),
    )
    joined = turns.join(made, ["conv_id", "turn"], "left")
    result = R.outcome(F.col("found"), F.col("proposed"), F.col("text"), F.col("after"), F.col("safe"))
    return joined.groupBy("role", result.alias("outcome")).agg(F.count("*").alias("rows"))


@register(
    "set_equality_check",
    """with e as (select conv_id * 100 + turn as k from conversations), f as (select conv_id * 100 + turn + 1 as k from conversations where turn % 2 = 0)
select coalesce(e.k, f.k) as k, case when f.k is null then 'missing' else 'unexpected' end as problem
from (select distinct k from e) e full join (select distinct k from f) f on e.k = f.k where e.k is null or f.k is null""",
)
def set_equality_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    k = F.col("conv_id") * 100 + F.col("turn")
    return M.set_difference(turns.select(k.alias("k")), turns.where("turn % 2 = 0").select((k + 1).alias("k")), "k")


@register("style_pool_filter", "select user_id, event_type, count(*) as rows from events where user_id is not null group by all having count(*) >= 2")
def style_pool_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.style_pools(table(spark, sf_dir, "events"), "user_id", "event_type").groupBy("user_id", "event_type").agg(F.count("*").alias("rows"))


@register(
    "reference_pick",
    """select event_id, coalesce(lead(event_id) over w, first_value(event_id) over (partition by user_id, event_type order by event_id rows between unbounded preceding and unbounded following)) as reference
from events window w as (partition by user_id, event_type order by event_id)""",
)
def reference_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.next_in_pool(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), "event_id", ["user_id", "event_type"]).select("event_id", "reference")


@register("first_per_group", "select user_id, event_type, min(event_id) as event_id, arg_min(value, event_id) as value from events group by all")
def first_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id"), F.min_by("value", "event_id").alias("value"))


@register(
    "best_n",
    """select l_suppkey, l_orderkey, l_linenumber, place from (select *, cast(row_number() over (partition by l_suppkey order by l_extendedprice, l_orderkey * 10 + l_linenumber) as integer) as place from lineitem) where place <= 3""",
)
def best_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("step"))
    return K.keep_best(items, ["l_suppkey"], "l_extendedprice", "step", 3).select("l_suppkey", "l_orderkey", "l_linenumber", "place")


@register(
    "latest_n",
    """select l_suppkey, l_orderkey, l_linenumber from (select *, row_number() over (partition by l_suppkey order by l_orderkey * 10 + l_linenumber desc) as k from lineitem) where k <= 5""",
)
def latest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("step"))
    return K.keep_latest(items, ["l_suppkey"], "step", 5).select("l_suppkey", "l_orderkey", "l_linenumber")


_ITEM = "l_orderkey * 10 + l_linenumber"


@register(
    "row_split",
    f"""with r as (select {_ITEM} as item, row_number() over (order by md5('13:' || ({_ITEM})::varchar), {_ITEM}) as k, count(*) over () as n from lineitem)
select item, case when k <= least(greatest(1, floor(n * 0.05)), n - 1) then 'valid' else 'train' end as part from r""",
)
def row_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.row_split(table(spark, sf_dir, "lineitem").select(F.expr(_ITEM).alias("item")), "item", 0.05, 13)


@register(
    "group_split",
    """with g as (select l_suppkey, count(*) as size, md5('13:g' || l_suppkey::varchar) as d from lineitem group by 1),
n as (select sum(size) as n, least(greatest(1, floor(sum(size) * 0.1)), sum(size) - 1) as target from g),
s as (select g.*, coalesce(sum(size) over (order by d rows between unbounded preceding and 1 preceding), 0) as before from g)
select case when before < target then 'valid' else 'train' end as part, count(*) as groups, cast(sum(size) as bigint) as rows from s, n group by 1""",
)
def group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", F.expr(_ITEM).alias("item"))
    split = S.group_split(items, "item", "l_suppkey", 0.1, 13)
    sizes = split.groupBy("part", "l_suppkey").agg(F.count("*").alias("n"))
    return sizes.groupBy("part").agg(F.count("*").alias("groups"), F.sum("n").alias("rows"))


@register(
    "balanced_undersample",
    """with c as (select min(n) as least from (select count(*) as n from events group by event_type)),
r as (select event_id, event_type, row_number() over (partition by event_type order by md5('9:' || event_id::varchar), event_id) as k from events)
select event_type, event_id from r, c where k <= least""",
)
def balanced_undersample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.balanced(table(spark, sf_dir, "events").select("event_type", "event_id"), "event_id", "event_type", seed=7, epoch=2)


@register(
    "length_buckets",
    """with s as (select event_id, value, row_number() over (order by md5('3:' || event_id::varchar), event_id) - 1 as pos from events),
w as (select *, pos // 512 as win from s), b as (select *, row_number() over (partition by win order by value, pos) - 1 as k from w)
select event_id, cast(win * 64 + k // 8 as bigint) as batch from b""",
)
def length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "events").select("event_id", "value")
    return S.length_batches(items, "event_id", "value", batch=8, windows=64, seed=3).select("event_id", "batch")


@register(
    "replica_sharding",
    """with s as (select event_id, row_number() over (order by md5('5:' || event_id::varchar), event_id) - 1 as pos, count(*) over () as n from events),
a as (select event_id, pos, n from s union all select event_id, pos + n, n from s where pos < cast(ceil(n / 7.0) as bigint) * 7 - n)
select event_id, pos, cast(pos % 7 as integer) as replica from a""",
)
def replica_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id")
    return S.replica_shards(S.shuffled(events, "event_id", 5), 7, events.count()).select("event_id", "pos", "replica")


@register(
    "weighted_pick",
    """with r as (select s_suppkey, s_acctbal as w, unnest(range(0, 50)) as pick from supplier where s_acctbal > 0),
t as (select pick, s_suppkey, -ln((cast('0x' || substr(md5('1:' || pick || ':' || s_suppkey), 1, 12) as bigint) + 1) / 281474976710656.0::double) / w as t from r)
select cast(pick as integer) as pick, arg_min(s_suppkey, t) as s_suppkey from t group by pick""",
)
def weighted_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.weighted_pick(table(spark, sf_dir, "supplier").withColumn("w", F.greatest("s_acctbal", F.lit(0.0))), "s_suppkey", "w", 50, 1)


@register(
    "label_join_rollup",
    """select d.lang, coalesce(l.quality::varchar, '__none__') as quality, count(*) as docs, count(l.toxic) as labelled, count(*) filter (where l.toxic = 1) as toxic
from documents d left join labels l using (doc_id) group by all""",
)
def label_join_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    quality = F.coalesce(F.col("quality").cast("string"), F.lit("__none__")).alias("quality")
    return rows.groupBy("lang", quality).agg(F.count("*").alias("docs"), F.count("toxic").alias("labelled"), F.count_if(F.col("toxic") == 1).alias("toxic"))


def _streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").withColumn("id", F.concat_ws("-", "conv_id", "turn")).withColumn("row_index", F.col("turn"))
    turns = turns.withColumn("source_uid", T.source_uid(F.lit(None).cast("string"), F.concat(F.lit("Conv\\"), "conv_id")))
    turns = turns.withColumn("start", F.when(F.col("turn") % 4 < 3, F.col("turn").cast("string")).otherwise("x")).withColumn("end", F.lit(None).cast("string"))
    speech = turns.where("role = 'user'").select("id", "row_index", "source_uid", "start", "end", F.lit(None).cast("string").alias("asr_text_raw"), "text", F.lit("").alias("asr_backend"))
    other = turns.where("role <> 'user'").select("id", "row_index", "source_uid", "start", "end", F.col("text").alias("transcript_text_raw"), F.lit("").alias("transcript_text"), F.lit("own").alias("transcript_backend"))
    return T.timeline_rows(speech, other)


@register(
    "timeline_rows",
    """select case when role = 'user' then 'speech' else 'nonverbal' end as kind, conv_id || '-' || turn as id, 'path:conv/' || conv_id as source_uid,
  case when turn % 4 < 3 then turn::double else 1e12 + turn end as "start", case when role = 'user' then 'grok-stt' else 'own' end as backend from conversations where coalesce(trim(text), '') <> ''""",
)
def timeline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streams(spark, sf_dir).select("kind", "id", "source_uid", "start", "backend")


@register(
    "proposal_checks",
    """select id, problem from (select conv_id || '-' || turn as id, case when turn % 6 = 0 then 'missing' when turn % 6 = 1 then 'duplicate'
  when turn % 6 = 2 then 'bad_status' when turn % 6 = 3 then 'bad_category' end as problem from conversations) where problem is not null""",
)
def proposal_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").withColumn("id", F.concat_ws("-", "conv_id", "turn"))
    status = F.when(F.col("turn") % 6 == 2, "odd").otherwise("unchanged")
    category = F.when(F.col("turn") % 6 == 3, "odd").otherwise("speech")
    made = turns.where("turn % 6 <> 0").select("id", "turn", status.alias("status"), category.alias("category"))
    made = made.unionByName(made.where("turn % 6 = 1"))
    return T.check_proposals(turns, made, ["unchanged", "corrected", "uncertain"], ["speech", "other"])


@register(
    "correction_rollup",
    """select kind, outcome, force_review, count(*) as items from (select case when role = 'user' then 'speech' else 'nonverbal' end as kind,
  case when turn % 3 = 0 then 'missing' when turn % 3 = 1 then 'unchanged' when regexp_matches(text, '[\\p{L}\\p{M}\\p{N}]') then 'accepted' else 'rejected_unsafe' end as outcome, turn % 3 = 1 and role = 'user' as force_review
  from conversations where coalesce(trim(text), '') <> '') group by all""",
)
def correction_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _streams(spark, sf_dir).join(table(spark, sf_dir, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("id"), "turn"), "id")
    made = rows.where("turn % 3 <> 0").select(
        "id", F.when(F.col("turn") % 3 == 1, F.col("text")).otherwise(F.concat(F.col("text"), F.lit("!"))).alias("corrected_text"), F.lit("corrected").alias("status"),
        F.when(F.col("turn") % 3 == 1, "other").otherwise("speech").alias("category"),
    )
    return T.resolve(rows.drop("turn"), made).groupBy("kind", "outcome", "force_review").agg(F.count("*").alias("items"))
