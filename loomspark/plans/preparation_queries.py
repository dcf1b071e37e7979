"""Preparation, merges, pools, clips, losses and levels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomspark.functions import arrays as A
from loomspark.functions import audio as U
from loomspark.functions import schedules as C
from loomspark.functions import text as X
from loomspark.operators import clips as P
from loomspark.operators import intervals as V
from loomspark.operators import lineage as N
from loomspark.operators import manifest as M
from loomspark.operators import pools as G
from loomspark.operators import prepare as Q
from loomspark.operators import review as R
from loomspark.operators import sampling as B
from loomspark.operators import segmentation as S
from loomspark.operators import transcripts as T
from loomspark.plans.interval_queries import HOUR, event_intervals, frames
from loomspark.plans.registry import register
from loomspark.session import table


@register(
    "latent_merge",
    """with m as (
  select 0 as input, doc_id as line, 'lat/' || lang || '/../' || doc_id || '.pt' as raw, '/data/docs/lat/' || doc_id || '.pt' as abs, 'd' || doc_id as id, coalesce(text, '') as text,
    case when doc_id % 3 = 0 then 'RJ' || (doc_id % 50) else source end as speaker_id, doc_id % 3 = 0 as changed from documents
  union all select 1, item_id, '../bench/./' || item_id || '.pt', '/data/bench/' || item_id || '.pt', 'b' || item_id, text, null, false from benchmark)
select id, case when input = 0 then '../docs/lat/' || substr(abs, 16) else '../bench/' || substr(abs, 13) end as latent_path, speaker_id, md5(text) as text_md5 from m""",
)
def latent_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    speaker = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("x:rj"), F.col("doc_id") % 50, F.lit("_take"))).otherwise(F.col("source"))
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("line"), F.concat(F.lit("lat/"), "lang", F.lit("/../"), "doc_id", F.lit(".pt")).alias("latent_path"), F.concat(F.lit("d"), "doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"), speaker.alias("speaker_id")
    )
    bench = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("long").alias("line"), F.concat(F.lit("../bench/./"), "item_id", F.lit(".pt")).alias("latent_path"), F.concat(F.lit("b"), "item_id").alias("id"), "text")
    merged = N.merge_latents({"/data/docs/manifest.jsonl": docs, "/data/x/manifest.jsonl": bench}, "/data/out/all.jsonl", collapse_speakers=True)
    return merged.rows.select("id", "latent_path", "speaker_id", F.md5("text").alias("text_md5"))


_SKIP = """case when coalesce(trim(text), '') = '' then 'empty_text' when doc_id % 7 = 0 then 'audio_decode' when doc_id % 5 * 8000 < 16000 then 'low_sample_rate'
  when n_chars % 9 = 0 then 'trimmed_empty' when doc_id % 11 = 0 then 'prepare_error' when doc_id % 13 = 0 then 'encode_error' end"""


def _skips(spark: SparkSession, sf_dir: str, most: int | None = None) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    bad = lambda n: F.when(F.col("doc_id") % n == 0, F.lit("broken"))
    samples = F.when(F.col("n_chars") % 9 == 0, 0).otherwise(F.col("n_chars")).cast("long")
    reason = Q.skip_reason(F.col("text"), bad(7), F.col("doc_id") % 5 * 8000, samples, 30.0, 16000, bad(11), bad(13))
    return Q.limited(docs.select("doc_id", reason.alias("skip_reason")), "doc_id", most)


@register("skip_reasons", f"select doc_id, {_SKIP} as skip_reason from documents")
def skip_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _skips(spark, sf_dir)


@register(
    "sample_limit",
    f"""with r as (select doc_id, {_SKIP} as reason from documents), k as (select *, count(*) filter (where reason is null) over (order by doc_id rows unbounded preceding) as n from r)
select doc_id, case when reason is null and n > 100 then 'max_samples_limit' else reason end as skip_reason from k""",
)
def sample_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _skips(spark, sf_dir, 100)


@register(
    "skip_rollup",
    f"""select count(*) as seen, count(*) filter (where r is null) as written, count(*) filter (where r = 'empty_text') as skipped_empty,
  count(*) filter (where r in ('audio_decode', 'trimmed_empty', 'prepare_error', 'encode_error', 'dataset_iter_error')) as skipped_audio,
  count(*) filter (where r = 'low_sample_rate') as skipped_low_sr, count(*) filter (where r = 'max_samples_limit') as skipped_max from (select {_SKIP} as r from documents)""",
)
def skip_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.skip_rollup(_skips(spark, sf_dir))


@register(
    "prepared_rows",
    """select doc_id as idx, nullif(trim(source), '') as source_uid, 'ns:' || lang || '__' || source as speaker_id, nullif(lang, '') as category from documents""",
)
def prepared_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("idx"), "text", F.concat(F.lit(" "), "source").alias("source_uid"), F.col("lang").alias("category"), "lang", "source")
    made = Q.prepared(docs, F.lit(None).cast("string"), "text", speakers=("lang", "source"), namespace="ns")
    return made.select("idx", "source_uid", "speaker_id", "category")


@register("row_limit", "select o_orderkey from orders order by o_orderkey limit 250")
def row_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.first_rows(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 250)


@register("transcription_summary", "select count(*) as rows, count(*) filter (where doc_id % 2 = 0) as cached, count(*) filter (where quality = 1) as ok, count(*) filter (where quality = 0 and toxic = 0) as review, count(*) filter (where quality = 0 and toxic = 1) as errors from labels")
def transcription_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("quality") == 1, "ok").when(F.col("toxic") == 0, "review").otherwise("error")
    return Q.transcription_summary(table(spark, sf_dir, "labels").select((F.col("doc_id") % 2 == 0).alias("cached"), status.alias("status")))


@register("hours_by_type", "select event_type, round(sum(abs(value)) / 3600, 6) as hours from events group by event_type")
def hours_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.round(Q.total_hours(F.abs("value")), 6).alias("hours"))


@register("finite_steps", "select event_id, count(*) filter (where event_id % 4 <> 0) over (partition by user_id order by event_id rows unbounded preceding) as events from events")
def finite_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", F.when(F.col("event_id") % 4 != 0, F.col("value")).otherwise(F.lit(float("nan"))).alias("v"))
    return Q.finite_steps(rows, "v", ["user_id"], "event_id").select("event_id", "events")


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    speaker = F.when(F.col("user_id") % 7 != 0, F.col("user_id"))
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("idx"), speaker.alias("speaker_id"), F.when(F.col("event_type") != "click", F.col("event_type")).alias("category"), "value")


_INDEX = "select event_id as idx, case when user_id % 7 <> 0 then user_id end as speaker_id, case when event_type <> 'click' then event_type end as category, value from events"


@register("style_filtered", f"with x as ({_INDEX}), n as (select *, count(*) over (partition by speaker_id, category) as n from x) select idx, speaker_id, category from n where speaker_id is not null and n >= 2")
def style_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.style_filtered(_index(spark, sf_dir)).select("idx", "speaker_id", "category")


@register("group_members", f"with x as ({_INDEX}) select speaker_id, category, idx, cast(row_number() over (partition by speaker_id, category order by idx) - 1 as integer) as place from x where speaker_id is not null")
def group_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.members(_index(spark, sf_dir), ["speaker_id", "category"], "idx")


@register("subset_rows", f"with x as ({_INDEX}) select idx, speaker_id from x where idx in (select event_id from events where event_id % 9 = 1)")
def subset_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "events").where("event_id % 9 = 1").select(F.col("event_id").alias("idx"))
    return G.subset(_index(spark, sf_dir), wanted).select("idx", "speaker_id")


@register("labelled_counts", f"with x as ({_INDEX}) select count(*) as rows, count(speaker_id) as speakers, count(*) filter (where category is not null) as captions, count(*) filter (where abs(value) * 100 > 50) as overlong from x")
def labelled_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir).agg(*G.labelled(F.col("speaker_id"), F.col("category").isNotNull(), F.abs("value") * 100, 50))


@register(
    "picked_references",
    f"""with x as ({_INDEX}), p as (select *, row_number() over (partition by speaker_id, category order by idx) - 1 as p, count(*) over (partition by speaker_id, category) as n,
  row_number() over (partition by speaker_id order by idx) - 1 as q, count(*) over (partition by speaker_id) as m, cast('0x' || substr(md5('11:' || idx::varchar), 1, 12) as bigint) as u from x where speaker_id is not null),
a as (select *, case when n > 1 then (p + 1 + u % (n - 1)) % n when m > 1 then (q + 1 + u % (m - 1)) % m end as pick from p)
select a.idx, coalesce(near.idx, far.idx) as reference from a
left join p near on a.n > 1 and near.speaker_id = a.speaker_id and near.category is not distinct from a.category and near.p = a.pick
left join p far on a.n <= 1 and far.speaker_id = a.speaker_id and far.q = a.pick
union all select idx, null from x where speaker_id is null""",
)
def picked_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.picked_references(_index(spark, sf_dir).select("idx", "speaker_id", "category"), "idx", "speaker_id", "category", 11).select("idx", "reference")


@register(
    "fixed_references",
    """with x as (select event_id as line, 'RJ' || (user_id % 20) as work, event_type as category, 'p/' || event_id as latent_path, 'rj' || (user_id % 20) || '_' || (user_id % 3) as speaker_id from events),
s as (select work, category, min(line) as line, arg_min(latent_path, line) as latent_path, arg_min(speaker_id, line) as own from x where category in ('click', 'view') group by all),
w as (select work, min(line) filter (where category = 'click') as first, arg_min(own, line) as speaker_id from s group by work having count(*) filter (where category = 'click') > 0),
c as (select *, cast(row_number() over (order by first) - 1 as integer) as place from w order by first limit 5)
select s.work, s.category, c.speaker_id, s.latent_path, c.place from s join c using (work)""",
)
def fixed_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id")
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("line"), F.concat(F.lit("rj"), user % 20, F.lit("_"), user % 3).alias("speaker_id"), F.col("event_type").alias("category"), F.concat(F.lit("p/"), "event_id").alias("latent_path")
    )
    return G.fixed_references(rows, ["view"], "click", 5)


@register("file_union", "select distinct text from (select source as text from documents union select lang from documents) order by 1")
def file_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("source").alias("text")).union(docs.select("lang")).distinct().orderBy("text")


@register("stage_intersect", "select user_id from events where event_type = 'click' intersect select user_id from events where event_type = 'view'")
def stage_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = lambda name: table(spark, sf_dir, "events").where(F.col("event_type") == name).select("user_id")
    return kind("click").intersect(kind("view"))


_PACK = """with recursive p as (select user_id, s + i * {cap} as s, least(s + (i + 1) * {cap}, e) as e
  from (select user_id, s, e, unnest(range(0, greatest(cast(ceil((e - s) / {cap}::double) as bigint), 1))) as i from ({rows}) where e > s)),
o as (select *, row_number() over (partition by user_id order by s, e) as k from p),
f as (select user_id, k, s as cs, e as ce, 1 as pack from o where k = 1
  union all select o.user_id, o.k, case when j then f.cs else o.s end, case when j then greatest(f.ce, o.e) else o.e end, case when j then f.pack else f.pack + 1 end
  from f join o on o.user_id = f.user_id and o.k = f.k + 1, lateral (select greatest(o.s - f.ce, 0) <= {gap} and o.e - f.cs <= {cap} as j)),
z as (select user_id, greatest(min(cs) - {pad}, 0) as s, least(max(ce) + {pad}, {limit}) as e from f group by user_id, pack),
w as (select *, lag(e) over (partition by user_id order by s, e) as le, lead(s) over (partition by user_id order by s, e) as ns from z),
c as (select user_id, case when le > s then (le + s) / 2.0::double else s end as s, case when e > ns then (e + ns) / 2.0::double else e end as e from w)
"""
_CLIPS = P.ClipLimits(shortest=600.0, longest=86_400.0, padding=3600.0, join_gap=7200.0, extension=0.0)
_DAYS = 31 * 86_400


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("source_uid")).distinct()
    return users.select("source_uid", F.col("source_uid").alias("speaker_id"), F.concat(F.lit("a/"), "source_uid").alias("path"), F.lit(float(_DAYS)).alias("duration"), F.lit(24000).alias("sample_rate"))


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_intervals(spark, sf_dir)
    return rows.select(F.col("user_id").alias("source_uid"), (F.col("start") / 1e6).alias("start"), (F.col("end") / 1e6).alias("end"))


_EVENTS = "select user_id, epoch_us(ts) - epoch_us(timestamp '2024-01-01') as s, epoch_us(ts) - epoch_us(timestamp '2024-01-01') + cast(floor(abs(value) * 1000) as bigint) * 60000 as e from events"


@register(
    "speech_clips",
    _PACK.format(cap=(86_400 - 7200) * 1_000_000, gap=7200 * 1_000_000, pad=3600 * 1_000_000, limit=_DAYS * 1_000_000, rows=_EVENTS)
    + """select user_id as source_uid, round(s / 1e6, 3) as "start", round(e / 1e6, 3) as "end",
  case when e - s < 600e6 or e - s > 86400.05e6 then 'review' else 'train' end as status, case when e - s < 600e6 then 'too_short' when e - s > 86400.05e6 then 'too_long' else '' end as reasons from c""",
)
def speech_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = P.speech_clips(_sources(spark, sf_dir), _regions(spark, sf_dir), _CLIPS)
    return found.select("source_uid", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"), "status", F.array_join("review_reasons", ",").alias("reasons"))


@register(
    "missing_regions",
    "select user_id as source_uid, 'missing_vad_cache' as reason from (select distinct user_id from events where user_id not in (select user_id from events where event_type = 'click' and user_id is not null) and user_id is not null)",
)
def missing_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    covered = table(spark, sf_dir, "events").where("event_type = 'click'").select(F.col("user_id").alias("source_uid"))
    return P.missing_regions(_sources(spark, sf_dir), covered).select("source_uid", "reason")


@register("event_clips")
def event_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sound events in the gaps of speech: every user's month is the source, embeddings of a label the frames of a user."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("label").cast("long").alias("source_uid"), "vec_id", F.posexplode("embedding").alias("bin", "v"))
    at = F.row_number().over(Window.partitionBy("source_uid").orderBy("vec_id", "bin")) - 1
    levels = vectors.select("source_uid", at.alias("idx"), F.abs("v").cast("double").alias("amplitude"))
    last = F.lag("amplitude").over(Window.partitionBy("source_uid").orderBy("idx"))
    made = levels.withColumn("rms", 2 * U.power_db(F.col("amplitude"))).withColumn("flux", F.greatest(F.coalesce(F.col("amplitude") - last, F.lit(0.0)), F.lit(0.0)))
    made = made.withColumn("novelty", F.col("flux")).withColumn("value", F.col("rms"))
    made = V.context_step(made, ["source_uid"], 30).drop("value")
    durations = levels.groupBy("source_uid").agg((F.max("idx") * 0.01 + 0.01).alias("duration"))
    sources = durations.select("source_uid", F.col("source_uid").alias("speaker_id"), F.concat(F.lit("a/"), "source_uid").alias("path"), "duration", F.lit(16000).alias("sample_rate"))
    speech = sources.select("source_uid", F.lit(0.0).alias("start"), F.lit(2.0).alias("end"))
    limits = P.ClipLimits(shortest=0.6, longest=6.0, padding=0.2)
    fragments = P.gap_fragments(P.quiet_gaps(sources, speech), made, S.Limits(longest=4.0))
    return P.event_clips(sources, fragments, limits)


@register(
    "cosine_novelty",
    """with f as (select label, vec_id, row_number() over (partition by label order by vec_id) - 1 as idx, count(*) over (partition by label) as n, embedding from embeddings),
b as (select label, vec_id, idx, n, unnest(range(1, 65)) as k, unnest(embedding)::double as v from f),
w as (select label, vec_id, idx, n, avg(v) over (partition by label, k order by idx rows between 3 preceding and 1 preceding) as l, avg(v) over (partition by label, k order by idx rows between current row and 2 following) as r from b)
select vec_id, round(case when any_value(idx) >= 3 and any_value(idx) < any_value(n) - 3 then 1 - sum(l * r) / (greatest(sqrt(sum(l * l)), 1e-8) * greatest(sqrt(sum(r * r)), 1e-8)) else 0 end, 6) as novelty from w group by vec_id""",
)
def cosine_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = (F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1).alias("idx")
    rows = table(spark, sf_dir, "embeddings").select("label", "vec_id", place, F.transform("embedding", lambda v: v.cast("double")).alias("spectrum"))
    return V.cosine_novelty(rows, ["label"], 3).select("vec_id", (F.round("novelty", 6) + 0.0).alias("novelty"))


_FRAMES = "select vec_id, i as idx, embedding[i + 1]::double as value from (select vec_id, embedding, unnest(range(0, len(embedding))) as i from embeddings)"


@register("pool_max", f"select vec_id, cast(idx as integer) as idx, round(max(value) over (partition by vec_id order by idx rows between 4 preceding and 4 following), 6) as smooth from ({_FRAMES})")
def pool_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.smoothed_max(frames(spark, sf_dir), ["vec_id"], 9).select("vec_id", "idx", F.round("smooth", 6).alias("smooth"))


@register(
    "frame_boundaries",
    f"""with f as ({_FRAMES}), a as (select vec_id, idx, value as score, 0 as seq from f where value > 0.1 union all select vec_id, idx, abs(value), 1 from f where abs(value) > 0.05),
r as (select *, row_number() over (partition by vec_id, idx order by score desc, seq) as k from a)
select vec_id, cast(idx as integer) as idx, round(score, 6) as score, case when seq = 0 then 'loud' else 'any' end as reason from r where k = 1""",
)
def frame_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames(spark, sf_dir)
    loud, near = rows.where("value > 0.1").withColumn("score", F.col("value")), rows.where("abs(value) > 0.05").withColumn("score", F.abs("value"))
    cuts = S.one_a_frame([(loud, "loud"), (near, "any")], "vec_id", 1.0).select("vec_id", F.explode("cuts").alias("c"))
    return cuts.select("vec_id", F.col("c.time").cast("int").alias("idx"), F.round("c.score", 6).alias("score"), "c.reason")


@register("fragment_segmentation")
def fragment_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments of every vector, taken as a sound of 64 frames of 0.1 s."""
    rows = frames(spark, sf_dir)
    last = F.lag("value").over(Window.partitionBy("vec_id").orderBy("idx"))
    made = V.context_step(rows, ["vec_id"], 3).withColumns(
        {"rms": U.power_db(F.col("value") * F.col("value"), 1e-8), "flux": F.abs(F.col("value") - F.coalesce(last, F.col("value"))), "novelty": F.abs("value")}
    )
    durations = rows.groupBy("vec_id").agg(((F.max("idx") + 1) * 0.1).alias("duration"))
    limits = S.Limits(hop=0.1, shortest=0.5, longest=2.0, envelope=1.5, pause=0.1)
    return S.segment_frames(made.drop("value"), durations, "vec_id", limits)


@register("levels", "select vec_id, round(20 * log10(greatest(sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double)) / 64), 1e-6)), 4) as db, sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double)) / 64) >= pow(10, -60 / 20.0) as loud from embeddings")
def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = A.rms(F.col("embedding"))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(U.power_db(level * level), 4).alias("db"), U.loud_enough(level).alias("loud"))


@register(
    "edge_fades",
    """with v as (select vec_id, unnest(embedding)::double as v, unnest(range(0, 64)) as i from embeddings)
select vec_id, round(sum(v * case when i < 10 then 0.5 - 0.5 * cos(pi() * i / 10) else 1 end * case when 63 - i < 32 then 0.5 - 0.5 * cos(pi() * (63 - i) / 32) else 1 end), 6) + 0.0 as total from v group by vec_id""",
)
def edge_fades(spark: SparkSession, sf_dir: str) -> DataFrame:
    faded = U.edge_fades(F.col("embedding"), F.lit(100))
    return table(spark, sf_dir, "embeddings").select("vec_id", (F.round(A.total(faded), 6) + 0.0).alias("total"))


@register(
    "latent_layouts",
    """select vec_id, cast(16 as integer) as steps, round(case when vec_id % 4 in (0, 2) then embedding[5] else embedding[2] end::double, 6) as second from embeddings""",
)
def latent_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("vec_id") % 4
    shape = F.when(kind == 0, F.array(F.lit(16), F.lit(4))).when(kind == 1, F.array(F.lit(4), F.lit(16))).when(kind == 2, F.array(F.lit(1), F.lit(16), F.lit(4))).otherwise(F.array(F.lit(1), F.lit(4), F.lit(16)))
    rows = U.latent_rows(F.col("embedding"), shape, 4)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.size(rows).alias("steps"), F.round(rows[1][0].cast("double"), 6).alias("second"))


_LOSS = """with e as (select label, vec_id, list_transform(range(1, 17), lambda i: list_sum(list_transform(range(1, 5), lambda j: power(embedding[(i - 1) * 4 + j]::double - 0.1, 2))) / 4) as e from embeddings),
s as (select label, vec_id, unnest(range(0, 16)) as i, unnest(e) as e, from e)"""


@register(
    "loss_normalizations",
    _LOSS
    + """, u as (select label, vec_id, sum(case when i < 12 then e else 0 end) / 12 as m, sum(case when i % 2 = 0 then e else 0 end) as n, count(*) as c, count(*) filter (where i % 2 = 0 and i < 12) as b from s group by all)
select label, round(avg(m), 6) as utterance_mean, round(sum(n) / sum(c) / greatest(sum(b) / sum(c), 1e-6), 6) as ratio_normalized from u group by label""",
)
def loss_normalizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = F.sequence(F.lit(0), F.lit(15))
    patches, aim = A.patchify(F.col("embedding"), 4), F.transform(steps, lambda i: F.array_repeat(F.lit(0.1), 4))
    rows = table(spark, sf_dir, "embeddings").select("label", A.step_mse(patches, aim).alias("e"), F.transform(steps, lambda i: i < 12).alias("valid"), F.transform(steps, lambda i: i % 2 == 0).alias("counted"))
    return rows.groupBy("label").agg(
        F.round(A.utterance_mean_mse(F.col("e"), F.col("valid")), 6).alias("utterance_mean"), F.round(A.ratio_normalized_mse(F.col("e"), F.col("counted"), F.col("valid")), 6).alias("ratio_normalized")
    )


@register(
    "guidance_scales",
    """select event_id, case when event_id % 5 = 0 then 2.5 else 1.5 end::double as text, case when event_id % 5 = 0 then 2.5 else 3.0 end::double as caption,
  case when event_id % 3 = 0 then 0.0 when event_id % 5 = 0 then 2.5 else 5.0 end::double as speaker, event_id % 3 = 0 as speaker_ignored from events""",
)
def guidance_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    override = F.when(k % 5 == 0, F.lit(2.5))
    scales = C.guidance(F.lit(1.5), F.lit(3.0), F.lit(5.0), override, k % 2 == 0, k % 3 != 0, k % 5 == 0)
    return table(spark, sf_dir, "events").select("event_id", scales.alias("s")).select("event_id", "s.*")


@register("duration_frames", "select l_orderkey, l_linenumber, cast(least(greatest(round_even(l_quantity * 1.37, 0), 4), 60) as bigint) as frames from lineitem")
def duration_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = A.frames_from_duration(F.log1p("l_quantity"), 1.37, 4, 60)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", found.alias("frames"))


@register("flow_terms", "select vec_id, round(list_sum(list_transform(embedding, lambda x: 1 - x::double)), 5) as velocity, round(list_sum(list_transform(embedding, lambda x: x::double)), 5) + 0.0 as origin from embeddings")
def flow_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    ones = F.transform(e, lambda x: F.lit(1.0))
    v = A.velocity(e, ones)
    back = A.origin(A.interpolate(e, ones, 0.25), v, 0.25)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(A.total(v), 5).alias("velocity"), (F.round(A.total(back), 5) + 0.0).alias("origin"))


@register("speaker_flag", "select vec_id, cast(64 as integer) as size, case when label % 2 = 0 then 1.0 else 0.0 end::double as last from embeddings")
def speaker_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = A.replaced_last(F.transform("embedding", lambda v: v.cast("double")), F.when(F.col("label") % 2 == 0, 1.0).otherwise(0.0))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.size(e).alias("size"), F.element_at(e, -1).alias("last"))


@register("manifest_paths", "select page_id, case when page_id % 2 = 0 then 'clips/' || page_id || '.flac' else '/other/' || page_id || '.flac' end as path from pages")
def manifest_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.when(F.col("page_id") % 2 == 0, F.lit("/root/p\\clips\\")).otherwise(F.lit("\\other\\")), "page_id", F.lit(".flac"))
    return table(spark, sf_dir, "pages").select("page_id", U.manifest_path(raw, "/root/p").alias("path"))


@register("sound_fingerprints", "select doc_id, md5('a/' || doc_id || '|' || n_chars || '|' || doc_id * 1000) as stamp from documents")
def sound_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    print_ = U.sound_fingerprint(F.concat(F.lit("a/"), "doc_id"), F.col("n_chars"), F.col("doc_id") * 1000)
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(F.concat_ws("|", print_["path"], print_["size_bytes"], print_["mtime_ns"])).alias("stamp"))


@register("optional_floats", "select p_partkey, case p_partkey % 4 when 0 then null when 1 then null else p_size / 2.0::double end as value from part")
def optional_floats(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 4
    text = F.when(k == 0, " None ").when(k == 1, "DISABLED").otherwise(F.concat(F.lit(" "), (F.col("p_size") / 2.0).cast("string")))
    return table(spark, sf_dir, "part").select("p_partkey", X.optional_float(text).alias("value"))


@register(
    "correction_audit",
    """with t as (select case turn % 5 when 4 then 'missing' when 3 then 'uncertain' when 2 then 'unchanged' else 'accepted' end as o from conversations where regexp_matches(text, '[\\p{L}\\p{N}]'))
select count(*) as timeline_segments, count(*) filter (where o = 'accepted') as accepted, count(*) filter (where o = 'unchanged') as unchanged, count(*) filter (where o = 'uncertain') as uncertain,
  cast(0 as bigint) as rejected_unsafe, count(*) filter (where o = 'missing') as missing, (select count(distinct conv_id) from conversations) as batches,
  (select count(distinct conv_id) from conversations where conv_id % 3 <> 0) as batches_completed, (select count(distinct conv_id) from conversations where conv_id % 3 = 0) as batches_failed from t""",
)
def correction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").where(F.col("text").rlike(r"[\p{L}\p{N}]"))
    rows = turns.select(F.concat_ws("-", "conv_id", "turn").alias("id"), F.lit("speech").alias("kind"), "conv_id", "turn", X.collapse_whitespace(F.col("text")).alias("text"))
    k = F.col("turn") % 5
    made = rows.where(k != 4).select("id", F.when(k == 2, F.col("text")).otherwise(F.concat(F.col("text"), F.lit("!"))).alias("corrected_text"), F.when(k == 3, "uncertain").otherwise("corrected").alias("status"), F.lit("speech").alias("category"))
    batches = table(spark, sf_dir, "conversations").select("conv_id").distinct().select("conv_id", F.lit(0).alias("ordinal"), F.col("conv_id").cast("string").alias("payload"))

    def strict(text: str) -> str:
        if int(text) % 3 == 0:
            raise ValueError("no answer")
        return text

    answers = T.answered(batches, [("first", strict), ("second", strict)], source="conv_id")
    return T.correction_summary(T.resolve(rows, made), answers)


@register("clip_silence_rules", "select vec_id, case when label = 0 then 'near_silent_audio' when label = 1 then 'clipping_audio' else '' end as reasons from embeddings")
def clip_silence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label")
    why = R.clip_reasons(F.lit(5.0), 1.0, 20.0, F.when(label == 0, 1e-6).otherwise(0.1), F.when(label == 1, 0.02).otherwise(0.01))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.array_join(why, ",").alias("reasons"))


@register("parameter_groups", "select p_type, count(*) filter (where not regexp_matches(p_type, '(BRASS|STEEL)$')) as decayed, count(*) filter (where regexp_matches(p_type, '(BRASS|STEEL)$')) as plain, cast(sum(p_size) as bigint) as total from part group by p_type")
def parameter_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = M.name_group(F.col("p_type"), {"plain": r"(BRASS|STEEL)$"}, "decayed")
    rows = table(spark, sf_dir, "part").select("p_type", plain.alias("g"), "p_size")
    return rows.groupBy("p_type").agg(F.count_if(F.col("g") == "decayed").alias("decayed"), F.count_if(F.col("g") == "plain").alias("plain"), F.sum("p_size").alias("total"))


@register("output_order", "select doc_id, cast(row_number() over (order by lower(lang), lower(source), doc_id) as integer) as place from documents")
def output_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places by case-folded keys, within each language's and source's rows, with offsets from their counts."""
    rows = table(spark, sf_dir, "documents").select("doc_id", X.casefolded(F.upper("lang")).alias("a"), X.casefolded(F.col("source")).alias("b"))
    counts = rows.groupBy("a", "b").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("a", "b").orderBy("doc_id"))
    return rows.withColumn("k", place).join(counts.select("a", "b", before.alias("o")), ["a", "b"]).select("doc_id", (F.col("o") + F.col("k")).cast("int").alias("place"))


@register(
    "segment_regions",
    _PACK.format(cap=22 * HOUR, gap=6 * HOUR, pad=HOUR, limit=31 * 24 * HOUR, rows=_EVENTS) + 'select user_id, s::double as "start", e::double as "end" from c',
)
def segment_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_intervals(spark, sf_dir)
    limits = rows.select("user_id").distinct().withColumn("limit", F.lit(31 * 24 * HOUR))
    found = V.segment(rows, ["user_id"], limits, longest=24 * HOUR, shortest=HOUR, padding=HOUR, join_gap=6 * HOUR)
    return found.select("user_id", F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"))


@register(
    "pack_events",
    f"""with recursive r as ({_EVENTS}), g as (select *, lag(e) over w as le, row_number() over w as k from r window w as (partition by user_id order by s, e)),
p as (select *, le is not null and abs(s - le) <= {2 * HOUR} as near, greatest(cast(ceil((e - s) / {4 * HOUR}::double) as bigint) - 1, 0) as whole from g),
f as (select user_id, k, s + whole * {4 * HOUR} as cs, e as ce, s as bs, whole, 1 as grp from p where k = 1
  union all select p.user_id, p.k, case when j then f.cs else p.s + p.whole * {4 * HOUR} end, p.e, case when j then f.bs else p.s end, case when j then f.whole else p.whole end, case when j then f.grp else f.grp + 1 end
  from f join p on p.user_id = f.user_id and p.k = f.k + 1, lateral (select p.near and p.e - f.cs <= {4 * HOUR} as j)),
e as (select user_id, grp, any_value(cs) as cs, arg_max(ce, k) as ce, any_value(bs) as bs, any_value(whole) as whole from f group by user_id, grp)
select user_id, cs as "start", ce as "end" from e where ce - cs >= {HOUR // 2}
union all select user_id, bs + i * {4 * HOUR}, bs + (i + 1) * {4 * HOUR} from (select *, unnest(range(0, whole)) as i from e)""",
)
def pack_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.pack_events(event_intervals(spark, sf_dir), ["user_id"], max_span=4 * HOUR, minimum=HOUR // 2, slack=2 * HOUR)


@register(
    "collapsed_peaks",
    f"""with recursive t as (select *, max(value) over (partition by vec_id order by idx rows between 3 preceding and 3 following) as top from ({_FRAMES})),
p as (select vec_id, idx, value, row_number() over (partition by vec_id order by idx) as k from t where value >= top - 1e-8 and value >= 0),
f as (select vec_id, k, idx, value, 1 as kept from p where k = 1
  union all select p.vec_id, p.k, case when far or up then p.idx else f.idx end, case when far or up then p.value else f.value end, case when far then f.kept + 1 else f.kept end
  from f join p on p.vec_id = f.vec_id and p.k = f.k + 1, lateral (select p.idx - f.idx > 5 as far, p.value > f.value + 1e-9 as up))
select vec_id, cast(arg_max(idx, k) as integer) as idx, arg_max(value, k) as value from f group by vec_id, kept""",
)
def collapsed_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    peaks = V.local_peaks(frames(spark, sf_dir), ["vec_id"], 3, F.lit(0.0))
    return V.collapsed_peaks(peaks, ["vec_id"], 5)


@register(
    "shuffled_batches",
    """select batch, row_number() over (order by md5('4:' || batch::varchar), batch) - 1 as place from (select distinct event_id // 16 as batch from events)""",
)
def shuffled_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 16).alias("batch"))
    return B.shuffled_batches(batches, "batch", 4).select("batch", "place")


@register(
    "excerpts",
    """with t as (select event_id % 700 as i, event_id // 700 as attempt, user_id as key, abs(value) * 10 as d, event_id % 3 <> 0 as sounds from events),
f as (select *, 0.5 + cast('0x' || substr(md5('2:' || i || ':' || attempt), 1, 12) as bigint) / 281474976710656.0::double * (d - 1.5) as o from t where d > 1.5),
w as (select i, arg_min(key, attempt) as key, arg_min(o, attempt) as o from f where sounds group by i)
select a.i as index, w.key, round(w.o, 6) as "offset", w.i is null as silent from (select distinct event_id % 700 as i from events) a left join w on w.i = a.i""",
)
def excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    rows = table(spark, sf_dir, "events").select((k % 700).alias("index"), F.floor(k / 700).alias("attempt"), F.col("user_id").alias("key"), (F.abs("value") * 10).alias("duration"), F.when(k % 3 != 0, 0.1).otherwise(0.0).alias("rms"))
    tries = B.excerpt_tries(rows, "duration", 0.5, 2)
    return B.first_sounding(tries, rows, "rms").select("index", "key", F.round("offset", 6).alias("offset"), "silent")
