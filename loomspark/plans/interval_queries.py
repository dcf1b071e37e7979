"""Interval operators over events as intervals: user is the source, the event starts at ts and lasts value seconds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.operators import intervals as V
from loomspark.plans.registry import register
from loomspark.session import table

HOUR = 3_600_000_000
#: Packing limits and the fixed end of every source, in microseconds.
CAP, GAP, END = 24 * HOUR, 6 * HOUR, 31 * 24 * HOUR
_ROWS = "select user_id, epoch_us(ts) - epoch_us(timestamp '2024-01-01') as s, epoch_us(ts) - epoch_us(timestamp '2024-01-01') + cast(floor(abs(value) * 1000) as bigint) * 60000 as e from events"


def event_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, start, end) in microseconds since 2024-01-01; a value of 1 lasts a minute."""
    start = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)")
    rows = table(spark, sf_dir, "events").select("user_id", start.alias("start"), (F.floor(F.abs("value") * 1000) * 60000).cast("long").alias("length"))
    return rows.select("user_id", "start", (F.col("start") + F.col("length")).alias("end"))


def _limits(rows: DataFrame) -> DataFrame:
    return rows.select("user_id").distinct().withColumn("limit", F.lit(END))


@register(
    "vad_complement",
    f"""with r as ({_ROWS}), w as (select user_id, s, greatest(coalesce(max(e) over (partition by user_id order by s, e rows between unbounded preceding and 1 preceding), 0), 0) as reach from r)
select user_id, reach as gap_start, s as gap_end from w where s - reach >= {GAP}
union all select user_id, greatest(max(e), 0), {END} from r group by user_id having {END} - greatest(max(e), 0) >= {GAP}""",
)
def vad_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_intervals(spark, sf_dir)
    return V.complement(rows, ["user_id"], _limits(rows), GAP)


@register(
    "midpoint_cut",
    f"""with r as (select user_id, s, s + {2 * HOUR} as e, row_number() over (partition by user_id order by s, e) as k from ({_ROWS})),
w as (select *, lag(e) over (partition by user_id order by k) as le, lead(s) over (partition by user_id order by k) as ns from r)
select user_id, k as place, case when le > s then (le + s) / 2.0::double else s end as cut_start, case when e > ns then (e + ns) / 2.0::double else e end as cut_end from w""",
)
def midpoint_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    rows = event_intervals(spark, sf_dir)
    placed = rows.withColumn("place", F.row_number().over(Window.partitionBy("user_id").orderBy("start", "end")).cast("long"))
    placed = placed.withColumn("end", F.col("start") + 2 * HOUR)
    cut = V.midpoint_cut(placed, ["user_id"], ["place"])
    return cut.select("user_id", "place", F.col("cut_start").cast("double").alias("cut_start"), F.col("cut_end").cast("double").alias("cut_end"))


_PIECES = f"""select user_id, s + i * {CAP} as s, least(s + (i + 1) * {CAP}, e) as e
  from (select user_id, s, e, unnest(range(0, greatest(cast(ceil((e - s) / {CAP}::double) as bigint), 1))) as i from ({_ROWS}) where e > s)"""


@register(
    "pack_regions",
    f"""with recursive p as ({_PIECES}), o as (select *, row_number() over (partition by user_id order by s, e) as k from p),
f as (select user_id, k, s as cs, e as ce, 1 as pack from o where k = 1
  union all select o.user_id, o.k, case when j then f.cs else o.s end, case when j then greatest(f.ce, o.e) else o.e end, case when j then f.pack else f.pack + 1 end
  from f join o on o.user_id = f.user_id and o.k = f.k + 1, lateral (select greatest(o.s - f.ce, 0) <= {GAP} and o.e - f.cs <= {CAP} as j))
select user_id, min(cs) as "start", max(ce) as "end", count(*) as parts from f group by user_id, pack""",
)
def pack_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.pack(event_intervals(spark, sf_dir), ["user_id"], CAP, GAP)


@register(
    "gap_sessions",
    f"""with r as ({_ROWS}), w as (select *, max(e) over (partition by user_id order by s, e rows between unbounded preceding and 1 preceding) as reach from r),
i as (select *, sum(case when reach is null or s - reach > {GAP} then 1 else 0 end) over (partition by user_id order by s, e rows unbounded preceding) as island from w)
select user_id, cast(island as bigint) as island, min(s) as "start", max(e) as "end", count(*) as parts from i group by user_id, island""",
)
def gap_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = V.islands(event_intervals(spark, sf_dir), ["user_id"], GAP)
    return cut.groupBy("user_id", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("parts"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as frames: vec_id, idx from 0, value."""
    return table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("idx", "value")).withColumn("value", F.col("value").cast("double"))


_FRAMES = "select vec_id, i as idx, embedding[i + 1]::double as value from (select vec_id, embedding, unnest(range(0, len(embedding))) as i from embeddings)"


@register(
    "pause_runs",
    f"""with q as (select * from ({_FRAMES}) where abs(value) < 0.1), r as (select *, idx - row_number() over (partition by vec_id order by idx) as run from q)
select vec_id, cast(min(idx) as integer) as "first", cast(max(idx) as integer) as "last", cast(arg_min(idx, (abs(value), idx)) as integer) as lowest
from r group by vec_id, run having max(idx) - min(idx) + 1 >= 4""",
)
def pause_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames(spark, sf_dir).select("vec_id", "idx", F.abs("value").alias("rms"))
    return V.quiet_runs(rows, ["vec_id"], F.col("rms") < 0.1, 4)


@register(
    "local_peaks",
    f"""select vec_id, cast(idx as integer) as idx, round(value, 6) as value from (select *, max(value) over (partition by vec_id order by idx rows between 5 preceding and 5 following) as top from ({_FRAMES}))
where value >= top - 1e-8 and value >= 0.1""",
)
def local_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.local_peaks(frames(spark, sf_dir), ["vec_id"], 5, F.lit(0.1)).select("vec_id", "idx", F.round("value", 6).alias("value"))


@register(
    "replicate_pool_mean",
    f"""with f as ({_FRAMES}), w as (select *, sum(value) over (partition by vec_id order by idx rows between 3 preceding and 3 following) as s,
  first_value(value) over (partition by vec_id order by idx) as fv, last_value(value) over (partition by vec_id order by idx rows between unbounded preceding and unbounded following) as lv,
  count(*) over (partition by vec_id) as n from f)
select vec_id, cast(idx as integer) as idx, round((s + greatest(3 - idx, 0) * fv + greatest(idx + 3 - (n - 1), 0) * lv) / 7, 5) + 0.0 as smooth from w""",
)
def replicate_pool_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.smoothed_mean(frames(spark, sf_dir), ["vec_id"], 7).select("vec_id", "idx", (F.round("smooth", 5) + 0.0).alias("smooth"))


@register(
    "context_step",
    f"""with f as ({_FRAMES}), w as (select *, avg(value) over (partition by vec_id order by idx rows between 6 preceding and 1 preceding) as l,
  avg(value) over (partition by vec_id order by idx rows between current row and 5 following) as r, count(*) over (partition by vec_id) as n from f)
select vec_id, cast(idx as integer) as idx, round(case when idx >= 6 and idx < n - 6 then abs(l - r) else 0 end, 6) as step from w""",
)
def context_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.context_step(frames(spark, sf_dir), ["vec_id"], 6).select("vec_id", "idx", F.round("step", 6).alias("step"))


@register(
    "positive_flux",
    """with f as (select label, vec_id as idx, list_transform(embedding, lambda x: x::double) as s, lag(list_transform(embedding, lambda x: x::double)) over (partition by label order by vec_id) as p from embeddings)
select label, idx, round(coalesce(sqrt(list_sum(list_transform(list_zip(s, p), lambda z: power(greatest(z[1] - z[2], 0), 2)))), 0), 6) as flux from f""",
)
def positive_flux(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("label", F.col("vec_id").alias("idx"), F.col("embedding").alias("spectrum"))
    return V.positive_flux(rows, ["label"]).select("label", "idx", F.round("flux", 6).alias("flux"))
