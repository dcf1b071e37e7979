"""Metrics, quantiles, schedules and array kernels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomspark.functions import arrays as A
from loomspark.functions import schedules as C
from loomspark.operators import metrics as K
from loomspark.plans.registry import register
from loomspark.session import table

_GROUPS = {
    "speaker": "sp", "no_speaker": "not sp", "caption": "cap", "no_caption": "not cap",
    "speaker_caption": "sp and cap", "speaker_only": "sp and not cap", "caption_only": "not sp and cap", "neither": "not sp and not cap",
}


@register(
    "conditional_metrics",
    "select event_type, "
    + ", ".join(f"count(*) filter (where {c}) as n_{g}, round(coalesce(sum(value) filter (where {c}) / nullif(count(*) filter (where {c}), 0), 0), 6) as loss_{g}" for g, c in _GROUPS.items())
    + " from (select event_type, value, case when user_id % 5 <> 0 then user_id % 2 = 0 end as sp, event_id % 3 = 0 as cap from events) group by event_type",
)
def conditional_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    speaker = F.when(F.col("user_id") % 5 != 0, F.col("user_id") % 2 == 0)
    rows = table(spark, sf_dir, "events").select("event_type", "value", speaker.alias("sp"), (F.col("event_id") % 3 == 0).alias("cap"))
    return rows.groupBy("event_type").agg(*K.conditional_means({"loss": F.col("value")}, F.col("sp"), F.col("cap")))


@register("weighted_mean", "select l_returnflag, round(sum(l_discount * l_quantity) / sum(l_quantity), 8) as mean from lineitem group by l_returnflag")
def weighted_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.round(K.weighted_mean(F.col("l_discount"), F.col("l_quantity")), 8).alias("mean"))


@register("moving_average_20", "select event_id, round(avg(value) over (partition by user_id order by event_id rows between 19 preceding and current row), 7) as mean from events")
def moving_average_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = K.trailing_mean(F.col("value"), ["user_id"], ["event_id"], 20)
    return table(spark, sf_dir, "events").select("event_id", F.round(mean, 7).alias("mean"))


@register("throughput_rate", "select event_id, round((event_id - lag(event_id) over w) * 8 / nullif(event_id * 0.5::double - lag(event_id * 0.5::double) over w, 0), 6) as rate from events window w as (partition by user_id order by event_id)")
def throughput_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = K.rate(F.col("event_id"), F.col("event_id") * 0.5, ["user_id"], ["event_id"], 8)
    return table(spark, sf_dir, "events").select("event_id", F.round(found, 6).alias("rate"))


@register("exact_quantiles", "select event_type, round(quantile_cont(value, 0.6), 6) as q60, round(quantile_cont(value, 0.9), 6) as q90, round(quantile_cont(value, 0.99), 6) as q99 from events group by event_type")
def exact_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.percentile("value", F.array(F.lit(0.6), F.lit(0.9), F.lit(0.99)))
    rows = table(spark, sf_dir, "events").groupBy("event_type").agg(q.alias("q"))
    return rows.select("event_type", *[F.round(F.col("q")[i], 6).alias(n) for i, n in enumerate(("q60", "q90", "q99"))])


@register(
    "huber_metrics",
    """select l_returnflag, round(avg(case when abs(d) <= 1 then 0.5 * d * d else abs(d) - 0.5 end), 6) as huber, round(avg(abs(exp(p) - 1 - l_quantity)), 5) as mae
from (select l_returnflag, l_quantity, ln(1 + l_quantity * (1 + l_discount)) as p, ln(1 + l_quantity * (1 + l_discount)) - ln(1 + l_quantity * 0.25) as d from lineitem) group by l_returnflag""",
)
def huber_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.log1p(F.col("l_quantity") * (1 + F.col("l_discount")))
    error = p - F.log1p(F.col("l_quantity") * 0.25)
    rows = table(spark, sf_dir, "lineitem")
    return rows.groupBy("l_returnflag").agg(F.round(F.avg(K.huber(error, 1.0)), 6).alias("huber"), F.round(F.avg(K.frame_error(p, F.col("l_quantity"))), 5).alias("mae"))


_V = "list_transform(embedding, lambda x: x::double)"


@register(
    "peak_rms_clip",
    f"""select vec_id, round(list_max(list_transform(v, lambda x: abs(x))), 6) as peak, round(sqrt(list_sum(list_transform(v, lambda x: x * x)) / len(v)), 6) as rms,
  round(len(list_filter(v, lambda x: abs(x) >= 0.2)) / len(v), 6) as clipping from (select vec_id, {_V} as v from embeddings)""",
)
def peak_rms_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    figures = [F.round(A.peak(e), 6).alias("peak"), F.round(A.rms(e), 6).alias("rms"), F.round(A.clipping(F.transform(e, lambda x: x.cast("double")), 0.2), 6).alias("clipping")]
    return table(spark, sf_dir, "embeddings").select("vec_id", *figures)


@register(
    "masked_mean",
    f"""select vec_id, round(list_sum(list_filter(v, lambda x: x > 0)) / greatest(len(list_filter(v, lambda x: x > 0)), 1), 6) as mean from (select vec_id, {_V} as v from embeddings)""",
)
def masked_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(A.masked_mean(e, F.transform(e, lambda x: x > 0)), 6).alias("mean"))


@register(
    "patchify",
    """select vec_id, i as patch, round(list_sum(list_transform(embedding[i * 6 + 1:i * 6 + 6], lambda x: x::double)), 5) as total
from (select vec_id, embedding, unnest(range(0, len(embedding) // 6)) as i from embeddings)""",
)
def patchify(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(A.patchify(F.col("embedding"), 6)).alias("patch", "p"))
    return rows.select("vec_id", F.col("patch").cast("long").alias("patch"), F.round(A.total(F.col("p")), 5).alias("total"))


@register("unpatchify", "select vec_id, len(embedding) // 6 * 6 as frames, md5(array_to_string(list_transform(embedding[1:len(embedding) // 6 * 6], lambda x: round(x::double * 1000000)::bigint), ',')) as digest from embeddings")
def unpatchify(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = A.unpatchify(A.patchify(F.col("embedding"), 6))
    digits = F.transform(back, lambda x: F.round(x.cast("double") * 1000000).cast("long").cast("string"))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.size(back).cast("long").alias("frames"), F.md5(F.array_join(digits, ",")).alias("digest"))


@register(
    "flattening_point",
    f"""with v as (select vec_id, len(embedding) as n, list_concat({_V}, list_transform(range(0, 20), lambda x: 0.0::double)) as v from embeddings),
w as (select vec_id, n, i, v[i + 1:i + 20] as p from (select *, unnest(range(0, n)) as i from v)),
s as (select vec_id, n, i, list_sum(p) / 20 as m, list_sum(list_transform(p, lambda x: x * x)) / 20 as q from w)
select vec_id, cast(coalesce(min(i) filter (where sqrt(greatest(q - m * m, 0)) < 0.11 and abs(m) < 0.1), max(n)) as integer) as point from s group by vec_id""",
)
def flattening_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", A.flattening_point(F.col("embedding"), flat=0.11).alias("point"))


@register(
    "lr_schedule",
    """select i as step, round(case when i < 50 then (i + 1) / 50.0::double else 0.1 + 0.9 * 0.5 * (1 + cos(pi() * least(1, (i - 50) / 450.0::double))) end, 6) as cosine,
  round(case when i < 50 then (i + 1) / 50.0::double when i < 250 then 1 else 0.1 + 0.9 * 0.5 * (1 + cos(pi() * least(1, (i - 250) / 250.0::double))) end, 6) as wsd from range(0, 520) t(i)""",
)
def lr_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = F.col("step")
    rows = spark.range(520).select(F.col("id").alias("step"))
    return rows.select("step", F.round(A.lr_scale(step, "cosine", 50, 500, least=0.1), 6).alias("cosine"), F.round(A.lr_scale(step, "wsd", 50, 500, 200, 0.1), 6).alias("wsd"))


@register(
    "ema_fold",
    """with recursive o as (select user_id, value, row_number() over (partition by user_id order by event_id) as k, count(*) over (partition by user_id) as n from events),
f as (select user_id, k, n, value::double as e from o where k = 1 union all select o.user_id, o.k, o.n, f.e + 0.1 * (o.value - f.e) from f join o on o.user_id = f.user_id and o.k = f.k + 1)
select user_id, round(e, 5) as ema from f where k = n""",
)
def ema_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("event_id"))) - 1
    first = F.count("*").over(Window.partitionBy("user_id")) - 1
    rows = table(spark, sf_dir, "events").select("user_id", "value", back.alias("back"), first.alias("first"))
    return rows.groupBy("user_id").agg(F.round(K.ema(F.col("value"), F.col("back"), F.col("first"), 0.9), 5).alias("ema"))


@register("interpolate", "select vec_id, round(list_sum(list_transform(embedding, lambda x: 0.75 * x::double)) + 0.25 * len(embedding), 5) as total from embeddings")
def interpolate(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    ones = F.transform(e, lambda x: F.lit(1.0))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(A.total(A.interpolate(e, ones, 0.25)), 5).alias("total"))


@register(
    "padded_batch",
    f"""select vec_id, cast(80 as integer) as size, cast(least(len(v), 80) as integer) as filled, round(list_sum(v[1:80]), 5) + 0.0 as total,
  cast(least(len(v), 40) as integer) as cut, round(list_sum(v[1:40]), 5) + 0.0 as cut_total from (select vec_id, {_V} as v from embeddings)""",
)
def padded_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    wide, narrow, mask = A.padded(e, 80), A.padded(e, 40), A.padding_mask(e, 80)
    sums = [(F.round(A.total(x), 5) + 0.0).alias(name) for x, name in ((wide, "total"), (narrow, "cut_total"))]
    return table(spark, sf_dir, "embeddings").select("vec_id", F.size(wide).alias("size"), F.size(F.filter(mask, lambda m: m)).alias("filled"), F.size(narrow).alias("cut"), *sums)


@register("pricing_rollup", "select l_returnflag, l_linestatus, count(*) as n, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue from lineitem where l_shipdate <= timestamp '1998-09-02' group by all")
def pricing_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").where("l_shipdate <= TIMESTAMP_NTZ'1998-09-02 00:00:00'")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@register(
    "time_schedules",
    """select i as step, round(greatest(0, least(1, u + 0.5 * (cos(pi() / 2 * u) + u - 1))) * 0.999, 6) as sway,
  round((((1 - u) * (1 - u) / (u * u) * 0.25 + 1) / ((1 - u) * (1 - u) / (u * u) * 0.25 / 1.5 + 1) * ((1 - u) * 0.3 + 0.7) - 0.7) / (1 - u), 6) as rescaled,
  printf('rank01_%08d.pt', i) as latent, cast(case when i % 7 = 0 then 64 else least(i, 64) end as bigint) as length
from (select i, i / 100.0::double as u from range(1, 100) t(i))""",
)
def time_schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.range(1, 100).select(F.col("id").alias("step"), (F.col("id") / 100.0).alias("u"))
    frames = F.when(F.col("step") % 7 == 0, -1).otherwise(F.col("step"))
    return rows.select(
        "step", F.round(A.sway(F.col("u"), 0.5), 6).alias("sway"), F.round(C.score_rescaled(F.lit(0.3), F.lit(0.7), F.col("u"), 1.5, 0.5), 6).alias("rescaled"),
        C.latent_name(F.col("step"), 1, 4).alias("latent"), C.sample_length(frames, 64).cast("long").alias("length"),
    )
