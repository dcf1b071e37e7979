"""Numeric kernels over array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(x: Column) -> Column:
    """Sum of the elements, in order, as double."""
    return F.aggregate(x, F.lit(0.0).cast("double"), lambda a, v: a + v.cast("double"))


def masked_mean(x: Column, mask: Column) -> Column:
    """Sum of x where the mask holds, over the number of those, at least 1."""
    hits = F.zip_with(x, mask, lambda v, m: F.when(m, v.cast("double")).otherwise(F.lit(0.0)))
    return total(hits) / F.greatest(F.size(F.filter(mask, lambda m: m)).cast("double"), F.lit(1.0))


def step_mse(a: Column, b: Column) -> Column:
    """Squared difference of two sequences of vectors, as a mean for each step."""
    square = lambda u, v: F.aggregate(F.zip_with(u, v, lambda p, q: p.cast("double") - q.cast("double")), F.lit(0.0), lambda s, d: s + d * d)
    return F.zip_with(a, b, lambda u, v: square(u, v) / F.size(u))


def masked_mse(a: Column, b: Column, mask: Column) -> Column:
    """Mean squared difference of two sequences of numbers where the mask holds."""
    square = F.zip_with(a, b, lambda u, v: (u - v).cast("double") * (u - v).cast("double"))
    return masked_mean(square, mask)


def utterance_mean_mse(error: Column, valid: Column) -> Column:
    """Aggregate: each row's mean error over its valid steps (at least 1), then the mean of the rows."""
    return F.avg(masked_mean(error, valid))


def ratio_normalized_mse(error: Column, counted: Column, valid: Column) -> Column:
    """Aggregate: the mean of counted errors over all steps, by the share of steps both counted and valid.

    A row without a valid step adds nothing to that share, which is at least 1e-6.
    """
    weight = lambda m: F.when(m, F.lit(1.0)).otherwise(F.lit(0.0))
    steps = F.sum(F.size(error))
    errors = F.sum(total(F.zip_with(error, counted, lambda e, m: e * weight(m))))
    both = F.sum(total(F.zip_with(counted, valid, lambda m, v: weight(m & v))))
    return errors / steps / F.greatest(both / steps, F.lit(1e-6))


def replaced_last(x: Column, value: Column) -> Column:
    """An array with another last element, as the speaker flag of duration features."""
    return F.concat(F.slice(x, 1, F.greatest(F.size(x) - 1, F.lit(0))), F.array(value))


def velocity(x0: Column, x1: Column) -> Column:
    """Direction from x0 to x1, element by element."""
    return F.zip_with(x0, x1, lambda a, b: b.cast("double") - a.cast("double"))


def origin(xt: Column, v: Column, t: float) -> Column:
    """Where a straight path started that is at xt at time t with this velocity."""
    return F.zip_with(xt, v, lambda x, d: x.cast("double") - t * d.cast("double"))


def peak(x: Column) -> Column:
    """Largest absolute value, 0 if empty."""
    return F.coalesce(F.array_max(F.transform(x, lambda v: F.abs(v.cast("double")))), F.lit(0.0))


def rms(x: Column) -> Column:
    """Root of the mean square, 0 if empty."""
    squares = F.aggregate(x, F.lit(0.0).cast("double"), lambda a, v: a + v.cast("double") * v.cast("double"))
    return F.when(F.size(x) > 0, F.sqrt(squares / F.size(x))).otherwise(F.lit(0.0))


def clipping(x: Column, level: float = 0.999) -> Column:
    """Share of elements at or beyond the level."""
    return F.when(F.size(x) > 0, F.size(F.filter(x, lambda v: F.abs(v) >= level)) / F.size(x)).otherwise(F.lit(0.0))


def frame_rms(x: Column, frame: int) -> Column:
    """Root mean square of each whole frame; the rest is left out."""
    n = F.floor(F.size(x) / F.lit(frame)).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: rms(F.slice(x, i * frame + 1, frame)))).otherwise(F.array().cast("array<double>"))


def patchify(x: Column, p: int, width: int = 1) -> Column:
    """Groups of p consecutive frames (each of `width` elements) as one patch; a rest is left out."""
    size = p * width
    n = F.floor(F.size(x) / F.lit(size)).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(x, i * size + 1, size)))


def unpatchify(patches: Column) -> Column:
    """Frames of patches in order."""
    return F.flatten(patches)


def padded(x: Column, size: int, fill: float = 0.0) -> Column:
    """Cut or filled up to size."""
    return F.slice(F.concat(x, F.array_repeat(F.lit(fill).cast("float"), size)), 1, size)


def padding_mask(x: Column, size: int) -> Column:
    """True for elements that are no filling."""
    return F.transform(F.sequence(F.lit(1), F.lit(size)), lambda i: i <= F.size(x))


def flattening_point(x: Column, window: int = 20, flat: float = 0.05, level: float = 0.1, target: float = 0.0) -> Column:
    """First start of a window (zeros behind the end) with a deviation below `flat` and a mean near `target`; the length if none."""
    long = F.concat(F.transform(x, lambda v: v.cast("double")), F.array_repeat(F.lit(0.0), window))
    n = F.size(x)

    def fits(i: Column) -> Column:
        part = F.slice(long, i + 1, window)
        fine = F.aggregate(
            part,
            F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q")),
            lambda a, v: F.struct((a["s"] + v).alias("s"), (a["q"] + v * v).alias("q")),
            # The deviation from the mean square; one pass over the window.
            lambda a: (F.sqrt(F.greatest(a["q"] / window - (a["s"] / window) * (a["s"] / window), F.lit(0.0))) < flat) & (F.abs(a["s"] / window - target) < level),
        )
        return fine

    hits = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), fits)
    return F.when(n == 0, 0).otherwise(F.coalesce(F.get(hits, F.lit(0)), n)).cast("int")


def ema(values: Column, decay: float) -> Column:
    """Exponential moving average of an ordered array, from its first element."""
    start = F.get(values, F.lit(0)).cast("double")
    return F.aggregate(F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0))), start, lambda a, v: a + (1 - decay) * (v.cast("double") - a))


def raised_cosine_ramp(i: Column, n: Column) -> Column:
    """Step i (from 0) of a rise from 0 towards 1 in n steps."""
    return 0.5 - 0.5 * F.cos(F.lit(3.141592653589793) * i / n)


def raised_cosine(n: int, rising: bool = True) -> Column:
    """Fade of n steps from 0 towards 1, or back."""
    up = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: raised_cosine_ramp(i, F.lit(n)))
    return up if rising else F.reverse(up)


def lr_scale(step: Column, kind: str, warmup: int, total_steps: int, stable: int = 0, least: float = 0.0) -> Column:
    """Learning-rate factor at a step: linear warm-up, then a cosine, or a plateau and a cosine (wsd)."""
    if kind not in ("cosine", "wsd"):
        raise ValueError(f"unknown schedule {kind}")
    hold = warmup + (stable if kind == "wsd" else 0)
    share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (step - hold) / F.lit(float(max(1, total_steps - hold)))))
    tail = least + (1.0 - least) * (0.5 * (1.0 + F.cos(F.lit(3.141592653589793) * share)))
    out = F.when(step < warmup, (step + 1) / F.lit(float(max(1, warmup))))
    return (out.when(step < hold, F.lit(1.0)) if kind == "wsd" else out).otherwise(tail)


def sway(u: Column, s: float) -> Column:
    """Warped time in [0, 0.999]."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), u + s * (F.cos(F.lit(1.5707963267948966) * u) + u - 1))) * 0.999


def interpolate(x0: Column, x1: Column, t: float) -> Column:
    """(1 - t) * x0 + t * x1, element by element."""
    return F.zip_with(x0, x1, lambda a, b: (1 - t) * a.cast("double") + t * b.cast("double"))


def frames_from_duration(log1p_mean: Column, scale: float, least: int, most: int) -> Column:
    """Predicted frames: expm1, scaled, rounded half to even, held in bounds."""
    return F.least(F.greatest(F.bround(F.expm1(log1p_mean) * scale).cast("long"), F.lit(least)), F.lit(most))
