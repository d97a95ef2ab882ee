"""Window-feature builders for ordered series.

Every builder takes the value column and one ``WindowSpec`` (partition = series,
order = time). Builders that share the spec share one sort: Spark evaluates them
in the same Window operator, whatever their frames are. ``shift=1`` makes a
feature at row t depend on rows before t only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, Window, WindowSpec, functions as F

from .scalars import clip_lower, safe_div

# Decay of the repeat-event probability with the lag in months.
REPEAT_SCALE = 0.106
REPEAT_POWER = -0.383
REPEAT_OFFSET = 0.018


def series_window(series: str | list[str], *order: str) -> WindowSpec:
    keys = [series] if isinstance(series, str) else list(series)
    return Window.partitionBy(*keys).orderBy(*order)


def lagged(x: Column, k: int, w: WindowSpec) -> Column:
    return x if k == 0 else F.lag(x, k).over(w)


def full_frame(agg, x: Column, w: WindowSpec, first: int, last: int) -> Column:
    """``agg`` over rows first..last, NULL unless every row of the frame has a value."""
    frame = w.rowsBetween(first, last)
    return F.when(F.count(x).over(frame) == last - first + 1, agg(x).over(frame))


def rolling_sum(x: Column, n: int, w: WindowSpec, shift: int = 1) -> Column:
    return full_frame(F.sum, x, w, -(n - 1) - shift, -shift)


def rolling_mean(x: Column, n: int, w: WindowSpec, shift: int) -> Column:
    return full_frame(F.avg, x, w, -(n - 1) - shift, -shift)


def rolling_std(x: Column, n: int, w: WindowSpec, shift: int) -> Column:
    return full_frame(F.stddev_samp, x, w, -(n - 1) - shift, -shift)


def active(x: Column, n: int, w: WindowSpec) -> Column:
    """1 if the n rows before t hold any event, 0 if not or too few; NULL on the first row."""
    total = rolling_sum(x, n, w, shift=1)
    has_past = F.lag(F.lit(1), 1).over(w).isNotNull()
    return F.when(has_past, F.when(total > 0, 1).otherwise(0))


def pct_change(x: Column, near: int, far: int, w: WindowSpec) -> Column:
    base = lagged(x, far, w)
    return safe_div(lagged(x, near, w) - base, base)


def volatility(x: Column, n: int, w: WindowSpec, shift: int) -> Column:
    return safe_div(rolling_std(x, n, w, shift), rolling_mean(x, n, w, shift))


def trend_ratio(x: Column, n: int, w: WindowSpec, near: int, far: int) -> Column:
    return safe_div(rolling_mean(x, n, w, near), rolling_mean(x, n, w, far))


def wma(x: Column, n: int, w: WindowSpec, shift: int = 0) -> Column:
    """Linearly weighted mean, newest heaviest, never below 0.

    NULL until n values exist and wherever one of the n values is NULL: the sum of
    lags carries NULL through by itself.
    """
    if n < 1:
        raise ValueError("period must be at least 1")
    total = None
    for weight in range(1, n + 1):
        term = lagged(x, shift + n - weight, w).cast("double") * F.lit(float(weight))
        total = term if total is None else total + term
    return clip_lower(total / F.lit(n * (n + 1) / 2.0))


def hull_inner(x: Column, n: int, w: WindowSpec) -> Column:
    """Inner difference of the Hull mean; the outer pass is ``hull_outer``."""
    return wma(x, n // 2, w) * 2 - wma(x, n, w)


def hull_outer(inner: Column, n: int, w: WindowSpec, shift: int = 1) -> Column:
    return wma(inner, int(math.isqrt(n)), w, shift)


def ewm_block(spans: Sequence[int]) -> int:
    """Rows of a block in which the closed form of ``ewm_inner`` stays inside double range
    for every span, while what a block leaves to the next but one is below 1e-16."""
    block = int(350 / math.log((min(spans) + 1) / (min(spans) - 1)))
    if block * math.log((max(spans) + 1) / (max(spans) - 1)) < 37:
        raise ValueError(f"spans too far apart for one pass: {sorted(spans)}")
    return block


def ewm_inner(x: Column, span: int, t: Column, block: int, inner: WindowSpec) -> Column:
    """Part of the exponential mean that comes from the row's own block.

    e0 = x0, e_t = (1-a) e_(t-1) + a x_t with a = 2/(span+1). Unrolled inside a block of
    rows (row ``j`` of it), that is ``r^j * cumulative sum(a * x_i / r^i)``: one running
    sum, O(1) per row. ``inner`` is the window of one block.
    """
    total = F.sum(ewm_term(x, span, t, block)).over(inner.rowsBetween(Window.unboundedPreceding, 0))
    return total * F.pow(F.lit(1.0 - 2.0 / (span + 1)), t % block)


def ewm_term(x: Column, span: int, t: Column, block: int) -> Column:
    """What a row adds to the running sum of its block."""
    alpha = 2.0 / (span + 1)
    r = 1.0 - alpha
    return x.cast("double") * F.pow(F.lit(1.0 / r), t % block) * F.when(t == 0, 1.0).otherwise(alpha)


def ewm_whole(part: Column, span: int, t: Column, block: int, w: WindowSpec) -> Column:
    """The exponential mean: ``part`` (of ``ewm_inner``) and what the block before has left."""
    j = t % block
    ends = F.when(j == block - 1, part)
    left = F.last(ends, True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return part + F.coalesce(left, F.lit(0.0)) * F.pow(F.lit(1.0 - 2.0 / (span + 1)), j + 1)


def repeat_weight(lag: int) -> float:
    """Weight of an event ``lag`` months ago; 0 for a lag of 0 or less."""
    if lag <= 0:
        return 0.0
    return max(REPEAT_SCALE * lag ** REPEAT_POWER - REPEAT_OFFSET, 0.0)


def repeat_risk(x: Column, w: WindowSpec, max_lag: int = 24, prob: float = 0.134) -> Column:
    """Probability-weighted sum of the past counts; missing history counts as 0."""
    total = F.lit(0.0)
    for lag in range(1, max_lag + 1):
        past = F.lag(F.coalesce(x.cast("double"), F.lit(0.0)), lag, 0.0).over(w)
        total = total + past * F.lit(repeat_weight(lag))
    return total * F.lit(prob)
