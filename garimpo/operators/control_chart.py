"""Spikes, stuck values and impossible readings, per source, by robust exponentially weighted control charts.

1. Readings are reduced to (source, date) -> centre, lowest and highest value. The centre is the exact median of the date's possible
   readings: equal values are counted on the map side first, so a source with a third of all rows is never in one task, and
   what is left of a date is its distinct values. Two of a date's readings at its ends say nothing about the hundreds between.
2. Each source's centres, in order of date, run through two charts, forwards and backwards, many sources at a time in numpy. A
   chart predicts a point before it sees it; a point beyond ``clip`` scales is clipped there before mean and scale are
   updated, so that a spike hardly moves them. The usual value at a date is the mean of both predictions.
3. A run-length counter finds stretches of at least ``run`` successive dates with one value only.
4. Dates whose lowest or highest value breaks a limit, and the limits, go back to the rows. Only those dates travel, keyed by
   source and date.

Defined cases: rows without source, date or value are never flagged, but that a value at or below ``floor`` is impossible
even without a source; such values stay out of the charts, and end a run of one value. Sources with fewer than ``least`` dates have no chart:
the median of all their possible readings is their usual value, if there are at least three of them. Repeated rows are flagged
alike. Empty tables give empty results.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Chart:
    #: relative distance from the usual value that is an offence
    tolerance: float = 0.30
    #: successive dates with one value only that are an offence
    run: int = 6
    #: values at or below are impossible
    floor: float = 0.0
    #: weight of a new point in mean and scale
    weight: float = 0.25
    #: scales at which a point is clipped
    clip: float = 3.0
    #: smallest scale, as a share of the mean
    least_scale: float = 0.02
    #: points that start a chart (their median)
    start: int = 9
    #: dates a source must have for a chart
    least: int = 4


def ewma(mid: np.ndarray, n: np.ndarray, p: Chart) -> np.ndarray:
    """Predictions for padded series (sources x time); nan is a date without centre, the columns beyond ``n`` are ignored."""
    m, width = mid.shape
    mid = np.where(np.arange(width)[None, :] < n[:, None], mid, np.nan)
    # the first ``start`` dates that have a centre
    head = np.where(np.cumsum(~np.isnan(mid), axis=1) <= p.start, mid, np.nan)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", RuntimeWarning)  # a source without any centre stays nan
        centre = np.nanmedian(head, axis=1)
        scale = np.maximum(1.4826 * np.nanmedian(np.abs(head - centre[:, None]), axis=1), p.least_scale * np.abs(centre))
    out = np.empty_like(mid)
    for t in range(width):
        out[:, t] = centre
        r, bound = mid[:, t] - centre, p.clip * scale
        seen = ~np.isnan(r)
        r = np.where(seen, np.clip(r, -bound, bound), 0.0)
        centre = centre + p.weight * r
        scale = np.where(seen, np.maximum((1 - p.weight) * scale + p.weight * 1.2533 * np.abs(r), p.least_scale * np.abs(centre)), scale)
    return out


def usual(series: list[np.ndarray], counts: list[np.ndarray], p: Chart) -> list[np.ndarray]:
    """The usual value at each point of each series of daily centres (nan where a date has none)."""
    out: list = [None] * len(series)
    order = np.argsort([len(a) for a in series], kind="stable")
    for begin in range(0, len(order), 512):  # neighbours in length share a padded block
        block = order[begin : begin + 512]
        n = np.array([len(series[k]) for k in block])
        width = int(n.max(initial=0))
        if not width:
            for k in block:
                out[k] = np.empty(0)
            continue
        mid, back = (np.full((len(block), width), np.nan) for _ in range(2))
        for i, k in enumerate(block):
            mid[i, : n[i]], back[i, : n[i]] = series[k], series[k][::-1]
        forward, backward = ewma(mid, n, p), ewma(back, n, p)
        for i, k in enumerate(block):
            size = n[i]
            if np.count_nonzero(~np.isnan(series[k])) < p.least:
                out[k] = np.full(size, few(series[k], counts[k]))
                continue
            f, b = forward[i, :size], backward[i, :size][::-1]
            w = np.minimum(np.arange(size) / p.start, 1.0)  # a chart counts in full once it has seen enough points
            v = w[::-1]
            total = w + v
            out[k] = np.where(total > 0, (w * f + v * b) / np.where(total > 0, total, 1), (f + b) / 2)
    return out


def few(centres: np.ndarray, counts: np.ndarray) -> float:
    """The median of a few dates' centres, each counted as often as the date has readings; nan below three readings."""
    known = ~np.isnan(centres)
    order = np.argsort(centres[known], kind="stable")
    c, w = centres[known][order], counts[known][order]
    total = int(w.sum())
    if total < 3:
        return float("nan")
    upto = np.cumsum(w)
    return float((c[np.searchsorted(upto, (total + 1) // 2)] + c[np.searchsorted(upto, total // 2 + 1)]) / 2)


def runs(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Length of the stretch of one single value that each point is part of (0 where a date has several)."""
    n = len(lo)
    if not n:
        return np.empty(0, int)
    same = np.zeros(n, bool)
    same[1:] = (lo[1:] == lo[:-1]) & (hi[1:] == hi[:-1]) & (lo[1:] == hi[1:])
    group = np.cumsum(~same)
    length = np.bincount(group)[group]
    return np.where(lo == hi, length, 0)


def limits(readings: DataFrame, source: list[str], date: str, value: str, p: Chart = Chart()) -> DataFrame:
    """(__k0.., __d, __lo, __hi, __usual, __run) for the sources and dates that break a limit."""
    keys = [f"__k{n}" for n in range(len(source))]  # names of our own: the readings may have any
    points = readings.select(*(F.col(c).alias(k) for c, k in zip(source, keys)), F.col(date).alias("__d"), F.col(value).cast("double").alias("__v"))
    for c in [*keys, "__d", "__v"]:
        points = points.filter(F.col(c).isNotNull())
    points = points.filter(~F.isnan("__v"))
    possible = F.when(F.col("__v") > p.floor, F.col("__v"))
    daily = points.groupBy(*keys, "__d").agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"), F.percentile(possible, F.lit(0.5)).alias("__m"), F.count(possible).alias("__n"))
    series = daily.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__d", "__lo", "__hi", "__m", "__n"))).alias("__s"))

    @F.pandas_udf("array<struct<usual:double,run:int>>")
    def chart(lows: pd.Series, highs: pd.Series, centres: pd.Series, counts: pd.Series) -> pd.Series:
        judged = usual([np.asarray(c, float) for c in centres], [np.asarray(c) for c in counts], p)
        return pd.Series([[{"usual": float(u), "run": int(r)} for u, r in zip(us, runs(np.asarray(a, float), np.asarray(b, float)))] for us, a, b in zip(judged, lows, highs)], dtype=object)

    judged = series.withColumn("__j", chart(F.col("__s.__lo"), F.col("__s.__hi"), F.col("__s.__m"), F.col("__s.__n")))
    flat = judged.select(*keys, F.explode(F.arrays_zip("__s", "__j")).alias("x")).select(*keys, F.col("x.__s.__d").alias("__d"), F.col("x.__s.__lo").alias("__lo"), F.col("x.__s.__hi").alias("__hi"), F.col("x.__j.usual").alias("__usual"), F.col("x.__j.run").alias("__run"))
    far = ~F.isnan("__usual") & ((F.col("__lo") < F.col("__usual") * (1 - p.tolerance)) | (F.col("__hi") > F.col("__usual") * (1 + p.tolerance)))
    return flat.filter(far | (F.col("__run") >= p.run))


def flag(readings: DataFrame, source: list[str], date: str, value: str, p: Chart = Chart()) -> DataFrame:
    """The offending rows with ``motivo`` (impossivel, salto, parado) and the ``usual`` value; columns of these two names are replaced."""
    broken = limits(readings, source, date, value, p)
    v = F.col(value).cast("double")
    keep = [c for c in readings.columns if c not in ("usual", "motivo")]
    # impossible values need no company; the others meet their source's limits
    impossible = readings.filter(v <= p.floor).select(*keep, F.lit(None).cast("double").alias("usual"), F.lit("impossivel").alias("motivo"))
    same = [F.col(c) == F.col(f"__k{n}") for n, c in enumerate(source)] + [F.col(date) == F.col("__d")]
    rest = readings.filter(v > p.floor).join(broken, same)
    far = ~F.isnan("__usual") & (F.abs(v - F.col("__usual")) > p.tolerance * F.abs(F.col("__usual")))
    why = F.when(far, "salto").when(F.col("__run") >= p.run, "parado")
    return rest.select(*keep, F.col("__usual").alias("usual"), why.alias("motivo")).filter(F.col("motivo").isNotNull()).unionByName(impossible)
