"""Exact quantiles of many columns without sorting or gathering a column.

Each round counts the values of every open bracket in equal-width buckets (one
scan, partial aggregation, at most ``BUCKETS`` rows per bracket) and keeps the one
bucket that holds the wanted rank. A bracket whose rows are few is finished by
fetching its distinct values, so no task or driver holds more than a fixed number
of rows however long the table is.

Infinities get buckets of their own, positions are computed on halved bounds where a
range overflows, and a bracket that equal widths hardly narrow (values of very different
magnitude) is cut by sign and then by exponent. Every round must leave something out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from basketlens.operators.columns import column_stats, present

BUCKETS = 1024
FETCH_ROWS = 10_000


@dataclass
class _Bracket:
    column: str
    rank: int  # 0-based rank of the lower neighbour, counted from the bracket's start
    fraction: float
    low: float
    high: float
    rows: int
    value: float | None = None
    by_magnitude: bool = False

    @property
    def span(self) -> tuple[str, float, float, bool]:
        return self.column, self.low, self.high, self.by_magnitude


def _position(value: Column, low: float, high: float, by_magnitude: bool) -> Column:
    """Bucket of a value of the bracket; low and high never share one."""
    if math.isinf(low) or math.isinf(high):
        return F.when(value == F.lit(low), 0).when(value == F.lit(high), 2).otherwise(1)
    if by_magnitude and low <= 0.0 <= high:
        return F.when(value < 0, 0).when(value == 0, 1).otherwise(2)
    if by_magnitude:
        first, last = (math.log2(abs(x)) for x in (low, high))
        if first != last:
            place = (F.log2(F.abs(value)) - F.lit(first)) / F.lit(last - first) * BUCKETS
            # The library's logarithm may differ from Python's in the last digit at the ends.
            inner = F.greatest(F.least(F.floor(place), F.lit(BUCKETS - 1)), F.lit(0))
            return F.when(value == F.lit(low), 0).when(value == F.lit(high), BUCKETS - 1).otherwise(inner)
    half = 0.5 if math.isinf(high - low) else 1.0
    place = (value * F.lit(half) - F.lit(low * half)) / F.lit(high * half - low * half) * BUCKETS
    return F.least(F.floor(place), F.lit(BUCKETS - 1))


def _bracket_rows(df: DataFrame, spans: list[tuple[str, float, float, bool]], bucket: bool) -> DataFrame:
    """(span, value[, bucket]) rows of every span, from one scan."""
    entries = []
    for i, (column, low, high, by_magnitude) in enumerate(spans):
        value = present(column)
        inside = value.between(F.lit(low), F.lit(high))
        fields = [F.lit(i).alias("span"), F.when(inside, value).alias("v")]
        if bucket:
            fields.append(F.when(inside, _position(value, low, high, by_magnitude).cast("long")).alias("bucket"))
        entries.append(F.struct(*fields))
    return df.select(F.inline(F.array(*entries))).where(F.col("v").isNotNull())


def _at(counted: list[tuple[float, int]], rank: int) -> float:
    seen = 0
    for value, n in counted:
        seen += n
        if rank < seen:
            return value
    return counted[-1][0]


def _interpolate(low: float, high: float, fraction: float) -> float:
    if low == high or fraction == 0.0:
        return low
    if math.isinf(high - low) and not math.isinf(low) and not math.isinf(high):
        return low * (1 - fraction) + high * fraction
    return low + (high - low) * fraction


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], fetch_rows: int = FETCH_ROWS
) -> dict[str, dict[float, float | None]]:
    """Linearly interpolated quantiles, missing values left out; None for an empty column."""
    if not columns:
        return {}
    brackets: dict[tuple[str, float], _Bracket] = {}
    for c, stats in column_stats(df, columns).items():
        for p in probabilities if stats.present else ():
            place = p * (stats.present - 1)
            rank = math.floor(place)
            brackets[c, p] = _Bracket(c, rank, place - rank, stats.low, stats.high, stats.present)

    while True:
        for b in brackets.values():
            if b.value is None and b.low == b.high:
                b.value = b.low
        open_ = [b for b in brackets.values() if b.value is None]
        if not open_:
            break
        short = [b for b in open_ if b.rows <= fetch_rows]
        if short:
            _finish(df, short)
        wide = [b for b in open_ if b.value is None]
        if wide:
            _narrow(df, wide)

    return {
        c: {p: (brackets[c, p].value if (c, p) in brackets else None) for p in probabilities} for c in columns
    }


def _spans(brackets: list[_Bracket]) -> tuple[list[tuple[str, float, float, bool]], dict[tuple, int]]:
    spans = list(dict.fromkeys(b.span for b in brackets))
    return spans, {s: i for i, s in enumerate(spans)}


def _finish(df: DataFrame, brackets: list[_Bracket]) -> None:
    spans, index = _spans(brackets)
    counted: dict[int, list[tuple[float, int]]] = {}
    for row in _bracket_rows(df, spans, bucket=False).groupBy("span", "v").agg(F.count("*").alias("n")).collect():
        counted.setdefault(row["span"], []).append((row["v"], row["n"]))
    for values in counted.values():
        values.sort()
    for b in brackets:
        values = counted[index[b.span]]
        b.value = _interpolate(_at(values, b.rank), _at(values, b.rank + 1), b.fraction)


def _narrow(df: DataFrame, brackets: list[_Bracket]) -> None:
    spans, index = _spans(brackets)
    buckets: dict[int, list] = {}
    grouped = _bracket_rows(df, spans, bucket=True).groupBy("span", "bucket")
    for row in grouped.agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect():
        buckets.setdefault(row["span"], []).append(row)
    for rows in buckets.values():
        rows.sort(key=lambda r: r["bucket"])
    for b in brackets:
        rows = buckets[index[b.span]]
        before = 0
        for i, row in enumerate(rows):
            inside = b.rank - before
            if inside < row["n"]:
                break
            before += row["n"]
        if inside == row["n"] - 1:
            # The lower neighbour is the bucket's largest value, the upper one starts the next bucket.
            upper = rows[i + 1]["lo"] if i + 1 < len(rows) else row["hi"]
            b.value = _interpolate(row["hi"], upper, b.fraction)
        else:
            if row["n"] == b.rows:
                raise ArithmeticError(f"quantiles of {b.column}: no bucket of [{b.low}, {b.high}] leaves a row out")
            b.by_magnitude = b.by_magnitude or row["n"] > b.rows * 0.9
            b.rank, b.low, b.high, b.rows = inside, row["lo"], row["hi"], row["n"]
