"""Time and size functions on columns. Times are milliseconds in BIGINT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import text_width

STAMP = r"^(\d{2}):(\d{2}):(\d{2}),(\d{3})"


def parse_time(c: Column) -> Column:
    """HH:MM:SS,mmm to ms; null for anything else. Hours may exceed 23."""
    part = lambda i: F.try_to_number(F.regexp_extract(F.trim(c), STAMP, i), F.lit("999")).cast("bigint")
    return F.when(F.trim(c).rlike(STAMP), part(1) * 3600000 + part(2) * 60000 + part(3) * 1000 + part(4))


def format_time(ms: Column, clamp: bool = True) -> Column:
    """ms to HH:MM:SS,mmm; negative times are 0 unless ``clamp`` is off."""
    t = F.greatest(F.lit(0).cast("bigint"), ms.cast("bigint")) if clamp else ms.cast("bigint")
    floor = lambda x, n: F.floor(x / n).cast("bigint")
    return F.format_string("%02d:%02d:%02d,%03d", floor(t, 3600000), floor(F.pmod(t, F.lit(3600000)), 60000), floor(F.pmod(t, F.lit(60000)), 1000), F.pmod(t, F.lit(1000)))


def reading_ms(c: Column, speed: float = 5.0) -> Column:
    """Time to read a text at ``speed`` full widths a second; 0 if speed is not positive."""
    return F.lit(0).cast("bigint") if speed <= 0 else (text_width(c) * F.lit(1000.0) / F.lit(float(speed))).cast("bigint")


def round_100(ms: Column) -> Column:
    """To whole 100 ms, halves to even."""
    return (F.bround(ms.cast("double") / 100, 0) * 100).cast("bigint")


def split_point(start: Column, end: Column, a: Column, b: Column) -> Column:
    """Where a cue shared by two neighbours is cut, by their characters in it; its end if either has none."""
    return F.when((a > 0) & (b > 0), (start + (end - start) * a / (a + b)).cast("bigint")).otherwise(end)


def needs_interpolation(duration: Column, need: Column, ratio: float = 0.7, least_ms: int = 1000, gap_ms: int = 300) -> Column:
    """A fragment, or clearly too short to read."""
    short = need * F.lit(ratio)
    return (duration < least_ms) | ((need > 0) & (duration < short) & (short - duration >= gap_ms))


def duration_class(duration: Column, median: Column, units: Column) -> Column:
    return F.when(duration > F.greatest(F.lit(15000), 2 * median), "overlong").when(duration < 300, "very short").when((duration < 1000) & (units >= 2), "fragment").when(duration < 1000, "short sentence").otherwise("ok")


def token_estimate(visible: Column) -> Column:
    """Tokens of so many characters that are not white space."""
    return (visible / F.lit(1.5)).cast("bigint")


def capacity(window: int = 1_000_000, split_ratio: float = 0.05, max_output: int = 8192, output_ratio: float = 0.8, amplification: float | None = 5) -> int:
    """Tokens that one chunk may take in: the input budget, or the output budget over the amplification."""
    taken, given = int(window * split_ratio), int(max_output * output_ratio)
    return min(taken, int(given / amplification) if amplification else given)


def owned_cues(cap: Column, average: Column) -> Column:
    """Cues for one chunk of capacity ``cap`` at ``average`` characters a cue; 50 if less than one."""
    n = (cap * F.lit(1.5) / average).cast("bigint")
    return F.when(n < 1, F.lit(50).cast("bigint")).otherwise(n)


def seconds_1(ms: Column) -> Column:
    """Seconds with one decimal, for display only; keep ms for computing."""
    return F.format_string("%.1f", ms / F.lit(1000.0))
