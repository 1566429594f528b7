"""Gap groups on streams: sessions whose gap depends on each cue, with a watermark for late cues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as tx


def gap_sessions(cues: DataFrame, gap_ms: int = 5000, late: str = "1 minute") -> DataFrame:
    """Sessions (doc_id, first, last, cues) of a stream of speech cues with event time ``ts`` and start_ms, end_ms.

    The gap is the cue's own duration and ``gap_ms``, so a session breaks where silence is longer; a cue exactly
    at the threshold stays, as in batch: sessions that touch are merged.
    """
    speech = cues.filter(~tx.is_pure_marker(F.col("text"))).withWatermark("ts", late)
    reach = F.concat((F.col("end_ms") - F.col("start_ms") + gap_ms).cast("string"), F.lit(" milliseconds"))
    out = speech.groupBy("doc_id", F.session_window("ts", reach)).agg(F.min("start_ms").alias("first_ms"), F.max("end_ms").alias("last_ms"), F.count(F.lit(1)).alias("cues"))
    return out.drop("session_window")


def windowed_counts(events: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events of each type in tumbling windows."""
    w = events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.col("window.start").alias("start"), "event_type", "n")
