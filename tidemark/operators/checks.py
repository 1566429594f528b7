"""Composite checks of a translation run; each gives rows of findings instead of a report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions import text as tx
from tidemark.functions import timing as tm


def wording(source: DataFrame, result: DataFrame) -> DataFrame:
    """Whether each chunk's words are kept by its result: 'same', 'subset' (only where border marks were taken
    out), 'differs' with the first different word, or 'missing'. Inputs are (doc_id, chunk_no, text)."""
    r = result.select("doc_id", "chunk_no", F.col("text").alias("raw"))
    both = source.join(r, ["doc_id", "chunk_no"], "left")
    x, y = tx.words(F.col("text")), tx.words(tx.strip_stitch_marks(F.coalesce("raw", F.lit(""))))
    both = both.withColumn("x", x).withColumn("y", y).withColumn("marked", F.size(tx.residual_marks(F.coalesce("raw", F.lit("")))) > 0)
    places = F.sequence(F.lit(1), F.greatest(F.size("x"), F.size("y"), F.lit(1)))
    first = F.filter(places, lambda i: ~F.get("x", i - 1).eqNullSafe(F.get("y", i - 1)))[0]
    same, subset = F.col("x") == F.col("y"), F.col("marked") & (F.size("y") < F.size("x")) & (F.size(F.array_except("y", "x")) == 0)
    status = F.when(F.col("raw").isNull(), "missing").when(same, "same").when(subset, "subset").otherwise("differs")
    out = both.withColumn("status", status).withColumn("at", F.when(F.col("status") == "differs", first - 1).cast("bigint"))
    return out.select("doc_id", "chunk_no", "status", "at", F.get("x", F.col("at").cast("int")).alias("word"), F.get("y", F.col("at").cast("int")).alias("instead"))


def durations(cues: DataFrame, units: DataFrame, speed: float = 5.0, min_ms: int = 1000, ratio: float = 0.7, gap_ms: int = 300) -> DataFrame:
    """Units (doc_id, seq, unit_no, zh) on cues by order that are fragments of a longer sentence, short sentences, or
    too short to read; a document of unequal counts gives the one row 'count'."""
    order = W.partitionBy("doc_id").orderBy("start_ms", "idx")
    c = cues.withColumn("place", F.row_number().over(order)).select("doc_id", "place", (F.col("end_ms") - F.col("start_ms")).alias("d"), "text")
    per = W.partitionBy("doc_id", "seq")
    u = units.withColumn("place", F.row_number().over(W.partitionBy("doc_id").orderBy("seq", "unit_no"))).withColumn("n", F.count(F.lit(1)).over(per)).select("doc_id", "place", "seq", "unit_no", "n")
    counts = c.groupBy("doc_id").agg(F.count(F.lit(1)).alias("a")).join(u.groupBy("doc_id").agg(F.count(F.lit(1)).alias("b")), "doc_id", "full_outer").filter(~F.col("a").eqNullSafe(F.col("b")))
    need = tm.reading_ms(F.col("text"), speed)
    short = F.when(F.col("d") < min_ms, F.when(F.col("n") >= 2, "fragment").otherwise("short sentence"))
    slow = F.when((need > 0) & (F.col("d") < need * F.lit(ratio)) & (need * F.lit(ratio) - F.col("d") >= gap_ms), F.lit("mismatch"))
    rows = c.join(u, ["doc_id", "place"]).join(counts, "doc_id", "left_anti")
    rows = rows.select("doc_id", "seq", "unit_no", "d", F.explode(F.filter(F.array(short, slow), lambda x: x.isNotNull())).alias("rule"))
    return rows.unionByName(counts.select("doc_id", F.lit(None).cast("bigint").alias("seq"), F.lit(None).cast("bigint").alias("unit_no"), F.lit(None).cast("bigint").alias("d"), F.lit("count").alias("rule")))


def widths(cues: DataFrame, order: str = "en-zh", soft: float = 22, hard: float = 26) -> DataFrame:
    """Cues (doc_id, idx, body) whose translated line is too wide; the line is the last one, or the first if the
    translation comes first."""
    line = F.element_at("body", 1 if order.startswith("zh") else -1)
    out = cues.filter(F.size("body") > 0).withColumn("width", tx.text_width(line)).withColumn("flag", tx.width_flag(F.col("width"), soft, hard))
    return out.filter("flag <> 'ok'").select("doc_id", "idx", "width", "flag")


def summary(findings: DataFrame, column: str = "status") -> DataFrame:
    """Counts of each outcome."""
    return findings.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def ends(parts: DataFrame, column: str, n: int = 3) -> DataFrame:
    """The first and last ``n`` elements of an array column, for showing a bad block."""
    return parts.withColumn("head", F.slice(column, 1, n)).withColumn("tail", F.slice(column, -F.least(F.size(column), F.lit(n)), F.lit(n)))
