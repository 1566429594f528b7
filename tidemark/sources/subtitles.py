"""Subtitle and chunk files as rows, and back.

One parser with options takes the place of the many slightly different readers such tools grow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions import text as tx
from tidemark.functions import timing as tm

TIMES = r"^\s*(\d{2}:\d{2}:\d{2},\d{3})\s*-->\s*(\d{2}:\d{2}:\d{2},\d{3})"


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, value) of whole text files, a byte order mark taken off."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1).alias("doc_id"), F.regexp_replace("value", "^\\x{feff}", "").alias("value"))


def parse_srt(files: DataFrame, blocks: str = "blank", min_lines: int = 2, markers: str = "drop", body: str = "space") -> DataFrame:
    """Cues of subtitle files (doc_id, value).

    blocks: 'blank' parts at lines of white space, 'strict' at empty lines only. markers: 'drop' takes bracketed marks
    out and drops cues that had nothing else, 'blank' keeps them empty, 'keep' changes nothing. body: lines joined by
    'space' or 'pipe', or kept as an 'array'. Blocks without a number or times are dropped.
    """
    value = F.regexp_replace("value", r"\r\n?", "\n")
    sep = r"\n\s*\n" if blocks == "blank" else r"\n\n"
    rows = files.select("doc_id", F.posexplode(F.split(tx.strip(value), sep)).alias("pos", "block"))
    lines = F.split(F.regexp_replace("block", r"^\n+|\n+$", ""), "\n")
    rows = rows.withColumn("lines", lines).filter(F.size("lines") >= min_lines)
    number, times = F.trim(F.col("lines")[0]), F.col("lines")[1]
    rows = rows.filter(number.rlike(r"^\d+$") & times.rlike(TIMES))
    texts = F.slice("lines", F.lit(3), F.greatest(F.size("lines") - 2, F.lit(0)))
    joined = {"space": F.array_join(texts, " "), "pipe": F.array_join(texts, " | "), "array": F.array_join(texts, "\n")}[body]
    if markers == "drop":
        joined = tx.strip(tx.strip_brackets(joined))
    elif markers == "blank":
        joined = F.when(tx.is_pure_marker(joined), "").otherwise(joined)
    out = rows.select("doc_id", number.cast("bigint").alias("idx"), tm.parse_time(F.regexp_extract(times, TIMES, 1)).alias("start_ms"), tm.parse_time(F.regexp_extract(times, TIMES, 2)).alias("end_ms"), joined.alias("text"))
    if markers == "drop":
        out = out.filter("text <> ''")
    return out.withColumn("body", F.split("text", "\n")).drop("text") if body == "array" else out


def parse_lines(files: DataFrame) -> DataFrame:
    """Cue ids and times by a line scan: any line of digits opens a cue, and the last one opened holds what
    follows."""
    lines = files.select("doc_id", F.posexplode(F.split(F.regexp_replace("value", r"\r\n?", "\n"), "\n")).alias("pos", "line"))
    number = F.when(F.trim("line").rlike(r"^\d+$"), F.trim("line").cast("bigint"))
    lines = lines.withColumn("idx", F.last(number, ignorenulls=True).over(W.partitionBy("doc_id").orderBy("pos")))
    times = lines.filter(F.col("line").rlike(TIMES) & F.col("idx").isNotNull())
    return times.select("doc_id", "idx", tm.parse_time(F.regexp_extract("line", TIMES, 1)).alias("start_ms"), tm.parse_time(F.regexp_extract("line", TIMES, 2)).alias("end_ms"))


def render_srt(cues: DataFrame, renumber: bool = True) -> DataFrame:
    """(doc_id, value) of subtitle files: numbered blocks parted by an empty line."""
    order = W.partitionBy("doc_id").orderBy("start_ms", "idx")
    n = F.row_number().over(order) if renumber else F.col("idx")
    block = F.concat_ws("\n", n.cast("string"), F.concat(tm.format_time(F.col("start_ms")), F.lit(" --> "), tm.format_time(F.col("end_ms"))), F.col("text"))
    rows = cues.withColumn("__b", F.struct(F.row_number().over(order).alias("n"), block.alias("b")))
    return rows.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("__b")), lambda x: x["b"]), "\n\n").alias("value"))


def split_fields(files: DataFrame, fields: list[str]) -> DataFrame:
    """(doc_id, pos, lang, text): the lines of each block that has exactly one for each field."""
    rows = files.select("doc_id", F.posexplode(F.split(tx.strip(F.col("value")), r"\n\n")).alias("pos", "block")).withColumn("lines", F.split("block", "\n"))
    rows = rows.filter(F.size("lines") == len(fields))
    return rows.select("doc_id", "pos", F.explode(F.map_from_arrays(F.array(*[F.lit(f) for f in fields]), F.col("lines"))).alias("lang", "text"))


def parse_segments(files: DataFrame) -> DataFrame:
    """Rows ``seg|c<a>[~][-c<b>[~]]|text``; ~ marks an estimated boundary."""
    pattern = r"^(\d+)\|c(\d+)(~?)(?:-c(\d+)(~?))?\|(.*)$"
    lines = files.select("doc_id", F.explode(F.split("value", "\n")).alias("line")).filter(F.col("line").rlike(pattern))
    g = lambda i: F.regexp_extract("line", pattern, i)
    end = F.when(g(4) == "", g(2)).otherwise(g(4)).cast("bigint")
    end_est = F.when(g(4) == "", g(3)).otherwise(g(5)) == "~"
    return lines.select("doc_id", g(1).cast("bigint").alias("seg_no"), g(2).cast("bigint").alias("cue_start"), (g(3) == "~").alias("start_est"), end.alias("cue_end"), end_est.alias("end_est"), g(6).alias("text"))


def parse_chunks(files: DataFrame) -> DataFrame:
    """Chunk files (doc_id 'chunk_NNN') as (chunk_no, role, pos, idx, rest): lines ``c<id>\\t...`` of the sections
    BEFORE, OWNED and AFTER."""
    rows = files.filter(F.col("doc_id").rlike(r"chunk_\d{3}$")).select(F.regexp_extract("doc_id", r"(\d{3})$", 1).cast("bigint").alias("chunk_no"), F.posexplode(F.split("value", "\n")).alias("pos", "line"))
    head = F.when(F.startswith("line", F.lit("## ")), F.lower(F.regexp_extract("line", r"^## (\w+)", 1)))
    rows = rows.withColumn("role", F.last(head, ignorenulls=True).over(W.partitionBy("chunk_no").orderBy("pos")))
    cue = r"^c(\d+)\t(.*)$"
    return rows.filter(F.col("line").rlike(cue)).select("chunk_no", "role", "pos", F.regexp_extract("line", cue, 1).cast("bigint").alias("idx"), F.regexp_extract("line", cue, 2).alias("rest"))


def render_chunks(chunks: DataFrame) -> DataFrame:
    """(doc_id, chunk_no, value) of chunk files from the long chunk table."""
    rank = F.when(F.col("role") == "before", 0).when(F.col("role") == "owned", 1).otherwise(2)
    line = F.concat_ws("\t", F.concat(F.lit("c"), F.col("idx").cast("string")), tm.format_time(F.col("start_ms")), F.col("text"))
    rows = chunks.withColumn("__x", F.struct(rank.alias("rank"), "pos", line.alias("line"))).groupBy("doc_id", "chunk_no").agg(F.array_sort(F.collect_list("__x")).alias("x"))
    section = lambda i, name: F.concat_ws("\n", F.lit(f"## {name}"), F.array_join(F.transform(F.filter("x", lambda r: r["rank"] == i), lambda r: r["line"]), "\n"))
    return rows.select("doc_id", "chunk_no", F.concat_ws("\n\n", section(0, "BEFORE"), section(1, "OWNED"), section(2, "AFTER")).alias("value"))
