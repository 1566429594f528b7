"""Readers of the line formats of the translation plan, as forward fills over lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions import text as tx


def _lines(files: DataFrame) -> DataFrame:
    return files.select("doc_id", F.posexplode(F.split(F.regexp_replace("value", r"\r\n?", "\n"), "\n")).alias("pos", "line"))


def parse_plan(files: DataFrame) -> DataFrame:
    """Sentences of a plan: ``## S<n>[+<n>...]`` with EN, ZH and relation lines, and ``### S<n><letters>`` units.

    A sentence without units is its own unit. ``problem`` names what is missing instead of raising.
    """
    by_line = W.partitionBy("doc_id").orderBy("pos")
    rows = _lines(files)
    head = F.when(F.col("line").rlike(r"^## S\d+(\+\d+)*\s*$"), F.regexp_extract("line", r"^## S([\d+]+)", 1))
    unit = F.when(F.col("line").rlike(r"^### S[\d+]+[a-z]+\s*$"), F.regexp_extract("line", r"^### S[\d+]+([a-z]+)", 1))
    rows = rows.withColumn("group", F.count(head).over(by_line)).withColumn("numbers", F.last(head, ignorenulls=True).over(by_line)).filter("group > 0")
    in_group = W.partitionBy("doc_id", "group").orderBy("pos")
    rows = rows.withColumn("unit_no", F.count(unit).over(in_group).cast("int"))
    field = F.regexp_extract("line", r"^- (EN|ZH|关系)[:：]\s*(.*)$", 1)
    rows = rows.withColumn("field", field).withColumn("text", F.regexp_extract("line", r"^- (EN|ZH|关系)[:：]\s*(.*)$", 2)).filter("field <> ''")
    pick = lambda f: F.min_by(F.when(F.col("field") == f, F.col("text")), F.when(F.col("field") == f, F.col("pos")))
    parts = rows.groupBy("doc_id", "group", "numbers", "unit_no").agg(pick("EN").alias("en"), pick("ZH").alias("zh"), pick("关系").alias("rel"), F.min("pos").alias("at"))
    own = F.max_by(F.struct("en", "zh", "rel"), F.when(F.col("unit_no") == 0, 1))
    units = F.array_sort(F.collect_list(F.when(F.col("unit_no") > 0, F.struct("unit_no", "en", "zh"))))
    out = parts.groupBy("doc_id", "group", "numbers").agg(own.alias("s"), units.alias("units"), F.min("at").alias("line"))
    units = F.when(F.size("units") > 0, F.col("units")).otherwise(F.array(F.struct(F.lit(1).alias("unit_no"), F.col("s.en").alias("en"), F.col("s.zh").alias("zh"))))
    problem = F.when(F.col("s.en").isNull(), "no EN").when(F.col("s.rel").isNull(), "no relation").when(F.exists("units", lambda u: u["en"].isNull() | u["zh"].isNull()), "unit without EN or ZH")
    return out.select("doc_id", F.col("group").cast("int").alias("seq"), F.transform(F.split("numbers", r"\+"), lambda x: x.cast("int")).alias("numbers"), F.col("s.en").alias("en"), F.col("s.zh").alias("zh"), F.col("s.rel").alias("rel"), units.alias("units"), (F.col("line") + 1).alias("line"), problem.alias("problem"))


def join_plans(plans: DataFrame) -> DataFrame:
    """Plans of chunks (doc_id, chunk_no, seq, numbers, en, ...) as one: every number of a key is shifted by the sum
    of the earlier chunks' largest, and of sentences with one normalised English the first stays."""
    top = plans.groupBy("doc_id", "chunk_no").agg(F.max(F.array_max("numbers")).alias("top"))
    w = W.partitionBy("doc_id").orderBy("chunk_no").rowsBetween(W.unboundedPreceding, -1)
    shift = top.select("doc_id", "chunk_no", F.coalesce(F.sum("top").over(w), F.lit(0)).cast("int").alias("shift"))
    rows = plans.join(shift, ["doc_id", "chunk_no"]).withColumn("numbers", F.expr("transform(numbers, x -> x + shift)")).drop("shift")
    first = W.partitionBy("doc_id", tx.norm(F.col("en"))).orderBy("chunk_no", "seq")
    return rows.withColumn("__rn", F.row_number().over(first)).filter("__rn = 1").drop("__rn")


def parse_numbered(files: DataFrame, prefix: str = "E") -> DataFrame:
    """``- E<n>: text`` lines; a line without a number goes on the one before, without a space."""
    rows = _lines(files)
    pattern = rf"^- {prefix}(\d+): ?(.*)$"
    number = F.when(F.col("line").rlike(pattern), F.regexp_extract("line", pattern, 1).cast("bigint"))
    rows = rows.filter(~F.startswith("line", F.lit("#"))).withColumn("n", F.last(number, ignorenulls=True).over(W.partitionBy("doc_id").orderBy("pos"))).filter("n is not null")
    piece = F.when(F.col("line").rlike(pattern), F.regexp_extract("line", pattern, 2)).otherwise(F.col("line"))
    return rows.groupBy("doc_id", "n").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", piece.alias("t")))), lambda x: x["t"]), "").alias("text"))


def parse_matches(files: DataFrame) -> DataFrame:
    """``Z5+Z6 = E5`` lines as number lists; other lines that are not comments or empty are problems."""
    rows = _lines(files).filter((F.trim("line") != "") & ~F.startswith("line", F.lit("#")))
    good = F.col("line").rlike(r"^\s*Z\d+(\s*\+\s*Z\d+)*\s*=\s*E\d+(\s*\+\s*E\d+)*\s*$")
    numbers = lambda c: F.transform(F.regexp_extract_all("line", F.lit(rf"{c}(\d+)"), 1), lambda x: x.cast("int"))
    return rows.select("doc_id", (F.col("pos") + 1).alias("line_no"), F.when(good, numbers("Z")).alias("z"), F.when(good, numbers("E")).alias("e"), F.when(~good, F.col("line")).alias("problem"))


def parse_table(files: DataFrame, names: dict[str, list[str]]) -> DataFrame:
    """Rows of markdown tables by header names; a line that is no table row ends the table."""
    rows = _lines(files)
    is_row = F.startswith(F.trim("line"), F.lit("|"))
    by_line = W.partitionBy("doc_id").orderBy("pos")
    rows = rows.withColumn("table", F.sum(F.when(~is_row, 1).otherwise(0)).over(by_line)).filter(is_row)
    cells = F.transform(F.split(F.regexp_replace(F.trim("line"), r"^\||\|$", ""), r"\|"), tx.strip)
    rows = rows.withColumn("cells", cells).withColumn("head", F.first("cells").over(W.partitionBy("doc_id", "table").orderBy("pos"))).withColumn("n", F.row_number().over(W.partitionBy("doc_id", "table").orderBy("pos")))
    rows = rows.filter((F.col("n") > 1) & ~F.forall("cells", lambda c: c.rlike("^:?-*:?$")))

    def column(wanted: list[str]) -> F.Column:
        at = F.coalesce(*[F.nullif(F.array_position(F.transform("head", F.lower), w.lower()), F.lit(0)) for w in wanted])
        return F.get("cells", (at - 1).cast("int"))

    return rows.select("doc_id", (F.col("pos") + 1).alias("line"), *[column(v).alias(k) for k, v in names.items()])


def parse_section(files: DataFrame, title: str) -> DataFrame:
    """Lines of one markdown section, as (doc_id, pos, line)."""
    rows = _lines(files)
    head = F.when(F.startswith("line", F.lit("#")), F.trim(F.regexp_replace("line", "^#+", "")))
    rows = rows.withColumn("title", F.last(head, ignorenulls=True).over(W.partitionBy("doc_id").orderBy("pos")))
    return rows.filter((F.col("title") == title) & ~F.startswith("line", F.lit("#"))).select("doc_id", "pos", "line")


def parse_front_matter(files: DataFrame) -> DataFrame:
    """(doc_id, meta map, body) of pages that open with a --- block."""
    pattern = r"(?s)^---\n(.*?)\n---\n?(.*)$"
    meta = F.regexp_extract("value", pattern, 1)
    pairs = F.filter(F.transform(F.split(meta, "\n"), lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("k"), F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("v"))), lambda x: x["k"] != "")
    has = F.col("value").rlike(pattern)
    return files.select("doc_id", F.when(has, F.map_from_entries(F.array_distinct(pairs))).alias("meta"), F.when(has, F.regexp_extract("value", pattern, 2)).otherwise(F.col("value")).alias("body"))


def parse_template(files: DataFrame) -> DataFrame:
    """Blocks ``## ..Z<n>`` of a template with their ZH line and the ZH lines of their ``###`` parts in order; a block
    without parts has its own text as its one part."""
    rows = _lines(files)
    by_line = W.partitionBy("doc_id").orderBy("pos")
    head = F.when(F.col("line").rlike(r"^## .*Z\d+"), F.regexp_extract("line", r"Z(\d+)", 1).cast("bigint"))
    rows = rows.withColumn("z", F.last(head, ignorenulls=True).over(by_line)).withColumn("block", F.count(head).over(by_line)).filter("block > 0")
    rows = rows.withColumn("part", F.count(F.when(F.startswith("line", F.lit("### ")), 1)).over(W.partitionBy("doc_id", "block").orderBy("pos")))
    zh = rows.filter(F.col("line").rlike(r"^- ZH:")).withColumn("text", F.regexp_extract("line", r"^- ZH:\s?(.*)$", 1))
    parts = F.transform(F.array_sort(F.collect_list(F.when(F.col("part") > 0, F.struct("part", "text")))), lambda x: x["text"])
    out = zh.groupBy("doc_id", "block", "z").agg(F.min_by(F.when(F.col("part") == 0, F.col("text")), F.when(F.col("part") == 0, F.col("pos"))).alias("text"), parts.alias("parts"))
    return out.select("doc_id", "z", "text", F.when(F.size("parts") > 0, F.col("parts")).when(F.col("text").isNotNull(), F.array("text")).otherwise(F.col("parts")).alias("parts"))


def parse_gap_report(files: DataFrame) -> DataFrame:
    """Gaps of a report, in ms from seconds with one decimal (so rounded; tables keep ms)."""
    pattern = r"^###?\s*\d+\.\s*c(\d+)\s*→\s*c(\d+)\s*（([\d.]+)s）"
    rows = _lines(files).filter(F.col("line").rlike(pattern))
    g = lambda i: F.regexp_extract("line", pattern, i)
    return rows.select("doc_id", g(1).cast("bigint").alias("ia"), g(2).cast("bigint").alias("ib"), (g(3).cast("double") * 1000).cast("bigint").alias("gap_ms"))


def kind_of(files: DataFrame) -> DataFrame:
    """'srt', 'segments' or 'text' of each file, by its first 4096 characters."""
    head = F.left("value", F.lit(4096))
    return files.select("doc_id", F.when(head.rlike(r"\d{2}:\d{2}:\d{2},\d{3}\s*-->"), "srt").when(head.rlike(r"(?m)^\d+\|c\d+"), "segments").otherwise("text").alias("kind"))


def positional_terms(df: DataFrame, en: int = 2, zh: int = 7, least: int = 8) -> DataFrame:
    """(en, zh) of a CSV by column places; a table of fewer columns has none."""
    if len(df.columns) < least:
        return df.sparkSession.createDataFrame([], "en string, zh string")
    return df.select(F.col(f"`{df.columns[en]}`").alias("en"), F.col(f"`{df.columns[zh]}`").alias("zh"))
