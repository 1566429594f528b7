"""Writers. Spark writes partitioned folders; nothing is rewritten in place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.operators.glossary import split_categories
from tidemark.sources.subtitles import render_chunks, render_srt


def write_srt(cues: DataFrame, path: str) -> None:
    """One text for each document, parted by doc_id."""
    render_srt(cues).write.mode("overwrite").partitionBy("doc_id").text(path)


def write_jsonl(rows: DataFrame, path: str) -> None:
    """One JSON object a line, non-ASCII as it is."""
    rows.write.mode("overwrite").json(path)


def write_chunks(chunks: DataFrame, path: str) -> None:
    render_chunks(chunks).write.mode("overwrite").partitionBy("doc_id", "chunk_no").text(path)


def write_categories(glossary: DataFrame, path: str, column: str = "category") -> None:
    """A CSV folder for each category; the column itself goes into the folder's name."""
    rows = split_categories(glossary, column).withColumn(column, F.translate(column, "/\\", "__"))
    rows.write.mode("overwrite").option("header", True).partitionBy(column).csv(path)


def write_languages(pivoted: DataFrame, path: str) -> None:
    """A CSV folder for each category, keys sorted, '' for what is missing."""
    pivoted.repartitionByRange("category", "key").sortWithinPartitions("category", "key").write.mode("overwrite").option("header", True).option("emptyValue", "").partitionBy("category").csv(path)


def write_by_language(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").partitionBy("lang").json(path)


def page_markdown(pages: DataFrame) -> DataFrame:
    """(name, value) of pages with front matter; names are safe for file systems."""
    head = F.concat_ws("\n", F.lit("---"), F.concat(F.lit("title: "), "title"), F.concat(F.lit("url: "), "url"), F.concat(F.lit("fetched: "), F.date_format("fetched", "yyyy-MM-dd'T'HH:mm:ss'Z'")), F.concat(F.lit("via: "), "via"), F.concat(F.lit("fidelity: "), "fidelity"), F.lit("---"))
    return pages.select(tx.safe_name(F.col("title")).alias("name"), F.concat(head, F.lit("\n\n"), F.col("body")).alias("value"))


def gap_markdown(gaps: DataFrame) -> DataFrame:
    """A markdown row for each gap of a report."""
    from tidemark.functions.timing import seconds_1

    return gaps.select("doc_id", "rank", F.format_string("| %d | c%d | c%d | %s s | %s |", "rank", "ia", "ib", seconds_1(F.col("gap_ms")), F.when(F.col("is_jump"), "jump").otherwise("")).alias("value"))


def bom_csv(df: DataFrame) -> DataFrame:
    """The CSV lines of a small report, the first with a byte order mark."""
    return df.select(F.concat(F.lit("﻿"), F.concat_ws(",", *df.columns)).alias("value"))
