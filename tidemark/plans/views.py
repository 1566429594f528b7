"""Derived views over the test tables, once as DataFrames and once as DuckDB SQL.

The tables hold no subtitles, so cue streams, sentences and glossaries are derived from conversations,
documents and parts by fixed rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions import scans
from tidemark.functions import text as tx


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cue for each turn: 60 ms a character, gaps of 200, 6000 or 12000 ms, some turns a mark only."""
    conv, turn = F.col("conv_id"), F.col("turn")
    gap = F.when(turn == 0, 0).when((conv * 7 + turn * 13) % 5 == 0, 6000).when((conv * 7 + turn * 13) % 11 == 0, 12000).otherwise(200).cast("bigint")
    g = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when((conv * 3 + turn) % 9 == 4, "[Music]").otherwise(F.col("text")).alias("text"), (60 * F.length("text")).cast("bigint").alias("dur"), gap.alias("gap"))
    w = W.partitionBy("conv_id").orderBy("turn")
    start = F.sum("gap").over(w.rowsBetween(W.unboundedPreceding, 0)) + F.coalesce(F.sum("dur").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    c = g.withColumn("start_ms", start.cast("bigint"))
    return c.select(conv.alias("doc_id"), (turn + 1).cast("bigint").alias("idx"), "start_ms", (F.col("start_ms") + F.col("dur")).alias("end_ms"), "text")


CUES = """g as (select conv_id, turn, case when (conv_id*3+turn)%9=4 then '[Music]' else text end as text, cast(60*length(text) as bigint) dur,
    cast(case when turn=0 then 0 when (conv_id*7+turn*13)%5=0 then 6000 when (conv_id*7+turn*13)%11=0 then 12000 else 200 end as bigint) gap from conversations),
cues as (select conv_id doc_id, cast(turn+1 as bigint) idx, start_ms, start_ms+dur end_ms, text from (select *,
    cast(sum(gap) over (partition by conv_id order by turn rows between unbounded preceding and current row)
    + coalesce(sum(dur) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding),0) as bigint) start_ms from g))"""

WS = r"[\s]"
#: Python's and Java's Unicode white space as far as the tables go: ASCII white space and the no-break space.
SQL_COLLAPSE = r"trim(regexp_replace({c}, '\s+', ' ', 'g'))"


def doc_cues(spark: SparkSession, sf_dir: str, size: int = 8) -> DataFrame:
    """Documents in cues of ``size`` words."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(scans.word_lines(F.coalesce("text", F.lit("")), F.lit(size))).alias("pos", "text"))
    return d.select("doc_id", (F.col("pos") + 1).cast("bigint").alias("idx"), "text")


DOC_CUES = r"""dw as (select doc_id, list_filter(regexp_split_to_array(coalesce(text,''), '\s+'), lambda x: x <> '') w from documents),
doc_cues as (select doc_id, cast(i + 1 as bigint) idx, array_to_string(list_slice(w, i*8+1, i*8+8), ' ') as text from (select doc_id, w, unnest(range(cast(ceil(len(w)/8.0) as bigint))) i from dw))"""


def doc_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Of an array that is a column, Spark would infer a filter on its size and make it twice.
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(tx.sentences_en(F.coalesce("text", F.lit("")))).alias("pos", "sentence"))
    return d.select("doc_id", (F.col("pos") + 1).cast("bigint").alias("seq"), "sentence")


DOC_SENTENCES = r"""ds as (select doc_id, list_filter(list_transform(string_split(regexp_replace(trim(regexp_replace(coalesce(text,''), '\s+', ' ', 'g')), '([.!?]+)( |$)', '\1' || chr(10), 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> '') s from documents),
doc_sentences as (select doc_id, cast(i as bigint) seq, s[i] sentence from (select doc_id, s, unnest(range(1, len(s)+1)) i from ds))"""


def glossary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a glossary of three levels: every cell an alias and a synonym."""
    p = table(spark, sf_dir, "part")
    brand = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    level = F.when(brand % 3 == 0, "L1").when(brand % 3 == 1, "L1.5").otherwise("L2")
    cell = F.concat(F.col("p_name"), F.lit(" (aka "), F.substring_index("p_name", " ", 1), F.lit(" item); "), F.col("p_name"), F.lit("*"))
    return p.select(level.alias("level"), F.concat(F.lit("src"), (brand % 5).cast("string")).alias("path"), (brand % 5).cast("int").alias("source_order"), F.col("p_partkey").alias("row_no"), cell.alias("term_en"), F.substring("p_brand", 7, 4).alias("short_form"), F.col("p_type").alias("term_zh"))


GLOSSARY = r"""glossary as (select case when b % 3 = 0 then 'L1' when b % 3 = 1 then 'L1.5' else 'L2' end as level, 'src' || cast(b % 5 as varchar) path, cast(b % 5 as int) source_order, p_partkey row_no,
    p_name || ' (aka ' || string_split(p_name, ' ')[1] || ' item); ' || p_name || '*' term_en, substr(p_brand, 7, 4) short_form, p_type term_zh from (select *, cast(regexp_extract(p_brand, '(\d+)', 1) as int) b from part))"""
