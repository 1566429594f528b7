"""Operators on word and character sequences: multisets, first divergence, segmentation, sentence quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions import packing as pk
from tidemark.functions import scans
from tidemark.functions import text as tx


def multiset_diff(a: DataFrame, b: DataFrame, key: list[str], item: str) -> DataFrame:
    """Items that one side has more often: (key..., item, missing, extra). One shuffle: counts are signed and
    added, instead of a full outer join."""
    both = a.select(*key, item, F.lit(1).alias("n")).unionAll(b.select(*key, item, F.lit(-1).alias("n")))
    out = both.groupBy(*key, item).agg(F.sum("n").alias("d")).filter("d <> 0")
    return out.select(*key, item, F.greatest("d", F.lit(0)).cast("bigint").alias("missing"), F.greatest(-F.col("d"), F.lit(0)).cast("bigint").alias("extra"))


def bag_diff(rows: DataFrame, key: list[str], a: str, b: str, item: str) -> DataFrame:
    """The same of two lists of one row: they are compared in the row, and only what differs is shuffled, to add up rows
    of one key."""
    changes = rows.select(*key, F.explode(scans.bag_changes(F.col(a), F.col(b))).alias("c")).select(*key, F.col("c.item").alias(item), F.col("c.d").alias("d"))
    out = changes.groupBy(*key, item).agg(F.sum("d").alias("d")).filter("d <> 0")
    return out.select(*key, item, F.greatest("d", F.lit(0)).cast("bigint").alias("missing"), F.greatest(-F.col("d"), F.lit(0)).cast("bigint").alias("extra"))


def first_divergence(pairs: DataFrame, key: list[str], a: str, b: str) -> DataFrame:
    """0-based place of the first different word of two texts in one row; null if they are equal."""
    x, y = tx.words(F.col(a)), tx.words(F.col(b))
    rows = pairs.select(*key, x.alias("x"), y.alias("y"))
    places = F.sequence(F.lit(1), F.greatest(F.size("x"), F.size("y"), F.lit(1)))
    differs = F.filter(places, lambda i: ~F.get("x", i - 1).eqNullSafe(F.get("y", i - 1)))
    at = F.when(F.size(differs) > 0, differs[0] - 1)
    return rows.select(*key, at.cast("bigint").alias("at"), F.get("x", at).alias("a_word"), F.get("y", at).alias("b_word"))


def bag_subset(pairs: DataFrame, key: list[str], part: str, whole: str) -> DataFrame:
    """Whether a shorter word list has only words of the other (allowed where border marks were taken out)."""
    x, y = tx.words(F.col(part)), tx.words(F.col(whole))
    return pairs.select(*key, ((F.size(x) < F.size(y)) & (F.size(F.array_except(x, y)) == 0)).alias("ok"))


def word_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    return texts.select(F.explode(tx.words(F.col(text))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def sentence_quality(sentences: DataFrame, max_comma: int = 10, max_sent: int = 600, max_avg: float = 350, soft_comma: int = 8, soft_sent: int = 250) -> DataFrame:
    """Per document: sentences, average and longest length, most commas, hard and soft findings."""
    n, commas = F.length("sentence"), tx.count_of(F.col("sentence"), ",")
    s = sentences.select("doc_id", n.alias("chars"), commas.alias("commas"))
    out = s.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("sentences"), F.sum("chars").alias("chars"), F.max("chars").cast("bigint").alias("longest"), F.max("commas").cast("bigint").alias("commas"),
        F.count_if((F.col("commas") > max_comma) | (F.col("chars") > max_sent)).alias("hard"), F.count_if((F.col("commas") >= soft_comma) & (F.col("chars") >= soft_sent)).alias("soft"),
    )
    return out.withColumn("sparse", F.col("chars") > max_avg * F.col("sentences"))


def presplit(texts: DataFrame, lang: str = "en", text: str = "text") -> DataFrame:
    """Numbered sentences of each text. English by expressions; Chinese depends on bracket depth and is a fold."""
    parts = tx.sentences_subtitle(F.col(text)) if lang == "en" else pk.split_zh_udf(F.col(text))
    return texts.select(*[c for c in texts.columns if c != text], F.posexplode(parts).alias("n", "sentence")).withColumn("n", F.col("n") + 1)


def plan_units(sentences: DataFrame, levels: tuple[str, ...] = ("，；：", "、", "—"), hard: float = 26, least: float = 5) -> DataFrame:
    """Display units of each sentence, with the plan's status: cut by marks level by level, then packed."""
    planned = sentences.withColumn("__plan", pk.plan_udf(levels, float(hard), float(least))("sentence"))
    return planned.select(*sentences.columns, F.col("__plan.units").alias("units"), F.col("__plan.status").alias("status"))


def render_plan(planned: DataFrame) -> DataFrame:
    """The plan as text rows: relation 1:1 or 1:n and a number for each unit. What is exploded is no bare column, as
    Spark would infer a filter on the size of that and plan all sentences twice."""
    n = F.size("units")
    relation = F.when(n <= 1, "1:1").otherwise(F.concat(F.lit("1:"), n.cast("string")))
    return planned.withColumn("relation", relation).select("*", F.posexplode(F.coalesce("units", F.array().cast("array<string>"))).alias("unit_no", "unit")).withColumn("unit_no", F.col("unit_no") + 1).drop("units")


def chunk_text(texts: DataFrame, unit: str = "sentence", max_chars: int = 6000, text: str = "text") -> DataFrame:
    """Texts in parts (doc_id, gid, part, piece): paragraphs, or sentences by paragraph; longer atoms are packed
    from their sentences, or sliced if they have one only. Parts count from 1 in each group."""
    blocks = F.filter(F.split(F.col(text), r"\n\s*\n"), lambda s: tx.strip(s) != "")
    rows = texts.select("doc_id", F.posexplode(blocks).alias("gid", "block"))
    chinese = F.col("block").rlike(f"[{tx.HAN}]")
    atoms = F.when(chinese, tx.sentences_zh(F.col("block"))).otherwise(tx.sentences_en(F.col("block"))) if unit == "sentence" else F.array(tx.collapse(F.col("block")))
    rows = rows.select("doc_id", "gid", F.posexplode(atoms).alias("atom_no", "atom"))
    long = F.when(F.length("atom") > max_chars, F.col("atom"))
    rows = rows.withColumn("sentences", F.when(F.col("atom").rlike(f"[{tx.HAN}]"), tx.sentences_zh(long)).otherwise(tx.sentences_en(long)))
    short = rows.filter(F.length("atom") <= max_chars).withColumn("pieces", F.array("atom"))
    single = rows.filter((F.length("atom") > max_chars) & (F.size("sentences") <= 1)).withColumn("pieces", tx.hard_slices(F.col("atom"), max_chars))
    several = rows.filter((F.length("atom") > max_chars) & (F.size("sentences") > 1)).withColumn("pieces", pk.greedy_pack("sentences", F.lit(max_chars)))
    out = short.unionByName(single).unionByName(several)
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("atom_no", "pieces"))), lambda x: x["pieces"])
    grouped = out.groupBy("doc_id", "gid").agg(F.flatten(pieces).alias("pieces"))
    return grouped.select("doc_id", "gid", F.posexplode("pieces").alias("part", "piece")).withColumn("part", F.col("part") + 1)


def merge_parts(parts: DataFrame) -> DataFrame:
    """Texts of groups again from their parts: joined without a space if the first part has Chinese, else with one;
    repeated parts keep the first, missing ones are listed."""
    first = parts.groupBy("doc_id", "gid", "part").agg(F.min_by("text", "seq").alias("text"), F.count(F.lit(1)).alias("copies"))
    rows = first.groupBy("doc_id", "gid").agg(F.array_sort(F.collect_list(F.struct("part", "text", "copies"))).alias("p"))
    sep = F.when(F.element_at("p", 1)["text"].rlike(f"[{tx.HAN}]"), F.lit("")).otherwise(F.lit(" "))
    have = F.transform("p", lambda x: x["part"].cast("int"))
    missing = F.array_except(F.sequence(F.lit(1), F.array_max(have)), have)
    return rows.select("doc_id", "gid", F.array_join(F.transform("p", lambda x: x["text"]), "\u0000").alias("__t"), sep.alias("__s"), F.array_join(missing, ",").alias("missing"), F.size(F.filter("p", lambda x: x["copies"] > 1)).cast("bigint").alias("repeated")).select("doc_id", "gid", F.replace("__t", F.lit("\u0000"), F.col("__s")).alias("text"), "missing", "repeated")


def merge_segments(segments: DataFrame) -> DataFrame:
    """Chunks' segments in one numbering with what is wrong at their seams; carried rows pass through unnumbered."""
    own = segments.filter("not carried")
    w = W.partitionBy("doc_id").orderBy("chunk_no", "seg_no")
    prev = F.lag("cue_end").over(w)
    rule = F.when(F.col("cue_start") < prev, "overlap").when(F.col("cue_start") > prev + 1, "gap")
    return own.select("doc_id", "chunk_no", "seg_no", F.row_number().over(w).cast("bigint").alias("number"), "cue_start", "cue_end", rule.alias("rule"))


def join_parts(parts: DataFrame, expected: DataFrame) -> DataFrame:
    """Chunks' cues in one numbering. A document with any chunk of another count than expected gives no rows."""
    n = parts.groupBy("doc_id", "chunk_no").agg(F.count(F.lit(1)).alias("n"))
    bad = expected.join(n, ["doc_id", "chunk_no"], "full_outer").filter(~F.col("n").eqNullSafe(F.col("expected"))).select("doc_id").distinct()
    w = W.partitionBy("doc_id").orderBy("chunk_no", "idx")
    return parts.join(bad, "doc_id", "left_anti").withColumn("number", F.row_number().over(w).cast("bigint"))


def build_plan(matches: DataFrame, z: DataFrame, e: DataFrame) -> DataFrame:
    """Matched groups (chunk_no, group_no) with the texts of their Z and E numbers in order, and what is missing:
    numbers that no text has, and texts on either side that no match names."""
    zs = matches.select("chunk_no", "group_no", F.posexplode("z").alias("at", "n")).join(z, ["chunk_no", "n"], "left")
    es = matches.select("chunk_no", "group_no", F.posexplode("e").alias("at", "n")).join(e, ["chunk_no", "n"], "left")
    text = lambda: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), " ")
    lost = lambda: F.array_join(F.array_sort(F.collect_list(F.when(F.col("text").isNull(), F.col("n")))), ",")
    a = zs.groupBy("chunk_no", "group_no").agg(text().alias("zh"), lost().alias("lost_z"))
    b = es.groupBy("chunk_no", "group_no").agg(text().alias("en"), lost().alias("lost_e"))
    return a.join(b, ["chunk_no", "group_no"], "full_outer")


def unmatched(matches: DataFrame, side: str, texts: DataFrame) -> DataFrame:
    """Texts that no match names."""
    named = matches.select("chunk_no", F.explode(side).alias("n")).distinct()
    return texts.join(named, ["chunk_no", "n"], "left_anti")
