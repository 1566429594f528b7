"""Operators on cue streams (doc_id, idx, start_ms, end_ms, text): gaps, groups, chunks, checks.

Every operator is keyed by doc_id; windows partition by it, and range joins carry it as an equi key, so a corpus
scales out by documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions import text as tx
from tidemark.functions import timing as tm

def by_time():
    """The order of time in each document."""
    return W.partitionBy("doc_id").orderBy("start_ms", "idx")


def speech_gaps(cues: DataFrame, gap_ms: int = 5000, jump_ms: int = 10000) -> DataFrame:
    """(doc_id, ia, ib, gap_ms, is_jump) between neighbouring speech cues more than ``gap_ms`` apart; cues of
    marks only are passed over."""
    speech = cues.filter(~tx.is_pure_marker(F.col("text")))
    gap = F.lead("start_ms").over(by_time()) - F.col("end_ms")
    out = speech.select("doc_id", F.col("idx").alias("ia"), F.lead("idx").over(by_time()).alias("ib"), gap.alias("gap_ms"))
    return out.filter(F.col("gap_ms") > gap_ms).withColumn("is_jump", F.col("gap_ms") > jump_ms)


def gap_report(cues: DataFrame, gap_ms: int = 5000, jump_ms: int = 10000) -> DataFrame:
    """Gaps ranked by length within their document; ties keep the order of time. With both texts, and the words
    on either side that stand alone (at most two) as a hint."""
    gaps = speech_gaps(cues, gap_ms, jump_ms)
    gaps = gaps.withColumn("rank", F.row_number().over(W.partitionBy("doc_id").orderBy(F.desc("gap_ms"), "ia")))
    side = cues.select("doc_id", "idx", "text")
    gaps = gaps.join(side.withColumnsRenamed({"idx": "ia", "text": "a_text"}), ["doc_id", "ia"]).join(side.withColumnsRenamed({"idx": "ib", "text": "b_text"}), ["doc_id", "ib"])
    stray = (F.size(tx.words(F.col("a_text"))) <= 2) | (F.size(tx.words(F.col("b_text"))) <= 2)
    return gaps.select("doc_id", "rank", "ia", "ib", "gap_ms", "is_jump", tx.clip(F.col("a_text"), 30).alias("a_text"), tx.clip(F.col("b_text"), 30).alias("b_text"), stray.alias("stray"))


def gap_groups(cues: DataFrame, gap_ms: int = 5000) -> DataFrame:
    """Cues with ``group_id`` (0-based): a group begins at the speech cue after a gap, so marks inside a gap stay
    with the earlier group."""
    marker = tx.is_pure_marker(F.col("text"))
    before = W.partitionBy("doc_id").orderBy("start_ms", "idx").rowsBetween(W.unboundedPreceding, -1)
    last_end = F.last(F.when(~marker, F.col("end_ms")), ignorenulls=True).over(before)
    flag = F.when(~marker & (F.col("start_ms") - last_end > gap_ms), 1).otherwise(0)
    return cues.withColumn("__new", flag).withColumn("group_id", F.sum("__new").over(by_time()).cast("bigint")).drop("__new")


def sessionize(events: DataFrame, key: str, ts: str, gap_ms: int) -> DataFrame:
    """``session_id`` (0-based) of events by inactivity of more than ``gap_ms``."""
    w = W.partitionBy(key).orderBy(ts)
    ms = F.unix_millis(F.col(ts).cast("timestamp"))
    apart = ms - F.lag(ms).over(w)
    return events.withColumn("__new", F.when(apart > gap_ms, 1).otherwise(0)).withColumn("session_id", F.sum("__new").over(w.rangeBetween(W.unboundedPreceding, 0)).cast("bigint")).drop("__new")


def number_chunks(cues: DataFrame, owned: int = 100, gap_ms: int | None = None) -> DataFrame:
    """Cues with pos (0-based) and chunk_no (1-based): every ``owned`` cues, within gap groups if ``gap_ms``."""
    cues = gap_groups(cues, gap_ms) if gap_ms is not None else cues.withColumn("group_id", F.lit(0).cast("bigint"))
    within = W.partitionBy("doc_id", "group_id").orderBy("start_ms", "idx")
    cues = cues.withColumn("pos", (F.row_number().over(by_time()) - 1).cast("bigint")).withColumn("piece", F.floor((F.row_number().over(within) - 1) / owned))
    head = F.when(F.lag("group_id").over(by_time()).eqNullSafe(F.col("group_id")) & F.lag("piece").over(by_time()).eqNullSafe(F.col("piece")), 0).otherwise(1)
    return cues.withColumn("__head", head).withColumn("chunk_no", F.sum("__head").over(by_time()).cast("bigint")).drop("__head", "piece")


def chunk(cues: DataFrame, owned: int = 100, ctx: int = 6, gap_ms: int | None = None) -> DataFrame:
    """The long chunk table (doc_id, chunk_no, role, pos, idx, ...): owned cues, and ``ctx`` cues of context before
    and after, across groups.

    Context needs no range join: a cue belongs to the context of the chunks of its ``ctx`` neighbours on either
    side, which a window gives.
    """
    numbered = number_chunks(cues, owned, gap_ms)
    own = numbered.withColumn("role", F.lit("owned"))
    if ctx <= 0:
        return own
    lo, hi = W.partitionBy("doc_id").orderBy("pos").rowsBetween(-ctx, -1), W.partitionBy("doc_id").orderBy("pos").rowsBetween(1, ctx)
    near = numbered.withColumn("__b", F.array_distinct(F.collect_list("chunk_no").over(hi))).withColumn("__a", F.array_distinct(F.collect_list("chunk_no").over(lo)))

    def side(name: str, role: str) -> DataFrame:
        other = F.filter(F.col(name), lambda k: k != F.col("chunk_no"))
        return near.withColumn("__k", F.explode(other)).withColumn("chunk_no", F.col("__k")).drop("__k", "__a", "__b").withColumn("role", F.lit(role))

    return own.unionByName(side("__b", "before")).unionByName(side("__a", "after"))


def manifest(chunks: DataFrame) -> DataFrame:
    """A row for each chunk: first and last owned cue, cues owned, groups in order."""
    own = chunks.filter("role = 'owned'")
    groups = F.array_join(F.array_sort(F.collect_set("group_id")), ",")
    return own.groupBy("doc_id", "chunk_no").agg(F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"), F.count(F.lit(1)).alias("n"), groups.alias("groups"))


def owned_range(chunks: DataFrame) -> DataFrame:
    """(doc_id, chunk_no, cue_min, cue_max) of the owned cues."""
    return chunks.filter("role = 'owned'").groupBy("doc_id", "chunk_no").agg(F.min("idx").alias("cue_min"), F.max("idx").alias("cue_max"))


def locate_in_chunks(points: DataFrame, ranges: DataFrame, column: str = "idx") -> DataFrame:
    """Points joined to the chunk whose owned range holds them (equi key doc_id, range on the cue)."""
    return points.join(ranges, "doc_id").filter(F.col(column).between(F.col("cue_min"), F.col("cue_max")))


def owned_text(chunks: DataFrame, role: str = "owned") -> DataFrame:
    """One text for each chunk: its cues in order, marks dropped; a chunk of marks only is a stub."""
    rows = chunks.filter(F.col("role") == role).withColumn("speech", tx.collapse(tx.strip_brackets(F.col("text"))))
    parts = F.transform(F.array_sort(F.collect_list(F.when(F.col("speech") != "", F.struct("pos", "speech")))), lambda x: x["speech"])
    out = rows.groupBy("doc_id", "chunk_no").agg(F.array_join(parts, " ").alias("text"))
    return out.withColumn("text", F.when(F.col("text") == "", "[marks only]").otherwise(F.col("text")))


def merge_owned(chunks: DataFrame) -> DataFrame:
    """The cue stream again from its chunks: lossless."""
    return chunks.filter("role = 'owned'").select("doc_id", "idx", "start_ms", "end_ms", "text")


def inherit_chunks(parent: DataFrame, texts: DataFrame) -> DataFrame:
    """New contents (doc_id, chunk_no, text) on a parent's chunks, with the neighbours' texts as context."""
    w = W.partitionBy("doc_id").orderBy("chunk_no")
    keys = parent.select("doc_id", "chunk_no").distinct()
    out = keys.join(texts, ["doc_id", "chunk_no"], "left")
    return out.withColumn("before", F.lag("text").over(w)).withColumn("after", F.lead("text").over(w))


# Checks: each gives (doc_id, rule, key, detail...) rows.


def exact_times(target: DataFrame, original: DataFrame) -> DataFrame:
    """Cues missing, extra, or with other times: full outer join by id."""
    a = target.select("doc_id", "idx", F.col("start_ms").alias("s1"), F.col("end_ms").alias("e1"))
    b = original.select("doc_id", "idx", F.col("start_ms").alias("s0"), F.col("end_ms").alias("e0"))
    rule = F.when(F.col("s1").isNull(), "missing").when(F.col("s0").isNull(), "extra").when((F.col("s1") != F.col("s0")) | (F.col("e1") != F.col("e0")), "time")
    return a.join(b, ["doc_id", "idx"], "full_outer").withColumn("rule", rule).filter(F.col("rule").isNotNull()).select("doc_id", "idx", "rule")


def boundaries(cues: DataFrame) -> DataFrame:
    """Distinct times at which a cue begins or ends."""
    return cues.select("doc_id", F.col("start_ms").alias("t")).union(cues.select("doc_id", "end_ms")).distinct()


def off_boundary(target: DataFrame, original: DataFrame) -> DataFrame:
    """Times of the target that are no boundary of the original."""
    return boundaries(target).join(boundaries(original), ["doc_id", "t"], "left_anti")


def overlaps(cues: DataFrame) -> DataFrame:
    """Cues that begin before the one before them ends."""
    by_id = W.partitionBy("doc_id").orderBy("idx")
    out = cues.withColumn("prev_end", F.lag("end_ms").over(by_id))
    return out.filter(F.col("start_ms") < F.col("prev_end")).select("doc_id", "idx", (F.col("prev_end") - F.col("start_ms")).alias("over_ms"))


def continuity(rows: DataFrame, number: str = "idx") -> DataFrame:
    """Numbers that are not their predecessor plus one."""
    w = W.partitionBy("doc_id").orderBy("pos")
    out = rows.withColumn("expected", F.lag(number, 1, 0).over(w) + 1)
    return out.filter(F.col(number) != F.col("expected")).select("doc_id", "pos", F.col("expected").cast("bigint").alias("expected"), F.col(number).alias("found"))


def uncovered(segments: DataFrame, cues: DataFrame) -> DataFrame:
    """Cue ids from 1 to the largest that no segment (cue_start..cue_end) covers."""
    top = cues.groupBy("doc_id").agg(F.max("idx").alias("top"))
    want = top.select("doc_id", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("top"))).alias("idx"))
    have = segments.select("doc_id", F.explode(F.sequence("cue_start", "cue_end")).alias("idx")).distinct()
    return want.join(have, ["doc_id", "idx"], "left_anti")


def segment_order(segments: DataFrame) -> DataFrame:
    """Segments that cross or share a cue with the one before, unless the shared boundary is estimated."""
    w = W.partitionBy("doc_id").orderBy("seg_no")
    out = segments.withColumn("prev", F.lag("cue_end").over(w)).withColumn("prev_est", F.lag("end_est").over(w))
    rule = F.when(F.col("cue_start") < F.col("prev"), "crossing").when((F.col("cue_start") == F.col("prev")) & ~(F.col("prev_est") | F.col("start_est")), "shared")
    return out.withColumn("rule", rule).filter(F.col("rule").isNotNull()).select("doc_id", "seg_no", "rule")


def neighbours(points: DataFrame, cues: DataFrame, n: int = 3) -> DataFrame:
    """The cues within ``n`` ids of each point, by exploding the ids instead of a range join."""
    near = points.select("doc_id", F.col("idx").alias("at"), F.explode(F.sequence(F.col("idx") - n, F.col("idx") + n)).alias("idx"))
    return near.join(cues, ["doc_id", "idx"]).select("doc_id", "at", "idx", "text")


def zip_by_order(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two streams side by side by place; the surplus of the longer one is 'extra_a' or 'extra_b'."""
    left = a.withColumn("place", F.row_number().over(by_time())).select("doc_id", "place", F.col("text").alias("a"))
    right = b.withColumn("place", F.row_number().over(by_time())).select("doc_id", "place", F.col("text").alias("b"))
    out = left.withColumn("__l", F.lit(1)).join(right.withColumn("__r", F.lit(1)), ["doc_id", "place"], "full_outer")
    kind = F.when(F.col("__r").isNull(), "extra_a").when(F.col("__l").isNull(), "extra_b").when(F.col("a").eqNullSafe(F.col("b")), "same").otherwise("diff")
    return out.select("doc_id", F.col("place").cast("bigint").alias("place"), kind.alias("kind"), "a", "b")


def renumber_blocks(rows: DataFrame, number: str = "n") -> DataFrame:
    """Numbers within blocks made global: each block is shifted by the sum of the earlier blocks' maxima."""
    top = rows.groupBy("doc_id", "block").agg(F.max(number).alias("top"))
    w = W.partitionBy("doc_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    shift = top.select("doc_id", "block", F.coalesce(F.sum("top").over(w), F.lit(0)).alias("shift"))
    return rows.join(shift, ["doc_id", "block"]).withColumn("global_no", F.col(number) + F.col("shift")).drop("shift")


def keep_first(rows: DataFrame, key: list[str], order: list) -> DataFrame:
    """The first row of each key by an explicit order."""
    return rows.withColumn("__rn", F.row_number().over(W.partitionBy(*key).orderBy(*order))).filter("__rn = 1").drop("__rn")


def durations(cues: DataFrame, units: DataFrame | None = None) -> DataFrame:
    """Duration classes against the document's upper median."""
    d = cues.withColumn("duration", F.col("end_ms") - F.col("start_ms"))
    ranked = d.withColumn("__r", F.row_number().over(W.partitionBy("doc_id").orderBy("duration", "idx"))).withColumn("__n", F.count(F.lit(1)).over(W.partitionBy("doc_id")))
    middle = ranked.filter(F.col("__r") == F.floor(F.col("__n") / 2) + 1).select("doc_id", F.col("duration").alias("median"))
    per = F.col("n_units") if "n_units" in cues.columns else F.lit(1)
    return d.join(middle, "doc_id").select("doc_id", "idx", "duration", "median", tm.duration_class(F.col("duration"), F.col("median"), per).alias("class"))


def internal_gaps(anchors: DataFrame, cues: DataFrame, gap_ms: int = 5000) -> DataFrame:
    """Gaps inside anchored sentences (doc_id, key, first, last cue)."""
    w = W.partitionBy("doc_id").orderBy("idx")
    gaps = cues.select("doc_id", "idx", F.lead("idx").over(w).alias("next"), (F.lead("start_ms").over(w) - F.col("end_ms")).alias("gap_ms")).filter(F.col("gap_ms") > gap_ms)
    return anchors.join(gaps, "doc_id").filter((F.col("idx") >= F.col("cue_first")) & (F.col("next") <= F.col("cue_last"))).select("doc_id", "key", "idx", "gap_ms")


def attach(cues: DataFrame, units: DataFrame) -> DataFrame:
    """Cue times with bilingual units by order; a document with unequal counts has no rows but a status."""
    n = cues.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_cues")).join(units.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_units")), "doc_id", "full_outer")
    ok = n.filter("n_cues = n_units").select("doc_id")
    c = cues.withColumn("place", F.row_number().over(by_time())).select("doc_id", "place", "start_ms", "end_ms")
    u = units.withColumn("place", F.row_number().over(W.partitionBy("doc_id").orderBy("unit_no"))).select("doc_id", "place", "en", "zh")
    w = W.partitionBy("doc_id").orderBy("place")
    return c.join(u, ["doc_id", "place"]).join(ok, "doc_id", "left_semi").withColumn("repeats", F.coalesce(F.lag("en").over(w) == F.col("en"), F.lit(False)))
