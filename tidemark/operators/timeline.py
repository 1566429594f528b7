"""Time allocation inside anchored sentences, alerts, and the whole reflow.

Everything but weighted snapping is windows and expressions. Snapping accepts a boundary only beyond the last
one accepted, so it is a fold over a sentence's few points; it runs on Arrow batches of whole sentences, with no
shuffle of its own.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions import text as tx
from tidemark.functions import timing as tm
from tidemark.operators import anchor as an
from tidemark.operators import cues as cu
from tidemark.storage import table

def in_sentence():
    """The order of units in each sentence."""
    return W.partitionBy("doc_id", "seq").orderBy("unit_no")


def snap(weights: list[float], start: int, end: int, bounds: list[int], snap_ms: int = 300) -> list[tuple[int, int, bool, bool]]:
    """(start, end, start predicted, end predicted) of each part of a span by weight. A point snaps to the nearest
    boundary (the lower of a tie) within ``snap_ms`` if that leaves 100 ms on both sides; else it is predicted, on
    whole 100 ms. A span without room keeps its order only as far as its end allows."""
    total, span, acc = sum(weights) or 1, max(0, end - start), 0.0
    edges, predicted = [start], []
    for w in weights[:-1]:
        acc += w
        at = start + span * acc / total
        i = bisect_left(bounds, at)
        near = min(bounds[max(0, i - 1) : i + 1], key=lambda b: (abs(b - at), b), default=None)
        if near is not None and abs(near - at) <= snap_ms and edges[-1] + 100 < near < end - 100:
            edges.append(int(near))
            predicted.append(False)
        else:
            at = max(round(at / 100) * 100, edges[-1] + 100) if round(at / 100) * 100 <= edges[-1] else round(at / 100) * 100
            edges.append(min(at, end - 100))
            predicted.append(True)
    edges.append(end)
    if len(edges) > 2 and edges[-2] >= edges[-1]:
        edges[-2], predicted[-1] = end - 100, True
    n = len(weights)
    return [(edges[i], edges[i + 1], i > 0 and predicted[i - 1], i < n - 1 and predicted[i]) for i in range(n)]


def allocate(units: DataFrame, bounds: DataFrame, snap_ms: int = 300) -> DataFrame:
    """Units (doc_id, seq, unit_no, weight, start, end of the sentence) with their own start and end.

    Only the boundaries inside a sentence's span (and ``snap_ms`` beside it) come with it: a range join keyed by
    document.
    """
    parts = F.array_sort(F.collect_list(F.struct("unit_no", F.col("weight").cast("double").alias("weight"))))
    rows = units.groupBy("doc_id", "seq", "start", "end").agg(parts.alias("parts"))
    b = bounds.select("doc_id", "t")
    near = rows.select("doc_id", "seq", "start", "end").join(b, "doc_id").filter((F.col("t") >= F.col("start") - snap_ms) & (F.col("t") <= F.col("end") + snap_ms)).groupBy("doc_id", "seq").agg(F.array_sort(F.collect_list("t")).alias("bounds"))
    rows = rows.join(near, ["doc_id", "seq"], "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                bounds = [] if r.bounds is None else [int(x) for x in r.bounds]
                for part, (a, b, p, q) in zip(r.parts, snap([x["weight"] for x in r.parts], int(r.start), int(r.end), bounds, snap_ms)):
                    out.append((r.doc_id, r.seq, part["unit_no"], a, b, p, q))
            yield pd.DataFrame(out, columns=["doc_id", "seq", "unit_no", "start", "end", "start_pred", "end_pred"])

    return rows.mapInPandas(run, "doc_id long, seq long, unit_no long, start long, end long, start_pred boolean, end_pred boolean")


def by_ratio(units: DataFrame, bounds: DataFrame, snap_ms: int = 300) -> DataFrame:
    """Allocation by the length of each unit's text."""
    return allocate(units.withColumn("weight", F.length("zh")), bounds, snap_ms)


def by_reading(units: DataFrame, bounds: DataFrame, snap_ms: int = 300, speed: float = 5.0) -> DataFrame:
    """Allocation by the time each unit takes to read."""
    return allocate(units.withColumn("weight", F.greatest(F.lit(1), tm.reading_ms(F.col("zh"), speed))), bounds, snap_ms)


def place_units(units: DataFrame, anchors: DataFrame) -> DataFrame:
    """Places of units (doc_id, seq, unit_no, en) inside their anchored sentence. Where the units' normalised
    texts joined are the sentence's, a unit's place is a prefix sum of lengths."""
    n = F.length(tx.norm(F.col("en"))).cast("bigint")
    u = units.withColumn("n", n).withColumn("upto", F.sum("n").over(in_sentence())).withColumn("all", F.sum("n").over(W.partitionBy("doc_id", "seq"))).withColumn("least", F.min("n").over(W.partitionBy("doc_id", "seq")))
    out = u.join(anchors.select("doc_id", "seq", F.col("pos").alias("s_pos"), F.col("pos_end").alias("s_end")), ["doc_id", "seq"])
    whole = (F.col("all") == F.col("s_end") - F.col("s_pos") + 1) & (F.col("least") > 0)
    return out.filter(whole).withColumn("pos", F.col("s_pos") + F.col("upto") - F.col("n")).withColumn("pos_end", F.col("s_pos") + F.col("upto") - 1).drop("n", "upto", "all", "least", "s_pos", "s_end")


def by_cues(placed: DataFrame, anchors: DataFrame, cues: DataFrame, offsets: DataFrame) -> DataFrame:
    """Units on their own cues: a cue shared by two units is cut by their characters in it, the first and last unit
    are clipped to the sentence, and a unit begins no earlier than the one before it ends. The pass never
    writes an end, so ``lag`` is enough."""
    places = placed.withColumn("__seq", F.col("seq") * 1000 + F.col("unit_no"))
    held = an.on_cues(places.select("doc_id", F.col("__seq").alias("seq"), "pos", "pos_end"), offsets).withColumnRenamed("seq", "__seq")
    u = places.join(held.drop("pos", "pos_end"), ["doc_id", "__seq"])
    t = cues.join(offsets, ["doc_id", "idx"])
    u = u.join(t.select("doc_id", F.col("idx").alias("cue_first"), F.col("start_ms").alias("us"), F.col("end_ms").alias("c_end"), "off_start", "off_end"), ["doc_id", "cue_first"])
    u = u.join(cues.select("doc_id", F.col("idx").alias("cue_last"), F.col("end_ms").alias("ue")), ["doc_id", "cue_last"])
    shared = F.lag("cue_last").over(in_sentence()) == F.col("cue_first")
    cut = tm.split_point(F.col("us"), F.col("c_end"), F.lag("pos_end").over(in_sentence()) + 1 - F.col("off_start"), F.col("off_end") - F.col("pos"))
    u = u.withColumn("cut", F.when(F.coalesce(shared, F.lit(False)), cut))
    u = u.withColumn("b", F.coalesce("cut", "us")).withColumn("e", F.coalesce(F.lead("cut").over(in_sentence()), "ue"))
    u = u.join(anchors.select("doc_id", "seq", F.col("start").alias("s_start"), F.col("end").alias("s_end")), ["doc_id", "seq"])
    first, last = F.lag("unit_no").over(in_sentence()).isNull(), F.lead("unit_no").over(in_sentence()).isNull()
    u = u.withColumn("b", F.when(first, F.greatest("b", "s_start")).otherwise(F.col("b"))).withColumn("e", F.when(last, F.least("e", "s_end")).otherwise(F.col("e")))
    u = u.withColumn("b", F.greatest("b", F.coalesce(F.lag("e").over(in_sentence()), F.col("b"))))
    return u.select("doc_id", "seq", "unit_no", F.col("b").cast("bigint").alias("start"), F.col("e").cast("bigint").alias("end"), F.lit(False).alias("start_pred"), F.lit(False).alias("end_pred"))


def reflow(cues: DataFrame, sentences: DataFrame, units: DataFrame, snap_ms: int = 300, speed: float = 5.0) -> DataFrame:
    """The timeline of all units: sentences are anchored and parted at shared cues; units lie on their own cues,
    unless they cannot be placed (then by text length) or would be too short to read (then by reading time)."""
    # Each step joins what several earlier ones gave; written tables keep the plans from multiplying.
    cues, sentences, units = (table(x, "reflow-in") for x in (cues, sentences, units))
    offsets = table(an.cue_offsets(cues), "reflow-offsets")
    places = table(an.on_cues(table(an.locate(cues, sentences), "reflow-places"), offsets), "reflow-held")
    anchors = table(an.resolve_shared(an.timed(places, cues), cues, offsets), "reflow-anchors")
    bounds = cu.boundaries(cues)
    own = table(by_cues(table(place_units(units, anchors), "reflow-units"), anchors, cues, offsets), "reflow-own")
    text = own.join(units.select("doc_id", "seq", "unit_no", "zh"), ["doc_id", "seq", "unit_no"])
    hard = text.filter(tm.needs_interpolation(F.col("end") - F.col("start"), tm.reading_ms(F.col("zh"), speed))).select("doc_id", "seq").distinct()
    spans = units.join(anchors.select("doc_id", "seq", "start", "end"), ["doc_id", "seq"])
    read = by_reading(spans.join(hard, ["doc_id", "seq"], "left_semi"), bounds, snap_ms, speed)
    rest = by_ratio(spans.join(own.select("doc_id", "seq").distinct(), ["doc_id", "seq"], "left_anti"), bounds, snap_ms)
    kept = own.join(hard, ["doc_id", "seq"], "left_anti")
    tag = lambda df, how: df.withColumn("alloc", F.lit(how))
    return tag(kept, "cue").unionByName(tag(read, "reading")).unionByName(tag(rest, "ratio"))


def alerts(timeline: DataFrame, units: DataFrame) -> DataFrame:
    """Typed findings (doc_id, seq, unit_no, kind, value) of a timeline."""
    t = timeline.join(units.select("doc_id", "seq", "unit_no", "zh"), ["doc_id", "seq", "unit_no"]).withColumn("d", F.col("end") - F.col("start"))
    ranked = t.withColumn("__r", F.row_number().over(W.partitionBy("doc_id").orderBy("d", "seq", "unit_no"))).withColumn("__n", F.count(F.lit(1)).over(W.partitionBy("doc_id")))
    median = ranked.filter(F.col("__r") == F.floor(F.col("__n") / 2) + 1).select("doc_id", F.col("d").alias("median"))
    n = t.groupBy("doc_id", "seq").agg(F.count(F.lit(1)).alias("n"))
    t = t.join(median, "doc_id").join(n, ["doc_id", "seq"])
    order = W.partitionBy("doc_id").orderBy("start", "seq", "unit_no")
    t = t.withColumn("jump", F.col("start") - F.lag("end").over(order)).withColumn("width", tx.text_width(F.col("zh"))).withColumn("class", tm.duration_class(F.col("d"), F.col("median"), F.col("n")))
    key = ["doc_id", "seq", "unit_no"]
    found = [t.filter("class <> 'ok'").select(*key, F.col("class").alias("kind"), F.col("d").cast("double").alias("value")), t.filter("jump > 10000").select(*key, F.lit("jump").alias("kind"), F.col("jump").cast("double").alias("value")), t.filter("width > 22").select(*key, F.lit("width").alias("kind"), F.col("width").alias("value")), t.filter("start_pred or end_pred").select(*key, F.lit("predicted").alias("kind"), F.col("start").cast("double").alias("value"))]
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def check_plan(sentences: DataFrame, units: DataFrame, hard: float = 26, soft: float = 22) -> DataFrame:
    """Rules of a bilingual plan (doc_id, seq, rule, detail): units that do not join to their sentence in either
    language, residual border marks, unbalanced brackets and quotes, and over-wide units."""
    join = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("unit_no", c))), lambda x: x[c]), "")
    u = units.groupBy("doc_id", "seq").agg(join("en").alias("u_en"), join("zh").alias("u_zh"))
    s = sentences.join(u, ["doc_id", "seq"])
    rules = [
        s.filter(tx.norm(F.col("u_en")) != tx.norm(F.col("en"))).select("doc_id", "seq", F.lit("en-concat").alias("rule"), F.col("u_en").alias("detail")),
        s.filter(tx.zh_content(F.col("u_zh")) != tx.zh_content(F.col("zh"))).select("doc_id", "seq", F.lit("zh-concat").alias("rule"), F.col("u_zh").alias("detail")),
        units.select("doc_id", "seq", tx.width_flag(tx.text_width(F.col("zh")), soft, hard).alias("rule"), F.col("zh").alias("detail")).filter("rule <> 'ok'"),
        units.select("doc_id", "seq", F.explode(tx.residual_marks(F.col("zh"))).alias("detail")).select("doc_id", "seq", F.lit("residue").alias("rule"), "detail"),
        units.select("doc_id", "seq", tx.bracket_state(F.col("zh")).alias("rule"), F.col("zh").alias("detail")).filter("rule <> 'ok'"),
        units.select("doc_id", "seq", tx.quote_state(F.col("zh")).alias("rule"), F.col("zh").alias("detail")).filter("rule <> 'ok'"),
    ]
    out = rules[0]
    for r in rules[1:]:
        out = out.unionByName(r)
    return out


def histogram(findings: DataFrame, kind: str = "rule") -> DataFrame:
    return findings.groupBy(kind).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), kind)
