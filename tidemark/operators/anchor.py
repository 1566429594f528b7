"""Anchoring sentences on the time axis by their place in the normalised text.

A document's normalised cues are one string with an offset for each cue. Sentences are located in it inside one
row for each document, so the string is never copied to a row for each sentence: all places of the text are hashed once,
and a sentence looks its beginning up among them. Only the offsets found meet the cues, in a join keyed by document.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions import scans
from tidemark.functions import timing as tm


def cue_offsets(cues: DataFrame, normal=scans.norm) -> DataFrame:
    """(doc_id, idx, off_start, off_end) of every cue in its document's normalised text."""
    n = cues.select("doc_id", "idx", F.length(normal(F.col("text"))).cast("bigint").alias("n"))
    upto = F.sum("n").over(W.partitionBy("doc_id").orderBy("idx"))
    return n.select("doc_id", "idx", (upto - F.col("n")).alias("off_start"), upto.alias("off_end"))


def full_text(cues: DataFrame, normal=scans.norm) -> DataFrame:
    rows = cues.select("doc_id", "idx", normal(F.col("text")).alias("n")).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("idx", "n"))).alias("c"))
    return rows.select("doc_id", F.array_join("c.n", "").alias("full"))


def locate(cues: DataFrame, sentences: DataFrame, normal=scans.norm) -> DataFrame:
    """(doc_id, seq, pos, pos_end, status): first place of each sentence, 0-based; 'non-unique' if there is a
    second, 'failed' if there is none or nothing is left of the sentence."""
    full = full_text(cues, normal)
    wanted = sentences.groupBy("doc_id").agg(F.collect_list(F.struct("seq", normal(F.col("sentence")).alias("n"))).alias("s"))
    both = wanted.join(full, "doc_id", "left").select("doc_id", F.coalesce("full", F.lit("")).alias("full"), F.col("s.seq").alias("seq"), F.col("s.n").alias("n"))
    types = {f.name: f.dataType.simpleString() for f in sentences.schema}
    return both.mapInArrow(_locate, f"doc_id {types['doc_id']}, seq {types['seq']}, pos bigint, pos_end bigint, status string")


def _locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found, sizes = [], []
        for row in range(batch.num_rows):
            wanted = batch.column("n")[row].as_py()
            for n, (first, again) in zip(wanted, places(batch.column("full")[row].as_py(), wanted)):
                found.append((first, first + len(n) - 1, "unique" if again < 0 else "non-unique") if first >= 0 else (None, None, "failed"))
            sizes.append(len(wanted))
        pos, end, status = zip(*found) if found else ((), (), ())
        ids = batch.column("doc_id").take(pa.array(np.repeat(np.arange(batch.num_rows), sizes), pa.int64()))
        yield pa.RecordBatch.from_arrays([ids, batch.column("seq").flatten(), pa.array(pos, pa.int64()), pa.array(end, pa.int64()), pa.array(status, pa.string())], names=["doc_id", "seq", "pos", "pos_end", "status"])


#: Characters of a sentence's beginning that are looked up, a power of two.
GRAM = 16


def places(text: str, wanted: list[str | None]) -> list[tuple[int, int]]:
    """First and second place of each string in a text, -1 where there is none; empty strings have none."""
    out = []
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    heads = [n for n in wanted if n and len(n) >= GRAM]
    at: dict[int, list[int]] = {}
    if heads and len(codes) >= GRAM:
        begins = np.frombuffer("".join(n[:GRAM] for n in heads).encode("utf-32-le"), np.uint32).reshape(-1, GRAM)
        grams, keys = _hash(codes), _hash(begins)[:, 0]
        known = np.unique(keys)
        hit = np.flatnonzero(known[np.minimum(np.searchsorted(known, grams), len(known) - 1)] == grams)
        for key, p in zip(grams[hit].tolist(), hit.tolist()):
            at.setdefault(key, []).append(p)
        keys = iter(keys.tolist())
    for n in wanted:
        if not n or len(n) > len(text):
            out.append((-1, -1))
            if n and len(n) >= GRAM and len(codes) >= GRAM:
                next(keys)
        elif len(n) < GRAM:
            first = text.find(n)
            out.append((first, text.find(n, first + 1) if first >= 0 else -1))
        else:
            got = islice((p for p in at.get(next(keys), ()) if text.startswith(n, p)), 2)
            out.append((next(got, -1), next(got, -1)))
    return out


def _hash(codes: np.ndarray) -> np.ndarray:
    """Hashes of all runs of ``GRAM`` characters along the last axis, from those of runs half as long."""
    out, n, factor = codes.astype(np.uint64), 1, np.uint64(0x9E3779B97F4A7C15)
    while n < GRAM:
        out = out[..., :-n] * factor + out[..., n:]
        n, factor = 2 * n, np.uint64(int(factor) ** 2 % 2**64)
    return out


def on_cues(places: DataFrame, offsets: DataFrame) -> DataFrame:
    """Adds the cues that hold a sentence's first and last character (cue_first, cue_last).

    Places and cue starts of one document are merged in order and the last cue start is carried forward: a
    range join without one row compared with many. Both characters of a place are points of one pass, in rows that carry
    the place, so that places are made and sorted once.
    """
    columns = places.columns
    ends = F.explode(F.array(F.struct(F.col("pos").alias("at"), F.lit(0).alias("end")), F.struct(F.col("pos_end").alias("at"), F.lit(1).alias("end"))))
    points = places.select("doc_id", F.struct(*columns).alias("place"), ends.alias("p")).select("doc_id", "p.at", F.lit(1).alias("kind"), "place", "p.end", F.lit(None).cast("bigint").alias("idx"))
    starts = offsets.filter("off_end > off_start").select("doc_id", F.col("off_start").alias("at"), F.lit(0).alias("kind"), "idx")
    w = W.partitionBy("doc_id").orderBy("at", "kind").rowsBetween(W.unboundedPreceding, 0)
    held = points.unionByName(starts, allowMissingColumns=True).withColumn("held", F.when(F.col("at").isNotNull(), F.last("idx", ignorenulls=True).over(w))).filter("kind = 1")
    both = held.groupBy("doc_id", "place").agg(F.max(F.when(F.col("end") == 0, F.col("held"))).alias("cue_first"), F.max(F.when(F.col("end") == 1, F.col("held"))).alias("cue_last"), F.count_if(F.col("end") == 0).cast("int").alias("copies"))
    # Equal places are as many rows as before.
    return both.select("place", "cue_first", "cue_last", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("place.*", "cue_first", "cue_last")


def timed(anchors: DataFrame, cues: DataFrame) -> DataFrame:
    """Adds start and end; a failed sentence stands at its predecessor's end (0 if first)."""
    a = anchors.join(cues.select("doc_id", F.col("idx").alias("cue_first"), F.col("start_ms").alias("start")), ["doc_id", "cue_first"], "left")
    a = a.join(cues.select("doc_id", F.col("idx").alias("cue_last"), F.col("end_ms").alias("end")), ["doc_id", "cue_last"], "left")
    before = W.partitionBy("doc_id").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    carried = F.coalesce(F.last("end", ignorenulls=True).over(before), F.lit(0))
    return a.withColumn("start", F.coalesce("start", carried)).withColumn("end", F.coalesce("end", carried))


def resolve_shared(anchors: DataFrame, cues: DataFrame, offsets: DataFrame) -> DataFrame:
    """Neighbouring sentences that share a cue cut it by their characters in it; other overlaps move the later
    start. Each step reads only times that no earlier step has written, so ``lag`` and ``lead`` over the
    original rows give the same as a pass from left to right."""
    c = cues.join(offsets, ["doc_id", "idx"]).select("doc_id", F.col("idx").alias("cue_first"), F.col("start_ms").alias("c_start"), F.col("end_ms").alias("c_end"), "off_start", "off_end")
    w = W.partitionBy("doc_id").orderBy("seq")
    a = anchors.join(c, ["doc_id", "cue_first"], "left")
    p_end, p_cue, p_pos = F.lag("end").over(w), F.lag("cue_last").over(w), F.lag("pos_end").over(w)
    over = F.col("start") < p_end
    cut = tm.split_point(F.col("c_start"), F.col("c_end"), p_pos - F.col("off_start") + 1, F.col("off_end") - F.col("pos"))
    a = a.withColumn("__shared", F.coalesce(over & (p_cue == F.col("cue_first")), F.lit(False))).withColumn("__cut", F.when(F.col("__shared"), cut))
    start = F.when(F.col("__shared"), F.col("__cut")).when(F.coalesce(over, F.lit(False)), p_end).otherwise(F.col("start"))
    end = F.coalesce(F.lead("__cut").over(w), F.col("end"))
    out = a.withColumn("__s", start).withColumn("__e", end)
    return out.select("doc_id", "seq", "pos", "pos_end", "status", "cue_first", "cue_last", F.col("__s").cast("bigint").alias("start"), F.col("__e").cast("bigint").alias("end"), F.col("__shared").alias("shared"))


def nearest_bound(points: DataFrame, bounds: DataFrame, snap_ms: int = 300) -> DataFrame:
    """The boundary nearest to each point (doc_id, key, at) within ``snap_ms``, the lower one of a tie.

    An as-of join without comparing all pairs: points and boundaries are merged in order, and each point sees
    the last boundary before and the first after it.
    """
    p = points.select("doc_id", "key", F.col("at").cast("double").alias("at"), F.lit(1).alias("kind"))
    b = bounds.select("doc_id", F.lit(None).cast(points.schema["key"].dataType).alias("key"), F.col("t").cast("double").alias("at"), F.lit(0).alias("kind"))
    both = p.unionByName(b).withColumn("t", F.when(F.col("kind") == 0, F.col("at")))
    w = W.partitionBy("doc_id").orderBy("at", "kind")
    back = F.last("t", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    forth = F.first("t", ignorenulls=True).over(w.rowsBetween(0, W.unboundedFollowing))
    out = both.withColumn("lo", back).withColumn("hi", forth).filter("kind = 1")
    d_lo, d_hi = F.col("at") - F.col("lo"), F.col("hi") - F.col("at")
    best = F.when(F.col("hi").isNull() | (d_lo <= d_hi), F.col("lo")).otherwise(F.col("hi"))
    return out.select("doc_id", "key", "at", F.when(F.abs(best - F.col("at")) <= snap_ms, best).cast("bigint").alias("bound"))


def split_points(units: DataFrame, weight: str = "weight") -> DataFrame:
    """Proportional split points of each sentence's span: (doc_id, seq, unit_no, at) after every unit but the
    last."""
    w = W.partitionBy("doc_id", "seq")
    upto = F.sum(weight).over(w.orderBy("unit_no"))
    total = F.sum(weight).over(w)
    at = F.col("start") + (F.col("end") - F.col("start")) * upto / total
    last = F.max("unit_no").over(w)
    return units.withColumn("at", at.cast("double")).withColumn("__last", last).filter(F.col("unit_no") < F.col("__last")).select("doc_id", "seq", "unit_no", "at")


def align_in_order(cues: Iterable[tuple[int, str | None]], text: str) -> Iterator[tuple[int, int | None, int | None]]:
    """Place of every normalised cue (idx, text) in a normalised text, searching on from the last one found."""
    cursor = 0
    for idx, n in cues:
        at = text.find(n, cursor) if n else -1
        yield (idx, None, None) if at < 0 else (idx, at, at + len(n))
        cursor = cursor if at < 0 else at + len(n)


def check_breaks(cues: DataFrame, texts: DataFrame, gaps: DataFrame) -> DataFrame:
    """For each gap whether a full stop stands between its cues in the punctuated text: 'pass', 'violate', or
    'skip' where a cue cannot be placed. The cursor makes it a fold, by document."""
    prepared = cues.select("doc_id", "idx", scans.norm_ascii(F.col("text")).alias("n"))
    rows = prepared.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("idx", "n"))).alias("c")).select("doc_id", F.col("c.idx").alias("idx"), F.col("c.n").alias("n"))
    points = gaps.groupBy("doc_id").agg(F.collect_list(F.struct("ia", "ib")).alias("g")).select("doc_id", F.col("g.ia").alias("ia"), F.col("g.ib").alias("ib"))
    both = rows.join(texts.select("doc_id", "text"), "doc_id").join(points, "doc_id").select("doc_id", "idx", "n", "text", "ia", "ib")
    return both.mapInArrow(_check_breaks, "doc_id long, ia long, ib long, status string")


def _check_breaks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        col, status, sizes = {name: batch.column(name) for name in batch.schema.names}, [], []
        for row in range(batch.num_rows):
            ia, ib = col["ia"][row].as_py(), col["ib"][row].as_py()
            # A null text has no characters; no cue is placed in it.
            status += breaks(zip(col["idx"][row].as_py(), col["n"][row].as_py()), col["text"][row].as_py() or "", zip(ia, ib))
            sizes.append(len(ia))
        ids = col["doc_id"].take(pa.array(np.repeat(np.arange(batch.num_rows), sizes)))
        yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), col["ia"].flatten().cast(pa.int64()), col["ib"].flatten().cast(pa.int64()), pa.array(status, pa.string())], names=["doc_id", "ia", "ib", "status"])


def breaks(cues: Iterable[tuple[int, str | None]], text: str, gaps: Iterable[tuple[int, int]]) -> list[str]:
    """Status of each gap (ia, ib) of one document, by its normalised cues (idx, text) and punctuated text."""
    data = np.frombuffer(text.encode(), np.uint8)
    out = scans.kept(data, False)
    at = np.flatnonzero(out)
    stops = np.concatenate([[0], np.cumsum((data == ord(".")) | (data == ord("?")) | (data == ord("!")))])
    upto = stops[np.append(at, len(data))].tolist()  # full stops before each kept character, and in all
    placed = {i: (a, b) for i, a, b in align_in_order(cues, out[at].tobytes().decode("ascii"))}
    status, nowhere = [], (None, None)
    for ia, ib in gaps:
        end, begin = placed.get(ia, nowhere)[1], placed.get(ib, nowhere)[0]
        status.append("skip" if begin is None or not end else "pass" if upto[begin] > upto[end - 1] else "violate")
    return status


def check_breaks_chunked(gaps: DataFrame, ranges: DataFrame, texts: DataFrame, last: int = 8) -> DataFrame:
    """For gaps between two chunks whether the earlier chunk's text has a full stop among its last characters."""
    a = gaps.join(ranges.select("doc_id", F.col("chunk_no").alias("ca"), "cue_min", "cue_max"), "doc_id").filter(F.col("ia").between(F.col("cue_min"), F.col("cue_max"))).drop("cue_min", "cue_max")
    b = a.join(ranges.select("doc_id", F.col("chunk_no").alias("cb"), "cue_min", "cue_max"), "doc_id").filter(F.col("ib").between(F.col("cue_min"), F.col("cue_max"))).filter("ca <> cb")
    t = texts.select("doc_id", F.col("chunk_no").alias("ca"), F.rtrim("text").alias("text"))
    out = b.join(t, ["doc_id", "ca"], "left")
    status = F.when(F.coalesce(F.col("text"), F.lit("")) == "", "skip").when(F.right("text", F.lit(last)).rlike("[.?!]"), "pass").otherwise("violate")
    return out.select("doc_id", "ia", "ib", "ca", "cb", status.alias("status"))
