"""Sharding by Karmarkar-Karp differencing.

Groups of equal texts are indivisible. Each block of groups is differenced by one task: the two partial
partitions with the largest spread are combined, the largest part of one with the smallest of the other, until
one partition of the block into ``shards`` parts is left. Those partitions (``shards`` sums each) are combined
in the same way, level by level, ``FAN`` at a time, so no task and not the driver ever holds more than a
bounded number of them.

Defined results: a null text has no bytes (size 1) and shares the group of the empty text; repeated rows are
rows of their own; an empty table gives an empty result; further input columns are ignored. A group larger than
a shard's share is still kept together, as groups are indivisible.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.runtime import drop, table

#: Groups in a block, partitions combined by one task, rows that get their slots in one task.
BLOCK, FAN, SLOTS = 4096, 256, 50_000


def difference(sums: np.ndarray) -> np.ndarray:
    """Combine partial partitions (rows of ``sums``, k parts each) by largest differencing.

    Returns, for each row and part, the part of the whole to which it goes. Ties go to the earlier row.
    """
    m, k = sums.shape
    order = np.argsort(-sums, axis=1, kind="stable")
    parts = np.take_along_axis(sums, order, axis=1).tolist()
    names = order.tolist()
    children: list[tuple[int, int, list[int], list[int]]] = []
    heap = [(p[-1] - p[0], i) for i, p in enumerate(parts)]
    heapq.heapify(heap)
    live = dict(enumerate(zip(parts, names)))
    turn = list(range(k))
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        (pa, na), (pb, nb) = live.pop(a), live.pop(b)
        total = [x + y for x, y in zip(pa, reversed(pb))]
        by = sorted(turn, key=lambda j: -total[j])
        node = m + len(children)
        nb.reverse()
        children.append((a, b, [na[j] for j in by], [nb[j] for j in by]))
        total = [total[j] for j in by]
        live[node] = (total, turn[:])
        heapq.heappush(heap, (total[-1] - total[0], node))
    out = np.zeros((m, k), np.int32)
    goes: dict[int, list[int]] = {}
    root = heap[0][1]
    if root < m:
        out[0, names[0]] = turn
        return out
    goes[root] = turn
    for node in range(root, m - 1, -1):
        a, b, la, lb = children[node - m]
        here = goes.pop(node)
        for child, own in ((a, la), (b, lb)):
            to = [0] * k
            for j, part in enumerate(own):
                to[part] = here[j]
            if child < m:
                out[child] = to
            else:
                goes[child] = to
    return out


def _block(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "digest"], ascending=[False, True], kind="stable")
        sums = np.zeros((len(pdf), k), np.int64)
        sums[:, 0] = pdf["bytes"]
        return pdf.assign(part=difference(sums)[:, 0].astype(np.int32))[["block", "digest", "bytes", "part"]]

    return run


def _combine(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        blocks, row = np.unique(pdf["block"], return_inverse=True)
        sums = np.zeros((len(blocks), k), np.int64)
        sums[row, pdf["part"]] = pdf["bytes"]
        to = difference(sums)
        return pd.DataFrame({"up": np.repeat(np.int64(pdf["up"].iloc[0]), len(blocks) * k), "block": np.repeat(blocks, k), "part": np.tile(np.arange(k, dtype=np.int32), len(blocks)), "to": to.ravel(), "bytes": sums.ravel()})

    return run


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """Deal all rows into ``shards`` shards with near-equal bytes.

    Returns id, size, text_crc32, shard and slot (gapless from 0 in each shard); with ``keep`` also the input's
    other columns.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("crc"), F.unhex(F.sha2(text, 256)).alias("digest"))
    rows = table(rows, "shard-rows")
    n_rows, n_groups = rows.agg(F.count(F.lit(1)), F.count_distinct("digest")).first()
    blocks = max(1, -(-n_groups // BLOCK))
    dealt = rows.groupBy("digest").agg(F.sum("size").alias("bytes")).withColumn("block", F.pmod(F.xxhash64("digest"), F.lit(blocks)))
    dealt = table(dealt.groupBy("block").applyInPandas(_block(shards), "block long, digest binary, bytes long, part int"), "shard-parts")
    sums = dealt.groupBy("block", "part").agg(F.sum("bytes").alias("bytes"))
    place = None
    while True:
        up = sums.withColumn("up", F.floor(F.col("block") / FAN))
        level = table(up.groupBy("up").applyInPandas(_combine(shards), "up long, block long, part int, to int, bytes long"), "shard-level")
        if place is None:
            place = level.select(F.col("block").alias("leaf"), F.col("part").alias("leaf_part"), "up", "to")
        else:
            place = place.withColumnsRenamed({"up": "block", "to": "part"}).join(level.select("block", "part", F.col("up").alias("higher"), F.col("to").alias("next")), ["block", "part"]).select("leaf", "leaf_part", F.col("higher").alias("up"), F.col("next").alias("to"))
        blocks = -(-blocks // FAN)
        if blocks <= 1:
            break
        sums = level.groupBy(F.col("up").alias("block"), F.col("to").alias("part")).agg(F.sum("bytes").alias("bytes"))
    homes = dealt.join(place.withColumnsRenamed({"leaf": "block", "leaf_part": "part"}), ["block", "part"]).select("digest", F.col("to").alias("shard"))
    buckets = max(1, -(-n_rows // (SLOTS * shards)))
    within = W.partitionBy("shard", "bucket").orderBy("id", "digest")
    placed = rows.join(homes, "digest").withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))
    # written once slots are known: a file for each bucket of a shard, not for each partition of the join
    placed = table(placed.withColumn("slot", F.row_number().over(within) - 1).select("id", "size", "crc", "shard", "bucket", "slot"), "shard-placed")
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n")).select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    out = placed.join(F.broadcast(offsets), ["shard", "bucket"])
    out = out.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("slot") + F.col("before")).cast("long").alias("slot"))
    drop(rows)
    if keep:
        slots = out.select(F.col(id_col).alias("__id"), F.struct("size", "text_crc32", "shard", "slot").alias("__shard")).withColumn("__n", F.row_number().over(W.partitionBy("__id").orderBy("__shard.text_crc32", "__shard.size", "__shard.slot")))
        held = docs.select(F.col(id_col).alias("__doc"), F.struct(*docs.columns).alias("__row"), F.row_number().over(W.partitionBy(id_col).orderBy(F.crc32(text), F.octet_length(text))).alias("__m"))
        out = held.join(slots, held["__doc"].eqNullSafe(slots["__id"]) & (held["__m"] == slots["__n"])).select("__row.*", "__shard.*")
    return out


def op7_sharding(spark, sf_dir: str) -> DataFrame:
    """Contract query: every document, law ``bytes``, 16 shards."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = shard(docs, 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
