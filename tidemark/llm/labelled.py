"""Bounded samples of labelled documents, and the held-out fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of each class that a fit may use, and the longest text among them: bounds of what the driver gets.
PER_CLASS, LONGEST = 2500, 20_000


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row belongs to the fold that no fit may learn labels from. A null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int = PER_CLASS, longest: int = LONGEST) -> list[tuple[str, int]]:
    """(text, label) of at most ``per_class`` documents of each class 0 and 1, outside the held-out fold: those
    of the least hash among the labelled ids. Null labels and texts, and texts over ``longest``, are not used;
    an id with several labels counts with the largest."""
    known = labels.filter(F.col(label).isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.max(label).alias("y"))
    order = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = known.filter("y = 0").orderBy(order, "doc_id").limit(per_class).union(known.filter("y = 1").orderBy(order, "doc_id").limit(per_class))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most 2 * per_class ids
    rows = rows.filter(F.length("text") <= longest).dropDuplicates(["doc_id"]).select("doc_id", "text", "y")
    return [(r["text"], int(r["y"])) for r in sorted(rows.collect(), key=lambda r: r["doc_id"])]
