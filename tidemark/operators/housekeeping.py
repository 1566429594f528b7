"""Cache age, index staleness, context budgets and prompt rendering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions import text as tx
from tidemark.functions import timing as tm

# Fidelity of a page copy, best first.
FIDELITY = ["lossless", "refined", "plain", "degraded"]


def expired(pages: DataFrame, now, ttl_days: int = 7, column: str = "fetched") -> DataFrame:
    """Pages older than the time to live at an injected ``now``."""
    return pages.filter(F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds(F.col(column).cast("timestamp")) > ttl_days * 86400)


def refresh_plan(status: DataFrame, force: bool = False) -> DataFrame:
    """What to refresh: everything if forced, else what any of its signals calls stale."""
    stale = F.lit(True) if force else F.coalesce(F.col("version_stale"), F.lit(False)) | F.coalesce(F.col("glossary_stale"), F.lit(False)) | F.coalesce(F.col("expired"), F.lit(False))
    return status.withColumn("refresh", stale)


def staleness(current: DataFrame, recorded: DataFrame) -> DataFrame:
    """State of each repository's index: 'ok', 'stale', 'no index' or 'no commit'."""
    both = current.join(recorded, "repo", "left")
    state = F.when(F.col("current_commit").isNull(), "no commit").when(F.col("recorded_commit").isNull(), "no index").when(F.startswith("current_commit", "recorded_commit"), "ok").otherwise("stale")
    return both.select("repo", state.alias("state"))


def keep_best(pages: DataFrame) -> DataFrame:
    """One copy of each page: the best fidelity, then the latest."""
    rank = F.array_position(F.array(*[F.lit(x) for x in FIDELITY]), F.col("fidelity"))
    return pages.groupBy("title").agg(F.max_by(F.struct(*[c for c in pages.columns if c != "title"]), F.struct(-F.when(rank == 0, 99).otherwise(rank), "fetched")).alias("x")).select("title", "x.*")


def estimate(cues: DataFrame, cap: int | None = None, amplification: float | None = 5, window: int = 1_000_000, split_ratio: float = 0.05, max_output: int = 8192, output_ratio: float = 0.8) -> DataFrame:
    """Context budget of each document: visible characters, tokens, mean characters of cues that are not marks
    only, cues to own in one chunk, and the state against both budgets."""
    visible = F.length(F.regexp_replace("text", r"(?U)\s", ""))
    real = F.length(F.regexp_replace(tx.strip_brackets(F.col("text")), r"(?U)\s", "")) > 0
    out = cues.groupBy("doc_id").agg(F.sum(visible).alias("chars"), F.avg(F.when(real, visible)).alias("mean"))
    cap = tm.capacity(window, split_ratio, max_output, output_ratio, amplification) if cap is None else cap
    tokens = tm.token_estimate(F.col("chars"))
    amp = (tokens * F.lit(float(amplification))).cast("bigint") if amplification else F.lit(0).cast("bigint")
    taken, given = int(window * split_ratio), int(max_output * output_ratio)
    state = F.when(tokens > given, "over output").when(amp > given, "predicted over").when(tokens > taken, "over input").otherwise("ok")
    return out.select("doc_id", "chars", tokens.alias("tokens"), tm.owned_cues(F.lit(cap), F.col("mean")).alias("owned"), state.alias("state"))


def prompts(chunks: DataFrame, hits: DataFrame, template: str) -> DataFrame:
    """A prompt for each chunk: its template filled with its text, its neighbours' and the terms found on its
    cues."""
    own = chunks.filter("role = 'owned'")
    text = own.groupBy("doc_id", "chunk_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "text"))), lambda x: x["text"]), " ").alias("text"))
    w = W.partitionBy("doc_id").orderBy("chunk_no")
    text = text.withColumn("prev", F.coalesce(F.lag("text").over(w), F.lit(""))).withColumn("next", F.coalesce(F.lead("text").over(w), F.lit("")))
    terms = own.select("doc_id", "chunk_no", "idx").join(hits, ["doc_id", "idx"]).groupBy("doc_id", "chunk_no").agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(" = ", "term_key", "zh"))), "; ").alias("terms"))
    out = text.join(terms, ["doc_id", "chunk_no"], "left").withColumn("terms", F.coalesce("terms", F.lit("none")))
    return out.select("doc_id", "chunk_no", tx.render_template(F.lit(template), {c: F.col(c) for c in ("text", "prev", "next", "terms")}).alias("prompt"))
