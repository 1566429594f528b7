"""Quality rules: base rules of a text, and cross-document line frequency.

Lines are normalised (A-Z lower-cased, digits to 0, white space runs to one space, trimmed) and hashed. A
line's frequency is the number of distinct documents of one host that hold it. Lines above the host's limit (``LIMIT``
documents, or ``SHARE`` of the host's documents if that is more) are removed, unless they stand in fewer than ``TEXTS``
different texts: what only copies of a few texts share is a matter of dedup, and removing it would take all copies away.
A document that keeps less than ``LEFT`` percent of its words is depleted and rejected. Here a host is the document's
source.

Defined results: a null text is empty and fails the base rules; a null host is the empty host; repeated rows (same id
and text) count as one document and get equal results; different texts of one id, and of none, are documents of their
own; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import table
from tidemark.llm.wordscan import U64, Words, mix, scan, slices, windows

LIMIT, SHARE, TEXTS, LEFT = 50, 0.005, 10, 25
SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
#: A-Z to a-z, digits to 0; separators are dealt with by split.
_NORMAL = bytes.maketrans(bytes(range(65, 91)) + b"123456789", bytes(range(97, 123)) + b"0" * 9)
_WORD = re.compile(rb"[^\x20\x09-\x0D]")

MEASURED = "id long, host string, digest binary, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lines array<struct<line:long,words:long>>"


def repeat_words(words: Words, width: int = 5) -> np.ndarray:
    """For each document, its words in windows of ``width`` words that it holds at least twice."""
    docs, doc = len(words.first) - 1, words.doc()
    n = len(doc) - width + 1
    if n <= 0:
        return np.zeros(docs, np.int64)
    key = mix(windows(words.hashes(), width) + doc[:n].astype(U64) * U64(0x9E3779B97F4A7C15))
    at = np.flatnonzero(doc[:n] == doc[width - 1 :])
    key = key[at]
    order = np.argsort(key)
    ranked = key[order]
    twin = np.zeros(len(key), bool)
    if len(key) > 1:
        same = ranked[1:] == ranked[:-1]
        twin[1:] |= same
        twin[:-1] |= same
    start = at[order[twin]]
    edge = np.zeros(len(doc) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + width, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
    return covered[words.first[1:]] - covered[words.first[:-1]]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            words = scan(part.column("text"))
            head = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
            chars = head[words.end] - head[words.start]
            upto = np.concatenate([[0], np.cumsum(chars)])
            symbols = np.concatenate([[0], np.cumsum(_SYMBOL[words.data])])
            lines, twins, digests = [], [], []
            for a, b in zip(words.text_start.tolist(), words.text_end.tolist()):
                raw = words.data[a:b].tobytes()
                seen: set[bytes] = set()
                again, own = 0, {}
                for line in raw.split(b"\n"):
                    if line in seen:
                        again += 1
                    elif _WORD.search(line):
                        seen.add(line)
                for line in raw.split(b"\n"):
                    parts = line.translate(_NORMAL).split()
                    if parts:
                        key = int.from_bytes(hashlib.blake2b(b" ".join(parts), digest_size=8).digest(), "little", signed=True)
                        own[key] = own.get(key, 0) + len(parts)
                lines.append(list(own.items()))
                twins.append(again)
                digests.append(hashlib.blake2b(raw, digest_size=16).digest())
            counts = np.array([len(x) for x in lines])
            pairs = np.array([p for x in lines for p in x], np.int64).reshape(-1, 2)
            packed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.StructArray.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["line", "words"]))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("host"), pa.array(digests, pa.binary()), pa.array(words.count.astype(np.int64)), pa.array(upto[words.first[1:]] - upto[words.first[:-1]]), pa.array(symbols[words.text_end] - symbols[words.text_start]), pa.array(twins, pa.int64()), pa.array(repeat_words(words)), packed],
                names=["id", "host", "digest", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"],
            )


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limit: int = LIMIT, share: float = SHARE, texts: int = TEXTS, left: int = LEFT) -> DataFrame:
    """Every row's measures, base verdict, removed words and verdict."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(host_col, F.lit("")).alias("host"), F.col(text_col).alias("text"))
    measured = table(rows.mapInArrow(_measure, MEASURED), "rules-measured")
    document = F.xxhash64("id", "digest").alias("document")
    lines = measured.select(document, "host", "digest", F.explode("lines").alias("x")).select("document", "host", "digest", "x.line", "x.words")
    known = measured.select("host", document).groupBy("host").agg(F.count_distinct("document").alias("documents"))
    often = lines.groupBy("host", "line").agg(F.count_distinct("document").alias("n"), F.count_distinct("digest").alias("texts")).filter((F.col("n") > limit) & (F.col("texts") >= texts))
    often = often.join(known, "host").filter(F.col("n") > F.greatest(F.lit(float(limit)), F.col("documents") * share)).select("host", "line")
    # Rows of one text and host have the same lines, so one sum for each text and host stands for all of them.
    removed = lines.select("host", "digest", "line", "words").distinct().join(often, ["host", "line"]).groupBy("host", "digest").agg(F.sum("words").alias("removed"))
    out = measured.drop("lines").join(removed, ["host", "digest"], "left").withColumn("n_removed", F.coalesce("removed", F.lit(0)).cast("long"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    depleted = (F.col("n_removed") > 0) & (100 * (F.col("n_words") - F.col("n_removed")) < left * F.col("n_words"))
    out = out.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed", "kept")


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = rf"""with d as (select doc_id, coalesce(source, '') host, coalesce(text, '') t from documents),
    w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') ws, regexp_split_to_array(t, '\n') ls from d),
    b as (select doc_id, host, t, cast(len(ws) as bigint) n_words, cast(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) as bigint) word_chars,
        cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) n_symbols, cast(len(list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
        - len(list_distinct(list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) as bigint) n_dup_lines from w),
    g as (select doc_id, i, list_slice(ws, i, i + 4) k from (select doc_id, ws, unnest(range(1, cast(len(ws) - 3 as bigint))) i from w where len(ws) >= 5)),
    r as (select doc_id, cast(count(distinct p) as bigint) n_repeat_words from (select doc_id, unnest(range(i, i + 5)) p from
        (select doc_id, i, count(*) over (partition by doc_id, k) n from g) where n > 1) group by 1),
    l as (select host, md5(t) h, x, sum(len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))) n from (select distinct on (host, t) host, t,
        unnest(ls) y from w), lateral (select trim(regexp_replace(regexp_replace(translate(y, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g'),
        '[\x20\x09-\x0D]+', ' ', 'g')) x) where x <> '' group by all),
    c as (select host, md5(t) h, count(distinct coalesce(cast(doc_id as varchar), '')) copies from d group by all),
    o as (select host, x from (select host, x, sum(copies) n, count(*) texts from l join c using (host, h) group by all) join (select host, sum(copies) documents from c group by 1) using (host)
        where n > greatest({float(LIMIT)}, documents * {SHARE}) and texts >= {TEXTS}),
    m as (select host, h, cast(sum(n) as bigint) removed from l join o using (host, x) group by all)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) n_repeat_words, n_words < 10 or 100 * coalesce(n_repeat_words, 0) > 20 * n_words base_failed,
        coalesce(removed, 0) n_removed, not (n_words < 10 or 100 * coalesce(n_repeat_words, 0) > 20 * n_words) and not (coalesce(removed, 0) > 0 and 100 * (n_words - coalesce(removed, 0)) < {LEFT} * n_words) kept
    from b left join r using (doc_id) left join m on m.host = b.host and m.h = md5(b.t)"""
