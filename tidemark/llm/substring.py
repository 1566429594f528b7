"""Substring dedup by Relative Lempel-Ziv parsing.

Every document is indexed and parsed. A *reference block* is the text around one anchor: of the 8-word grams
in a 20-word window the one with the least hash (the leftmost of equals) is the window's anchor, and the windows
that share an anchor span its block of 20 to 32 words. Anchors depend on the window's words only, so equal
windows have equal anchors and meet in the index under the anchor's hash.

1. Parse: a block that equals an earlier block of the index is a copy of the earliest one: (place, reference
   document, place there, length).
2. Boundaries: where blocks of one anchor differ, a factor ends or begins inside the block. There, and only
   there, the block's windows are looked up one by one against those of the other differing blocks.
3. Copies of one alignment (same reference, same shift) that touch are extended to one factor, and the document is
   parsed greedily from the left: of the factors that cover a place the one that reaches furthest is taken. Every
   factor comes from copies of at least 20 words; each document drops the words that its factors cover.

The index is dealt by ranges of (anchor hash, block hash) and streamed in order: no group is collected, and the blocks
of one common anchor fall into many ranges; blocks at a range's ends count as boundaries, which costs a lookup and loses
nothing. Each slice of documents sends one row for equal blocks, the earliest, as later ones are known to repeat it; so a
passage that a third of all documents hold sends a row for each slice, not for each document. Places count as equal when
two 64-bit hashes of their words agree; words themselves are hashed to 64 bits.

Defined results: null and empty texts have no words and lose none; texts under 20 words lose none; repeated
rows (same id and text) count as one document and get equal results; different texts of one id are documents of their
own, in the order of a hash of the text; a null id counts as smaller than any other; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import drop, table
from tidemark.llm.wordscan import U64, Words, mix, scan, slices, windows

WINDOW, GRAM = 20, 8
_BASES = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
#: A span is packed as start * 64 + words; a block has at most 32 words.
PACK = 64
#: Bytes of text that are hashed at once, which takes many times as much memory; and rows sent to Spark at once.
PART, SENT = 2 << 20, 1 << 16
NO_ID = -(1 << 63)


def _powers(base: U64, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Ranges:
    """Hashes of any ranges of words of one slice."""

    def __init__(self, hashes: np.ndarray, base: int = _BASES[0]) -> None:
        n = len(hashes)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(hashes * _powers(U64(base), n), out=self.sums[1:])
        self.back = _powers(U64(pow(base, -1, 1 << 64)), n + 1)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.sums[b] - self.sums[a]) * self.back[a] + (b - a).astype(U64) * U64(0x9E3779B97F4A7C15))


def _blocks(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, last window) of every block, as word positions of the slice."""
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3
    valid = doc[:n] == doc[WINDOW - 1 :]
    grams = windows(hashes, GRAM)
    at = np.empty(n, np.int64)
    least = grams[:n].copy()
    at[:] = np.arange(n)
    for i in range(1, WINDOW - GRAM + 1):
        other = grams[i : i + n]
        better = other < least
        np.copyto(least, other, where=better)
        np.copyto(at, np.arange(i, i + n), where=better)
    start = np.flatnonzero(valid)
    anchor = at[start]
    if not len(start):
        return (np.zeros(0, np.int64),) * 3
    # Windows of one block follow each other: a block ends where the anchor or the document changes.
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (np.diff(start) != 1) | (doc[start[1:]] != doc[start[:-1]])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(start)]]) - 1
    return anchor[first], start[first], start[last]


def _batch(names: str, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64) if x.dtype == U64 else x) for x in columns], names=names.split())


def _rows(part: pa.RecordBatch, own: np.ndarray, key: np.ndarray, block: np.ndarray, span: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One candidate row (kind 0) for equal blocks of a slice, the earliest; the others copy it (kind 1)."""
    doc, dig = np.asarray(part.column("doc")), np.asarray(part.column("dig"))
    turn = np.lexsort((dig, doc))
    new = np.ones(len(turn), bool)
    new[1:] = (np.diff(doc[turn]) != 0) | (np.diff(dig[turn]) != 0)
    rank = np.empty(len(turn), np.int64)
    rank[turn] = np.cumsum(new)  # equal for repeated rows
    order = np.lexsort((span, rank[own], block, key))
    key, block, own, span = key[order], block[order], own[order], span[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (block[1:] != block[:-1])
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(new) else new.astype(int)
    start = span // PACK
    later = (rank[own] != rank[own[head]]) | (start != start[head])
    for kind, rows in ((0, new), (1, later)):
        whole = np.flatnonzero(rows)
        for a in range(0, len(whole), SENT):
            rows = whole[a : a + SENT]
            none = np.zeros(len(rows), np.int64)
            hashed = (key[rows], block[rows]) if kind == 0 else (none, none)
            ref = (none, none) if kind == 0 else (doc[own[head[rows]]], start[head[rows]])
            yield _batch("kind key block doc dig span ref_doc ref_start", np.full(len(rows), kind, np.int32), *hashed, doc[own[rows]], dig[own[rows]], span[rows], *ref)


ROWS = "kind int, key long, block long, doc long, dig long, span long, ref_doc long, ref_start long"
COPIES = "kind int, doc long, dig long, span long, ref_doc long, ref_start long"


def _sent(batches: Iterator[pa.RecordBatch], find: Callable) -> Iterator[pa.RecordBatch]:
    """The rows of whole slices, each searched in parts of ``PART`` bytes."""
    for batch in batches:
        for whole in slices(batch):
            found, row = [], 0
            for part in slices(whole, most=PART):
                own, *columns = find(part, scan(part.column("text")))
                found.append((own + row, *columns))
                row += part.num_rows
            yield from _rows(whole, *map(np.concatenate, zip(*found)))


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of every document."""

    def find(part: pa.RecordBatch, words: Words) -> tuple[np.ndarray, ...]:
        hashes, doc = words.hashes(), words.doc()
        anchor, lo, hi = _blocks(hashes, doc)
        grams = windows(hashes, GRAM)
        block = mix(Ranges(hashes)(lo, hi + WINDOW) + (anchor - lo).astype(U64))
        own = doc[lo]
        return own, grams[anchor], block, (lo - words.first[own]) * PACK + hi - lo + WINDOW

    return _sent(batches, find)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The single windows of given blocks, keyed by two hashes."""

    def find(part: pa.RecordBatch, words: Words) -> tuple[np.ndarray, ...]:
        spans = part.column("spans")
        counts = np.diff(np.asarray(spans.offsets))
        packed = np.asarray(spans.flatten())
        own = np.repeat(np.arange(part.num_rows), counts)
        start, extra = packed // PACK, packed % PACK - WINDOW + 1
        step = np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra)
        own, start = np.repeat(own, extra), np.repeat(start, extra) + step
        at, hashes = words.first[own] + start, words.hashes()
        return own, *(Ranges(hashes, base)(at, at + WINDOW) for base in _BASES), start * PACK + WINDOW

    return _sent(batches, find)


def _parse(edges: bool) -> Callable:
    """Walk rows in the order (key, block, doc, dig, span). A row after the first of its block copies that (kind 1);
    with ``edges``, the first rows of blocks whose key has other blocks too, or may have them in another partition, are
    boundaries (kind 2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, ...] | None = None  # key and block walked last; doc, dig and start of its first row
        held: tuple[int, ...] | None = None  # doc, dig and span of the first row of a key, while the key has one block
        border = None  # the partition's first key
        for batch in batches:
            if not batch.num_rows:
                continue
            key, block, doc, dig, span = (np.asarray(batch.column(i)) for i in range(5))
            border = int(key[0]) if border is None else border
            start = span // PACK
            new_key, new = np.ones(len(key), bool), np.ones(len(key), bool)
            new_key[1:] = key[1:] != key[:-1]
            new[1:] = new_key[1:] | (block[1:] != block[:-1])
            same_key = last is not None and last[0] == key[0]
            goes_on = same_key and last[1] == block[0]
            new_key[0], new[0] = not same_key, not goes_on
            firsts = np.flatnonzero(new)
            head = np.cumsum(new)
            head_doc, head_dig, head_start = (np.concatenate([[last[i + 2] if last else 0], x[firsts]])[head] for i, x in enumerate((doc, dig, start)))
            copies = np.flatnonzero(~new & ((doc != head_doc) | (dig != head_dig) | (start != head_start)))
            if len(copies):
                yield _found(1, doc[copies], dig[copies], span[copies], head_doc[copies], head_start[copies])
            if edges:
                # Of the first rows: those that open a key wait for another block of it.
                opens = new_key[firsts]
                several = ~opens | (key[firsts] == border)
                several[:-1] |= ~opens[1:]
                if held is not None and len(firsts):
                    if not opens[0]:
                        yield _found(2, *(np.array([x]) for x in held))
                    held = None
                if len(firsts):
                    end = firsts[-1]
                    held = None if several[-1] else (int(doc[end]), int(dig[end]), int(span[end]))
                if several.any():
                    rows = firsts[several]
                    yield _found(2, doc[rows], dig[rows], span[rows])
            last = (int(key[-1]), int(block[-1]), int(head_doc[-1]), int(head_dig[-1]), int(head_start[-1]))
        if held is not None:
            yield _found(2, *(np.array([x]) for x in held))

    return run


def _found(kind: int, doc: np.ndarray, dig: np.ndarray, span: np.ndarray, *ref: np.ndarray) -> pa.RecordBatch:
    none = np.zeros(len(doc), np.int64)
    return _batch("kind doc dig span ref_doc ref_start", np.full(len(doc), kind, np.int32), doc, dig, span, *(ref or (none, none)))


def _walk(rows: DataFrame, edges: bool, name: str) -> DataFrame:
    dealt = rows.filter("kind = 0").select("key", "block", "doc", "dig", "span")
    # Without a number, so that Spark may merge small ranges, which gives fewer files.
    dealt = dealt.repartitionByRange("key", "block").sortWithinPartitions("key", "block", "doc", "dig", "span")
    return table(dealt.mapInArrow(_parse(edges), COPIES), name)


def factors(own: np.ndarray, start: np.ndarray, size: np.ndarray, ref: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """The greedy parse of documents ``own`` from their copies of ``size`` words at ``start``, found in document ``ref``
    at ``at``: (own, start, words, ref, place there), in order, not overlapping."""
    shift = at - start
    order = np.lexsort((start, shift, ref, own))
    own, start, size, ref, shift = own[order], start[order], size[order], ref[order], shift[order]
    lane = np.cumsum(np.concatenate([[0], (np.diff(own) != 0) | (np.diff(ref) != 0) | (np.diff(shift) != 0)]).astype(np.int64)) if len(own) else own
    # How far an alignment has come: lanes follow each other, each above all places of the one before.
    wide = int((start + size).max()) + 1 if len(own) else 1
    reach = np.maximum.accumulate(lane * wide + start + size) if len(own) else lane
    new = np.ones(len(own), bool)
    new[1:] = (lane[1:] != lane[:-1]) | (lane[1:] * wide + start[1:] > reach[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(own)]]) - 1 if len(first) else first
    ends = reach[last] - lane[last] * wide
    runs = sorted(zip(own[first].tolist(), start[first].tolist(), ends.tolist(), ref[first].tolist(), shift[first].tolist()))
    out: list[tuple[int, int, int, int, int]] = []
    i, doc, upto = 0, -1, 0
    while i < len(runs):
        if runs[i][0] != doc:
            doc, upto = runs[i][0], 0
        best, here = None, max(upto, runs[i][1])
        while i < len(runs) and runs[i][0] == doc and runs[i][1] <= here:
            if runs[i][2] > here and (best is None or runs[i][2] > best[2]):
                best = runs[i]
            i += 1
        if best is not None:
            out.append((doc, here, best[2] - here, best[3], here + best[4]))
            upto = best[2]
    return out


def _cut(kept_text: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=PART):
                copies = part.column("copies")
                counts = np.diff(np.asarray(copies.offsets))
                flat = copies.flatten()
                span, ref, at = (np.asarray(flat.field(name)) for name in ("span", "ref_doc", "ref_start"))
                found: list[list[tuple[int, int, int, int]]] = [[] for _ in range(part.num_rows)]
                for own, *factor in factors(np.repeat(np.arange(part.num_rows), counts), span // PACK, span % PACK, ref, at):
                    found[own].append(tuple(factor))
                n_words, n_removed, digests, texts = [], [], [], []
                for raw, own in zip(part.column("text").cast(pa.binary()), found):
                    words = (raw.as_py() or b"").split()
                    kept = words
                    if own:
                        keep = np.ones(len(words), bool)
                        for a, n, *_ in own:
                            keep[a : a + n] = False
                        kept = list(compress(words, keep.tolist()))
                    joined = b" ".join(kept)
                    n_words.append(len(words))
                    n_removed.append(len(words) - len(kept))
                    digests.append(hashlib.sha256(joined).hexdigest())
                    if kept_text:
                        texts.append(joined)
                rows = [[{"start": a, "words": n, "ref": None if r == NO_ID else r, "ref_start": x} for a, n, r, x in own] for own in found]
                columns = [part.column("id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string()), pa.array(rows, _FACTORS)]
                names = ["id", "n_words", "n_removed", "kept_sha256", "factors"]
                if kept_text:
                    columns, names = [*columns, pa.array(texts, pa.binary()).cast(pa.string())], [*names, "kept_text"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


_FACTORS = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "words", "ref", "ref_start")]))
CUT = "id long, n_words long, n_removed long, kept_sha256 string, factors array<struct<start:long,words:long,ref:long,ref_start:long>>"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kept_text: bool = True) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, factors[, kept_text]) of every row. A factor: its first word, words, the
    reference document's id and the first word there."""
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), doc.alias("doc"), F.xxhash64(text_col).alias("dig"), F.col(text_col).alias("text"))
    keyed = texts.select("doc", "dig", "text")
    blocks = table(keyed.mapInArrow(_index, ROWS), "rlz-blocks")
    parsed = _walk(blocks, True, "rlz-parsed")
    edges = parsed.filter("kind = 2").groupBy("doc", "dig").agg(F.collect_list("span").alias("spans"))
    # Repeated rows: their windows are equal and meet again below.
    single = table(keyed.join(edges, ["doc", "dig"]).select("doc", "dig", "text", "spans").mapInArrow(_windows, ROWS), "rlz-windows")
    matched = _walk(single, False, "rlz-matched")
    copies = reduce(DataFrame.union, [x.filter("kind = 1").select("doc", "dig", "span", "ref_doc", "ref_start") for x in (blocks, parsed, single, matched)])
    copies = table(copies.groupBy("doc", "dig").agg(F.collect_list(F.struct("span", "ref_doc", "ref_start")).alias("copies")), "rlz-copies")
    drop(blocks, parsed, single, matched)
    none = F.array().cast("array<struct<span:long,ref_doc:long,ref_start:long>>")
    cut = texts.join(copies, ["doc", "dig"], "left").select("id", "text", F.coalesce("copies", none).alias("copies"))
    return cut.mapInArrow(_cut(kept_text), CUT + (", kept_text string" if kept_text else "")).withColumnRenamed("id", id_col)


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: every document's words, removed words and digest of what is kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs, kept_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


#: The contract's rows by comparing all windows.
ORACLE = r"""with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
    g as (select doc_id, i, md5(array_to_string(list_slice(w, i, i + 19), ' ')) k from (select doc_id, w, unnest(range(1, cast(len(w) - 18 as bigint))) i from d where len(w) >= 20)),
    f as (select doc_id, i, row_number() over (partition by k order by doc_id, i) r from g),
    c as (select distinct doc_id, p from (select doc_id, unnest(range(i, i + 20)) p from f where r > 1)),
    a as (select doc_id, p, w[p] x from (select doc_id, w, unnest(range(1, cast(len(w) + 1 as bigint))) p from d)),
    k as (select a.doc_id, count(*) n, string_agg(x, ' ' order by a.p) t from a anti join c on c.doc_id = a.doc_id and c.p = a.p group by 1)
    select d.doc_id, cast(len(w) as bigint) n_words, cast(len(w) - coalesce(n, 0) as bigint) n_removed, sha256(coalesce(t, '')) kept_sha256 from d left join k using (doc_id)"""
