"""Near-duplicate grouping: SuperMinHash, banding, verification on full sets, union-find.

1. Each document becomes its set of distinct 5-word shingles, a digest of the set, a signature of 128 slots and
   32 band hashes. Documents of one digest are one *class* from then on, so exact copies are never paired.
2. In each band bucket every class is paired with the one that meets most members over all its buckets, as the text
   does that the others were copied from; pairs whose sizes or signatures rule out the threshold go; the rest are
   confirmed on full sets, and components are formed.
3. A star can miss links between its leaves. So in each bucket that still holds several components, members of
   different components are compared by signature, in blocks; those that may link stay in their block, once each, and
   are confirmed on full sets there, a pair in the least bucket that it shares. No pair list is ever made: a block
   yields at most its own members, then links between components.

A pair at the threshold shares none of its 32 bands with probability (1 - 0.75^4)^32 = 5e-6; the signature
filter (``LEAST`` of 128 equal slots) lets a pair at the threshold go with at most 5e-6 (binomial), and the filter on one
bit of each slot before it (``BITS`` of 128) with 1e-6.

Defined results: null and empty texts have empty sets and stay alone; shorter texts than a shingle have their
whole word sequence as their one shingle; repeated rows share a class; a null id is never a component's id
unless nothing else is in it; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import UnionFind, components
from tidemark.llm.runtime import drop, row_key, table
from tidemark.llm.superminhash import SLOTS, bands, overlap, shingles, signatures
from tidemark.llm.wordscan import scan, slices

WIDTH, PERCENT, ROWS = 5, 75, 4
#: Equal slots of 128 under which a pair at 0.75 (96 expected, deviation at most 4.9) need not be looked at, and equal
#: lowest bits of slots (112 expected, deviation 3.7).
LEAST, BITS = 74, 93
#: Bytes of text that are signed at once: the arrays of words and shingles take some 13 times as much.
PART = 2 << 20
#: Members of one block of a bucket; ids that a broadcast filter may hold.
BLOCK, BROADCAST = 2048, 1_000_000

SIGNED = "id long, n long, digest binary, sig binary, bands array<long>"
SETS = "id long, n long, sig binary, bands array<long>, items binary"
FLAGGED = "key long, cell long, id long, comp long, outer boolean"


def _fixed(values: np.ndarray, width: int) -> pa.Array:
    """Rows of a byte matrix as a binary column."""
    offsets = np.arange(0, len(values) * width + 1, width, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def _lists(sig: np.ndarray) -> pa.Array:
    """Band hashes of signatures as a list column."""
    keys = bands(sig, ROWS).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)), pa.array(keys.ravel()))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, most=PART):
            items, bound = shingles(scan(part.column("text")), WIDTH)
            sig = signatures(items, bound)
            digests = [hashlib.blake2b(items[a:b].tobytes(), digest_size=16).digest() for a, b in zip(bound[:-1].tolist(), bound[1:].tolist())]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.diff(bound)), pa.array(digests, pa.binary()), _fixed((sig & np.uint64(255)).astype(np.uint8), SLOTS), _lists(sig)], names=["id", "n", "digest", "sig", "bands"])


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, most=PART):
            items, bound = shingles(scan(part.column("text")), WIDTH)
            sig = signatures(items, bound)
            blobs = [items[a:b].tobytes() for a, b in zip(bound[:-1].tolist(), bound[1:].tolist())]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.diff(bound)), _fixed((sig & np.uint64(255)).astype(np.uint8), SLOTS), _lists(sig), pa.array(blobs, pa.binary())], names=["id", "n", "sig", "bands", "items"])


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), -1)


def linked(a: bytes, b: bytes, percent: int = PERCENT) -> bool:
    """Whether two full sets meet the threshold."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = overlap(x, y)
    return 100 * both >= percent * (len(x) + len(y) - both)


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs (a, b, na, nb, sa, sb), those that sizes and signatures let pass."""
    for batch in batches:
        pdf = batch.to_pandas()
        if len(pdf):
            equal = (_matrix(pdf["sa"]) == _matrix(pdf["sb"])).sum(axis=1)
            sizes = 100 * np.minimum(pdf["na"], pdf["nb"]) >= PERCENT * np.maximum(pdf["na"], pdf["nb"])
            yield pa.RecordBatch.from_pandas(pdf.loc[(equal >= LEAST) & sizes, ["a", "b"]], preserve_index=False)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column("ia").to_pylist(), batch.column("ib").to_pylist()
        keep = pa.array([linked(x, y) for x, y in zip(a, b)], pa.bool_())
        yield batch.select(["a", "b"]).filter(keep)


def _bits(sig: np.ndarray) -> np.ndarray:
    """The lowest bit of every slot, 64 to a word."""
    return np.packbits(sig & 1, axis=1).view(np.uint64)


#: Pairs compared at once.
PAIRS = 1 << 19


def _pairs(group: np.ndarray, outer: np.ndarray, comp: np.ndarray, n: np.ndarray, sig: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of rows in groups that follow each other: outer rows and rows of other components in their group that sizes and
    signatures let pass."""
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[start, len(group)])
    lane = np.cumsum(np.r_[False, group[1:] != group[:-1]])
    rows = np.flatnonzero(outer)
    width = size[lane[rows]]
    bits = _bits(sig)
    upto = np.cumsum(width)
    a = 0
    while a < len(rows):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + PAIRS, side="right")))
        w = width[a:b]
        i = np.repeat(rows[a:b], w)
        j = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w) + np.repeat(start[lane[rows[a:b]]], w)
        equal = 128 - np.bitwise_count(bits[i, 0] ^ bits[j, 0]).astype(np.int16) - np.bitwise_count(bits[i, 1] ^ bits[j, 1])
        some = np.flatnonzero((equal >= BITS) & (comp[i] != comp[j]))
        i, j = i[some], j[some]
        some = np.flatnonzero(100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j]))
        for c in range(0, len(some), 1 << 16):
            x, y = i[some[c : c + (1 << 16)]], j[some[c : c + (1 << 16)]]
            near = (sig[x] == sig[y]).sum(axis=1) >= LEAST
            yield x[near], y[near]
        a = b


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of the cells of buckets that may link to another component: (comp, outer, id) with the component whose
    members they are compared with. Rows come ordered by cell; a cell has at most two blocks."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        group = np.asarray(batch.column("cell"))
        last = int(np.searchsorted(group, group[-1]))  # the last cell may go on in the next batch
        if last or held and held[-1].column("cell")[0].as_py() != group[0]:
            held.append(batch.slice(0, last))
            yield from _compared(held)
            held = []
        held.append(batch.slice(last))
    yield from _compared(held)


def _compared(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches([p for p in parts if p.num_rows]) if any(p.num_rows for p in parts) else None
    if rows is None:
        return
    group, ids, comp, size, outer, n = (rows.column(x).to_numpy() for x in ("cell", "id", "comp", "size", "outer", "n"))
    sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint8).reshape(len(ids), -1)
    found = [np.zeros((0, 3), np.int64)]
    for i, j in _pairs(group, outer, comp, n, sig):
        # The larger component (then the smaller id) is the one compared with; the other side comes to it.
        first = (size[i] > size[j]) | ((size[i] == size[j]) & (comp[i] < comp[j]))
        home, guest = np.where(first, i, j), np.where(first, j, i)
        for side, x in ((0, home), (1, guest)):
            found.append(np.unique(np.stack([comp[home], np.full(len(x), side), ids[x]], axis=1), axis=0))
    out = np.unique(np.concatenate(found), axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1] == 1), pa.array(out[:, 2])], names=["comp", "outer", "id"])


def _flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of cells that are suspects, each once: never more than came in, however many components they meet."""
    kept: list[pa.RecordBatch] = []
    start = 0  # number of the first row kept

    def numbered() -> Iterator[pa.RecordBatch]:
        upto = 0
        for batch in batches:
            if batch.num_rows:
                kept.append(batch.select(["key", "cell", "id", "comp", "outer"]))
                numbers = pa.array(np.arange(upto, upto + batch.num_rows))
                upto += batch.num_rows
                yield batch.set_column(batch.schema.get_field_index("id"), "id", numbers)

    for found in _suspects(numbered()):
        rows = pa.Table.from_batches(kept)
        yield from rows.take(np.unique(found.column("id")) - start).to_batches()
        start += rows.num_rows - kept[-1].num_rows
        del kept[:-1]  # the last cell of the last batch may go on


def _links(pdf: pd.DataFrame) -> pd.DataFrame:
    """Confirmed links between the components of one cell, no more than join them. A pair is judged in the least of the
    buckets that it shares."""
    pdf = pdf.sort_values(["key", "id"], ignore_index=True)
    key, ids, comp, outer, n, items = (pdf[x].to_numpy() for x in ("key", "id", "comp", "outer", "n", "items"))
    keys, most = np.stack(pdf["bands"]), np.iinfo(np.int64).max
    sets, out = UnionFind(), []
    for i, j in _pairs(key, outer, comp, n, _matrix(pdf["sig"])):
        own = (~outer[j] | (i < j)) & (np.where(keys[i] == keys[j], keys[i], most).min(axis=1, initial=most) == key[i])
        for a, b in zip(i[own].tolist(), j[own].tolist()):
            x, y = int(comp[a]), int(comp[b])
            if sets.find(x) != sets.find(y) and linked(items[a], items[b]):
                sets.union(x, y)
                out.append((ids[a], ids[b]))
    return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)


def _sets(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """Sets of the classes ``ids``, one each: a broadcast filter while there are few, else a join by id."""
    count = ids.count()
    chosen = texts.join(F.broadcast(ids) if count <= BROADCAST else ids, "id", "left_semi")
    sets = table(chosen.mapInArrow(_gather, SETS), "dup-sets")
    return sets if sets.count() == count else sets.dropDuplicates(["id"])  # repeated rows


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = table(texts.mapInArrow(_sign, SIGNED), "dup-signed")
    classes = signed.filter("n > 0 and id is not null").groupBy("digest").agg(F.min(F.struct("id", "n", "sig", "bands")).alias("x"))
    classes = table(classes.select("digest", "x.*"), "dup-classes")
    rows = classes.select("id", F.posexplode("bands").alias("band", "key")).select("id", "key")
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = table(rows.join(sizes, "key"), "dup-members")
    # Stars.
    met = members.groupBy("id").agg(F.sum("members").alias("met"))
    firsts = members.join(met, "id").groupBy("key").agg(F.max(F.struct("met", (-F.col("id")).alias("m")))["m"].alias("m")).select("key", (-F.col("m")).alias("first"))
    pairs = members.join(firsts, "key").filter("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b")).distinct()
    slim = classes.select("id", "n", "sig")
    pairs = pairs.join(slim.withColumnsRenamed({"id": "a", "n": "na", "sig": "sa"}), "a").join(slim.withColumnsRenamed({"id": "b", "n": "nb", "sig": "sb"}), "b")
    pairs = table(pairs.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_plausible, "a long, b long"), "dup-pairs")
    sets = _sets(texts, pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    links = _confirmed(pairs, sets)
    roots = components(links)
    # Buckets that still hold several components.
    homes = members.join(roots.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("root", "id").alias("comp"))
    open_ = homes.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key")
    homes = table(homes.join(open_, "key"), "dup-open")
    parts = homes.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
    most = parts.groupBy("key").agg(F.max(F.struct("c", (-F.col("comp")).alias("m"))).alias("x"), F.sum("c").alias("all"))
    most = most.select("key", (-F.col("x.m")).alias("main"), F.ceil(F.col("x.c") / BLOCK).alias("home_blocks"), F.ceil((F.col("all") - F.col("x.c")) / BLOCK).alias("outer_blocks"))
    blocks = homes.join(most, "key").withColumn("outer", F.col("comp") != F.col("main"))
    hashed = F.xxhash64("id")
    # A home block meets each outer block; outer blocks meet each other too, as members of the pair's first.
    own = F.when(F.col("outer"), F.pmod(hashed, F.col("outer_blocks"))).otherwise(F.pmod(hashed, F.col("home_blocks")))
    blocks = blocks.withColumn("own", own)
    cells = F.when(~F.col("outer"), F.transform(F.sequence(F.lit(0), F.col("outer_blocks") - 1), lambda j: F.struct(F.lit("h").alias("kind"), F.col("own").cast("long").alias("x"), j.cast("long").alias("y"))))
    to_home = F.transform(F.sequence(F.lit(0), F.col("home_blocks") - 1), lambda i: F.struct(F.lit("h").alias("kind"), i.cast("long").alias("x"), F.col("own").cast("long").alias("y")))
    to_outer = F.transform(F.filter(F.sequence(F.lit(0), F.col("outer_blocks") - 1), lambda j: j != F.col("own")), lambda j: F.struct(F.lit("o").alias("kind"), F.least(j, F.col("own")).cast("long").alias("x"), F.greatest(j, F.col("own")).cast("long").alias("y")))
    blocks = blocks.withColumn("cell", F.explode(cells.otherwise(F.concat(to_home, to_outer))))
    blocks = blocks.join(slim, "id")
    # Cells that hash alike are compared too, which does no harm. Which of two components is the larger is of no account.
    blocks = blocks.select("key", F.xxhash64("key", "cell").alias("cell"), "id", "comp", F.lit(1).cast("long").alias("size"), "outer", "n", "sig")
    blocks = blocks.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "cell").sortWithinPartitions("cell")
    suspects = table(blocks.mapInArrow(_flagged, FLAGGED), "dup-suspects")
    more_sets = _sets(texts, suspects.select("id").distinct())
    more = suspects.join(more_sets, "id").groupBy("cell").applyInPandas(_links, "a long, b long")
    more = table(more, "dup-more")
    if more.limit(1).count():
        roots = components(links.union(more))
    drop(members, pairs, homes, suspects)
    heads = classes.select("digest", F.col("id").alias("head")).join(roots.withColumnRenamed("node", "head"), "head", "left").select("digest", F.coalesce("root", "head").alias("component"))
    out = signed.select("id", "n", "digest").join(heads, "digest", "left")
    component = F.when(F.col("n") > 0, F.coalesce("component", "id")).otherwise(F.col("id"))
    out = out.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))).withColumnRenamed("id", id_col)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    items = sets.select("id", "items")
    both = pairs.join(items.withColumnsRenamed({"id": "a", "items": "ia"}), "a").join(items.withColumnsRenamed({"id": "b", "items": "ib"}), "b")
    return table(both.select("a", "b", "ia", "ib").mapInArrow(_confirm, "a long, b long"), "dup-links")


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group, that of the least id, and every document without words.

    Rows are grouped by ``row_key``, so different texts of one id, or without an id, are documents of their own.
    """
    rows = docs.select("doc_id", "text", row_key().alias("__row"))
    found = group(rows, "__row").select("__row", "n_shingles", "component_id").distinct()
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row")
    least = found.join(rows.select("__row", "doc_id").distinct(), "__row").groupBy("component_id").agg(F.min(order).alias("x"), F.max("n_shingles").alias("__n"))
    kept = least.select("x.__row", "__n")
    # Of repeated rows one stays; without words, each.
    own = F.when(F.col("__n") > 0, F.lit(-1).cast("long")).otherwise(F.monotonically_increasing_id())
    whole = docs.select(F.struct(*docs.columns).alias("__doc"), row_key().alias("__row"))  # apart from any name
    return whole.join(kept, "__row").withColumn("__own", own).dropDuplicates(["__row", "__own"]).select("__doc.*")


def op8_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: every document's set size, component and whether it stays."""
    return group(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: The contract's rows from all pairs that share a shingle.
ORACLE = r"""with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
    s as (select distinct doc_id, case when len(w) < 5 then array_to_string(w, ' ') else array_to_string(list_slice(w, i, i + 4), ' ') end h
        from (select doc_id, w, unnest(range(1, cast(greatest(len(w) - 3, 2) as bigint))) i from d where len(w) > 0)),
    n as (select doc_id, count(*) n from s group by 1),
    p as (select a.doc_id x, b.doc_id y, count(*) i from s a join s b on a.h = b.h and a.doc_id < b.doc_id group by 1, 2),
    l as (select x, y from p join n a on a.doc_id = x join n b on b.doc_id = y where 100 * i >= 75 * (a.n + b.n - i)),
    e as (select x, y from l union select y, x from l),
    r as (select doc_id, doc_id c from d union select r.doc_id, e.y from r join e on e.x = r.c),
    m as (select doc_id, min(c) component_id from r group by 1)
    select doc_id, coalesce(n, 0) n_shingles, component_id, doc_id = component_id kept from m left join n using (doc_id)"""
