"""Scans of whole texts on Arrow batches: the same results as their patterns in Java, at a small part of the time.

Java's Unicode classes and ``translate`` cost about a microsecond for each character; here a character is visited once, in
numpy or in C string methods.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRINGS = T.ArrayType(T.StringType())
#: Unicode's white space, as Java's Unicode class has it. Python's own has four separators more.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_RUNS = re.compile(f"[{SPACES}]+")
_SEPARATORS = "\x1c\x1d\x1e\x1f"


def folds() -> tuple[str, str]:
    """Latin letters with marks and the letters left of them, by Unicode decomposition."""
    pairs = []
    for code in range(0x00C0, 0x0250):
        ch = chr(code)
        base = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x)).lower()
        if len(base) == 1 and base.isascii() and base != ch:
            pairs.append((ch, base))
    return "".join(p[0] for p in pairs), "".join(p[1] for p in pairs)


def _tables(fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """What stays of each byte of ASCII and of each character of two bytes: one of a-z, 0-9, ', or 0."""
    marks = dict(zip(*folds())) if fold else {}
    kept = [[x for x in marks.get(chr(code), chr(code)).lower() if x.isascii() and (x.isalnum() or x == "'")] for code in range(0x800)]
    codes = np.array([ord(k[0]) if k else 0 for k in kept], np.uint8)
    return np.concatenate([codes[:0x80], np.zeros(0x80, np.uint8)]), codes


_TABLES = {fold: _tables(fold) for fold in (True, False)}


def kept(data: np.ndarray, fold: bool) -> np.ndarray:
    """For each byte of UTF-8 the byte that ``norm`` (``norm_ascii`` without ``fold``) keeps of its character, else 0."""
    one, two = _TABLES[fold]
    out = one[data]
    if len(data) and data.max() >= 0x80:
        at = np.flatnonzero((data >= 0xC2) & (data <= 0xDF))
        out[at] = two[(data[at] & 0x1F).astype(np.uint16) << 6 | (data[at + 1] & 0x3F)]
        at = np.flatnonzero(data[:-2] == 0xE2)
        out[at[(data[at + 1] == 0x84) & (data[at + 2] == 0xAA)]] = ord("k")  # the Kelvin sign, whose lower case is k
    return out


def _normal(texts: pa.Array, fold: bool) -> pa.Array:
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body else np.zeros(0, np.uint8)
    out = kept(data, fold)
    stays = out != 0
    upto = np.concatenate([[0], np.cumsum(stays)])[offsets - offsets[0]]
    full = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(np.ascontiguousarray(upto, np.int64)), pa.py_buffer(out[stays])])
    return (pc.if_else(texts.is_valid(), full, None) if texts.null_count else full).cast(pa.string())


def collapse(text: str) -> str:
    """White space runs to one space, none at the ends."""
    if any(c in text for c in _SEPARATORS):
        return _RUNS.sub(" ", text).strip(" ")
    return " ".join(text.split())


def split_en(text: str) -> list[str]:
    marked = collapse(text).replace(". ", ".\n").replace("! ", "!\n").replace("? ", "?\n")
    return [s for s in marked.split("\n") if s]


def split_zh(text: str) -> list[str]:
    marked = collapse(text).replace("。", "。\n").replace("？", "？\n").replace("！", "！\n")
    return [s for p in marked.split("\n") if (s := p.strip(" "))]


def lines(text: bytes, size: int) -> list[bytes]:
    """Lines of ``size`` words between ASCII white space."""
    w = text.split()
    return [b" ".join(w[i : i + size]) for i in range(0, len(w), size)]


@F.arrow_udf(T.StringType())
def norm(text: pa.Array) -> pa.Array:
    """Letters without marks, lower-cased; only a-z, 0-9 and the apostrophe stay."""
    return _normal(text, True)


@F.arrow_udf(T.StringType())
def norm_ascii(text: pa.Array) -> pa.Array:
    """Like ``norm`` without folding marks: marked letters go."""
    return _normal(text, False)


@F.arrow_udf(STRINGS)
def sentences_en(text: pa.Array) -> pa.Array:
    return pa.array([None if t is None else split_en(t) for t in text.to_pylist()], pa.list_(pa.string()))


@F.arrow_udf(STRINGS)
def sentences_zh(text: pa.Array) -> pa.Array:
    return pa.array([None if t is None else split_zh(t) for t in text.to_pylist()], pa.list_(pa.string()))


@F.arrow_udf(STRINGS)
def word_lines(text: pa.Array, size: pa.Array) -> pa.Array:
    return pa.array([None if t is None else lines(t, n) for t, n in zip(text.cast(pa.binary()).to_pylist(), size.to_pylist())], pa.list_(pa.string()))


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("item", T.StringType()), T.StructField("d", T.LongType())])))
def bag_changes(a: pa.Array, b: pa.Array) -> pa.Array:
    """Items that one list of a row has more often, with how many more the first one has."""
    part = 512  # rows whose items are sorted at once
    return pa.concat_arrays([_changes(a.slice(i, part), b.slice(i, part)) for i in range(0, len(a), part)] or [_changes(a, b)])


def _changes(a: pa.Array, b: pa.Array) -> pa.Array:
    sizes = [pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False) for x in (a, b)]
    items = pa.concat_arrays([a.flatten(), b.flatten()]).dictionary_encode(null_encoding="encode")
    row = np.concatenate([np.repeat(np.arange(len(a)), n) for n in sizes])
    key, at = np.unique(row * max(1, len(items.dictionary)) + items.indices.to_numpy(zero_copy_only=False), return_inverse=True)
    d = np.bincount(at, weights=np.repeat([1, -1], [sizes[0].sum(), sizes[1].sum()]), minlength=len(key)).astype(np.int64)
    key, d = key[d != 0], d[d != 0]
    row, code = np.divmod(key, max(1, len(items.dictionary)))
    changed = pa.StructArray.from_arrays([items.dictionary.take(pa.array(code)), pa.array(d)], ["item", "d"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(a) + 1)), pa.int32()), changed)
