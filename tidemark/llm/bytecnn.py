"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, convolved by learned filters (a row of bytes every ``STRIDE``), rectified and max-pooled over
chunks of ``CHUNK`` bytes that overlap by half and cover the whole text. A document's vector is the mean and the
maximum of its chunks' vectors, and a logistic layer makes it one probability.

The fit uses a bounded sample of labelled documents (``labelled.sample``) and Adam on the driver; scoring runs
over whole texts in blocks of bounded size, so memory does not grow with a text's length.

Defined results: null and empty texts are one chunk of padding and get its score; equal texts get equal scores;
without labelled rows of both classes the network stays as initialised and scores the share of its labels (a
half without any); a null id is not held out; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labelled import held_out, sample
from tidemark.llm.wordscan import slices

EMBED, FILTERS, WIDTH, STRIDE, CHUNK = 8, 32, 8, 2, 512
HALF = CHUNK // 2
STEPS = HALF // STRIDE  # positions in half a chunk
#: Fit: rows of each class, longest text, passes, rows in a batch, rate.
PER_CLASS, LONGEST, EPOCHS, BATCH, RATE = 1500, 6000, 14, 48, 4e-3
#: Share of good documents that scores are calibrated to.
GOOD = 0.85
BLOCK = 256  # half chunks convolved at once


def pack(texts: list[bytes] | list[memoryview]) -> tuple[np.ndarray, np.ndarray]:
    """Texts laid out in whole half chunks, each after zero bytes of the filter's width, so no window sees bytes of
    two texts; and the half chunks where each begins."""
    lengths = np.array([len(t) for t in texts], np.int64)
    halves = (lengths + WIDTH + HALF - 1) // HALF
    first = np.concatenate([[0], np.cumsum(halves)])
    data = np.zeros(int(first[-1]) * HALF + WIDTH, np.uint8)
    for t, at in zip(texts, first[:-1].tolist()):
        data[at * HALF + WIDTH : at * HALF + WIDTH + len(t)] = np.frombuffer(t, np.uint8)
    return data, first


class Network:
    def __init__(self, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.p = {
            "embed": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
            "filters": rng.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "out": rng.normal(0, 0.2, 2 * FILTERS + 1).astype(np.float32),
            "out_bias": np.zeros(1, np.float32),
        }

    def _columns(self, data: np.ndarray, a: int, b: int) -> np.ndarray:
        """Embedded windows of half chunks a to b, a row for each position."""
        part = self.p["embed"][data[a * HALF : b * HALF + WIDTH]]
        n = (b - a) * STEPS
        step = part.strides[0]
        view = np.lib.stride_tricks.as_strided(part, (n, WIDTH * EMBED), (step * STRIDE, part.strides[1]))
        return view

    def halves(self, data: np.ndarray, count: int, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Largest activation of each filter in each half chunk, and the position that has it."""
        out = np.empty((count, FILTERS), np.float32)
        at = np.empty((count, FILTERS), np.int64) if where else None
        for a in range(0, count, BLOCK):
            b = min(count, a + BLOCK)
            acts = (np.ascontiguousarray(self._columns(data, a, b)) @ self.p["filters"]).reshape(b - a, STEPS, FILTERS)
            if where:
                best = acts.argmax(axis=1)
                at[a:b] = best
                out[a:b] = np.take_along_axis(acts, best[:, None], axis=1)[:, 0]
            else:
                out[a:b] = acts.max(axis=1)
        return np.maximum(out + self.p["bias"], 0), at

    @staticmethod
    def chunks(halves: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chunk vectors: each half with its successor in the same text (a lone half is a chunk), their bounds,
        and the first half of each."""
        n = np.diff(first)
        start = np.arange(first[-1])
        last = np.zeros(first[-1], bool)
        last[first[1:] - 1] = True
        keep = ~last | np.repeat(n == 1, n)
        start = start[keep]
        follow = np.where(last[start], start, start + 1)
        bound = np.concatenate([[0], np.cumsum(np.maximum(n - 1, 1))])
        return np.maximum(halves[start], halves[follow]), bound, start

    @staticmethod
    def fill(texts: list[bytes]) -> np.ndarray:
        """How far a text fills one chunk: a short text has fewer places for filters to fire."""
        return np.array([[1 - min(len(t), CHUNK) / CHUNK] for t in texts], np.float32)

    def vectors(self, halves: np.ndarray, first: np.ndarray, texts: list[bytes]) -> np.ndarray:
        chunk, bound, _ = self.chunks(halves, first)
        mean = np.add.reduceat(chunk, bound[:-1], axis=0) / np.diff(bound)[:, None]
        return np.concatenate([mean, np.maximum.reduceat(chunk, bound[:-1], axis=0), self.fill(texts)], axis=1)

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        data, first = pack(texts)
        halves, _ = self.halves(data, int(first[-1]))
        z = self.vectors(halves, first, texts) @ self.p["out"] + self.p["out_bias"]
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))

    def gradients(self, texts: list[bytes], y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        data, first = pack(texts)
        halves, at = self.halves(data, int(first[-1]), where=True)
        chunk, bound, start = self.chunks(halves, first)
        n = np.diff(bound)
        mean = np.add.reduceat(chunk, bound[:-1], axis=0) / n[:, None]
        top = np.maximum.reduceat(chunk, bound[:-1], axis=0)
        vector = np.concatenate([mean, top, self.fill(texts)], axis=1)
        score = 1 / (1 + np.exp(-np.clip(vector @ self.p["out"] + self.p["out_bias"], -30, 30)))
        d = ((score - y) * weight / len(y)).astype(np.float32)
        g = {"out": vector.T @ d, "out_bias": d.sum(keepdims=True)}
        dv = d[:, None] * self.p["out"]
        owner = np.repeat(np.arange(len(n)), n)
        dc = dv[owner, :FILTERS] / n[owner][:, None]
        hits = chunk == top[owner]
        dc += np.where(hits, dv[owner, FILTERS:-1], 0) / np.maximum(np.add.reduceat(hits, bound[:-1], axis=0, dtype=np.float32), 1)[owner]
        dh = np.zeros_like(halves)
        follow = np.minimum(start + 1, len(halves) - 1)
        second = (halves[follow] > halves[start]) & (np.repeat(np.diff(first), n) > 1)[:, None]
        np.add.at(dh, start, np.where(second, 0, dc))
        np.add.at(dh, follow, np.where(second, dc, 0))
        dh *= halves > 0
        g["bias"] = dh.sum(axis=0)
        row, f = np.nonzero(dh)
        value = dh[row, f]
        byte = (row * HALF + at[row, f] * STRIDE)[:, None] + np.arange(WIDTH)
        byte = data[byte]
        seen = self.p["embed"][byte].reshape(len(row), WIDTH * EMBED) * value[:, None]
        g["filters"] = np.zeros_like(self.p["filters"])
        order = np.argsort(f, kind="stable")
        if len(order):
            heads = np.flatnonzero(np.r_[True, np.diff(f[order]) > 0])
            g["filters"][:, f[order][heads]] = np.add.reduceat(seen[order], heads, axis=0).T
        back = (self.p["filters"].T[f] * value[:, None]).reshape(-1, EMBED)
        flat = byte.ravel()
        g["embed"] = np.stack([np.bincount(flat, back[:, i], 256) for i in range(EMBED)], axis=1).astype(np.float32)
        return g

    def fit(self, rows: list[tuple[str, int]], epochs: int = EPOCHS, seed: int = 7) -> "Network":
        texts, y = [t.encode() for t, _ in rows], np.array([v for _, v in rows], np.float32)
        if not len(rows) or y.min() == y.max():
            share = min(max(float(y.mean()) if len(rows) else 0.5, 0.01), 0.99)
            self.p["out_bias"][0] = np.log(share / (1 - share))
            return self
        rng = np.random.default_rng(seed)
        weight = np.where(y > 0, GOOD / y.mean(), (1 - GOOD) / (1 - y.mean())).astype(np.float32)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, epochs = 0, max(epochs, -(-400 // -(-len(rows) // BATCH)))
        total = epochs * -(-len(rows) // BATCH)
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for a in range(0, len(order), BATCH):
                pick = order[a : a + BATCH]
                g = self.gradients([texts[i] for i in pick], y[pick], weight[pick])
                step += 1
                rate = RATE * min(1, step / 20) * (1 - 0.9 * step / total)
                for k, grad in g.items():
                    grad = grad + 1e-4 * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    s[k] = 0.999 * s[k] + 0.001 * grad * grad
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self


def _score(network: Network) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=4 << 20):
                texts = [x or b"" for x in part.column("text").cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(network.score(texts))], names=["id", "score"])

    return run


def score(docs: DataFrame, network: Network, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(_score(network), "id long, score double")
    return out.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def train(docs: DataFrame, labels: DataFrame) -> Network:
    return Network().fit(sample(docs, labels, "quality", PER_CLASS, LONGEST))


def op10_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
