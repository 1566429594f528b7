"""Toxicity by a fuzzy lexicon and the context of its hits.

Fit, on a bounded sample of labelled documents: terms and productive stems whose documents are toxic far more
often than chance allows (a likelihood-ratio test over all candidates); then a logistic regression on what the
hits add up to. Score, over whole texts: every distinct word of a slice walks the Levenshtein automaton of the
lexicon; a hit's window of words tells quotation (quote marks, words of reporting) from abuse (address, emphasis) and
scales the hit.

Defined results: null and empty texts have no hits and get the score of a text without any; equal texts get equal scores;
without labelled rows of both classes the lexicon is the public seed list alone; a null id is not held out; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labelled import held_out, sample
from tidemark.llm.levenshtein import Lexicon
from tidemark.llm.runtime import give_back
from tidemark.llm.wordscan import scan, slices

#: A seed list of English insults, words of reporting, words of address.
SEED = "bastard clown disgusting dumb filthy fool garbage idiot imbecile loser moron pathetic scum stupid trash vermin worthless".split()
REPORTING = set("said says called calling word words term phrase quote quoted quotes wrote written labeled labelled reads title dijo palabra llamó sagte wort nannte dit mot appelé".split())
ADDRESS = set("you your you're u du dich dein sie ihr tu tú te vous votre usted ustedes".split())
QUOTES = "\"'“”„‟«»‹›‘’`"
EDGE = " \t\n.,;:!?()[]{}<>|/\\*#$%&=+~^_-–—…" + QUOTES
#: Words on each side that make a hit's context; lexicon size; lengths of stems; needed precision.
CONTEXT, TERMS, STEMS, PRECISION = 6, 400, range(4, 9), 0.85
#: Words of a stem that a document may be asked to hold.
MOST = 3
CACHE = 1_000_000


def errors_for(term: str, stem: bool) -> int:
    """Errors a term or stem may be misspelled with: longer ones bear more, those under five letters none."""
    if stem:
        return 0 if len(term) < 5 else 1
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


def _gain(k: int, n: int, p: float) -> float:
    """Log-likelihood ratio of k toxic among n against the base rate."""
    q = k / n
    return k * math.log(max(q, 1e-12) / p) + (n - k) * math.log(max(1 - q, 1e-12) / (1 - p)) if q > p else 0.0


def independent(rows: list[tuple[str, int]], share: float = 0.2) -> list[tuple[str, int]]:
    """Rows whose text is mostly new: one of each group of copies, so that copies are no evidence."""
    seen: set[int] = set()
    out = []
    for text, y in rows:
        words = text.split()
        own = {hash(tuple(words[i : i + 5])) for i in range(max(1, len(words) - 4))}
        if len(own & seen) <= share * len(own):
            out.append((text, y))
        seen |= own
    return out


def learn_lexicon(rows: list[tuple[str, int]]) -> tuple[dict[str, int], dict[str, int], dict[str, int]]:
    """Terms and stems with the errors they allow, and the words of a stem that a document must hold.

    A stem needs four different words that go on from it, and may be one that ordinary texts hold now and then: it
    then counts from its second or third word on, whichever is the first to tell. Of a chain of stems the longest
    stands that keeps most of the shortest one's documents.
    """
    toxic, total = Counter(), Counter()
    forms: dict[str, set[str]] = defaultdict(set)
    rows = independent(rows)
    for text, y in rows:
        found = Counter(w for w in (x.strip(EDGE) for x in text.lower().split()) if len(w) > 2)
        begun: Counter = Counter()
        for w, c in found.items():
            for n in STEMS:
                if len(w) > n:
                    begun[w[:n]] += c
                    if y and len(forms[w[:n]]) < 4:
                        forms[w[:n]].add(w)
        keys = [*found, *((p, t) for p, c in begun.items() for t in range(1, min(c, MOST) + 1))]
        total.update(keys)
        if y:
            toxic.update(keys)
    n_toxic = sum(y for _, y in rows)
    terms, stems = dict.fromkeys(SEED, 0), {}
    if 0 < n_toxic < len(rows):
        base = n_toxic / len(rows)
        tested = [k for k in toxic if toxic[k] >= 4]
        need = math.log(max(len(tested), 2)) + 3
        good = {k: g for k in tested if toxic[k] >= PRECISION * total[k] and (g := _gain(toxic[k], total[k], base)) >= need}
        least: dict[str, int] = {}
        for p, t in (k for k in good if isinstance(k, tuple)):
            least[p] = min(t, least.get(p, t))
        for stem in sorted(least, key=len):
            if any(stem[:n] in least for n in STEMS if n < len(stem)):
                continue  # not the shortest of its chain
            t = least[stem]
            longer = [x for x in least if x.startswith(stem) and least[x] <= t and toxic[(x, least[x])] >= 0.9 * toxic[(stem, t)]]
            whole = [k for k in good if isinstance(k, str) and k.startswith(stem) and toxic[k] >= 0.9 * toxic[(stem, t)]]
            stem = max(longer, key=lambda x: (len(x), x))
            if not whole and len(forms[stem]) >= 4:
                stems[stem] = least[stem]
        best = sorted((k for k in good if isinstance(k, str) and not any(k.startswith(s) and errors_for(s, True) for s in stems)), key=lambda k: (-good[k], k))
        terms = dict.fromkeys([*best[:TERMS], *(s for s in SEED if s not in total or toxic[s] >= PRECISION * total[s])], 0)
    kept = sorted(stems)[:TERMS]
    return {t: errors_for(t, False) for t in terms}, {x: errors_for(x, True) for x in kept}, {x: stems[x] for x in kept}


def spelling(word: str, hit: tuple[str, int, bool]) -> str:
    """What a misspelled hit is spelled as: the word, or its beginning where a stem is meant."""
    return word[: len(hit[0])] if hit[2] else word


class Scanner:
    """Finds hits of a lexicon in slices of text; remembers the words it has seen, up to a bound."""

    def __init__(self, terms: dict[str, int], stems: dict[str, int], least: dict[str, int], excluded: frozenset[str] = frozenset()) -> None:
        self.lexicon, self.least, self.excluded = Lexicon(terms, stems), least, excluded
        self.seen: set[int] = set()
        self.hits: dict[int, tuple[str, int, bool]] = {}

    def lookup(self, word: str) -> tuple[str, int, bool] | None:
        word = word.lower().strip(EDGE)
        hit = self.lexicon.match(word) if word else None
        return None if hit and hit[1] and spelling(word, hit) in self.excluded else hit

    def __call__(self, text: pa.Array) -> tuple[np.ndarray, list[list[tuple[str, int, bool, float]]]]:
        """Words of each text, and its hits with the weight of their context."""
        words = scan(text)
        hashes = words.hashes(lower=True)
        distinct, at = np.unique(hashes, return_index=True)
        if len(self.seen) > CACHE:
            self.seen.clear()
            self.hits.clear()
        for h, i in zip(distinct.tolist(), at.tolist()):
            if h not in self.seen:
                self.seen.add(h)
                if hit := self.lookup(words.word(i).decode("utf-8", "replace")):
                    self.hits[h] = hit
        out: list[list[tuple[str, int, bool, float]]] = [[] for _ in range(len(words.first) - 1)]
        if self.hits:
            known = np.sort(np.fromiter(self.hits, np.uint64, len(self.hits)))
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            found = np.flatnonzero(known[place] == hashes)
            docs = np.searchsorted(words.first, found, side="right") - 1
            for i, d in zip(found.tolist(), docs.tolist()):
                a, b = max(int(words.first[d]), i - CONTEXT), min(int(words.first[d + 1]), i + CONTEXT + 1)
                near = [words.word(j).decode("utf-8", "replace") for j in range(a, b)]
                out[d].append((*self.hits[int(hashes[i])], context(near, i - a)))
        return words.count, [self._counted(h) for h in out]

    def _counted(self, hits: list[tuple[str, int, bool, float]]) -> list[tuple[str, int, bool, float]]:
        """Without the first words of stems that count from a later one on."""
        if all(self.least.get(t, 1) == 1 for t, *_ in hits):
            return hits
        seen: Counter = Counter()
        out = []
        for hit in hits:
            seen[hit[0]] += hit[2]
            if not hit[2] or seen[hit[0]] >= self.least.get(hit[0], 1):
                out.append(hit)
        return out


def context(words: list[str], at: int) -> float:
    """Weight of a hit at ``words[at]``: under 1 in quotation, over 1 in abuse."""
    own = words[at]
    quoted = own[:1] in QUOTES and own.rstrip(".,;:!?")[-1:] in QUOTES
    if not quoted:
        opened = sum(w[:1] in QUOTES for w in words[: at + 1]) - sum(w.rstrip(".,;:!?")[-1:] in QUOTES and len(w) > 1 for w in words[:at])
        closed = any(w.rstrip(".,;:!?")[-1:] in QUOTES for w in words[at:])
        quoted = opened > 0 and closed
    plain = [w.lower().strip(EDGE) for w in words]
    reported = any(w in REPORTING for w in plain[max(0, at - 3) : at + 2])
    weight = 1.0
    if quoted:
        weight *= 0.35
    if reported:
        weight *= 0.6
    if not quoted and (any(w in ADDRESS for w in plain) or "!" in own or own.isupper()):
        weight *= 1.3
    return weight


#: A misspelled hit counts as so much of an exact one. It is not fitted: labelled texts may hold no misspelling at all.
FUZZY = 0.8


def features(n_words: int, hits: list[tuple[str, int, bool, float]]) -> list[float]:
    """Intercept, whether there is a full hit, sum and density of weighted hits, more than one term."""
    total = sum(w * (FUZZY if e else 1) for _, e, _, w in hits)
    return [1.0, min(total, 1.0), math.log1p(total), math.log1p(100 * total / max(n_words, 20)), float(len({t for t, *_ in hits}) > 1)]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.02, steps: int = 60) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    """Lexicon and weights; small, sent to the executors with the task."""

    def __init__(self, rows: list[tuple[str, int]]) -> None:
        self.terms, self.stems, self.least = learn_lexicon(rows)
        rows = independent(rows)
        scanner = Scanner(self.terms, self.stems, self.least)
        counts, hits = scanner(pa.array([t for t, _ in rows], pa.string()))
        y = np.array([y for _, y in rows], float)
        # Spellings near a term, and beginnings near a stem, that clean documents use are words of their own.
        clean = {w for (t, label), own in zip(rows, hits) if not label and any(h[1] for h in own) for w in (x.lower().strip(EDGE) for x in t.split())}
        spelled = {spelling(w, m) for w in clean if (m := scanner.lexicon.match(w)) and m[1]}
        self.excluded = frozenset(spelled)
        if 0 < y.sum() < len(y):
            counts, hits = Scanner(self.terms, self.stems, self.least, self.excluded)(pa.array([t for t, _ in rows], pa.string()))
            self.weights = fit_logistic(np.array([features(int(n), h) for n, h in zip(counts, hits)]), y)
        else:
            self.weights = np.array([-4.0, 3.0, 0.7, 0.5, 0.5])

    def scanner(self) -> Scanner:
        return Scanner(self.terms, self.stems, self.least, self.excluded)


def _score(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = model.scanner()
        for batch in batches:
            for part in slices(batch, most=4 << 20):
                counts, hits = scanner(part.column("text"))
                x = np.array([features(int(n), h) for n, h in zip(counts, hits)]).reshape(-1, len(model.weights))
                score = 1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))
                terms = [sorted({t for t, *_ in h}) for h in hits]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(score), pa.array([len(h) for h in hits], pa.int64()), pa.array(terms, pa.list_(pa.string()))], names=["id", "score", "n_hits", "terms"])

    return run


def score(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted, n_hits, terms) of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(_score(model), "id long, score double, n_hits long, terms array<string>")
    return out.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_hits", "terms")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    model = Model(sample(docs, labels, "toxic"))
    give_back()
    return model


def _clean(model: Model, threshold: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = model.scanner()
        for batch in batches:
            for part in slices(batch, most=4 << 20):
                counts, hits = scanner(part.column("text"))
                x = np.array([features(int(n), h) for n, h in zip(counts, hits)]).reshape(-1, len(model.weights))
                yield part.filter(pa.array(1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30))) < threshold))

    return run


def remove_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as they are."""
    return docs.mapInArrow(_clean(train(docs, labels), threshold), docs.schema)


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))).select("doc_id", "held_out", "score", "predicted", "n_hits")
