"""Levenshtein automata intersected with a lexicon trie, as one lazily built deterministic automaton.

A state is the set of (trie node, errors so far) that a prefix of the word can reach; matching a word walks one
transition for each character, and transitions are computed once. Terms allow errors by their length; a stem
matches any word that begins with it.
"""

from __future__ import annotations


class Lexicon:
    """Terms and stems, each with the errors it allows."""

    def __init__(self, terms: dict[str, int], stems: dict[str, int]) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.word: list[tuple[str, int] | None] = [None]
        self.stem: list[tuple[str, int] | None] = [None]
        self.most: list[int] = [0]
        for table, entries in ((self.word, terms), (self.stem, stems)):
            for term, errors in sorted(entries.items()):
                node = 0
                for c in term:
                    if c not in self.next[node]:
                        self.next[node][c] = len(self.next)
                        self.next.append({})
                        self.word.append(None)
                        self.stem.append(None)
                        self.most.append(-1)
                    self.most[node] = max(self.most[node], errors)
                    node = self.next[node][c]
                self.most[node] = max(self.most[node], errors)
                table[node] = (term, errors)
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.ends: list[tuple[str, int] | None] = []
        self.stops: list[tuple[str, int] | None] = []
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        # Missing characters: a child is reached with one more error.
        todo = list(pairs)
        while todo:
            node, e = todo.pop()
            for child in self.next[node].values():
                if e + 1 <= self.most[child] and (child, e + 1) not in pairs:
                    pairs.add((child, e + 1))
                    todo.append((child, e + 1))
        key = frozenset(pairs)
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            self.ends.append(self._best(self.word, key))
            self.stops.append(self._best(self.stem, key))
        return self.ids[key]

    def _best(self, table: list, key: frozenset) -> tuple[str, int] | None:
        found = [(e, table[n][0]) for n, e in key if table[n] and e <= table[n][1]]
        return (min(found)[1], min(found)[0]) if found else None

    def _move(self, state: int, c: str) -> int:
        out: set[tuple[int, int]] = set()
        for node, e in self.sets[state]:
            for label, child in self.next[node].items():
                if e + (label != c) <= self.most[child]:
                    out.add((child, e + (label != c)))
            if e + 1 <= self.most[node]:
                out.add((node, e + 1))  # one character too many
        out = {(n, e) for n, e in out if not any((n, x) in out for x in range(e))}
        to = self.moves[state][c] = self._state(out) if out else -1
        return to

    def match(self, word: str) -> tuple[str, int, bool] | None:
        """(term, errors, whether by a stem) of the best match of a whole word."""
        state, stem = self.start, None
        for c in word:
            to = self.moves[state].get(c)
            state = self._move(state, c) if to is None else to
            if state < 0:
                break
            if self.stops[state] is not None and (stem is None or self.stops[state][1] < stem[1]):
                stem = self.stops[state]
        if state >= 0 and self.ends[state] is not None and (stem is None or self.ends[state][1] <= stem[1]):
            return (*self.ends[state], False)
        return None if stem is None else (*stem, True)


def distance(a: str, b: str) -> int:
    """Plain edit distance, for tests."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]
