"""Byte-pair merging of many words at once.

``merge_words`` works on the words' symbols laid end to end.  In every step each
word's best candidate (lowest rank, then leftmost) is merged, for all words
together, until no word has a candidate: the same result as an agenda per word,
in a few array operations a step.  A candidate is named by its word's key and
the characters it spans, so a keyed hash can drop candidates before they enter
(see ``dropped``) without changing how the others are processed.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Rank of no candidate.
NONE = np.int32(2**31 - 1)


class MergeTable:
    """Ranks and results of symbol pairs, looked up by (left, right).  Pairs of one
    rank have one result."""

    def __init__(self, left: Sequence[int], right: Sequence[int], rank: Sequence[int],
                 result: Sequence[int]):
        key = np.asarray(left, np.int64) << 32 | np.asarray(right, np.int64)
        order = np.argsort(key, kind="stable")
        self.key = key[order]
        self.rank = np.asarray(rank, np.int32)[order]
        self.result = np.asarray(result, np.int32)[order]
        self.of_rank = np.zeros(int(self.rank.max(initial=-1)) + 1, np.int32)
        self.of_rank[self.rank] = self.result
        if (self.of_rank[self.rank] != self.result).any():
            raise ValueError("pairs of one rank have different results")
        size = 1 << max(4, int(4 * len(key)).bit_length())
        self.shift = np.uint64(64 - (size.bit_length() - 1))
        self.slots = np.full(size, -1, np.int32)
        self._fill()

    _MIX = np.uint64(0x9E3779B97F4A7C15)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * self._MIX >> self.shift).astype(np.int64)

    def _fill(self) -> None:
        """Open addressing: every key takes the first free slot from its own."""
        mask, todo, step = len(self.slots) - 1, np.arange(len(self.key)), 0
        home, self.probes = self._slot(self.key), 0
        while len(todo):
            at = (home[todo] + step) & mask
            free = self.slots[at] < 0
            places, who = np.unique(at[free], return_index=True)
            self.slots[places] = todo[free][who]
            todo = todo[self.slots[at] != todo]
            step += 1
            self.probes = step
        self.slot_key = np.where(self.slots < 0, -1, self.key[self.slots])

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair in the table, -1 where there is none."""
        key = left.astype(np.int64) << 32 | right
        mask, at = len(self.slots) - 1, self._slot(key)
        there = self.slot_key[at]
        out = np.where(there == key, self.slots[at], -1).astype(np.int64)
        open_ = np.flatnonzero((there != key) & (there >= 0))
        for _ in range(1, self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & mask
            spot, want = at[open_], key[open_]
            there = self.slot_key[spot]
            out[open_] = np.where(there == want, self.slots[spot], -1)
            open_ = open_[(there != want) & (there >= 0)]
        return out


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finisher on uint64 arrays."""
    x = x.astype(np.uint64)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def span_hash(start: np.ndarray, mid: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the candidates that join characters [start, mid) and [mid, end)."""
    return mix64(start.astype(np.uint64) << np.uint64(42)
                 ^ mid.astype(np.uint64) << np.uint64(21) ^ end.astype(np.uint64))


def falls(keys: np.ndarray, spans: np.ndarray, rate: float) -> np.ndarray:
    """``dropped`` for span hashes."""
    return (mix64(keys + spans) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53 < rate


def dropped(keys: np.ndarray, start: np.ndarray, mid: np.ndarray, end: np.ndarray,
            rate: float) -> np.ndarray:
    """Whether the candidate that joins characters [start, mid) and [mid, end)
    of the word with this key is skipped; true for ``rate`` of all candidates."""
    return falls(keys, span_hash(start, mid, end), rate)


def merge_words(symbols: np.ndarray, lengths: np.ndarray, table: MergeTable,
                keys: np.ndarray | None = None, rate: float = 0.0, trace: list | None = None,
                banned: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Merged symbols of all words end to end, and their number per word.

    ``symbols``: the words' first symbols end to end; ``lengths``: how many each
    word has (at least 1); ``keys``, ``rate``: see ``dropped``.  ``trace`` receives
    (word, span hash) arrays of all candidates that were merged: were any other one
    dropped, nothing would change.
    ``banned``: span hashes of candidates to drop besides, a row for each word (0: none)."""
    n = len(lengths)
    sym = np.asarray(symbols, np.int32).copy()
    word = np.repeat(np.arange(n, dtype=np.int32), lengths)
    first = (np.cumsum(lengths) - lengths).astype(np.int64)
    skips = rate > 0 and keys is not None
    drops = skips or banned is not None
    spans = drops or trace is not None
    # the character each symbol begins with, counted over all words
    start = np.arange(len(sym)) if spans else None
    stop = first + lengths

    def spanned(at: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Span hash of the candidates (at, at + 1) of the words w."""
        after = np.minimum(at + 2, len(sym) - 1)
        end = np.where((at + 2 < len(sym)) & (word[after] == w), start[after], stop[w])
        return span_hash(start[at] - first[w], start[at + 1] - first[w], end - first[w])

    def ranks(i: np.ndarray) -> np.ndarray:
        """Rank of the candidate (i, i + 1), or NONE."""
        out = np.full(len(i), NONE, np.int32)
        inner = i < len(sym) - 1
        at = i[inner]
        same = word[at] == word[at + 1]
        spot = np.flatnonzero(inner)[same]
        at = at[same]
        found = table.find(sym[at], sym[at + 1])
        real = found >= 0
        spot, at, found = spot[real], at[real], found[real]
        if drops and len(at):
            w = word[at]
            span = spanned(at, w)
            stay = ~falls(keys[w], span, rate) if skips else np.ones(len(w), bool)
            if banned is not None:
                stay &= (banned[w] != span[:, None]).all(axis=1)
            spot, found = spot[stay], found[stay]
        out[spot] = table.rank[found]
        return out

    cand, run = ranks(np.arange(len(sym))), np.asarray(lengths, np.int64)
    done_word, done_sym = [], []
    while len(sym):
        best = np.minimum.reduceat(cand, np.cumsum(run) - run)
        live = best < NONE
        if not live.all():
            stay = np.repeat(live, run)
            done_word.append(word[~stay])
            done_sym.append(sym[~stay])
            sym, word, cand = sym[stay], word[stay], cand[stay]
            start = start[stay] if spans else None
            best, run = best[live], run[live]
            if not len(sym):
                break
        at = np.flatnonzero(cand == np.repeat(best, run))
        at = at[np.diff(word[at], prepend=-1) != 0]  # the leftmost of each word
        if trace is not None:
            trace.append((word[at], spanned(at, word[at])))
        sym[at], run = table.of_rank[best], run - 1  # each word that is left has merged once
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        moved = at - np.arange(len(at))  # one symbol less for every earlier merge
        sym, word, cand = sym[keep], word[keep], cand[keep]
        start = start[keep] if spans else None
        fresh = np.concatenate([moved, moved[moved > 0] - 1])
        cand[fresh] = ranks(fresh)
    words = np.concatenate(done_word) if done_word else np.zeros(0, np.int32)
    out = np.concatenate(done_sym) if done_sym else np.zeros(0, np.int32)
    by_word = np.argsort(words, kind="stable")
    return out[by_word], np.bincount(words, minlength=n)


def merge_word_by_agenda(symbols: Sequence[int], table: MergeTable, key: int = 0,
                         rate: float = 0.0) -> list[int]:
    """One word's merges through an explicit agenda (a heap of candidates): the
    same result as ``merge_words``, in time n log n for a word of n symbols."""
    import heapq

    sym, n = list(symbols), len(symbols)
    prev, nxt = list(range(-1, n - 1)), list(range(1, n + 1))
    start, end = list(range(n)), list(range(1, n + 1))
    agenda: list[tuple[int, int, int, int, int]] = []
    keys = np.array([key], np.uint64)

    def offer(lefts: list[int]) -> None:
        lefts = [i for i in lefts if i >= 0 and nxt[i] < n]
        if not lefts:
            return
        a = np.array([sym[i] for i in lefts], np.int64)
        b = np.array([sym[nxt[i]] for i in lefts], np.int64)
        found = table.find(a, b)
        if rate:
            s, m, e = (np.array(x) for x in zip(*((start[i], end[i], end[nxt[i]]) for i in lefts)))
            found[dropped(np.repeat(keys, len(lefts)), s, m, e, rate)] = -1
        for i, p in zip(lefts, found.tolist()):
            if p >= 0:
                heapq.heappush(agenda, (int(table.rank[p]), start[i], end[nxt[i]], i, p))

    offer(list(range(n - 1)))
    gone = [False] * n
    while agenda:
        _, _, stop, i, p = heapq.heappop(agenda)
        j = nxt[i]
        if gone[i] or j >= n or end[j] != stop or gone[j] or table.key[p] != sym[i] << 32 | sym[j]:
            continue  # one of its parts has been merged away
        sym[i], end[i], gone[j] = int(table.result[p]), end[j], True
        nxt[i] = nxt[j]
        if nxt[j] < n:
            prev[nxt[j]] = i
        offer([prev[i], i])
    return [s for s, g in zip(sym, gone) if not g]
