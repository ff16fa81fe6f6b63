"""SentencePiece (merge-type) encoding with seeded merge-dropout, and decoding.

A text's pieces never cross a blank from left to right, and none holds a letter
before a comma, a full stop or a line break (both are verified on the model), so
a text is a list of chunks that are cut there.  Each chunk's characters are merged
by the model's scores, best first and leftmost first among equals; a candidate
merge is skipped when a keyed hash of (seed, draw, chunk, characters spanned)
falls below ``rate``.  A chunk's draw is a hash of (seed, document id, its place in
the document) modulo ``draws`` (2^63): every occurrence of a word and every copy of
a text has its own skips, however often it occurs, and the same seed always gives
the same pieces, whatever the partitioning, so a lost task repeats its result.
``rate`` 0 is the model's own encoding.

A chunk's encodings are remembered by the candidates skipped on the way, with the
candidates that each meets: an occurrence whose hash skips none of those has that
encoding, and one that skips some goes on to the encoding without them, until it
meets no other to skip.  That is the encoding its own merges would give, as they
skip the same candidates and meet the same others.  Long chunks are merged anew.

Decoding is exact for every text: characters without a piece become byte pieces,
and so does a literal U+2581, which the model would otherwise read as a blank.
The model file is a parameter; it is read on the driver and never trained.

Null texts are empty (no pieces).  Rows with equal id and text get equal pieces;
a null id counts as 0 in the draws.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.bpe import MergeTable, falls, merge_word_by_agenda, merge_words, mix64
from tabloom.llm.common import groups_by_size, id_long, id_text, text_of

RATE = 0.1
DRAWS = 1 << 63
SEED = 17
LONG_CHUNK = 64
BLOCK = 1 << 21
#: Encodings a task remembers; the memory is emptied when full.
REMEMBERED = 400_000
#: Candidates of an encoding, the skips of which lead to another remembered one; an
#: occurrence that skips any of an encoding with more of them is merged anew.
TOLD_APART = 32
BLANK = "▁"
#: Blanks and what follows up to the next blank, cut between a letter and these.
STOPS = ".,\n"
CHUNK = re.compile(r" +[^\W\d_]*(?=[.,\n])| +[^ ]*|[^ ]+")


class PieceModel:
    """Symbols, merges and byte pieces of a SentencePiece merge-type model."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)
                                             or sp.is_unused(i))]
        name = {i: sp.id_to_piece(i) for i in plain}
        place = {p: i for i, p in name.items()}
        if any(BLANK in p.lstrip(BLANK) for p in place):
            raise ValueError("a piece of this model crosses a blank")
        if any(a.isalpha() and b in STOPS for p in place for a, b in zip(p, p[1:])):
            raise ValueError("a piece of this model joins a letter and a stop")
        self.unknown = n
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.of_char = np.full(0x110000, self.unknown, np.int32)
        for p, i in place.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        self.of_char[ord(" ")] = place[BLANK]
        self.of_char[ord(BLANK)] = self.unknown
        order = sorted((i for i in plain if len(name[i]) > 1), key=lambda i: (-sp.get_score(i), i))
        merges = [(place[p[:c]], place[p[c:]], rank, i) for rank, i in enumerate(order)
                  for p in [name[i]] for c in range(1, len(p)) if p[:c] in place and p[c:] in place]
        self.table = MergeTable(*zip(*merges))
        self.texts = [b""] * n
        for i in plain:
            self.texts[i] = name[i].replace(BLANK, " ").encode("utf-8")
        for b, i in enumerate(self.byte_ids.tolist()):
            self.texts[i] = bytes([b])
        self.raw = np.frombuffer(b"".join(self.texts), np.uint8)
        self.raw_n = np.fromiter(map(len, self.texts), np.int64, n)
        self.raw_begin = np.cumsum(self.raw_n) - self.raw_n

    def _spell(self, ids: np.ndarray, text: str | np.ndarray, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged symbols with unknown characters of the text (or its code points)
        written as bytes; also how many ids every symbol gave.  Unknown characters
        never merge, so they come in the order of the text."""
        gap = ids == self.unknown
        if not gap.any():
            return ids, np.ones(len(ids), np.int64)
        points = code_points(text) if isinstance(text, str) else text
        chars = [chr(c).encode("utf-8") for c in points[sym == self.unknown].tolist()]
        width = np.ones(len(ids), np.int64)
        width[gap] = [len(c) for c in chars]
        out = np.repeat(ids, width)
        out[np.repeat(gap, width)] = self.byte_ids[np.frombuffer(b"".join(chars), np.uint8)]
        return out, width

    def _symbols(self, text: str) -> np.ndarray:
        return self.of_char[code_points(text)]

    def encode_points(self, points: np.ndarray, lengths: np.ndarray, keys: np.ndarray | None, rate: float,
                      trace: list | None = None, banned: np.ndarray | None = None
                      ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks that are given as code points end to end, and their number per
        chunk; the rest as in ``merge_words``."""
        if not len(lengths):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        sym = self.of_char[points]
        ids, n = merge_words(sym, lengths, self.table, keys, rate, trace, banned)
        ids, width = self._spell(ids, points, sym)
        return ids, np.diff(np.cumsum(width)[np.cumsum(n) - 1], prepend=0)

    def encode_chunks(self, chunks: list[str], keys: np.ndarray, rate: float) -> list[bytes]:
        """Ids (little-endian int32) of every chunk under its key."""
        short = [i for i, c in enumerate(chunks) if len(c) <= LONG_CHUNK]
        out = [b""] * len(chunks)
        ids, n = self.encode_points(code_points("".join([chunks[i] for i in short])),
                                    np.array([len(chunks[i]) for i in short], np.int64), keys[short], rate)
        raw, start = ids.astype("<i4").tobytes(), 0
        for i, end in zip(short, (np.cumsum(n) * 4).tolist()):
            out[i] = raw[start:end]
            start = end
        for i, c in enumerate(chunks):
            if len(c) > LONG_CHUNK:
                out[i] = self.encode_long(c, int(keys[i]), rate).astype("<i4").tobytes()
        return out

    def encode_long(self, chunk: str, key: int, rate: float) -> np.ndarray:
        """Ids of one chunk of any length."""
        sym = self._symbols(chunk)
        return self._spell(np.array(merge_word_by_agenda(sym.tolist(), self.table, key, rate), np.int32),
                           chunk, sym)[0]

    def decode(self, ids: np.ndarray) -> str:
        """The text of a document's ids: the first blank is the model's prefix."""
        return self.decode_all([ids])[0].decode("utf-8")

    def decode_all(self, several: list[np.ndarray]) -> list[bytes]:
        """The texts of several documents' ids, in UTF-8."""
        ids = np.concatenate(several)
        n = self.raw_n[ids]
        raw = self.raw[stretches(self.raw_begin[ids], n)].tobytes()
        ends = np.append(0, np.cumsum(n))[np.cumsum([len(i) for i in several])].tolist()
        return [raw[s + 1:e] for s, e in zip([0, *ends], ends)]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")


def stretches(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ..., n[0] of them, then those from begin[1], ..."""
    return np.arange(n.sum()) + np.repeat(begin - (np.cumsum(n) - n), n)


def chunk_key(chunk: str, seed: int) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(chunk.encode("utf-8", "replace"), seed)


def chunk_keys(chunks: list[str], seed: int) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(c.encode("utf-8", "replace"), seed) for c in chunks),
                       np.uint64, len(chunks))


class _Places(dict):
    """Numbers of chunks in the order in which they came up."""

    def __missing__(self, chunk: str) -> int:
        place = self[chunk] = len(self)
        return place


def _further(ends: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Ends of stretches, with those of more stretches of ``n`` entries."""
    return np.append(ends, ends[-1] + np.cumsum(n))


def chunk_draws(docs: list[int], lengths: list[int], seed: int, draws: int) -> np.ndarray:
    """The draws of all chunks of several documents end to end."""
    n = np.array(lengths, np.int64)
    doc = np.fromiter(((d % (1 << 64)) ^ (seed << 32) % (1 << 64) for d in docs), np.uint64, len(docs))
    place = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)).astype(np.uint64)
    return mix64(np.repeat(mix64(doc), n) + mix64(place)) % np.uint64(draws)


class DropoutEncoder:
    """Encodes documents with a memory of the chunks' encodings.

    An encoding's place in the memory is its state.  A chunk's first state is the
    encoding without skips; the others are told apart by the state before and the
    places of the candidates skipped there.  What states and chunks hold lies end to
    end in arrays."""

    def __init__(self, model: PieceModel, rate: float = RATE, draws: int = DRAWS, seed: int = SEED):
        self.model, self.rate, self.seed, self.draws = model, rate, seed, draws
        self._forget()

    def _forget(self) -> None:
        # chunks: places, keys, first states, code points (of long ones none)
        self.known = _Places()
        self.own, self.first, self.long = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.points, self.point_ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        # states: chunk, ids, span hashes of the candidates merged and of those skipped
        self.of = np.zeros(0, np.int64)
        self.ids, self.id_ends = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.spans, self.span_ends = np.zeros(0, np.uint64), np.zeros(1, np.int64)
        self.skipped, self.skipped_ends = np.zeros(0, np.uint64), np.zeros(1, np.int64)
        # state after (state << TOLD_APART | skipped places)
        self.after: dict[int, int] = {}

    def _add(self, of: np.ndarray, ids: np.ndarray, n: np.ndarray, trace: list, place: np.ndarray,
             skipped: np.ndarray, skipped_n: np.ndarray) -> np.ndarray:
        """New states; ``trace`` is of those at ``place``.  Returns their numbers."""
        first = len(self.of)
        self.of = np.append(self.of, of)
        self.ids, self.id_ends = np.append(self.ids, ids), _further(self.id_ends, n)
        word = place[np.concatenate([w for w, _ in trace])] if trace else np.zeros(0, np.int64)
        spans = np.concatenate([s for _, s in trace]) if trace else np.zeros(0, np.uint64)
        self.spans = np.append(self.spans, spans[np.argsort(word, kind="stable")])
        self.span_ends = _further(self.span_ends, np.bincount(word, minlength=len(of)))
        self.skipped = np.append(self.skipped, skipped)
        self.skipped_ends = _further(self.skipped_ends, skipped_n)
        return np.arange(first, len(self.of))

    def _learn(self, new: list[str]) -> None:
        """Encode new chunks without skips.  Long ones have no plain encoding
        here unless nothing is skipped at all: one of their candidates nearly
        always falls."""
        if not new:
            return
        count = len(self.own)
        chars = np.fromiter(map(len, new), np.int64, len(new))
        long = chars > LONG_CHUNK
        points = code_points("".join(c for c in new if len(c) <= LONG_CHUNK) if long.any() else "".join(new))
        trace: list = []
        ids, some = self.model.encode_points(points, chars[~long], None, 0.0, trace if self.rate else None)
        n = np.zeros(len(new), np.int64)
        n[~long] = some
        if not self.rate and long.any():
            parts = iter(np.split(ids, np.cumsum(some)[:-1]) if len(some) else [])
            parts = [self.model.encode_long(c, 0, 0.0) if big else next(parts) for c, big in zip(new, long.tolist())]
            ids, n = np.concatenate(parts), np.array([len(x) for x in parts], np.int64)
        self.own = np.append(self.own, chunk_keys(new, self.seed))
        self.long = np.append(self.long, long)
        self.points = np.append(self.points, points)
        self.point_ends = _further(self.point_ends, np.where(long, 0, chars))
        self.first = np.append(self.first, self._add(
            np.arange(count, count + len(new)), ids, n, trace, np.flatnonzero(~long), np.zeros(0, np.uint64),
            np.zeros(len(new), np.int64)))

    def _points_of(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code points and lengths of known short chunks."""
        begin = self.point_ends[chunks]
        n = self.point_ends[chunks + 1] - begin
        return self.points[stretches(begin, n)], n

    def _go_on(self, steps: np.ndarray) -> np.ndarray:
        """Encode with the candidates of every new step (state << TOLD_APART | skipped
        places) skipped, besides those that its state skips.  Returns the states."""
        state, places = steps >> TOLD_APART, steps & (1 << TOLD_APART) - 1
        which, place = np.nonzero(places[:, None] >> np.arange(TOLD_APART) & 1)
        more, n_more = self.spans[self.span_ends[state[which]] + place], np.bincount(which, minlength=len(steps))
        n_old = self.skipped_ends[state + 1] - self.skipped_ends[state]
        n = n_old + n_more
        slots = np.arange(n.max())
        banned = np.zeros((len(steps), n.max()), np.uint64)
        banned[slots < n_old[:, None]] = self.skipped[stretches(self.skipped_ends[state], n_old)]
        banned[(slots >= n_old[:, None]) & (slots < n[:, None])] = more
        trace: list = []
        ids, n_ids = self.model.encode_points(*self._points_of(self.of[state]), None, 0.0, trace, banned)
        found = self._add(self.of[state], ids, n_ids, trace, np.arange(len(steps)), banned[slots < n[:, None]], n)
        self.after.update(zip(steps.tolist(), found.tolist()))
        return found

    def _skips(self, state: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The places, as bits, of the candidates merged in its state that each
        occurrence skips; -1 if it skips any of too many."""
        begin = self.span_ends[state]
        n = self.span_ends[state + 1] - begin
        spots = stretches(begin, n)
        which = np.repeat(np.arange(len(state)), n)
        hit = np.flatnonzero(falls(keys[which], self.spans[spots], self.rate))
        which = which[hit]
        place = np.minimum(spots[hit] - begin[which], TOLD_APART)
        # a sum of different powers of two, exact in a double
        bits = np.bincount(which, np.exp2(place), len(state)).astype(np.int64)
        return np.where((bits > 0) & (n > TOLD_APART), -1, bits)

    def encode(self, docs: list[int], texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        split = [CHUNK.findall(" " + t) if t else [] for t in texts]
        lengths = list(map(len, split))
        flat = list(chain.from_iterable(split))
        if len(self.of) > REMEMBERED:
            self._forget()
        count = len(self.known)
        chunk = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        self._learn(list(islice(self.known, count, None)))
        state = self.first[chunk]
        begin, n = self.id_ends[state], self.id_ends[state + 1] - self.id_ends[state]
        pool = [self.ids]
        if self.rate and flat:
            keys = mix64(self.own[chunk] + chunk_draws(docs, lengths, self.seed, self.draws))
            long = self.long[chunk]
            anew, open_ = [], np.flatnonzero(~long)
            while len(open_):
                bits = self._skips(state[open_], keys[open_])
                anew.append(open_[bits < 0])
                open_, bits = open_[bits > 0], bits[bits > 0]
                steps, step_of, often = np.unique(state[open_] << TOLD_APART | bits, return_inverse=True,
                                                  return_counts=True)
                to = np.array([self.after.get(s, -1) for s in steps.tolist()], np.int64)
                new = (to < 0) & (often > 1)
                if new.any():
                    to[new] = self._go_on(steps[new])
                to = to[step_of]
                anew.append(open_[to < 0])  # what occurs once is not remembered
                open_ = open_[to >= 0]
                state[open_] = to[to >= 0]
            begin, n = self.id_ends[state], self.id_ends[state + 1] - self.id_ends[state]
            anew = np.concatenate(anew) if anew else np.zeros(0, np.int64)
            fresh, n[anew] = self.model.encode_points(*self._points_of(chunk[anew]), keys[anew], self.rate)
            begin[anew] = len(self.ids) + np.cumsum(n[anew]) - n[anew]
            pool = [self.ids, fresh]
            done = len(self.ids) + len(fresh)
            for i in np.flatnonzero(long).tolist():
                pool.append(self.model.encode_long(flat[i], int(keys[i]), self.rate))
                begin[i], n[i] = done, len(pool[-1])
                done += len(pool[-1])
        out = np.concatenate(pool)[stretches(begin, n)].astype("<i4", copy=False)
        ends = np.append(0, np.cumsum(n))[np.cumsum(lengths, dtype=np.int64)].tolist()
        return [out[s:e] for s, e in zip([0, *ends], ends)]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                     rate: float = RATE, draws: int = DRAWS, seed: int = SEED) -> DataFrame:
    """doc_id, ids (array of int), decoded_sha256 (of the text that the ids decode
    to) and lossless (that text is the row's)."""
    model = PieceModel(model_path)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = DropoutEncoder(model, rate, draws, seed)
        for pdf in batches:
            done = 0
            for texts in groups_by_size(pdf["text"], BLOCK):
                part = pdf.iloc[done:done + len(texts)]
                done += len(texts)
                ids = coder.encode(part["key"].tolist(), texts)
                back = model.decode_all(ids)
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].to_numpy(), "ids": ids,
                    "decoded_sha256": [hashlib.sha256(b).hexdigest() for b in back],
                    "lossless": [a == b.decode("utf-8") for a, b in zip(texts, back)]})

    return id_long(docs.select(id_text(id_col), F.coalesce(F.col(id_col), F.lit(0)).alias("key"),
                               text_of(text_col).alias("text")).mapInPandas(
        encode, "doc_id string, ids array<int>, decoded_sha256 string, lossless boolean"))
