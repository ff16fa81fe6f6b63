"""Ids of the word-level BPE vocabulary, word by word.

The vocabulary's normaliser and splitter never look across white space, so a
text's ids are the ids of its words end to end.  A task remembers the words it
has met and merges the new ones of a batch together (see ``bpe``).  Texts with
characters beyond printable Latin-1, or with a special token's string, go
through the tokenizers library as they are.  The vocabulary file is a parameter.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

import numpy as np

from tabloom.llm.bpe import MergeTable, merge_word_by_agenda, merge_words

#: Words a task remembers (about 200 bytes each); the memory is emptied when full.
REMEMBERED = 600_000
LONG_PART = 64
#: Texts that the library's normaliser changes by lower case only: printable
#: Latin-1 and ASCII white space.
PLAIN = re.compile("[\t-\r \x21-\x7e\xa1-\xff]*")


def byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordTokenizer:
    """ids(texts) for the vocabulary file at ``path``."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        spec = json.loads(self.library.to_str())
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.split = regex.compile("\n|" + split["pattern"]["Regex"]).findall
        names = byte_symbols()
        self.inner = np.array([vocab[names[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[names[b] + end] for b in range(256)], np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left, right = zip(*merges)
        self.table = MergeTable([vocab[x] for x in left], [vocab[x] for x in right],
                                range(len(merges)), [vocab[x + y] for x, y in merges])
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"])
                                  or "(?!)")
        self.known: dict[bytes, bytes] = {}

    def _learn(self, words: list[bytes]) -> None:
        """Put the ids of new (lower-case, plain) words into the memory."""
        if len(self.known) + len(words) > REMEMBERED:
            self.known.clear()
        # one pass over all words; the mark between them is no plain character
        found = self.split(b"\n".join(words).decode("utf-8"))
        new = list(dict.fromkeys(found))
        ids = dict(zip(new, self._part_ids([p.encode() for p in new])))
        parts = iter(found)
        for word in words:
            got = ids[next(parts)]
            for p in parts:
                if p == "\n":
                    break
                got += ids[p]
            self.known[word] = got

    def _part_ids(self, parts: list[bytes]) -> list[bytes]:
        short = [p for p in parts if len(p) <= LONG_PART]
        found = {}
        if short:
            lengths = np.array([len(p) for p in short], np.int64)
            data = np.frombuffer(b"".join(short), np.uint8)
            sym, ends = self.inner[data], np.cumsum(lengths)
            sym[ends - 1] = self.last[data[ends - 1]]
            out, n = merge_words(sym, lengths, self.table)
            raw, stop = out.astype("<u4").tobytes(), (4 * np.cumsum(n)).tolist()
            found = {p: raw[a:b] for p, a, b in zip(short, [0, *stop], stop)}
        for p in parts:
            if len(p) > LONG_PART:
                data = np.frombuffer(p, np.uint8)
                sym = [*self.inner[data[:-1]].tolist(), int(self.last[data[-1]])]
                found[p] = np.array(merge_word_by_agenda(sym, self.table), "<u4").tobytes()
        return [found[p] for p in parts]

    def ids(self, texts: Iterable[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        split = [t.lower().encode().split() if PLAIN.fullmatch(t) and not self.special.search(t)
                 else None for t in texts]
        met = set().union(*(words for words in split if words))
        new = [w for w in met if w not in self.known]
        if new:
            self._learn(new)
            gone = [w for w in met if w not in self.known]  # after a full memory was emptied
            if gone:
                self._learn(gone)
        get = self.known.__getitem__
        return [b"".join(map(get, words)) if words is not None else
                np.array(self.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
                for t, words in zip(texts, split)]
