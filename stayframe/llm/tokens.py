"""Token ids of whole texts by a public tokenizer, exactly as the library gives them.

The vocabulary's rules never join characters across ASCII white space, so a
text's ids are those of its space-separated words in order, and the library
runs once per new word. Nor do they join a letter or digit to the signs after
it, so the signs at a word's end are looked up by themselves. Only words of plain
ASCII are lower-cased before they are looked up: elsewhere normalisation comes
before lower-casing and the order matters. Words with ``<`` stay as they are, as
they may hold a special token.
"""

from __future__ import annotations

import ctypes
from itertools import compress

import numpy as np

from stayframe.llm.common import SPACE

VOCABULARY, CLOSING_ID, KEEP = "word_bpe_49k.json", 2, 500_000
SENTINEL = "\ue000"  # stands between words when the ends of their ids can't be told otherwise
_ENDERS = frozenset(".,;:!?*#$%&|")
_SIGN, _ALNUM, _LATIN = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_SIGN[[ord(c) for c in _ENDERS]] = True
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_LATIN[0x80:0xC0], _LATIN[[0x97, 0xB7]] = True, False  # after 0xC3: the letters U+00C0 to U+00FF, which no normalisation changes
TAIL = 16  # signs; words with more stay whole
AT_ONCE = 1 << 14  # new words
_ENCODERS: dict[tuple[str, int], "Encoder"] = {}


class _Places(dict):
    """Words' places, dealt out as new words are asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


def _tails(raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Signs at each word's end, where a letter or digit stands before them (else 0)."""
    tail = np.zeros(len(start), np.int64)
    last = start + length - 1
    left = np.flatnonzero(_SIGN[raw[last]]) if len(start) else last
    for k in range(1, TAIL + 1):
        left = left[length[left] > k]
        before = raw[last[left] - k]
        latin = _LATIN[before] & (raw[last[left] - k - 1] == 0xC3) & (length[left] > k + 1)
        tail[left[_ALNUM[before] | latin]] = k
        left = left[_SIGN[before]]
    return tail


class Encoder:
    """Ids of batches of texts, with a bounded memory of words seen (``keep`` words, then all but the half met in most batches are forgotten)."""

    def __init__(self, path: str, keep: int = KEEP):
        from tokenizers import Tokenizer

        self.tokenizer, self.keep = Tokenizer.from_file(path), keep
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.place = _Places()
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.at, self.count, self.seen = (np.zeros(1 << 14, np.int64), *np.zeros((2, 1 << 14), np.int32))  # of each word's ids; batches with the word

    def _forget(self) -> None:
        seen = self.seen[: len(self.place)]
        often = np.flatnonzero(seen > 1)
        often = np.sort(often[np.argsort(-seen[often], kind="stable")[: self.keep // 2]])
        at, count, seen = self.at[often], self.count[often], seen[often] >> 1  # words out of use go in the end
        first = np.concatenate(([0], np.cumsum(count, dtype=np.int64)))
        stay = np.zeros(len(self.place), bool)
        stay[often] = True
        self.place = _Places(zip(compress(self.place, stay.tolist()), range(len(often))))
        self.ids, self.used = self.ids[np.repeat(at - first[:-1], count) + np.arange(first[-1])], int(first[-1])
        self.ids = np.concatenate((self.ids, np.zeros(1 << 16, np.uint32)))
        self.at, self.count, self.seen = (np.concatenate((x, np.zeros(1 << 14, x.dtype))) for x in (first[:-1], count, seen))

    def _store(self, words: list[bytes], flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        """Keep the ids flat[start:end] of each word."""
        places, count = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words)), end - start
        first = self.used + np.concatenate(([0], np.cumsum(count)))
        while first[-1] > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        while len(self.place) > len(self.at):
            self.at, self.count, self.seen = (np.concatenate((x, np.zeros_like(x))) for x in (self.at, self.count, self.seen))
        self.ids[self.used : first[-1]] = flat[np.repeat(start - first[:-1], count) + np.arange(self.used, first[-1])]
        self.at[places], self.count[places] = first[:-1], count
        self.used = int(first[-1])

    def _run(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _learn(self, new: list[bytes]) -> None:
        """Many new words run as one text, cut again at the ids that end a word or run of signs."""
        plain, parts, rest = [], [], []
        for w in new:
            t = w.decode()
            if t.isalpha():
                plain.append((w, t))
                parts.append(1)
            elif t[-1] in _ENDERS and t[:-1].isalpha():
                plain.append((w, t))
                parts.append(2)
            else:
                rest.append(w)
        if plain:
            flat = self._run(" ".join(t for _, t in plain))
            ends = np.flatnonzero(self.ends[flat]) + 1
            upto = np.cumsum(parts)
            if len(ends) == upto[-1]:
                self._store([w for w, _ in plain], flat, np.concatenate(([0], ends[upto[:-1] - 1])), ends[upto - 1])
            else:  # a letter that normalises to something else
                rest += [w for w, _ in plain]
        odd = [w for w in rest if SENTINEL.encode() in w]
        rest = [w for w in rest if SENTINEL.encode() not in w]
        if rest:
            mark = self._run(SENTINEL)
            flat = self._run(f" {SENTINEL} ".join(w.decode() for w in rest))
            hit = np.ones(max(0, len(flat) - len(mark) + 1), bool)
            for k, m in enumerate(mark):
                hit &= flat[k : k + len(hit)] == m
            at = np.flatnonzero(hit)
            if len(at) == len(rest) - 1:
                self._store(rest, flat, np.concatenate(([0], at + len(mark))), np.concatenate((at, [len(flat)])))
            else:
                odd += rest
        for w in odd:
            flat = self._run(w.decode())
            self._store([w], flat, np.zeros(1, np.int64), np.array([len(flat)]))

    def _places(self, raw: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The place of each word, given all words' bytes in a row and their lengths."""
        import pyarrow as pa

        first = np.concatenate(([0], np.cumsum(length)))
        as_is = np.logical_or.reduceat((raw >= 128) | (raw == 60), first[:-1])
        raw = np.where((raw >= 65) & (raw <= 90) & np.repeat(~as_is, length), raw + np.uint8(32), raw)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(first), pa.py_buffer(raw)]).dictionary_encode()
        distinct = words.dictionary.to_pylist()
        if len(self.place) + len(distinct) > self.keep:
            self._forget()
        known = len(self.place)
        places = np.fromiter(map(self.place.__getitem__, distinct), np.int64, len(distinct))
        if len(self.place) > known:
            new = np.flatnonzero(places >= known)
            for k in range(0, len(new), AT_ONCE):  # the library takes some hundred bytes an id of a text
                self._learn([distinct[x] for x in new[k : k + AT_ONCE]])
        self.seen[places] += 1
        return places[words.indices.to_numpy()]

    def __call__(self, texts: list[bytes], closing: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids in a row (each text's followed by ``closing``, if given), and where each text's begin (one more than texts)."""
        raw = np.frombuffer(b" ".join(texts), np.uint8)
        word = ~SPACE[raw]
        edge = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
        start, length = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        length = length - start
        text_start = np.cumsum([0, *map(len, texts)]) + np.arange(len(texts) + 1)
        upto = np.searchsorted(start, text_start)  # words before each text
        tail = _tails(raw, start, length)
        split = np.flatnonzero(tail)
        upto = upto + np.searchsorted(split, upto)
        length[split] -= tail[split]
        length = np.insert(length, split + 1, tail[split])
        place = self._places(raw[word], length) if len(start) else np.zeros(0, np.int64)
        at, n = self.at[place], self.count[place]
        before = np.concatenate(([0], np.cumsum(n)))
        of = np.repeat(at - before[:-1], n)
        of += np.arange(before[-1])
        ids = self.ids[of]
        first = before[upto]
        if closing is None:
            return ids, first
        out = np.full(len(ids) + len(texts), closing, np.uint32)
        np.copyto(of, np.repeat(np.arange(len(texts)), np.diff(first)))
        of += np.arange(len(ids))
        out[of] = ids
        return out, first + np.arange(len(texts) + 1)


def encoder(path: str, keep: int = KEEP) -> Encoder:
    """One encoder per worker, vocabulary and bound, so that tasks share the words seen."""
    if (path, keep) not in _ENCODERS:
        _ENCODERS[path, keep] = Encoder(path, keep)
    return _ENCODERS[path, keep]


def release() -> None:
    """Give back this worker's memory of words: for the stages that come after tokenising."""
    if _ENCODERS:
        _ENCODERS.clear()
        trim()


def trim() -> None:
    """Let Arrow and the C library give freed memory back, which they else keep for the worker's life (the latter has no effect where it can't)."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass
