"""Exact byte-pair encoding in batches, for the two kinds of vocabulary file of the tokenizers library.

A text is cut at places that no token can cross, and each distinct piece is encoded once per batch. Pieces of
Latin letters, digits and signs are split by the vocabulary's own pattern and merged here, all unseen ones of a
batch together: in each round every word merges its leftmost pair of lowest rank. Any other piece, and any
that may hold a special token, goes to the library itself. Ids equal the library's.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

from ledgerwatch.llm import text as X

#: Pieces whose ids a worker keeps, and the longest word that is merged here.
KEPT, LONGEST, ROUND = 600_000, 48, 32_768
_NONE = np.int32(2**31 - 1)
_LETTER, _DIGIT = "a-zA-ZªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼½¾"
_SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
_REST = rf"[^\s\0{_LETTER}{_DIGIT}]+"
#: The patterns of the two vocabularies for plain characters; a zero byte ends a piece.
_BYTE_WORDS = re.compile(rf"\0|{_SHORT}| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?{_REST}|\s+(?![^\s\0])|\s+")
_LOWER_WORDS = re.compile(rf"\0|{_SHORT}|[{_LETTER}]+|[{_DIGIT}]|{_REST}")
_END = b"\xff" * 4
#: Bytes that no plain piece has: controls, and first bytes of characters beyond U+017F.
_STRANGE = np.isin(np.arange(256), [*range(1, 10), *range(11, 32), 127, *range(0xC6, 256)])
_CUT = re.compile(r"(?<=[^\s\x1c-\x1f])(?=[ \n])")
#: Bytes that may belong to white space other than space and newline.
_ODD = np.isin(np.arange(256), [9, 11, 12, 13, 28, 29, 30, 31, 0xC2, 0xE1, 0xE2, 0xE3])


class Table:
    """Numbers by 64-bit key: open addressing in two arrays, looked up for many keys at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.keys, self.values = np.full(1 << self.bits, ~np.uint64(0)), np.full(1 << self.bits, -1, np.int32)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[at[left]] == ~np.uint64(0)
            _, first = np.unique(at[left], return_index=True)
            wins = np.zeros(len(left), bool)
            wins[first] = True
            put = left[wins & free]
            self.keys[at[put]], self.values[at[put]] = keys[put], values[put]
            left = left[~(wins & free)]
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * X.GOLDEN) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        at = self._slot(keys)
        out, found = self.values[at], self.keys[at]
        open_ = np.flatnonzero((found != keys) & (out >= 0))
        out[found != keys] = -1
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            found, value = self.keys[at[open_]], self.values[at[open_]]
            same = found == keys[open_]
            out[open_[same]] = value[same]
            open_ = open_[~same & (value >= 0)]
        return out


@lru_cache(1)
def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """A vocabulary file: symbols of bytes, merges by rank, and the library's own tokenizer for odd pieces."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        ids, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.by_words = bool(end)
        chars = byte_characters()
        self.symbol = np.array([ids[c] for c in chars], np.int32)
        self.last = np.array([ids[c + end] for c in chars], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        key = np.array([[ids[a], ids[b]] for a, b in pairs], np.uint64)
        self.ranks = Table((key[:, 0] << np.uint64(32)) | key[:, 1], np.arange(len(pairs), dtype=np.int32))
        self.made = np.array([ids[a + b] for a, b in pairs], np.int32)
        self.kept = KEPT
        self.pieces: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {"\0": _END}
        back = {c: b for b, c in enumerate(chars)}
        names = sorted((i, t) for t, i in (ids | self.library.get_vocab(True)).items())
        known = {i: bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for i, t in names}
        parts = [known.get(i, b"") for i in range(max(known) + 1)]
        self.sizes = np.array([len(p) for p in parts])
        self.begins, self.bytes = np.cumsum(self.sizes) - self.sizes, np.frombuffer(b"".join(parts), np.uint8)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)
        found = self.ranks.get(keys.ravel()).reshape(keys.shape)
        return np.where((a < 0) | (b < 0) | (found < 0), _NONE, found)

    def _merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of about equal length, as little-endian unsigned 32-bit numbers."""
        size = np.array([len(w) for w in words])
        n, width = len(words), int(size.max()) + 1
        symbols = np.full((n, width), -1, np.int32)
        inside = np.arange(width)[None, :] < size[:, None]
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols[inside] = self.symbol[raw]
        symbols[np.arange(n), size - 1] = self.last[raw[np.cumsum(size) - 1]]
        follow = np.tile(np.arange(1, width + 1, dtype=np.int16), (n, 1))
        before = follow - 2
        rank = np.full((n, width), _NONE, np.int32)
        rank[:, :-1] = self._rank(symbols[:, :-1], symbols[:, 1:])
        open_ = np.arange(n)
        while len(open_):
            at = rank[open_].argmin(1)
            best = rank[open_, at]
            going = best < _NONE
            open_, at, best = open_[going], at[going], best[going]
            if not len(open_):
                break
            gone = follow[open_, at].astype(np.int64)
            after = follow[open_, gone].astype(np.int64)
            symbols[open_, at] = self.made[best]
            symbols[open_, gone] = -2
            rank[open_, gone] = _NONE
            follow[open_, at] = after
            stop = np.minimum(after, width - 1)
            before[open_, stop] = np.where(after < width, at, before[open_, stop])
            right = np.where(after < width, symbols[open_, stop], -1)
            rank[open_, at] = self._rank(self.made[best], right)
            left = before[open_, at].astype(np.int64)
            some = left >= 0
            rows, left = open_[some], left[some]
            rank[rows, left] = self._rank(symbols[rows, left], self.made[best[some]])
        alive = symbols >= 0
        flat, cut = symbols[alive].astype("<u4").tobytes(), 4 * np.concatenate([[0], np.cumsum(alive.sum(1))])
        return [flat[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]

    def merge(self, words: list[bytes]) -> list[bytes]:
        words_by_size = sorted(range(len(words)), key=lambda i: len(words[i]))
        out: list[bytes] = [b""] * len(words)
        for low in range(0, len(words), ROUND):
            own = words_by_size[low : low + ROUND]
            for i, ids in zip(own, self._merge([words[i] for i in own]), strict=True):
                out[i] = ids
        return out

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words as the pattern finds them."""
        out, own, long_ = {}, [], []
        for w in words:
            (own if len(w) <= LONGEST else long_).append(w)
        out |= zip(own, self.merge([w.encode() for w in own]) if own else (), strict=True)
        out |= zip(long_, self._library(long_), strict=True)
        return [out[w] for w in words]

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch(texts, add_special_tokens=False)] if texts else []

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of texts that stand for themselves. The plain ones are split in one go, with _END after each."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1
        ends = np.cumsum(size)
        raw = np.frombuffer(b"\0".join([*pieces, b""]), np.uint8)
        before, after = raw[:-1], raw[1:]
        strange = np.zeros(len(raw), bool)
        strange[:] = _STRANGE[raw]
        strange[:-1] |= ((before == 0xC2) & (after <= 0xA0)) | ((before == 0xC4) & (after == 0xB0)) | ((before == 0x3C) & (after == 0x7C))
        # A zero byte ends each piece; one more in it makes the piece odd.
        zeros = np.diff(np.searchsorted(np.flatnonzero(raw == 0), ends - 1, "right"), prepend=0) > 1
        odd = np.diff(np.searchsorted(np.flatnonzero(strange), ends), prepend=0).astype(bool) | zeros
        plain = pieces if not odd.any() else [p for p, o in zip(pieces, odd.tolist(), strict=True) if not o]
        text = b"\0".join([*plain, b""]).decode()
        found = (_LOWER_WORDS if self.by_words else _BYTE_WORDS).findall(text.lower() if self.by_words else text)
        if len(self.words) > self.kept:
            self.words.clear()
        self.words["\0"] = _END
        unseen = list(set(found).difference(self.words))
        self.words.update(zip(unseen, self._words(unseen), strict=True))
        flat = b"".join(map(self.words.__getitem__, found))
        cut = 4 * np.flatnonzero(np.frombuffer(flat, "<u4") == 0xFFFFFFFF)
        own = [flat[a:b] for a, b in zip([0, *(cut[:-1] + 4).tolist()], cut.tolist(), strict=False)]
        if len(own) == len(pieces):
            return own
        rest = iter(self._library([p.decode("utf-8", "replace") for p, o in zip(pieces, odd.tolist(), strict=True) if o]))
        mine = iter(own)
        return [next(rest) if o else next(mine) for o in odd.tolist()]

    def cut(self, texts: list[bytes], odd: np.ndarray) -> list[list[bytes]]:
        """Keys of the pieces of each text; `odd` marks texts with other white space than single spaces and newlines."""
        if self.by_words:
            return [t.split() for t in texts]
        out = []
        for t, strange in zip(texts, odd.tolist(), strict=True):
            if strange:
                out.append([b" " + p.encode() for p in _CUT.split(t.decode("utf-8", "replace"))])
            else:
                keys = t.replace(b"\n", b" \n").split(b" ")
                keys[0] = b" " + keys[0]
                out.append(keys)
        return out

    def piece(self, key: bytes) -> bytes:
        """What a key of `cut` stands for: itself after a space, a line that it begins, or a word after a space."""
        return key if self.by_words or key[:1] == b"\n" else key[1:] if key[:1] == b" " else b" " + key

    def keys(self, texts) -> list[list[bytes]]:
        """Keys of the pieces of an Arrow array of texts."""
        buf, at = X.bytes_of(texts)
        gap = (buf == 32) | (buf == 10)
        strange = _ODD[buf]
        strange[1:] |= gap[1:] & gap[:-1]
        marks = np.diff(np.searchsorted(np.flatnonzero(strange), at)) > 0
        raw = buf.tobytes()
        return self.cut([raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], marks)

    def encode(self, texts, known=None) -> list[bytes]:
        """Ids of each text of an Arrow array, as little-endian unsigned 32-bit numbers; null is the empty text.

        `known(keys)` may return the ids of a list of keys, None where it has none.
        """
        keys = self.keys(texts)
        if len(self.pieces) > self.kept:
            self.pieces.clear()
        unseen = list(set().union(*keys).difference(self.pieces))
        if known is not None and unseen:
            found = known(unseen)
            self.pieces.update((k, ids) for k, ids in zip(unseen, found, strict=True) if ids is not None)
            unseen = [k for k, ids in zip(unseen, found, strict=True) if ids is None]
        self.pieces.update(zip(unseen, self.encode_pieces([self.piece(k) for k in unseen]), strict=True))
        get = self.pieces.__getitem__
        return [b"".join(map(get, k)) for k in keys]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that ids of a byte-level vocabulary stand for."""
        size = self.sizes[ids]
        ends = np.cumsum(size)
        return self.bytes[np.repeat(self.begins[ids] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)].tobytes()


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    """One per worker and file."""
    return Vocabulary(path)
