"""Byte-level BPE ids of many texts, for use inside Arrow tasks.

The ids are those of the ``tokenizers`` library for the whole text. Most
pieces of text occur again and again, so each batch is cut into chunks at
places that are pre-token borders in any context, chunks are looked up by a
64-bit hash in a bounded table of known chunks, and only chunks not seen
before go through the tokenizer. Texts that hold the string of an added token
(such as "<|endoftext|>", which the library makes one id) go through it whole.

Where a border is certain for the byte-level pattern (contractions, letters,
digits, other characters, white space; one space joins what follows it):
between a letter and a printable ASCII character that is no letter, digit or
not, except the apostrophe; and before a run of spaces or line feeds that
follows a letter, printable ASCII character or apostrophe. Letters here are
A-Z, a-z and the Latin-1 letters. Every other character keeps its chunk whole.
"""

from __future__ import annotations

import numpy as np

SUB_BATCH = 1 << 20        # bytes encoded together
LONGEST = 64               # longer chunks (bytes) are not kept in the table
KNOWN_LIMIT = 1_000_000    # chunks in the table before it is started anew

_SPACE, _LETTER, _OTHER, _APOSTROPHE, _UNSURE = range(5)


def _classes() -> np.ndarray:
    cls = np.full(256, _UNSURE, dtype=np.uint8)
    cls[0x21:0x7f] = _OTHER
    cls[ord("A"):ord("Z") + 1] = _LETTER
    cls[ord("a"):ord("z") + 1] = _LETTER
    cls[[0x20, 0x0a]] = _SPACE
    cls[ord("'")] = _APOSTROPHE
    return cls


def _cuts() -> np.ndarray:
    cut = np.zeros((5, 5), dtype=bool)
    cut[_LETTER, _OTHER] = cut[_OTHER, _LETTER] = True
    cut[[_LETTER, _OTHER, _APOSTROPHE], _SPACE] = True
    return cut.ravel()


CLASSES, CUTS = _classes(), _cuts()


def _visible_bytes() -> str:
    """The character that stands for each byte in a byte-level vocabulary:
    printable bytes for themselves, the others numbered from U+0100."""
    shown = [*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return "".join(chr(b) if b in shown else chr(next(hidden)) for b in range(256))


class Encoder:
    """Encodes lists of texts; one per worker process and tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.visible = {b: ord(c) for b, c in enumerate(_visible_bytes())}
        rng = np.random.default_rng(7)
        self.byte_value = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        base = np.uint64(0x9E3779B97F4A7C15)
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        n = SUB_BATCH + 1
        self.power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, base, dtype=np.uint64))])
        self.inverse = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, inverse, dtype=np.uint64))])
        self._reset()

    def _reset(self) -> None:
        self.keys = np.empty(0, dtype=np.uint64)
        self.entry = np.empty(0, dtype=np.int64)    # key -> entry
        self.offset = np.empty(0, dtype=np.int64)   # entry -> place in pool
        self.length = np.empty(0, dtype=np.int64)
        self.pool = np.empty(0, dtype=np.uint32)

    def plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def one_word(self, chunk: bytes) -> list[int]:
        """Ids of letters with at most one space before them: one pre-token."""
        return [t.id for t in self.model.tokenize(chunk.decode("latin-1").translate(self.visible))]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets): text i has ids[offsets[i]:offsets[i + 1]]."""
        whole = [i for i, t in enumerate(texts) if any(a in t for a in self.added)]
        if not whole:
            return self._encode(texts)
        rest = list(texts)
        for i in whole:
            rest[i] = ""
        ids, offsets = self._encode(rest)
        n = np.diff(offsets)
        parts, done = [], 0
        for i in whole:  # one after the other: a text may be long
            own = self.plain([texts[i].encode("utf-8", "replace").decode()])[0]
            n[i] = len(own)
            parts += [ids[done:offsets[i]], np.array(own, dtype=np.uint32)]
            done = offsets[i]
        return np.concatenate([*parts, ids[done:]]), np.concatenate([[0], np.cumsum(n)])

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts without added tokens."""
        raw = [t.encode("utf-8", "replace") for t in texts]
        sizes = np.array([len(r) for r in raw], dtype=np.int64)
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        offsets = np.zeros(len(texts) + 1, dtype=np.int64)
        if not len(data):
            return np.empty(0, dtype=np.uint32), offsets
        text_at = np.concatenate([[0], np.cumsum(sizes)])
        starts, self.letters = self._chunk_starts(data, text_at)
        ends = np.append(starts[1:], len(data))
        counts = np.empty(len(starts), dtype=np.int64)
        parts, at = [], 0
        while at < len(starts):  # as many chunks as fit a sub-batch, or one long chunk
            to = int(np.searchsorted(ends, starts[at] + SUB_BATCH, side="right"))
            if to <= at:
                ids, n = self._direct(data, starts[at], ends[at])
                counts[at] = n
                to = at + 1
            else:
                ids, counts[at:to] = self._chunks(data, starts[at:to], ends[at:to])
            parts.append(ids)
            at = to
        before = np.concatenate([[0], np.cumsum(counts)])
        offsets = before[np.searchsorted(starts, text_at, side="left")]
        return np.concatenate(parts), offsets

    @staticmethod
    def _chunk_starts(data: np.ndarray, text_at: np.ndarray):
        """Starts of the chunks, and the number of letter bytes before each place."""
        cls = CLASSES[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)
        second = data[lead + 1]
        lead = lead[(second != 0x97) & (second != 0xB7)]  # the signs for times and division are no letters
        cls[lead] = _LETTER
        cls[lead + 1] = _LETTER
        cut = CUTS[cls[:-1] * 5 + cls[1:]]
        first = np.zeros(len(data), dtype=bool)
        first[1:] = cut
        first[text_at[:-1][text_at[:-1] < len(data)]] = True
        return np.flatnonzero(first), np.concatenate([[0], np.cumsum(cls == _LETTER, dtype=np.int64)])

    def _direct(self, data, start, end):
        ids = np.array(self.plain([data[start:end].tobytes().decode()])[0], dtype=np.uint32)
        return ids, len(ids)

    def _chunks(self, data, starts, ends):
        low = starts[0]
        s, e = starts - low, ends - low
        value = self.byte_value[data[low:ends[-1]]]
        total = np.concatenate([[np.uint64(0)], np.cumsum(value * self.power[:len(value)])])
        h = (total[e] - total[s]) * self.inverse[s] + (e - s).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        distinct, where, inverse = np.unique(h, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, distinct), max(len(self.keys) - 1, 0))
        known = self.keys[at] == distinct if len(self.keys) else np.zeros(len(distinct), dtype=bool)
        new = np.flatnonzero(~known)
        if len(self.keys) + len(new) > KNOWN_LIMIT and len(self.keys):
            self._reset()
            return self._chunks(data, starts, ends)
        at_entry = np.empty(len(distinct), dtype=np.int64)
        at_entry[known] = self.entry[at[known]] if len(self.keys) else 0
        if len(new):
            blob = data[low:ends[-1]].tobytes()
            s_new, e_new = s[where[new]], e[where[new]]
            rest = (e_new - s_new) - (self.letters[e_new + low] - self.letters[s_new + low])
            simple = (rest == 0) | ((rest == 1) & (data[s_new + low] == 0x20) & (e_new - s_new > 1))
            other = iter(self.plain([blob[a:b].decode() for a, b in zip(s_new[~simple], e_new[~simple])]))
            ids = [self.one_word(blob[a:b]) if one else next(other)
                   for a, b, one in zip(s_new, e_new, simple)]
            n = np.array([len(x) for x in ids], dtype=np.int64)
            first = len(self.offset)
            self.offset = np.concatenate([self.offset, len(self.pool) + np.cumsum(n) - n])
            self.length = np.concatenate([self.length, n])
            self.pool = np.concatenate([self.pool, np.fromiter((i for x in ids for i in x), np.uint32, int(n.sum()))])
            at_entry[new] = np.arange(first, first + len(new))
            keep = new[(e - s)[where[new]] <= LONGEST]
            keys = np.concatenate([self.keys, distinct[keep]])
            order = np.argsort(keys, kind="stable")
            self.keys = keys[order]
            self.entry = np.concatenate([self.entry, at_entry[keep]])[order]
        entry = at_entry[inverse]
        n = self.length[entry]
        ends_at = np.cumsum(n)
        place = np.repeat(self.offset[entry] - (ends_at - n), n) + np.arange(int(ends_at[-1]))
        return self.pool[place], n


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def groups_by_bytes(texts: list[str | None], limit: int = SUB_BATCH):
    """(from, to) ranges of a list of texts with about ``limit`` characters each."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
