"""Canonical length-limited Huffman code for token ids, vectorised.

The code lengths alone define the code: symbols are numbered in order of
(length, id). Lengths come from the package-merge method, so none exceeds
``limit``. Encoding writes the bits of a whole array at once; decoding reads
one table entry a symbol and runs over many checkpoints of a block side by
side.
"""

from __future__ import annotations

import numpy as np

LIMIT = 18           # longest code, bits; the decoding table has 2 ** LIMIT entries
CHECKPOINT = 256     # symbols between two bit-offset checkpoints


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Length of each symbol's code (0: not used), by package-merge.

    One symbol alone gets one bit. There must be at most ``2 ** limit`` symbols.
    """
    symbols = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(symbols) < 2:
        lengths[symbols] = 1
        return lengths
    if len(symbols) > 1 << limit:
        raise ValueError("more symbols than codes of that length")
    order = symbols[np.argsort(counts[symbols], kind="stable")]
    weight = counts[order].astype(np.int64)
    n = len(order)
    # rounds[r]: for each item of the merged list, is it a leaf?
    packages, rounds = np.empty(0, dtype=np.int64), []
    for _ in range(limit):
        both = np.concatenate([weight, packages])
        rank = np.argsort(both, kind="stable")
        rounds.append(rank < n)
        both = both[rank]
        packages = both[:len(both) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take = 2 * (n - 1)  # items chosen of the last list; half of them are packages of the one before
    depth = np.zeros(n + 1, dtype=np.int64)
    for leaf in reversed(rounds):
        leaves = int(leaf[:take].sum())
        depth[0] += 1
        depth[leaves] -= 1
        take = 2 * (take - leaves)
    lengths[order] = np.cumsum(depth)[:n]
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The code of each symbol as an integer of its length."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        n = lengths[order].astype(np.int64)
        share = np.int64(1) << (n.max() - n)   # codes of the longest length that each takes
        codes[order] = ((np.cumsum(share) - share) >> (n.max() - n)).astype(np.uint64)
    return codes


def decode_table(lengths: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """(symbol, length) for each ``limit``-bit window."""
    codes = canonical_codes(lengths)
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    span = np.int64(1) << (limit - lengths[used].astype(np.int64))
    symbol = np.zeros(1 << limit, dtype=np.uint32)
    length = np.ones(1 << limit, dtype=np.uint8)
    filled = int(span.sum())
    symbol[:filled] = np.repeat(used.astype(np.uint32), span)
    length[:filled] = np.repeat(lengths[used], span)
    assert not len(used) or int(codes[used[0]]) == 0
    return symbol, length


def encode(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(payload, checkpoints): the bits of all ids, and the bit offset of every
    ``CHECKPOINT``-th id."""
    if not len(ids):
        return b"", np.empty(0, dtype=np.int64)
    n = lengths[ids].astype(np.int64)
    ends = np.cumsum(n)
    at = ends - n
    word = at >> 5
    shifted = codes[ids] << (64 - n - (at & 31)).astype(np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    merged = np.bitwise_or.reduceat(shifted, first)
    words = np.zeros(int(word[-1]) + 2, dtype=np.uint32)
    words[word[first]] |= (merged >> np.uint64(32)).astype(np.uint32)
    words[word[first] + 1] |= (merged & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    payload = words.astype(">u4").tobytes()[:(int(ends[-1]) + 7) // 8]
    return payload, at[::CHECKPOINT].copy()


def decode(payload: bytes, checkpoints: np.ndarray, count: int, table: tuple[np.ndarray, np.ndarray],
           limit: int = LIMIT) -> np.ndarray:
    """The ``count`` ids of a block; all its checkpoints advance together."""
    symbol, length = table
    out = np.zeros((len(checkpoints), CHECKPOINT), dtype=np.uint32)
    data = np.frombuffer(payload + b"\0" * 8, dtype=np.uint8).astype(np.uint32)
    window = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    at = checkpoints.astype(np.int64)
    last = len(payload) * 8
    for i in range(min(CHECKPOINT, count)):
        code = (window[at >> 3] << (at & 7).astype(np.uint32)) >> np.uint32(32 - limit)
        out[:, i] = symbol[code]
        at = np.minimum(at + length[code], last)  # lanes past their last id stay inside
    return out.ravel()[:count]
