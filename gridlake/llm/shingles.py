"""Hashes of words and of runs of five words, for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

RUN = 5  # words
BATCH_BYTES = 500_000

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to ``n`` modulo 2**64; the worker keeps those of one batch."""
    most = BATCH_BYTES + 200_000
    have = _powers.get(base) if n <= most else None
    if have is None:
        have = np.full(max(n, most) + 1, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= most:
            _powers[base] = have
    return have[: n + 1]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all beginnings of ``data``."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data))[:-1], out=total[1:])
    return total


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, total: np.ndarray | None = None) -> np.ndarray:
    """A hash of the bytes of each range; equal bytes have equal hashes wherever they stand."""
    total = prefix_sums(data) if total is None else total
    return mixed((total[end] - total[start]) * _power(_INVERSE, len(data))[start] + (end - start).astype(np.uint64))


def gram_hashes(data: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """The hash of the ``n`` bytes from each position on."""
    return mixed((total[n:] - total[:-n]) * _power(_INVERSE, len(data))[: len(data) - n + 1])


def batches(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Bounds of batches of texts of about ``BATCH_BYTES`` characters."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BATCH_BYTES:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``doc, hash, count``: the distinct runs of five words of each text, sorted by text and hash.

    Words are what lies between ASCII white space, in lower case. A text of one to four words has
    one shingle, all its words; a text without words has none.
    """
    parts = [t.lower().encode("utf-8", "replace") + b"\n" for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    text_end = np.cumsum([len(p) for p in parts])
    space = _SPACE[data]
    before = np.concatenate(([True], space[:-1]))
    start = np.flatnonzero(~space & before)
    end = np.flatnonzero(space & ~before)
    word = range_hashes(data, start, end)
    doc = np.searchsorted(text_end, start, side="right")
    words_of = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(words_of) - words_of
    short = np.flatnonzero((words_of > 0) & (words_of < RUN))
    head = np.flatnonzero(doc[: max(0, len(doc) - RUN + 1)] == doc[RUN - 1 :])
    total = np.zeros(len(head), np.uint64)
    factors = _power(0xD6E8FEB86659FD93, RUN)
    for k in range(RUN):
        total += word[head + k] * factors[k]
    shingle, of = [mixed(total)], [doc[head]]
    for d in short:
        own = word[first[d] : first[d] + words_of[d]]
        shingle.append(mixed((own * factors[: len(own)]).sum(dtype=np.uint64, keepdims=True)))
        of.append(np.array([d]))
    shingle, of = np.concatenate(shingle), np.concatenate(of)
    order = np.argsort(shingle)
    order = order[np.argsort(of[order], kind="stable")]
    shingle, of = shingle[order], of[order]
    new = np.ones(len(of), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(new)
    return of[at], shingle[at], np.diff(np.append(at, len(of)))
