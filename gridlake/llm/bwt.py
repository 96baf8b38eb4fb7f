"""Column-wise construction of the Burrows-Wheeler transform of a collection, with common prefixes.

Every round inserts one symbol per string, from its last one to its first: the suffixes that are one
symbol longer. Rows are suffixes in lexicographic order, ends of strings first. A row keeps its first
symbol and the row of the suffix without it; within a symbol these links ascend, so the place of a
new suffix is found among them by bisection, which is the count of equal symbols before it in the
transform. Its common prefix with a neighbour is one more than the least common prefix between the
rows that the two extend. To find repeats of many bytes the symbols are runs of ``STEP`` bytes, and a
string is read once from each of its first ``STEP`` bytes on. A round reads both columns from their first row to the last and writes them
anew; columns above ``IN_MEMORY`` bytes live in temporary files of the task.
"""

from __future__ import annotations

import tempfile

import numpy as np

IN_MEMORY = 64 * 1024 * 1024
END = -1
STEP = 8  # bytes of a symbol where repeats are looked for
BITS = 24  # of a row number
ROW = (1 << BITS) - 1
MOST = 250  # longer common prefixes are kept as this


class Column:
    """An array that is read and written as a whole, from a file if it is large."""

    def __init__(self, values: np.ndarray):
        self.file, self.held, self.kind = None, None, values.dtype
        self.write(values)

    def read(self) -> np.ndarray:
        if self.file is None:
            return self.held
        self.file.seek(0)
        return np.fromfile(self.file, self.kind)

    def write(self, values: np.ndarray) -> None:
        if values.nbytes <= IN_MEMORY:
            self.held = values
            return
        self.held = None
        if self.file is None:
            self.file = tempfile.TemporaryFile()  # no name, and gone with the task
        self.file.seek(0)
        values.tofile(self.file)
        self.file.truncate()


def collection(data: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``string, start, common, before`` of all suffixes in order: ``common`` with the row before, up to
    ``MOST``, and ``before``, the transform, which has ``END`` where a string begins.

    ``data`` has the symbols of all strings, numbers from 0 on, and ``length`` how many each has. The
    empty suffixes come first, in the order of the strings.
    """
    m = len(length)
    ends = np.cumsum(length)
    if m + len(data) > ROW or m == 0:
        raise ValueError(f"a collection has 1 to {ROW} symbols and strings")
    data = data.astype(np.int64)
    links, common = Column(np.zeros(m, np.uint64)), Column(np.zeros(m, np.uint8))
    newest = np.arange(m)  # each string's row of the last round
    for j in range(1, int(length.max()) + 1):
        link, lcp = links.read(), common.read()
        on = np.flatnonzero(length >= j)
        wanted = (data[ends[on] - j] << BITS) | newest[on]
        order = np.argsort(wanted)
        on, wanted = on[order], wanted[order]
        turn = np.searchsorted(link[m:], wanted.astype(np.uint64))
        at = m + turn + np.arange(len(turn))
        run_ends = np.append(turn[1:] != turn[:-1], True)
        # what is before each new row, and before the old row after it
        before = np.where(turn > 0, link[m + np.maximum(turn, 1) - 1] if len(link) > m else 0, 0).astype(np.int64)
        before[turn == 0] = -1
        before[1:] = np.where(run_ends[:-1], before[1:], wanted[:-1])
        after = np.flatnonzero(run_ends & (m + turn < len(link)))
        left = np.concatenate((before, wanted[after]))
        right = np.concatenate((wanted, link[m + turn[after]].astype(np.int64)))
        touched = np.concatenate((at, at[after] + 1))
        value = np.zeros(len(touched), np.uint8)
        meet = np.flatnonzero((left >= 0) & (left >> BITS == right >> BITS))
        if len(meet):
            a, b = (left[meet] & ROW) + 1, (right[meet] & ROW) + 1
            by = np.argsort(a)[::-1]  # from the last on, so that only the ranges themselves are read
            least = np.minimum.reduceat(np.append(lcp, np.uint8(0)), np.column_stack((a[by], b[by])).ravel())[::2]
            value[meet[by]] = np.minimum(least, MOST - 1) + 1
        moved = np.cumsum(np.bincount(m + turn, minlength=len(link) + 1)[: len(link)], dtype=np.int64)
        old = np.ones(len(link) + len(turn), bool)
        old[at] = False
        grown = np.empty(len(old), np.uint64)
        grown[old] = link + moved[(link & np.uint64(ROW)).astype(np.int64)].astype(np.uint64)
        grown[at] = (wanted + moved[wanted & ROW]).astype(np.uint64)
        links.write(grown)
        grown = np.empty(len(old), np.uint8)
        grown[old] = lcp
        grown[touched] = value
        common.write(grown)
        newest += moved[newest]
        newest[on] = at
    link = links.read()
    string, start = np.empty(len(link), np.int64), np.empty(len(link), np.int64)
    on, row = np.arange(m), newest
    for s in range(int(length.max()) + 1):
        string[row], start[row] = on, s
        more = length[on] > s
        on, row = on[more], (link[row[more]] & np.uint64(ROW)).astype(np.int64)
    place = (ends - length)[string] + start
    symbols = np.where(start > 0, data[np.maximum(place, 1) - 1] if len(data) else 0, END)
    return string, start, common.read(), symbols


def repeated_starts(strings: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """``string, start`` of every substring of ``length`` bytes that also starts elsewhere, sorted.

    ``length`` is a multiple of ``STEP``, so a substring is a whole number of symbols, and any two equal
    ones are read as the same symbols.
    """
    if length % STEP:
        raise ValueError(f"the length must be a multiple of {STEP}")
    sizes = np.array([len(s) for s in strings], np.int64)
    raw = np.frombuffer(b"".join(strings) + bytes(STEP), np.uint8)
    whole = np.zeros(len(raw) - STEP, np.uint64)
    for i in range(STEP):
        whole = (whole << np.uint64(8)) | raw[i : len(raw) - STEP + i]
    string = np.repeat(np.arange(len(strings)), sizes)
    start = np.arange(len(string)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = start + STEP <= sizes[string]
    string, start, whole = string[inside], start[inside], whole[inside]
    if not len(string):
        return string, start
    reading = string * STEP + start % STEP  # one reading for each string and first byte
    order = np.argsort(reading, kind="stable")
    string, start, reading = string[order], start[order], reading[order]
    symbol = np.unique(whole, return_inverse=True)[1][order]
    head = np.flatnonzero(np.concatenate(([True], reading[1:] != reading[:-1])))
    which, at, common, _ = collection(symbol, np.diff(np.append(head, len(reading))))
    with_last = common >= length // STEP
    found = with_last | np.append(with_last[1:], False)
    place = head[which[found]] + at[found]
    string, start = string[place], start[place]
    order = np.lexsort((start, string))
    return string[order], start[order]
