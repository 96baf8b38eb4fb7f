"""Packing of documents into fixed windows by weighted deficit round-robin over source queues.

Each source is a queue of token ids. Time runs in small steps; at step ``v`` a queue of weight ``w``
has been served ``v * w >> SHIFT`` ids, so what a queue could not be served yet (its deficit) is the
fraction that is left over, and it is carried on exactly. A window closes as soon as it has ``size``
ids; queues that fall due in the same step are served in order, and a queue that has run dry leaves
its share to the others. Every window is full but the last one, each queue is cut wherever a window
ends, and the share of a source in each window is its weight to within one id while all queues last.

The number of ids served at any step is a formula, so every task computes the windows of its own
documents alone: no state passes from window to window or between partitions.

More sources than a node of ``QUEUES`` queues holds make a tree of such nodes. The largest sources are
queues of the root, and its last queue is the stream of ids that the nodes below it give out by the same
rule. A document of a small source is cut into the runs that its node serves; those runs are in turn cut by
the node above. A node's queue weighs what its sources weigh together.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.functions.positions import broadcast_if_small
from gridlake.llm.common import gives_memory_back, null_to_empty, small_batches, stored
from gridlake.llm.tokens import encoder, release

SIZE = 2048
SHIFT = 16  # the heaviest queue is served about one id a step; 2**47 ids a queue fit in 64 bits
QUEUES = 256  # queues of one node of the tree
CELLS = 1 << 18  # windows times queues that are computed at once
FEWEST = 16  # ids that a node below the root gives out as one window of its own
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"


class Schedule:
    """Which ids of which queue a window holds."""

    def __init__(self, sizes, weights, size: int = SIZE):
        self.sizes = np.asarray(sizes, dtype=np.int64)
        top = max((float(w) for w in weights), default=1.0) or 1.0
        self.weights = np.array([max(1, round(w / top * (1 << SHIFT))) for w in weights], dtype=np.int64)
        self.size = size
        self.last_step = int((-(-(self.sizes << SHIFT) // self.weights)).max(initial=0))

    def served(self, step: np.ndarray) -> np.ndarray:
        """Ids of each queue that are served up to each step: one row per step."""
        return np.minimum(self.sizes, (np.asarray(step, np.int64)[:, None] * self.weights) >> SHIFT)

    def window_of(self, queue: int, place: np.ndarray) -> np.ndarray:
        """The windows of the ids at ``place`` in a queue."""
        step = -(-((np.asarray(place, np.int64) + 1) << SHIFT) // self.weights[queue])
        before, after = self.served(step - 1), self.served(step)
        return (before.sum(axis=1) + (after - before)[:, :queue].sum(axis=1)) // self.size

    def bounds(self, window: np.ndarray) -> np.ndarray:
        """Ids of each queue that lie before each window: one row per window."""
        due = np.minimum(np.asarray(window, np.int64) * self.size, self.sizes.sum())
        lo, hi = np.zeros(len(due), np.int64), np.full(len(due), self.last_step, np.int64)
        while (lo < hi).any():  # the last step with at most that many ids served
            mid = (lo + hi + 1) >> 1
            fits = self.served(mid).sum(axis=1) <= due
            lo, hi = np.where(fits, mid, lo), np.where(fits, hi, mid - 1)
        base = self.served(lo)
        room = (due - base.sum(axis=1))[:, None]
        next_ = self.served(lo + 1) - base
        return base + np.clip(room - (np.cumsum(next_, axis=1) - next_), 0, next_)

    def runs(self, queue: np.ndarray, place: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """``row, start, length, at``: what the windows take of ``n`` ids from ``place`` on in ``queue``, and
        where in the stream of windows it lies; in bounded parts, however long a row is."""
        step = max(1, CELLS // len(self.sizes))
        for head in range(0, len(queue), step):
            own = slice(head, head + step)
            first, last = np.empty(len(queue[own]), np.int64), np.empty(len(queue[own]), np.int64)
            for q in np.unique(queue[own]):
                at = queue[own] == q
                first[at] = self.window_of(q, place[own][at])
                last[at] = self.window_of(q, (place[own] + n[own])[at] - 1)
            times = last - first + 1
            upto = np.cumsum(times)
            for lo in range(0, int(upto[-1]), step):
                nth = np.arange(lo, min(lo + step, int(upto[-1])))
                row = np.searchsorted(upto, nth, side="right")
                window = nth - (upto - times)[row] + first[row]
                row = row + head
                seen, at = np.unique(window, return_inverse=True)
                starts, ends = self.bounds(seen), self.bounds(seen + 1)
                served, q = ends - starts, queue[row]
                a = np.maximum(place[row], starts[at, q])
                b = np.minimum(place[row] + n[row], ends[at, q])
                to = window * self.size + (np.cumsum(served, axis=1) - served)[at, q] + a - starts[at, q]
                some = b > a  # not a window in which the queue is not served
                yield row[some], (a - place[row])[some], (b - a)[some], to[some]


def tokenised(docs: DataFrame, vocabulary_path: str, by: str, end_id: int, remembered: int | None = None) -> DataFrame:
    """Stored ``doc_id, source, ids, n, part, before``: ids with the end id, and how many ids of its
    source the rows before it in the same part have."""

    @gives_memory_back
    def encoded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = encoder(vocabulary_path, by, remembered).encode, np.array([end_id], "<u4").tobytes()
        part, seen = TaskContext.get().partitionId(), {}
        for frame in frames:
            ids, n, before = [], [], []
            for source, text in zip(frame["source"], null_to_empty(frame["text"]), strict=True):
                data = encode(text) + end
                before.append(seen.get(source, 0))
                n.append(len(data) // 4)
                seen[source] = before[-1] + n[-1]
                ids.append(np.frombuffer(data, "<u4").astype("<u2").tobytes() if small else data)
            yield frame[["doc_id", "source"]].assign(ids=ids, n=n, part=part, before=before)

    small = end_id < 65536 and _vocabulary(vocabulary_path) <= 65536
    plan = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text")
    out = plan.mapInPandas(encoded, "doc_id long, source string, ids binary, n long, part long, before long")
    with small_batches(docs.sparkSession):
        return stored(out.withColumn("wide", F.lit(not small)), "packing-ids")


def _vocabulary(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()


class Tree:
    """Schedules of nodes with at most ``queues`` queues each; node 0 gives out the windows."""

    def __init__(self, sizes: list[int], weights: list[float], size: int, queues: int):
        self.schedules: list[Schedule] = []
        self.above: list[tuple[int, int]] = []  # node and queue that take in what a node gives out
        self.leaf = [(0, 0)] * len(sizes)  # node and queue of each source
        self.queues = max(2, queues)
        self._node(sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)), sizes, weights, size, (-1, -1))

    def _node(self, members: list[int], sizes, weights, size: int, above: tuple[int, int]) -> None:
        most = self.queues
        if len(members) <= most:
            groups = [[m] for m in sorted(members)]
        elif above[0] < 0:
            groups = [[m] for m in sorted(members[: most - 1])] + [members[most - 1 :]]
        else:
            groups = [members[k::most] for k in range(most)]
        number = len(self.schedules)
        total = [sum(weights[m] for m in g) for g in groups]
        self.schedules.append(Schedule([sum(sizes[m] for m in g) for g in groups], total, size))
        self.above.append(above)
        for queue, (group, weight) in enumerate(zip(groups, total, strict=True)):
            if len(group) == 1:
                self.leaf[group[0]] = (number, queue)
            else:  # about what one window of this node takes of the one below
                share = weight / sum(total) if sum(total) else 1 / len(groups)
                self._node(group, sizes, weights, min(size, max(FEWEST, round(size * share))), (number, queue))

    def placed(self, node: np.ndarray, queue: np.ndarray, place: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """``row, start, length, at``: each row's ids in runs, and where the runs lie in the root's stream."""
        rows = np.arange(len(node))
        todo = {k: [(rows[node == k], np.zeros_like(n)[node == k], *(x[node == k] for x in (queue, place, n)))] for k in np.unique(node).tolist()}
        while todo:
            number = max(todo)  # nodes above have smaller numbers
            row, begin, q, at, length = (np.concatenate(x) for x in zip(*todo.pop(number), strict=True))
            for r, start, count, to in self.schedules[number].runs(q, at, length):
                if number == 0:
                    yield row[r], begin[r] + start, count, to
                else:
                    up, into = self.above[number]
                    todo.setdefault(up, []).append((row[r], begin[r] + start, np.full(len(r), into), to, count))


def pack(
    docs: DataFrame,
    vocabulary_path: str,
    by: str,
    end_id: int,
    size: int = SIZE,
    targets: dict[str | None, float] | None = None,
    queues: int = QUEUES,
    keep_ids: bool = False,
    remembered: int | None = None,
) -> DataFrame:
    """Every piece of every document of ``doc_id, source, text`` with its window and place in it.

    ``targets`` are weights by source (sources without one weigh 0: they are served last, at the
    slowest pace); by default a source weighs as many ids as it has, so that all queues end
    together. A null text is empty and still has its end id; a null source is a source; repeated rows are
    packed each; an empty table has no pieces. Columns of other names are not looked at. ``queues`` bounds a node of
    the tree of queues; the driver and each task hold two numbers for every source. With
    ``keep_ids`` pieces carry their ids, 32-bit little-endian. ``remembered`` bounds the words that a Python worker
    remembers (about 200 bytes each, twice); with fewer of them more words are encoded again.
    """
    ids = tokenised(docs, vocabulary_path, by, end_id, remembered)
    parts = stored(ids.groupBy("source", "part").agg(F.sum("n").alias("n")), "packing-parts")
    totals = parts.groupBy("source").agg(F.sum("n").alias("n")).collect()  # a row for each source
    totals = sorted(totals, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["n"] for r in totals]
    weights = [float(n) for n in sizes] if targets is None else [float(targets.get(r["source"], 0)) for r in totals]
    tree = Tree(sizes, weights, size, queues)

    leaves = [{"source": r["source"], "node": node, "queue": queue} for r, (node, queue) in zip(totals, tree.leaf, strict=True)]
    fields = pa.schema([("source", pa.string()), ("node", pa.int32()), ("queue", pa.int32())])
    # An Arrow table goes to the JVM as it is; a list would start Python workers of its own beside those of the stages.
    leaves = docs.sparkSession.createDataFrame(pa.Table.from_pylist(leaves, fields))
    order = Window.partitionBy("source").orderBy("part")
    base = parts.withColumn("base", F.sum("n").over(order) - F.col("n")).alias("p")
    base = base.join(leaves.alias("l"), F.col("p.source").eqNullSafe(F.col("l.source")))
    # A row for each task and source: where these are few, no ids are shuffled.
    base = broadcast_if_small(base.select("p.source", "part", "base", "node", "queue"))
    same = F.col("i.source").eqNullSafe(F.col("b.source")) & (F.col("i.part") == F.col("b.part"))
    placed = ids.alias("i").join(base.alias("b"), same).select(
        "doc_id", "i.source", "node", "queue", "ids", "n", "wide", (F.col("base") + F.col("before")).alias("place")
    )

    @gives_memory_back
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release()
        for frame in frames:
            for lo in range(0, len(frame), 512):
                yield from _pieces(frame.iloc[lo : lo + 512], tree, size, keep_ids)

    return placed.mapInPandas(cut, PIECES + (", ids binary" if keep_ids else ""))


def _pieces(frame: pd.DataFrame, tree: Tree, size: int, keep_ids: bool) -> Iterator[pd.DataFrame]:
    node, queue, place, n = (frame[c].to_numpy(np.int64) for c in ("node", "queue", "place", "n"))
    doc_id, source, ids, wide = (frame[c].to_numpy() for c in ("doc_id", "source", "ids", "wide"))
    for doc, start, length, at in tree.placed(node, queue, place, n):
        whole = {d: np.frombuffer(ids[d], "<u4" if wide[d] else "<u2").astype("<u4", copy=False) for d in np.unique(doc).tolist()}
        cuts = [whole[d][s : s + k].tobytes() for d, s, k in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)]
        out = pd.DataFrame(
            {
                "doc_id": doc_id[doc],
                "start": start,
                "length": length,
                "ids_crc32": [zlib.crc32(c) for c in cuts],
                "doc_tokens": n[doc],
                "sequence_id": at // size,
                "offset": at % size,
                "source": source[doc],
            }
        )
        if keep_ids:
            out["ids"] = cuts
        yield out
