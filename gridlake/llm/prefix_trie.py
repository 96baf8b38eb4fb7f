"""The trie of all prefixes of conversations, from their sorted order alone.

Conversations are sequences of turn digests. Once they are sorted, the members of a prefix are an interval. For
the lengths that neighbours have in common (LCP) a sparse table gives the least of any range; each candidate
prefix then searches its left and its right end by halving, on its own, without a stack over the order.

The order is cut into ranges of bounded size, also between equal conversations, so that a first turn with a
third of all conversations is spread over many tasks. A prefix of the first or the last row of a range may
go on in the neighbours: its pieces are added up by key between two passes over the ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.common import stored

GROUP = 5
HEADS = 9
ENTRY = 24  # bytes of a turn: 16 of a digest of role and text, 8 of the length of the text
TURNS_PER_RANGE = 200_000
LEAST_TURNS = 2_000

NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
_PIECES = "part int, key binary, depth long, n long, conv_id long, children long"
_SECOND = f"kind string, key binary, {NODE}"


def trie(conversations: DataFrame, turns_per_range: int = TURNS_PER_RANGE) -> DataFrame:
    """Every distinct prefix of the rebuilt conversations as a node (see ``NODE`` for the columns).

    ``conversations`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are not looked at. See
    ``rebuilt`` for null, repeated and tied rows. An empty table has no node, not even a root.
    """
    spark = conversations.sparkSession
    convs = stored(rebuilt(conversations), "rebuilt")
    size = convs.agg(F.count("*").alias("n"), F.sum(F.octet_length("seq")).alias("bytes")).first()
    if not size["n"]:
        return spark.createDataFrame([], NODE)
    turns = size["n"] + size["bytes"] // ENTRY
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(-(-turns // turns_per_range), min(turns // LEAST_TURNS, slots), 1)
    rows = stored(
        convs.repartitionByRange(ranges, "seq", "conv_id").withColumn("part", F.spark_partition_id()), "ranges"
    )
    # The last row of the range before, one for each range.
    edges = rows.groupBy("part").agg(F.max(F.struct("seq", "conv_id")).alias("last"))
    edges = edges.select("part", F.lag("last.seq").over(Window.orderBy("part")).alias("before"))
    groups = rows.groupBy("part")

    pieces = stored(groups.cogroup(edges.groupBy("part")).applyInPandas(_first_pass, _PIECES), "pieces")
    totals = pieces.groupBy("key", "depth").agg(
        F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"), F.sum("children").alias("children")
    )
    # Its prefixes across ranges with their totals: at most the turns of the first and the last row of a range.
    known = pieces.select("part", "key", "depth").join(totals, ["key", "depth"])
    known = known.unionByName(edges.withColumn("depth", F.lit(-1).cast("long")), allowMissingColumns=True)
    found = stored(groups.cogroup(known.groupBy("part")).applyInPandas(_second_pass, _SECOND), "nodes")

    ends = found.where("kind = 'end'").select("key", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id")
    ends = ends.mapInPandas(_hashed_ends, "key binary, ends string")
    last = [F.first(c).alias(c) for c in ("conv_id", "parent_conv_id", "n_convs", "n_children")]
    sums = [F.sum(c).alias(c) for c in ("n_leaves", "saved_tokens")]
    across = found.where("kind = 'piece'").groupBy("key", "depth").agg(*last, *sums).join(ends, "key", "left")
    nobody = hashlib.sha256(b"").hexdigest()
    across = across.withColumn("ends_sha256", F.coalesce("ends", F.lit(nobody)))
    names = [column.split()[0] for column in NODE.split(", ")]
    return found.where("kind = 'node'").select(*names).unionByName(across.select(*names))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and ``seq``, the entries of its rebuilt turns one after the other.

    Turns are ordered by ``turn``, null first; those that tie are ordered by a digest of role and text, and
    repeated rows are turns of their own. Null role or text is empty; rows without ``conv_id`` are left out. The first
    h turns come from conversation c - c % 5, the others are its own after its first h; h is crc32(c) % 9.
    Texts are replaced by their digests before anything is shuffled; one conversation is one row of 24
    bytes a turn.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    entry = F.concat(digest, F.lpad(F.hex(F.octet_length(text)), 16, "0"))
    conv = F.col("conv_id").cast("long")
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        (conv - conv % GROUP).alias("base"),
        conv.alias("conv_id"),
        F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"), entry.alias("entry")).alias("t"),
    )
    # Dealt by base, which the join of a conversation with its base then uses as well.
    turns = turns.repartition("base")
    own = turns.groupBy("base", "conv_id").agg(F.array_sort(F.collect_list("t"))["entry"].alias("own"))
    heads = own.where("conv_id = base").select("base", F.slice("own", 1, HEADS - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    joined = own.join(heads, "base", "left").select(
        "conv_id",
        F.concat(
            F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), h),
            F.slice("own", h + 1, F.greatest(F.size("own"), F.lit(1))),
        ).alias("entries"),
    )
    return joined.select("conv_id", F.unhex(F.array_join("entries", "")).alias("seq"))


class LeastTable:
    """Sparse table over an array: the least value of any range, and how far a bound holds on either side."""

    def __init__(self, values: np.ndarray):
        self.levels = [np.asarray(values)]
        while 2 * (step := 1 << (len(self.levels) - 1)) <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def least(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Least values of the ranges from ``left`` to ``right``, both included and not empty."""
        level = np.frexp((right - left + 1).astype(np.float64))[1] - 1
        out = np.empty(len(left), self.levels[0].dtype)
        for k in np.unique(level):
            rows = level == k
            out[rows] = np.minimum(self.levels[k][left[rows]], self.levels[k][right[rows] - (1 << k) + 1])
        return out

    def left_end(self, rows: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first row from which on all values after it, up to ``rows``, are at least ``depth``."""
        at = rows.copy()
        for k in reversed(range(len(self.levels))):
            start = at - (1 << k) + 1
            ok = start >= 1
            ok[ok] = self.levels[k][start[ok]] >= depth[ok]
            at[ok] -= 1 << k
        return at

    def right_end(self, rows: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last row up to which all values after ``rows`` are at least ``depth``."""
        n, at = len(self.levels[0]), rows.copy()
        for k in reversed(range(len(self.levels))):
            ok = at + (1 << k) < n
            ok[ok] = self.levels[k][at[ok] + 1] >= depth[ok]
            at[ok] += 1 << k
        return at


class Range:
    """The pieces of nodes in one range of the sorted conversations.

    Piece k is the prefix of ``depth[k]`` turns of row ``row[k]``, the first row of the range that has it; pieces
    are ordered by row and depth. ``old`` of them, those of row 0 up to its LCP with the range before,
    go on from there; every other piece starts its node. Its members are the rows up to ``right[k]``.
    """

    def __init__(self, frame: pd.DataFrame, before: bytes | None):
        frame = frame.sort_values(["seq", "conv_id"], kind="stable", ignore_index=True)
        self.seq, self.conv = frame["seq"].tolist(), frame["conv_id"].to_numpy(np.int64)
        n = len(self.seq)
        self.length = np.array([len(s) // ENTRY for s in self.seq], np.int64)
        first = np.cumsum(self.length) - self.length
        data = b"".join(self.seq) + bytes(ENTRY)  # never empty
        turns = np.frombuffer(data, f"V{ENTRY}")
        self.bytes = np.frombuffer(data, ">i8").reshape(-1, ENTRY // 8)[:, -1].astype(np.int64)
        self.first = first

        self.lcp = np.zeros(n, np.int64)
        same = np.arange(1, n)
        depth = 0
        while len(same):
            same = same[(self.length[same] > depth) & (self.length[same - 1] > depth)]
            same = same[turns[first[same] + depth] == turns[first[same - 1] + depth]]
            depth += 1
            self.lcp[same] = depth
        self.lcp[0] = -1 if before is None else _common(before, self.seq[0])
        self.old = self.lcp[0] + 1
        self.table = LeastTable(self.lcp)

        starts = self.length - self.lcp
        starts[0] = self.length[0] + 1  # the pieces of row 0 are all its prefixes, the empty one too
        self.begin = np.cumsum(starts) - starts
        self.end = self.begin + starts
        self.row = np.repeat(np.arange(n), starts)
        lowest = self.lcp + 1
        lowest[0] = 0
        self.depth = np.arange(len(self.row)) - self.begin[self.row] + lowest[self.row]
        self.right = self.table.right_end(self.row, self.depth)
        # Old pieces are no starts: children and sums count from the first start on.
        self.from_ = np.maximum(np.arange(len(self.row)), self.old)
        self.n = self.right - self.row + 1
        self.conv_id = LeastTable(self.conv).least(self.row, self.right)
        self.children = self._children()
        # A prefix of the first or the last row may have members in other ranges.
        self.shared = (self.row == 0) | (self.right == n - 1)

    def _children(self) -> np.ndarray:
        """Starts one turn deeper among the starts of the rows of each piece."""
        m = len(self.row) + 1
        starts = np.arange(self.old, m - 1)
        order = np.sort(self.depth[starts] * m + starts)
        deeper = (self.depth + 1) * m
        return np.searchsorted(order, deeper + self.end[self.right]) - np.searchsorted(order, deeper + self.from_)

    def keys(self) -> dict[int, bytes]:
        """Digests of the prefixes that are shared, by piece."""
        out = {}
        for row in np.unique(self.row[self.shared]):
            shared = [k for k in range(self.begin[row], self.end[row]) if self.shared[k]]
            digest, done = hashlib.md5(), 0
            for k in shared:
                upto = int(self.depth[k]) * ENTRY
                digest.update(self.seq[row][done:upto])
                done = upto
                out[k] = digest.copy().digest()
        return out

    def parents(self) -> np.ndarray:
        """The piece one turn up of every piece; the root has itself."""
        k = np.arange(len(self.row))
        up = k - 1
        head = (k == self.begin[self.row]) & (self.row > 0)
        left = self.table.left_end(self.row[head], self.depth[head] - 1)
        up[head] = self.begin[left] + self.depth[head] - 1 - self.depth[self.begin[left]]
        return np.maximum(up, 0)


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b)) // ENTRY
    x, y = (np.frombuffer(s, f"V{ENTRY}", n) for s in (a, b))
    different = np.flatnonzero(x != y)
    return int(different[0]) if len(different) else n


def _before(edges: pd.DataFrame) -> bytes | None:
    value = edges["before"].iloc[0]
    return None if value is None else bytes(value)


def _first_pass(rows: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
    """The shared pieces of a range."""
    own = Range(rows, _before(edges))
    keys = own.keys()
    k = np.array(list(keys), np.int64)
    return pd.DataFrame(
        {
            "part": rows["part"].iloc[0],
            "key": list(keys.values()),
            "depth": own.depth[k],
            "n": own.n[k],
            "conv_id": own.conv_id[k],
            "children": own.children[k],
        }
    )


def _second_pass(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """Whole nodes, pieces of shared nodes with their share of the sums, and the members that end at those."""
    own = Range(rows, _before(known[known["depth"] < 0]))
    known = known[known["depth"] >= 0]
    totals = dict(zip(map(bytes, known["key"]), zip(known["n"], known["conv_id"], known["children"], strict=True), strict=True))
    n, conv_id, children = own.n.copy(), own.conv_id.copy(), own.children.copy()
    keys = own.keys()
    for k, key in keys.items():
        n[k], conv_id[k], children[k] = totals[key]

    bytes_ = np.zeros(len(n), np.int64)
    deep = own.depth > 0
    bytes_[deep] = own.bytes[own.first[own.row[deep]] + own.depth[deep] - 1]
    sums = []
    for value in (children == 0, (n - 1) * bytes_):
        upto = np.concatenate([[0], np.cumsum(value, dtype=np.int64)])
        sums.append(upto[own.end[own.right]] - upto[own.from_])
    parent = conv_id[own.parents()].astype(object)
    parent[own.depth == 0] = None

    ends = [None] * len(n)
    members = []
    for k in np.flatnonzero(own.length[own.row] == own.depth):
        # Those that end here are the rows from the first on that are equal to it.
        low, high = own.row[k], own.right[k]
        same = np.searchsorted(own.length[low : high + 1] > own.depth[k], True)
        ids = own.conv[low : low + same]
        if k in keys:
            members += [(keys[k], int(i)) for i in ids]
        else:
            ends[k] = hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()
    nobody = hashlib.sha256(b"").hexdigest()
    out = pd.DataFrame(
        {
            "kind": ["piece" if k in keys else "node" for k in range(len(n))],
            "key": [keys.get(k) for k in range(len(n))],
            "conv_id": conv_id,
            "depth": own.depth,
            "parent_conv_id": pd.array(parent, "Int64"),
            "n_convs": n,
            "n_children": children,
            "n_leaves": sums[0],
            "saved_tokens": sums[1],
            "ends_sha256": [e or nobody for e in ends],
        }
    )
    if not members:
        return out
    end = pd.DataFrame(members, columns=["key", "conv_id"])
    return pd.concat([out, end.assign(kind="end")], ignore_index=True)[out.columns].convert_dtypes()


def _hashed_ends(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the ids of each key. Ids come in order and are hashed as they come, however many they are."""
    key, digest = None, None
    for frame in frames:
        done = []
        found = frame["key"].map(bytes)
        for k, ids in frame.groupby((found != found.shift()).cumsum(), sort=False):
            k = found[ids.index[0]]
            if k != key:
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest, lead = k, hashlib.sha256(), ""
            else:
                lead = ","
            digest.update((lead + ",".join(map(str, ids["conv_id"].tolist()))).encode())
        yield pd.DataFrame(done, columns=["key", "ends"])
    if key is not None:
        yield pd.DataFrame([(key, digest.hexdigest())], columns=["key", "ends"])
