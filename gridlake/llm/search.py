"""Exact top-k search by BM25 over an inverted index in shards, with block-max WAND.

A shard holds the documents of about ``SHARD_BYTES`` of text in the order of their ids, so that lists
of places in the shard are lists of ids. Its lists of postings are cut into blocks of ``BLOCK``, each
with its largest term count and shortest document, from which the largest score in the block follows
once the corpus's mean length and document counts are known. Shards are bundled by term hash, so that
a query reads the bundles of its terms alone.

Within a shard the lists of a query are walked in order of documents. The first document whose lists
could together exceed the k-th best score is the pivot; if the blocks at the pivot cannot, the walk
goes on behind the nearest end of a block. Scores are rounded before they are ranked, ties go to the
smaller id, and the shards' best are merged.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.common import null_to_empty, small_batches, stored
from gridlake.llm.shingles import batches, range_hashes

K1, B = 1.2, 0.75
BLOCK = 64
BUNDLES = 32
SHARD_BYTES = 12 * 1024 * 1024
QUERIES_AT_ONCE = 64  # of one group of a shard
DIGITS = 6
SLACK = 10.0**-DIGITS

_LETTER = np.zeros(256, bool)
_LETTER[48:58] = _LETTER[97:123] = _LETTER[128:] = True

INDEX = (
    "shard long, bundle int, terms binary, counts binary, docs binary, tfs binary, "
    "block_tf binary, block_length binary, lengths binary"
)


def terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``doc, term``: a 64-bit hash of each word of each text; words are runs of ASCII digits, letters
    and all other characters beyond ASCII, in lower case."""
    docs, words = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for lo, hi in batches(texts):
        parts = [t.lower().encode("utf-8", "replace") + b"\n" for t in texts[lo:hi]]
        data = np.frombuffer(b"".join(parts), np.uint8)
        letter = _LETTER[data]
        before = np.concatenate(([False], letter[:-1]))
        start, end = np.flatnonzero(letter & ~before), np.flatnonzero(~letter & before)
        words.append(range_hashes(data, start, end))
        docs.append(np.searchsorted(np.cumsum([len(p) for p in parts]), start, side="right") + lo)
    return np.concatenate(docs), np.concatenate(words)


def index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The stored index, and ``shard, place, doc_id, length`` of every document. A null text is empty."""

    def indexed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, held, size, n = TaskContext.get().partitionId() * 1_000_000, [], 0, 0
        for frame in frames:
            for lo in range(0, len(frame), 1000):
                held.append(frame.iloc[lo : lo + 1000])
                size += int(held[-1]["text"].str.len().sum())
                if size >= SHARD_BYTES:
                    yield _shard(pd.concat(held), first + n)
                    held, size, n = [], 0, n + 1
        if held:
            yield _shard(pd.concat(held), first + n)

    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = plain.mapInPandas(indexed, INDEX + ", ids array<long>")
    with small_batches(docs.sparkSession):
        rows = stored(rows, "index")
    known = rows.where("ids IS NOT NULL").select("shard", F.posexplode("ids").alias("place", "doc_id"), "lengths")
    return rows.drop("ids"), known.drop("lengths")


def _shard(frame: pd.DataFrame, shard: int) -> pd.DataFrame:
    frame = frame.sort_values("doc_id", kind="stable", na_position="last")
    doc, term = terms(null_to_empty(frame["text"]))
    length = np.bincount(doc, minlength=len(frame)).astype(np.int32)
    order = np.argsort(term)
    order = order[np.lexsort((doc[order], term[order]))]
    term, doc = term[order], doc[order]
    new = np.ones(len(term), bool)
    new[1:] = (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    tf = np.diff(np.append(head, len(term))).astype(np.int32)
    term, doc = term[head], doc[head].astype(np.int32)
    start = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1]))) if len(term) else np.empty(0, np.int64)
    count = np.diff(np.append(start, len(term)))
    blocks = -(-count // BLOCK)
    nth = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    cut = np.repeat(start, blocks) + nth * BLOCK
    block_tf = np.maximum.reduceat(tf, cut) if len(cut) else tf
    block_length = np.minimum.reduceat(length[doc], cut) if len(cut) else tf
    names = term[start]
    bundle = (names >> np.uint64(59)).astype(np.int64)
    ids = [None if pd.isna(i) else int(i) for i in frame["doc_id"]]
    out = []
    of_block, of_posting = np.append(0, np.cumsum(blocks)), np.append(0, np.cumsum(count))
    for b in range(BUNDLES):
        lo, hi = np.searchsorted(bundle, b), np.searchsorted(bundle, b, side="right")
        p, q = slice(of_posting[lo], of_posting[hi]), slice(of_block[lo], of_block[hi])
        arrays = (names[lo:hi], count[lo:hi].astype(np.int32), doc[p], tf[p], block_tf[q], block_length[q], length)
        out.append((shard, b, *(a.tobytes() for a in arrays), ids if b == 0 else None))
    return pd.DataFrame(out, columns=["shard", "bundle", "terms", "counts", "docs", "tfs", "block_tf", "block_length", "lengths", "ids"])


def top_k(corpus: DataFrame, queries: DataFrame, k: int = 10, query_id: str = "query_id") -> DataFrame:
    """``query_id, rank, doc_id, score``: the ``k`` best documents with a positive score for each row of
    ``query_id, text``. A query counts each of its words once; one without known words has no rows."""
    rows, known = index(corpus)
    known = stored(known, "documents")
    lengths = stored(
        rows.where("bundle = 0").select("shard", "lengths").mapInPandas(_lengths, "docs long, words long"), "lengths"
    )
    of_all = lengths.agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).first()
    n_docs, n_words = int(of_all["docs"] or 0), int(of_all["words"] or 0)
    mean = n_words / n_docs if n_words else 1.0

    def words_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            doc, term = terms(null_to_empty(frame["text"]))
            yield pd.DataFrame({"query": frame["query"].to_numpy()[doc], "term": term.view(np.int64)}).drop_duplicates()

    asked = queries.select(F.col(query_id).cast("long").alias("query"), "text").where("query IS NOT NULL")
    asked = stored(asked.mapInPandas(words_of, "query long, term long").distinct(), "query-words")
    numbers = asked.select("query").distinct().count()
    group = F.pmod(F.xxhash64("query"), F.lit(max(1, -(-numbers // QUERIES_AT_ONCE)))).cast("int")
    bundle = F.shiftrightunsigned("term", 59).cast("int")
    wanted = asked.groupBy(bundle.alias("bundle")).agg(F.collect_set("term").alias("wanted"))
    found = rows.join(wanted, "bundle").mapInPandas(
        _lists, "shard long, term long, n long, docs binary, tfs binary, lengths binary, block_tf binary, block_length binary"
    )
    found = stored(found, "lists")
    counts = found.groupBy("term").agg(F.sum("n").alias("df"))
    weighted = asked.join(counts, "term").select("query", "term", F.log1p((n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    grouped = weighted.groupBy(group.alias("group"), "term").agg(F.max("idf").alias("idf"), F.collect_list("query").alias("queries"))

    def best(frame: pd.DataFrame) -> pd.DataFrame:
        return _search(frame, k, mean)

    parts = found.join(grouped, "term").groupBy("shard", "group").applyInPandas(best, "shard long, query long, place int, score double")
    named = parts.join(known, ["shard", "place"])
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("query").alias(query_id), F.col("rank").cast("long").alias("rank"), "doc_id", "score")


def _lengths(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        found = [np.frombuffer(b, np.int32) for b in frame["lengths"]]
        yield pd.DataFrame({"docs": [len(x) for x in found], "words": [int(x.sum()) for x in found]})


def _lists(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The lists of the wanted terms out of whole bundles."""
    for frame in frames:
        for r in frame.itertuples():
            names, count = np.frombuffer(r.terms, np.uint64), np.frombuffer(r.counts, np.int32).astype(np.int64)
            docs, tfs, length = (np.frombuffer(x, np.int32) for x in (r.docs, r.tfs, r.lengths))
            block_tf, block_length = np.frombuffer(r.block_tf, np.int32), np.frombuffer(r.block_length, np.int32)
            ends, block_ends = np.cumsum(count), np.cumsum(-(-count // BLOCK))
            wanted = np.asarray(r.wanted, np.int64).view(np.uint64)
            at = np.searchsorted(names, wanted)
            out = []
            for term, i in zip(wanted, at, strict=True):
                if i == len(names) or names[i] != term:
                    continue
                p = slice(ends[i] - count[i], ends[i])
                q = slice(block_ends[i] - -(-count[i] // BLOCK), block_ends[i])
                arrays = (docs[p], tfs[p], length[docs[p]], block_tf[q], block_length[q])
                out.append((r.shard, int(term.view(np.int64)), int(count[i]), *(a.tobytes() for a in arrays)))
            yield pd.DataFrame(out, columns=["shard", "term", "n", "docs", "tfs", "lengths", "block_tf", "block_length"])


class Postings:
    """A cursor on the list of one term in one shard."""

    def __init__(self, row, mean: float):
        self.docs = np.frombuffer(row.docs, np.int32).tolist()
        self.tfs, self.lengths = np.frombuffer(row.tfs, np.int32), np.frombuffer(row.lengths, np.int32)
        self.weight, self.mean, self.at = row.idf, mean, 0
        most = self.score(np.frombuffer(row.block_tf, np.int32), np.frombuffer(row.block_length, np.int32))
        self.block_most, self.most = most.tolist(), float(most.max())

    def score(self, tf, length):
        return self.weight * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / self.mean))

    def here(self) -> float:
        return float(self.score(float(self.tfs[self.at]), float(self.lengths[self.at])))

    def to(self, doc: int) -> bool:
        """Go on to the first document from ``doc`` on; false at the end."""
        self.at = bisect_left(self.docs, doc, self.at)
        return self.at < len(self.docs)

    def block_of(self, doc: int) -> tuple[float, int]:
        """Largest score of the block in which ``doc`` would be, and its last document."""
        at = bisect_left(self.docs, doc, self.at)
        if at == len(self.docs):
            return 0.0, self.docs[-1] if self.docs[-1] >= doc else 1 << 40
        block = at // BLOCK
        return self.block_most[block], self.docs[min((block + 1) * BLOCK, len(self.docs)) - 1]


def walk(lists: list[Postings], k: int) -> list[tuple[float, int]]:
    """The ``k`` best ``score, place`` by rounded score, then place."""
    best: list[tuple[float, int]] = []
    lists = [x for x in lists if x.docs]
    while lists:
        lists.sort(key=lambda x: x.docs[x.at])
        least = best[0][0] + SLACK / 2 if len(best) == k else 0.0
        bound, p = 0.0, -1
        for i, x in enumerate(lists):
            bound += x.most
            if bound + SLACK > least:
                p = i
                break
        if p < 0:
            break
        pivot = lists[p].docs[lists[p].at]
        while p + 1 < len(lists) and lists[p + 1].docs[lists[p + 1].at] == pivot:
            p += 1
        blocks = [x.block_of(pivot) for x in lists[: p + 1]]
        if sum(b[0] for b in blocks) + SLACK <= least:
            beyond = min(b[1] for b in blocks) + 1
            if p + 1 < len(lists):
                beyond = min(beyond, lists[p + 1].docs[lists[p + 1].at])
            target = max(beyond, pivot + 1)
            moved = lists[: p + 1]
        elif lists[0].docs[lists[0].at] == pivot:
            score = round(sum(sorted(x.here() for x in lists[: p + 1])), DIGITS)
            heapq.heappush(best, (score, -pivot))
            if len(best) > k:
                heapq.heappop(best)
            target, moved = pivot + 1, lists[: p + 1]
        else:
            target, moved = pivot, [x for x in lists[: p + 1] if x.docs[x.at] < pivot]
        done = [x for x in moved if not x.to(target)]
        if done:
            lists = [x for x in lists if x not in done]
    return [(s, -d) for s, d in best]


def _search(frame: pd.DataFrame, k: int, mean: float) -> pd.DataFrame:
    """All queries of one group in one shard."""
    by_query: dict[int, list] = {}
    for row in frame.itertuples():
        for query in row.queries:
            by_query.setdefault(int(query), []).append(row)
    out = []
    for query, rows in by_query.items():
        out += [(frame["shard"].iat[0], query, place, score) for score, place in walk([Postings(r, mean) for r in rows], k)]
    return pd.DataFrame(out, columns=["shard", "query", "place", "score"])
