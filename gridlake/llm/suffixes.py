"""Removal of byte strings that repeat anywhere in a corpus, found in suffix order.

The corpus is cut into small collections between which nothing can repeat. Every string of ``MATCH``
bytes contains a least hashed run of ``grams`` bytes; equal strings have equal least runs. Neighbouring
strings with the same one form a piece, and pieces meet by its hash, their key. Pieces with the same
bytes are counted before the shuffle, and where there are several, all of their strings repeat. What is
left are pieces with a key in common and different bytes: these collections are sorted by the
column-wise construction of :mod:`gridlake.llm.bwt`, and a string repeats if its suffix shares
``MATCH`` bytes with a neighbour.

A key with more than ``MOST_PIECES`` different pieces (a passage that
thousands of documents share has one at either end) is not given to one task: its pieces are cut
again with longer runs, up to a whole string, where the key alone decides; so every string is compared, whatever the
size of its group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.bwt import repeated_starts
from gridlake.llm.common import null_to_empty, stored, whole_groups
from gridlake.llm.shingles import BATCH_BYTES, gram_hashes, prefix_sums, range_hashes

MATCH = 200
GRAMS = (64, 128, 176, 200)  # bytes, of one cut after the other
LONGEST = 200  # strings in a piece
MOST_PIECES = 256
COLLECTION = 1000  # pieces that are sorted together


def pieces(texts: list[bytes], grams: int) -> tuple[np.ndarray, ...]:
    """``text, start, count, key, content, own``: runs of neighbouring strings with the same least run of bytes.

    ``content`` is a hash of all bytes of the piece. ``own`` says that its least run stands in it more
    than once, as in periodic text, so that strings of the piece may repeat each other.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    width = MATCH - grams + 1
    if len(data) < MATCH:
        none = np.empty(0, np.int64)
        return none, none, none, none, none, none.astype(bool)
    total = prefix_sums(data)
    gram = gram_hashes(data, grams, total)
    n = len(gram)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max)
    padded[:n] = gram
    rows = padded.reshape(-1, width)  # least of each window from the two rows that it touches
    upto = np.minimum.accumulate(rows, axis=1).ravel()
    since = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    key = np.minimum(since[: n - width + 1], upto[width - 1 : n])
    start = np.arange(len(key))
    text = np.searchsorted(ends, start, side="right")
    whole = start + MATCH <= ends[text]
    start, text, key = start[whole], text[whole], key[whole]
    new = np.ones(len(start), bool)
    new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    new |= (np.arange(len(start)) - np.repeat(head, np.diff(np.append(head, len(start))))) % LONGEST == 0
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(start)))
    start, text = start[head], text[head]
    content = range_hashes(data, start, start + count + MATCH - 1, total)
    span = count + width - 1
    first = np.cumsum(span) - span
    place = np.arange(span.sum()) - np.repeat(first - start, span)
    same = gram[place] == np.repeat(key[head], span)
    own = np.add.reduceat(same, first, dtype=np.int64) > 1 if len(head) else np.empty(0, bool)
    within = start - (ends - np.array([len(t) for t in texts]))[text]
    return text, within, count, key[head].view(np.int64), content.view(np.int64), own


def _cut(items: DataFrame, grams: int, packed: bool) -> DataFrame:
    """``key, content, uid, item, lo, n, own`` of the pieces of ``uid, item, data``."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            lo = 0
            while lo < len(frame):
                texts, size = [], 0
                while lo + len(texts) < len(frame) and size < BATCH_BYTES:
                    data = frame["data"].iat[lo + len(texts)]
                    texts.append(_plain(data) if packed else data)
                    size += len(texts[-1])
                text, start, count, key, content, own = pieces(texts, grams)
                item = frame["item"].to_numpy()[lo + text]
                yield pd.DataFrame(
                    {"key": key, "content": content, "uid": frame["uid"].to_numpy()[lo + text], "item": item, "lo": item + start, "n": count, "own": own}
                )
                lo += len(texts)

    return items.mapInPandas(cut, "key long, content long, uid long, item long, lo long, n int, own boolean")


def _packed(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(data)


def _plain(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def numbered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Stored ``uid, doc_id, data``: a number for each row and its compressed bytes."""

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            data = [_packed(t.encode("utf-8", "replace")) for t in null_to_empty(frame["text"])]
            yield frame[["doc_id"]].assign(data=data)

    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = plain.mapInPandas(packed, "doc_id long, data binary")
    return stored(rows.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "data"), "texts")


def repeats(items: DataFrame) -> DataFrame:
    """``uid, lo, hi``: ranges of starts of strings of ``MATCH`` bytes that also start elsewhere.

    ``items`` are stored rows ``uid, item, data``: compressed bytes that begin at place ``item`` of
    text ``uid``; the bytes of later cuts are not compressed.
    """
    covers = []
    for grams in GRAMS:
        cut = stored(_cut(items, grams, grams == GRAMS[0]), "pieces")
        met = cut.groupBy("key").agg(F.count("*").alias("_n"), F.max("own").alias("_own"))
        met = met.where("_n > 1 OR _own").select("key")
        cut = stored(cut.join(met, "key", "left_semi"), "pieces-met")
        place = F.struct("uid", "lo", "item")
        same = cut.groupBy("key", "content", "n").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.max("own").alias("own"))
        same = stored(same, "classes")
        twice = same.where("first.uid != last.uid OR first.lo != last.lo").select("key", "content", "n")
        covers.append(cut.join(twice, ["key", "content", "n"], "left_semi").select("uid", "lo", (F.col("lo") + F.col("n")).alias("hi")))
        kinds = same.groupBy("key").agg(F.count("*").alias("kinds"), F.max("own").alias("_own"))
        kinds = kinds.where("kinds > 1 OR _own").drop("_own")
        wanted = same.join(kinds, "key").select("key", "kinds", "n", "first.uid", "first.item", "first.lo")
        wanted = wanted.groupBy("uid", "item").agg(F.collect_list(F.array("key", "kinds", "lo", F.col("n").cast("long"))).alias("wanted"))
        read = stored(_sliced(items.join(wanted, ["uid", "item"]), grams == GRAMS[0]), "piece-bytes")
        fits = F.lit(grams == GRAMS[-1]) | (F.col("kinds") <= MOST_PIECES)  # at last a key has LONGEST kinds
        small = read.where(fits).drop("kinds")
        covers.append(stored(_sorted(small.repartition("key").sortWithinPartitions("key")), "repeats"))
        items = read.where(~fits).select("uid", F.col("lo").alias("item"), "data")
        if items.isEmpty():
            break
    return reduce(DataFrame.union, covers)


def _sliced(items: DataFrame, packed: bool) -> DataFrame:
    def sliced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for uid, item, data, wanted in zip(frame["uid"], frame["item"], frame["data"], frame["wanted"], strict=True):
                whole = _plain(data) if packed else data
                for key, kinds, lo, n in wanted:
                    out.append((key, kinds, uid, lo, whole[lo - item : lo - item + n + MATCH - 1]))
            yield pd.DataFrame(out, columns=["key", "kinds", "uid", "lo", "data"])

    return items.mapInPandas(sliced, "key long, kinds long, uid long, lo long, data binary")


def _sorted(read: DataFrame) -> DataFrame:
    """Repeats within the keys of ``key, uid, lo, data``, which has equal keys side by side."""

    def found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, "key"):
            key = frame["key"].to_numpy()
            bounds = np.append(np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))), len(key))
            lo = 0
            while lo < len(frame):  # whole keys, as many as make a collection
                hi = int(bounds[max(np.searchsorted(bounds, lo + COLLECTION, "right") - 1, np.searchsorted(bounds, lo, "right"))])
                part = frame.iloc[lo:hi]
                string, start = repeated_starts(list(part["data"]), MATCH)
                new = np.ones(len(string), bool)
                new[1:] = (string[1:] != string[:-1]) | (start[1:] != start[:-1] + 1)
                head = np.flatnonzero(new)
                begin = part["lo"].to_numpy()[string[head]] + start[head]
                yield pd.DataFrame(
                    {"uid": part["uid"].to_numpy()[string[head]], "lo": begin, "hi": begin + np.diff(np.append(head, len(string)))}
                )
                lo = hi

    return read.mapInPandas(found, "uid long, lo long, hi long")


def spans_of(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The maximal runs of bytes that strings starting in the sorted ``ranges`` cover."""
    out: list[tuple[int, int]] = []
    for lo, hi in ranges:
        hi += MATCH - 1
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, data, spans, kept``: bytes of each text, the removed ranges of bytes, and what is left.

    A null text is empty. Every row is a text of its own, also where ids or texts repeat: equal texts
    of ``MATCH`` bytes and more lose all of their bytes.
    """
    texts = numbered(docs, doc_id, text)
    ranges = repeats(texts.select("uid", F.lit(0).cast("long").alias("item"), "data"))
    by_text = ranges.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("ranges"))

    def removed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            whole = [_plain(d) for d in frame["data"]]
            spans = [spans_of([(r["lo"], r["hi"]) for r in rs]) if rs is not None else [] for rs in frame["ranges"]]
            kept = []
            for data, cuts in zip(whole, spans, strict=True):
                bounds = [0, *(x for cut in cuts for x in cut), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True)))
            spans = [[{"lo": a, "hi": b} for a, b in cuts] for cuts in spans]
            yield frame[["doc_id"]].assign(n_bytes=[len(d) for d in whole], spans=spans, kept=kept)

    joined = texts.join(by_text, "uid", "left").select("doc_id", "data", "ranges")
    return joined.mapInPandas(removed, "doc_id long, n_bytes long, spans array<struct<lo: long, hi: long>>, kept binary")


def digest(found: DataFrame) -> DataFrame:
    """Numbers and a checksum instead of the bytes that :func:`without_repeats` returns."""
    return found.select(
        "doc_id",
        "n_bytes",
        F.expr("aggregate(spans, 0L, (s, x) -> s + x.hi - x.lo)").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
