"""Near-duplicates by ProbMinHash of word shingles, banding, and exact verification.

Every distinct run of five words is a Poisson process whose rate is its weight, which is 1 however
often it stands in the text. Its arrivals fall on random registers of the signature; a register keeps
the shingle that came first, and a shingle stops as soon as its next arrival is later than all
registers of its document. Two documents agree in a register with the probability Jaccard similarity
of their weights, here the Jaccard index of their sets of shingles, which also defines the links.
Documents that agree in all registers of a band share a bucket.

Within a bucket all members are first compared to one centre, the member that meets the most others
over all buckets, so a group of many copies costs as many comparisons as it has members. Members that
the links so far do not join to the bucket's largest class are then compared to all members of other
classes, in blocks of at most ``TILE`` signatures. So every pair of a bucket is either compared or already
in one class, and no link between classes is lost. Pairs that agree in fewer than ``PLAUSIBLE`` of
their registers end there; all others are verified by the shingles of both whole texts: the
similarity is the Jaccard index of the sets of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import components, gives_memory_back, small_batches, stored, whole_groups
from gridlake.llm.shingles import batches, mixed, shingles

BANDS, ROWS = 26, 5  # a pair of similarity 0.8 is missed in 1 of 30,000 cases
THRESHOLD = 0.8
REGISTERS = 2 * BANDS * ROWS  # the first half makes the bands, all of them estimate similarities
PLAUSIBLE = 0.7  # of the registers; a pair of similarity 0.8 agrees in fewer in 1 of 30,000 cases
FILTER_BITS = 1 << 26
TILE = 1024
ROWS_AT_ONCE = 2000


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, docs: int, registers: int) -> np.ndarray:
    """The first shingle of each register, one row per document; 0 for a document without shingles."""
    came = np.full(docs * registers, np.inf)
    who = np.zeros(docs * registers, np.uint64)
    time = np.zeros(len(shingle))
    turn = 0
    while len(shingle):
        drawn = mixed(shingle + np.uint64((turn * 0x9E3779B97F4A7C15) % 2**64))
        time = time - np.log(((drawn >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        at = doc * registers + (mixed(drawn) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(came, at, time)
        first = time == came[at]
        who[at[first]] = shingle[first]
        latest = came.reshape(docs, registers).max(axis=1)
        on = time < latest[doc]
        doc, shingle, weight, time = doc[on], shingle[on], weight[on], time[on]
        turn += 1
    return who.reshape(docs, registers)


def band_hashes(texts: list[str], bands: int = BANDS, rows: int = ROWS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``lo, hi, hashes, registers`` for batches of texts; hashes of 0 for a text without words, and
    8 bits of each register.

    A hash is a bijection of its band's number and of these 8 bits of the band's registers (at most 7
    rows), so two texts have equal hashes exactly where all registers of the band agree.
    """
    for lo, hi in batches(texts):
        doc, shingle, _ = shingles(texts[lo:hi])
        who = signatures(doc, shingle, np.ones(len(shingle)), hi - lo, REGISTERS)
        who >>= np.uint64(56)
        digits = who[:, : bands * rows].reshape(hi - lo, bands, rows) << (np.arange(rows, dtype=np.uint64) * np.uint64(8))
        number = np.arange(1, bands + 1, dtype=np.uint64) << np.uint64(8 * rows)
        out = mixed(digits.sum(axis=2, dtype=np.uint64) + number)
        out[np.bincount(doc, minlength=hi - lo) == 0] = 0
        yield lo, hi, out, who.astype(np.uint8)


def jaccard(left: list[str], right: list[str]) -> np.ndarray:
    """Similarity of the sets of shingles of each pair of texts."""
    out = np.zeros(len(left))
    for lo, hi in batches([a + b for a, b in zip(left, right, strict=True)]):
        n = hi - lo
        doc, shingle, _ = shingles(left[lo:hi] + right[lo:hi])
        pair = doc % n
        order = np.argsort(shingle)
        order = order[np.argsort(pair[order], kind="stable")]
        pair, shingle = pair[order], shingle[order]
        shared = np.bincount(pair[1:][(pair[1:] == pair[:-1]) & (shingle[1:] == shingle[:-1])], minlength=n)
        union = np.bincount(pair, minlength=n) - shared
        out[lo:hi] = shared / np.maximum(union, 1)
    return out


def sketches(texts: DataFrame) -> DataFrame:
    """``node, buckets, registers`` of each text with words; equal texts of different tasks repeat."""

    @gives_memory_back
    def sketched(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame = frame.drop_duplicates("node")
            for at in range(0, len(frame), ROWS_AT_ONCE):
                part = frame.iloc[at : at + ROWS_AT_ONCE]
                nodes = part["node"].to_numpy()
                for lo, hi, found, registers in band_hashes(list(part["text"])):
                    some = np.flatnonzero((found != 0).any(axis=1))
                    yield pd.DataFrame(
                        {
                            "node": nodes[lo:hi][some],
                            "buckets": list(found[some].view(np.int64)),
                            "registers": [r.tobytes() for r in registers[some]],
                        }
                    )

    return texts.mapInPandas(sketched, "node binary, buckets array<long>, registers binary")


def _agreeing(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left == right).mean(axis=-1) >= PLAUSIBLE


def plausible(pairs: DataFrame, registers: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose registers agree often enough."""
    left = registers.select(F.col("node").alias("a"), F.col("registers").alias("left"))
    right = registers.select(F.col("node").alias("b"), F.col("registers").alias("right"))

    @gives_memory_back
    def kept(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                both = [np.frombuffer(b"".join(frame[c]), np.uint8).reshape(len(frame), -1) for c in ("left", "right")]
                yield frame.loc[_agreeing(*both), ["a", "b"]]

    return pairs.join(left, "a").join(right, "b").mapInPandas(kept, "a binary, b binary")


def across(mixed_: DataFrame, registers: DataFrame) -> DataFrame:
    """Plausible pairs ``a, b`` of different classes within the buckets of ``bucket, band, node, root, main``.

    At least one of a pair is outside the bucket's main class. A bucket is dealt into slots, and each
    pair of slots is a block of its own.
    """
    sizes = mixed_.groupBy("bucket").agg(F.ceil(F.count("*") / TILE).alias("slots"))
    rows = mixed_.join(sizes, "bucket").withColumn("slot", F.pmod(F.xxhash64("node", "bucket"), F.col("slots")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)))
    cell = F.xxhash64("bucket", F.least("slot", "other"), F.greatest("slot", "other"))
    rows = rows.select("node", "band", F.xxhash64("root").alias("root"), (F.col("root") == F.col("main")).alias("inner"), "slot", (F.col("slot") == F.col("other")).alias("own"), cell.alias("cell"))
    rows = rows.join(registers, "node").repartition("cell").sortWithinPartitions("cell")

    @gives_memory_back
    def compared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, "cell"):
            cells = frame["cell"].to_numpy()
            head = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
            for lo, hi in zip(head, np.append(head[1:], len(frame)), strict=True):
                part = frame.iloc[lo:hi]
                register = np.frombuffer(b"".join(part["registers"]), np.uint8).reshape(hi - lo, -1)
                node, band, root, slot, inner, own = (part[c].to_numpy() for c in ("node", "band", "root", "slot", "inner", "own"))
                bands = register[:, : BANDS * ROWS].reshape(hi - lo, BANDS, ROWS)
                for x in np.flatnonzero(~inner):
                    may = root != root[x]
                    may &= inner | (np.arange(hi - lo) > x)  # two outsiders meet once
                    if not own[0]:
                        may &= slot != slot[x]
                    y = np.flatnonzero(may)
                    y = y[_agreeing(register[y], register[x])] if len(y) else y
                    if len(y):  # a pair that meets in several bands counts in the first one
                        y = y[(bands[y] == bands[x]).all(axis=2).argmax(axis=1) == band[0]]
                    if len(y):
                        yield pd.DataFrame({"a": [max(node[x], node[i]) for i in y], "b": [min(node[x], node[i]) for i in y]})

    return rows.mapInPandas(compared, "a binary, b binary")


def maybe_in(rows: DataFrame, wanted: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """All ``rows`` whose ``key`` is in ``wanted``, and few others, without a shuffle of ``rows``; with ``left_anti`` all the rest.

    The broadcast side is a bitmap of ``FILTER_BITS`` hashes, so it has at most 8 MB whatever the size
    of ``wanted``; a fuller bitmap only lets more rows through to the exact join behind it.
    """
    code = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    marks = wanted.select(code.alias("_code"), F.bitmap_bucket_number(code).alias("_bucket"))
    marks = marks.repartition("_bucket").groupBy("_bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("_code")).alias("_bits"))
    place = F.bitmap_bit_position(code)
    byte = F.conv(F.hex(F.substring("_bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = byte.bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) != 0
    return rows.join(F.broadcast(marks), (F.bitmap_bucket_number(code) == F.col("_bucket")) & marked, how)


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a, b`` whose texts are at least ``threshold`` alike; hardly any other text is shuffled."""
    pairs = stored(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    read = maybe_in(texts, wanted, "node").join(wanted, "node", "left_semi")
    read = read.groupBy("node").agg(F.first("text").alias("text"))
    read = stored(read, "texts")
    left = read.select(F.col("node").alias("a"), F.col("text").alias("left"))
    right = read.select(F.col("node").alias("b"), F.col("text").alias("right"))

    @gives_memory_back
    def compared(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lo in range(0, len(frame), 64):
                part = frame.iloc[lo : lo + 64]
                alike = jaccard(list(part["left"]), list(part["right"])) >= threshold
                yield part.loc[alike, ["a", "b"]]

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return both.mapInPandas(compared, "a binary, b binary")


def _whole(text: str) -> tuple[Column, Column]:
    """A text, null as the empty one, and the node of all texts that equal it."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return whole, F.unhex(F.md5(whole))


def _roots(texts: DataFrame, threshold: float) -> DataFrame:
    """``node, root`` of the nodes among ``texts`` (``node, text``) that have a link."""
    spark = texts.sparkSession
    with small_batches(spark, ROWS_AT_ONCE):
        sketch = stored(sketches(texts), "sketches")
    rows = sketch.select("node", F.posexplode("buckets").alias("band", "bucket"))
    code = F.xxhash64("node")  # a number aggregates in half the space of the node
    span = rows.groupBy("bucket").agg(F.min(code).alias("_min"), F.max(code).alias("_max")).where("_min != _max")
    members = stored(rows.join(span.select("bucket"), "bucket", "left_semi").distinct(), "members")
    met = members.join(members.groupBy("bucket").agg(F.count("*").alias("n")), "bucket")
    mass = met.groupBy("node").agg(F.sum("n").alias("mass"))
    heavy = members.join(mass, "node").groupBy("bucket").agg(F.max_by("node", F.struct("mass", "node")).alias("centre"))
    centred = members.join(heavy, "bucket").where("node != centre")
    star = centred.select(F.greatest("node", "centre").alias("a"), F.least("node", "centre").alias("b")).distinct()
    registers = sketch.select("node", "registers").join(mass.select("node"), "node", "left_semi").dropDuplicates(["node"])
    registers = stored(registers, "registers")
    found = verified(plausible(star, registers), texts, threshold)
    with small_batches(spark):
        links = stored(found, "links")
    roots = components(links)

    inside = members.join(roots, "node", "left").select("bucket", "band", "node", F.coalesce("root", "node").alias("root"))
    counts = inside.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    main = counts.groupBy("bucket").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("classes"))
    mixed_ = stored(inside.join(main.where("classes > 1").drop("classes"), "bucket"), "mixed")
    found = verified(across(mixed_, registers), texts, threshold)
    with small_batches(spark):
        more = stored(found, "links")
    if not more.isEmpty():
        roots = components(links.union(more))
    return roots


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, class_key: str = "class_key"
) -> DataFrame:
    """``docs`` with ``class_key``, equal for documents that links of ``threshold`` or more join.

    Equal texts are one node from the start. A null text is empty; texts without words are never
    linked, each row has a class of its own only by its id, and its key is null. All columns are
    kept; one of the name given as ``class_key`` is replaced. Repeated rows are in one class; an empty table stays empty.
    """
    whole, node = _whole(text)
    roots = _roots(docs.select(node.alias("node"), whole.alias("text")), threshold)
    kept = [c for c in docs.columns if c != class_key]
    whole_row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc")
    named = docs.select(whole_row, node.alias("node"), (F.trim(whole) == "").alias("blank"))
    found = named.join(roots, "node", "left")
    key = F.when(~F.col("blank"), F.coalesce("root", "node"))
    return found.select(*[F.col("doc")[c].alias(c) for c in kept], key.alias(class_key))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, class_id, kept``: the smallest id of each document's class, and whether it is its own."""
    keyed = near_duplicates(docs.select(doc_id, text), doc_id, text, threshold).select(F.col(doc_id).alias("doc_id"), "class_key")
    keyed = stored(keyed, "classes")
    least = keyed.where("class_key IS NOT NULL").groupBy("class_key").agg(F.min("doc_id").alias("class_id"))
    out = keyed.join(least, "class_key", "left").select("doc_id", F.when(F.col("class_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))
    return out.select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row of ``docs`` for each class: the one with the smallest id. Texts without words all stay.

    All columns keep their names and values, whatever they are called.
    """
    whole, node = _whole(text)
    texts = docs.select(F.col(doc_id).alias("id"), node.alias("node"), whole.alias("text"))
    roots = _roots(texts.select("node", "text"), threshold)
    keyed = texts.where(F.trim("text") != "").groupBy("id", "node").agg(F.count("*").alias("n"))
    keyed = stored(keyed.join(roots, "node", "left").select("id", "node", F.coalesce("root", "node").alias("key"), "n"), "keyed")
    judged = keyed.join(keyed.groupBy("key").agg(F.min("id").alias("first")), "key").withColumn("leads", F.col("id").eqNullSafe(F.col("first")))
    rows = judged.where("leads").groupBy("key").agg(F.sum("n").alias("rows"))
    marked = judged.join(rows, "key").where("NOT leads OR rows > 1").select("id", "node", "key", "leads", F.xxhash64("id", "node").alias("mark"))
    marked = stored(marked, "marked")  # most rows are not in it, and whole rows that are not are not shuffled
    columns = [F.col("d.doc")[c].alias(c) for c in docs.columns]
    whole_row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    named = docs.select(whole_row, F.col(doc_id).alias("id"), node.alias("node"), F.xxhash64(doc_id, node).alias("mark"))
    same = F.col("d.id").eqNullSafe(F.col("m.id")) & (F.col("d.node") == F.col("m.node"))
    clear = maybe_in(named, marked, "mark", "left_anti").alias("d").select(*columns)
    alike = maybe_in(named, marked, "mark").alias("d").join(marked.alias("m"), same, "left_anti").select(*columns)
    # Rows that share the smallest id of their class, of which one stays.
    tied = marked.where("leads")
    tied = maybe_in(named, tied, "mark").alias("d").join(tied.alias("m"), same).dropDuplicates(["key"]).select(*columns)
    return clear.unionByName(alike).unionByName(tied)
