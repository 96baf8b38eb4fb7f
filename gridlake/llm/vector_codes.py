"""Codes of vectors: each part of a vector becomes the number of the nearest entry in the codebook of its position.

Codebooks are fitted by Lloyd's rounds over members that stay where they are: the parts of all vectors lie in
files dealt by (position, entry, salt). An owner of an entry sums its resident members, the few new entries go
to every task, members are assigned again in place, and only those that change their entry are shuffled to
their new owner. The salt spreads an entry with many members over several owners.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.llm.common import free_name, joined_by_key, stored
from gridlake.session import new_scratch

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LARGEST = 1 << 28  # of an integer component; squared distances then fit 64 bits
MEMBERS_PER_OWNER = 1_000_000
BATCH = 8192  # parts whose distances to all entries are in memory at once

_STATE = "rid long, position int, salt int, entry int, values array<int>, moved boolean"
_OWNER = ("position", "entry", "salt")


def codes(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", keep: tuple[str, ...] = ()
) -> DataFrame:
    """``vec_id``, ``keep`` and ``code``, ``error``, ``label_error``, ``codebooks_sha256`` of every vector.

    Left out are vectors that are null or empty or hold null or non-finite components, and those that differ
    in length from the vector with the smallest id. Components become ``floor(256 x)``; one beyond 2^28
    is an error, as distances would not be exact. A length that is no multiple of 16 is filled up with
    zeros. Rows that tie in ``vec_id`` (null last) are ordered by their vector; each repeated row has a row of the
    result. With fewer than 64 vectors codebooks are shorter, and an empty table gives an empty result. A
    result column whose name is taken gets underscores until it is free.
    """
    x = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    too_large = F.raise_error(F.lit(f"a component is beyond {LARGEST} after scaling")).cast("array<int>")
    whole = F.transform(x, lambda c: F.floor(c * SCALE).cast("int"))
    whole = F.when(F.exists(x, lambda c: F.abs(c * SCALE) > LARGEST), too_large).otherwise(whole)
    row = F.struct(*[F.col(f"`{c}`") for c in dict.fromkeys((vec_id, *keep))]).alias("row")
    kept = df.where(finite & (F.size(x) > 0)).select(
        row, F.struct(F.col(f"`{label}`").alias("label")).alias("label"), F.col(f"`{vec_id}`").alias("id"), whole.alias("x")
    )
    kept = stored(kept.withColumn("rid", F.monotonically_increasing_id()), "vectors")

    # The 64 first vectors are the codebooks; no more of the table comes to the driver.
    first = kept.orderBy(F.asc_nulls_last("id"), "x").select("x").limit(ENTRIES).collect()
    taken = [vec_id, *keep]
    names = {n: free_name(n, taken) for n in ("code", "error", "label_error", "codebooks_sha256")}
    size = len(first[0]["x"]) if first else 0
    kept = kept.where(F.size("x") == size)
    books = codebooks([r["x"] for r in first if len(r["x"]) == size])
    if first:
        books = fitted(kept, books, members=MEMBERS_PER_OWNER)
    found = assigned_codes(kept, books)

    totals = found.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    out = joined_by_key(found, totals, "label", "n")
    return out.select(
        *[F.col(f"row.`{c}`") for c in dict.fromkeys(taken)],
        *[F.col(c).alias(names[c]) for c in ("code", "error", "label_error")],
        F.lit(digest(books, size)).alias(names["codebooks_sha256"]),
    )


def codebooks(vectors) -> np.ndarray:
    """The parts of ``vectors`` by position, filled up with zeros to equal parts."""
    if not len(vectors):
        return np.zeros((PARTS, 0, 1), np.int64)
    x = np.asarray(vectors, np.int64)
    x = np.pad(x, ((0, 0), (0, -x.shape[1] % PARTS)))
    return x.reshape(len(vectors), PARTS, -1).transpose(1, 0, 2)


def digest(books: np.ndarray, size: int) -> str:
    """SHA-256 of all entries, without the zeros that fill up the last parts."""
    width = books.shape[2]
    parts = [e[: max(0, size - p * width)] for p, entries in enumerate(books) for e in entries.tolist()]
    return hashlib.sha256(",".join(str(c) for part in parts for c in part).encode()).hexdigest()


def fitted(kept: DataFrame, books: np.ndarray, members: int, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks after ``rounds`` of assigning and averaging. ``kept`` has ``rid`` and ``x``."""
    spark = kept.sparkSession
    salts = max(1, -(-kept.count() // members))
    state = kept.select("rid", "x").mapInArrow(lambda batches: _first_members(batches, books, salts), _STATE)
    state = _at_owners(state)
    books = _averaged(state, books)
    for _ in range(rounds - 1):
        path = new_scratch(spark, "members")
        again = state.mapInArrow(lambda batches, books=books: _assigned_again(batches, books), _STATE)
        again.write.partitionBy("moved").parquet(path)
        # Members that stay are read where they were written; only the others are shuffled.
        members_ = spark.read.schema(_STATE).parquet(path)
        state = members_.where("NOT moved").unionByName(_at_owners(members_.where("moved")))
        books = _averaged(state, books)
    return books


def _at_owners(members: DataFrame) -> DataFrame:
    return stored(members.repartition(*_OWNER).sortWithinPartitions(*_OWNER), "owned")


def _averaged(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """New entries, as owners sum their members; an entry without members stays."""
    width = books.shape[2]
    parts = [F.sum(F.col("values")[i]).alias(f"v{i}") for i in range(width)]
    by_owner = state.groupBy(*_OWNER).agg(F.count("*").alias("n"), *parts)
    totals = [F.sum(c).alias(c) for c in ("n", *[f"v{i}" for i in range(width)])]
    books = books.copy()
    # A row for each entry: 1,024 at most.
    for row in by_owner.groupBy("position", "entry").agg(*totals).collect():
        books[row["position"], row["entry"]] = [row[f"v{i}"] // row["n"] for i in range(width)]
    return books


def assigned_codes(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """``row`` and ``label`` of each vector with its ``code`` and ``error``. Vectors are whole here, so nothing is shuffled."""
    given = kept.select("row", "label", "x")
    schema = T.StructType([*given.drop("x").schema.fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, BATCH // PARTS):
            x = _parts(batch)
            found = [nearest(x[p], books[p]) for p in range(PARTS)]
            entry = np.stack([e for e, _ in found], axis=1).astype(np.uint8)
            code = pa.array([row.tobytes().hex() for row in entry], pa.string())
            error = pa.array(sum(d for _, d in found), pa.int64())
            yield pa.RecordBatch.from_arrays([batch["row"], batch["label"], code, error], ["row", "label", "code", "error"])

    return given.mapInArrow(assign, schema)


def _slices(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def _parts(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch by position: positions x vectors x components."""
    return codebooks(batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest entry of each row, the lower one in a tie, and its squared distance."""
    distance = np.zeros((len(x), len(entries)), np.int64)
    for k in range(x.shape[1]):
        distance += (x[:, k, None] - entries[None, :, k]) ** 2
    best = distance.argmin(axis=1)
    return best, distance[np.arange(len(x)), best]


def _first_members(batches: Iterable[pa.RecordBatch], books: np.ndarray, salts: int) -> Iterator[pa.RecordBatch]:
    """Every part of every vector with its first entry; all of them go to an owner."""
    for batch in _slices(batches, BATCH // PARTS):
        rid, x = batch["rid"].to_numpy(), _parts(batch)
        for p in range(PARTS):
            entry, _ = nearest(x[p], books[p])
            yield _members(rid, np.full(len(rid), p), rid % salts, entry, x[p], np.full(len(rid), True))


def _assigned_again(batches: Iterable[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches, BATCH):
        rid, position, salt, before = (batch[c].to_numpy() for c in ("rid", "position", "salt", "entry"))
        x = batch["values"].flatten().to_numpy(zero_copy_only=False).reshape(len(rid), -1).astype(np.int64)
        entry = before.copy()
        for p in np.unique(position):
            rows = position == p
            entry[rows] = nearest(x[rows], books[p])[0]
        yield _members(rid, position, salt, entry, x, entry != before)


def _members(rid, position, salt, entry, x: np.ndarray, moved) -> pa.RecordBatch:
    ends = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
    values = pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32).ravel()))
    small = [pa.array(np.asarray(c, np.int32)) for c in (position, salt, entry)]
    return pa.RecordBatch.from_arrays([pa.array(rid), *small, values, pa.array(moved)], ["rid", "position", "salt", "entry", "values", "moved"])
