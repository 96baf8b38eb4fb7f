"""Token files: ids packed into the fewest bits that hold the vocabulary, with block offsets.

A file holds the documents of one range of ``doc_id``, in ascending order::

    header   8 bytes   b"TOKPACK1"
    blocks   each BLOCK ids of ``bits`` bits, least significant bit first, padded to whole bytes
    footer   64-bit little-endian words, as ``np.int64``: the shard, bits, number of ids, number of
             documents, number of blocks; the byte offset of each block; the doc_id (lowest 64-bit
             value for null) and the number of ids of each document
    tail     8 bytes   length of the footer in bytes

A block is read at its offset without any other, and unpacks as one numpy expression. Each part is
followed by the one byte that Spark's text writer puts between records. Spark writes and reads the
files, so they may lie in any store, and a lost task leaves no half file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridlake.llm.common import null_to_empty
from gridlake.llm.tokens import encoder
from gridlake.session import new_scratch

MAGIC = b"TOKPACK1"
BLOCK = 65536  # ids; a multiple of 8, so that every full block ends on a byte
NO_ID = -(2**63)
UNKNOWN = 1 << 60  # Spark's estimate for a table that it knows nothing about is above
FILE_BYTES = 32 * 1024 * 1024  # of text, so that a file fits in a task's memory


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold ids below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` as consecutive fields of ``bits`` bits."""
    if bits == 16:
        return ids.astype("<u2").tobytes()
    planes = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of a block."""
    if bits == 16:
        return np.frombuffer(data, "<u2", count).astype("<u4")
    planes = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little")
    weights = (1 << np.arange(bits, dtype=np.uint64)).astype(np.uint32)
    return (planes.reshape(count, bits) * weights).sum(axis=1, dtype=np.uint32).astype("<u4")


class TokenFile:
    """Random access to the bytes of one file."""

    def __init__(self, data: bytes):
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        self.data = data
        end = len(data) - 9
        footer = int.from_bytes(data[end : end + 8], "little")
        words = np.frombuffer(data, "<i8", footer // 8, end - 1 - footer)
        self.shard, self.bits, self.n_ids, n_docs, n_blocks = (int(x) for x in words[:5])
        self.offsets = words[5 : 5 + n_blocks]
        self.doc_ids = words[5 + n_blocks : 5 + n_blocks + n_docs]
        self.lengths = words[5 + n_blocks + n_docs :]
        self.starts = np.cumsum(self.lengths) - self.lengths

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from ``start``, reading only the blocks they lie in."""
        first, last = start // BLOCK, (start + count - 1) // BLOCK if count else start // BLOCK - 1
        parts = [self.block(b) for b in range(first, last + 1)]
        whole = np.concatenate(parts) if parts else np.empty(0, "<u4")
        return whole[start - first * BLOCK : start - first * BLOCK + count]

    def block(self, b: int) -> np.ndarray:
        count = min(BLOCK, self.n_ids - b * BLOCK)
        at = int(self.offsets[b])
        return unpack(self.data[at : at + (count * self.bits + 7) // 8], self.bits, count)


def write_token_files(docs: DataFrame, path: str, vocabulary_path: str, by: str, end_id: int, vocabulary: int) -> None:
    """Encode ``doc_id, text`` (null text: empty) and write token files in ascending order of doc_id.

    Null ids come first; repeated ids are ordered by text. Every document ends with ``end_id``. The
    ranges of doc_id are cut before encoding, so texts move once and ids never.
    """
    bits = bits_for(max(vocabulary, end_id + 1))
    plan = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = int(plan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    files = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if size < UNKNOWN:
        files = max(files, -(-size // FILE_BYTES))
    ranged = plan.repartitionByRange(files, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")

    def encoded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = encoder(vocabulary_path, by).encode, np.array([end_id], "<u4").tobytes()
        doc_ids, lengths, offsets, rest, at, n = [], [], [], b"", len(MAGIC) + 1, 0
        rows = [MAGIC]

        def cut(data: bytes):
            nonlocal at, n
            ids = np.frombuffer(data, "<u4")
            packed = pack(ids, bits)
            offsets.append(at)
            at += len(packed) + 1
            n += len(ids)
            return packed

        for frame in frames:
            buffer = [rest]
            for doc_id, text in zip(frame["doc_id"], null_to_empty(frame["text"]), strict=True):
                ids = encode(text) + end
                doc_ids.append(NO_ID if pd.isna(doc_id) else int(doc_id))
                lengths.append(len(ids) // 4)
                buffer.append(ids)
            rest = b"".join(buffer)
            full = len(rest) // (4 * BLOCK) * 4 * BLOCK
            rows += [cut(rest[i : i + 4 * BLOCK]) for i in range(0, full, 4 * BLOCK)]
            rest = rest[full:]
            if rows:
                yield pd.DataFrame({"part": rows})
                rows = []
        if not doc_ids:
            return
        rows += [cut(rest)] if rest else []
        shard = TaskContext.get().partitionId()
        words = [shard, bits, n, len(doc_ids), len(offsets), *offsets, *doc_ids, *lengths]
        footer = np.array(words, "<i8").tobytes()
        yield pd.DataFrame({"part": [*rows, footer, len(footer).to_bytes(8, "little")]})

    parts = ranged.mapInPandas(encoded, "part binary")
    parts.select(F.col("part").cast("string").alias("value")).write.option("compression", "none").text(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the files.

    ``start`` counts the ids of all documents before it, over all files.
    """
    files = spark.read.format("binaryFile").load(path).select("content")

    def decoded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for data in frame["content"]:
                file = TokenFile(data) if data else None
                if file is None:
                    continue
                crc = _crcs(file)
                yield pd.DataFrame(
                    {
                        "shard": file.shard,
                        "doc_id": pd.array([None if i == NO_ID else i for i in file.doc_ids.tolist()], dtype="Int64"),
                        "within": file.starts,
                        "n_tokens": file.lengths,
                        "ids_crc32": crc,
                        "n_ids": file.n_ids,
                    }
                )

    docs = files.mapInPandas(
        decoded, "shard long, doc_id long, within long, n_tokens long, ids_crc32 long, n_ids long"
    )
    return docs


def with_starts(docs: DataFrame) -> DataFrame:
    """Offsets of the files before, added to the offsets in the file."""
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = docs.groupBy("shard").agg(F.max("n_ids").alias("n_ids"))
    shards = shards.select("shard", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("base"))
    return docs.join(shards, "shard").select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def _crcs(file: TokenFile) -> list[int]:
    """The checksum of each document, unpacking one block at a time."""
    out = [0] * len(file.lengths)
    bounds = np.append(file.starts, file.n_ids)
    for b in range(len(file.offsets)):
        ids, lo = file.block(b), b * BLOCK
        data = memoryview(ids.tobytes())
        d = int(np.searchsorted(bounds, lo, "right")) - 1
        while d < len(out) and bounds[d] < lo + len(ids):
            i, j = max(int(bounds[d]), lo) - lo, min(int(bounds[d + 1]), lo + len(ids)) - lo
            out[d] = zlib.crc32(data[4 * i : 4 * j], out[d])
            d += 1
    return out


def token_files(docs: DataFrame, vocabulary_path: str, by: str, end_id: int, vocabulary: int) -> DataFrame:
    """Write ``docs`` to files in the shared scratch folder and return what :func:`read_token_files` finds."""
    spark = docs.sparkSession
    path = new_scratch(spark, "token-files")
    write_token_files(docs, path, vocabulary_path, by, end_id, vocabulary)
    return with_starts(read_token_files(spark, path))
