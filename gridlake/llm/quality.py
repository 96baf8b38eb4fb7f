"""Quality of whole texts by a convolutional network over bytes, in numpy.

Every byte has a learned embedding; learned filters slide over the whole text. The positions are cut
into blocks, and two neighbouring blocks are a chunk, so chunks overlap by half and cover the text.
A filter's answer is max-pooled over each chunk; the largest and the mean answer over all chunks of
the text are combined into one probability. Both pooled answers have the same size for any text, so
a text of any length is scored whole, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import gives_memory_back, null_to_empty
from gridlake.llm.labelled import held_out, sample

TRAIN_ROWS = 4000  # at most so many labelled documents are fitted, all of them whole
TRAIN_BYTES = 16 << 20  # and at most so many bytes: rows beyond that are left out, in an order by hashes of ids
BLOCK, WIDTH, DIMS, FILTERS = 256, 7, 8, 24
EPOCHS, STEP, RATE = 6, 64, 0.01
THRESHOLD = 0.3
PIECE = 1 << 16  # bytes that are filtered at once
SLOPES = 1 << 16  # winning positions that are learned from at once


class ByteNetwork:
    """Embedding, filters and the last layer; all arrays are a few thousand numbers."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.bytes = (rng.standard_normal((256, DIMS)) * 0.5).astype(np.float32)
        self.filters = (rng.standard_normal((WIDTH * DIMS, FILTERS)) / np.sqrt(WIDTH * DIMS)).astype(np.float32)
        self.shift = np.zeros(FILTERS, np.float32)
        self.last = (rng.standard_normal(2 * FILTERS) * 0.1).astype(np.float32)
        self.bias = np.zeros(1, np.float32)

    def weights(self) -> list[np.ndarray]:
        return [self.bytes, self.filters, self.shift, self.last, self.bias]

    def windows(self, data: np.ndarray) -> np.ndarray:
        """The embedded bytes from each position on; ``data`` has ``WIDTH - 1`` more bytes than positions."""
        flat = self.bytes[data].ravel()
        n = len(data) - WIDTH + 1
        view = np.lib.stride_tricks.as_strided(flat, (n, WIDTH * DIMS), (4 * DIMS, 4))
        return np.ascontiguousarray(view)

    def blocks(self, data: np.ndarray) -> np.ndarray:
        """Largest answer of each filter in each block of ``data``, whose length is a multiple of ``BLOCK``."""
        out = [answers.max(axis=1) for answers in self._answers(data)]
        return np.maximum(np.concatenate(out) + self.shift, 0)

    def _answers(self, data: np.ndarray) -> Iterator[np.ndarray]:
        """Answers by block, position and filter, for some blocks at a time."""
        padded = np.concatenate((data, np.zeros(WIDTH - 1, np.uint8)))
        for lo in range(0, len(data), PIECE):
            hi = min(lo + PIECE, len(data))
            yield (self.windows(padded[lo : hi + WIDTH - 1]) @ self.filters).reshape(-1, BLOCK, FILTERS)

    def probability(self, texts: list[bytes]) -> np.ndarray:
        data, counts = laid_out(texts)
        pooled = self.blocks(data)
        features, _ = combined(pooled, counts)
        return 1.0 / (1.0 + np.exp(-(features @ self.last + self.bias).astype(float)))

    def fit(self, texts: list[bytes], labels: np.ndarray, seed: int = 0) -> ByteNetwork:
        """Adam on the logistic loss; a filter learns from the position that was largest in its chunk."""
        weights = self.weights()
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        rng, turn = np.random.default_rng(seed), 0
        rate = np.clip(labels.mean(), 0.01, 0.99)
        self.bias[0] = np.log(rate / (1 - rate))
        for epoch in range(EPOCHS):
            order = rng.permutation(len(texts))
            for lo in range(0, len(order), STEP):
                batch = order[lo : lo + STEP]
                slopes = self._slopes([texts[i] for i in batch], labels[batch])
                turn += 1
                for w, g, m, v in zip(weights, slopes, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= RATE * 0.5**epoch**0.5 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-7)
        return self

    def _slopes(self, texts: list[bytes], labels: np.ndarray) -> list[np.ndarray]:
        data, counts = laid_out(texts)
        padded = np.concatenate((data, np.zeros(WIDTH - 1, np.uint8)))
        raw, at = [], []
        for answers in self._answers(data):
            at.append(answers.argmax(axis=1))
            raw.append(np.take_along_axis(answers, at[-1][:, None, :], 1)[:, 0])
        raw, at = np.concatenate(raw) + self.shift, np.concatenate(at)
        pooled = np.maximum(raw, 0)
        features, back = combined(pooled, counts)
        score = 1.0 / (1.0 + np.exp(-(features @ self.last + self.bias)))
        error = ((score - labels) / len(texts)).astype(np.float32)
        slope = back(error[:, None] * self.last) * (raw > 0)
        b, f = np.nonzero(slope)
        g, position = slope[b, f], b * BLOCK + at[b, f]
        filters, used = np.zeros_like(self.filters), np.zeros_like(self.bytes)
        for lo in range(0, len(g), SLOPES):
            own = slice(lo, lo + SLOPES)
            seen = padded[position[own, None] + np.arange(WIDTH)]
            by_filter = np.zeros((FILTERS, len(f[own])), np.float32)
            by_filter[f[own], np.arange(len(f[own]))] = g[own]
            filters += (by_filter @ self.bytes[seen].reshape(-1, WIDTH * DIMS)).T
            embedded = (g[own, None] * self.filters.T[f[own]]).reshape(-1, DIMS)
            for d in range(DIMS):
                used[:, d] += np.bincount(seen.ravel(), embedded[:, d], minlength=256)
        return [used, filters, slope.sum(axis=0), features.T @ error + 1e-5 * self.last, error.sum(keepdims=True)]


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in whole blocks, each after ``WIDTH - 1`` zeros so that no filter sees two texts;
    and the number of blocks of each."""
    counts = np.array([-(-(len(t) + WIDTH - 1) // BLOCK) for t in texts])
    lead = b"\0" * (WIDTH - 1)
    whole = b"".join((lead + t).ljust(n * BLOCK, b"\0") for t, n in zip(texts, counts.tolist(), strict=True))
    return np.frombuffer(whole, np.uint8), counts


def combined(pooled: np.ndarray, counts: np.ndarray):
    """Largest and mean answer over the chunks of each text, and the way back for slopes.

    A chunk is a block and the next one of its text; the last block is a chunk alone only where the
    text has no other.
    """
    start = np.cumsum(counts) - counts
    last = np.zeros(len(pooled), bool)
    last[start + counts - 1] = True
    nxt = np.minimum(np.arange(len(pooled)) + 1, len(pooled) - 1)
    nxt[last] = np.flatnonzero(last)
    chunk = last <= np.repeat(counts == 1, counts)  # the chunks' first blocks
    heads = np.flatnonzero(chunk)
    later = pooled[nxt[heads]] > pooled[heads]
    best = np.where(later, nxt[heads][:, None], heads[:, None])
    value = np.maximum(pooled[heads], pooled[nxt[heads]])
    sizes = np.maximum(counts - 1, 1)
    at = np.cumsum(sizes) - sizes
    top = np.maximum.reduceat(value, at)
    mean = np.add.reduceat(value, at) / sizes[:, None]

    def back(slope: np.ndarray) -> np.ndarray:
        out = np.zeros_like(pooled)
        filters = np.arange(pooled.shape[1])
        text = np.repeat(np.arange(len(counts)), sizes)
        share = (slope[:, FILTERS:] / sizes[:, None])[text]
        is_top = value == top[text]
        ties = np.add.reduceat(is_top.astype(np.float32), at)
        share = share + np.where(is_top, (slope[:, :FILTERS] / ties)[text], 0)
        np.add.at(out, (best, np.broadcast_to(filters, best.shape)), share)
        return out

    return np.concatenate((top, mean), axis=1).astype(np.float32), back


def fitted(
    docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES
) -> ByteNetwork | float:
    """A network fitted on whole texts of at most ``rows`` labelled documents with ``most_bytes`` bytes in all;
    the share of ones where there is one class."""
    known = sample(docs, labels, label, rows, most_bytes).toPandas().sort_values(["_id", "label", "text"])
    known = known[known["label"].isin((0, 1))]
    if known["label"].nunique() < 2:
        return float(known["label"].mean()) if len(known) else 0.5
    texts = [t.encode("utf-8", "replace") for t in known["text"]]
    return ByteNetwork().fit(texts, known["label"].to_numpy(np.float32))


def scored(docs: DataFrame, network: ByteNetwork | float, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with ``score``, the probability that a text is good; a null text is scored as empty.

    A column called ``score`` is replaced, all others are kept; equal texts get equal scores; an empty table stays empty.
    """
    columns = [c for c in docs.columns if c != score]
    schema = docs.select(*columns).withColumn(score, F.lit(0.0)).schema

    @gives_memory_back
    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
            lo = 0
            while lo < len(sizes):  # texts are taken out and rows handed on a few at a time, which bounds memory
                hi, size = lo + 1, sizes[lo]
                while hi < len(sizes) and size < 8 * PIECE:
                    size += sizes[hi]
                    hi += 1
                part = batch.slice(lo, hi - lo)
                if isinstance(network, float):
                    out = np.full(hi - lo, network)
                else:
                    out = network.probability([t.encode("utf-8", "replace") for t in null_to_empty(part.column(text).to_pylist())])
                yield part.append_column(score, pa.array(out, pa.float64()))
                lo = hi

    return docs.select(*columns).mapInArrow(answered, schema)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    scores = scored(docs.select("doc_id", "text"), fitted(docs, labels))
    return scores.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
