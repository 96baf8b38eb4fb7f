"""Token counts through a cache of content digests: only texts that no earlier run counted are encoded.

The cache is a Parquet folder ``version=<digest>/run=<id>`` with one row for each content: its SHA-256 and its
number of tokens. The version is a digest of the library, its release and the vocabulary file, so another
vocabulary or release never meets old counts. A run appends one folder; only folders that Spark finished count.
"""

from __future__ import annotations

import hashlib
import importlib.metadata
import json
import os
import re
import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm.common import free_name, joined_by_key, null_to_empty, stored
from gridlake.session import list_names, path_exists

FEW = 100_000  # missing digests (3 MB) that are broadcast; more are joined by a shuffle
SLICE = 400_000  # characters that are encoded at once
PIECE = 100_000  # characters; longer texts are cut where the vocabulary cuts them anyway
_CUT = re.compile("[A-Za-z] (?=[A-Za-z])")


def counts(
    docs: DataFrame, vocabulary: str, cache: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text", limit: int = 1024
) -> DataFrame:
    """The columns ``keep`` of every row with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit``).

    Content is normalised no further than null to the empty text, since anything else may change a count.
    Tokens are what the library gives for the whole text: ``tokenizers`` for a ``.json``, ``sentencepiece``
    for a ``.model``, without added tokens, truncation or padding. Repeated texts are encoded once, repeated rows
    stay, an empty text has no tokens, and an empty table gives an empty result. A result column whose
    name is in ``keep`` gets underscores until it is free. Texts beyond ``PIECE`` characters are encoded in
    pieces where that is exact (see ``Counter``), so that a worker's memory does not grow with them.
    """
    spark = docs.sparkSession
    version = version_digest(vocabulary)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    digest = F.unhex(F.sha2(body, 256)).alias("digest")
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in keep]).alias("row")
    rows = stored(docs.select(row, digest, F.octet_length(body).cast("long").alias("n_bytes")), "digests")

    wanted = stored(rows.groupBy("digest").agg(F.count("*").alias("n")), "contents")
    missing = stored(wanted.select("digest").join(cached(spark, cache, version), "digest", "left_anti"), "missing")
    texts = docs.select(digest, body.alias("body"))
    if missing.count() <= FEW:
        texts = texts.join(F.broadcast(missing), "digest", "left_semi").dropDuplicates(["digest"])
    else:  # copies are merged before the shuffle, which the join then uses as well
        texts = texts.dropDuplicates(["digest"]).join(missing, "digest", "left_semi")
    new = texts.mapInPandas(lambda frames: _encoded(vocabulary, frames), "digest binary, n_tokens long")
    new.write.parquet(f"{cache}/version={version}/run={uuid.uuid4().hex}")

    known = wanted.join(cached(spark, cache, version), "digest")
    names = [free_name(n, keep) for n in ("n_bytes", "n_tokens", "over_limit")]
    return joined_by_key(rows, known, "digest", "n").select(
        *[F.col(f"row.`{c}`") for c in keep],
        F.col("n_bytes").alias(names[0]),
        F.col("n_tokens").alias(names[1]),
        (F.col("n_tokens") > limit).alias(names[2]),
    )


def cached(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Counts that finished runs of a version left; two runs at the same time may both have counted a text."""
    root = f"{cache}/version={version}"
    runs = [f"{root}/{name}" for name in list_names(spark, root) if path_exists(spark, f"{root}/{name}/_SUCCESS")]
    reader = spark.read.schema("digest binary, n_tokens long")
    if not runs:
        return spark.createDataFrame([], "digest binary, n_tokens long")
    return reader.parquet(*runs).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def version_digest(vocabulary: str) -> str:
    """Digest of what a count depends on besides the text: library, release, vocabulary."""
    library = "sentencepiece" if vocabulary.endswith(".model") else "tokenizers"
    digest = hashlib.sha256(f"{library} {importlib.metadata.version(library)}\n".encode())
    with open(vocabulary, "rb") as file:
        while block := file.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()[:32]


class Counter:
    """``count(texts)``: the number of tokens of each text.

    A vocabulary without normaliser that cuts texts into byte-level words (``ByteLevel``, no added blank)
    starts a new word at every blank between letters. Long texts are cut there, which leaves the
    count as it is; texts without such a place, and those of other vocabularies, are encoded whole.
    """

    def __init__(self, vocabulary: str):
        self.cuts = False
        if vocabulary.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=vocabulary)
            self.encode = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(vocabulary)
        model.no_truncation()
        model.no_padding()
        self.encode = lambda texts: [len(e) for e in model.encode_batch(texts, add_special_tokens=False)]
        with open(vocabulary, encoding="utf-8") as file:
            parts = json.load(file)
        words = parts["pre_tokenizer"] or {}
        plain = not any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in parts["added_tokens"])
        self.cuts = plain and parts["normalizer"] is None and words.get("type") == "ByteLevel" and (
            words.get("use_regex", True) and not words.get("add_prefix_space", True)
        )

    def count(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        batch, owners, size = [], [], 0
        for i, text in enumerate(texts):
            for piece in self._pieces(text):
                batch.append(piece)
                owners.append(i)
                size += len(piece)
                if size >= SLICE:
                    self._add(out, batch, owners)
                    batch, owners, size = [], [], 0
        self._add(out, batch, owners)
        return out

    def _add(self, out: list[int], batch: list[str], owners: list[int]) -> None:
        for i, n in zip(owners, self.encode(batch), strict=True):
            out[i] += n

    def _pieces(self, text: str) -> Iterator[str]:
        at = 0
        while self.cuts and len(text) - at > PIECE and (place := _CUT.search(text, at + PIECE)):
            yield text[at : place.start() + 1]
            at = place.start() + 1
        yield text[at:] if at else text


_counters: dict[str, Counter] = {}


def _encoded(vocabulary: str, frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    if vocabulary not in _counters:  # one for each Python worker
        _counters[vocabulary] = Counter(vocabulary)
    for frame in frames:
        n = _counters[vocabulary].count(null_to_empty(frame["body"]))
        yield pd.DataFrame({"digest": frame["digest"], "n_tokens": n})
