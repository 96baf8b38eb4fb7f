"""From raw documents to packed training sequences, in five stages that are written one by one.

A document that the quality classifier rejects goes; of each group of near-duplicates one document
stays; personal data becomes pseudonyms; documents are drawn, some twice, so that sources come to their
target weights; and what was drawn is packed into sequences. Every stage but the last returns the
columns it was given, with their values, whatever they are called, and works on all rows of the stage before
it. A null text counts as empty and stays null; repeated rows are near-duplicates; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm import minhash, mixing, packing, pii, quality
from gridlake.llm.common import free_name, small_batches, stored, stored_once
from gridlake.llm.queries import pii_key, vocabulary

#: Words that a Python worker remembers of the texts it packs; the workers of this job hold memory of other stages too.
WORDS = 100_000


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being good is at least 0.3; a null or empty text is scored like any other."""
    network, score = quality.fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), free_name("_score", docs.columns)
    passed = quality.scored(docs, network, score=score).where(F.col(score) >= quality.THRESHOLD).select(*docs.columns)
    with small_batches(spark):  # written here: who writes it later would hand 10,000 whole texts to Python at once
        return stored(passed, "pipeline-passed")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near-duplicates; null and empty texts all stay."""
    return minhash.deduplicated(docs)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without personal data; a null text stays null."""
    found = free_name("_n_replaced", docs.columns)
    return _counted(pii.pseudonymise(docs, key=pii_key(spark), found=found), docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them, in shards of shuffled rows; a null source is a source."""
    out, shard, place = (free_name(c, docs.columns) for c in ("mix", "mix_shard", "mix_place"))
    return _counted(mixing.mix(docs, out=out, shard=shard, place=place), docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place in it; a document drawn twice is packed twice, a null text as its end id."""
    pieces = packing.pack(docs, vocabulary("byte_bpe_50k.json"), by="byte", end_id=1, remembered=WORDS)
    with small_batches(spark):  # as above: these rows have the ids of whole texts
        return stored(pieces, "pipeline-packed")


STAGES = [
    ("quality", quality_filter),
    ("near_dedup", near_dedup),
    ("pii", pseudonyms),
    ("mixing", mixture),
    ("packing", sequences),
]

#: A network over bytes and keyed permutations have no SQL; the tests compare with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, run_id: str | None = None) -> DataFrame:
    """All stages over ``documents``; each result is written and read again as the next one's input.

    With a ``run_id``, stages that an earlier call with that id has written whole are read instead of made
    again, so a lost driver goes on where it was.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        if run_id is None:
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        else:
            docs = stored_once(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"pipeline-{run_id}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def _counted(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with the number of characters as it is now."""
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)
