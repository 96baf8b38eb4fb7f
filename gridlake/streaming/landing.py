"""Unattended update of a cube store from a folder where files land."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gridlake.model import nan_to_null
from gridlake.sources.store import upsert_timesteps


def stream_cube(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    schema: T.StructType,
    keys: tuple[str, ...] = ("time",),
    max_files: int | None = None,
    name: str = "landing",
) -> StreamingQuery:
    """Start one run over the files that are new since the last run.

    The source checkpoint says which files are done. A batch that is repeated after a
    failure carries the same id, which the store takes only once; the id holds that of the
    checkpoint, so several streams, or a new checkpoint, may feed one store. A step may be
    spread over files of different batches: cells are replaced one by one.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    landed = nan_to_null(reader.parquet(landing).withColumn("path", F.col("_metadata.file_path")))

    def put(batch: DataFrame, batch_id: int) -> None:
        stream = spark.read.json(f"{checkpoint}/metadata").first()["id"]
        upsert_timesteps(
            root,
            batch.drop("path"),
            keys=keys,
            batch=f"{name}-{stream}-{batch_id}",
            paths=batch.select("path").distinct(),
            by_cell=True,
        )

    return (
        landed.writeStream.foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
