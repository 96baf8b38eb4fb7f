"""Session settings, shared scratch space and path checks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}


SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024
FILES_PER_TASK = 64


def build_session(
    app: str = "gridlake", master: str | None = None, input_bytes: int | None = None, **conf
) -> SparkSession:
    """A session with the settings the library relies on; ``conf`` wins over them.

    ``input_bytes`` sizes the shuffle so that a partition is about 128 MB. Adaptive
    execution merges small partitions and splits skewed ones, but adds none otherwise.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    if input_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(max(200, -(-input_bytes // SHUFFLE_PARTITION_BYTES)))
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables in the shared folder ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="gridlake-")
        base = _local_scratch[app]
    return f"{base}/gridlake/{name}"


def new_scratch(spark: SparkSession, name: str) -> str:
    """A scratch path nobody has used."""
    return scratch_dir(spark, f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to scratch space and read back, so that it is computed once.

    The table outlives lost executors, and its size is known to the optimizer.
    """
    path = new_scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def tasks_by_files(spark: SparkSession, files: int) -> Iterator[None]:
    """Tables written or listed inside get their tasks by their number of small ``files``.

    Adaptive execution merges partitions by their bytes, so that a few tasks would write thousands of small files,
    and a listing starts one task for each of thousands of folders.
    """
    cores = spark.sparkContext.defaultParallelism
    settings = {
        "spark.sql.adaptive.coalescePartitions.minPartitionNum": str(max(cores, -(-files // FILES_PER_TASK))),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4k",
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * cores),
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def path_state(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """Bytes and time of last change (milliseconds) of a file, or of a folder with what is in it; None where there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        return None
    return system.getContentSummary(target).getLength(), system.getFileStatus(target).getModificationTime()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file whole."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that must not be there yet."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename in one step; False where the new name is taken."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    paths = [hadoop.Path(p) for p in (source, target)]
    context = hadoop.FileContext.getFileContext(
        paths[1].getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(*paths, options)
    except Py4JJavaError as error:
        if path_exists(spark, target) and path_exists(spark, source):
            return False
        raise error
    return True


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library and what is in it; nothing where it does not exist."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def list_names(spark: SparkSession, root: str) -> list[str]:
    """Names directly below a path; none where it does not exist."""
    if not path_exists(spark, root):
        return []
    target = spark._jvm.org.apache.hadoop.fs.Path(root)
    listed = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return [status.getPath().getName() for status in listed]


def partition_values(spark: SparkSession, root: str, key: str) -> list[str]:
    """Values of the first partition column of a table, from its directory names."""
    return [n.split("=", 1)[1] for n in list_names(spark, root) if n.startswith(f"{key}=")]
