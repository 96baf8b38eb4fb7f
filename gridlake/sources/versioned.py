"""A cube store whose every change is a new version, published by one rename.

Files of cells are written once and never change. A version is a folder with a manifest, one row for each live
file, and a short description of the store; it gets its name ``versions/v<number>`` by a rename that fails where the name
is taken. Readers pin a version, so they see one state of the store whatever writers do, and older versions stay
readable until ``vacuum``. What a lost job left has no name in any manifest.

Cells are dealt into chunks of time steps and into blocks, which are stretches of a Hilbert curve over
the horizontal axes cut so that they hold about the same number of rows. The manifest knows the bounds, sums and digests
of every file: bounds choose the files before anything of them is opened, sums answer extents and means, and digests
tell which blocks of two versions or stores differ.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.functions.curves import SIDE, hilbert_places, looked_up, square
from gridlake.functions.times import step_number
from gridlake.model import HORIZONTAL, variables
from gridlake.operators.quality import compare_cubes
from gridlake.session import delete_path, list_names, path_exists, read_text, rename_new, stored, tasks_by_files, write_text

ROWS_PER_FILE = 4_000_000
PARTS = ("time_chunk", "block")
_STATS = "map<string, struct<n: bigint, total: double, low: double, high: double, digest: bigint>>"
_WHERE = ("min_time", "max_time", "min_x", "max_x", "min_y", "max_y")


class Conflict(RuntimeError):
    """Another writer changed the same chunks since this one read them."""


@dataclass(frozen=True)
class Snapshot:
    """One version of a store: what to read, fixed when it was opened."""

    root: str
    version: int
    origin: str
    step_seconds: int
    chunk: int
    horizontal: tuple[str, ...]
    extent: tuple[float, ...]
    blocks: tuple[int, ...]
    first_chunk: int
    last_chunk: int
    schema: str
    created: str
    parent: int | None = None
    batch: str | None = None

    @property
    def fields(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    def origin_column(self) -> Column:
        return F.lit(self.origin).cast("timestamp_ntz")


def create(
    df: DataFrame, root: str, chunk: int, step_seconds: int, rows_per_file: int = ROWS_PER_FILE, batch: str | None = None,
    paths: DataFrame | None = None,
) -> Snapshot:
    """A store with the cells of ``df``, or a new version of an existing one that has these cells alone.

    The axis starts at the first time and is padded to whole chunks, a full one more when it was whole already.
    Rows without a time, or between two steps, are an error. Readers see the old store until the new one is whole.
    """
    spark = df.sparkSession
    df = stored(df, "cells")
    horizontal = tuple(c for c in HORIZONTAL if c in df.columns)
    x, y = _xy(horizontal)
    sides = [F.min(x), F.max(x), F.min(y), F.max(y)]
    ends = df.agg(F.min("time").cast("string"), F.max("time").cast("string"), *[s.cast("double") for s in sides]).first()
    if ends[0] is None:
        raise ValueError("a store needs rows with a time")
    extent = tuple(0.0 if e is None else e for e in ends[2:])
    latest = _latest(spark, root)
    new = Snapshot(
        root=root, version=0, origin=ends[0], step_seconds=step_seconds, chunk=chunk, horizontal=horizontal, extent=extent,
        blocks=(0,) * SIDE * SIDE, first_chunk=0, last_chunk=0, schema="", created="", parent=None, batch=batch,
    )
    _refuse_off_axis(df, new)
    steps = spark.range(1).select(step_number(F.lit(ends[1]).cast("timestamp_ntz"), new.origin_column(), step_seconds)).first()[0]
    last = (steps + 1) // chunk
    # At most SIDE x SIDE rows: how many rows a chunk has in each square.
    counts = df.groupBy(square(x, y, list(extent)).alias("square")).agg(F.count("*").alias("n")).collect()
    blocks = _cut(dict(counts), max(1, steps // chunk + 1), rows_per_file)
    new = replace(new, blocks=blocks, last_chunk=last)
    write, schema = _write(df, new, (last + 1) * len(set(blocks)))
    new = replace(new, schema=schema)
    return _commit(spark, root, latest, lambda _: (new, write), paths)


def upsert(
    root: str, new: DataFrame, keys: tuple[str, ...] = ("time",), by_cell: bool = False, batch: str | None = None,
    paths: DataFrame | None = None,
) -> Snapshot:
    """The next version, with the steps of ``new`` in the store.

    A stored step with the same ``keys`` is replaced as a whole, or ``by_cell`` only its cells that ``new`` has,
    which rewrites the blocks of those cells alone. Later and earlier steps extend the axis. Rows without a
    time, or with one between two steps, are an error. Files are written once. A ``batch`` that is in the
    version's history is not taken again. When another writer was faster, the change is published behind
    theirs if they touched other chunks, and ``Conflict`` is raised otherwise.
    """
    spark = new.sparkSession
    base = open_version(spark, root)
    if batch is not None and batch in batches(spark, base):
        return base
    new = stored(new, "cells")
    _refuse_off_axis(new, base)
    if by_cell:
        keys = (*keys, *[c for c in (*base.horizontal, "forecast") if c in new.columns and c not in keys])
    new = _placed(new, base)
    scope = PARTS if by_cell else PARTS[:1]
    # Numbers of the chunks (and blocks) to write again.
    touched = [tuple(r) for r in new.select(*scope).distinct().collect()]
    if not touched:
        return base
    old = manifest(spark, base)
    kept = _read(spark, base, old.where(_within(scope, touched))).join(new.select(*scope, *keys).distinct(), [*scope, *keys], "left_anti")
    merged = kept.unionByName(new, allowMissingColumns=True)
    chunks = [t[0] for t in touched]
    write, schema = _write(merged, base, len(touched) * (1 if by_cell else len(set(base.blocks))))

    def following(current: Snapshot) -> tuple[Snapshot, DataFrame]:
        now = manifest(spark, current)
        if current.version != base.version:
            mine = old.where(_within(scope, touched)).select("path")
            theirs = now.where(_within(scope, touched)).select("path")
            moved = not mine.exceptAll(theirs).isEmpty() or not theirs.exceptAll(mine).isEmpty()
            if moved or _layout(current) != _layout(base):
                raise Conflict(f"chunks {sorted(set(chunks))} changed between version {base.version} and {current.version}")
        after = replace(
            current,
            first_chunk=min(current.first_chunk, *chunks),
            last_chunk=max(current.last_chunk, *chunks),
            schema=_joined_schema(schema, current.schema),
            parent=current.version,
            batch=batch,
        )
        return after, now.where(~_within(scope, touched)).unionByName(write, allowMissingColumns=True)

    return _commit(spark, root, base.version, following, paths)


def restore(spark: SparkSession, root: str, version: int) -> Snapshot:
    """A new version that equals an older one, its history included. Nothing is copied."""
    old = open_version(spark, root, version)
    again = replace(old, parent=old.version, batch=None)
    return _commit(spark, root, _latest(spark, root), lambda _: (again, manifest(spark, old)))


def open_version(spark: SparkSession, root: str, version: int | None = None, as_of: dt.datetime | None = None) -> Snapshot:
    """A version by number, the last one made up to ``as_of`` (UTC), or the newest."""
    known = _versions(spark, root)
    if version is None and as_of is not None:
        made = [(v, _about(spark, root, v).created) for v in known]
        known = [v for v, created in made if dt.datetime.fromisoformat(created) <= as_of]
    chosen = version if version is not None else max(known, default=None)
    if chosen is None or not path_exists(spark, f"{_folder(root, chosen)}/files/_SUCCESS"):
        raise FileNotFoundError(f"{root} has no version {version if as_of is None else as_of}")
    return _about(spark, root, chosen)


def history(spark: SparkSession, root: str) -> DataFrame:
    """``version, parent, batch, created`` of all versions, those that can no longer be read as well."""
    rows = [(a.version, a.parent, a.batch, a.created) for a in (_about(spark, root, v) for v in _versions(spark, root))]
    return spark.createDataFrame(rows, "version long, parent long, batch string, created string")


def batches(spark: SparkSession, snapshot: Snapshot) -> list[str]:
    """The batches that a version contains."""
    return [a.batch for a in _line(spark, snapshot) if a.batch is not None]


def processed_paths(spark: SparkSession, snapshot: Snapshot) -> DataFrame:
    """Files that a version was made from."""
    folders = [f"{_folder(a.root, a.version)}/paths" for a in _line(spark, snapshot)]
    return spark.read.schema("path string").parquet(*folders).distinct()


def _line(spark: SparkSession, snapshot: Snapshot) -> list[Snapshot]:
    """A version and all it was made from."""
    line = [snapshot]
    while line[-1].parent is not None:
        line.append(_about(spark, snapshot.root, line[-1].parent))
    return line


def manifest(spark: SparkSession, snapshot: Snapshot) -> DataFrame:
    """One row for each live file: chunk, block, path below the root, bytes, rows, bounds, and by variable its sums and digest."""
    return spark.read.parquet(f"{_folder(snapshot.root, snapshot.version)}/files")


def read(
    spark: SparkSession,
    snapshot: Snapshot,
    since: dt.datetime | None = None,
    until: dt.datetime | None = None,
    bbox: tuple[float, float, float, float] | None = None,
) -> DataFrame:
    """Cells from ``since`` to ``until`` within ``bbox`` (lat or northing from and to, lon or easting from and to), all included.

    Only files whose bounds meet these are listed and opened.
    """
    files = manifest(spark, snapshot)
    tests = []
    if since is not None:
        files = files.where(F.col("max_time") >= _ntz(since))
        tests.append(F.col("time") >= _ntz(since))
    if until is not None:
        files = files.where(F.col("min_time") <= _ntz(until))
        tests.append(F.col("time") <= _ntz(until))
    if bbox is not None:
        for name, side, low, high in zip(snapshot.horizontal, "xy", bbox[::2], bbox[1::2], strict=True):
            files = files.where((F.col(f"max_{side}") >= low) & (F.col(f"min_{side}") <= high))
            tests.append(F.col(name).between(low, high))
    cells = _read(spark, snapshot, files)
    for test in tests:
        cells = cells.where(test)
    return cells.drop(*PARTS)


def axis(spark: SparkSession, snapshot: Snapshot) -> DataFrame:
    """Every step of every chunk, those without cells too."""
    steps = spark.range(snapshot.first_chunk * snapshot.chunk, (snapshot.last_chunk + 1) * snapshot.chunk)
    seconds = (F.col("id") * snapshot.step_seconds).cast("decimal(18,6)")
    return steps.select(
        (snapshot.origin_column() + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)).alias("time"),
        F.floor(F.col("id") / snapshot.chunk).cast("int").alias("time_chunk"),
    )


def summary(spark: SparkSession, snapshot: Snapshot) -> DataFrame:
    """``variable, n, mean, low, high`` of every variable, from the sums of the files; no cell is read."""
    stats = manifest(spark, snapshot).select(F.explode("stats").alias("variable", "s"))
    return stats.groupBy("variable").agg(
        F.sum("s.n").alias("n"), (F.sum("s.total") / F.sum("s.n")).alias("mean"), F.min("s.low").alias("low"), F.max("s.high").alias("high")
    )


def bounds(spark: SparkSession, snapshot: Snapshot) -> DataFrame:
    """One row of first and last time, extent and number of cells, from the bounds of the files."""
    low = [F.min(c).alias(c) for c in _WHERE if c.startswith("min")]
    high = [F.max(c).alias(c) for c in _WHERE if c.startswith("max")]
    return manifest(spark, snapshot).agg(F.sum("rows").alias("n_cells"), *low, *high)


def different_blocks(spark: SparkSession, a: Snapshot, b: Snapshot, names: list[str]) -> DataFrame:
    """Chunks and blocks in which digests of two versions or stores differ, with the ``names`` that do.

    Digests are of single cells, so neither the number nor the order of files matters. Both sides need the same
    origin, chunks and blocks, as versions of one store have.
    """
    if _layout(a) != _layout(b):
        raise ValueError("stores with other chunks or blocks have no common digests")
    sides = []
    for tag, snapshot in (("a", a), ("b", b)):
        digests = [F.coalesce(F.bit_xor(F.col("stats")[v]["digest"]), F.lit(0)).alias(f"{tag}_{v}") for v in names]
        total = F.sum("rows").alias(f"{tag}_rows")
        sides.append(manifest(spark, snapshot).groupBy(*PARTS).agg(total, *digests))
    joined = sides[0].join(sides[1], list(PARTS), "full")
    changed = F.filter(
        F.array(*[F.when(~F.col(f"a_{v}").eqNullSafe(F.col(f"b_{v}")), F.lit(v)) for v in names]), lambda c: c.isNotNull()
    )
    found = joined.select(*PARTS, "a_rows", "b_rows", changed.alias("variables"))
    return found.where((F.size("variables") > 0) | ~F.col("a_rows").eqNullSafe(F.col("b_rows")))


def compare(spark: SparkSession, a: Snapshot, b: Snapshot, names: list[str], tolerance: float | None = None) -> DataFrame:
    """What ``compare_cubes`` gives for two versions; only blocks whose digests differ are read, on both sides."""
    found = different_blocks(spark, a, b, names).select(*PARTS)
    # Blocks that changed, which are files to open.
    touched = [tuple(r) for r in found.collect()]
    inside = _within(PARTS, touched)
    keys = tuple(c for c in ("time", *a.horizontal, "forecast") if c in a.fields.names)
    parts = compare_cubes(*[_read(spark, s, manifest(spark, s).where(inside)) for s in (a, b)], names, keys, tolerance)
    same = manifest(spark, a).where(~inside).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))
    n = same.first()["n"]
    rest = spark.createDataFrame([(v, n, 0) for v in names], "variable string, n_cells long, n_different long")
    return parts.unionByName(rest).groupBy("variable").agg(*[F.sum(c).alias(c) for c in ("n_cells", "n_different")])


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> None:
    """Delete the manifests of all but the newest ``keep`` versions, and the cells that none of those names.

    The history, with batches and paths, stays. Run it while nobody writes.
    """
    known = _versions(spark, root)
    for version in known[:-keep]:
        delete_path(spark, f"{_folder(root, version)}/files")
    for name in list_names(spark, f"{root}/versions"):
        if name.startswith(".new-"):
            delete_path(spark, f"{root}/versions/{name}")
    live = [manifest(spark, _about(spark, root, v)).select("write", *PARTS) for v in known[-keep:]]
    # Folders of writes and their chunks, as any scan would list them.
    used = {tuple(r) for r in reduce(DataFrame.union, live).distinct().collect()}
    for write in list_names(spark, f"{root}/cells"):
        for chunk in list_names(spark, f"{root}/cells/{write}"):
            for block in list_names(spark, f"{root}/cells/{write}/{chunk}"):
                if "=" in block and (write.split("=")[1], int(chunk.split("=")[1]), int(block.split("=")[1])) not in used:
                    delete_path(spark, f"{root}/cells/{write}/{chunk}/{block}")
        if not any(u[0] == write.split("=")[1] for u in used):
            delete_path(spark, f"{root}/cells/{write}")


def _layout(snapshot: Snapshot) -> tuple:
    return snapshot.origin, snapshot.step_seconds, snapshot.chunk, snapshot.extent, snapshot.blocks


def _xy(horizontal: tuple[str, ...]) -> tuple[Column, Column]:
    columns = [F.col(c) for c in horizontal] + [F.lit(0.0), F.lit(0.0)]
    return columns[0], columns[1]


def _cut(counts: dict[int, int], chunks: int, rows_per_file: int) -> tuple[int, ...]:
    """The block of each square: stretches of the curve with at most ``rows_per_file`` rows a chunk, if squares allow it."""
    places = hilbert_places()
    block, held, out = 0, 0.0, [0] * len(places)
    for square_ in sorted(range(len(places)), key=places.__getitem__):
        rows = counts.get(square_, 0) / chunks
        if held and held + rows > rows_per_file:
            block, held = block + 1, 0.0
        held += rows
        out[square_] = block
    return tuple(out)


def _placed(df: DataFrame, store: Snapshot) -> DataFrame:
    steps = step_number("time", store.origin_column(), store.step_seconds)
    cell = square(*_xy(store.horizontal), list(store.extent))
    return df.withColumn("time_chunk", F.floor(steps / store.chunk).cast("int")).withColumn("block", looked_up(list(store.blocks), cell))


def _refuse_off_axis(new: DataFrame, store: Snapshot) -> None:
    micros = F.timestamp_diff("MICROSECOND", store.origin_column(), F.col("time"))
    between = F.pmod(micros, F.lit(store.step_seconds * 1_000_000)) != 0
    wrong = new.agg(F.count_if(F.col("time").isNull()).alias("missing"), F.count_if(between).alias("between")).first()
    if wrong["missing"] or wrong["between"]:
        raise ValueError(f"{wrong['missing']} rows have no time, {wrong['between']} one that is not on the axis")


def _within(scope: tuple[str, ...], touched: list[tuple]) -> Column:
    """Whether a file's or cell's chunk (and block) is among ``touched``."""
    if not touched:
        return F.lit(False)
    chunks = F.col("time_chunk").isin([t[0] for t in touched])
    if len(scope) == 1:
        return chunks
    by_chunk: dict[int, list[int]] = {}
    for chunk, block in touched:
        by_chunk.setdefault(chunk, []).append(block)
    names = [f"{c}:{b}" for c, bs in by_chunk.items() for b in bs]
    return chunks & F.concat_ws(":", "time_chunk", "block").isin(names)


def _write(df: DataFrame, store: Snapshot, files: int) -> tuple[DataFrame, str]:
    """Write cells once, about ``files`` files with cells along the curve; their manifest rows, and the schema."""
    spark = df.sparkSession
    cells = _placed(df, store)
    places = looked_up(hilbert_places(), square(*_xy(store.horizontal), list(store.extent)))
    write = uuid.uuid4().hex
    ordered = cells.hint("rebalance", *PARTS).withColumn("_place", places)
    ordered = ordered.sortWithinPartitions(*PARTS, "_place", *store.horizontal, "time").drop("_place")
    with tasks_by_files(spark, files):
        ordered.write.partitionBy(*PARTS).parquet(f"{store.root}/cells/write={write}")

    fields = T.StructType([f for f in cells.schema.fields if f.name not in PARTS])
    base = f"{store.root}/cells"
    parts = T.StructType([*fields.fields, *_part_fields()])
    with tasks_by_files(spark, files):
        back = spark.read.schema(parts).option("basePath", base).parquet(f"{base}/write={write}")
    x, y = _xy(store.horizontal)
    keys = ["time", *[c for c in (*store.horizontal, "forecast") if c in fields.names]]
    sides = {"time": F.col("time"), "x": x.cast("double"), "y": y.cast("double")}
    ends = [f(c).alias(f"{n}_{s}") for s, c in sides.items() for n, f in (("min", F.min), ("max", F.max))]
    stats = [
        F.struct(
            F.lit(v).alias("variable"),
            F.count(v).alias("n"),
            F.sum(F.col(v).cast("double")).alias("total"),
            F.min(F.col(v).cast("double")).alias("low"),
            F.max(F.col(v).cast("double")).alias("high"),
            F.bit_xor(F.xxhash64(*keys, F.lit(v), F.col(v).isNull(), v)).alias("digest"),
        )
        for v in variables(back.select(*fields.names))
    ]
    file = F.col("_metadata.file_path")
    by_file = back.groupBy("write", *PARTS, file.alias("file")).agg(
        F.max("_metadata.file_size").alias("bytes"), F.count("*").alias("rows"), *ends, F.array(*stats).alias("s")
    )
    table = F.map_from_arrays(F.col("s.variable"), F.transform("s", lambda s: s.dropFields("variable"))) if stats else F.create_map().cast(_STATS)
    rows = by_file.select(
        F.concat(F.lit("cells/write="), F.regexp_extract("file", r"/write=(.*)$", 1)).alias("path"),
        "write", *PARTS, "bytes", "rows", *_WHERE, table.alias("stats"),
    )
    return rows, fields.json()


def _joined_schema(new: str, old: str) -> str:
    fields = T.StructType.fromJson(json.loads(new)).fields
    names = {f.name for f in fields}
    return T.StructType([*fields, *[f for f in T.StructType.fromJson(json.loads(old)).fields if f.name not in names]]).json()


def _part_fields() -> list[T.StructField]:
    return [T.StructField("write", T.StringType())] + [T.StructField(c, T.IntegerType()) for c in PARTS]


def _read(spark: SparkSession, snapshot: Snapshot, files: DataFrame) -> DataFrame:
    # The names of the files of a scan are on the driver anyway.
    paths = [f"{snapshot.root}/{r['path']}" for r in files.select("path").collect()]
    fields = T.StructType([*snapshot.fields.fields, *_part_fields()])
    if not paths:
        return spark.createDataFrame([], fields).drop("write")
    reader = spark.read.schema(fields).option("basePath", f"{snapshot.root}/cells")
    with tasks_by_files(spark, len(paths)):
        return reader.parquet(*paths).drop("write")


def _ntz(time: dt.datetime) -> Column:
    return F.lit(time.isoformat()).cast("timestamp_ntz")


def _folder(root: str, version: int) -> str:
    return f"{root}/versions/v{version:010d}"


def _versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n[1:]) for n in list_names(spark, f"{root}/versions") if re.fullmatch(r"v\d{10}", n))


def _latest(spark: SparkSession, root: str) -> int:
    return max(_versions(spark, root), default=0)


def _about(spark: SparkSession, root: str, version: int) -> Snapshot:
    about = json.loads(read_text(spark, f"{_folder(root, version)}/about.json"))
    for name in ("horizontal", "extent", "blocks"):
        about[name] = tuple(about[name])
    return Snapshot(**about | {"root": root, "version": version})


def _commit(spark: SparkSession, root: str, base: int, following, paths: DataFrame | None = None) -> Snapshot:
    """Give the next version its name. ``following`` makes it and its manifest from the version before, None for the first."""
    while True:
        staged = f"{root}/versions/.new-{uuid.uuid4().hex}"
        new, files = following(_about(spark, root, base) if base else None)
        files.write.parquet(f"{staged}/files")
        named = paths.select("path") if paths is not None else spark.createDataFrame([], "path string")
        named.write.parquet(f"{staged}/paths")
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat()
        done = replace(new, root=root, version=base + 1, created=now)
        about = {k: v for k, v in done.__dict__.items() if k not in ("root", "version")}
        write_text(spark, f"{staged}/about.json", json.dumps(about))
        if rename_new(spark, staged, _folder(root, base + 1)):
            return done
        delete_path(spark, staged)
        base = _latest(spark, root)
