"""Mixing of sources to target weights by a multivariate hypergeometric splitting tree.

Every source is a stream of words: its documents in an order permuted by a keyed hash, then again
in another order for what is taken twice. The stream is cut into blocks of whole documents up to
the source's quota. A tree halves the output shards: at each node the blocks of all sources are
dealt to both sides without replacement, which draws the sources' counts from a multivariate
hypergeometric law and keeps every quota exact. A leaf tells how many blocks of each source its
shard gets; they are the next ones in the permuted order of that source's blocks.

A document finds its block by comparing its place in the permuted order with the blocks' first
places, so texts are never shuffled to be counted. All of it is DataFrame and SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.common import free_name, running_total, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARDS = 64
BLOCKS_PER_SHARD = 16
SEED = "mix"


def words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), 0)), F.lit(0)).cast("long") * F.when(
        text.isNull(), 0
    ).otherwise(1)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source, rank, source_size, target`` from rows ``source, size``.

    ``weights`` repeat over the sources in code point order, null last. The targets are ``share``
    of all words, by weight; none exceeds ``most`` times its source, and what is above goes to the
    others by weight. A source is full where its ratio of limit to weight is below the common
    level; ordered by that ratio, the level follows from running sums.
    """
    order, every = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy()
    cycle = F.array(*[F.lit(w) for w in weights])
    by_ratio = Window.orderBy("ratio", "rank")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn("rank", F.row_number().over(order) - 1).select(
        "*",
        cycle[F.col("rank") % len(weights)].cast("long").alias("weight"),
        (F.col("source_size") * F.lit(float(most))).alias("limit"),
    )
    ranked = ranked.withColumn("ratio", F.col("limit") / F.col("weight"))
    before = F.coalesce(F.sum("limit").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(every) * F.lit(float(share))
    ranked = ranked.select("*", ((total - before) / left).alias("level"))
    # where share exceeds most every source is full, and no level is low enough
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level"))).over(every)["level"]
    ranked = ranked.withColumn("common", level)
    target = F.when(F.col("common").isNull(), F.col("limit")).otherwise(
        F.least(F.col("limit"), F.col("weight") * F.col("common"))
    )
    return ranked.select("source", "rank", "source_size", target.alias("target"))


def split_blocks(counts: DataFrame, shards: int, seed: str = SEED) -> DataFrame:
    """``rank, shard, n`` from ``rank, blocks``: how many blocks of each source a shard gets.

    One row per node of the tree holds the count of every source. Going through a node's blocks,
    each goes left with the odds of the places left there to the blocks left: sampling without
    replacement, exact whatever the counts.
    """
    node = counts.agg(F.sort_array(F.collect_list(F.struct("rank", "blocks"))).alias("of")).select(
        F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"), "of"
    )
    draw = f"pmod(xxhash64('{seed}', lo, hi, x.rank, i), 9007199254740992L) / 9007199254740992D"
    one = f"""aggregate(IF(x.blocks > 0, sequence(1L, x.blocks), array()),
        named_struct('room', s.room, 'rest', s.rest),
        (c, i) -> named_struct('room', c.room - IF({draw} * c.rest < c.room, 1L, 0L), 'rest', c.rest - 1L))"""
    left = f"""aggregate(of, named_struct('room', room, 'rest', rest,
            'of', CAST(array() AS ARRAY<STRUCT<rank: INT, blocks: BIGINT>>)),
        (s, x) -> transform(array({one}), c -> named_struct('room', c.room, 'rest', c.rest,
            'of', concat(s.of, array(named_struct('rank', x.rank, 'blocks', s.room - c.room)))))[0]).of"""
    for _ in range(max(0, (shards - 1).bit_length())):
        halves = node.selectExpr("*", "(lo + hi) DIV 2 AS mid", "aggregate(of, 0L, (s, x) -> s + x.blocks) AS rest")
        halves = halves.selectExpr("*", "(rest * (mid - lo)) DIV (hi - lo) AS room")
        halves = halves.selectExpr("*", f"{left} AS gone")
        node = halves.selectExpr(
            """explode(IF(hi - lo < 2, array(named_struct('lo', lo, 'hi', hi, 'of', of)), array(
                named_struct('lo', lo, 'hi', mid, 'of', gone),
                named_struct('lo', mid, 'hi', hi, 'of', zip_with(of, gone, (x, y) ->
                    named_struct('rank', x.rank, 'blocks', x.blocks - y.blocks)))))) AS node"""
        ).select("node.*")
    return node.selectExpr("lo AS shard", "explode(of) AS x").selectExpr("x.rank AS rank", "shard", "x.blocks AS n")


def mix_plan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    size: Column | None = None,
    weights=WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    shards: int = SHARDS,
    seed: str = SEED,
    out: str = "mix",
) -> DataFrame:
    """The rows of ``docs`` with a column ``out``; a column of that name is replaced.

    ``out`` has ``size``, ``source_size``, ``target`` and ``parts``, an array with one struct
    ``epoch, shard, place, taken`` for each time the document is taken: ``taken`` counts its first
    words (all, but for the document at a source's end), ``place`` orders the shard. A null text
    has size 0; a null source is a source of its own; a document without words is taken at most
    once, with 0 words. Repeated rows share one place, and what is left at a source's end is
    divided among them. An empty table stays empty.
    """
    size = words(F.col("text")) if size is None else size
    epochs = max(1, -int(-most // 1))
    place = [F.md5(F.concat_ws(":", F.lit(seed), F.lit(e), F.col(doc_id).cast("string"))) for e in range(epochs)]
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(source).alias("source"),
        size.alias("size"),
        F.array(*place).alias("places"),
    )
    sized = stored(named.groupBy("source", "places").agg(F.sum("size").alias("size")), "mix-sizes")
    targets = stored(source_targets(sized, weights, share, most), "mix-targets")
    quota = F.round("target").cast("long")
    blocks_in_all = shards * BLOCKS_PER_SHARD
    width = targets.agg(F.greatest(F.lit(1), F.ceil(F.sum(quota) / blocks_in_all)).alias("width"))
    plan = targets.join(F.broadcast(width))  # one row
    plan = plan.select("*", quota.alias("quota"), F.ceil(quota / F.col("width")).alias("blocks"))

    same = F.col("s.source").eqNullSafe(F.col("t.source"))
    places = (
        sized.alias("s")
        .join(targets.select("source", "rank", "source_size").alias("t"), same)
        .select("rank", "source_size", "size", F.posexplode("places").alias("epoch", "place"))
    )
    running = running_total(places, ["rank", "epoch"], ["place"], "size", "before")
    running = running.join(F.broadcast(plan.select("rank", "quota", "width")), "rank")
    room = F.col("quota") - F.col("epoch") * F.col("source_size")  # words that this epoch may give
    running = running.withColumn("room", room).where("room > before")
    # the document that fills the room; where the room holds the whole source nothing is cut
    fills = (F.col("before") + F.col("size") >= F.col("room")) & (F.col("room") < F.col("source_size"))
    block = F.floor((F.col("epoch") * F.col("source_size") + F.col("before")) / F.col("width"))
    first = stored(
        running.groupBy("rank", "epoch", block.alias("block")).agg(
            F.min("place").alias("place"),
            F.max(F.when(fills, F.struct("place", (F.col("room") - F.col("before")).alias("words"), "size"))).alias("end"),
        ),
        "mix-blocks",
    )

    deal = split_blocks(plan.select("rank", "blocks"), shards, seed)
    by_shard = Window.partitionBy("rank").orderBy("shard")
    upto = F.sum("n").over(by_shard)
    turns = F.sequence(upto - F.col("n"), upto - 1)
    deal = deal.select("rank", "shard", F.when(F.col("n") > 0, turns).alias("turns"))
    deal = deal.select("rank", "shard", F.explode("turns").alias("nth"))
    shuffled = Window.partitionBy("rank").orderBy(F.xxhash64(F.lit(seed), "rank", "block"), "block")
    known = plan.where("blocks > 0").select("rank", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    known = known.select("rank", "block", (F.row_number().over(shuffled) - 1).cast("long").alias("nth"))
    dealt = known.join(deal, ["rank", "nth"]).select("rank", "block", "shard")
    found = first.join(dealt, ["rank", "block"])
    found = found.groupBy("rank", "epoch").agg(
        F.sort_array(F.collect_list(F.struct("place", "shard"))).alias("starts"), F.max("end").alias("end")
    )
    # at most one start for each block; cut into pieces of about the square root for the search
    step = "CAST(ceil(sqrt(size(starts))) AS INT)"
    found = found.selectExpr(
        "rank", "epoch", "end", f"transform(sequence(0, (size(starts) - 1) DIV {step}), k -> slice(starts, k * {step} + 1, {step})) AS starts"
    )
    found = found.groupBy("rank").agg(F.sort_array(F.collect_list(F.struct("epoch", "starts", "end"))).alias("found"))
    per_source = stored(
        targets.join(found, "rank", "left").select("source", "source_size", "target", "found"), "mix-plan"
    )

    rows = named.alias("s").join(per_source.alias("t"), same).select("doc", "size", "places", "t.source_size", "target", "found")
    group = "element_at(filter(f.starts, g -> g[0].place <= places[f.epoch]), -1)"
    shard = f"element_at(filter({group}, b -> b.place <= places[f.epoch]), -1).shard"
    taken = """CASE WHEN f.end IS NULL OR places[f.epoch] < f.end.place THEN size
        ELSE size * f.end.words DIV greatest(f.end.size, 1L) END"""
    parts = f"""transform(filter(found, f -> (f.epoch = 0 OR size > 0) AND (f.end IS NULL OR places[f.epoch] <= f.end.place)
        AND f.starts[0][0].place <= places[f.epoch]), f -> named_struct('epoch', f.epoch, 'shard', {shard},
        'place', md5(concat(places[f.epoch], '{seed}')), 'taken', {taken}))"""
    mix = F.struct("size", "source_size", "target", F.coalesce(F.expr(parts), F.expr("array()")).alias("parts"))
    kept = [F.col("doc")[c].alias(c) for c in docs.columns if c != out]
    return rows.select(*kept, mix.alias(out))


def mix(
    docs: DataFrame, text: str = "text", out: str = "mix", shard: str = "mix_shard", place: str = "mix_place", **options
) -> DataFrame:
    """The mixture: the rows of ``docs`` as often as they are taken, with columns ``shard`` and ``place``.

    Columns of these two names and ``out`` are replaced, all others are kept. The text of a document that a
    source's end cuts keeps its first words. Rows are ordered by shard and place within tasks: a shard is dealt to
    tasks in up to 4,096 slices by the first digits of the place, so no task holds a whole shard, however much
    text it has, and reading a shard by place gives its order.
    """
    own = free_name("_part", [*docs.columns, out])
    part = mix_plan(docs, out=out, **options).withColumn(own, F.explode(f"{out}.parts"))
    first = F.array_join(F.slice(F.regexp_extract_all(F.col(text), F.lit(WORD), 0), 1, F.col(f"{own}.taken").cast("int")), " ")
    cut = F.when(F.col(f"{own}.taken") < F.col(f"{out}.size"), first).otherwise(F.col(text))
    made = part.withColumn(text, cut).select(
        *[f"`{c}`" for c in docs.columns if c not in (out, shard, place)],
        F.col(f"{own}.shard").alias(shard),
        F.col(f"{own}.place").alias(place),
    )
    return made.repartition(shard, F.substring(place, 1, 3)).sortWithinPartitions(shard, place)
