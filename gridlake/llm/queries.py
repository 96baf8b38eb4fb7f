"""Queries of the operators for training text, with SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm import (
    embeddings,
    minhash,
    mixing,
    packed_ids,
    packing,
    pii,
    prefix_trie,
    quality,
    search,
    suffixes,
    token_counts,
    toxicity,
    vector_codes,
)
from gridlake.llm.common import stored
from gridlake.session import new_scratch


def vocabulary(name: str) -> str:
    """The path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 2048 ids, each source served by its share of all ids."""
    return packing.pack(_documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), by="byte", end_id=1)


def op2_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.95 and more between all embeddings."""
    return embeddings.links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP2_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[64]) AS e FROM embeddings),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b
    ON a.vec_id != b.vec_id AND array_cosine_similarity(a.e, b.e) >= 0.95),
r(a, c) AS (SELECT vec_id, vec_id FROM v UNION SELECT p.b, r.c FROM r JOIN p ON p.a = r.a),
c AS (SELECT a AS vec_id, min(c) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM p GROUP BY a)
SELECT c.vec_id, coalesce(n.n, 0) AS n_links, component_id, c.vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade of toxicity of every document; a grade of 1 is toxic."""
    docs = _documents(spark, sf_dir)
    return toxicity.graded(docs, toxicity.fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability that a document is good."""
    return quality.judged(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated strings of 200 bytes."""
    return suffixes.digest(suffixes.without_repeats(_documents(spark, sf_dir)))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents that share at least 0.8 of their runs of five words."""
    return minhash.classes(_documents(spark, sf_dir))


def op7_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item whose id is divisible by 20."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").where("item_id % 20 = 0")
    return search.top_k(_documents(spark, sf_dir), items, k=10, query_id="item_id")


OP7_SQL = r"""
WITH q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
    FROM benchmark WHERE item_id % 20 = 0),
w AS (SELECT rowid AS row, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+') AS words
    FROM (SELECT row_number() OVER () AS rowid, * FROM documents)),
n AS (SELECT count(*) AS docs, sum(len(words)) / count(*) AS mean FROM w),
t AS (SELECT row, doc_id, len(words) AS length, unnest(words) AS term FROM w),
p AS (SELECT row, doc_id, length, term, count(*) AS tf FROM t SEMI JOIN q USING (term) GROUP BY ALL),
d AS (SELECT term, ln(1 + (max(docs) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM p, n GROUP BY term),
s AS (SELECT item_id, row, doc_id, round(sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))), 6) AS score
    FROM q JOIN p USING (term) JOIN d USING (term), n GROUP BY item_id, row, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
FROM s QUALIFY rank <= 10
"""


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids written to packed files and read back."""
    return packed_ids.token_files(
        _documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), by="word", end_id=2, vocabulary=49_408
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mixture takes of each document."""
    docs = _documents(spark, sf_dir).select("doc_id", "source", mixing.words(F.col("text")).alias("size"))
    planned = mixing.mix_plan(stored(docs, "sizes"), size=F.col("size"))
    return planned.select(
        "doc_id",
        "size",
        F.col("mix.source_size").alias("source_size"),
        F.col("mix.target").alias("target"),
        F.expr("aggregate(mix.parts, 0L, (s, p) -> s + p.taken)").alias("taken"),
    )


OP9_SQL = r"""
WITH d AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n FROM s),
w AS (SELECT *, CASE n % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM r),
l AS (SELECT *, 2.0::DOUBLE * source_size AS lim, 2.0::DOUBLE * source_size / weight AS ratio FROM w),
v AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(lim) OVER (
        ORDER BY ratio, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) /
    sum(weight) OVER (ORDER BY ratio, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM l),
c AS (SELECT arg_min(level, ratio) AS common FROM v WHERE level <= ratio),
t AS (SELECT source, source_size, least(lim, weight * common) AS target FROM v, c),
e AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, epoch,
        round(t.target) - epoch * t.source_size AS room,
        coalesce(sum(d.size) OVER (PARTITION BY d.source, epoch ORDER BY md5('mix:' || epoch || ':' || doc_id)
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source, (VALUES (0), (1)) AS g(epoch))
SELECT doc_id, size, source_size, target,
    CAST(sum(greatest(0, least(size, room - before))) AS BIGINT) AS taken
FROM e GROUP BY ALL
"""


def pii_key(spark: SparkSession) -> str:
    """The session's key for pseudonyms; the invented people of the test tables need no secret one."""
    return spark.conf.get(pii.KEY_SETTING, "test tables only")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by pseudonyms."""
    return pii.pseudonymise(_documents(spark, sf_dir).select("doc_id", "text"), key=pii_key(spark))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, through a cache that is empty at first."""
    cache = new_scratch(spark, "token-counts")
    return token_counts.counts(_documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), cache)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every common beginning of the rebuilt conversations."""
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


# The polynomial is a fixed value of CRC-32.
OP12_SQL = """
WITH t AS (
    SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns,
        CAST(xor(4294967295, list_reduce(
            list_concat([4294967295::BIGINT], list_transform(range(1, 1 + length(CAST(conv_id AS VARCHAR))), lambda i: ascii(substr(CAST(conv_id AS VARCHAR), i, 1))::BIGINT)),
            lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                lambda e, z: CASE WHEN e & 1 = 1 THEN xor(e >> 1, 3988292384) ELSE e >> 1 END))) % 9 AS BIGINT) AS h
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
r AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
    FROM t AS c LEFT JOIN t AS b ON b.conv_id = c.conv_id - c.conv_id % 5),
p AS (SELECT conv_id, turns[1:depth] AS prefix, depth, len(turns) AS n FROM (SELECT *, unnest(range(len(turns) + 1)) AS depth FROM r)),
n AS (
    SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256,
        (count(*) - 1) * coalesce(strlen(prefix[depth].text), 0) AS saved
    FROM p GROUP BY prefix, depth),
c AS (SELECT prefix[1:depth - 1] AS prefix, depth - 1 AS depth, count(*) AS n FROM n WHERE depth > 0 GROUP BY ALL),
l AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM n LEFT JOIN c USING (prefix, depth)),
s AS (
    SELECT prefix[1:up] AS prefix, up AS depth, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT *, unnest(range(depth + 1)) AS up FROM l) GROUP BY ALL)
SELECT l.conv_id, l.depth, u.conv_id AS parent_conv_id, l.n_convs, l.n_children, n_leaves,
    CAST(saved_tokens AS BIGINT) AS saved_tokens, l.ends_sha256
FROM l JOIN s USING (prefix, depth) LEFT JOIN n AS u ON u.depth = l.depth - 1 AND u.prefix = l.prefix[1:l.depth - 1]
"""


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings in 16 codebooks of 64 entries."""
    return vector_codes.codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _op13_sql() -> str:
    """Rounds written out; parts have four components, as the vectors of the table have 64."""
    nearest = """SELECT rid, a.pos, min((({}) * 64) + entry) AS near FROM p AS a JOIN c{} AS b USING (pos) GROUP BY rid, a.pos"""
    distance = " + ".join(f"(a.v{i} - b.v{i}) * (a.v{i} - b.v{i})" for i in range(1, 5))
    means = ", ".join(f"floor(sum(v{i}) / count(*)) AS v{i}" for i in range(1, 5))
    rounds = [
        f"""a{n} AS ({nearest.format(distance, n)}),
c{n + 1} AS (SELECT pos, entry, {', '.join(f'CAST(coalesce(m.v{i}, b.v{i}) AS BIGINT) AS v{i}' for i in range(1, 5))}
    FROM c{n} AS b LEFT JOIN (SELECT pos, near % 64 AS entry, {means} FROM p JOIN a{n} USING (rid, pos) GROUP BY ALL) AS m
    USING (pos, entry))"""
        for n in range(2)
    ]
    return f"""
WITH k AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, list_transform(embedding, lambda c: CAST(floor(256 * c::DOUBLE) AS BIGINT)) AS x
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
p AS (
    SELECT rid, pos, x[4 * pos + 1] AS v1, x[4 * pos + 2] AS v2, x[4 * pos + 3] AS v3, x[4 * pos + 4] AS v4
    FROM k, range(16) AS r(pos)),
c0 AS (SELECT pos, rid - 1 AS entry, v1, v2, v3, v4 FROM p WHERE rid <= 64),
{", ".join(rounds)},
f AS ({nearest.format(distance, 2)}),
o AS (SELECT rid, string_agg(printf('%02x', near % 64), '' ORDER BY pos) AS code, CAST(sum(near // 64) AS BIGINT) AS error FROM f GROUP BY rid),
h AS (SELECT sha256(string_agg(v1 || ',' || v2 || ',' || v3 || ',' || v4, ',' ORDER BY pos, entry)) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM o JOIN k USING (rid), h
"""


OP13_SQL = _op13_sql()

QUERIES = {
    "op1_packing": op1_packing,
    "op2_embedding_links": op2_embedding_links,
    "op3_toxicity": op3_toxicity,
    "op4_quality": op4_quality,
    "op5_repeats": op5_repeats,
    "op6_minhash": op6_minhash,
    "op7_search": op7_search,
    "op8_token_files": op8_token_files,
    "op9_mixing": op9_mixing,
    "op10_pii": op10_pii,
    "op11_token_counts": op11_token_counts,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_vector_codes": op13_vector_codes,
}
ORACLES = {
    "op2_embedding_links": OP2_SQL,
    "op7_search": OP7_SQL,
    "op9_mixing": OP9_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_vector_codes": OP13_SQL,
}
