"""Token counts, prefix trie and vector codes against plain Python on small tables with odd rows."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlake.llm import prefix_trie, token_counts, vector_codes
from gridlake.llm.queries import vocabulary
from gridlake.session import list_names, new_scratch

TEXTS = [None, "", "a b", "a b", "it's <|endoftext|> here", "Ünï cödé  \n\n 漢字 ²", "word " * 60_000, "x" * 150_000, "a b"]
DOCS = "doc_id long, text string, n_tokens string, digest string, n string, row string"


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_equal_the_library(spark, name):
    path = vocabulary(name)
    if name.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        want = [len(SentencePieceProcessor(model_file=path).encode(t or "")) for t in TEXTS]
    else:
        from tokenizers import Tokenizer

        want = [len(Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids) for t in TEXTS]
    docs = spark.createDataFrame([(i, t, "own", "d", "n", "r") for i, t in enumerate(TEXTS)] + [(8, "a b", "own", "d", "n", "r")], DOCS)
    cache = new_scratch(spark, "counts")
    keep = ("doc_id", "n_tokens", "digest", "n", "row")
    got = token_counts.counts(docs.repartition(3), path, cache, keep=keep, limit=1).orderBy("doc_id").toPandas()
    assert list(got["doc_id"]) == [*range(len(TEXTS)), 8]
    assert list(got["n_tokens_"]) == [*want, want[8]]
    assert list(got["n_bytes"]) == [len((t or "").encode()) for t in TEXTS] + [3]
    assert list(got["over_limit"]) == [n > 1 for n in want] + [want[8] > 1]
    assert set(got["n_tokens"]) == {"own"} and set(got["digest"]) == {"d"} and set(got["row"]) == {"r"}


def test_only_missing_contents_are_encoded(spark, monkeypatch):
    path, cache = vocabulary("byte_bpe_50k.json"), new_scratch(spark, "counts")
    version = token_counts.version_digest(path)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS[:6])], "doc_id long, text string")
    # A text that is in the cache keeps the count it has there.
    known = docs.where("doc_id = 5").select(F.unhex(F.sha2("text", 256)).alias("digest"), F.lit(77).cast("long").alias("n_tokens"))
    known.write.parquet(f"{cache}/version={version}/run=a")
    # What a lost run left does not count.
    known.withColumn("n_tokens", F.lit(99).cast("long")).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{cache}/version={version}/run=lost")
    first = {r["doc_id"]: r["n_tokens"] for r in token_counts.counts(docs, path, cache).collect()}
    assert first[5] == 77 and first[0] == first[1] == 0 and first[2] == first[3]
    contents = token_counts.cached(spark, cache, version).count()
    assert contents == len({t or "" for t in TEXTS[:6]})
    monkeypatch.setattr(token_counts, "FEW", 0)
    more = docs.union(spark.createDataFrame([(9, "new one")], docs.schema))
    again = {r["doc_id"]: r["n_tokens"] for r in token_counts.counts(more, path, cache).collect()}
    assert again == first | {9: 2}
    assert token_counts.cached(spark, cache, version).count() == contents + 1
    assert token_counts.counts(docs.limit(0), path, cache).count() == 0
    assert list_names(spark, cache) == [f"version={version}"]


def brute_trie(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members = collections.defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built = own.get(c - c % 5, [])[:h] + own[c][h:]
        for d in range(len(built) + 1):
            members[tuple(built[:d])].append((c, len(built) == d))
    children = collections.defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = []
    for p, m in members.items():
        below, todo = [], [p]
        while todo:
            q = todo.pop()
            below.append(q)
            todo += children[q]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = hashlib.sha256(",".join(str(c) for c, end in sorted(m) if end).encode()).hexdigest()
        parent = min(c for c, _ in members[p[:-1]]) if p else None
        out.append((min(m)[0], len(p), parent, len(m), len(children[p]), sum(not children[q] for q in below), saved, ends))
    return collections.Counter(out)


def got_trie(spark, rows, **options):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit("x"))
    names = [c.split()[0] for c in prefix_trie.NODE.split(", ")]
    return collections.Counter(tuple(r) for r in prefix_trie.trie(df.repartition(4), **options).select(*names).collect())


@pytest.mark.parametrize("per_range", [3, 40, 100_000])
def test_trie_equals_brute_force(spark, per_range):
    rng = np.random.default_rng(per_range)
    rows = [(None, 0, "user", "x"), (7, None, None, None), (7, 3, "user", "late"), (3000, 0, "", "")]
    for c in range(90):
        for turn in range(rng.integers(1, 7)):
            rows.append((c, turn, ["user", "assistant", None][turn % 3], f"é{rng.integers(0, 2)}" if turn else "hello"))
    rows += [(c, t, "user", f"same {t}") for c in range(100, 400, 5) for t in range(11)]  # a group of copies
    rows += [(1000 + c, 0, "user", "one") for c in range(40)]
    rows += [(2000, t, "user", str(t)) for t in range(300)] + [rows[5], rows[5]]
    assert got_trie(spark, rows, turns_per_range=per_range) == brute_trie(rows)


def test_trie_of_nothing(spark):
    assert not got_trie(spark, [])
    assert not got_trie(spark, [(None, 1, "user", "x")])
    assert got_trie(spark, [(1, 0, "a", "b")]) == brute_trie([(1, 0, "a", "b")])


def test_extents_of_the_sparse_table():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 64, 100):
        values = rng.integers(0, 5, n)
        table = prefix_trie.LeastTable(values)
        at, depth = map(np.array, zip(*itertools.product(range(n), range(6)), strict=True))
        left, right = table.left_end(at, depth), table.right_end(at, depth)
        for i, d, lo, hi in zip(at, depth, left, right, strict=True):
            assert (values[lo + 1 : i + 1] >= d).all() and (lo == 0 or values[lo] < d)
            assert (values[i + 1 : hi + 1] >= d).all() and (hi == n - 1 or values[hi + 1] < d)
        assert (table.least(np.minimum(at, at[::-1]), np.maximum(at, at[::-1])) == [
            values[min(a, b) : max(a, b) + 1].min() for a, b in zip(at, at[::-1], strict=True)
        ]).all()


def brute_codes(rows):
    kept = sorted([r for r in rows if r[1] is not None and len(r[1]) == 32 and all(c is not None and math.isfinite(c) for c in r[1])],
                  key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = [[tuple(math.floor(256 * c) for c in v[2 * p : 2 * p + 2]) for p in range(16)] for _, v, _ in kept]
    books = [[v[p] for v in x[:64]] for p in range(16)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(2):
        for p, book in enumerate(books):
            owned = collections.defaultdict(list)
            for v in x:
                owned[near(v[p], book)[1]].append(v[p])
            for i, m in owned.items():
                book[i] = tuple(sum(c) // len(m) for c in zip(*m, strict=True))
    found = [[near(v[p], books[p]) for p in range(16)] for v in x]
    errors = [sum(d for d, _ in f) for f in found]
    labels = collections.Counter()
    for (_, _, label), e in zip(kept, errors, strict=True):
        labels[label] += e
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return collections.Counter(
        (i, "".join(f"{c:02x}" for _, c in f), e, labels[label], sha) for (i, _, label), f, e in zip(kept, found, errors, strict=True)
    )


@pytest.mark.parametrize("n", [40, 400])
def test_codes_equal_brute_force(spark, monkeypatch, n):
    rng = np.random.default_rng(n)
    rows = [(i, [float(c) for c in rng.normal(0, 0.2, 32).round(3)], int(i % 7) if i % 3 else None) for i in range(n)]
    rows += [(n + i, rows[3][1], 2) for i in range(n)]  # half of all rows are equal
    rows += [rows[0], (None, rows[1][1], None), (5, [-1.0] * 32, 1), (5, [-2.0] * 32, 1)]
    rows += [(-1, None, 1), (-2, [None] * 32, 1), (-3, [math.nan] * 32, 1), (-4, [math.inf] * 32, 1), (-5, [], 1), (n * 3, [1.0] * 5, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    df = df.withColumns({"code": F.lit("own"), "row": F.lit(1), "x": F.lit(2), "rid": F.lit(3)}).repartition(4)
    monkeypatch.setattr(vector_codes, "MEMBERS_PER_OWNER", 50)
    monkeypatch.setattr(vector_codes, "BATCH", 64)
    got = vector_codes.codes(df, keep=("code", "row")).collect()
    assert {(r["code"], r["row"]) for r in got} == {("own", 1)}
    assert collections.Counter((r["vec_id"], r["code_"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got) == brute_codes(rows)


def test_codes_of_nothing_and_of_uneven_parts(spark):
    schema = "vec_id long, embedding array<float>, label string"
    assert vector_codes.codes(spark.createDataFrame([(1, None, "a")], schema)).count() == 0
    got = vector_codes.codes(spark.createDataFrame([(1, [0.5] * 17, "a"), (2, [-0.5] * 17, None)], schema)).collect()
    want = ",".join(str(c) for p in range(9) for c in [128] * min(2, 17 - 2 * p) + [-128] * min(2, 17 - 2 * p))
    assert {r["codebooks_sha256"] for r in got} == {hashlib.sha256(want.encode()).hexdigest()}
    assert [r["error"] for r in got] == [0, 0]
    with pytest.raises(Exception, match="beyond"):
        vector_codes.codes(spark.createDataFrame([(1, [1e9] * 16, "a")], schema)).collect()
