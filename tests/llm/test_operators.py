"""Each operator against plain Python on small tables with nulls, empty texts, ties and repeated rows."""

from __future__ import annotations

import collections
import ctypes
import hashlib
import json
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridlake.llm import (
    bwt,
    embeddings,
    minhash,
    mixing,
    packed_ids,
    packing,
    pii,
    quality,
    search,
    suffixes,
    tokens,
    toxicity,
)
from gridlake.llm.common import components, gives_memory_back
from gridlake.llm.queries import vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, mix string, class_key string, score string"


def word(i):
    return "w" + hashlib.md5(str(i).encode()).hexdigest()[:5]


def text(seed, n=80):
    return " ".join(word(seed * 1000 + i) for i in range(n))


@pytest.fixture(scope="module")
def rows():
    base = text(1)
    near = base.replace(word(1040), "other")
    period = "one two " * 60
    texts = [base, near, base, text(2), None, "", "a b", "a b", period, "x" * 700, text(3) + base[:300], "Ünï cödé  \n\n 漢字 ²", text(4, 3000)]
    out = [(i, t, "en", f"s{i % 3}" if i % 5 else None, 1, "m", "k", "c") for i, t in enumerate(texts)]
    return [*out, out[3], (None, "no id " + text(5), None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("by, name", [("byte", "byte_bpe_50k.json"), ("word", "word_bpe_49k.json")])
def test_encoder_equals_the_library(by, name, rows):
    own = tokens.Encoder(vocabulary(name), by)
    for t in [r[1] or "" for r in rows] + ["it's  I'LL\n\n x", " a ", "İ<|endoftext|>", "é́ \x1c  b", "1234 !?'s"]:
        assert own.encode(t) == own.whole(t)
        assert own.encode(t) == own.whole(t)


def test_encoder_of_other_settings_takes_texts_whole(tmp_path, rows):
    """A vocabulary that cuts texts in another way gets the ids of its own library."""
    with open(vocabulary("byte_bpe_50k.json"), encoding="utf-8") as file:
        parts = json.load(file)
    parts["pre_tokenizer"]["add_prefix_space"] = True
    other = tmp_path / "other.json"
    other.write_text(json.dumps(parts), encoding="utf-8")
    own = tokens.Encoder(str(other), "byte")
    assert not own.cuts and own.encode("a b") == own.whole("a b") != tokens.Encoder(vocabulary("byte_bpe_50k.json"), "byte").encode("a b")
    for by, name in (("word", "byte_bpe_50k.json"), ("byte", "word_bpe_49k.json")):  # the wrong way named
        own = tokens.Encoder(vocabulary(name), by)
        assert not own.cuts and all(own.encode(r[1] or "") == own.whole(r[1] or "") for r in rows)


def test_encoder_forgets_in_generations(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_PIECES", {"byte": 5})
    own = tokens.Encoder(vocabulary("byte_bpe_50k.json"), "byte")
    for t in [text(7), text(8), text(7), "long " + "y" * 200 + " " + text(7)]:
        assert own.encode(t) == own.whole(t)
    assert len(own.known) <= 5 and len(own.known.before) <= 5


def test_encoder_remembers_as_many_words_as_it_is_told():
    path = vocabulary("byte_bpe_50k.json")
    own = tokens.encoder(path, "byte", 5)
    for t in [text(7), text(8), text(7)]:
        assert own.encode(t) == own.whole(t)
    assert len(own.known) <= 5 and len(own.known.before) <= 5
    assert tokens.encoder(path, "byte", 5) is own is not tokens.encoder(path, "byte")
    tokens.release()


def test_packing_is_the_same_with_few_remembered_words(docs):
    path = vocabulary("byte_bpe_50k.json")
    many, few = (collections.Counter(packing.pack(docs, path, "byte", 1, size=64, remembered=n).collect()) for n in (None, 5))
    assert many == few


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="not glibc")
def test_memory_goes_back_behind_the_last_batch():
    def own():  # MB of this process without mapped files
        with open("/proc/self/status") as file:
            return next(int(line.split()[1]) for line in file if line.startswith("RssAnon")) / 1024

    last = []  # lies above what is freed, so the allocator keeps it

    def used(batches):
        for batch in batches:
            held = [bytes(60_000) for _ in range(3000)]
            last.append(held.pop())
            del held
            yield batch

    ctypes.CDLL(None).malloc_trim(0)
    before = own()
    assert list(used([1, 2])) == [1, 2] and own() - before > 100
    assert list(gives_memory_back(used)([1, 2])) == [1, 2] and own() - before < 60
    assert list(gives_memory_back(used)([])) == []


def test_packing_places_every_id_once(docs, empty, rows):
    path = vocabulary("byte_bpe_50k.json")
    own = tokens.Encoder(path, "byte")
    for targets in (None, {"s1": 3.0, "s2": 1.0}):
        got = packing.pack(docs, path, "byte", 1, size=64, targets=targets, queues=3, keep_ids=True).toPandas()
        want = collections.Counter((r[0], own.whole(r[1] or "") + b"\1\0\0\0") for r in rows)
        assert got["length"].sum() == sum(len(b) // 4 * n for (_, b), n in want.items())
        assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got.itertuples())
        for _, window in got.sort_values("offset").groupby("sequence_id"):
            assert list(window["offset"]) == list(window["length"].cumsum() - window["length"])
            assert window["length"].sum() == 64 or window["sequence_id"].iat[0] == got["sequence_id"].max()
        for i in (0, 4, 9, 12):
            one = got[got["doc_id"] == i].sort_values("start")
            assert b"".join(one["ids"]) == next(b for (d, b) in want if d == i)
    shares = packing.Schedule([1000, 2000, 3000], [1, 2, 3], 100)
    served = np.diff(shares.bounds(np.arange(0, 61)), axis=0)
    assert (served.sum(axis=1) == 100).all() and (abs(served - [100 / 6, 200 / 6, 50]) <= 1.01).all()
    assert packing.pack(empty, path, "byte", 1).count() == 0


def test_packing_hands_no_lists_to_python_workers(spark, docs, monkeypatch):
    """A table made from a list is read through Python workers of another kind, which then stay beside those of the stages."""
    given, made = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **k: given.append(data) or made(self, data, *a, **k))
    assert packing.pack(docs, vocabulary("byte_bpe_50k.json"), "byte", 1).count()
    assert given and all(isinstance(g, pa.Table) for g in given)


@pytest.mark.parametrize("queues", [256, 16, 3])
def test_more_sources_than_queues_keep_their_shares(queues):
    sizes = [4000 + i % 7 for i in range(600)]
    weights = [1.0 + i % 3 for i in range(600)]
    tree = packing.Tree(sizes, weights, 2048, queues)
    assert len(set(tree.leaf)) == 600 and all(len(s.sizes) <= queues for s in tree.schedules)
    node, queue = np.array(tree.leaf).T
    owner, seen = np.full(sum(sizes), -1), np.zeros(sum(sizes), np.int64)
    for row, start, length, at in tree.placed(node, queue, np.zeros(600, np.int64), np.array(sizes)):
        for r, s, n, a in zip(row, start, length, at, strict=True):
            assert (owner[a : a + n] == -1).all()
            owner[a : a + n], seen[a : a + n] = r, np.arange(s, s + n)
    assert (owner >= 0).all() and all((np.diff(seen[owner == r]) == 1).all() for r in range(600))
    head = owner[: 200 * 2048]  # while all last, every source has about its share
    got = np.bincount(head, minlength=600) / len(head)
    assert (abs(got / (np.array(weights) / sum(weights)) - 1) < 0.15).all()


def test_a_very_long_document_is_cut_in_parts(monkeypatch):
    monkeypatch.setattr(packing, "CELLS", 1000)
    tree = packing.Tree([10**7, 500], [1.0, 1.0], 2048, 256)
    parts = list(tree.placed(np.zeros(2, int), np.array([0, 1]), np.zeros(2, np.int64), np.array([10**7, 500])))
    assert max(len(p[0]) for p in parts) <= 500 and sum(p[2].sum() for p in parts) == 10**7 + 500


def test_embedding_links_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((20, 16))
    vectors = [b + rng.standard_normal(16) * s for b in base for s in (0.0, 0.1, 0.15, 0.2, 0.0)]
    vectors += [np.zeros(16), rng.standard_normal(5)]
    data = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    data += [(500, None), (501, []), (502, [None] * 16), (503, [math.inf] * 16), (504, [math.nan] * 16), (0, data[0][1])]
    got = embeddings.links(spark.createDataFrame(data, "vec_id long, embedding array<double>")).toPandas()
    x = [np.array(v) / np.linalg.norm(v) if i < 100 else None for i, v in data]
    links = [[j for j, b in enumerate(x) if b is not None and a is not None and j != k and a @ b >= 0.95] for k, a in enumerate(x)]
    want = collections.Counter()
    for k, (i, _) in enumerate(data):
        seen, todo = {k}, [k]
        while todo:
            todo = [j for t in todo for j in links[t] if j not in seen and not seen.add(j)]
        want[i, len(links[k]), min(data[j][0] for j in seen)] += 1
    assert collections.Counter(zip(got["vec_id"], got["n_links"], got["component_id"], strict=True)) == want
    assert ((got["vec_id"] == got["component_id"]) == got["kept"]).all()


def test_toxicity_orders_grades(spark, empty):
    mild, harsh = "sillyword", "vileword"
    data = [(i, f"{text(i, 30)} {[mild, harsh, ''][i % 3]}", [1, 2, 0][i % 3]) for i in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in data] + [(1000, None), (1001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, g) for i, _, g in data] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fitted(docs, labels)
    assert (np.diff(model.cuts) > 0).all()
    got = toxicity.graded(docs, model).toPandas().set_index("doc_id")
    assert all(got.loc[i, "grade"] == g for i, _, g in data) and got.loc[1000, "grade"] == 0
    assert got.loc[1, "severity"] > got.loc[0, "severity"] > got.loc[2, "severity"] >= 0
    assert toxicity.graded(empty, toxicity.fitted(empty, labels.limit(0))).count() == 0


def test_quality_takes_few_texts_out_of_a_batch_at_once(spark):
    """A batch of 20 MB and what is made of it in Python, at their most together; before, 60 MB."""

    class Watch:
        def __setstate__(self, state):
            import tracemalloc

            tracemalloc.start()

        def __getstate__(self):
            return 1

        def probability(self, texts):
            import tracemalloc

            most = tracemalloc.get_traced_memory()[1] / 1e6
            if any(t.startswith(b"1999 ") for t in texts):
                tracemalloc.stop()
            return [most] * len(texts)

    many = spark.range(0, 2000, 1, 1).select("id", F.concat("id", F.lit(" "), F.repeat(F.lit("text "), 2000)).alias("text"))
    got = quality.scored(many, Watch())
    assert got.agg(F.max("score")).first()[0] < 30
    assert not got.drop("score").exceptAll(many).count() and got.count() == 2000


def test_quality_keeps_columns_of_any_type(spark):
    odd = spark.sql(
        """SELECT id, IF(id % 3 = 0, NULL, CAST(id AS STRING)) AS text, IF(id = 1, NULL, id) AS n, CAST(id AS DECIMAL(20, 3)) AS d,
        TIMESTAMP '2020-01-01 00:00:00' AS t, TIMESTAMP_NTZ '2020-01-01 00:00:00' AS u, DATE '2020-01-01' AS v, array(id, NULL) AS a,
        map('k', id) AS m, named_struct('x', id, 'y', array('z')) AS s, CAST('b' AS BINARY) AS b, INTERVAL '1' DAY AS i, id > 1 AS f FROM range(7)"""
    )
    got = quality.scored(odd, quality.ByteNetwork())
    assert got.drop("score").schema.simpleString() == odd.schema.simpleString()
    assert sorted(map(str, got.drop("score").collect())) == sorted(map(str, odd.collect()))
    assert {r["score"] for r in got.where("text IS NULL").collect()} == {r["score"] for r in quality.scored(odd.selectExpr("'' AS text"), quality.ByteNetwork()).collect()}


def test_quality_separates_held_out_texts(spark, docs, empty):
    data = [(i, text(i, 40) if i % 2 else "%%% ".join(text(i, 40).split()), i % 2) for i in range(400)]
    own = spark.createDataFrame([(i, t) for i, t, _ in data] + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in data], "doc_id long, quality int")
    got = quality.judged(own, labels).toPandas().set_index("doc_id")
    want = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in got.index}
    assert got["held_out"].to_dict() == want
    truth = {i: y for i, _, y in data}
    assert all(got.loc[i, "predicted"] == truth[i] for i in truth if want[i])
    assert got.loc[900, "score"] == pytest.approx(got.loc[901, "score"]) and got["score"].between(0, 1).all()
    assert quality.judged(docs, labels.limit(0)).count() == docs.count()
    assert quality.judged(empty, labels).count() == 0
    network = quality.ByteNetwork()
    alone = [network.probability([t])[0] for t in (b"", b"abc", b"x" * 5000)]
    assert network.probability([b"", b"abc", b"x" * 5000]) == pytest.approx(alone)


def test_network_equals_plain_python():
    net = quality.ByteNetwork(3)
    net.bias[0] = 0.25
    for given in (b"", b"abc", bytes(i * 37 % 256 for i in range(900))):
        blocks = -(-(len(given) + quality.WIDTH - 1) // quality.BLOCK)
        data = (b"\0" * (quality.WIDTH - 1) + given).ljust(blocks * quality.BLOCK + quality.WIDTH - 1, b"\0")
        best = [[0.0] * quality.FILTERS for _ in range(blocks)]
        for p in range(blocks * quality.BLOCK):
            seen = [float(x) for c in data[p : p + quality.WIDTH] for x in net.bytes[c]]
            for f in range(quality.FILTERS):
                answer = sum(x * float(net.filters[i, f]) for i, x in enumerate(seen)) + float(net.shift[f])
                best[p // quality.BLOCK][f] = max(best[p // quality.BLOCK][f], answer)
        chunks = [[max(x, y) for x, y in zip(a, b, strict=True)] for a, b in zip(best, best[1:], strict=False)] or best
        features = [max(c) for c in zip(*chunks, strict=True)] + [sum(c) / len(chunks) for c in zip(*chunks, strict=True)]
        want = 1 / (1 + math.exp(-sum(x * float(w) for x, w in zip(features, net.last, strict=True)) - 0.25))
        assert net.probability([given])[0] == pytest.approx(want, abs=1e-5)


def test_fit_slopes_of_long_texts_do_not_depend_on_the_parts(monkeypatch):
    texts, labels = [bytes(i * 7 % 251 for i in range(n)) for n in (5, 3000, 20000)], np.array([1, 0, 1], np.float32)
    whole = quality.ByteNetwork()._slopes(texts, labels)
    monkeypatch.setattr(quality, "PIECE", 4 * quality.BLOCK)
    monkeypatch.setattr(quality, "SLOPES", 100)
    parts = quality.ByteNetwork()._slopes(texts, labels)
    assert all(np.allclose(a, b, atol=1e-5) for a, b in zip(whole, parts, strict=True))


def test_fit_is_bounded_by_rows_of_whole_texts(spark):
    docs = spark.createDataFrame([(i, "x" * 100) for i in range(1, 50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 50)], "doc_id long, quality int")
    every = quality.sample(docs, labels, "quality", 1000, 10**6).collect()
    few = quality.sample(docs, labels, "quality", 1000, 1050).collect()
    assert len(few) == 10 and set(few) < set(every) and all(len(r["text"]) == 100 for r in every)
    assert quality.sample(docs, labels, "quality", 1000, 99).count() == 0


def test_transform_of_a_collection():
    rng = np.random.default_rng(1)
    for _ in range(50):
        strings = [bytes(rng.integers(97, 99, rng.integers(0, 12)).astype(np.uint8)) for _ in range(rng.integers(1, 6))]
        data = np.frombuffer(b"".join(strings), np.uint8)
        string, start, common, before = bwt.collection(data, np.array([len(s) for s in strings]))
        found = [strings[i][j:] for i, j in zip(string, start, strict=True)]
        assert found == sorted(found)
        assert [b if j else -1 for b, j in zip([strings[i][j - 1] if j else -1 for i, j in zip(string, start, strict=True)], start, strict=True)] == list(before)
        for a, b, n in zip(found, found[1:], common[1:], strict=False):
            assert a[:n] == b[:n] and (a[n : n + 1] != b[n : n + 1] or len(a) == n)


@pytest.mark.parametrize("most", [256, 0])
def test_repeats_equal_brute_force(docs, empty, rows, most, monkeypatch):
    monkeypatch.setattr(suffixes, "MOST_PIECES", most)
    got = suffixes.digest(suffixes.without_repeats(docs)).toPandas()
    data = [(r[1] or "").encode() for r in rows]
    seen = collections.Counter(t[s : s + 200] for t in data for s in range(len(t) - 199))
    want = collections.Counter()
    for r, t in zip(rows, data, strict=True):
        cut = np.zeros(len(t), bool)
        for s in range(len(t) - 199):
            cut[s : s + 200] |= seen[t[s : s + 200]] > 1
        spans = int((np.diff(np.append(0, cut.astype(int))) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~cut].tobytes()
        want[-1 if r[0] is None else r[0], len(t), int(cut.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    got["doc_id"] = got["doc_id"].fillna(-1).astype(int)
    assert collections.Counter(got.itertuples(index=False, name=None)) == want
    assert suffixes.digest(suffixes.without_repeats(empty)).count() == 0


def test_bitmap_lets_every_wanted_row_through(spark):
    rows = spark.range(20000).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("node"), "id")
    rows = rows.unionByName(rows.where("id < 10"))
    wanted = rows.where("id % 9 = 0").select("node").distinct()
    found = [r["id"] for r in minhash.maybe_in(rows, wanted, "node").select("id").collect()]
    through = sorted(i for i in found if i % 9 == 0)
    assert through == sorted([*range(0, 20000, 9), 0, 9])
    assert len(found) < 2 * len(through)
    assert minhash.maybe_in(rows, wanted.where("false"), "node").isEmpty()


def test_near_duplicates(spark, docs, empty):
    got = {r["doc_id"]: r for r in minhash.classes(docs).collect()}
    assert [got[i]["class_id"] for i in range(13)] == [0, 0, 0, 3, 4, 5, 6, 6, 8, 9, 10, 11, 12]
    assert sum(r["kept"] for r in got.values()) == 11
    kept = minhash.deduplicated(docs).toPandas()
    assert list(kept.columns) == docs.columns
    assert sorted(kept["doc_id"].fillna(-1)) == [-1, 0, 3, 4, 5, 6, 8, 9, 10, 11, 12]
    assert minhash.classes(empty).count() == 0 and minhash.deduplicated(empty).count() == 0
    chain = spark.createDataFrame([(i + 1, i) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    assert {tuple(r) for r in components(chain).collect()} == {(i, 0) for i in range(61)} | {(100, 100), (101, 100)}


def test_a_passage_repeated_inside_one_copy_is_still_a_link(spark):
    data = []
    for i, block in enumerate((120, 120, 200, 200)):
        base = text(10 + i, 1000)
        data += [(2 * i, base), (2 * i + 1, base + (" " + text(20 + i, block)) * 20)]
    assert (minhash.jaccard([t for _, t in data[::2]], [t for _, t in data[1::2]]) > 0.82).all()
    got = {r["doc_id"]: r["class_id"] for r in minhash.classes(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i in range(8)}


def test_pairs_that_share_a_bucket_are_compared_once(spark):
    texts = [t for i in range(1500) for t in (text(i, 60), f"{text(i, 54)} {text(9000 + i, 6)}")]
    members, registers, want = [], [], collections.Counter()
    found, register = (np.concatenate(part) for part in list(zip(*minhash.band_hashes(texts), strict=True))[2:])
    nodes = [str(i).zfill(5).encode() for i in range(len(texts))]
    for a in range(0, len(texts), 2):
        same = np.flatnonzero(found[a] == found[a + 1])
        members += [(int(found[i].view(np.int64)[k]), int(k), nodes[i], nodes[i], b"none") for k in same for i in (a, a + 1)]
        registers += [(nodes[i], register[i].tobytes()) for i in (a, a + 1)]
        if len(same) and (register[a] == register[a + 1]).mean() >= minhash.PLAUSIBLE:
            want[nodes[a + 1], nodes[a]] += 1
    mixed = spark.createDataFrame(members, "bucket long, band int, node binary, root binary, main binary")
    got = minhash.across(mixed, spark.createDataFrame(registers, "node binary, registers binary")).collect()
    assert len(want) > 1000 and collections.Counter((bytes(r["a"]), bytes(r["b"])) for r in got) == want


def test_search_equals_brute_force(spark, docs, empty, rows):
    data = [(i, f"{text(i % 7, 20 + i)} {'rare' if i % 50 == 0 else ''} the the") for i in range(300)] + [(400, None), (401, "")]
    corpus = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    asked = [(1, f"the {word(1003)} rare rare {word(2005)}"), (2, "unknownword"), (3, None), (None, "the")]
    got = search.top_k(corpus, spark.createDataFrame(asked, "query_id long, text string"), k=7).toPandas()
    words = {i: (t or "").lower().split() for i, t in data}
    mean = sum(map(len, words.values())) / len(words)
    score = collections.Counter()
    for t in set(asked[0][1].split()):
        has = [i for i in words if t in words[i]]
        idf = math.log(1 + (len(words) - len(has) + 0.5) / (len(has) + 0.5))
        for i in has:
            tf = words[i].count(t)
            score[i] += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words[i]) / mean))
    want = sorted(((round(s, 6), i) for i, s in score.items()), key=lambda x: (-x[0], x[1]))[:7]
    got = got.sort_values("rank")
    assert set(got["query_id"]) == {1} and [(s, d) for s, d in zip(got["score"], got["doc_id"], strict=True)] == want
    assert search.top_k(empty, spark.createDataFrame(asked, "query_id long, text string")).count() == 0


def test_packed_fields_and_files(docs, empty, rows):
    rng = np.random.default_rng(0)
    for bits in (1, 7, 13, 16, 17, 32):
        ids = rng.integers(0, 2**bits, 1000).astype(np.uint32)
        assert (packed_ids.unpack(packed_ids.pack(ids, bits), bits, 1000) == ids).all()
    assert [packed_ids.bits_for(n) for n in (2, 3, 49_408, 65_536, 65_537)] == [1, 2, 16, 16, 17]
    path = vocabulary("word_bpe_49k.json")
    own = tokens.Encoder(path, "word")
    for size in (49_408, 100_000):
        got = packed_ids.token_files(docs, path, "word", 2, size).toPandas().sort_values("start")
        want = sorted(((-1 if r[0] is None else r[0], r[1] or "") for r in rows))
        ids = [own.whole(t) + b"\2\0\0\0" for _, t in want]
        assert list(got["doc_id"].fillna(-1)) == [i for i, _ in want]
        assert list(got["ids_crc32"]) == [zlib.crc32(b) for b in ids]
        assert list(got["start"]) == list(np.cumsum([0, *(len(b) // 4 for b in ids)])[:-1])
    assert packed_ids.token_files(empty, path, "word", 2, 49_408).count() == 0


def test_mixture_keeps_quotas(spark, docs, empty, rows):
    got = mixing.mix_plan(docs, shards=4).select("doc_id", "source", "mix.*").toPandas()
    assert len(got) == len(rows)
    taken = got["parts"].map(lambda ps: sum(p["taken"] for p in ps))
    assert (taken <= 2 * got["size"]).all()
    for _, own in got.assign(taken=taken).groupby("source", dropna=False):
        assert abs(own["taken"].sum() - own["target"].iat[0]) <= 2
    again = mixing.mix_plan(docs, shards=4).select("doc_id", "mix.parts").toPandas()
    assert sorted(map(str, again["parts"])) == sorted(map(str, got["parts"]))
    mixed = mixing.mix(docs, shards=4)
    assert set(mixed.columns) - {"mix_shard", "mix_place"} == set(docs.columns) - {"mix"}
    assert mixed.agg(F.sum(mixing.words(F.col("text")))).first()[0] == taken.sum()
    counts = spark.createDataFrame([(0, 50), (1, 0), (2, 30), (3, 7)], "rank int, blocks long")
    split = mixing.split_blocks(counts, 7).toPandas()
    assert split.groupby("rank")["n"].sum().tolist() == [50, 0, 30, 7]
    assert split.groupby("shard")["n"].sum().between(11, 14).all()
    assert mixing.mix(empty).count() == 0


@pytest.mark.parametrize("words", [(1,), (5,), (1, 0, 2)])
def test_mixture_where_documents_fill_the_room_exactly(spark, words):
    data = [(i, " ".join(["w"] * words[i // 3 % len(words)]), f"s{i % 3}") for i in range(360)]
    got = mixing.mix_plan(spark.createDataFrame(data, "doc_id long, text string, source string"), shards=4)
    got = got.select("doc_id", "source", "mix.*").toPandas()
    for _, own in got.groupby("source"):
        size, source_size, quota = own.set_index("doc_id")["size"], own["source_size"].iat[0], round(own["target"].iat[0])
        want = dict.fromkeys(size.index, 0)
        for epoch in (0, 1):
            room = quota - epoch * source_size
            for i in sorted(size.index, key=lambda i: hashlib.md5(f"{mixing.SEED}:{epoch}:{i}".encode()).hexdigest()):
                want[i] += max(0, min(size[i], room))
                room -= size[i]
        assert {r.doc_id: sum(p["taken"] for p in r.parts) for r in own.itertuples()} == want


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def test_pseudonyms_keep_formats(spark, empty):
    values = {
        "card": "4111111111111111", "spaced": "5500-0000-0000-0004", "phone": "+1 (017) 555-7713", "ip": "192.168.7.31",
        "date": "1987-11-03", "european": "31.12.1999", "ssn": "219-09-9999", "iban": "DE89370400440532013000",
        "mail": "jörg.müller@mail.example.com", "secret": 'token = "a1b2c3d4e5f60718"',
    }
    data = [(i, f"See {v}, again {v}.") for i, v in enumerate(values.values())]
    data += [(90, None), (91, ""), (92, "4111111111111112 and 999.1.1.1 on 2001-02-30 at v1.2"), (93, "4111111111111111")]
    docs = spark.createDataFrame([(i, t, "z") for i, t in data], "doc_id long, text string, n_replaced string")
    got = {r["doc_id"]: r for r in pii.pseudonymise(docs, key="k").collect()}
    found = {}
    for (kind, old), i in zip(values.items(), range(len(values)), strict=True):
        first, second = got[i]["text"].removeprefix("See ").removesuffix(".").split(", again ")
        assert first == second != old and old not in got[i]["text"] and got[i]["n_replaced"] == 2, kind
        found[kind] = first
    assert luhn(found["card"]) and luhn(found["spaced"].replace("-", "")) and got[93]["text"] == found["card"]
    assert [c if not c.isdigit() else "9" for c in found["phone"]] == [c if not c.isdigit() else "9" for c in values["phone"]]
    assert all(0 <= int(x) < 256 for x in found["ip"].split(".")) and len(found["date"]) == 10 and found["date"][4] == "-"
    turned = found["iban"][4:] + str(ord("D") - 55) + str(ord("E") - 55) + found["iban"][2:4]
    assert int(turned) % 97 == 1
    assert got[90]["text"] is None and got[91]["text"] == "" and got[92]["text"] == data[12][1] and got[92]["n_replaced"] == 0
    assert pii.pseudonymise(empty, key="k").count() == 0
    pairs = spark.range(17 * 19).selectExpr(f"{pii.feistel('17L', '19L', 'id % 17', 'id DIV 17', chr(39) + 't' + chr(39), 'k')} AS p")
    assert {tuple(r["p"]) for r in pairs.collect()} == {(a, b) for a in range(17) for b in range(19)}


def test_values_next_to_other_groups_are_found(spark):
    iban, short, card = "ES91 2100 0418 4502 0005 1332", "NO93 8601 1117 947", "4111 1111 1111 1111"
    cases = [
        (f"{iban} BIC CAIXESBB", iban), (f"{iban} 2024", iban), (f"AB12 {iban}", iban), (f"{short} 2024 1234", short),
        (f"pay {iban.replace(' ', '')} BIC", iban.replace(" ", "")), (f"2024 {card}", card), (f"{card} 2024", card),
        (f"1234-{card.replace(' ', '-')}.", card.replace(" ", "-")), ("30/02/1987-11-03", "1987-11-03"), (card, card),
    ]
    data = [(i, t) for i, (t, _) in enumerate(cases)] + [(100, "2024 4111 1111 1112 1111 x"), (101, f"{card}, {card}")]
    got = {r["doc_id"]: r for r in pii.pseudonymise(spark.createDataFrame(data, "doc_id long, text string"), key="k").collect()}
    for i, (t, value) in enumerate(cases):
        before, after = t.split(value)
        new = got[i]["text"].removeprefix(before).removesuffix(after)
        assert got[i]["text"] == before + new + after and new != value and len(new) == len(value) and got[i]["n_replaced"] == 1, t
    assert got[100]["text"] == data[-2][1] and got[100]["n_replaced"] == 0
    assert got[101]["text"] == f"{got[9]['text']}, {got[9]['text']}" and got[101]["n_replaced"] == 2


def test_dates_are_permuted_within_their_format(spark):
    days = spark.sql("SELECT explode(sequence(DATE'1900-01-01', DATE'2099-12-31')) AS d")
    late = days.where("day(d) > 12").selectExpr("date_format(d, 'dd/MM/yyyy') AS m")
    for old, number, fmt in ((late, pii.LATE, "dd/MM/yyyy"), (days.selectExpr("date_format(d, 'MM/dd/yyyy') AS m"), pii.DAYS, "MM/dd/yyyy")):
        new = old.select(F.expr(pii._date("m", "k")).alias("m"))
        assert old.count() == new.distinct().count() == number
        assert new.exceptAll(old).isEmpty() and not new.where(F.to_date("m", fmt).isNull()).count()


def test_feistel_and_check_digits_equal_plain_python(spark):
    def plain(a, b, left, right, tweak, key):
        for i in range(pii.ROUNDS):
            said = f"{key}|{tweak}|{i}|{left if i % 2 else right}"
            drawn = int(hashlib.sha256(said.encode()).hexdigest()[:15], 16)
            left, right = (left, (right + drawn) % b) if i % 2 else ((left + drawn) % a, right)
        return left, right

    pairs = spark.range(300).selectExpr("id", f"{pii.feistel('1000L', '77L', 'id % 1000', 'id % 77', chr(39) + 't' + chr(39), 'k')} AS p")
    assert all(tuple(r["p"]) == plain(1000, 77, r["id"] % 1000, r["id"] % 77, "t", "k") for r in pairs.collect())
    digits = spark.range(300).selectExpr("CAST(id * 7919 + 10000 AS STRING) AS v").selectExpr("v", f"{pii.luhn_digit('v')} AS c")
    assert all(luhn(r["v"] + r["c"]) and r["c"].isdigit() for r in digits.collect())
    ibans = spark.range(200).selectExpr("CAST(id * 104729 + 10000000000 AS STRING) AS v").selectExpr("v", f"{pii.iban_digits(chr(39) + 'GB' + chr(39), 'v')} AS c")
    assert all(int(r["v"] + "1611" + r["c"]) % 97 == 1 for r in ibans.collect())


def test_pseudonyms_of_a_long_text_and_without_a_key(spark):
    n = 40000
    old = " ".join(f"10.{i % 256}.{i // 256}.7, x" for i in range(n))
    one = spark.createDataFrame([(1, old), (1, old), (2, "10.3.0.7, x")], "doc_id long, text string")
    got = pii.pseudonymise(one, key="k").collect()
    new = got[0]["text"].split(", x")
    assert got[0] == got[1] and got[0]["n_replaced"] == n and len(set(new)) == n + 1
    assert got[2]["text"] == new[3].strip() + ", x"
    with pytest.raises(ValueError):
        pii.pseudonymise(one)


def test_callers_columns_keep_their_values(spark):
    names = ["doc_id", "text", "source", "class_key", "_first", "_n", "_node", "_blank", "_part", "_pii_cut", "node", "root", "doc", "k", "id", "n", "f", "d", "a.b"]
    data = [(i, text(i, 30), f"s{i % 2}", *[f"{c}{i}" for c in names[3:]]) for i in range(6)]
    docs = spark.createDataFrame(data, names)
    kept = minhash.deduplicated(docs)
    assert kept.columns == names and sorted(map(tuple, kept.collect())) == sorted(data)
    hidden = pii.pseudonymise(docs, key="k", found="found").drop("found")
    assert hidden.columns == names and sorted(map(tuple, hidden.collect())) == sorted(data)
    taken = mixing.mix(docs, out="o", shard="s", place="p", shards=2)
    assert taken.columns == [*names, "s", "p"]
    assert {(r["doc_id"], *r[2:-2]) for r in taken.collect()} <= {(d[0], *d[2:]) for d in data}


def test_whole_rows_are_kept_without_a_copy_of_their_texts(spark, monkeypatch):
    words = "one two three four five six seven eight nine ten"
    data = [(i, f"{words} {i} {i * 7} {i * 11} {i * 13} {i * 17} {i * 19} {i * 23} {i * 29} {i * 31}", f"s{i}") for i in range(30)]
    data += [(40, data[3][1], "copy"), (5, data[5][1], "s5"), (None, data[7][1], "no id"), (41, None, "null"), (42, "", "empty"), (43, None, "null")]
    seen = {}
    own = minhash.stored

    def stored(df, name):
        seen[name] = df.columns
        return own(df, name)

    monkeypatch.setattr(minhash, "stored", stored)
    kept = minhash.deduplicated(spark.createDataFrame(data, "doc_id long, text string, `a.b` string"))
    want = [(i, s) for i, _, s in data[:30]] + [(41, "null"), (42, "empty"), (43, "null")]
    assert sorted((r.doc_id, r["a.b"]) for r in kept.collect()) == want
    assert "text" not in seen["keyed"]
