"""Each operator against its plain form, with nulls, empty and long texts, ties, repeats and empty tables."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import ann, bpe, chat, components, kneser, merkle, mixing, quality, queries, rollup, simhash, sketch

from ..oracle import rows_of_spark, rows_of_sql
from . import brute

FORM = "doc_id long, text string, lang string, source string, n_chars long, h string, size string, score int, _id int, range int"


def documents(spark, rows):
    """[(doc_id, text, source)] with further columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "h", "s", 1, 2, 3) for i, t, s in rows], FORM)


def text(r, n, vocabulary=300):
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    out = [(i, text(r, r.choice([3, 20, 60, 200])), f"s{i % 4}") for i in range(80)]
    base = text(r, 300)
    for i in range(80, 110):  # near copies
        w = base.split()
        w[r.randrange(300)] = f"new{i}"
        out.append((i, " ".join(w), "s0"))
    out += [(i, base, None) for i in range(110, 115)]  # copies
    out += [(115, None, "s1"), (116, "", "s2"), (117, " \t\n", None), (118, "one", "Ä"), (119, "ONE", "Ä")]
    out += [(120, text(r, 30_000), "s3"), (None, "no id at all", "s3"), (None, base, "s3"), (121, "same row", "s1"), (121, "same row", "s1")]
    return out


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows_as_sql(spark, sf, name):
    assert rows_of_spark(queries.QUERIES[name](spark, sf)) == rows_of_sql(queries.ORACLE_SQL[name], sf)


def test_empty_tables(spark):
    d = documents(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    talk = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    results = [
        bpe.encoded(d), mixing.plan(d), mixing.mixed(d), sketch.fingerprinted(d), simhash.grouped(d), simhash.deduplicated(d),
        quality.classified(d, labels), kneser.scored(d, kneser.fit(d)), ann.search(vectors, vectors), chat.digests(chat.segments(talk)),
        chat.examples(chat.segments(talk)), chat.materialize(chat.segments(talk)), merkle.audit(merkle.leaves(pages), merkle.leaves(pages)),
    ]
    assert [x.count() for x in results] == [0] * len(results)


# 1


def test_search_ties_copies_and_unusable(spark):
    r = np.random.default_rng(1)
    x = r.standard_normal((300, 16)).astype(np.float32)
    x[100:180] = x[7]  # many copies of one vector
    vectors = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(900, None), (920, [0.0] * 16), (940, [float("nan")] * 16), (960, [float("inf")] + [0.0] * 15), (980, [None] * 16), (None, x[0].tolist()), (1000, [1.0] * 3)]
    df = spark.createDataFrame(vectors + bad, "vec_id long, embedding array<float>")
    got = {}
    for q, rank, v, s in ann.search(df, df.filter("vec_id % 20 = 0"), cover=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(q, []).append((rank, v, s))
    ids = np.arange(300)
    want = ann.exact(x.astype(float), ids, x[::20].astype(float), ids[::20])
    assert sorted(got) == list(range(0, 300, 20))
    for q, w in zip(range(0, 300, 20), want):
        assert [v for _, v, _ in got[q]] == [v for v, _ in w]
        assert np.allclose([s for _, _, s in got[q]], [s for _, s in w], atol=1e-12)
        assert [k for k, _, _ in got[q]] == list(range(1, 21))


def test_search_recall_and_few(spark, sf):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    pdf = df.toPandas()
    x, ids = np.array(pdf["embedding"].tolist(), float), pdf["vec_id"].to_numpy()
    asked = ids % 20 == 0
    got = ann.search(df, df.filter("vec_id % 20 = 0")).toPandas().groupby("query_id")["vec_id"].agg(set)
    want = ann.exact(x, ids, x[asked], ids[asked])
    assert np.mean([len(got[q] & {v for v, _ in w}) / 20 for q, w in zip(ids[asked], want)]) >= 0.95
    few = df.limit(3)
    assert ann.search(few, few).count() == 6


def _vectors(clusters, n, dims=48, seed=4):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, dims))
    if clusters:
        x = r.standard_normal((clusters, dims))[r.integers(0, clusters, n)] * 2 + x * 0.7
    return x / np.linalg.norm(x, axis=1, keepdims=True) * r.uniform(0.9, 1.1, (n, 1))


@pytest.mark.parametrize("clusters, recall, share, probed", [(0, 0.93, 0.5, 1.0), (150, 0.95, 0.05, 0.2)])
def test_scan_at_fifty_thousand(clusters, recall, share, probed):
    """Recall against brute force, and the pairs read to the end as a share of all."""
    n, k = 50_000, 20
    x = _vectors(clusters, n)
    centres = ann.fit_centres(x[:20_000], 224)
    probes = ann.enough_probes(x[:20_000], centres, k)
    assert probes <= probed * len(centres)
    lists = (x @ centres.T).argmax(1)
    order = np.argsort(lists, kind="stable")
    q = x[::250]
    near = q @ centres.T
    probe = np.zeros(near.shape, bool)
    np.put_along_axis(probe, np.argsort(-near, axis=1)[:, :probes], True, 1)
    read = []
    who, at, score = ann.scan(x[order], lists[order], order, q, probe, k, ann.rotation(x.shape[1]), nearest=near.argmax(1), read=read)
    want = np.argsort(-(q @ x.T), axis=1)[:, :k]
    assert np.mean([len(set(order[at[who == i]]) & set(w)) / k for i, w in enumerate(want)]) >= recall
    assert read[0] / (len(q) * n) <= share


@pytest.mark.parametrize("clusters", [0, 150])
def test_search_at_fifty_thousand(spark, clusters):
    """The whole operator, over many cells and both rounds."""
    n = 50_000
    x = _vectors(clusters, n)
    df = spark.createDataFrame([(i, v.tolist(), "extra") for i, v in enumerate(x)], "vec_id long, embedding array<double>, cells string")
    got = ann.search(df, df.filter("vec_id % 500 = 0")).toPandas()
    want = ann.exact(x, np.arange(n), x[::500], np.arange(0, n, 500))
    found = got.groupby("query_id")["vec_id"].agg(set)
    assert np.mean([len(found[q] & {v for v, _ in w}) / 20 for q, w in zip(range(0, n, 500), want)]) >= 0.93
    assert got.groupby("query_id")["rank"].agg(list).map(lambda r: sorted(r) == list(range(1, 21))).all()
    assert np.allclose(got["score"], (x[got["query_id"]] * x[got["vec_id"]]).sum(1), atol=1e-12)


def test_search_of_ids_with_two_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.1]), (3, [0.1, 1.0]), (3, [0.1, 1.0])], "vec_id long, embedding array<double>")
    got = {(q, v, round(s, 3)) for q, _, v, s in ann.search(df, df).collect()}
    assert {(1, 2, 1.0), (1, 2, 0.1), (1, 3, 1.0), (1, 3, 0.1), (2, 1, 1.0), (2, 3, 0.2), (3, 1, 1.0)} <= got
    assert all(q != v for q, v, _ in got)


def test_adaptive_scan_keeps_the_best():
    r = np.random.default_rng(2)
    x, q = r.standard_normal((6000, 64)), r.standard_normal((40, 64))
    lists = np.sort(r.integers(0, 15, 6000))
    probes = np.ones((40, 15), bool)
    who, at, score = ann.scan(x, lists, np.arange(6000), q, probes, 10, ann.rotation(64))
    assert np.allclose(score, (q[who] * x[at]).sum(1)) and (np.bincount(who) == 10).all()
    hits = [len(set(np.argsort(-(x @ v))[:10]) & set(at[who == i].tolist())) for i, v in enumerate(q)]
    assert np.mean(hits) >= 9.5
    # a bound that is given is kept: only what reaches it comes back
    top = np.sort(q @ x.T, axis=1)[:, -3]
    who, at, score = ann.scan(x, lists, np.arange(6000), q, probes, 10, ann.rotation(64), bound=top)
    assert (score >= top[who] - 1e-9).all() and len(who) >= 100


# 2


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(*bpe.default_vocabulary())


@pytest.fixture(scope="module")
def library(codec):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=bpe.default_vocabulary()[1], mergeable_ranks=codec.transducer.ranks, special_tokens={})


LONG = ["a" * 50_000, "ab" * 20_000, " " * 5000 + "x", "the " * 20_000, "中文字" * 3000, "aé🙂" * 900, "x" * 255, "y" * 257]


def test_bpe_equals_the_library(codec, library):
    r = random.Random(3)
    letters = " \n\t\x0b\x1c\x85\xa0　aabcdeeeinstrtho'sldmllvé1239!!##..🙂中文а́ßÜ"
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(80))) for _ in range(3000)] + LONG
    for at in range(0, len(texts), 700):
        for t, ids in zip(texts[at : at + 700], codec.encode_all(texts[at : at + 700])):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(t)
            assert "".join(codec.decode_stream(np.frombuffer(ids, "<u4").tolist())) == t
            assert codec.digests(ids)[1] == hashlib.sha256(t.encode()).hexdigest()


def test_bpe_gives_out_long_words_early(codec, library):
    """Tokens come while the word is read, from a window of bounded size."""
    for t in LONG[:2] + LONG[4:5]:
        parts = list(codec.transducer.stream(t.encode()))
        assert np.frombuffer(b"".join(parts), "<u4").tolist() == [i for w in codec.find(t) for i in library.encode_ordinary(w)]
        assert len(parts) >= len(t.encode()) // bpe.LOOK and len(parts[-1]) < 1024


def test_bpe_tables_may_start_anew(codec, library, monkeypatch):
    small = bpe.Transducer(codec.transducer.ranks, limit=20)
    for w in [b"hello", b"tokenization", b"overwhelmingly"] * 20:
        assert small.encode(w) == library.encode_ordinary(w.decode())
    monkeypatch.setattr(bpe, "PIECES_BYTES", 4000)
    c = bpe.Codec(*bpe.default_vocabulary())
    r = random.Random(7)
    for _ in range(30):
        t = " ".join(f"w{r.randrange(60)}-{r.choice('abc')}" for _ in range(50))
        assert np.frombuffer(c.encode(t), "<u4").tolist() == library.encode_ordinary(t)
    assert len(c.pieces) < 60


def test_utf8_stream():
    r = random.Random(4)
    for _ in range(500):
        data = bytes(r.choice([0x41, 0x80, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x99, 0x82, 0xED, 0xA0, 0xFF, 0xC0]) for _ in range(12))
        s = bpe.Utf8Stream()
        cut = r.randrange(12)
        assert s.feed(data[:cut]) + s.feed(data[cut:]) + s.close() == data.decode("utf-8", "replace")


def test_bpe_rows(spark, rows, library):
    rows = rows + [(130, t, "long") for t in LONG]
    got = bpe.encoded(documents(spark, rows))
    back = sorted((r["doc_id"] is None, r["doc_id"], r["text"]) for r in bpe.decoded(got).collect() if r["doc_id"] is not None)
    assert back == sorted((False, i, t or "") for i, t, _ in rows if i is not None)
    want = []
    for i, t, _ in rows:
        ids = np.array(library.encode_ordinary(t or ""), "<u4")
        want.append((str(i), len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got.collect()) == sorted(want)
    assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in got.collect())


# 3


def test_mix_equals_sharing_and_sorting(spark, rows):
    rows = [x for x in rows if x[0] != 121] + [(121, "same row", "s1")]
    got = {}
    for r in mixing.plan(documents(spark, rows)).collect():
        got.setdefault(r["source"], []).append((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]))
    for s, copies, once, size, target, own in brute.mix([(i, s, t) for i, t, s in rows]):
        want = [(i, n, size, target, n * (copies + ((i, h) in once))) for i, _, n, h in own]
        key = lambda x: (str(x[0]), x[1])
        assert [x[:3] + x[4:] for x in sorted(got[s], key=key)] == [x[:3] + x[4:] for x in sorted(want, key=key)]
        assert all(abs(a[3] - target) < 1e-6 for a in got[s])


def test_mix_repeats_rows(spark, rows):
    d = documents(spark, rows)
    plan = {(r["doc_id"], r["size"], r["source"]): r["times"] for r in mixing.plan(d).collect()}
    got = mixing.mixed(d)
    assert got.columns == d.columns
    counts = got.groupBy("doc_id", "text", "source").count().collect()
    repeats = {}
    for i, t, s in rows:
        repeats[i, t, s] = repeats.get((i, t, s), 0) + 1
    assert sum(r["count"] for r in counts) == sum(plan[i, len(brute.words(t)), s] * n for (i, t, s), n in repeats.items())
    assert all(r["count"] == plan[r["doc_id"], len(brute.words(r["text"])), r["source"]] * repeats[r["doc_id"], r["text"], r["source"]] for r in counts)


def test_mix_without_words(spark):
    got = mixing.plan(documents(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert all(r["taken"] == 0 and r["target"] == 0 for r in got) and len(got) == 2


# 4


def test_sketches_estimate_and_merge():
    r = random.Random(6)
    hash_words = sketch._hasher()
    a = text(r, 20_000, 10**6).split()
    b = a[:15_000] + text(r, 5_000, 10**6).split()
    sa, sb = (sketch.sketch(" ".join(x).encode(), hash_words) for x in (a, b))
    j, c = sketch.compare(sa, sb)
    assert abs(j - 0.6) < 0.1 and abs(c - 0.75) < 0.1
    part = sketch.sketch(" ".join(a[100:400]).encode(), hash_words)
    assert sketch.compare(part, sa)[1] > 0.9
    whole = " ".join(a[:500]).encode()
    halves = [sketch.sketch(" ".join(x).encode(), hash_words) for x in (a[:300], a[296:500])]
    assert (sketch.merge(*halves) == sketch.sketch(whole, hash_words)).all()
    assert (sketch.read(sketch.written(sa)) == sa).all()


def test_fingerprints_equal_plain_form(spark, rows):
    """Null, empty, short, long, repeated and near texts; rows without an id come first, in either order."""
    got = sorted(
        (str(r["doc_id"]), r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9))
        for r in sketch.fingerprinted(documents(spark, rows)).collect()
    )
    hexed = lambda s: "".join(f"{h:016x}" for h in sorted(s))

    def want(order):
        for (i, t, _), (_, after, _) in zip(order, order[1:] + order[:1]):
            t, after = t or "", after or ""
            edited = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
            own, other, following = (brute.sketch(x, sketch.FRACTION) for x in (t, edited, after))
            near = [round(brute.likeness(own, x, sketch.FRACTION), 9) for x in (other, following)]
            yield (str(i), len(t), hashlib.sha256(edited.encode()).hexdigest(), hexed(own), hexed(other), *near)

    none = [x for x in rows if x[0] is None]
    rest = sorted((x for x in rows if x[0] is not None), key=lambda x: x[0])
    assert got in [sorted(want(first + rest)) for first in (none, none[::-1])]


def test_fingerprints_tell_copies_and_others(spark):
    """The threshold rules: nearly every document keeps more than one hash, and copies, near copies and others come apart."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sketch.fingerprinted(d).collect()
    assert np.mean([len(r["fingerprint"]) > 16 for r in rows]) > 0.95
    text = dict(d.select("doc_id", "text").collect())
    error = [abs(r["near_edited"] - brute.likeness(*(brute.sketch(t, 1) for t in _edit(text, r["doc_id"])), 1)) for r in rows[:300]]
    assert np.mean(error) < 0.06


def _edit(text, i):
    after = text[min((j for j in text if j > i), default=min(text))] or ""
    t = text[i] or ""
    return t, t[: len(t) - len(t) // 4] + after[: len(t) // 4]


def test_fingerprints_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(sketch, "RANGE_ROWS", 3)
    ids = random.Random(8).sample(range(10_000), 40)
    order = sorted(ids)
    got = {r["doc_id"]: r["edited_sha256"] for r in sketch.fingerprinted(documents(spark, [(i, f"text {i} " * 9, "s") for i in ids] + [(None, "null", "s")])).collect()}
    for i, after in zip(order, [f"text {j} " * 9 for j in order[1:]] + ["null"]):
        t = f"text {i} " * 9
        assert got[i] == hashlib.sha256((t[: len(t) - len(t) // 4] + after[: len(t) // 4]).encode()).hexdigest()


# 5


def _token_totals(rows, text=lambda i, t: t):
    """By source, language and version: documents and tokens, as the library counts them."""
    out = {}
    for version in rollup.TOKENIZERS:
        e = rollup._encoding(version)
        for i, t, s in rows:
            n, k = out.get((s, "en", version), (0, 0))
            out[s, "en", version] = n + 1, k + len(e.encode_ordinary(text(i, t) or ""))
    return sorted((str(k), *v) for k, v in out.items())


def _read(totals):
    return sorted((str((x["source"], x["lang"], x["tokenizer"])), x["documents"], x["tokens"]) for x in totals.collect())


def test_rollup_is_idempotent(spark, rows, tmp_path):
    d = documents(spark, rows).withColumn("documents", F.lit("x")).withColumn("tokens", F.lit(7)).withColumn("tokenizer", F.lit("mine"))
    r = rollup.Rollup(spark, f"file://{tmp_path}/r")
    assert r.totals().count() == 0
    r.commit("none", rollup.inserts(rollup.token_counts(d.limit(0))))
    assert r.totals().count() == 0
    counts = rollup.token_counts(d)
    r.commit("a", rollup.inserts(counts))
    assert _read(r.totals()) == _token_totals(rows)
    r.commit("a", rollup.inserts(counts))
    assert _read(r.totals()) == _token_totals(rows)
    r.commit("b", rollup.deletes(rollup.token_counts(d.filter("source = 's0'"))))
    one = counts.filter("doc_id = 118")
    r.commit("c", rollup.revisions(one, one.withColumn("tokens", F.lit(None).cast("long"))))  # a null count is 0
    r.commit("d", rollup.revisions(one.withColumn("tokens", F.lit(0).cast("long")), one))
    left = _token_totals([x for x in rows if x[2] != "s0"])
    assert _read(r.totals()) == left
    for _ in range(2):
        r.compact("1")
        r.commit("b", rollup.inserts(counts))  # late repetition of a folded batch
        assert _read(r.totals()) == left and r.batches() == ["batch=compact-1"]
    r.commit("e", rollup.inserts(one))
    r.compact("2")
    r.commit("a", rollup.inserts(counts))
    assert r.batches() == ["batch=compact-2"]
    r.commit("f", rollup.deletes(one))
    assert _read(r.totals()) == left


@pytest.mark.parametrize("crash", ["write", "rename", "delete"])
def test_rollup_survives_a_crash(spark, rows, tmp_path, monkeypatch, crash):
    """Whatever step of a compaction fails, totals stay, and the next one ends the work."""
    r = rollup.Rollup(spark, f"file://{tmp_path}/r")
    counts = rollup.token_counts(documents(spark, rows))
    r.commit("a", rollup.inserts(counts))
    r.commit("b", rollup.deletes(counts.filter("source = 's1'")))
    left = _read(r.totals())
    real, fs_of = rollup.Rollup._placed, rollup.Rollup._fs

    class Fails:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            if name == crash:
                raise RuntimeError("lost")
            return getattr(self.fs, name)

    def placed(self, fs, at, sums, name, folds=None):
        if crash == "write":
            sums.write.parquet(f"{self.path}/_part-half/sums")
            raise RuntimeError("lost")
        real(self, fs, at, sums, name, folds)

    with monkeypatch.context() as m:
        m.setattr(rollup.Rollup, "_placed", placed)
        m.setattr(rollup.Rollup, "_fs", lambda self: (Fails(fs_of(self)[0]), fs_of(self)[1]))
        with pytest.raises(RuntimeError):
            r.compact("1")
    assert _read(r.totals()) == left
    r.compact("1")
    assert _read(r.totals()) == left and r.batches() == ["batch=compact-1"]


def test_rollup_query(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source", "lang").collect()
    want = {}
    for version in rollup.TOKENIZERS:
        e = rollup._encoding(version)
        for i, t, s, g in d:
            if i % 7 != 3:
                n, k = want.get((s, g, version), (0, 0))
                want[s, g, version] = n + 1, k + len(e.encode_ordinary(f"{t} {t}" if i % 7 == 5 else t))
    got = {(r["source"], r["lang"], r["tokenizer"]): (r["documents"], r["tokens"]) for r in queries.QUERIES["op5_token_rollup"](spark, sf).collect()}
    assert got == want


# 6


def test_quality_held_out(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit(d, labels)
    assert (model[0] == quality.fit(d, labels)[0]).all()
    got = quality.scored(d, model)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = got.collect()
    assert all(r["held_out"] == (brute.crc_mod(r["doc_id"], 5) == 0) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) >= 0.98
    kept = quality.scored(d, model, keep=True)
    assert kept.columns == d.columns and kept.count() == sum(r["predicted"] for r in rows)


def test_quality_odd_rows(spark, rows):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 0), (3, 0, 1), (999, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.classified(documents(spark, rows), labels)
    assert got.count() == len(rows) and got.filter("score IS NULL").count() == 0
    none = quality.classified(documents(spark, rows), labels.limit(0))
    assert {r["score"] for r in none.collect()} == {0.5}


def test_quality_scores_equal_plain_form(spark, rows):
    """A score is the logistic of the mean weight of all feature occurrences, and the bias."""
    weights = np.random.default_rng(3).standard_normal(quality.BUCKETS).astype(np.float32) * 20
    rows = rows + [(140, "a a a b a a b b c a c", "s"), (141, "x", "s"), (142, "x x", "s")]
    got = sorted((str(r["doc_id"]), round(r["score"], 9)) for r in quality.scored(documents(spark, rows), (weights, 0.25)).collect())
    want = []
    for i, t, _ in rows:
        f = brute.features(t, quality.BUCKETS)
        want.append((str(i), round(1 / (1 + np.exp(-(0.25 + (weights[f].astype(float).mean() if f else 0)))), 9)))
        ids, n = quality.counts((t or "").encode())
        assert sorted(f) == np.repeat(ids, n).tolist()
    assert got == sorted(want)
    kept = quality.scored(documents(spark, rows), (weights, 0.25), keep=True).collect()
    assert sorted((str(r["doc_id"]), r["size"], r["range"]) for r in kept) == sorted((i, "s", 3) for i, x in want if x >= quality.THRESHOLD)


# 7


def test_simhash_components(spark, rows):
    got = simhash.grouped(documents(spark, rows)).collect()
    fps = [brute.simhash(t) for _, t, _ in rows]
    want = sorted(zip([str(i) for i, _, _ in rows], fps, map(str, brute.components(fps, [i for i, _, _ in rows]))))
    assert sorted((str(r["doc_id"]), r["fp"] % 2**64, str(r["component_id"])) for r in got) == want


@pytest.mark.parametrize("cell", [4, 8192])
def test_simhash_links_lose_none(spark, monkeypatch, cell):
    """Dense clusters, which fill cells of few rows, still come out whole."""
    monkeypatch.setattr(simhash, "CELL", cell)
    r = random.Random(9)
    fps = set()
    for _ in range(8):
        c = r.getrandbits(64)
        fps |= {c ^ sum(1 << b for b in r.sample(range(64), r.randrange(5))) for _ in range(20)}
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.array(f, np.uint64).view(np.int64)),) for f in fps], "fp long")
    root = {x["node"] % 2**64: x["root"] % 2**64 for x in components.components(simhash.links(df)).collect()}
    want = brute.components(fps, list(range(len(fps))))
    groups, mine = {}, {}
    for f, w in zip(fps, want):
        groups.setdefault(w, set()).add(f)
        mine.setdefault(root.get(f, f), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_deduplicated_keeps_one_of_each(spark, rows):
    rows = [*rows, (118, rows[60][1], "s1")]  # an id with two texts
    d = documents(spark, rows)
    got = simhash.deduplicated(d)
    assert got.columns == d.columns
    fps = [brute.simhash(t) for _, t, _ in rows]
    groups = {}
    for (i, t, _), c, f in zip(rows, brute.components(fps, [i for i, _, _ in rows]), fps):
        groups.setdefault(c if c is not None else ("none", f), []).append((i, t))
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert len(kept) == len(groups)
    assert sorted(str(i) for i, _ in kept) == sorted(str(k if not isinstance(k, tuple) else None) for k in groups)


def test_components_of_long_chains(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1000), (500, 501)], "a long, b long")
    assert {(r["node"], r["root"]) for r in components.components(df).collect()} == {(i, 0) for i in range(201)} | {(500, 500), (501, 500)}


# 8


PAGES = "page_id long, url string, html string, file string, offset int, length int, digest string, record string"


def _pages(spark, rows):
    """Pages with further columns whose names the operator uses inside."""
    return spark.createDataFrame([(*r, "f", 1, 2, "d", "r") for r in rows], PAGES)


@pytest.fixture(scope="module")
def archived():
    out = [(i, f"http://x/{i}", f"<p>{i}</p>" * (i % 30)) for i in range(1500)]
    return out + [(None, None, None), (None, "a", "b"), (None, "a", "b"), (7, "twice", "x"), (7, "twice", "x"), (-3, "ä", "é🙂" * 40_000), (600, "same", "")]


def _differences(spark, ours, theirs):
    got = merkle.audit(merkle.leaves(_pages(spark, ours)), merkle.leaves(_pages(spark, theirs))).collect()
    assert all((r["offset"] is None) == (r["state"] == "extra") and (r["replica_offset"] is None) == (r["state"] == "missing") for r in got)
    return sorted((r["page_id"] is None, r["page_id"], r["state"]) for r in got)


def test_audit_finds_damage(spark, archived):
    assert _differences(spark, archived, archived[::-1]) == []
    assert _differences(spark, archived, [x for x in archived if x[0] != 3]) == [(False, 3, "missing")]  # all behind it have moved
    theirs = [x for x in archived if x[0] != 900 and x[1] != "same"]
    theirs = [(i, u, {29: "gone", 1400: "longer " * 9000}.get(i, h)) for i, u, h in theirs] + [(5000, "new", "x"), (7, "twice", "x"), (1100, "beside", "y")]
    theirs.remove((None, "a", "b"))
    want = [(7, "extra"), (29, "changed"), (600, "missing"), (900, "missing"), (1100, "extra"), (1400, "changed"), (5000, "extra")]
    assert _differences(spark, archived, theirs) == [(False, *w) for w in want] + [(True, None, "missing")]
    back = {"extra": "missing", "missing": "extra", "changed": "changed"}
    assert _differences(spark, theirs, archived) == [(False, i, back[s]) for i, s in want] + [(True, None, "extra")]
    assert _differences(spark, archived[:2], []) == [(False, 0, "missing"), (False, 1, "missing")]


def test_archives_are_read_as_laid_out(spark, archived, tmp_path):
    pages = _pages(spark, archived)
    folder = f"{tmp_path}/warc"
    for _ in range(2):  # a repeated job leaves the same files
        written = merkle.write_archive(pages, f"file://{folder}").collect()
    assert sum(r["records"] for r in written) == len(archived)
    key = lambda r: [str(x) for x in r]
    want = sorted(map(tuple, merkle.leaves(pages).collect()), key=key)
    assert sorted(map(tuple, merkle.read_archive(spark, f"file://{folder}").collect()), key=key) == want
    flipped = next(r for r in want if r[3] == 1234)
    with open(f"{folder}/{flipped[0]}.warc", "r+b") as f:
        f.seek(flipped[1] + flipped[2] - 6)
        f.write(b"!")
    got = merkle.audit(merkle.leaves(pages), merkle.read_archive(spark, folder)).collect()
    assert [(r["page_id"], r["state"], r["offset"]) for r in got] == [(1234, "changed", flipped[1])]
    with open(f"{folder}/-9.warc", "wb") as f:
        f.write(b"no record at all")
    got = merkle.audit(merkle.leaves(pages), merkle.read_archive(spark, folder)).collect()
    assert sorted((str(r["page_id"]), r["file"], r["state"]) for r in got) == [("1234", 2, "changed"), ("None", -9, "extra")]


# 9

TALK = [
    (1, 0, "system", "be brief"), (1, 1, "user", "a<|im_end|>b"), (1, 2, "assistant", "<\\|x"), (1, 3, "user", "<\\\\| %25"), (1, 4, "assistant", ""),
    (2, 0, "assistant", "first"), (2, 1, "user", None), (3, 0, "user", "alone"), (4, 2, "assistant", "b"), (4, 2, "assistant", "a"), (4, None, "user", "n"),
    (None, 0, None, "x"), (5, 1, "ro%le\n<|", "<|im_start|>assistant ok"), (6, 0, "assistant", "dup"), (6, 0, "assistant", "dup"), (7, 5000, "assistant", "é🙂" * 2000),
]


def _talks(talk):
    out = {}
    for c, t, r, x in talk:
        out.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    return {c: sorted(v) for c, v in out.items()}


LONG_TALK = [(8, i, "assistant" if i % 3 else "user", None if i % 7 == 0 else f"turn {i} <|im_end|>" * (i % 5)) for i in range(3000)]


@pytest.mark.parametrize("limit", [1 << 25, 60, 0])
def test_chat_reads_back(spark, monkeypatch, limit):
    """From expanded texts, from the positional form, and from either by length."""
    monkeypatch.setattr(chat, "EXPANDED", limit)
    talk = TALK + LONG_TALK * (limit == 60)
    df = spark.createDataFrame([(*r, 1, "x") for r in talk], "conv_id long, turn long, role string, text string, segment int, s string")
    got = {r["conv_id"]: r for r in chat.digests(chat.segments(df)).collect()}
    talks = _talks(talk)
    assert set(got) == set(talks)
    for c, turns in talks.items():
        all_ = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        formatted = sum(len(chat.START + r.replace("%", "%25").replace("\n", "%0A") + "\n" + x + chat.END + "\n") for _, _, r, x in turns)
        escaped = sum(len(re.findall(r"<\\*\|", s)) for _, _, r, x in turns for s in (r, x))
        r = got[c]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), hashlib.sha256(all_.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r["formatted_chars"] == formatted + escaped


def test_chat_examples(spark):
    df = spark.createDataFrame(TALK, "conv_id long, turn long, role string, text string")
    segs = chat.segments(df)
    full = sorted((str(r["conv_id"]), r["text"], r["loss_start"], r["loss_end"]) for r in chat.materialize(segs).collect())
    assert len(full) == sum(r == "assistant" for _, _, r, _ in TALK)
    rendered = lambda r, x: chat.START + re.sub(r"<(\\*)\|", r"<\\\1|", r.replace("%", "%25").replace("\n", "%0A")) + "\n" + re.sub(r"<(\\*)\|", r"<\\\1|", x) + chat.END + "\n"
    want = []
    for c, turns in _talks(TALK).items():
        for i, (_, _, r, x) in enumerate(turns):
            if r == "assistant":
                own = "".join(rendered(r, x) for _, _, r, x in turns[: i + 1])
                end = len(own) - len(chat.END) - 1
                want.append((str(c), own, end - len(rendered("", x)) + len(chat.START + chat.END) + 2, end))
    assert full == sorted(want)
    by_block = sorted((str(r["conv_id"]), r["context_chars"], r["context_turns"], r["loss_start"], r["loss_end"]) for r in chat.examples(segs, block=2).collect())
    assert sorted((c, a, b) for c, _, a, b in full) == sorted((c, a, b) for c, _, _, a, b in by_block)
    assert all(a > n for _, n, _, a, _ in by_block)


# 10


def test_language_model_equals_plain_form(spark, rows, monkeypatch):
    rows = rows[:60] + rows[110:]
    d = documents(spark, rows)
    train = [t for i, t, _ in rows if brute.crc_mod(i, 10)]
    want = brute.kneser(train, [t for _, t, _ in rows])
    for tokens in (2_000_000, 500):  # one shard, and many, with frequent contexts spread
        monkeypatch.setattr(kneser, "SHARD_TOKENS", tokens)
        got = kneser.scored(d, kneser.fit(d)).collect()
        assert len(got) == len(rows)
        pairs = sorted((str(r["doc_id"]), r["n_tokens"], round(r["score"], 6)) for r in got)
        assert pairs == sorted((str(i), len(brute.words(t)) + 1, round(w, 6)) for (i, t, _), w in zip(rows, want))
        assert {r["train_tokens"] for r in got} == {sum(len(brute.words(t)) + 1 for t in train)}
        base = [(str(i), n, round(b, 6)) for (i, _, _), (n, b) in zip(rows, brute.base_scores(train, [t for _, t, _ in rows]))]
        assert sorted((str(r["doc_id"]), r["n_known"], round(r["base_score"], 6)) for r in got) == sorted(base)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_language_model_without_training(spark):
    rows = [(i, t, "s") for i, t in zip([i for i in range(200) if brute.crc_mod(i, 10) == 0], ["a b", None, "", "c " * 500])]
    got = kneser.scored(documents(spark, rows), kneser.fit(documents(spark, rows))).collect()
    assert len(got) == 4
    for r in got:
        assert (r["held_out"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (True, 0, 0, 0, 0)


def test_counts_beyond_32_bits():
    for a in ([1, 2, 3], [1 << 32, 5, (1 << 40) + 7], []):
        assert kneser._unpack_counts(kneser._pack_counts(np.array(a, np.int64))).tolist() == a
    assert kneser._small(np.array([[1 << 33]])).tolist() == [[1 << 33]] and kneser._small(np.array([7])).dtype == np.uint32
    key, n = kneser._merged([np.array([5], np.uint64)] * 2, [np.array([(1 << 32) - 1], np.uint32)] * 2)
    assert (key.tolist(), n.tolist()) == ([5], [2 * ((1 << 32) - 1)])
    with pytest.raises(OverflowError):
        kneser.Counts("nowhere", 1, [1 << 31, 1 << 31], [1 << 31, 1 << 31])


def test_arrays_are_closed(tmp_path):
    held = kneser.arrays.Open(3, 1 << 20)
    for i in range(10):
        kneser.arrays.save(f"{tmp_path}/{i}.npy", np.arange(i + 1))
        assert held.get(f"{tmp_path}/{i}.npy").tolist() == list(range(i + 1)) and len(held.held) <= 3


def test_language_model_sums_to_one(spark):
    d = documents(spark, [(i, "a b c a b d", "s") for i in range(1, 5)] + [(8, "b b", "s")])
    m = kneser.fit(d)
    words = [b"a", b"b", b"c", b"d", kneser._END, b"unseen"]
    ids = np.array([*m.counts.ids(words[:-1]), m.counts.unknown])
    for context in (*ids[:4], m.counts.bos):
        order = np.sort(ids)
        _, low = m.unigrams(order)
        key = np.uint64(context) << np.uint64(32) | order.astype(np.uint64)
        n = m.bigram_counts(key)
        total, n1, n2, n3 = m._dense("context", np.array([context]), 4)[:, 0]
        p = np.maximum(n - m.d2[np.minimum(n, 3)], 0) / total + (m.d2[1:] @ [n1, n2, n3]) / total * low
        assert abs(p.sum() - 1) < 1e-9
