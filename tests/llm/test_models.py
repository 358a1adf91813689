import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from pricemart.llm import decontam, host_rules, mix, ngram_join, pieces, quality, revisits, token_files, toxicity
from pricemart.llm.common import bounded_sample, table
from pricemart.llm.tokens import words

from .conftest import SF, documents, prose
from .test_text_operators import WORD, brute_classes, brute_hits, low

SF1 = "/root/testdata/sf0.01"
BPE = public_tokenizers.path("word_bpe_49k.json")


# ---- mixing

def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted((n for n in sizes if n is not None)) + [None] * (None in sizes)
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[n] for n in open_)
        full = {n for n in open_ if left * weight[n] / total >= most * sizes[n]}
        if not full:
            out.update({n: left * weight[n] / total for n in open_})
            break
        for n in full:
            out[n] = most * sizes[n]
        left -= sum(out[n] for n in full)
        open_ -= full
    return out


def mixture():
    rows = []
    for s, n in (("a", 300), ("b", 60), ("c", 40), ("Z", 25), (None, 30)):
        rows += [(len(rows) + i, prose(len(rows) + i, 1 + (i * 37) % 120), s) for i in range(n)]
    return rows + [(9000, None, "a"), (9001, "", None), (9002, " ", "d"), (9003, "x", "e")]


@pytest.mark.parametrize("rows_in_range", [mix.RANGE_ROWS, 7])
def test_mix(spark, monkeypatch, rows_in_range):
    """Targets against brute force; each source ends within half its largest document; ranges don't change anything."""
    monkeypatch.setattr(mix, "RANGE_ROWS", rows_in_range)
    rows = mixture()
    got = mix.report(documents(spark, rows).repartition(5)).collect()
    size = {d: len((t or "").split()) for d, t, _ in rows}
    source = {d: s for d, _, s in rows}
    sizes = Counter()
    for d in size:
        sizes[source[d]] += size[d]
    want = brute_targets(sizes)
    taken = Counter()
    for r in got:
        assert r.size == size[r.doc_id] and r.source_size == sizes[source[r.doc_id]]
        assert math.isclose(r.target, want[source[r.doc_id]], abs_tol=1e-6) and 0 <= r.taken <= 2 * r.size
        taken[source[r.doc_id]] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(size[d] for d in size if source[d] == s) / 2
    again = mix.report(documents(spark, rows[::-1]).repartition(2)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    # against the plain method: sort by key, take documents while their middle is below the rest
    keys = {r.doc_id: r.k for r in documents(spark, rows).select("doc_id", mix.exponential_key(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")), mix.sign_quality(F.col("text"))).alias("k")).collect()}
    for s in sizes:
        epochs = int(want[s] // sizes[s]) if sizes[s] else 0
        rest, before = want[s] - epochs * sizes[s], 0
        for d in sorted((d for d in size if source[d] == s), key=lambda d: (keys[d], str(d), size[d])):
            inside = rest > 0 and before + size[d] / 2 <= rest
            assert [r.taken for r in got if r.doc_id == d] == [size[d] * (epochs + inside)]
            before += size[d]


def test_sums_before_a_row_in_ranges(spark):
    """Skewed keys, ties and the null series against brute force, for one range and for many; many sources fill up as few do."""
    rows = [(("a", None, "c")[i % 3 if i % 7 else 0], (i % 50 / 50.0) ** 9, i, i % 11) for i in range(700)]
    df = spark.createDataFrame(rows, "s string, k double, i long, v long")
    for ranges in (1, 16):
        got = {r.i: r.before for r in mix._before(df, ["k", "i"], ranges, ["s"], before="v").collect()}
        assert got == {i: sum(w for t, l, j, w in rows if t == s and (l, j) < (k, i)) for s, k, i, _ in rows}
    sizes = {f"host{i}": 1 + i * i % 97 for i in range(200)} | {None: 40}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    want = brute_targets(sizes)
    assert all(math.isclose(r.target, want[r.source], rel_tol=1e-9) for r in mix.targets(frame, (3, 1, 2), 1.5, 2.0).collect())


def test_mix_repeats_rows_whole(spark):
    docs = documents(spark, mixture()).withColumnRenamed("lang", "epochs").withColumnRenamed("n_chars", "key")
    taken = {r.doc_id: r.taken for r in mix.report(docs).collect()}
    out = mix.mix(docs)
    assert out.columns == docs.columns
    count = Counter(r.doc_id for r in out.collect())
    texts = {d: t for d, t, _ in mixture()}
    assert all(r.text == texts[r.doc_id] for r in out.collect())
    assert all(count[d] * len(texts[d].split()) == n for d, n in taken.items() if n)


def test_better_documents_are_drawn_more_often(spark):
    rows = [(i, "word " * 10 + ("### " * 10 if i % 2 else "more " * 10), "a") for i in range(2000)]
    got = mix.report(documents(spark, rows), weights=(1,), share=0.5).collect()
    n = Counter(r.doc_id % 2 for r in got if r.taken)
    assert n[0] > 1.3 * n[1] and abs(n[0] + n[1] - 1000) <= 1


# ---- quality

def test_quality_on_held_out_labels(spark):
    docs, labels = table(spark, SF1, "documents"), table(spark, SF1, "labels")
    got = quality.report(docs, labels).join(labels, "doc_id").where("held_out and quality is not null").collect()
    low_, high = [r for r in got if r.quality == 0], [r for r in got if r.quality == 1]
    assert sum(r.predicted for r in high) >= 0.97 * len(high)
    assert sum(1 - r.predicted for r in low_) >= 0.5 * len(low_)
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    loss = -np.mean([math.log(max(1e-9, r.score if r.quality else 1 - r.score)) for r in got])
    assert loss < 0.3


def test_context_table_equals_loops(spark):
    texts = ["a b c a", None, "", "x !! y", "a"]
    got = quality.context_table(documents(spark, list(enumerate(texts))).select("text").repartition(3))
    dims, signs = quality._index()
    want = np.zeros((quality.BUCKETS, quality.DIM + 1))
    for t in texts:
        ids = [int(quality._tokens(pa.array([w]))[0][0]) for w in (t or "").split()]
        for i, x in enumerate(ids):
            want[x, quality.DIM] += 1
            for j in range(max(0, i - quality.REACH), min(len(ids), i + quality.REACH + 1)):
                if j != i:
                    for d, s in zip(dims[ids[j]], signs[ids[j]]):
                        want[x, d] += s
    assert (got == want).all()


def test_pooling_equals_loops():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(quality.BUCKETS, quality.DIM + 1)).astype(np.float32)
    vectors[:, -1] = np.abs(vectors[:, -1]) + 0.1
    texts = [prose(3, 50), "", None, "one"]
    got = quality.pooled(pa.array(texts), vectors)
    for x, t in zip(got, texts):
        ids = [int(quality._tokens(pa.array([w]))[0][0]) for w in (t or "").split()]
        v, w = vectors[ids, :-1].astype(float), vectors[ids, -1:].astype(float)
        if not ids:
            assert (x == 0).all()
            continue
        mean = (v * w).sum(0) / w.sum()
        assert np.allclose(x[:quality.DIM], mean, atol=1e-4)
        assert np.allclose(x[quality.DIM:2 * quality.DIM], np.sqrt(np.maximum((v * v * w).sum(0) / w.sum() - mean ** 2, 0)), atol=2e-3)


def test_scores_without_usable_labels(spark):
    docs, none = documents(spark, [(1, "a b"), (2, None)]), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    assert [r.score for r in quality.report(docs, none).collect()] == [0.5, 0.5]
    assert all(0.5 < r.score < 1 for r in quality.report(docs, one).collect())
    assert [r.score for r in toxicity.report(docs, none).collect()] == [0.5, 0.5]
    assert all(0 < r.score <= 0.5 for r in toxicity.report(docs, one).collect())


def test_sample_is_bounded_and_repeatable(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id")
    a, b = (sorted(r.doc_id for r in bounded_sample(x, 1000).collect()) for x in (rows, rows.repartition(7)))
    assert a == b and 850 < len(a) < 1150
    assert bounded_sample(rows, 20_000).count() == 20_000


# ---- toxicity

def test_a_repeated_document_is_learnt_once(spark, monkeypatch):
    docs, labels = table(spark, SF1, "documents").select("doc_id", "text"), table(spark, SF1, "labels")
    some = labels.orderBy("doc_id").limit(1).select("doc_id")
    hot = docs.join(some, "doc_id").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("n")
    other = hot.limit(200).withColumn("text", F.lit("another text of the same id"))
    seen = []
    monkeypatch.setattr(quality, "Network", lambda x, y: seen.append(x.shape))
    quality.fit(docs.unionByName(hot).unionByName(other), labels)
    quality.fit(docs, labels)
    assert seen[0] == seen[1] and seen[0][0] <= labels.count()
    once, often = toxicity.fit(docs, labels), toxicity.fit(docs.unionByName(hot), labels)
    assert all(np.array_equal(a, b) for a, b in zip(once, often))


def test_toxicity_on_held_out_labels(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    got = toxicity.report(docs, labels).join(labels, "doc_id").where("held_out and toxic is not null").collect()
    bad, fine = [r for r in got if r.toxic == 1], [r for r in got if r.toxic == 0]
    assert sum(r.predicted for r in bad) >= 0.6 * len(bad) and sum(r.predicted for r in fine) <= 0.01 * len(fine)
    auc = np.mean([np.mean([b.score > f.score for f in fine[::7]]) for b in bad])
    assert auc > 0.95


def test_toxic_score_equals_loops():
    text = "a b c a b"
    at = [toxicity.features(words(pa.array([g])))[1] for g in ("a", "b", "c")]
    model = np.array([int(at[0][0]), int(at[1][0]), toxicity.BIAS, toxicity.SLOPE, toxicity.SHIFT]), np.array([1.5, -0.5, -1.0, 2.0, 0.25])
    got = toxicity.score(words(pa.array([text, None, "c"])), model)     # present or not: repeats count once
    assert np.allclose(got, [toxicity.sigmoid(2 * (1.5 - 0.5 - 1) + 0.25), *[toxicity.sigmoid(-2 + 0.25)] * 2])


def test_ftrl_equals_the_formulas():
    rng = np.random.default_rng(3)
    data = [(np.unique(rng.integers(0, 30, 6)), int(rng.integers(0, 2))) for _ in range(40)]
    got = toxicity.train(data)
    z, n = Counter(), Counter()

    def weight(i):
        penalty = 0 if i == toxicity.BIAS else toxicity.L1
        return 0.0 if abs(z[i]) <= penalty else -(z[i] - math.copysign(penalty, z[i])) * toxicity.ALPHA / (toxicity.BETA + math.sqrt(n[i]))

    for _ in range(toxicity.EPOCHS):
        for cols, y in data:
            at = [*map(int, cols), toxicity.BIAS]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-max(-30, min(30, sum(w.values()))))) - y
            for i in at:
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / toxicity.ALPHA * w[i]
                n[i] += g * g
    assert np.allclose([got.z[i] for i in z], list(z.values())) and np.allclose([got.n[i] for i in n], list(n.values()))


# ---- host rules

def test_host_verdicts(spark):
    """A host that fails often is rejected as a whole; small hosts are held up by the prior; null is a host."""
    good, bad = prose(1, 60), "### " * 40 + prose(2, 30)
    rows = [(i, good, f"h{i % 10}") for i in range(200)] + [(1000 + i, bad if i % 10 else good, "junk") for i in range(50)]
    rows += [(2000, good, None), (2001, None, None), (2002, "", None), (2003, bad, "tiny")]
    got = {r.doc_id: r for r in host_rules.judge(documents(spark, rows), max_rate=0.6).collect()}
    assert all(got[i].kept for i in range(200)) and not any(got[1000 + i].kept for i in range(50)) and got[1000].host_failed and not got[1000].base_failed
    assert got[2000].kept and got[2001].base_failed and got[2001].n_words == 0
    hosts = {}
    for d, t, h in rows:
        own = hosts.setdefault(h, [0, 0])
        own[0] += 1
        ws = (t or "").split()
        own[1] += 100 * len(re.findall(r"[#*$%&|<>]", t or "")) > 10 * sum(map(len, ws))
    rates = [f / n for n, f in hosts.values()]
    m, v = np.mean(rates), np.var(rates)
    k = max(m * (1 - m) / v - 1, 0.01)
    shrunk = {h: (f + m * k) / (n + k) for h, (n, f) in hosts.items()}
    assert shrunk["junk"] > 0.6 and got[2003].host_failed == (shrunk["tiny"] > 0.6)


def test_repeated_words(spark):
    texts = ["a b c d e f g h " * 2, prose(9, 40) + " q " + prose(9, 40), "x " * 9, "x " * 8, prose(4, 500), None, "one"]
    got = [r.n_repeat_words for r in host_rules.report(documents(spark, list(enumerate(texts)))).orderBy("doc_id").collect()]
    want = []
    for t in texts:
        ws = (t or "").split()
        grams = [tuple(ws[i:i + 8]) for i in range(len(ws) - 7)]
        n = Counter(grams)
        want.append(len({j for i, g in enumerate(grams) if n[g] > 1 for j in range(i, i + 8)}))
    assert got == want


# ---- revisits

def _record(i, kind, uri, t, status, headers, digest):
    return (i, kind, uri, t, status, None if headers is None else [tuple(h) for h in headers], digest)


def test_revisits_equal_loops(spark):
    T = "2024-01-0%d %02d:%02d:00"
    tag = lambda v: [("ETag", v), ("Cache-Control", "a"), ("X", "1")]
    rows = [
        _record("r1", "response", "http://A.com:80/x?b=2&a=1#f", T % (1, 1, 0), 200, tag('"1"'), "d1"),
        _record("v1", "revisit", "https://www.a.com/x?a=1&b=2", T % (1, 1, 0), 304, tag('W/"1"'), None),       # the same instant: not earlier
        _record("v2", "revisit", "https://www.a.com/x?a=1&b=2", T % (1, 1, 1), 304, [("etag", 'W/"1"'), ("Expires", "e"), ("X", "2")], None),
        _record("r2", "response", "http://a.com/x?a=1&b=2", T % (2, 5, 0), 200, tag('"2"'), "d2"),
        _record("r3", "response", "http://a.com/x?a=1&b=2", T % (2, 6, 0), 404, tag('"9"'), "d9"),              # no full response
        _record("v3", "revisit", "http://a.com/x?a=1&b=2", T % (3, 0, 0), 304, tag('"1"'), None),
        _record("v4", "revisit", "http://a.com/x?a=1&b=2", T % (4, 0, 0), 304, None, "d2"),
        _record("v5", "revisit", "http://a.com/x?a=1&b=2", T % (4, 0, 0), 304, [], None),
        _record("v6", "revisit", None, T % (4, 0, 0), 304, [], None), _record("r4", "response", None, T % (1, 0, 0), 200, [], "d"),
        _record("v7", "revisit", "http://a.com/x?a=1&b=2", None, 304, tag('"2"'), None),
        _record("v8", "revisit", "http://a.com", T % (4, 0, 0), 304, [], None),
        _record("v4", "revisit", "http://a.com/x?a=1&b=2", T % (4, 0, 0), 304, None, "d2"),
    ]
    schema = ("record_id string, warc_type string, target_uri string, warc_date string, status int, "
              "headers array<struct<name:string,value:string>>, payload_digest string")
    df = spark.createDataFrame(rows, schema).withColumn("warc_date", F.to_timestamp("warc_date"))
    got = sorted((r.record_id, r.verdict, r.base_id, r.payload_digest) for r in revisits.resolve(df).collect())
    assert got == [("v1", "no_response", None, None), ("v2", "resolved", "r1", "d1"), ("v3", "mismatch", "r2", None), ("v4", "resolved", "r2", "d2"),
                   ("v4", "resolved", "r2", "d2"), ("v5", "unverified", "r2", None), ("v6", "no_response", None, None),
                   ("v7", "no_response", None, None), ("v8", "no_response", None, None)]
    merged = {r.record_id: [tuple(h) for h in r.headers] for r in revisits.resolve(df).collect()}
    assert merged["v2"] == [("Cache-Control", "a"), ("X", "1"), ("etag", 'W/"1"'), ("Expires", "e")]
    urls = {r.record_id: r.url for r in revisits.resolve(df).collect()}
    assert urls["v2"] == "a.com/x?a=1&b=2" and urls["v8"] == "a.com/"
    assert revisits.resolve(df.limit(0)).collect() == []


# ---- token files

def test_token_files_round_trip(spark, tmp_path, odd):
    """ids of every document against the tokenizer itself; sequences and masks; start and crc."""
    index = token_files.write(odd.repartition(3), f"file://{tmp_path}/out", BPE, 1, True, seq_len=64, rows=4)
    tok = Tokenizer.from_file(BPE)
    rows = index.collect()
    texts = Counter()
    for r in rows:
        ids = token_files.TokenFile(r.file).tokens(r.at, r.n_tokens)
        assert ids.dtype == np.uint16 and ids[-1] == 1
        texts[r.doc_id, tuple(ids[:-1].tolist())] += 1
    assert texts == Counter((r.doc_id, tuple(tok.encode(r.text or "", add_special_tokens=False).ids)) for r in odd.collect())
    for f in {r.file for r in rows}:
        file, n = token_files.TokenFile(f), sum(r.n_tokens for r in rows if r.file == f)
        seqs = [file.sequence(i) for i in range(-(-n // 64))]
        assert (np.concatenate([s for s, _ in seqs])[:n] == file.tokens(0, n)).all() and sum(m.sum() for _, m in seqs) == n
        with pa.ipc.open_stream(pa.memory_map(f.removeprefix("file://"))) as plain:     # any Arrow reader reads the files
            assert all(b.num_rows == 4 for b in plain)
    parts = [x.path for x in pafs.LocalFileSystem().get_file_info(pafs.FileSelector(f"{tmp_path}/out"))]
    assert len(parts) == len({r.file for r in rows})        # no unfinished files stay
    start = 0
    back = {(r.start): r for r in token_files.read_back(index).collect()}
    order = sorted(back)
    assert [back[s].doc_id for s in order] == sorted((r.doc_id for r in rows), key=lambda d: (d is not None, d))
    for s in order:
        assert s == start
        start += back[s].n_tokens


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_encode_like_whole_texts(spark, name):
    texts = [r.text for r in table(spark, SF, "documents").collect()]
    texts += ["a, b", "don't 'LL it's", "é, à. İ!", "x<|endoftext|>Y", "áb ç ...", "12,3 a1b2 'quote' “q”, z", " a\x85b", "tab\there,\n"]
    coder = token_files.Encoder(public_tokenizers.path(name), drops_space=name.startswith("word"))
    got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)]
    assert got == [e.ids for e in coder.tok.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_letters_that_compose_in_lower_case_only(name):
    texts = ["H\u0331adra", "T\u0308 x", "W\u030aX.", "Y\u030a, y", "GJ\u030cG! A", "H\u0331.  AB, \u0331H C"]
    coder = token_files.Encoder(public_tokenizers.path(name), drops_space=name.startswith("word"))
    got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)]
    assert got == [e.ids for e in coder.tok.encode_batch(texts, add_special_tokens=False)]


PARTS = ["a", "B", "é", "ß", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "\u2003", "\u2028", "'s", "'", "'LL", "12", "3", ".", "!?", "…", "—", "Σ", "H\u0331",
         "T\u0308", "≠", "İ", "日本", "\u0301", "<|endoftext|>", "<|", "|>", "\x00", "\x1c", "\x85", "×", "÷", "don't", "foo", "🙂", "👩\u200d👧", "\u200b",
         "\r\n", "º", "١٢", "A\u030a", "ŉ", "ﬁ", "가", "\u1100", "\u1161", "averyveryverylongwordofmorethanthirtybytes", "Привет"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_tables_of_pieces_give_the_tokenizers_ids(name):
    """Random texts of letters, signs, marks and white space of many kinds, many in one call, with a table that is full
    (and emptied) and without."""
    rng = random.Random(7)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(14))) or None for _ in range(4000)]
    for room in (pieces.TABLE_PIECES, 300):
        coder = pieces.PieceTable(public_tokenizers.path(name), name.startswith("word"), room)
        want = [e.ids for e in coder.tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]
        assert not coder.whole and coder.parts
        for i in range(0, len(texts), 500):
            ids, at = coder.encode(pa.array(texts[i:i + 500], pa.string()))
            assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want[i:i + 500]
    ids, at = pieces.with_end(*coder.encode(pa.array(["a b", None, "", "c"])), 1)
    assert (np.diff(at) >= 1).all() and ids[at[1:] - 1].tolist() == [1, 1, 1, 1] and at[0] == 0


# ---- pipeline

def test_pipeline_equals_brute_force(spark):
    """Each stage against a plain version over the same input; the last one against the tokenizer."""
    docs = table(spark, SF, "documents")
    labels, bench = table(spark, SF, "labels"), [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    rows = [tuple(r) for r in docs.collect()]
    # 1: one table of contexts over all texts at once, the same network
    ids, offsets = quality._tokens(pa.array([r[1] for r in rows]))
    vectors = quality.word_vectors(quality.contexts(ids, offsets).reshape(quality.BUCKETS, -1).astype(np.int64))
    known = {r.doc_id: r.quality for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5}
    x = quality.pooled(pa.array([r[1] for r in rows]), vectors)
    learn = [i for i in sorted(range(len(rows)), key=lambda i: rows[i][0]) if rows[i][0] in known]
    net = quality.Network(x[learn].astype(np.float64), np.array([known[rows[i][0]] for i in learn], np.float64))
    rows = [r for r, s in zip(rows, net.score(x)) if s >= 0.3]
    stage = corpus_pipeline.good(spark, docs, SF)
    assert sorted(tuple(r) for r in stage.collect()) == sorted(rows)
    # 2: the smallest id of each class
    classes = {d: c for d, c, _ in brute_classes([(r[0], r[1]) for r in rows])}
    stage = corpus_pipeline.distinct(spark, spark.createDataFrame(rows, docs.schema), SF)
    rows = [r for r in rows if classes[r[0]] == r[0]]
    assert sorted(tuple(r) for r in stage.collect()) == sorted(rows)
    # 3: no benchmark windows
    grams = {}
    for _, t in bench:
        ws = WORD.findall(low(t))
        for i in range(len(ws) - min(10, len(ws)) + 1 if ws else 0):
            grams.setdefault(min(10, len(ws)), set()).add(tuple(ws[i:i + 10]))

    def leaks(text):
        ws = WORD.findall(low(text))
        return any(tuple(ws[i:i + n]) in g for n, g in grams.items() for i in range(len(ws) - n + 1))

    stage = corpus_pipeline.clean(spark, spark.createDataFrame(rows, docs.schema), SF)
    rows = [r for r in rows if not leaks(r[1])]
    assert sorted(tuple(r) for r in stage.collect()) == sorted(rows) and brute_hits("", bench)[1] == 0
    # 4: copies by the mix's report (tested against brute force above)
    now = spark.createDataFrame(rows, docs.schema)
    copies = {r.doc_id: r.taken // r.size if r.size else None for r in mix.report(now).collect()}
    stage = corpus_pipeline.mixed(spark, now, SF)
    assert stage.columns == docs.columns
    got = Counter(tuple(r) for r in stage.collect())
    assert all(got[r] == copies[r[0]] for r in rows if copies[r[0]] is not None) and set(got) <= set(rows)
    # 5: ids of the mixed rows, in order; and the whole run
    tok, start, want = Tokenizer.from_file(BPE), 0, []
    for r in sorted(got.elements()):
        ids = np.array([*tok.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((r[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) == want


def test_stages_keep_clashing_columns(spark):
    names = ["score", "n_hit", "_row", "node"]
    docs = table(spark, SF, "documents").withColumns({n: F.lit("mine") for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert out.where("score = 'mine' and n_hit = 'mine' and _row = 'mine' and node = 'mine'").count() == out.count() > 0
    assert decontam.WINDOW == 10 and ngram_join.SHINGLE == 5
