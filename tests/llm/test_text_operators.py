import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricemart.llm import decontam, line_dedup, ngram_join, suffix_dedup, tokens
from pricemart.llm.graph import components

from .conftest import documents, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# ---- tokens

def test_words_are_the_regular_expressions():
    texts = ["Ab cd-EF é1  x", None, "", "--", "日本 语 x\x7fy", "a" * 70 + " b", "A" * 5000 + " tail"]
    for classes, rule, fold in ((tokens.ALNUM, WORD, low), (tokens.NON_SPACE, re.compile(r"[^\x20\x09-\x0D]+"), lambda t: t or "")):
        w = tokens.words(pa.array(texts), classes, tokens.LOWER if fold is low else tokens.SAME)
        for i, t in enumerate(texts):
            own = range(w.offsets[i], w.offsets[i + 1])
            assert [tokens.token_bytes(w, j, tokens.LOWER if fold is low else tokens.SAME).decode() for j in own] == rule.findall(fold(t))


def test_equal_words_equal_hashes_wherever_they_stand(monkeypatch):
    text = prose(5, 3000, 50)
    w = tokens.words(pa.array(["x", text, "y"]))
    by = {}
    for i in range(len(w.hashes)):
        by.setdefault(tokens.token_bytes(w, i), set()).add(int(w.hashes[i]))
    assert all(len(v) == 1 for v in by.values()) and len({h for v in by.values() for h in v}) == len(by)
    monkeypatch.setattr(tokens, "SEGMENT", 1000)            # long texts are hashed piece by piece
    assert (tokens.words(pa.array(["x", text, "y"])).hashes == w.hashes).all()


# ---- decontamination

BENCH = [(1, "The quick brown fox jumps over the lazy dog and runs away"), (2, "short item"), (3, None), (4, ""), (1, "Second text, same id: short ITEM")]
LEAKY = [(1, "x " * 5 + "THE quick, brown fox jumps over the lazy dog and runs off"), (2, "a short item, a short item"), (3, "the quick brown fox"),
         (4, None), (5, "short\n\nitem"), (5, "shortitem")]


def brute_hits(text, bench):
    ws = WORD.findall(low(text))
    hit, items = set(), set()
    for item, t in bench:
        iw = WORD.findall(low(t))
        n = min(10, len(iw))
        for i in range(len(iw) - n + 1 if n else 0):
            for j in range(len(ws) - n + 1):
                if ws[j:j + n] == iw[i:i + n]:
                    hit.update(range(j, j + n))
                    items.add(str(item))
    ids = sorted(items)
    return len(ws), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("bound,most", [(decontam.BROADCAST_BYTES, decontam.MAX_HASHES), (0, decontam.MAX_HASHES), (0, 2)])
def test_decontamination_equals_brute_force(spark, bound, most):
    """Also with the shuffle join, and with the hashes in several slices."""
    docs, bench = documents(spark, LEAKY), spark.createDataFrame(BENCH, "item_id long, text string")
    got = decontam.report(docs, bench, broadcast_bytes=bound, max_hashes=most).collect()
    assert sorted(tuple(r) for r in got) == sorted((d, *brute_hits(t, BENCH)) for d, t in LEAKY)


def test_a_set_too_big_to_broadcast_is_not_built(spark, monkeypatch):
    """Half a megabyte of text, but 100,000 windows: joined, with the same hits."""
    monkeypatch.setattr(decontam, "Grams", None)
    long = " ".join(f"w{i % 977}x{i % 101}" for i in range(100_009))
    bench = spark.createDataFrame([(1, long), (2, "short item")], "item_id long, text string")
    docs = documents(spark, [(1, "so " + " ".join(long.split()[500:512]) + " off"), (2, "a short item"), (3, "nothing"), (4, None)])
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontam.report(docs, bench).collect()}
    assert got == {1: (14, 12, 1), 2: (3, 2, 1), 3: (1, 0, 0), 4: (0, 0, 0)}


def test_decontamination_removes_documents_or_spans(spark):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    docs = documents(spark, LEAKY).withColumnRenamed("lang", "n_hit")           # a clashing name
    kept = decontam.decontaminate(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5]
    cut = {(r.doc_id, r.text) for r in decontam.decontaminate(docs, bench, remove="span").collect()}
    assert (2, "a , a ") in cut and (3, "the quick brown fox") in cut and (4, None) in cut and (5, "") in cut and (1, "x " * 5 + " off") in cut


def test_names_that_clash(spark):
    """Columns with the names of new or inner ones: new columns step aside, old ones keep their values."""
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    docs = documents(spark, LEAKY).withColumnsRenamed({"lang": "n_words", "source": "ids", "n_chars": "spans"})
    for bound in (decontam.BROADCAST_BYTES, 0):
        got = decontam.scan(docs, bench, broadcast_bytes=bound)
        assert got.columns == [*docs.columns, "_n_words", "n_hit", "items", "clean_text"]
        assert {(r.n_words, r.ids) for r in got.collect()} == {("en", "s")} and {r._n_words for r in got.collect()} >= {0, 4}
    lines = documents(spark, LINES).withColumnsRenamed({"lang": "n_lines", "source": "kept_text"})
    for bound in (line_dedup.BROADCAST_BYTES, 0):
        got = line_dedup.drop_lines(lines, 3, broadcast_bytes=bound)
        assert got.columns == [*lines.columns, "_n_lines", "n_dropped", "_kept_text"] and {r.n_lines for r in got.collect()} == {"en"}
    rows = documents(spark, [(i, prose(77, 80) + f" own {i}") for i in range(3)]).withColumnsRenamed({"lang": "_d", "source": "_t"})
    got = suffix_dedup.remove_repeats(rows)
    assert got.columns == rows.columns and sorted(len(r.text.split()) for r in got.collect()) == [1, 1, 82]


# ---- lines

LINES = [(i, f"Shared LINE \n own {i}\n\n  shared line") for i in range(6)] + [(6, None), (7, ""), (8, "own 1"), (8, "own 1"), (9, "É\né")]


def brute_lines(rows, at_least):
    key = lambda x: low(x.strip(" \t\n\x0b\x0c\r"))
    count = {}
    for _, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            count[k] = count.get(k, 0) + 1
    out = []
    for d, t in rows:
        ls = (t or "").split("\n")
        keep = [x for x in ls if not (key(x) and count[key(x)] >= at_least)]
        out.append((d, len(ls), len(ls) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("more", [{}, {"broadcast_bytes": 0}, {"log2_bits": 6}])
@pytest.mark.parametrize("at_least", [2, 3, 6])
def test_lines_equal_brute_force(spark, at_least, more):
    """Also with the shuffle join, and with filters so small that every key is suspected."""
    got = line_dedup.report(documents(spark, LINES).repartition(4), at_least, **more).collect()
    assert sorted(tuple(r) for r in got) == brute_lines(LINES, at_least)


@pytest.mark.parametrize("bound", [line_dedup.BROADCAST_BYTES, 0])
def test_first_occurrence_can_stay(spark, bound):
    docs = documents(spark, LINES).withColumnRenamed("n_chars", "place")
    got = line_dedup.drop_lines(docs, 3, keep="first", broadcast_bytes=bound)
    texts = {r.doc_id: r.kept_text for r in got.collect()}
    assert texts[0] == "Shared LINE \n own 0\n" and texts[1] == " own 1\n" and texts[2] == " own 2\n" and texts[6] is None
    assert got.columns == [*docs.columns, "n_lines", "n_dropped", "kept_text"]


def test_filter_finds_every_repeat(spark):
    texts = documents(spark, [(i, f"a{i % 40}\nb{i}") for i in range(80)]).select("text").repartition(7)
    bits = line_dedup.suspects(texts, log2_bits=16)
    sure = line_dedup._has(bits, line_dedup._probes(line_dedup._hashes([f"a{i}".encode() for i in range(40)]), 16))
    once = line_dedup._has(bits, line_dedup._probes(line_dedup._hashes([f"b{i}".encode() for i in range(80)]), 16))
    assert sure.all() and once.mean() < 0.2


# ---- n-gram join

def brute_sets(text):
    ws = WORD.findall(low(text))
    return {tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def brute_classes(rows, threshold=0.8):
    sets = [brute_sets(t) for _, t in rows]
    near = {(i, j) for i in range(len(rows)) for j in range(len(rows)) if i != j and sets[i] and sets[j]
            and len(sets[i] & sets[j]) * 10 >= 8 * len(sets[i] | sets[j])}
    root = list(range(len(rows)))
    for _ in rows:
        for i, j in near:
            root[i] = root[j] = min(root[i], root[j])
    lowest = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            lowest[root[i]] = min(lowest.get(root[i], d), d)
    return sorted(((d, lowest.get(root[i]), sum(a == i for a, _ in near)) for i, (d, _) in enumerate(rows)), key=str)


def copies(seed, n, edits):
    """n near copies of a text, each with its own words at ``edits`` places."""
    base = prose(seed, 150).split()
    out = []
    for i in range(n):
        ws = list(base)
        for e in range(edits):
            ws[(i * 37 + e * 61) % len(ws)] = f"e{i}x{e}"
        out.append(" ".join(ws))
    return out


NEAR = [*((100 + i, t) for i, t in enumerate(copies(11, 12, 1))), *((200 + i, t) for i, t in enumerate(copies(12, 8, 2))),
        *((300 + i, prose(50 + i, 80)) for i in range(6)), (400, "one two"), (401, "One, two!"), (402, "one two three"), (403, None), (404, ""),
        (405, "..."), (100, copies(11, 1, 1)[0]), (None, prose(50, 80))]


@pytest.mark.parametrize("block,block_bytes", [(ngram_join.BLOCK, ngram_join.BLOCK_BYTES), (4, ngram_join.BLOCK_BYTES), (1, ngram_join.BLOCK_BYTES),
                                               (ngram_join.BLOCK, 1), (ngram_join.BLOCK, 1500)])
def test_join_equals_brute_force(spark, block, block_bytes):
    """Also with components cut into blocks."""
    got = ngram_join.classify(documents(spark, NEAR).repartition(3), block=block, block_bytes=block_bytes).select("doc_id", "class_id", "n_links").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_classes(NEAR)


def test_groups_hold_each_text_once_and_bounded_bytes(spark):
    slim = documents(spark, [(i, f"{i:03}" + "y" * 997) for i in range(60)] + [(7, "007" + "y" * 997)] * 500).select(
        "doc_id", "text", F.xxhash64("text").alias("text_hash"))
    found = slim.distinct().select(F.lit(1).cast("long").alias("root"), F.col("doc_id").alias("node"), F.lit(1).cast("long").alias("copies"),
                                   F.struct("doc_id", "text_hash", F.octet_length("text").alias("bytes")).alias("place"))
    rows = [(r.i, r.j, r.node, len(r.text)) for r in ngram_join.groups(found, slim, 512, 6000).collect()]
    assert len(rows) == len({r[:3] for r in rows}) == 60 * 10          # ten blocks
    size = Counter()
    for i, j, _, n in rows:
        size[i, j] += n
    assert max(size.values()) <= 30_000
    met = {frozenset((a[2], b[2])) for a in rows for b in rows if a[:2] == b[:2] and a[2] < b[2]}
    assert len(met) == 60 * 59 // 2                                     # every pair meets


def test_pairs_of_long_near_copies_have_one_link_each(spark):
    """Two texts above the byte bound are two blocks; both may fall on one side."""
    rows = []
    for i in range(6):
        base = prose(900 + i, 3000)
        rows += [(2 * i, base), (2 * i + 1, base + " tail")]
    got = ngram_join.classify(documents(spark, rows), block_bytes=4000).select("doc_id", "class_id", "n_links").collect()
    assert sorted(tuple(r) for r in got) == [(d, d // 2 * 2, 1) for d in range(12)]


def test_one_document_of_each_class_stays(spark):
    docs = documents(spark, NEAR).withColumnRenamed("lang", "class")
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(100, NEAR[0][1]), (200, NEAR[12][1]), (None, prose(50, 80)), *((300 + i, prose(50 + i, 80)) for i in range(1, 6)), (400, "one two"),
         (402, "one two three"), (403, None), (404, ""), (405, "...")], key=str)


def test_bands_reach_the_recall():
    for t, recall, most in ((0.8, 0.9999, 128), (0.7, 0.99, 128), (0.9, 0.999, 200)):
        rows, bands = ngram_join.banding(t, recall, most)
        assert rows * bands <= most and 1 - (1 - t ** rows) ** bands >= recall


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (103, 102), (7, 7)] + [(200, 200 + i) for i in range(1, 30)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 104)}, **{200 + i: 200 for i in range(30)}}


# ---- repeated passages

def brute_passages(rows, length=50):
    seen = {}
    for d, t in rows:
        ws = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        for i in range(len(ws) - length + 1):
            seen.setdefault(tuple(ws[i:i + length]), []).append((d, i))
    out = {}
    for places in seen.values():
        if len(places) > 1:
            for k, (d, i) in enumerate(sorted(places)):
                words, later = out.setdefault(d, (set(), set()))
                words.update(range(i, i + length))
                if k:
                    later.update(range(i, i + length))
    return {d: (len(a), len(b)) for d, (a, b) in out.items()}


SHARED = [prose(21, 60), prose(22, 50), prose(23, 49), prose(24, 200)]
PASSAGES = [(i, " ".join([prose(600 + i, 30 + i), SHARED[i % 4], prose(700 + i, 20), SHARED[(i + 1) % 4], prose(800 + i, 7)])) for i in range(12)]
PASSAGES += [(50, "same " * 130), (51, SHARED[3]), (52, SHARED[1] + "\n\n" + SHARED[1]), (53, None), (54, ""), (55, prose(25, 400)), (56, SHARED[3][5:])]


@pytest.mark.parametrize("parts", [1, 9])
def test_passages_equal_brute_force(spark, parts):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(parts == 1).lower())
    try:
        got = {r.doc_id: (r.n_repeated, r.n_later) for r in suffix_dedup.report(documents(spark, PASSAGES).repartition(parts)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute_passages(PASSAGES)


def test_every_stretch_holds_a_kept_suffix():
    w = tokens.words(pa.array([t for _, t in PASSAGES]), tokens.NON_SPACE, tokens.SAME)
    at, _ = suffix_dedup.kept_suffixes(w)
    for s in np.flatnonzero(tokens.starts_inside(w.offsets, 50)):
        assert ((at >= s) & (at + suffix_dedup.KEY <= s + 50)).any()


def test_later_occurrences_are_cut(spark):
    rows = [(1, "a b " + SHARED[0] + " c"), (2, SHARED[0] + " d\ne"), (3, None)]
    docs = documents(spark, rows).withColumnRenamed("lang", "spans")
    got = suffix_dedup.remove_repeats(docs)
    assert got.columns == docs.columns and {r.doc_id: r.text for r in got.collect()} == {1: rows[0][1], 2: " d\ne", 3: None}


def test_rows_of_one_id_and_text_repeat_each_other(spark):
    got = suffix_dedup.report(documents(spark, [(1, SHARED[3]), (1, SHARED[3]), (None, SHARED[2])])).collect()
    assert [(r.doc_id, r.n_repeated, r.n_later) for r in got] == [(1, 200, 200)]
