import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricemart.llm import periodic_runs
from pricemart.llm.common import table
from pricemart.llm.tokens import NON_SPACE, SAME, words

from .conftest import SF, documents, prose

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(ws, least=24, times=3):
    """Every lag's stretches of matches; of stretches in one place the smallest lag is the period."""
    found = {}
    number = {w: i for i, w in enumerate(dict.fromkeys(ws))}
    x = np.array([number[w] for w in ws], np.int64)
    for q in range(1, len(ws) // times + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], x[q:] == x[:-q], [0]])))
        for a, e in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if e - a + q >= max(least, times * q):
                found.setdefault((a, e + q), q)
    return sorted((a, e - a, q) for (a, e), q in found.items())


def brute(doc_id, text):
    ws = SPLIT.findall(text or "")
    n = len(ws)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            ws = [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(ws)
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    gone = {i for a, length, q in runs for i in range(a + q, a + length)}
    kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
    digest = ["".join(f"{a},{length},{q}\n" for a, length, q in runs), kept]
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None, *(hashlib.sha256(x.encode()).hexdigest() for x in digest))


def hard_texts(seed, count):
    """Words of few kinds, powers of powers, Fibonacci words, runs that overlap or differ in one word."""
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        kind, n = rng.randrange(6), rng.randrange(1, 160)
        if kind == 0:
            ws = [rng.choice("ab") for _ in range(n)]
        elif kind == 1:
            base = [rng.choice("abc") for _ in range(rng.randrange(1, 30))]
            ws = [*prose(n, rng.randrange(1, 9)).split(), *(base * rng.randrange(2, 7))[:200], *base[:rng.randrange(30)], "end"]
        elif kind == 2:
            a, b = ["a"], ["a", "b"]
            while len(b) < n:
                a, b = b, b + a
            ws = b
        elif kind == 3:
            inner = ["x"] * rng.randrange(1, 40) + [rng.choice("xy")]
            ws = (inner * rng.randrange(1, 6))[:300]
        elif kind == 4:
            one, two = [str(i) for i in range(rng.randrange(1, 12))], [str(i) for i in range(rng.randrange(1, 12))]
            ws = one * rng.randrange(1, 12) + two * rng.randrange(1, 12)
        else:
            base = [f"w{i}" for i in range(rng.randrange(8, 60))]
            ws = base * 4
            ws[rng.randrange(len(ws))] = "odd"
        out.append(" ".join(ws))
    return out


def test_runs_equal_brute_force():
    texts = hard_texts(3, 400)
    for size in (400, 7):
        for i in range(0, len(texts), size):
            part = texts[i:i + size]
            w = words(pa.array(part), NON_SPACE, SAME)
            got = periodic_runs.find(w.hashes, w.offsets)
            rows = sorted(zip(*(x.tolist() for x in got)))
            assert rows == sorted((j, *r) for j, t in enumerate(part) for r in brute_runs(t.split()))


def test_periods_at_the_edges_of_levels():
    for q in (1, 7, 8, 9, 15, 16, 17, 31, 32, 33, 63, 64, 65, 200):
        base = [f"w{i}" for i in range(q)]
        for n in (23, 24, 25, 3 * q - 1, 3 * q, 3 * q + 1, 5 * q):
            ws = ["left", *(base * (n // q + 1))[:n], "right"]
            w = words(pa.array([" ".join(ws)]), NON_SPACE, SAME)
            assert sorted(zip(*(x.tolist() for x in periodic_runs.find(w.hashes, w.offsets))))[:1] == [(0, *r) for r in brute_runs(ws)][:1]


def test_report_equals_brute_force(spark, odd):
    rows = [(i, t) for i, t in enumerate(hard_texts(11, 120))] + [(None, "a " * 30), (7, None), (7, ""), (7, " \t")]
    for docs in (documents(spark, rows).repartition(3), odd, table(spark, SF, "documents").limit(0)):
        got = [tuple(r) for r in periodic_runs.report(docs).collect()]
        want = [brute(r.doc_id, r.text) for r in docs.collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert periodic_runs.report(docs).columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                                                      "collapsed_sha256"]


def test_documents_of_the_table(spark):
    docs = table(spark, SF, "documents")
    short = docs.where(F.length("text") < 2500)
    assert sorted(tuple(r) for r in periodic_runs.report(short).collect()) == sorted(brute(r.doc_id, r.text) for r in short.collect())


def test_a_word_that_fills_a_long_text(spark):
    """200,000 equal words, and a long text of frequent words: far from all pairs of occurrences."""
    text = "the " * 200_000
    got = periodic_runs.periodic_runs(documents(spark, [(1, text), (2, prose(3, 200_000, 5) + " x" * 24)])).collect()
    one, two = sorted(got, key=lambda r: r.doc_id)
    assert [tuple(r) for r in one.runs] == [(0, 200_000, 1)] and one.collapsed == "the" and one.best == 0
    assert tuple(two.runs[-1]) == (200_000, 24, 1)


def test_collapse_and_names_that_clash(spark):
    rows = [(1, "a  b " * 20), (2, "one  two"), (3, None)]
    docs = documents(spark, rows).withColumnsRenamed({"lang": "runs", "source": "_short", "n_chars": "best"})
    assert {r.doc_id: r.text for r in periodic_runs.collapse(docs).collect()} == {1: "a b", 2: "one  two", 3: None}
    assert periodic_runs.collapse(docs).columns == docs.columns
    more = periodic_runs.periodic_runs(docs)
    assert more.columns == [*docs.columns, "n_words", "_runs", "_best", "collapsed"]
    assert {r.doc_id: [tuple(x) for x in r._runs] for r in more.collect()} == {1: [(0, 40, 2)], 2: [], 3: []}


def test_too_short_runs_are_refused():
    with pytest.raises(ValueError):
        periodic_runs.find(np.zeros(0, np.uint64), np.zeros(1, np.int64), 10, 2)
