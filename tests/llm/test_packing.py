import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pricemart.llm import packing
from pricemart.llm.common import table

from .conftest import SF, documents, prose

BPE = public_tokenizers.path("byte_bpe_50k.json")


def check_pieces(rows, docs, seq_len):
    """Every id in one piece, sequences without gaps, no padding."""
    tok = Tokenizer.from_file(BPE)
    want = {}
    for d, t in docs:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        want.setdefault((d, len(ids)), []).append(ids)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(want)
    for key, pieces in by_doc.items():
        ids = want[key]
        assert sum(p.length for p in pieces) == len(ids) * key[1]
        if len(ids) == 1:
            pieces.sort(key=lambda p: p.start)
            assert [p.start for p in pieces] == [sum(p.length for p in pieces[:i]) for i in range(len(pieces))]
        for p in pieces:
            assert p.length > 0 and any(zlib.crc32(np.array(x[p.start:p.start + p.length], "<u4").tobytes()) == p.ids_crc32 for x in ids)
    sizes = []
    for k in range(len(by_sequence)):
        at = 0
        for p in sorted(by_sequence[k], key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        sizes.append(at)
    total = sum(sizes)
    assert sizes[:total // seq_len] == [seq_len] * (total // seq_len)
    assert all(n & (n - 1) == 0 for n in sizes[total // seq_len:]) and len(set(sizes[total // seq_len:])) == len(sizes[total // seq_len:])
    return by_sequence




def test_windows_of_a_plan_tile_everything():
    """Every token of every source has one place, places fill all windows, sources are served in order."""
    rng = random.Random(4)
    for case in range(60):
        seq_len = rng.choice([4, 16, 64])
        names = [None, *(f"s{i}" for i in range(rng.randrange(1, 9)))]
        sizes = {s: rng.choice([0, 1, 2, 7, 50, 1000, 4001]) for s in names}
        weights = {} if case % 2 else {s: rng.choice([0, 1, 2, 500]) for s in names if rng.random() < 0.7}
        total, at, bounds = sum(sizes.values()), 0, {}
        free = sum(n for s, n in sizes.items() if s not in weights)
        for s in packing.in_order(sizes):
            if s in weights or (sizes[s] and sizes[s] * seq_len >= free):
                bounds[s] = (at, sizes[s])
            at += sizes[s]
        plan = packing.Plan(bounds, weights, total, seq_len)
        seen, at = set(), 0
        for s in packing.in_order(sizes):
            served, place = [], 0
            while place < sizes[s]:                                 # documents of several sizes
                n = min(rng.choice([1, 3, 40, 900]), sizes[s] - place)
                where = 0
                for start, length, k, offset in plan.pieces(s, at + place, n):
                    assert start == where and length > 0
                    where += length
                    served += [(k, offset + i) for i in range(length)]
                assert where == n
                place += n
            assert len(served) == sizes[s] == len(set(served)) and [k for k, _ in served] == sorted(k for k, _ in served)
            seen.update(served)
            at += sizes[s]
        assert len(seen) == total
        full = total // seq_len
        assert {x for x in seen if x[0] < full} == {(k, o) for k in range(full) for o in range(seq_len)}
        tail = [max(o for j, o in seen if j == k) + 1 for k in sorted({k for k, _ in seen if k >= full})]
        assert sum(tail) == total % seq_len and all(n & (n - 1) == 0 for n in tail)


def test_every_window_has_the_target_shares():
    sizes = {"a": 70_000, "b": 20_000, "c": 9_000, "d": 1_000}
    plan = packing.Plan({"a": (0, 70_000), "b": (70_000, 20_000), "c": (90_000, 9_000), "d": (99_000, 1_000)}, {}, 100_000, 512)
    at = 0
    for s, n in sizes.items():
        count = {}
        for length, k, _ in plan.windows(s, at, n):
            count[k] = count.get(k, 0) + length
        served = 0
        for k in range(100_000 // 512):
            served += count.get(k, 0)
            assert abs(count.get(k, 0) - 512 * n / 100_000) < 2 and abs(served - 512 * (k + 1) * n / 100_000) < 1
        at += n
    weighted = packing.Plan({"a": (0, 70_000), "b": (70_000, 20_000)}, {"a": 1, "b": 1}, 90_000, 512)
    for s, at, n in (("a", 0, 70_000), ("b", 70_000, 20_000)):
        count = {}
        for length, k, _ in weighted.windows(s, at, n):
            count[k] = count.get(k, 0) + length
        assert all(count[k] == 256 for k in range(40_000 // 512))


def test_pieces_of_odd_documents(spark, odd):
    for docs in (odd, odd.repartition(5), odd.where("doc_id = 6")):
        rows = packing.report(docs.withColumnsRenamed({"lang": "ids", "n_chars": "part"}), BPE, seq_len=256).collect()
        check_pieces(rows, [(r.doc_id, r.text) for r in docs.collect()], 256)
    assert packing.report(odd.limit(0), BPE).collect() == []
    with pytest.raises(ValueError):
        packing.pack(odd, BPE, seq_len=1000)


def test_windows_of_documents_have_the_sources_shares(spark):
    """A hot source, small ones and one of a token a document; weights; sequences hold their pieces' ids."""
    docs = [(i, prose(i, 40 + i % 90), "hot" if i % 3 else f"s{i % 5}") for i in range(400)] + [(900 + i, None, f"tiny{i}") for i in range(9)]
    frame = documents(spark, docs).repartition(6)
    rows = packing.report(frame, BPE, seq_len=128).collect()
    by_sequence = check_pieces(rows, [d[:2] for d in docs], 128)
    total, hot = sum(r.length for r in rows), sum(r.length for r in rows if r.source == "hot")
    for k in range(total // 128):
        assert abs(sum(r.length for r in by_sequence[k] if r.source == "hot") - 128 * hot / total) < 2
    rows = packing.report(frame, BPE, weights={"hot": 1, "s0": 3}, seq_len=128).collect()
    by_sequence = check_pieces(rows, [d[:2] for d in docs], 128)
    small = sum(r.length for r in rows if r.source == "s0")
    for k in range(small * 4 // 3 // 128):
        assert sum(r.length for r in by_sequence[k] if r.source == "s0") == 96
    sequences = packing.padded(packing.pack(frame, BPE, seq_len=128), 128).collect()
    assert all(len(r.ids) in (256, 2 * r.n_tokens) and r.n_tokens == sum(p.length for p in r.pieces) for r in sequences)


def test_pieces_of_the_table(spark):
    docs = table(spark, SF, "documents")
    check_pieces(packing.report(docs, BPE).collect(), [(r.doc_id, r.text) for r in docs.collect()], 2048)
