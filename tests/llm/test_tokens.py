"""Operators 2, 8 and 10 against the tokenizers library."""
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparkrisk.llm import bpe, packing, queries, tokenfile
from sparkrisk.llm.tokens import TokenEncoder
from sparkrisk.session import shared_dir

SF = "/root/testdata/sf0.001"
FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


def strings(n=1500):
    rng = random.Random(1)
    parts = list("aAbB 's'tσΣİéñ  \n\n\t.,!?12３\xa0　́ \x1c<|>漢字👍🏽\x85") + ["the ", "<|endoftext|>", "<|startoftext|>", " \n", "'re "]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)] + [None, "", "ab" * 3000]


@pytest.mark.parametrize("name", FILES)
def test_encoders_equal_library(name):
    path, texts = public_tokenizers.path(name), strings()
    lib = Tokenizer.from_file(path)
    want = [lib.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in TokenEncoder(path).encode(texts)] == want
    assert [np.frombuffer(b, "<u4").tolist() for b in TokenEncoder(path, max_pieces=7).encode(texts)] == want  # memory that overflows
    own = bpe.BpeModel(path)
    got = own.encode(texts)
    assert [g.tolist() for g in got] == want
    assert [own.decode(g.tolist()) for g in got] == [lib.decode(w, skip_special_tokens=False) for w in want]


def test_merge_order_is_leftmost_lowest_rank():
    own = bpe.BpeModel(public_tokenizers.path("byte_bpe_50k.json"))
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    words = ["a" * n for n in (1, 2, 3, 7, 8, 9, 64, 1000)] + ["abab" * 50, "hellohello"]
    assert [np.frombuffer(b, "<u4").tolist() for b in own.merge_words([w.encode() for w in words])] == [lib.encode(w).ids for w in words]


def test_op8_query(llm, small_docs):
    lib = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for d, t in small_docs:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, queries.queries()["op8_bpe_segment_tree"](llm, SF).collect())) == want


def test_op8_edges(odd, none):
    path = public_tokenizers.path(FILES[0])
    rows = bpe.digests(odd, path).collect()
    assert len(rows) == odd.count() and {r.n_tokens for r in rows if r.doc_id in (1, 2, 6)} == {0}
    assert bpe.digests(none, path).collect() == [] and bpe.encode_decode(none, path).collect() == []
    lists = {r.doc_id: r for r in bpe.encode_decode(odd, path).collect()}
    assert len(lists[3].ids) == 1 and lists[2].decoded == ""


def check_places(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for placed in by.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_op2_query(llm, small_docs):
    lib = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    want = {}
    for d, t in small_docs:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [1]
        for at in range(0, len(ids), 4096):
            cut = ids[at : at + 4096]
            want[d, at // 4096] = (at, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes()))
    rows = queries.queries()["op2_best_fit_packing"](llm, SF).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    lower = -(-sum(r.length for r in rows) // 4096)
    assert lower <= check_places(rows, 4096) <= lower + 1


def best_fit(lengths, capacity):
    """Sequences that item-by-item best fit, longest first, opens."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


def test_plan_equals_item_by_item_best_fit():
    rng = random.Random(2)
    for _ in range(60):
        capacity = rng.randint(5, 60)
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 200))]
        histogram = {n: lengths.count(n) for n in set(lengths)}
        sequences, covered = set(), defaultdict(int)
        for length, lo, hi, first, per, at in packing.plan_best_fit(histogram, capacity):
            covered[length] += hi - lo
            sequences |= {first + i // per for i in range(hi - lo)}
            assert at + min(per, hi - lo) * length <= capacity
        assert dict(covered) == histogram and len(sequences) == best_fit(lengths, capacity)


def test_op2_edges(odd, none):
    path = public_tokenizers.path(FILES[0])
    rows = packing.pack(odd, path, end_id=1, capacity=128, with_ids=True).collect()
    check_places(rows, 128)
    assert {r.length for r in rows if r.doc_id in (1, 2)} == {1} and all(len(r.ids) == r.length for r in rows)
    assert len([r for r in rows if r.doc_id == 8]) == 2
    assert packing.pack(none, path, end_id=1).collect() == []


def test_bits_round_trip():
    rng = np.random.default_rng(3)
    for bits in (1, 3, 8, 13, 16, 17, 31, 32):
        for n in (0, 1, 2, 63, 64, 65, 1000):
            ids = rng.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
            payload = tokenfile.pack_bits(ids, bits)
            assert len(payload) == -(-n * bits // 64) * 8
            assert (tokenfile.unpack_bits(payload, bits, 0, n) == ids).all()
            if n > 10:
                assert (tokenfile.unpack_bits(payload, bits, 7, n - 9) == ids[7:-2]).all()  # random access
    assert [tokenfile.bits_for(n) for n in (1, 2, 3, 256, 257, 50257)] == [1, 1, 2, 8, 9, 16]


def test_op10_query(llm, small_docs):
    lib, want, start = Tokenizer.from_file(public_tokenizers.path(FILES[1])), [], 0
    for d, t in small_docs:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, queries.queries()["op10_token_files"](llm, SF).collect())) == want


def test_op10_edges(llm, odd, none):
    path = public_tokenizers.path(FILES[1])
    files = tokenfile.write_token_files(odd, shared_dir(llm, "t"), path, end_id=0, block_ids=64)
    rows = sorted(tokenfile.read_token_files(llm, files, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in odd.collect()), key=lambda x: (x is not None, x))
    end = 0
    for r in rows:
        assert r.start == end and len(r.ids) == r.n_tokens and r.ids[-1] == 0
        end += r.n_tokens
    empty = tokenfile.write_token_files(none, shared_dir(llm, "t"), path, end_id=0)
    assert tokenfile.read_token_files(llm, empty).collect() == []


def test_op10_hot_id_is_many_shards(llm):
    path = public_tokenizers.path(FILES[1])
    rows = [(7, f"text {i % 400}") for i in range(1200)] + [(i, "other") for i in range(100)]
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(4)
    merge = "spark.sql.adaptive.coalescePartitions.enabled"  # would make one task of so few rows
    llm.conf.set(merge, "false")
    try:
        files = tokenfile.write_token_files(docs, shared_dir(llm, "t"), path, end_id=0, block_ids=64)
    finally:
        llm.conf.set(merge, "true")
    hot = llm.read.parquet(files).selectExpr("shard", "explode(keys) AS k").filter("k = 7").select("shard").distinct().count()
    assert hot > 1
    got = sorted(tokenfile.read_token_files(llm, files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(r[0] for r in rows)
    lib = Tokenizer.from_file(path)
    crc = lambda t: zlib.crc32(np.array(lib.encode(t, add_special_tokens=False).ids + [0], "<u4").tobytes())
    assert sorted((r.doc_id, r.ids_crc32) for r in got) == sorted((k, crc(t)) for k, t in rows)
    assert sum(r.n_tokens for r in got[:-1]) == got[-1].start
