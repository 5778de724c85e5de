"""Operators 1, 5 and 7 against brute force."""
import hashlib
import random
import re

import numpy as np

from sparkrisk.llm import ann, components, fmindex, minhash, queries, substring, wordhash

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


# -- operator 1 ---------------------------------------------------------------------------

def test_hilbert_neighbours_touch():
    for d, bits in ((2, 4), (3, 3), (4, 2)):
        side = 1 << bits
        cells = np.stack([g.ravel() for g in np.meshgrid(*[np.arange(side)] * d)], 1)
        keys = ann.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(side**d))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_best_of_a_block_as_one_query_after_the_other():
    rng = np.random.default_rng(3)
    for n, d, k in ((1, 3, 5), (30, 4, 20), (900, 8, 5), (2500, 16, 20)):
        base = np.round(rng.normal(size=(n, d)) * 2)  # many equal scores
        ids = [sorted(rng.integers(0, 4000, int(rng.integers(1, 4))).tolist()) for _ in range(n)]
        asked = rng.integers(0, n, 40)
        own = np.array([ids[j][0] for j in asked])
        many, far, got = ann._best(base[asked], own, base, np.linalg.norm(base, axis=1).max(), np.array(sum(ids, [])),
                                   np.array([len(x) for x in ids]), k)
        ends = np.cumsum(many)
        for j, a, a_z, me in zip(asked, ends - many, ends, own):
            want = sorted((-float(base[j] @ base[e]), x) for e in range(n) for x in ids[e] if x != me)[:k]
            assert list(zip(far[a:a_z].tolist(), got[a:a_z].tolist())) == want


def test_op1_a_query_visits_few_blocks_of_a_large_table(llm, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(2000)]
    vectors = llm.createDataFrame(rows, "vec_id long, embedding array<double>")
    frame, blocks = type(vectors), []
    plain = frame.mapInArrow

    def counted(df, f, schema):
        if "near" in str(schema):
            blocks.append(df.select("o", "block").distinct().count())
        return plain(df, f, schema)

    monkeypatch.setattr(frame, "mapInArrow", counted)
    got = ann.nearest(vectors, k=5, query=vectors["vec_id"] % 20 == 0, block_rows=2).collect()
    assert blocks[0] <= 8 * 50  # 1,000 blocks of 2 in each of 8 orderings otherwise
    want = brute_nearest(rows, 5, lambda i: i % 20 == 0)
    found = {(r.query_id, r.vec_id) for r in got}
    assert sum((q, i) in found for q, near in want.items() for _, i in near) >= 0.9 * 5 * len(want)


def brute_nearest(rows, k, query):
    ok = {i: np.array(v, float) for i, v in rows}
    out = {}
    for q in ok:
        if query(q):
            out[q] = sorted((-float(ok[q] @ v), i) for i, v in ok.items() if i != q)[:k]
    return out


def test_op1_recall(llm):
    rows = [(r.vec_id, r.embedding) for r in llm.read.parquet(f"{SF}/embeddings.parquet").collect()]
    vectors = llm.read.parquet(f"{SF}/embeddings.parquet")
    got = ann.nearest(vectors, query=vectors["vec_id"] % 20 == 0, block_rows=32).collect()
    want = brute_nearest(rows, 20, lambda i: i % 20 == 0)
    found = {}
    for r in got:
        found.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    hit = sum(len({i for _, i in want[q]} & {v for v, _ in found[q].values()}) for q in want)
    assert hit >= 0.9 * 20 * len(want)
    values = dict(rows)
    for q, best in found.items():
        assert sorted(best) == list(range(1, len(best) + 1))
        for v, score in best.values():
            assert abs(score - float(np.array(values[q], float) @ np.array(values[v], float))) < 1e-12


def test_op1_exact_in_one_block_with_ties_and_bad_rows(llm):
    rng = random.Random(4)
    good = [(i, [rng.choice([-1.0, 0.5, 1.0]) for _ in range(3)]) for i in range(200)]
    good += [(200 + i, [1.0, 1.0, 1.0]) for i in range(60)]  # one frequent vector
    bad = [(900, None), (901, []), (902, [0.0] * 3), (903, [1.0, None, 1.0]), (904, [float("nan"), 1.0, 1.0]),
           (905, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (906, [1.0, 2.0])]
    df = llm.createDataFrame([(i, v, "x", 1.0) for i, v in good + bad], "vec_id long, embedding array<double>, id string, score double").repartition(4)
    got = {}
    for r in ann.nearest(df, k=20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute_nearest(good, 20, lambda i: True)
    assert {q: [(v, s) for _, v, s in sorted(x)] for q, x in got.items()} == {q: [(i, -s) for s, i in x] for q, x in want.items()}
    assert ann.nearest(df.limit(0)).collect() == [] and ann.nearest(df.filter("vec_id >= 900")).count() <= 1
    few = ann.nearest(df.filter("vec_id < 3"), k=20).collect()
    assert len(few) == 6


# -- operator 5 ---------------------------------------------------------------------------

def brute_components(rows, n, percent=80):
    sets = {}
    for d, t in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[d] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def planted(seed=5):
    """Chains and stars of near copies, exact copies, and texts that only share a passage."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows, passage = [], text(25)
    for _ in range(12):
        base = text(rng.randint(30, 120))
        for _ in range(rng.randint(1, 14)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = f"e{rng.random()}"
            rows.append(copy)
            if rng.random() < 0.3:
                base = copy
    rows += [passage + text(20) for _ in range(25)] + [text(rng.randint(0, 6)) for _ in range(15)]
    rng.shuffle(rows)
    return [(i, " ".join(w).upper() if i % 7 == 0 else "\n".join(w)) for i, w in enumerate(rows)]


def as_dict(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_op5_planted(llm):
    rows = planted()
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute_components(rows, 4)
    assert as_dict(minhash.near_duplicates(df, shingle=4)) == want
    # Clusters dealt over many chunks: links between chunks, with a hub and without.
    assert as_dict(minhash.near_duplicates(df, shingle=4, chunk_shingles=150)) == want


def test_op5_collisions():
    """The counted collisions equal a plain count over all pairs, though long lists are skipped."""
    rng = np.random.default_rng(3)
    signatures = rng.integers(0, 40, (60, 48)).astype(np.uint64) + np.arange(48, dtype=np.uint64) * np.uint64(100)
    for i in range(30, 60):  # copies with some coordinates changed
        signatures[i] = signatures[i - 30]
        signatures[i, rng.permutation(48)[: i - 30]] += np.uint64(1)
    signatures[:, :12] = signatures[0, :12]  # values that all documents share
    posts = minhash._Postings(list(signatures), 26)
    for own in signatures:
        assert posts.colliding(own).tolist() == np.nonzero((signatures == own).sum(axis=1) >= 26)[0].tolist()


def test_op5_chained_group(llm):
    """A chain in which only neighbours are similar, beside a hot group of near copies: over many
    chunks, and with the shuffle's parts."""
    rng = random.Random(11)
    line = [f"c{rng.randrange(5000)}" for _ in range(900)]
    rows = [line[i : i + 60] for i in range(0, 780, 3)]
    base = [f"h{rng.randrange(300)}" for _ in range(80)]
    for _ in range(130):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(80)] = f"x{rng.random()}"
        rows.append(copy)
    rng.shuffle(rows)
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute_components(rows, 4)
    assert as_dict(minhash.near_duplicates(df, shingle=4)) == want
    assert as_dict(minhash.near_duplicates(df, shingle=4, chunk_shingles=1500)) == want


def test_op5_query(llm, small_docs):
    assert as_dict(queries.queries()["op5_minhash_coordinates"](llm, SF)) == brute_components(small_docs, 4)


def test_op5_edges(odd, none):
    rows = minhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert (by[1].n_shingles, by[1].component_id, by[1].kept) == (0, 1, True) and by[2].kept
    assert by[5].component_id == 4 and not by[5].kept and by[3].n_shingles == 1
    assert by[None].component_id is None and by[None].kept
    assert minhash.near_duplicates(none).collect() == [] and minhash.drop_near_duplicates(none).collect() == []
    kept = minhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted((r.doc_id or 0) for r in odd.collect() if r.doc_id != 5)


def test_components(llm):
    edges = [(i, f"g{i}") for i in range(40)] + [(i + 1, f"g{i}") for i in range(40)] + [(100, "h"), (101, "h"), (200, "solo")]
    got = {r.doc: r.label for r in components.components(llm.createDataFrame(edges, "doc long, grp string")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 200}


# -- operator 7 ---------------------------------------------------------------------------

def brute_repeats(rows, width):
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            window = tuple(w[i : i + width])
            if window in seen:
                gone[i : i + width] = [True] * width
            seen.add(window)
        kept = [x for x, g in zip(w, gone) if not g]
        out[d] = (len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def digests(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()}


def test_fm_index_matches():
    rng = np.random.default_rng(6)
    text = np.append(rng.integers(1, 5, 300), 0)  # 0 separates and is never searched
    index = fmindex.FmIndex(text, 8)
    plain = text.tolist()
    ends = np.arange(8, len(text) - 1)
    length, low, high = index.matching_statistics(text, ends, 8)
    for e, n, lo, hi in zip(ends.tolist(), length.tolist(), low.tolist(), high.tolist()):
        places = lambda m, e=e: [i for i in range(len(plain) - m + 1) if plain[i : i + m] == plain[e - m : e]]
        assert n == max(m for m in range(9) if m == 0 or len(places(m)) >= 2)
        if n:
            assert sorted(index.order[lo:hi].tolist()) == places(n)


def test_word_hashes():
    import pyarrow as pa

    texts = ["Ab c", None, "", " \x0bÉa\tb ", "c Ab", "ab C"]
    data, offsets = wordhash.utf8(pa.array(texts))
    h, first, end, per = wordhash.words(data, offsets)
    assert per.tolist() == [2, 0, 0, 2, 2, 2] and [bytes(data[a:b]).decode() for a, b in zip(first, end)] == "Ab c Éa b c Ab ab C".split()
    assert h[0] == h[5] and h[1] == h[4] and len(set(h.tolist())) == 6
    low = wordhash.words(data, offsets, lower=True)[0]
    assert low[0] == low[6] and low[1] == low[7]
    assert wordhash.Runs(h).hash(np.array([0, 4]), 1).tolist()[0] != wordhash.Runs(h).hash(np.array([4]), 1)[0]


def test_op7_planted(llm):
    rng = random.Random(7)
    passages = [[f"p{rng.randrange(60)}" for _ in range(rng.randint(6, 40))] for _ in range(6)]
    rows = []
    for i in range(150):
        w = []
        for _ in range(rng.randint(0, 5)):
            w += rng.choice(passages)[rng.randrange(4) :] if rng.random() < 0.6 else [f"r{rng.randrange(30)}" for _ in range(rng.randint(1, 25))]
        if i % 11 == 0:
            w += ["again"] * 30
        rows.append((i, "\n ".join(w) if w or i % 2 else None))
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for width, gram in ((8, 3), (20, 8), (5, 5)):
        for hot in (500, 1):  # 1: all candidates go window by window
            assert digests(substring.kept_digests(df, width=width, gram=gram, hot=hot)) == brute_repeats(rows, width)


def test_op7_query(llm, small_docs):
    assert digests(queries.queries()["op7_fm_index_repeats"](llm, SF)) == brute_repeats(small_docs, 20)


def test_op7_edges(odd, none):
    rows = substring.kept_digests(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert by[5].n_removed == 30_000 and by[4].n_removed < 30_000 and by[2].n_words == 0 and by[None].n_removed == 0
    assert [r.n_removed for r in rows if r.doc_id == 8] == [0, 0]  # the same document twice
    assert by[10].n_removed == 499 or by[10].n_removed == 500
    texts = substring.remove_repeats(odd)
    assert texts.columns == odd.columns
    out = {r.doc_id: r.text for r in texts.collect()}
    assert out[5] == "" and out[2] is None and out[7] == [r.text for r in odd.collect() if r.doc_id == 7][0]
    assert substring.kept_digests(none).collect() == [] and substring.remove_repeats(none).collect() == []
