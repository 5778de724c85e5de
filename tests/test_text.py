"""Text operators on hand-written texts."""

from sparkrisk.operators import text as TX


def test_encode_decode_pad(spark):
    docs = spark.createDataFrame(
        [(1, "a b  a\tc"), (2, "zzz qqq"), (3, ""), (4, " ".join(["a"] * 300 + ["b"]))], "doc_id long, text string"
    )
    vocab = TX.vocabulary(TX.tokens(docs), n=2)
    assert [(r.word, r.id) for r in vocab.orderBy("id").collect()] == [("a", 1), ("b", 2)]
    enc = {r.doc_id: r.ids for r in TX.encode(docs, vocab).collect()}
    assert enc[1] == [1, 2, 1] and enc[2] == [] and enc[3] == [] and len(enc[4]) == 301
    dec = {r.doc_id: r.text for r in TX.decode(TX.encode(docs, vocab), vocab).collect()}
    assert dec[1] == "a b a" and dec[2] == "" and dec[3] == ""
    padded = {r.doc_id: r.ids for r in TX.pad(TX.encode(docs, vocab), n=250).collect()}
    assert all(len(v) == 250 for v in padded.values())
    assert padded[1] == [0] * 247 + [1, 2, 1]
    assert padded[4][-1] == 2 and padded[4][0] == 1


def test_ngrams(spark):
    docs = spark.createDataFrame([(1, "a b c a b c"), (2, "a b")], "doc_id long, text string")
    got = {(r.doc_id, r.ngram): r["count"] for r in TX.ngrams(docs).collect()}
    assert got == {(1, "a b c"): 2, (1, "b c a"): 1, (1, "c a b"): 1}


def test_ngrams_inside_rows(spark):
    import random

    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 2, i]), " ".join(rng.choice(["a", "b", "é", "", "\t"]) for _ in range(rng.randrange(40)))) for i in range(700)]
    rows += [(7, None), (8, "x " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for n in (1, 2, 3, 40):
        want = []
        for key, text in rows:
            w = (text or "").split()
            counts = {}
            for i in range(len(w) - n + 1):
                g = " ".join(w[i : i + n])
                counts[g] = counts.get(g, 0) + 1
            want += [(key, g, c) for g, c in counts.items()]
        got = TX.ngrams(docs, n=n)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert TX.ngrams(docs.limit(0)).count() == 0


def test_lookup_and_join_agree(spark):
    docs = spark.createDataFrame([(i % 5, " ".join(f"w{(i * j) % 17}" for j in range(i % 9))) for i in range(60)] + [(1, None)],
                                 "doc_id long, text string")
    vocab = TX.vocabulary(TX.tokens(docs), n=9)
    enc, joined = TX.encode(docs, vocab), TX.encode(docs, vocab, most=0)
    assert "Exchange" not in enc._jdf.queryExecution().executedPlan().toString()
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(enc) == rows(joined)
    assert rows(TX.decode(enc, vocab)) == rows(TX.decode(enc, vocab, most=0))


def test_repeated_keys_are_separate_texts(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "b a a"), (1, "a b"), (2, ""), (2, ""), (None, "b")], "doc_id long, text string")
    vocab = TX.vocabulary(TX.tokens(docs), n=2)
    a, b = (vocab.filter(f"word = '{w}'").first().id for w in "ab")
    enc = TX.encode(docs, vocab)
    rows = sorted((r.doc_id or 0, r.ids) for r in enc.collect())
    assert rows == sorted([(1, [a, b]), (1, [b, a, a]), (1, [a, b]), (2, []), (2, []), (0, [b])])
    assert sorted((r.doc_id or 0, r.text) for r in TX.decode(enc, vocab).collect()) == [(0, "b"), (1, "a b"), (1, "a b"), (1, "b a a"), (2, ""), (2, "")]


def test_large_vocabulary_joins_by_salted_shuffle(spark):
    docs = spark.createDataFrame([(i, "the " * 20 + f"w{i}") for i in range(50)], "doc_id long, text string")
    toks = TX.tokens(docs)
    vocab = toks.groupBy("word").count().selectExpr("word", "CAST(hash(word) AS INT) AS id")  # no proven bound
    got = TX.lookup(toks, vocab)
    assert "__salt" in got._jdf.queryExecution().optimizedPlan().toString()
    want = {r.word: r.id for r in vocab.collect()}
    rows = got.collect()
    assert len(rows) == 50 * 21 and all(want[r.word] == r.id for r in rows)
    assert TX.known_tokens(toks, vocab.filter("word = 'the'")).count() == 1000
