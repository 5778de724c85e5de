"""Benchmark decontamination against a plain Python version."""

import hashlib
import re

import pytest
from conftest import SF_SMALL
from oracle import compare
from pyspark.sql import functions as F

from sparkrisk.llm import decontamination as DC
from sparkrisk.llm import queries as Q

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, width=10):
    wins = {}
    for item, text in items:
        w = words(text)
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[i : i + n]), set()).add(None if item is None else str(item))
    out = []
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                got = wins.get(tuple(w[i : i + n]))
                if got:
                    hit.update(range(i, i + n))
                    found |= got
        found = sorted(found - {None})
        out.append((key, len(w), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit)))
    return out


P1 = "Ten words, in a row: make a window of a benchmark ITEM and then some more words"
P2 = "señor Ñandú ñandú 42 is short"
ITEMS = [(1, P1), (10, P1), (9, "zz " + P1[:60]), (2, P2), (3, None), (4, "..."), (None, "an item without an id is nine words"), (2, "the the the the the the the the the the the")]
DOCS = [
    (1, P1), (2, "x " + P1.upper() + " y"), (3, "ten words in a row make a window"), (4, None), (5, ""), (6, "?!"),
    (7, "a SEÑOR Ñandú ñandú 42 is short b"), (7, "a señor Ñandú ñandú 42 is short b"), (7, "a señor Ñandú ñandú 42 is short b"),
    (8, "the " * 50), (9, " ".join([P1] * 40)), (None, "so an item without an id is nine words so"),
    (11, "filler " * 20000 + P1 + " filler" * 20000), (12, "Straße " + P2.replace(" ", " ")), (13, P1[:70] + P1),
]


@pytest.fixture(scope="module")
def tables(llm):
    docs = llm.createDataFrame(DOCS, "doc_id long, text string").withColumns({c: F.lit("extra") for c in ("w", "key", "row", "items", "spans", "h", "length", "words", "place", "item")})
    return docs.repartition(3), llm.createDataFrame(ITEMS, "item_id long, text string").withColumn("words", F.lit(1))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("most", [DC.MAX_WINDOWS, 3])
def test_report_equals_brute_force(tables, most):
    got = DC.report(*tables, most=most)
    assert rows(got) == sorted(brute(DOCS, ITEMS), key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_other_widths(tables):
    assert rows(DC.report(*tables, width=3)) == sorted(brute(DOCS, ITEMS, 3), key=repr)


def test_empty_tables(tables):
    docs, items = tables
    assert DC.report(docs.limit(0), items).count() == 0
    clean = DC.report(docs, items.limit(0)).collect()
    assert len(clean) == len(DOCS) and not any(r.contaminated for r in clean)


def test_odd_documents(llm, odd):
    items = llm.createDataFrame([(5, "w0x0 w1x1 w2x2 w3x3 w4x4 w5x5 w6x6 w7x7 w8x8 w9x9"), (6, "the")], "item_id long, text string")
    want = brute([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()],
                 [(r.item_id, r.text) for r in items.collect()])
    assert rows(DC.report(odd, items)) == sorted(want, key=repr)


def test_remove(tables):
    docs, items = tables
    kept = DC.remove(docs, items, "documents")
    facts = brute(DOCS, ITEMS)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in facts if not r[5])
    half = DC.remove(docs, items, "documents", share=0.5)
    assert sorted(r.doc_id or 0 for r in half.collect()) == sorted(r[0] or 0 for r in facts if 2 * r[2] <= r[1])
    cut = DC.remove(docs, items)
    texts = {r.doc_id: r.text for r in cut.filter("doc_id <> 7").collect()}
    assert texts[2] == "x  y" and texts[1] == "" and texts[3] == DOCS[2][1] and texts[4] is None
    assert {r[2] for r in brute([(r.doc_id, r.text) for r in cut.collect()], ITEMS)} == {0}
    with pytest.raises(ValueError):
        DC.remove(docs, items, "words")


def test_query_equals_sql(llm):
    df = Q.queries()["op11_decontamination"](llm, SF_SMALL)
    assert df.filter("contaminated").count() > 0
    ok, msg = compare(df, Q.oracle_sql()["op11_decontamination"], SF_SMALL)
    assert ok, msg
