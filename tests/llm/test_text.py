"""Operators 3, 4, 6 and 9, and the pipeline."""
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sparkrisk.llm import crf, disclosure, html, outliers, packing, queries

SF = "/root/testdata/sf0.001"
SF_LABELS = "/root/testdata/sf0.01"
WORD = re.compile("[^\x20\x09-\x0d]+")
PYTHON_NODES = ("Python", "Pandas", "Arrow")


def native(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not [n for n in PYTHON_NODES if n in plan]


# -- operator 3 ---------------------------------------------------------------------------

def counts(t):
    t = t or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    c = Counter(zip(w, w[1:], w[2:]))
    covered = [False] * len(w)
    for i in range(len(w) - 2):
        if c[tuple(w[i : i + 3])] > 1:
            covered[i : i + 3] = [True] * 3
    r = sum(covered)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), r,
            len(w) < 50 or 100 * r > 50 * len(w))


def row3(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_op3_counts(llm, small_docs):
    df = queries.queries()["op3_robust_outliers"](llm, SF)
    assert native(df)
    assert {r.doc_id: row3(r) for r in df.collect()} == {d: counts(t) for d, t in small_docs}


def test_op3_random_counts(llm):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice("aab \t\n#|.é👍\x0b\x1c") for _ in range(rng.randint(0, 90))), "en", "s") for i in range(800)]
    df = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert {r.doc_id: row3(r) for r in outliers.verdicts(df).collect()} == {r[0]: counts(r[1]) for r in rows}


def brute_mcd(x, support, steps):
    """The same concentration with numpy and exact quantiles."""
    floor = np.diag(outliers.FLOORS)
    m = np.quantile(x, 0.5, axis=0, method="inverted_cdf")
    d = np.quantile(np.abs(x - m), 0.5, axis=0, method="inverted_cdf")
    c = np.diag((1.4826 * d) ** 2) + floor
    dist = lambda: np.einsum("ij,ij->i", (x - m) @ np.linalg.inv(c), x - m)
    for _ in range(steps):
        near = dist()
        pick = x[near <= np.quantile(near, support, method="inverted_cdf")]
        m, c = pick.mean(0), np.cov(pick.T, bias=True) + floor
    final = dist()
    return final / max(np.quantile(final, 0.5, method="inverted_cdf") / outliers.CHI2_MEDIAN, 1)


def test_op3_distances(llm):
    rng = random.Random(9)
    rows = []
    for i in range(400):
        w = [f"{rng.choice('abcdef')}{'x' * rng.randint(1, 8)}{rng.randrange(300)}" for _ in range(rng.randint(60, 400))]
        if i % 20 == 0:
            w = [x + "###" for x in w]
        rows.append((i, " ".join(w), "en" if i % 2 else None, "s"))
    df = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in outliers.verdicts(df, min_group=100).collect()}
    for odd in (0, 1):
        ids = [i for i in range(400) if i % 2 == odd]
        c = np.array([counts(rows[i][1])[:5] for i in ids], float)
        x = np.stack([np.log1p(c[:, 0]), np.log((c[:, 1] + 1) / (c[:, 0] + 1)), np.sqrt(c[:, 2] / (c[:, 1] + 1)),
                      np.sqrt(c[:, 4] / np.maximum(c[:, 0], 1)), np.log1p(c[:, 3])], 1)
        want = brute_mcd(x, outliers.SUPPORT, outliers.STEPS)
        assert np.allclose([got[i].distance for i in ids], want, rtol=1e-6)
        assert [got[i].kept for i in ids] == [not got[i].base_failed and w <= outliers.CHI2_CUTOFF for i, w in zip(ids, want)]
    assert not any(got[i].kept for i in range(0, 400, 20)) and sum(r.kept for r in got.values()) > 370


def test_op3_null_groups_and_pools_stay_apart(llm):
    rng = random.Random(12)
    kinds = [("en", None, 3), *[("en", f"s{i}", 30) for i in range(6)], (None, None, 8), *[(None, f"s{i}", 90) for i in range(6)]]
    rows = []
    for lang, source, size in kinds:
        for _ in range(120 if source is None else 20):
            w = [f"{rng.choice('abcdef')}{'x' * rng.randint(1, 8)}{rng.randrange(9 * size)}" for _ in range(rng.randint(60, 70 + 3 * size))]
            rows.append((len(rows), " ".join(w), lang, source))
    df = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.distance for r in outliers.verdicts(df, min_group=100).collect()}
    for lang in ("en", None):
        for alone in (True, False):
            ids = [i for i, _, la, so in rows if la == lang and (so is None) == alone]
            c = np.array([counts(rows[i][1])[:5] for i in ids], float)
            x = np.stack([np.log1p(c[:, 0]), np.log((c[:, 1] + 1) / (c[:, 0] + 1)), np.sqrt(c[:, 2] / (c[:, 1] + 1)),
                          np.sqrt(c[:, 4] / np.maximum(c[:, 0], 1)), np.log1p(c[:, 3])], 1)
            assert np.allclose([got[i] for i in ids], brute_mcd(x, outliers.SUPPORT, outliers.STEPS), rtol=1e-6)


def test_op3_edges(odd, none):
    rows = outliers.verdicts(odd).collect()
    assert len(rows) == odd.count() and {r.base_failed for r in rows if r.doc_id in (1, 2, 3, 6)} == {True}
    assert sorted(map(row3, rows)) == sorted(counts(r.text) for r in odd.collect())
    assert outliers.verdicts(none).collect() == []


# -- operator 4 ---------------------------------------------------------------------------

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute_spans(t):
    found = sorted((m.start(), n, m.end(), k) for n, (k, p) in enumerate(PLAIN.items()) for m in re.finditer(p, t or "") if valid(k, m.group()))
    n = Counter(f[3] for f in found)
    text = ",".join(f"{k}:{a}:{z}" for a, _, z, k in found)
    return (*[n[k] for k in PLAIN], hashlib.sha256(text.encode()).hexdigest()), text


def row4(r):
    return r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256


def test_op4_base(llm, small_docs):
    df = queries.queries()["op4_disclosure_spans"](llm, SF)
    assert native(df)
    assert {r.doc_id: row4(r) for r in df.collect()} == {d: brute_spans(t)[0] for d, t in small_docs}


def test_op4_random_and_hostile_texts(llm):
    rng = random.Random(10)
    parts = list("a1.@-_+ (5)%0") + ["a@b.c", "1.2.3.4", "+1 (243) 555-5526", "4795522935961213", "\n", "é👍", "25"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))) for i in range(3000)]
    rows += [(9000, None), (9001, "1" * 20000), (9002, "a@" + "b." * 20000 + "c"), (9003, "a" * 50000 + "@"), (9004, "1." * 20000)]
    got = disclosure.find_spans(llm.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {d: brute_spans(t) for d, t in rows}
    for r in got:
        assert row4(r) == want[r.doc_id][0]
        assert ",".join(s for s in r.spans.split(",") if not s.startswith("term:")) == want[r.doc_id][1]


def test_op4_terms(llm):
    filler = [(100 + i, f"common words about nothing number{i}") for i in range(60)]
    rows = [(1, "Write to Zorblax at jo@corp.com today\nother line"), (2, "common words: jo@corp.com, that is zorblax!"),
            (3, "jo@corp.com wrote common words"), (4, "zorblax alone"), (5, "nobody mentions anyone"),
            (6, "once ann@corp.com with quux"), (6, "once ann@corp.com with quux")]
    df = llm.createDataFrame(rows + filler, "doc_id long, text string")
    # n(zorblax) = 3, n(jo) = 3, together 2 of 67: log(2 * 67 / 9) / log(67 / 3) = 0.87
    assert {r.doc_id: r.n_term for r in disclosure.find_spans(df, threshold=0.9).collect() if r.n_term} == {}
    got = {r.doc_id: r for r in disclosure.find_spans(df, threshold=0.85).collect()}
    assert {d: r.n_term for d, r in got.items() if r.n_term} == {1: 1, 2: 1}
    assert got[1].spans == "term:9:16,email:20:31" and got[2].spans == "email:14:25,term:35:42"
    out = {r.doc_id: r.text for r in disclosure.sanitise(df, threshold=0.85).collect()}
    assert out[1] == "Write to [TERM] at [EMAIL] today\nother line" and out[5] == rows[4][1] and out[6] == "once [EMAIL] with quux"


def test_op4_one_line_in_several_documents(llm):
    rows = [(i, f"text {i} about nothing\nEditor: Maria Kowalczyk, desk@x.org\nmore of {i}") for i in range(20)]
    rows += [(100 + i, f"number{i} of the common editor words, more text about nothing") for i in range(40)]
    rows += [(200, "same ann@x.org and quux"), (201, "same ann@x.org and quux"), (202, "once bob@x.org and quuz")]
    df = llm.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in disclosure.find_spans(df).collect()}
    # Both names always come with the address; 'editor' is common; one text alone is no evidence.
    assert {d: r.n_term for d, r in got.items() if r.n_term} == {i: 2 for i in range(20)}
    out = {r.doc_id: r.text for r in disclosure.sanitise(df).collect()}
    assert out[3] == "text 3 about nothing\nEditor: [TERM] [TERM], [EMAIL]\nmore of 3" and out[200] == "same [EMAIL] and quux"


def test_op4_names_in_the_address_and_on_other_lines(llm):
    def letter(i):
        return f"letter {i}\nthe editor\nJane Kowalczyk\n \njane.kowalczyk@x.org, ann@x.org\nroom Zorblax"

    rows = [(i, letter(i)) for i in range(20)] + [(100 + i, f"the room number{i} of an editor, letter {i}") for i in range(40)]
    rows += [(200, "kowalczyk@y.org"), (201, "kowalczyk@y.org again")]  # a part of an entity is no use of the term
    df = llm.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in disclosure.find_spans(df).collect()}
    assert {d: r.n_term for d, r in got.items() if r.n_term} == {i: 3 for i in range(20)}
    out = {r.doc_id: r.text for r in disclosure.sanitise(df).collect()}
    assert out[3] == "letter 3\nthe editor\n[TERM] [TERM]\n \n[EMAIL], [EMAIL]\nroom [TERM]" and out[200] == "[EMAIL]"


def test_op4_edges(odd, none):
    rows = disclosure.find_spans(odd).collect()
    assert len(rows) == odd.count() and {r.spans for r in rows} == {""}
    same = disclosure.sanitise(odd)
    assert same.columns == odd.columns and sorted(map(str, same.collect())) == sorted(map(str, odd.collect()))
    assert disclosure.find_spans(none).collect() == [] and disclosure.sanitise(none).collect() == []


# -- operator 6 ---------------------------------------------------------------------------

def test_op6_query_equals_article(llm):
    from html import unescape

    pages = llm.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.page_id: r for r in queries.queries()["op6_main_text"](llm, SF).collect()}
    for p in pages:
        inner = re.search(r"<article>(.*?)(?:</article>|$)", p.html, re.S).group(1)
        want = " ".join(unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", inner))).split())
        assert (got[p.page_id].text, got[p.page_id].n_chars, got[p.page_id].url) == (want, len(want), p.url)


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("plain", "plain"), ("<p>a<b>b</b>c</p><p>d", "abc d"), ("<body><p>x &lt;y&gt; &amp; z&nbsp;!</p>", "x <y> & z !"),
    ("<main><header>no</header></main><script>if (a<b) '</p>'</script><article><h1>T</h1><p>one<br>two<!-- c --></p></article>", "T one two"),
    ("<article><p>body text</p><div class='comments'><p>spam</p><div>x</div></div><form>f</form><p>end</p></article>", "body text end"),
    ("<div id=top-nav>menu</div><article>a < b</article><aside>s</aside><footer>f</footer>", "a < b"),
    ("<article><p title='a>b'>q</p><style>p{}</style><p>r", "q r"), ("<article>cut <p", "cut"),
])
def test_op6_cases(page, want):
    assert html.main_text(page) == want


def test_op6_density_without_markup_hints():
    words = lambda n: " ".join(f"word{i}" for i in range(n))
    menu = "".join(f"<li><a href=x>link {i}</a></li>" for i in range(30))
    page = f"<html><body><div><ul>{menu}</ul></div><div><div><p>{words(60)}</p><p>{words(50)}</p><p>{words(40)}</p></div></div><div><a>one</a> <a>two</a></div></body></html>"
    assert html.main_text(page) == " ".join([words(60), words(50), words(40)])


def test_op6_density_decides_inside_article_and_main(small_pages):
    words = lambda n: " ".join(f"word{i}" for i in range(n))
    body = f"<div><p>{words(60)}</p><p>{words(50)}</p><p>{words(40)}</p></div>"
    links = "<div>" + "".join(f"<a href=x>link {i}</a> " for i in range(30)) + "</div>"
    want = " ".join([words(60), words(50), words(40)])
    for name in ("article", "main", "div"):  # link lists that no tag or class declares
        assert html.main_text(f"<body><{name}>{links}{body}{links}</{name}></body>") == want
        assert html.main_text(f"<body>{links}<{name}><p>short</p></{name}><div>{body}</div></body>") == want
    for page in small_pages:  # the names of the elements do not matter
        assert html.main_text(re.sub(r"(</?)article>", r"\1div>", page)) == html.main_text(page)


def test_op6_keeps_the_article_behind_declared_elements():
    words = lambda a, n: " ".join(f"{a}{i}" for i in range(n))
    paragraphs = [words(a, n) for a, n in (("one", 60), ("two", 50), ("three", 40))]
    body, want = "".join(f"<p>{x}</p>" for x in paragraphs), " ".join(paragraphs)
    menu = "".join(f"<a href=x>link {i}</a> " for i in range(30))
    # Without end tags: an element ends where the parser ends it.
    assert html.main_text(f"<body><p class='notice'>x{body}</body>") == want
    assert html.main_text(f"<body><div><ul><li class='social'>x<li>y</ul></div><div>{body}</div></body>") == want
    assert html.main_text(f"<body><div><div class='ad'>buy</div><div>{body}</div></div><nav>{menu}</body>") == want
    for start in ("<div class='ad'>", "<nav>"):
        assert html.main_text(f"<body><div>{start}{menu}</div><div>{body}</div></body>") == want
        assert want in html.main_text(f"<body>{start}{menu}<div>{body}</div></body>")
    # A word of a class name says little of an element that holds the text.
    for name in ("content-with-sidebar", "no-sidebar", "page-header-wrapper", "elementor-widget-text-editor", "widget"):
        assert html.main_text(f"<body><div>{menu}</div><div class='{name}'>{body}</div></body>") == want
        assert html.main_text(f"<body><div class='{name}'>{paragraphs[0]}</div></body>") == paragraphs[0]
    each = "".join(f"<div class='elementor-widget-text-editor'><p>{x}</p></div>" for x in paragraphs)
    assert html.main_text(f"<body><div>{menu}</div><div>{each}</div></body>") == want
    assert html.main_text(f"<body><form><div>{body}</div></form></body>") == want
    # Whole class names of a minor share still leave the page.
    assert html.main_text(f"<body><div>{body}<div class='box ad'>buy</div><span class=share>me</span></div></body>") == want
    # Text that stands directly in an ancestor of the densest node.
    lead = words("lead", 80)
    assert html.main_text(f"<body><div>{menu}</div><div>{lead}<div>{body}</div></div></body>") == f"{lead} {want}"


def test_op6_edges(llm):
    df = llm.createDataFrame([(1, None, None, "x", 5), (2, "u", "<p>a", "y", 6), (2, "u", "<p>a", "y", 6), (None, "u", "<div>" * 3000 + "deep", "z", 7)],
                             "page_id long, url string, html string, text string, n_chars int")
    got = html.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.text, r.n_chars) for r in got.collect()) == [("", 0), ("a", 1), ("a", 1), ("deep", 4)]
    assert html.extract(df.limit(0)).collect() == []


# -- operator 9 ---------------------------------------------------------------------------

def features(texts):
    raw = [(t or "").encode() for t in texts]
    return crf.line_features(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))


def test_chain_equals_enumeration():
    from itertools import product

    rng = np.random.default_rng(11)
    model = crf.ChainModel(np.zeros(1), rng.normal(size=(2, 2)))
    lines = np.array([1, 4, 2, 6])
    unary = rng.normal(size=lines.sum())
    got = model.forward_backward(unary, lines)[2]
    at = 0
    for n in lines:
        u, total, good = unary[at : at + n], 0.0, np.zeros(n)
        for path in product((0, 1), repeat=int(n)):
            w = np.exp(sum(x * y for x, y in zip(path, u)) + sum(model.scores[a, b] for a, b in zip(path, path[1:])))
            total += w
            good += w * np.array(path)
        assert np.allclose(got[at : at + n], good / total)
        at += n


def test_line_features():
    x, length, lines = features(["ab AB!\n\nab AB!", None, "", "a a a b\n"])
    assert lines.tolist() == [3, 1, 1, 2] and length.tolist() == [6, 0, 6, 0, 0, 7, 0]
    c = len(crf._CLASSES)
    assert np.allclose(x[5, [c + 1, c + 2]], [0.5, 0.5])  # two distinct words of four, two repeats
    assert x[0, c + 4] == x[2, c + 4] == 1 and x[1, c + 4] == x[5, c + 4] == 0
    for i, t in enumerate(["ab AB!\n\nab AB!", None, "", "a a a b\n"]):  # neighbours in the batch do not matter
        assert np.allclose(features([t])[0], x[lines[:i].sum() : lines[: i + 1].sum()])


def test_op9_held_out(llm):
    labels = {r.doc_id: r.quality for r in llm.read.parquet(f"{SF_LABELS}/labels.parquet").collect()}
    rows = queries.queries()["op9_line_crf_quality"](llm, SF_LABELS).collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    test = [r for r in rows if r.held_out and r.doc_id in labels]
    assert len(test) > 40 and np.mean([r.predicted == labels[r.doc_id] for r in test]) >= 0.93


def test_op9_edges(llm, odd, none):
    labels = llm.createDataFrame([(1, 1), (None, 1), (3, 0), (3, None), (4, 1), (7, 1), (10, 0), (11, 0), (99, 1), (8, 7)], "doc_id long, quality int")
    model = crf.fit(odd, labels)
    out = crf.score(odd, model)
    assert set(out.columns) == set(odd.columns)  # the clashing column is replaced
    assert all(0 <= r.score <= 1 for r in out.collect()) and out.count() == odd.count()
    assert crf.score(none, model).collect() == []
    assert crf.fit(none, labels).constant == 0.5 and crf.fit(odd, labels.limit(0)).constant == 0.5
    assert {r.score for r in crf.score(odd, crf.fit(odd, labels.filter("quality = 1"))).collect()} == {1.0}


# -- pipeline -------------------------------------------------------------------------------

def test_pipeline(llm):
    import corpus_pipeline as P
    from pyspark.sql import functions as F

    docs = llm.read.parquet(f"{SF_LABELS}/documents.parquet")
    seen = docs
    for name, step in P.STAGES[:-1]:
        out = step(llm, seen, SF_LABELS)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        rows = {r.doc_id: r for r in out.collect()}
        before = {r.doc_id: r for r in seen.collect()}
        assert set(rows) <= set(before)
        if name == "near-duplicates":
            from llm.test_search import brute_components

            want = {d for d, (_, _, kept) in brute_components([(d, r.text) for d, r in before.items()], 5).items() if kept}
            assert set(rows) == want
        if name == "repeated passages":
            from llm.test_search import brute_repeats

            want = brute_repeats([(d, r.text) for d, r in before.items()], 20)
            for d, r in rows.items():
                kept = WORD.findall(r.text)
                assert (len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()) == (want[d][0] - want[d][1], want[d][2])
        if name == "personal data":
            assert native(out)
            assert all(brute_spans(r.text)[1] == "" for r in rows.values())
        if name not in ("quality classifier", "near-duplicates"):
            assert set(rows) == set(before) and all(r.n_chars == len(r.text) for r in rows.values())
        seen = llm.createDataFrame(list(rows.values()), out.schema).withColumn("n_chars", F.col("n_chars"))
    last = P.STAGES[-1][1](llm, seen, SF_LABELS).collect()
    assert {r.doc_id for r in last} == set(rows) and sum(r.length for r in last if r.piece == 0) > 0


def test_pipeline_edges(llm, odd, none, tmp_path):
    import corpus_pipeline as P

    for docs in (odd, none):
        for _, step in P.STAGES[:-1]:
            out = step(llm, docs, SF)
            assert out.columns == docs.columns
            out.collect()
        assert (P.STAGES[-1][1](llm, docs, SF).count() == 0) == (docs is none)


def test_pipeline_query_runs(llm):
    rows = queries.queries()["pipeline"](llm, SF).collect()
    assert rows and all(0 < r.length <= 4096 for r in rows)
