"""Checked queries for text operators."""

from __future__ import annotations

from sparkrisk import fixtures as FX
from sparkrisk.functions import scalar as S
from sparkrisk.operators import text as TX
from sparkrisk.plans.registry import query

WORDS = r"list_filter(regexp_split_to_array(text, '[ \t\n\r\f]+'), lambda x: x <> '')"

CTE_TOK = f"""tok AS (
  SELECT doc_id, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS word
  FROM (SELECT doc_id, {WORDS} AS w FROM documents)
)"""

CTE_VOCAB = f"""{CTE_TOK},
cnt AS (SELECT word, count(*) AS count FROM tok GROUP BY word),
vocab AS (
  SELECT * FROM (SELECT word, CAST(row_number() OVER (ORDER BY count DESC, word) AS INTEGER) AS id, count FROM cnt)
  WHERE id <= {TX.VOCAB_SIZE}
)"""

CTE_ENC = f"""{CTE_VOCAB},
enc0 AS (
  SELECT t.doc_id, list(v.id ORDER BY t.pos) FILTER (WHERE v.id IS NOT NULL) AS ids
  FROM tok t LEFT JOIN vocab v ON t.word = v.word GROUP BY t.doc_id
),
enc AS (
  SELECT d.doc_id, coalesce(e.ids, CAST([] AS INTEGER[])) AS ids
  FROM documents d LEFT JOIN enc0 e ON d.doc_id = e.doc_id
)"""


def _docs(spark, sf_dir):
    return FX.table(spark, sf_dir, "documents")


def _vocab(spark, sf_dir):
    return TX.vocabulary(TX.words(_docs(spark, sf_dir)))


def _encoded(spark, sf_dir):
    return TX.encode(_docs(spark, sf_dir), _vocab(spark, sf_dir))


@query(
    "T1_labelled_text",
    "SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
)
def t1_labelled_text(spark, sf_dir):
    return TX.labelled_text(_docs(spark, sf_dir), FX.table(spark, sf_dir, "labels"))


@query("T2_tokens", f"WITH {CTE_TOK} SELECT * FROM tok")
def t2_tokens(spark, sf_dir):
    return TX.tokens(_docs(spark, sf_dir))


@query("T3_vocabulary", f"WITH {CTE_VOCAB} SELECT * FROM vocab")
def t3_vocabulary(spark, sf_dir):
    return _vocab(spark, sf_dir)


@query("T4_encode", f"WITH {CTE_ENC} SELECT * FROM enc")
def t4_encode(spark, sf_dir):
    return _encoded(spark, sf_dir)


@query(
    "T5_decode",
    f"WITH {CTE_VOCAB}, k AS (SELECT t.doc_id, string_agg(t.word, ' ' ORDER BY t.pos) AS text "
    "FROM tok t JOIN vocab v ON t.word = v.word GROUP BY t.doc_id) "
    "SELECT d.doc_id, coalesce(k.text, '') AS text FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id",
)
def t5_decode(spark, sf_dir):
    vocab = _vocab(spark, sf_dir)
    return TX.decode(TX.encode(_docs(spark, sf_dir), vocab), vocab)


@query(
    "T6_pad",
    f"WITH {CTE_ENC} SELECT doc_id, CASE WHEN len(ids) >= {TX.SEQ_LEN} THEN ids[len(ids) - {TX.SEQ_LEN - 1}:] "
    f"ELSE list_concat(list_transform(range({TX.SEQ_LEN} - len(ids)), lambda x: 0), ids) END AS ids FROM enc",
)
def t6_pad(spark, sf_dir):
    return TX.pad(_encoded(spark, sf_dir))


@query(
    "T8_ngram_counts",
    f"""WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents),
g AS (SELECT doc_id, unnest(CASE WHEN len(w) >= 3
        THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
        ELSE CAST([] AS VARCHAR[]) END) AS ngram FROM w)
SELECT doc_id, ngram, count(*) AS count FROM g GROUP BY doc_id, ngram""",
)
def t8_ngram_counts(spark, sf_dir):
    return TX.ngrams(_docs(spark, sf_dir).select("doc_id", "text"))


@query("J3_known_tokens", f"WITH {CTE_VOCAB} SELECT * FROM tok WHERE word IN (SELECT word FROM vocab)")
def j3_known_tokens(spark, sf_dir):
    return TX.known_tokens(TX.tokens(_docs(spark, sf_dir)), _vocab(spark, sf_dir))


@query(
    "J4_lookup",
    f"WITH {CTE_VOCAB} SELECT t.word, t.doc_id, t.pos, v.id FROM tok t JOIN vocab v ON t.word = v.word",
)
def j4_lookup(spark, sf_dir):
    return TX.lookup(TX.tokens(_docs(spark, sf_dir)), _vocab(spark, sf_dir))


@query(
    "J5_seen_ids",
    "WITH " + CTE_VOCAB.replace(" AS (\n", " AS MATERIALIZED (\n", 1).replace("vocab AS (", "vocab AS MATERIALIZED (")
    + ", ids AS MATERIALIZED (SELECT t.doc_id, t.pos, v.id FROM tok t JOIN vocab v ON t.word = v.word), "
    "used AS MATERIALIZED (SELECT DISTINCT id FROM ids SEMI JOIN labels ON ids.doc_id = labels.doc_id) "
    "SELECT ids.* FROM ids SEMI JOIN used ON ids.id = used.id",
)
def j5_seen_ids(spark, sf_dir):
    docs, vocab = _docs(spark, sf_dir), _vocab(spark, sf_dir)
    ids = TX.lookup(TX.tokens(docs), vocab).select("doc_id", "pos", "id")
    labelled = docs.join(FX.table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return TX.seen_ids(ids, TX.lookup(TX.tokens(labelled), vocab).select("id"), vocab)


@query("F9_split_words", f"SELECT doc_id, {WORDS} AS words FROM documents")
def f9_split_words(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", S.split_words("text").alias("words"))


@query("F10_join_words", f"SELECT doc_id, array_to_string({WORDS}, ' ') AS text FROM documents")
def f10_join_words(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", S.join_words(S.split_words("text")).alias("text"))


@query("F11_array_has", f"WITH {CTE_ENC} SELECT doc_id, list_contains(ids, 1) AS has_top_word FROM enc")
def f11_array_has(spark, sf_dir):
    return _encoded(spark, sf_dir).select("doc_id", S.array_has("ids", 1).alias("has_top_word"))


