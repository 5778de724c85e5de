"""Registered queries of the training-data operators: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkrisk.llm.common import setup, table
from sparkrisk.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str):
    def wrap(fn):
        QUERIES[name] = fn
        return fn

    return wrap


def _oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


@_query("op8_bpe_segment_tree")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded with the word-level BPE file."""
    from sparkrisk.llm.bpe import digests

    return digests(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


@_query("op2_best_fit_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 ids, end id 1."""
    from sparkrisk.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), end_id=1)


@_query("op10_token_files")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as bit-packed id files (end id 0) and read back."""
    from sparkrisk.llm.tokenfile import read_token_files, write_token_files

    setup(spark)
    path = write_token_files(table(spark, sf_dir, "documents"), shared_dir(spark, "tokens"),
                             _tokenizer("byte_bpe_50k.json"), end_id=0)
    return read_token_files(spark, path)


@_query("op6_main_text")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    from sparkrisk.llm.html import extract

    return extract(table(spark, sf_dir, "pages"))


@_query("op1_hilbert_neighbours")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    from sparkrisk.llm.ann import nearest

    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, k=20, query=vectors["vec_id"] % 20 == 0)


@_query("op9_line_crf_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels that are not held out."""
    from pyspark.sql import functions as F

    from sparkrisk.llm import crf

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = crf.fit(docs, table(spark, sf_dir, "labels"))
    return crf.score(docs, model).select("doc_id", crf.held_out("doc_id").alias("held_out"), "score",
                                         F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


@_query("op7_fm_index_repeats")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeat an earlier 20-word window, removed."""
    from sparkrisk.llm.substring import kept_digests

    return kept_digests(table(spark, sf_dir, "documents"))


@_query("op5_minhash_coordinates")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicates: four-word shingles, similarity of 0.8 or more."""
    from sparkrisk.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)


@_query("op3_robust_outliers")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and robust outlier verdict of every document, per language and source."""
    from sparkrisk.llm.outliers import verdicts

    return verdicts(table(spark, sf_dir, "documents"))


@_query("op4_disclosure_spans")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and the terms that give it away, in every document."""
    from sparkrisk.llm.disclosure import find_spans

    return find_spans(table(spark, sf_dir, "documents"))


@_query("op11_decontamination")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a benchmark window of 10 words."""
    from sparkrisk.llm.decontamination import report

    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_oracle("op11_decontamination", r"""
WITH doc AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS win
    FROM (SELECT item, w, least(10, len(w)) AS n FROM item WHERE len(w) > 0)),
place AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM win))),
hit AS MATERIALIZED (SELECT rid, n, i, item FROM place JOIN win USING (n, win)),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
    FROM (SELECT DISTINCT rid, item FROM hit WHERE item IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid)""")


@_query("op12_centroid_planes")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's nearest of 40 centroids after 5 rounds, with exact distances."""
    from sparkrisk.llm.centroids import cluster_report

    return cluster_report(table(spark, sf_dir, "embeddings"))


def _centroid_sql(k: int = 40, rounds: int = 5) -> str:
    """The rounds spelled out: long rows (vector, component, integer), joined by component."""
    ctes = ["""kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, e FROM (
      SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) WHERE len(e) = 64
      AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
            """x AS MATERIALIZED (SELECT rid, unnest(range(64)) AS d,
      unnest(list_transform(e, lambda c: CAST(floor(256 * c) AS BIGINT))) AS x FROM kept)""",
            f"""c0 AS MATERIALIZED (SELECT c, d, x FROM (SELECT rid, row_number() OVER (
      ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR))) - 1 AS c FROM kept) s JOIN x USING (rid) WHERE c < {k})"""]
    for r in range(rounds + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (SELECT rid, arg_min(c, (far, c)) AS c, min(far) AS far FROM (
          SELECT rid, c, sum((x.x - m.x) * (x.x - m.x)) AS far FROM x JOIN c{r} m USING (d) GROUP BY rid, c) GROUP BY rid)""")
        if r < rounds:
            ctes.append(f"""c{r + 1} AS MATERIALIZED (SELECT c, d, coalesce(m, x) AS x FROM c{r} LEFT JOIN (
              SELECT c, d, (sum(x.x) - ((sum(x.x) % count(*)) + count(*)) % count(*)) // count(*) AS m
              FROM x JOIN a{r} USING (rid) GROUP BY c, d) USING (c, d))""")
    return f"""WITH {", ".join(ctes)},
    sha AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
    SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(far AS BIGINT) AS distance,
           CAST(sum(far) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(far) OVER () AS BIGINT) AS inertia, centroid_sha256
    FROM a{rounds} JOIN kept USING (rid) JOIN sha USING (c)"""


_oracle("op12_centroid_planes", _centroid_sql())


@_query("op13_bit_sliced_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whitened on its 8 leading components, from the exact scatter matrix."""
    from sparkrisk.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))


@_query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline.py."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
