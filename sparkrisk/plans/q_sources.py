"""Checked queries for scans, sinks and paged ingest.

Each query writes to a fresh folder under the shared checkpoint folder and reads back, so
the check covers the round trip.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrisk import fixtures as FX
from sparkrisk.plans import q_history as QH
from sparkrisk.plans.registry import query
from sparkrisk.plans.sql import CTE_HISTORY
from sparkrisk.schemas import ACTIVE_RAW, HISTORY, INSPECTIONS_RAW
from sparkrisk.session import shared_dir
from sparkrisk.sources import pages as PG
from sparkrisk.sources import tables as TB
from sparkrisk.streaming.ingest import ingest_stream

INS = f"WITH {FX.CTE_INSPECTIONS} "
PAGE_LIMIT = 5000

# Records as text (the API's form), except the numeric id.
TEXT_COLUMNS = ["property_id", "resultdttm", "issdttm", "resultdttm_raw", "state", "location", "licensecat",
                "descript", "city", "zip", "result", "violstatus", "viollevel"]
RECORD_SCHEMA = T.StructType([T.StructField("_id", T.LongType())] + [T.StructField(c, T.StringType()) for c in TEXT_COLUMNS])
TEXT_SQL = ", ".join(["_id"] + [f"CAST({c} AS VARCHAR) AS {c}" for c in TEXT_COLUMNS])
TYPED_SQL = ", ".join(
    ["_id"] + [c if c in ("resultdttm", "issdttm") else f"CAST({c} AS VARCHAR) AS {c}" for c in TEXT_COLUMNS]
)


def _name(prefix):
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _landed_pages(spark, sf_dir):
    path = shared_dir(spark, "pages")
    PG.write_pages(PG.as_api_records(FX.fx_inspections(spark, sf_dir)), path, PAGE_LIMIT)
    return path


@query("S1_empty_table", f"WITH {CTE_HISTORY} SELECT * FROM hist")
def s1_empty_table(spark, sf_dir):
    """Start from an empty table of the history schema, written to the catalog, and append the
    history to it."""
    name = _name("historic")
    TB.empty_table(spark, HISTORY, name, shared_dir(spark, "empty"))
    QH.history(spark, sf_dir).write.mode("append").format("parquet").insertInto(name)
    return spark.table(name)


EMPTY_TABLES = (("inspections", INSPECTIONS_RAW, "fx_inspections"), ("active", ACTIVE_RAW, "fx_establishments"))


def _empty_tables_sql():
    rows = ", ".join(f"('{t}', {i}, '{f.name}', '{f.dataType.simpleString()}', (SELECT count(*) FROM {src}))"
                     for t, schema, src in EMPTY_TABLES for i, f in enumerate(schema.fields))
    return (f"WITH {FX.CTE_INSPECTIONS}, {FX.CTE_ESTABLISHMENTS} "
            f"SELECT * FROM (VALUES {rows}) t(\"table\", ordinal, \"column\", type, rows)")


@query("S1_empty_raw_tables", _empty_tables_sql())
def s1_empty_raw_tables(spark, sf_dir):
    """The 27- and 14-column record tables, written empty to the catalog, then filled: (table,
    ordinal, column, type, rows) as the catalog and the filled tables have them."""
    records = {"inspections": FX.fx_inspections(spark, sf_dir), "active": FX.fx_establishments(spark, sf_dir)}
    out = None
    for table, schema, _ in EMPTY_TABLES:
        name = _name(table)
        TB.empty_table(spark, schema, name, shared_dir(spark, "empty"))
        PG.conform(records[table], schema).write.mode("append").format("parquet").insertInto(name)
        fields = [F.struct(F.lit(table).alias("table"), F.lit(i).alias("ordinal"), F.lit(f.name).alias("column"),
                           F.lit(f.dataType.simpleString()).alias("type")) for i, f in enumerate(spark.table(name).schema.fields)]
        rows = spark.table(name).agg(F.count(F.lit(1)).alias("rows")).select(F.inline(F.array(*fields)), "rows")
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "S2_page_plan",
    INS + f"SELECT CAST(p AS BIGINT) AS page, CAST(p * {PAGE_LIMIT} AS BIGINT) AS offset, {PAGE_LIMIT} AS limit "
    f"FROM (SELECT unnest(range(0, CAST(ceil(count(*) / {PAGE_LIMIT}.0) AS BIGINT))) AS p FROM fx_inspections)",
)
def s2_page_plan(spark, sf_dir):
    return PG.page_plan(FX.fx_inspections(spark, sf_dir), PAGE_LIMIT)


@query("S3_read_pages", INS + f"SELECT {TEXT_SQL} FROM fx_inspections")
def s3_read_pages(spark, sf_dir):
    return PG.read_pages(spark, _landed_pages(spark, sf_dir), RECORD_SCHEMA)


@query("S3_paged_api", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderpriority FROM orders")
def s3_paged_api(spark, sf_dir):
    """All orders landed as page files in the shared folder and fetched page by page on executors."""
    folder = shared_dir(spark, "page-files")
    if not folder.startswith(("/", "file:")):
        raise RuntimeError("S3_paged_api writes page files: spark.checkpoint.dir must be a folder that all executors mount")
    folder = "/" + folder.removeprefix("file:").lstrip("/")
    fields = ["o_orderkey", "o_custkey", "o_orderpriority"]
    orders = FX.table(spark, sf_dir, "orders").select(*fields)
    url = PG.write_page_files(orders, folder, PAGE_LIMIT)
    PG.register_paged_api(spark)
    schema = ", ".join(f"{c} string" for c in fields)
    return spark.read.format("paged_api").schema(schema).options(url=url, total=str(orders.count()), limit=str(PAGE_LIMIT)).load()


@query("S4_conform", INS + f"SELECT CAST(_id AS INTEGER) AS _id, {', '.join(TEXT_COLUMNS[:4])}, "
       "CAST(NULL AS VARCHAR) AS businessname FROM (SELECT " + TEXT_SQL + " FROM fx_inspections)")
def s4_conform(spark, sf_dir):
    target = T.StructType.fromDDL(
        "_id INT, property_id STRING, resultdttm STRING, issdttm STRING, resultdttm_raw STRING, businessname STRING"
    )
    return PG.conform(PG.read_pages(spark, _landed_pages(spark, sf_dir), RECORD_SCHEMA), target)


@query("S5_read_table", f"WITH {CTE_HISTORY} SELECT * FROM hist")
def s5_read_table(spark, sf_dir):
    path = TB.write_parquet(QH.history(spark, sf_dir), shared_dir(spark, "history"))
    return TB.read_table(spark, path)


@query("S6_scan_table", f"WITH {CTE_HISTORY} SELECT * FROM hist")
def s6_scan_table(spark, sf_dir):
    name = TB.write_table(QH.history(spark, sf_dir), _name("inspections_historic"), shared_dir(spark, "history"))
    return TB.scan_table(spark, name)


@query("S7_read_csv", f"WITH {CTE_HISTORY} SELECT * FROM hist")
def s7_read_csv(spark, sf_dir):
    path = TB.write_csv(QH.history(spark, sf_dir), shared_dir(spark, "train_data"))
    return TB.read_csv(spark, path, sep=";", schema=HISTORY)


@query("S8_write_table", f"WITH {CTE_HISTORY} SELECT * FROM hist")
def s8_write_table(spark, sf_dir):
    # File sizes are left to adaptive execution: a single output file would be one task
    # writing the whole table.
    name = TB.write_table(QH.history(spark, sf_dir), _name("inspections_historic"), shared_dir(spark, "history"))
    return spark.table(name)


@query("S8_replace_table", f"WITH {CTE_HISTORY} SELECT * FROM hist")
def s8_replace_table(spark, sf_dir):
    """A table replaced by rows read from itself: its history, written with all counts one too high,
    is mended in place."""
    name = _name("inspections_historic")
    path = shared_dir(spark, "history")
    wrong = QH.history(spark, sf_dir).withColumn("inspections_so_far", F.col("inspections_so_far") + 1)
    TB.replace_table(wrong, name, path)
    TB.replace_table(spark.table(name).withColumn("inspections_so_far", F.col("inspections_so_far") - 1), name, path)
    return spark.table(name)


@query("S9_managed_table", f"WITH {CTE_HISTORY} SELECT * FROM hist")
def s9_managed_table(spark, sf_dir):
    db = _name("sparkrisk")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{shared_dir(spark, 'warehouse')}'")
    name = TB.write_table(QH.history(spark, sf_dir), f"{db}.predict")
    return spark.table(name)


@query("S10_write_csv", INS + f"SELECT {TEXT_SQL} FROM fx_inspections")
def s10_write_csv(spark, sf_dir):
    # An entity's records are alike: they move together.
    path = TB.write_csv(PG.as_api_records(FX.fx_inspections(spark, sf_dir)), shared_dir(spark, "csv"), by=["property_id"])
    return TB.read_csv(spark, path, schema=RECORD_SCHEMA)


# Texts that break careless delimited files, dealt over the documents.
HOSTILE = ["a\nb", 'q"x', "back\\", "", None, " ", "x;y", 'e\\"z', "cr\rx", "\\N", "\\n", '"', "#x"]
_HOSTILE_SQL = " ".join(
    f"WHEN {i} THEN " + ("NULL" if t is None else " || ".join(
        ["''", *(f"chr({ord(ch)})" if ch in "\r\n\\" else f"'{ch}'" for ch in t)])) for i, t in enumerate(HOSTILE))


@query("S10_csv_hostile_texts", "SELECT doc_id, text, lang, source, n_chars, "
       f"CASE doc_id % {len(HOSTILE)} {_HOSTILE_SQL} END AS odd FROM documents")
def s10_csv_hostile_texts(spark, sf_dir):
    """All documents, with their line breaks, and fields that need care, written and read back."""
    docs = FX.table(spark, sf_dir, "documents")
    odd = F.array(*[F.lit(t).cast("string") for t in HOSTILE])[(F.col("doc_id") % len(HOSTILE)).cast("int")]
    docs = docs.withColumn("odd", odd)
    return TB.read_csv(spark, TB.write_csv(docs, shared_dir(spark, "csv")), schema=docs.schema)


_BAD_LINE = "CASE o_orderkey % 10 WHEN 3 THEN 'x' || o_orderkey || ';' || o_custkey WHEN 7 THEN CAST(o_orderkey AS {t}) ELSE o_orderkey || ';' || o_custkey END"


@query("S7_csv_bad_records", "SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR) AS record FROM orders WHERE o_orderkey % 10 NOT IN (3, 7) "
       f"UNION ALL SELECT NULL, NULL, {_BAD_LINE.format(t='VARCHAR')} FROM orders WHERE o_orderkey % 10 IN (3, 7)")
def s7_csv_bad_records(spark, sf_dir):
    """Order lines of which some have a wrong key or a missing field: rows and bad records apart."""
    path = shared_dir(spark, "lines")
    FX.table(spark, sf_dir, "orders").selectExpr(_BAD_LINE.format(t="STRING") + " AS value").write.text(path)
    schema = T.StructType.fromDDL("o_orderkey BIGINT, o_custkey BIGINT")
    rows, bad = TB.read_csv(spark, path, schema=schema, header=False, bad="apart")
    return rows.unionByName(bad, allowMissingColumns=True)


@query("S11_file_count", INS + f"SELECT {TEXT_SQL} FROM fx_inspections")
def s11_file_count(spark, sf_dir):
    path = TB.write_parquet(PG.as_api_records(FX.fx_inspections(spark, sf_dir)), shared_dir(spark, "files"))
    return TB.read_table(spark, path)


@query("C1_ingest", INS + f"SELECT {TYPED_SQL} FROM fx_inspections")
def c1_ingest(spark, sf_dir):
    pages = _landed_pages(spark, sf_dir)
    return PG.ingest(spark, pages, RECORD_SCHEMA, ["resultdttm", "issdttm"], _name("inspections"),
                     shared_dir(spark, "inspections"), by=["property_id"])  # an entity's records are alike


@query("C1_ingest_stream", INS + f"SELECT {TYPED_SQL} FROM fx_inspections")
def c1_ingest_stream(spark, sf_dir):
    pages = _landed_pages(spark, sf_dir)
    sink = shared_dir(spark, "inspections-stream")
    ingest_stream(spark, pages, RECORD_SCHEMA, ["resultdttm", "issdttm"], sink)
    return TB.read_table(spark, sink)


def _conform_sql(schema, source_cols, table):
    cols = []
    have = {c.lower(): c for c in source_cols}
    sql_types = {"int": "INTEGER", "string": "VARCHAR"}
    for f in schema.fields:
        t = sql_types[f.dataType.simpleString()]
        src = have.get(f.name.lower())
        cols.append(f"TRY_CAST({src} AS {t}) AS {f.name}" if src else f"CAST(NULL AS {t}) AS {f.name}")
    return f"SELECT {', '.join(cols)} FROM {table}"


@query(
    "S4_conform_inspection_schema",
    INS + _conform_sql(INSPECTIONS_RAW, ["_id", *TEXT_COLUMNS], f"(SELECT {TEXT_SQL} FROM fx_inspections)"),
)
def s4_conform_inspection_schema(spark, sf_dir):
    """Landed pages read into the 27-column inspection layout: absent keys null, extra keys
    (here ``resultdttm_raw``) dropped, ``_id`` narrowed to int."""
    return PG.conform(PG.read_pages(spark, _landed_pages(spark, sf_dir), RECORD_SCHEMA), INSPECTIONS_RAW)


@query(
    "S4_conform_active_schema",
    f"WITH {FX.CTE_ESTABLISHMENTS} "
    + _conform_sql(ACTIVE_RAW, ["_id", "Property_ID", "BusinessName", "State", "LICENSECAT", "DESCRIPT", "CITY", "ZIP"],
                   "fx_establishments"),
)
def s4_conform_active_schema(spark, sf_dir):
    """Entity records in the 14-column active-establishment layout (names matched without
    regard to case)."""
    return PG.conform(FX.fx_establishments(spark, sf_dir), ACTIVE_RAW)
