"""Table scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrisk.session import materialize


def empty_table(spark: SparkSession, schema: T.StructType, name: str | None = None, path: str | None = None) -> DataFrame:
    """An empty DataFrame with ``schema``; written as a table when ``name`` is given."""
    df = spark.createDataFrame([], schema)
    if name is not None:
        write_table(df, name, path)
        return spark.table(name)
    return df


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan by path (filters and columns are pushed into the reader)."""
    return spark.read.parquet(path)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table scan."""
    return spark.table(name)


# Delimited text. A null is written as nothing and an empty text as "", and both read back as they
# were; quotes are doubled, white space is kept. Line breaks and backslashes of a text are written
# as \\n, \\r and \\\\, so a record is always one line and the scan of a large file can be split. The
# folder says so in ``_dialect`` (a name that scans skip); files without it are read as they are.
_CSV = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "quote": '"', "escape": '"'}
_NULL = "\\N"  # never the written form of a text, whose backslashes are doubled
_DIALECT = "_dialect"
BAD = "__bad"


def _is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType)


def _escaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def _unescaped(c: Column) -> Column:
    # Doubled backslashes are cut out first, from left to right; what is left of one is a break.
    part = lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    return F.when(F.contains(c, F.lit("\\")), F.array_join(F.transform(F.split(c, r"\\\\"), part), "\\")).otherwise(c)


def _dialect(spark: SparkSession, path: str, write: bool = False) -> bool:
    """Whether the folder holds escaped texts; ``write`` says so."""
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, _DIALECT)
    fs = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if write:
        fs.create(file, True).close()
    return write or fs.exists(file)


def read_csv(spark: SparkSession, path: str, sep: str = ";", schema: T.StructType | None = None, header: bool = True,
             bad: str = "fail", multi_line: bool = False):
    """Delimited text with a header. Give ``schema`` in production: inference reads the data twice.

    A record that does not fit the schema (wrong number of fields, a value of another type) fails the
    read. With ``bad="apart"`` the result is (rows, bad records): the records are parsed once into a
    stage, and the second frame holds the lines that did not fit, as they stand in the file.
    ``multi_line`` reads foreign files whose quoted fields hold line breaks; those cannot be split."""
    if bad not in ("fail", "apart") or (bad == "apart" and schema is None):
        raise ValueError("bad is 'fail' or, with a schema, 'apart'")
    options = {**_CSV, "header": str(header).lower(), "sep": sep, "nullValue": _NULL, "multiLine": str(multi_line).lower(),
               # All fields are parsed, whatever a query needs: bad records are found in any of them.
               "mode": "FAILFAST" if bad == "fail" else "PERMISSIVE", "columnPruning": "false"}
    reader = spark.read.options(**options)
    if schema is None:
        rows = reader.option("inferSchema", "true").csv(path)
    elif bad == "fail":
        rows = reader.schema(schema).csv(path)
    else:
        whole = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
        rows = materialize(reader.schema(whole).option("columnNameOfCorruptRecord", BAD).csv(path))
    if _dialect(spark, path):
        texts = {f.name: _unescaped(F.col(f"`{f.name}`")) for f in rows.schema.fields if _is_text(f) and f.name != BAD}
        rows = rows.withColumns(texts) if texts else rows
    if bad == "fail":
        return rows
    return rows.filter(F.col(BAD).isNull()).drop(BAD), rows.filter(F.col(BAD).isNotNull()).select(F.col(BAD).alias("record"))


def _files(df: DataFrame, files: int | None, by: Sequence[str] = ()) -> DataFrame:
    """Output files. ``None`` (the default) rebalances: adaptive execution splits large
    partitions and merges small ones to its advisory size, so the file count follows the data. A
    number gives exactly that many files by a round-robin exchange, which is also the number of
    writing tasks: only for outputs known to be small.

    Without ``by`` the rows are dealt one by one, so like rows part and the shuffle compresses badly. With
    it, rows that share these columns move together, in the order they came; adaptive execution splits the
    partition of a frequent value."""
    return df.hint("rebalance", *by) if files is None else df.repartition(files)


def write_table(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite", files: int | None = None,
                by: Sequence[str] = ()) -> str:
    """Save as a catalog table; external (parquet at ``path``) when a path is given,
    managed otherwise; ``by`` as in ``_files``. Returns the table name."""
    w = _files(df, files, by).write.mode(mode).format("parquet")
    if path is not None:
        w = w.option("path", path)
    w.saveAsTable(name)
    return name


def replace_table(df: DataFrame, name: str, path: str, files: int | None = None, keep: int = 1) -> str:
    """S8, all or nothing: ``df`` is written to a fresh version folder under ``path``, and only then
    does the table ``name`` point there (one change in the catalog). A write that fails or is
    killed leaves the table with its old rows; ``df`` may read the table itself. Of the former versions
    the newest ``keep`` stay for readers that have begun; older ones are deleted, and so are folders of
    killed writes. One writer at a time. Returns the table name."""
    spark = df.sparkSession
    if keep < 1:  # df itself may be a reader of the version before
        raise ValueError("keep at least one former version")
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(root)] if fs.exists(root) else []
    versions = {p.getName(): p for p in found if p.getName().startswith("version-")}
    number = max((int(v.split("-")[1]) for v in versions), default=0) + 1
    target = f"{path.rstrip('/')}/version-{number:06d}"
    write_parquet(df, target, files, mode="errorifexists")
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{target}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=target, source="parquet")
    whole = sorted(v for v, p in versions.items() if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))
    for v, p in versions.items():
        if v not in whole[-keep:]:
            fs.delete(p, True)
    return name


def write_csv(df: DataFrame, path: str, sep: str = ";", files: int | None = None, mode: str = "overwrite",
              by: Sequence[str] = ()) -> str:
    """Delimited text with a header, in the form that ``read_csv`` reads back exactly. ``by``: see ``_files``."""
    spark = df.sparkSession
    if mode == "append" and not _dialect(spark, path):
        raise ValueError(f"{path} has files that were written in another form")
    texts = {f.name: _escaped(F.col(f"`{f.name}`")) for f in df.schema.fields if _is_text(f)}
    out = df.withColumns(texts) if texts else df
    # A record of one column must not be an empty or blank line: readers skip those.
    alone = {"quoteAll": "true", "nullValue": _NULL} if len(df.columns) == 1 else {}
    _files(out, files, by).write.mode(mode).options(header="true", sep=sep, **_CSV, **alone).csv(path)
    _dialect(spark, path, write=True)
    return path


def write_parquet(df: DataFrame, path: str, files: int | None = None, mode: str = "overwrite") -> str:
    _files(df, files).write.mode(mode).parquet(path)
    return path
