"""Paged record source.

The source API returns pages ``{result: {total, records: [...]}}`` for ``limit``/``offset``.
Here pages are plain files (JSON, one envelope per line or per file), read with a fixed
envelope schema, so there is no inference pass and each file is split across tasks. The
``paged_api`` data source fetches pages on executors, one partition per page, instead of a
driver loop.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrisk.functions.scalar import parse_time
from sparkrisk.schemas import TIME_FORMAT, as_text_schema, page_envelope
from sparkrisk.session import materialize, shuffles_dropped, stage_scope

# Records of one file of pages: some 100 MB of JSON and a tenth of it in the file.
FILE_RECORDS = 250_000


def page_plan(df_or_total, limit: int, spark: SparkSession | None = None) -> DataFrame:
    """One row per page (page, offset, limit): ceil(total / limit) pages. ``total`` is a
    number or the row count of a DataFrame.

    Only the count (one number) reaches the driver; the page rows come from a distributed
    ``range``, so the plan is spread over tasks however many pages there are.
    """
    if isinstance(df_or_total, DataFrame):
        spark = df_or_total.sparkSession
        total = df_or_total.count()
    else:
        total = int(df_or_total)
    n = -(-total // limit)
    pages = spark.range(0, n).withColumnRenamed("id", "page")
    return pages.select("page", (F.col("page") * limit).alias("offset"), F.lit(limit).alias("limit"))


def as_api_records(df: DataFrame, keep: Sequence[str] = ("_id",)) -> DataFrame:
    """Records as the API sends them: text values, except the numeric ``keep`` columns."""
    return df.select(*[F.col(c) if c in keep else F.col(c).cast("string").alias(c) for c in df.columns])


def write_pages(df: DataFrame, path: str, limit: int) -> str:
    """Land ``df`` as page envelopes of at most ``limit`` records (JSON lines).

    The records are written once as a stage, and each task of its scan fills one page after the other
    in the order of its rows: it holds a page, whatever the size of the input, and nothing is
    shuffled. No global numbering or ordering is needed; a page never mixes tasks and holds at most
    ``limit`` records. Pages repeat every field name in every record, so the files are gzip, of
    ``FILE_RECORDS`` records or one page, since such a file is read by one task; the stage goes once
    the pages are written.
    """
    if limit < 1:
        raise ValueError("limit must be at least 1")
    with stage_scope(df.sparkSession):
        with shuffles_dropped(df.sparkSession):
            df = materialize(df, compression="zstd")
        return _fill_pages(df, path, limit)


def _fill_pages(df: DataFrame, path: str, limit: int) -> str:
    total = df.count()

    def fill(batches):
        import pyarrow as pa

        def page(parts):
            records = pa.concat_arrays(parts)
            records = pa.ListArray.from_arrays(pa.array([0, len(records)], pa.int32()), records)
            result = pa.StructArray.from_arrays([pa.array([total], pa.int64()), records], names=["total", "records"])
            return pa.RecordBatch.from_arrays([result], names=["result"])

        held, n = [], 0
        for batch in batches:
            rows, at = batch.to_struct_array(), 0
            while at < len(rows):
                part = rows.slice(at, limit - n)
                held.append(part)
                at, n = at + len(part), n + len(part)
                if n == limit:
                    yield page(held)
                    held, n = [], 0
        if held:
            yield page(held)

    pages = df.mapInArrow(fill, page_envelope(df.schema)).write.mode("overwrite")
    pages.option("maxRecordsPerFile", max(1, FILE_RECORDS // limit)).json(path, compression="gzip")
    return path


def write_page_files(df: DataFrame, folder: str, limit: int) -> str:
    """Land ``df`` as one file a page, ``page-<n>.json``, every page but the last with exactly ``limit``
    records: the form that ``paged_api`` fetches. Returns the URL template.

    Row numbers come from the row counts of the stage's scan tasks (one number a task on the driver)
    and the ids inside a task. Records meet by page, and a task writes its pages one after the other:
    it holds one. ``folder`` is a path that all executors mount.
    A page is written to a name of its own and then renamed: a task that runs twice leaves one whole file.
    """
    if limit < 1:
        raise ValueError("limit must be at least 1")
    df = materialize(df)
    total = df.count()
    if not total:
        raise ValueError("no records: there is no page to write")
    ids = df.withColumn("__id", F.monotonically_increasing_id())
    task, inside = F.shiftright("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    sizes = {r.task: r.n for r in ids.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, start = [], 0
    for t in sorted(sizes):
        starts += [F.lit(t), F.lit(start)]
        start += sizes[t]
    page = F.floor((F.create_map(*starts)[task] + inside) / F.lit(limit))
    rec = F.to_json(F.struct(*[F.col(c) for c in df.columns])).cast("binary")
    pages = ids.select(page.alias("page"), "__id", rec.alias("r")).repartition("page").sortWithinPartitions("page", "__id")

    def write(batches):
        import os
        import uuid

        import pyarrow as pa

        os.makedirs(folder, exist_ok=True)

        def whole(n, records):
            part = f"{folder}/.part-{uuid.uuid4().hex}"
            with open(part, "wb") as f:
                f.write(b'{"result":{"total":%d,"records":[' % total + b",".join(records) + b"]}}")
            os.replace(part, f"{folder}/page-{n}.json")
            return pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["page"])

        last, held = None, []
        for batch in batches:
            for n, record in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if n != last and held:
                    yield whole(last, held)
                    held = []
                last = n
                held.append(record)
        if held:
            yield whole(last, held)

    pages.select("page", "r").mapInArrow(write, "page long").write.format("noop").mode("overwrite").save()
    return f"file://{folder}/page-{{page}}.json"


def read_pages(spark: SparkSession, path: str, record_schema: T.StructType, multiline: bool = False) -> DataFrame:
    """All records of all page files, one row per record, pages appended, in the fields of
    ``record_schema``.

    A file that is not a whole page fails the read (no record is lost without notice). Records
    are read as text and then cast: keys missing from a record read as null, unknown keys are
    dropped, a JSON number read into a text field keeps its text. A value that does not convert
    becomes null in ``conform`` by its definition; here it fails the read too.
    """
    reader = spark.read.schema(page_envelope(as_text_schema(record_schema))).option("mode", "FAILFAST")
    env = reader.option("multiLine", str(multiline).lower()).json(path)
    return _strict(env.select(F.inline("result.records")), record_schema)


def _strict(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Text fields cast to ``schema``; text that does not convert is an error naming the field."""
    cols = []
    for f in schema.fields:
        text = F.col(f.name)
        value = text.try_cast(f.dataType)
        bad = F.raise_error(F.concat(F.lit(f"{f.name}: cannot read "), text)).cast(f.dataType)
        cols.append((text if isinstance(f.dataType, T.StringType) else F.when(text.isNotNull() & value.isNull(), bad).otherwise(value)).alias(f.name))
    return records.select(*cols)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the fields of ``schema`` in its order: absent ones null, others cast
    (values that do not convert become null), extra columns dropped."""
    have = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = have.get(f.name.lower())
        col = F.col(src).try_cast(f.dataType) if src is not None else F.lit(None).cast(f.dataType)
        cols.append(col.alias(f.name))
    return df.select(*cols)


def parse_times(df: DataFrame, time_cols: Sequence[str] | Mapping[str, str], fmt: str = TIME_FORMAT) -> DataFrame:
    """F5 at ingest: ``[col, ...]`` parses each column from itself; ``{out: src}`` parses
    ``src`` into ``out``."""
    mapping = dict(time_cols) if isinstance(time_cols, Mapping) else {c: c for c in time_cols}
    return df.withColumns({out: parse_time(src, fmt) for out, src in mapping.items()})


def ingest(
    spark: SparkSession,
    pages_path: str,
    record_schema: T.StructType,
    time_cols: Sequence[str] | Mapping[str, str],
    table: str,
    path: str,
    files: int | None = None,
    multiline: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Pages to a typed table: read (S3), conform (S4), parse times (F5), size the
    output files (S11) and save as an external table (S8). Returns the table scan.

    ``files=None`` leaves file sizes to adaptive execution; a fixed count caps the write at
    that many tasks, so use it only for small tables. Records that share the ``by`` columns move
    to the writing tasks together."""
    from sparkrisk.sources.tables import write_table

    records = conform(read_pages(spark, pages_path, record_schema, multiline), record_schema)
    with shuffles_dropped(spark):
        write_table(parse_times(records, time_cols), table, path, files=files, by=by)
    return spark.table(table)


# --- executor-side paging -------------------------------------------------------------

try:  # Python data sources need pyspark >= 4.0
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    def _as_text(value) -> str | None:
        """A JSON value as Spark gives it in a text field: text as it is, else its (compact) JSON."""
        if value is None or isinstance(value, str):
            return value
        return json.dumps(value, separators=(",", ":"), ensure_ascii=False)

    class _Pages(InputPartition):
        def __init__(self, first: int, last: int):
            self.first, self.last = first, last  # page numbers, last exclusive

    class PagedApiReader(DataSourceReader):
        def __init__(self, schema: T.StructType, options: Mapping[str, str]):
            self.schema = schema
            self.url = options["url"]
            self.limit = int(options.get("limit", "5000"))
            self.total = int(options["total"])
            self.timeout = float(options.get("timeout", "60"))
            self.per_task = max(1, int(options.get("pages_per_partition", "1")))
            self.retries = int(options.get("retries", "3"))
            self.wait = float(options.get("wait", "1"))

        def partitions(self):
            n = -(-self.total // self.limit)
            return [_Pages(p, min(p + self.per_task, n)) for p in range(0, n, self.per_task)]

        def fetch(self, page: int) -> list[dict]:
            """The records of a page; a failed or short answer is asked for again, then an error."""
            import time
            from urllib.request import urlopen

            url = self.url.format(page=page, offset=page * self.limit, limit=self.limit)
            expected = min(self.limit, self.total - page * self.limit)
            for attempt in range(self.retries + 1):
                try:
                    with urlopen(url, timeout=self.timeout) as resp:  # noqa: S310 - the caller names the endpoint
                        records = json.load(resp)["result"]["records"]
                    if len(records) < expected:
                        raise ValueError(f"{len(records)} records where {expected} are due")
                    return records
                except (OSError, ValueError, KeyError, TypeError) as e:
                    failure = e
                if attempt < self.retries:
                    time.sleep(self.wait * 2**attempt)
            raise RuntimeError(f"page {page} ({url}): {failure}")

        def read(self, partition: _Pages) -> Iterator[tuple]:
            names = [f.name for f in self.schema.fields]
            for page in range(partition.first, partition.last):
                for rec in self.fetch(page):
                    yield tuple(_as_text(rec.get(n)) for n in names)

    class PagedApiDataSource(DataSource):
        """``spark.read.format("paged_api").schema(text_schema).options(url=..., total=...,
        limit=...)``: pages fetched on executors, ``pages_per_partition`` contiguous pages per
        task (default 1); ``url`` is a template with ``{page}``, ``{offset}`` and ``{limit}``.
        A page that fails, or holds fewer records than ``total`` says, is fetched ``retries`` times
        more (default 3, after ``wait`` seconds, doubled each time); then the read fails. Every field is read as text; conform afterwards."""

        @classmethod
        def name(cls):
            return "paged_api"

        def schema(self):
            raise ValueError("paged_api needs an explicit schema")

        def reader(self, schema):
            return PagedApiReader(schema, self.options)

    def register_paged_api(spark: SparkSession) -> None:
        spark.dataSource.register(PagedApiDataSource)

except ImportError:  # pragma: no cover
    def register_paged_api(spark: SparkSession) -> None:
        raise RuntimeError("Python data sources need pyspark 4")
