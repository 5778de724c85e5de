"""Table schemas of the event-history data model.

Fixed values: the column names and types below are the record layouts the jobs read and
write; they must stay exactly as listed for downstream tables to line up.
"""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "STRING": T.StringType(),
    "DOUBLE": T.DoubleType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def _struct(spec: str) -> T.StructType:
    """``"name TYPE, ..."`` with the simple types above, all fields nullable. Built without a
    session, so the constants can be imported before Spark starts."""
    fields = []
    for item in spec.split(","):
        name, typ = item.split()
        fields.append(T.StructField(name, _TYPES[typ.upper()]))
    return T.StructType(fields)


# Inspection records, in source order; all nullable. The four *dttm columns
# arrive as text and are parsed to timestamps at ingest.
INSPECTIONS_RAW = _struct(
    "_id INT, businessname STRING, zip STRING, state STRING, resultdttm STRING, issdttm STRING, "
    "address STRING, licenseno STRING, property_id STRING, city STRING, violdttm STRING, "
    "violation STRING, licstatus STRING, result STRING, licensecat STRING, statusdate STRING, "
    "dbaname STRING, namefirst STRING, violstatus STRING, viollevel STRING, legalowner STRING, "
    "location STRING, expdttm STRING, comments STRING, violdesc STRING, descript STRING, "
    "namelast STRING"
)
INSPECTION_TIME_COLUMNS = ("resultdttm", "issdttm", "violdttm", "expdttm")

# Active establishment records, in source order; all nullable.
ACTIVE_RAW = _struct(
    "_id INT, LicenseAddDtTm STRING, State STRING, Location STRING, LICENSECAT STRING, "
    "Property_ID STRING, Address STRING, DBAName STRING, DESCRIPT STRING, LICSTATUS STRING, "
    "BusinessName STRING, dayphn STRING, CITY STRING, ZIP STRING"
)
ACTIVE_TIME_COLUMNS = ("LicenseAddDtTm",)

# The history table written by the history job.
HISTORY = _struct(
    "property_id STRING, resultdttm TIMESTAMP_NTZ, issdttm TIMESTAMP_NTZ, state STRING, "
    "location STRING, licensecat STRING, descript STRING, city STRING, zip STRING, "
    "inspections_so_far INT, last_inspections TIMESTAMP_NTZ, days_since_last_inspect INT, "
    "viol_fail BIGINT, viol_pass BIGINT, fail INT, last_viol_fail BIGINT, last_viol_pass BIGINT"
)

# The reference time-text format and default fills.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
FIRST_EVENT_FILL = 99999999
DEFAULT_CITY = "boston"
DEFAULT_ZIP = "02116"

# Categorical and numeric model inputs of the risk model.
CATEGORICAL_FEATURES = ("licensecat", "descript", "city", "zip")
NUMERIC_FEATURES = ("inspections_so_far", "days_since_last_inspect", "last_viol_fail", "last_viol_pass")


def page_envelope(record_schema: T.StructType) -> T.StructType:
    """One API page: ``{result: {total, records: [...]}}``."""
    return T.StructType(
        [
            T.StructField(
                "result",
                T.StructType(
                    [
                        T.StructField("total", T.LongType()),
                        T.StructField("records", T.ArrayType(record_schema)),
                    ]
                ),
            )
        ]
    )


def as_text_schema(schema: T.StructType) -> T.StructType:
    """Same field names, every field a string: how paged JSON records arrive."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
