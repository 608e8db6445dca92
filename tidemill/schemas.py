"""Record schemas.  Streams always read with an explicit schema."""

from pyspark.sql import types as T

from tidemill.fixed_values import POST_FIELDS


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


POST = _strings(*POST_FIELDS)
POST_INDUSTRY = T.StructType(
    [*POST.fields, T.StructField("sub_industry_id", T.ArrayType(T.StringType()))]
)
POST_RESULT = _strings(*POST_FIELDS, "sub_industry_id", "parent_id")

# epoch seconds in ``timestamp``
TIMED_RECORD = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("time", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)
COMMA_RECORD = T.StructType(TIMED_RECORD.fields[:3])

ENVELOPE = _strings("topic", "value")
MESSAGE = T.StructType(
    [
        *ENVELOPE.fields,
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

CELL_COLUMNS = ("rowkey", "family", "qualifier", "version", "value")
