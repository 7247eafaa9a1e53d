import datetime as dt

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from checks.compare import session

BASE = 1704067200  # 2024-01-01 UTC
HOUR = 3600


@pytest.fixture(scope="session")
def spark():
    spark = session("4")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    yield spark
    spark.stop()


@pytest.fixture
def frame(spark):
    """frame(schema, rows): a DataFrame; a timestamp column takes seconds after 2024-01-01."""
    def build(schema, rows):
        struct = T._parse_datatype_string(schema)
        columns = list(zip(*rows)) if rows else [()] * len(struct.fields)
        arrays = {}
        for field, values in zip(struct.fields, columns):
            if isinstance(field.dataType, T.TimestampType):
                stamps = [None if v is None else dt.datetime.fromtimestamp(BASE + v, dt.timezone.utc) for v in values]
                arrays[field.name] = pa.array(stamps, pa.timestamp("us", tz="UTC"))
            else:
                arrays[field.name] = pa.array(list(values), {
                    T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(),
                    T.StringType: pa.string(), T.BooleanType: pa.bool_(), T.DateType: pa.date32(),
                }[type(field.dataType)])
        return spark.createDataFrame(pa.table(arrays), struct)
    return build


def rows_of(df, *cols):
    """Sorted tuples of the given columns, timestamps as seconds after 2024-01-01."""
    def plain(v):
        if isinstance(v, dt.datetime):
            return int(v.replace(tzinfo=dt.timezone.utc).timestamp()) - BASE
        return v
    found = [tuple(plain(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return sorted(found, key=lambda t: tuple((x is None, x) for x in t))
