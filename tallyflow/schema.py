"""Input and output schemas. Every input column is nullable; ``dt`` is the day partition."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {"int": T.IntegerType(), "bigint": T.LongType(), "string": T.StringType()}


def _schema(ddl: str) -> T.StructType:
    columns = [c.split() for c in ddl.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])


BASIC_LOG = _schema("dateline bigint, clientip string, qid string, uid string, clientime string, dt string")
H5_LOG = _schema(
    "dateline bigint, clientip string, qid string, uid string, apptypeid string, clientime string, "
    "logtype string, urlto string, dt string"
)
H5_ACTIVE_LOG = _schema("dateline bigint, uid string, qid string, dt string")
APP_LOG = _schema(
    "dateline bigint, clientip string, appqid string, apptypeid string, clientime string, urlto string, dt string"
)
APP_ACTIVE_LOG = _schema("dateline bigint, uid string, qid string, softname string, softid string, dt string")
SDK_LIST = _schema("h5qid string")

H5_METRICS = _schema(
    "dt int, currenttime bigint, qid string, pv bigint, uv bigint, ip bigint, "
    "incr_pv bigint, incr_uv bigint, incr_ip bigint, activecnt bigint, incr_activecnt bigint"
)
APP_METRICS = _schema(
    "dt int, logtime bigint, apptypeid string, qid string, pv bigint, uv bigint, ip bigint, "
    "incr_pv bigint, incr_uv bigint, incr_ip bigint, currenttime string"
)

SLOT_COUNTS = _schema("dt string, upto bigint, qid string, pv bigint, uv bigint")

H5_KEYS = ["dt", "currenttime", "qid"]
APP_KEYS = ["dt", "logtime", "apptypeid", "qid", "currenttime"]
# partition columns of a metrics table: the day and the tick
H5_SLICE = ["dt", "currenttime"]
APP_SLICE = ["dt", "logtime"]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in its order, cast to its types."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
