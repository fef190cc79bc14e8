"""Small tables kept outside the logs, read over JDBC or from files."""

from pyspark.sql import DataFrame, SparkSession

from tallyflow.operators.rollups import channel_list


def read_jdbc_query(spark: SparkSession, url: str, query: str, properties: dict[str, str]) -> DataFrame:
    """Any query the database runs.

    One task reads it unless ``properties`` name a ``partitionColumn`` with its bounds and
    ``numPartitions``; give them for more than a small list.
    """
    return spark.read.format("jdbc").options(url=url, dbtable=f"({query}) q", **properties).load()


def read_sdk_list_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str]) -> DataFrame:
    return channel_list(read_jdbc_query(spark, url, f"select h5qid from {table}", properties))
