"""Metrics to a database over Spark's JDBC writer.

Spark writes batches from the executors. It has no DELETE, so a slice is replaced on the database
side: load the staging table with ``replace_all`` and let the database move the slice, or publish
on files (``sinks.tables``) and append the published slice here.
"""

from pyspark.sql import DataFrame


def _writer(metrics: DataFrame, url: str, table: str, properties: dict[str, str]):
    return metrics.write.format("jdbc").options(url=url, dbtable=table, **properties)


def append(metrics: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    _writer(metrics, url, table, properties).mode("append").save()


def replace_all(metrics: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Truncate the table, keep its definition, and load ``metrics``."""
    _writer(metrics, url, table, properties).option("truncate", "true").mode("overwrite").save()
