"""Warehouse tables: JDBC append, managed prediction table, bulk load."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidestream.schemas import PREDICTION_COLUMNS

log = logging.getLogger(__name__)

# Warehouse tables and the metrics that go to them.
WAREHOUSE_TABLES = {
    "hourly": "hourly_clickstream_metrics",
    "products": "product_performance_metrics",
    "categories": "category_performance_metrics",
}
PREDICTIONS_TABLE = "ml_purchase_predictions"


def jdbc_options(
    url: str, table: str, user: str, password: str, driver: str, connections: int = 16
) -> dict[str, str]:
    """Writer options; `connections` bounds the sessions opened on the warehouse."""
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "numPartitions": str(connections),
        "batchsize": "10000",
    }


def flatten_arrays(df: DataFrame) -> DataFrame:
    """Text arrays as comma-separated text, as JDBC has no array type."""
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({c: F.concat_ws(",", c) for c in arrays}) if arrays else df


def write_jdbc(df: DataFrame, options: Mapping[str, str], mode: str = "append") -> None:
    flatten_arrays(df).write.format("jdbc").options(**options).mode(mode).save()


def swap_statements(target: str, staging: str, columns: Sequence[str], days: Sequence[dt.date], day_column: str = "event_date") -> list[str]:
    """SQL that puts the rows of a staging table in place of a target's rows of some days."""
    names = ", ".join(columns)
    dates = ", ".join(f"DATE '{day.isoformat()}'" for day in days)
    return [
        f"DELETE FROM {target} WHERE {day_column} IN ({dates})",
        f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging}",
    ]


def run_statements(spark: SparkSession, connection: Mapping[str, str], statements: Sequence[str]) -> None:
    """Statements in one transaction of the warehouse, from the driver."""
    jvm = spark._jvm
    jvm.java.lang.Class.forName(connection["driver"])
    opened = jvm.java.sql.DriverManager.getConnection(connection["url"], connection["user"], connection["password"])
    try:
        opened.setAutoCommit(False)
        try:
            for text in statements:
                statement = opened.createStatement()
                statement.executeUpdate(text)
                statement.close()
            opened.commit()
        except Exception:
            opened.rollback()
            raise
    finally:
        opened.close()


def replace_days_jdbc(df: DataFrame, connection: Mapping[str, str], days: Sequence[dt.date]) -> None:
    """Replace some days of the table named in `connection`, which exists, by the rows of `df`.

    The rows go to a staging table, written over at every load; the swap is one transaction. So a load that
    fails changes nothing, and one that is repeated changes nothing more.
    """
    if not days:
        return
    target = connection["dbtable"]
    staging = f"{target}_staging"
    write_jdbc(df, {**connection, "dbtable": staging}, "overwrite")
    run_statements(df.sparkSession, connection, swap_statements(target, staging, df.columns, days))


def write_metrics_jdbc(metrics: Mapping[str, DataFrame], connection: Mapping[str, str]) -> None:
    """The hourly, product and category metrics to their warehouse tables."""
    for name, target in WAREHOUSE_TABLES.items():
        write_jdbc(metrics[name], {**connection, "dbtable": target})


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Let INSERT OVERWRITE replace only the partitions it fills."""
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def create_predictions_table(spark: SparkSession, table: str = PREDICTIONS_TABLE) -> None:
    """The prediction table, partitioned by day."""
    columns = ", ".join(f"{name} {kind}" for name, kind in PREDICTION_COLUMNS.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY (event_date)"
    )


def load_predictions(export: DataFrame, table: str = PREDICTIONS_TABLE) -> None:
    """Replace the days present in `export`, each file sorted by hour.

    Sorted files keep min/max statistics tight, so a filter on the hour skips row groups.
    """
    spark = export.sparkSession
    target = spark.table(table).columns
    rows = (
        export.select(*target)
        .hint("rebalance", "event_date")
        .sortWithinPartitions("event_date", "event_hour")
    )
    with dynamic_overwrite(spark):
        rows.write.insertInto(table, overwrite=True)


def save_predictions(
    export: DataFrame, jdbc: Mapping[str, str] | None = None, table: str = PREDICTIONS_TABLE
) -> str:
    """To the warehouse if one is reachable, else to a managed table; returns which.

    Only a failure to reach the warehouse's table leads to the managed one. An error in the
    predictions themselves, or half-way through the write, is raised: the rows already sent
    would else be in both places.
    """
    if jdbc is not None:
        try:
            spark = export.sparkSession
            spark.read.format("jdbc").options(**jdbc).load().schema  # opens a connection, reads no row
        except Exception as error:  # the driver's own Java errors arrive as Py4JJavaError
            if not isinstance(error, (PySparkException, OSError)) and type(error).__name__ != "Py4JJavaError":
                raise
            log.warning("the warehouse is not reachable, using the managed table: %s", error)
        else:
            write_jdbc(export, jdbc)
            return "jdbc"
    export.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(table)
    return "table"


def bulk_load(
    spark: SparkSession, path: str, table: str, columns: Sequence[str] | None = None
) -> None:
    """Load a lake folder into a partitioned table, replacing the partitions found in the folder.

    The folder must hold those partitions whole, as the metric tables do with their days. To
    load the batches of a raw table one by one, divide the target by batch_id as well; a target
    that is not partitioned would lose all other rows and is refused. Columns are matched by
    name, so partition folders and extra columns do no harm.
    """
    if not any(c.isPartition for c in spark.catalog.listColumns(table)):
        raise ValueError(f"{table} is not partitioned; loading would replace all its rows")
    rows = spark.read.parquet(path).select(*(columns or spark.table(table).columns))
    with dynamic_overwrite(spark):
        rows.write.insertInto(table, overwrite=True)
