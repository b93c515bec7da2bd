"""Bounded relational scan (S4) and external catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemart.operators.projections import apply_schema, schema_from_names
from tidemart.schemas import ODS_COLUMNS


def jdbc_options(
    url: str, table: str, user: str, password: str, driver: str = "com.mysql.cj.jdbc.Driver",
    split_on: str | None = None, bounds: tuple[str, str] | None = None, splits: int | None = None,
    fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC scan; with ``split_on`` the table is read by many tasks."""
    options = {
        "url": url, "dbtable": table, "user": user, "password": password, "driver": driver,
        "fetchsize": str(fetch_rows),
    }
    if split_on:
        if not bounds or not splits:
            raise ValueError("split_on needs bounds and splits")
        options |= {
            "partitionColumn": split_on, "lowerBound": bounds[0], "upperBound": bounds[1],
            "numPartitions": str(splits),
        }
    return options


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """One table as a batch."""
    return spark.read.format("jdbc").options(**options).load()


def ods_table(rows: DataFrame, table: str) -> DataFrame:
    """Columns and types of one of the copied tables, from any relational rows."""
    return apply_schema(rows, schema_from_names(ODS_COLUMNS[table]))


def hive_catalog(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Session with an external metastore."""
    return builder.enableHiveSupport()


def lake_catalog(
    builder: SparkSession.Builder, name: str, implementation: str, warehouse: str, endpoint: str
) -> SparkSession.Builder:
    """Session with a lake catalog on object storage; its jars must be on the class path."""
    return (
        builder.config(f"spark.sql.catalog.{name}", implementation)
        .config(f"spark.sql.catalog.{name}.warehouse", warehouse)
        .config("spark.hadoop.fs.s3a.endpoint", endpoint)
        .config("spark.hadoop.fs.s3a.path.style.access", "true")
    )
