"""Dimension tables (S5, S9, S15, S16): rowkey plus one info family, in the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.latest import latest_per_key
from tidemart.schemas import CDC_TABLES, ROUTED_DIM


class DimStore:
    """Dimension tables of one database.

    Each write makes a new version folder and then points the table at it, so
    readers always see a whole version. A version already in place is not written
    again, so a repeated batch is harmless. The catalog must outlive the session
    (a metastore) for a store that does. Every name is qualified here, once, for
    create, drop, read and write.
    """

    def __init__(self, spark: SparkSession, root: str, database: str = "dims") -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def qualified(self, name: str) -> str:
        return f"{self.database}.`{name}`"

    # -- definition ------------------------------------------------------------

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{name}")

    def create(self, name: str, schema: str = ROUTED_DIM) -> None:
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.qualified(name)} ({schema}) USING parquet "
            f"LOCATION '{self.root}/{name}/empty'"
        )

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.qualified(name)}")

    def drop_all(self) -> None:
        """Drop the database and its tables; their files stay."""
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.database} CASCADE")

    def list_dims(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(self.database) if t.tableType != "TEMPORARY")

    # -- rows ---------------------------------------------------------------------

    def read(self, name: str) -> DataFrame:
        """All rows."""
        return self.spark.table(self.qualified(name))

    def scan(self, name: str, limit: int) -> DataFrame:
        return self.read(name).limit(limit)

    def get(self, name: str, rowkey: str) -> DataFrame:
        return self.read(name).filter(F.col("rowkey") == rowkey)

    def count(self, name: str) -> int:
        """A7."""
        return self.read(name).count()

    def write(self, name: str, rows: DataFrame, version: str | int) -> None:
        """Put rows by row key; ``rows`` holds one row per key."""
        if self._published(name, version):
            return
        kept = self.read(name).join(rows.select("rowkey"), "rowkey", "left_anti")
        self._publish(name, kept.unionByName(rows.select(*kept.columns)), version)

    def delete(self, name: str, keys: DataFrame, version: str | int) -> None:
        if self._published(name, version):
            return
        kept = self.read(name).join(keys.select("rowkey"), "rowkey", "left_anti")
        self._publish(name, kept, version)

    def _published(self, name: str, version: str | int) -> bool:
        details = self.spark.sql(f"DESCRIBE FORMATTED {self.qualified(name)}")
        location = details.filter("col_name = 'Location'").first()
        return location.data_type.rstrip("/").endswith(f"/{name}/version={version}")

    def _publish(self, name: str, rows: DataFrame, version: str | int) -> None:
        folder = f"{self.root}/{name}/version={version}"
        rows.write.mode("overwrite").parquet(folder)
        self.spark.sql(f"ALTER TABLE {self.qualified(name)} SET LOCATION '{folder}'")
        self.spark.catalog.refreshTable(f"{self.database}.{name}")


def sync_dim_tables(store: DimStore, config_batch: DataFrame) -> None:
    """Follow config changes (``op``, ``before``, ``after`` as JSON, ``ts_ms``).

    d drops the table; r and c create it if missing; any other change drops the
    old table and creates the new one. The driver issues the definitions one by
    one and reads the changes as it goes, a partition at a time.
    """
    schema = CDC_TABLES["table_process_dim"]
    rows = config_batch.select(
        "op", F.from_json("before", schema)["sink_table"].alias("old"),
        F.from_json("after", schema)["sink_table"].alias("new"), "ts_ms",
    ).orderBy("ts_ms")
    for row in rows.toLocalIterator():
        if row.op == "d":
            store.drop(row.old)
        elif row.op in ("r", "c"):
            store.create(row.new)
        else:
            if row.old:
                store.drop(row.old)
            store.create(row.new)


def write_routed(store: DimStore, routed: DataFrame, version: str | int, order_by: str = "ts_ms") -> None:
    """Write the rows of ``route_dims`` to their tables, the latest per row key.

    Only tables with a row in the batch are written; missing ones are created.
    """
    rows = latest_per_key(routed, ["sink_table", "rowkey"], [order_by]).persist()
    try:
        for (sink,) in rows.select("sink_table").distinct().toLocalIterator():
            if not store.exists(sink):
                store.create(sink)
            store.write(sink, rows.filter(F.col("sink_table") == sink).select("rowkey", "info"), version)
    finally:
        rows.unpersist()
