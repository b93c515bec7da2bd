"""Database sinks with a primary key.

No database is reachable here: the statements and options are checked by tests,
the connections are not.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from tidemart.operators.latest import latest_per_key

RETRIES = 3


def merge_statement(table: str, staging: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """Keyed replace of a table from its staging table, in the MySQL dialect."""
    names = ", ".join(f"`{c}`" for c in columns)
    updates = ", ".join(f"`{c}` = VALUES(`{c}`)" for c in columns if c not in keys)
    action = f"ON DUPLICATE KEY UPDATE {updates}" if updates else ""
    insert = "INSERT INTO" if updates else "INSERT IGNORE INTO"
    return f"{insert} `{table}` ({names}) SELECT {names} FROM `{staging}` {action}".strip()


def with_retries(action: Callable[[], None], retries: int = RETRIES, wait_s: float = 1.0) -> None:
    """Run an action again after a failure, at most ``retries`` times."""
    for attempt in range(retries + 1):
        try:
            return action()
        except Exception:
            if attempt == retries:
                raise
            time.sleep(wait_s * 2 ** attempt)


def run_statement(df: DataFrame, options: dict[str, str], statement: str) -> None:
    """Execute one statement on the database."""
    jvm = df.sparkSession._jvm
    connection = jvm.java.sql.DriverManager.getConnection(options["url"], options["user"], options["password"])
    try:
        connection.createStatement().execute(statement)
    finally:
        connection.close()


def write_jdbc_upsert(
    df: DataFrame, options: dict[str, str], table: str, keys: Sequence[str], order_by: Sequence[str],
    batch_id: int = 0, execute: Callable[[DataFrame, dict[str, str], str], None] = run_statement,
) -> None:
    """Write a batch to a staging table in parallel, then merge it by key in one statement."""
    staging = f"{table}_stage_{batch_id}"
    latest = latest_per_key(df, keys, order_by)

    def action() -> None:
        latest.write.format("jdbc").options(**{**options, "dbtable": staging}).mode("overwrite").save()
        execute(df, options, merge_statement(table, staging, df.columns, keys))
        execute(df, options, f"DROP TABLE `{staging}`")

    with_retries(action)


def olap_options(nodes: str, table: str, user: str, password: str) -> dict[str, str]:
    """Options of the OLAP store's connector, whose jar must be on the class path."""
    return {
        "fenodes": nodes, "table.identifier": table, "user": user, "password": password,
        "sink.max-retries": str(RETRIES),
    }


def write_olap(df: DataFrame, options: dict[str, str], keys: Sequence[str], order_by: Sequence[str],
               connector: str = "doris") -> None:
    """The store itself keeps the last row per primary key."""
    latest = latest_per_key(df, keys, order_by)
    with_retries(lambda: latest.write.format(connector).options(**options).mode("append").save())
