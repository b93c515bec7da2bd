"""Copy of relational tables to JSON topics."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemart.operators.projections import row_to_json
from tidemart.sources.relational import ods_table


def ods_copy(rows: DataFrame, table: str) -> DataFrame:
    """Rows of a relational table as JSON records with name-derived types."""
    return row_to_json(ods_table(rows, table))
