"""Dimension rows from the operation logs: latest row per key, one info family."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemart.operators.latest import latest_per_key
from tidemart.operators.projections import info_row

GOODS_INFO = ("goods_id", "operate_type", "operate_time", "price", "stock_num", "operate_content")
SHOP_INFO = ("shop_id", "operate_type", "operate_time", "operate_content", "operator_id")
USER_INFO = ("register_time", "register_channel", "device_id", "register_ip")


def _dim(log: DataFrame, key: str, fields: Sequence[str], newest: str) -> DataFrame:
    return info_row(latest_per_key(log, [key], [newest]), key, fields)


def dim_goods(log: DataFrame) -> DataFrame:
    return _dim(log, "id", GOODS_INFO, "operate_time")


def dim_shop(log: DataFrame) -> DataFrame:
    return _dim(log, "id", SHOP_INFO, "operate_time")


def dim_user(log: DataFrame) -> DataFrame:
    return _dim(log, "user_id", USER_INFO, "register_time")
