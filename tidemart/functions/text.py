"""Text expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the class of accepted characters.
ALLOWED = r"""[\u4e00-\u9fa5a-zA-Z0-9\[\]\-_+{}:：“<>`?!——+·~@#$%^&*(、，。；‘【】！@#￥%……&*（）)"]"""


def join_list(items: Column, delimiter: str) -> Column:
    """F16: list to text; a null list stays null, a null element reads ``null``."""
    return F.array_join(items, delimiter, "null")


def to_csv(items: Column) -> Column:
    return join_list(items, ", ")


def capitalise(text: Column) -> Column:
    """first letter to upper case."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substr(text, F.lit(2)))


def uncapitalise(text: Column) -> Column:
    """first letter to lower case."""
    return F.concat(F.lower(F.substring(text, 1, 1)), F.substr(text, F.lit(2)))


def repeat(char: str, times: Column | int) -> Column:
    return F.repeat(F.lit(char), F.lit(times) if isinstance(times, int) else times)


def zeros(times: Column | int) -> Column:
    return repeat("0", times)


def is_empty(text: Column) -> Column:
    return text.isNull() | (text == "")


def is_blank(text: Column) -> Column:
    """Null, empty, or only control characters and spaces."""
    return text.isNull() | text.rlike(r"^[\x00-\x20]*$")


def only_allowed_characters(text: Column) -> Column:
    """every character is in the allowed set, and there is at least one."""
    return text.rlike(f"^{ALLOWED}+\\z")


def last_token(text: Column, separator: str = ",") -> Column:
    """last piece of a separated text; trailing empty pieces do not count."""
    mark = re.escape(separator)
    return F.element_at(F.split(F.regexp_replace(text, f"(?:{mark})+$", ""), mark), -1)
