"""Collation names: what they say, and the Spark collation that compares likewise."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Flags(NamedTuple):
    case_sensitive: bool
    accent_sensitive: bool
    binary: bool
    utf8: bool


def flags(name: str) -> Flags:
    parts = set(name.upper().split("_"))
    binary = any(re.fullmatch(r"BIN2?", p) for p in parts)
    return Flags(binary or "CS" in parts, binary or "AI" not in parts, binary, "UTF8" in parts)


def spark_name(name: str, trailing_spaces: bool = True) -> str:
    """trailing_spaces: whether 'a' and 'a ' differ."""
    f = flags(name)
    base = "UTF8_BINARY" if f.case_sensitive and f.accent_sensitive else "UNICODE_AI" if f.case_sensitive else "UNICODE_CI" if f.accent_sensitive else "UNICODE_CI_AI"
    return base + ("" if trailing_spaces else "_RTRIM")


def collate(c: Column, name: str) -> Column:
    return F.collate(c, spark_name(name))
