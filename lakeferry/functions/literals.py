"""Values and names as T-SQL text."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import uuid

from ..errors import Refused


def quote(name: str) -> str:
    return "[" + name.replace("]", "]]") + "]"


def like_escape(text: str) -> str:
    """Text to stand for itself in a LIKE pattern."""
    return "".join(f"[{c}]" if c in "%_[" else c for c in text)


def literal(value, single: bool = False) -> str:
    """A value as T-SQL text. single: a float that stands for a REAL."""
    match value:
        case None:
            return "NULL"
        case bool():
            return "1" if value else "0"
        case int():
            if not -(1 << 63) <= value < 1 << 63:
                return f"CAST({value} AS DECIMAL({20 if 0 <= value < 1 << 64 else 38},0))"
            return str(value)
        case float():
            if not math.isfinite(value):
                raise Refused("NaN and infinity have no literal")
            text = f"{value:.{9 if single else 17}g}"
            return text if any(c in text for c in ".e") else text + ".0"
        case decimal.Decimal():
            return f"{value:f}"
        case bytes() | bytearray():
            return "0x" + bytes(value).hex().upper()
        case uuid.UUID():
            return f"'{value}'"
        case dt.datetime():
            text = value.astimezone(dt.UTC) if value.tzinfo else value
            text = f"{text:%Y-%m-%dT%H:%M:%S}.{text.microsecond:06d}0"
            return f"CAST('{text}+00:00' AS DATETIMEOFFSET(7))" if value.tzinfo else f"CAST('{text}' AS DATETIME2(7))"
        case dt.date():
            return f"'{value.isoformat()}'"
        case dt.time():
            return f"'{value:%H:%M:%S}.{value.microsecond:06d}0'"
        case _:
            return "N'" + str(value).replace("'", "''") + "'"
