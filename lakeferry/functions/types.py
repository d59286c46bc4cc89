"""Remote types and Spark types, both ways."""

from __future__ import annotations

import re

from pyspark.sql import types as T

from ..errors import Refused

#: Remote type name -> Spark type. Parametrised ones are in spark_type().
FIXED = {
    "bit": T.BooleanType(),
    "tinyint": T.ShortType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "real": T.FloatType(),
    "float": T.DoubleType(),
    "money": T.DecimalType(19, 4),
    "smallmoney": T.DecimalType(10, 4),
    "date": T.DateType(),
    "datetime": T.TimestampNTZType(),
    "smalldatetime": T.TimestampNTZType(),
    "datetime2": T.TimestampNTZType(),
    "datetimeoffset": T.TimestampType(),
    "uniqueidentifier": T.StringType(),
    "xml": T.StringType(),
    "geometry": T.BinaryType(),
    "geography": T.BinaryType(),
}
TEXT = ("char", "varchar", "text", "nchar", "nvarchar", "ntext", "xml")
BINARY = ("binary", "varbinary", "image")
#: Largest n of a bounded string type.
BOUNDS = {"nvarchar": 4000, "nchar": 4000, "varchar": 8000, "char": 8000}


def parse(remote: str) -> tuple[str, tuple[str, ...]]:
    """("decimal", ("10", "2")) of "DECIMAL(10, 2)"."""
    m = re.fullmatch(r"\s*(\w+)\s*(?:\(([^)]*)\))?.*", remote.lower())
    if not m:
        raise Refused(f"not a type: {remote}")
    return m[1], tuple(x.strip() for x in m[2].split(",")) if m[2] else ()


def spark_type(remote: str) -> T.DataType:
    """The type of a remote column as read. What is unknown arrives as text."""
    name, args = parse(remote)
    if name in ("decimal", "numeric"):
        p = int(args[0]) if args else 18
        return T.DecimalType(min(p, 38), int(args[1]) if len(args) > 1 else 0)
    if name == "time":
        return T.TimeType(6)
    if name in BINARY:
        return T.BinaryType()
    return FIXED.get(name, T.StringType())


def string_type(kind: str, n: int, collation: str | None = None) -> dict:
    """Field metadata of a bounded string column: nvarchar(n) counts UTF-16 units, varchar(n) bytes of UTF-8."""
    if not 1 <= n <= BOUNDS[kind]:
        raise Refused(f"{kind} length must be between 1 and {BOUNDS[kind]}, not {n}")
    return {"remote_type": f"{kind}({n})", "length": n} | ({"collation": collation} if collation else {})


def remote_type(field: T.StructField, text: str = "nvarchar", default_length: int = 0) -> str:
    """The type a table created from this field gets."""
    if said := field.metadata.get("remote_type"):
        return said
    t = field.dataType
    simple = {
        T.BooleanType: "bit",
        T.ByteType: "smallint",  # the remote tinyint is unsigned
        T.ShortType: "smallint",
        T.IntegerType: "int",
        T.LongType: "bigint",
        T.FloatType: "real",
        T.DoubleType: "float",
        T.BinaryType: "varbinary(max)",
        T.DateType: "date",
        T.TimeType: "time(6)",
        T.TimestampNTZType: "datetime2(6)",
        T.TimestampType: "datetimeoffset(7)",
    }
    if type(t) in simple:
        return simple[type(t)]
    if isinstance(t, T.DecimalType):
        p = min(t.precision, 38)
        return f"decimal({p},{min(t.scale, p)})"
    if isinstance(t, T.StringType):
        return f"{text}({default_length})" if default_length else f"{text}(max)"
    if isinstance(t, (T.DayTimeIntervalType, T.YearMonthIntervalType)):
        return "nvarchar(50)"
    raise refusal(field.name, t)


def refusal(column: str, t: T.DataType) -> Refused:
    name = t.simpleString().split("<")[0].upper()
    return Refused(f"column {column}: type {name} has no counterpart in a table; consider serializing to JSON")


#: Which existing column types take which source type.
_INTS = ("tinyint", "smallint", "int", "bigint")
_DECIMALS = ("decimal", "numeric", "money", "smallmoney")
ACCEPTED = {
    T.BooleanType: ("bit",),
    T.ByteType: _INTS,
    T.ShortType: _INTS,
    T.IntegerType: _INTS,
    T.LongType: _INTS,
    T.FloatType: ("real", "float"),
    T.DoubleType: ("real", "float"),
    T.DecimalType: _DECIMALS,
    T.StringType: TEXT,
    T.BinaryType: BINARY,
    T.DateType: ("date", "datetime", "datetime2", "smalldatetime"),
    T.TimeType: ("time",),
    T.TimestampNTZType: ("datetime2", "datetime", "smalldatetime"),
    T.TimestampType: ("datetimeoffset",),
}


def accepts(source: T.DataType, remote: str) -> bool:
    """Whether an existing column of type `remote` takes values of the source type."""
    name = parse(remote)[0]
    if isinstance(source, T.StringType) and name == "uniqueidentifier":
        return True  # identifiers travel as text here
    return name in ACCEPTED.get(type(source), ())
