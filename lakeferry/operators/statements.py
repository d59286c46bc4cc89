"""Statements without a result set, as text: what exec runs on a store."""

from __future__ import annotations

import re

from pyspark.sql import types as T

from ..errors import Refused
from ..functions.types import spark_type
from ..plans.dialect import names, spark_sql
from ..sources.catalog import Catalog
from . import ddl, dml, load

_NAME = r"(?:`(?:[^`]|``)+`|[\w#$]+)(?:\.(?:`(?:[^`]|``)+`|[\w#$]+)){0,2}"


def _plain(name: str) -> str:
    return name.strip().strip("`").replace("``", "`")


def _list(text: str) -> list[str]:
    """Parts at commas outside of brackets and quotes."""
    out, depth, held = [], 0, ""
    for m in re.finditer(r"'(?:[^']|'')*'|`[^`]*`|.", text, re.S):
        depth += {"(": 1, ")": -1}.get(m[0], 0)
        if m[0] == "," and not depth:
            out.append(held.strip())
            held = ""
        else:
            held += m[0]
    return [*out, held.strip()] if held.strip() else out


def execute(c: Catalog, sql: str) -> int:
    """Runs one statement; rows changed."""
    text = names(sql).strip().rstrip(";")
    match = lambda p: re.fullmatch(re.sub(r"\bNAME\b", lambda _: f"({_NAME})", p), text, re.I | re.S)
    if m := match(r"INSERT\s+INTO\s+NAME\s*(?:\(([^()]*)\)\s*)?((?:SELECT|VALUES|WITH|FROM)\b.*)"):
        columns = [_plain(x) for x in m[2].split(",")] if m[2] else None
        return dml.insert(c, m[1], c._select(m[3]), columns)
    if m := match(r"UPDATE\s+NAME\s+SET\s+(.*?)(?:\s+WHERE\s+(.*))?"):
        pairs = [re.split(r"\s*=\s*", x, maxsplit=1) for x in _list(m[2])]
        return dml.update(c, m[1], {_plain(k): spark_sql(v) for k, v in pairs}, m[3] and spark_sql(m[3]))
    if m := match(r"DELETE\s+FROM\s+NAME(?:\s+WHERE\s+(.*))?"):
        return dml.delete(c, m[1], m[2] and spark_sql(m[2]))
    if m := match(r"TRUNCATE\s+TABLE\s+NAME"):
        schema, table, meta = ddl.existing(c, m[1], "TRUNCATE")
        ddl.stage(c, schema, table, ddl.replace(meta, segments=[], gone={}, rows=0), meta.version)
        return meta.rows
    if m := match(r"CREATE\s+SCHEMA\s+(IF\s+NOT\s+EXISTS\s+)?NAME"):
        ddl.create_schema(c, _plain(m[2]), bool(m[1]))
        return 0
    if m := match(r"DROP\s+SCHEMA\s+(IF\s+EXISTS\s+)?NAME(\s+CASCADE)?"):
        ddl.drop_schema(c, _plain(m[2]), bool(m[1]), cascade=bool(m[3]))
        return 0
    if m := match(r"DROP\s+TABLE\s+(IF\s+EXISTS\s+)?NAME"):
        ddl.drop_table(c, m[2], bool(m[1]))
        return 0
    if m := match(r"CREATE\s+(OR\s+REPLACE\s+)?TABLE\s+(IF\s+NOT\s+EXISTS\s+)?NAME\s+AS\s+(.*)"):
        return load.create_table_as(c, m[3], c._select(m[4]), or_replace=bool(m[1]), if_not_exists=bool(m[2]))
    if m := match(r"CREATE\s+(OR\s+REPLACE\s+)?TABLE\s+(IF\s+NOT\s+EXISTS\s+)?NAME\s*\((.*)\)"):
        fields, key = [], []
        for part in _list(m[4]):
            if k := re.fullmatch(r"(?:CONSTRAINT\s+\S+\s+)?PRIMARY\s+KEY\s*(?:\w+\s*)?\((.*)\)", part, re.I | re.S):
                key = [_plain(x) for x in k[1].split(",")]
                continue
            name, kind, rest = re.fullmatch(r"(`(?:[^`]|``)+`|\S+)\s+(\w+\s*(?:\([^)]*\))?)\s*(.*)", part, re.S).groups()
            said = {"remote_type": re.sub(r"\s", "", kind).lower()}
            if i := re.search(r"IDENTITY\s*(?:\((-?\d+)\s*,\s*(-?\d+)\))?", rest, re.I):
                said["identity"] = [int(i[1] or 1), int(i[2] or 1)]
            if d := re.search(r"DEFAULT\s+(\([^)]*\)|'[^']*'|\S+)", rest, re.I):
                said["default"] = spark_sql(d[1])
            if o := re.search(r"COLLATE\s+(\w+)", rest, re.I):
                said["collation"] = o[1]
            if re.search(r"PRIMARY\s+KEY", rest, re.I):
                key = [_plain(name)]
            fields.append(T.StructField(_plain(name), spark_type(kind), True, said))
        ddl.create_table(c, m[3], T.StructType(fields), key, if_not_exists=bool(m[2]), or_replace=bool(m[1]))
        return 0
    if m := match(r"ALTER\s+TABLE\s+NAME\s+ADD\s+(?:COLUMN\s+)?(\S+)\s+(.*)"):
        ddl.add_column(c, m[1], _plain(m[2]), spark_type(m[3]).simpleString())
        return 0
    if m := match(r"ALTER\s+TABLE\s+NAME\s+DROP\s+COLUMN\s+(\S+)"):
        ddl.drop_column(c, m[1], _plain(m[2]))
        return 0
    if m := match(r"ALTER\s+TABLE\s+NAME\s+RENAME\s+TO\s+(\S+)"):
        ddl.rename_table(c, m[1], _plain(m[2]))
        return 0
    if m := match(r"ALTER\s+TABLE\s+NAME\s+RENAME\s+(?:COLUMN\s+)?(\S+)\s+TO\s+(\S+)"):
        ddl.rename_column(c, m[1], _plain(m[2]), _plain(m[3]))
        return 0
    if m := re.match(r"CREATE\s+(?:OR\s+REPLACE\s+)?(?:UNIQUE\s+)?(\w+)", text, re.I):
        ddl.refuse(m[1])
    raise Refused(f"not a statement this engine runs: {text[:80]}")
