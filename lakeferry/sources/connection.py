"""Connection strings, secrets and options of an attach, and what a JDBC driver is told."""

from __future__ import annotations

import re
from urllib.parse import parse_qsl, unquote, urlsplit

from ..errors import EngineError
from ..settings import settings

#: Names by which a field may be called.
ALIASES = {
    "host": ("server", "data source", "address", "addr", "network address"),
    "database": ("initial catalog",),
    "user": ("user id", "uid", "username"),
    "password": ("pwd",),
    "use_encrypt": ("encrypt",),
    "application_name": ("app", "application name", "applicationname"),
    "schema_filter": ("schemafilter",),
    "table_filter": ("tablefilter",),
    "access_token": ("accesstoken",),
}
_NAMES = {a: k for k, v in ALIASES.items() for a in (k, *v)} | {"port": "port", "catalog": "catalog", "authenticator": "authenticator", "order_pushdown": "order_pushdown", "lazy_validation": "lazy_validation"}


def _truth(value: str) -> bool:
    if value.lower() in ("true", "yes", "1", "on", "mandatory", "strict"):
        return True
    if value.lower() in ("false", "no", "0", "off", "optional"):
        return False
    raise EngineError(f"not a truth value: {value}")


def parse(text: str) -> dict[str, str]:
    """Fields of `Key=Value;...` or of a `scheme://user:password@host:port/database?...` URI."""
    if re.match(r"\w+://", text):
        u = urlsplit(text)
        out = {"host": u.hostname, "port": str(u.port) if u.port else None, "database": unquote(u.path.strip("/")), "user": unquote(u.username or ""), "password": unquote(u.password or "")}
        pairs = parse_qsl(u.query, keep_blank_values=True)
    else:
        out, pairs = {}, []
        for m in re.finditer(r"\s*([^=;]+?)\s*=\s*(?:\"((?:[^\"]|\"\")*)\"|'((?:[^']|'')*)'|\{([^}]*)\}|([^;]*))\s*(?:;|$)", text):
            value = next((x for x in m.groups()[1:] if x is not None), "")
            pairs.append((m[1], value.replace('""', '"') if m[2] is not None else value.strip()))
        if not pairs:
            raise EngineError("not a connection string")
    for k, v in pairs:
        name = _NAMES.get(k.lower().strip())
        if name:
            out[name] = v
    out = {k: v for k, v in out.items() if v}
    host = out.get("host", "")
    if "," in host:  # host,port
        out["host"], out["port"] = host.split(",", 1)
    return out


def merge(attach: dict, secret: dict | None = None, text: str | None = None) -> dict:
    """Options of the attach go before those of a connection string, and these before a secret's."""
    return {k.lower(): v for k, v in (secret or {}).items()} | (parse(text) if text else {}) | {k.lower(): v for k, v in attach.items() if v is not None}


def jdbc(fields: dict, url: str = "jdbc:sqlserver://{host}:{port};databaseName={database}") -> tuple[str, dict[str, str]]:
    """URL and properties for spark.read.jdbc; url: the driver's own form."""
    for need in [x for x in ("host", "database") if f"{{{x}}}" in url]:
        if not fields.get(need):
            raise EngineError(f"{need} is missing")
    if "{host}" in url and not (fields.get("user") or fields.get("access_token") or fields.get("authenticator")):
        raise EngineError("credentials are missing: user and password, access_token or authenticator")
    props = {k: str(fields[k]) for k in ("user", "password") if fields.get(k)}
    if fields.get("access_token"):
        props["accessToken"] = fields["access_token"]
    if "use_encrypt" in fields:
        props["encrypt"] = str(_truth(str(fields["use_encrypt"]))).lower()
    if fields.get("application_name"):
        props["applicationName"] = fields["application_name"]
    if "sqlserver" in url:
        props |= {"loginTimeout": str(settings["connection_timeout"]), "packetSize": str(min(settings["tds_packet_size"], 32767)), "sendStringParametersAsUnicode": "true"}
    return url.format(**{"port": 1433, "host": "", "database": ""} | fields), props
