"""Settings by name, with defaults and checks; those of wire protocol and pool are kept for a driver to read."""

from __future__ import annotations

from .errors import EngineError

#: Name -> default. A bool, number or text keeps its kind.
DEFAULTS = {
    "connection_limit": 64,
    "connection_cache": True,
    "reset_connection": True,
    "connection_timeout": 30,
    "idle_timeout": 300,
    "min_connections": 0,
    "acquire_timeout": 30,
    "attach_validation_timeout": 0,
    "query_timeout": 30,
    "metadata_timeout": 300,
    "login7_max_packet": 0,
    "tds_packet_size": 16384,
    "utf8_support": True,
    "browser_timeout_seconds": 3,
    "named_instance_resolution": True,
    "catalog_cache_ttl": 0,
    "exec_invalidate_cache": False,
    "enable_statistics": True,
    "statistics_level": 0,
    "statistics_use_dbcc": False,
    "statistics_cache_ttl_seconds": 300,
    "insert_batch_size": 1000,
    "insert_max_rows_per_statement": 1000,
    "insert_max_sql_bytes": 8388608,
    "insert_use_returning_output": True,
    "dml_batch_size": 500,
    "dml_max_parameters": 2000,
    "dml_use_prepared": True,
    "ctas_drop_on_failure": False,
    "ctas_text_type": "NVARCHAR",
    "ctas_use_bcp": True,
    "default_string_length": 0,
    "utf8_collation": "Latin1_General_100_BIN2_UTF8",
    "catalog_native_types": True,
    "default_table_kind": "HEAP",
    "copy_flush_rows": 102400,
    "copy_parallel_writers": 0,
    "copy_tablock": "auto",
    "order_pushdown": False,
    "convert_varchar_max": True,
}
#: What a text setting may be, in lower case.
CHOICES = {"ctas_text_type": ("nvarchar", "varchar"), "default_table_kind": ("heap", "columnstore", "cci"), "copy_tablock": ("auto", "true", "false")}


class Settings:
    def __init__(self):
        self.values = dict(DEFAULTS)

    def __getitem__(self, name: str):
        if name not in self.values:
            raise EngineError(f"no setting {name}")
        return self.values[name]

    def __setitem__(self, name: str, value) -> None:
        kind = type(self[name])
        if kind is bool and isinstance(value, str) and value.lower() in ("true", "false"):
            value = value.lower() == "true"
        if type(value) is not kind or (kind is int and value < 0):
            raise EngineError(f"setting {name} takes a {kind.__name__}{' of 0 or more' if kind is int else ''}, not {value!r}")
        if name in CHOICES and value.lower() not in CHOICES[name]:
            raise EngineError(f"setting {name} is one of {', '.join(CHOICES[name])}, not {value}")
        self.values[name] = value

    def reset(self, name: str) -> None:
        self.values[name] = DEFAULTS[name]


settings = Settings()
