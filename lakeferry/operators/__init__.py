"""Writing operators: DDL, DML, bulk load, transactions."""
