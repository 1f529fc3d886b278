"""Independent DuckDB SQL for every registered query (the correctness oracle)."""

from .duckdb_sql import ORACLE_SQL  # noqa: F401
