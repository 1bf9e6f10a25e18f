"""DuckDB SQL for every registered query, written apart from the Spark code it checks."""

from .reports import oracles

__all__ = ["oracles"]
