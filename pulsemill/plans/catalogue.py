"""Catalogue of driver queries: name -> callable, and name -> equivalent SQL."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict = {}


def query(sql: str | None = None):
    """Register a function(spark, sf_dir) under its name, with the DuckDB SQL that gives the same rows."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE[function.__name__] = sql
        return function

    return add


from . import trigger_queries, wave_queries, peak_queries, table_queries, channel_queries, stream_queries, source_queries, split_queries, tree_queries  # noqa: E402, F401
