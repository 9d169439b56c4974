"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``benchmark``.

Each module holds one operator with a general interface; ``queries.py`` holds the thin
registered queries and ``oracle.py`` their DuckDB twins where SQL can express them.
Nothing outside this folder imports it (``__spark_entry__.py`` adds it if it is there).
"""
