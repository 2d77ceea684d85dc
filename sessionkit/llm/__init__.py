"""Operators for preparing language-model training data.

Each module holds one operator with its own general interface; ``queries``
holds the thin registered queries and their DuckDB SQL.  Nothing outside this
subpackage imports it (``__spark_entry__`` adds its queries when it is there).
"""
