"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface plus the thin ``opN_<name>`` query over the
``documents`` (or ``pages`` / ``embeddings``) table; :mod:`.registry` gathers
the queries and their SQL.
"""
