"""Training-data operators: packing, formatting, deduplication, filtering and output.

Nothing outside this subpackage imports it.  ``registry.queries()`` and
``registry.oracle_sql()`` list what ``__spark_entry__`` registers.
"""
