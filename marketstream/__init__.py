"""Live market data on Spark: parse, clean, de-duplicate, keep per-minute tables, answer dashboards.

Everything is a ``DataFrame -> DataFrame`` function except the few modules that act:
``sources.tables``, ``sources.jdbc`` and ``streaming``.
"""
