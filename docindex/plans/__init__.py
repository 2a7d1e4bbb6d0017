"""Named query plans: every operator of SURVEY §2 run over the driver tables.

``catalog.REGISTRY`` maps a query name to its Spark builder and the oracle SQL
that DuckDB runs on the same parquet tables.
"""
