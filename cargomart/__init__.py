"""cargomart: DataFrame operators and batch jobs for a shipment data mart.

Layout
------
sources/    scans and in-memory row sources (A1-A6, A16) and the adapter
            views that map the driver's test tables onto shipment roles
functions/  Column-level predicates and measures (B3-B11, D5-D7, H*)
operators/  DataFrame -> DataFrame operators: filter sets, joins, latest
            record per key, aggregates, rule tables, sinks and gates
plans/      the four jobs (ingest, dimension refresh, summary, export) and
            the registered driver queries with their SQL oracles
streaming/  intentionally empty: every job of the reference is a batch job

Everything is expressed with built-in Spark SQL functions; no UDF is used.
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
