"""tripmart: a trip-record warehouse on Spark.

Layers: sources (landing files, test-table adapter, table sinks) -> bronze ->
silver -> star schema (gold) -> questions, plus data-quality checks and
median imputation. Every step is a DataFrame function; Catalyst plans it.
"""

__version__ = "0.1.0"
