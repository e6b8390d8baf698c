"""tarnlog: a Spark-native engine for log ingestion and text-corpus analytics.

Everything is declared on DataFrames so that Catalyst plans it; Python runs only in
Arrow batches where the built-in expressions cannot state the semantics.
"""

__version__ = "0.1.0"
