"""strata: nested JSON to dimensional history, expressed as Spark DataFrame operators.

Layers follow the medallion pattern: a typed bronze read of dated JSON documents, silver
tables shredded from nested arrays and objects, and gold dimensions with surrogate keys plus
an append-only daily fact history. Every operator takes and returns lazy DataFrames (or
Columns) and takes column names as arguments.
"""

from strata.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
