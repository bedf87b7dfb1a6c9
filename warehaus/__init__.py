"""Spark-native batch warehouse loading and reporting.

Every operator is a DataFrame -> DataFrame function; Catalyst and adaptive
query execution choose join strategies, partial aggregation and skew splits.
"""

from warehaus.batch import Batch

__all__ = ["Batch"]
__version__ = "0.1.0"
