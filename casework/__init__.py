"""Contract-margin casework on Spark: DataFrame in, DataFrame out."""

from casework.settings import ExceptionSettings, Settings

__all__ = ["ExceptionSettings", "Settings"]
