"""Click-stream analytics as plain PySpark DataFrame functions."""

from clicktrail.params import TaskParams

__all__ = ["TaskParams"]
