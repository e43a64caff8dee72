"""Race-forecast analytics as Spark DataFrame operators."""

from gridcast.params import Limits, Params

__all__ = ["Limits", "Params"]
