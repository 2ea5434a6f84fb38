"""fleetspark: vehicle-telemetry analytics as Spark DataFrame plans."""

from .params import DEFAULT, Params

__all__ = ["Params", "DEFAULT"]
