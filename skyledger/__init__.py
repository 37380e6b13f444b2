"""Environmental time-series analytics as Spark jobs."""

from skyledger.spec import AIR, SPECS, WEATHER, DatasetSpec

__all__ = ["AIR", "SPECS", "WEATHER", "DatasetSpec"]
