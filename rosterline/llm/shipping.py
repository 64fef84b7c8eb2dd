"""Values of bounded size for every task; executors need not have this package installed."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import SparkSession


class Shipped:
    """A broadcast value that carries its own classes."""

    def __init__(self, spark: SparkSession, value):
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def load(self):
        return cloudpickle.loads(self._sent.value)

    def release(self) -> None:
        """Drops the value everywhere; no later job may need it."""
        self._sent.destroy()
