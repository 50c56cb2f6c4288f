"""Sensor registry kept up to date by a stream: one small snapshot per micro-batch."""

from pyspark.sql import DataFrame, SparkSession

from gaugeline.operators.registry import merge_registry, sensor_registry
from gaugeline.plans.scratch import path_exists, publish, remove_path, running_query, subfolders

KEPT_EPOCHS = 3


class RegistryKeeper:
    """Micro-batch function: reduces the batch to a row per sensor and merges it with the last snapshot.

    Snapshots are {path}/run=R/epoch=N, where R is the id of the query, which belongs to its checkpoint. A repeated
    epoch changes nothing, and an epoch without a snapshot before it is an error, never a fresh count.
    """

    def __init__(self, path: str, time: str = "ts", arrival: str = "id"):
        self.path, self.time, self.arrival = path, time, arrival
        self.run: str | None = None

    def _snapshot(self, epoch: int) -> str:
        return f"{self.path}/run={self.run}/epoch={epoch}"

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        self.run = running_query(spark) or self.run or "direct"
        if path_exists(spark, self._snapshot(epoch)):
            return
        update = sensor_registry(batch, self.time, self.arrival)
        before = self._before(spark, epoch)
        merged = update if before is None else merge_registry(before, update)
        publish(merged, self._snapshot(epoch), f"{self.path}-staging/{self.run}-{epoch}")
        remove_path(spark, self._snapshot(epoch - KEPT_EPOCHS))

    def _before(self, spark: SparkSession, epoch: int) -> DataFrame | None:
        for e in range(epoch - 1, max(epoch - 1 - KEPT_EPOCHS, -1), -1):
            if path_exists(spark, self._snapshot(e)):
                return spark.read.parquet(self._snapshot(e))
        if epoch > 0:
            raise RuntimeError(f"no registry before epoch {epoch} of run {self.run} in {self.path}")
        return None

    def latest(self, spark: SparkSession) -> DataFrame | None:
        """The newest snapshot of this keeper's run."""
        epochs = [int(x.partition("=")[2]) for x in subfolders(spark, f"{self.path}/run={self.run}")]
        return spark.read.parquet(self._snapshot(max(epochs))) if epochs else None
