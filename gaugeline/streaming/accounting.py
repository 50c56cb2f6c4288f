"""What streams did, kept beyond a restart: every progress report as a row of a table.

Spark holds the last reports of a running query in memory. The listener writes each as a file named by query and batch, so a
batch that is repeated after a restart replaces its report, and sums count every batch once.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from gaugeline.plans.scratch import write_text

REPORT = (
    "id string, runId string, name string, timestamp string, batchId bigint, numInputRows bigint, "
    "stateOperators array<struct<operatorName: string, numRowsTotal: bigint, numRowsDroppedByWatermark: bigint>>"
)


class ProgressLog(StreamingQueryListener):
    """Writes the reports of the named queries, or of all, to {path}. Add it with `spark.streams.addListener`."""

    def __init__(self, spark: SparkSession, path: str, names: tuple[str, ...] = ()):
        self.spark, self.path, self.names = spark, path, names

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        if not self.names or progress.name in self.names:
            line = progress.json.replace("\n", " ")
            write_text(self.spark, f"{self.path}/{progress.id}-{progress.batchId:012d}.json", line)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def stop(self) -> None:
        """Wait for reports on their way, then listen no longer."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    """A row per query and batch."""
    return spark.read.schema(REPORT).json(path)


def stream_accounts(spark: SparkSession, path: str) -> DataFrame:
    """Per query: batches, rows read, and rows that arrived behind the watermark, over all its runs.

    An aggregate counts late rows after it has joined those of a task and group into one.
    """
    late = F.aggregate("stateOperators", F.lit(0).cast("bigint"), lambda n, s: n + F.coalesce(s["numRowsDroppedByWatermark"], F.lit(0)))
    return progress_table(spark, path).groupBy("name").agg(
        F.count_distinct("id", "batchId").alias("batches"), F.sum("numInputRows").alias("rows"), F.sum(late).alias("dropped")
    )
