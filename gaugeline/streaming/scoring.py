"""Rolling z-scores on a stream, equal to those of the batch.

A row window is not allowed on a stream, and one over each micro-batch would start cold. Every micro-batch here is
scored by the batch operator over three parts: the last rows of every group, rows that waited for the watermark, and
the new rows. What the next batch needs is written as a small table per epoch. A group that holds most of a
micro-batch is split into chunks by the batch operator, where a keyed state would give it to one task.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from gaugeline.operators.rolling import ORDER, PRECEDING, flag_anomalies, rolling_zscore
from gaugeline.plans.chunks import ROWS_PER_CHUNK
from gaugeline.plans.scratch import path_exists, publish, remove_path, running_query
from gaugeline.sources.topics import start

SALTS = 32
KEPT_EPOCHS = 3
RUN, EPOCH, REASON = "run", "epoch", "reject_reason"


class RollingScorer:
    """Micro-batch function: scores what the watermark has passed and keeps the rest.

    The watermark is the highest event time seen, less `delay`. Rows at or behind it on arrival are late, rows up to
    it are released in (time, id) order. Scored rows go to {path}/scored/run=R/epoch=N, the state behind them to
    {path}/state/run=R/epoch=N, and late rows and rows without an event time, with the reason, to
    {path}/rejected/run=R/epoch=N. All appear by rename, and a repeated epoch reads the state before it, so a restart
    repeats nothing. R is the id of the query, which belongs to its checkpoint: epochs of another checkpoint
    start cold in folders of their own and never meet those of this one.
    """

    def __init__(
        self,
        path: str,
        keys: Sequence[str] = ("sensor_type", "location"),
        order: Sequence[str] = ORDER,
        preceding: int = PRECEDING,
        delay: str = "2 minutes",
        rows_per_chunk: int = ROWS_PER_CHUNK,
    ):
        self.path, self.keys, self.order, self.preceding = path, list(keys), list(order), preceding
        self.delay, self.rows_per_chunk = delay, rows_per_chunk
        self.run: str | None = None

    def _place(self, kind: str, epoch: int) -> str:
        return f"{self.path}/{kind}/{RUN}={self.run}/{EPOCH}={epoch}"

    def _publish(self, rows: DataFrame, kind: str, epoch: int) -> None:
        publish(rows, self._place(kind, epoch), f"{self.path}/staging/{kind}-{self.run}-{epoch}")

    def _last_state(self, spark: SparkSession, epoch: int) -> DataFrame | None:
        for e in range(epoch - 1, max(epoch - 1 - KEPT_EPOCHS, -1), -1):
            if path_exists(spark, self._place("state", e)):
                return spark.read.parquet(self._place("state", e))
        if epoch > 0:
            raise RuntimeError(f"no state before epoch {epoch} of run {self.run} in {self.path}")
        return None

    def _newest(self, rows: DataFrame) -> DataFrame:
        """The rows later frames can still reach, per group; first by salt, so no group is ranked in one task."""
        salt = F.pmod(F.xxhash64(*self.order), F.lit(SALTS))
        kept = rows.withColumn("_salt", salt)
        for part in ([*self.keys, "_salt"], self.keys):
            rank = F.row_number().over(Window.partitionBy(*part).orderBy(*[F.desc(o) for o in self.order]))
            kept = kept.withColumn("_rank", rank).filter(F.col("_rank") <= 2 * self.preceding)
        return kept.drop("_salt", "_rank")

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        self.run = running_query(spark) or self.run or "direct"
        if path_exists(spark, self._place("state", epoch)):
            return
        time = F.col(self.order[0])
        state = self._last_state(spark, epoch)
        batch = batch.persist()
        try:
            passed = None if state is None else state.agg(F.max("_watermark")).first()[0]
            on_time = F.lit(True) if passed is None else time > F.lit(passed)
            newest = batch.agg(F.max(time) - F.expr(f"INTERVAL {self.delay}")).first()[0]
            reason = F.when(time.isNull(), "no event time").when(~on_time, "late")
            self._publish(batch.withColumn(REASON, reason).filter(F.col(REASON).isNotNull()), "rejected", epoch)
            watermark = max((w for w in (passed, newest) if w is not None), default=None)
            pool = batch.filter(time.isNotNull() & on_time).withColumn("_released", F.lit(False))
            if state is not None:
                pool = state.drop("_watermark").filter("_released IS NOT NULL").unionByName(pool)
            ready = pool.filter(time <= F.lit(watermark).cast("timestamp"))
            scored = rolling_zscore(ready, self.keys, self.order, self.preceding, self.rows_per_chunk)
            fresh = flag_anomalies(scored.filter("NOT _released").drop("_released"))
            self._publish(fresh, "scored", epoch)

            history = self._newest(ready).withColumn("_released", F.lit(True))
            waiting = pool.filter(time > F.lit(watermark).cast("timestamp"))
            # One row without content carries the watermark even when nothing is kept.
            marker = spark.range(1).select(
                *[F.lit(None).cast(f.dataType).alias(f.name) for f in pool.schema.fields]
            )
            kept = history.unionByName(waiting).unionByName(marker)
            kept = kept.withColumn("_watermark", F.lit(watermark).cast("timestamp"))
            self._publish(kept, "state", epoch)
            remove_path(spark, self._place("state", epoch - KEPT_EPOCHS))
        finally:
            batch.unpersist()

    def read(self, spark: SparkSession, stream: bool = False, reading: T.StructType | None = None) -> DataFrame:
        """Scored rows so far, or as a stream for the next stage (which needs the schema of the readings)."""
        if not stream:
            return spark.read.parquet(f"{self.path}/scored").drop(RUN, EPOCH)
        fields = [*reading.fields, *SCORE_FIELDS, T.StructField(RUN, T.StringType()), T.StructField(EPOCH, T.IntegerType())]
        return spark.readStream.schema(T.StructType(fields)).parquet(f"{self.path}/scored").drop(RUN, EPOCH)

    def rejected(self, spark: SparkSession) -> DataFrame:
        """Rows that were not scored, with the reason: late, or no event time."""
        return spark.read.parquet(f"{self.path}/rejected").drop(RUN, EPOCH)


SCORE_FIELDS = [
    T.StructField("rolling_mean", T.DoubleType()),
    T.StructField("rolling_std", T.DoubleType()),
    T.StructField("z_score", T.DoubleType()),
    T.StructField("is_anomaly_statistical", T.BooleanType()),
    T.StructField("is_anomaly_status", T.BooleanType()),
    T.StructField("is_anomaly", T.BooleanType()),
]


def start_scoring(
    readings: DataFrame,
    scorer: RollingScorer,
    checkpoint: str,
    name: str = "readings_scored",
    every: str = "5 seconds",
    available_now: bool = False,
) -> StreamingQuery:
    writer = readings.writeStream.queryName(name).option("checkpointLocation", f"{checkpoint}/{name}").foreachBatch(scorer)
    return start(writer, every, available_now)
