"""Training and applying the outlier models of all sensor types at once, and storing them as Parquet tables."""

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeline.operators import dbscan, forest
from gaugeline.operators.fill import prepare_features
from gaugeline.operators.quantile import quantile_table
from gaugeline.operators.rolling import FEATURES
from gaugeline.operators.scaler import apply_scaler, fit_scaler
from gaugeline.plans.joins import broadcast_if_small
from gaugeline.plans.scratch import claim, local_table, materialize, path_exists, remove_path, subfolders

ISOLATION, DBSCAN = "isolation", "dbscan"
TABLES = ("scaler_params", "iforest_nodes", "iforest_meta", "dbscan_meta", "sensor_stats")
KEPT_VERSIONS = 5
PREDICTION_SCHEMA = (
    "id bigint, sensor_id string, sensor_type string, model string, prediction bigint, score double, is_anomaly boolean"
)
PREDICTIONS = tuple(f.split()[0] for f in PREDICTION_SCHEMA.split(", "))


@dataclass(frozen=True)
class Models:
    """Model tables. A model key is {sensor_type}_{isolation|dbscan}."""

    scaler_params: DataFrame
    iforest_nodes: DataFrame
    iforest_meta: DataFrame
    dbscan_meta: DataFrame
    sensor_stats: DataFrame

    def keys(self) -> DataFrame:
        return self.iforest_meta.select("model_key").union(self.dbscan_meta.select("model_key")).distinct()

    def summary(self) -> DataFrame:
        """Share of anomalies in the training data per model."""
        columns = ["model_key", "rows", "anomaly_ratio"]
        return self.iforest_meta.select(*columns).union(self.dbscan_meta.select(*columns))


def _key(model: str):
    return F.concat("sensor_type", F.lit(f"_{model}"))


def _ratio(flags: DataFrame, model: str) -> DataFrame:
    share = F.avg(F.col("is_anomaly").cast("double")).alias("anomaly_ratio")
    return flags.groupBy("sensor_type").agg(F.count("*").alias("rows"), share).withColumn("model_key", _key(model))


def prepared(readings: DataFrame) -> DataFrame:
    """The features of `readings` (id, sensor_id, sensor_type, ts, value), written: `train` and `predict` take them where
    both are called on the same readings."""
    return materialize(prepare_features(readings.select("id", "sensor_id", "sensor_type", "ts", "value")), "features")


def _points(scaled: DataFrame) -> DataFrame:
    return materialize(scaled.select("sensor_type", "id", *dbscan.FEATURES), "points")


def clustered(features: DataFrame) -> DataFrame:
    """DBSCAN's labels of all rows of `features`, scaled by these rows, written. DBSCAN has no model to apply: who trains on
    rows and asks for the labels of the same rows gets both from one run."""
    params = fit_scaler(features, dbscan.FEATURES)
    return materialize(dbscan.dbscan(_points(apply_scaler(features, params, dbscan.FEATURES))), "clustered")


def train(
    readings: DataFrame,
    models: tuple[str, ...] = (ISOLATION, DBSCAN),
    trees: int = forest.TREES,
    contamination: float = forest.CONTAMINATION,
    seed: int = forest.SEED,
    approximate_threshold: bool = False,
    features: DataFrame | None = None,
    labels: DataFrame | None = None,
) -> Models:
    """Fit scalers and models for every sensor type of `readings` (id, sensor_id, sensor_type, ts, value).

    Features are computed once and written, because scaling, sampling and scoring each read them. `features` and `labels`
    are what `prepared` and `clustered` gave for these readings, if they are there already.
    """
    spark = readings.sparkSession
    features = prepared(readings) if features is None else features
    params = materialize(fit_scaler(features, FEATURES), "scaler")
    scaled = apply_scaler(features, params, FEATURES).select("id", "sensor_type", *FEATURES)

    nodes = local_table(spark, [], forest.NODE_SCHEMA)
    meta = local_table(
        spark, [], "sensor_type string, threshold double, rows bigint, anomaly_ratio double, model_key string"
    )
    if ISOLATION in models:
        sizes = dict(features.groupBy("sensor_type").count().collect())
        drawn = forest.sample_rows(scaled, sizes, trees=trees, seed=seed)
        nodes = materialize(forest.grow_forest(drawn, FEATURES, seed), "nodes")
        scores = forest.score_rows(scaled, nodes, FEATURES, sum(sizes.values()))
        scores = materialize(scores.select("sensor_type", "score_sample"), "scores")
        limits = quantile_table(scores, "sensor_type", "score_sample", contamination, approximate_threshold)
        limits = limits.withColumnRenamed("quantile", "threshold")
        judged = scores.join(broadcast_if_small(limits), "sensor_type")
        judged = judged.withColumn("is_anomaly", F.col("score_sample") - F.col("threshold") < 0)
        meta = materialize(limits.join(_ratio(judged, ISOLATION), "sensor_type"), "forest-meta")

    density = local_table(spark, [], "sensor_type string, rows bigint, anomaly_ratio double, model_key string")
    if DBSCAN in models:
        flags = dbscan.dbscan(_points(scaled), clusters=False) if labels is None else labels
        density = materialize(_ratio(flags, DBSCAN), "dbscan-meta")
    density = density.withColumns({"eps": F.lit(dbscan.EPS), "min_points": F.lit(dbscan.MIN_POINTS)})
    return Models(params, nodes, meta, density, local_table(spark, [], "sensor_id string"))


def predict(
    models: Models, readings: DataFrame, features: DataFrame | None = None, labels: DataFrame | None = None
) -> DataFrame:
    """One row per reading and model of its type: prediction (-1 anomaly; otherwise 1, or the cluster label), score of
    the isolation forest (negative is anomalous), and the flag. Features come from `readings` alone; types without a
    model give no rows. `features` are what `prepared` gave for these readings. `labels` are what `clustered` gave for
    them; they hold only where the models were trained on the same readings."""
    features = prepared(readings) if features is None else features
    scaled = apply_scaler(features, models.scaler_params, FEATURES).select("id", "sensor_id", "sensor_type", *FEATURES)
    # Each model answers only where the store holds one.
    answers = [local_table(readings.sparkSession, [], PREDICTION_SCHEMA)]
    if not models.iforest_meta.isEmpty():
        known = models.iforest_meta.select("sensor_type", "threshold")
        rows = scaled.join(broadcast_if_small(known), "sensor_type")
        score = F.col("score_sample") - F.col("threshold")
        scored = forest.score_rows(rows, models.iforest_nodes, FEATURES, features.count())
        by_forest = scored.withColumns(
            {"model": F.lit("isolation_forest"), "score": score, "is_anomaly": score < 0}
        )
        answers.append(
            by_forest.withColumn("prediction", F.when(F.col("is_anomaly"), -1).otherwise(1).cast("bigint"))
        )
    if not models.dbscan_meta.isEmpty():
        kinds = broadcast_if_small(models.dbscan_meta.select("sensor_type"))
        dense = scaled.join(kinds, "sensor_type")
        labels = dbscan.dbscan(_points(dense)) if labels is None else labels.join(kinds, "sensor_type", "left_semi")
        answers.append(
            labels.join(dense.select("id", "sensor_id"), "id").withColumns(
                {"model": F.lit("dbscan"), "prediction": F.col("label"), "score": F.lit(None).cast("double")}
            )
        )
    return reduce(DataFrame.unionByName, [a.select(*PREDICTIONS) for a in answers])


def count_anomalies(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("sensor_type", "model").agg(F.count_if("is_anomaly").alias("anomalies"))


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in subfolders(spark, f"{path}/versions"))


def save_models(models: Models, path: str) -> int:
    """Store all tables of the models as the next version, and return its number.

    A version appears whole, by one rename, so a reader during a save sees the version before; models that were loaded
    from `path` can be saved to it. Of several who save at once, each gets a version of its own. The newest
    KEPT_VERSIONS stay.
    """
    spark = models.iforest_nodes.sparkSession
    staging = f"{path}/staging/{uuid.uuid4().hex}"
    for name in TABLES:
        getattr(models, name).withColumn("saved_at", F.current_timestamp()).write.parquet(f"{staging}/{name}")
    version = max(_versions(spark, path), default=0) + 1
    while not claim(spark, staging, f"{path}/versions/{version}", keep=True):
        version += 1
    for old in _versions(spark, path)[:-KEPT_VERSIONS]:
        remove_path(spark, f"{path}/versions/{old}")
    return version


def load_models(spark: SparkSession, path: str, version: int | None = None) -> Models:
    """Stored models, by default the newest; a store without sensor statistics gives an empty table of them."""
    if version is None:
        version = max(_versions(spark, path), default=None)
        if version is None:
            raise FileNotFoundError(f"no models in {path}")
    place = f"{path}/versions/{version}"
    tables = {}
    for name in TABLES:
        if name == "sensor_stats" and not path_exists(spark, f"{place}/{name}"):
            tables[name] = local_table(spark, [], "sensor_id string")
        else:
            tables[name] = spark.read.parquet(f"{place}/{name}").drop("saved_at")
    return Models(**tables)
