"""Isolation forest (Liu, Ting and Zhou 2008): one forest per sensor type, all types in one plan.

Spark draws the samples and shuffles one small group per tree; only growing a tree over its few hundred sample rows
and walking rows through trees are Python, on Arrow batches.
"""

import math
import sys
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from gaugeline.plans.scratch import spread_work

# The functions below travel to the executors, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TREES = 100
SAMPLE = 256
CONTAMINATION = 0.1
SEED = 42
MAX_NODES = 2_000_000
MAX_GROW_TASKS = 1_000
EULER_GAMMA = 0.5772156649015329

NODE_SCHEMA = (
    "sensor_type string, tree int, node int, feature int, threshold double, left int, right int, path double, "
    "sample_size int"
)


def average_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3)
    long = 2.0 * (np.log(big - 1.0) + EULER_GAMMA) - 2.0 * (big - 1.0) / big
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, long))


def binomial_bounds(trials: int, p: float) -> list[float]:
    """Chances of at most 0, 1, ... trials - 1 successes."""
    total, bounds = 0.0, []
    for k in range(trials):
        total += math.comb(trials, k) * p**k * (1 - p) ** (trials - k)
        bounds.append(min(1.0, total))
    return bounds


def sample_rows(
    scaled: DataFrame, sizes: dict[str, int], key: str = "id", trees: int = TREES, sample: int = SAMPLE, seed: int = SEED
) -> DataFrame:
    """`sample` rows per type and tree, drawn without replacement by hash: the same rows however `scaled` is
    partitioned, and from all of them at any size. Each tree takes a row with the same chance, enough for twice its
    sample. One hash tells how many trees take the row, by the binomial distribution of that number, so most rows of a
    large table cost one hash; only for the others are the trees drawn."""
    scale = 1 << 52
    bounds = {t: binomial_bounds(trees, min(1.0, 2 * sample / n)) for t, n in sizes.items() if n}

    def hashed(salt: int, *columns):
        return F.pmod(F.xxhash64(F.lit(seed + salt), *columns), F.lit(scale))

    lists = [x for t, values in bounds.items() for x in (F.lit(t), F.array(*[F.lit(v) for v in values]))]
    of_type = F.element_at(F.create_map(*lists), F.col("sensor_type")) if lists else F.array(F.lit(1.0))
    share = hashed(0, key) / F.lit(float(scale))
    taken = scaled.filter(share >= F.get(of_type, F.lit(0)))
    count = F.size(F.filter(of_type, lambda bound: bound <= share))
    by_hash = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(hashed(1, t, key).alias("h"), t.alias("tree"))))
    hits = F.transform(F.slice(by_hash, F.lit(1), count), lambda x: x["tree"])
    pool = spread_work(taken, int(sum(n * (1 - bounds[t][0]) for t, n in sizes.items() if n)))

    def drawn(tree):
        return hashed(2, tree, F.col(key))

    # Ranking and growing share one shuffle. It is split by number: the rows are few, but the work on them is not, and
    # adaptive execution would merge them by size.
    tasks = min(MAX_GROW_TASKS, 2 * scaled.sparkSession.sparkContext.defaultParallelism)
    candidates = pool.withColumn("tree", F.explode(hits)).repartition(tasks, "sensor_type", "tree")
    first = Window.partitionBy("sensor_type", "tree").orderBy(drawn(F.col("tree")), key)
    return candidates.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= sample).drop("_n")


def _grow(sensor_type: str, tree: int, rows: np.ndarray, seed: int) -> pd.DataFrame:
    """Split at a random value of a random feature that still varies, down to the mean depth of a random tree."""
    rng = np.random.default_rng([seed, tree, *sensor_type.encode()])
    depth_limit = math.ceil(math.log2(max(len(rows), 2)))
    nodes, todo = [], [(np.arange(len(rows)), 0)]
    while len(nodes) < len(todo):
        members, depth = todo[len(nodes)]
        part = rows[members]
        lo, hi = part.min(axis=0), part.max(axis=0)
        varying = np.flatnonzero(hi > lo)
        if depth >= depth_limit or len(members) <= 1 or not len(varying):
            nodes.append((-1, 0.0, -1, -1, depth + float(average_path(len(members)))))
            continue
        f = int(varying[rng.integers(len(varying))])
        # Below the maximum, so that both sides get rows even when only rounding tells the values apart.
        at = min(float(rng.uniform(lo[f], hi[f])), float(np.nextafter(hi[f], lo[f])))
        goes_left = part[:, f] <= at
        nodes.append((f, at, len(todo), len(todo) + 1, 0.0))
        todo += [(members[goes_left], depth + 1), (members[~goes_left], depth + 1)]
    out = pd.DataFrame(nodes, columns=["feature", "threshold", "left", "right", "path"])
    return out.assign(sensor_type=sensor_type, tree=tree, node=np.arange(len(nodes)), sample_size=len(rows))


def grow_forest(samples: DataFrame, columns: Sequence[str], seed: int = SEED) -> DataFrame:
    """Node table of all trees: inner nodes with feature and threshold, leaves (feature -1) with their path length."""
    names = [f.split()[0] for f in NODE_SCHEMA.split(", ")]
    columns = list(columns)

    def grow_tree(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        return _grow(pdf["sensor_type"].iloc[0], int(pdf["tree"].iloc[0]), pdf[columns].to_numpy(float), seed)[names]

    # A group is one tree's sample: a few hundred rows, whatever the size of the table.
    return (
        samples.select("sensor_type", "tree", "id", *columns)
        .groupBy("sensor_type", "tree")
        .applyInPandas(grow_tree, NODE_SCHEMA)
    )


def _scorer(nodes: pd.DataFrame, columns: Sequence[str]):
    """A vectorised UDF that walks a batch through the trees of its type, level by level."""
    forests = {}
    for kind, table in nodes.groupby("sensor_type"):
        table = table.sort_values(["tree", "node"])
        start = table.groupby("tree")["node"].transform("size").groupby(table["tree"]).first().cumsum().shift(fill_value=0)
        base = table["tree"].map(start).to_numpy()
        inner = table["feature"].to_numpy() >= 0
        own = base + table["node"].to_numpy()
        # A leaf is its own child on both sides. The children of a node are at 2 * node and 2 * node + 1.
        children = np.column_stack([np.where(inner, base + table[side].to_numpy(), own) for side in ("left", "right")])
        forests[kind] = (
            start.to_numpy(np.intp),
            np.where(inner, table["feature"].to_numpy(), 0).astype(np.intp),
            np.where(inner, table["threshold"].to_numpy(), np.inf),
            children.ravel().astype(np.intp),
            table["path"].to_numpy(),
            float(average_path(table["sample_size"].max())),
        )

    @F.pandas_udf("double")
    def score_iforest(kind: pd.Series, features: pd.DataFrame) -> pd.Series:
        x_all, out = features.to_numpy(float), np.full(len(kind), np.nan)
        for k, where in kind.groupby(kind).indices.items():
            if k not in forests:
                continue
            roots, feature, threshold, children, path, norm = forests[k]
            x = x_all[where]
            first, x = np.arange(len(where)) * x.shape[1], x.ravel()
            depth = np.zeros(len(where))
            for root in roots:
                at = np.full(len(where), root)
                while True:
                    right = ~(x.take(first + feature.take(at)) <= threshold.take(at))
                    nxt = children.take(2 * at + right)
                    if (nxt == at).all():
                        break
                    at = nxt
                depth += path.take(at)
            out[where] = -np.exp2(-depth / (len(roots) * max(norm, 1e-12)))
        return pd.Series(out)

    return score_iforest(F.col("sensor_type"), F.struct(*columns))


def score_rows(
    scaled: DataFrame, nodes: DataFrame, columns: Sequence[str], rows: int, max_nodes: int = MAX_NODES
) -> DataFrame:
    """Add the anomaly score (lower is more anomalous) of each of the `rows` rows whose type has a forest.

    Trees travel to the tasks. A type has at most trees x 2 x sample nodes; when all types together are above
    `max_nodes`, the types are scored in slices that each stay below it.
    """
    sizes = nodes.groupBy("sensor_type").count().orderBy("sensor_type").collect()
    slices, room = [[]], max_nodes
    for kind, n in sizes:
        if n > room and slices[-1]:
            slices.append([])
            room = max_nodes
        slices[-1].append(kind)
        room -= n
    scored = []
    for kinds in slices:
        table = nodes.filter(F.col("sensor_type").isin(kinds)).toArrow().to_pandas()
        chosen = spread_work(scaled.filter(F.col("sensor_type").isin(kinds)), rows)
        scored.append(chosen.withColumn("score_sample", _scorer(table, columns)))
    return reduce(DataFrame.unionByName, scored)
