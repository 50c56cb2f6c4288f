"""Exact quantiles per group without gathering a group."""

import math

from pyspark.sql import DataFrame, functions as F

from gaugeline.plans.scratch import local_table

ACCURACY = 10_000
FEW_VALUES = 5_000
MAX_GROUPS = 10_000


def exact_quantile(df: DataFrame, group: str, value: str, q: float) -> dict:
    """The linearly interpolated q-quantile of `value` for every value of `group`.

    A sketch brackets the wanted ranks between two values that are there. A count says how many rows lie below
    and inside; a bracket with few distinct values is finished from their counts, another one is sketched again inside,
    which leaves about 4 / ACCURACY of its rows. Ranks that a sketch missed are looked for between the old bound and the new
    one, so every round narrows. A billion rows take two sketches; infinities and far outliers are values like others.
    `df` is read twice a round and once at the end. Groups are driver entries: more than MAX_GROUPS are an error.
    """
    rows = df.select(F.col(group).alias("g"), F.col(value).alias("v")).filter("v IS NOT NULL AND NOT isnan(v)")
    spark = df.sparkSession
    kind = rows.schema["g"].dataType.simpleString()
    first = rows.groupBy("g").agg(F.count("*"), F.min("v"), F.max("v"))
    sizes = first.limit(MAX_GROUPS + 1).collect()
    if len(sizes) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups")
    ranks, weights, brackets, found = {}, {}, {}, {}
    for g, n, lo, hi in sizes:
        at = q * (n - 1)
        weights[g] = at - math.floor(at)
        ranks[g] = (math.floor(at), min(math.floor(at) + 1, n - 1))
        brackets[g] = (0, n, lo, hi)  # rows below, rows inside, bounds

    def inside(table: list[tuple]) -> DataFrame:
        wanted = local_table(spark, table, f"g {kind}, lo double, hi double")  # MAX_GROUPS rows at most
        return rows.join(F.broadcast(wanted), rows["g"].eqNullSafe(wanted["g"])).drop(wanted["g"]).filter("v BETWEEN lo AND hi")

    while brackets:
        few = {g for g, (_, n, lo, hi) in brackets.items() if n <= FEW_VALUES or lo == hi}
        if few:
            counts: dict = {}
            part = inside([(g, brackets[g][2], brackets[g][3]) for g in few])
            for g, v, n in part.groupBy("g", "v").count().toLocalIterator():
                counts.setdefault(g, []).append((v, n))
            for g in few:
                below = brackets.pop(g)[0]
                ordered = sorted(counts[g])
                found[g] = [_value_at(ordered, r - below) for r in ranks[g]]
        if not brackets:
            break
        shares = {}
        for g, (below, n, lo, hi) in brackets.items():
            a, b = ((r - below) / n for r in ranks[g])
            shares[g] = (max(0.0, a - 2 / ACCURACY), min(1.0, b + 2 / ACCURACY))
        picked = {}
        for wanted in set(shares.values()):
            some = [(g, brackets[g][2], brackets[g][3]) for g, s in shares.items() if s == wanted]
            cut = inside(some).groupBy("g").agg(F.percentile_approx("v", list(wanted), ACCURACY).alias("cut"))
            picked |= {r["g"]: tuple(r["cut"]) for r in cut.collect()}
        table = [(g, brackets[g][2], brackets[g][3], *picked[g]) for g in brackets]
        wanted = local_table(spark, table, f"g {kind}, lo double, hi double, a double, b double")
        joined = rows.join(F.broadcast(wanted), rows["g"].eqNullSafe(wanted["g"])).drop(wanted["g"]).filter("v BETWEEN lo AND hi")
        under, within = F.col("v") < F.col("a"), F.col("v").between(F.col("a"), F.col("b"))
        tops = [F.max(F.when(under, F.col("v"))), F.min(F.when(F.col("v") > F.col("b"), F.col("v")))]
        for g, n_under, n_in, top, bottom in joined.groupBy("g").agg(F.count_if(under), F.count_if(within), *tops).collect():
            below, n, lo, hi = brackets[g]
            a, b = picked[g]
            begin = below + n_under
            parts = [(below, n_under, lo, top), (begin, n_in, a, b), (begin + n_in, n - n_under - n_in, bottom, hi)]
            held = [p for p in parts if p[1] and p[0] <= ranks[g][1] and ranks[g][0] < p[0] + p[1]]
            # Two neighbouring ranks on both sides of a cut: they are the last of one part and the first of the next.
            if len(held) > 1:
                found[g] = [held[0][3], held[1][2]]
                del brackets[g]
            else:
                brackets[g] = held[0]
    return {g: a if a == b else a + (b - a) * weights[g] if weights[g] else a for g, (a, b) in found.items()}


def _value_at(counted: list[tuple[float, int]], rank: int) -> float:
    for v, n in counted:
        if rank < n:
            return v
        rank -= n
    raise ValueError("the rank is beyond the rows")


def quantile_table(df: DataFrame, group: str, value: str, q: float, approximate: bool = False) -> DataFrame:
    """One row per group with the quantile, exact or (one pass, bounded memory) approximate."""
    if approximate:
        return df.groupBy(group).agg(F.percentile_approx(value, q, 100_000).alias("quantile"))
    pairs = list(exact_quantile(df, group, value, q).items())
    schema = f"{group} {df.schema[group].dataType.simpleString()}, quantile double"
    return local_table(df.sparkSession, pairs, schema)
