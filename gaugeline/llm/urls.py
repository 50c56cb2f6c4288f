"""URL filters by a sort-merge range join.

A rule is a host and a path prefix; it fits its host and every subdomain. Hosts are written from the top-level label
down, so that a rule is a prefix of what it fits and so an interval of sorted keys. A URL is looked up under each of
its last labels (as many as the longest rule host has), and there the interval test runs on the path alone: rule
openings, rule closings and URL paths are sorted together and swept once. Rules with one host are nested or
disjoint, so the stack of active rules is a depth, and the innermost active rule is the last opening at the current
depth.

The sweep is a window over (host suffix, slice). Suffixes with more rows than a slice holds are cut into slices that
each get the rules of that suffix; the number of such suffixes is bounded by rows / slice size and checked before
they are broadcast. Only DataFrame functions are used.

Defined cases: a null URL or one without ``://`` has an empty host and path and fits no rule. Null or empty rule
hosts fit nothing; a null rule path counts as empty and fits every path. Of equal rules, block wins. The longest
rule wins (characters of host and path, then more host labels, then text order). Repeated URLs are judged once and
joined back, so every input row and column stays. Empty tables give empty results.
"""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gaugeline.llm.common import ascii_lower, fresh_name, table
from gaugeline.plans.joins import broadcast_if_small

#: The production rules: verdict, host, path prefix.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
ROWS_PER_SLICE = 200_000
_CLOSE, _OPEN, _URL = 0, 1, 2


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def after_prefix(prefix: Column) -> Column:
    """The first byte string past all that start with `prefix`; the last byte of UTF-8 is never FF. Null for none."""
    digits = F.hex(prefix)
    cut = F.length(digits) - 2
    last = F.lpad(F.hex(F.conv(F.substr(digits, cut + F.lit(1)), 16, 10).cast("bigint") + 1), 2, "0")
    return F.when(F.length(digits) > 0, F.unhex(F.concat(F.substr(digits, F.lit(1), cut), last)))


def _canonical_rules(rules: DataFrame) -> DataFrame:
    """(suffix, labels, path, rule, verdict), one row for each host and path."""
    host = ascii_lower("host")
    named = rules.filter(F.length("host") > 0).select(
        host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    )
    one = named.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    return one.select(
        reversed_host(F.col("host")).alias("suffix"),
        F.size(F.split("host", r"\.")).alias("labels"),
        F.col("path").cast("binary").alias("key"),
        F.struct(
            (F.length("host") + F.length("path")).alias("length"),
            F.size(F.split("host", r"\.")).alias("labels"),
            F.concat("host", "path").alias("rule"),
            "verdict",
        ).alias("found"),
    )


def _suffixes(host: Column, most: int) -> Column:
    """The reversed last 1 to `most` labels of a host."""
    labels = F.reverse(F.split(host, r"\."))
    count = F.least(F.size(labels), F.lit(most))
    return F.transform(F.sequence(F.lit(1), count), lambda k: F.array_join(F.slice(labels, F.lit(1), k), "."))


def match_rules(places: DataFrame, rules: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """(host, path, rule, verdict) of the distinct `places` (host, path) that some rule fits."""
    rules = _canonical_rules(rules)
    most = rules.agg(F.max("labels")).first()[0]
    if most is None:
        return places.limit(0).select("host", "path", F.lit("").alias("rule"), F.lit("").alias("verdict"))
    ruled = broadcast_if_small(rules.select("suffix").distinct())
    urls = places.filter("host <> ''").select("host", "path", F.explode(_suffixes(F.col("host"), most)).alias("suffix"))
    urls = urls.join(ruled, "suffix", "left_semi")
    counts = urls.groupBy("suffix").count().filter(F.col("count") > rows_per_slice)
    slices = broadcast_if_small(counts.select("suffix", F.ceil(F.col("count") / rows_per_slice).cast("int").alias("n")))
    n = F.coalesce("n", F.lit(1))
    urls = urls.join(slices, "suffix", "left").select(
        "suffix", F.pmod(F.xxhash64("host", "path"), n).cast("int").alias("slice"), F.col("path").cast("binary").alias("key"),
        F.lit(_URL).alias("kind"), "host", "path", F.lit(None).cast(rules.schema["found"].dataType).alias("found"),
    )
    sliced = rules.join(slices, "suffix", "left").withColumn("slice", F.explode(F.sequence(F.lit(0), n - 1)))
    none = F.lit(None).cast("string")

    def events(kind: int, key: Column, found: Column) -> DataFrame:
        return sliced.select("suffix", "slice", key.alias("key"), F.lit(kind).alias("kind"), none.alias("host"), none.alias("path"), found.alias("found"))

    opened = events(_OPEN, F.col("key"), F.col("found"))
    closed = events(_CLOSE, after_prefix(F.col("key")), F.col("found")).filter("key is not null")
    swept = Window.partitionBy("suffix", "slice").orderBy("key", "kind", F.col("found.length"))
    step = F.when(F.col("kind") == _OPEN, 1).when(F.col("kind") == _CLOSE, -1).otherwise(0)
    before = swept.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = urls.unionByName(opened).unionByName(closed).withColumn("depth", F.sum(step).over(before))
    level = Window.partitionBy("suffix", "slice", "depth").orderBy("key", "kind", F.col("found.length"))
    opening = F.when(F.col("kind") == _OPEN, F.col("found"))
    active = F.last(opening, ignorenulls=True).over(level.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hits = rows.withColumn("active", active).filter((F.col("kind") == _URL) & (F.col("depth") > 0))
    best = hits.groupBy("host", "path").agg(F.max("active").alias("best"))
    return best.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))


def filter_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """`pages` with `host`, `path`, `rule` and `verdict`; URLs that no rule fits get the `default` verdict.

    Columns of `pages` with these names are replaced.
    """
    made = {"host": url_host(F.col(url)), "path": url_path(F.col(url))}
    rows = pages.withColumns(made).drop("rule", "verdict")
    found = match_rules(rows.select("host", "path").distinct(), rules, rows_per_slice)
    h, p = fresh_name(rows, "_host"), fresh_name(rows, "_path")
    found = found.withColumnsRenamed({"host": h, "path": p})
    joined = rows.join(found, (F.col("host") == F.col(h)) & (F.col("path") == F.col(p)), "left").drop(h, p)
    return joined.withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def op3_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return filter_urls(pages, rule_table(spark)).select("page_id", "host", "path", "rule", "verdict")


SQL = r"""
with cut as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) end as rest from pages),
parts as (
  select page_id, row_number() over () as r,
    translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path from cut),
rules as (
  select * from (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) t(verdict, rule_host, rule_path)),
ranked as (
  select p.*, rule_host || rule_path as rule, verdict,
    row_number() over (partition by r order by length(rule_host || rule_path) desc) as n
  from parts p left join rules
    on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from ranked where n = 1
"""
