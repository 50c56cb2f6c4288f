"""Small text conversions at the edges of the system."""

from pyspark.sql import Column, functions as F

_NUMBER = r"[-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?"
_RANGE = rf"^\s*[(\[]\s*({_NUMBER})\s*,\s*({_NUMBER})\s*[)\]]\s*$"
DEFAULT_RANGE = (0.0, 100.0)


def parse_range(text: Column) -> tuple[Column, Column]:
    """Both numbers of a text like "(a, b)"; the default range when the text is missing or is no such pair."""
    ends = [F.regexp_extract(text, _RANGE, i).try_cast("double") for i in (1, 2)]
    known = ends[0].isNotNull() & ends[1].isNotNull()
    return tuple(F.when(known, e).otherwise(F.lit(d)) for e, d in zip(ends, DEFAULT_RANGE))


def format_range(lo: Column, hi: Column) -> Column:
    return F.concat(F.lit("("), lo.cast("string"), F.lit(", "), hi.cast("string"), F.lit(")"))


def to_second(time: Column) -> Column:
    """ISO text cut after the seconds."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")


def topic_of(sensor_type: Column) -> Column:
    return F.concat(F.lit("sensors."), sensor_type)
