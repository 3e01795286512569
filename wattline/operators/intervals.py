"""What was valid at a time: joining readings to the intervals that hold them, without comparing all with all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Width of the finest bins in seconds, and how many times wider the bins of each further class are.
FINEST = 3600
WIDER = 16


def _seconds(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp")) / 1_000_000


def at_time(
    readings: DataFrame,
    intervals: DataFrame,
    key: str,
    time: str,
    start: str,
    end: str,
    *,
    finest: int = FINEST,
    wider: int = WIDER,
    salts: int = 1,
) -> DataFrame:
    """Every pair of a reading and an interval of its key with ``start <= time < end``: the columns of both.

    Intervals are put into classes by length, a class's bins being at least as wide as its intervals, so that an
    interval of any length lies in two bins at most. Readings look into one bin of each class that occurs. The join is
    an equi-join on key, class and bin, and the exact comparison runs on its few partners. Open intervals (no start,
    no end) are cut to the readings' own range first, which one aggregation finds; so the classes are logarithmic in
    that range, and no bin lies outside of it.

    A key with a large share of all rows is spread over its bins, and with ``salts`` each bin over so many tasks: its
    readings are dealt out and its intervals repeated. Overlapping intervals all match. Null keys and times match
    nothing; an interval that ends before it starts holds nothing. Both sides must not share a column but the key.
    """
    clash = set(readings.columns) & set(intervals.columns) - {key}
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    span = readings.agg(F.min(time).alias("low"), F.max(time).alias("high")).first()
    if span.low is None:
        span_low = span_high = F.lit(None).cast("timestamp")
    else:
        span_low, span_high = F.lit(span.low).cast("timestamp"), F.lit(span.high).cast("timestamp")
    begun = F.greatest(F.col(start).cast("timestamp"), span_low)
    ended = F.least(F.col(end).cast("timestamp"), span_high)
    held = intervals.where(F.col(key).isNotNull() & (F.col(start).isNull() | F.col(end).isNull() | (F.col(start) < F.col(end))))
    held = held.withColumn("_low", _seconds(begun)).withColumn("_high", _seconds(ended)).where("_low <= _high")
    # the class is the least whose bins are as wide as the interval is long
    classes = F.ceil(F.log(float(wider), F.greatest((F.col("_high") - F.col("_low")) / finest, F.lit(1.0))))
    classed = held.withColumn("_class", classes.cast("int")).withColumn(
        "_width", F.lit(finest) * F.pow(F.lit(float(wider)), F.col("_class"))
    )
    first, last = F.floor(F.col("_low") / F.col("_width")), F.floor(F.col("_high") / F.col("_width"))
    salt = F.sequence(F.lit(0), F.lit(salts - 1))
    binned = (
        classed.withColumn("_bin", F.explode(F.sequence(first, last)))
        .withColumn("_salt", F.explode(salt))
        .drop("_low", "_high", "_width")
    )
    used = sorted(row[0] for row in classed.select("_class").distinct().collect())  # as many as the range has classes
    own = _seconds(F.col(time))
    places = [
        F.struct(F.lit(c).alias("_class"), F.floor(own / F.lit(float(finest * wider**c))).alias("_bin")) for c in used
    ]
    asked = (
        readings.where(F.col(key).isNotNull() & F.col(time).isNotNull())
        .withColumn("_at", F.explode(F.array(*places) if places else F.array().cast("array<struct<_class:int,_bin:bigint>>")))
        .select(*[f"`{name}`" for name in readings.columns], "_at.*", F.pmod(F.xxhash64(time), F.lit(salts)).cast("int").alias("_salt"))
    )
    met = asked.join(binned, [key, "_class", "_bin", "_salt"])
    within = (F.col(start).isNull() | (F.col(start) <= F.col(time))) & (F.col(end).isNull() | (F.col(time) < F.col(end)))
    return met.where(within).drop("_class", "_bin", "_salt")
