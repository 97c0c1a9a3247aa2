"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pickle
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ionframe.session import drop_stored, materialize as stored, materialize_at as stored_at  # noqa: F401

#: A run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: At most so many keys are treated as hot; a hot key holds at least 1/HOT_KEYS of the rows.
HOT_KEYS = 1000


def share(spark: SparkSession, value) -> Callable[[], object]:
    """Broadcast ``value`` (of bounded size), by value, so that executors need no copy of its class. Returns
    a function that gives it in a task; a worker loads it once and keeps it, with whatever it remembers."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get():
        got = getattr(sent, "loaded", None)
        if got is None:
            got = sent.loaded = pickle.loads(sent.value)
        return got

    return get


def unlike(df: DataFrame, prefix: str) -> str:
    """``prefix``, longer if need be, such that no column of ``df`` begins with it."""
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def named(column: str) -> Column:
    """The column of exactly this name, dots and backquotes included."""
    return F.col("`" + column.replace("`", "``") + "`")


def word_count(text: str) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def utf8_bytes(text: str) -> Column:
    """Length of the text in UTF-8 bytes; 0 for null."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")


def spread(col: Column, n: int) -> Column:
    """A stable number from 0 to n - 1 drawn from ``col`` (null allowed)."""
    digest = F.md5(F.coalesce(col.cast("string"), F.lit("null")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(n)


def held_out(doc_id: str) -> Column:
    """True where crc32 of doc_id as text is divisible by 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def attach(rows: DataFrame, table: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has each non-null key once and in
    column ``n`` the key's number of rows. Keys with at least a thousandth of
    all rows (so at most 1000 of them) are joined by broadcast; no task gets all rows of one."""
    floor = max(1000, total // HOT_KEYS)
    hot = F.broadcast(table.where(F.col(n) >= floor).drop(n))
    cold = table.where(F.col(n) < floor).drop(n)
    return (rows.join(hot, on=key)
            .unionByName(rows.join(F.broadcast(hot.select(key)), on=key, how="left_anti").join(cold, on=key)))


def numbered(rows: DataFrame, group: str, within: Column, order: list, out: str, n_buckets: int) -> DataFrame:
    """Gapless numbers from 0 within each ``group`` without a window over a whole
    group: rows are bucketed by ``within`` (0 to n_buckets - 1), buckets counted, and a
    row's number is its bucket's offset plus its place in the bucket. ``rows``
    should be stored; it is read twice."""
    from pyspark.sql import Window

    r = rows.withColumn("_nb", within)
    counts = r.groupBy(group, "_nb").agg(F.count(F.lit(1)).alias("_nc"))
    before = Window.partitionBy(group).orderBy("_nb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "_nb", F.coalesce(F.sum("_nc").over(before), F.lit(0)).alias("_no"))
    place = Window.partitionBy(group, "_nb").orderBy(*order)
    return (r.withColumn("_np", F.row_number().over(place))
            .join(offsets, on=[group, "_nb"])
            .withColumn(out, (F.col("_no") + F.col("_np") - 1).cast("long"))
            .drop("_nb", "_np", "_no"))
