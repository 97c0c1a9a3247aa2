"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import named, spread, stored, unlike, word_count

#: Rows a numbering bucket is meant for once a corpus outgrows the least number of buckets.
BUCKET_ROWS = 1_000_000
LEAST_BUCKETS = 64
#: Columns that `mix` adds or replaces.
ADDED = ("mix_size", "mix_source_size", "mix_target", "mix_copies")


def _kept(df: DataFrame) -> list:
    """Columns of ``df`` but those of `mix`."""
    return [named(c) for c in df.columns if c.lower() not in ADDED]


def source_targets(sizes: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """Targets of sources. ``sizes``: (_key, _null, _name, _size), a row a source (a
    dimension: it is ordered in one task). Weights repeat along the sources in code-point
    order, null last. A source gets min(level * weight, cap * size), the
    level being the one at which targets add up to all sizes: with sources
    ordered by cap * size / weight it is the largest of the levels found when the
    first k are held at their cap. Adds _w and _target; all targets are 0 if all sizes are."""
    by_name = Window.orderBy("_null", "_name")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("_w", w).withColumn("_cap", F.lit(float(cap)) * F.col("_size"))
    fill = Window.orderBy(F.col("_cap") / F.col("_w"), "_key")
    before = F.coalesce(F.sum("_cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("_w").over(fill.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("_level", (F.sum("_size").over(everything) - before) / rest)
    s = s.withColumn("_level", F.max("_level").over(everything))
    return s.withColumn("_target", F.least(F.col("_level") * F.col("_w"), F.col("_cap"))).drop("_cap", "_level")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), cap: float = 3.0, seed: int = 0,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Decide how often the mix takes each document.

    Returns each row of ``docs`` once, with its columns and mix_size (words),
    mix_source_size, mix_target (both of its source) and mix_copies (0 to cap);
    input columns of these names are replaced. A document's expected number of copies is
    target / size of its source. Documents of a source stand in an order by
    size class, so that any stretch of it holds sizes like the whole; the
    expected copies are summed along it, one offset (drawn from seed and source) is
    added, and a copy is emitted for each integer passed. Sampling is therefore even
    over sizes, and reruns agree.

    The order is (size class, hash bucket, size, doc_id, text hash). Places come
    from bucket counts, so no task holds a source; buckets grow with the table. Null
    text: size 0. Null source: a source of its own. A source of size 0 has target 0
    and no copies. Rows that repeat take different places; which of identical
    rows gets more copies is not defined. Empty tables give empty results.
    """
    own = unlike(docs, "_mix_")
    key, cls, bucket, size, place, start, u, rho, r = (own + x for x in ("key", "class", "bucket", "size", "place", "start", "u", "rho", "r"))
    source_size, target = own + "source_size", own + "target"
    n_buckets = LEAST_BUCKETS + docs.count() // BUCKET_ROWS
    d = (docs.withColumn(size, word_count(text))
         .withColumn(key, F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n")))
         .withColumn(cls, F.floor(F.sqrt(size) * 4))
         .withColumn(bucket, spread(F.col(doc_id), n_buckets)))
    buckets = stored(d.groupBy(F.col(key).alias("_key"), F.col(cls).alias("_class"), F.col(bucket).alias("_bucket"))
                     .agg(F.count(F.lit(1)).alias("_n"), F.sum(size).alias("_size"), F.min(source).alias("_name")), "mix-buckets")
    before = Window.unboundedPreceding
    classes = buckets.groupBy("_key", "_class").agg(F.sum("_n").alias("_cn"))
    classes = classes.withColumn("_cstart", F.coalesce(F.sum("_cn").over(
        Window.partitionBy("_key").orderBy("_class").rowsBetween(before, -1)), F.lit(0))).drop("_cn")
    starts = buckets.withColumn("_bstart", F.coalesce(F.sum("_n").over(
        Window.partitionBy("_key", "_class").orderBy("_bucket").rowsBetween(before, -1)), F.lit(0)))
    sizes = buckets.groupBy("_key").agg(F.sum("_size").alias("_size"), F.min("_name").alias("_name"))
    sources = source_targets(sizes.withColumn("_null", F.col("_name").isNull()), weights, cap).select(
        "_key", F.col("_size").alias(source_size), F.col("_target").alias(target),
        (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("_key")).cast("binary")), 1, 8), 16, 10).cast("double")
         / F.lit(4294967296.0)).alias(u))
    starts = (starts.join(classes, on=["_key", "_class"]).join(sources, on="_key")
              .select(F.col("_key").alias(key), F.col("_class").alias(cls), F.col("_bucket").alias(bucket),
                      (F.col("_cstart") + F.col("_bstart")).alias(start), source_size, target, u))
    in_bucket = Window.partitionBy(key, cls, bucket).orderBy(size, doc_id, F.xxhash64(text))
    out = (d.withColumn(place, F.row_number().over(in_bucket))
           .join(starts, on=[key, cls, bucket])
           .withColumn(r, F.col(start) + F.col(place))
           .withColumn(rho, F.when(F.col(source_size) > 0, F.col(target) / F.nullif(F.col(source_size), F.lit(0))).otherwise(0.0)))
    copies = F.least(F.lit(int(cap)).cast("long"), F.floor(F.col(r) * F.col(rho) + F.col(u)) - F.floor((F.col(r) - 1) * F.col(rho) + F.col(u)))
    return out.select(*_kept(docs), F.col(size).alias("mix_size"), F.col(source_size).alias("mix_source_size"),
                      F.col(target).alias("mix_target"), copies.alias("mix_copies"))


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row of `mix` as often as mix_copies says, without the four columns that `mix` adds."""
    copy = unlike(mixed, "_mix_") + "copy"
    return mixed.select(*_kept(mixed), F.explode(F.array_repeat(F.lit(1), F.col("mix_copies").cast("int"))).alias(copy)).drop(copy)
