"""Exact dedup: sorted digest runs of the input's partitions, merged up a tree of binomial exchanges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach, stored

#: Bits of the tree that a round replaces: 2^BITS partitions exchange runs, and each merges as many.
BITS = 4
#: Slices of a digest's hash by which the rows of one node are spread over tasks.
SLICES = 256


def normalised(text: Column) -> Column:
    """Text with each run of space, tab, line feed, vertical tab, form feed and carriage return as one space; null as empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _depth(leaves: int, bits: int) -> int:
    """Rounds until every partition has met every other one, at least one."""
    rounds = 1
    while 1 << (bits * rounds) < leaves:
        rounds += 1
    return rounds


def merge_runs(rows: DataFrame, leaves: int, bits: int = BITS) -> DataFrame:
    """One entry (digest, bytes, sha256, keep, n) per distinct text of ``rows`` (leaf, digest, bytes, sha256, keep, n).

    The leaves 0 to ``leaves`` - 1 each hold a run. A node's number has ``bits`` bits a round. In a round the nodes that
    differ in the round's bits alone exchange their runs: an entry goes to the node whose bits are those of its digest.
    There the 2^bits runs that arrive are merged in the order of their digests, and of entries of one text the smallest
    identifier stays, with the number of rows behind it. After the last round a node's number consists of
    digest bits, so a text has one entry in all. An entry that many partitions hold shrinks 2^bits-fold a round. Entries are of one
    text only if the digest, the length and the SHA-256 agree; equal 64-bit digests alone merge nothing.
    """
    rounds = _depth(leaves, bits)
    width = rounds * bits
    key = ["node", "slice", "digest", "bytes", "sha256"]
    runs = rows.withColumn("node", F.col("leaf").cast("long")).withColumn("slice", F.col("digest").bitwiseAND(SLICES - 1))
    for r in range(1, rounds + 1):
        low = width - r * bits
        head = F.shiftleft(F.shiftrightunsigned("digest", 64 - r * bits), low)
        runs = runs.withColumn("node", head + F.col("node").bitwiseAND((1 << low) - 1))
        if r > 1:  # in the first round Spark's partial aggregate makes the leaves' runs and the exchange follows it
            runs = runs.repartition("node", "slice").sortWithinPartitions(*key)
        runs = runs.groupBy(*key).agg(F.min("keep").alias("keep"), F.sum("n").alias("n"))
    return runs.drop("node", "slice")


def text_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id (the smallest doc_id of the rows of equal text), group_size,
    kept, text_sha256 (of the normalised text).

    Texts are equal if identical after `normalised`; null is empty text. Of equal texts exactly one
    row is kept, that of the smallest doc_id; rows without an id come last, and of several rows of one id and text
    one stays. keep_id is null if no row of the group has an id. Extra columns are left out. Empty
    tables give empty results.

    The rows' digests are stored once (about 80 bytes a row; texts are read once and never shuffled). Classes come
    back to the rows by SHA-256; those with a thousandth of all rows or more by broadcast.
    """
    norm = normalised(F.col(text))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), norm.alias("_norm"))
    rows = rows.select("doc_id", F.unhex(F.sha2("_norm", 256)).alias("sha256"), F.octet_length("_norm").alias("bytes"),
                       F.xxhash64("_norm").alias("digest"), F.spark_partition_id().alias("leaf"),
                       F.monotonically_increasing_id().alias("place"))
    rows = stored(rows, "dedup-rows")
    leaves, total = rows.agg(F.coalesce(F.max("leaf"), F.lit(0)) + 1, F.count(F.lit(1))).first()
    keep = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("place").alias("place"))
    leaf = rows.select("leaf", "digest", "bytes", "sha256", keep.alias("keep"), F.lit(1).cast("long").alias("n"))
    classes = stored(merge_runs(leaf, leaves, bits).select("sha256", "keep", F.col("n").alias("group_size"), "n"), "dedup-classes")
    out = attach(rows.select("doc_id", "place", "sha256"), classes, "sha256", "n", total)
    return out.select("doc_id", F.col("keep.id").alias("keep_id"), "group_size",
                      (F.col("place") == F.col("keep.place")).alias("kept"), F.lower(F.hex("sha256")).alias("text_sha256"))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that `text_classes` keeps, with all their columns whatever their names."""
    d = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    of = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    first = text_classes(d, of[doc_id], of[text]).where("kept").select(F.col("doc_id").alias("k0"), F.col("text_sha256").alias("k1"))
    d = d.withColumn("s", F.sha2(normalised(F.col(of[text])), 256))
    d = d.join(first, on=d[of[doc_id]].cast("long").eqNullSafe(F.col("k0")) & (F.col("s") == F.col("k1")), how="left_semi")
    # rows that repeat an id and text
    return d.dropDuplicates([of[doc_id], "s"]).drop("s").toDF(*docs.columns)
