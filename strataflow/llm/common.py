"""Helpers that several operators share: session settings, words, keys of rows, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.session import coarsely, settle, tune

# A word of the contract: a run without space, tab, line feed, vertical tab, form feed or carriage return.
# bytes.split() cuts UTF-8 at exactly these bytes.
WORD = r"[^\x20\x09-\x0D]+"

# Texts differ widely in length, so batches between the JVM and Python are bounded in rows and bytes.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
}


def ready(spark: SparkSession) -> SparkSession:
    """The session with adaptive execution and bounded batches."""
    coarsely(tune(spark))
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def body(text: Column) -> Column:
    """UTF-8 bytes of a text; null becomes empty."""
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def text_hash(text: Column) -> Column:
    """Tells the texts of rows with the same key apart."""
    return F.xxhash64(body(text))


def unsigned_crc32(text: Column) -> Column:
    return F.crc32(body(text))


def fold_remainder(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def prefix_ranks(df: DataFrame, group: list[str], order: list[str], buckets: int, name: str) -> DataFrame:
    """Gapless numbers from 0 within ``group`` without bringing a group into one task.

    Rows of a group are dealt into ``buckets`` by a hash of ``order`` and their place in the input; numbers within a bucket are
    shifted by the sizes of the buckets before it.  The table of sizes has at most groups x buckets
    rows.  Rows that agree in all of ``order`` are spread like any others, as their numbers may be swapped; the dealt rows are
    written, so a task that runs again deals alike.
    """
    from pyspark.sql import Window

    place = F.xxhash64(F.xxhash64(*order), F.monotonically_increasing_id())
    dealt = settle(df.withColumn("__bucket", F.pmod(place, F.lit(buckets)).cast("int")), "dealt")
    sizes = dealt.groupBy(*group, "__bucket").agg(F.count("*").alias("__size"))
    earlier = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        *[F.col(g).alias(f"__{g}") for g in group], F.col("__bucket").alias("__at"),
        F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__shift"),
    )
    inside = Window.partitionBy(*group, "__bucket").orderBy(*order)
    same = F.col("__bucket") == F.col("__at")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__{g}"))
    numbered = dealt.withColumn("__n", F.row_number().over(inside) - 1).join(shifts, same)
    return numbered.withColumn(name, F.col("__n") + F.col("__shift")).select(*df.columns, name)


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) of every node that has an edge; root is the smallest node of its component.

    Alternates the large-star and small-star steps until the edges are stars.  Each round is written
    to the shared folder, which cuts the lineage; nothing but two numbers reaches the driver.
    """
    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    now, seen = settle(now, label), None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if seen == (mark.n, mark.x):
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = (mark.n, mark.x)
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = settle(small.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), label)
