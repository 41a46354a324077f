"""Reproducible sharding: a Feistel permutation of global row numbers, in DataFrame functions only.

A row's global number is its place among all rows, ordered by hash bucket, then id, then content. The permutation
sends it to a position; position modulo the number of shards is the shard and the quotient is the slot. Both are
computable from the number, and the number from the position (number_at() runs the rounds backwards), so a reader can
say which row any slot holds. Counts of shards differ by one at most, slots have no gaps.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .workspace import Workspace, only

#: Hash buckets in which rows are numbered; their counts are the only thing that is brought together (a bounded table).
BUCKETS = 4096
ROUNDS = 6
#: Most steps of cycle walking; see walk_steps().
MOST_STEPS = 64


def domain(n: int) -> tuple[int, int]:
    """Sides a and b of the Feistel square: a * b >= n, and a * b - n < a."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def walk_steps(n: int) -> int:
    """Steps after which every walk has ended: a walk visits each of the a * b - n outside positions once at most.

    Beyond MOST_STEPS outside positions the share of them is below 1/64, so a longer walk has a chance under 64**-64;
    such a row would stop the job by raise_error, not get a wrong place.
    """
    a, b = domain(n)
    return min(a * b - n + 1, MOST_STEPS)


def _pass(value: Column, n: int, seed: int, back: bool) -> Column:
    """All rounds of a two-sided Feistel network over the square, or all of them backwards."""
    a, b = domain(n)
    start = F.struct(F.pmod(value, F.lit(a)).alias("l"), F.floor(value / F.lit(a)).cast("long").alias("r"))
    order = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    keys = F.array(*[F.lit(seed * 1000 + k).cast("long") for k in order])

    def moved(x: Column, by: Column, side: int) -> Column:
        by = F.pmod(by, F.lit(side))
        return F.pmod(x - by if back else x + by, F.lit(side))

    def one(s: Column, k: Column) -> Column:
        return F.struct(moved(s["l"], F.xxhash64(s["r"], k), a).alias("l"), s["r"].alias("r"))

    def two(s: Column, k: Column) -> Column:
        return F.struct(s["l"].alias("l"), moved(s["r"], F.xxhash64(s["l"], k, F.lit(1)), b).alias("r"))

    step = (lambda s, k: one(two(s, k), k)) if back else (lambda s, k: two(one(s, k), k))
    return F.aggregate(keys, start, step, lambda s: s["r"] * F.lit(a) + s["l"])


def permute(x: Column, n: int, seed: int, back: bool = False) -> Column:
    """The position in 0..n-1 of number x, or the number at position x: the network, walked until inside."""
    steps = F.sequence(F.lit(1), F.lit(walk_steps(n)))
    return F.aggregate(steps, x, lambda v, i: F.when((v >= n) | (i == 1), _pass(v, n, seed, back)).otherwise(v))


def number_at(shard: Column, slot: Column, n: int, shards: int = 8, seed: int = 20) -> Column:
    """The global row number that a slot of a shard holds, of n rows."""
    return permute(slot * F.lit(shards) + shard, n, seed, back=True)


def number_rows(spark: SparkSession, rows: DataFrame, order: list[str], ws: Workspace) -> tuple[DataFrame, int]:
    """Add _number, 0 to n-1 without gaps, to a table of narrow rows; also return n.

    Equal rows are counted before the shuffle and expanded after it, so no number of copies makes a task large.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_copies"))
    counted = ws.save(counted.withColumn("_bucket", F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(BUCKETS)).cast("int")), "rows")
    sizes = counted.groupBy("_bucket").agg(F.sum("_copies").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    n = sizes.agg(F.sum("_size")).first()[0] or 0
    inside = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("_start", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
    # BUCKETS rows at most, whatever the input
    placed = placed.join(F.broadcast(offsets), "_bucket")
    number = F.explode(F.sequence(F.col("_before") + F.col("_start"), F.col("_before") + F.col("_start") + F.col("_copies") - 1))
    return placed.select(*rows.columns, number.alias("_number")), n


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8, seed: int = 20) -> DataFrame:
    """Put every row into one of the shards; counts of shards are at most one apart.

    Returns id_col, size (UTF-8 bytes of the text, plus 1), text_crc32, number, position, shard and slot. Null text: size 1
    and the checksum of nothing, 0. Null ids and repeated rows are numbered like any others, in one order: id (nulls
    first), size, checksum; equal rows get different slots. An empty table gives no rows. Other columns are dropped.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "shard")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = only(docs, id_col, text_col).select(id_col, (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"))
    numbered, n = number_rows(spark, rows, [id_col, "size", "text_crc32"], ws)
    position = permute(F.col("_number"), n, seed)
    out = numbered.select(id_col, "size", "text_crc32", F.col("_number").alias("number"), position.alias("position"))
    inside = F.when(F.col("position") < n, F.col("position")).otherwise(F.raise_error(F.lit("cycle walking did not end")).cast("long"))
    out = out.withColumn("position", inside)
    return out.withColumns({"shard": F.pmod("position", F.lit(shards)).cast("int"), "slot": F.floor(F.col("position") / shards).cast("long")})


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query: all documents in shards 0 to 7 under the law `rows`."""
    out = shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
