"""Shards from a Feistel permutation of global row numbers (DataFrame functions only).

Every row gets a global number in a reproducible order; a keyed Feistel network over
[0, a*a) with a = ceil(sqrt(rows)), walked along its cycle until it falls below the row
count, permutes those numbers. From the place p of a row both its shard (p mod shards)
and its slot (p div shards) follow, and the inverse walk finds any row again, without a
table. Shard sizes differ by one row at most.

Defined results: a null text has size 16 and CRC 0, like an empty one; a null doc_id is a
key as any other; repeated rows get as many neighbouring numbers as there are copies, so
which of several identical rows has which place does not matter; an empty table gives no
rows; columns other than doc_id and text are not read, whatever their names; texts of any length are
read whole, for their size and CRC alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tidelog.llm import shared

ROUNDS = 6
#: Buckets of the global order, at least, and different rows in one: each is sorted in one task, so
#: their number goes up with the input (400,000 for 100 billion rows, three numbers each).
BUCKETS, BUCKET_ROWS = 4096, 250_000
#: Copies of one row that one task lists at a time.
BLOCK = 1 << 16
#: Steps along the cycle before the walk of full length is taken.
SHORT_WALK = 8


def _side(total: Column) -> Column:
    """The least a with a * a >= total (a bound of rounding errors in sqrt is removed)."""
    guess = F.ceil(F.sqrt(total.cast("double"))).cast("long")
    guess = F.greatest(guess, F.lit(1).cast("long"))
    return F.when(guess * guess < total, guess + 1).when((guess > 1) & ((guess - 1) * (guess - 1) >= total), guess - 1).otherwise(guess)


def _feistel(place: Column, side: Column, seed: int) -> Column:
    """One pass of the network over [0, side * side)."""
    keys = F.array(*[F.lit(seed * 1_000_003 + i).cast("long") for i in range(ROUNDS)])
    start = F.struct(((place - F.pmod(place, side)) / side).cast("long").alias("l"), F.pmod(place, side).alias("r"))
    mixed = F.aggregate(
        keys,
        start,
        lambda acc, key: F.struct(
            acc["r"].alias("l"),
            F.pmod(acc["l"] + F.pmod(F.xxhash64(acc["r"], key), side), side).alias("r"),
        ),
        lambda acc: acc["l"] * side + acc["r"],
    )
    return mixed


def _walk(place: Column, side: Column, total: Column, seed: int, steps: Column) -> Column:
    return F.aggregate(
        F.sequence(F.lit(1).cast("long"), steps),
        place,
        lambda acc, _: F.when(acc < total, acc).otherwise(_feistel(acc, side, seed)),
    )


def permuted(number: str, total: str, seed: int, df: DataFrame) -> DataFrame:
    """df with column "place": the permutation of column number over [0, column total).

    Only side*side - total numbers lie outside, so a cycle holds no more of them and the
    walk of that length always ends below total; few rows need more than one step.
    """
    df = df.withColumn("_side", _side(F.col(total)))
    df = df.withColumn("_first", _feistel(F.col(number), F.col("_side"), seed))
    side, rows = F.col("_side"), F.col(total)
    outside = side * side - rows
    df = df.withColumn(
        "_near",
        F.when(F.col("_first") < rows, F.col("_first")).otherwise(_walk(F.col("_first"), side, rows, seed, F.lit(SHORT_WALK).cast("long"))),
    )
    df = df.withColumn(
        "place",
        F.when(F.col("_near") < rows, F.col("_near")).otherwise(_walk(F.col("_near"), side, rows, seed, F.greatest(outside, F.lit(1).cast("long")))),
    )
    return df.drop("_side", "_first", "_near")


def numbered(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, size, text_crc32 with row_number (global, from 0) and total (rows).

    Texts are hashed where they are read; only doc_id, size and CRC are shuffled. Equal
    rows are counted before the shuffle and listed again after it, so no key is hot.
    """
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.length(body) + 16).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    mark = F.xxhash64(F.col("doc_id"), F.col("size"), F.col("text_crc32"))
    counted, seen = shared.measured(counted.withColumn("mark", mark), "numbered")  # for both uses below; the texts are read once
    buckets = max(buckets, seen["rows"] // BUCKET_ROWS)
    counted = counted.withColumn("bucket", F.pmod(F.col("mark"), F.lit(buckets)))
    starts = (
        counted.groupBy("bucket")
        .agg(F.sum("copies").alias("rows"))
        .select(
            F.col("bucket"),
            (F.sum("rows").over(Window.orderBy("bucket")) - F.col("rows")).alias("start"),
            F.sum("rows").over(Window.partitionBy()).alias("total"),
        )
    )
    order = Window.partitionBy("bucket").orderBy("mark", "doc_id", "size", "text_crc32")
    placed = counted.withColumn("before", F.sum("copies").over(order) - F.col("copies"))
    # At most `buckets` rows of three numbers are broadcast.
    placed = placed.join(F.broadcast(starts), "bucket").withColumn("at", F.col("start") + F.col("before"))
    one = F.lit(1).cast("long")
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - one) / BLOCK).cast("long"))
    listed = placed.select("doc_id", "size", "text_crc32", "total", "at", "copies", F.explode(blocks).alias("block"))
    first = F.col("block") * BLOCK
    inside = F.sequence(first, F.least(first + (BLOCK - 1), F.col("copies") - one))
    return listed.select("doc_id", "size", "text_crc32", "total", "at", F.explode(inside).alias("copy")).select(
        "doc_id", "size", "text_crc32", "total", (F.col("at") + F.col("copy")).alias("row_number")
    )


def shards(docs: DataFrame, n_shards: int = 40, seed: int = 17, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number for every row of docs."""
    placed = permuted("row_number", "total", seed, numbered(docs, buckets))
    n = F.lit(n_shards).cast("long")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.pmod(F.col("place"), n).cast("int").alias("shard"),
        ((F.col("place") - F.pmod(F.col("place"), n)) / n).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
