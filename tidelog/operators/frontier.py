"""Ledger algebra: contiguous frontiers, pending and committed ranges, progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tidelog.plans.logs import logs, with_logs


class RangeRejected(ValueError):
    """A range that may not be registered, with the reason."""


class Coordinator:
    """Pending ranges of one source and the frontier below which everything is committed.

    For a driver that commits out of order; the same algebra over tables is frontier() and
    pending(). An unknown baseline is taken from the first range.
    """

    def __init__(self, baseline: int | None = None):
        self.frontier, self.head = baseline, baseline
        self.started = baseline is not None
        self.ranges: dict[tuple[int, int], bool] = {}

    def register(self, low: int, high: int) -> None:
        if low > high:
            raise RangeRejected(f"low {low} above high {high}")
        if not self.started:
            self.started = True
            self.frontier = self.head = low - 1 if low > 0 else None
        if self.frontier is not None and low <= self.frontier:
            raise RangeRejected(f"{low} is at or below the frontier {self.frontier}")
        if self.head is not None and low <= self.head:
            raise RangeRejected(f"{low}-{high} overlaps what is registered up to {self.head}")
        expected = 0 if self.head is None else self.head + 1
        if low != expected:
            raise RangeRejected(f"{low} leaves a gap after {expected - 1}")
        self.ranges[(low, high)] = False
        self.head = high

    def commit(self, low: int, high: int) -> int | None:
        """Mark a range committed; the new frontier where it moved, else None."""
        if (low, high) not in self.ranges:
            raise RangeRejected(f"{low}-{high} is not pending")
        self.ranges[(low, high)] = True
        moved = None
        for key in sorted(self.ranges):
            if not self.ranges[key]:
                break
            del self.ranges[key]
            self.frontier = moved = key[1]
        return moved

    @property
    def pending(self) -> int:
        return len(self.ranges)


class Registry:
    """Coordinators by source; a source may be added once."""

    def __init__(self):
        self.sources: dict[str, Coordinator] = {}

    def add(self, source: str, baseline: int | None = None) -> Coordinator:
        if source in self.sources:
            raise RangeRejected(f"source {source} is registered")
        self.sources[source] = Coordinator(baseline)
        return self.sources[source]

    def pending_total(self) -> int:
        return sum(c.pending for c in self.sources.values())


def frontier(commits: DataFrame, source: str = "source", baseline: int = -1) -> DataFrame:
    """source, frontier: the highest sequence below which every one after baseline is committed.

    The committed sequences of a source are counted by range of width 2**16; ranges before the
    first one that isn't full need no look inside, so no window spans a whole source.
    """
    width = 1 << 16
    done = commits.where(F.col("src_sequence") > baseline).select(source, "src_sequence").distinct()
    block = F.floor((F.col("src_sequence") - (baseline + 1)) / width)
    per = done.groupBy(source, block.alias("block")).agg(F.count("*").alias("n"))
    order = Window.partitionBy(source).orderBy("block")
    ahead = per.withColumn("place", F.row_number().over(order) - 1).withColumn("whole_before", F.coalesce(F.min((F.col("n") == width).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(1)))
    last = ahead.where((F.col("place") == F.col("block")) & (F.col("whole_before") == 1)).groupBy(source).agg(F.max("block").alias("block"))
    inside = done.withColumn("block", block).join(last, [source, "block"])
    island = Window.partitionBy(source).orderBy("src_sequence")
    start = F.col("block") * width + baseline + 1
    held = inside.withColumn("gap", F.col("src_sequence") - start - (F.row_number().over(island) - 1))
    reach = held.groupBy(source).agg(F.max(F.when(F.col("gap") == 0, F.col("src_sequence"))).alias("reach"), F.max("block").alias("block"))
    found = reach.select(source, F.coalesce("reach", F.col("block") * width + baseline).alias("frontier"))
    return commits.select(source).distinct().join(found, source, "left").select(source, F.coalesce("frontier", F.lit(baseline)).cast("bigint").alias("frontier"))


def pending(descriptors: DataFrame, commits: DataFrame) -> DataFrame:
    """Descriptors without a commit."""
    return descriptors.join(commits.select("source", "src_sequence").distinct(), ["source", "src_sequence"], "left_anti")


def commit_status(asked: DataFrame, ledger: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """asked with status, by identity: committed, not_committed, or unknown where the ledger can't tell.

    It can for the given sources (all, where none are given); a row without identity is unknown too.
    """
    known = ledger.select("identity").distinct().withColumn("_known", F.lit(True))
    told = F.lit(True) if sources is None else F.col("source").isin(sources)
    status = F.when(F.col("_known"), "committed").when(F.col("identity").isNotNull() & told, "not_committed").otherwise("unknown")
    return asked.join(known, "identity", "left").select(*asked.columns, status.alias("status"))


def _descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs(spark, sf_dir).groupBy("src_sequence").agg(F.count("*").alias("n"), F.max("time_ns").alias("last_ns")).withColumn("source", F.concat(F.lit("s"), (F.col("src_sequence") % 2).cast("string")))


def _commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source with the commits of all sequences but those at 96 of 97 (at 16 of 17 in a second source)."""
    d = _descriptors(spark, sf_dir).drop("source")
    one = d.where("src_sequence % 97 <> 96").withColumn("source", F.lit("a"))
    return one.unionByName(d.where("src_sequence % 17 <> 16").withColumn("source", F.lit("b")))


def ack_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier(_commits(spark, sf_dir))


def pending_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _descriptors(spark, sf_dir).drop("source")
    both = d.withColumn("source", F.lit("a")).unionByName(d.withColumn("source", F.lit("b")))
    return pending(both, _commits(spark, sf_dir)).select("source", "src_sequence", "n")


def pending_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending_ranges(spark, sf_dir).groupBy("source").agg(F.count("*").alias("pending"))


def source_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Head minus frontier of each source."""
    c = _commits(spark, sf_dir)
    head = _descriptors(spark, sf_dir).agg(F.max("src_sequence").alias("head"))
    return frontier(c).crossJoin(head).select("source", (F.col("head") - F.col("frontier")).alias("lag"))


def check_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.col("source"), F.lit(":table:"), F.col("src_sequence").cast("string"))
    d = _descriptors(spark, sf_dir).drop("source")
    asked = d.withColumn("source", F.explode(F.array(F.lit("a"), F.lit("elsewhere")))).withColumn("identity", name)
    return commit_status(asked.select("source", "src_sequence", "identity"), _commits(spark, sf_dir).withColumn("identity", name), ["a", "b"])


def run_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of a run from its ledger."""
    c = _commits(spark, sf_dir)
    totals = c.groupBy("source").agg(F.count("*").alias("batches"), F.sum("n").alias("rows_written"), F.max("src_sequence").alias("last_sequence"))
    return totals.join(frontier(c), "source")


COMMITS_SQL = """, d AS (SELECT src_sequence, count(*) AS n FROM logs GROUP BY 1), c AS (
    SELECT 'a' AS source, * FROM d WHERE src_sequence % 97 <> 96 UNION ALL SELECT 'b', * FROM d WHERE src_sequence % 17 <> 16
), f AS (
    SELECT source, coalesce(max(src_sequence) FILTER (src_sequence = r), -1) AS frontier
    FROM (SELECT source, src_sequence, row_number() OVER (PARTITION BY source ORDER BY src_sequence) - 1 AS r FROM c) GROUP BY 1
), p AS (
    SELECT s.source, d.src_sequence, d.n FROM d CROSS JOIN (VALUES ('a'), ('b')) s(source)
    ANTI JOIN c ON c.source = s.source AND c.src_sequence = d.src_sequence
)"""

ENTRIES = {
    ack_frontier: with_logs(f"{COMMITS_SQL} SELECT source, frontier FROM f"),
    pending_ranges: with_logs(f"{COMMITS_SQL} SELECT source, src_sequence, n FROM p"),
    pending_totals: with_logs(f"{COMMITS_SQL} SELECT source, count(*) AS pending FROM p GROUP BY 1"),
    source_lag: with_logs(f"{COMMITS_SQL} SELECT source, (SELECT max(src_sequence) FROM d) - frontier AS lag FROM f"),
    check_committed: with_logs(f"{COMMITS_SQL} SELECT 'a' AS source, src_sequence, 'a:table:' || CAST(src_sequence AS VARCHAR) AS identity, CASE WHEN src_sequence % 97 <> 96 THEN 'committed' ELSE 'not_committed' END AS status FROM d UNION ALL SELECT 'elsewhere', src_sequence, 'elsewhere:table:' || CAST(src_sequence AS VARCHAR), 'unknown' FROM d"),
    run_progress: with_logs(f"{COMMITS_SQL} SELECT c.source, count(*) AS batches, CAST(sum(n) AS BIGINT) AS rows_written, max(src_sequence) AS last_sequence, any_value(frontier) AS frontier FROM c JOIN f USING (source) GROUP BY 1"),
}
