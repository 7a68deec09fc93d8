"""Benchmark decontamination by spaced seeds (DataFrame functions only).

Words (runs outside ASCII white space, in lower case) are hashed. A mask picks some words of
a window and ignores the others, so a window with a substituted word can still agree; the
windows of the texts meet those of the benchmark in a join by seed, and around each hit the
aligned words of both are compared: a passage is found where at least SHARE of WINDOW words
in a row (of the whole item, if it is shorter) are equal.

The seeds of the benchmark are sent to the executors in blocks of at most BLOCK rows, each
with the words around it; a benchmark of more seeds takes more blocks, so what is broadcast
at a time has a fixed bound. Texts are read once a block and never shuffled for the search.

Defined results: null and empty texts hold no passage; items without text, or of fewer than
LEAST_WORDS words (any text would hold those), are no passages; items of LEAST_WORDS to SPAN - 1
words, too short for the masks, must occur whole and unchanged; repeated items are found each;
texts are taken whole, of any length; of several places of an item in a text (ties) the most
equal words count, and hits counts all; rows are named by the key columns, so equal keys share
one result row for an item; other columns, whatever their names, are carried by clean() alone;
an empty table gives an empty one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidelog.llm import shared

#: Places of the words that count, from the first. Found by going through all sets of three: with
#: these, however the words that SHARE allows to differ lie in SPAN to WINDOW words in a row, one
#: mask meets none of them in some place.
MASKS = ((0, 1, 2, 3, 6), (0, 1, 5, 6, 7), (0, 2, 3, 6, 7))
SPAN = 1 + max(max(m) for m in MASKS)
WINDOW, SHARE = 15, 0.8
LEAST_WORDS = 5
#: Seeds that are broadcast at a time: numbers of at most 2 * WINDOW + SPAN words each.
BLOCK = 250_000


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds(words: Column, size: Column, mask: tuple[int, ...]) -> Column:
    """The seeds of all windows of one mask, in order."""
    last = size - F.lit(max(mask) + 1)
    every = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.xxhash64(F.lit(len(mask) * 100 + max(mask)), F.lit(sum(x * x for x in mask)), *[F.get(words, i + x) for x in mask]),
    )
    return F.when(last >= 0, every).otherwise(F.array().cast("array<bigint>"))


def benchmark_seeds(benchmark: DataFrame, masks) -> DataFrame:
    """seed, item_id, mask, back, near, need_of: each window of the items with the words around it.

    back: words of near before the window; need_of: words a passage of the item must span.
    """
    items = benchmark.where(F.col("text").isNotNull()).select("item_id", word_hashes(F.col("text")).alias("words"))
    items = items.withColumn("size", F.size("words")).where(F.col("size") >= LEAST_WORDS)
    out = []
    for k, mask in enumerate(masks):
        span = max(mask) + 1
        own = items.where((F.col("size") >= SPAN) if span > len(mask) else (F.col("size") == span) & (F.col("size") < SPAN))
        own = own.withColumn("seeds", _seeds(F.col("words"), F.col("size"), mask))
        own = own.select("item_id", "words", "size", F.posexplode_outer("seeds").alias("at", "seed")).where("seed is not null")
        back = F.least(F.col("at"), F.lit(WINDOW))
        out.append(
            own.select(
                "seed",
                "item_id",
                F.lit(k).alias("mask"),
                back.alias("back"),
                F.slice("words", F.col("at") - back + 1, back + span + WINDOW).alias("near"),
                F.least(F.col("size"), F.lit(WINDOW)).alias("need_of"),
                (F.col("size") < SPAN).alias("whole"),
            )
        )
    return reduce(DataFrame.unionByName, out)


def _masks(benchmark: DataFrame) -> list[tuple[int, ...]]:
    """MASKS, and one without gaps for each length of items that are too short for them."""
    size = F.size(word_hashes(F.col("text")))
    short = benchmark.where(F.col("text").isNotNull()).select(size.alias("n")).where(F.col("n").between(LEAST_WORDS, SPAN - 1)).distinct()
    return [*MASKS, *(tuple(range(n)) for n in sorted(r.n for r in short.collect()))]


def _best() -> Column:
    """The most equal words in any need_of words in a row: near of the item against around of the text."""
    equal = F.transform(F.col("near"), lambda x, k: F.when(F.get(F.col("around"), k - F.col("lead")) == x, 1).otherwise(0))
    last = F.greatest(F.size("near") - F.col("need_of"), F.lit(0))
    # A lambda's argument is computed once, a column named twice may be computed twice.
    best = lambda e: F.array_max(
        F.transform(F.sequence(F.lit(0), last), lambda s: F.aggregate(F.slice(e, s + 1, F.col("need_of")), F.lit(0), lambda x, y: x + y))
    )
    return F.transform(F.array(equal), best)


def passages(docs: DataFrame, benchmark: DataFrame, keys: dict[str, Column] | None = None, block: int = BLOCK) -> DataFrame:
    """keys, item_id, matched, of, hits: the benchmark items whose passages texts hold.

    keys: names and values of the columns that name a row, of docs' columns (doc_id alone
    if none are given).
    """
    keys = keys or {"doc_id": F.col("doc_id")}
    masks = _masks(benchmark)
    seeds = benchmark_seeds(benchmark, masks)
    blocks = max(1, -(-seeds.count() // block))
    texts = docs.where(F.col("text").isNotNull()).select(*[v.alias(k) for k, v in keys.items()], word_hashes(F.col("text")).alias("_words"))
    texts = texts.withColumn("_size", F.size("_words"))
    lists = [_seeds(F.col("_words"), F.col("_size"), m) for m in masks]
    texts = texts.withColumn("_seeds", F.concat(*lists))
    # Where the seeds of each mask begin in the joint list.
    starts, start = [], F.lit(0)
    for m in masks:
        starts.append(start)
        start = start + F.greatest(F.col("_size") - F.lit(max(m)), F.lit(0))
    parts = []
    for b in range(blocks):
        own = seeds if blocks == 1 else seeds.where(F.pmod(F.xxhash64("seed"), F.lit(blocks)) == b)
        spread = texts.select(*keys, "_words", "_size", F.posexplode_outer("_seeds").alias("_i", "seed"))
        hits = spread.join(F.broadcast(own), "seed")
        begin = F.lit(0)
        for k, s in enumerate(starts):
            begin = F.when(F.col("mask") == k, s).otherwise(begin)
        at = F.col("_i") - begin
        # Only the words around a hit go on from here, in the same generated code as the join.
        hits = hits.select(
            *keys,
            "item_id",
            "near",
            "need_of",
            "whole",
            F.greatest(F.col("back") - at, F.lit(0)).alias("lead"),
            F.slice("_words", F.greatest(at - F.col("back"), F.lit(0)) + 1, F.size("near")).alias("around"),
        )
        # An outer explode of the one value keeps the comparison below out of the join's condition.
        hits = hits.select(*keys, "item_id", "need_of", "whole", F.explode_outer(_best()).alias("matched"))
        need = F.when(F.col("whole"), F.col("need_of")).otherwise(F.ceil(F.col("need_of") * SHARE))
        parts.append(hits.where(F.col("matched") >= need).select(*keys, "item_id", "matched", F.col("need_of").alias("of")))
    found = reduce(DataFrame.unionByName, parts)
    return found.groupBy(*keys, "item_id", "of").agg(F.max("matched").alias("matched"), F.count("*").alias("hits"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs whose texts hold no benchmark passage."""
    name = F.unhex(F.md5("text"))
    found = passages(docs, benchmark, {"_text_md5": name}).select("_text_md5").distinct()
    found, seen = shared.measured(found, "contaminated")
    row = docs.select(F.struct(*docs.columns).alias("_row"), name.alias("_own_md5"))
    return row.join(shared.side(found, seen["rows"]), F.col("_own_md5") == F.col("_text_md5"), "left_anti").select("_row.*")
