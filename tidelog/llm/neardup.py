"""Near duplicates: BagMinHash signatures of word shingles, banded, verified on the multisets.

Words are runs outside ASCII white space; a text is the multiset of its runs of SHINGLE
words (a shorter text with words has one, of all of them). Texts are near duplicates when
sum(min) / sum(max) of their counts is at least SIMILARITY, and classes are the connected
components of that relation. BANDS bands of ROWS components find a pair at the threshold
with a probability above 0.999; every candidate counts only if its multisets agree.

Equal texts are one node. In each bucket (texts with a band in common) one leader is compared
with all others. Buckets that then still hold several components are searched further: in
those of at most SMALL texts the members outside one component are compared with all of
other components. Texts of larger ones get a second, longer signature: FINE_BANDS tables of
FINE_ROWS components deal them into smaller buckets (a pair at the threshold meets in one
with a probability above 0.999). There a member of the largest component leads first, then each
member outside it once: a leader is held against the members of other components by SKETCH
components of the signature, and compared if so many agree as do for all but about one in
30,000 pairs at the threshold. So pairs inside a component need not be listed, no bucket is cut off, and look-alikes below the
threshold cost a comparison of bits. A large number of texts that are all just below the
threshold of each other still costs as many such comparisons as they have pairs.

Defined results: a null text is a class of its own; texts without words are duplicates only
of equal texts; a class is named after its least doc_id (null where all are null); of
repeated rows with one doc_id and text, one stays; ties of doc_id are broken by the text's
hash; texts of any length are taken whole, in slices of one text at least; an empty table
gives an empty one; columns other than doc_id and text are only carried along, whatever
their names.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from tidelog.llm import bagminhash, shared, textbatch, worker
from tidelog.llm.components import components, merged

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 7
#: Texts of a bucket whose open pairs are all compared; larger buckets are dealt anew.
SMALL = 16
FINE_BANDS, FINE_ROWS = 100, 12
#: Components in a sketch (three bits each) and how many of them may differ: seven in eight of
#: those that disagree do, a share of APART at the threshold; and four standard deviations more.
SKETCH, PLANES = 1152, ("one", "two", "three")
APART = (1 - SIMILARITY) * (1 - 0.5 ** len(PLANES))
MOST_APART = round(SKETCH * APART + 4 * (SKETCH * APART * (1 - APART)) ** 0.5)
#: Leaders that a bucket gets in one round, about; it sets the number of rounds, not the result.
LEADERS = 512
#: Pairs, and texts of long signatures, to a task.
PAIRS, TEXTS = 1000, 200
#: Texts that are broadcast have at most so many bytes in all; others are joined by shuffle.
BROADCAST_BYTES = 8 << 20
#: Rows of sketches that count as much as one of a few numbers where a side's size is checked.
WIDE = 8


def _multisets(column: pa.Array, limit: int = textbatch.SLICE):
    """(first row, rows, element, text, count) for slices of a column of texts."""
    worker.enter("neardup")
    for at, to, body, offsets in textbatch.slices(column, limit):
        starts, ends, owner = textbatch.words(body, offsets)
        hashes = textbatch.word_hashes(body, starts, ends)
        yield at, to - at, *bagminhash.multiset(*textbatch.shingle_hashes(hashes, owner, to - at, SHINGLE))


@F.arrow_udf(T.ArrayType(T.LongType()))
def _bands(text: pa.Array) -> pa.Array:
    out = np.zeros((len(text), BANDS), np.uint64)
    some = np.zeros(len(text), bool)
    for at, n, element, owner, count in _multisets(text, textbatch.SLICE // 2):
        times = bagminhash.signatures(element, owner, count, n, BANDS * ROWS)
        out[at : at + n] = bagminhash.bands(times, ROWS)
        some[at + np.unique(owner)] = True
    worker.trim()
    sizes = np.concatenate([[0], np.cumsum(np.where(some, BANDS, 0))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(sizes), pa.array(out[some].ravel().view(np.int64)))


@F.arrow_udf(T.DoubleType())
def _similarity(a: pa.Array, b: pa.Array) -> pa.Array:
    """Weighted Jaccard similarity of two texts with words."""
    size = np.cumsum(np.asarray(pc.add(pc.binary_length(a), pc.binary_length(b)).to_numpy(zero_copy_only=False), np.int64))
    out, at = np.zeros(len(a)), 0
    while at < len(a):
        to = int(np.searchsorted(size, (size[at - 1] if at else 0) + textbatch.SLICE, "right"))
        to = min(max(to, at + 1), at + 4096)
        n = to - at
        keys, counts, totals = [], [], np.zeros(n)
        for column in (a, b):
            parts = [(own + done, element, count) for done, _, element, own, count in _multisets(column.slice(at, n))]
            own, element, count = (np.concatenate(x) for x in zip(*parts))
            keys.append((own.astype(np.uint64) << np.uint64(50)) | element)
            counts.append(count)
            totals += np.bincount(own, count, minlength=n)
        shared_keys, i, j = np.intersect1d(*keys, assume_unique=True, return_indices=True)
        both = np.bincount((shared_keys >> np.uint64(50)).astype(np.int64), np.minimum(counts[0][i], counts[1][j]), minlength=n)
        out[at:to] = both / np.maximum(totals - both, 1)
        at = to
    worker.trim()
    return pa.array(out)


_LONGS = T.ArrayType(T.LongType())


@F.arrow_udf(T.StructType([T.StructField(x, _LONGS) for x in ("fine", *PLANES)]))
def _fine(text: pa.Array) -> pa.Array:
    """Keys of the fine buckets and the bits of each component of the sketch, in planes."""
    fine = np.zeros((len(text), FINE_BANDS), np.uint64)
    planes = np.zeros((len(PLANES), len(text), SKETCH // 64), np.int64)
    for at, n, element, owner, count in _multisets(text, textbatch.SLICE // 8):  # long signatures take memory by the text
        times = bagminhash.signatures(element, owner, count, n, FINE_BANDS * FINE_ROWS)
        fine[at : at + n] = bagminhash.bands(times, FINE_ROWS)
        bits = textbatch.mix(times[:, :SKETCH].view(np.uint64))
        for k in range(len(PLANES)):
            one = ((bits >> np.uint64(k)) & np.uint64(1)).astype(np.uint8)
            planes[k, at : at + n] = np.packbits(one, axis=1).view(np.int64)
    worker.trim()
    lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.int64())) for x in (fine.view(np.int64), *planes)]
    return pa.StructArray.from_arrays(lists, ["fine", *PLANES])


def _apart(a: str, b: str) -> F.Column:
    """In how many components two sketches differ."""
    unlike = lambda p, i: F.col(f"{a}.{p}")[i].bitwiseXOR(F.col(f"{b}.{p}")[i])
    word = lambda i: F.bit_count(reduce(lambda x, y: x.bitwiseOR(y), (unlike(p, i) for p in PLANES)))
    return reduce(lambda x, y: x + y, map(word, range(SKETCH // 64)))


def _verified(pairs: DataFrame, texts: DataFrame, rows: int, size: int) -> tuple[DataFrame, int]:
    """Those of the pairs (a, b) whose texts are near duplicates, and how many they are.

    rows: about how many pairs; size: bytes of all texts, which are broadcast only if that is small.
    """
    pairs, seen = shared.measured(shared.sized(pairs.distinct(), rows, PAIRS), "pairs")
    second = texts.select(F.col("tid").alias("b"), F.col("text").alias("text_b"))
    first = texts.select(F.col("tid").alias("a"), F.col("text").alias("text_a"))
    if size <= BROADCAST_BYTES:
        both = pairs.join(F.broadcast(second), "b").join(F.broadcast(first), "a")
    else:  # many small tasks: one that works through several parts of a join holds the memory of all
        both = shared.side(pairs, seen["rows"]).join(second, "b").join(first, "a")
    near = both.select("a", "b", _similarity("text_a", "text_b").alias("s")).where(F.col("s") >= SIMILARITY).select("a", "b")
    links, seen = shared.measured(near, "verified")
    shared.discard(pairs)
    return links, seen["rows"]


def _mixed(members: DataFrame, found: DataFrame, n_found: int, rows: int) -> tuple[DataFrame, int]:
    """members (bkey, tid, ...) of buckets with several components, with root, n (of the bucket), outside and first.

    Outside is a member that isn't in the bucket's largest component; the others are in one
    component, so leaders from outside miss no pair. First is one member of the largest. Where
    members have led, n_due counts those outside that haven't.
    """
    few = lambda df: shared.sized(df, rows)
    weight = found.groupBy("root").agg(F.count("*").alias("weight"))
    known = found.join(shared.side(weight, n_found), "root").select(F.col("node").alias("tid"), "root", "weight")
    own = members.join(shared.side(known, n_found), "tid", "left").withColumns({"root": F.coalesce("root", "tid"), "weight": F.coalesce("weight", F.lit(1))})
    own = shared.written(few(own), "rooted")
    fresh = ~F.col("led") if "led" in members.columns else F.lit(True)
    held = few(own.groupBy("bkey", "root").agg(F.max("weight").alias("weight"), F.max("tid").alias("tid"), F.count("*").alias("n"), F.count_if(fresh).alias("n_due")))
    of = F.struct("weight", "root", "tid", "n_due")
    buckets = few(held.groupBy("bkey").agg(F.max(of).alias("most"), F.count("*").alias("parts"), F.sum("n").alias("n"), F.sum("n_due").alias("n_due")))
    buckets = buckets.where("parts > 1").select("bkey", "most", "n", (F.col("n_due") - F.col("most.n_due")).alias("n_due"))
    out = few(own.join(shared.side(buckets, rows), "bkey")).withColumns({"outside": F.col("root") != F.col("most.root"), "first": F.col("tid") == F.col("most.tid")})
    out, seen = shared.measured(out.drop("most", "weight"), "mixed")
    shared.discard(own)
    return out, seen["rows"]


def _pairs(leaders: DataFrame, members: DataFrame, near: F.Column, rows: int) -> DataFrame:
    """a < b of leaders (aliased l) and members (m) of their buckets in other components, if near."""
    both = shared.side(leaders, rows).alias("l").join(members.alias("m"), (F.col("l.bkey") == F.col("m.bkey")) & (F.col("l.root") != F.col("m.root")) & near)
    return both.select(F.least("l.tid", "m.tid").alias("a"), F.greatest("l.tid", "m.tid").alias("b"))


def _several(spread: DataFrame) -> tuple[DataFrame, int]:
    """The rows of spread (bkey, tid) whose bkey has more than one, written, and their number."""
    keys, seen = shared.measured(spread.groupBy("bkey").agg(F.count("*").alias("n")).where("n > 1").select("bkey"), "keys")
    members, held = shared.measured(spread.join(shared.side(keys, seen["rows"]), "bkey", "left_semi"), "members")
    shared.discard(keys)
    return members, held["rows"]


def _refined(crowd: DataFrame, rows: int) -> tuple[DataFrame, DataFrame, int]:
    """(bkey, tid, led of the fine buckets of several texts; tid, planes) of crowd (tid, text; so many rows), and the number of the first."""
    marked = shared.sized(crowd.repartition("tid"), rows, TEXTS).select("tid", _fine("text").alias("r")).select("tid", "r.*")
    marked = shared.written(marked, "refined")
    members, n = _several(marked.select(F.explode("fine").alias("bkey"), "tid"))
    return members.withColumn("led", F.lit(False)), marked.select("tid", *PLANES), n


def roots(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, root of all texts (by tid) that are near duplicates of others; nodes: tid, bands."""
    members, rows = _several(nodes.select(F.explode("bands").alias("bkey"), "tid"))
    wanted, seen = shared.measured(shared.sized(members.select("tid").distinct(), rows), "wanted")
    texts = docs.select(F.unhex(F.md5("text")).alias("tid"), "text").join(shared.side(wanted, seen["rows"]), "tid", "left_semi")
    of = {"size": F.coalesce(F.sum(F.octet_length("text")), F.lit(0))}
    texts, held = shared.measured(texts.groupBy("tid").agg(F.first("text").alias("text")), "texts", **of)

    lead = shared.sized(members.groupBy("bkey").agg(F.min("tid").alias("lead")), rows)
    star = members.join(shared.side(lead, rows), "bkey")
    pairs = star.where("tid != lead").select(F.col("lead").alias("a"), F.col("tid").alias("b"))
    links, n_links = _verified(pairs, texts, rows, held["size"])
    found, seen = shared.measured(components(links, n_links), "found")
    mixed, rows = _mixed(star, found, seen["rows"], rows)
    small = mixed.where(F.col("n") <= SMALL)
    untried = (F.col("l.tid") != F.col("l.lead")) & (F.col("m.tid") != F.col("m.lead"))
    pairs = _pairs(small.where("outside"), small, untried, rows)
    open_texts = texts.join(shared.side(shared.sized(mixed.groupBy("tid").agg(F.max("n").alias("n")), rows), rows), "tid")
    open_texts, held = shared.measured(open_texts, "open-texts", crowd=F.count_if(F.col("n") > SMALL), **of)
    crowd = held["crowd"]
    finer, sketches, fine_rows = _refined(open_texts.where(F.col("n") > SMALL), crowd) if crowd else (None, None, 0)
    turn = 0
    while True:
        links, n_links = _verified(pairs, open_texts, rows, held["size"])
        shared.discard(mixed)
        if turn == 0:  # the members of small buckets are done with
            shared.discard(members)
            shared.discard(texts)
            members, rows = finer, fine_rows
        if n_links:
            found, seen = shared.measured(merged(found, links, seen["rows"], n_links), "found")
        if not rows:
            return found
        mixed, rows = _mixed(members, found, seen["rows"], rows)
        shared.discard(members)
        due = F.col("outside") & ~F.col("led")
        leads = due & (F.pmod(F.xxhash64("tid", F.lit(turn)), F.ceil(F.col("n_due") / LEADERS)) == 0) if turn else F.col("first")
        marked = mixed.where("n_due > 0").withColumn("leads", leads).join(shared.side(sketches, crowd * WIDE), "tid")
        marked = shared.written(shared.sized(marked, rows), "marked")
        shared.discard(mixed)
        mixed = marked
        pairs = _pairs(mixed.where("leads"), mixed, _apart("l", "m") <= MOST_APART, rows * WIDE)
        following = mixed.where(F.col("n_due") > LEADERS) if turn else mixed
        members, left = shared.measured(following.select("bkey", "tid", (F.col("led") | (F.col("leads") & F.col("outside"))).alias("led")), "members")
        rows, turn = left["rows"], turn + 1


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, tid, class_id, class_size, kept: one row for each row of docs."""
    text = docs.select("doc_id", "text")
    marked = shared.written(text.select("doc_id", F.unhex(F.md5("text")).alias("tid"), _bands("text").alias("bands")), "bands")
    nodes = marked.where(F.size("bands") > 0).groupBy("tid").agg(F.first("bands").alias("bands"))
    found = roots(text, nodes)
    order = F.struct(F.col("doc_id").isNull().alias("x"), F.col("doc_id").alias("doc_id"), F.col("tid").alias("tid"))
    # Each text, then each class, is one row before anything is joined: partial sums take the copies.
    texts = marked.where("tid is not null").groupBy("tid").agg(F.count("*").alias("n"), F.min(order).alias("best"))
    texts = texts.join(found.withColumnRenamed("node", "tid"), "tid", "left").withColumn("root", F.coalesce("root", "tid"))
    texts = shared.written(texts, "rooted-texts")
    groups = texts.groupBy("root").agg(F.sum("n").alias("class_size"), F.min("best").alias("best")).where("class_size > 1")
    large = texts.drop("n", "best").join(groups, "root").select("tid", "class_size", F.col("best.tid").alias("_tid"), F.col("best.doc_id").alias("_id"))
    large = shared.written(large, "classes")
    joined = marked.select("doc_id", "tid").join(large, "tid", "left")
    single = F.col("class_size").isNull()
    first = (F.col("_tid") == F.col("tid")) & F.col("_id").eqNullSafe(F.col("doc_id"))
    return joined.select(
        "doc_id",
        "tid",
        F.when(single, F.col("doc_id")).otherwise(F.col("_id")).alias("class_id"),
        F.when(single, F.lit(1)).otherwise(F.col("class_size")).cast("long").alias("class_size"),
        (single | first).alias("kept"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs with one row of each class: that of the least doc_id, then the least text hash."""
    judged = classes(docs).where("tid is not null").groupBy("tid", "doc_id").agg(F.first("kept").alias("kept"), F.count("*").alias("copies"))
    special = judged.where("not kept or copies > 1").select("tid", F.col("doc_id").alias("_id"), F.col("kept").alias("_kept"))
    special, seen = shared.measured(special, "special", repeated=F.count_if("_kept"))
    row = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_doc"), F.unhex(F.md5("text")).alias("_tid"))
    joined = row.join(shared.side(special, seen["rows"]), (F.col("_tid") == F.col("tid")) & F.col("_doc").eqNullSafe(F.col("_id")), "left")
    out = joined.where("_kept is null").select("_row.*")
    if seen["repeated"]:
        once = joined.where("_kept").groupBy("_tid", "_doc").agg(F.first("_row").alias("_row"))
        out = out.unionByName(once.select("_row.*"))
    return out
