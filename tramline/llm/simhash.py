"""Operator 1, SimHash near-dedup by a binary trie self-join.

Fingerprint: 64 bits by majority over the XXH64 (seed 42) of the 3-word shingles of the lower-cased text, repeats
included; bit k is set if it is set in over half of them. Two fingerprints link at BUDGET (2) or fewer differing bits,
and groups are the connected components.

The join. With a budget of two, of the three blocks that 64 bits fall into one is equal in both of a linked pair. So
each distinct fingerprint goes into three tries, each with another block on top, and every trie is cut into the
subtrees below its top block; a subtree meets in one task. There the traversal starts from the pair (subtree,
subtree), descends a bit a round for all node pairs of the task at once, adds the differing bit of mixed child pairs,
and drops pairs over the budget. A trie is never built: a node is a range of the sorted fingerprints. A subtree of
more than SPLIT fingerprints is cut further, into the node pairs some bits below that are still within the budget, each
a group of its own, and these again while one is larger than that and bits are left, so that a task's group stays
small and no pair is lost. A task reads its rows sorted by group and holds HELD of them at a time.

A task does not emit pairs but, for each of its components, one row a member that names the smallest member: at most
as many rows as it read. Components of those stars are found by minimum labels with shortcuts, in DataFrame joins; all
labels are written to the shared folder each round, and nothing is collected but the number of changed rows.

Defined results: null, empty and wordless texts have fingerprint zero and link like any other; one or two words are
one shingle; rows with a null doc_id get a fingerprint, a null component and take no part in linking; repeated rows
each stay; a tie (exactly half) leaves a bit 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm import common

SEED, BUDGET, SHINGLE = 42, 2, 3
#: Widths of the three blocks; their sum is 64.
BLOCKS = (22, 21, 21)
#: Most distinct fingerprints of one subtree that meet in one group, and most bits that a larger one is cut by at once.
SPLIT, MOST_BITS = 20_000, 12
#: Node pairs held at once in a traversal, and rows of groups.
FRONTIER, HELD = 1 << 21, 200_000
#: How far each trie turns the bits to the left, and the rows of a star that share a salt.
TURNS, PART = (0, BLOCKS[0], BLOCKS[0] + BLOCKS[1]), 2_000


def fingerprint(text: bytes) -> int:
    """Unsigned fingerprint of a text in UTF-8; bytes.lower() and bytes.split() are A-Z and the six ASCII spaces."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    if len(words) <= SHINGLE:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        starts = [0, *ends[:-SHINGLE].tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, (ends[SHINGLE - 1 :] - 1).tolist(), strict=True)], np.uint64)
    votes = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 248):  # a block's votes fit in a byte
        bits = np.unpackbits(hashes[k : k + 248].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in (x for batch in batches for x in common.slices(batch)):
            fps = np.fromiter((fingerprint(x) for x in some.column(1).to_pylist()), np.uint64, some.num_rows)
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.utf8("text")).mapInArrow(run, "doc_id long, fp long")


# ---- the trie self-join


def rotated(fp: Column, by: int) -> Column:
    return fp if not by else F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by))


def subtrees(distinct: DataFrame, split: int = SPLIT, most_bits: int = MOST_BITS) -> DataFrame:
    """trie, top, lo, hi, q, r, first: each fingerprint (rotated: r) in each group that it takes part in. A group holds
    what lies below the nodes lo and hi, q bits below the top block; it is cut while it has more than split rows."""
    tries = F.array(*[F.struct(F.lit(k).alias("trie"), rotated(F.col("fp"), turn).alias("r"), F.shiftrightunsigned(rotated(F.col("fp"), turn), 64 - BLOCKS[k]).alias("top")) for k, turn in enumerate(TURNS)])
    zero = F.lit(0).cast("long")
    keys, columns = ["trie", "top", "lo", "hi"], ["trie", "top", "lo", "hi", "q", "r", "first"]
    rows = distinct.select("first", F.inline(tries)).select("trie", "top", zero.alias("lo"), zero.alias("hi"), F.lit(0).alias("q"), "r", "first")
    # masks of at most so many bits, by that number and by width
    masks = F.array(*[F.array(*[F.array(*[F.lit(m).cast("long") for m in range(1 << q) if m.bit_count() <= left]) for q in range(most_bits + 1)]) for left in range(BUDGET + 1)])
    width = F.when(F.col("trie") == 0, BLOCKS[0]).otherwise(BLOCKS[1])
    more = F.least(F.lit(most_bits), F.ceil(F.log2(F.col("count") / split)) + 2, 64 - F.col("width") - F.col("q")).cast("int")
    done = None
    while True:
        hot = rows.groupBy(*keys, "q").count().filter(F.col("count") > split).withColumn("width", width).filter("width + q < 64")
        hot = common.cut(hot.select(*keys, "width", more.alias("more")))
        if hot.isEmpty():
            return rows if done is None else done.unionByName(rows)
        cold = rows.join(hot, keys, "left_anti").select(columns)
        done = cold if done is None else done.unionByName(cold)
        rows = rows.join(hot, keys).withColumn("q", F.col("q") + F.col("more"))
        rows = rows.withColumn("node", F.expr("shiftrightunsigned(shiftleft(r, width), 64 - q)")).withColumn("apart", F.col("lo").bitwiseXOR(F.col("hi")))
        mask = F.explode(F.element_at(F.element_at(masks, (BUDGET + 1 - F.bit_count("apart")).cast("int")), F.col("more") + 1))
        rows = rows.withColumn("mask", mask).withColumn("other", F.col("node").bitwiseXOR(F.expr("shiftleft(apart, more)").bitwiseOR(F.col("mask"))))
        rows = common.cut(rows.select("trie", "top", F.least("node", "other").alias("lo"), F.greatest("node", "other").alias("hi"), "q", "r", "first"))


def traverse(r: np.ndarray, groups: np.ndarray, depth: int, lo: np.ndarray, hi: np.ndarray, q: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of linked fingerprints. r: rotated fingerprints, sorted within groups; groups: bounds of the
    groups; all of a group agree in their first depth bits. With q, a group holds the rows of node lo and then of hi."""
    start, end = groups[:-1], groups[1:]
    if q:  # the pair of nodes that the group stands for
        node = ((r << np.uint64(depth)) >> np.uint64(64 - q)).astype(np.int64)
        sums = np.concatenate([[0], np.cumsum(node == np.repeat(lo, end - start))])
        mid = np.where(lo == hi, end, start + sums[end] - sums[start])
        diff = np.bitwise_count(lo ^ hi).astype(np.int8)
        a0, a1, b0, b1 = start, mid, np.where(lo == hi, start, mid), end
    else:
        a0, a1, b0, b1, diff = start, end, start, end, np.zeros(len(start), np.int8)
    stack = [(depth + q, a0, a1, b0, b1, diff)]
    at, sums = -1, np.zeros(0, np.int64)
    while stack:
        depth, a0, a1, b0, b1, diff = stack.pop()
        if len(a0) > FRONTIER:  # later, so that memory stays bounded
            cut = len(a0) // 2
            stack += [(depth, a0[s], a1[s], b0[s], b1[s], diff[s]) for s in (slice(cut, None), slice(cut))]
            continue
        self_ = a0 == b0
        live = (a1 > a0) & (b1 > b0) & (diff <= BUDGET) & ~(self_ & (a1 - a0 < 2))
        a0, a1, b0, b1, diff, self_ = a0[live], a1[live], b0[live], b1[live], diff[live], self_[live]
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        if single.any():  # both paths are unbranched from here: count their differing bits at once
            i, j = a0[single], b0[single]
            near = np.bitwise_count(r[i] ^ r[j]) <= BUDGET
            yield i[near], j[near]
            a0, a1, b0, b1, diff, self_ = (x[~single] for x in (a0, a1, b0, b1, diff, self_))
        if not len(a0) or depth == 64:
            continue
        if at != depth:
            sums = np.concatenate([[0], np.cumsum((r >> np.uint64(63 - depth)) & np.uint64(1), dtype=np.int64)])
            at = depth
        am, bm = a1 - (sums[a1] - sums[a0]), b1 - (sums[b1] - sums[b0])
        cross = ~self_
        join = lambda *xs: np.concatenate(xs)
        more = diff + 1
        stack.append((
            depth + 1,
            join(a0, am, a0, am[cross]), join(am, a1, am, a1[cross]),
            join(b0, bm, bm, b0[cross]), join(bm, b1, b1, bm[cross]),
            join(diff, diff, more, more[cross]),
        ))


def components(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index reachable from each of n, pairs taken batch by batch."""
    label = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = label[i], label[j]
            low = np.minimum(a, b)
            if (a == b).all():
                break
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            while not np.array_equal(up := label[label], label):
                label = up
    return label


def links(distinct: DataFrame, split: int = SPLIT) -> DataFrame:
    """v, root, parts, label: a star for each component found in a subtree, of distinct (fp, first). The label is the
    smallest (first, fp) of the component; parts grows with its size, to deal a large star's rows to several tasks."""

    def stars_of(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """The stars of whole groups."""
        r = columns[5].view(np.uint64)
        trie, top, lo, hi, q, r, first = (x[np.lexsort((r, *columns[3::-1]))] for x in (*columns[:5], r, columns[6]))
        for t, turn in enumerate(TURNS):
            for bits in np.unique(q[trie == t]):
                own = np.flatnonzero((trie == t) & (q == bits))
                k = np.stack([top[own], lo[own], hi[own]])
                cuts = np.concatenate([[0], np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1, [len(own)]])
                large = np.flatnonzero(np.diff(cuts) > 1)
                own = own[np.repeat(np.diff(cuts) > 1, np.diff(cuts))]
                if not len(own):
                    continue
                bounds = np.concatenate([[0], np.cumsum(np.diff(cuts)[large])])
                rr, ids = r[own], first[own]
                label = components(len(rr), traverse(rr, bounds, BLOCKS[t], lo[own][bounds[:-1]], hi[own][bounds[:-1]], int(bits)))
                size = np.bincount(label, minlength=len(rr))[label]
                fp = (rr if not turn else (rr >> np.uint64(turn)) | (rr << np.uint64(64 - turn))).view(np.int64)
                by = np.lexsort((fp, ids, label))  # a component's smallest (first, fp) leads it
                leads = by[np.concatenate([[True], label[by][1:] != label[by][:-1]])]
                least = np.zeros(len(rr), np.int64)
                least[label[leads]] = leads
                lead, many = least[label], size > 1
                found = [fp[many], fp[lead][many], (size[many] // PART + 1).astype(np.int32), ids[lead][many]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["v", "root", "parts", "first"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole groups at a time, as rows come sorted by group."""
        held: list[list[np.ndarray]] = []
        rows = 0
        for b in batches:
            held.append([c.to_numpy() for c in b.columns])
            rows += b.num_rows
            if rows >= HELD:
                columns = [np.concatenate(x) for x in zip(*held, strict=True)]
                last = np.flatnonzero(np.any([x[1:] != x[:-1] for x in columns[:4]], axis=0))
                end = int(last[-1]) + 1 if len(last) else 0  # where the last group starts, which may go on
                if end:
                    yield from stars_of([x[:end] for x in columns])
                held = [[x[end:] for x in columns]]
                rows = len(columns[0]) - end
        if rows:
            yield from stars_of([np.concatenate(x) for x in zip(*held, strict=True)])

    groups = subtrees(distinct, split).repartition("trie", "top", "lo", "hi").sortWithinPartitions("trie", "top", "lo", "hi")
    stars = groups.mapInArrow(run, "v long, root long, parts int, first long")
    return stars.select("v", "root", "parts", F.struct("first", F.col("root").alias("fp")).alias("label"))


def connect(stars: DataFrame) -> DataFrame:
    """v, label of each vertex of the stars, the label now being the smallest of all that it is connected to.

    A round takes the smallest label of each star, then of each vertex; then all vertices that shared a label take the
    smallest that any of them found, and that label's own new label, so that rounds are few on any shape. A large star's
    rows carry one of parts salts, and its smallest label goes to each.
    """
    stars = common.cut(stars.withColumn("salt", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int")))
    labels = common.cut(stars.groupBy("v").agg(F.min("label").alias("label")))
    stars = stars.drop("label")
    while True:
        low = stars.join(labels, "v").groupBy("root").agg(F.min("label").alias("low"), F.max("parts").alias("parts"))
        low = low.select("root", "low", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"))
        near = stars.join(low, ["root", "salt"]).groupBy("v").agg(F.min("low").alias("low"))
        step = common.cut(labels.join(near, "v").select("v", F.col("label.fp").alias("was"), F.least("label", "low").alias("low")))
        groups = common.cut(step.groupBy("was").agg(F.min("low").alias("low")))
        up = groups.select(F.col("was").alias("to"), F.col("low").alias("lower"))
        moved = groups.withColumn("to", F.col("low.fp")).join(up, "to", "left").select("was", F.coalesce("lower", "low").alias("label"))
        changed = not groups.filter("low.fp <> was").isEmpty()
        after = common.cut(step.select("v", "was").join(moved, "was").select("v", "label"))
        common.drop(step, groups, labels)
        labels = after
        if not changed:
            return labels


def assign(prints: DataFrame, split: int = SPLIT, lead: bool = False) -> DataFrame:
    """doc_id, fp, component_id of documents' fingerprints (doc_id, fp), which should be written already; with lead also
    lead, the component's fingerprint of smallest (doc_id, fp)."""
    first = common.cut(prints.filter("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("first")))
    stars = common.cut(links(first, split))
    own = first.select("fp", F.col("first").alias("component_id"), F.col("fp").alias("lead"))
    if not stars.isEmpty():
        own = first.join(connect(stars).select(F.col("v").alias("fp"), "label"), "fp", "left")
        own = own.select("fp", F.coalesce("label.first", "first").alias("component_id"), F.coalesce("label.fp", "fp").alias("lead"))
    # under another key, so that both sides are dealt out anew and Spark can split the partition of a hot fingerprint
    own = common.cut(own.select(F.bitwise_not("fp").alias("key"), "component_id", *["lead"] * lead))
    joined = prints.withColumn("key", F.bitwise_not("fp")).join(own, "key", "left")
    return joined.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"), *["lead"] * lead)


def near_duplicates(docs: DataFrame, split: int = SPLIT) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row of docs (doc_id, text)."""
    prints = common.cut(fingerprints(docs))
    return assign(prints, split).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """docs without all but one row of each group, that of smallest doc_id and then fingerprint; of rows with equal both
    that of smallest text stays, rows without doc_id all stay. A doc_id with texts of several groups may stay in each."""
    groups = common.cut(assign(common.cut(fingerprints(docs.select("doc_id", "text"))), lead=True).filter("doc_id IS NOT NULL"))
    again = common.cut(groups.groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    gone = groups.filter(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    if again.isEmpty():
        return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    rest = docs.join(gone.union(again).distinct(), "doc_id", "left_anti").select(docs.columns)
    at = common.cut(docs.join(again, "doc_id", "left_semi").select(F.monotonically_increasing_id().alias("at"), F.struct(*docs.columns).alias("row")))
    own = fingerprints(at.select(F.col("at").alias("doc_id"), F.col("row.text").alias("text"))).select(F.col("doc_id").alias("at"), "fp")
    leads = groups.filter("doc_id = component_id AND fp = lead").select("doc_id", "fp").distinct()
    first = at.join(own, "at").select("at", F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.text").alias("text"), "fp").join(leads, ["doc_id", "fp"], "left_semi")
    first = first.groupBy("doc_id", "fp").agg(F.min(F.struct("text", "at")).alias("least")).select(F.col("least.at").alias("at"))
    return rest.unionByName(at.join(first, "at", "left_semi").select("row.*"))
