"""Operator 8, approximate nearest neighbours: inverted lists scanned by adaptive dimensions.

Nearness is the largest inner product, in double precision on the original vectors. Scaled by the largest norm and
filled to length one by a further coordinate, vectors turn it into the smallest Euclidean distance; then a random rotation
makes every block of columns a random sample of the distance. Lists are Voronoi cells of centroids. A query probes its
nearest lists. Within a list the rotated vectors, in single precision, are read in blocks of BLOCK columns: a candidate
whose partial distance, scaled up, fails the test against the query's bound is abandoned, and the survivors get the exact
measure. The bound allows for rounding (SLACK). In the nearest list it is the distance within which the probed lists hold
2 * TOP vectors of the sample below, so that enough always survive; in the others it is the lesser of that and the
distance of the last of the TOP + 1 found in the nearest list.

The centroids, and how many lists must be probed for RECALL of the true neighbours, are fitted on a bounded sample
(SAMPLE vectors, PILOT of them as queries); every vector is indexed. Equal vectors are searched once: only the TOP + 1
smallest ids of a vector can appear in a result, and each of its query rows takes the answer, less itself. Lists longer
than CHUNK, and lists probed by more than CHUNK queries, meet in blocks of both, so that no task gets an unbounded group;
a block gives at most TOP + 1 rows a query.

Defined results: vectors that are null, zero, of another length than most, or hold null or non-finite components take no
part, nor do rows with a null vec_id; scores too large for a double are infinite, and which of
those too small for one are found is open; of rows that share a vec_id the one with the smallest vector counts; ties go to
the smaller vec_id; fewer than TOP candidates give fewer rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm import common

TOP, EVERY = 20, 20
SAMPLE, PILOT, RECALL = 20_000, 256, 0.97
MOST_LISTS, ROUNDS = 2048, 6
BLOCK, EPSILON, CHUNK, SEED = 13, 2.1, 2048, 5
#: Rounding in single precision of squared distances between vectors of length one.
SLACK = (np.float32(1 + 1e-4), np.float32(1e-5))
FOUND = "uid long, vec_id long, score double"


def taking_part(rows: DataFrame) -> DataFrame:
    """vec_id, v: one usable vector for each id, in double precision unless it comes in single."""
    kind = rows.schema["embedding"].dataType.simpleString()
    v = F.col("embedding").cast(kind if kind == "array<float>" else "array<double>")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    rows = rows.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    rows = common.cut(rows.groupBy("vec_id").agg(F.min("v").alias("v")))
    size = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.filter(F.size("v") == (size[0]["d"] if size else 0))


def matrix(column: pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy().astype(np.float64).reshape(len(values), -1) if len(values) else np.zeros((0, 1))


class Index:
    """What tasks need to place and compare vectors: the largest component and norm, the rotation, centroids, and how many
    lists to probe."""

    def __init__(self, sample: np.ndarray, unit: float, norm: float, count: int):
        rng = np.random.default_rng(SEED)
        d = sample.shape[1] + 1
        self.unit, self.norm = unit, norm  # norm is that of vectors divided by unit
        self.turn = np.linalg.qr(rng.standard_normal((d, d)))[0].astype(np.float32)
        self.sample = x = self.rotated(sample)
        k = int(max(1, min(MOST_LISTS, np.sqrt(count) / 2, len(x))))
        self.centroids = x[rng.choice(len(x), k, replace=False)]
        for _ in range(ROUNDS if k > 1 else 0):
            own = self.nearest(x, 1)[:, 0]
            sums, sizes = np.zeros_like(self.centroids), np.bincount(own, minlength=k)
            np.add.at(sums, own, x)
            self.centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], self.centroids).astype(np.float32)
        self.own = self.nearest(x, 1)[:, 0]
        self.probes = self.needed(sample)

    def rotated(self, v: np.ndarray) -> np.ndarray:
        v = v / self.unit / self.norm
        fill = np.sqrt(np.maximum(0, 1 - (v**2).sum(axis=1)))
        return np.concatenate([v, fill[:, None]], axis=1).astype(np.float32) @ self.turn

    def turned(self, q: np.ndarray) -> np.ndarray:
        """Queries: their length doesn't matter for the order, so it is one, and nothing is filled."""
        q = q / np.abs(q).max(axis=1, keepdims=True, initial=0)
        q = q / np.sqrt((q**2).sum(axis=1, keepdims=True))
        return np.concatenate([q, np.zeros((len(q), 1))], axis=1).astype(np.float32) @ self.turn

    def distance(self, q: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Squared distance of candidates with such scores from queries, rounded up; infinite for none."""
        most = np.abs(q).max(axis=1, initial=0)
        length = np.sqrt(((q / most[:, None]) ** 2).sum(axis=1))
        far = 2 - 2 * (score / most / self.unit / length / self.norm)
        return np.where(np.isfinite(far), far, np.inf).astype(np.float32) * SLACK[0] + SLACK[1]

    def nearest(self, x: np.ndarray, k: int) -> np.ndarray:
        out = np.empty((len(x), k), np.int32)
        half = (self.centroids**2).sum(axis=1) / 2
        for a in range(0, len(x), 2048):
            far = half - x[a : a + 2048] @ self.centroids.T
            out[a : a + 2048] = np.argsort(far, axis=1, kind="stable")[:, :k] if k > 1 else far.argmin(axis=1)[:, None]
        return out

    def bounds(self, q: np.ndarray, probed: np.ndarray, k: int) -> np.ndarray:
        """Squared distance within which the probed lists have k vectors of the sample for each query."""
        if len(self.sample) < k:
            return np.full(len(q), np.inf, np.float32)
        size, out = (self.sample**2).sum(axis=1), []
        for a in range(0, len(q), 256):
            part = q[a : a + 256]
            read = np.zeros((len(part), len(self.centroids)), bool)
            np.put_along_axis(read, probed[a : a + 256], True, axis=1)
            far = np.where(read[:, self.own], size - 2 * part @ self.sample.T, np.inf)
            out.append(np.partition(far, k - 1, axis=1)[:, k - 1] + (part**2).sum(axis=1))
        return np.concatenate(out).astype(np.float32) * SLACK[0] + SLACK[1]

    def needed(self, sample: np.ndarray) -> int:
        """Lists to probe for RECALL of the sample's own neighbours."""
        lists = len(self.centroids)
        if lists == 1 or len(sample) <= TOP:
            return lists
        pilot = np.arange(min(PILOT, len(sample)))
        scaled = sample / self.unit
        score = scaled[pilot] @ scaled.T
        score[pilot, pilot] = -np.inf
        near = np.argpartition(-score, TOP - 1, axis=1)[:, :TOP]
        place = np.argsort(self.nearest(self.turned(sample[pilot]), lists), axis=1)
        ranks = np.sort(np.take_along_axis(place, self.own[near], axis=1), axis=None)
        return int(ranks[min(len(ranks) - 1, int(np.ceil(RECALL * len(ranks))))]) + 1


def scan(q: np.ndarray, x: np.ndarray, bound: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, candidate) of rotated rows at most bound apart (squared, by query), some queries at a time.

    After each block of columns a pair is abandoned if its partial distance, scaled to all columns, exceeds the bound
    by more than the test allows for so many columns. While most pairs live, a block is one matrix product; when they
    are few, only theirs are read on.
    """
    d = x.shape[1]
    for a in range(0, len(q), 128):
        part, most = q[a : a + 128], bound[a : a + 128]
        far, pairs = np.zeros((len(part), len(x)), np.float32), None
        for b in range(0, d, BLOCK):
            e = min(d, b + BLOCK)
            s = slice(b, e)
            slack = np.float32(e / d * (1 + EPSILON / np.sqrt(e)) ** 2 if e < d else SLACK[0])
            if pairs is None:
                far += (part[:, s] ** 2).sum(axis=1)[:, None] + (x[:, s] ** 2).sum(axis=1)
                far -= 2 * part[:, s] @ x[:, s].T
                live = far <= (most * slack + SLACK[1])[:, None]
                if np.count_nonzero(live) < 0.1 * live.size or e == d:
                    pairs = np.nonzero(live)
                    far = far[pairs]
            else:
                i, j = pairs
                far = far + ((part[i, s] - x[j, s]) ** 2).sum(axis=1)
                live = far <= most[i] * slack + SLACK[1]
                pairs, far = (i[live], j[live]), far[live]
        i, j = pairs
        yield i + a, j


def block_join(held: Broadcast, top: int):
    """The function of a block: candidates (uid, v, ids) against queries (uid, v, bound)."""

    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if candidates.num_rows and queries.num_rows:
            order = np.argsort(candidates.column("uid").to_numpy(), kind="stable")
            candidates = candidates.take(pa.array(order))
            x, q = matrix(candidates.column("v")), matrix(queries.column("v"))
            ids = candidates.column("ids").combine_chunks()
            flat, cuts = ids.flatten().to_numpy(), np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())])
            uid = queries.column("uid").to_numpy()
            for i, j in scan(held.value.turned(q), held.value.rotated(x), queries.column("bound").to_numpy()):
                score = (q[i] * x[j]).sum(axis=1)
                many = cuts[j + 1] - cuts[j]
                i, score = np.repeat(i, many), np.repeat(score, many)
                vec = flat[np.repeat(cuts[j], many) + np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)]
                order = np.lexsort((vec, -score, i))
                i, score, vec = i[order], score[order], vec[order]
                first = np.concatenate([[True], i[1:] != i[:-1]]) if len(i) else np.zeros(0, bool)
                rank = np.arange(len(i)) - np.maximum.accumulate(np.where(first, np.arange(len(i)), 0))
                out.append((uid[i[rank < top]], vec[rank < top], score[rank < top]))
        columns = [np.concatenate([o[k] for o in out]) if out else np.zeros(0) for k in range(3)]
        return pa.table({"uid": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})

    return run


def search(rows: DataFrame, top: int = TOP, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score of rows (vec_id, embedding), for the query rows whose id is divisible by every."""
    spark = rows.sparkSession
    rows = taking_part(rows)
    smallest = rows.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).filter(F.col("n") <= top + 1)
    distinct = smallest.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    # under another key, so that a join with many equal vectors deals both sides out anew and can split them
    distinct = common.cut(distinct.select(F.col("ids")[0].alias("uid"), "v", "ids", F.reverse("v").alias("key")))
    asks = rows.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.reverse("v").alias("key"))
    asks = common.cut(asks.join(distinct.select("key", "uid", "v"), "key").select("query_id", "uid", "v"))
    count = distinct.count()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    unit = distinct.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(x).cast("double"))))).first()[0]
    part = lambda x: x.cast("double") / unit
    norm = distinct.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + part(x) * part(x))))).first()[0]
    sample = matrix(distinct.orderBy(F.xxhash64("uid"), "uid").limit(SAMPLE).select("v").toArrow().column(0))
    held = spark.sparkContext.broadcast(Index(sample, unit, norm, count))
    v = distinct.schema["v"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                own = held.value.nearest(held.value.rotated(matrix(b.column(1))), 1)[:, 0]
                yield pa.RecordBatch.from_arrays([pa.array(own), *b.columns], names=["list", "uid", "v", "ids"])

    def probe(which: slice):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    x = matrix(b.column(1))
                    q = held.value.turned(x)
                    own = held.value.nearest(q, held.value.probes)
                    bound = held.value.bounds(q, own, 2 * top)
                    last = b.column(2).to_numpy(zero_copy_only=False)  # no number for none
                    bound = pa.array(np.minimum(bound, held.value.distance(x, last)))
                    own = own[:, which]
                    again = pa.array(np.repeat(np.arange(b.num_rows), own.shape[1]))
                    yield pa.RecordBatch.from_arrays([pa.array(own.ravel()), *(x.take(again) for x in (*b.columns[:2], bound))], names=["list", "uid", "v", "bound"])

        return run

    lists = common.cut(distinct.select("uid", "v", "ids").mapInArrow(place, f"list int, uid long, v {v}, ids array<long>"))
    sizes = common.cut(lists.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("rows")))
    order = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= top + 1)

    def meet(probes: DataFrame) -> DataFrame:
        """FOUND of probes (list, uid, v, bound): blocks of each list on either side, of at most MOST_LISTS lists."""
        probes = common.cut(probes)
        blocks = F.broadcast(common.cut(sizes.join(probes.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("asks")), "list")))
        part = lambda n: F.pmod(F.xxhash64("uid"), F.col(n)).cast("int")
        each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = lists.join(blocks, "list").select("list", part("rows").alias("a"), each("asks").alias("b"), "uid", "v", "ids")
        right = probes.join(blocks, "list").select("list", each("rows").alias("a"), part("asks").alias("b"), "uid", "v", "bound")
        keys = ["list", "a", "b"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(block_join(held, top + 1), FOUND)

    single = common.cut(asks.dropDuplicates(["uid"]).select("uid", "v"))
    probed = f"list int, uid long, v {v}, bound float"
    first = common.cut(best(meet(single.withColumn("last", F.lit(None).cast("double")).mapInArrow(probe(slice(0, 1)), probed))))
    last = first.filter(F.col("n") == top + 1).select("uid", F.col("score").alias("last"))
    rest = meet(single.join(last, "uid", "left").select("uid", "v", "last").mapInArrow(probe(slice(1, None)), probed))
    found = best(first.select("uid", "vec_id", "score").unionByName(rest))
    answers = common.cut(found.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near")))
    answers = answers.select(F.bitwise_not("uid").alias("key"), "near")
    near = asks.select("query_id", F.bitwise_not("uid").alias("key")).join(answers, "key")
    near = near.select("query_id", F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, top).alias("near"))
    return near.select("query_id", F.posexplode("near").alias("at", "x")).select("query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", "x.score")
