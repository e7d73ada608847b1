"""Operator 6, best-fit packing of documents into sequences of at most CAPACITY tokens, by linear grouping.

Tokens: a document's ids and then id 0. A longer document is cut into pieces of CAPACITY tokens from its end, so that
only its first piece can be shorter; every other document is one piece.

Pieces of one length are alike, so the plan is made from the histogram of lengths alone (at most CAPACITY rows, all
that the driver sees) and has a bounded number of rows at any input size:
1. Pieces longer than a threshold go, by falling length, into GROUPS groups of equal cardinality; each counts as long
   as the longest of its group.
2. Configurations (which group sizes share a sequence) are optimised over those few sizes: the largest size left is
   joined by the subset that fills the sequence best, found by a bit-set knapsack over the counts that are left, and
   the configuration is used as often as the counts allow.
3. The slots get the actual pieces of their group, by falling length, which frees the room that rounding took.
4. Small pieces go, by falling length, where they leave the least room; new sequences open only when none has room.
Where small ends is tried at each of SMALL, shares of the capacity, and the plan with fewest sequences is taken, the first
of equals.

A plan row says: of the pieces of this length, those ranked lo to hi go to sequences from seq on, per to a sequence,
from this offset on. Ranks need no global sort: a task numbers its pieces of each length as it cuts them, and the
tasks' counts are summed before it. A piece meets its plan row in a broadcast join with the bounded plan.

Defined results: a null or empty text is one piece of one token (id 0); rows with a null doc_id are packed like any
other; repeated rows each get a place; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm import common
from tramline.llm.bpe import byte_characters

CAPACITY, GROUPS = 2048, 32
SMALL = (0.25, 0.3125, 0.375, 0.4375, 0.5)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"
#: The byte-level tokenizer's own split, a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_BLANK = re.compile(r"\s{256}").search


class Tokens:
    """Ids as the tokenizers library gives them. The ranks of the same file's byte-level tokens go to tiktoken, which
    merges the same pairs many times as fast; texts with a special token's string, and texts with a long run of white
    space, on which tiktoken's pattern engine takes quadratic time and at last gives up, go to the tokenizers library itself."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(path)
        self.tool.no_truncation()
        self.tool.no_padding()
        added = self.tool.get_added_tokens_decoder()
        self.special = [x.content.encode() for x in added.values()]
        byte = {c: b for b, c in enumerate(byte_characters())}
        ranks = {bytes(byte[c] for c in token): i for token, i in self.tool.get_vocab(with_added_tokens=False).items()}
        self.fast = tiktoken.Encoding("fast", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: bytes) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        said = text.decode("utf-8", "replace")
        if LONG_BLANK(said) or any(x in text for x in self.special):
            return np.array(self.tool.encode(said, add_special_tokens=False).ids, "<u4").tobytes()
        return self.fast.encode_to_numpy(said, disallowed_special=()).astype("<u4").tobytes()


_made: dict[str, Tokens] = {}


def shared(path: str) -> Tokens:
    if path not in _made:
        _made[path] = Tokens(path)
    return _made[path]


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """PIECES of docs (doc_id, text): part and place number the pieces of each length within a task."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = shared(path), TaskContext.get().partitionId()
        placed = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for some in common.slices(batch):
                rows = []
                for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    ids = tokens.encode(text) + b"\0\0\0\0"
                    n = len(ids) // 4
                    first = n % capacity or capacity
                    for k, end in enumerate(range(first, n + 1, capacity)):
                        start = max(0, end - capacity) if k else 0
                        rows.append((doc_id, k, start, end - start, zlib.crc32(ids[4 * start : 4 * end]), part, int(placed[end - start])))
                        placed[end - start] += 1
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=[x.split()[0] for x in PIECES.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.utf8("text")).mapInArrow(run, PIECES)


# ---- the plan, from a histogram


def groups_of(counts: dict[int, int], most: int) -> list[list[list[int]]]:
    """Groups of equal cardinality, by falling length; a group is its runs [length, count]."""
    total = sum(counts.values())
    size = max(1, -(-total // most))
    out: list[list[list[int]]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            if not room:
                out.append([])
                room = size
            take = min(n, room)
            out[-1].append([length, take])
            n, room = n - take, room - take
    return out


def best_subset(sizes: list[int], counts: list[int], room: int) -> dict[int, int]:
    """How many of each size (by index, sizes falling) fill the room best, larger sizes first."""
    full = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for k in range(len(sizes) - 1, -1, -1):
        if counts[k] and sizes[k] <= room:
            steps.append((k, reach))
            for _ in range(min(counts[k], room // sizes[k])):
                more = reach | (reach << sizes[k]) & full
                if more == reach:
                    break
                reach = more
    at, used = reach.bit_length() - 1, {}
    for k, before in reversed(steps):
        n = 0
        while n < counts[k] and at >= sizes[k] and (not before >> at & 1 or n == 0 and _reaches(before, at - sizes[k], sizes[k], counts[k] - 1)):
            at -= sizes[k]
            n += 1
        if n:
            used[k] = n
    return used


def _reaches(before: int, at: int, size: int, copies: int) -> bool:
    """Whether at is a sum of what was reachable before and at most so many copies."""
    while at >= 0 and copies >= 0:
        if before >> at & 1:
            return True
        at, copies = at - size, copies - 1
    return False


def configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[int, list[int]]]:
    """(multiplicity, group indices) that use up the counts; sizes fall."""
    left, out = list(counts), []
    for k in range(len(sizes)):
        while left[k]:
            left[k] -= 1
            used = best_subset(sizes, left, capacity - sizes[k])
            left[k] += 1
            used[k] = used.get(k, 0) + 1
            times = min(left[j] // n for j, n in used.items())
            for j, n in used.items():
                left[j] -= times * n
            out.append((times, [j for j in sorted(used) for _ in range(used[j])]))
    return out


def sequences(rows: list[tuple[int, int, int, int, int, int]]) -> int:
    return max((seq + -(-(hi - lo) // per) for _, lo, hi, per, seq, _ in rows), default=0)


def plan(histogram: dict[int, int], capacity: int = CAPACITY, small: tuple[float, ...] = SMALL, most: int = GROUPS) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, lo, hi, per, seq, offset) that place every piece of the histogram."""
    return min((plan_at(histogram, capacity, int(share * capacity), most) for share in small), key=sequences)


def plan_at(histogram: dict[int, int], capacity: int, small: int, most: int) -> list[tuple[int, int, int, int, int, int]]:
    """The plan where pieces of at most small are small."""
    rows: list[tuple[int, int, int, int, int, int]] = []
    ranks = dict.fromkeys(histogram, 0)
    opened = 0
    rooms: dict[int, list[tuple[int, int]]] = {}  # free room: (first sequence, sequences)

    def place(length: int, n: int, per: int, seq: int, offset: int) -> None:
        rows.append((length, ranks[length], ranks[length] + n, per, seq, offset))
        ranks[length] += n

    groups = groups_of({k: n for k, n in histogram.items() if k > small}, most)
    shapes = configurations([g[0][0] for g in groups], [sum(n for _, n in g) for g in groups], capacity)
    for times, config in shapes:
        bins = [(times, 0)]  # runs of sequences that end alike, in order: how many, and where they end
        for g in config:
            after: list[tuple[int, int]] = []
            at = opened
            for n, end in bins:
                while n:
                    run = groups[g][0]
                    take = min(n, run[1])
                    place(run[0], take, 1, at, end)
                    run[1] -= take
                    if not run[1]:
                        groups[g].pop(0)
                    after.append((take, end + run[0]))
                    at, n = at + take, n - take
            bins = after
        at = opened
        for n, end in bins:
            rooms.setdefault(capacity - end, []).append((at, n))
            at += n
        opened += times
    free = sorted(rooms)
    for length in sorted((k for k in histogram if k <= small), reverse=True):
        n = histogram[length]
        while n:
            k = bisect_left(free, length)
            if k == len(free):
                per = capacity // length
                new = -(-n // per)
                rooms.setdefault(capacity, []).append((opened, new))
                opened += new
                insort(free, capacity)
                continue
            room = free[k]
            seq, bins = rooms[room].pop()
            per = min(room // length, n)
            used = min(bins, n // per)
            place(length, used * per, per, seq, capacity - room)
            n -= used * per
            if used < bins:
                rooms[room].append((seq + used, bins - used))
            if not rooms[room]:
                del rooms[room]
                free.pop(k)
            rest = room - per * length
            if rest not in rooms:
                insort(free, rest)
            rooms.setdefault(rest, []).append((seq, used))
    return rows


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, small: tuple[float, ...] = SMALL, most: int = GROUPS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of docs (doc_id, text)."""
    spark = docs.sparkSession
    cut = common.cut(pieces(docs, path, capacity))
    counts = common.cut(cut.groupBy("length", "part").agg(F.max("place").alias("n")).withColumn("n", F.col("n") + 1))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    placed = spark.createDataFrame(plan(histogram, capacity, small, most), "length long, lo long, hi long, per long, seq long, at long")
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    ranked = cut.join(counts.select("length", "part", before.alias("before")), ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("place")).alias("a")
    found = ranked.join(F.broadcast(placed.alias("b")), F.expr("a.length = b.length AND rank >= lo AND rank < hi"))
    return found.select(
        "doc_id", "piece", "start", "a.length", "ids_crc32",
        F.expr("seq + (rank - lo) div per").alias("sequence_id"), F.expr("at + (rank - lo) % per * a.length").alias("offset"),
    )
