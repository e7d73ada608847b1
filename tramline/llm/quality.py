"""Operator 4, quality rules: base counts, and a hashed n-gram log-likelihood ratio of every document.

Two multinomials over BUCKETS hashed byte n-grams (GRAM bytes; byte n-grams see casing, marks and layout, and are
dense in small corpora too): the raw corpus, counted over all documents, and the trusted target, counted over all
documents that labels mark with quality 1. With the target's counts scaled to the raw total and PRIOR added to both,
a document's ratio is the mean over its n-grams of ln(target / raw), and it is kept if the ratio is at least
THRESHOLD and the base rules don't fail it. Counts are exact sums over tasks; the model is BUCKETS numbers whatever
the corpus. The threshold lies between running text (about 0, above -0.25 even in small corpora) and junk (below
-0.7), as measured on the labelled rows.

Texts are read where they lie: the labels of good documents go to each task if they are at most BROADCAST (counted
first), and else meet the documents in a shuffled join.

Defined results: a null text has no words; a document without an n-gram has ratio 0; without any target the ratio is
0 for all; rows with a null doc_id are counted and judged like others; repeated rows each count and stay; an empty
table gives no rows; other columns are ignored (the filter keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm import common

BUCKETS, GRAM, PRIOR, THRESHOLD = 1 << 16, 4, 5.0, -0.4
MIN_WORDS, MOST_REPEATED = 50, 50
BROADCAST = 1_000_000  # about 16 MB
SYMBOLS = b"#*$%&|<>"
RESULT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, llr double, kept boolean"


def grams(text: bytes) -> np.ndarray:
    """Bucket of each n-gram of a text."""
    b = np.frombuffer(text, np.uint8)
    n = len(b) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    h = b[:n].astype(np.uint32)
    for k in range(1, GRAM):
        h <<= np.uint32(8)
        h |= b[k : k + n]
    h *= np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    return h >> np.uint32(16)


def base(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    n = len(words)
    if not n:
        return 0, 0, 0, 0, 0
    joined = np.frombuffer(b"".join(words), np.uint8)
    chars = int(np.count_nonzero((joined & 0xC0) != 0x80))
    seen: set[bytes] = set()
    twice = 0
    for line in text.split(b"\n"):
        if line in seen:
            twice += 1
        elif line.strip():
            seen.add(line)
    return n, chars, len(text) - len(text.translate(None, SYMBOLS)), twice, repeated(words)


def repeated(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    pair = w[:-1] * len(ids) + w[1:]
    if len(ids) >= 1 << 20:  # three ids no longer fit in 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(ids) + w[2:]
    order = np.argsort(window, kind="stable")
    same = window[order][1:] == window[order][:-1]
    if not same.any():
        return 0
    hit = np.zeros(n, bool)
    at = order[np.append(same, False) | np.append(False, same)]
    for k in range(3):
        hit[at + k] = True
    return int(np.count_nonzero(hit))


def counts(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Two rows of BUCKETS counts: of all documents, and of those of quality 1."""
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("good", F.lit(True))
    few = good.count() <= BROADCAST
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.utf8("text"))
    marked = docs.join(F.broadcast(good) if few else good, "doc_id", "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BUCKETS), np.int64)
        for some in (x for batch in batches for x in common.slices(batch, column=0)):
            for text, flag in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                found = np.bincount(grams(text), minlength=BUCKETS)
                sums[0] += found
                if flag:
                    sums[1] += found
        own = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(sums[0][own]), pa.array(sums[1][own])], names=["bucket", "raw", "target"])

    rows = marked.mapInArrow(run, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    out = np.zeros((2, BUCKETS), np.int64)  # at most BUCKETS rows come to the driver
    bucket = rows.column(0).to_numpy()
    out[0, bucket], out[1, bucket] = rows.column(1).to_numpy(), rows.column(2).to_numpy()
    return out


def weights(found: np.ndarray) -> np.ndarray:
    raw, target = found.astype(np.float64)
    if not target.sum():
        return np.zeros(BUCKETS)
    return np.log((target * (raw.sum() / target.sum()) + PRIOR) / (raw + PRIOR))


def judge(text: bytes, ratio: np.ndarray) -> tuple[int, int, int, int, int, bool, float, bool]:
    found = base(text)
    failed = found[0] < MIN_WORDS or 100 * found[4] > MOST_REPEATED * found[0]
    own = grams(text)
    llr = float(ratio[own].mean()) if len(own) else 0.0
    return *found, failed, llr, not failed and llr >= THRESHOLD


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """RESULT of every row of docs (doc_id, text)."""
    ratio = docs.sparkSession.sparkContext.broadcast(weights(counts(docs, labels)))
    names = [x.split()[0] for x in RESULT.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.bool_(), pa.float64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in (x for batch in batches for x in common.slices(batch)):
            rows = [judge(x, ratio.value) for x in some.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([some.column(0), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds[1:]))], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.utf8("text")).mapInArrow(run, RESULT)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that the rules reject."""
    ratio = docs.sparkSession.sparkContext.broadcast(weights(counts(docs, labels)))
    return common.filtered(docs, lambda: lambda found: [judge(x, ratio.value)[-1] for x in found])
