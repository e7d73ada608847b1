"""Operator 2, toxicity: a bidirectional GRU with attention pooling over word and character inputs, in numpy.

A word's input is the embedding of the word (of those frequent in the training sample; others share a zero row) next
to the mean embedding of its hashed character trigrams. Windows of WINDOW words start every STRIDE words and cover the
whole text (words lie between Unicode white space, and one of more than LONG bytes is cut into overlapping pieces, so that
texts without spaces have windows too); each is read in both directions, pooled by attention and given a logit. The
largest logit of a text, scaled on training documents that took no part in the fit, is its score.

Training: labels come only from rows whose crc32(doc_id as text) mod 5 is not 0, and of these from a bounded sample:
the SAMPLE (toxic, other) rows first by hash of doc_id, whatever their length; of a document of more than PASSAGES *
PASSAGE words, as many passages from all over it train, first by hash. A document's label holds for some window only, so each epoch trains on the windows with the largest logits, and on random others of
documents that aren't toxic. Labels are noisy: after TRIM epochs, documents that the model firmly contradicts rest.
labels, lang, source and doc_id are no inputs of a score.

Defined results: null, empty and wordless texts score 0.0; without labels of both kinds every score is 0.0; of labels
repeated for a doc_id the largest counts; rows with a null doc_id are scored, and aren't held out; repeated rows each
stay; an empty table gives no rows; other columns are ignored (the filter keeps them).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm import common

WINDOW, STRIDE, HIDDEN = 32, 16, 8
WORD_DIM, CHAR_DIM, TRIGRAMS, MIN_DOCS = 12, 12, 4096, 4
SAMPLE = (1500, 3000)
#: Of a longer training document, so many passages of so many words, first by hash.
PASSAGES, PASSAGE = 12, 128
EPOCHS, WIDE, TRIM, BATCH, RATE, SEED = 8, 3, 6, 128, 0.01, 7
KNOWN, MET, BLOCK = 300_000, 50_000, 4096
#: A longer word (in bytes) has no spaces to go by, and is read in pieces of that many characters.
LONG, PIECE = 96, 8
#: ASCII in lower case and separators as spaces; and the UTF-8 of other white space.
LOWER = bytes(32 if 28 <= x < 32 else x + 32 if 65 <= x <= 90 else x for x in range(256))
SPACES = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2(?:\x80[\x80-\x8a\xa8\xa9\xaf]|\x81\x9f)|\xe3\x80\x80")
MARKS = bytes(x for x in range(33, 127) if not chr(x).isalnum())
RESULT = "doc_id long, held_out boolean, score double, predicted int"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


# ---- inputs


def words_of(text: bytes) -> list[bytes]:
    """The words between Unicode white space; a word of more than LONG bytes as overlapping pieces of characters."""
    low = text.translate(LOWER)
    words = (low if low.isascii() else SPACES.sub(b" ", low)).split()
    if max(map(len, words), default=0) <= LONG:
        return words
    return [piece for w in words for piece in ([w] if len(w) <= LONG else pieces(w.decode("utf-8", "surrogateescape")))]


def excerpt(text: bytes) -> bytes:
    """What trains of a text: all its words, or PASSAGES passages of them in their order."""
    words = words_of(text)
    if len(words) <= PASSAGES * PASSAGE:
        return text
    passages = [b" ".join(words[k : k + PASSAGE]) for k in range(0, len(words), PASSAGE)]
    first = sorted(range(len(passages)), key=lambda k: (zlib.crc32(passages[k]), k))[:PASSAGES]
    return b" ".join(passages[k] for k in sorted(first))


def pieces(word: str) -> list[bytes]:
    """PIECE characters from every PIECE // 2nd on; the last ends with the word."""
    return [word[k : k + PIECE].encode("utf-8", "surrogateescape") for k in range(0, max(1, len(word) - PIECE // 2), PIECE // 2)]


def trigrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every character trigram of the words, boundaries marked, and where each word's begin."""
    flat = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in words), np.uint8).astype(np.uint32)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 2)
    h = (flat[:-2] << np.uint32(16) | flat[1:-1] << np.uint32(8) | flat[2:]) * np.uint32(0x9E3779B1)
    h = (h >> np.uint32(20)).astype(np.int64)
    keep = np.ones(len(h), bool)
    for k in (1, 2):  # not across words
        keep[(ends - k)[ends - k < len(h)]] = False
    starts = np.concatenate([[0], ends[:-1]])
    return h[keep], starts - 2 * np.arange(len(words))


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end (in the words of all texts) of each window, and its text; texts without words have none."""
    n = np.where(lengths > 0, np.maximum(1, -(-(lengths - (WINDOW - STRIDE)) // STRIDE)), 0)
    of = np.repeat(np.arange(len(lengths)), n)
    first = np.cumsum(lengths) - lengths
    k = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    start = first[of] + STRIDE * k
    return start, np.minimum(start + WINDOW, first[of] + lengths[of]), of


# ---- the network; sigmoid(x) is computed as (1 + tanh(x / 2)) / 2


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def summed(rows: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """n rows, each the sum of those rows that name it."""
    out = np.zeros((n, rows.shape[1]), np.float32)
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    out[at[first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


class Features(NamedTuple):
    """What the inputs of words are made from: rows of word, buckets of char, where each word's begin and how many."""

    rows: np.ndarray
    buckets: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    def some(self, k: np.ndarray) -> Features:
        sizes = self.sizes[k]
        starts = np.cumsum(sizes) - sizes
        return Features(self.rows[k], self.buckets[np.arange(sizes.sum()) + np.repeat(self.starts[k] - starts, sizes)], starts, sizes)


class Net:
    """Parameters, forward and backward pass. A gate block is ordered reset, update, new."""

    def __init__(self, vocabulary: dict[bytes, int], rng: np.random.Generator):
        d, h = WORD_DIM + CHAR_DIM, HIDDEN
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.vocabulary = vocabulary
        self.p = {
            "word": (0.3 * rng.standard_normal((len(vocabulary) + 1, WORD_DIM))).astype(np.float32),
            "char": (0.5 * rng.standard_normal((TRIGRAMS, CHAR_DIM))).astype(np.float32),
            "A": draw(2 * h, h), "a": np.zeros(h, np.float32), "v": draw(h), "o": draw(2 * h), "c": np.zeros(1, np.float32),
        }
        self.p["word"][0] = 0
        for s in "fb":
            self.p |= {f"W{s}": draw(d, 3 * h), f"U{s}": draw(h, 3 * h), f"b{s}": np.zeros(3 * h, np.float32)}
        self.scale = np.array([1.0, 0.0])

    def features(self, words: list[bytes]) -> Features:
        get = self.vocabulary.get
        rows = np.fromiter((get(w.strip(MARKS) or w, 0) for w in words), np.int64, len(words))
        buckets, starts = trigrams(words)
        return Features(rows, buckets, starts, np.diff(np.append(starts, len(buckets))))

    def inputs(self, of: Features) -> np.ndarray:
        """The input vector of each word."""
        chars = np.add.reduceat(self.p["char"][of.buckets], of.starts, axis=0) / of.sizes[:, None].astype(np.float32)
        return np.concatenate([self.p["word"][of.rows], chars], axis=1)

    def read(self, projected: np.ndarray, at: np.ndarray, side: str, keep: list | None = None) -> np.ndarray:
        """States (T, B, HIDDEN) of one direction over words at (B, T) of the projected inputs."""
        h, u = HIDDEN, self.p[f"U{side}"]
        state = np.zeros((len(at), h), np.float32)
        out = np.empty((at.shape[1], len(at), h), np.float32)
        for t in range(at.shape[1]) if side == "f" else range(at.shape[1] - 1, -1, -1):
            x, hu = projected[at[:, t]], state @ u
            gates = sigmoid(x[:, : 2 * h] + hu[:, : 2 * h])
            reset, update = gates[:, :h], gates[:, h:]
            new = np.tanh(x[:, 2 * h :] + reset * hu[:, 2 * h :])
            if keep is not None:
                keep.append((t, state, reset, update, new, hu[:, 2 * h :]))
            state = new + update * (state - new)
            out[t] = state
        return out

    def project(self, x: np.ndarray, side: str) -> np.ndarray:
        return x @ self.p[f"W{side}"] + self.p[f"b{side}"]

    def pool(self, states: np.ndarray, mask: np.ndarray) -> tuple:
        """Logits (B) of states (T, B, 2 HIDDEN) by attention over the words that mask (T, B) has."""
        tanh = np.tanh(states @ self.p["A"] + self.p["a"])
        score = np.where(mask, tanh @ self.p["v"], np.float32(-1e9))
        weight = np.exp(score - score.max(axis=0))
        weight /= weight.sum(axis=0)
        context = np.einsum("tb,tbh->bh", weight, states)
        return context @ self.p["o"] + self.p["c"][0], context, weight, tanh

    def step(self, of: Features, at: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss and gradients of windows at (B, T) of the words, -1 for none; the last row of inputs stands for it."""
        h, p = HIDDEN, self.p
        x, words = self.inputs(of), len(of.rows)
        at = np.where(at < 0, words, at)
        kept: dict[str, list] = {"f": [], "b": []}
        states = []
        for s in "fb":
            pad = np.array([0] * h + [30] * h + [0] * h, np.float32)  # keeps the state
            states.append(self.read(np.vstack([self.project(x, s), pad]), at, s, kept[s]))
        states = np.concatenate(states, axis=2)
        logit, context, weight, tanh = self.pool(states, mask)
        y = sigmoid(logit)
        loss = float(-np.mean(label * np.log(y + 1e-7) + (1 - label) * np.log(1 - y + 1e-7)))
        g = {k: np.zeros_like(v) for k, v in p.items()}
        dl = ((y - label) / len(label)).astype(np.float32)
        g["c"][0], g["o"] = dl.sum(), context.T @ dl
        dc = dl[:, None] * p["o"]
        dw = np.einsum("bh,tbh->tb", dc, states)
        ds = weight * (dw - (weight * dw).sum(axis=0))
        dstates = weight[:, :, None] * dc
        g["v"] = np.einsum("tb,tbk->k", ds, tanh)
        dt = ds[:, :, None] * p["v"] * (1 - tanh * tanh)
        g["A"], g["a"] = np.einsum("tbh,tbk->hk", states, dt), dt.sum(axis=(0, 1))
        dstates = dstates + dt @ p["A"].T
        dx = np.zeros_like(x)
        for k, s in enumerate("fb"):
            u, dh = p[f"U{s}"], np.zeros((len(at), h), np.float32)
            gates = np.empty((at.shape[1], len(at), 3 * h), np.float32)
            for t, before, reset, update, new, hn in reversed(kept[s]):
                dh = dh + dstates[t, :, k * h : (k + 1) * h]
                dn = dh * (1 - update) * (1 - new * new)
                dz = dh * (before - new) * update * (1 - update)
                dr = dn * hn * reset * (1 - reset)
                dhu = np.concatenate([dr, dz, dn * reset], axis=1)
                gates[t, :, :h], gates[t, :, h : 2 * h], gates[t, :, 2 * h :] = dr, dz, dn
                g[f"U{s}"] += before.T @ dhu
                dh = dh * update + dhu @ u.T
            dp = summed(gates.reshape(-1, 3 * h), at.T.ravel(), words + 1)[:words]
            g[f"W{s}"], g[f"b{s}"] = x.T @ dp, dp.sum(axis=0)
            dx += dp @ p[f"W{s}"].T
        g["word"] = summed(dx[:, :WORD_DIM], of.rows, len(p["word"]))
        g["word"][0] = 0
        g["char"] = summed(np.repeat(dx[:, WORD_DIM:] / of.sizes[:, None].astype(np.float32), of.sizes, axis=0), of.buckets, TRIGRAMS)
        return loss, g


def window_logits(net: Net, tables: dict[str, np.ndarray], flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Logit of each window of flat, rows of the projected tables (row 0 is the pad)."""
    out = np.empty(len(start), np.float32)
    offsets = np.arange(WINDOW)
    for k in range(0, len(start), BLOCK):
        at = start[k : k + BLOCK, None] + offsets
        mask = at < end[k : k + BLOCK, None]
        at = np.where(mask, flat[np.minimum(at, len(flat) - 1)], 0)
        states = np.concatenate([net.read(tables[s], at, s) for s in "fb"], axis=2)
        out[k : k + BLOCK] = net.pool(states, mask.T)[0]
    return out


def largest(logit: np.ndarray, of: np.ndarray, texts: int) -> np.ndarray:
    best = np.full(texts, -np.inf)
    np.maximum.at(best, of, logit)
    return best


class Scorer:
    """Scores texts with a net; keeps the projected inputs of the words that it has met."""

    def __init__(self, net: Net):
        self.net = net
        self.clear()

    def clear(self) -> None:
        h = HIDDEN
        pad = np.array([[0] * h + [30] * h + [0] * h], np.float32)
        self.ids: dict[bytes, int] = {}
        self.tables, self.size = {s: np.repeat(pad, 1024, axis=0) for s in "fb"}, 1  # row 0 is the pad

    def learn(self, words: list[bytes]) -> None:
        for k in range(0, len(words), MET):
            some = words[k : k + MET]
            x = self.net.inputs(self.net.features(some))
            need = self.size + len(some)
            for s in "fb":
                if need > len(self.tables[s]):
                    more = np.empty((max(need, 2 * len(self.tables[s])), 3 * HIDDEN), np.float32)
                    more[: self.size] = self.tables[s][: self.size]
                    self.tables[s] = more
                self.tables[s][self.size : need] = self.net.project(x, s)
            self.ids.update(zip(some, range(self.size, need), strict=True))
            self.size = need

    def logits(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logit of every window, its start and its text."""
        if self.size > KNOWN:
            self.clear()
        cut = [words_of(x) for x in texts]
        self.learn(list(set().union(*cut) - self.ids.keys()) if cut else [])
        ids = self.ids
        flat = np.array([ids[w] for words in cut for w in words] + [0], np.int64)
        lengths = np.fromiter(map(len, cut), np.int64, len(cut))
        start, end, of = windows(lengths)
        return window_logits(self.net, self.tables, flat, start, end), start, of

    def scores(self, texts: list[bytes]) -> np.ndarray:
        logit, _, of = self.logits(texts)
        best = largest(logit, of, len(texts))
        a, b = self.net.scale
        return np.where(np.isfinite(best), 1 / (1 + np.exp(-np.clip(a * np.where(np.isfinite(best), best, 0) + b, -30, 30))), 0.0)


# ---- training


def fit(texts: list[bytes], toxic: list[int], share: float | None = None) -> Net | None:
    """A net for texts and their labels, or None without both kinds. share: of toxic ones among all labelled rows, if
    the texts are drawn by kind."""
    label = np.array(toxic, np.int64)
    if not len(label) or label.min() == label.max():
        return None
    rng = np.random.default_rng(SEED)
    apart = np.array([zlib.crc32(x) % 5 == 0 for x in texts])  # for the scale only; equal texts stay together
    if not (len({*label[apart].tolist()}) == 2 and len({*label[~apart].tolist()}) == 2):
        apart = np.zeros(len(texts), bool)
    seen: dict[bytes, int] = {}
    ids: dict[bytes, int] = {}
    read = []  # words as numbers, text by text, as the words themselves take ten times the room
    for text, held in zip(texts, apart.tolist(), strict=True):
        words = words_of(text)
        read.append(np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int32, len(words)))
        for w in {x.strip(MARKS) for x in words} if not held else ():
            seen[w] = seen.get(w, 0) + 1
    net = Net({w: k + 1 for k, w in enumerate(sorted(w for w, n in seen.items() if n >= MIN_DOCS and w))}, rng)
    names = sorted(ids)
    rank = np.empty(len(names) + 1, np.int64)
    rank[[ids[w] for w in names]] = np.arange(len(names))
    flat = np.append(rank[np.concatenate(read)], 0)
    start, end, of = windows(np.array([len(x) for x in read]))
    del read, ids, seen
    given = net.features(names)

    def now() -> np.ndarray:
        """Logit of every window, as the net stands."""
        pad = np.array([[0] * HIDDEN + [30] * HIDDEN + [0] * HIDDEN], np.float32)
        tables = {s: [pad] for s in "fb"}
        for k in range(0, len(names), MET):
            x = net.inputs(given.some(np.arange(k, min(k + MET, len(names)))))
            for s in "fb":
                tables[s].append(net.project(x, s))
        return window_logits(net, {s: np.concatenate(x) for s, x in tables.items()}, flat + 1, start, end)

    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    count = 0
    for epoch in range(EPOCHS):
        if epoch < WIDE or epoch % 2 == 0:
            logit = now()
        order = np.lexsort((-logit, of))
        rank = np.empty(len(of), np.int64)
        firsts = np.concatenate([[True], of[order][1:] != of[order][:-1]])
        rank[order] = np.arange(len(of)) - np.maximum.accumulate(np.where(firsts, np.arange(len(of)), 0))
        usable = ~apart[of]
        if epoch >= TRIM:
            best = largest(logit, of, len(texts))
            usable &= ~(((label == 1) & (best < -1)) | ((label == 0) & (best > 1)))[of]
        most = np.where(label[of] == 1, 6 if epoch < WIDE else 1, 2)
        chosen = usable & ((rank < most) | ((label[of] == 0) & (rng.random(len(of)) < 0.1)))
        batch = rng.permutation(np.flatnonzero(chosen))
        for k in range(0, len(batch), BATCH):
            own = batch[k : k + BATCH]
            at = start[own][:, None] + np.arange(WINDOW)
            mask = at < end[own][:, None]
            word = flat[np.minimum(at, len(flat) - 1)]
            distinct, inverse = np.unique(word[mask], return_inverse=True)
            at = np.full(word.shape, -1)
            at[mask] = inverse
            _, g = net.step(given.some(distinct), at, mask.T, label[of[own]].astype(np.float32))
            count += 1
            rate = RATE * (1 - epoch / EPOCHS) * np.sqrt(1 - 0.999**count) / (1 - 0.9**count)
            for name, d in g.items():
                m, v = moments[name]
                m += 0.1 * (d - m)
                v += 0.001 * (d * d - v)
                net.p[name] -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
                if name in ("word", "char"):
                    net.p[name] *= np.float32(1 - 0.02 * rate)
    net.scale = scale(largest(now(), of, len(texts)), label, apart, label.mean() if share is None else share)
    return net


def scale(best: np.ndarray, label: np.ndarray, apart: np.ndarray, share: float) -> np.ndarray:
    """Slope and offset of the largest logit, by logistic regression with a weak prior, on texts kept from the fit; both
    kinds weigh as among all labelled rows."""
    own = np.flatnonzero(apart) if apart.any() else np.arange(len(best))
    own = own[np.isfinite(best[own])]
    x, y, w = np.stack([best[own], np.ones(len(own))], axis=1), label[own], np.array([1.0, 0.0])
    own_share = min(max(y.mean(), 1e-6), 1 - 1e-6) if len(y) else 0.5
    each = np.where(y == 1, share / own_share, (1 - share) / (1 - own_share))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (each * (p - y)) + 0.1 * (w - [1.0, 0.0])
        hess = (x * (each * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        w = w - np.clip(move, -1, 1)
    return np.array([max(w[0], 0.05), w[1]])


def train(docs: DataFrame, labels: DataFrame) -> Net | None:
    """The model, from the bounded sample; only that many rows come to the driver."""
    own = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
    own = own.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.utf8("text")).filter(F.octet_length("text") > 0)
    fitting = common.cut(own.join(docs.select("doc_id"), "doc_id", "left_semi"))
    chosen = [fitting.filter(F.col("toxic") == k).orderBy(*order).limit(n) for k, n in ((1, SAMPLE[0]), (0, SAMPLE[1]))]
    chosen = common.cut(chosen[0].unionByName(chosen[1]))  # at most sum(SAMPLE) ids
    share = own.agg(F.avg("toxic")).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in common.slices(batch):
                yield some.set_column(1, "text", pa.array([excerpt(x) for x in some.column(1).to_pylist()], pa.binary()))

    rows = docs.join(F.broadcast(chosen), "doc_id").mapInArrow(run, "doc_id long, text binary, toxic int").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).toArrow()
    order = np.argsort(rows.column("doc_id").to_numpy(), kind="stable")
    texts, toxic = rows.column("text").to_pylist(), rows.column("toxic").to_pylist()
    return fit([texts[k] for k in order], [toxic[k] for k in order], share)


def scored(docs: DataFrame, net: Net | None) -> DataFrame:
    """RESULT of every row of docs (doc_id, text)."""
    model = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value) if model.value else None
        for batch in batches:
            for some in common.slices(batch):
                score = scorer.scores(some.column(1).to_pylist()) if scorer else np.zeros(some.num_rows)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(2), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), common.utf8("text"), held_out(doc_id).alias("held_out")).mapInArrow(run, RESULT)


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that score 0.5 or more, by a model of these docs' labels."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def flags():
        scorer = Scorer(model.value) if model.value else None
        return lambda found: scorer.scores(found) < 0.5 if scorer else np.ones(len(found), bool)

    return common.filtered(docs, flags)
