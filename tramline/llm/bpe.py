"""Operator 5, BPE encoding and decoding with a public vocabulary, by batched numpy merge rounds.

A text is cut at the six ASCII spaces into chunks; normalisation and pre-tokenisation never reach across one, so a
chunk has the same ids wherever it stands. Chunks that a task hasn't met are normalised and split by the tokenizer's
own rules, and their words are merged together: the symbols of all words lie in one flat array; each round looks up
all adjacent pairs by binary search in the sorted keys of the merge table, takes the lowest rank of each word, and
merges that pair wherever it stands in the word, left to right. A word is done when none of its pairs merges.
A merge's result takes part in later merges only, so a round by word gives what one merge at a time gives.

Decoding maps ids to tokens by table and joins them by a space, as a tokenizer without a decoder does.

Defined results: a null text is empty, and has no ids and an empty decoded text; special tokens' strings inside a
text are their ids; a very long text is merged in blocks of BLOCK bytes of new words; repeated rows each stay; an empty
table gives no rows; other columns are ignored. A task holds one batch of texts, and at most CHUNKS known chunks.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm import common

CHUNKS, BLOCK = 400_000, 1 << 20
#: Latin letters but the dotted capital I (two code points in lower case), then ASCII marks but the apostrophe:
#: composed and split without the tokenizer's own rules.
LATIN = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ɏ]*)([!-&(-/:-@\\[-`{-~]*)").fullmatch
NEVER = np.iinfo(np.int64).max


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable, else the next one from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (chr(0x100 + k) for k in range(256))
    return [chr(b) if b in own else next(others) for b in range(256)]


_made: dict[str, Bpe] = {}


def shared(path: str) -> Bpe:
    """One encoder a Python worker, so that its known chunks serve later tasks."""
    if path not in _made:
        _made[path] = Bpe(path)
    return _made[path]


class Bpe:
    """The merges of a tokenizer file (byte-level symbols, with or without an end-of-word suffix)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, tool = spec["model"], Tokenizer.from_file(path)
        self.normalize = tool.normalizer.normalize_str if tool.normalizer else (lambda text: text)
        self.split = tool.pre_tokenizer.pre_tokenize_str
        vocab = model["vocab"]
        self.base = max(vocab.values()) + 1
        left, right = zip(*((x.split(" ") if isinstance(x, str) else x) for x in model["merges"]), strict=True)
        keys = np.array([vocab[x] for x in left], np.int64) * self.base + np.array([vocab[x] for x in right], np.int64)
        made = np.array([vocab[x + y] for x, y in zip(left, right, strict=True)], np.int64)
        order = np.argsort(keys, kind="stable")
        order = order[np.concatenate([[True], np.diff(keys[order]) > 0])]
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        suffix = model["end_of_word_suffix"] or ""
        self.inner = {c: vocab[c] for c in ByteLevel.alphabet()}
        self.last = {c: vocab[c + suffix] for c in ByteLevel.alphabet()}
        self.special = {x["content"].encode(): x["id"] for x in spec["added_tokens"]}
        self.cuts = re.compile(b"(" + b"|".join(map(re.escape, self.special)) + b")") if self.special else None
        names = vocab | {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = [b""] * (max(names.values()) + 1)
        for token, i in names.items():
            self.tokens[i] = token.encode()
        self.visible = {b: c for b, c in enumerate(byte_characters())}
        kinds = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        self.plain = kinds == ["NFC", "Replace", "Lowercase"]
        self.known: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}

    def merge(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word, given in byte-level characters."""
        inner, last = self.inner, self.last
        s = np.array([i for w in words for i in (*(inner[c] for c in w[:-1]), last[w[-1]])], np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        of = np.repeat(np.arange(len(words)), lengths)
        done: list[np.ndarray] = [s[:0]] * len(words)
        while len(s):
            key = s[:-1] * self.base + s[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where((self.keys[at] == key) & (of[:-1] == of[1:]), self.ranks[at], NEVER)
            rank = np.append(rank, NEVER)
            first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            sizes = np.diff(np.append(first, len(s)))
            low = np.minimum.reduceat(rank, first)
            ended = low == NEVER
            for k, a, n in zip(of[first[ended]].tolist(), first[ended].tolist(), sizes[ended].tolist(), strict=True):
                done[k] = s[a : a + n]
            hit = (rank == np.repeat(low, sizes)) & (rank != NEVER)
            if (hit[1:] & hit[:-1]).any():  # of pairs that overlap, as in "aaa", every second counts
                run = np.flatnonzero(hit)
                starts = np.concatenate([[True], np.diff(run) > 1])
                place = np.arange(len(run)) - np.maximum.accumulate(np.where(starts, np.arange(len(run)), 0))
                hit[run[place % 2 == 1]] = False
            where = np.flatnonzero(hit)
            s = s.copy()
            s[where] = self.made[at[where]]
            keep = np.repeat(~ended, sizes)
            keep[where + 1] = False
            s, of = s[keep], of[keep]
        return done

    def cut(self, chunk: str) -> list[str]:
        """Words of a chunk, in byte-level characters."""
        if self.plain and (m := LATIN(chunk)):
            letters, marks = m.groups()
            letters = letters.lower()
            if not letters.isascii():
                letters = letters.encode().decode("latin-1").translate(self.visible)
            return [x for x in (letters, marks) if x]
        return [w for w, _ in self.split(self.normalize(chunk))]

    def learn(self, chunks: list[bytes]) -> None:
        """Adds chunks (without ASCII spaces) to those known."""
        parts = [self.cut(x.decode("utf-8", "replace")) for x in chunks]
        new = list(dict.fromkeys(w for p in parts for w in p if w not in self.words))
        at = 0
        while at < len(new):
            end, size = at, 0
            while end < len(new) and (size < BLOCK or end == at):
                size += len(new[end])
                end += 1
            for w, ids in zip(new[at:end], self.merge(new[at:end]), strict=True):
                self.words[w] = ids.astype("<u4").tobytes()
            at = end
        for x, p in zip(chunks, parts, strict=True):
            self.known[x] = b"".join([self.words[w] for w in p])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        if len(self.known) > CHUNKS:
            self.known, self.words = {}, {}
        cut = []
        for text in texts:
            if self.cuts and any(x in text for x in self.special):
                parts = [[x] if x in self.special else x.split() for x in self.cuts.split(text)]
                cut.append([y for p in parts for y in p])
            else:
                cut.append(text.split())
        for x, i in self.special.items():
            self.known[x] = np.array([i], "<u4").tobytes()
        new = list(set().union(*cut) - self.known.keys()) if cut else []
        self.learn(new)
        known = self.known
        return [b"".join([known[x] for x in p]) for p in cut]

    def decode(self, ids: bytes) -> bytes:
        tokens = self.tokens
        return b" ".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def encode_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit), decoded (binary, UTF-8) of docs (doc_id, text)."""
    return apply(docs, path, "doc_id long, ids binary, decoded binary", [pa.int64(), pa.binary(), pa.binary()], lambda ids, decoded: (ids, decoded))


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    row = lambda ids, decoded: (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest())
    return apply(docs, path, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", [pa.int64(), pa.int64(), pa.string(), pa.string()], row)


def apply(docs: DataFrame, path: str | None, schema: str, kinds: list[pa.DataType], row) -> DataFrame:
    path = path or vocabulary_path()
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared(path)
        for batch in batches:
            for piece in common.slices(batch):
                found = [row(ids, bpe.decode(ids)) for ids in bpe.encode(piece.column(1).to_pylist())]
                columns = [piece.column(0), *(pa.array([r[k] for r in found], kind) for k, kind in enumerate(kinds[1:]))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.utf8("text")).mapInArrow(run, schema)
