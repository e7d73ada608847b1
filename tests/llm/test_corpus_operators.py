"""SimHash, toxicity, quality rules, nearest neighbours and the pipeline against brute force and held-out labels."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import xxhash

from tramline.llm import ann, quality, simhash, toxicity

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ---- SimHash


def brute_fingerprint(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    grams = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """doc_id to component of (doc_id, fingerprint)."""
    fps = sorted({f for _, f in rows})
    up = {f: f for f in fps}

    def top(f):
        while up[f] != f:
            f = up[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                up[top(b)] = top(a)
    least = {}
    for d, f in rows:
        least[top(f)] = min(d, least.get(top(f), d))
    return {d: least[top(f)] for d, f in rows}


def test_fingerprints_and_groups(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(10**6, None), (10**6 + 1, " \n"), (10**6 + 2, "One"), (10**6 + 3, "ONE"), (10**6 + 4, "É É"), (10**6 + 5, "a b\x0bc d " * 4000)], "doc_id long, text string")
    rows = docs.unionByName(extra).collect()
    got = {r.doc_id: r for r in simhash.near_duplicates(docs.unionByName(extra).withColumn("fp", docs.doc_id)).collect()}
    want = brute_components([(r.doc_id, brute_fingerprint(r.text)) for r in rows])
    assert {r.doc_id: got[r.doc_id].fingerprint for r in rows} == {r.doc_id: f"{brute_fingerprint(r.text):016x}" for r in rows}
    assert {d: r.component_id for d, r in got.items()} == want


@pytest.mark.parametrize(("split", "held"), [(8, 100), (60, 10**6)])
def test_large_subtrees_are_cut_again(spark, monkeypatch, split, held):
    """Fingerprints that agree in their first 50 bits, where one cut of 12 bits below the top block tells none apart."""
    monkeypatch.setattr(simhash, "HELD", held)
    rng = random.Random(8)
    fps = sorted({0x5A5A5A5A5A5A5000 & ~0x3FFF | rng.randrange(1 << 14) for _ in range(400)} | {rng.getrandbits(64) for _ in range(50)})
    rows = spark.createDataFrame([(k, f - (1 << 64) if f >> 63 else f) for k, f in enumerate(fps)], "first long, fp long")
    groups = simhash.subtrees(rows, split).groupBy("trie", "top", "lo", "hi").count()
    assert groups.agg({"count": "max"}).first()[0] <= split
    label = list(range(len(fps)))
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2 and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    got = simhash.assign(rows.withColumnRenamed("first", "doc_id"), split).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(label))


@pytest.mark.parametrize("split", [20_000, 40, 4])
def test_trie_join_on_clusters_and_chains(spark, split):
    rng = random.Random(split)
    rows = []
    for c in range(12):
        x = rng.getrandbits(64)
        for _ in range(60):
            for b in rng.sample(range(64), rng.choice([0, 1, 1, 2, 3, 5])):
                x ^= 1 << b
            rows.append(x)
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    signed = [(d, f - 2**64 if f >> 63 else f) for d, f in rows]
    got = simhash.assign(spark.createDataFrame(signed, "doc_id long, fp long"), split).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(rows)


def test_long_chain_and_odd_rows(spark):
    chain = [0]
    for k in range(40):
        chain.append(chain[-1] ^ (3 << (k + 10)))
    rows = [(d, f) for d, f in zip(random.Random(1).sample(range(41), 41), chain, strict=True)]
    got = simhash.assign(spark.createDataFrame([*rows, (None, 0), (rows[0][0], chain[0])], "doc_id long, fp long")).collect()
    assert [r.component_id for r in got if r.doc_id is None] == [None] and len(got) == 43
    assert {r.component_id for r in got if r.doc_id is not None} == set(brute_components(rows).values())
    assert simhash.assign(spark.createDataFrame([], "doc_id long, fp long")).count() == 0


def test_keep_one(spark):
    docs = spark.createDataFrame([(5, "same words in here", "x"), (2, "same words in here", "y"), (2, "same words in here", "y"), (None, "same words in here", "z"), (9, "quite another text", None)], "doc_id long, text string, component_id string")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == {2: 1, None: 1, 9: 1}


def test_keep_one_of_each_group_where_ids_repeat(spark):
    a, b, c = "alpha text about trams in the city", "quite another story of 17 wild geese", "numbers 1 2 3 and nothing else at all"
    keep = lambda rows: Counter((r.doc_id, r.text) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert keep([(5, a), (5, b), (3, b)]) == {(5, a): 1, (3, b): 1}
    assert keep([(5, a), (5, b), (5, b), (7, c), (9, a), (None, a)]) == {(5, a): 1, (5, b): 1, (7, c): 1, (None, a): 1}


# ---- toxicity


def test_windows_cover_every_word():
    start, end, of = toxicity.windows(np.array([0, 1, 16, 32, 33, 49, 200]))
    for k, (first, n) in enumerate(zip([0, 0, 1, 17, 49, 82, 131], [0, 1, 16, 32, 33, 49, 200], strict=True)):
        spans = [(a, b) for a, b, o in zip(start, end, of, strict=True) if o == k]
        assert {w for a, b in spans for w in range(a, b)} == set(range(first, first + n))
        assert all(b - a <= toxicity.WINDOW for a, b in spans) and all(y[0] - x[0] == toxicity.STRIDE for x, y in zip(spans, spans[1:], strict=False))


def test_words_of_texts_without_ascii_spaces():
    spaces = [chr(k) for k in range(0x3001) if chr(k).isspace()]
    assert toxicity.words_of(("A" + "É".join(spaces) + "b").encode()) == [b"a", *["É".encode()] * (len(spaces) - 1), b"b"]
    for word in ("漢字かな" * 500, "x" * 97, "é" * 49):
        words = [w.decode() for w in toxicity.words_of(word.encode())]
        assert len(words) > 10 and all(len(w) <= toxicity.PIECE for w in words)
        assert "".join(w[: toxicity.PIECE // 2] for w in words[:-1]) + words[-1] == word
    assert len(toxicity.words_of(b"y" * 96)) == 1
    assert len(toxicity.windows(np.array([len(toxicity.words_of(("漢字かな" * 500).encode()))]))[0]) > 30


def test_gradients():
    rng = np.random.default_rng(0)
    net = toxicity.Net({b"bad": 1, b"word": 2}, rng)
    names = [b"bad", b"word", b"other!", b"x"]
    at = rng.integers(0, 4, (3, 6))
    mask = np.ones((6, 3), bool)
    mask[4:, 1] = False
    at[1, 4:] = -1
    label = np.array([1, 0, 1], np.float32)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    _, g = net.step(net.features(names), at, mask, label)
    for name in ("word", "char", "Wf", "Ub", "bf", "A", "v", "o"):
        flat, grad = net.p[name].reshape(-1), g[name].reshape(-1)
        for k in np.argsort(-np.abs(grad))[:3]:
            keep, e = flat[k], 1e-4
            flat[k] = keep + e
            up = net.step(net.features(names), at, mask, label)[0]
            flat[k] = keep - e
            down = net.step(net.features(names), at, mask, label)[0]
            flat[k] = keep
            assert abs((up - down) / (2 * e) - grad[k]) < 1e-3 * max(1, abs(grad[k])) + 2e-4


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.scored(docs, toxicity.train(docs, labels)).toPandas().merge(labels.toPandas(), on="doc_id", how="left")
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in got.doc_id]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    own = got[got.held_out & got.toxic.notna()]
    assert (own.predicted == own.toxic).mean() >= 0.85


def test_toxicity_samples_among_documents_that_are_there(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", (8, 8))
    labels = spark.createDataFrame([(k, 0, k % 2) for k in range(2000)], "doc_id long, quality int, toxic int")
    here = [(k, ("you are bad" if k % 2 else "all is fine here") + (" long" * 4000 if k < 1500 else "")) for k in range(1000, 1600)]
    net = toxicity.train(spark.createDataFrame(here, "doc_id long, text string"), labels)
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, toxic, share: seen.extend(zip(texts, toxic, strict=True)))
    toxicity.train(spark.createDataFrame(here, "doc_id long, text string"), labels)
    assert net is not None and sum(y for _, y in seen) == 8 and len(seen) == 16


def test_toxicity_trains_on_long_documents(spark):
    """Nothing but documents of 40 kB, of which the toxic ones are so in places all over them."""
    rng = random.Random(5)
    calm = [f"w{k}" for k in range(300)]

    def text(toxic):
        return " ".join("you vile rotten scum" if toxic and rng.random() < 0.03 else rng.choice(calm) for _ in range(8000))

    rows = [(k, text(k % 2), k % 2) for k in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 0, y) for k, _, y in rows], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.scored(docs, toxicity.train(docs, labels)).collect()}
    assert sum(got[k] == y for k, _, y in rows) >= 58


def test_excerpts():
    text = " ".join(f"w{k}" for k in range(80 * toxicity.PASSAGE)).encode()
    words = toxicity.words_of(toxicity.excerpt(text))
    assert len(words) == toxicity.PASSAGES * toxicity.PASSAGE == len(set(words)) and words == sorted(words, key=lambda w: int(w[1:]))
    assert toxicity.excerpt(b"A  short\ttext") == b"A  short\ttext"


def plain_score(net, text):
    """The score of a text by a loop over windows, words and gates, without tables, batches or masks."""
    sigmoid, words = (lambda x: 1 / (1 + np.exp(-x))), toxicity.words_of(text)
    h, p = toxicity.HIDDEN, {k: v.astype(np.float64) for k, v in net.p.items()}
    starts = range(0, max(1, len(words) - (toxicity.WINDOW - toxicity.STRIDE)), toxicity.STRIDE) if words else []
    best = -np.inf
    for a in starts:
        xs = []
        for w in words[a : a + toxicity.WINDOW]:
            chars = b"\x02" + w + b"\x03"
            codes = [((chars[k] << 16 | chars[k + 1] << 8 | chars[k + 2]) * 0x9E3779B1 % 2**32) >> 20 for k in range(len(chars) - 2)]
            xs.append(np.concatenate([p["word"][net.vocabulary.get(w.strip(toxicity.MARKS) or w, 0)], np.mean([p["char"][c] for c in codes], axis=0)]))
        sides = []
        for s, order in (("f", xs), ("b", xs[::-1])):
            state, out = np.zeros(h), []
            for x in order:
                i, u = x @ p[f"W{s}"] + p[f"b{s}"], state @ p[f"U{s}"]
                r, z = sigmoid(i[:h] + u[:h]), sigmoid(i[h : 2 * h] + u[h : 2 * h])
                state = (1 - z) * np.tanh(i[2 * h :] + r * u[2 * h :]) + z * state
                out.append(state)
            sides.append(out if s == "f" else out[::-1])
        states = [np.concatenate(x) for x in zip(*sides, strict=True)]
        weight = np.exp([np.tanh(x @ p["A"] + p["a"]) @ p["v"] for x in states])
        best = max(best, float((weight / weight.sum()) @ states @ p["o"] + p["c"][0]))
    a, b = net.scale
    return sigmoid(np.clip(a * best + b, -30, 30)) if starts else 0.0


def test_scores_equal_a_plain_loop():
    rng = random.Random(4)
    words = ["bad", "fine", "(word)", "naïve", "漢字", "x", "é" * 70, "Zebra's"]
    texts = [" ".join(rng.choice(words) for _ in range(n)).encode() for n in (0, 1, 2, 15, 16, 17, 31, 32, 33, 48, 49, 200)]
    net = toxicity.fit([b"you are bad"] * 6 + [b"all is fine here word"] * 6 + texts[4:], [1] * 6 + [0] * 6 + [k % 2 for k in range(len(texts) - 4)])
    scorer = toxicity.Scorer(net)
    for _ in range(2):  # with and without known words
        assert np.allclose(scorer.scores(texts), [plain_score(net, x) for x in texts], atol=2e-5)


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (None, "some text", "a"), (2, "", "a"), (3, "w " * 50_000, "a")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1, None), (2, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int")
    net = toxicity.train(docs, labels)
    assert net is None and {r.score for r in toxicity.scored(docs, net).collect()} == {0.0}
    model = toxicity.fit([b"you are bad"] * 6 + [b"all is fine here"] * 6, [1] * 6 + [0] * 6)
    rows = toxicity.scored(docs, model).collect()
    assert len(rows) == 5 and all(r.score == 0.0 for r in rows if r.doc_id in (1, 2))
    assert toxicity.keep_clean(docs, labels).count() == 5 and toxicity.scored(docs.limit(0), model).count() == 0


# ---- quality


def brute_base(text):
    w = words(text)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered, seen, twice = set(), set(), 0
    for k, x in enumerate(zip(w, w[1:], w[2:], strict=False)):
        if windows[x] > 1:
            covered |= {k, k + 1, k + 2}
    for line in (text or "").split("\n"):
        if words(line):
            twice += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")) if w else 0, twice, len(covered)


def test_base_counts_and_ratio(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    extra = spark.createDataFrame([(10**6 + k, t) for k, t in enumerate([None, "", "a b a b a b", "É É É\nÉ É É\n\n \n", "#|<", "abc"])], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(extra)
    got = {r.doc_id: r for r in quality.verdicts(both, labels).collect()}
    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    raw, target = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    texts = {r.doc_id: (r.text or "").encode() for r in both.collect()}
    for d, t in texts.items():
        for b in quality.grams(t):
            raw[b] += 1
            target[b] += d in good
    ratio = np.log((target * raw.sum() / target.sum() + quality.PRIOR) / (raw + quality.PRIOR))
    for d, t in texts.items():
        r, base = got[d], brute_base(t.decode())
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        own = quality.grams(t)
        assert abs(r.llr - (ratio[own].mean() if len(own) else 0)) < 1e-9
        assert r.kept == (not r.base_failed and r.llr >= quality.THRESHOLD)


def test_quality_odd_rows(spark):
    long = "some words that go on and on " * 60_000
    rows = [(None, "plain words " * 40, "x", 1), (1, "plain words " * 40, "x", 1), (1, "plain words " * 40, "x", 1), (2, None, None, None), (3, "", "x", 2), (4, long, "x", 3), (5, "z" * 1_000_000, "x", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int")
    labels = spark.createDataFrame([(1, 1), (None, 1), (4, None), (3, 0), (1, 1)], "doc_id long, quality int")
    got = quality.verdicts(docs, labels).collect()
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.n_words) for r in got) == Counter((d, len(words(t))) for d, t, *_ in rows)
    again = [r for r in got if r.doc_id == 1]
    assert again[0] == again[1]
    assert {r.doc_id: (r.n_words, r.base_failed) for r in got if r.doc_id in (2, 3, 5)} == {2: (0, True), 3: (0, True), 5: (1, True)}
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)


def test_quality_same_with_either_join(spark, monkeypatch):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    before = quality.counts(docs, labels)
    monkeypatch.setattr(quality, "BROADCAST", 0)
    assert (quality.counts(docs, labels) == before).all()


def test_quality_filter(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    kept = quality.keep_good(docs, labels)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality.verdicts(docs, labels).collect() if r.kept}
    bad = kept.join(labels.filter("quality = 0"), "doc_id").count()
    assert bad == 0 and kept.join(labels.filter("quality = 1"), "doc_id").count() > 0.7 * docs.join(labels.filter("quality = 1"), "doc_id").count()
    assert quality.verdicts(docs.limit(0), labels).count() == 0 and quality.verdicts(docs, labels.limit(0)).count() == docs.count()


def test_repeated_words_with_many_distinct():
    text = [str(k).encode() for k in range(1_100_000)]
    assert quality.repeated(text) == 0 and quality.repeated([*text, *text[:3]]) == 6


# ---- nearest neighbours


def brute_nearest(vectors, query):
    x = np.array([v for _, v in vectors], np.float64)
    ids = np.array([i for i, _ in vectors])
    q = x[list(ids).index(query)]
    order = [k for k in np.lexsort((ids, -np.round(x @ q, 10))) if ids[k] != query][:20]
    return [(int(ids[k]), float(x[k] @ q)) for k in order]


def test_search_exact_on_small_tables(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 8)).astype(np.float32)
    x[30:45] = x[0]
    rows = [(k, v.tolist(), "clash") for k, v in enumerate(x)]
    odd = [(100, None, ""), (120, [0.0] * 8, ""), (140, [float("nan")] + [1.0] * 7, ""), (160, [None] + [1.0] * 7, ""), (180, [1.0] * 3, ""), (200, [float("inf")] * 8, ""), (None, [1.0] * 8, ""), (20, x[20].tolist(), "twice")]
    got = ann.search(spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<float>, rank string")).toPandas()
    assert set(got.query_id) == {0, 20, 40}
    for query, own in got.groupby("query_id"):
        own = own.sort_values("rank")
        want = brute_nearest([(k, v) for k, v, _ in rows], query)
        assert own["rank"].tolist() == list(range(1, 21)) and own.vec_id.tolist() == [i for i, _ in want]
        assert np.allclose(own.score, [s for _, s in want], rtol=1e-12)


def test_search_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = ann.search(df).toPandas()
    e = df.toPandas()
    x, ids = np.stack(e.embedding).astype(np.float64), e.vec_id.to_numpy()
    hit = total = 0
    for query, own in got.groupby("query_id"):
        k = int(np.flatnonzero(ids == query)[0])
        s = x @ x[k]
        s[k] = -np.inf
        hit += len(set(own.vec_id) & set(ids[np.argsort(-s)[:20]]))
        total += 20
    assert len(got) == total and hit / total >= 0.9


def test_search_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.rank, r.vec_id, r.score) for r in ann.search(few).orderBy("rank").collect()] == [(1, 2, 2.0), (2, 1, 1.0)]
    assert ann.search(few.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1.0, 1e39, 1e-150, 1e150])
def test_search_in_double_precision(spark, size):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(90, 6)) * size
    x[50:80] = x[7]  # more equal vectors than places, query rows among them
    got = ann.search(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")).toPandas()
    assert set(got.query_id) == {0, 20, 40, 60, 80}
    for query, own in got.groupby("query_id"):
        score = {k: float((x[k] * x[query]).sum()) for k in range(len(x)) if k != query}
        want = sorted(score, key=lambda k: (-score[k], k))[:20]
        own = own.sort_values("rank")
        assert own.vec_id.tolist() == want and own.score.tolist() == [score[k] for k in want]


def test_search_with_lists_and_bounds(spark):
    """Enough vectors for several lists, of very unequal lengths and with a hot repeated one."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 12)) * np.exp(rng.normal(size=(3000, 1)))
    x[1000:2000] = x[3]
    got = ann.search(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")).toPandas()
    hit = 0
    for query, own in got.groupby("query_id"):
        s = (x * x[query]).sum(axis=1)
        s[query] = -np.inf
        order = np.lexsort((np.arange(len(x)), -s))[:20]
        assert len(own) == 20
        hit += len(set(own.vec_id) & set(order.tolist()))
    assert got.query_id.nunique() == 150 and hit / len(got) >= 0.9


def test_search_one_huge_vector(spark):
    rows = [(0, [1.0, 2.0]), (1, [1e39, 0.0]), (2, [0.5, 0.25])]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 1e39), (2, 1.0)]


# ---- pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = [docs]
    for _, stage in p.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], SF).cache())
        assert kept[-1].columns == docs.columns
        assert kept[-1].exceptAll(kept[-2]).isEmpty()
    good = {r.doc_id for r in quality.verdicts(docs, labels).filter("kept").collect()}
    assert {r.doc_id for r in kept[1].collect()} == good
    calm = toxicity.scored(kept[1], toxicity.train(kept[1], labels)).filter("score < 0.5")
    assert {r.doc_id for r in kept[2].collect()} == {r.doc_id for r in calm.collect()}
    groups = brute_components([(r.doc_id, brute_fingerprint(r.text)) for r in kept[2].collect()])
    assert {r.doc_id for r in kept[3].collect()} == set(groups.values())
    final = p.run(spark, SF).toPandas()
    assert set(final.doc_id) == set(groups.values())
    assert final.groupby("sequence_id").length.sum().max() <= 2048
    assert isinstance(final, pd.DataFrame) and p.ORACLE_SQL is None


def run_on(spark, tmp_path, docs, labels):
    import corpus_pipeline as p

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    return p.run(spark, str(tmp_path)).collect()


DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def test_pipeline_on_odd_rows(spark, tmp_path):
    rng = random.Random(9)
    prose = lambda: " ".join(rng.choice(["the", "tram", "runs", "from", "one", "stop", "to", "another", "every", "morning", "and", "late", "at", "night"]) + str(rng.randrange(40)) for _ in range(90))
    texts = [prose() for _ in range(30)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(100, texts[0]), (5, prose()), (None, prose()), (101, None), (102, ""), (103, "#$% " * 100), (5, texts[5])]
    docs = spark.createDataFrame([(d, t, None, "a", None) for d, t in rows], DOCUMENT)
    labels = spark.createDataFrame([(k, 1, 0) for k in range(20)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    got = run_on(spark, tmp_path, docs, labels)
    ids = Counter(r.doc_id for r in got if r.piece == 0)
    assert ids == Counter([*range(30), 5, None])  # copies, nulls and empty texts go; both texts of 5 stay, once each


@pytest.mark.parametrize("rows", [[], [(1, "too short"), (2, None)]])
def test_pipeline_that_keeps_nothing(spark, tmp_path, rows):
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOCUMENT)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert run_on(spark, tmp_path, docs, labels) == []
