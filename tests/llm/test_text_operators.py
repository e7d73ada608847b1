"""Chat formatting, BPE, packing, HTML, WARC and licence scans against plain versions and round trips."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from tramline.llm import bpe, chat, entry, html_text, licenses, packing, warc

WEIRD = [
    None, "", "   ", "\n\n", "word", "two words", "a\tb\x0bc\x0cd\re", "aaaaaaaa aaa", "x<|endoftext|>y <|startoftext|> z", "É é x́ İstanbul ΣΑΣ ß ﬁ", "it's don't we'LL 's", "12345 ١٢٣ ²³",
    "a b c\x1cd\x85e", "日本語 テスト 😀👍🏽", "a\x00b", "é" * 3000, "x " * 5000, "\\ <| <\\| \\\\| <|im_end|>\n<|im_start|>assistant\n",
]


def docs(spark, texts=WEIRD):
    rows = [(k, t, "clash") for k, t in enumerate(texts)] + [(None, "no id", "clash"), (1, "again", None), (1, "again", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


# ---- chat


def brute_chat(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_reads_back_what_it_wrote(spark):
    texts = [t for t in WEIRD if t is None or len(t) < 3000]
    rng = random.Random(3)
    roles = ["user", "assistant", "system", None, "", "odd\nrole<|im_sep|>\\n|"]
    rows = [(c, rng.choice([0, 1, 2, 3, None]), rng.choice(roles), rng.choice(texts)) for c in (1, 2, 3, None, -5) for _ in range(14)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(chat.format_chats(df)).collect()}
    assert got == brute_chat(rows)


def test_chat_merges_adjacent_turns(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")], "conv_id long, turn long, role string, text string")
    assert chat.format_chats(df).first().formatted == "<|im_start|>user\na<|im_sep|>b<|im_end|>\n<|im_start|>assistant\nc<|im_end|>\n"
    assert chat.digests(chat.format_chats(df.limit(0))).count() == 0


def test_chat_plan_is_native(spark):
    plan = entry.op3_chat_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|ExistingRDD|UDF", plan)


def test_long_chats_with_clashing_columns(spark):
    long = "é<|im_sep|>\\" * 200_000
    rows = [(1, 0, "user", long, "x", 1), (1, 1, "assistant", long, "y", 2), (1, 1, "assistant", long, "y", 2), (2, 0, "assistant", "b" * 1_000_000, None, 3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, turns int")
    got = {r.conv_id: r for r in chat.digests(chat.format_chats(df)).collect()}
    assert got[1].n_turns == 3 and got[1].loss_chars == 2 * len(long) and got[1].loss_sha256 == hashlib.sha256((2 * long).encode()).hexdigest()
    assert got[1].turns_sha256 == hashlib.sha256(f"user\n{long}\nassistant\n{long}\nassistant\n{long}\n".encode()).hexdigest()
    assert got[2].loss_chars == 1_000_000 and len(got) == 2


# ---- tokens


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(bpe.vocabulary_path())
    df = docs(spark)
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(df).collect()}
    want = set()
    for r in df.collect():
        ids = tool.encode(r.text or "", add_special_tokens=False).ids
        said = tool.decode(ids, skip_special_tokens=False)
        want.add((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(said.encode()).hexdigest()))
    assert got == want
    assert bpe.digests(df).count() == df.count() and bpe.digests(df.limit(0)).count() == 0


def test_bpe_on_test_documents():
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer

    tool, own = Tokenizer.from_file(bpe.vocabulary_path()), bpe.Bpe(bpe.vocabulary_path())
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    for text, ids in zip(texts, own.encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tool.encode(text, add_special_tokens=False).ids


# ---- packing


def held(rows, capacity):
    """Sequences used; fails unless every sequence is gapless and within capacity."""
    by = {}
    for seq, offset, length in rows:
        by.setdefault(seq, []).append((offset, length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_plan_places_everything():
    rng = random.Random(1)
    for _ in range(150):
        capacity = rng.choice([5, 16, 64, 200])
        histogram = {rng.randint(1, capacity): rng.randint(1, 9) for _ in range(rng.randint(1, 30))}
        rows, seen = packing.plan(histogram, capacity, rng.choice([(0.25,), (0.5,), packing.SMALL]), rng.choice([1, 5, 50])), Counter()
        placed = []
        for length, lo, hi, per, seq, offset in rows:
            assert lo == seen[length]
            seen[length] = hi
            placed += [(seq + i // per, offset + i % per * length, length) for i in range(hi - lo)]
        assert dict(seen) == histogram
        held(placed, capacity)
    assert packing.plan({}) == []


def fewest(lengths, capacity):
    """The least number of sequences, by search over all ways to place each piece, longest first."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(lengths):
            best = len(rooms)
            return
        for room in sorted({r for r in rooms if r >= lengths[k]}):
            rest = list(rooms)
            rest.remove(room)
            place(k + 1, [*rest, room - lengths[k]])
        place(k + 1, [*rooms, capacity - lengths[k]])

    place(0, [])
    return best


def test_packing_against_the_optimum():
    rng, more, none = random.Random(6), 0, 0
    for _ in range(300):
        capacity = rng.choice([10, 20, 60])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        used, least = packing.sequences(packing.plan(Counter(lengths), capacity)), fewest(lengths, capacity)
        assert least <= used <= least + 1
        more += used - least
        none += used == least
    assert more <= 15 and none >= 285
    # thirds and quarters that only configurations put together
    assert packing.sequences(packing.plan({51: 6, 27: 6, 26: 6, 23: 12}, 101)) <= 10


def test_few_groups_round_up():
    histogram = {k: 3 for k in range(600, 1600)}
    groups = packing.groups_of(histogram, packing.GROUPS)
    sizes = [sum(n for _, n in g) for g in groups]
    assert len(groups) <= packing.GROUPS and len(set(sizes[:-1])) == 1 and all(g[0][0] > g[-1][0] for g in groups)


def test_tokens_beside_long_white_space():
    from tokenizers import Tokenizer

    tool, tokens = Tokenizer.from_file(packing.vocabulary_path()), packing.shared(packing.vocabulary_path())
    for n in (255, 256, 257, 4998, 4999, 5000, 5001):
        for blank in (" ", "\n", " \n\t\u3000"):
            run = (blank * n)[:n]
            for text in (run, f"a{run}b", f"a{run}", f"{run}b", f"x{run}y {run}\u00e9{run}"):
                assert tokens.encode(text.encode()) == np.array(tool.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_packing_is_near_the_bound():
    rng = random.Random(2)
    histogram = Counter(rng.randint(1, 2048) for _ in range(20_000))
    rows = packing.plan(histogram)
    used = 1 + max(seq + (hi - lo - 1) // per for _, lo, hi, per, seq, _ in rows)
    assert used <= 1.01 * -(-sum(k * n for k, n in histogram.items()) // 2048)


def test_pieces_and_places(spark):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(packing.vocabulary_path())
    df = docs(spark)
    got = packing.pack(df.repartition(3)).collect()
    want = Counter()
    for r in df.collect():
        ids = [*tool.encode(r.text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        for k, end in enumerate(range(first, len(ids) + 1, 2048)):
            start = max(0, end - 2048)
            want[(r.doc_id, k, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    held([(r.sequence_id, r.offset, r.length) for r in got], 2048)
    assert packing.pack(df.limit(0)).count() == 0


# ---- HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div><!-- <p>ad</p> -->
%s<aside>side</aside><div id="comments"><p>Nice</p></div><form><p>mail</p></form><footer>&copy; us</footer></body></html>"""


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("plain &amp; text", "plain & text"), ("<p>Hi <b>you</b>th</p>", "Hi youth"), ("<p>a &lt;b&gt;\n x<!-- open", "a <b> x"), ("<p>a<script>x</p>", "a"), ("a < b <c", "a < b"),
        (PAGE % "<article><h1>Head</h1><p>One <i>two</i>.\n<p>Three<br>four<div class='ad'>buy</div><ul><li>five<li>six</ul></article>", "Head One two. Three four five six"),
        (PAGE % ("<div class=content><p>" + "long words " * 20 + "</p><p>end</p></div>"), "long words " * 20 + "end"),
        (PAGE % "<main><p>a</p><article><p>b</p></article></main>", "a b"),
        ("<p>İİİİİİ</p><SCRIPT>x</Script ><p>abcdef</p>", "İİİİİİ abcdef"), ("<p>a<button>x<p>b</p><select><option>y</select>c", "a x b c"), ("a<button>x<button>y</BUTTON>c", "a c"), ("<li>a<li>b<td>c", "a b c"),
        ("<p>" + "words " * 60 + "</p>" + "<div class=x>" * 9 + "<p>Buy</p>" + "</div>" * 9 + "<p>" + "more " * 60, "words " * 60 + "Buy " + "more " * 59 + "more"),
        ("<p>" + "words " * 60 + "</p>" + "<div class=x>" * 9 + "<p>Buy</p>", "words " * 59 + "words"),
        (PAGE % "", ""),
    ],
)
def test_main_text(html, text):
    assert html_text.extract(html) == text


def test_line_blocks_decide():
    body = "<p>" + "long words " * 20 + "</p>"
    links = "<ul>" + "<li><a href=/x>Read this too</a></li>" * 5 + "</ul>"
    got = html_text.extract(PAGE % f"<article><h1><a href=/>Head</a></h1>{body}{links}<p>Tags</p></article>")
    assert got == "Head " + "long words " * 19 + "long words"
    assert html_text.extract(PAGE % f"<article><p>Start.</p><div class=ad>buy</div>{body}</article><p>Out</p>") == "Start. " + "long words " * 19 + "long words"
    far = "<div>" + "other prose " * 40 + "</div>"
    assert "other prose" in html_text.extract(PAGE % f"<article>{body}</article>{far}")
    for name in ("post-header", "share-price", "site-content right-sidebar", "x"):  # names that only hold a mark drop nothing
        assert "other prose" in html_text.extract(PAGE % f"<div class='{name}'>{far}{body}</div>")
    # a mark weighs, and much text outweighs it
    assert html_text.extract(f"<div class=sidebar>{'<p>' + 'other prose ' * 200 + '</p>'}</div><p>Short</p>").startswith("other prose")
    assert html_text.extract(f"<div class=sidebar>{far}</div><p>Short</p>") == "Short"


@pytest.mark.parametrize("html", ["<i>" * 100_000 + "x" + "</u>" * 100_000, "<div>" * 100_000 + "x" + "</div>" * 100_000, "<h2>" * 50_000 + "</li><li>" * 50_000 + "x", "<button>" * 100_000 + "x", "<nav>" * 50_000 + "<p>x"])
def test_pages_of_many_tags(html):
    began = time.time()
    assert html_text.extract(html) in ("x", "")
    assert time.time() - began < 20


def by_definition(page):
    """The same choice of lines by comparing every pair of lines, window by window."""
    chosen, wide = {}, html_text.WINDOW
    for c in page.columns:
        full = [k for k, size in enumerate(c.sizes) if size]
        same = lambda a, b, c=c: all(sum(c.sizes[k : k + wide]) for k in range(a, b - wide + 1))
        groups = {a: [b for b in full if same(min(a, b), max(a, b))] for a in full}
        chosen[id(c)] = sorted({(min(g), max(g)) for g in groups.values()})
    size = lambda c, ab: sum(c.sizes[ab[0] : ab[1] + 1])
    most = max([size(c, ab) for c in page.columns if c.weight == 1 for ab in chosen[id(c)]], default=0)
    out = []
    for c in page.columns:
        good = [ab for ab in chosen[id(c)] if (size(c, ab) >= min(html_text.SURGE, most / 4) if c.weight == 1 else size(c, ab) / c.weight >= max(html_text.SURGE, most))]
        if good:
            bounds = [ab for ab in chosen[id(c)] if good[0][0] <= ab[0] <= good[-1][0]]
            out += [c.texts[k] for k in c.texts if any(a <= k <= b for a, b in bounds)]
    return " ".join(text for _, text in sorted(out))


def article(html):
    import html as h

    body = re.search(r"<article>(.*?)(?:</article>|\Z)", html, re.S)[1]
    blocks = [" ".join(h.unescape(x).split()) for x in re.split(r"<[^>]*>", re.sub(r"</?b>", "", body))]
    return " ".join(x for x in blocks if x)


def test_main_text_of_pages(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in html_text.main_text(pages).collect()}
    rows = pages.collect()
    for r in rows:
        assert got[r.page_id].text == article(r.html) == by_definition(html_text.Page(r.html))
        assert got[r.page_id].n_chars == len(got[r.page_id].text)
    # the line blocks alone, without any mark, find nearly all; without the blocks nothing is right
    monkeypatch.setattr(html_text, "marked", lambda *_: False)
    assert sum(html_text.extract(r.html) == article(r.html) for r in rows) >= 0.9 * len(rows)
    assert all(html_text.extract(r.html) == by_definition(html_text.Page(r.html)) for r in rows)
    every = lambda page: " ".join(t for _, t in sorted(x for c in page.columns for x in c.texts.values()))
    assert not any(every(html_text.Page(r.html)) == article(r.html) for r in rows)


@pytest.mark.parametrize("seed", range(30))
def test_line_blocks_of_random_pages(seed):
    draw = random.Random(seed)
    tags = ["<p>", "</p>", "<div>", "</div>", "<ul>", "<li>", "</ul>", "<br>", "<nav>", "</nav>", "<div class=ad>", "<article>", "</article>", "<h2>", "</h2>", "<a href=x>", "</a>", "<table><tr><td>", "</table>", "<aside>", "</aside>"]
    html = "".join(draw.choice(tags) if draw.random() < 0.75 else "word " * draw.randrange(1, 60) for _ in range(250))
    assert html_text.extract(html) == by_definition(html_text.Page(html))


def test_main_text_rows(spark):
    pages = spark.createDataFrame([(1, None, None, 5), (None, "u", "<p>x", 6), (1, None, None, 5)], "page_id long, url string, html string, text int")
    assert sorted((r.text, r.n_chars) for r in html_text.main_text(pages).collect()) == [("", 0), ("", 0), ("x", 1)]
    assert html_text.main_text(pages.limit(0)).count() == 0


# ---- WARC


def test_archives_round_trip(spark):
    big, huge = "b" * 1000, "é" * 200_000
    rows = [(1, "u1", big), (7, "u\r\n7", big), (3, None, big), (2, "x", "small"), (4, "y", "small"), (5, "z", None), (6, "h", huge), (None, "n", big), (None, "m", "only"), (7, "again", big), (9, "w", "a" * 999)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    typed = warc.assign_types(pages)
    base = warc.common.fresh_path(spark, "warc")
    index = warc.common.cut(warc.write_archives(typed, base))
    got = warc.read_records(index, base).collect()
    sha = lambda x: hashlib.sha1((x or "").encode()).hexdigest()
    last = {big: 7}
    want = Counter((i, len((h or "").encode()), sha(h), "revisit" if h in last and i != 7 else "response", last[h] if h in last and i != 7 else None) for i, _, h in rows)
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert {r.payload.decode() for r in got if r.page_id == 6} == {huge}
    names = [r.record_id for r in index.collect()]
    assert len(set(names)) == len(names) == len(rows)
    assert warc.archive_and_read(pages.limit(0)).count() == 0


def test_frames_are_independent_and_listed(tmp_path):
    import zstandard

    bundle = warc.Bundle(f"file://{tmp_path}")
    places = [bundle.add(bytes([k]) * 50_000) for k in range(7)]
    bundle.close()
    data = (tmp_path / bundle.name).read_bytes()
    import pyarrow as pa

    frames = warc.seek_table(pa.BufferReader(data))
    assert len(frames) > 1
    for k, (frame, start) in enumerate(places):
        at, size = frames[frame]
        raw = zstandard.ZstdDecompressor().decompress(data[at : at + size])
        assert raw[start : start + 50_000] == bytes([k]) * 50_000
    whole = b"".join(zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read(-1) for _ in range(1))
    assert len(whole) == 350_000


# ---- licences


def brute_scan(s, text):
    w = [s.ids.get(x, 0) for x in licenses.WORD.findall(text.lower())]
    g = [a * s.base + b if a and b else -1 for a, b in zip(w, w[1:], strict=False)]
    out = []
    for k, counts in enumerate(s.counts):
        best = None
        for i in range(len(g)):
            left, common = dict(counts), 0
            for j in range(i, len(g)):
                if left.get(g[j], 0):
                    left[g[j]] -= 1
                    common += 1
                like = 2 * common / (j - i + 1 + s.sizes[k])
                if like >= s.like and (best is None or like > best[0]):
                    best = (like, i, j + 1)
        if best:
            out.append((best, k))
    out.sort(key=lambda x: (-x[0][0], -s.sizes[x[1]], s.names[x[1]]))
    return [(s.names[k], *b) for b, k in out]


def test_licence_windows_against_all_windows():
    rng = random.Random(2)
    letters = list("abcde")
    for _ in range(300):
        templates = {str(k): " ".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for k in range(4)}
        s = licenses.Scanner(templates, rng.choice([0.5, 0.7, 0.85]))
        text = " ".join(rng.choice([*letters, "zz"]) for _ in range(rng.randint(0, 25))).encode()
        assert s.scan(text) == brute_scan(s, text)


def licences_of(text):
    return sorted({x[0].partition("#")[0] for x in licenses.Scanner().resolve(text.encode())})


@pytest.mark.parametrize(("key", "name"), [(k, k.partition("#")[0]) for k in licenses.TEMPLATES])
def test_licence_template_matches_itself_only(key, name):
    text = licenses.TEMPLATES[key]
    assert licences_of(f"Some words. {text} More words. {text} The end.") == [name]


def test_licences_differ_by_their_distinguishing_words():
    said = "This work is licensed under the GNU {}General Public License{}."
    assert licences_of(said.format("", ", version 3")) == ["GPL-3.0"]
    assert licences_of(said.format("", ", version 2.0")) == ["GPL-2.0"]
    assert licences_of(said.format("", ", version 2.1")) == licences_of(said.format("", "")) == licences_of(said.format("Library ", ", version 3")) == []
    assert licences_of(said.format("", ", version 3") + " 5 files. " + said.format("Affero ", ", version 3") + " Released under the MIT License.") == ["AGPL-3.0", "GPL-3.0", "MIT"]
    assert licences_of("Licensed under CC BY-NC-SA 3.0.") == []
    assert licences_of("The header. " + licenses.TEMPLATES["BSD-3-Clause"].replace("the copyright holder", "Example Inc")) == ["BSD-3-Clause"]


def test_licence_headers_and_texts():
    header = "// This program is free software: you can redistribute it and/or modify\n// it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.\n// This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."
    assert licences_of(header) == ["AGPL-3.0"]
    assert licences_of(header.replace("Affero", "Lesser")) == ["LGPL-3.0"]
    assert licences_of(header.replace("Affero", "Lesser").replace("version 3", "version 2.1").replace("program", "library")) == ["LGPL-2.1"]
    for name in ("Apache-2.0", "MPL-2.0", "AGPL-3.0", "GPL-3.0", "LGPL-2.1", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "BSD-2-Clause"):
        words = licenses.TEMPLATES[f"{name}#text"].split()
        assert licences_of(" ".join(words[: len(words) * 7 // 8])) == [name]
    assert licences_of(licenses.TEMPLATES["CC-BY-SA-4.0#text"].replace("ShareAlike", "NonCommercial-ShareAlike")) == []
    gpl, agpl = (licenses.TEMPLATES[f"{x}#text"] for x in ("GPL-3.0", "AGPL-3.0"))
    assert licences_of(gpl + " x x x " + " ".join(w if k % 20 else "x" for k, w in enumerate(agpl.split())) + " x x x " + gpl) == ["AGPL-3.0", "GPL-3.0"]


@pytest.mark.parametrize(("said", "names"), [
    ("This work is licensed under the GNU General Public License, version 2", ["GPL-2.0"]), ("This work is licensed under the GNU General Public License, version 3", ["GPL-3.0"]),
    ("This work is licensed under the GNU Lesser General Public License, version 2.1", ["LGPL-2.1"]), ("This work is licensed under the GNU Lesser General Public License, version 3", ["LGPL-3.0"]),
    ("This work is licensed under the GNU Affero General Public License, version 3", ["AGPL-3.0"]), ("This work is licensed under a Creative Commons Attribution 4.0 International License", ["CC-BY-4.0"]),
    ("This work is licensed under a Creative Commons Attribution 3.0 International License", []), ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ["CC-BY-SA-4.0"]),
    ("Licensed under the Apache License, Version 2.0", ["Apache-2.0"]), ("Licensed under the Apache License, Version 1.1", []),
])
def test_licence_versions(said, names):
    found = licenses.Scanner().resolve(f"Some words before. {said}. And some after.".encode())
    assert sorted({x[0].partition("#")[0] for x in found}) == names


def test_licences_in_very_long_texts(spark):
    prose = "words of an ordinary text about trams and trains in a city " * 40_000
    mit = licenses.TEMPLATES["MIT"]
    rows = [(1, prose + mit + prose, "clash"), (2, prose, "clash"), (3, (mit + " ") * 30, "clash"), (4, "the software " * 200_000, "clash")]
    got = {r.doc_id: (r.license, r.n_licenses) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, license string")).collect()}
    assert got == {1: ("MIT", 1), 2: (None, 0), 3: ("MIT", 1), 4: (None, 0)}


def test_licence_rows(spark):
    texts = [None, "", "Nothing here", "Intro.\n" + licenses.TEMPLATES["MIT"].replace("Software", "Program") + "\nmore", "x. Released under the MIT License. Licensed under CC BY-NC 4.0."]
    got = {r.doc_id: r for r in licenses.scan(docs(spark, texts)).filter("doc_id <> 1 OR license IS NOT NULL").collect()}
    assert got[0].license is None and got[2].n_licenses == 0 and got[3].license == "MIT" and 0.85 <= got[3].dice < 1
    assert got[4].licenses == "CC-BY-NC-4.0,MIT" and got[4].dice == 1.0
    assert licenses.matches(docs(spark, texts)).filter("doc_id = 4").count() >= 2
    assert licenses.scan(docs(spark, texts).limit(0)).count() == 0
