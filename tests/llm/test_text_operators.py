"""Operators on texts against brute force, the libraries and edge cases."""

import hashlib
import html
import json
import random
import re
import time
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.llm import bpe_count, decontaminate, html_text, ngram_join, pii_feistel, queries, sentencepiece_codec, spotsigs, toxicity

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, n long, grp string, token string"


def frame(spark, rows, schema=DOCS, rename=None):
    return spark.createDataFrame([(*r, *[None] * (len(schema.split(",")) - len(r))) for r in rows], schema)


def table(name):
    return duckdb.connect().execute(f"select * from '{SF}/{name}.parquet'").fetchall()


def brute_classes(rows, k=5):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets.append((i, {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()))
    low = {i: i for i, _ in sets}

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = root(i), root(j)
                low[max(x, y)] = min(x, y)
    return sorted((i, len(s), root(i)) for i, s in sets)


def copies(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(60)]
    rows = []
    for g in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([3, 7, 40, 150]))]
        for _ in range(rng.choice([1, 2, 9])):
            own = list(base)
            for _ in range(rng.randrange(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(words)
            if rng.random() < 0.3:
                own += passage
            rows.append(" ".join(own).upper() if rng.random() < 0.3 else "\t".join(own))
    rows += ["", None, " \n", "one", "ONE", "one two", "x " * 300]
    rng.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]


def test_ngram_classes(spark):
    rows = copies()
    got = ngram_join.ngram_jaccard_classes(frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == brute_classes(rows)


def test_ngram_classes_documents(spark):
    got = queries.op1_ngram_jaccard_join(spark, SF).collect()
    assert sorted(tuple(r) for r in got) == brute_classes([(r[0], r[1]) for r in table("documents")])


def test_ngram_classes_edges(spark):
    assert ngram_join.ngram_jaccard_classes(frame(spark, [])).collect() == []
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (2, "a b c d e f"), (2, "z"), (9, "z")]
    got = sorted((tuple(r) for r in ngram_join.ngram_jaccard_classes(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 2, None), (4, 2, 2), (2, 2, 2), (2, 1, 2), (9, 1, 2)], key=str)


def test_ngram_classes_of_a_template(spark):
    rng = random.Random(11)
    template = [f"t{i}" for i in range(104)]
    rows = [(0, " ".join(template))]
    for i in range(1, 51):
        rows.append((i, " ".join(template + [f"u{i}x{j}" for j in range(rng.randrange(17, 26))])))
    want = brute_classes(rows)
    assert {c for _, _, c in want} == {0}
    got = ngram_join.ngram_jaccard_classes(frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == want


def test_token_counts_match_the_library(spark):
    from tokenizers import Tokenizer

    path = bpe_count.tokenizer_path("byte_bpe_50k.json")
    library, counter = Tokenizer.from_file(path), bpe_count._counter(path)
    rng = random.Random(1)
    alphabet = list("ab 'sdté漢😀\n\t\x1c\x85\xa0 ​1²٣<|>.,!") + ["<|endoftext|>", "  "]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(500)] + ["a" * 3000, ""]
    assert [counter.count(t) for t in texts] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    rows = [(r[0], r[1]) for r in table("documents")] + [(None, None), (5, "")]
    got = bpe_count.count_tokens(frame(spark, rows)).collect()
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert sorted((tuple(r)[:3] for r in got), key=str) == sorted(want, key=str)
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)
    assert bpe_count.count_tokens(frame(spark, [])).collect() == []


def test_sentencepiece_parity_and_round_trip(spark):
    path = sentencepiece_codec.tokenizer_path("piece_bpe_32k.model")
    texts = [r[1] for r in table("documents")][:80] + sentencepiece_codec.PROBES + ["x" * 2000, "▁ ▁▁ a▁b"]
    assert sentencepiece_codec.verify_parity(path, texts) == []
    rows = [(1, "Größe 漢字 \u0001"), (None, None), (1, ""), (2, "  a  b ")]
    out = sentencepiece_codec.encode_documents(frame(spark, rows))
    back = sorted(((r.doc_id, r.text) for r in sentencepiece_codec.decode_documents(out).collect()), key=str)
    assert back == sorted(((i, t or "") for i, t in rows), key=str)
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in out.collect())
    assert sentencepiece_codec.encode_documents(frame(spark, [])).collect() == []


def test_unigram_models_are_rebuilt():
    def field(number, value):
        if isinstance(value, int):
            return bytes([number << 3, value]) if number < 16 else bytes([(number << 3) & 127 | 128, number >> 4, value])
        return bytes([number << 3 | 2, len(value)]) + value

    import struct

    def piece(text, score, kind=1):
        return field(1, field(1, text.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", score) + field(3, kind))

    data = piece("<unk>", 0, 2) + piece("▁", -3) + piece("a", -2) + piece("b", -2) + piece("▁ab", -1) + piece("ab", -2.5)
    model = sentencepiece_codec.parse_model(data + field(2, field(3, 1)) + field(3, field(3, 1) + field(4, 0)))
    assert [e.ids for e in sentencepiece_codec.build_tokenizer(model).encode_batch_fast(["ab ab", "abb"])] == [[4, 4], [4, 3]]


def test_html(spark):
    tree = html_text.trained_tree()
    page = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></li></ul></nav>
    <div class="cookie-notice">We use cookies on this long and winding site of ours.</div><div id=ad-1>Buy this now, it is a very good thing.</div>
    <article><h1>Title &amp; more</h1><p>First <b>bold</b>\n text&nbsp;&#233;.<p>Second<br>line</p><aside>Not this</aside><script>var a="</p><p>no";</script>
    <!-- gone <p> --><ul><li>item</li></ul><form><label>Mail</label></form></article><section class="comments"><p>A reader says something long here.</p></section>
    <footer>&copy; 2024</footer></body></html>"""
    assert html_text.main_text(page, tree) == "Title & more First bold text é. Second line item"
    plain = "<div><a>a</a> <a>b</a></div><p>" + "word " * 40 + "</p><p>" + "more " * 30 + "</p>"
    assert html_text.main_text(plain, tree).split() == ["word"] * 40 + ["more"] * 30
    got = html_text.extract_pages(frame(spark, [(1, "u", None), (None, None, ""), (1, "u", "<p")], "page_id long, url string, html string, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "u", "", 0), (1, "u", "", 0), (None, None, "", 0)]
    for r in queries.op9_html_extraction(spark, SF).collect():
        whole = dict((p[0], p[2]) for p in table("pages"))[r.page_id]
        inside = re.search(r"<article>(.*?)(</article>|$)", whole, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?(p|h1|br)>", " ", inside).replace("<b>", "").replace("</b>", "")).split())
        assert r.text == want and r.n_chars == len(want)


def test_html_articles_are_weighed_by_their_text():
    tree = html_text.trained_tree()
    para = lambda w, n: f"<p>{' '.join([w] * n)}</p>"
    body = "<div><h1>Body title here</h1>" + para("body", 80) + para("more", 60) + "</div>"
    text = "Body title here " + " ".join(["body"] * 80 + ["more"] * 60)
    linked = "".join(f"<article><h3><a href=x>Other page number {i}</a></h3>{para('teaser', 12)}</article>" for i in range(4))
    plain = "".join(f"<article><h3>Other page {i}</h3>{para('teaser', 12)}</article>" for i in range(3))
    for cards in (linked, plain):
        assert html_text.main_text(body + cards, tree) == text
        assert html_text.main_text(cards + body, tree) == text
    links = "<ul>" + "".join(f"<li><a href=x>Another story {i}</a></li>" for i in range(6)) + "</ul>"
    notes = "<div><p>Somebody said a few words on this.</p></div>"
    article = "<h1>Title</h1>" + para("first", 50) + "<p>Short line.</p>" + para("last", 40)
    want = " ".join(["Title", *["first"] * 50, "Short line.", *["last"] * 40])
    assert html_text.main_text(f"<article>{article}{links}</article>{notes}{links}", tree) == want
    assert html_text.main_text(f"<main>{links}{article}</main>", tree) == want
    assert html_text.main_text("<article><h1>One</h1><p>two</p></article>", tree) == "One two"


def test_html_shapes_keep_their_articles():
    tree = html_text.trained_tree()
    text = " ".join(f"word{i}" for i in range(40))
    para = f"<p>{text}</p>"
    for page, want in [
        (f"<article><p title=it's>{text}</p><p>{text} end</p></article>", f"{text} {text} end"),
        (f"<article><p data-id=ad data-class='nav'>{text}</p></article>", text),
        (f"<form id=aspnetForm><div class=menu><a href=x>a</a></div><h1>Title here</h1>{para}{para}</form>", f"Title here {text} {text}"),
        (f"<form><nav><a href=x>a</a></nav><article><h1>T</h1>{para}</article></form>", f"T {text}"),
        (f"{para}<form><label>Name</label><p>Please log in</p></form>{para}", f"{text} {text}"),
        (f"<article>{para}<form><p>Sign up for our letter, {text}</p></form></article>", text),
        (f"<article><div class='article-header'><h1>Title</h1></div>{para}</article>", f"Title {text}"),
        (f"<article>{para}<section id=search-engines><h2>Search engines</h2>{para}</section></article>", f"{text} Search engines {text}"),
        (f"<article><div class=social-history>{para}</div>{para}</article>", f"{text} {text}"),
        (f"<article><div class=social-links>{para}</div>{para}<div class=comment-list>{para}</div></article>", text),
        (f"<div class='site-header'><h1>Site</h1></div><article>{para}</article><div class='related-posts'>{para}</div>", text),
    ]:
        assert html_text.main_text(page, tree) == want
    deep = "<div>" * 50_000
    start = time.time()
    assert html_text.main_text(deep + para + "<svg/>" * 50_000, tree) == text
    assert time.time() - start < 5


def test_tiles_cover_reordered_passages():
    import numpy as np

    item = np.arange(100, 130)
    text = np.concatenate([np.arange(20), item[18:], np.arange(50, 60), item[:18], np.arange(70, 75)])
    tiles = decontaminate.greedy_tiles(item, text, 5)
    assert sorted((i, n) for i, _, n in tiles) == [(0, 18), (18, 12)]
    rng = np.random.default_rng(5)
    for _ in range(200):
        a, b = rng.integers(0, 4, rng.integers(0, 30)), rng.integers(0, 4, rng.integers(0, 60))
        free_a, free_b, want = np.ones(len(a), bool), np.ones(len(b), bool), []
        while True:  # brute force: the longest free match, again and again
            best = max(((n, -i, -j) for i in range(len(a)) for j in range(len(b)) for n in [next(
                n for n in range(100) if i + n >= len(a) or j + n >= len(b) or not free_a[i + n] or not free_b[j + n] or a[i + n] != b[j + n])]), default=(0, 0, 0))
            if best[0] < 3:
                break
            n, i, j = best[0], -best[1], -best[2]
            free_a[i : i + n] = free_b[j : j + n] = False
            want.append((i, j, n))
        assert decontaminate.greedy_tiles(a, b, 3) == want, (a, b)


def test_tiles_measured_in_batches(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(6)
    cases = [(rng.integers(0, 3, rng.integers(0, 40)), rng.integers(0, 3, rng.integers(0, 80))) for _ in range(100)]
    whole = [decontaminate.greedy_tiles(a, b, 3) for a, b in cases]
    calls, measured = [], decontaminate._measured
    monkeypatch.setattr(decontaminate, "_measured", lambda *x: calls.append(len(x[4])) or measured(*x))
    assert decontaminate.greedy_tiles(np.full(20_000, 7), np.full(200, 7), 5) == [(0, 0, 200)]
    assert len(calls) < 100  # not one for each place of the item
    monkeypatch.setattr(decontaminate, "PAIRS", 2)
    assert [decontaminate.greedy_tiles(a, b, 3) for a, b in cases] == whole


def test_tiles_of_repeated_words():
    import time

    import numpy as np

    began = time.monotonic()
    item, text = np.full(200, 7), np.full(20_000, 7)
    assert decontaminate.greedy_tiles(item, text, 5) == [(0, 0, 200)]
    assert decontaminate.greedy_tiles(text, item, 5) == [(0, 0, 200)]
    assert decontaminate.greedy_tiles(np.tile([1, 2], 300), np.tile([2, 1, 3], 5_000), 5) == []
    assert decontaminate.greedy_tiles(np.zeros(0, int), text, 5) == decontaminate.greedy_tiles(item, text[:4], 5) == []
    assert time.monotonic() - began < 5


def test_leaks(spark):
    item = "The quick brown fox jumps over the lazy dog while seven other animals stand around and stare at them"
    words = item.split()
    bench = frame(spark, [(7, item), (8, "too short"), (9, None), (None, item)], "item_id long, text string, words string")
    rows = [(1, "x y " + item.upper() + "!"), (2, " ".join(words[9:] + ["so"] * 9 + words[:9])), (3, " ".join(words[:8])), (4, None), (5, ""), (None, item), (6, "too short")]
    got = decontaminate.find_leaks(frame(spark, rows), bench).collect()
    assert sorted((r.doc_id, r.item_id, r.n_tiles) for r in got) == [(1, 7, 1), (2, 7, 2)]
    assert decontaminate.find_leaks(frame(spark, []), bench).collect() == []
    assert decontaminate.find_leaks(frame(spark, rows), frame(spark, [], "item_id long, text string")).collect() == []


def test_long_items_are_not_broadcast(spark, monkeypatch):
    item = " ".join(f"w{i}" for i in range(300))
    bench = frame(spark, [(7, item)], "item_id long, text string")
    docs = frame(spark, [(1, item), (2, "x " + item), (3, "y")])
    want = [(1, 7, 300), (2, 7, 300)]
    for limit, sent in ((600, True), (599, False)):
        monkeypatch.setattr(decontaminate, "BROADCAST_WORDS", limit, raising=False)
        out = decontaminate.find_leaks(docs, bench)
        assert sorted((r.doc_id, r.item_id, r.n_covered) for r in out.collect()) == want
        assert ("strategy=broadcast" in out._jdf.queryExecution().optimizedPlan().toString()) == sent


def test_leaks_documents(spark):
    cut = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), t))
    items = {i: cut(t) for i, t in table("benchmark")}
    want = {(d[0], i) for d in table("documents") for i, w in items.items() if len(w) >= 5 and f" {' '.join(w)} " in f" {' '.join(cut(d[1]))} "}
    got = {(r.doc_id, r.item_id) for r in queries.op5_decontamination(spark, SF).collect()}
    assert want <= got and len(got) <= len(want) + 2


def luhn(s):
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(s)))) % 10 == 0


def test_pseudonyms(spark):
    text = ("card 4111 1111 1111 1111, again 4111 1111 1111 1111; no card 4111111111111112. mail Ann.O@ex-a.example.com! +1 (017) 555-7713 "
            "10.0.0.255 300.1.1.1 123-45-6789 000-12-3456 2001-02-29 1999-12-31 12/31/1999 31.12.1999 token=\"" + "ab12" * 10 + "\" v2.0")
    rows = [(1, text), (2, None), (3, ""), (4, "nothing here"), (5, "4111 1111 1111 1111")]
    out = {r.doc_id: r for r in pii_feistel.pseudonymise(frame(spark, rows), "k").collect()}
    assert (out[2].text, out[3].text, out[4].text, out[2].n_pseudonyms) == (None, "", "nothing here", 0)
    new = out[1].text
    cards = re.findall(r"\d{4} \d{4} \d{4} \d{4}", new)
    assert cards[0] == cards[1] == out[5].text != "4111 1111 1111 1111" and luhn(cards[0].replace(" ", ""))
    for kept in ("4111111111111112.", "300.1.1.1", "000-12-3456", "2001-02-29", 'token="', "v2.0", "+1 ("):
        assert kept in new
    for gone in ("Ann.O", "555-7713", "10.0.0.255", "123-45-6789", "1999-12-31", "12/31/1999", "31.12.1999", "ab12ab12"):
        assert gone not in new
    assert re.search(r"u\w{16}@p\w{8}\.invalid!", new) and re.search(r'="[0-9a-f]{40}"', new)
    dates = re.search(r"(\d{4})-(\d\d)-(\d\d) (\d\d)/(\d\d)/(\d{4}) (\d\d)\.(\d\d)\.(\d{4})", new).groups()
    assert dates[0] == dates[5] == dates[8] and dates[1] == dates[3] == dates[7] and dates[2] == dates[4] == dates[6]
    assert out[1].n_pseudonyms == 10
    other = pii_feistel.pseudonymise(frame(spark, [(5, "4111 1111 1111 1111")]), "other key").first().text
    assert other != out[5].text


def test_pseudonyms_of_long_and_adjacent_values(spark):
    """Patterns neither recurse nor start again inside a run: these texts took minutes or the whole executor."""
    import time

    many = "x@" + "a." * 20_000 + "com"
    rows = [(1, many), (2, "b" * 200_000 + " 1"), (3, "b" * 200_000 + "@"), (4, "1" * 200_000), (5, "a-" * 50_000 + "@b.c"), (6, "x@" + "a-" * 50_000 + "b.org"),
            (7, "a@b.com_c@d.org"), (8, "a@b-.com a@b a@@b.c é@ü.de"), (9, "10.0.0.1x@y.z"), (10, "a@b.c@d.e")]
    began = time.monotonic()
    out = {r.doc_id: r for r in pii_feistel.pseudonymise(frame(spark, rows), "k").collect()}
    assert time.monotonic() - began < 60
    assert [out[i].n_pseudonyms for i in range(1, 11)] == [1, 0, 0, 0, 1, 1, 2, 0, 1, 1]
    assert re.fullmatch(r"u\w{16}@p\w{8}\.invalid", out[1].text) and re.fullmatch(r"(u\w{16}@p\w{8}\.invalid){2}", out[7].text)
    assert out[8].text == rows[7][1] and all(out[i].text == rows[i - 1][1] for i in (2, 3, 4))
    assert pii_feistel.pseudonymise(frame(spark, []), "k").collect() == []
    twice = pii_feistel.pseudonymise(frame(spark, [(1, "a@b.c"), (1, "a@b.c")]), "k").collect()
    assert twice[0] == twice[1]


def test_many_copies_of_one_text(spark, monkeypatch):
    """One set on half of the rows is joined apart from the others."""
    monkeypatch.setattr(ngram_join, "TOGETHER", 3)
    rows = [(i, "one text of seven words in all") for i in range(100, 160)] + [(i, f"text {i // 2} with a word more than six") for i in range(60)]
    got = ngram_join.ngram_jaccard_classes(frame(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == brute_classes(rows)


def test_scan_of_sizes_counts_shared_shingles(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(ngram_join, "MERGED", 20)
    texts = [" ".join(f"w{j}" for j in range(i, i + 9)) for i in range(30)] + ["q r s t u"] * 5
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    *_, last = ngram_join._scan_sizes(5)(iter([batch]))
    found = dict(zip(last.column(4).to_pylist()[0], last.column(5).to_pylist()[0]))
    sets = ngram_join.shingle_sets(ngram_join.words_of(*next(iter(ngram_join.chunks(batch.column(1))))[1:]), 5)
    held = {}
    for values in sets[:30]:
        for x in values.tolist():
            held[x] = held.get(x, 0) + 1
    assert found and all(held[x] >= c > 1 for x, c in found.items()) and sets[30][0] not in found


def test_scan_memory_is_bounded():
    """The peak of the first scan's own arrays stays under 60 MB, however many texts a partition holds."""
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(2)
    texts = pa.array([" ".join(rng.choices("abcdefghijklmnop", k=400)) for _ in range(3000)])
    batches = (pa.RecordBatch.from_arrays([pa.array(range(3000)), texts], ["doc_id", "text"]) for _ in range(3))
    tracemalloc.start()
    for _ in ngram_join._scan_sizes(5)(batches):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20


def test_feistel_is_a_permutation(spark):
    from pyspark.sql import functions as F

    pair = pii_feistel.feistel(F.floor(F.col("id") / 11), F.col("id") % 11, 7, 11, F.lit("t"))
    got = {tuple(r.p)[:2] for r in spark.range(77).select(pair.alias("p")).collect()}
    assert got == {(x, y) for x in range(7) for y in range(11)}


def brute_spots(spark, texts):
    from pyspark.sql import functions as F

    rows = []
    for k, t in enumerate(texts):
        words = [w for w in re.split(r"[^\w]|_", (t or "").lower()) if w]
        rows.append((k, words))
    every = sorted({w for _, ws in rows for w in ws})
    sampled = {r.w for r in spark.createDataFrame([(w,) for w in every], "w string").filter(F.pmod(F.hash("w"), F.lit(16)) == 0).collect()}
    anchors = set(spotsigs.ANCHORS) | sampled
    out = []
    for _, ws in rows:
        spots = set()
        for p, w in enumerate(ws):
            if w in anchors:
                chain = [x for x in ws[p + 1 :] if x not in anchors][:2]
                if len(chain) == 2:
                    spots.add((w, *chain))
        out.append(spots or ({tuple(ws)} if ws else set()))
    return out


def test_fingerprints(spark):
    import hashlib

    docs = sorted((r[0], r[1]) for r in table("documents"))
    got = {r.doc_id: r for r in spotsigs.fingerprint_documents(frame(spark, docs), rows=16).collect()}
    assert len(got) == len(docs)
    texts = [t for _, t in docs]
    edited = []
    for k, t in enumerate(texts):
        q = len(t) // 4
        edited.append(t[: len(t) - q] + texts[(k + 1) % len(texts)][:q])
    spots, new = brute_spots(spark, texts), brute_spots(spark, edited)
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for k, (i, t) in enumerate(docs):
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited[k].encode()).hexdigest()
        assert len(r.fingerprint) == 8 * len(spots[k])
        assert r.near_edited == pytest.approx(like(spots[k], new[k]))
        assert r.near_next == pytest.approx(like(spots[k], spots[(k + 1) % len(docs)]))


def test_fingerprint_edges(spark):
    assert spotsigs.fingerprint_documents(frame(spark, [])).collect() == []
    one = spotsigs.fingerprint_documents(frame(spark, [(1, "the quick fox")])).first()
    assert one.near_next == 1.0 and one.n_chars == 13
    rows = [(None, "a"), (5, None), (5, ""), (2, "the same two words here"), (9, "the same two words here")]
    got = spotsigs.fingerprint_documents(frame(spark, rows)).collect()
    assert len(got) == 5 and len({r.fingerprint for r in got if r.n_chars > 5}) == 1


@pytest.mark.parametrize("ids", [
    [-(2**63), None, None, -9 * 10**18, 0, 9 * 10**18, 2**63 - 1],  # the whole range, and rows without an id
    [*range(40), 10**18, 10**18 + 1],  # far outliers
    [*range(20), *[7] * 25, *[None] * 25],  # hot ids, cut by the hash of the text
])
def test_fingerprints_of_any_ids(spark, ids):
    texts = [f"the text {k} of the few words and more {k * k}" for k in range(len(ids))]
    rows = list(zip(ids, texts))
    hashes = {r.text: r.h for r in frame(spark, rows).select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]]))
    want = {}
    for k, (i, t) in enumerate(order):
        q = len(t) // 4
        want[(i, hashlib.sha256((t[: len(t) - q] + order[(k + 1) % len(order)][1][:q]).encode()).hexdigest())] = len(t)
    for rows_of in (1, 3, 1000):
        got = spotsigs.fingerprint_documents(frame(spark, rows), rows=rows_of)
        assert {(r.doc_id, r.edited_sha256): r.n_chars for r in got.collect()} == want


def test_ranges_hold_few_rows(spark):
    dense, spread = range(10**15, 10**15 + 100), range(10**18, 10**18 + 100 * 4096, 4096)
    ids = [*range(100), *[7] * 100, *[10**18 + 5] * 100, *[None] * 100, *dense, *spread, 2**63 - 1, -(2**63)]
    docs = frame(spark, [(i, f"text {k}") for k, i in enumerate(ids)]).select("doc_id", "text")
    sizes = [r["count"] for r in spotsigs._ranged(docs, 10).groupBy("part").count().collect()]
    assert sum(sizes) == len(ids) and max(sizes) <= 40


def test_similar_pairs(spark):
    docs = [(r[0], r[1]) for r in table("documents")]
    spots = brute_spots(spark, [t for _, t in docs])
    first = {}
    for (i, _), s in sorted(zip(docs, spots), key=lambda x: x[0][0]):
        if s:
            first.setdefault(frozenset(s), i)
    reps = list(first.items())
    want = {(min(i, j), max(i, j)) for k, (a, i) in enumerate(reps) for b, j in reps[:k] if len(a & b) >= 0.8 * len(a | b)}
    assert {(r.a, r.b) for r in spotsigs.similar_pairs(frame(spark, docs)).collect()} == want


def test_swapped_identity_terms_score_alike():
    import numpy as np
    import pyarrow as pa

    rng = random.Random(2)
    texts, labels = [], []
    for k in range(1200):
        bad = k % 4 == 0
        words = [rng.choice(["walk", "tree", "house", "river", "green", "day", "bread"]) for _ in range(20)]
        if bad:
            words[3:6] = ["you", "awful", "moron"]
        if rng.random() < (0.6 if bad else 0.1):  # the sample is biased against one group
            words[8] = "muslim"
        elif rng.random() < 0.2:
            words[8] = "christian"
        texts.append(" ".join(words))
        labels.append(float(bad))
    docs = [np.unique(w, return_counts=True) for w in toxicity._documents(pa.array(texts))]
    args = ([w for w, _ in docs], [c for _, c in docs], np.array([c.sum() for _, c in docs]), np.array(labels))
    gap = {}
    for penalty in (0.0, toxicity.LAMBDA):
        model = toxicity.fit(*args, penalty=penalty)
        a, b, c = model.logits(pa.array(["a muslim walks by the tree", "a christian walks by the tree", "you awful moron"]))
        gap[penalty] = abs(a - b)
        assert c > 0 > a
    assert gap[toxicity.LAMBDA] < 0.25 * gap[0.0]


def test_folds(spark):
    from pyspark.sql import functions as F
    from tessera.llm.labelled import held_out

    got = spark.range(50).select("id", held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)
    assert not spark.range(1).select(F.lit(None).cast("long").alias("doc_id")).select(held_out().alias("h")).first().h


@pytest.mark.parametrize("query,label,cut,least", [("op2_toxicity", 2, 0.5, 0.85), ("op6_quality", 1, 0.3, 0.9)])
def test_classifiers_on_the_held_out_fold(spark, query, label, cut, least):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.QUERIES[query](spark, sf).collect()}
    labels = duckdb.connect().execute(f"select doc_id, quality, toxic from '{sf}/labels.parquet'").fetchall()
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= cut) for r in got.values())
    fold = [(got[x[0]].predicted, x[label]) for x in labels if got[x[0]].held_out]
    assert sum(p == y for p, y in fold) / len(fold) >= least


def test_classifier_edges(spark):
    from tessera.llm import quality_gam

    docs = frame(spark, [(1, "a b"), (2, None), (None, ""), (2, "x")])
    none = spark.createDataFrame([(1, None)], "doc_id long, quality int")
    model = quality_gam.train_quality(docs, none)
    assert [r.score for r in quality_gam.score_quality(docs, model).collect()] == [0.5] * 4
    assert quality_gam.keep_quality(docs, model).count() == 4
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, empty)).collect()] == [0.5] * 4


def test_tool_calls(spark):
    from tessera.llm import tool_chat

    kinds = "conv_id long, call_id string, parent_id string, name string, arguments string, content string"
    calls = spark.createDataFrame([
        (1, "a", None, "search", '{ "query":"x", "limit": 5}', None), (1, "b", "a", "search", '{"limit":51,"query":1}', None),
        (1, "c", "b", "lookup", '{"key":"k","more":[1,{"z":1,"a":2}]}', None), (2, "d", "e", "count", '{"words":1}', None), (2, "e", "d", "nope", "{}", None),
        (3, None, None, "lookup", None, None), (3, "f", "zz", "lookup", "[1]", None)], kinds)
    results = spark.createDataFrame([("a", "r\"1"), ("a", "r2"), ("x", "lost"), (None, "?"), ("c", None)], "call_id string, content string")
    got = {r.call_id: r for r in tool_chat.link_tool_calls(calls, results, tool_chat.CHAT_TOOLS).collect() if r.call_id}
    assert {k: r.depth for k, r in got.items()} == {"a": 0, "b": 1, "c": 2, "d": None, "e": None, "f": 0, "x": None}
    assert {k for k, r in got.items() if r.linked} == {"a", "c"} and {k for k, r in got.items() if r.valid} == {"a"}
    assert got["a"].json == '{"arguments":{"limit":5,"query":"x"},"depth":0,"id":"a","name":"search","result":"r\\"1"}'
    assert got["b"].errors == ["limit: beyond maximum", "query: not string"] and got["c"].errors == ["more: not allowed"]
    assert got["d"].errors == ["unit: missing"] and got["e"].errors == ["unknown tool nope"] and got["f"].errors == ["arguments: not a JSON object"]
    assert json.loads(got["c"].json)["arguments"]["more"] == [1, {"a": 2, "z": 1}] and '{"a":2,"z":1}' in got["c"].json
    empty = tool_chat.link_tool_calls(calls.limit(0), results.limit(0), tool_chat.CHAT_TOOLS)
    assert empty.collect() == []


def test_lines_are_canonical(spark):
    from tessera.llm import tool_chat

    kinds = "conv_id long, call_id string, parent_id string, name string, arguments string, depth string, errors long"
    texts = ['{"limit":1e2,"query":"1e2 \\"1.0"}', '{"query":"x","limit":100.0}', '{"limit":100,"query":"-3.0,1E5"}', '{"limit":-0.5e1,"query":"2.50"}',
             '{"limit":1.25,"query":""}', '{"limit":1,"limit":2}', "not json", None, ""]
    calls = spark.createDataFrame([(1, f"c{k}", None, "search", t, "clash", 7) for k, t in enumerate(texts)]
                                  + [(1, None, "c0", "search", texts[0], None, None)] * 30, kinds)
    results = spark.createDataFrame([("c0", "5.0", 1)], "call_id string, content string, depth long")
    rows = tool_chat.link_tool_calls(calls, results, tool_chat.CHAT_TOOLS).collect()
    got = {r.call_id: json.loads(r.json) for r in rows}
    assert len(rows) == len(texts) + 30 and sum(r.call_id is None and r.depth is None and not r.linked for r in rows) == 30
    assert [got[f"c{k}"]["arguments"]["limit"] for k in range(5)] == [100, 100, 100, -5, 1.25]
    lines = {r.call_id: r.json for r in rows}
    assert all(f'"limit":{n},' in lines[f"c{k}"] for k, n in enumerate(["100", "100", "100", "-5", "1.25"]))
    assert [got[f"c{k}"]["arguments"]["query"] for k in range(5)] == ['1e2 "1.0', "x", "-3.0,1E5", "2.50", ""] and got["c0"]["result"] == "5.0"
    assert [got[f"c{k}"].get("raw") for k in range(4, 9)] == [None, *texts[5:]]
    long = "\\" * 200_000 + '"' * 100_000 + " 1.0"
    one = spark.createDataFrame([(json.dumps({"a": 7.0, "b": long}),)], "line string").select(tool_chat.canonical_numbers(F.regexp_replace("line", ": |, ", ":"))).first()[0]
    assert '"a":7:' in one and one.endswith(' 1.0"}')


def test_turns_without_a_number(spark):
    from tessera.llm import tool_chat

    rows = [(1, None, "assistant", "a"), (1, None, "assistant", "bb"), (None, 1, "assistant", "ccc"), (1, 1, "assistant", "d"), (1, 2, "user", "e")]
    calls, results = tool_chat.calls_from_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = tool_chat.link_tool_calls(calls, results, tool_chat.CHAT_TOOLS).collect()
    assert sorted((r.call_id or "", r.linked) for r in got) == [("", False)] * 3 + [("call_1_1", True)]


def test_tool_calls_of_conversations(spark):
    turns = {(c, n): (role, text) for c, n, role, text in table("conversations")}
    want = {}
    for (c, n), (role, text) in turns.items():
        if role == "assistant":
            depth, m = 0, n - 2
            while turns.get((c, m), ("",))[0] == "assistant":
                depth, m = depth + 1, m - 2
            want[f"call_{c}_{n}"] = (depth, turns.get((c, n + 1), ("",))[0] == "user")
    got = {r.call_id: (r.depth, r.linked) for r in queries.op10_chat_formatting(spark, SF).collect() if r.name}
    assert got == want


def test_every_turn_stands_in_the_output(spark):
    from collections import Counter

    got = Counter()
    for r in queries.op10_chat_formatting(spark, SF).collect():
        line = json.loads(r.json)
        arguments = line.get("arguments", {})
        got.update(t for t in (line.get("content"), line.get("result"), *(arguments.get(k) for k in ("query", "key", "text"))) if t is not None)
        assert not r.name or not [e for e in r.errors if "not allowed" in e]
    assert got == Counter(text for *_, text in table("conversations"))


def test_messages_keep_odd_turns(spark):
    from tessera.llm import tool_chat

    rows = [(1, 0, "system", "s"), (1, 1, "user", "r"), (2, 0, "user", "u"), (2, 1, "assistant", "a"), (3, None, "user", "n"), (4, 2, None, "o"), (4, 3, "tool", None)]
    got = tool_chat.messages_from_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted((r.conv_id, json.loads(r.json).get("content")) for r in got if r.call_id != "message_4_3") == [(1, "s"), (2, "u"), (3, "n"), (4, "o")]
    assert len(got) == 5 and all(r.name is None and not r.linked for r in got)


def test_every_result_of_a_call_stays(spark):
    from tessera.llm import tool_chat

    kinds = "conv_id long, call_id string, parent_id string, name string, arguments string"
    calls = spark.createDataFrame([(1, "a", None, "lookup", '{"key":"k"}'), (1, "b", None, "lookup", '{"key":"k"}')], kinds)
    rows = [("a", "two"), ("a", "one"), ("a", "two"), ("a", None), ("x", "p"), ("x", "q"), (None, "m"), (None, "n"), (None, "n"), (None, None)]
    got = tool_chat.link_tool_calls(calls, spark.createDataFrame(rows, "call_id string, content string"), tool_chat.CHAT_TOOLS).collect()
    held = sorted(((r.call_id, r.linked, [tuple(x) for x in r.results] if r.results else None) for r in got), key=str)
    assert held == sorted([("a", True, [(None, 1), ("one", 1), ("two", 2)]), ("b", False, None), ("x", False, [("p", 1), ("q", 1)]),
                           (None, False, [("m", 1)]), (None, False, [("n", 1)]), (None, False, [("n", 1)]), (None, False, [(None, 1)])], key=str)
    assert sorted(r.json for r in got if r.call_id is None) == ['{"result":"m"}', '{"result":"n"}', '{"result":"n"}', "{}"]


def test_training_texts_are_bounded_by_rows(spark):
    """One labelled id on most rows gives one training text."""
    from tessera.llm.labelled import training_texts

    docs = frame(spark, [(1, f"text {i}") for i in range(1000)] + [(i, None) for i in range(2, 40)])
    labels = spark.createDataFrame([(i, 1) for i in range(1, 40)] + [(1, 0)], "doc_id long, quality int")
    got = {r.doc_id: (r.text, r.label) for r in training_texts(docs, labels, "quality", "doc_id", "text", rows=100).collect()}
    assert got[1] == ("text 0", 1) and len(got) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(1, 40))
    assert training_texts(docs, labels, "quality", "doc_id", "text", rows=10).count() <= 10
