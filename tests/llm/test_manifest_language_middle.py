"""Fill-in-middle, Merkle manifest and language labels against brute force, and their edge cases."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import fill_middle, language_crf, merkle, queries

SF = "/root/testdata/sf0.001"
CLASH = "doc_id long, text string, lang string, n long, form string, output string, rank long, tree string, level long, held_out int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, *[None] * (10 - len(r))) for r in rows], CLASH)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------ fill in the middle

def brute_middle(i, text, signs=("<P>", "<S>", "<M>"), seed=1, plain=10, spm=20):
    text = text or ""
    h = sha(f"{seed}:{'' if i is None else i}")
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    if not text or any(s in text for s in signs) or h3 % 100 >= 100 - plain:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, s, m = signs[0] + text[:a], signs[1] + text[b:], signs[2] + text[a:b]
    return (n, "spm", a, b - a, s + p + m) if h4 % 100 < spm else (n, "psm", a, b - a, p + s + m)


def random_texts(seed=5):
    rng = random.Random(seed)
    alphabet = ["a", "b", "<", ">", "P", "S", "M", "é", "ß", "汉", "🙂", " ", "\n", "\x00"]
    return [(i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 40)))) for i in range(300)]


EDGES = [(None, "no id"), (None, "no id"), (7, None), (8, ""), (9, "x"), (10, "🙂"), (11, "<"), (12, "<P"), (13, "a<M>b"), (14, "é" * 70_000),
         (14, "same id"), (-1, "negative"), (2**63 - 1, "great"), (15, "<S" + "x" * 50 + ">")]


def check_middle(spark, rows, **options):
    signs = options.get("markers", fill_middle.Markers())
    out = fill_middle.restore_texts(fill_middle.fill_in_middle(frame(spark, rows), **options), signs)
    got = sorted((tuple(r) for r in out.collect()), key=str)
    args = {k: options[k] for k in ("seed",) if k in options}
    args |= {"plain": options.get("plain_percent", 10), "spm": options.get("spm_percent", 20)}
    assert got == sorted(((i, *brute_middle(i, t, signs.all, **args), t or "") for i, t in rows), key=str)
    return got


def test_fill_in_middle(spark):
    forms = {r[2] for r in check_middle(spark, random_texts() + EDGES)}
    assert forms == {"plain", "psm", "spm"}


def test_fill_in_middle_options(spark):
    marks = fill_middle.Markers("[pre]", "[s]", "[middle]")
    check_middle(spark, random_texts(6), markers=marks, seed=42, plain_percent=0, spm_percent=50)


def test_fill_in_middle_refuses(spark):
    for bad in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("<<", "S", "M"), ("ab", "ba", "c")):
        with pytest.raises(ValueError):
            fill_middle.Markers(*bad)
    broken = spark.createDataFrame([("no markers", "psm")], "output string, form string")
    with pytest.raises(Exception, match="markers"):
        fill_middle.restore_texts(broken).collect()
    with pytest.raises(ValueError):
        fill_middle.restore_texts(broken.withColumn("restored", F.lit(1)))
    assert fill_middle.restore_texts(fill_middle.fill_in_middle(frame(spark, []))).collect() == []


def test_fill_in_middle_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op11_fill_in_middle(spark, SF).collect():
        n, form, a, m, out = brute_middle(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, a, m)
        assert r.output_sha256 == sha(out) and r.restored_sha256 == sha(docs[r.doc_id])


# ------------------------------------------------------------ Merkle manifest

def brute_tree(nodes):
    """(top, for each node its siblings as (left, right) from below)."""
    above, proofs = list(enumerate(nodes)), [[] for _ in nodes]
    groups = [[i] for i in range(len(nodes))]
    row = list(nodes)
    while len(row) > 1:
        up, merged = [], []
        for j in range(0, len(row), 2):
            two = row[j : j + 2]
            up.append(sha("".join(two)))
            merged.append([x for g in groups[j : j + 2] for x in g])
            for k, g in enumerate(groups[j : j + 2]):
                for leaf in g:
                    proofs[leaf].append(("".join(two[:k]), "".join(two[k + 1 :])))
        row, groups = up, merged
    return row[0], proofs


def brute_manifest(rows):
    trees = {}
    for i, lang, leaf in rows:
        trees.setdefault((lang is not None, (lang or "").encode()), []).append((i is not None, i or 0, leaf, i))
    names = sorted(trees)
    tops = {name: brute_tree([x[2] for x in sorted(trees[name], key=lambda x: x[:3])]) for name in names}
    root, upper = brute_tree([tops[n][0] for n in names])
    out = []
    for k, n in enumerate(names):
        for x, proof in zip(sorted(trees[n], key=lambda x: x[:3]), tops[n][1]):
            out.append((x[3], x[2], tops[n][0], root, proof + upper[k]))
    return sorted(out, key=str)


def check_manifest(spark, rows):
    leaves = spark.createDataFrame([(i, t, sha(x), x, 1, "x") for i, t, x in rows], "doc_id long, lang string, leaf string, own string, rank int, tree string")
    got = merkle.merkle_manifest(leaves, carry=["own", "rank"]).withColumn("again", merkle.fold(F.col("leaf"), F.col("proof"))).collect()
    assert all(r.again == r.root and sha(r.own) == r.leaf and r["rank"] == 1 for r in got)
    found = sorted(((r.doc_id, r.leaf, r.subroot, r.root, [tuple(p) for p in r.proof]) for r in got), key=str)
    assert found == brute_manifest([(i, t, sha(x)) for i, t, x in rows])


def test_merkle_trees_of_all_sizes(spark):
    sizes = [1, 2, 3, 5, 8, 255, 256, 257, 700]
    rows = [(i, f"t{n}", f"{n} {i}") for n in sizes for i in random.Random(n).sample(range(10_000), n)]
    check_manifest(spark, rows)


def test_merkle_three_buckets(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", 2)
    check_manifest(spark, [(i * 3, "hot" if i % 3 else None, str(i)) for i in range(75)] + [(1, "lone", "x"), (2, "é", "y"), (3, "Z", "z"), (4, "", "e")])


def test_merkle_edges(spark):
    check_manifest(spark, [(5, None, "only")])
    check_manifest(spark, [(None, "a", "x"), (None, "a", "x"), (3, "a", "x"), (3, "a", "w"), (3, "a", "x"), (-5, "a", "q"), (3, None, "x")])
    empty = spark.createDataFrame([], "doc_id long, lang string, leaf string")
    assert merkle.merkle_manifest(empty).collect() == []
    with pytest.raises(Exception, match="leaf is null"):
        merkle.merkle_manifest(spark.createDataFrame([(1, "a", None)], "doc_id long, lang string, leaf string")).collect()


def test_merkle_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = {r.doc_id: sha("".join(map(field, r))) for r in rows}
    want = {r[0]: r for r in brute_manifest([(r.doc_id, r.lang, leaf[r.doc_id]) for r in rows])}
    bad = 0
    for r in queries.op12_merkle_manifest(spark, SF).collect():
        _, own, subroot, root, proof = want[r.doc_id]
        assert (r.leaf, r.subroot, r.root, r.proof_sha256) == (own, subroot, root, sha("".join(a + b for a, b in proof)))
        tampered = zlib.crc32(str(r.doc_id).encode()) % 7 == 0
        assert r.verified == (not tampered) and (r.folded_root == root) == r.verified
        bad += tampered
    assert bad > 10


# ------------------------------------------------------------ languages

def brute_marginals(e, first, move, begin):
    """Each word's label probabilities by walking all label sequences."""
    out = []
    cuts = [*np.flatnonzero(first), len(e)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        total = np.zeros((b - a, e.shape[1]))
        for ys in itertools.product(range(e.shape[1]), repeat=b - a):
            w = begin[ys[0]] * np.prod([e[a + t, y] for t, y in enumerate(ys)]) * np.prod([move[x, y] for x, y in zip(ys[:-1], ys[1:])])
            for t, y in enumerate(ys):
                total[t, y] += w
        out.append(total / total.sum(axis=1, keepdims=True))
    return np.concatenate(out)


def test_forward_backward():
    rng = np.random.default_rng(1)
    for sizes in ([1], [6], [2, 1, 5, 3, 6, 1], [4] * 9):
        for labels in (2, 3):
            first = np.zeros(sum(sizes), bool)
            first[np.cumsum([0, *sizes[:-1]])] = True
            chain = language_crf.Chain(rng.random((len(first), labels)) + 0.01, first, rng.random((labels, labels)), rng.random(labels))
            want = brute_marginals(chain.weights, first, chain.move, chain.begin)
            assert np.allclose(chain.marginals(), want)


def test_features_of_words():
    data = np.frombuffer("ab straße".encode(), np.uint8)
    words, buckets = language_crf.word_features(np.array([0, 3]), np.array([2, 10]), data)
    # Prefixes, suffixes and n-grams of 2 to 4 bytes, as far as the word goes: 2 + 2 + 1 and 4 + 4 + 6 + 5 + 4.
    assert np.bincount(words).tolist() == [5, 23] and buckets.min() >= 0 and buckets.max() < language_crf.BUCKETS
    again, same = language_crf.word_features(np.array([0]), np.array([2]), np.frombuffer(b"ab", np.uint8))
    assert sorted(same) == sorted(buckets[words == 0]) and len(again) == 5


@pytest.fixture(scope="module")
def model(spark):
    return language_crf.train_language(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def test_language_held_out(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = [r for r in language_crf.predict_language(docs, model).collect() if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    for name in ("en", "fr", "de", "es"):
        hit = sum(r.lang_pred == name for r in rows if lang[r.doc_id] == name)
        said, there = sum(r.lang_pred == name for r in rows), sum(lang[r.doc_id] == name for r in rows)
        assert there > 200 and hit >= 0.98 * there and hit >= 0.98 * said
    assert all(0 <= r.score <= 1 for r in rows)


def test_code_switched_words(spark, model):
    """Runs of two languages in one text come back, word by word."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("lang in ('fr', 'de') and n_chars > 600").filter(language_crf.held_out())
    text = {}
    for r in docs.orderBy("doc_id").collect():
        text.setdefault(r.lang, " ".join(w for w in r.text.split() if w.isalpha()).split())
    rows = [(1, " ".join(text["fr"][:20] + text["de"][:25] + text["fr"][20:45]))]
    (got,) = language_crf.language_runs(frame(spark, rows), model).collect()
    labels = [run.lang for run in got.runs for _ in range(run.n_words)]
    truth = ["fr"] * 20 + ["de"] * 25 + ["fr"] * 25
    assert len(labels) == 70 and sum(a == b for a, b in zip(labels, truth)) >= 66
    assert " ".join(run.words for run in got.runs) == rows[0][1].lower()


def test_transitions_decide_on_doubtful_words(spark, model):
    assert (np.diag(model.move) > model.move.max(axis=1) - 1e-9).all()
    words = language_crf.words_of(np.frombuffer(b"der die und nicht zz mit auch von den", np.uint8), np.array([0, 38]), language_crf.SEPARATORS)
    assert set(model.marginals(words).argmax(axis=1)) == {model.labels.index("de")}


def test_language_edges(spark, model):
    rows = [(1, None), (2, ""), (3, " 12 \n --"), (None, "the and of the"), (4, "the and"), (4, "und der"), (5, "— …"), (6, "the " * 60_000), (7, "汉字")]
    got = language_crf.predict_language(frame(spark, rows), model).collect()
    by = {r.doc_id: r for r in got if r.doc_id not in (4, None)}
    assert len(got) == len(rows)
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1, 2, 3, 5))
    assert by[6].lang_pred == "en" and by[6].n_words == 60_000 and by[6].n_switches == 0 and by[7].lang_pred in model.labels
    assert sorted(r.lang_pred for r in got if r.doc_id == 4) == ["de", "en"] and [r.held_out for r in got if r.doc_id is None] == [False]
    assert language_crf.predict_language(frame(spark, []), model).collect() == []
    untaught = language_crf.train_language(frame(spark, [(1, "some text"), (3, None)]))
    assert untaught.labels == [] and [r.lang_pred for r in language_crf.predict_language(frame(spark, [(9, "text")]), untaught).collect()] == ["und"]
    one = language_crf.train_language(frame(spark, [(1, "some text", "xx"), (3, None, "xx"), (3, "again", "xx")]))
    assert [(r.lang_pred, r.score) for r in language_crf.predict_language(frame(spark, [(9, "text")]), one).collect()] == [("xx", 1.0)]


def test_language_sample_is_bounded(spark, monkeypatch):
    """A repeated id holds most rows; the sample stays at its bound and each language has its share."""
    taken = []
    monkeypatch.setattr(language_crf, "fit", lambda runs, labels: taken.append((runs, labels)))
    rows = [(1, "wort eins zwei", "de")] * 900 + [(i, "word and some more words", "en") for i in range(400)]
    language_crf.train_language(frame(spark, rows), rows=100, words=2)
    ((runs, labels),) = taken
    assert labels == ["de", "en"] and sum(y == 1 for _, y in runs) == 50 and len(runs) <= 100
    assert all(len(t.split()) == 2 for t, _ in runs)
