"""Classes of alike spot signatures against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import queries, spot_classes, spotsigs
from test_text_operators import SF, brute_spots, frame, table


def brute(spark, rows, percent=80):
    """(doc_id, class_id) of each row, by all pairs."""
    sets = brute_spots(spark, [t for _, t in rows])
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, least.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def classes(spark, rows, percent=80):
    docs = frame(spark, rows)
    got = spotsigs.fingerprint_documents(docs, rows=7, classes=spot_classes.spot_classes(docs, percent))
    return sorted(((r.doc_id, r.class_id) for r in got.collect()), key=str)


def text(rng, n):
    return [rng.choice(["the", "of", "and"]) + f" w{rng.randrange(5000)} w{rng.randrange(5000)}" for _ in range(n)]


def near_copies(seed):
    """A large group of near copies, templates with tails of their own (17 to 26 in a
    hundred, around the threshold), short texts and chains of edits."""
    rng = random.Random(seed)
    rows, base = [], text(rng, 60)
    for _ in range(60):
        own = list(base)
        for _ in range(rng.randrange(1, 9)):
            own[rng.randrange(len(own))] = text(rng, 1)[0]
        rows.append(own)
    template = text(rng, 100)
    rows.append(template)
    rows += [template + text(rng, rng.randrange(17, 27)) for _ in range(30)]
    rows += [text(rng, rng.randrange(1, 6)) for _ in range(20)]
    chain = text(rng, 40)
    for _ in range(15):
        chain = chain[3:] + text(rng, 3)
        rows.append(chain)
    rows += [list(base)] * 5
    rng.shuffle(rows)
    return [(100 + 3 * k, " ".join(r)) for k, r in enumerate(rows)]


@pytest.mark.parametrize("percent", [50, 80])
def test_classes_of_near_copies(spark, percent):
    rows = near_copies(percent)
    want = brute(spark, rows, percent)
    assert len({c for _, c in want}) < len(rows) - 40
    assert classes(spark, rows, percent) == want


def test_rest_finds_links_that_leaders_miss(spark, monkeypatch):
    rows = near_copies(7)
    monkeypatch.setattr(spot_classes, "_led", lambda shared, percent: shared.selectExpr("rep a", "rep b").limit(0))
    assert classes(spark, rows) == brute(spark, rows)


def test_classes_of_the_table(spark):
    rows = [(r[0], r[1]) for r in table("documents")]
    want = brute(spark, rows)
    assert any(i != c for i, c in want)
    got = queries.op3_spotsigs(spark, SF).collect()
    assert sorted(((r.doc_id, r.class_id) for r in got), key=str) == want


def test_class_edges(spark):
    assert classes(spark, []) == []
    same = "the quick brown fox of the lazy dog and the other small cat"
    rows = [(None, same), (9, same), (4, same), (4, "the one text of other words here"), (4, same), (1, None), (2, ""), (3, " . "),
            (None, "a lone text without the id of any row"), (-(2**63), "no other of these"), (8, "the same two of that"), (8, "the same two of that")]
    assert classes(spark, rows) == brute(spark, rows)
    extra = frame(spark, rows).selectExpr("*", "1 as row", "2 as hash", "3 as rep", "4 as spots")
    got = spotsigs.fingerprint_documents(extra, classes=spot_classes.spot_classes(extra))
    assert sorted(((r.doc_id, r.class_id) for r in got.collect()), key=str) == brute(spark, rows)


def test_long_and_repetitive_texts(spark):
    rows = [(1, "the same word " * 50_000), (2, "the same word " * 50_001), (3, " ".join(f"the w{k} v{k}" for k in range(20_000)))]
    assert classes(spark, rows) == [(1, 1), (2, 1), (3, 3)]


def sketched(spark, sets):
    rows = [(k, len(s), sorted(s)) for k, s in enumerate(sets)]
    frame = spark.createDataFrame(rows, "row long, n int, spots array<int>")
    return frame.select("row", "n", spot_classes._sketch(frame.spots).alias("bits"))


def test_sketches_of_every_size(spark):
    """A sketch differs from another in no more bits than the sets, and tells large sets apart."""
    rng = random.Random(3)
    draw = lambda n: set(rng.sample(range(-(1 << 31), 1 << 31), n))
    sets = [draw(n) for n in (1, 40, 512, 513, 560, 2000, 2100, 2400, 9000)]
    sets += [set(list(s)[: len(s) * 19 // 20]) | draw(len(s) // 40) for s in sets]  # linked, some with a sketch of another size
    rows = {r.row: r.bits for r in sketched(spark, sets).collect()}
    for k, s in enumerate(sets):
        bits = rows[k]
        assert 64 * len(bits) >= len(s)
        want = [0] * len(bits)
        for x in s:
            want[(x >> 6) % len(bits)] ^= 1 << (x & 63)
        assert [b % (1 << 64) for b in bits] == want
    pairs = [(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))]
    fit = lambda a, b: min(len(sets[a]), len(sets[b])) * 100 >= max(len(sets[a]), len(sets[b])) * 80
    pairs = [(a, b) for a, b in pairs if fit(a, b)]
    got = spot_classes._near(sketched(spark, sets), spark.createDataFrame(pairs, "a long, b long"), 80)
    linked = {(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert len({len(b) for b in rows.values()}) == 4 and len(linked) >= 7 and len(pairs) > len(linked) + 5
    assert {(r.a, r.b) for r in got.collect()} == linked


def test_long_texts_with_a_common_phrase_are_no_pairs(spark, monkeypatch):
    """Unrelated long texts that share one signature never have their whole sets compared, nor their sketches after the leaders'."""
    rng = random.Random(5)
    rows = [(k, " ".join(["the common phrase", *(f"the w{rng.randrange(10**9)} v{rng.randrange(10**9)}" for _ in range(1100 + k))])) for k in range(24)]
    rows += [(100 + k, f"{t} the tail{k} end") for k, t in rows[:3]]
    near, whole = [], []
    for name, seen in (("_near", near), ("_verified", whole)):
        monkeypatch.setattr(spot_classes, name, lambda sets, pairs, percent, f=getattr(spot_classes, name), seen=seen: seen.append(pairs.count()) or f(sets, pairs, percent))
    [phrase] = frame(spark, [(0, "the common phrase")]).select(spotsigs.spot_signatures(F.col("text"))).first()[0]
    levels = bytearray(b"\1" * spot_classes.CELLS)
    levels[phrase % spot_classes.CELLS] = 0  # the phrase comes first in every order
    monkeypatch.setattr(spot_classes, "_levels", lambda signed: levels)
    got = classes(spark, rows)
    assert got == sorted(((i, i % 100) for i, _ in rows), key=str)
    assert near[1] == 0 and sum(whole) <= 3
