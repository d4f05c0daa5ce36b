"""Benchmark decontamination by greedy string tiling.

1. *Seeds.* Every window of ``least`` words of a benchmark item is a seed. A
   document's windows first meet a bit table of all seeds (of fixed size, so a
   huge benchmark only fills it up), and the few that pass join the seeds
   exactly. That gives candidate pairs of document and item.
2. *Tiles.* For a candidate, running Karp-Rabin hashes find all common runs of
   words that no tile has marked yet, longest first; a run becomes a tile
   and its words are marked on both sides, so tiles never overlap. The search
   length is halved down to ``least``.
3. *Coverage.* A document leaks an item if tiles cover at least ``coverage`` of
   the item's words. Tiles may lie anywhere in the document and in any order,
   so a passage whose parts were reordered is caught as well.

Words are lower-cased (A-Z) and cut at white space and ASCII punctuation.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.staging import stage_table
from .tasks import map_arrow
from .wordhash import PUNCTUATION, chunks, int_lists, windows, words_of

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bits of the seed table (512 kB).
TABLE_BITS = 22
#: Candidate pairs up to this many are broadcast to their documents, more are joined.
BROADCAST_PAIRS = 1 << 18
#: And if their items have up to this many words in all (128 MB).
BROADCAST_WORDS = 1 << 24
#: Pairs of places whose runs are measured at once, about.
PAIRS = 1 << 14


def _word_lists(texts: pa.Array):
    for first, data, offsets in chunks(texts):
        words = words_of(data, offsets, PUNCTUATION)
        yield first, words


class _Running:
    """Running Karp-Rabin hashes of a word array: any range's hash by one subtraction."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.size = n
        power = np.multiply.accumulate(np.append(np.uint64(1), np.full(n, _BASE, np.uint64)))
        self.inverse = np.multiply.accumulate(np.append(np.uint64(1), np.full(n, _INVERSE, np.uint64)))
        self.total = np.concatenate([[np.uint64(0)], np.cumsum(words.view(np.uint64) * power[:n])])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        """Hashes of the ranges of ``length`` words from ``start`` on."""
        return (self.total[start + length] - self.total[start]) * self.inverse[start]


def _free_from(free: np.ndarray) -> np.ndarray:
    """How many words are free from each place on."""
    taken = np.append(np.flatnonzero(~free), len(free))
    return taken[np.searchsorted(taken, np.arange(len(free)))] - np.arange(len(free))


def _measured(run_i: _Running, run_t: _Running, room_i: np.ndarray, room_t: np.ndarray, pairs: list, least: int) -> np.ndarray:
    """(length, place in item, place in text) of the common runs of at least ``least``
    words that start at ``pairs``, each a place in item and its places in text."""
    t = np.concatenate([x for _, x in pairs])
    i = np.repeat([x for x, _ in pairs], [len(x) for _, x in pairs])
    lo, hi = np.full(len(t), least), np.minimum(room_i[i], room_t[t])
    while (lo < hi).any():
        mid = (lo + hi + 1) // 2
        same = run_i.of(i, mid) == run_t.of(t, mid)
        lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
    return np.stack([lo, i, t], axis=1)


def greedy_tiles(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (position in item, position in text, length) of two word arrays: the
    longest common run of unmarked words again and again, the first in item and
    then in text of equally long ones.

    A run is measured only from its first word, by a binary search on the running
    hashes, however many windows of the search length lie inside it.
    """
    tiles: list[tuple[int, int, int]] = []
    if min(len(item), len(text)) < least:
        return tiles
    free_i, free_t = np.ones(len(item), bool), np.ones(len(text), bool)
    run_i, run_t = _Running(item), _Running(text)
    length = max(least, min(len(item), 64))
    while True:
        room_i, room_t = _free_from(free_i), _free_from(free_t)
        ok_i, ok_t = np.flatnonzero(room_i >= length), np.flatnonzero(room_t >= length)
        hash_i, hash_t = run_i.of(ok_i, length), run_t.of(ok_t, length)
        order = np.argsort(hash_t, kind="stable")
        low, high = (np.searchsorted(hash_t[order], hash_i, side=s) for s in ("left", "right"))
        found, pairs, held = [np.zeros((0, 3), np.int64)], [], 0
        for i, a, b in zip(ok_i[high > low], low[high > low], high[high > low]):
            t = ok_t[order[a:b]]
            if i > 0 and free_i[i - 1]:  # not from inside a longer run
                t = t[~((t > 0) & free_t[t - 1] & (text[t - 1] == item[i - 1]))]
            if len(t) == 0:
                continue
            pairs.append((i, t))
            held += len(t)
            if held >= PAIRS:
                found.append(_measured(run_i, run_t, room_i, room_t, pairs, length))
                pairs, held = [], 0
        if pairs:
            found.append(_measured(run_i, run_t, room_i, room_t, pairs, length))
        runs = np.concatenate(found)
        runs = runs[np.lexsort((runs[:, 2], runs[:, 1], -runs[:, 0]))]
        cut = 0
        for n, i, t in runs.tolist():
            if n < cut:  # what is left of a cut run may be longer
                break
            if room_i[i] >= n and room_t[t] >= n and free_i[i] and free_t[t] and free_i[i + n - 1] and free_t[t + n - 1] and (
                    free_i[i : i + n].all() and free_t[t : t + n].all()):
                free_i[i : i + n] = free_t[t : t + n] = False
                tiles.append((i, t, n))
            else:
                cut = cut or n
        if not cut:
            if length == least or not free_i.any():
                return tiles
            length = max(least, length // 2)


def find_leaks(docs: DataFrame, benchmark: DataFrame, least: int = 5, coverage: float = 0.6, id_col: str = "doc_id",
               text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, n_words, n_covered, n_tiles, coverage): one row for each
    document and benchmark item that it leaks.

    ``n_words`` counts the item's words. Items of fewer than ``least`` words
    prove nothing and match nothing. Null and empty texts leak nothing; rows
    without an id are left alone. Texts that repeat an id count as one document
    (its best coverage); items that repeat an id are compared one by one. Other
    columns are ignored; an empty table on either side gives no rows.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("doc_id is not null")
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")).filter("item_id is not null")
    kinds = {c: d.schema[c].dataType.simpleString() for d, c in ((docs, "doc_id"), (items, "item_id"))}

    def read_items(batches):
        for batch in batches:
            for first, words in _word_lists(batch.column(1)):
                hashes = words.hashes.view(np.int64)
                seeds, bounds = windows(words, least)
                seeds = seeds.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(words)),
                     int_lists([hashes[words.bounds[i] : words.bounds[i + 1]] for i in range(len(words))]),
                     int_lists([np.unique(seeds[bounds[i] : bounds[i + 1]]) for i in range(len(words))])],
                    ["item_id", "words", "seeds"])

    known = stage_table(map_arrow(items, read_items, f"item_id {kinds['item_id']}, words array<long>, seeds array<long>"), "leak-items")
    known = known.withColumn("item", F.xxhash64("item_id", "words"))
    seeds = known.select("item", F.explode("seeds").alias("seed"))
    bucket = F.shiftrightunsigned("seed", 64 - TABLE_BITS)
    table = np.zeros(1 << (TABLE_BITS - 6), np.uint64)
    rows = seeds.groupBy(F.shiftright(bucket, 6).alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(seed, {64 - TABLE_BITS}) & 63 as int))")).alias("bits")).toArrow()
    table[rows.column(0).to_numpy()] = rows.column(1).to_numpy().view(np.uint64)

    def find_seeds(batches):
        for batch in batches:
            for first, words in _word_lists(batch.column(1)):
                hashes, bounds = windows(words, least)
                place = hashes >> np.uint64(64 - TABLE_BITS)
                hit = np.flatnonzero((table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1))
                doc = np.searchsorted(bounds, hit, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(first + doc)), pa.array(hashes[hit].view(np.int64))], ["doc_id", "seed"])

    hits = map_arrow(docs, find_seeds, f"doc_id {kinds['doc_id']}, seed long")
    pairs = hits.join(seeds, "seed").select("doc_id", "item").distinct()
    pairs = stage_table(pairs.join(known.select("item", "item_id", "words").dropDuplicates(["item"]), "item")
                        .select("doc_id", "item_id", F.col("words").alias("item_words")), "leak-pairs")
    n_pairs, n_words = pairs.agg(F.count("*"), F.coalesce(F.sum(F.size("item_words").cast("long")), F.lit(0))).first()
    few = n_pairs <= BROADCAST_PAIRS and n_words <= BROADCAST_WORDS
    # Repeated items are small in the staged file, so Spark is told not to judge by its size.
    asked = docs.join(F.broadcast(pairs) if few else pairs.hint("merge"), "doc_id").select("doc_id", "text", "item_id", "item_words")

    def tile(batches):
        for batch in batches:
            wanted, out = batch.column(3), []
            for first, words in _word_lists(batch.column(1)):
                hashes = words.hashes.view(np.int64)
                for k in range(len(words)):
                    item = wanted[first + k].values.to_numpy(zero_copy_only=False)
                    tiles = greedy_tiles(item, hashes[words.bounds[k] : words.bounds[k + 1]], least)
                    out.append((len(item), sum(t[2] for t in tiles), len(tiles)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *(pa.array([o[j] for o in out], pa.int64()) for j in range(3))],
                ["doc_id", "item_id", "n_words", "n_covered", "n_tiles"])

    tiled = map_arrow(asked, tile, f"doc_id {kinds['doc_id']}, item_id {kinds['item_id']}, n_words long, n_covered long, n_tiles long")
    best = F.max(F.struct((F.col("n_covered") / F.col("n_words")).alias("coverage"), "n_words", "n_covered", "n_tiles")).alias("best")
    return (tiled.withColumn("part", F.col("n_covered") / F.col("n_words")).filter(F.col("part") >= coverage)
            .groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", "best.n_words", "best.n_covered", "best.n_tiles", "best.coverage"))
