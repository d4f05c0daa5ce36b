"""Language of words and texts: a linear-chain conditional random field.

Every word of a text gets a language label. A word's score for a label is the sum
of the label's weights of its features: hashed prefixes and suffixes of one to
four bytes, hashed n-grams of two to four bytes, and the word itself if the
lexicon of the training words has it. Learned transitions tie neighbours
together, so that a doubtful word follows its surroundings and a run of words in
another language still stands out. Forward-backward gives each word's
probability of each label.

Forward and backward run over all texts of a chunk at once. A text's first word
carries a step that forgets what came before, so the chunk is one chain; the chain
is cut into about the square root of its length blocks, the product of each
block's step matrices joins the blocks, and the inside of all blocks is walked
side by side. The cost does not depend on how words are dealt over texts.

The model is fitted on the driver over a bounded sample: at most ``TRAIN_ROWS``
texts, shared evenly among the languages and chosen by the hash of the id, and
of each of them a run of ``RUN_WORDS`` words at a place chosen by the same hash.
Runs of different languages are spliced into code-switched sequences, which is
what teaches the transitions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .tasks import map_arrow
from .wordhash import chunks, mix, words_of

#: Texts that the model is fitted on, and words taken from each, at most.
TRAIN_ROWS, RUN_WORDS = 4000, 30
#: Runs that are spliced into one training sequence.
SPLICED = 8
#: Weights of hashed affixes and n-grams for each label.
BUCKETS = 1 << 16
CHUNK_BYTES = 1 << 19
UNKNOWN = "und"

#: Bytes that part words: ASCII other than letters. Digits and signs are in no word.
SEPARATORS = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
_KINDS = mix(np.arange(1, 33, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


def held_out(id_col: str = "doc_id") -> Column:
    """The test fold: crc32 of the id's text leaves 2 modulo 4. Null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def word_features(start: np.ndarray, end: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of every affix and n-gram of the words at these bytes, by word."""
    size = end - start
    word = np.repeat(np.arange(len(size)), size)
    begin = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - begin[word]
    left = size[word] - place  # bytes from here to the word's end
    text = data[start[word] + place].astype(np.uint64)
    key = np.zeros(len(text), np.uint64)
    words, buckets = [], []
    for n in range(1, 5):
        key = (key << np.uint64(8)) | np.append(text[n - 1 :], np.zeros(min(n - 1, len(text)), np.uint64))[: len(text)]
        fits = left >= n
        for kind, chosen in ((0, fits & (place == 0)), (1, fits & (left == n)), (2, fits & (n > 1))):
            at = np.flatnonzero(chosen)
            words.append(word[at])
            buckets.append((mix(key[at] ^ _KINDS[4 * kind + n]) & np.uint64(BUCKETS - 1)).astype(np.int64))
    words, buckets = np.concatenate(words), np.concatenate(buckets)
    order = np.argsort(words, kind="stable")
    return words[order], buckets[order]


@dataclass
class Chain:
    """Forward-backward over consecutive words of several sequences.

    ``weights`` (words x labels) are exponentials of word scores, ``first`` marks
    the words that begin a sequence, ``move`` and ``begin`` are exponentials of
    transition and start scores."""

    weights: np.ndarray
    first: np.ndarray
    move: np.ndarray
    begin: np.ndarray

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(forward, backward, scale): forward sums to 1 at each word, backward is
        scaled freely; scale is the log of the sum that forward was divided by."""
        words, labels = self.weights.shape
        width = max(1, int(np.ceil(np.sqrt(words))))
        blocks = -(-words // width)
        padded = blocks * width
        e = np.ones((padded, labels))
        e[:words] = self.weights
        first = np.zeros(padded, bool)
        first[:words] = self.first
        first[words:] = True  # words beyond the end stand for themselves
        e, first = e.reshape(blocks, width, labels), first.reshape(blocks, width)

        def step(j):  # blocks x from x to
            return np.where(first[:, j, None, None], self.begin, self.move)

        through = np.broadcast_to(np.eye(labels), (blocks, labels, labels))
        for j in range(width):
            through = (through @ step(j)) * e[:, j, None, :]
            through = through / through.sum(axis=(1, 2), keepdims=True)
        enter, leave = np.empty((blocks, labels)), np.empty((blocks, labels))
        state = np.full(labels, 1.0 / labels)
        for k in range(blocks):
            enter[k] = state
            state = state @ through[k]
            state = state / state.sum()
        state = np.ones(labels)
        for k in range(blocks - 1, -1, -1):
            leave[k] = state
            state = through[k] @ state
            state = state / state.sum()
        forward, backward, scale = np.empty_like(e), np.empty_like(e), np.empty((blocks, width))
        state = enter
        for j in range(width):
            state = (state[:, None, :] @ step(j))[:, 0] * e[:, j]
            scale[:, j] = state.sum(axis=1)
            state = state / scale[:, j, None]
            forward[:, j] = state
        state = leave
        for j in range(width - 1, -1, -1):
            backward[:, j] = state
            state = (step(j) @ (state * e[:, j])[:, :, None])[:, :, 0]
            state = state / state.sum(axis=1, keepdims=True)
        flat = lambda x: x.reshape(padded, -1)[:words]
        return flat(forward), flat(backward), np.log(scale.reshape(padded)[:words])

    def marginals(self) -> np.ndarray:
        forward, backward, _ = self.run()
        both = forward * backward
        return both / both.sum(axis=1, keepdims=True)


@dataclass
class LanguageModel:
    labels: list[str]
    buckets: np.ndarray     # BUCKETS x labels
    lexicon: np.ndarray     # sorted word hashes
    known: np.ndarray       # a row for each lexicon word, and a last one for all others
    bias: np.ndarray
    move: np.ndarray        # transition scores, from x to
    begin: np.ndarray

    def _place(self, hashes: np.ndarray) -> np.ndarray:
        """Rows of ``known`` for these word hashes."""
        if len(self.lexicon) == 0:
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == hashes, at, len(self.lexicon))

    def word_scores(self, words) -> np.ndarray:
        """Scores (words x labels) of all words of a chunk; equal words are scored once."""
        hashes, at, which = np.unique(words.hashes, return_index=True, return_inverse=True)
        word, bucket = word_features(words.start[at], words.end[at], words.data)
        total = np.zeros((len(bucket) + 1, len(self.labels)))
        np.cumsum(self.buckets[bucket], axis=0, out=total[1:])
        ends = np.searchsorted(word, np.arange(len(hashes) + 1))
        return (total[ends[1:]] - total[ends[:-1]] + self.known[self._place(hashes)] + self.bias)[which]

    def marginals(self, words) -> np.ndarray:
        """Each word's probability of each label; ``words`` are those of one chunk."""
        if len(words.hashes) == 0:
            return np.zeros((0, len(self.labels)))
        scores = self.word_scores(words)
        first = np.zeros(len(scores), bool)
        first[words.bounds[:-1][np.diff(words.bounds) > 0]] = True
        return Chain(np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -60)), first, np.exp(self.move), np.exp(self.begin)).marginals()


def fit(runs: list, labels: list[str], rounds: int = 30, rate: float = 0.3, penalty: float = 2e-4, least: int = 3) -> LanguageModel:
    """Fit on ``runs`` of (text, label index), spliced ``SPLICED`` at a time in the
    order given, by Adam steps on the penalised conditional likelihood. The lexicon
    takes the words that occur ``least`` times. Without runs all scores are 0."""
    n = len(labels)
    sizes = np.concatenate([[0], np.cumsum([len(t.encode()) for t, _ in runs])]).astype(np.int64)
    words = words_of(np.frombuffer("".join(t for t, _ in runs).encode(), np.uint8), sizes, SEPARATORS)
    hashes, at, which, counts = np.unique(words.hashes, return_index=True, return_inverse=True, return_counts=True)
    lexicon = hashes[counts >= least]
    model = LanguageModel(labels, np.zeros((BUCKETS, n)), lexicon, np.zeros((len(lexicon) + 1, n)), np.zeros(n), np.zeros((n, n)), np.zeros(n))
    if len(words.hashes) == 0 or n < 2:
        return model
    word, bucket = word_features(words.start[at], words.end[at], words.data)
    ends = np.searchsorted(word, np.arange(len(hashes) + 1))
    place = model._place(hashes)
    used, local = np.unique(bucket, return_inverse=True)
    length = np.diff(words.bounds)
    truth = np.repeat(np.array([y for _, y in runs]), length)
    edges = words.bounds[:-1:SPLICED]
    first = np.zeros(len(truth), bool)
    first[edges[edges < len(truth)]] = True
    inner = np.flatnonzero(~first)
    gold = np.zeros((len(truth), n))
    gold[np.arange(len(truth)), truth] = 1
    gold_moves = np.bincount(truth[inner - 1] * n + truth[inner], minlength=n * n).reshape(n, n)
    weights = [np.zeros((len(used), n)), model.known, model.bias, model.move, model.begin]
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]

    def by(keys, values, size):
        return np.stack([np.bincount(keys, values[:, y], size) for y in range(n)], axis=1)

    for step in range(1, rounds + 1):
        total = np.zeros((len(bucket) + 1, n))
        np.cumsum(weights[0][local], axis=0, out=total[1:])
        scores = (total[ends[1:]] - total[ends[:-1]] + weights[1][place] + weights[2])[which]
        e = np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -60))
        move, begin = np.exp(weights[3]), np.exp(weights[4])
        forward, backward, _ = Chain(e, first, move, begin).run()
        both = forward * backward
        error = gold - both / both.sum(axis=1, keepdims=True)
        pair = forward[inner - 1][:, :, None] * move * (e * backward)[inner][:, None, :]
        pair = (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        typed = by(which, error, len(hashes))
        slopes = [by(local, typed[word], len(used)), by(place, typed, len(lexicon) + 1), error.sum(axis=0), gold_moves - pair, error[first].sum(axis=0)]
        for w, g, m, v in zip(weights, slopes, mean, square):
            g = g / len(truth) - penalty * w
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    model.buckets[used] = weights[0]
    return model


def _run_of(text: str, draw: int, words: int) -> str:
    """``words`` consecutive words of a text from a place that ``draw`` chooses."""
    data = np.frombuffer(text.encode(), np.uint8)
    found = words_of(data, np.array([0, len(data)]), SEPARATORS)
    n = len(found.hashes)
    if n == 0:
        return ""
    first = draw % max(1, n - words + 1)
    return bytes(data[found.start[first] : found.end[min(first + words, n) - 1]]).decode() + " "


def train_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", rows: int = TRAIN_ROWS,
                   words: int = RUN_WORDS) -> LanguageModel:
    """Fit on documents outside the test fold that have a language.

    Every language gives an even share of ``rows``, those with the least hash of
    their id, or all it has (a language in few documents is over-represented, not
    left out; with more languages than ``rows`` those with the least hashes of an
    id are learned). Only runs of ``words`` words reach the driver. Null texts and
    texts without a word teach nothing, but their language stays a label.
    """
    known = docs.select(F.col(id_col).alias("doc_id"), F.lower(F.col(text_col).cast("string")).alias("text"), F.col(label_col).cast("string").alias("label"),
                        F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 40)).alias("draw")).filter(~held_out("doc_id")).filter("label is not null")
    counts = known.groupBy("label").agg(F.count("*").alias("c"), F.min("draw").alias("d")).orderBy("d", "label").limit(rows).toArrow().to_pylist()
    if not counts:
        return fit([], [])
    labels = sorted(r["label"] for r in counts)
    share = max(1, rows // len(labels))
    # As many rows as a language's share are expected under its bound on the draw; a wide
    # margin and the limit by rank then make it exact without ordering the whole table.
    bound = {r["label"]: (1 << 40) if r["c"] <= share else min(1 << 40, int((share + 6 * share**0.5 + 20) / r["c"] * (1 << 40))) for r in counts}
    listed = F.create_map(*[F.lit(x) for r in bound.items() for x in r])
    chosen = known.filter(F.col("draw") < listed[F.col("label")])

    def run(batches):
        for batch in batches:
            texts = [_run_of(t or "", d // 64, words) for t, d in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(texts), batch.column(1), batch.column(2)], ["text", "label", "draw"])

    most = len(labels) * (share + int(12 * share**0.5) + 64)
    runs = map_arrow(chosen.select("text", "label", "draw"), run, "text string, label string, draw long").orderBy("draw", "label", "text").limit(most).toArrow().to_pylist()
    left, kept = dict.fromkeys(labels, share), []
    for r in runs:
        if left.get(r["label"], 0) > 0:
            left[r["label"]] -= 1
            kept.append((r["text"], labels.index(r["label"])))
    return fit(kept, labels)


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("doc_id"), F.lower(text).alias("text"), held_out(id_col).alias("held_out"),
                       F.coalesce(F.regexp_like(text, F.lit(r"\p{L}")), F.lit(False)).alias("letters"))


def predict_language(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, n_words, n_switches), one row for each row of ``docs``.

    ``lang_pred`` is the language with the greatest mean probability over all words
    (the least of ties), ``score`` that mean. ``und`` with score 0 stands for a null
    text and for one without a letter, or if no language was learned. ``n_switches``
    counts neighbouring words whose most likely languages differ. Null and repeated
    ids are carried as they are; other columns are ignored, whatever their names; an
    empty table gives no rows. Texts are read whole, however long.
    """

    def run(batches):
        for batch in batches:
            for first, data, offsets in chunks(batch.column(1), CHUNK_BYTES):
                rows = len(offsets) - 1
                found = words_of(data, offsets, SEPARATORS)
                count = np.diff(found.bounds)
                sums = np.zeros((rows, max(1, len(model.labels))))
                switches = np.zeros(rows, np.int64)
                if len(found.hashes) and model.labels:
                    p = model.marginals(found)
                    total = np.concatenate([np.zeros((1, p.shape[1])), np.cumsum(p, axis=0)])
                    sums = total[found.bounds[1:]] - total[found.bounds[:-1]]
                    best = p.argmax(axis=1)
                    changes = np.concatenate([[0, 0], np.cumsum(best[1:] != best[:-1])])
                    switches = np.where(count > 0, changes[found.bounds[1:]] - changes[np.minimum(found.bounds[:-1] + 1, len(best))], 0)
                some = batch.column(3).slice(first, rows).to_numpy(zero_copy_only=False) & (count > 0) & bool(model.labels)
                top = sums.argmax(axis=1)
                names = [model.labels[t] if s else UNKNOWN for t, s in zip(top, some)]
                score = np.where(some, np.clip(sums[np.arange(rows), top] / np.maximum(count, 1), 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, rows), batch.column(2).slice(first, rows), pa.array(names, pa.string()), pa.array(score),
                     pa.array(count, pa.int64()), pa.array(switches, pa.int64())],
                    ["doc_id", "held_out", "lang_pred", "score", "n_words", "n_switches"])

    narrow = _narrow(docs, id_col, text_col)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return map_arrow(narrow, run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, n_words long, n_switches long")


def language_runs(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, runs), one row for each row of ``docs``: the runs of words with one
    most likely language, as an array of (lang, n_words, words) in text order. The
    words are the lower-cased text from the run's first word to its last. Empty
    for texts without words. Ids and other columns as in ``predict_language``."""

    def run(batches):
        for batch in batches:
            for first, data, offsets in chunks(batch.column(1), CHUNK_BYTES):
                found = words_of(data, offsets, SEPARATORS)
                best = model.marginals(found).argmax(axis=1) if model.labels else np.zeros(len(found.hashes), np.int64)
                out = []
                for a, b in zip(found.bounds[:-1], found.bounds[1:]):
                    cuts = np.concatenate([[a], np.flatnonzero(best[a + 1 : b] != best[a : b - 1]) + a + 1, [b]]) if b > a else np.zeros(0, int)
                    out.append([{"lang": model.labels[best[i]] if model.labels else UNKNOWN, "n_words": int(j - i),
                                 "words": bytes(found.data[found.start[i] : found.end[j - 1]]).decode()} for i, j in zip(cuts[:-1], cuts[1:])])
                kind = pa.list_(pa.struct([("lang", pa.string()), ("n_words", pa.int64()), ("words", pa.string())]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(out)), pa.array(out, kind)], ["doc_id", "runs"])

    narrow = _narrow(docs, id_col, text_col).select("doc_id", "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return map_arrow(narrow, run, f"doc_id {kind}, runs array<struct<lang: string, n_words: long, words: string>>")
