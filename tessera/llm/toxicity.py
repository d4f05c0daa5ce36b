"""Toxicity: a linear text classifier with a counterfactual penalty.

Features are words (lower-cased A-Z, cut at white space and ASCII punctuation): the
logarithm of a word's count and its density in the text. Training minimises
the logistic loss plus a penalty on score changes: every labelled text with an
identity term gets counterfactual twins in which the terms are swapped for
others of the same kind, and the squared difference of the two logits is added
with weight ``LAMBDA``. A neutral mention of a group can then not move the
score by itself; the words around it must.

Fitted on the driver over at most ``TRAIN_ROWS`` labelled rows, of which only
sparse word counts arrive there. Scoring looks words up in the fitted
vocabulary, vectorised over a batch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .labelled import held_out, training_texts
from .tasks import map_arrow
from .wordhash import PUNCTUATION, chunks, words_of

#: A feature word stands in at least this many sampled documents ...
LEAST_DOCUMENTS = 5
#: ... and its share of toxic ones differs from the rest's by so many standard errors.
LEAST_Z = 3.0
#: Labelled rows that the classifier is fitted on, at most.
TRAIN_ROWS = 10_000
LAMBDA = 5.0
TWINS = 2

#: Terms that may be swapped for one another, by kind.
IDENTITY = [
    "muslim christian jewish hindu buddhist catholic protestant sikh atheist".split(),
    "muslims christians jews hindus buddhists catholics protestants sikhs atheists".split(),
    "black white asian latino hispanic african european arab indian chinese mexican".split(),
    "gay straight lesbian bisexual queer heterosexual homosexual transgender".split(),
    "women men girls boys".split(), "woman man girl boy".split(), "she he".split(), "female male".split(),
    "immigrants refugees migrants natives citizens".split(), "old young elderly teenage".split(),
    "blind deaf disabled paralyzed".split(),
    "musulman chrétien juif hindou bouddhiste".split(), "femmes hommes".split(), "muslimisch christlich jüdisch".split(),
    "frauen männer".split(), "musulmán cristiano judío".split(), "mujeres hombres".split(),
]

def word_hashes(terms: list[str]) -> np.ndarray:
    return np.concatenate([words_of(d, o, PUNCTUATION).hashes for _, d, o in chunks(pa.array(terms))]).view(np.int64)


def _documents(texts: pa.Array):
    """Each document's word hashes (int64)."""
    for _, data, offsets in chunks(texts):
        words = words_of(data, offsets, PUNCTUATION)
        hashes = words.hashes.view(np.int64)
        for i in range(len(words)):
            yield hashes[words.bounds[i] : words.bounds[i + 1]]


def _values(counts: np.ndarray, sizes) -> np.ndarray:
    """A word's feature from its count and the text's number of words."""
    return np.log1p(counts) * 0.5 + np.minimum(counts * 50.0 / np.maximum(sizes, 10), 4.0) * 0.5


@dataclass
class ToxicityModel:
    words: np.ndarray       # sorted word hashes
    weights: np.ndarray
    intercept: float

    def logits(self, texts: pa.Array) -> np.ndarray:
        out = []
        for own in _documents(texts):
            logit = self.intercept
            if len(own) and len(self.words):
                at = np.minimum(np.searchsorted(self.words, own), len(self.words) - 1)
                at = at[self.words[at] == own]
                if len(at):
                    ids, counts = np.unique(at, return_counts=True)
                    logit += float(_values(counts, len(own)) @ self.weights[ids])
            out.append(logit)
        return np.array(out)

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -30, 30)))


def _twins(counts: list[np.ndarray], words: list[np.ndarray], seed: int = 7):
    """Swap identity terms in labelled texts: (document, word, new word) triples,
    ``TWINS`` twins for each document that holds a term."""
    kind, member = {}, []
    for group in IDENTITY:
        hashes = word_hashes(group)
        for h in hashes.tolist():
            kind.setdefault(h, len(member))
        member.append(hashes)
    known = np.array(sorted(kind), dtype=np.int64)
    rng = np.random.default_rng(seed)
    out = []
    for d, own in enumerate(words):
        terms = own[np.isin(own, known)]
        if len(terms):
            for _ in range(TWINS):
                out.append((d, {int(t): int(rng.choice(member[kind[int(t)]])) for t in terms}))
    return out


def fit(words: list[np.ndarray], counts: list[np.ndarray], sizes: np.ndarray, labels: np.ndarray, steps: int = 300,
        rate: float = 0.05, ridge: float = 2e-4, penalty: float = LAMBDA) -> ToxicityModel:
    """Sparse logistic regression by Adam, with the counterfactual penalty. No
    rows, or one class only, give a constant score."""
    share = (labels.sum() + 0.5) / (len(labels) + 1.0)
    bias = float(np.log(share / (1 - share)))
    if len(np.unique(labels)) < 2:
        return ToxicityModel(np.zeros(0, np.int64), np.zeros(0), bias)
    every, at = np.unique(np.concatenate(words), return_inverse=True)
    held = np.bincount(at, minlength=len(every))
    toxic = np.bincount(at, np.repeat(labels, [len(w) for w in words]), len(every))
    apart = np.abs(toxic - held * share) / np.sqrt(held * share * (1 - share))
    terms = np.concatenate([word_hashes(g) for g in IDENTITY])
    vocab = np.unique(np.concatenate([every[(held >= LEAST_DOCUMENTS) & (apart >= LEAST_Z)], terms]))
    index = lambda w: np.minimum(np.searchsorted(vocab, w), len(vocab) - 1)

    def sparse(docs):
        row, col, val = [], [], []
        for r, (w, c, n) in enumerate(docs):
            at = index(w)
            ok = vocab[at] == w
            row.append(np.full(ok.sum(), r))
            col.append(at[ok])
            val.append(_values(c[ok], n))
        join = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
        return join(row, np.int64), join(col, np.int64), join(val, float)

    row, col, val = sparse(zip(words, counts, sizes))
    # Differences between texts and their twins, as sparse rows.
    changed = []
    for d, swap in _twins(counts, words):
        twin: dict[int, int] = {}
        for w, c in zip(words[d].tolist(), counts[d].tolist()):
            if w in swap:
                twin[swap[w]] = twin.get(swap[w], 0) + c
        changed.append((d, list(swap), twin))
    t_row, t_col, t_val = [], [], []
    for r, (d, old, twin) in enumerate(changed):
        place = {int(w): i for i, w in enumerate(words[d].tolist())}
        for sign, part in ((1.0, {w: int(counts[d][place[w]]) for w in old}), (-1.0, twin)):
            for w, c in part.items():
                i = int(index(np.array([w]))[0])
                t_row.append(r)
                t_col.append(i)
                t_val.append(sign * float(_values(np.array([c]), sizes[d])[0]))
    t_row, t_col, t_val = np.array(t_row, np.int64), np.array(t_col, np.int64), np.array(t_val, float)

    n, k = len(labels), len(vocab)
    weights = np.zeros(k)
    balance = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share)) ** 0.5
    first, second, b1, b2 = np.zeros(k + 1), np.zeros(k + 1), 0.0, 0.0
    for step in range(1, steps + 1):
        logit = np.bincount(row, val * weights[col], n) + bias
        error = balance * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels) / n
        grad = np.bincount(col, val * error[row], k) + ridge * weights
        if changed:
            gap = np.bincount(t_row, t_val * weights[t_col], len(changed))
            grad += penalty * np.bincount(t_col, t_val * gap[t_row], k) / len(changed)
        full = np.append(grad, error.sum())
        first, second = 0.9 * first + 0.1 * full, 0.999 * second + 0.001 * full**2
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights -= move[:k]
        bias -= move[k]
    used = np.abs(weights) > 1e-3
    return ToxicityModel(vocab[used], weights[used], float(bias))


def train_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
                   rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Fit on labelled documents outside the test fold (``rows`` of them at most)."""

    def run(batches):
        for batch in batches:
            found = [np.unique(w, return_counts=True) for w in _documents(batch.column(1))]
            sizes = [int(c.sum()) for _, c in found]
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(w) for w, _ in found])]).astype(np.int32))
            flat = lambda x, t: pa.array(np.concatenate([np.zeros(0, t), *x]).astype(t))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets, flat([w for w, _ in found], np.int64)),
                 pa.ListArray.from_arrays(offsets, flat([c for _, c in found], np.int32)), pa.array(sizes, pa.int64()), batch.column(2)],
                ["doc_id", "words", "counts", "size", "label"])

    known = training_texts(docs, labels, label, id_col, text_col, rows)
    kind = known.schema["doc_id"].dataType.simpleString()
    table = map_arrow(known, run, f"doc_id {kind}, words array<long>, counts array<int>, size long, label int").orderBy("doc_id").toArrow()

    def lists(name):
        column = table.column(name).combine_chunks()
        return np.split(column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()[1:-1] - column.offsets[0].as_py()) if len(column) else []

    return fit(lists("words"), lists("counts"), table.column("size").to_numpy(), table.column("label").to_numpy().astype(float))


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", cut: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row of ``docs``.

    The score comes from the text alone. Null and empty texts score by the
    intercept. Null and repeated ids are carried as they are; other columns are
    ignored; an empty table gives no rows.
    """

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(model.scores(batch.column(1)))], ["doc_id", "held_out", "score"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), held_out(id_col).alias("held_out"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    out = map_arrow(narrow, run, f"doc_id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= cut).cast("int"))
