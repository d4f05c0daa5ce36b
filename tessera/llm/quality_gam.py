"""Quality classifier: a generalised additive model with pairwise interactions.

Every text becomes a dozen shape features (lengths, repetition, symbols, case),
and every feature is cut into quantile bins. Training cycles over the features
for many rounds; each step grows a shallow tree (four leaves at most) on the
residuals of one feature's bins and adds a small share of it to that feature's
lookup table. The pairs of features whose joint bins still explain most of the
residuals get two-way tables, boosted the same way. A score is the logistic
function of the sum of table entries: bin searches and additions, vectorised
over a batch.

Fitted on the driver over at most ``TRAIN_ROWS`` labelled rows, of which only
the features arrive there.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .labelled import TRAIN_ROWS, held_out, training_texts
from .tasks import map_arrow
from .wordhash import Words, chunks, words_of

FEATURES = ["log_words", "word_length", "distinct_share", "top_share", "repeated_share", "symbol_share", "upper_share", "digit_share",
            "pipe_share", "stop_share", "line_words", "repeated_lines"]
BINS, PAIR_BINS = 48, 8


def text_features(words: Words, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` for each document of a chunk."""
    n = len(words)
    count = np.diff(words.bounds)
    letters = np.add.reduceat(np.append(words.end - words.start, 0), np.minimum(words.bounds[:-1], len(words.start))) if n else count
    letters = np.where(count > 0, letters, 0)
    size = np.maximum(np.diff(offsets), 1)

    def share(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[data])])
        return (total[offsets[1:]] - total[offsets[:-1]]) / size

    kind = np.zeros((4, 256), dtype=np.int64)
    kind[0, [b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:!?'\"()-"]] = 1
    kind[1, 65:91] = 1
    kind[2, 48:58] = 1
    kind[3, [ord("|")]] = 1
    stop = np.concatenate([[0], np.cumsum(data[np.maximum(words.end - 1, 0)] == ord("."))]) if len(words.end) else np.zeros(1)
    rest = np.zeros((n, 5))
    newline = np.flatnonzero(data == 10)
    for i in range(n):
        own = words.hashes[words.bounds[i] : words.bounds[i + 1]]
        if len(own) == 0:
            continue
        _, times = np.unique(own, return_counts=True)
        cuts = newline[np.searchsorted(newline, offsets[i]) : np.searchsorted(newline, offsets[i + 1])]
        ends = np.append(np.searchsorted(words.start[words.bounds[i] : words.bounds[i + 1]], cuts), len(own))
        begins = np.concatenate([[0], ends[:-1]])
        plain = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own)])
        full = ends > begins
        lines = (plain[ends] - plain[begins])[full]
        rest[i] = (len(times) / len(own), times.max() / len(own), (own[1:] == own[:-1]).mean() if len(own) > 1 else 0.0,
                   len(own) / max(len(lines), 1), 1 - len(np.unique(lines)) / max(len(lines), 1))
    shares = [share(k) for k in kind]
    many = np.maximum(count, 1)
    return np.stack([np.log1p(count), letters / many, rest[:, 0], rest[:, 1], rest[:, 2], *shares,
                     (stop[words.bounds[1:]] - stop[words.bounds[:-1]]) / many, np.log1p(rest[:, 3]), rest[:, 4]], axis=1)


def batch_features(texts: pa.Array) -> np.ndarray:
    rows = [text_features(words_of(data, offsets), data, offsets) for _, data, offsets in chunks(texts)]
    return np.concatenate(rows) if rows else np.zeros((0, len(FEATURES)))


@dataclass
class GamModel:
    intercept: float
    cuts: list[np.ndarray]            # bin edges of each feature
    tables: list[np.ndarray]          # a score for each bin
    coarse: list[np.ndarray]          # fewer edges, for pairs
    pairs: dict[tuple[int, int], np.ndarray]

    def logits(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.intercept)
        for f, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            out += table[np.searchsorted(cuts, rows[:, f], side="right")]
        for (f, g), table in self.pairs.items():
            out += table[np.searchsorted(self.coarse[f], rows[:, f], side="right"), np.searchsorted(self.coarse[g], rows[:, g], side="right")]
        return out

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(rows), -30, 30)))


def _step(grad: np.ndarray, hess: np.ndarray, leaves: int, least: float = 4.0) -> np.ndarray:
    """A shallow tree over ordered bins: the best cuts one after another, then
    a Newton step in each leaf."""
    edges = [0, len(grad)]
    g, h = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])
    worth = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)
    while len(edges) <= leaves:
        best = (1e-9, None)
        for a, b in zip(edges[:-1], edges[1:]):
            c = np.arange(a + 1, b)
            if len(c):
                gain = np.where(np.minimum(h[c] - h[a], h[b] - h[c]) * 4 >= least, worth(a, c) + worth(c, b) - worth(a, b), 0)
                k = int(np.argmax(gain))
                best = max(best, (float(gain[k]), int(c[k])), key=lambda x: x[0])
        if best[1] is None:
            break
        edges = sorted([*edges, best[1]])
    out = np.zeros(len(grad))
    for a, b in zip(edges[:-1], edges[1:]):
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1.0)
    return out


def fit(rows: np.ndarray, labels: np.ndarray, rounds: int = 150, rate: float = 0.15, n_pairs: int = 6) -> GamModel:
    """Cyclic boosting of the tables, then of the pair tables. No rows, or one
    class only, give a constant score."""
    share = (labels.sum() + 0.5) / (len(labels) + 1.0)
    edges = lambda x, k: np.unique(np.quantile(x, np.linspace(0, 1, k + 1)[1:-1])) if len(x) else np.zeros(0)
    cuts = [edges(x, BINS) for x in rows.T]
    coarse = [edges(x, PAIR_BINS) for x in rows.T]
    model = GamModel(float(np.log(share / (1 - share))), cuts, [np.zeros(len(c) + 1) for c in cuts], coarse, {})
    if len(np.unique(labels)) < 2:
        return model
    bins = [np.searchsorted(c, x, side="right") for c, x in zip(cuts, rows.T)]
    small = [np.searchsorted(c, x, side="right") for c, x in zip(coarse, rows.T)]
    logit = np.full(len(labels), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-logit))
        return labels - p, p * (1 - p)

    for _ in range(rounds):
        for f, b in enumerate(bins):
            g, h = slopes()
            k = len(model.tables[f])
            step = rate * _step(np.bincount(b, g, k), np.bincount(b, h, k), leaves=4)
            model.tables[f] += step
            logit += step[b]
    g, h = slopes()
    gains = []
    for f, q in combinations(range(rows.shape[1]), 2):
        shape = (len(coarse[f]) + 1, len(coarse[q]) + 1)
        cell = small[f] * shape[1] + small[q]
        sums, weights = np.bincount(cell, g, shape[0] * shape[1]), np.bincount(cell, h, shape[0] * shape[1])
        gains.append(((sums**2 / (weights + 1.0)).sum(), f, q, shape, cell))
    for _, f, q, shape, cell in sorted(gains, key=lambda x: -x[0])[:n_pairs]:
        model.pairs[f, q] = np.zeros(shape)
    chosen = {(f, q): (shape, cell) for _, f, q, shape, cell in gains if (f, q) in model.pairs}
    for _ in range(rounds // 5):
        for (f, q), (shape, cell) in chosen.items():
            g, h = slopes()
            step = rate * np.bincount(cell, g, shape[0] * shape[1]) / (np.bincount(cell, h, shape[0] * shape[1]) + 4.0)
            model.pairs[f, q] += step.reshape(shape)
            logit += step[cell]
    return model


def train_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
                  rows: int = TRAIN_ROWS) -> GamModel:
    """Fit on labelled documents outside the test fold (``rows`` of them at most)."""

    def run(batches):
        for batch in batches:
            x = batch_features(batch.column(1))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, batch.column(2)], ["doc_id", "x", "label"])

    known = training_texts(docs, labels, label, id_col, text_col, rows)
    kind = known.schema["doc_id"].dataType.simpleString()
    table = map_arrow(known, run, f"doc_id {kind}, x array<double>, label int").orderBy("doc_id").toArrow()
    x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
    return fit(x, table.column("label").to_numpy().astype(float))


def score_quality(docs: DataFrame, model: GamModel, id_col: str = "doc_id", text_col: str = "text", cut: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row of ``docs``.

    The score comes from the text alone. Null texts score as empty ones. Null
    and repeated ids are carried as they are; other columns are ignored; an
    empty table gives no rows.
    """

    def run(batches):
        for batch in batches:
            scores = model.scores(batch_features(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(scores)], ["doc_id", "held_out", "score"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), held_out(id_col).alias("held_out"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    out = map_arrow(narrow, run, f"doc_id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def keep_quality(docs: DataFrame, model: GamModel, text_col: str = "text", cut: float = 0.3) -> DataFrame:
    """The rows of ``docs``, unchanged, whose text scores at least ``cut``."""

    def run(batches):
        for batch in batches:
            scores = model.scores(batch_features(batch.column(batch.schema.get_field_index(text_col))))
            yield batch.filter(pa.array(scores >= cut))

    return map_arrow(docs, run, docs.schema)
