"""Token counts by heap-and-linked-list byte-pair merging.

A pre-token starts as a doubly linked list of byte symbols. A heap holds every
adjacent pair that has a merge rank; the lowest rank (leftmost first) is popped,
the two nodes become one, and the new neighbours are pushed. Stale heap entries
are recognised by their symbols. The number of tokens is the number of initial
symbols minus the number of merges, so no token ids are ever emitted.

Reads byte-level BPE files of the tokenizers library. Special strings inside a
text count as one token each, as in the library; nothing is added, truncated
or padded.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .tasks import map_arrow

#: Pre-tokens whose counts a Python worker remembers; it forgets all when full.
REMEMBERED = 1 << 19

#: Fixed value: the pre-token pattern of byte-level BPE.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary:
    printable Latin-1 stands for itself, the rest for code points from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(plain))
    return [out[b] for b in range(256)]


def count_symbols(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> int:
    """Symbols left after all merges. ``ranks``: pair -> (rank, merged symbol)."""
    n = len(symbols)
    symbols, after, before = list(symbols), [*range(1, n), -1], [*range(-1, n - 1)]
    heap = []
    for i in range(n - 1):
        if found := ranks.get((symbols[i], symbols[i + 1])):
            heap.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, left, right, joined = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != left or j < 0 or symbols[j] != right:
            continue
        symbols[i], symbols[j] = joined, -1
        after[i] = k = after[j]
        merges += 1
        if k >= 0:
            before[k] = i
            if found := ranks.get((joined, symbols[k])):
                heapq.heappush(heap, (found[0], i, joined, symbols[k], found[1]))
        h = before[i]
        if h >= 0 and (found := ranks.get((symbols[h], joined))):
            heapq.heappush(heap, (found[0], h, symbols[h], joined, found[1]))
    return n - merges


class TokenCounter:
    """Counts the tokens of texts as the library does for one tokenizer file."""

    def __init__(self, spec: dict):
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("only byte-level BPE without a normalizer or prefix space is read")
        vocab = model["vocab"]
        self.bytes = [vocab[c] for c in byte_symbols()]
        self.ranks = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        added = spec.get("added_tokens") or []
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens with lstrip, rstrip or single_word are not read")
        strings = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, strings))) if strings else None
        self.pieces = regex.compile(PRETOKEN).findall
        self.known: dict[str, int] = {}

    def _plain(self, text: str) -> int:
        pieces, known = self.pieces(text), self.known
        try:
            return sum(map(known.__getitem__, pieces))
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for piece in pieces:
                if piece not in known:
                    known[piece] = count_symbols([self.bytes[b] for b in piece.encode()], self.ranks)
            return sum(map(known.__getitem__, pieces))

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))


@lru_cache(maxsize=2)
def _counter(name: str) -> TokenCounter:
    with open(tokenizer_path(name), encoding="utf-8") as f:
        return TokenCounter(json.load(f))


def tokenizer_path(name: str) -> str:
    """A path as it is, or the place of a file of the installed public_tokenizers package."""
    if "/" in name:
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))


def count_tokens(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row for each row of ``docs``.

    ``tokenizer`` names a file of the installed package, or a path that every
    executor has. A null text counts as empty: 0 bytes and 0 tokens. Null and
    repeated ids are carried as they are; other columns are ignored; an empty
    table gives no rows. Texts are counted whole, however long.
    """

    def run(batches):
        counter = _counter(tokenizer)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = [counter.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                         F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("n_bytes"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    out = map_arrow(narrow, run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
