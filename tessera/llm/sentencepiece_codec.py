"""SentencePiece encoding and decoding on the tokenizers library.

The model protobuf is parsed here (pieces, scores, types, and the trainer and
normaliser settings) and rebuilt as a tokenizers pipeline:

* normaliser: the model's compiled character map if it has one, collapsing of
  repeated spaces if the model asks for it, then the metaspace marker for
  spaces and for the dummy prefix;
* model: Unigram with the pieces' scores, or BPE whose merges are all splits
  of a piece into two pieces, ranked by the piece's score;
* byte fallback for characters without a piece.

Batches are encoded by the library's thread pool. Decoding joins each piece's
bytes, so byte pieces need no second pass. ``verify_parity`` compares with the
sentencepiece library.
"""

from __future__ import annotations

import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bpe_count import tokenizer_path
from .tasks import map_arrow
from .wordhash import chunks

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
#: Texts on which every worker compares both libraries before it encodes.
PROBES = ["", " ", "a", "  two  spaces ", "line\nbreak\ttab", "Größe, niño, été!", "漢字 \U0001f600 \u0000 x", "3.14 <s> </s> <unk>"]


def _fields(data: bytes):
    """(number, value) of one protobuf message; length-delimited values as bytes."""
    at, end = 0, len(data)

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < end:
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, data[at : at + size]
            at += size


def parse_model(data: bytes) -> dict:
    """Pieces as (text, score, type), and the settings that encoding needs."""
    model = {"pieces": [], "type": 1, "byte_fallback": False, "charsmap": b"", "dummy_prefix": True,
             "collapse": True, "escape": True, "suffix": False}
    for number, value in _fields(data):
        if number == 1:
            piece = {1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(_fields(value))
            model["pieces"].append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
        elif number == 2:
            spec = dict(_fields(value))
            model |= {"type": spec.get(3, 1), "byte_fallback": bool(spec.get(35, 0)), "suffix": bool(spec.get(24, 0))}
        elif number == 3:
            spec = dict(_fields(value))
            model |= {"charsmap": spec.get(2, b""), "dummy_prefix": bool(spec.get(3, 1)), "collapse": bool(spec.get(4, 1)),
                      "escape": bool(spec.get(5, 1))}
    return model


def build_tokenizer(model: dict):
    """The tokenizers pipeline of a parsed model (types Unigram 1 and BPE 2)."""
    from tokenizers import Regex, Tokenizer, models, normalizers

    if model["suffix"] or not model["escape"]:
        raise ValueError("models with white space as suffix or without escapes are not read")
    pieces = model["pieces"]
    vocab = {p: i for i, (p, _, _) in enumerate(pieces)}
    unknown = next(i for i, (_, _, kind) in enumerate(pieces) if kind == UNKNOWN)
    if model["type"] == 1:
        body = models.Unigram([(p, s) for p, s, _ in pieces], unknown, model["byte_fallback"])
    elif model["type"] == 2:
        whole = {p for p, _, kind in pieces if kind in (NORMAL, USER)}
        merges = []
        for p, score, kind in pieces:
            if kind in (NORMAL, USER):
                splits = [(p[:k], p[k:]) for k in range(1, len(p)) if p[:k] in whole and p[k:] in whole]
                merges += [(-score, vocab[a], vocab[b], a, b) for a, b in splits]
        merges.sort(key=lambda m: m[0])
        body = models.BPE(vocab=vocab, merges=[m[3:] for m in merges], unk_token=pieces[unknown][0], fuse_unk=True,
                          byte_fallback=model["byte_fallback"])
    else:
        raise ValueError(f"model type {model['type']} is not read")
    steps = [normalizers.Precompiled(model["charsmap"])] if model["charsmap"] else []
    if model["collapse"]:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model["dummy_prefix"]:
        steps.append(normalizers.Prepend(SPACE))
    steps.append(normalizers.Replace(" ", SPACE))
    out = Tokenizer(body)
    out.normalizer = normalizers.Sequence(steps)
    return out


class Codec:
    """Encodes and decodes with one model file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.model = parse_model(f.read())
        self.tokenizer = build_tokenizer(self.model)
        self.bytes = []
        for piece, _, kind in self.model["pieces"]:
            if kind == BYTE:
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif kind == CONTROL:
                self.bytes.append(b"")
            else:
                self.bytes.append((" ⁇ " if kind == UNKNOWN else piece.replace(SPACE, " ")).encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.bytes.__getitem__, ids))
        if self.model["dummy_prefix"] and raw.startswith(b" "):
            raw = raw[1:]
        return raw.decode("utf-8", errors="replace")


def verify_parity(path: str, texts: list[str]) -> list[int]:
    """Positions of the texts on which the sentencepiece library gives other ids or another decoding."""
    import sentencepiece

    codec, other = _codec(path), sentencepiece.SentencePieceProcessor(model_file=path)
    ours = codec.encode(texts)
    return [i for i, (t, ids) in enumerate(zip(texts, ours))
            if ids != other.encode(t) or codec.decode(ids) != other.decode(ids)]


@lru_cache(maxsize=2)
def _codec(path: str) -> Codec:
    return Codec(path)


@lru_cache(maxsize=2)
def _checked(path: str) -> Codec:
    if bad := verify_parity(path, PROBES):
        raise ValueError(f"the rebuilt tokenizer differs from the sentencepiece library on {[PROBES[i] for i in bad]}")
    return _codec(path)


def encode_documents(docs: DataFrame, tokenizer: str = "piece_bpe_32k.model", id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(doc_id, ids, n_tokens, round_trip), one row for each row of ``docs``.

    ``round_trip``: decoding the ids gives the text again (models that normalise
    texts can be false here). A null text counts as empty: no ids. Null and
    repeated ids are carried as they are; other columns are ignored; an empty
    table gives no rows. Texts are encoded whole. ``tokenizer`` names a file of
    the installed package, or a path that every executor has. A worker holds the
    tokens of a few hundred thousand bytes of text (one text at least) at a time.
    """

    def run(batches):
        codec = _checked(tokenizer_path(tokenizer))
        for batch in batches:
            for first, _, bounds in chunks(batch.column(1)):
                some = [t or "" for t in batch.column(1).slice(first, len(bounds) - 1).to_pylist()]
                ids = codec.encode(some)
                same = [codec.decode(x) == t for x, t in zip(ids, some)]
                sizes = np.array([len(x) for x in ids], dtype=np.int64)
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                flat = np.concatenate([np.array(x, dtype=np.int32) for x in ids])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(some)), pa.ListArray.from_arrays(offsets, pa.array(flat)),
                     pa.array(sizes), pa.array(same)], ["doc_id", "ids", "n_tokens", "round_trip"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return map_arrow(narrow, run, f"doc_id {kind}, ids array<int>, n_tokens long, round_trip boolean")


def decode_documents(encoded: DataFrame, tokenizer: str = "piece_bpe_32k.model", id_col: str = "doc_id",
                     ids_col: str = "ids") -> DataFrame:
    """(doc_id, text): the text of each row's ids. Null ids give an empty text;
    a null inside the ids is skipped; an id outside the model fails the job."""

    def run(batches):
        codec = _checked(tokenizer_path(tokenizer))
        for batch in batches:
            texts = [codec.decode([i for i in x or [] if i is not None]) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    narrow = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return map_arrow(narrow, run, f"doc_id {kind}, text string")
