"""Fill-in-middle transformation by displacement scatter.

A text is cut at two code points into prefix, middle and suffix, which leave in
another order behind three markers. Nothing is sliced or joined row by row: all
texts of a chunk lie in one byte buffer, and every byte only needs to know how
far it moves.

1. *Scan cuts.* The bytes that begin a code point turn the cuts, which count
   code points, into byte positions.
2. *Difference array.* A part's shift, less the shift of the part before it, is
   added where the part begins. The cumulative sum is the shift of every byte.
3. *Scatter.* ``out[i + shift[i]] = data[i]`` writes all outputs of the chunk at
   once; the markers are scattered into the gaps.
4. *Inverse gather.* To restore, the markers are found in the outputs again and
   give the same shifts; ``data[i] = out[i + shift[i]]``.

Chunks hold a bounded number of bytes (one text at least).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tasks import map_arrow
from .wordhash import chunks

CHUNK_BYTES = 1 << 20
PLAIN, PSM, SPM = 0, 1, 2
FORMS = np.array(["plain", "psm", "spm"])


@dataclass(frozen=True)
class Markers:
    """The strings in front of prefix, suffix and middle. Their first characters
    may stand nowhere else in them, so no marker can arise at a joint."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        if "" in self.all or len(set(self.all)) < 3 or any(m[0] in n[1:] for m in self.all for n in self.all):
            raise ValueError("markers must differ, and their first characters may stand nowhere else in them")

    @property
    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle

    @property
    def bytes(self) -> list[np.ndarray]:
        return [np.frombuffer(m.encode(), np.uint8) for m in self.all]


def _layout(form: np.ndarray, p: np.ndarray, m: np.ndarray, s: np.ndarray, sizes: tuple[int, int, int]):
    """Where prefix, middle and suffix (of p, m and s bytes) begin in the output,
    from its first byte; the parts of a plain text keep their places."""
    mp, ms, mm = sizes
    psm, spm = form == PSM, form == SPM
    prefix = np.where(psm, mp, np.where(spm, ms + s + mp, 0))
    suffix = np.where(psm, mp + p + ms, np.where(spm, ms, p + m))
    middle = np.where(form == PLAIN, p, mp + ms + mm + p + s)
    return prefix, middle, suffix


def _shifts(begin: np.ndarray, p: np.ndarray, m: np.ndarray, to: list[np.ndarray], total: int) -> np.ndarray:
    """The shift of each of ``total`` text bytes: ``begin`` is where each text
    begins, ``to`` where its prefix, middle and suffix begin in the output."""
    at = np.stack([begin, begin + p, begin + p + m], axis=1).ravel()
    shift = np.stack(to, axis=1).ravel() - at
    steps = np.diff(shift, prepend=0)
    difference = np.zeros(total + 1, np.int64)
    np.add.at(difference, at, steps)
    return np.cumsum(difference[:-1])


def scatter(data: np.ndarray, offsets: np.ndarray, form: np.ndarray, p: np.ndarray, m: np.ndarray, markers: Markers):
    """(bytes, offsets) of all outputs of a chunk; ``p`` and ``m`` are in bytes."""
    signs = markers.bytes
    sizes = tuple(len(x) for x in signs)
    moved = form != PLAIN
    out_offsets = np.concatenate([[0], np.cumsum(np.diff(offsets) + sum(sizes) * moved)])
    begin, first = offsets[:-1], out_offsets[:-1]
    to = [first + x for x in _layout(form, p, m, np.diff(offsets) - p - m, sizes)]
    out = np.empty(int(out_offsets[-1]), np.uint8)
    out[np.arange(len(data)) + _shifts(begin, p, m, to, len(data))] = data
    for sign, part in zip(signs, (to[0], to[2], to[1])):
        places = (part[moved] - len(sign))[:, None] + np.arange(len(sign))
        out[places] = sign
    return out, out_offsets


def _find(out: np.ndarray, offsets: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """The first place of ``sign`` in each text, from the buffer's first byte; -1 without one."""
    n, k = len(out), len(sign)
    found = np.full(len(offsets) - 1, -1, np.int64)
    if n < k:
        return found
    hits = np.flatnonzero(out[: n - k + 1] == sign[0])
    for j in range(1, k):
        hits = hits[out[hits + j] == sign[j]]
    row = np.searchsorted(offsets, hits, side="right") - 1
    inside = hits + k <= offsets[row + 1]
    rows, first = np.unique(row[inside], return_index=True)
    found[rows] = hits[inside][first]
    return found


def gather(out: np.ndarray, offsets: np.ndarray, form: np.ndarray, markers: Markers):
    """(bytes, offsets) of the texts that gave these outputs, from outputs and forms alone."""
    signs = markers.bytes
    sizes = tuple(len(x) for x in signs)
    moved, size, first = form != PLAIN, np.diff(offsets), offsets[:-1]
    at_p, at_s, at_m = (np.where(moved, _find(out, offsets, x), 0) for x in signs)
    order = np.where(form == PSM, (at_p == first) & (at_p < at_s) & (at_s < at_m), (at_s == first) & (at_s < at_p) & (at_p < at_m))
    if not (order | ~moved).all():
        raise ValueError("an output does not hold its markers in the order of its form")
    end = offsets[1:]
    p = np.where(form == PSM, at_s - at_p - sizes[0], np.where(form == SPM, at_m - at_p - sizes[0], size))
    m = np.where(moved, end - at_m - sizes[2], 0)
    s = np.where(moved, size - sum(sizes) - p - m, 0)
    text_offsets = np.concatenate([[0], np.cumsum(p + m + s)])
    to = [first + x for x in _layout(form, p, m, s, sizes)]
    total = int(text_offsets[-1])
    return out[np.arange(total) + _shifts(text_offsets[:-1], p, m, to, total)], text_offsets


def code_point_bytes(data: np.ndarray, offsets: np.ndarray):
    """The byte position of every code point of a chunk, and where each text's begin in that list."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    return np.append(starts, len(data)), np.searchsorted(starts, offsets)


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    parts = pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, *parts).cast(pa.string())


def fill_in_middle(docs: DataFrame, markers: Markers = Markers(), seed: int = 1, plain_percent: int = 10, spm_percent: int = 20,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output), one row for each row of ``docs``.

    Four 32-bit numbers come from the SHA-256 of ``seed:id``. The first two, modulo
    n + 1 code points, are the cuts. The text stays ``plain`` if it is empty, holds
    a marker, or the third number modulo 100 falls into the last ``plain_percent``;
    else the fourth modulo 100 makes it ``spm`` below ``spm_percent``, ``psm`` from there.

    A null text counts as empty; a null id is hashed as the empty string, so all
    rows without an id draw the same numbers, as do rows that repeat an id. Other
    columns are ignored, whatever their names. An empty table gives no rows. Texts
    are handled whole, however long.
    """

    def run(batches):
        for batch in batches:
            for first, data, offsets in chunks(batch.column(1), CHUNK_BYTES):
                rows = len(offsets) - 1
                draws = np.frombuffer(bytes.fromhex("".join(batch.column(2).slice(first, rows).to_pylist())), ">u4").reshape(rows, 4)
                draws = draws.astype(np.int64)
                marked = batch.column(3).slice(first, rows).to_numpy(zero_copy_only=False)
                starts, begins = code_point_bytes(data, offsets)
                n = np.diff(begins)
                plain = (n == 0) | marked | (draws[:, 2] % 100 >= 100 - plain_percent)
                form = np.where(plain, PLAIN, np.where(draws[:, 3] % 100 < spm_percent, SPM, PSM))
                one, two = draws[:, 0] % (n + 1), draws[:, 1] % (n + 1)
                low, high = np.where(plain, n, np.minimum(one, two)), np.where(plain, n, np.maximum(one, two))
                edge = lambda c: np.where(c == n, offsets[1:], starts[begins[:-1] + np.minimum(c, np.maximum(n - 1, 0))])  # noqa: E731,B023
                p = edge(low) - offsets[:-1]
                m = edge(high) - offsets[:-1] - p
                out, out_offsets = scatter(data, offsets, form, p, m, markers)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, rows), pa.array(n, pa.int64()), pa.array(FORMS[form]), pa.array(low, pa.int64(), mask=plain),
                     pa.array(high - low, pa.int64(), mask=plain), _strings(out, out_offsets)],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    has = F.contains(text, F.lit(markers.prefix)) | F.contains(text, F.lit(markers.suffix)) | F.contains(text, F.lit(markers.middle))
    narrow = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"),
                         F.substr(F.sha2(F.concat(F.lit(f"{seed}:"), own), 256), F.lit(1), F.lit(32)).alias("draws"), has.alias("marked"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return map_arrow(narrow, run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restore_texts(outputs: DataFrame, markers: Markers = Markers(), output_col: str = "output", form_col: str = "form",
                  into: str = "restored") -> DataFrame:
    """``outputs`` with the texts that gave them as column ``into``.

    Reads outputs and forms alone. A null output stands for an empty plain text;
    an output whose markers do not fit its form fails the job. The column ``into``
    must not be there yet. An empty table gives no rows.
    """
    if into in outputs.columns:
        raise ValueError(f"the table already has a column {into}")

    def run(batches):
        for batch in batches:
            of = batch.schema.get_field_index
            for first, data, offsets in chunks(batch.column(of(output_col)), CHUNK_BYTES):
                part = batch.slice(first, len(offsets) - 1)
                names = np.array([f or "plain" for f in part.column(of(form_col)).to_pylist()], dtype=object)
                form = np.select([names == "plain", names == "psm", names == "spm"], [PLAIN, PSM, SPM], -1)
                if (form < 0).any():
                    raise ValueError(f"unknown form {names[form < 0][0]!r}")
                text, text_offsets = gather(data, offsets, form, markers)
                yield pa.RecordBatch.from_arrays([*part.columns, _strings(text, text_offsets)], [*part.schema.names, into])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outputs.schema.fields)
    return map_arrow(outputs, run, f"{fields}, `{into}` string")
