"""Vector bin packing of token sequences: every bin has a limit on tokens, on segments and on loss-bearing tokens at once.

A document is the ids of its prompt and text and one separator id; ids of the prompt bear no loss. Whole chunks of the bin
size go into bins of their own. The rests wait in a window of bounded size, and bins are filled one after another: among the
waiting rests that fit in all dimensions, the one with the greatest dot product of its demand with the room that is left
(both as shares of the limits) comes next. When nothing fits but tokens, loss and segments are left, the rest with the
greatest dot product is cut to fill the bin. The last bin of a task, which may stay part full, is cut into sequences whose
lengths are powers of two; those need no padding.

Tasks pack their own documents, so nothing is shuffled and nothing is stored: ids live only while their window is packed.

Edge cases: a NULL or empty text is the separator alone; repeated rows are packed each; a document longer than the window is
cut into full bins first; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .tokens import Encoder


@dataclass(frozen=True)
class Limits:
    """``window`` is the number of rests that wait at most before they are packed."""

    tokens: int = 1024
    segments: int = 256
    loss: int = 1024
    least_cut: int = 1
    window: int = 20_000


@dataclass
class Piece:
    """``length`` ids of document ``doc`` from ``start``; the first ``silent`` ids of the piece bear no loss."""

    doc: object
    start: int
    length: int
    silent: int = 0

    @property
    def loss(self) -> int:
        return self.length - self.silent

    def cut(self, length: int) -> tuple[Piece, Piece]:
        silent = min(self.silent, length)
        return (Piece(self.doc, self.start, length, silent),
                Piece(self.doc, self.start + length, self.length - length, self.silent - silent))


def fill(pieces: list[Piece], limits: Limits) -> Iterator[list[Piece]]:
    """Bins of the pieces, each of at most ``limits.tokens``; only the last can have room that a cut could have filled."""
    by_demand: dict[tuple[int, int], list[Piece]] = {}
    for piece in pieces:
        by_demand.setdefault((piece.length, piece.loss), []).append(piece)
    keys = list(by_demand)
    length, loss = (np.array([k[i] for k in keys], np.int64) for i in (0, 1))
    count = np.array([len(by_demand[k]) for k in keys], np.int64)
    left = int(count.sum())

    def put(piece: Piece) -> None:
        nonlocal keys, length, loss, count, left
        key = (piece.length, piece.loss)
        if key not in by_demand:
            by_demand[key] = []
            keys.append(key)
            length, loss, count = np.append(length, key[0]), np.append(loss, key[1]), np.append(count, 0)
        by_demand[key].append(piece)
        count[keys.index(key)] += 1
        left += 1

    while left:
        room, quiet, places, chosen = limits.tokens, limits.loss, limits.segments, []
        while left and room and places:
            # the demand in segments is the same for all pieces, so its term does not change the order
            worth = length * (room / limits.tokens**2) + loss * (quiet / max(limits.loss, 1)**2)
            able = (count > 0) & (length <= room) & (loss <= quiet)
            if able.any():
                at = int(np.argmax(np.where(able, worth, -1.0)))
                piece = by_demand[keys[at]].pop()
                count[at] -= 1
                left -= 1
            else:
                at = int(np.argmax(np.where(count > 0, worth, -1.0)))
                piece = by_demand[keys[at]][-1]
                take = min(room, piece.silent + quiet, piece.length)
                if chosen and take < limits.least_cut:
                    break
                by_demand[keys[at]].pop()
                count[at] -= 1
                left -= 1
                piece, rest = piece.cut(take)
                put(rest)
            chosen.append(piece)
            room, quiet, places = room - piece.length, quiet - piece.loss, places - 1
        yield chosen


def powers(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """The pieces of a part-full bin as sequences whose lengths are powers of two, longest first."""
    waiting = list(reversed(pieces))
    total = sum(p.length for p in pieces)
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        chosen = []
        while room:
            piece = waiting.pop()
            if piece.length > room:
                piece, rest = piece.cut(room)
                waiting.append(rest)
            chosen.append(piece)
            room -= piece.length
        yield chosen


def pack(docs: DataFrame, doc_id: str, text: str, path: str, pattern: str, separator: int = 0, prompt: str | None = None,
         special: dict[str, int] | None = None, limits: Limits = Limits()) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, loss_tokens, ids (little-endian uint32).

    ``prompt`` names a column whose tokens bear no loss; without it every token does. Sequence numbers are unique and depend
    on how the input is split, as a task numbers its own sequences. ``loss`` must be at least 1.
    """
    if limits.loss < 1 or limits.tokens < 1 or limits.segments < 1:
        raise ValueError("limits must be positive")
    columns = [F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
               F.col(prompt).alias("prompt") if prompt else F.lit(None).cast("string").alias("prompt")]
    schema = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
              "loss_tokens long, ids binary")
    kinds = [pa.int64()] * 7 + [pa.binary()]
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, pattern, special)
        width = encoder.dtype.itemsize
        end = np.array([separator], encoder.dtype).tobytes()
        sequence = TaskContext.get().partitionId() << 33
        ids: dict[int, tuple[int | None, bytes, int]] = {}  # row: doc id, ids from the first waiting one on, number of all ids
        skipped: dict[int, int] = {}
        rests: list[Piece] = []
        rows: list[tuple] = []
        number = 0

        def emit(pieces: list[Piece]) -> None:
            nonlocal sequence
            offset = 0
            for p in pieces:
                doc, data, total = ids[p.doc]
                at = p.start - skipped[p.doc]
                wide = np.frombuffer(data[at * width:(at + p.length) * width], encoder.dtype).astype("<u4").tobytes()
                rows.append((doc, p.start, p.length, total, sequence, offset, p.loss, wide))
                offset += p.length
            sequence += 1

        def flush(last: bool) -> None:
            nonlocal rests
            bins = list(fill(rests, limits))
            rests = []
            for i, pieces in enumerate(bins):
                full = sum(p.length for p in pieces) == limits.tokens
                if full or i < len(bins) - 1:
                    emit(pieces)
                elif last:
                    for part in powers(pieces):
                        emit(part)
                else:  # waits for more documents
                    rests = pieces
            used = {p.doc for p in rests}
            for key in [k for k in ids if k not in used]:
                del ids[key], skipped[key]

        def batch_of() -> pa.RecordBatch:
            nonlocal rows
            values, rows = list(zip(*rows, strict=True)), []
            return pa.RecordBatch.from_arrays([pa.array(v, type=k) for v, k in zip(values, kinds, strict=True)], names=names)

        for batch in batches:
            for doc, value, lead in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                silent_ids = encoder.encode(lead or "")
                data = silent_ids + encoder.encode(value or "") + end
                total, silent, number = len(data) // width, len(silent_ids) // width, number + 1
                whole = Piece(number, 0, total, silent)
                ids[number], skipped[number] = (doc, data, total), 0
                while whole.length >= limits.tokens and limits.loss >= limits.tokens:
                    chunk, whole = whole.cut(limits.tokens)
                    emit([chunk])
                if whole.length:  # only what waits stays in memory
                    ids[number], skipped[number] = (doc, data[whole.start * width:], total), whole.start
                    rests.append(whole)
                else:
                    del ids[number], skipped[number]
                if len(rests) >= limits.window:
                    flush(False)
                if len(rows) >= 4096:
                    yield batch_of()
        flush(True)
        if rows:
            yield batch_of()

    return docs.select(*columns).mapInArrow(run, schema)


ship(__name__)
