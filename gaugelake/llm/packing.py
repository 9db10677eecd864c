"""Vector bin packing of token sequences under limits on tokens, segments and loss-bearing tokens.

A bin (sequence) has three capacities at once. It takes, again and again, the example whose demands have the largest
dot product with what is left of the bin (both in shares of the capacities) among those that fit in all
three. When none fits as a whole and examples may be cut, the example that fills the most is cut to
what is left. Full sequences are cut off long examples first.

Bins are filled from a window of WINDOW examples that is topped up while a task reads its part of the table, so
memory is bounded, nothing but texts is read and nothing is shuffled; the last, partial sequence of a task is
cut into powers of two, which need no padding. A piece is never in two sequences, and every token is in one piece.
Which examples meet depends on how Spark cuts the input, not on the order in which tasks run: a repeated task
gives the same pieces and ids.

Defined cases: a null or empty text is its end id alone; repeated rows are packed like any others; a null
doc_id is kept; an empty table gives no rows; extra columns are ignored. An example's loss-bearing tokens are
spread over its pieces from the end, as answers follow prompts; in the query every token bears loss.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from gaugelake.llm.encoding import encoder, public_path
from gaugelake.llm.shared import documents, text_batches

TOKENIZER = "byte_bpe_50k.json"
END_ID = 1  # fixed: appended to each document
WINDOW = 256
SEQUENCES_PER_TASK = 1 << 40


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 512
    loss: int = 2048


@dataclass
class Example:
    """What is left to place of an example: ``start`` to ``end`` of its ids, the last ``loss`` of them bear loss."""

    doc_id: int | None
    ids: np.ndarray
    start: int
    end: int
    loss: int


Piece = tuple[int | None, int, int, int, int, int, int]  # the columns of the result


class Packer:
    def __init__(self, limits: Limits, first_sequence: int = 0, cut: bool = True):
        self.limits, self.cut, self.sequence = limits, cut, first_sequence
        self.waiting: list[Example] = []
        self.open: list[tuple[Example, int, int]] = []  # example, start, length
        self.left = self._capacity()

    def _capacity(self) -> list[int]:
        return [self.limits.tokens, self.limits.segments, self.limits.loss]

    def add(self, example: Example) -> Iterator[Piece]:
        """Take an example; gives the pieces of the sequences this completes."""
        if not self.cut and (example.end - example.start > self.limits.tokens or example.loss > self.limits.loss):
            raise ValueError(f"example of document {example.doc_id} exceeds a sequence")
        size = self.limits.tokens
        while self.cut and example.end - example.start >= size and min(example.loss, size) <= self.limits.loss:
            yield self._piece(example, example.start, size, 0)
            self.sequence += 1
            example.start += size
            example.loss = min(example.loss, example.end - example.start)
        if example.end > example.start:
            self.waiting.append(example)
        if len(self.waiting) >= WINDOW:
            yield from self._fill(WINDOW // 2)

    def finish(self) -> Iterator[Piece]:
        yield from self._fill(0)
        if self.open and self.cut:
            yield from self._powers_of_two()
        elif self.open:
            yield from self._close()

    def _fill(self, keep: int) -> Iterator[Piece]:
        """Place examples until at most ``keep`` wait."""
        capacity = np.array(self._capacity(), float)
        demand = np.array([self._demand(e) for e in self.waiting], float).reshape(-1, 3)
        alive = np.ones(len(self.waiting), bool)
        n = len(self.waiting)
        while n > keep:
            left = np.array(self.left, float)
            fits = alive & (demand <= left).all(axis=1)
            if fits.any():
                score = np.where(fits, (demand / capacity) @ (left / capacity), -1.0)
                i = int(score.argmax())
                self._place(self.waiting[i], self.waiting[i].end - self.waiting[i].start)
                alive[i] = False
                n -= 1
            else:
                length = 0
                if self.cut and self.left[0] and self.left[1] and self.left[2]:
                    i = int(np.where(alive, demand[:, 0], -1).argmax())
                    length = min(self._most(self.waiting[i]), self.waiting[i].end - self.waiting[i].start)
                if length:
                    self._place(self.waiting[i], length)
                    if self.waiting[i].end == self.waiting[i].start:
                        alive[i] = False
                        n -= 1
                    else:
                        demand[i] = self._demand(self.waiting[i])
                if not length or not self.left[0] or not self.left[1]:
                    yield from self._close()
            if not self.left[0]:
                yield from self._close()
        self.waiting = [e for e, a in zip(self.waiting, alive, strict=True) if a]

    @staticmethod
    def _demand(e: Example) -> tuple[int, int, int]:
        return e.end - e.start, 1, e.loss

    def _most(self, e: Example) -> int:
        """The longest head of an example that fits what is left of the open sequence."""
        free = e.end - e.start - e.loss  # ids before the first that bears loss
        return min(self.left[0], free + self.left[2])

    def _place(self, e: Example, length: int) -> None:
        bears = max(0, e.loss - (e.end - e.start - length))
        self.open.append((e, e.start, length))
        self.left[0] -= length
        self.left[1] -= 1
        self.left[2] -= bears
        e.start += length
        e.loss -= bears

    def _piece(self, e: Example, start: int, length: int, offset: int) -> Piece:
        crc = zlib.crc32(np.ascontiguousarray(e.ids[start: start + length], "<u4"))
        return e.doc_id, start, length, crc, len(e.ids), self.sequence, offset

    def _close(self) -> Iterator[Piece]:
        offset = 0
        for e, start, length in self.open:
            yield self._piece(e, start, length, offset)
            offset += length
        if self.open:
            self.sequence += 1
        self.open, self.left = [], self._capacity()

    def _powers_of_two(self) -> Iterator[Piece]:
        """The open sequence as sequences of the powers of two that add up to its length."""
        held, total = self.open, sum(length for *_, length in self.open)
        while total:
            size = 1 << (total.bit_length() - 1)
            total -= size
            part = []
            while size:
                e, start, length = held[0]
                take = min(size, length)
                part.append((e, start, take))
                held = held[1:] if take == length else [(e, start + take, length - take), *held[1:]]
                size -= take
            self.open = part
            yield from self._close()


SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def _batch(pieces: list[Piece]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in zip(*pieces, strict=True)], COLUMNS)


def pack_documents(docs: DataFrame, path: str, kind: str = "byte", end_id: int = END_ID,
                   limits: Limits = Limits(), forget: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    With ``forget`` a worker keeps no words once its task is done, for jobs whose other stages need the memory.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, kind)
        packer = Packer(limits, TaskContext.get().partitionId() * SEQUENCES_PER_TASK)
        done: list[Piece] = []
        for whole in batches:
            for batch in text_batches(whole, "text"):
                for doc_id, found in zip(batch.column("doc_id").to_pylist(), own.encode_all(batch.column("text")), strict=True):
                    ids = np.append(found, np.uint32(end_id))
                    done += packer.add(Example(doc_id, ids, 0, len(ids), len(ids)))
                if done:
                    yield _batch(done)
                    done = []
        done += packer.finish()
        if done:
            yield _batch(done)
        if forget:
            own.forget()

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def op9_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_path(TOKENIZER))
