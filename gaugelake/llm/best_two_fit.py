"""Best-two-fit packing of token sequences: as few bins as possible, only what is longer than a bin is cut.

A bin is filled greedily, always with the longest piece that fits. When nothing fits any more, its smallest piece is taken out if
two pieces that are not packed yet fit the gap this makes more tightly (together longer than the piece, at most the gap;
the longest such pair is taken). That is repeated while it gains.

Pieces of one length are interchangeable, so this needs only how many pieces there are of each length: at most ``capacity``
numbers, however large the input. The driver works the bins out from these counts. The same contents come
again and again, so each step finds one pattern and how often it may be repeated before a length runs short: bins made one by one
would all be the same until then. Every length runs short of what a pattern needs at most as many times as it fits a bin, so there are
at most capacity * (1 + ln capacity) patterns, some 38,000 for 4,096. Spark numbers the pieces of each length (in blocks
drawn from their content, so no length falls to one task), and the number says which bin and place a piece has: nothing is moved
but a row of numbers per piece. The result is the same on every run and for every cut of the input, up to pieces that are equal in all
columns.

Defined cases: a null or empty text is its end id alone; repeated rows are packed like any others; a null doc_id is kept;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugelake.llm.encoding import encoder, public_path
from gaugelake.llm.shared import Scratch, documents, text_batches

TOKENIZER = "word_bpe_49k.json"
END_ID = 1  # fixed: appended to each document
CAPACITY = 4096
BLOCK_ROWS = 250_000  # pieces that are numbered together


class Pattern(NamedTuple):
    lengths: tuple[int, ...]  # of the pieces of a bin, in the order of their places
    times: int


def _fill(left: np.ndarray, capacity: int) -> tuple[Counter, Counter]:
    """The pieces of the next bin, and the most of each length that it held on the way; ``left[n]`` pieces have length n."""
    held, most = Counter(), Counter()

    def longest(room: int, avoid: Counter) -> int:
        """The longest length up to ``room`` of which a piece is left, 0 if none."""
        while room > 0:
            places = np.flatnonzero(left[1: room + 1])
            if not len(places):
                return 0
            length = int(places[-1]) + 1
            if left[length] > avoid[length]:
                return length
            room = length - 1
        return 0

    gap = capacity
    while gap:
        length = longest(gap, held)
        if not length:
            break
        taken = min(int(left[length]) - held[length], gap // length)
        held[length] += taken
        gap -= taken * length
    most |= held
    while gap and held:
        smallest = min(held)
        pair = _best_pair(left, held, smallest, smallest + gap)
        if pair is None:
            break
        held[smallest] -= 1
        held += Counter()  # drops those at 0
        held.update(pair)
        gap += smallest - sum(pair)
        most |= held
    return held, most


def _best_pair(left: np.ndarray, held: Counter, more_than: int, room: int) -> tuple[int, int] | None:
    """Two pieces left whose lengths add up to the most, more than ``more_than`` and at most ``room``."""
    free = left[: room + 1].copy()
    for length, n in held.items():
        if length <= room:
            free[length] -= n
    first = np.flatnonzero(free)
    if not len(first):
        return None
    # for each length the longest one up to it that is free, leaving out the length itself where only one is
    upto = np.maximum.accumulate(np.where(free > 0, np.arange(room + 1), 0))
    second = upto[room - first]
    alone = (second == first) & (free[first] < 2)
    second[alone] = upto[first[alone] - 1]
    total = np.where(second > 0, first + second, 0)
    best = int(total.argmax())
    if total[best] <= more_than:
        return None
    return int(first[best]), int(second[best])


def best_two_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """The contents of all bins for so many pieces of each length."""
    if any(not 0 < length <= capacity for length in counts):
        raise ValueError("a piece is empty or longer than a bin")
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    patterns = []
    while left.any():
        held, most = _fill(left, capacity)
        # the same choices come again while what a bin held on the way is still left
        times = min((int(left[n]) - most[n]) // held[n] + 1 for n in held)
        for n, k in held.items():
            left[n] -= k * times
        patterns.append(Pattern(tuple(sorted(held.elements(), reverse=True)), times))
    return patterns


class Places:
    """Which bin and place the r-th piece of a length has, as sorted arrays: a few numbers per pattern and length."""

    def __init__(self, patterns: list[Pattern]):
        entries, used, bins = [], Counter(), 0
        for lengths, times in patterns:
            at = 0
            for n, k in Counter(lengths).items():
                entries.append((n, used[n], bins, k, at))
                used[n] += k * times
                at += n * k
            bins += times
        self.bins = bins
        table = np.array(sorted(entries), np.int64).reshape(-1, 5)
        self.length, self.first, self.bin, self.each, self.at = table.T.copy()

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bin and the place in it of pieces of these lengths and ranks."""
        bins, at = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        order = np.argsort(lengths, kind="stable")
        cuts = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            rows = order[lo:hi]
            n = int(lengths[rows[0]])
            a, b = np.searchsorted(self.length, [n, n + 1])
            entry = a + np.searchsorted(self.first[a:b], ranks[rows], side="right") - 1
            number, slot = np.divmod(ranks[rows] - self.first[entry], self.each[entry])
            bins[rows] = self.bin[entry] + number
            at[rows] = self.at[entry] + slot * n
        return bins, at


def token_pieces(docs: DataFrame, path: str, kind: str = "word", end_id: int = END_ID, capacity: int = CAPACITY,
                 with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length and checksum of the pieces of every text, with their ids if wanted.

    Only documents longer than ``capacity`` are cut, into pieces of that length and a last one.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, kind)
        for whole in batches:
            for batch in text_batches(whole, "text"):
                rows = []
                for doc_id, found in zip(batch.column("doc_id").to_pylist(), own.encode_all(batch.column("text")), strict=True):
                    ids = np.append(found, np.uint32(end_id)).astype("<u4")
                    for number, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start: start + capacity]
                        rows.append((doc_id, number, start, len(part), zlib.crc32(part), part.astype(np.int32)))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t, _ in zip(columns, types, names, strict=False)], names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(pieces, schema)


def _ranked(pieces: DataFrame, order: list[str], counts: dict[int, int]) -> DataFrame:
    """Number the pieces of each length from 0 in the column ``_rank``."""
    blocks = max(1, -(-sum(counts.values()) // BLOCK_ROWS))
    rows = pieces.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)))
    sizes = rows.groupBy("_block", "length").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_block", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_block", "length").orderBy(*order)
    return (rows.withColumn("_row", F.row_number().over(within)).join(starts, ["_block", "length"])
            .withColumn("_rank", F.col("_start") + F.col("_row") - 1).select(*pieces.columns, "_rank"))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``pieces`` with sequence_id and offset; ``length`` (from 1 to ``capacity``) is what a row takes of a bin.

    ``pieces`` must give the same rows each time it is read (pass a written table).
    """
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    pieces = pieces.select(*columns)
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = Places(best_two_fit(counts, capacity))
    order = [c for c in columns if not pieces.schema[c].dataType.simpleString().startswith("map")]
    ranked = _ranked(pieces, order, counts)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank")]
            bins, at = places.find(*numbers)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], pa.array(bins), pa.array(at)], [*columns, "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in columns)
    return ranked.mapInArrow(assign, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and the ids of each sequence, from packed pieces that carry their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("_parts")).select(
        "sequence_id", F.flatten("_parts.ids").alias("ids"), F.col("_parts.doc_id").alias("doc_ids"),
        F.col("_parts.offset").alias("offsets"))


def op12_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "best-two-fit")
    pieces = scratch.save(token_pieces(documents(spark, sf_dir), public_path(TOKENIZER)), "pieces")
    return pack(pieces)
