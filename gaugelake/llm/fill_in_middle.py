"""Fill-in-the-middle transformation of whole texts by displacement scatter, and its inverse.

A text is cut into prefix, middle and suffix at two places drawn from a digest of its id, and written as

    plain  the text
    psm    <P> prefix <S> suffix <M> middle
    spm    <S> suffix <P> prefix <M> middle

A batch of texts is one array of bytes. The cuts are found by scanning it for the first bytes of code points. At the first byte of
each part an array of differences holds by how much the part moves more than the one before; its cumulative
sum is the shift of every byte, and one numpy scatter writes the output of the whole batch. The way back looks for the marks in the
output, sums up the differences in the same way and gathers. Both go through a batch in windows of WINDOW bytes, so that the work
space does not grow with a text.

A text that holds a mark stays plain, and no mark may begin as another one ends, so the marks found in an output are the
three that were written.

Defined cases: a null text counts as empty, an empty text is plain; a null doc_id is drawn from the digest of the seed and the colon alone;
repeated rows give repeated results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugelake.llm.shared import documents, text_batches

WINDOW = 1 << 20

FORMS = ["plain", "psm", "spm"]
PLAIN, PSM, SPM = range(3)


@dataclass(frozen=True)
class Marks:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = self.as_bytes()
        for i, a in enumerate(marks):
            for j, b in enumerate(marks):
                if not a or (i != j and a in b) or any(a.endswith(b[:n]) for n in range(1, min(len(a), len(b)))):
                    raise ValueError(f"marks {a!r} and {b!r} can't be told apart in every text")

    def as_bytes(self) -> list[bytes]:
        return [self.prefix.encode(), self.suffix.encode(), self.middle.encode()]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings of a column, null as empty, and the bounds of each."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return data[bounds[0]: bounds[-1]], bounds - bounds[0]


def strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data))


def _code_points(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each window its first byte and the places of the code points that begin in it."""
    for lo in range(0, len(data), WINDOW):
        yield lo, np.flatnonzero((data[lo: lo + WINDOW] & 0xC0) != 0x80)


def points_before(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """How many code points begin before each of the ascending places."""
    out, seen = np.zeros(len(places), np.int64), 0
    for lo, starts in _code_points(data):
        a, b = np.searchsorted(places, [lo, lo + WINDOW])
        out[a:b] = seen + np.searchsorted(starts, places[a:b] - lo)
        seen += len(starts)
        out[b:] = seen
    return out


def places_of(data: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Where the code points of these ascending numbers begin; the number of all of them stands for the end."""
    out, seen = np.full(len(numbers), len(data), np.int64), 0
    for lo, starts in _code_points(data):
        a, b = np.searchsorted(numbers, [seen, seen + len(starts)])
        out[a:b] = lo + starts[numbers[a:b] - seen]
        seen += len(starts)
    return out


def displaced(starts: np.ndarray, shifts: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """For each window of ``size`` bytes where every byte moves, if the part from ``starts[i]`` on moves by ``shifts[i]``.

    ``starts`` ascend from 0; of parts with the same start only the last has any bytes.
    """
    steps = np.diff(shifts, prepend=0)
    before = 0
    for lo in range(0, size, WINDOW):
        hi = min(lo + WINDOW, size)
        a, b = np.searchsorted(starts, [lo, hi])
        moves = np.zeros(hi - lo, np.int64)
        np.add.at(moves, starts[a:b] - lo, steps[a:b])
        moves[0] += before
        np.cumsum(moves, out=moves)
        before = int(moves[-1])
        moves += np.arange(lo, hi)
        yield lo, hi, moves


def _found(data: np.ndarray, mark: bytes) -> np.ndarray:
    """The places of a mark, over the borders of the texts too."""
    places = []
    for lo in range(0, len(data) - len(mark) + 1, WINDOW):
        part = data[lo: lo + WINDOW + len(mark) - 1]
        at = np.flatnonzero(part[: len(part) - len(mark) + 1] == mark[0])
        for k in range(1, len(mark)):
            at = at[part[at + k] == mark[k]]
        places.append(at + lo)
    return np.concatenate(places) if places else np.empty(0, np.int64)


def find_marks(data: np.ndarray, bounds: np.ndarray, mark: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The places of a mark and the number of the text that holds it as a whole."""
    places = _found(data, mark)
    text = np.searchsorted(bounds, places, side="right") - 1
    whole = places + len(mark) <= bounds[text + 1]
    return places[whole], text[whole]


def _parts(first, second, third) -> np.ndarray:
    """One array with the three values of each text in turn."""
    return np.stack([first, second, third], axis=1).ravel()


def transform(data: np.ndarray, bounds: np.ndarray, draws: np.ndarray, plain_from: int, spm_below: int,
              marks: list[bytes]) -> dict[str, np.ndarray]:
    """Outputs of all texts of a batch; ``draws`` holds four numbers for each."""
    prefix_mark, suffix_mark, middle_mark = marks
    begin, end = bounds[:-1], bounds[1:]
    before = points_before(data, bounds)
    n = np.diff(before)
    form = np.where(draws[:, 3] % 100 < spm_below, SPM, PSM)
    form[(n == 0) | (draws[:, 2] % 100 >= plain_from)] = PLAIN
    for mark in marks:
        form[find_marks(data, bounds, mark)[1]] = PLAIN
    plain = form == PLAIN
    cuts = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
    cuts[plain] = n[plain, None]
    places = places_of(data, (before[:-1, None] + cuts).ravel()).reshape(-1, 2)
    cut1, cut2 = places[:, 0], places[:, 1]
    prefix, middle, suffix = cut1 - begin, cut2 - cut1, end - cut2

    marked = np.where(plain, 0, sum(map(len, marks)))
    out_bounds = np.concatenate(([0], np.cumsum(end - begin + marked)))
    start = out_bounds[:-1]
    spm = form == SPM
    head = np.where(spm, len(suffix_mark), len(prefix_mark))
    first = np.where(spm, suffix, prefix)
    inner = np.where(spm, len(prefix_mark), len(suffix_mark))
    second_at = start + head + first + inner
    middle_at = out_bounds[1:] - middle
    prefix_at = np.where(plain, start, np.where(spm, second_at, start + head))
    suffix_at = np.where(plain, out_bounds[1:], np.where(spm, start + head, second_at))

    out = np.empty(out_bounds[-1], np.uint8)
    shifts = _parts(prefix_at - begin, middle_at - cut1, suffix_at - cut2)
    for lo, hi, to in displaced(_parts(begin, cut1, cut2), shifts, len(data)):
        out[to] = data[lo:hi]
    for mark, part_at in ((prefix_mark, prefix_at), (suffix_mark, suffix_at), (middle_mark, middle_at)):
        at = part_at[~plain] - len(mark)
        for k, byte in enumerate(mark):
            out[at + k] = byte
    return {"n": n, "form": form, "prefix": cuts[:, 0], "middle": cuts[:, 1] - cuts[:, 0], "data": out,
            "bounds": out_bounds}


def inverse(data: np.ndarray, bounds: np.ndarray, form: np.ndarray, marks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts from their outputs and forms."""
    plain, spm = form == PLAIN, form == SPM
    at = []
    for mark in marks:
        places, text = find_marks(data, bounds, mark)
        places, text = places[~plain[text]], text[~plain[text]]
        if len(text) != (~plain).sum() or (np.diff(text) == 0).any():
            raise ValueError("an output does not hold each mark once")
        own = bounds[1:].copy()  # a plain text is all prefix
        own[text] = places
        at.append(own)
    prefix_mark, suffix_mark, middle_mark = at
    lengths = [np.where(plain, 0, len(mark)) for mark in marks]
    prefix_from = np.where(plain, bounds[:-1], prefix_mark + lengths[0])
    suffix_from = suffix_mark + lengths[1]
    middle_from = middle_mark + lengths[2]
    prefix = np.where(spm, middle_mark, suffix_mark) - prefix_from
    middle = bounds[1:] - middle_from
    out_bounds = np.concatenate(([0], np.cumsum(np.diff(bounds) - sum(lengths))))
    start = out_bounds[:-1]
    middle_at = start + prefix
    suffix_at = middle_at + middle
    out = np.empty(out_bounds[-1], np.uint8)
    shifts = _parts(prefix_from - start, middle_from - middle_at, suffix_from - suffix_at)
    for lo, hi, source in displaced(_parts(start, middle_at, suffix_at), shifts, len(out)):
        out[lo:hi] = data[source]
    return out, out_bounds


def fill_in_middle(docs: DataFrame, seed: int = 1, plain_from: int = 90, spm_below: int = 20,
                   marks: Marks = Marks()) -> DataFrame:
    """doc_id, n (code points), form, prefix_chars, middle_chars (null if plain) and the output of every text.

    The digest of ``seed:doc_id`` gives four numbers: the first two place the cuts, a text is plain if the third modulo 100 is ``plain_from`` or
    more, and else spm if the fourth modulo 100 is below ``spm_below``.
    """
    own = marks.as_bytes()
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i}") for i in range(4)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches(whole, "text"):
                drawn = np.stack([batch.column(f"h{i}").to_numpy(zero_copy_only=False) for i in range(4)], axis=1)
                made = transform(*flat(batch.column("text")), drawn, plain_from, spm_below, own)
                plain = made["form"] == PLAIN
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(made["n"]), pa.array(FORMS).take(pa.array(made["form"])),
                     pa.array(made["prefix"], mask=plain), pa.array(made["middle"], mask=plain),
                     strings(made["data"], made["bounds"]).cast(pa.string())],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", *draws).mapInArrow(
        run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(outputs: DataFrame, marks: Marks = Marks()) -> DataFrame:
    """The rows of ``outputs`` with the column ``restored``: the texts, from the columns form and output alone.

    A null output gives an empty text. An output that does not hold each mark once where its form has them is an error.
    """
    own = marks.as_bytes()
    columns = [c for c in outputs.columns if c != "restored"]
    schema = ", ".join(f"`{c}` {outputs.schema[c].dataType.simpleString()}" for c in columns) + ", restored string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches(whole, "output"):
                form = pc.index_in(batch.column("form"), pa.array(FORMS)).to_numpy(zero_copy_only=False)
                texts = strings(*inverse(*flat(batch.column("output")), form, own)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, "restored"])

    return outputs.select(*columns).mapInArrow(run, schema)


def op11_displacement_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = restore(fill_in_middle(documents(spark, sf_dir)))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output"), 256).alias("output_sha256"),
                       F.sha2(F.col("restored"), 256).alias("restored_sha256"))


OP11_SQL = """
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
           sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
    FROM documents
), numbers AS (
    SELECT doc_id, text, n,
           CAST('0x' || substr(digest, 1, 8) AS BIGINT) % (n + 1) AS a,
           CAST('0x' || substr(digest, 9, 8) AS BIGINT) % (n + 1) AS b,
           CAST('0x' || substr(digest, 17, 8) AS BIGINT) % 100 AS c,
           CAST('0x' || substr(digest, 25, 8) AS BIGINT) % 100 AS d
    FROM drawn
), cut AS (
    SELECT doc_id, text, n,
           CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR c >= 90 THEN 'plain'
                WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form,
           substr(text, 1, least(a, b)) AS prefix,
           substr(text, least(a, b) + 1, greatest(a, b) - least(a, b)) AS middle,
           substr(text, greatest(a, b) + 1) AS suffix, least(a, b) AS n_prefix, greatest(a, b) - least(a, b) AS n_middle
    FROM numbers
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN n_prefix END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN n_middle END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""
