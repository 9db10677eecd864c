"""Ranked lexical search with hashed max-sketches as upper bounds and exact rescoring.

A term that occurs tf times in a document has an impact that grows with tf and falls with the document's length; a document's
score is the sum of weight times impact over the terms of a query. The index holds a *sketch* of every document: each term goes
to two cells, drawn from its hash, and a cell keeps the maximum of what falls on it. The frequencies are folded rather than the
impacts, as for one document the impact of the largest frequency is the largest impact; so the index stays valid when the corpus
statistics change. Frequencies above 127 are rounded up to a step of a scale, so that a cell is one byte. A sketch has at least
CELLS cells for each distinct term, so long and short documents are bounded about equally well (up to MOST_CELLS; beyond
two million distinct terms the bounds of a document widen). Few cells are taken, so the index keeps the distances between them:
about four bytes per distinct term.

The smaller of a term's two cells is at least its frequency, so summing weight times impact over the cells of a query's terms
gives an upper bound of the score, for all documents of a batch by one look-up per term. Rescoring descends the
bounds:

1. the FIRST documents with the highest bounds of each query are scored exactly from their texts; the k-th best score of these is the
   threshold,
2. of all other documents those whose bound reaches the threshold are scored, and none else can be among the k best.

Queries are taken in blocks of about BLOCK_TERMS terms (one longer query is a block of its own), against the sketches of all documents
in turn. A block and its weights go to the tasks; nothing of the documents passes the driver but N, L and one threshold per
query. Terms are compared by 64-bit hashes.

Defined cases: a null text, an empty one and one without terms have no terms, do not count in N and are not returned; rows with
the same doc_id are documents of their own, each with its rank (equal scores in an order that does not matter, as they show the same
id); a null doc_id comes last among equal scores; rows of ``queries`` with the same id are one query with the terms of all
distinct texts; a query without a known term has no results; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugelake.llm.shared import Scratch, documents, text_batches
from gaugelake.llm.shingles import hashed_words

CELLS = 32  # of a sketch, per distinct term at least
MOST_CELLS = 1 << 26
FIRST = 64  # documents per query that are rescored for the threshold
BLOCK_TERMS = 50_000
DF_TERMS = 1 << 21  # distinct terms of documents that a task holds before it sums them up
BOUND_CELLS = 4_000_000  # terms x documents whose impacts are held at once
OPEN_CELLS = 1 << 25  # of sketches that are spread out at once; a longer sketch is alone
SMALL_ROWS = 500_000  # ids of candidates (8 MB) up to which they are broadcast

_not_term = np.ones(256, bool)
_not_term[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

# The frequency a code stands for: itself up to 127, then steps of a quarter up to 2**31.
_SCALE = np.array([*range(128), *(int(128 * 1.25**i) for i in range(1, 76)), 2**31], np.int64)


class Sketch(NamedTuple):
    """Of a document: its terms with repeats, the number of cells, and those that are taken as steps from one to the next."""

    n: int
    width: int
    steps: np.ndarray
    codes: np.ndarray


def term_counts(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text the sorted hashes of its terms and how often each occurs."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    starts, hashes = hashed_words(b" ".join(raw), _not_term)
    cuts = np.searchsorted(starts, np.cumsum([0, *(len(r) + 1 for r in raw)]))
    return [np.unique(hashes[a:b], return_counts=True) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def _two_cells(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(width - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


def sketch_of(hashes: np.ndarray, counts: np.ndarray) -> Sketch:
    width = min(MOST_CELLS, 1 << max(4, int(CELLS * len(hashes) - 1).bit_length()))
    codes = np.searchsorted(_SCALE, counts)
    keys = np.sort(np.concatenate([places << 8 | codes for places in _two_cells(hashes, width)]))
    places = keys >> 8
    highest = np.append(places[1:] != places[:-1], len(keys) > 0)[: len(keys)]  # of each place
    places, keys = places[highest], keys[highest]
    # a distance of 255 or more takes several steps; code 0 means that no cell is meant
    distance = np.diff(places, prepend=0)
    last = np.cumsum(distance // 255 + 1) - 1
    steps = np.full(last[-1] + 1 if len(last) else 0, 255, np.uint8)
    steps[last] = distance % 255
    out = np.zeros(len(steps), np.uint8)
    out[last] = keys & 255
    return Sketch(int(counts.sum()), width, steps, out)


def spread(sketches: list[Sketch]) -> np.ndarray:
    """The cells of sketches of one width, a column for each."""
    cells = np.zeros((sketches[0].width, len(sketches)), np.uint8)
    for j, s in enumerate(sketches):
        taken = s.codes > 0
        cells[np.cumsum(s.steps, dtype=np.int64)[taken], j] = s.codes[taken]
    return cells


def impacts(tf: np.ndarray, n: np.ndarray, documents_with_terms: int, all_terms: int) -> np.ndarray:
    """Fixed formula in whole numbers: what tf occurrences in a document of n terms count."""
    m = 75 + 25 * n * documents_with_terms // all_terms
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def build_index(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """A written table with two kinds of rows: a sketch per document, and counts of documents per term (summed up per task)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0

        def term_rows() -> pa.RecordBatch:
            terms, df = np.unique(np.concatenate(held), return_counts=True)
            step = 1 << 16
            parts = range(0, len(terms), step)
            nothing = pa.nulls(len(parts))
            return pa.RecordBatch.from_arrays(
                [nothing.cast(ids), *[nothing.cast(t) for t in (pa.int64(), pa.int32(), pa.binary(), pa.binary())],
                 pa.array([terms[i: i + step].view(np.int64) for i in parts], pa.list_(pa.int64())),
                 pa.array([df[i: i + step] for i in parts], pa.list_(pa.int64()))], names)

        names = ["doc_id", "n", "width", "steps", "codes", "terms", "dfs"]
        for whole in batches:
            ids = whole.schema.field("doc_id").type
            for batch in text_batches(whole, "text"):
                made = term_counts(batch.column("text").to_pylist())
                nothing = pa.nulls(len(made), pa.list_(pa.int64()))
                sketches = [sketch_of(h, c) for h, c in made]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([s.n for s in sketches], pa.int64()),
                     pa.array([s.width for s in sketches], pa.int32()),
                     pa.array([s.steps.tobytes() for s in sketches], pa.binary()),
                     pa.array([s.codes.tobytes() for s in sketches], pa.binary()), nothing, nothing], names)
                held += [h for h, _ in made]
                n_held += sum(len(h) for h, _ in made)
                if n_held > DF_TERMS:
                    yield term_rows()
                    held, n_held = [], 0
        if n_held:
            yield term_rows()

    return scratch.save(docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n long, width int, steps binary, codes binary, terms array<long>, dfs array<long>"), "index")


def corpus_totals(index: DataFrame) -> tuple[int, int]:
    """N, the documents with a term, and L, all their terms."""
    row = index.filter("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    return row["docs"], row["terms"] or 0


def _query_terms(queries: DataFrame, index: DataFrame, n_docs: int) -> DataFrame:
    """item_id, term, weight (times its repeats) of the terms that some document has."""
    kind = queries.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches(whole, "text"):
                made = term_counts(batch.column("text").to_pylist())
                rows = pa.array(np.repeat(np.arange(len(made)), [len(h) for h, _ in made]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item_id").take(rows), pa.array(np.concatenate([h for h, _ in made]).view(np.int64)),
                     pa.array(np.concatenate([c for _, c in made]).astype(np.int64))], ["item_id", "term", "times"])

    found = (queries.select("item_id", "text").distinct().mapInArrow(run, f"item_id {kind}, term long, times long")
             .groupBy("item_id", "term").agg(F.sum("times").alias("times")))
    holding = (index.filter("terms is not null").select(F.explode(F.arrays_zip("terms", "dfs")).alias("t"))
               .select(F.col("t.terms").alias("term"), F.col("t.dfs").alias("df"))
               .join(found.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df")))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1).cast("double")))
    return found.join(holding, "term").select("item_id", "term", (weight * F.col("times")).alias("weight"))


class Block:
    """Queries as arrays: all their distinct terms, and for each query the places of its terms and their weights."""

    def __init__(self, rows: list):
        by_item: dict = {}
        for item, term, weight in rows:
            by_item.setdefault(item, []).append((np.int64(term).view(np.uint64), weight))
        self.items = sorted(by_item, key=lambda i: (i is None, i))
        self.terms = np.unique(np.array([t for i in self.items for t, _ in by_item[i]], np.uint64))
        self.places = [np.searchsorted(self.terms, np.array([t for t, _ in by_item[i]], np.uint64)) for i in self.items]
        self.weights = [np.array([w for _, w in by_item[i]], np.int64) for i in self.items]


def bounds(block: Block, sketches: list[Sketch], n_docs: int, all_terms: int) -> np.ndarray:
    """Queries x documents: numbers that no score exceeds."""
    impact = np.zeros((len(block.terms), len(sketches)))
    widths = np.array([s.width for s in sketches])
    lengths = np.array([s.n for s in sketches], np.int64)
    for width in np.unique(widths).tolist():
        one, two = _two_cells(block.terms, width)
        same = np.flatnonzero(widths == width)
        together = max(1, OPEN_CELLS // width)
        for lo in range(0, len(same), together):
            columns = same[lo: lo + together]
            cells = spread([sketches[i] for i in columns.tolist()])
            codes = np.minimum(cells[one], cells[two])
            term, column = np.nonzero(codes)
            own = columns[column]
            impact[term, own] = impacts(_SCALE[codes[term, column]], lengths[own], n_docs, all_terms)
    sums = np.stack([w.astype(np.float64) @ impact[p] for p, w in zip(block.places, block.weights, strict=True)])
    return np.ceil(sums * (1 + 2.0**-40))  # sums beyond 2**53 are rounded


def _bounded(index: DataFrame, block: Block, totals: tuple[int, int], emit) -> DataFrame:
    """q, doc_id, bound of what ``emit`` takes of a task's bounds; see _highest and _reaching."""
    kind = index.schema["doc_id"].dataType.simpleString()
    together = max(1, BOUND_CELLS // max(1, len(block.terms)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def computed() -> Iterator[tuple[np.ndarray, pa.Array]]:
            for batch in batches:
                for lo in range(0, batch.num_rows, together):
                    part = batch.slice(lo, together)
                    sketches = [Sketch(n, w, np.frombuffer(s, np.uint8), np.frombuffer(c, np.uint8)) for n, w, s, c in
                                zip(*(part.column(c).to_pylist() for c in ("n", "width", "steps", "codes")), strict=True)]
                    yield bounds(block, sketches, *totals), part.column("doc_id")

        for q, docs, values in emit(computed()):
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), docs, pa.array(values, pa.float64())],
                                             ["q", "doc_id", "bound"])

    return index.filter("n > 0").select("doc_id", "n", "width", "steps", "codes").mapInArrow(
        run, f"q int, doc_id {kind}, bound double")


def _highest(first: int):
    """The ``first`` highest bounds of each query that a task sees."""
    def emit(parts):
        best = None
        for values, docs in parts:
            n = len(docs)
            docs = docs.take(pa.array(np.tile(np.arange(n), len(values))))
            q = np.repeat(np.arange(len(values)), n)
            table = pa.table({"q": q, "doc_id": docs, "bound": values.ravel()})
            table = table.filter(pa.array(values.ravel() > 0))
            best = table if best is None else pa.concat_tables([best, table])
            order = np.lexsort((-best["bound"].to_numpy(), best["q"].to_numpy()))
            sorted_q = best["q"].to_numpy()[order]
            place = np.arange(len(order)) - np.searchsorted(sorted_q, sorted_q)
            best = best.take(pa.array(order[place < first]))
        if best is not None:
            best = best.combine_chunks()
            for b in best.to_batches():
                yield b.column("q").to_numpy(), b.column("doc_id"), b.column("bound").to_numpy()

    return emit


def _reaching(thresholds: np.ndarray):
    """All bounds that reach the threshold of their query."""
    def emit(parts):
        for values, docs in parts:
            q, d = np.nonzero(values >= thresholds[:, None])
            if len(q):
                yield q, docs.take(pa.array(d)), values[q, d]

    return emit


def rescore(docs: DataFrame, wanted: DataFrame, block: Block, totals: tuple[int, int]) -> DataFrame:
    """q, doc_id, score: the exact scores of the pairs (q, doc_id), from the whole texts."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches(whole, "text"):
                q, row, score = [], [], []
                made = term_counts(batch.column("text").to_pylist())
                for i, ((hashes, counts), asked) in enumerate(zip(made, batch.column("qs").to_pylist(), strict=True)):
                    if not len(hashes):
                        continue
                    at = np.minimum(np.searchsorted(hashes, block.terms), len(hashes) - 1)
                    tf = np.where(hashes[at] == block.terms, counts[at], 0).astype(np.int64)
                    impact = impacts(tf, np.int64(counts.sum()), *totals)
                    for k in asked:
                        q.append(k)
                        row.append(i)
                        score.append(int(block.weights[k] @ impact[block.places[k]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q, pa.int32()), batch.column("doc_id").take(pa.array(row, pa.int64())),
                     pa.array(score, pa.int64())], ["q", "doc_id", "score"])

    asked = wanted.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_list("q").alias("qs"))
    if wanted.count() <= SMALL_ROWS:
        asked = F.broadcast(asked)
    return (docs.select("doc_id", "text").join(asked, F.col("doc_id").eqNullSafe(F.col("_id")))
            .select("doc_id", "text", "qs").mapInArrow(run, f"q int, doc_id {kind}, score long").filter("score > 0"))


def _best(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, queries: DataFrame, k: int = 20, index: DataFrame | None = None,
           first: int = FIRST) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of each query with the highest scores above 0.

    ``docs`` has doc_id and text, ``queries`` item_id and text; ``index`` is what ``build_index`` made of the same documents.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "search")
    index = build_index(docs, scratch) if index is None else index
    item, doc = (t.schema[c].dataType.simpleString() for t, c in ((queries, "item_id"), (docs, "doc_id")))
    totals = corpus_totals(index)
    terms = scratch.save(_query_terms(queries, index, totals[0]), "terms")
    blocks = -(-terms.count() // BLOCK_TERMS)
    result = spark.createDataFrame([], f"item_id {item}, rank int, doc_id {doc}, score long")
    for number in range(blocks):
        rows = terms.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).collect()
        if rows:
            found = _search_block(docs, index, Block(rows), totals, k, max(first, k), scratch, number)
            result = result.unionByName(found.select(F.col("item").cast(item).alias("item_id"), "rank", "doc_id", "score"))
    return result


def _search_block(docs: DataFrame, index: DataFrame, block: Block, totals: tuple[int, int], k: int, first: int,
                  scratch: Scratch, number: int) -> DataFrame:
    spark = docs.sparkSession
    by_bound = Window.partitionBy("q").orderBy(F.col("bound").desc(), F.col("doc_id").asc_nulls_last())
    top = (_bounded(index, block, totals, _highest(first))
           .withColumn("place", F.row_number().over(by_bound)).filter(F.col("place") <= first))
    top = scratch.save(top.select("q", "doc_id").distinct(), f"top-{number}")
    scored = scratch.save(rescore(docs, top, block, totals), f"scored-{number}")
    thresholds = np.ones(len(block.items))
    for row in _best(scored, k).filter(F.col("rank") == k).select("q", "score").collect():
        thresholds[row["q"]] = row["score"]
    done = top.select(F.col("q").alias("_q"), F.col("doc_id").alias("_id"))
    more = (_bounded(index, block, totals, _reaching(thresholds)).select("q", "doc_id").distinct()
            .join(done, (F.col("q") == F.col("_q")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_anti"))
    more = scratch.save(more, f"more-{number}")
    scored = scored.unionByName(scratch.save(rescore(docs, more, block, totals), f"rescored-{number}"))
    kind = "string" if any(isinstance(i, str) for i in block.items) else "long"
    names = spark.createDataFrame(list(enumerate(block.items)), f"q int, item {kind}")
    best = scratch.save(_best(scored, k).join(names, "q"), f"best-{number}")
    scratch.drop(*[f"{name}-{number}" for name in ("top", "scored", "more", "rescored")])
    return best


def op13_max_sketch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


OP13_SQL = r"""
WITH texts AS (
    SELECT row_number() OVER () AS place, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), words AS (
    SELECT place, doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts
), frequencies AS (
    SELECT place, term, count(*) AS tf FROM words GROUP BY place, term
), lengths AS (
    SELECT place, doc_id, count(*) AS n FROM words GROUP BY place, doc_id
), totals AS (
    SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths
), asked AS (
    SELECT item_id, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM frequencies, totals GROUP BY term, docs
), scores AS (
    SELECT a.item_id, l.place, l.doc_id,
           CAST(sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 12 * (75 + (25 * l.n * t.docs) // t.terms)))) AS BIGINT) AS score
    FROM asked a JOIN weights w ON w.term = a.term JOIN frequencies f ON f.term = a.term
         JOIN lengths l ON l.place = f.place, totals t
    GROUP BY a.item_id, l.place, l.doc_id
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
    FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
