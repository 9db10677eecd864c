"""N-gram Jaccard join: which documents share nearly all of their word n-grams.

A document is the set of its distinct ``words``-grams (hashed to 64 bits). Two documents link when
``100 * |intersection| >= percent * |union|``; the join returns the components of the links.

With a threshold t, a document of n n-grams can miss at most ``m = n - ceil(t * n)`` of them in any
partner. So two partners share at least k n-grams among the first ``m + k`` of each in one fixed order
(here: by hash), whatever those orders are on. That *reach* of ``m + k`` n-grams is all that is
shuffled of a document:

* Rare first: the n-grams of a reach are ordered by the number of documents that have them. Partners share at
  least k of their reaches, so they share one of the ``m + 1`` rarest (the prefix). N-grams of one document are
  part of the prefix but need no posting, and a document with fewer than k shared n-grams has no partner.
* Length filter: partners have ``ceil(t * n)`` n-grams or more.
* Positional filter: a shared n-gram at places a and b (by hash) leaves room for at most
  ``min(a, b) + min(n_a - a, n_b - b)`` shared ones; and one at places i and j of the prefixes is the rarest shared
  one only if enough n-grams follow it in both.
* Suffix filter: parity bits over the whole set; each n-gram in just one of two sets flips one bit, so the bits
  that differ bound the size of the difference from below. 256 bits go with every posting, which decides for short sets; a pair that
  passes is then held against bits in proportion to its sets (about two per n-gram), which tell long sets apart as well.

Pairs that pass are verified once, on their whole sets. Documents with equal sets are one class from the start.
In each posting list all documents are first held against its smallest. The components of the links found so are labels,
and the second round joins only documents with different labels, so a large group of near copies
does not become all of its pairs. In a list of LONG_LIST documents or more a pair counts at the first n-gram that both have among
their FEW rarest of such lists (or at every n-gram, if these have none in common), so documents that share much meet once there, not at each n-gram. Every pair
of unlinked labels that passes the filters is still verified: no link
between components is lost. The components come from alternating large-star and small-star steps.

Defined cases: null and empty texts and texts of white space have no n-grams, link with nothing and are their own
component; a text with fewer words than ``words`` has one n-gram; equal texts always link; rows with the same doc_id
count as one document with equal rows dropped (of different texts under one doc_id, all sets count and the components
meet in the id); a null doc_id is returned with null component; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugelake.llm.shared import Scratch, distinct_texts_first, documents, text_batches
from gaugelake.llm.shingles import shingle_sets
from gaugelake.session import ensure_checkpoint_dir

PARITY_WORDS = 4  # 64 bits each
LONG_LIST = 8
SET_BYTES = 2_000_000  # of text whose sets are made at once in a task
FEW = 16
WIDE_FROM = 400  # n-grams: the 64 * PARITY_WORDS bits of larger sets differ too little to rule pairs out
WIDE_MOST = 2048  # bits

SIGNATURE = [f"s{i}" for i in range(PARITY_WORDS)]


def least_overlap(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def extra(n: int, percent: int, reach: int) -> int:
    """k of a document of n n-grams: ``reach`` percent of what it can miss, one at least."""
    overlap = least_overlap(n, percent)
    return min(overlap, 1 + (n - overlap) * reach // 100)


def _overlap(n: F.Column, percent: int) -> F.Column:
    return F.floor((n * percent + 99) / 100).cast("int")


def _extra(n: F.Column, percent: int, reach: int) -> F.Column:
    overlap = _overlap(n, percent)
    return F.least(overlap, 1 + F.floor((n - overlap) * reach / 100)).cast("int")


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def parity(tokens: np.ndarray) -> np.ndarray:
    """64 * PARITY_WORDS bits; a bit is set if an odd number of the n-grams fall on it."""
    cells = np.bincount((tokens >> np.uint64(20)).astype(np.int64) & (64 * PARITY_WORDS - 1),
                        minlength=64 * PARITY_WORDS) & 1
    return np.packbits(cells.astype(np.uint8)).view(np.int64)


def parity_in_proportion(tokens: np.ndarray) -> bytes:
    """As ``parity``, with a power of two of bits: two for each n-gram at least."""
    bits = 1 << max(6, int(2 * len(tokens) - 1).bit_length())
    cells = np.bincount((tokens >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(cells.astype(np.uint8), bitorder="little").tobytes()


def parity_difference(a: bytes, b: bytes) -> int:
    """How many bits differ, on as many bits as the shorter one has: halves fold onto each other."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) != len(y):
        if len(x) < len(y):
            x, y = y, x
        x = x[: len(x) // 2] ^ x[len(x) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def wide_parity(bits: bytes, n: int) -> np.ndarray:
    """Half of the bits in proportion, WIDE_MOST at most, for sets of WIDE_FROM n-grams or more; empty for others."""
    if n < WIDE_FROM:
        return np.empty(0, np.int64)
    x = np.frombuffer(bits, np.uint64)
    words = min(len(x) // 2, WIDE_MOST // 64)
    while len(x) > words:
        x = x[: len(x) // 2] ^ x[len(x) // 2:]
    return x.view(np.int64)


def most_different(n_a: int, n_b: int, percent: int) -> int:
    """The n-grams that two linked sets can have alone, both together."""
    return n_a + n_b - 2 * -(-(n_a + n_b) * percent // (100 + percent))


def _reaches(docs: DataFrame, words: int, percent: int, reach: int) -> DataFrame:
    """doc_id, set size, digest of the set, parity bits and the n-grams of the reach, in the order of their hashes."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches(whole, "text", SET_BYTES):
                texts, index = distinct_texts_first(batch.column("text").to_pylist())
                made = shingle_sets(texts, words)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in made]
                bits = [parity(s) for s in made]
                heads = [s[: len(s) - least_overlap(len(s), percent) + extra(len(s), percent, reach)] for s in made]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"),
                     pa.array([len(made[i]) for i in index], pa.int32()),
                     pa.array([digests[i] for i in index], pa.binary()),
                     *[pa.array([int(bits[i][j]) for i in index], pa.int64()) for j in range(PARITY_WORDS)],
                     _lists([heads[i] for i in index])],
                    ["doc_id", "n", "digest", *SIGNATURE, "head"])

    schema = ("doc_id long, n int, digest binary, " + ", ".join(f"{s} long" for s in SIGNATURE)
              + ", head array<long>")
    return docs.select("doc_id", "text").mapInArrow(sets, schema)


def _whole_sets(docs: DataFrame, words: int) -> DataFrame:
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches(whole, "text", SET_BYTES):
                made = shingle_sets(batch.column("text").to_pylist(), words)
                bits = [parity_in_proportion(s) for s in made]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array([len(s) for s in made], pa.int32()), pa.array(bits, pa.binary()), _lists(made),
                     _lists([wide_parity(b, len(s)) for b, s in zip(bits, made, strict=True)])],
                    ["id", "n", "bits", "tokens", "wide"])

    return docs.select("id", "text").mapInArrow(sets, "id long, n int, bits binary, tokens array<long>, wide array<long>")


def _postings(heads: DataFrame, reps: DataFrame, percent: int, reach: int) -> DataFrame:
    """The shared n-grams of each prefix: token, place by hash, place in the prefix, and the document."""
    tokens = heads.select("doc_id", F.posexplode("head").alias("place", "token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    known = tokens.join(shared, "token").join(reps, "doc_id")
    ranked = known.select(
        "*",
        F.row_number().over(Window.partitionBy("doc_id").orderBy("df", "token")).alias("rare"),
        F.count("*").over(Window.partitionBy("doc_id")).alias("n_shared"))
    n = F.col("n")
    least = _extra(_overlap(n, percent), percent, reach)  # k of the smallest possible partner
    own = _extra(n, percent, reach)
    left = F.col("n_shared") - F.col("rare") + 1  # n-grams of the reach from this one on that others have too
    return (ranked.filter(left >= least)
            .select("token", F.col("doc_id").alias("id"), "n", "place", left.cast("int").alias("left"),
                    own.alias("k"), *SIGNATURE))


def _needed(a, b, percent: int) -> F.Column:
    return F.ceil((a("n") + b("n")) * percent / (100.0 + percent) - 1e-9)


def _wide_passes(a, b, percent: int) -> F.Column:
    """The suffix filter with the bits of long sets, on as many as the shorter one has; a set without them passes."""
    x, y = a("wide"), b("wide")
    words, most = F.least(F.size(x), F.size(y)), F.greatest(F.size(x), F.size(y))

    def folded(bits: F.Column) -> F.Column:
        halves = F.zip_with(F.slice(bits, F.lit(1), words), F.slice(bits, words + 1, words), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(bits) > words, halves).otherwise(bits)

    differ = F.aggregate(F.zip_with(folded(x), folded(y), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, c: s + c)
    return (most > 2 * words) | (differ <= a("n") + b("n") - 2 * _needed(a, b, percent))


def _passes(a, b, percent: int) -> F.Column:
    """Length, positional and suffix filters of two postings of one n-gram."""
    needed = _needed(a, b, percent)
    smaller, larger = F.least(a("n"), b("n")), F.greatest(a("n"), b("n"))
    room = F.least(a("place"), b("place")) + F.least(a("n") - a("place"), b("n") - b("place"))
    differ = sum((F.bit_count(a(s).bitwiseXOR(b(s))) for s in SIGNATURE), F.lit(0))
    return ((smaller * 100 >= larger * percent)
            & (room >= needed)
            & (F.least(a("left"), b("left")) >= F.least(a("k"), b("k")))
            & (differ <= a("n") + b("n") - 2 * needed))


def _near_enough(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the parity bits of their whole sets do not rule out."""
    first = sets.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    second = sets.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("n_a", "n_b", "bits_a", "bits_b")]
            passes = [parity_difference(x, y) <= most_different(n, m, percent) for n, m, x, y in zip(*columns, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(passes, pa.bool_()))

    return pairs.join(first, "a").join(second, "b").select(
        "a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(check, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link."""
    first = sets.select(F.col("id").alias("a"), F.col("tokens").alias("x"))
    second = sets.select(F.col("id").alias("b"), F.col("tokens").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return (pairs.join(first, "a").join(second, "b")
            .filter(common * 100 >= (F.size("x") + F.size("y") - common) * percent)
            .select("a", "b"))


def _pairs(labelled: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of postings of one n-gram whose labels differ and that pass the filters.

    In long lists a pair counts at the first n-gram that both documents have among their FEW of the shortest long lists. A linked pair passes
    the filter on places at each n-gram, and the one on what is left at the rarest n-gram of both; what is left is not asked
    in long lists, as a pair may count at another n-gram there.
    """
    long = F.col("many") >= LONG_LIST
    order = Window.partitionBy("id").orderBy("many", "token")
    few = (labelled.filter(long).select("id", "many", "token").withColumn("at", F.row_number().over(order))
           .filter(F.col("at") <= FEW).groupBy("id")
           .agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "token"))), lambda x: x["token"]).alias("few")))
    rows = labelled.join(few, "id", "left").withColumns(
        {"left": F.when(long, F.col("k")).otherwise(F.col("left")), "few": F.when(long, F.col("few"))})
    other = rows.select("token", *[F.col(c).alias(f"l_{c}") for c in rows.columns if c not in ("token", "many")])
    common = F.array_intersect("l_few", "few")
    once = ~long | (F.size(common) == 0) | (F.get(common, F.lit(0)) == F.col("token"))
    return (rows.join(other, "token")
            .filter((F.col("l_id") < F.col("id")) & (F.col("l_label") != F.col("label")))
            .filter(_passes(F.col, lambda c: F.col(f"l_{c}"), percent)).filter(once)
            .filter(_wide_passes(F.col, lambda c: F.col(f"l_{c}"), percent))
            .select(F.col("l_id").alias("a"), F.col("id").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of all nodes with an edge (a, b); every step is checkpointed."""
    ensure_checkpoint_dir(edges.sparkSession)
    edges = (edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
             .filter("a <> b").distinct().checkpoint())
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        least = least.select("a", F.least("a", "least").alias("least"))
        large = (both.join(least, "a").filter("b > a")
                 .select(F.col("b").alias("a"), F.col("least").alias("b")).distinct())
        lowest = large.groupBy("a").agg(F.min("b").alias("least"))
        small = (large.join(lowest, "a")
                 .select(F.explode(F.array(
                     F.struct(F.col("a").alias("a"), F.col("least").alias("b")),
                     F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("e"))
                 .select("e.*").filter("a <> b").distinct())
        edges = small.checkpoint()
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = now


def near_duplicates(docs: DataFrame, words: int, percent: int, reach: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id of every document; see the module for the method.

    ``reach`` is k in percent of what a document may miss: more of it finds rarer prefixes and shuffles more.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram-join")
    heads = scratch.save(_reaches(docs, words, percent, reach), "heads")
    whole = heads.filter("digest is not null and doc_id is not null")
    members = whole.select("doc_id", "digest").distinct()
    classes = members.groupBy("digest").agg(F.min("doc_id").alias("id"))
    classed = scratch.save(members.join(classes, "digest").select("doc_id", "id"), "classes")
    reps = (whole.join(classes.select(F.col("id").alias("doc_id"), "digest"), ["doc_id", "digest"], "left_semi")
            .select("doc_id", "n", *SIGNATURE).dropDuplicates(["doc_id", "n", *SIGNATURE]))
    found = _postings(whole, reps, percent, reach)
    several = scratch.save(found, "postings")

    hubs = several.groupBy("token").agg(F.min("id").alias("hub"), F.count("*").alias("many")).filter("many > 1")
    listed = several.join(hubs, "token")
    hub = listed.filter("id = hub").select("token", *[F.col(c).alias(f"h_{c}") for c in
                                                      ["id", "n", "place", "left", "k", *SIGNATURE]])
    near = (several.join(hub, "token").filter(F.col("id") > F.col("h_id"))
            .filter(_passes(F.col, lambda c: F.col(f"h_{c}"), percent))
            .select(F.col("h_id").alias("a"), F.col("id").alias("b")).distinct())
    wanted = listed.select("id").distinct()
    texts = docs.select(F.col("doc_id").alias("id"), "text").join(wanted, "id", "left_semi")
    sets = scratch.save(_whole_sets(texts, words), "sets")
    near = scratch.save(_near_enough(near, sets, percent), "near")
    first = scratch.save(_verified(near, sets, percent), "first")

    linked = first.union(classed.select(F.col("doc_id").alias("a"), F.col("id").alias("b")))
    labels = scratch.save(components(linked).select(F.col("node").alias("id"), F.col("component").alias("label")), "labels")
    # several texts under one id have bits of their own, told apart by their sizes
    wide = sets.filter("size(wide) > 0").select("id", "n", "wide").distinct()
    labelled = listed.drop("hub").join(labels, "id", "left").join(wide, ["id", "n"], "left").withColumns({
        "label": F.coalesce("label", "id"), "wide": F.coalesce("wide", F.array().cast("array<long>"))})
    rest = scratch.save(_pairs(labelled, percent).distinct(), "rest")
    rest = scratch.save(_near_enough(rest.join(near, ["a", "b"], "left_anti"), sets, percent), "unlike")
    second = scratch.save(_verified(rest, sets, percent), "second")

    found = components(first.union(second).union(classed.select(F.col("doc_id").alias("a"), F.col("id").alias("b"))))
    sizes = heads.groupBy("doc_id").agg(F.max("n").cast("long").alias("n_shingles"))
    result = scratch.save(
        sizes.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")), "result")
    scratch.drop("heads", "classes", "postings", "sets", "near", "first", "labels", "rest", "unlike", "second")
    return result


def keep_one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, reach: int = 25) -> DataFrame:
    """The documents whose id is the smallest of its component; of rows with equal ids one stays.

    Rows without an id can't be compared and stay. Only the ids that go, and those that occur more than once, are
    joined, so the texts that stay are not shuffled where these are few.
    """
    scratch = Scratch(docs.sparkSession, "one-of-each")
    goes = scratch.save(near_duplicates(docs, words, percent, reach)
                        .filter("doc_id <> component_id").select("doc_id"), "goes")
    repeated = scratch.save(docs.filter("doc_id is not null").groupBy("doc_id").count()
                            .filter("count > 1").select("doc_id"), "repeated")
    stays = docs.join(goes, "doc_id", "left_anti").select(*docs.columns)
    single = stays.join(repeated, "doc_id", "left_anti").select(*docs.columns)
    if repeated.isEmpty():
        return single
    return single.unionByName(
        stays.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), words=3, percent=90)
