"""Mixing sources to target weights by cube-method balanced sampling.

Every source has a target of words; a document of a source is taken ``floor(target / size of the source)`` times
and once more with the remaining probability p. The samples are balanced: the flight phase moves the probabilities of
three documents at a time along the null space of the two balancing constraints (number of documents and
number of words) until one of them is 0 or 1, so both totals stay as expected. Long documents go first; what is left of
a block is two undecided documents at most and SPARE of all lengths, which are held back.

A source is cut into blocks of about BLOCK documents by a hash, so a source that holds a third of all rows is many
blocks. The undecided of many blocks meet in the next flight, level by level, until one block of them
remains per source; the landing phase drops the number of documents and decides its last few by the smallest deviation in words. A
document is known by its id, text, source and, among rows equal in these, a number; its block, its place in the flight and all random choices come
from these and the seed, so reruns agree, however the files are split and on any number of cores.

Defined cases: a null text has size 0 and is never taken; a null source is a source of its own, the last one; a
source without words has target 0; repeated rows are documents of their own; a null doc_id is kept; an empty table
gives no rows; other columns are ignored by ``sample`` and kept by ``mix``, whatever their names (but for those that begin with ``_mix_``).
"""

from __future__ import annotations

import random
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugelake.llm.shared import WORD, Scratch, documents
from gaugelake.operators.numbering import with_position

WEIGHTS = (3, 1, 2)  # fixed: repeated over the sources in code point order
SHARE = 1.5  # fixed: words of the mix, in words of all documents
MOST = 2  # fixed: a document is taken so many times at most
BLOCK = 20_000
FAN = 5_000  # blocks whose undecided documents meet in the next level
SEED = 17
SPARE = 26
EDGE = 1e-9


def flight(sizes: Sequence[int], shares: Sequence[float], rng: random.Random) -> list[float]:
    """Probabilities after the flight phase: 0 or 1 but for two and SPARE at most, which lie evenly in the order given."""
    p = [0.0 if x < EDGE else 1.0 if x > 1 - EDGE else x for x in shares]
    held: list[int] = []
    open_ = [i for i, x in enumerate(p) if 0 < x < 1]
    spare = {open_[k * (len(open_) - 1) // (SPARE - 1)] for k in range(SPARE)} if open_ else set()
    for i in open_:
        if i in spare:
            continue
        held.append(i)
        while len(held) == 3 or len(held) == 2 and sizes[held[0]] == sizes[held[1]]:
            if len(held) == 3:
                a, b, c = (sizes[j] for j in held)
                move = (b - c, c - a, a - b) if a != b or b != c else (1, -1, 0)
            else:
                move = (1, -1)
            up = min(((1 - p[j]) / u if u > 0 else p[j] / -u) for j, u in zip(held, move, strict=True) if u)
            down = min((p[j] / u if u > 0 else (1 - p[j]) / -u) for j, u in zip(held, move, strict=True) if u)
            step = up if rng.random() * (up + down) < down else -down
            for j, u in zip(held, move, strict=True):
                x = p[j] + step * u
                p[j] = 0.0 if x < EDGE else 1.0 if x > 1 - EDGE else x
            held = [j for j in held if 0 < p[j] < 1]
    return p


def landing(sizes: Sequence[int], shares: Sequence[float]) -> list[float]:
    """0 or 1 for each of the few undecided, so that their words come nearest to the expected ones."""
    left = [i for i, x in enumerate(shares) if 0 < x < 1]
    wanted = sum(sizes[i] * shares[i] for i in left)
    half = len(left) // 2

    def sums(some: list[int]) -> np.ndarray:
        """Of all choices; the place of a choice has a bit for each document."""
        out = np.zeros(1, np.int64)
        for i in some:
            out = np.concatenate([out, out + sizes[i]])
        return out

    # each choice of one half with the two choices of the other half that come nearest
    ours, theirs = sums(left[:half]), sums(left[half:])
    order = np.argsort(theirs, kind="stable")
    at = np.searchsorted(theirs[order], wanted - ours)
    near = np.stack([np.clip(at - 1, 0, len(order) - 1), np.clip(at, 0, len(order) - 1)])
    off = np.abs(ours + theirs[order][near] - wanted)
    side, place = np.unravel_index(int(off.argmin()), off.shape)
    best = int(place) | int(order[near[side, place]]) << half
    p = list(shares)
    for k, i in enumerate(left):
        p[i] = float(best >> k & 1)
    return p


def _with_targets(sized: DataFrame, scratch: Scratch) -> DataFrame:
    """A row per source: its number, size, documents and target.

    The excess over the caps is shared out again until no source is above; each pass is one aggregate over the sources.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    sources = sources.withColumn("_null", F.col("source").isNull())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("source_no") % len(WEIGHTS) + 1).cast("int"))
    sources = scratch.save(with_position(sources, ["_null", "source"], "source_no").drop("_null")
                           .withColumn("weight", weight).withColumn("cap", MOST * F.col("source_size")), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    each, before = 0.0, -1.0
    while each != before:
        full = F.col("weight") * each > F.col("cap")
        capped, weights = sources.agg(F.sum(F.when(full, F.col("cap")).otherwise(0)),
                                      F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        before, each = each, (total * SHARE - (capped or 0)) / weights if weights else each
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(float(each)), F.col("cap").cast("double")))


UNITS = ("id string, digest long, number long, source_no long, block long, size long, source_size long, target double,"
         " times int, p double")


def _fly(units: DataFrame, last: bool) -> DataFrame:
    def decide(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["size", "mixed", "id", "digest", "number"], ascending=[False, True, True, True, True])
        rng = random.Random(f"{SEED}/{block['source_no'].iat[0]}/{block['block'].iat[0]}/{last}")
        sizes = block["size"].tolist()
        p = flight(sizes, block["p"].tolist(), rng)
        return block.drop(columns="mixed").assign(p=landing(sizes, p) if last else p)

    mixed = units.withColumn("mixed", F.xxhash64("id", "digest", "number", F.lit(SEED)))
    return mixed.groupBy("source_no", "block").applyInPandas(decide, UNITS)


def sample(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """A row per document: id (doc_id as text), digest of the text, source, number among equal ones, size, source_size, target and times taken."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    kinds = docs.select(F.col("doc_id").cast("string").alias("id"), "source", F.xxhash64("text").alias("digest"), words.alias("size"))
    # counted before they are numbered: rows that are all equal never meet in one task
    kinds = kinds.groupBy("id", "source", "digest", "size").agg(F.count("*").alias("equal"))
    sized = scratch.save(kinds.withColumn("number", F.explode(F.sequence(F.lit(1).cast("long"), "equal"))).drop("equal"), "sized")
    targets = scratch.save(_with_targets(sized, scratch), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).select(
        "id", "digest", "number", "source_no",
        F.pmod(F.xxhash64("id", "digest", "number"), F.ceil(F.col("n_docs") / BLOCK)).alias("block"),
        "size", "source_size", "target",
        F.least(F.floor(ratio), F.lit(MOST)).cast("int").alias("times"),
        (ratio - F.floor(ratio)).alias("p"))
    blocks = max(1, -(-(targets.agg(F.max("n_docs")).first()[0] or 0) // BLOCK))
    decided, level = [], 0
    while True:
        last = blocks == 1
        flown = scratch.save(_fly(units, last), f"level{level}")
        decided.append(flown if last else flown.filter("p = 0 or p = 1"))
        if last:
            break
        blocks, level = -(-blocks // FAN), level + 1
        units = flown.filter("p > 0 and p < 1").withColumn("block", F.floor(F.col("block") / FAN))
    rows = decided[0]
    for more in decided[1:]:
        rows = rows.unionByName(more)
    rows = rows.withColumn("times", F.when(F.col("size") > 0, F.col("times") + F.col("p").cast("int")).otherwise(0))
    return rows.join(targets.select("source", "source_no"), "source_no").select(
        "id", "digest", "source", "number", "size", "source_size", "target", "times")


def mix(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all their columns.

    Documents equal in id, text and source share what is taken of them; only where that does not come out even are they numbered, in the
    order of a digest of all their columns.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    taken = sample(docs, scratch).groupBy("id", "digest", "source").agg(
        F.sum("times").alias("_mix_times"), F.count("*").alias("_mix_equal"))
    taken = scratch.save(taken.filter("_mix_times > 0").withColumnsRenamed(
        {"id": "_mix_id", "digest": "_mix_digest", "source": "_mix_source"}), "taken")
    held = docs.join(taken, F.col("doc_id").cast("string").eqNullSafe(F.col("_mix_id"))
                     & (F.xxhash64("text") == F.col("_mix_digest")) & F.col("source").eqNullSafe(F.col("_mix_source")))
    uneven = F.col("_mix_times") % F.col("_mix_equal") != 0
    whole = F.floor(F.col("_mix_times") / F.col("_mix_equal"))
    even = held.filter(~uneven).withColumn("_mix_each", whole)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    key = Window.partitionBy("_mix_id", "_mix_digest", "_mix_source").orderBy(F.xxhash64(*columns))
    odd = held.filter(uneven).withColumn("_mix_number", F.row_number().over(key)).withColumn(
        "_mix_each", whole + (F.col("_mix_number") <= F.col("_mix_times") % F.col("_mix_equal")).cast("long")).drop("_mix_number")
    each = even.unionByName(odd).filter("_mix_each > 0")
    return each.withColumn("_mix_time", F.explode(F.sequence(F.lit(1).cast("long"), "_mix_each"))).select(*columns)


def op5_cube_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sample(documents(spark, sf_dir), Scratch(spark, "mixing"))
    return rows.select(F.col("id").cast("long").alias("doc_id"), "size", "source_size", "target",
                       (F.col("size") * F.col("times")).alias("taken"))
