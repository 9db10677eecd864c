"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in DataFrame operations only.

A text is the set of the digests of its paragraphs: its lines, and lines of more than PIECE characters in
pieces. The digests are dealt to parts by hash, and each part is a table of 3 * SLOTS cells; a digest is added to
one cell of each third: the count goes up by one, the digest and a check of it are XORed in. The fingerprint of a text
is its number of digests and its table of BASE_PARTS parts; equal texts have equal fingerprints.

To compare two versions their cells are subtracted: what they share vanishes. A cell with count 1 or -1 whose
check fits holds one digest of the first or the second version alone; it is recovered and removed from its cells, which
lays further ones bare (peeling). Each part is peeled by itself, round by round. If cells remain, the difference was too
large: both are sketched again with four times as many parts (and other hashes) and peeled again, up to TRIES times; the
first try already takes parts by the number of cells that differ, as a full table can't be peeled. The few
differences that fail all tries are taken from the digests themselves, so the result is always whole. The likeness is the Jaccard index,
(a + b - d) / (a + b + d), for d recovered digests of texts with a and b.

A text and the next one (ascending doc_id, the first after the last) meet in a window over ranges of doc_id; the first text
of each range is also dealt to the range before it. Texts are shuffled once.

Defined cases: a null or empty text is the empty set, and two empty sets are alike (1.0); a single document is its
own next one; equal doc_ids follow each other in the order of their texts; a null doc_id comes first; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugelake.llm.shared import documents, range_bounds, range_of, ranges_for

PIECE = 400  # characters of a paragraph
SLOTS = 8  # cells of one third of a part
BASE_PARTS = 2
LOAD = 4  # differing digests wanted in a part of 3 * SLOTS cells
TRIES = 3
ROUNDS = 6  # of peeling in a part


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def digests(text: Column) -> Column:
    """The sorted distinct paragraph digests."""
    cut = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line != "")
    pieces = F.flatten(F.transform(cut, lambda line: F.when(F.length(line) <= PIECE, F.array(line)).otherwise(
        F.regexp_extract_all(line, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)))))
    return F.array_sort(F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p))))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(7))


def _slot(key: Column, third, salt: Column) -> Column:
    """The cell of a key in a part, from 0 to 3 * SLOTS - 1."""
    return F.pmod(F.shiftright(F.xxhash64(key, salt), third * 8), F.lit(SLOTS)).cast("int") + third * SLOTS


def _hashed(keys: Column, parts: Column, salt: Column) -> Column:
    """Each key with its check, part and three cells."""
    return F.transform(keys, lambda k: F.struct(
        k.alias("k"), _check(k).alias("h"), F.pmod(F.xxhash64(k, salt + 1000), parts).cast("int").alias("part"),
        _slot(k, 0, salt).alias("x"), _slot(k, 1, salt).alias("y"), _slot(k, 2, salt).alias("z")))


def _cell(entries: Column) -> Column:
    """Count, key and check of the entries of one cell."""
    empty = F.struct(F.lit(0).alias("c"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("h"))
    return F.aggregate(entries, empty, lambda cell, e: F.struct(
        (cell["c"] + 1).alias("c"), cell["k"].bitwiseXOR(e["k"]).alias("k"), cell["h"].bitwiseXOR(e["h"]).alias("h")))


def sketch(keys: Column, parts: Column, salt: Column) -> Column:
    """The parts, each an array of its 3 * SLOTS cells."""
    def table(entries: Column) -> Column:
        def part(number: Column) -> Column:
            def cells(own: Column) -> Column:
                return F.transform(F.sequence(F.lit(0), F.lit(3 * SLOTS - 1)), lambda i: _cell(F.filter(
                    own, lambda e: F.when(i < SLOTS, e["x"]).when(i < 2 * SLOTS, e["y"]).otherwise(e["z"]) == i)))

            return let(F.filter(entries, lambda e: e["part"] == number), cells)

        return F.transform(F.sequence(F.lit(0), (parts - 1).cast("int")), part)

    return let(_hashed(keys, parts, salt), table)


def subtract(first: Column, second: Column) -> Column:
    return F.zip_with(first, second, lambda p, q: F.zip_with(p, q, lambda a, b: F.struct(
        (a["c"] - b["c"]).alias("c"), a["k"].bitwiseXOR(b["k"]).alias("k"),
        a["h"].bitwiseXOR(b["h"]).alias("h"))))


def _nonzero(cell: Column) -> Column:
    return (cell["c"] != 0) | (cell["k"] != 0) | (cell["h"] != 0)


def _peel_part(cells: Column, salt: Column) -> Column:
    """Number of keys recovered from a part, and whether nothing is left of it."""
    def one_round(state: Column) -> Column:
        def after(pure: Column) -> Column:
            def without(cell: Column, i: Column) -> Column:
                return F.aggregate(pure, cell, lambda left, p: F.when(
                    (p["x"] == i) | (p["y"] == i) | (p["z"] == i), F.struct(
                        (left["c"] - p["c"]).alias("c"), left["k"].bitwiseXOR(p["k"]).alias("k"),
                        left["h"].bitwiseXOR(p["h"]).alias("h"))).otherwise(left))

            return F.struct(F.transform(state["cells"], without).alias("cells"),
                            (state["n"] + F.size(pure)).alias("n"))

        alone = F.filter(state["cells"], lambda c: (F.abs(c["c"]) == 1) & (c["h"] == _check(c["k"])))
        pure = F.array_distinct(F.transform(alone, lambda c: F.struct(
            c["c"].alias("c"), c["k"].alias("k"), c["h"].alias("h"), _slot(c["k"], 0, salt).alias("x"),
            _slot(c["k"], 1, salt).alias("y"), _slot(c["k"], 2, salt).alias("z"))))
        return let(pure, lambda p: F.when(F.size(p) == 0, state).otherwise(after(p)))

    begin = F.struct(cells.alias("cells"), F.lit(0).alias("n"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), begin, lambda state, _: one_round(state),
                       lambda state: F.struct(state["n"].alias("n"),
                                              (~F.exists(state["cells"], _nonzero)).alias("done")))


def peel(table: Column, salt: Column) -> Column:
    """Number of differing digests, or null if the table could not be peeled to the end."""
    def counted(parts: Column) -> Column:
        return F.when(F.forall(parts, lambda p: p["done"]),
                      F.aggregate(parts, F.lit(0), lambda n, p: n + p["n"]))

    return let(F.transform(table, lambda cells: _peel_part(cells, salt)), counted)


def differing(a_keys: Column, b_keys: Column, a_base: Column, b_base: Column) -> Column:
    """Number of digests that only one of the two has, by subtracting and peeling, larger on failure."""
    most = F.size(a_keys) + F.size(b_keys)

    def tried(cells: Column) -> Column:
        used = F.aggregate(cells, F.lit(0), lambda n, part: n + F.size(F.filter(part, _nonzero)))
        # of 24 cells all are used long before the table is overfull: then the sizes are the only estimate
        wide = F.when(used * 3 <= 3 * SLOTS * BASE_PARTS, BASE_PARTS).otherwise(
            F.greatest(F.lit(2 * BASE_PARTS), F.ceil(most / LOAD))).cast("int")

        def again(found: Column, attempt: Column) -> Column:
            parts, salt = wide * F.pow(F.lit(4), attempt - 1).cast("int"), attempt
            larger = peel(subtract(sketch(a_keys, parts, salt), sketch(b_keys, parts, salt)), salt)
            return F.when(found.isNotNull(), found).otherwise(larger)

        first = F.when(used * 4 <= 3 * 3 * SLOTS * BASE_PARTS, peel(cells, F.lit(0)))
        return F.aggregate(F.sequence(F.lit(1), F.lit(TRIES)), first, again)

    exact = F.size(F.array_except(a_keys, b_keys)) + F.size(F.array_except(b_keys, a_keys))
    return F.coalesce(let(subtract(a_base, b_base), tried), exact)


def likeness(a_keys: Column, b_keys: Column, differ: Column) -> Column:
    both = F.size(a_keys) + F.size(b_keys)
    return F.when(both == 0, 1.0).otherwise((both - differ) / (both + differ).cast("double"))


def as_text(keys: Column, base: Column) -> Column:
    """The fingerprint: number of digests, and the cells as hexadecimal numbers."""
    cells = F.flatten(F.transform(base, lambda part: F.transform(part, lambda c: F.concat_ws(
        ".", F.hex(c["c"].cast("long")), F.hex(c["k"]), F.hex(c["h"])))))
    return F.concat_ws("-", F.size(keys).cast("string"), F.concat_ws("-", cells))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and next_text: the text of the next document, after the last that of the first."""
    bounds = range_bounds(docs, "doc_id", 2 * ranges_for(docs.sparkSession))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       range_of("doc_id", bounds).alias("range"))
    # one row per range, of which there are MAX_RANGES at most
    heads = rows.groupBy("range").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("f"))
    firsts = sorted((r["range"], r["f"]["doc_id"]) for r in heads.collect()) if bounds else [
        (r["range"], r["f"]["doc_id"]) for r in heads.collect()]
    if not firsts:
        return rows.select("doc_id", "text", F.lit("").alias("next_text"))
    numbers = [n for n, _ in firsts]
    before = {n: numbers[i - 1] for i, n in enumerate(numbers)}  # of the first range: the last
    is_first = F.lit(False)
    for n, doc_id in firsts:
        is_first = is_first | ((F.col("range") == n) & F.col("doc_id").eqNullSafe(F.lit(doc_id).cast("long")))
    previous = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), F.col("range"))
    own = F.struct(F.col("range"), F.lit(False).alias("extra"))
    dealt = F.when(is_first, F.array(own, F.struct(previous.alias("range"), F.lit(True).alias("extra")))
                   ).otherwise(F.array(own))
    dealt = rows.select("doc_id", "text", F.explode(dealt).alias("to")).select("doc_id", "text", "to.*")
    order = Window.partitionBy("range").orderBy("extra", F.col("doc_id").asc_nulls_first(), "text")
    return (dealt.withColumn("next_text", F.lead("text").over(order)).filter(~F.col("extra"))
            .select("doc_id", "text", "next_text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    rows = with_next(docs)
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("edited", F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - quarter).cast("int")), F.substring("next_text", F.lit(1), quarter)))
    parts, salt = F.lit(BASE_PARTS), F.lit(0)
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       digests(F.col("text")).alias("own"), digests(F.col("edited")).alias("changed"),
                       digests(F.col("next_text")).alias("next"))
    rows = rows.select("*", sketch(F.col("own"), parts, salt).alias("own_base"),
                       sketch(F.col("changed"), parts, salt).alias("changed_base"),
                       sketch(F.col("next"), parts, salt).alias("next_base"))
    return rows.select(
        "*", differing(F.col("own"), F.col("changed"), F.col("own_base"), F.col("changed_base")).alias("d_edited"),
        differing(F.col("own"), F.col("next"), F.col("own_base"), F.col("next_base")).alias("d_next"),
    ).select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("own"), F.col("own_base")).alias("fingerprint"),
        as_text(F.col("changed"), F.col("changed_base")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed"), F.col("d_edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("next"), F.col("d_next")).alias("near_next"))


def op2_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))
