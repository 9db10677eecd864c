"""Quality rules with host-level verdicts, in DataFrame operations only.

Every document is measured (words, symbols, repeated lines, words in repeated 8-word windows) and held against the
rules. The failures are summed up by host; a host's failure rate is shrunk towards the mean of all hosts with a
beta prior fitted to the rates of the hosts (method of moments), so a host of few documents is judged by the prior and
a large one by itself. Documents of a host whose shrunk rate exceeds HOST_LIMIT go, as do those that fail a base rule.

A host is the ``source``; the sums are combined before the shuffle, so a host with a third of all rows is one row
per task. Windows are compared by 64-bit hashes within a document.

Defined cases: a null or empty text has no words and fails the base rules; a null source is a host of its own;
repeated rows count as documents; a null doc_id is kept; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugelake.llm.shared import WHITE, Scratch, documents

SPACES = " \t\n\x0b\x0c\r"  # fixed: what separates words
SYMBOLS = r"[#*$%&|<>]"  # fixed
WINDOW_WORDS = 8  # fixed
LEAST_WORDS = 20  # fixed
MOST_REPEATED = 30  # fixed, percent of words
MOST_SYMBOLS = 25  # percent of the characters in words; counts against the host only
MOST_DUP_LINES = 50  # percent of lines with a word; counts against the host only
HOST_LIMIT = 0.5
STRONGEST = 1e6  # documents the prior counts for at most

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more."""
    def spans(ordered: Column) -> Column:
        def repeated(entry: Column, at: Column) -> Column:
            same = ((F.get(ordered, at - 1)["h"] == entry["h"])
                    | (F.get(ordered, at + 1)["h"] == entry["h"]))
            return F.when(same, entry["at"])

        starts = F.array_sort(F.filter(F.transform(ordered, repeated), lambda at: at.isNotNull()))
        nothing = F.struct(F.lit(0).alias("words"), F.lit(0).alias("until"))
        return F.aggregate(starts, nothing, lambda done, at: F.struct(
            (done["words"] + at + WINDOW_WORDS - F.greatest(done["until"], at)).alias("words"),
            (at + WINDOW_WORDS).alias("until")), lambda done: done["words"])

    ordered = F.array_sort(F.transform(hashes, lambda h, at: F.struct(h.alias("h"), at.alias("at"))))
    return _let(ordered, spans)


def measured(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` and the measures."""
    text = F.coalesce("text", F.lit(""))
    inner = F.btrim(text, F.lit(SPACES))
    no_words = F.array().cast("array<string>")
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    rows = docs.withColumns({
        "_words": F.when(inner == "", no_words).otherwise(F.split(inner, WHITE)),
        "_lines": lines,
        "word_chars": (F.length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
    })
    windows = F.transform(
        F.sequence(F.lit(1), F.size("_words") - (WINDOW_WORDS - 1)),
        lambda at: F.xxhash64(F.slice(F.col("_words"), at, WINDOW_WORDS)))
    rows = rows.withColumns({
        "n_words": F.size("_words").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_hashes": F.when(F.size("_words") > WINDOW_WORDS, windows),
    })
    some = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    rows = rows.withColumn("_n_lines", F.size("_lines")).withColumn(
        "n_repeat_words", F.when(some, _covered(F.col("_hashes"))).otherwise(0).cast("long"))
    return rows.drop("_words", "_lines", "_hashes")


def base_failed() -> Column:
    return ((F.col("n_words") < LEAST_WORDS)
            | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def any_failed() -> Column:
    return (base_failed() | (100 * F.col("n_symbols") > MOST_SYMBOLS * F.col("word_chars"))
            | (100 * F.col("n_dup_lines") > MOST_DUP_LINES * F.col("_n_lines")))


def host_verdicts(measures: DataFrame) -> DataFrame:
    """host, documents, failures, shrunk rate and whether the host is rejected."""
    hosts = measures.groupBy(F.col("source").alias("host")).agg(
        F.count("*").alias("n"), F.sum(any_failed().cast("long")).alias("failed"))
    rate = F.col("failed") / F.col("n")
    prior = hosts.agg(F.avg(rate).alias("mean"), F.var_pop(rate).alias("spread"),
                      F.avg(1 / F.col("n")).alias("per"))
    variance = F.col("mean") * (1 - F.col("mean"))
    between = F.col("spread") - variance * F.col("per")  # without what chance adds to the rates of small hosts
    strength = F.when(between > 0, F.greatest(F.lit(1.0), F.least(F.lit(STRONGEST), F.try_divide(
        variance, between) - 1))).otherwise(STRONGEST)
    prior = prior.select("mean", strength.alias("strength"))
    shrunk = (F.col("failed") + F.col("mean") * F.col("strength")) / (F.col("n") + F.col("strength"))
    # one row of numbers joins the hosts
    return (hosts.join(F.broadcast(prior)).withColumn("rate", shrunk)
            .withColumn("rejected", F.col("rate") > HOST_LIMIT)
            .select("host", "n", "failed", "rate", "rejected"))


def with_verdicts(measures: DataFrame, hosts: DataFrame) -> DataFrame:
    bad = hosts.filter("rejected").select("host", F.lit(True).alias("_bad"))
    held = measures.join(bad, measures["source"].eqNullSafe(bad["host"]), "left")
    return held.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & F.col("_bad").isNull())


def _narrow(docs: DataFrame) -> DataFrame:
    return measured(docs.select("doc_id", "text", "source")).select("doc_id", "source", "_n_lines", *MEASURES)


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns; each text is measured again, so no text is shuffled.

    The row number keeps Spark from moving the filter below the measures, where each part of the condition, and each
    word of a window, would split the text again.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    hosts = scratch.save(host_verdicts(_narrow(docs)), "hosts")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # the input row is carried as a whole, so a column of it may have the name of a measure
    rows = measured(docs.select("text", "source", F.struct(*columns).alias("_input")))
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    return with_verdicts(rows, hosts).filter("kept and _row >= 0").select("_input.*")


def op8_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "quality")
    measures = scratch.save(_narrow(documents(spark, sf_dir)), "measures")
    hosts = scratch.save(host_verdicts(measures), "hosts")
    return with_verdicts(measures, hosts).select("doc_id", *MEASURES, "base_failed", "kept")


# The SQL twin writes the rules out again. Windows are compared as text, positions are listed one by one.
OP8_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), split AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM docs
), windows AS (
  SELECT r, pos, array_to_string(words[pos:pos + 7], ' ') AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS pos FROM split WHERE len(words) >= 8)
), repeated AS (
  SELECT r, pos FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(pos, pos + 8)) AS p FROM repeated) GROUP BY r
), measures AS (
  SELECT s.r, doc_id, source, len(words) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
         coalesce(c.n, 0) AS n_repeat_words
  FROM split s LEFT JOIN covered c ON s.r = c.r
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         100 * n_symbols > 25 * word_chars OR 100 * n_dup_lines > 50 * n_lines AS other_failed
  FROM measures
), hosts AS (
  SELECT source, count(*) AS n, count(*) FILTER (base_failed OR other_failed) AS failed FROM judged GROUP BY source
), prior AS (
  SELECT avg(failed / n) AS m, var_pop(failed / n) AS v, avg(1 / n) AS per FROM hosts
), strength AS (
  SELECT m, CASE WHEN v - m * (1 - m) * per > 0
                 THEN greatest(1, least(1e6, m * (1 - m) / (v - m * (1 - m) * per) - 1)) ELSE 1e6 END AS s FROM prior
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND (h.failed + m * s) / (h.n + s) <= 0.5 AS kept
FROM judged j JOIN hosts h ON j.source IS NOT DISTINCT FROM h.source CROSS JOIN strength
"""
