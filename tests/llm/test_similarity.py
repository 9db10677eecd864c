"""The n-gram join and the fingerprints against plain loops."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugelake.llm import fingerprints, ngram_join, shared
from gaugelake.llm.shingles import shingle_sets


def plain_set(text, words):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not found:
        return set()
    return {tuple(found[i:i + words]) for i in range(max(1, len(found) - words + 1))}


def plain_components(sets, percent):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("words,percent,reach", [(3, 90, 100), (5, 80, 25), (2, 60, 50)])
def test_join(docs, rows, words, percent, reach):
    sets = {r[0]: plain_set(r[1], words) for r in rows}
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in ngram_join.near_duplicates(docs, words, percent, reach).collect()}
    parts = plain_components(sets, percent)
    assert got == {i: (len(s), parts[i]) for i, s in sets.items()}
    assert any(i != c for i, c in parts.items())


@pytest.mark.parametrize("long_list,few", [(8, 16), (2, 1), (2, 2)])
def test_random_near_copies(spark, long_list, few, monkeypatch):
    """Also where nearly every list counts as long, and documents seldom have one of their few n-grams in common."""
    monkeypatch.setattr(ngram_join, "LONG_LIST", long_list)
    monkeypatch.setattr(ngram_join, "FEW", few)
    rng = random.Random(5)
    base = [f"w{rng.randrange(40)}" for _ in range(60)]
    made = []
    for i in range(150):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = f"v{rng.randrange(30)}"
        made.append((i, " ".join(copy)))
    sets = {i: plain_set(t, 3) for i, t in made}
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(
        spark.createDataFrame(made, "doc_id long, text string"), 3, 90).collect()}
    assert got == plain_components(sets, 90)


def test_proportional_parity_never_exceeds_the_difference():
    rng = np.random.default_rng(6)
    for n in (1, 2, 31, 33, 700, 5000):
        for m in (n, max(1, n * 4 // 5), n // 2 + 1):
            shared = rng.integers(0, 2**63, m, dtype=np.uint64)
            a = np.unique(np.concatenate([shared, rng.integers(0, 2**63, n - m if n > m else 0, dtype=np.uint64)]))
            b = np.unique(np.concatenate([shared, rng.integers(0, 2**63, rng.integers(0, n + 1), dtype=np.uint64)]))
            bits = [ngram_join.parity_in_proportion(x) for x in (a, b)]
            difference = len(np.setxor1d(a, b))
            assert ngram_join.parity_difference(*bits) <= difference
            overlap = len(np.intersect1d(a, b))
            linked = 100 * overlap >= 80 * len(np.union1d(a, b))
            assert not linked or difference <= ngram_join.most_different(len(a), len(b), 80)
    far = [rng.integers(0, 2**63, 3000, dtype=np.uint64) for _ in range(2)]
    bits = [ngram_join.parity_in_proportion(x) for x in far]
    assert ngram_join.parity_difference(*bits) > ngram_join.most_different(3000, 3000, 80)


def test_bits_of_long_sets_lose_no_pair_and_tell_others_apart(spark):
    rng = np.random.default_rng(5)
    rows = []
    for n in (1, 399, 400, 500, 511, 520, 1000, 1030, 2040, 2100, 4000, 9000):
        base = rng.integers(0, 2**63, n, dtype=np.uint64)
        for changed in (0, n // 20, n // 10, n // 4, n):
            other = np.concatenate([base[changed:], rng.integers(0, 2**63, changed + n // 50, dtype=np.uint64)])
            common = len(np.intersect1d(base, other))
            linked = 100 * common >= 80 * (len(base) + len(other) - common)
            wide = [ngram_join.wide_parity(ngram_join.parity_in_proportion(x), len(x)).tolist() for x in (base, other)]
            rows.append((n, changed, linked, len(base), wide[0], len(other), wide[1]))
    pairs = spark.createDataFrame(rows, "at int, changed int, linked boolean, n int, wide array<long>, l_n int, l_wide array<long>")
    passes = ngram_join._wide_passes(F.col, lambda c: F.col(f"l_{c}"), 80)
    got = pairs.select("at", "changed", "linked", passes.alias("passes")).collect()
    assert sum(r["linked"] for r in got) > 20 and all(r["passes"] for r in got if r["linked"])
    assert not any(r["passes"] for r in got if r["changed"] == r["at"] and 500 <= r["at"] <= 4000)


def test_long_documents_with_a_common_passage_do_not_become_pairs(spark, monkeypatch):
    rng = random.Random(11)
    common = " ".join(f"c{i}" for i in range(300))
    rows = [(i, common + " " + " ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(900))) for i in range(12)]
    rows.append((12, rows[5][1].replace(" c150 ", " other ")))
    made, plain = [], ngram_join._pairs

    def counted(labelled, percent):
        pairs = plain(labelled, percent)
        made.append(pairs.distinct().count())
        return pairs

    monkeypatch.setattr(ngram_join, "_pairs", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in ngram_join.near_duplicates(docs, 5, 80, 25).collect()}
    assert found == {**{i: i for i in range(12)}, 12: 5}
    assert made == [0]


def test_join_of_odd_tables(with_repeats, empty):
    assert ngram_join.near_duplicates(empty, 3, 90).collect() == []
    got = [r for r in ngram_join.near_duplicates(with_repeats, 3, 90).collect()]
    assert len({r.doc_id for r in got}) == len(got)
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    kept = ngram_join.keep_one_of_each(with_repeats)
    assert kept.columns == with_repeats.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect() if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and kept.filter("doc_id is null").count() == 2
    whole = ngram_join.near_duplicates(with_repeats, 5, 80, 25)
    assert set(ids) == {r.doc_id for r in whole.filter("doc_id = component_id").collect()}


def test_shingles_of_long_words():
    long = "a" * (3 << 20)
    one, two = shingle_sets([f"x {long} y z", f"X {long.upper()}  Y z"], 3)
    assert len(one) == 2 and (one == two).all()


def pieces(text):
    size = fingerprints.PIECE
    return {line[i:i + size] for line in (text or "").split("\n") for i in range(0, len(line), size)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints(docs, rows):
    got = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
    ordered = sorted(rows)
    assert len(got) == len(rows)
    for k, row in enumerate(ordered):
        text, after = row[1] or "", ordered[(k + 1) % len(ordered)][1] or ""
        quarter = len(text) // 4
        edited = text[:len(text) - quarter] + after[:quarter]
        r = got[row[0]]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(jaccard(pieces(text), pieces(edited)))
        assert r.near_next == pytest.approx(jaccard(pieces(text), pieces(after)))
    same = {}
    for row in ordered:
        same.setdefault(frozenset(pieces(row[1])), set()).add(got[row[0]].fingerprint)
    assert all(len(v) == 1 for v in same.values())
    assert len({min(v) for v in same.values()}) == len(same)


def test_fingerprints_of_odd_tables(with_repeats, empty):
    assert fingerprints.fingerprints(empty).collect() == []
    assert fingerprints.fingerprints(with_repeats).count() == with_repeats.count()


def test_fingerprints_stay_in_the_jvm(docs):
    plan = fingerprints.fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_written_tables_leave_the_settings_and_can_be_made_again(spark):
    before = dict(spark.sparkContext.getConf().getAll()), spark.conf.get(shared._CLEANUP)
    counts = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    scratch = shared.Scratch(spark, "twice")
    first = scratch.save(counts, "first")
    again = scratch.save(counts, "again")  # its shuffle files are gone by now
    assert sorted(first.collect()) == sorted(again.collect()) == sorted(counts.collect())
    assert (dict(spark.sparkContext.getConf().getAll()), spark.conf.get(shared._CLEANUP)) == before
