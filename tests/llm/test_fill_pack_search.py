"""Fill-in-the-middle, best-two-fit packing and ranked search against plain code."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import compare, connect

from gaugelake.llm import best_two_fit, encoding, fill_in_middle, max_sketches
from gaugelake.llm.shared import Scratch

SF_DIR = "/root/testdata/sf0.001"


def plain_fill(doc_id, text, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = marks
    if not text or any(k in text for k in marks) or h[2] % 100 >= 90:
        return (n, "plain", None, None, text)
    if h[3] % 100 < 20:
        return (n, "spm", a, b - a, f"{s}{suffix}{p}{prefix}{m}{middle}")
    return (n, "psm", a, b - a, f"{p}{prefix}{s}{suffix}{m}{middle}")


MARKED = ["a<P>b", "<S>", "x<M", "<P", ">", "<" * 50, "<P<S<M>", "<<P>>", "é<S>日", "<P>" * 40]


@pytest.mark.parametrize("window", [3, 1 << 20])
@pytest.mark.parametrize("marks", [fill_in_middle.Marks(), fill_in_middle.Marks("[pre]", "{suffix}", "|m>")])
def test_transform(rows, window, marks, monkeypatch):
    monkeypatch.setattr(fill_in_middle, "WINDOW", window)
    names = (marks.prefix, marks.suffix, marks.middle)
    texts = [t for _, t, *_ in rows if t is None or len(t) < 3000] + MARKED + ["|m", "[pre", "é日本𝄞" * 30]
    draws = []
    for i in range(len(texts)):
        digest = hashlib.sha256(f"1:{i}".encode()).hexdigest()
        draws.append([int(digest[k:k + 8], 16) for k in (0, 8, 16, 24)])
    import pyarrow as pa
    flat = fill_in_middle.flat(pa.array(texts, pa.string()))
    made = fill_in_middle.transform(*flat, np.array(draws), 90, 20, marks.as_bytes())
    outputs = fill_in_middle.strings(made["data"], made["bounds"]).to_pylist()
    for i, text in enumerate(texts):
        n, form, prefix, middle, output = plain_fill(i, text, names)
        assert (made["n"][i], fill_in_middle.FORMS[made["form"][i]], outputs[i]) == (n, form, output)
        assert form == "plain" or (made["prefix"][i], made["middle"][i]) == (prefix, middle)
    back = fill_in_middle.inverse(made["data"], made["bounds"], made["form"], marks.as_bytes())
    assert fill_in_middle.strings(*back).to_pylist() == [t or "" for t in texts]


def test_marks_that_overlap():
    for bad in (("<P>", "<P>x", "<M>"), ("ab", "bc", "d"), ("", "s", "m"), ("a", "a", "b"), ("|m|", "s", "p")):
        with pytest.raises(ValueError):
            fill_in_middle.Marks(*bad)


def test_fill_in_middle(spark, with_repeats, empty):
    made = fill_in_middle.restore(fill_in_middle.fill_in_middle(with_repeats))
    got = Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made.collect())
    source = with_repeats.select("doc_id", "text").collect()
    assert got == Counter((r.doc_id, *plain_fill(r.doc_id, r.text)) for r in source)
    assert Counter(r.restored for r in made.collect()) == Counter(r.text or "" for r in source)
    assert fill_in_middle.restore(fill_in_middle.fill_in_middle(empty)).collect() == []


def test_restore_refuses_other_texts(spark):
    for output in ("no marks at all", "<P>a<S>b", "<P>a<S>b<M>c<M>d"):
        wrong = spark.createDataFrame([("psm", output)], "form string, output string")
        with pytest.raises(Exception, match="each mark once"):
            fill_in_middle.restore(wrong).collect()


def test_fill_in_middle_equals_sql(spark):
    result = fill_in_middle.op11_displacement_fill_in_middle(spark, SF_DIR)
    assert compare(result, connect(SF_DIR), fill_in_middle.OP11_SQL) is None


def plain_best_two_fit(lengths, capacity):
    """One bin after the other, from the list of all pieces, trying all pairs."""
    left, bins = sorted(lengths, reverse=True), []
    while left:
        held, gap = [], capacity
        for n in list(left):
            if n <= gap:
                held.append(n)
                left.remove(n)
                gap -= n
        while gap:
            smallest = min(held)
            best = 0
            for i, a in enumerate(left):
                for b in left[i + 1:]:
                    if smallest < a + b <= smallest + gap and a + b > best:
                        best, pair = a + b, (a, b)
            if not best:
                break
            # of pairs with an equal sum the one with the smallest piece
            pair = min((b, a) for i, a in enumerate(left) for b in left[i + 1:] if a + b == best)
            held.remove(smallest)
            for n in pair:
                left.remove(n)
            left = sorted([*left, smallest], reverse=True)
            held += pair
            gap += smallest - best
        bins.append(tuple(sorted(held, reverse=True)))
    return bins


@pytest.mark.parametrize("seed", range(12))
def test_patterns_equal_bins_made_one_by_one(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 30, 64])
    lengths = [rng.choice([rng.randint(1, capacity), rng.randint(1, 6), capacity // 3 + 1]) for _ in range(rng.randint(1, 90))]
    patterns = best_two_fit.best_two_fit(Counter(lengths), capacity)
    made = [p.lengths for p in patterns for _ in range(p.times)]
    assert made == plain_best_two_fit(lengths, capacity)


def test_patterns_do_not_grow_with_the_input():
    lengths = [1 + int(math.exp(random.Random(i).gauss(4, 1.2))) for i in range(20_000)]
    once = Counter(min(n, 512) for n in lengths)
    many = {n: k * 1_000_000 for n, k in once.items()}
    patterns = best_two_fit.best_two_fit(many, 512)
    used = Counter()
    for p in patterns:
        assert sum(p.lengths) <= 512
        for n in p.lengths:
            used[n] += p.times
    assert used == many and len(patterns) < 512 * (1 + math.log(512))
    total = sum(n * k for n, k in many.items())
    assert sum(p.times for p in patterns) <= 1.001 * total / 512
    with pytest.raises(ValueError):
        best_two_fit.best_two_fit({513: 1}, 512)


@pytest.mark.parametrize("capacity,block_rows", [(4096, 250_000), (64, 40)])
def test_packed(spark, with_repeats, empty, capacity, block_rows, monkeypatch):
    from tokenizers import Tokenizer
    monkeypatch.setattr(best_two_fit, "BLOCK_ROWS", block_rows)
    path = encoding.public_path(best_two_fit.TOKENIZER)
    pieces = Scratch(spark, "t").save(best_two_fit.token_pieces(with_repeats, path, capacity=capacity, with_ids=True), "p")
    packed = Scratch(spark, "t").save(best_two_fit.pack(pieces, capacity), "q")
    got = packed.collect()
    whole = Tokenizer.from_file(path)
    wanted = Counter()
    for r in with_repeats.select("doc_id", "text").collect():
        ids = np.array([*whole.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        for number, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start:start + capacity]
            wanted[r.doc_id, number, start, len(part), zlib.crc32(part), tuple(part.tolist())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in got) == wanted
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(bins) == list(range(len(bins)))
    assert len(bins) == sum(p.times for p in best_two_fit.best_two_fit(Counter(r.length for r in got), capacity))
    filled = {r.sequence_id: len(r.ids) for r in best_two_fit.sequences(packed).collect()}
    assert filled == {i: sum(n for _, n in parts) for i, parts in bins.items()}
    again = best_two_fit.pack(pieces.repartition(5), capacity).collect()
    key = lambda r: (str(r.doc_id), r.piece, r.sequence_id, r.offset)
    assert sorted(map(key, got)) == sorted(map(key, again))
    none = Scratch(spark, "t").save(best_two_fit.token_pieces(empty, path), "p")
    assert best_two_fit.pack(none).collect() == []


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms_of(text):
    return re.findall(TERM, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, queries, k):
    counted = [(d, Counter(terms_of(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, all_terms = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for item, text in set(queries):
        asked.setdefault(item, Counter()).update(terms_of(text))
    out = {}
    for item, wanted in asked.items():
        scored = []
        for d, c in counted:
            m = 75 + 25 * c.total() * n_docs // all_terms
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, times in wanted.items() if t in c)
            if score:
                scored.append((-score, d is None, d or 0, d))
        out[item] = [(r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return {i: v for i, v in out.items() if v}


def test_a_sketch_bounds_every_frequency():
    rng = np.random.default_rng(4)
    for n in (0, 1, 3, 40, 5000):
        hashes = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        counts = rng.geometric(0.02, len(hashes)) * rng.choice([1, 1, 1, 9000], len(hashes))
        sketch = max_sketches.sketch_of(hashes, counts)
        cells = max_sketches.spread([sketch])[:, 0]
        one, two = max_sketches._two_cells(hashes, sketch.width)
        bound = max_sketches._SCALE[np.minimum(cells[one], cells[two])]
        assert (bound >= counts).all() and sketch.n == counts.sum()
        full = np.zeros(sketch.width, np.uint8)
        for places in (one, two):
            np.maximum.at(full, places, np.searchsorted(max_sketches._SCALE, counts).astype(np.uint8))
        assert (cells == full).all()


@pytest.mark.parametrize("k,first,block,wide", [(20, 64, 50_000, 32), (3, 3, 40, 32), (5, 5, 200, 1)])
def test_search(spark, with_repeats, rows, empty, k, first, block, wide, monkeypatch):
    """Also with narrow sketches, whose bounds are loose, and with many blocks of queries."""
    monkeypatch.setattr(max_sketches, "BLOCK_TERMS", block)
    rng = random.Random(2)
    words = [w for r in rows for w in terms_of(r[1])]
    queries = [(i, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for i in range(12)]
    queries += [(20, None), (21, ""), (22, "zzz qqq"), (23, "Hill hill HILL"), (23, "Hill hill HILL"), (24, "river"),
                (24, "light light"), (None, "stone garden"), (25, "日本 é"), (26, "w" * 20_000 + " river")]
    asked = spark.createDataFrame(queries, "item_id long, text string")
    monkeypatch.setattr(max_sketches, "CELLS", wide)
    found = max_sketches.search(with_repeats, asked, k, first=first).collect()
    got = {}
    for r in sorted(found, key=lambda r: r.rank):
        got.setdefault(r.item_id, []).append((r.rank, r.doc_id, r.score))
    assert got == plain_search([(r.doc_id, r.text) for r in with_repeats.select("doc_id", "text").collect()], queries, k)
    assert max_sketches.search(empty, asked).collect() == []
    assert max_sketches.search(with_repeats, asked.limit(0)).collect() == []


def test_search_beyond_what_is_broadcast(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(max_sketches, "SMALL_ROWS", 1)
    found = max_sketches.search(docs, spark.createDataFrame([("a", "river stone")], "item_id string, text string"), 4).collect()
    plain = plain_search([(r[0], r[1]) for r in rows], [("a", "river stone")], 4)
    assert [(r.rank, r.doc_id, r.score) for r in sorted(found, key=lambda r: r.rank)] == plain["a"]


def test_search_equals_sql(spark):
    con = connect(SF_DIR)
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF_DIR}/benchmark.parquet'")
    assert compare(max_sketches.op13_max_sketch_search(spark, SF_DIR), con, max_sketches.OP13_SQL) is None


@pytest.mark.parametrize("kind, name", [("byte", "byte_bpe_50k.json"), ("word", "word_bpe_49k.json")])
def test_forgotten_words_are_found_again(kind, name):
    own = encoding.encoder(encoding.public_path(name), kind)
    texts = ["one river stone,\nover the winter", "a  letter"]
    first = [own.encode(t).tolist() for t in texts]
    pieces = [own.pieces] if kind == "word" else [own.first, own.rest]
    assert any(p.recent for p in pieces)
    own.forget()
    assert not any(p.recent or p.older or p.signs for p in pieces)
    assert [own.encode(t).tolist() for t in texts] == first
