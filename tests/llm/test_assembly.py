"""Mixing, token files, packing, quality rules and the pipeline."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from compare import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from gaugelake.llm import encoding, host_quality, mixing, packing, token_files
from gaugelake.llm.shared import Scratch, running_before

ODD = ["", " ", "\n", "a  b", " a", "a\n\nb", "x\ty", "don't we'll I'VE", "a<|endoftext|>b <|endoftext|> c",
       "ÀÉß µª ² naïve", "é café", "日本 語。", "a.b, c!! d's (x) __x", "İstanbul ΣΑΣ", "12 3.4 a1 1a", "a\x1cb c"]


@pytest.mark.parametrize("kind,name", [("word", token_files.TOKENIZER), ("byte", packing.TOKENIZER)])
def test_encoding_equals_the_tokenizer(rows, kind, name):
    from tokenizers import Tokenizer
    own, whole = encoding.encoder(encoding.public_path(name), kind), Tokenizer.from_file(encoding.public_path(name))
    for text in ODD + [r[1] or "" for r in rows]:
        assert own.encode(text).tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("kind,name", [("word", token_files.TOKENIZER), ("byte", packing.TOKENIZER)])
def test_encoding_of_batches(kind, name, monkeypatch):
    """Batches of odd texts, with a memory and windows so small that both are cut often."""
    from tokenizers import Tokenizer
    monkeypatch.setattr(encoding, "MOST", 20)
    monkeypatch.setattr(encoding, "GATHERED", 7)
    path = encoding.public_path(name)
    whole, rng = Tokenizer.from_file(path), random.Random(11)
    own = {"word": encoding.WordEncoder, "byte": encoding.ByteEncoder}[kind](whole)
    letters = list(" \n\n  abcABthe'.,!éÀß日\t <|1²")
    for _ in range(300):
        texts = [rng.choice([None, "", "".join(rng.choices(letters, k=rng.randint(0, 25)))]) for _ in range(rng.randint(0, 6))]
        got = own.encode_all(pa.array(texts, pa.string()))
        assert [ids.tolist() for ids in got] == [whole.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_water_filling_and_balance(spark):
    rng = random.Random(1)
    made = [(i, "w " * rng.randint(0, 300), rng.choice(["a", "b", "b", "b", "b", "c", None])) for i in range(3000)]
    docs = spark.createDataFrame(made, "doc_id long, text string, source string")
    got = mixing.sample(docs, Scratch(spark, "t")).toPandas()
    assert len(got) == 3000 and (got.times <= 2).all()
    sizes = Counter()
    for _, text, source in made:
        sizes[source] += len(text) // 2
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, full = {}, set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        each = left / sum(weight[s] for s in order if s not in full)
        target = {s: 2 * sizes[s] if s in full else each * weight[s] for s in order}
        more = {s for s in order if target[s] > 2 * sizes[s]}
        if not more:
            break
        full |= more
    by = got.assign(taken=got["size"] * got.times).groupby("source_size").agg(t=("target", "first"), k=("taken", "sum"))
    for s in order:
        assert by.t[sizes[s]] == pytest.approx(target[s])
        assert by.k[sizes[s]] == pytest.approx(target[s], rel=0.002)
    for split in (docs.repartition(7, "text"), docs.repartition(2), docs.sort("text")):
        again = mixing.sample(split, Scratch(spark, "t")).toPandas()
        assert again.sort_values("id").times.tolist() == got.sort_values("id").times.tolist()


def test_few_long_documents_come_near_their_target(spark):
    rng = random.Random(2)
    made = [(i, "w " * (rng.choice([5, 20, 3000, 5000]) + rng.randint(0, 60)), f"s{i % 4}") for i in range(200)]
    got = mixing.sample(spark.createDataFrame(made, "doc_id long, text string, source string"), Scratch(spark, "t")).toPandas()
    by = got.assign(taken=got["size"] * got.times).groupby("source").agg(t=("target", "first"), k=("taken", "sum"))
    assert (abs(by.k - by.t) <= 0.002 * by.t + 1).all()


def test_equal_rows_share_what_is_taken(spark):
    made = [(i // 3, "w " * (10 + i // 3), "a", i) for i in range(300)] + [(500, "w " * 400, "b", 0)]
    docs = spark.createDataFrame(made, "doc_id long, text string, source string, extra long")
    taken = mixing.sample(docs, Scratch(spark, "t")).toPandas()
    times = {int(k): int(v) for k, v in taken.groupby("id").times.sum().items()}
    mixed = mixing.mix(docs).toPandas()
    assert {k: v for k, v in times.items() if v} == mixed.groupby("doc_id").size().to_dict()
    assert mixed.groupby(["doc_id", "extra"]).size().max() <= 2


def test_flight_keeps_both_totals():
    rng = random.Random(3)
    sizes = [rng.randint(1, 500) for _ in range(400)]
    shares = [0.3] * 400
    p = mixing.flight(sizes, shares, rng)
    assert sum(p) == pytest.approx(120) and sum(map(float.__mul__, p, map(float, sizes))) == pytest.approx(0.3 * sum(sizes))
    assert sum(0 < x < 1 for x in p) <= mixing.SPARE + 2


def test_mix(with_repeats, empty):
    taken = mixing.sample(with_repeats, Scratch(with_repeats.sparkSession, "t")).toPandas()
    mixed = mixing.mix(with_repeats)
    assert mixed.columns == with_repeats.columns and mixed.count() == taken.times.sum()
    assert mixing.mix(empty).collect() == []


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 31, 32])
def test_packed_bits(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1000, dtype=np.uint64).astype(np.uint32)
    data = token_files.pack(ids, bits)
    assert len(data) == -(-1000 * bits // 8)
    for start, count in [(0, 1000), (0, 0), (7, 1), (13, 500), (999, 1)]:
        assert (token_files.unpack(data, bits, start, count) == ids[start:start + count]).all()


def test_token_files(spark, docs, rows, with_repeats, empty):
    from tokenizers import Tokenizer
    path = encoding.public_path(token_files.TOKENIZER)
    blocks = Scratch(spark, "t").save(token_files.write_blocks(docs, path), "b")
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_index(blocks).collect()}
    whole, before, wanted = Tokenizer.from_file(path), 0, {}
    for row in sorted(rows):
        ids = np.array([*whole.encode(row[1] or "", add_special_tokens=False).ids, 2], "<u4")
        wanted[row[0]] = (before, len(ids), zlib.crc32(ids))
        before += len(ids)
    assert got == wanted
    block = blocks.orderBy("shard", "block").first().data
    assert zlib.crc32(token_files.read_document(block, 1).astype("<u4")) == wanted[3][2]
    both = Scratch(spark, "t").save(token_files.write_blocks(with_repeats, path), "b")
    assert token_files.read_index(both).count() == with_repeats.count()
    none = Scratch(spark, "t").save(token_files.write_blocks(empty, path), "b")
    assert token_files.read_index(none).collect() == []


def test_workers_keep_no_words_of_token_files(rows):
    batch = pa.table({"shard": pa.array([0] * len(rows), pa.int32()), "doc_id": pa.array([r[0] for r in rows], pa.int64()),
                      "text": pa.array([r[1] for r in rows], pa.string())}).to_batches()[0]

    class InThisProcess:
        """Runs the task of mapInArrow here, on the batch above."""

        def select(self, *columns):
            return self

        def mapInArrow(self, task, schema):
            return list(task(iter([batch, batch])))

    path = encoding.public_path(token_files.TOKENIZER)
    own = encoding.encoder(path, "word")
    found = token_files.encode_documents(InThisProcess(), path, "word", token_files.END_ID, 16)
    assert not (own.pieces.recent or own.pieces.older or own.pieces.signs)
    ids = [raw for part in found for raw in part.column("ids").to_pylist()]
    wanted = [np.append(own.encode(r[1] or ""), token_files.END_ID).astype("<u2").tobytes() for r in rows]
    assert ids == wanted * 2


def test_running_before(spark):
    rng = random.Random(1)
    made = [(rng.choice([None, *range(60)]), rng.randint(0, 9), i) for i in range(300)]
    df = Scratch(spark, "t").save(spark.createDataFrame(made, "k long, v long, i long"), "r")
    got = running_before(df, "k", "v", "before", 7).collect()
    before = 0
    for r in sorted(got, key=lambda r: (r.k is not None, r.k or 0, r.v, r.i)):
        assert r.before == before
        before += r.v


def plain_check(pieces, limits):
    by_doc, by_sequence = {}, {}
    for doc_id, start, length, _, total, sequence, offset in pieces:
        by_doc.setdefault((doc_id, total), []).append((start, length))
        by_sequence.setdefault(sequence, []).append((offset, length))
    for (_, total), parts in by_doc.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == total
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limits.tokens and len(parts) <= limits.segments
    return [sum(n for _, n in p) for p in by_sequence.values()]


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(64, 3, 64), packing.Limits(100, 50, 20)])
def test_packer(limits):
    rng = random.Random(7)
    packer, out = packing.Packer(limits), []
    loss = {}
    for i in range(500):
        n = rng.choice([1, 2, 5, 30, 90, 700])
        loss[i] = rng.randint(0, n) if limits.loss < limits.tokens else n
        out += packer.add(packing.Example(i, np.arange(n, dtype=np.uint32), 0, n, loss[i]))
    out += packer.finish()
    filled = plain_check(out, limits)
    totals = Counter()
    for doc_id, start, length, _, total, sequence, _ in out:
        totals[sequence] += max(0, start + length - max(start, total - loss[doc_id]))
    assert max(totals.values()) <= limits.loss
    if limits == packing.Limits():
        assert all(n == limits.tokens or n & (n - 1) == 0 for n in filled)


def test_packer_without_cuts():
    rng = random.Random(8)
    packer, out = packing.Packer(packing.Limits(128, 6, 60), cut=False), []
    for i in range(400):
        n = rng.randint(1, 90)
        out += packer.add(packing.Example(i, np.arange(n, dtype=np.uint32), 0, n, min(60, n // 2)))
    out += packer.finish()
    assert len(out) == 400
    filled = plain_check(out, packing.Limits(128, 6, 60))
    assert sum(filled) / len(filled) > 100
    with pytest.raises(ValueError):
        list(packer.add(packing.Example(1, np.zeros(200, np.uint32), 0, 200, 1)))


def test_packed_documents(with_repeats, rows, docs, empty):
    path = encoding.public_path(packing.TOKENIZER)
    assert packing.pack_documents(empty, path).collect() == []
    pieces = [tuple(r) for r in packing.pack_documents(docs, path).collect()]
    assert all(n == 2048 or n & (n - 1) == 0 for n in plain_check(pieces, packing.Limits()))
    assert {p[0] for p in pieces} == {r[0] for r in rows}
    own = encoding.encoder(path, "byte")
    ids = {r[0]: np.append(own.encode(r[1] or ""), 1).astype("<u4") for r in rows}
    for doc_id, start, length, crc, total, *_ in pieces:
        assert total == len(ids[doc_id]) and crc == zlib.crc32(ids[doc_id][start:start + length].copy())
    repeated = packing.pack_documents(with_repeats, path).collect()
    assert sum(r.length for r in repeated) > sum(p[2] for p in pieces)


def plain_measures(text):
    import re
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if seen[tuple(words[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def test_measures(docs, rows):
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
           for r in host_quality.measured(docs).collect()}
    assert got == {r[0]: plain_measures(r[1]) for r in rows}


def test_bad_hosts_go(spark):
    good = "these are twenty good words of one plain text that nobody would ever want to reject for any such reason at all"
    made = [(i, good if host != "bad" or i % 3 == 0 else "short", host)
            for i, host in enumerate(["bad"] * 300 + ["fine"] * 300 + ["small"] * 2)] + [(700, "short", "new")]
    docs = spark.createDataFrame(made, "doc_id long, text string, source string")
    kept = {r.source for r in host_quality.keep_good(docs).collect()}
    assert kept == {"fine", "small"}


def test_quality_of_odd_tables(with_repeats, empty):
    assert host_quality.keep_good(empty).collect() == []
    assert host_quality.keep_good(with_repeats).columns == with_repeats.columns


def test_quality_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    result = host_quality.op8_host_quality(spark, sf_dir)
    assert compare(result, connect(sf_dir), host_quality.OP8_SQL) is None


def test_pipeline_keeps_columns_of_any_name(spark):
    """Columns named like what the stages work out, null ids, repeated rows and a very long text come through unchanged."""
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    names = ["n_words", "kept", "_words", "digest", "copy", "times", "size", "id", "label", "token", "count", "n", "row", "host"]
    given = source.withColumns({c: F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")) for c in names})
    long = given.limit(1).withColumns({"doc_id": F.lit(10**12), "text": F.concat_ws(
        " ", F.transform(F.sequence(F.lit(1), F.lit(60_000)), lambda i: F.concat(F.lit("word"), (i % 997 * (i % 9973)).cast("string"))))})
    unnamed = given.limit(2).withColumn("doc_id", F.lit(None).cast("long"))
    given = Scratch(spark, "t").save(given.union(given.limit(3)).union(long).union(unnamed), "given")
    table = given
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, table = table, Scratch(spark, "t").save(stage(spark, table, ""), name)
        assert table.columns == given.columns and table.dtypes == given.dtypes
        kept = [c for c in given.columns if c not in ("text", "n_chars")]  # a redacted text has another length
        assert table.select(kept).distinct().exceptAll(before.select(kept).distinct()).count() == 0
    assert table.filter(f"doc_id = {10**12}").count() <= 2
    packed = corpus_pipeline.STAGES[-1][1](spark, table, "")
    assert packed.columns == packing.COLUMNS and packed.count() > 0


def test_pipeline(spark, docs, empty):
    scratch = Scratch(spark, "t")
    table, kept = spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES:
        kept = scratch.save(stage(spark, table, "/root/testdata/sf0.001"), name)
        if name != "packing":
            assert kept.columns == table.columns
            table = kept
    assert kept.columns == packing.COLUMNS
    assert {r.doc_id for r in kept.select("doc_id").distinct().collect()} \
        == {r.doc_id for r in table.select("doc_id").distinct().collect()}
    held = empty
    for name, stage in corpus_pipeline.STAGES:
        held = scratch.save(stage(spark, held, ""), f"{name}-empty")
    assert held.collect() == []
