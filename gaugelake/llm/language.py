"""Language identification with a byte convolutional network, trained and applied with numpy.

A text is lower-cased and cut into windows of WINDOW bytes. Each byte has a vector; filters of several widths slide over a
window, the largest response of each filter is kept, and a softmax layer gives the languages' probabilities.
The probabilities of the windows of a text are averaged by their bytes, so the whole text counts.

Training uses text and non-null lang of documents that are not held out, about PER_LANGUAGE documents per
language chosen by a hash of the doc_id (a bounded sample, which the driver holds), SPREAD windows of each.
A filter's response to a window is a sum of one number per byte of its width, so the trained layer becomes tables
over bytes and pairs of bytes, which tasks only look up and add.

Defined cases: a null text and one without a letter are ``und`` with score 0; without any labelled document so is
every text; with one language every text has that one; repeated rows are predicted alike; a null doc_id is not held
out, and not learnt from; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugelake.llm.shared import documents, text_batches

UNKNOWN = "und"  # fixed
FOLDS, HELD_OUT = 3, 1  # fixed: crc32(doc_id) mod 3
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16  # per width
VECTOR = 8
PER_LANGUAGE = 400
MOST_SAMPLED = 20_000  # documents the driver trains on at most, over all languages
SPREAD = 4
EPOCHS = 8
BATCH = 64
RATE = 0.01
SEED = 11
LETTER = re.compile(r"[^\W\d_]")


def windows(text: str) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a text, the last padded with zeros, and how many bytes each has."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    n = max(1, -(-len(data) // WINDOW))
    padded = np.zeros(n * WINDOW, np.uint8)
    padded[: len(data)] = data
    used = np.full(n, WINDOW)
    used[-1] = len(data) - (n - 1) * WINDOW
    return padded.reshape(n, WINDOW), used


class Network:
    def __init__(self, languages: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.vectors = rng.normal(0, 0.5, (256, VECTOR)).astype(np.float32)
        self.filters = [rng.normal(0, (w * VECTOR) ** -0.5, (w, VECTOR, FILTERS)).astype(np.float32) for w in WIDTHS]
        n = FILTERS * len(WIDTHS)
        self.bias = np.zeros(n, np.float32)
        self.out = rng.normal(0, n ** -0.5, (n, len(languages))).astype(np.float32)
        self.out_bias = np.zeros(len(languages), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.vectors, *self.filters, self.bias, self.out, self.out_bias]

    def forward(self, x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Places of the largest responses by width, the pooled values before and after rectifying."""
        e = self.vectors[x]
        places, pooled = [], []
        for w, f in zip(WIDTHS, self.filters, strict=True):
            n = WINDOW - w + 1
            r = sum(e[:, j: j + n] @ f[j] for j in range(w))
            at = r.argmax(axis=1)
            places.append(at)
            pooled.append(np.take_along_axis(r, at[:, None], axis=1)[:, 0])
        values = np.concatenate(pooled, axis=1) + self.bias
        return places, values, np.maximum(values, 0)

    def train(self, x: np.ndarray, y: np.ndarray) -> None:
        """Minimise the cross entropy with Adam."""
        rng = np.random.default_rng(SEED)
        params = self.parameters()
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for lo in range(0, len(x), BATCH):
                rows = order[lo: lo + BATCH]
                gradients = self._gradients(x[rows], y[rows])
                step += 1
                for p, g, m, v in zip(params, gradients, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        places, values, hidden = self.forward(x)
        wrong = _softmax(hidden @ self.out + self.out_bias)
        wrong[np.arange(len(y)), y] -= 1
        wrong /= len(y)
        back = (wrong @ self.out.T) * (values > 0)
        d_vectors, d_filters = np.zeros_like(self.vectors), []
        rows = np.arange(len(x))[:, None]
        for k, (w, f) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            own = back[:, k * FILTERS: (k + 1) * FILTERS]
            d = np.zeros_like(f)
            for j in range(w):
                byte = x[rows, places[k] + j]  # the byte each filter's largest response met at j
                d[j] = np.einsum("bfv,bf->vf", self.vectors[byte], own)
                np.add.at(d_vectors, byte, own[:, :, None] * f[j].T[None])
            d_filters.append(d)
        return [d_vectors, *d_filters, back.sum(axis=0), hidden.T @ wrong, wrong.sum(axis=0)]


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


class Tables:
    """The trained network as tables over single bytes and pairs of bytes."""

    def __init__(self, network: Network):
        self.languages = network.languages
        self.bias, self.out, self.out_bias = network.bias, network.out, network.out_bias
        single = [[network.vectors @ f[j] for j in range(w)] for w, f in zip(WIDTHS, network.filters, strict=True)]
        self.parts = []  # by width: (offset, table, whether over pairs)
        for w, own in zip(WIDTHS, single, strict=True):
            parts = [(j, (own[j][:, None] + own[j + 1][None]).reshape(-1, FILTERS), True) for j in range(0, w - 1, 2)]
            if w % 2:
                parts.append((w - 1, own[w - 1], False))
            self.parts.append(parts)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        pairs = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        pooled = []
        for w, parts in zip(WIDTHS, self.parts, strict=True):
            n = WINDOW - w + 1
            total = None
            for j, table, paired in parts:
                got = table.take((pairs if paired else x)[:, j: j + n], axis=0)
                total = got if total is None else np.add(total, got, out=total)
            pooled.append(total.max(axis=1))
        return _softmax(np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0) @ self.out + self.out_bias)


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def train(docs: DataFrame) -> Tables | None:
    known = docs.select("doc_id", "text", "lang").filter(~held_out()).filter(
        "doc_id is not null and lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    each = max(1, min(PER_LANGUAGE, MOST_SAMPLED // len(counts)))
    every = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, max(1, n // each))])
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.element_at(every, F.col("lang"))) == 0)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, ids, parts = [], [], []
            for doc_id, text, lang in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "lang")), strict=True):
                if LETTER.search(text):
                    x, _ = windows(text)
                    for i in sorted({round(k * (len(x) - 1) / (SPREAD - 1)) for k in range(SPREAD)}):
                        langs.append(lang)
                        ids.append(doc_id)
                        parts.append(x[i].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(ids, pa.int64()),
                                              pa.array(parts, pa.binary())], ["lang", "doc_id", "part"])

    rows = chosen.mapInArrow(spread, "lang string, doc_id long, part binary").orderBy(
        F.xxhash64("doc_id", F.lit(SEED)), "doc_id", "part").limit(MOST_SAMPLED * SPREAD).collect()
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    network = Network(languages)
    place = {lang: i for i, lang in enumerate(languages)}
    x = np.frombuffer(b"".join(r["part"] for r in rows), np.uint8).reshape(-1, WINDOW)
    network.train(x, np.array([place[r["lang"]] for r in rows]))
    return Tables(network)


def predict(docs: DataFrame, model: Tables | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score; only the text decides the last two."""
    at_once = 256  # windows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches(whole, "text"):
                langs, scores = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
                texts = batch.column("text").to_pylist()
                rows = [i for i, t in enumerate(texts) if t and LETTER.search(t)] if model else []
                if rows:
                    made = [windows(texts[i]) for i in rows]
                    x, used = np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made])
                    p = np.concatenate([model.probabilities(x[lo: lo + at_once]) for lo in range(0, len(x), at_once)])
                    starts = np.cumsum([0] + [len(m[0]) for m in made[:-1]])
                    mean = np.add.reduceat(p * used[:, None], starts) / np.add.reduceat(used, starts)[:, None]
                    for i, k, s in zip(rows, mean.argmax(axis=1).tolist(), mean.max(axis=1).tolist(), strict=True):
                        langs[i], scores[i] = model.languages[k], min(1.0, s)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), pa.array(langs), pa.array(scores, pa.float64())],
                    ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def op10_byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict(docs, train(docs))
