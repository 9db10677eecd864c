"""Personal data: base patterns and a semi-Markov conditional random field over whole spans.

The base patterns find plain e-mail addresses, IP addresses, card and phone numbers. The random field adds spans that
are written in other ways (``name [at] host [dot] com``, ``(743) 555-3824``). It works on regions: runs of tokens around
cues (a digit, ``@`` or an "at" that an address could be written with), as far as a segment with a cue can reach; no segment
without a cue can be an entity, so texts outside of regions are decided already. Within a region every segment of up to MOST_TOKENS tokens, and every written address of any length, is a candidate for every kind. Its score is the
product of the kind's weights with features of the whole segment (digits and their grouping, check digits, signs, words
before it), and a dynamic program over boundaries and kinds finds the best cut, with as many
entities as it takes. Segments outside of entities are single tokens of score 0.

The weights are fitted by gradient ascent on the likelihood (forward and backward sums over all cuts) of regions from
a bounded sample of the documents. Their labels are the base spans; each labelled span is also rewritten in the ways
above, within its own surroundings, so the model learns from features that rewriting leaves in place. A sample
without personal data gives a model that adds nothing.

Spans are ``kind:start:end`` in code points, end exclusive; an added span never overlaps a base span.

Defined cases: a null or empty text has no spans; repeated rows are scanned alike; a null doc_id is kept; an empty table
gives no rows; extra columns are ignored. All scans take time in proportion to the text.
"""

from __future__ import annotations

import hashlib
import logging
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugelake.llm.shared import documents, text_batches

LOG = logging.getLogger(__name__)
KINDS = ("email", "ip", "card", "phone")  # fixed, and their order
# fixed patterns. Where a search could only fail again from within a run, it starts at the start of the run
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MOST_PART = 255
CARD_DIGITS = (12, 19)
PHONE_DIGITS = (9, 15)

TRAIN_DOCUMENTS = 20_000  # documents sampled by hash
TRAIN_REGIONS = 750  # regions the driver fits on
MOST_TOKENS = 14  # of a segment; written addresses may be longer
MOST_LABELS = 127  # fixed: of a domain name
AROUND = 4  # words of a training window before its first cue
BLOCK = 4096  # segments measured at once
EPOCHS = 40
MARGIN = 1.0  # an added entity must beat the best cut without it by this much
SEED = 5

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text, start - 1):
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            yield start, 0, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    spans = list(_emails(text)) if "@" in text else []
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    if "." in text:
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= MOST_PART for p in m[0].split(".")):
                spans.append((m.start(), 1, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if PHONE_DIGITS[0] <= sum(c.isdigit() for c in m[0]) <= PHONE_DIGITS[1]:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


TOKEN = re.compile(r"(?i:[\[({](?:at|dot|\.)[\])}])|[0-9]+|[^\W\d_]+|\S")
AT, DOT = r"(?:\[at\]|\(at\)|\{at\}| at )", r"(?:\[dot\]|\(dot\)|\{dot\}| dot )"
# the bare word "at" is a cue only where an address could be written with it
CUE = re.compile(rf"[0-9@]|(?i:[\[({{]at[\])}}]|at(?:(?<=[\w.+-] at)|(?<=[\w.+-]  at))(?=  ?[\w-]+ ?(?:\.|{DOT}) ?[\w-]))")
REACH = re.compile(rf"(\S*)(?:[^\S\n]+\S+){{0,{MOST_TOKENS}}}")
WRITTEN = re.compile(rf"[\w.+-]+ ?(?:@|{AT}) ?[\w-]+(?: ?(?:\.|{DOT}) ?[\w-]+)+", re.IGNORECASE)
# a whole address, and its part from the sign on; a domain name has 127 labels at most
LABELS = rf" ?[\w-]++(?: ?(?:\.|{DOT}) ?[\w-]++){{1,{MOST_LABELS - 1}}}"
LONG = re.compile(rf"(?<![\w.%+-])[.%+-]*+(?P<local>\w[\w.%+-]*+) ?(?:@|{AT}){LABELS}", re.IGNORECASE)
LABEL = re.compile(rf"(?: ?(?:@|{AT}|\.|{DOT}) ?)[\w-]++", re.IGNORECASE)
AFTER = re.compile(rf"(?:@|[\[({{]at[\])}}]|at ){LABELS}\S*", re.IGNORECASE)
GOES_ON = re.compile(rf" ?(?:\.|{DOT}) ?\w", re.IGNORECASE)
PROSE = re.compile(r" at .*(?:\. | \.)", re.IGNORECASE)  # "at noon. There" has the form too
BEGUN = re.compile(r"\w[.%+-]?\Z|_\Z")
QUADS = re.compile(r"[0-9]{1,3}(?:(?:\.|\[\.\]|\(\.\)| ?\[dot\] ?)[0-9]{1,3}){3}")
GROUPED = re.compile(r"(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3}[ .-]?[0-9]{4}")
CARD_GROUPS = re.compile(r"[0-9]{4}(?:[ .-]?[0-9]{4}){2,3}(?:[ .-]?[0-9]{1,3})?")
BEFORE = {"mail": 0, "email": 0, "contact": 0, "ip": 1, "host": 1, "server": 1, "address": 1, "card": 2, "visa": 2,
          "tel": 3, "phone": 3, "call": 3, "fax": 3, "mobile": 3}
N_FEATURES = 19


def features(text: str, start: int, end: int, word_before: str) -> np.ndarray:
    """Features of a whole segment; the same for every kind."""
    s = text[start:end]
    digits = re.sub(r"[^0-9]", "", s)
    n, f = len(digits), np.zeros(N_FEATURES)
    f[0] = 1
    written = (bool(WRITTEN.fullmatch(s)) and not GOES_ON.match(text, end)
               and not BEGUN.search(text[max(0, start - 2):start]))
    f[18] = written and bool(PROSE.search(s))
    f[1] = written and not f[18]
    f[2] = "@" in s
    f[3] = bool(QUADS.fullmatch(s)) and all(int(p) <= MOST_PART for p in re.findall("[0-9]+", s))
    f[4] = bool(CARD_GROUPS.fullmatch(s)) and luhn(digits)
    f[5] = bool(GROUPED.fullmatch(s)) and 9 <= n <= 15
    f[6] = n == 0 and not written
    f[7] = 1 <= n <= 6
    f[8] = 7 <= n <= 8
    f[9] = 9 <= n <= 11
    f[10] = 12 <= n <= 15 and not f[4]
    f[11] = n > 19
    f[12] = (start > 0 and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum())
    f[13] = not (s[0].isalnum() or s[0] in "+(") or not (s[-1].isalnum() or s[-1] in ")")
    f[14] = sum(c.isalpha() for c in s) > 0
    f[15] = s.count("(") != s.count(")")
    if word_before in BEFORE:
        f[16] = 1
    f[17] = len(s) / 20
    return f


def regions(text: str) -> list[tuple[int, int]]:
    """Code point ranges around cues, in order, apart from each other and each within a line.

    Every cue has MOST_TOKENS words on both sides, or more for a long address; ranges that meet are one. So no candidate segment crosses
    the end of a range, and deciding the ranges is deciding the text.
    """
    out: list[tuple[int, int]] = []
    line_lo = line_hi = word_hi = hi = -1
    for m in CUE.finditer(text):
        at = m.start()
        if at < word_hi:
            if not m[0].isdigit() and (whole := AFTER.match(text, at)):
                hi = max(hi, whole.end())
                out[-1] = out[-1][0], hi
            continue
        if at >= line_hi:
            line_lo = text.rfind("\n", max(line_hi, 0), at) + 1 or max(line_hi, 0)
            line_hi = text.find("\n", at)
            line_hi = len(text) if line_hi < 0 else line_hi
        base = max(line_lo, hi)
        words = text[base:at].rsplit(None, MOST_TOKENS)
        near = REACH.match(text, at)
        word_hi = near.end(1)
        whole = None if m[0].isdigit() else AFTER.match(text, at)
        end = max(near.end(), whole.end() if whole else 0)
        if base == hi and len(words) <= MOST_TOKENS:
            hi = max(hi, end)
            out[-1] = out[-1][0], hi
        else:
            lo, hi = base + (len(words[0]) if len(words) > MOST_TOKENS else 0), end
            out.append((lo, hi))
    return out


def windows(text: str) -> list[tuple[int, int]]:
    """Short code point ranges that hold the cues, to fit the weights on."""
    if not CUE.search(text):
        return []
    out: list[tuple[int, int]] = []
    for m in CUE.finditer(text):
        if out and m.start() < out[-1][1]:
            continue
        lo = m.start()
        for _ in range(AROUND):
            lo = max(text.rfind(" ", 0, max(0, lo - 1)) + 1, text.rfind("\n", 0, max(0, lo - 1)) + 1, lo - 40, 0)
        hi = m.end()
        for _ in range(AROUND + 2):
            space = [x for x in (text.find(" ", hi + 1, hi + 41), text.find("\n", hi + 1, hi + 41)) if x >= 0]
            hi = min(space) if space else min(len(text), hi + 40)
        if out and lo < out[-1][1]:
            lo = out[-1][1]
        if lo < hi:
            out.append((lo, hi))
    return out


def tokens_of(text: str, lo: int, hi: int) -> list[tuple[int, int]]:
    return [(m.start(), m.end()) for m in TOKEN.finditer(text, lo, hi)]


def words_before(text: str, tokens: list[tuple[int, int]]) -> list[str]:
    """The last word before each token."""
    out, last = [], ""
    for lo, hi in tokens:
        out.append(last)
        if text[lo].isalpha():
            last = text[lo:hi].lower()
    return out


def long_addresses(text: str, tokens: list[tuple[int, int]]) -> dict[int, list[int]]:
    """Written addresses of over MOST_TOKENS tokens: the ends, after any further label, by their first token."""
    out: dict[int, list[int]] = {}
    if not tokens:
        return out
    starts, ends = [lo for lo, _ in tokens], [hi for _, hi in tokens]
    for m in LONG.finditer(text, starts[0], ends[-1]):
        i, at = bisect_left(starts, m.start("local")), m.end("local")
        while label := LABEL.match(text, at, m.end()):
            at = label.end()
            j = bisect_left(ends, at)
            if starts[i] == m.start("local") and ends[j] == at and j + 1 - i > MOST_TOKENS:
                out.setdefault(i, []).append(j + 1)
    return out


def candidates(text: str, tokens: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Segments of a line that hold a cue, by their start: those of up to MOST_TOKENS tokens, and longer addresses."""
    n = len(tokens)
    longer = long_addresses(text, tokens)
    held, line = n, n  # the next cue, and the first token of the next line
    ends = []
    for i in range(n - 1, -1, -1):
        if i + 1 < n and "\n" in text[tokens[i][1]:tokens[i + 1][0]]:
            line = i + 1
        if CUE.match(text, tokens[i][0]):
            held = i
        ends.append((held + 1, min(i + MOST_TOKENS, line)))
    for i, (least, most) in enumerate(reversed(ends)):
        for j in range(least, most + 1):
            yield i, j
        for j in longer.get(i, ()):
            yield i, j


def measured(text: str, tokens: list[tuple[int, int]], before: list[str], segments: list[tuple[int, int]]) -> np.ndarray:
    rows = [features(text, tokens[i][0], tokens[j - 1][1], before[i]) for i, j in segments]
    return np.array(rows).reshape(-1, N_FEATURES)


class Lattice:
    """The segments of a region and their features."""

    def __init__(self, text: str):
        self.text = text
        self.tokens = tokens_of(text, 0, len(text))
        self.segments = list(candidates(text, self.tokens))  # (first token, token after the last)
        self.x = measured(text, self.tokens, words_before(text, self.tokens), self.segments)
        self.ending: list[list[int]] = [[] for _ in range(len(self.tokens) + 1)]
        for k, (_, j) in enumerate(self.segments):
            self.ending[j].append(k)

    def gold(self, spans: list[Span]) -> dict[int, int] | None:
        """Segment to kind of the labelled spans; None if one is no segment."""
        where = {(self.tokens[i][0], self.tokens[j - 1][1]): k for k, (i, j) in enumerate(self.segments)}
        out = {}
        for start, kind, end in spans:
            if (start, end) not in where:
                return None
            out[where[start, end]] = kind
        return out

    def expected(self, scores: np.ndarray) -> np.ndarray:
        """Marginal probability of each segment and kind, from sums over all cuts."""
        n = len(self.tokens)
        best = scores.max(axis=1)
        total = best + np.log(np.exp(scores - best[:, None]).sum(axis=1))
        forward, backward = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        forward[0] = backward[n] = 0
        for j in range(1, n + 1):
            forward[j] = np.logaddexp.reduce([forward[j - 1]] + [forward[self.segments[k][0]] + total[k]
                                                                 for k in self.ending[j]])
        for j in range(n, 0, -1):
            backward[j - 1] = np.logaddexp(backward[j - 1], backward[j])
            for k in self.ending[j]:
                i = self.segments[k][0]
                backward[i] = np.logaddexp(backward[i], backward[j] + total[k])
        first = np.array([forward[i] for i, _ in self.segments])
        last = np.array([backward[j] for _, j in self.segments])
        return np.exp(scores + (first + last - forward[n])[:, None])


def best_cut(worth: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int]]:
    """(first token, token after the last, kind) of the entities of the best cut, of any number.

    ``worth``: those and the value of each segment worth an entity (over 0), in order of its end. A bound on the entities
    that no cut can exceed never binds, so the program over boundaries need not count them.
    """
    ends, top = [0], [0.0]  # the ends at which the best value grows
    come: list[tuple[int, int, int, int] | None] = [None]
    for i, j, kind, value in worth:
        at = bisect_right(ends, i) - 1
        if top[at] + value > top[-1]:
            if ends[-1] == j:
                del ends[-1], top[-1], come[-1]
            ends.append(j)
            top.append(top[at] + value)
            come.append((i, j, kind, at))
    out, step = [], come[-1]
    while step:
        out.append(step[:3])
        step = come[step[3]]
    return out[::-1]


def rewritten(value: str, kind: int, rng: random.Random) -> str | None:
    """A span of a kind as it may also be written."""
    if kind == 0:
        at, dot = rng.choice([(" [at] ", " [dot] "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" at ", " dot ")])
        local, _, host = (re.sub("[0-9]", "", value) if rng.random() < 0.5 else value).partition("@")
        return local + at + host.replace(".", dot)
    if kind == 1:
        return value.replace(".", rng.choice(["[.]", "(.)", "[dot]"]))
    digits = re.sub("[^0-9]", "", value)
    if kind == 2 and len(digits) == 16:
        return rng.choice([".", "-"]).join(digits[i:i + 4] for i in range(0, 16, 4))
    if kind == 3 and len(digits) >= 10:
        local = digits[-10:]
        return rng.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}"]).format(local[:3], local[3:6], local[6:])
    return None


def examples(text: str, rng: random.Random) -> Iterator[tuple[str, list[Span]]]:
    """Labelled regions of a text, and their rewritten forms."""
    spans = base_spans(text)
    for lo, hi in windows(text):
        inside = [s for s in spans if s[0] < hi and s[2] > lo]
        if inside:
            lo, hi = min(lo, inside[0][0]), max(hi, max(s[2] for s in inside))
        own = [(a - lo, k, b - lo) for a, k, b in inside]
        if any(x[2] > y[0] for x, y in zip(own, own[1:], strict=False)):
            continue
        part = text[lo:hi]
        yield part, own
        for start, kind, end in own[:1]:
            new = rewritten(part[start:end], kind, rng)
            if new and len(own) == 1:
                yield part[:start] + new + part[end:], [(start, kind, start + len(new))]


def fit(labelled: list[tuple[str, list[Span]]]) -> np.ndarray:
    """Weights by kind and feature, from gradient ascent on the likelihood of the labelled cuts."""
    lattices, dropped = [], 0
    for text, spans in labelled:
        lattice = Lattice(text)
        gold = lattice.gold(spans)
        if gold is None:
            dropped += len(spans)
        elif lattice.segments:
            lattices.append((lattice, gold))
    if dropped:
        LOG.warning("%d of %d labelled spans are no segments and not learned from", dropped, sum(len(s) for _, s in labelled))
    weights = np.zeros((len(KINDS), N_FEATURES))
    weights[:, 0] = -4.0
    if not any(gold for _, gold in lattices):
        return weights
    # segments with equal features share their scores
    squares = np.full_like(weights, 1e-6)
    for epoch in range(EPOCHS):
        gradient = -0.002 * weights
        for lattice, gold in lattices:
            wrong = -lattice.expected(lattice.x @ weights.T)
            for k, kind in gold.items():
                wrong[k, kind] += 1
            gradient += wrong.T @ lattice.x
        squares += gradient ** 2
        weights += 1.0 * gradient / np.sqrt(squares)
    return weights


def train(docs: DataFrame) -> np.ndarray:
    n = docs.count()
    every = max(1, -(-n // TRAIN_DOCUMENTS))
    sample = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(every)) == 0).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(t, a, k, b) for text in batch.column("text").to_pylist() if text
                    for t, spans in examples(text, random.Random(len(text)))
                    for a, k, b in [spans[0] if len(spans) == 1 else (-1, -1, -1)] if len(spans) <= 1]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*rows, strict=True)], ["part", "start", "kind", "end"])

    found = sample.mapInArrow(run, "part string, start long, kind long, end long").distinct()
    order = F.xxhash64("part", F.lit(SEED))
    rows = (found.filter("kind >= 0").orderBy(order, "part").limit(TRAIN_REGIONS * 2 // 3)
            .union(found.filter("kind < 0").orderBy(order, "part").limit(TRAIN_REGIONS // 3))).collect()
    return fit([(r.part, [(r.start, r.kind, r.end)] if r.kind >= 0 else []) for r in rows])


def added_spans(text: str, base: list[Span], weights: np.ndarray) -> list[Span]:
    out, starts, reach = [], [a for a, _, _ in base], list(accumulate((b for _, _, b in base), max, initial=0))
    for lo, hi in regions(text):
        tokens = tokens_of(text, lo, hi)
        before, segments, worth = words_before(text, tokens), candidates(text, tokens), []
        while block := list(islice(segments, BLOCK)):
            scores = measured(text, tokens, before, block) @ weights.T
            value = scores.max(axis=1) - MARGIN
            worth += [(*block[k], int(scores[k].argmax()), float(value[k])) for k in np.flatnonzero(value > 0)]
        for i, j, kind in best_cut(sorted(worth, key=lambda w: w[1])):
            start, end = tokens[i][0], tokens[j - 1][1]
            if reach[bisect_left(starts, end)] <= start:
                out.append((start, kind, end))
    return out


def as_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches(whole, "text"):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                found = [base_spans(t) for t in texts]
                spans = [sorted(b + added_spans(t, b, weights)) for t, b in zip(texts, found, strict=True)]
                counts = [[sum(s[1] == kind for s in base) for base in found] for kind in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts],
                     pa.array([hashlib.sha256(as_text(base).encode()).hexdigest() for base in found]),
                     pa.array([as_text(s) for s in spans])],
                    ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, {counts}, base_sha256 string, spans string")


def op3_semi_crf_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scan(docs, train(docs))
