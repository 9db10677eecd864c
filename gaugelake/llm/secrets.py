"""Secret scan with a worklist of decoded layers.

Every text is scanned with the base rules. Parts that look encoded (percent escapes, Unicode and hexadecimal
escapes, base64, and compressed data within these) are decoded into a layer, which is scanned in the same way and whose own
encoded parts go onto the worklist, until nothing new comes up; a layer seen before is not decoded again, so cycles end. A
secret found in a layer is reported at the span of the outermost encoded part in the text, with its kind. Layers
of base64 are printable text, of the whole run, of lines joined, or from a delimiter (``/``, ``-``, ``_``) on; bad bytes of
percent escapes are replaced. Compressed data are
inflated by CHUNK, over all members, and scanned in pieces cut where no match can be open, so a bomb needs little memory.

Spans are ``kind:start:end`` in code points, end exclusive. Base spans always stay; spans of layers are added.

Defined cases: a null or empty text has no spans; repeated rows are scanned alike; a null doc_id is kept; an empty table gives
no rows; extra columns are ignored. All scans take time in proportion to the text.
"""

from __future__ import annotations

import base64
import binascii
import codecs
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugelake.llm.shared import documents, text_batches

KINDS = ("assign", "access", "hex")  # fixed, and their order
# fixed patterns; the least lengths are checked afterwards
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}+")
LEAST_VALUE, LEAST_ACCESS = 6, 20

ESCAPE = re.compile(r"\\u([0-9a-fA-F]{4})|\\x([0-9a-fA-F]{2})|\\U([0-9a-fA-F]{8})")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}")
PERCENT_ESCAPE = re.compile(r"%[0-9A-Fa-f]{2}")
DIGITS = re.compile(r"[A-Za-z0-9+/_-]++")
BLOCK = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)+={0,2}")
DELIMITER = re.compile(r"[/_-]")
PLAIN = re.compile(r"[^\x00-\x08\x0b\x0c\x0e-\x1f\x7f\ufffd]{12,}")  # shorter ones hold no secret
MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]")
RUN = re.compile(r"[!-~]+")
# a line break after what no wrapped base64 ends with; no match of the rules and no escape holds a line break
CLOSED = re.compile(r"[^A-Za-z0-9+/_=\s-][ \t]*+\r?\n|\n[ \t]*+\r?\n")
CHUNK = 1 << 22  # bytes inflated at once
REPLACEMENT = "[SECRET]"

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def base_spans(text: str) -> list[Span]:
    spans = []
    low = text.lower()
    if any(word in low for word in ("passw", "secret", "token", "key")):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def _printable(data: bytes) -> str | None:
    """The text of bytes that are UTF-8 without control characters."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text if text and all(c.isprintable() or c in "\t\r\n" for c in text) else None


def _inflated(data: bytes) -> Iterator[str]:
    """The texts of gzip and zlib data that start anywhere in bytes, in pieces that no match or encoded part crosses."""
    at = 0
    while m := MAGIC.search(data, at):
        at = m.start() + 1
        member, read = memoryview(data)[m.start():], 0
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        held, grown = "", 0
        while True:
            inflate, source = zlib.decompressobj(47), member[read:]
            try:
                while not inflate.eof:
                    piece = inflate.decompress(source, CHUNK)
                    if not piece and not inflate.unconsumed_tail and not inflate.eof:
                        break  # cut off
                    source = inflate.unconsumed_tail
                    held += decoder.decode(piece)
                    if len(held) - grown >= CHUNK // 4:
                        cut = _cut(held)
                        if cut:
                            yield held[:cut]
                        held = held[cut:]
                        grown = len(held)
            except zlib.error:
                break
            if not inflate.eof:
                read = len(member)
                break
            read = len(member) - len(inflate.unused_data)
            if not MAGIC.match(member, read):
                break
        held += decoder.decode(b"", True)
        if held:
            yield held
        at = max(at, m.start() + read)


def _cut(text: str) -> int:
    """The end of the last line or word that can be part of no match with what follows, or 0 if there is none."""
    at = 0
    for m in CLOSED.finditer(text, max(0, len(text) - CHUNK // 4)):
        at = m.end()
    return at


def _bytes(body: str) -> bytes:
    """The bytes of base64 digits without line breaks; a last digit that is over is left out."""
    body = body[:len(body) - (len(body) % 4 == 1)].replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def _base64(part: str) -> Iterator[str]:
    """What a run of base64 digits holds, as a whole or from a delimiter in it."""
    body = part.rstrip("=")
    delimiters = [m.end() for m in DELIMITER.finditer(body)]
    for shift in sorted({0, *(at % 4 for at in delimiters)}):
        data = _bytes(body[shift:])
        yield from _inflated(data)
        plain = _printable(data) if shift == 0 else None
        if plain is not None:
            yield plain
        elif delimiters:
            yield from (m[0] for m in PLAIN.finditer(data.decode("utf-8", "replace")))


def _blocks(text: str) -> Iterator[tuple[int, int, str]]:
    """Base64 wrapped into lines of one length and a shorter last one: with the last, and without."""
    for m in BLOCK.finditer(text):
        lines = list(DIGITS.finditer(text, m.start(), m.end()))
        first = 0
        while first + 1 < len(lines):
            width, last = len(lines[first + 1][0]), first + 1
            while last + 1 < len(lines) and len(lines[last + 1][0]) == width and not text.startswith("=", lines[last].end()):
                last += 1
            ends = [last]
            if last + 1 < len(lines) and len(lines[last + 1][0]) < width:
                ends.append(last + 1)
            for end in ends:
                yield lines[first].start(), lines[end].end(), "".join(x[0] for x in lines[first:end + 1])
            first = last


def _unescaped(part: str) -> str:
    def one(m: re.Match) -> str:
        code = int(m[1] or m[2] or m[3], 16)
        return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else m[0]

    return ESCAPE.sub(one, part)


def _decoded(text: str) -> Iterator[tuple[int, int, str]]:
    """The encoded parts of a text with what they hold."""
    percent, escape = "%" in text and PERCENT_ESCAPE.search(text), "\\" in text and ESCAPE.search(text)
    if percent or escape:
        for m in RUN.finditer(text):
            part = m[0]
            if percent and "%" in part and PERCENT_ESCAPE.search(part):
                data = unquote_to_bytes(part)
                for plain in (data.decode("utf-8", "replace"), *_inflated(data)):
                    yield m.start(), m.end(), plain
            if escape and "\\" in part and ESCAPE.search(part):
                plain = _unescaped(part)
                yield m.start(), m.end(), plain
                for plain in _inflated(plain.encode("latin-1", "replace")):
                    yield m.start(), m.end(), plain
    for m in BASE64.finditer(text):
        for plain in _base64(m[0]):
            yield m.start(), m.end(), plain
    if "\n" in text:
        for start, end, body in _blocks(text):
            for plain in _base64(body):
                yield start, end, plain


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and base and layer spans together, both in order."""
    base = base_spans(text)
    found = set(base)
    seen: set[bytes] = set()
    work: list[tuple[tuple[int, int] | None, Iterator[tuple[int, int, str]]]] = [(None, _decoded(text))]
    while work:
        outer, parts = work[-1]
        part = next(parts, None)
        if part is None:
            work.pop()
            continue
        (start, end), layer = outer or part[:2], part[2]
        digest = hashlib.blake2b(layer.encode("utf-8", "surrogatepass") + b"%d:%d" % (start, end), digest_size=16).digest()
        if digest in seen or layer == text[start:end]:
            continue
        seen.add(digest)
        found.update((start, kind, end) for _, kind, _ in base_spans(layer))
        work.append(((start, end), _decoded(layer)))
    return base, sorted(found)


def as_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches(whole, "text"):
                found = [all_spans(t or "") for t in batch.column("text").to_pylist()]
                counts = [[sum(s[1] == kind for s in base) for base, _ in found] for kind in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts],
                     pa.array([hashlib.sha256(as_text(base).encode()).hexdigest() for base, _ in found]),
                     pa.array([as_text(spans) for _, spans in found])],
                    ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, {counts}, base_sha256 string, spans string")


def redacted(text: str | None) -> str | None:
    """The text with every span, overlapping ones together, replaced."""
    if not text:
        return text
    out, done = [], 0
    for start, _, end in all_spans(text)[1]:
        if end <= done:
            continue
        if start >= done:
            out.append(text[done:start])
            out.append(REPLACEMENT)
        done = end
    out.append(text[done:])
    return "".join(out)


def redact(docs: DataFrame) -> DataFrame:
    """The documents with their secrets replaced; ``n_chars`` is that of the new text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches(whole, "text"):
                at = batch.schema.get_field_index("text")
                new = pa.array([redacted(t) for t in batch.column("text").to_pylist()], batch.schema.field(at).type)
                yield batch.set_column(at, batch.schema.field(at), new)

    clean = docs.mapInArrow(run, docs.schema)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else clean


def op7_layered_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
