"""Token ids of whole texts with a public tokenizer, a batch of texts at a time.

Both tokenizers cut a text at every white space before they merge, so the pieces between are encoded on
their own: Arrow splits the texts of a batch and numbers the distinct pieces, each of these is looked up (or encoded) once, and
numpy gathers the ids of all pieces by their numbers. The result equals that of the tokenizer on the whole text. Letters with signs
behind them are looked up apart. The memory of a worker is bounded: at most two times MOST pieces are kept besides those of a batch.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MOST = 350_000
GATHERED = 1 << 18  # pieces whose ids are gathered at once

# white space besides the space and the line feed, as any of the libraries sees it
_OTHER_SPACE = "[" + "".join(map(chr, [
    0x09, 0x0B, 0x0C, 0x0D, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
    0x202F, 0x205F, 0x3000])) + "]"
_NOT_SINGLE_SPACES = rf"\A | \z|  |\n\n| \n|\n |{_OTHER_SPACE}"


# letters, then ASCII signs but for the apostrophe: every tokenizer here cuts between the two
_LETTERS_SIGNS = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]+)")


def _byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_ALPHABET = _byte_alphabet()
_SPACE = _ALPHABET[0x20]


class _Pieces:
    """Ids of pieces as bytes of 32-bit numbers, encoded at their first use; ``space`` if a space goes before each.

    Beyond MOST pieces those not used since the last time are dropped.
    """

    def __init__(self, tokenizer, space: bool, lower: bool):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.before, self.lower = " " if space else "", lower
        self.signs: dict[str, bytes] = {}
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def forget(self) -> None:
        self.signs, self.recent, self.older = {}, {}, {}

    def find(self, pieces: list[str]) -> list[bytes]:
        if len(self.recent) > MOST:
            self.older, self.recent = self.recent, {}
        if len(self.signs) > MOST:
            self.signs = {}
        recent, older = self.recent, self.older
        found = list(map(recent.get, pieces))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    piece = pieces[i]
                    ids = older.pop(piece, None)
                    found[i] = recent[piece] = self._encoded(piece) if ids is None else ids
        return found

    def _encoded(self, piece: str) -> bytes:
        return self._letters(piece) if piece.isalpha() else self._mixed(piece)

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _letters(self, piece: str) -> bytes:
        # one word, which normalisation leaves as it is (in Latin 1): only merges are left to do
        plain = self.before + (piece.lower() if self.lower else piece)
        if not piece.isascii():
            try:
                piece.encode("latin-1")
            except UnicodeEncodeError:
                return self._whole(self.before + piece)
            plain = plain.encode().decode("latin-1").translate(_ALPHABET)
        elif self.before:
            plain = _SPACE + plain[1:]
        return array("I", [t.id for t in self.model.tokenize(plain)]).tobytes()

    def _mixed(self, piece: str) -> bytes:
        cut = _LETTERS_SIGNS.fullmatch(piece)
        if not cut:
            return self._whole(self.before + piece)
        letters, signs = cut.groups()
        if signs not in self.signs:
            self.signs[signs] = self._whole(signs)
        ids = self.recent.get(letters)
        if ids is None:
            ids = self.older.pop(letters, None)
            ids = self.recent[letters] = self._encoded(letters) if ids is None else ids
        return ids + self.signs[signs]


def _gather(ids_of: list[bytes], numbers: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """For each text (pieces ``bounds[i]`` to ``bounds[i + 1]``) the ids of all its pieces, which are given by number."""
    flat = np.frombuffer(b"".join(ids_of), np.uint32)
    lengths = np.fromiter(map(len, ids_of), np.int64, len(ids_of)) // 4
    starts = np.cumsum(lengths) - lengths
    ends = np.concatenate(([0], np.cumsum(lengths[numbers])))
    out = np.empty(ends[-1], np.uint32)
    for lo in range(0, len(numbers), GATHERED):
        part = numbers[lo: lo + GATHERED]
        own = lengths[part]
        at = np.repeat(starts[part] - (np.cumsum(own) - own), own)
        at += np.arange(len(at))
        out[ends[lo]: ends[lo] + len(at)] = flat[at]
    return np.split(out, ends[bounds[1:-1]])


def _listed(strings: pa.Array) -> list[str]:
    return strings.to_numpy(zero_copy_only=False).tolist()


def _pieces_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct pieces between single spaces, the numbers of all pieces, and the bounds of each text."""
    split = pc.split_pattern(texts, " ")
    bounds = split.offsets.to_numpy()
    coded = split.flatten().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), bounds - bounds[0]


class WordEncoder:
    """For tokenizers that lower-case and drop white space."""

    def __init__(self, tokenizer):
        self.pieces = _Pieces(tokenizer, space=False, lower=True)

    def forget(self) -> None:
        self.pieces.forget()

    def encode_all(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; null has none."""
        if not len(texts):
            return []
        distinct, numbers, bounds = _pieces_of(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "))
        return _gather(self.pieces.find(_listed(distinct)), numbers, bounds)

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all(pa.array([text], pa.string()))[0]


class ByteEncoder:
    """For byte-level tokenizers, where a piece begins with the space before it.

    A text with two white spaces in a row, or others than space and line feed, is encoded as a whole.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.first = _Pieces(tokenizer, space=False, lower=False)
        self.rest = _Pieces(tokenizer, space=True, lower=False)
        self.line_feed = np.array(tokenizer.encode("\n", add_special_tokens=False).ids, np.uint32).tobytes()

    def forget(self) -> None:
        self.first.forget()
        self.rest.forget()

    def encode_all(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; null has none."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _NOT_SINGLE_SPACES)
        out = [np.empty(0, np.uint32)] * len(texts)
        for i in pc.indices_nonzero(odd).to_pylist():
            out[i] = np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32)
        plain = pc.indices_nonzero(pc.invert(odd))
        if len(plain):
            for i, ids in zip(plain.to_pylist(), self._single_spaced(texts.take(plain)), strict=True):
                out[i] = ids
        return out

    def _single_spaced(self, texts: pa.Array) -> list[np.ndarray]:
        # a line feed opens a piece as a space does, and stays in it; the first piece of a text has neither
        distinct, numbers, bounds = _pieces_of(pc.replace_substring(texts, "\n", " \n"))
        of_lines = pc.starts_with(distinct, "\n")
        ids_of = np.empty(len(distinct), object)
        ids_of[~of_lines.to_numpy(zero_copy_only=False)] = self.rest.find(_listed(distinct.filter(pc.invert(of_lines))))
        after_feed = _listed(pc.utf8_slice_codeunits(distinct.filter(of_lines), 1))
        ids_of[of_lines.to_numpy(zero_copy_only=False)] = [self.line_feed + ids for ids in self.first.find(after_feed)]
        firsts = pa.array(numbers[bounds[:-1]]).dictionary_encode()
        opening = self._openings(_listed(distinct.take(firsts.dictionary)))
        numbers = numbers.copy()
        numbers[bounds[:-1]] = firsts.indices.to_numpy() + len(distinct)
        return _gather([*ids_of.tolist(), *opening], numbers, bounds)

    def _openings(self, pieces: list[str]) -> list[bytes]:
        """Ids of the first pieces of texts; one that begins with a line feed is an empty piece and a line."""
        ids = self.first.find([p.removeprefix("\n") for p in pieces])
        return [self.line_feed + x if p.startswith("\n") else x for p, x in zip(pieces, ids, strict=True)]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all(pa.array([text], pa.string()))[0]


@lru_cache(maxsize=4)
def encoder(path: str, kind: str):
    """The encoder of a tokenizer file, once per worker; ``kind`` is ``word`` or ``byte``."""
    from tokenizers import Tokenizer

    return {"word": WordEncoder, "byte": ByteEncoder}[kind](Tokenizer.from_file(path))


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
