"""Licence scan by sentence rules.

Sentences are normalised (lower case, letters and digits only) and mapped to identifiers of known licence sentences. A
licence rule is an ordered sequence of identifiers; a text has the licence where the sequence occurs among its known
sentences, with at most GAP other sentences in between. Of rules that start at the same place the longest wins, and
a sentence is part of one match only.

A sentence ends at ``.``, ``!``, ``?``, ``;`` or ``:`` before white space, or at a line end; a known sentence may run over
any number of such parts, as notices are wrapped and enumerated in different ways. In between, the lines up to a sign that
ends a sentence, or up to a line without words, count as one sentence.

Defined cases: a null or empty text has no licence; repeated rows are scanned alike; a null doc_id is kept; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gaugelake.llm.shared import documents, text_batches

GAP = 2

# fixed values: sentences of public licence texts and notices
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
                 "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                 "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
                 "furnished to do so, subject to the following conditions",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or "
                  "substantial portions of the Software.",
    "as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
             "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-name": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                 "provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and "
                  "the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
                  "and the following disclaimer in the documentation and/or other materials provided with the "
                  "distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                   "or promote products derived from this software without specific prior written permission.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                 "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
                 "in all copies.",
    "apache-name": "Licensed under the Apache License, Version 2.0.",
    "apache-head": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache-use": "you may not use this file except in compliance with the License.",
    "gpl3-name": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software",
    "gpl2-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                  "published by the Free Software Foundation; either version 2 of the License, or (at your option) "
                  "any later version.",
    "gpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                  "published by the Free Software Foundation, either version 3 of the License, or (at your option) "
                  "any later version.",
    "mpl-head": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by-nc-name": "Licensed under CC BY-NC 4.0.",
    "cc-by-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "reserved": "All rights reserved.",
}

# fixed values: licences as sequences of sentences
RULES = [
    ("MIT", ("mit-grant", "mit-notice", "as-is")), ("MIT", ("mit-name",)), ("MIT", ("mit-licensed",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", ("isc-grant",)), ("Apache-2.0", ("apache-name",)), ("Apache-2.0", ("apache-head", "apache-use")),
    ("GPL-3.0", ("gpl3-name",)), ("GPL-2.0-or-later", ("gpl-free", "gpl2-terms")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl3-terms")), ("MPL-2.0", ("mpl-head",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-name",)), ("CC-BY-4.0", ("cc-by-work",)), ("CC-BY-SA-4.0", ("cc-by-sa-work",)),
    ("Unlicense", ("unlicense",)), ("Proprietary", ("reserved",)),
]

END = re.compile(r"[.!?;:]+(?=\s|$)|\n")
NOT_WORD = re.compile(r"[^a-z0-9]+")


def normalised(sentence: str) -> str:
    return NOT_WORD.sub(" ", sentence.lower()).strip()


KNOWN = {normalised(s): name for name, s in SENTENCES.items()}
OPENINGS = {k.split()[0] for k in KNOWN}
LONGEST = max(map(len, KNOWN))
CUE = re.compile("|".join(sorted({max(k.split(), key=len) for k in KNOWN})))  # a word each known sentence has

Match = tuple[str, int, int]


def parts(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of each sentence or line, without the white space around it."""
    lo = 0
    for hi in [*(m.end() for m in END.finditer(text)), len(text)]:
        part = text[lo:hi]
        if bare := part.strip():
            start = lo + len(part) - len(part.lstrip())
            yield start, start + len(bare)
        lo = hi


def known_sentences(text: str) -> list[tuple[str, int, int, int, int]]:
    """Identifier, number of its first sentence, start, end, number of its last sentence; longer ones first to be tried."""
    if not CUE.search(text.lower()):
        return []
    cut, number, open_ = [], 0, False  # parts with words: start, end, words, number of the sentence
    for a, b in parts(text):
        words = normalised(text[a:b])
        if not words or not open_ or text.count("\n", cut[-1][1], a) > 1:
            number, open_ = number + open_, False
        if words:
            cut.append((a, b, words, number))
            open_ = text[b - 1] not in ".!?;:"
            number += not open_
    out, i = [], 0
    while i < len(cut):
        found, joined = None, ""
        if cut[i][2].partition(" ")[0] in OPENINGS:
            for j in range(i, len(cut)):
                joined = f"{joined} {cut[j][2]}".strip()
                if len(joined) > LONGEST:
                    break
                if joined in KNOWN:
                    found = (KNOWN[joined], cut[i][3], cut[i][0], cut[j][1], cut[j][3], j)
        if found:
            out.append(found[:5])
            i = found[5]
        i += 1
    return out


def licences(text: str) -> list[Match]:
    """Licence, start and end of each match, in order."""
    held = known_sentences(text)
    out, used = [], set()
    for at in range(len(held)):
        if at in used:
            continue
        best: tuple[int, str, list[int]] | None = None
        for name, sequence in RULES:
            places, k = [], at
            for wanted in sequence:
                while k < len(held) and (k in used or held[k][0] != wanted) and places \
                        and held[k][1] - held[places[-1]][4] <= GAP:
                    k += 1
                if k >= len(held) or k in used or held[k][0] != wanted:
                    break
                places.append(k)
                k += 1
            if len(places) == len(sequence) and (best is None or len(places) > best[0]):
                best = (len(places), name, places)
        if best:
            used.update(best[2])
            out.append((best[1], held[best[2][0]][2], held[best[2][-1]][3]))
    return out


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, number of matches, distinct licences in code point order, and the matches with their spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches(whole, "text"):
                found = [licences(t) if t else [] for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([len(f) for f in found], pa.int64()),
                     pa.array([",".join(sorted({name for name, *_ in f})) for f in found]),
                     pa.array([",".join(f"{name}:{a}:{b}" for name, a, b in f) for f in found])],
                    ["doc_id", "n_matches", "licences", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_matches long, licences string, spans string")


def op4_licence_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
