"""License scans: exact phrases and an exact containment join of text blocks with license templates.

Words are lower-cased runs of letters, digits and code points beyond ASCII. Notices may be wrapped: a
block is a line, or a line with those after it in its paragraph (up to a line without words) that
REACH times as many words as the template has can touch. The join finds each block B and template T
with |B ∩ T| >= threshold * |T| (sets of words), through filters that lose none: tokens in ascending
order of their document frequency over the whole table, template prefixes, the length of the block,
and the place of the first common token. They are applied to whole paragraphs, which hold all their
blocks, and blocks are compared with the templates that their paragraph meets. All of them come back as
`blocks`; `labels` has, beside those of the phrases, the label of the best on any line, as one notice
meets the templates of its kin (GPL of either version, LGPL, AGPL) too.

Null and empty texts have no words, labels or places, and score 0. Repeated rows are scanned alike;
further columns are not read. Only the words of the templates, a fixed list, are counted and broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, texts

# The phrases of the base scan and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# Whole licence texts (BSD in its form of three clauses) and the notice of the Apache license.
MIT = """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal
in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the
software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission
notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied
including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright
holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the
software or the use or other dealings in the software"""
ISC = """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright
notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software
including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages
or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in
connection with the use or performance of this software"""
BSD = """redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1
redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form must
reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the
distribution 3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
without specific prior written permission this software is provided by the copyright holders and contributors as is and any express or implied warranties
including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder
or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute
goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort
including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"""
ZLIB = """this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the
use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it
freely subject to the following restrictions 1 the origin of this software must not be misrepresented you must not claim that you wrote the original software if
you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required 2 altered source versions must be
plainly marked as such and must not be misrepresented as being the original software 3 this notice may not be removed or altered from any source distribution"""
APACHE = """licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of
the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is
distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing
permissions and limitations under the license"""
UNLICENSE = """this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this
software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"""
BOOST = """permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so"""
#: The second paragraph of notices of the GNU licences, which names no version.
WARRANTY = "this {} is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the {} general public license for more details"
#: Notices as projects commonly print them, opening sentences, and whole texts, with the label each stands for.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license"),
    ("gpl-2", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("agpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("mit", MIT),
    ("isc", ISC),
    ("bsd", BSD),
    ("zlib", ZLIB),
    ("apache-2", APACHE),
    ("unlicense", UNLICENSE),
    ("mpl-2", "this source code form is incompatible with secondary licenses as defined by the mozilla public license v 2 0"),
    ("mpl-2", "mozilla public license version 2 0 1 definitions 1 1 contributor means each individual or legal entity that creates contributes to the creation of or owns covered software"),
    ("epl-2", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0"),
    ("epl-1", "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html"),
    ("boost", "distributed under the boost software license version 1 0 see accompanying file license 1 0 txt or copy at http www boost org license 1 0 txt"),
    ("boost", BOOST),
    ("gpl-3", "gnu general public license version 3 29 june 2007 copyright c 2007 free software foundation inc"),
    ("gpl-2", "gnu general public license version 2 june 1991 copyright c 1989 1991 free software foundation inc"),
    ("lgpl", "gnu lesser general public license version 3 29 june 2007 copyright c 2007 free software foundation inc"),
    ("lgpl", "gnu lesser general public license version 2 1 february 1999 copyright c 1991 1999 free software foundation inc"),
    ("agpl-3", "gnu affero general public license version 3 19 november 2007 copyright c 2007 free software foundation inc"),
    *((label, f"spdx license identifier {label}") for label in ("mit", "isc", "unlicense")),  # ids of more words would meet each other
    *((label, WARRANTY.format(thing, name)) for label, name in (("gpl", "gnu"), ("lgpl", "gnu lesser"), ("agpl-3", "gnu affero")) for thing in ("program", "library", "software")),
]
#: Bytes of words stay, lower-cased; all others become spaces.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 10 if b == 10 else 32 for b in range(256))
#: Words after the first line of a block, for each word of the template; more than 1, as comment marks such as "rem" may stand between.
REACH = 1.5
SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double, blocks array<struct<template:int,line:int,last_line:int,containment:double>>"


def template_frequencies(documents: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> dict[str, int]:
    """Documents that hold each word of the templates, counted over the whole table."""
    wanted = frozenset(w.encode() for _, t in templates for w in t.split())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, int] = {}
        for batch in by_bytes(batches, "text"):
            for text in texts(batch):
                for w in wanted.intersection(text.encode().translate(TABLE).split()):
                    found[w] = found.get(w, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in found], pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])

    rows = documents.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"]: r["n"] for r in rows.collect()}  # at most the words of the templates


class TemplateIndex:
    """Prefix index over the templates, in the global order of tokens."""

    def __init__(self, templates: list[tuple[str, str]], frequencies: dict[str, int], threshold: float):
        words = sorted({w for _, t in templates for w in t.split()}, key=lambda w: (frequencies.get(w, 0), w))
        self.order = {w.encode(): i for i, w in enumerate(words)}
        self.sets = [sorted({self.order[w.encode()] for w in t.split()}) for _, t in templates]
        self.labels = [label for label, _ in templates]
        self.reach = [ceil(REACH * len(t.split())) for _, t in templates]
        self.need = [max(1, ceil(threshold * len(s) - 1e-9)) for s in self.sets]
        self.prefixes: dict[int, list[tuple[int, int]]] = {}
        for t, (tokens, need) in enumerate(zip(self.sets, self.need, strict=True)):
            for place, token in enumerate(tokens[: len(tokens) - need + 1]):
                self.prefixes.setdefault(token, []).append((t, place))
        self.rare = frozenset(w for w, i in self.order.items() if i in self.prefixes)
        self.shortest = min(self.need)

    def search(self, block: list[bytes]) -> Iterator[tuple[int, float]]:
        """(template, containment) for every template that the block meets."""
        known = sorted({self.order[w] for w in block if w in self.order})
        if len(known) < self.shortest:
            return
        have, seen = set(known), set()
        for at, token in enumerate(known):
            for t, place in self.prefixes.get(token, ()):
                if t in seen:
                    continue
                seen.add(t)  # the first common token: all others stand behind it in both
                left = 1 + min(len(self.sets[t]) - place - 1, len(known) - at - 1)
                if len(known) >= self.need[t] and left >= self.need[t]:
                    both = sum(x in have for x in self.sets[t])
                    if both >= self.need[t]:
                        yield t, both / len(self.sets[t])

    def notices(self, paragraph: list[list[bytes]]) -> Iterator[tuple[int, int, int, float]]:
        """(template, first line, last line, containment) of the blocks of a paragraph that meet a template.

        A block that meets it is left out where it begins with a line that doesn't meet it alone and
        holds no more of it than the block that begins a line later.
        """
        for t, most in self.search([w for line in paragraph for w in line]):
            if len(paragraph) == 1:
                yield t, 0, 0, most
                continue
            wanted, size, need = frozenset(self.sets[t]), len(self.sets[t]), self.need[t]
            held = [wanted.intersection(map(self.order.get, line)) for line in paragraph]
            later = 0
            for i in range(len(paragraph) - 1, -1, -1):
                both, words, j = held[i], 0, i + 1
                while j < len(paragraph) and words < self.reach[t] and len(both) < size:
                    both, words, j = both | held[j], words + len(paragraph[j]), j + 1
                if len(both) >= need and (len(held[i]) >= need or len(both) > later):
                    yield t, i, j - 1, len(both) / size
                later = len(both)

    def best(self, blocks: list[dict]) -> set[str]:
        """Labels of the blocks that no other block on the same lines meets better; of equals, the longer template's."""
        taken: dict[int, str] = {}
        for b in sorted(blocks, key=lambda b: (-b["containment"], -len(self.sets[b["template"]]), b["line"], b["template"])):
            lines, label = range(b["line"], b["last_line"] + 1), self.labels[b["template"]]
            if all(taken.get(x, label) == label for x in lines):
                taken.update(dict.fromkeys(lines, label))
        return set(taken.values())


def phrase_places(flat: bytes, phrases: dict[bytes, str]) -> dict[str, list[int]]:
    """Starts, in words, of each phrase in words joined by spaces with a space at both ends."""
    found: dict[str, list[int]] = {}
    for phrase, label in phrases.items():
        at, words, counted = flat.find(phrase), 0, 0
        while at >= 0:
            words, counted = words + flat.count(b" ", counted, at), at
            found.setdefault(label, []).append(words)
            at = flat.find(phrase, at + 1)
    return found


def paragraphs(plain: bytes) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(number of the first line, words of each line) of the runs of lines that have words."""
    first, held = 0, []
    for number, line in enumerate(plain.split(b"\n")):
        if words := line.split():
            if not held:
                first = number
            held.append(words)
        elif held:
            yield first, held
            held = []
    if held:
        yield first, held


def scan(documents: DataFrame, threshold: float = 0.8, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row a document (SCHEMA): base phrases, labels, and each block that meets a template (lines from 0).

    `score` is 1 where a base phrase stands, else the highest containment found, else 0.
    """
    frequencies = template_frequencies(documents, templates)
    spark = documents.sparkSession
    index = spark.sparkContext.broadcast(TemplateIndex(templates, frequencies, threshold))
    phrases = {f" {p} ".encode(): label for p, label in PHRASES.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value
        for batch in by_bytes(batches, "text"):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                plain = text.encode().translate(TABLE)
                words = plain.split()
                places = phrase_places(b" " + b" ".join(words) + b" ", phrases)
                blocks = []
                if not known.rare.isdisjoint(words):
                    for first, paragraph in paragraphs(plain):
                        if not all(map(known.rare.isdisjoint, paragraph)):
                            blocks += [{"template": t, "line": first + a, "last_line": first + z, "containment": c} for t, a, z, c in known.notices(paragraph)]
                    blocks.sort(key=lambda b: (b["line"], b["template"]))
                all_places = [p for x in places.values() for p in x]
                labels = sorted(places.keys() | known.best(blocks))
                score = 1.0 if places else max((b["containment"] for b in blocks), default=0.0)
                rows.append((doc, len(words), len(all_places), min(all_places, default=None), max(all_places, default=None), sorted(places), labels, score, blocks))
            names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks"]
            kinds = [pa.int64()] * 5 + [pa.list_(pa.string())] * 2 + [pa.float64(), pa.list_(pa.struct([("template", pa.int32()), ("line", pa.int32()), ("last_line", pa.int32()), ("containment", pa.float64())]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return documents.select("doc_id", "text").mapInArrow(run, SCHEMA)
