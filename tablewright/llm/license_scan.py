"""License scans: passages whose words differ little from a license's wording, and the license that compresses them best.

Sentences with a word that licenses use, and runs of them, are candidate blocks. Passages of a block that hold a notice
of a license, but for a few words, are its candidates. Where the passages of several licenses overlap, the words of all
of them are compressed once alone and once with each license's template as a raw dictionary; the licenses are ranked by
what that saves, and the winner alone is named. A notice that a word such as "not" comes just before is none.

Each document is scanned on its own; the templates are fixed, so nothing grows with the corpus but the output.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# For each license the words that a notice must keep where its wording has them, and wordings: short
# notices, standard headers, titles and passages of full texts. The BSD texts begin alike; BSD-2-Clause is the one whose
# second condition is followed by the disclaimer.
CC = "This work is licensed under a Creative Commons {0} 4.0 International License.", "Creative Commons {0} 4.0 International Public License"
GPL_HEADER = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {1}General Public License as published by the Free Software Foundation, either version {0} of the License, or (at your option) any later version."
GPL_ONLY = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {1}General Public License version {0} as published by the Free Software Foundation."
GPL_NOTICE = "This work is licensed under the GNU {1}General Public License, version {0}."
GNU = GPL_NOTICE, GPL_HEADER, GPL_ONLY
LICENSES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "AGPL-3.0": (("affero", "3"), (*(x.format("3", "Affero ") for x in GNU), "GNU Affero General Public License Version 3, 19 November 2007")),
    "Apache-2.0": (("apache", "2", "0"), ("Licensed under the Apache License, Version 2.0.", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.', "Apache License Version 2.0, January 2004")),
    "BSD-2-Clause": (("bsd", "2", "binary", "distribution", "this", "software"), ("Licensed under the BSD 2-Clause License.", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. This software is provided by the copyright holders and contributors")),
    "BSD-3-Clause": (("bsd", "3", "redistribution", "binary", "endorse"), ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "Licensed under the BSD 3-Clause License.", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.")),
    "BSL-1.0": (("boost", "1", "0", "organization"), ("Distributed under the Boost Software License, Version 1.0.", "Boost Software License - Version 1.0 - August 17th, 2003", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license")),
    "CC-BY-4.0": (("attribution", "4", "0"), ("Licensed under CC BY 4.0.", *(x.format("Attribution") for x in CC))),
    "CC-BY-NC-4.0": (("nc", "attribution", "noncommercial", "4", "0"), ("Licensed under CC BY-NC 4.0.", *(x.format("Attribution-NonCommercial") for x in CC))),
    "CC-BY-NC-SA-4.0": (("nc", "sa", "attribution", "noncommercial", "sharealike", "4", "0"), ("Licensed under CC BY-NC-SA 4.0.", *(x.format("Attribution-NonCommercial-ShareAlike") for x in CC))),
    "CC-BY-ND-4.0": (("nd", "attribution", "noderivatives", "4", "0"), ("Licensed under CC BY-ND 4.0.", *(x.format("Attribution-NoDerivatives") for x in CC))),
    "CC-BY-SA-4.0": (("sa", "attribution", "sharealike", "4", "0"), ("Licensed under CC BY-SA 4.0.", *(x.format("Attribution-ShareAlike") for x in CC))),
    "CC0-1.0": (("cc0", "0"), ("Licensed under CC0 1.0.", "CC0 1.0 Universal", "This work is dedicated to the public domain under CC0 1.0 Universal.")),
    "EPL-2.0": (("eclipse", "2", "0"), ("Licensed under the Eclipse Public License 2.0.", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "Eclipse Public License - v 2.0")),
    "GPL-2.0": (("gnu", "general", "public", "2"), (*(x.format("2", "") for x in GNU), "GNU General Public License Version 2, June 1991")),
    "GPL-3.0": (("gnu", "general", "public", "3"), (*(x.format("3", "") for x in GNU), "GNU General Public License Version 3, 29 June 2007")),
    "ISC": (("isc",), ("Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.")),
    "LGPL-2.1": (("lesser", "2", "1"), (*(x.format("2.1", "Lesser ") for x in GNU), "GNU Lesser General Public License Version 2.1, February 1999")),
    "LGPL-3.0": (("lesser", "3"), (*(x.format("3", "Lesser ") for x in GNU), "GNU Lesser General Public License Version 3, 29 June 2007")),
    "MIT": (("mit",), ("Released under the MIT License.", "Licensed under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software")),
    "MPL-2.0": (("mozilla", "2", "0"), ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Mozilla Public License Version 2.0")),
    "Unlicense": (("unencumbered", "unlicense"), ("This is free and unencumbered software released into the public domain.", "Released under the Unlicense.")),
    "Zlib": (("zlib", "origin"), ("Released under the zlib License.", "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.")),
}
#: Just before a notice, in its sentence, these make it none.
NEGATIONS = frozenset("not never nor cannot isn aren wasn weren".split())
NEGATED_WITHIN = 4
#: Words that make a notice one of another license: a run that holds one that the wording lacks is none of it.
TELLING = frozenset("affero lesser library commercial non noncommercial nc share alike sharealike sa noderivatives noderivs nd".split())
CUE = re.compile(r"licen[sc]e|redistribut|permission\W+(?:is|to)\b|public\W+license|mozilla\W+public|source\W+code\W+form|creative\W+commons|public\W+domain|CC0|misrepresented|Boost\W+Software|endorse\W+or\W+promote|copyright", re.IGNORECASE)
#: A wrapped sentence goes on over so many words without a cue at most; the longest wording has fewer.
GOES_ON = 80
#: A sentence ends after a word or a number, not after an initial such as "v.".
SENTENCE = re.compile(r"(?:(?<=[0-9A-Za-z.][0-9A-Za-z][.!?])[\x20\t]+|\n)")
#: Between two words: the end of a sentence, or a blank line.
SENTENCE_END = re.compile(r"[.!?;][\s\"')\]]|\n\s*\n")
#: Where a sentence ends with its line.
ENDS = re.compile(r"[.!?][\"')\]]*[\x20\t]*$")
WORD = re.compile(r"[0-9a-z]+|[^\x00-\x7F]+")
#: Share of a notice's words that may differ.
DIFFERENT = 0.15
LEVEL = 3


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def blocks_of(text: str) -> list[str]:
    """Runs of sentences (or lines) that each hold a cue or go on with a sentence that does; lines without words end no run."""
    if not CUE.search(text):
        return []
    found, run, left = [], [], 0
    for sentence in SENTENCE.split(text):
        if CUE.search(sentence):
            run.append(sentence)
            left = GOES_ON
        elif run and left > 0:
            run.append(sentence)
            left -= len(words_of(sentence))
        elif run and words_of(sentence):
            found.append(" ".join(run))
            run = []
        if ENDS.search(sentence):
            left = 0
    return found + ([" ".join(run)] if run else [])


def beginnings(block: str) -> list[bool]:
    """For each word of the block whether a notice may begin there: not where its sentence negates it just before."""
    found, barred, end = [], 0, 0
    for word in WORD.finditer(block.lower()):
        if SENTENCE_END.search(block, end, word.start()):
            barred = 0
        found.append(barred <= 0)
        barred, end = NEGATED_WITHIN if word[0] in NEGATIONS else barred - 1, word.end()
    return found


def nearest(notice: list[str], block: list[str], begins: list[bool] | None = None, keep: frozenset[str] = frozenset(), stop: frozenset[str] = frozenset()) -> tuple[float, int, int]:
    """The least number of words to insert, drop or replace that makes notice a run of words of block, and the run's bounds.

    Words of notice in keep are neither dropped nor replaced, a run holds no word in stop, and begins only where it may;
    infinite without one.
    """
    drop = [math.inf if own in keep else 1 for own in notice]
    # For each number of words of notice: the cost so far, and where the run began.
    empty = lambda at: list(zip(accumulate(drop, initial=0 if begins is None or at >= len(begins) or begins[at] else math.inf), [at] * (len(notice) + 1)))
    costs = empty(0)
    best = (*costs[-1], 0)
    for at, word in enumerate(block):
        if word in stop:
            costs = empty(at + 1)
            continue
        above, costs[0] = costs[0], empty(at + 1)[0]
        for k, own in enumerate(notice, 1):
            same = (above[0] + (drop[k - 1] if own != word else 0), above[1])
            above, costs[k] = costs[k], min(same, (costs[k][0] + 1, costs[k][1]), (costs[k - 1][0] + drop[k - 1], costs[k - 1][1]))
        if costs[-1][0] < best[0]:
            best = (*costs[-1], at + 1)
    return best


def near_parts(notice: list[str], block: list[str], text: str, allowed: int) -> list[tuple[int, int]]:
    """Bounds of the parts of block (text: its words, each between spaces) that hold every run within allowed differences of notice.

    One of allowed + 1 pieces of the notice is unchanged in such a run, which begins and ends near where the piece says.
    """
    cuts = [len(notice) * k // (allowed + 1) for k in range(allowed + 2)]
    hits = [(at.start(), a) for a, b in zip(cuts, cuts[1:]) for at in re.finditer(f"(?= {re.escape(' '.join(notice[a:b]))} )", text)]
    if not hits:
        return []
    place = {at: i for i, at in enumerate(accumulate((len(w) + 1 for w in block), initial=0))}
    spans = []
    for begin in sorted(place[at] - a - allowed for at, a in hits):
        begin, end = max(begin, 0), begin + len(notice) + 2 * allowed
        if spans and begin <= spans[-1][1]:
            spans[-1][1] = end
        else:
            spans.append([begin, end])
    return [(begin, end) for begin, end in spans]


def wordings_of(name: str) -> list[tuple[list[str], frozenset[str], frozenset[str]]]:
    """For each wording of the license: its words, those that must stay, and those that a run of it must not hold."""
    must, notices = LICENSES[name]
    return [(n, frozenset(must) & set(n), TELLING - set(n)) for n in map(words_of, notices)]


WORDINGS = {name: wordings_of(name) for name in LICENSES}


def candidates(name: str, block: list[str], begins: list[bool] | None = None) -> list[tuple[int, int, int]]:
    """Differing words, begin and end of the passages near a notice of the license that keep the words it must."""
    text = f" {' '.join(block)} "
    found = []
    for k, (notice, keep, stop) in enumerate(WORDINGS[name]):
        allowed = int(DIFFERENT * len(notice))
        if name == "BSD-3-Clause" and k == 0 and "endorse" not in block and candidates("BSD-2-Clause", block, begins):
            continue  # both texts begin so, and this one goes on as the other
        for begin, end in near_parts(notice, block, text, allowed):
            differing, a, b = nearest(notice, block[begin:end], begins and begins[begin:end], keep, stop)
            if differing <= allowed:
                found.append((differing, begin + a, begin + b))
    return found


class Scanner:
    def __init__(self):
        self.plain = zstandard.ZstdCompressor(level=LEVEL)
        raw = lambda text: zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.with_template = {name: zstandard.ZstdCompressor(level=LEVEL, dict_data=raw(" ".join(words_of(" ".join(notices))))) for name, (_, notices) in LICENSES.items()}

    def licenses_of(self, block: str) -> list[tuple[str, int, float]]:
        """The licenses of a block, each with its differing words and the largest share of bytes that its template saves.

        Passages that overlap, in a chain, are one place; of its licenses the one that saves most wins, and what the
        winner's own passages don't touch is decided next.
        """
        words, begins = words_of(block), beginnings(block)
        passages = [(begin, end, name, differing) for name in LICENSES for differing, begin, end in candidates(name, words, begins)]
        found: dict[str, tuple[int, float]] = {}
        while passages:
            passages.sort()
            place, reach = [], 0
            for p in passages:
                if place and p[0] >= reach:
                    break
                place.append(p)
                reach = max(reach, p[1])
            data = " ".join(words[place[0][0] : reach]).encode()
            alone = len(self.plain.compress(data))
            savings = {name: 1 - len(self.with_template[name].compress(data)) / alone for name in {p[2] for p in place}}
            winner = min(place, key=lambda p: (-savings[p[2]], p[3], p[2]))[2]
            own = [p for p in place if p[2] == winner]
            before = found.get(winner, (math.inf, 0.0))
            found[winner] = (min(before[0], *(p[3] for p in own)), max(before[1], savings[winner])) if before[0] < math.inf else (min(p[3] for p in own), savings[winner])
            passages = [p for p in passages if p[2] != winner and not any(p[0] < q[1] and q[0] < p[1] for q in own) or p not in place]
        return sorted(((name, differing, saving) for name, (differing, saving) in found.items()), key=lambda x: (-x[2], x[0]))


def license_scan(documents: DataFrame) -> DataFrame:
    """For each row of documents (doc_id, text): n_blocks, n_confirmed, licenses, n_differences and best_saving.

    n_confirmed: pairs of a block and a license that wins in it; licenses: their ids, sorted, comma-joined;
    n_differences: words that differ, summed over them; best_saving: the largest share of a confirmed block's bytes that its template saves, 0 where none does. A null
    or empty text has no blocks. Repeated rows give repeated results; other columns are ignored.
    """
    kept: list[Scanner] = []

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = kept[0] if kept else kept.append(Scanner()) or kept[0]
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                blocks = blocks_of(text or "")
                found = [x for block in blocks for x in scanner.licenses_of(block)]
                rows.append((len(blocks), len(found), ",".join(sorted({x[0] for x in found})), sum(x[1] for x in found), round(max((x[2] for x in found if x[2] > 0), default=0.0), 6)))
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_blocks", "n_confirmed", "licenses", "n_differences", "best_saving"])

    df = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return df.mapInArrow(scan, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, n_blocks long, n_confirmed long, licenses string, n_differences long, best_saving double")
