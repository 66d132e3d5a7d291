"""What a review found missing: languages without a list, long license files, wordings of real licenses, raking to the end."""

import math
import random
from collections import Counter

import pytest

from tablewright.llm import license_scan as L
from tablewright.llm.quality_rules import corpus_references, quality_rules

from .frames import documents


def js(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    return math.sqrt(max(0.0, sum(0.5 * (x * math.log2(2 * x / (x + y)) if x else 0.0) for a, b in zip(p, q) for x, y in ((a, b), (b, a)))))


def test_every_language_is_judged_by_its_words(spark):
    rng = random.Random(11)
    common = [f"c{i}," if i % 3 else f"c{i}" for i in range(40)]
    word = lambda: common[min(int(rng.expovariate(0.1)), 39)] if rng.random() < 0.5 else f"r{rng.randint(0, 10**6)}"
    texts = [" ".join(word() for _ in range(rng.randint(50, 120))) for _ in range(60)]
    odd = " ".join(f"q{i}" for i in range(200))
    tags = ["it", "EN", "en-US", "en"]
    rows = [(1000 * t + i, x, tag) for t, tag in enumerate(tags) for i, x in enumerate([*texts[t:], odd, "few words"])] + [(9000, "uno due tre", "few"), (9001, " ".join(["uno due"] * 40), "few")]
    docs = documents(spark, [r[:2] for r in rows]).drop("lang").join(spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, lang string"), "doc_id")
    out = {r.doc_id: r for r in quality_rules(docs).collect()}
    for tag in tags:
        own = {i: x.split() for i, x, t in rows if t == tag}
        good = Counter(w for i, x in own.items() if not out[i].base_failed for w in x)
        top = [w for w, _ in sorted(Counter(w for x in own.values() for w in x).items(), key=lambda x: (-x[1], x[0]))[:24]]
        bins = lambda c: [*(c[w] for w in top), c.total() - sum(c[w] for w in top)]
        for i, x in own.items():
            assert out[i].word_distance == (pytest.approx(js(bins(Counter(x)), bins(good)), abs=1e-9) if len(x) >= 60 else None)
    assert not any(out[i].kept for i, x, t in rows if x == odd)
    assert out[9001].word_distance is None and out[9001].base_failed  # of its language no text passes

    given = corpus_references(docs)
    assert {r.doc_id: r for r in quality_rules(docs, references=given).collect()} == out
    alone = quality_rules(docs.where("doc_id = 60"), references=given).collect()  # its corpus doesn't matter then
    assert alone == [out[60]]


GPL = "This program is free software{0} you can redistribute it and/or modify\nit under the terms of the GNU {1}General Public License as published by\nthe Free Software Foundation; either version {2} of the License, or\n(at your option) any later version."
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{0}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""
THIRD = """
3. Neither the name of Example Inc. nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
MIT = """MIT License

Copyright (c) 2020 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
CC = "This work is licensed under a\nCreative Commons {0} 4.0\nInternational License."


@pytest.mark.parametrize(
    "text, licenses",
    [
        (MIT, "MIT"), (ISC, "ISC"), (MPL, "MPL-2.0"), (BSD.format(""), "BSD-2-Clause"), (BSD.format(THIRD), "BSD-3-Clause"),
        (GPL.format(";", "", 2), "GPL-2.0"), (GPL.format(":", "", 3), "GPL-3.0"), (GPL.format(";", "Lesser ", 2), ""), (GPL.format(":", "Affero ", 3), "AGPL-3.0"),
        (CC.format("Attribution"), "CC-BY-4.0"), (CC.format("Attribution-NonCommercial"), "CC-BY-NC-4.0"), (CC.format("Attribution-ShareAlike"), "CC-BY-SA-4.0"),
        (CC.format("Attribution-NonCommercial-ShareAlike"), "CC-BY-NC-SA-4.0"), (CC.format("Attribution-NoDerivatives"), "CC-BY-ND-4.0"),
        ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", "LGPL-3.0"), ("GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", "GPL-3.0"),
        ("Licensed under the Apache License, Version 1.1.", ""), ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"), ("Licensed under CC BY-NC-ND 4.0.", ""),
        ("Not licensed under the MIT License.", ""), ("It is no longer so. It is not, and was never, licensed under the\nMIT License.", ""), ("Do not remove. Licensed under the MIT License.", "MIT"),
        (GPL.format(";", "Lesser ", 2.1), "LGPL-2.1"), ("Distributed under the Boost Software License, Version 1.0.\n(See accompanying file LICENSE_1_0.txt)", "BSL-1.0"),
        ("This is free and unencumbered software released into the public domain.", "Unlicense"), ("1. The origin of this software must not be misrepresented; you must not\n   claim that you wrote the original software.", "Zlib"),
        ("Licensed under the MIT License.\nLicensed under the ISC terms.\nReleased under the ISC License.", "ISC,MIT"),
    ],
)
def test_wordings_of_real_licenses(text, licenses):
    for x in (text, "# " + text.replace("\n", "\n# "), f"Some words before.\n\n{text}\n\nAnd some words after it, as ever."):
        found = {name for b in L.blocks_of(x) for name, *_ in L.Scanner().licenses_of(b)}
        assert ",".join(sorted(found)) == licenses


@pytest.mark.parametrize("n", [50, 500, 5000])
def test_long_license_files_lose_no_notice(n):
    rng = random.Random(12)
    lines = [f"p{rng.randint(0, 10**6)} - Licensed under the MIT License." for _ in range(n)]
    lines[n // 2] = "Licensed under the Apache License, Version 2.0."
    (block,) = L.blocks_of("\n".join(lines))
    assert {name for name, *_ in L.Scanner().licenses_of(block)} == {"MIT", "Apache-2.0"}


def test_parts_near_a_notice_hold_every_run_within_the_bound():
    rng = random.Random(13)
    for _ in range(400):
        notice = [rng.choice("abcde") for _ in range(rng.randint(7, 20))]
        allowed = int(L.DIFFERENT * len(notice))
        own = [w for w in notice if rng.random() > 0.08]
        block = [rng.choice("abcdefg") for _ in range(30)] + own + [rng.choice("abcdefg") for _ in range(30)]
        parts = L.near_parts(notice, block, f" {' '.join(block)} ", allowed)
        whole, least = L.nearest(notice, block)[0], min((L.nearest(notice, block[a:b])[0] for a, b in parts), default=99)
        assert whole == least if whole <= allowed else least > allowed
