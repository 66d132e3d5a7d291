"""Fill in the middle and importance resampling against plain loops."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tablewright.llm import importance_resampling as I
from tablewright.llm.fill_in_middle import CODE_POINT, cut_texts, fill_in_middle, restored
from tablewright.llm.importance_resampling import importance_resampling, resampled

from .frames import documents, empty, odd, odd_rows


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def cut(doc_id, text, unit):
    text = text or ""
    units = [m.group() for m in re.finditer(f"(?:{unit})|(?s:.)", text, re.ASCII)]
    digits = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digits[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm = h[3] % 100 < 20
    return n, "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


def generated(n=250):
    rng = random.Random(31)
    pieces = ["a", "bc ", "\n", "é", "😀", "  ", "<", "P>", "<S", ">", "<M>", "\r\n", "word ", "é"]
    return [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 40)))) for i in range(n)]


@pytest.mark.parametrize(("unit", "block"), [(CODE_POINT, 4096), (CODE_POINT, 3), (r"[^\s]+\s*", 4), (r"[a-z]{2}", 2), (r"\w+|\s+", 4096)])
def test_cuts(spark, unit, block):
    rows = generated()
    out = cut_texts(documents(spark, rows), unit=unit, block=block).withColumn("again", restored()).collect()
    assert len(out) == len(rows)
    for r in out:
        n, form, p, m, output = cut(r.doc_id, rows[r.doc_id][1], unit)
        assert (r.n, r.form, r.output) == (n, form, output)
        assert (r.prefix is None, r.middle is None) == (p is None, m is None) and len(r.prefix or "") == (p or 0) and len(r.middle or "") == (m or 0)
        assert r.again == rows[r.doc_id][1]


def test_cuts_of_a_long_text(spark):
    text = "xyé " * 300_000
    (r,) = fill_in_middle(documents(spark, [(5, text)])).collect()
    n, form, p, m, output = cut(5, text, CODE_POINT)
    assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) == (n, form, p, m, sha(output), sha(text))


def test_cuts_of_odd_rows(spark):
    out = fill_in_middle(odd(spark)).collect()
    expected = Counter((i, *(c := cut(i, t, CODE_POINT))[:4], sha(c[4]), sha(t or "")) for i, t, *_ in odd_rows())
    assert Counter(tuple(r) for r in out) == expected
    assert fill_in_middle(empty(spark)).count() == 0


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(rows, target, percent=5, least=20):
    bucket = lambda run: crc32(run.encode()) % 10000
    runs = [[" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)] for w in (words(t) for _, t in rows)]
    s = Counter(bucket(x) for own in runs for x in own)
    t = Counter(bucket(" ".join(w[i : i + k])) for w in map(words, target) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000))))
    out = []
    for (i, text), own in zip(rows, runs):
        h = int(sha(f"42:{'' if i is None else i}")[:8], 16)
        weight = sum(gain(bucket(x)) for x in own)
        out.append((i, len(words(text)), len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    mine = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    return out, mine[: percent * len(mine) // 100]


def prose(n, seed=32):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "Ünd", "É", "é", "Cat", "x1", "dog's", "a-b", "and"])
    return [(i, " ".join(word() for _ in range(rng.choice([0, 1, 2, 3, 19, 20, 40, 100])))) for i in range(n)]


@pytest.mark.parametrize(("bands", "percent"), [(1024, 5), (4, 30), (2, 100), (1024, 0)])
def test_resampling(spark, monkeypatch, bands, percent):
    monkeypatch.setattr(I, "BANDS", bands)
    rows, target = prose(400), [t for _, t in prose(12, 33)] + [None, "", "one"]
    expected, drawn = plain(rows, target, percent)
    table = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    out = importance_resampling(documents(spark, rows), table, percent).collect()
    assert sorted((r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in out) == expected
    assert {r["rank"]: r.doc_id for r in out if r["rank"] is not None} == {k + 1: r[0] for k, r in enumerate(drawn)}
    kept = resampled(documents(spark, rows), table, percent=percent)
    assert kept.columns == ["doc_id", "text", "lang", "source"] and sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in drawn)


def test_resampling_ties(spark):
    """Scores come from few values, so that ranks within one score go by doc_id over many rows."""
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), (F.xxhash64("id") % 7).alias("score"))
    out = I.with_ranks(rows.repartition(5), F.col("doc_id") % 3 != 0, 40, I.Temporary()).collect()
    mine = sorted((r for r in out if r.doc_id % 3), key=lambda r: (-r.score, r.doc_id))
    assert [r["rank"] for r in mine[: 40 * len(mine) // 100]] == list(range(1, 40 * len(mine) // 100 + 1))
    assert all(r["rank"] is None for r in mine[40 * len(mine) // 100 :]) and sum(r["rank"] is not None for r in out) == 40 * len(mine) // 100 and len(out) == 2000


def test_resampling_odd(spark):
    table = spark.createDataFrame([(1, "the lazy dog"), (2, None)], "item_id long, text string")
    out = importance_resampling(odd(spark), table, 50).collect()
    expected, drawn = plain([(r[0], r[1]) for r in odd_rows()], ["the lazy dog"], 50)
    assert Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in out) == Counter(expected)
    assert sorted(r["rank"] for r in out if r["rank"] is not None) == list(range(1, len(drawn) + 1))
    assert importance_resampling(empty(spark), table).count() == 0
    assert all(r.weight is not None for r in importance_resampling(odd(spark), table.limit(0)).collect())
