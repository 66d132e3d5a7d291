"""Operators that judge each document: against plain loops, on generated and on odd texts."""

import hashlib
import math
import random
import re
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablewright.llm import decontamination as D
from tablewright.llm import license_scan as L
from tablewright.llm import token_counts as T
from tablewright.llm.quality_classifier import FEATURES, bradley_terry, good_documents, held_out, quality_classifier
from tablewright.llm.quality_rules import quality_rules
from tablewright.llm.secret_scan import secret_scan
from tablewright.llm.token_counts import prove_whole_tokens, token_counts

from .frames import documents, empty, odd, odd_rows

SPACE = re.compile(r"[\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def base(text):
    w = words(text)
    wins = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(wins)
    covered = {i + k for i, x in enumerate(wins) if n[x] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed


def test_quality_rules_base(spark):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice(["a ", "bc ", "d\n", "# ", "e\te ", "ß|"]) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    for r in quality_rules(documents(spark, rows)).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(rows[r.doc_id][1])


def test_quality_rules_tell_junk_from_prose(spark):
    rng = random.Random(2)
    common = "the of and to in a is that for it as was with be by on not".split()
    word = lambda: rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(3, 9)))
    prose = [(i, " ".join(word() for _ in range(200)).capitalize() + ".") for i in range(40)]
    junk = [(100 + i, " ".join(word().upper() + "!!" for _ in range(200))) for i in range(3)]
    kept = {r.doc_id: r.kept for r in quality_rules(documents(spark, prose + junk)).collect()}
    assert all(kept[i] for i, _ in prose) and not any(kept[i] for i, _ in junk)


def test_quality_rules_odd(spark):
    out = quality_rules(odd(spark)).collect()
    expected = Counter((r[0], *base(r[1])) for r in odd_rows())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out) == expected
    assert quality_rules(empty(spark)).count() == 0


def labelled(spark, n=400):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        text = " ".join("".join(rng.choice("etaoinsh") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(3, 80)))
        rows.append((i, text if good else text.upper().replace(" ", "!! # ")))
        labels.append((i, int(good), 0))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifier_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    out = quality_classifier(docs, labels).join(labels, "doc_id").collect()
    unseen = [r for r in out if r.held_out]
    assert len(unseen) > 50 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    assert sum(r.predicted == r.quality for r in unseen) / len(unseen) > 0.97
    assert good_documents(docs, labels).columns == docs.columns
    assert good_documents(docs, labels).count() == sum(r.predicted for r in out)


def test_classifier_never_learns_from_held_out_labels(spark):
    docs, labels = labelled(spark)
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = lambda x: {r.doc_id: r.score for r in quality_classifier(docs, x).collect()}
    assert scores(labels) == scores(turned)


def test_classifier_odd(spark):
    docs, labels = labelled(spark, 100)
    more = labels.union(spark.createDataFrame([(None, 1, 0), (1, None, 0), (1, 0, 0), (2, 5, 0), (10**6, 1, 0)], labels.schema))
    train = docs.select("doc_id", "text").union(odd(spark).select(F.col("doc_id") + 1000, "text"))
    assert quality_classifier(train, more).where("score IS NULL OR predicted IS NULL OR held_out IS NULL").count() == 0
    assert quality_classifier(odd(spark), more).count() == len(odd_rows())
    assert {r.score for r in quality_classifier(odd(spark), labels.limit(0)).collect()} == {1.0}
    assert quality_classifier(empty(spark), labels).count() == 0


def test_bradley_terry_is_what_slow_descent_finds():
    """The weights against plain gradient descent on the same pairs, written apart."""
    import numpy as np

    rng = np.random.default_rng(6)
    n = len(FEATURES)
    x = rng.normal(size=(120, n))
    y = (x[:, 0] - x[:, 1] + rng.normal(size=120) > 0.4).astype(int)
    fit = bradley_terry(x, y, pairs=3000, penalty=0.05, seed=3)
    good, bad, draws = x[y == 1], x[y == 0], np.random.default_rng(3)
    scale = np.maximum(x.std(axis=0), 0.01)
    better, worse = draws.integers(len(good), size=3000), draws.integers(len(bad), size=3000)
    d = (good[better] - bad[worse]) / scale
    w = np.zeros(n)
    for _ in range(3000):
        w += 0.3 * ((d / (1 + np.exp(d @ w))[:, None]).mean(axis=0) - 0.05 * w)
    assert np.allclose(fit.weights * scale, w, atol=1e-4)
    raw = np.sort(x @ fit.weights)
    assert (x @ fit.weights >= fit.cut).sum() == len(good) and raw[len(bad) - 1] <= fit.cut <= raw[len(bad)]


def test_bradley_terry_orders_pairs():
    import numpy as np

    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, len(FEATURES)))
    y = (x[:, 0] - 2 * x[:, 3] > 0).astype(int)
    raw = x @ bradley_terry(x, y, pairs=5000).weights
    assert np.mean(raw[y == 1][:, None] > raw[y == 0][None, :]) > 0.99


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_hits(docs, items):
    of = lambda t: WORD.findall((t or "").translate(LOWER))
    windows = [(str(i) if i is not None else "", tuple(w[k : k + 10])) for i, t in items if (w := of(t)) for k in range(max(1, len(w) - 9))]
    out = []
    for i, t in docs:
        w, hit, ids = of(t), set(), set()
        for item, x in windows:
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k : k + len(x)]) == x:
                    hit.update(range(k, k + len(x)))
                    ids.add(item)
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


@pytest.mark.parametrize("bits", [D.MAX_BITS, 64])
def test_decontamination(spark, monkeypatch, bits):
    monkeypatch.setattr(D, "MAX_BITS", bits)  # so few let nearly all shingles through
    rng = random.Random(4)
    word = lambda: rng.choice(["a", "B", "c-d", "É", "e1"])
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 3, 10, 14])))) for i in range(8)] + [(3, "a b c"), (None, "zz yy"), (9, None)]
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(40)] + [(50, "x " + items[-4][1] + " zz, YY!"), (51, None), (51, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert Counter(map(tuple, D.decontamination(documents(spark, docs), bench).collect())) == brute_hits(docs, items)
    clean = D.clean_documents(documents(spark, docs), bench)
    assert clean.columns == documents(spark, docs).columns
    assert clean.count() == sum(n for x, n in brute_hits(docs, items).items() if not x[-1])


def test_decontamination_odd(spark):
    bench = spark.createDataFrame([(1, "quick brown fox"), (2, "w17 w18 w19 w20 w21 w22 w23 w24 w25 w26 w27")], "item_id long, text string")
    assert Counter(map(tuple, D.decontamination(odd(spark), bench).collect())) == brute_hits([r[:2] for r in odd_rows()], [(1, "quick brown fox"), (2, "w17 w18 w19 w20 w21 w22 w23 w24 w25 w26 w27")])
    assert D.decontamination(empty(spark), bench).count() == 0
    assert D.decontamination(odd(spark), bench.limit(0)).where("contaminated").count() == 0


def test_token_counts_are_the_librarys(spark):
    rng = random.Random(6)
    pieces = ["the", "The", "re-do", "can't", "CAN'T", "straße", "ÉTÉ", "é", "日本語", "a1b22", " ", " ", "<|endoftext|>", "<|startoftext|>x", "...", "!!", "\n", "\t", "🙂", "don't've", "'s", "İ", "Σας", "x́̂", "\x1f", "\x0b", "ﬁ", "①"]
    texts = [" ".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(200)] + ["".join(rng.choice(pieces) for _ in range(20)) for _ in range(100)] + [r[1] for r in odd_rows()]
    tokenizer = Tokenizer.from_file(TOKENIZER)
    expected = Counter((i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts))
    out = token_counts(documents(spark, list(enumerate(texts))), TOKENIZER, over=50).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in out) == expected
    assert all(r.over_limit == (r.n_tokens > 50) for r in out)
    assert token_counts(empty(spark), TOKENIZER).count() == 0
    assert token_counts(odd(spark), TOKENIZER).count() == len(odd_rows())


def test_other_tokenizers_encode_whole_texts(spark, tmp_path):
    import json

    with open(TOKENIZER, encoding="utf-8") as file:
        source = json.load(file)
    assert T.counts_by_word(json.dumps(source))
    source["normalizer"]["normalizers"].pop()
    source["pre_tokenizer"] = None  # words now stick together
    source["truncation"] = {"max_length": 3, "strategy": "LongestFirst", "stride": 0, "direction": "Right"}
    assert not T.counts_by_word(json.dumps(source))
    (tmp_path / "other.json").write_text(json.dumps(source))
    tokenizer = Tokenizer.from_str(json.dumps(source))
    tokenizer.no_truncation()
    texts = ["the Cat sat on the mat and then", "", None, "don't  stop"]
    out = {r.doc_id: r.n_tokens for r in token_counts(documents(spark, list(enumerate(texts))), str(tmp_path / "other.json")).collect()}
    assert out == {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_whole_tokens_are_single(spark):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    whole = prove_whole_tokens(tokenizer)
    assert len(whole) > 20000
    for w in random.Random(7).sample([w for w in whole if w.isascii() and w.isalpha()], 500):
        assert len(tokenizer.encode(w, add_special_tokens=False).ids) == 1


def word_edits(notice, run, keep, stop):
    """Edit distance of two lists of words, by the plain table; words of keep neither dropped nor replaced."""
    if stop & set(run):
        return math.inf
    table = {(0, 0): 0}
    for i in range(len(notice) + 1):
        for j in range(len(run) + 1):
            if i or j:
                cost = math.inf if i and notice[i - 1] in keep else 1
                ways = [table[i - 1, j] + cost] if i else []
                ways += [table[i, j - 1] + 1] if j else []
                ways += [table[i - 1, j - 1] + (0 if notice[i - 1] == run[j - 1] else cost)] if i and j else []
                table[i, j] = min(ways)
    return table[len(notice), len(run)]


def brute_licenses(text):
    """Licenses of which any run of the whole text's words is near a wording, by trying all runs."""
    words = re.findall(r"[0-9a-z]+|[^\x00-\x7F]+", text.lower())
    found = set()
    for name, (must, notices) in L.LICENSES.items():
        for notice in notices:
            own = re.findall(r"[0-9a-z]+|[^\x00-\x7F]+", notice.lower())
            allowed = int(0.15 * len(own))
            keep, stop = set(must) & set(own), set(L.TELLING) - set(own)
            for i in range(len(words)):
                for n in range(len(own) - allowed, len(own) + allowed + 1):
                    if n <= len(words) - i and word_edits(own, words[i : i + n], keep, stop) <= allowed:
                        found.add(name)
    return found


def test_license_scan_finds_what_trying_all_runs_finds(spark):
    rng = random.Random(8)
    notices = [n for _, ns in L.LICENSES.values() for n in ns if len(n) < 110]
    rows = []
    for i in range(40):
        words = rng.choice(notices).split()
        for _ in range(rng.randint(0, 2)):
            k = rng.randrange(len(words))
            words[k : k + 1] = rng.choice([[], ["green"], [words[k], "house"], [words[k], "Lesser"]])
        notice = " ".join(words).upper().replace(" ", " *** ") if rng.random() < 0.3 else " ".join(words)
        filler = " ".join(rng.choice(["green", "tree", "house", "over"]) for _ in range(rng.randint(0, 12)))
        rows.append((i, f"{filler}.\n{notice}\n{filler}" if rng.random() < 0.9 else filler + " copyright of nothing"))
    found = {r.doc_id: set(r.licenses.split(",")) - {""} for r in L.license_scan(documents(spark, rows)).collect()}
    brute = {i: brute_licenses(t) for i, t in rows}
    assert all(found[i] <= brute[i] and bool(found[i]) == bool(brute[i]) for i, _ in rows)
    assert all(found[i] == brute[i] for i, _ in rows if len(brute[i]) == 1)
    assert sum(map(len, brute.values())) > 20 and sum(not x for x in brute.values()) > 4
    assert L.license_scan(documents(spark, rows)).where("n_confirmed <> size(filter(split(licenses, ','), x -> x <> '')) AND n_blocks <= 1").count() == 0
    assert L.license_scan(empty(spark)).count() == 0
    assert L.license_scan(odd(spark)).where("n_blocks IS NULL OR licenses IS NULL").count() == 0


def test_license_differences():
    w = L.words_of
    assert L.nearest(w("released under the mit license"), w("this is released under an mit license today")) == (1, 2, 7)
    assert L.nearest(w("a b c"), w(""))[0] == 3
    assert L.candidates("MIT", w("Released under the BSD License.")) == []


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_secrets(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text or "") if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text or "") if len(m[0]) >= 16]
    return sorted(spans)


def digest(spans):
    return hashlib.sha256(",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()


def test_secret_spans(spark):
    rng = random.Random(9)
    pieces = ["token = ", "API_KEY:", "apikey='", "password=\"", "secret", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "é", " ", "\n", "deadbeef", "=", "'", "Token  :  ", "xyzt-12"]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))) for i in range(300)]
    for r in secret_scan(documents(spark, rows)).collect():
        spans = brute_secrets(rows[r.doc_id][1])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, k, _ in spans) for x in range(3))
        assert r.base_sha256 == digest(spans)
        assert {f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in spans} <= set(r.spans.split(","))


def test_copied_values_are_examples(spark):
    copied, own = "0123456789abcdef0123", "fedcba98765432100000"
    rows = [(i, f"key {copied}") for i in range(10)] + [(20, f"key {own}"), (21, f"id Zx9-{'Q' * 20}"), (22, None)]
    out = {r.doc_id: r for r in secret_scan(documents(spark, rows)).collect()}
    assert all(out[i].n_example == 1 and out[i].n_live == 0 for i in range(10))
    assert out[20].n_live == 1 and out[21].spans.startswith("opaque:3:") and out[21].n_hex == 0
    assert out[22].spans == "" and out[22].base_sha256 == digest([])


def test_secrets_odd(spark):
    out = secret_scan(odd(spark)).collect()
    assert Counter((r.doc_id, r.base_sha256) for r in out) == Counter((r[0], digest(brute_secrets(r[1]))) for r in odd_rows())
    assert secret_scan(empty(spark)).count() == 0
