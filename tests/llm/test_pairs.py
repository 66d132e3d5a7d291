"""Operators that compare rows with each other: against brute force, on generated and on odd rows."""

import datetime
import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import line_dedup as L
from tablewright.llm import ngram_jaccard as N
from tablewright.llm.line_dedup import deduplicated, line_dedup
from tablewright.llm.source_mixing import UnmetTargets, rake, sample_documents, source_mixing
from tablewright.llm.url_filters import host_of, url_filters

from .frames import documents, empty, odd, odd_rows

# --- line dedup


def apart(a, b):
    """Whether one inserted, dropped or replaced character makes a of b, or none."""
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]
    return True


def plain(line):
    return re.sub(r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ", line).strip(" ").lower()


def brute_lines(rows):
    at = [((i, k), plain(x)) for i, t in rows if i is not None and t is not None for k, x in enumerate(t.split("\n")) if plain(x)]
    first = {}
    for place, p in at:
        first[p] = min(first.get(p, place), place)
    forms = list(first)
    near = {p for p in forms if any(q != p and first[q] < first[p] and apart(p, q) for q in forms)}
    out = []
    for i, t in rows:
        lines = t.split("\n") if t is not None else []
        own = [plain(x) for x in lines]
        exact = [i is not None and bool(p) and (i, k) > first[p] for k, p in enumerate(own)]
        close = [i is not None and not e and p in near for e, p in zip(exact, own)]
        kept = "\n".join(x for x, e, c in zip(lines, exact, close) if not e and not c)
        out.append((i, len(lines), sum(exact), sum(close), len(kept), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def edited(rng, line):
    k = rng.randint(0, len(line))
    c = rng.choice("abé ")
    return rng.choice([line[:k] + c + line[k:], line[:k] + line[k + 1 :], line[:k] + c + line[k + 1 :]])


def test_line_dedup_finds_all_single_edits(spark):
    rng = random.Random(1)
    bases = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(1, 60))) for _ in range(25)]
    pool = [x for b in bases for x in [b, *(edited(rng, b) for _ in range(6)), edited(rng, edited(rng, b))]]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 6)))) for i in range(90)]
    expected = brute_lines(rows)
    assert sum(n * x[3] for x, n in expected.items()) > 40
    assert Counter(map(tuple, line_dedup(documents(spark, rows)).collect())) == expected


def test_line_dedup_cuts_long_parts_again(spark, monkeypatch):
    """With parts of at most one character, lines of up to 400 go through two cuts."""
    monkeypatch.setattr(L, "FEW", 1)
    rng = random.Random(2)
    bases = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([1, 2, 11, 12, 13, 40, 150, 400]))) for _ in range(20)] + ["a" * 30, "ab" * 20]
    pool = [x for b in bases for x in [b, *(edited(rng, b) for _ in range(5)), edited(rng, edited(rng, b))]]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 6)))) for i in range(80)]
    expected = brute_lines(rows)
    assert sum(n * x[3] for x, n in expected.items()) > 40
    assert Counter(map(tuple, line_dedup(documents(spark, rows)).collect())) == expected


def test_line_dedup_of_lines_of_a_megabyte(spark):
    rng = random.Random(3)
    line = "".join(rng.choices("abcdefgh é", k=1_000_000)).strip()
    at = 777_777
    other = "Z" + line[1:500_000] + "Z" + line[500_001:]
    rows = [(1, line), (2, line[:at] + "Z" + line[at:]), (3, line[:at] + line[at + 1 :]), (4, line[:at] + "Y" + line[at + 1 :]), (5, line[:-1]), (6, other)]
    assert [x[3] for x in sorted(brute_lines(rows))] == [0, 1, 1, 1, 1, 0]
    began = time.perf_counter()
    assert Counter(map(tuple, line_dedup(documents(spark, rows)).collect())) == brute_lines(rows)
    assert time.perf_counter() - began < 120


def test_line_dedup_odd(spark):
    rows = [r[:2] for r in odd_rows()]
    assert Counter(map(tuple, line_dedup(odd(spark)).collect())) == brute_lines(rows)
    assert line_dedup(empty(spark)).count() == 0
    kept = deduplicated(odd(spark))
    assert kept.columns == odd(spark).columns
    # 6 repeats 1; nothing else loses all its words.
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter(r[0] for r in odd_rows() if r[0] != 6)
    assert deduplicated(empty(spark)).count() == 0


def test_line_dedup_of_short_lines_and_string_ids(spark):
    rng = random.Random(8)
    rows = [(f"d{i}", "\n".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(0, 6))) for _ in range(3))) for i in range(60)]
    out = line_dedup(spark.createDataFrame(rows, "doc_id string, text string"))
    assert Counter(map(tuple, out.collect())) == brute_lines(rows)


def test_line_dedup_of_one_line_in_all_documents(spark):
    rows = [(i, f"a line that all documents share\nand line number {'x' * i} of its own") for i in range(60)]
    assert Counter(map(tuple, line_dedup(documents(spark, rows)).collect())) == brute_lines(rows)


# --- n-gram Jaccard join


def shingle_set(text, words=4):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()


def brute_components(rows, words=4, percent=85):
    sets = [(i, shingle_set(t, words)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            c = len(a & b)
            if a and b and 100 * c >= percent * (len(a) + len(b) - c):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return Counter((i, len(s), find(i)) for i, s in sets)


def near_copies(rng, groups=12, copies=12, size=80):
    vocabulary = [f"v{k}" for k in range(400)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, size))]
        for _ in range(rng.randint(1, copies)):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(w) if rng.random() < 0.9 else "  ".join(w).upper()))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("group,queries", [(N.GROUP_DOCS, N.QUERY_DOCS), (3, 2)])
def test_components_are_those_of_brute_force(spark, monkeypatch, group, queries):
    monkeypatch.setattr(N, "GROUP_DOCS", group)
    monkeypatch.setattr(N, "QUERY_DOCS", queries)
    rows = near_copies(random.Random(2))
    assert Counter(map(tuple, N.ngram_jaccard(documents(spark, rows)).collect())) == brute_components(rows)


@pytest.mark.parametrize("seed", range(3))
def test_groups_are_opened_where_leaders_link_nothing(spark, monkeypatch, seed):
    """Chains of slowly changing texts: most links are between classes that their leader isn't linked with."""
    monkeypatch.setattr(N, "GROUP_DOCS", 4)
    rng = random.Random(seed)
    rows = []
    for g in range(6):
        w = [f"g{g}w{k}" for k in range(rng.randint(30, 90))]
        for _ in range(14):
            w = list(w)
            w[rng.randrange(len(w))] = f"n{rng.random()}"
            rows.append((len(rows), " ".join(w)))
    rng.shuffle(rows)
    expected = brute_components(rows)
    assert 6 <= len({x[2] for x in expected}) < 60
    assert Counter(map(tuple, N.ngram_jaccard(documents(spark, rows)).collect())) == expected


def test_other_sizes_of_shingles(spark):
    rows = near_copies(random.Random(3), groups=6)
    assert Counter(map(tuple, N.ngram_jaccard(documents(spark, rows), 5, 80).collect())) == brute_components(rows, 5, 80)


def test_string_ids(spark):
    rows = near_copies(random.Random(9), groups=4)
    named = [(f"d{i:03d}", t) for i, t in rows]
    out = N.ngram_jaccard(spark.createDataFrame(named, "doc_id string, text string"))
    assert Counter(map(tuple, out.collect())) == brute_components(named)


def test_shared_passages_alone_link_nothing(spark):
    rng = random.Random(4)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(i, " ".join(f"u{rng.random()}" for _ in range(150)) + " " + passage) for i in range(150)]
    assert all(r.component_id == r.doc_id for r in N.ngram_jaccard(documents(spark, rows)).collect())


def test_components_odd(spark):
    out = Counter(map(tuple, N.ngram_jaccard(odd(spark)).collect()))
    rows = [r[:2] for r in odd_rows()]
    named = brute_components([r for r in rows if r[0] is not None])
    assert {k: v for k, v in out.items() if k[0] is not None} == dict(named)
    assert sum(v for k, v in out.items() if k[0] is None) == 2
    assert N.ngram_jaccard(empty(spark)).count() == 0
    assert sorted(str(r.doc_id) for r in N.distinct_documents(odd(spark)).collect()) == sorted(["1", "2", "3", "4", "5", "7", "8", "9", "10", "None", "None"])
    assert N.distinct_documents(odd(spark)).columns == odd(spark).columns
    assert N.distinct_documents(empty(spark)).count() == 0


def test_texts_of_one_id_share_a_component(spark):
    a, b = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    rows = [(5, a), (5, b), (3, a + " more"), (4, b + " more")]
    assert {r.component_id for r in N.ngram_jaccard(documents(spark, rows)).collect()} == {3}


def test_shingle_hashes_follow_the_words():
    rng = random.Random(5)
    seen = {}
    for _ in range(500):
        w = [rng.choice(["a", "b", "aa", "ab", "é", "A"]) for _ in range(rng.randint(0, 12))]
        text = "".join(x + rng.choice([" ", "\t\n", "  "]) for x in w).encode()
        assert len(N.shingles(text)) == len(shingle_set(" ".join(w)))
        key = frozenset(shingle_set(" ".join(w)))
        assert seen.setdefault(key, N.signatures(N.shingles(text))) == N.signatures(N.shingles(text))
    assert len(set(seen.values())) == len(seen)


def test_bounds_never_rule_out_a_link():
    """What prefixes of linked sets have in common, against the bound of a pair and the least of a range of sizes."""
    rng = np.random.default_rng(6)
    bound = lambda n, m, p=85: (n + m) * p / (100 + p) - max(n, m) * p / 100
    linked = 0
    for _ in range(3000):
        universe = np.sort(rng.integers(0, 2**62, 60))
        x, y = (np.sort(rng.choice(universe, rng.integers(45, 60), replace=False)) for _ in range(2))
        c = len(np.intersect1d(x, y))
        if 100 * c >= 85 * (len(x) + len(y) - c):
            linked += 1
            common = len(np.intersect1d(x[: N.prefix_size(len(x), 85)], y[: N.prefix_size(len(y), 85)]))
            assert common >= max(1, bound(len(x), len(y)))
            low, high = rng.integers(30, len(y) + 1), rng.integers(len(y), 90)
            low, high = max(low, len(x) * 0.85), min(high, len(x) / 0.85)
            assert common >= min(bound(len(x), low), bound(len(x), high)) - 1e-6
    assert linked > 100


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (7, 7), (101, 100)], "u long, v long")
    roots = {r.node: r.root for r in N.components(edges).collect()}
    assert all(roots[k] == 0 for k in range(1, 41)) and roots[101] == 100
    assert N.components(edges.limit(0)).count() == 0


# --- URL filters


def test_url_filters(spark):
    day = datetime.date.fromisoformat
    entries = [("bad.com", "block", "2024-01-10"), ("bad.com", "allow", "2024-02-01"), ("ok.bad.com", "allow", "2024-01-15"), ("BAD.com", "block", "2024-03-01"), ("twice.org", "allow", "2024-01-01"), ("twice.org", "block", "2024-01-01"), (None, "block", "2024-01-01"), ("com", "block", None)]
    captures = [("http://bad.com/x", "2024-01-09"), ("http://bad.com/x", "2024-01-10"), ("https://www.bad.com.:80/", "2024-01-31"), ("https://u:p@www.BAD.com?q", "2024-02-01"), ("http://ok.bad.com", "2024-01-14"), ("http://ok.bad.com", "2024-01-20"), ("http://notbad.com", "2024-01-20"), ("http://twice.org", "2024-05-05"), ("nonsense", "2024-05-05"), (None, "2024-05-05"), ("http://bad.com", None), ("http://bad.com/x", "2024-03-09")]
    c = spark.createDataFrame([(k, u, d and day(d)) for k, (u, d) in enumerate(captures)], "page_id long, url string, fetched date").withColumn("domain", F.lit("clash")).withColumn("since", F.lit(1))
    e = spark.createDataFrame([(a, b, d and day(d)) for a, b, d in entries], "domain string, action string, since date")
    out = {r.page_id: r for r in url_filters(c, e).collect()}
    assert [k for k in sorted(out) if out[k].blocked] == [1, 2, 4, 7, 11]
    assert out[5].matched_domain == "ok.bad.com" and out[5].action == "allow" and out[4].matched_domain == "bad.com"
    assert out[0].action is None and out[8].host is None and out[10].action is None
    assert url_filters(c.limit(0), e).count() == 0
    assert url_filters(c.union(c), e.limit(0)).where("blocked").count() == 0


def test_hosts(spark):
    df = spark.createDataFrame([("HTTP://A.b:8080/c?d#e",), ("ftp://x@y.z",), ("//a.b",), ("",)], "u string")
    assert [r[0] for r in df.select(host_of(F.col("u"))).collect()] == ["a.b", "y.z", None, None]


# --- mixing


def test_raking_meets_its_targets(spark):
    rng = random.Random(7)
    cells = spark.createDataFrame([(f"s{a}", f"l{b}", f"t{c}", rng.randint(1, 1000)) for a in range(4) for b in range(3) for c in range(2)], "source string, lang string, topic string, tokens long")
    shares = {"source": [0.4, 0.3, 0.2, 0.1], "lang": [0.5, 0.3, 0.2], "topic": [0.7, 0.3]}
    targets = {n: spark.createDataFrame([(f"{n[0]}{k}", v) for k, v in enumerate(x)], f"{n} string, share double") for n, x in shares.items()}
    fitted = rake(cells, targets)
    for name, wanted in shares.items():
        found = {r[0]: r[1] for r in fitted.groupBy(name).agg(F.sum("weight")).collect()}
        assert all(abs(found[f"{name[0]}{k}"] - v) < 1e-9 for k, v in enumerate(wanted))


def test_raking_goes_on_where_sources_are_tied_to_languages(spark):
    cells = spark.createDataFrame([("s0", "l0", "t", 900), ("s0", "l1", "t", 100), ("s1", "l0", "t", 50), ("s1", "l1", "t", 450)], "source string, lang string, topic string, tokens long")
    targets = {"source": spark.createDataFrame([("s0", 0.5), ("s1", 0.5)], "source string, share double"), "lang": spark.createDataFrame([("l0", 0.45), ("l1", 0.55)], "lang string, share double"), "topic": spark.createDataFrame([("t", 1.0)], "topic string, share double")}
    found = {(r.source, r.lang): r.weight for r in rake(cells, targets, 1e-4).collect()}
    assert abs(found["s0", "l0"] + found["s1", "l0"] - 0.45) < 1e-4 and abs(found["s0", "l0"] + found["s0", "l1"] - 0.5) < 1e-4
    with pytest.raises(UnmetTargets):
        rake(cells, targets, 1e-6, max_cycles=0)
    with pytest.warns(UserWarning, match="contradict"):
        rake(cells, targets, 1e-6, max_cycles=0, unmet="warn")


@pytest.mark.parametrize("tied", [0.99, 0.999])
def test_raking_of_tied_sources(spark, tied):
    """Plain raking leaves shares off by a few percent here after 60 rounds."""
    n = 1_000_000
    rows = [(f"s{a}", f"l{b}", "t", round(n * (a + 1) * (tied if a == b else 1 - tied))) for a in (0, 1) for b in (0, 1)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    shares = {"source": {"s0": 0.43, "s1": 0.57}, "lang": {"l0": 0.45, "l1": 0.55}, "topic": {"t": 1.0}}
    targets = {name: spark.createDataFrame(list(x.items()), f"{name} string, share double") for name, x in shares.items()}
    fitted = rake(cells, targets).collect()
    for name, wanted in shares.items():
        for value, share in wanted.items():
            assert abs(sum(r.weight for r in fitted if r[name] == value) - share) < 1e-8
    w = {(r.source, r.lang): r.weight / r.tokens for r in fitted}
    # Still a product of factors: the odds ratio is the one of the tokens.
    assert abs(w["s0", "l0"] * w["s1", "l1"] / w["s0", "l1"] / w["s1", "l0"] - 1) < 1e-6


def test_targets_that_contradict_each_other(spark):
    cells = spark.createDataFrame([("s0", "l0", "t", 5), ("s1", "l1", "t", 5)], "source string, lang string, topic string, tokens long")
    targets = {name: spark.createDataFrame(x, f"{name} string, share double") for name, x in {"source": [("s0", 0.3), ("s1", 0.7)], "lang": [("l0", 0.6), ("l1", 0.4)], "topic": [("t", 1.0)]}.items()}
    with pytest.raises(UnmetTargets):
        rake(cells, targets)


def test_the_sample_has_the_target_shares(spark):
    rng = random.Random(11)
    docs = documents(spark, [(i, "w " * rng.randint(1, 400)) for i in range(6000)]).withColumn("lang", F.when(F.col("doc_id") % 5 < 3, "en").otherwise("de"))
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "big").otherwise(F.concat(F.lit("s"), F.col("doc_id") % 4)))
    shares = {"source": {"big": 0.2, "s0": 0.2, "s1": 0.2, "s2": 0.2, "s3": 0.2}, "lang": {"en": 0.5, "de": 0.5}, "topic": {"short": 0.4, "medium": 0.6}}
    targets = {n: spark.createDataFrame(list(x.items()), f"{n} string, share double") for n, x in shares.items()}
    out = source_mixing(docs, targets=targets).where("sampled").toPandas()
    for name, wanted in shares.items():
        held = out.groupby(name)["n_tokens"].sum() / out["n_tokens"].sum()
        assert all(abs(held[k] - v) < 0.05 for k, v in wanted.items())


def test_samples_follow_probabilities(spark):
    rows = [(i, "w " * (1 + i % 300)) for i in range(3000)]
    docs = documents(spark, rows).withColumn("source", F.when(F.col("doc_id") % 3 == 0, "big").otherwise(F.concat(F.lit("s"), F.col("doc_id") % 7)))
    out = source_mixing(docs)
    assert out.where("probability < 0 OR probability > 1 OR (probability >= 1 AND NOT sampled)").count() == 0
    total = out.agg(F.sum("probability"), F.sum(F.col("sampled").cast("int"))).first()
    assert abs(total[0] - total[1]) < 0.05 * total[0]
    assert out.agg(F.max("probability")).first()[0] == 1.0
    assert sorted(r.doc_id for r in sample_documents(docs).collect()) == sorted(r.doc_id for r in out.where("sampled").collect())


@pytest.mark.parametrize("partitions", [1, 5])
def test_samples_do_not_depend_on_partitions(spark, partitions):
    docs = documents(spark, [(i, "w " * (1 + i % 50)) for i in range(200)])
    wanted = {r.doc_id for r in source_mixing(docs).where("sampled").collect()}
    assert wanted == {r.doc_id for r in source_mixing(docs.repartition(partitions)).where("sampled").collect()}


def test_mixing_odd(spark):
    out = source_mixing(odd(spark)).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in odd_rows())
    assert all(r.source is not None and r.lang is not None and r.probability is not None and r.sampled is not None for r in out)
    assert len({r.sampled for r in out if r.doc_id == 7}) == 1
    assert source_mixing(empty(spark)).count() == 0
    assert sample_documents(odd(spark)).columns == odd(spark).columns
