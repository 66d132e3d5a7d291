"""Personal data against plain loops, and what contexts add to it."""

import hashlib
import random
import re
from collections import Counter

import pytest

from tablewright.llm.personal_data import personal_data

from .frames import documents, empty, odd, odd_rows

PLAIN = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def right(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        double = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in double) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    found = [(k, m.start(), m.end()) for k, p in PLAIN for m in re.finditer(p, text or "") if right(k, m.group())]
    counts = Counter(k for k, *_ in found)
    return *(counts[k] for k, _ in PLAIN), ",".join(f"{k}:{s}:{e}" for k, s, e in found)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(rng, n=16):
    digits = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(digits + d for d in "0123456789" if right("card", digits + d))


def test_base_spans(spark):
    rng = random.Random(41)
    pieces = ["a@b.c", "x.y@d-e.f.g", "@", ".", "_", "é", " ", "1.2.3.4", "300.1.1.1", "0255.0.00.256", "+1 (555) 010-9999", "+49 ", "😀", "4111 1111 1111 1111", "7", "12", "-", "\n", "+", "(", "..", "%+x", luhn(rng), luhn(rng, 13)]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))) for i in range(600)]
    for r in personal_data(documents(spark, rows)).collect():
        n_email, n_ip, n_card, n_phone, listed = base(rows[r.doc_id][1])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == (n_email, n_ip, n_card, n_phone, sha(listed)), rows[r.doc_id]
        assert r.spans == listed or r.spans.startswith(listed + ",context_") or (not listed and r.spans.startswith("context_"))


def test_long_runs_take_linear_time(spark):
    runs = ["a" * 400_000, "1" * 400_000, "1." * 200_000, "a@" * 200_000, "x@y" + ".z" * 200_000, "+1 " * 130_000, "1" + " " * 400_000, "a@b.c " * 60_000]
    out = personal_data(documents(spark, list(enumerate(runs)))).collect()
    assert {r.doc_id: r.n_email for r in out} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 1, 5: 0, 6: 0, 7: 60_000}
    assert [r.n_ip for r in out if r.doc_id == 2] == [50_000] and sum(r.n_card for r in out) == 0


@pytest.fixture(scope="module")
def found(spark):
    rng = random.Random(42)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(3, 7)))
    filler = lambda: " ".join(word() for _ in range(12))
    rows = [(i, f"{filler()} please call me at +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} {filler()}") for i in range(200)]
    rows += [(1000 + i, f"{filler()} credit card {luhn(rng)} {filler()}") for i in range(30)]
    # Found in the first round by the words before it; what stands around it then speaks for the words after it.
    numbers = [f"{rng.randint(200, 999)}-555-{rng.randint(1000, 9999)}" for _ in range(20)]
    rows += [(2000 + i, f"{filler()} please call me at {n} {filler()}") for i, n in enumerate(numbers)]
    rows += [(3000 + i, f"{filler()} telefon {n} {filler()}") for i, n in enumerate(numbers)]
    rows += [(4000, f"{filler()} telefon 030 4455 6677 {filler()}")]
    rows += [(5000, f"{filler()} credit card 1234567890123456 {filler()}"), (5001, f"{filler()} order number 1234509876123456 {filler()}")]
    rows += [(6000 + i, f"{filler()} order number {rng.randint(10**9, 10**10)} {filler()}") for i in range(30)]
    return rows, {r.doc_id: r for r in personal_data(documents(spark, rows)).collect()}


def test_contexts_find_what_has_no_checked_form(found):
    rows, out = found
    texts = dict(rows)
    spans = lambda i: [texts[i][int(s) : int(e)] for k, s, e in (x.split(":") for x in out[i].spans.split(",")) if k.startswith("context_")]
    assert all(out[2000 + i].n_context == 1 and out[2000 + i].spans.startswith("context_phone:") for i in range(20))
    assert spans(5000) == ["1234567890123456"] and out[5000].spans.startswith("context_card")
    assert spans(2000)[0] in texts[3000]


def test_later_rounds_find_more(spark, found):
    rows, out = found
    # "telefon" stands before values that only the first round found.
    assert out[4000].n_context == 1 and all(out[3000 + i].n_context == 1 for i in range(20))
    first = {r.doc_id: r for r in personal_data(documents(spark, rows), rounds=1).collect()}
    assert first[4000].n_context == 0 and first[2000].n_context == 1


def test_other_numbers_are_left_alone(found):
    _, out = found
    assert out[5001].spans == "" and all(out[6000 + i].spans == "" for i in range(30))


def test_odd(spark):
    out = personal_data(odd(spark)).collect()
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in out) == Counter((r[0], *base(r[1])[:4]) for r in odd_rows())
    assert personal_data(empty(spark)).count() == 0
