"""DuckDB SQL for the rows of the corpus queries, where SQL can express them."""

from __future__ import annotations

from . import personal_data as P
from .quality_rules import FLOWING, N_COMMON, OTHERS
from .secret_scan import KINDS

#: More than enough for the shares of the test tables to stand.
ROUNDS = 40

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def quality_rules_sql(min_words: int = 60, min_chars: int = 200, max_word: float = 0.45, max_class: float = 0.28) -> str:
    left = "\n".join(f", l{k + 1} AS (SELECT *, regexp_replace(left{k}, '{pattern}', '', 'g') AS left{k + 1} FROM l{k})" for k, (_, pattern) in enumerate(OTHERS))
    last = len(OTHERS)
    space = "(length(txt) - length(array_to_string(words, '')))"
    counts = ", ".join([space, f"length(txt) - {space} - length(left0)"] + [f"length(left{k}) - length(left{k + 1})" for k in range(last)] + [f"length(left{last})"])

    def js(p: str, q: str) -> str:
        a, b = f"({p}[k] / list_sum({p}))", f"({q}[k] / list_sum({q}))"
        part = lambda x, y: f"(CASE WHEN {x} > 0 THEN {x} * log2(2 * {x} / ({x} + {y})) ELSE 0 END)"
        return f"CASE WHEN list_sum({p}) > 0 AND list_sum({q}) > 0 THEN sqrt(greatest(0, list_sum(list_transform(range(1, len({p}) + 1), lambda k: 0.5 * ({part(a, b)} + {part(b, a)}))))) END"

    return f"""
WITH l0 AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS txt, regexp_replace(coalesce(text, ''), '{FLOWING}', '', 'g') AS left0, {WORDS} AS words FROM documents)
{left}
, common AS (
  SELECT lang, list(w ORDER BY n DESC, w) AS common FROM (
    SELECT lang, w, count(*) AS n FROM (SELECT lang, unnest(words) AS w FROM l0 WHERE lang IS NOT NULL) GROUP BY lang, w
    QUALIFY row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, w) <= {N_COMMON}) GROUP BY lang)
, d AS (
  SELECT rid, doc_id, lang, txt, words, len(words) AS n_words, [{counts}] AS classes,
    list_filter(string_split(txt, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM l{last})
, win AS (SELECT rid, i, array_to_string(words[i:i + 4], ' ') AS w FROM (SELECT rid, words, unnest(range(1, n_words - 3)) AS i FROM d WHERE n_words >= 5))
, twice AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, w) > 1)
, rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, range(5) t(k) GROUP BY rid)
, hits AS (SELECT d.*, common, list_transform(common, lambda c: len(list_filter(words, lambda w: w = c))) AS hit FROM d LEFT JOIN common USING (lang))
, b AS (
  SELECT hits.*, coalesce(rep.n, 0) AS n_repeat, n_words < 10 OR 100 * coalesce(rep.n, 0) > 20 * n_words AS base_failed,
    CASE WHEN common IS NOT NULL THEN list_append(hit, n_words - list_sum(hit)) END AS word_own FROM hits LEFT JOIN rep USING (rid))
, ref AS (
  SELECT lang, list_filter([{', '.join(f'sum(word_own[{k + 1}])' for k in range(N_COMMON + 1))}], lambda x: x IS NOT NULL) AS word_ref, [{', '.join(f'sum(classes[{k + 1}])' for k in range(last + 3))}] AS class_ref
  FROM b WHERE NOT base_failed AND lang IS NOT NULL GROUP BY lang)
, dist AS (
  SELECT *, CASE WHEN n_words >= {min_words} THEN {js('word_own', 'word_ref')} END AS word_distance, CASE WHEN length(txt) >= {min_chars} THEN {js('classes', 'class_ref')} END AS class_distance FROM b LEFT JOIN ref USING (lang))
SELECT doc_id, n_words::BIGINT AS n_words, (length(txt) - classes[1])::BIGINT AS word_chars, classes[5]::BIGINT AS n_symbols,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, n_repeat::BIGINT AS n_repeat_words, base_failed,
  round(word_distance, 6) AS word_distance, round(class_distance, 6) AS class_distance,
  NOT base_failed AND NOT coalesce(word_distance > {max_word}, false) AND NOT coalesce(class_distance > {max_class}, false) AS kept
FROM dist"""


def url_filters_sql() -> str:
    return r"""
WITH p AS (
  SELECT page_id, nullif(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#@]+)', 1), '\.$', ''), '') AS host,
    (DATE '2024-01-01' + CAST(('0x' || substr(md5(page_id::VARCHAR), 1, 6))::BIGINT % 365 AS INTEGER))::DATE AS fetched FROM pages)
, h AS (SELECT host, ('0x' || substr(md5(host), 1, 6))::BIGINT AS x FROM (SELECT DISTINCT host FROM p WHERE host IS NOT NULL))
, e AS (
  SELECT host AS domain, CASE WHEN k % 2 = 0 THEN 'block' ELSE 'allow' END AS action, (DATE '2024-01-01' + CAST(x % 90 + 90 * k AS INTEGER))::DATE AS since
  FROM h, range(4) t(k) WHERE x % 4 = 0
  UNION ALL SELECT * FROM (VALUES ('example.net', 'block', DATE '2024-03-01'), ('example.net', 'allow', DATE '2024-06-01'), ('example.org', 'allow', DATE '2024-01-01')))
, i AS (SELECT *, lead(since) OVER (PARTITION BY domain ORDER BY since) AS until FROM (SELECT domain, since, max(action) AS action FROM e GROUP BY domain, since))
, looked AS (
  SELECT page_id, host, fetched, k, array_to_string(parts[k:], '.') AS domain
  FROM (SELECT page_id, host, fetched, string_split(host, '.') AS parts FROM p WHERE host IS NOT NULL), LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS k))
, v AS (
  SELECT host, fetched, arg_min(domain, k) AS matched_domain, arg_min(action, k) AS action FROM (
    SELECT DISTINCT l.host, l.fetched, l.k, l.domain, i.action FROM looked l JOIN i USING (domain) WHERE l.fetched >= i.since AND (i.until IS NULL OR l.fetched < i.until))
  GROUP BY host, fetched)
SELECT page_id, p.host, p.fetched::VARCHAR AS fetched, matched_domain, action, coalesce(action = 'block', false) AS blocked
FROM p LEFT JOIN v ON p.host = v.host AND p.fetched = v.fetched"""


def source_mixing_sql(power: float = 0.7, rounds: int = ROUNDS) -> str:
    dims = ("source", "lang", "topic")
    steps, last = [], "w0"
    for n in range(rounds):
        for name in dims:
            now = f"w{len(steps) + 1}"
            steps.append(f", {now} AS MATERIALIZED (SELECT source, lang, topic, tokens, CASE WHEN s > 0 THEN weight * share / s ELSE 0 END AS weight FROM (SELECT *, sum(weight) OVER (PARTITION BY {name}) AS s FROM {last}) JOIN t_{name} USING ({name}))")
            last = now
    targets = "".join(f", t_{c} AS (SELECT {c}, t ^ {power} / sum(t ^ {power}) OVER () AS share FROM (SELECT {c}, sum(tokens)::DOUBLE AS t FROM w0 GROUP BY {c}))" for c in dims)
    return f"""
WITH d AS (
  SELECT doc_id, n_tokens, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
    CASE WHEN n_tokens < 150 THEN 'short' WHEN n_tokens < 600 THEN 'medium' ELSE 'long' END AS topic,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS draw
  FROM (SELECT *, len({WORDS})::BIGINT AS n_tokens FROM documents))
, w0 AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens)::DOUBLE AS weight FROM d GROUP BY ALL HAVING sum(n_tokens) > 0)
{targets}
{''.join(steps)}
, p AS (SELECT source, lang, topic, coalesce((weight / tokens) / nullif(max(weight / tokens) OVER (), 0), 0) AS probability FROM {last})
SELECT doc_id, source, lang, topic, n_tokens, round(coalesce(probability, 0), 6) AS probability, draw, draw < coalesce(probability, 0) AS sampled
FROM d LEFT JOIN p USING (source, lang, topic)"""


def secret_scan_sql(live_owners: int = 2, live_repositories: int = 5) -> str:
    quoted = lambda x: x.replace("'", "''")
    kinds = "\n  UNION ALL ".join(
        f"SELECT rid, {rank} AS rank, regexp_split_to_array(text, '{quoted(p)}') AS pieces, regexp_extract_all(text, '{quoted(p)}', 0) AS ms, regexp_extract_all(text, '{quoted(p)}', {group}) AS vs, {least} AS least FROM d WHERE regexp_matches(text, '{quoted(p)}')"
        for rank, (_, p, group, least) in enumerate(KINDS)
    )
    names = "[" + ", ".join(f"'{k}'" for k, *_ in KINDS) + "]"
    label = f"{names}[rank + 1] || ':' || s || ':' || e"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents)
, found AS ({kinds})
, each AS (
  SELECT rid, rank, least, v, length(m) AS n, (sum(length(piece)) OVER (PARTITION BY rid, rank ORDER BY k) + coalesce(sum(length(m)) OVER (PARTITION BY rid, rank ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS s
  FROM (SELECT rid, rank, least, unnest(pieces[:len(ms)]) AS piece, unnest(ms) AS m, unnest(vs) AS v, unnest(range(len(ms))) AS k FROM found))
, spans AS (SELECT rid, rank, s, s + n AS e, v FROM each WHERE length(v) >= least AND (rank < 3 OR (regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]'))))
, kept AS (SELECT * FROM spans a WHERE rank < 3 OR NOT EXISTS (SELECT 1 FROM spans b WHERE b.rid = a.rid AND b.rank < 3 AND b.s < a.e AND a.s < b.e))
, freq AS (SELECT v, count(DISTINCT coalesce(source, '')) <= {live_owners} AND count(DISTINCT md5(text)) <= {live_repositories} AS live FROM kept JOIN d USING (rid) GROUP BY v)
, agg AS (
  SELECT rid, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
    string_agg({label}, ',' ORDER BY s, rank) FILTER (rank < 3) AS base, string_agg({label}, ',' ORDER BY s, rank) FILTER (rank < 3 OR live) AS spans,
    count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example FROM kept JOIN freq USING (v) GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_example, 0)::BIGINT AS n_example
FROM d LEFT JOIN agg USING (rid)"""


def line_dedup_sql() -> str:
    # levenshtein() counts bytes, of which a character has four at most, so it only gates.
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, text, string_split(text, chr(10)) AS ls FROM documents)
, l AS (
  SELECT rid, doc_id, k - 1 AS line_no, lower(trim(regexp_replace(ls[k], '[\x20\x09-\x0D]{{2,}}|[\x09-\x0D]', ' ', 'g'), ' ')) AS plain
  FROM (SELECT rid, doc_id, ls, unnest(range(1, len(ls) + 1)) AS k FROM docs WHERE doc_id IS NOT NULL AND text IS NOT NULL))
, f AS MATERIALIZED (SELECT plain, length(plain) AS n, min((doc_id, line_no)) AS first FROM l WHERE plain <> '' GROUP BY plain)
, long AS MATERIALIZED (SELECT *, plain[:n // 2] AS h0, plain[:(n - 1) // 2] AS h1, plain[n // 2 + 1:] AS t0, plain[(n - 1) // 2 + 2:] AS t1 FROM f)
, cand AS (
  SELECT x.plain, y.plain AS against FROM long x JOIN long y ON x.h0 = y.h0 WHERE x.n = y.n AND x.first > y.first
  UNION ALL SELECT x.plain, y.plain FROM long x JOIN long y ON x.t0 = y.t0 WHERE x.n = y.n AND x.first > y.first
  UNION ALL SELECT CASE WHEN x.first > y.first THEN x.plain ELSE y.plain END, CASE WHEN x.first > y.first THEN y.plain ELSE x.plain END FROM long x JOIN long y ON x.n = y.n + 1 AND x.h1 = y.h0
  UNION ALL SELECT CASE WHEN x.first > y.first THEN x.plain ELSE y.plain END, CASE WHEN x.first > y.first THEN y.plain ELSE x.plain END FROM long x JOIN long y ON x.n = y.n + 1 AND x.t1 = y.t0)
, pair AS (SELECT plain, against, CASE WHEN length(plain) > length(against) THEN plain ELSE against END AS x, CASE WHEN length(plain) > length(against) THEN against ELSE plain END AS y FROM cand WHERE levenshtein(plain, against) <= 4)
, near AS (
  SELECT DISTINCT plain FROM pair WHERE CASE WHEN length(x) = length(y) THEN len(list_filter(range(1, length(x) + 1), lambda i: x[i] <> y[i])) <= 1
    ELSE list_contains(list_transform(range(1, length(x) + 1), lambda i: x[:i - 1] || x[i + 1:]), y) END)
, gone AS (
  SELECT l.rid, line_no, (l.doc_id, line_no) > first AS again FROM l JOIN f USING (plain) LEFT JOIN near USING (plain)
  WHERE (l.doc_id, line_no) > first OR near.plain IS NOT NULL)
, g AS (SELECT rid, list(line_no) AS nos, count(*) FILTER (again) AS n_exact, count(*) FILTER (NOT again) AS n_near FROM gone GROUP BY rid)
, k AS (
  SELECT doc_id, coalesce(len(ls), 0)::BIGINT AS n_lines, coalesce(n_exact, 0)::BIGINT AS n_exact, coalesce(n_near, 0)::BIGINT AS n_near,
    coalesce(array_to_string(list_filter(ls, lambda x, i: NOT list_contains(coalesce(nos, []), i - 1)), chr(10)), '') AS kept FROM docs LEFT JOIN g USING (rid))
SELECT doc_id, n_lines, n_exact, n_near, length(kept)::BIGINT AS n_chars_kept, sha256(kept) AS kept_sha256 FROM k"""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def decontamination_sql(window: int = 10) -> str:
    words = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents)
, items AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {words} AS w FROM benchmark)
, win AS (
  SELECT DISTINCT item, array_to_string(w[i:i + {window - 1}], ' ') AS s, least(len(w), {window}) AS size
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - {window - 1}) + 1)) AS i FROM items WHERE len(w) > 0))
, sizes AS (SELECT DISTINCT size FROM win)
, runs AS (SELECT rid, size, i, array_to_string(w[i:i + size - 1], ' ') AS s FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size))
, hits AS (SELECT rid, r.i, r.size, item FROM runs r JOIN win USING (s, size))
, places AS (SELECT rid, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT rid, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT rid, i, size FROM hits)) GROUP BY rid)
, ids AS (SELECT rid, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (rid) LEFT JOIN ids USING (rid)"""


def ngram_jaccard_sql(words: int = 4, percent: int = 85) -> str:
    split = rf"list_filter(regexp_split_to_array({LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, {split} AS w FROM documents)
, s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {words - 1}], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - {words - 1}) + 1)) AS i FROM d WHERE len(w) > 0))
, n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id)
, pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL)
, links AS (SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= {percent} * (nx.n + ny.n - c))
, e AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links)
, reach AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.y, reach.root FROM reach JOIN e ON e.x = reach.node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, root AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(root) AS root FROM reach GROUP BY node) ON node = d.doc_id"""


def fill_in_middle_sql() -> str:
    part = lambda k: f"('0x' || substr(digits, {8 * k + 1}, 8))::BIGINT"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS digits FROM documents)
, h AS (SELECT *, least({part(0)} % (n + 1), {part(1)} % (n + 1)) AS a, greatest({part(0)} % (n + 1), {part(1)} % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR {part(2)} % 100 >= 90 THEN 'plain' WHEN {part(3)} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d)
, p AS (SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p"""


def importance_resampling_sql(percent: int = 5, min_words: int = 20, buckets: int = 10_000) -> str:
    words = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    runs = " UNION ALL ".join(f"SELECT side, rid, array_to_string(w[i:i + {k - 1}], ' ') AS run FROM (SELECT side, rid, w, unnest(range(1, len(w) - {k - 2})) AS i FROM texts WHERE len(w) >= {k})" for k in (1, 2, 3))
    # crc32 a byte at a time, by the 256 remainders of its polynomial.
    return f"""
WITH remainders AS MATERIALIZED (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS r FROM range(256) t(i))
, texts AS (SELECT 's' AS side, row_number() OVER () AS rid, doc_id, {words} AS w FROM documents UNION ALL SELECT 't', 0, NULL, {words} FROM benchmark)
, runs AS MATERIALIZED ({runs})
, hashed AS MATERIALIZED (
  SELECT run, xor(list_reduce(list_transform(range(strlen(run)), lambda k: ('0x' || substr(hex(run), 2 * k + 1, 2))::BIGINT), lambda c, b: xor(c >> 8, r[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % {buckets} AS bucket
  FROM (SELECT DISTINCT run FROM runs), remainders)
, counts AS (SELECT side, rid, bucket, count(*) AS n FROM runs JOIN hashed USING (run) GROUP BY ALL)
, held AS (SELECT bucket, coalesce(sum(n) FILTER (side = 's'), 0) AS s, coalesce(sum(n) FILTER (side = 't'), 0) AS t FROM counts GROUP BY bucket)
, gains AS (SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + {buckets})::DOUBLE) / ((s + 1)::DOUBLE * (sum(t) OVER () + {buckets})::DOUBLE)))::BIGINT AS gain FROM held)
, weights AS (SELECT rid, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM counts JOIN gains USING (bucket) WHERE side = 's' GROUP BY rid)
, scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM texts LEFT JOIN weights USING (rid) WHERE side = 's')
SELECT * EXCLUDE (place, total), CASE WHEN n_words >= {min_words} AND place <= {percent} * total // 100 THEN place END AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY n_words >= {min_words} ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_words >= {min_words}) OVER () AS total FROM scored)"""


# The plain patterns, in which a search needs no look-behind.
PERSONAL = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", f"regexp_matches(v, '{P.IP_PARTS}')"),
    (r"[0-9]([\x20-]?[0-9])+", "length(d) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda i: CASE WHEN (length(d) - i) % 2 = 1 THEN 2 * d[i]::INT - CASE WHEN d[i]::INT > 4 THEN 9 ELSE 0 END ELSE d[i]::INT END)) % 10 = 0"),
    (r"\+[0-9][\x20().0-9-]+[0-9]", "length(d) BETWEEN 9 AND 15"),
    (r"[0-9][0-9\x20().-]{5,}[0-9]", "length(d) BETWEEN 7 AND 19"),
    (r"[A-Za-z0-9._%+-]+(@|\x20?[\[(]at[\])]\x20?)[A-Za-z0-9.-]+", "true"),
    (r"[A-Z]{1,4}-?[0-9]{6,}", "true"),
)


def personal_data_sql(rounds: int = P.ROUNDS, min_trusted: int = P.MIN_TRUSTED, min_confidence: float = P.MIN_CONFIDENCE) -> str:
    lowered = lambda x: f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    kinds = "\n  UNION ALL ".join(f"SELECT rid, {rank} AS rank, regexp_split_to_array(text, '{p}') AS pieces, regexp_extract_all(text, '{p}', 0) AS ms FROM d WHERE regexp_matches(text, '{p}')" for rank, (p, _) in enumerate(PERSONAL))
    checks = " ".join(f"WHEN {rank} THEN {check}" for rank, (_, check) in enumerate(PERSONAL))
    names = "[" + ", ".join(f"'{x}{k}'" for x in ("", "context_") for k, _ in P.BASE) + "]"
    label = f"{names}[rank + 1] || ':' || s || ':' || e"
    steps = ""
    for k in range(rounds):
        steps += f"""
, trusted{k} AS (SELECT pattern, kind, round(sum(score) / (max(n) + 1), 9) AS confidence FROM edges JOIN found{k} USING (value) GROUP BY pattern, kind HAVING count(*) >= {min_trusted} AND round(sum(score) / (max(n) + 1), 9) >= {min_confidence})
, found{k + 1} AS MATERIALIZED (SELECT * FROM seeds UNION ALL SELECT value, kind, max(confidence) FROM edges JOIN trusted{k} USING (pattern) JOIN possible USING (value, kind) GROUP BY value, kind)"""
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents)
, matched AS ({kinds})
, each AS (
  SELECT rid, rank, m AS v, regexp_replace(m, '[^0-9]', '', 'g') AS d, length(m) AS n, (sum(length(piece)) OVER w + coalesce(sum(length(m)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS s,
    list_concat(['', ''], regexp_extract_all({lowered(f"right(piece, {P.REACH})")}, '{P.WORD}'))[-2:] AS before, coalesce(regexp_extract_all({lowered(f"left(following, {P.REACH})")}, '{P.WORD}')[1], '') AS after
  FROM (SELECT rid, rank, unnest(pieces[:len(ms)]) AS piece, unnest(pieces[2:]) AS following, unnest(ms) AS m, unnest(range(len(ms))) AS k FROM matched) WINDOW w AS (PARTITION BY rid, rank ORDER BY k))
, spans AS MATERIALIZED (SELECT rid, rank, s, s + n AS e, v, d, before, after FROM each WHERE CASE rank {checks} END)
, kept AS MATERIALIZED (
  SELECT *, CASE WHEN rank IN ({P.CARD}, {P.PHONE}, {P.NUMBER}) THEN d ELSE lower(v) END AS value
  FROM spans a WHERE rank < {P.FIRST_FORM} OR NOT EXISTS (SELECT 1 FROM spans b WHERE b.rid = a.rid AND b.rank < {P.FIRST_FORM} AND b.s < a.e AND a.s < b.e))
, linked AS (
  SELECT value, [1::VARCHAR, before[2]] AS pattern FROM kept WHERE before[2] <> '' UNION SELECT value, ['2', before[1], before[2]] FROM kept WHERE before[1] <> '' AND before[2] <> ''
  UNION SELECT value, ['3', after] FROM kept WHERE after <> '' UNION SELECT value, ['4', before[2], after] FROM kept WHERE before[2] <> '' AND after <> '')
, edges AS MATERIALIZED (SELECT pattern, value, n FROM linked JOIN (SELECT pattern, count(*) AS n FROM linked GROUP BY pattern HAVING count(*) >= {min_trusted}) USING (pattern))
, seeds AS MATERIALIZED (SELECT DISTINCT value, rank AS kind, 1.0::DOUBLE AS score FROM kept WHERE rank < {P.FIRST_FORM})
, possible AS MATERIALIZED (
  SELECT DISTINCT value, kind FROM (SELECT value, unnest(list_filter([CASE WHEN rank = {P.ADDRESS} THEN {P.EMAIL} END, CASE WHEN rank = {P.NUMBER} AND length(d) >= 12 OR rank = {P.CODE} THEN {P.CARD} END, CASE WHEN rank = {P.NUMBER} AND length(d) <= 15 THEN {P.PHONE} END], lambda x: x IS NOT NULL)) AS kind FROM kept WHERE rank >= {P.FIRST_FORM})
  ANTI JOIN seeds USING (value, kind))
, found0 AS (SELECT * FROM seeds)
{steps}
, best AS (SELECT value, arg_max(kind, (score, -kind)) AS kind FROM found{rounds} SEMI JOIN possible USING (value, kind) GROUP BY value)
, shown AS (SELECT rid, rank, s, e FROM kept WHERE rank < {P.FIRST_FORM} UNION ALL SELECT rid, kind + {len(P.BASE)}, s, e FROM kept JOIN best USING (value) WHERE rank >= {P.FIRST_FORM})
, agg AS (
  SELECT rid, {", ".join(f"count(*) FILTER (rank = {k}) AS n_{name}" for k, (name, _) in enumerate(P.BASE))}, count(*) FILTER (rank >= {len(P.BASE)}) AS n_context,
    string_agg({label}, ',' ORDER BY rank, s) FILTER (rank < {len(P.BASE)}) AS base, string_agg({label}, ',' ORDER BY rank, s, e) AS spans FROM shown GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{name}, 0)::BIGINT AS n_{name}" for name in (*(k for k, _ in P.BASE), "context"))}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN agg USING (rid)"""
