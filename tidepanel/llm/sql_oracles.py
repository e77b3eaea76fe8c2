"""DuckDB SQL for the url filter, the collocations and the resampling."""

from __future__ import annotations

from tidepanel.llm import collocations, resample, url_filter
from tidepanel.llm.url_samples import labelled_urls

A_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def url_filter_sql() -> str:
    """Same descent, relational: rounds of (examples -> errors -> weights)."""
    m = url_filter
    quoted = ", ".join("('{}', {})".format(u.replace("'", "''"), y) for u, y in labelled_urls())

    def runs(text: str, seed: int, n: int) -> str:
        total = " + ".join(f"ord({text}[i + {j}]) * {m.FACTORS[j]}" for j in range(n))
        return (f"list_transform(range(1, len({text}) - {n} + 2), lambda i: "
                f"(({seed + n} + {total})::BIGINT % {m.PRIME} * {m.SPIN}) % {m.PRIME} % {m.BUCKETS})")

    def parts(url: str) -> str:
        return (f"translate(regexp_extract(coalesce({url}, ''), '://([^/?#]*)', 1), {A_Z}) AS host, "
                f"regexp_extract(coalesce({url}, ''), '://[^/?#]*([^?#]*)', 1) AS path")

    grams = " || ".join(runs(t, seed, n) for t, seed in zip(("('^' || host || '$')", "path"), m.SEEDS)
                        for n in m.GRAMS)
    tests = []
    for said, rule in sorted(m.RULES, key=lambda r: -len(r[1])):
        name, slash, rest = rule.partition("/")
        tests.append((f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) "
                      f"AND starts_with(path, '{slash}{rest}') THEN ", rule, said))
    rule = " ".join(f"{t}'{r}'" for t, r, _ in tests)
    said = " ".join(f"{t}'{v}'" for t, _, v in tests)
    return f"""
WITH RECURSIVE ex AS MATERIALIZED (
  SELECT row_number() OVER () AS e, y, list_distinct({grams}) AS f
  FROM (SELECT y, {parts('url')} FROM (VALUES {quoted}) t(url, y))),
fx AS MATERIALIZED (SELECT e, unnest(f) AS b FROM ex),
v AS MATERIALIZED (SELECT e, y, 1.0 / sqrt(greatest(len(f), 1)) AS v FROM ex),
m(it, b, w) AS (
  SELECT 0, b, 0::DOUBLE FROM (SELECT DISTINCT b FROM fx UNION ALL SELECT -1)
  UNION ALL
  SELECT it + 1, b, w - {m.STEP!r} * (coalesce(g, 0) / (SELECT count(*) FROM ex)
                                      + CASE WHEN b < 0 THEN 0 ELSE {m.PENALTY!r} END * w)
  FROM m LEFT JOIN (
    SELECT b, sum(d) AS g
    FROM (SELECT CASE WHEN k = 0 THEN fx.b ELSE -1 END AS b,
                 CASE WHEN k = 0 THEN r.d * r.v ELSE r.d END AS d
          FROM (SELECT v.e, v.v, 1 / (1 + exp(-((SELECT w FROM m WHERE b = -1)
                                                + v.v * coalesce(s.s, 0)))) - v.y AS d
                FROM v LEFT JOIN (SELECT e, sum(w) AS s FROM fx JOIN m USING (b) GROUP BY e) s
                  ON s.e = v.e) r
          CROSS JOIN range(2) k(k) LEFT JOIN fx ON fx.e = r.e AND k = 0)
    GROUP BY b) USING (b)
  WHERE it < {m.ROUNDS}),
model AS MATERIALIZED (SELECT b, round(w * 1000000)::BIGINT AS w FROM m WHERE it = {m.ROUNDS}),
p AS (SELECT row_number() OVER () AS nr, page_id, {parts('url')} FROM pages),
q AS (SELECT *, list_distinct({grams}) AS f FROM p),
s AS (SELECT nr, sum(w) AS s FROM (SELECT nr, unnest(f) AS b FROM q) JOIN model USING (b) GROUP BY nr),
j AS (SELECT q.*, coalesce(s.s, 0)::BIGINT / sqrt(greatest(len(f), 1))
             + (SELECT w FROM model WHERE b = -1) AS score
      FROM q LEFT JOIN s USING (nr))
SELECT page_id, host, path, CASE {rule} END AS rule,
       coalesce(CASE {said} END, CASE WHEN score > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM j"""


def collocations_sql(least: int = collocations.LEAST, top: int = collocations.TOP) -> str:
    runs = " UNION ALL ".join(
        f"SELECT lang, {m} AS m, unnest(list_transform(range(1, len(w) - {m} + 2), "
        f"lambda i: array_to_string(w[i:i + {m} - 1], ' '))) AS phrase FROM pieces"
        for m in (1, 2, 3, 4))
    return rf"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(coalesce(text, ''), {A_Z}), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM d),
f AS MATERIALIZED (
  SELECT lang, m, phrase, count(*) AS a FROM ({runs}) GROUP BY ALL HAVING count(*) >= {least}),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
cut AS (
  SELECT lang, m, phrase, a, k, array_to_string(w[1:k], ' ') AS first,
         array_to_string(w[k + 1:m], ' ') AS rest
  FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
s AS (
  SELECT cut.lang, cut.m, cut.phrase, cut.a, k, x.a AS l, y.a AS r,
         ((2000000::HUGEINT * cut.a) // (x.a::HUGEINT + y.a))::BIGINT AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = first
           JOIN f y ON y.lang = cut.lang AND y.phrase = rest),
best AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, phrase, max(a) AS longer
  FROM (SELECT lang, a, array_to_string(w[i:i + l - 1], ' ') AS phrase
        FROM (SELECT *, unnest(range(1, m - l + 2)) AS i
              FROM (SELECT *, unnest(range(2, m)) AS l FROM c WHERE m > 2)))
  GROUP BY lang, phrase)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM best LEFT JOIN inner_ USING (lang, phrase) JOIN total USING (lang)
WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
QUALIFY rank <= {top}"""


def resample_sql(percent: int = resample.PERCENT, least_words: int = resample.LEAST_WORDS,
                 seed: int = resample.SEED, buckets: int = resample.BUCKETS) -> str:
    def words(table: str) -> str:
        return (f"regexp_extract_all(translate(coalesce(text, ''), {A_Z}), "
                r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM " + table)

    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS nr, doc_id, {words('documents')}),
b AS (SELECT {words('benchmark')}),
dw AS (SELECT nr, unnest(w) AS word FROM d), bw AS (SELECT unnest(w) AS word FROM b),
crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1
                THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i) ORDER BY i) AS t
  FROM range(256) x(i)),
crc AS MATERIALIZED (
  SELECT word, xor(4294967295, list_reduce(
           list_transform(range(1, octet_length(encode(word)) + 1), lambda i:
             ('0x' || hex(encode(word))[2 * i - 1:2 * i])::BIGINT),
           lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8), 4294967295::BIGINT))
         % {buckets} AS bucket
  FROM (SELECT word FROM dw UNION SELECT word FROM bw), crc_table),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN crc USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN crc USING (word) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + {buckets})
      / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM bw) + {buckets}))))::BIGINT AS gain
  FROM range({buckets}) k(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
sums AS (
  SELECT nr, sum(gain)::BIGINT AS g FROM dw JOIN crc USING (word) JOIN gain USING (bucket) GROUP BY nr),
scored AS (
  SELECT nr, doc_id, len(w)::BIGINT AS n_features,
         CASE WHEN len(w) = 0 THEN 0
              ELSE (g - ((g % len(w)) + len(w)) % len(w)) // len(w) END::BIGINT AS weight,
         ('0x' || sha256('{seed}:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT AS h
  FROM d LEFT JOIN sums USING (nr)),
final AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= {least_words}
                               ORDER BY score DESC, doc_id NULLS FIRST) AS place,
         count(*) FILTER (n_features >= {least_words}) OVER () AS n
  FROM final)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= {least_words} AND place <= {percent} * n // 100 THEN place END AS rank
FROM ranked"""
