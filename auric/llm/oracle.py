"""DuckDB SQL for the operators that SQL can express, written from the rules.

``documents`` and the other tables are registered as views. Patterns and
thresholds are parameters of the operators and are taken from them; the logic
is not.
"""

from __future__ import annotations

from auric.llm import quality_rules as Q
from auric.llm import secrets as S

WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"


def quality_measures(docs: str = "documents", columns: str = "") -> str:
    """SELECT of measurements, one row per row of ``docs`` (rid numbers them)."""
    blank = r"regexp_matches({0}, '^[\x20\x09-\x0D]*$')"
    strip = r"trim({0}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    count = lambda cls: f"CAST(length(regexp_replace(t, '{cls}', '', 'g')) AS BIGINT)"
    return f"""
WITH src AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t{columns} FROM {docs}),
split AS (
  SELECT *, {WORDS} AS w,
         list_filter(string_split(t, chr(10)), lambda x: NOT {blank.format('x')}) AS ln FROM src),
win AS (
  SELECT rid, i, list_slice(w, i, i + 4) AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM split WHERE len(w) >= 5)),
twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1),
cover AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM twice, range(5) r(k) GROUP BY rid)
SELECT s.rid, s.doc_id{columns},
  CAST(len(w) AS BIGINT) AS n_words,
  CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  {count('[^#*$%&|<>]')} AS n_symbols,
  CAST(len(ln) AS BIGINT) AS n_lines,
  CAST(len(ln) - len(list_distinct(ln)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
  CAST(len(list_filter(w, lambda x: regexp_matches(x, '\\p{{L}}'))) AS BIGINT) AS n_letter_words,
  {count(chr(92) + 'P{L}')} AS n_letters,
  {count(chr(92) + 'P{Lu}')} AS n_upper,
  {count('[^!]')} AS n_exclamations,
  CAST(len(list_filter(ln, lambda x: regexp_matches({strip.format('x')}, '^[-*•]'))) AS BIGINT) AS n_bullet_lines,
  CAST(len(list_filter(ln, lambda x: regexp_matches({strip.format('x')}, '(\\.\\.\\.|…)$'))) AS BIGINT) AS n_ellipsis_lines
FROM split s LEFT JOIN cover c ON c.rid = s.rid"""


def quality_rules(version: str = Q.CURRENT) -> str:
    bits = " | ".join(f"(CASE WHEN {cond} THEN {1 << i} ELSE 0 END)" for i, (_, cond) in enumerate(Q.RULES))
    return f"""
WITH m AS ({quality_measures()}),
l AS (SELECT *, CAST({bits} AS BIGINT) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       (fail_bits & {Q.policy(version).mask}) = 0 AS kept, fail_bits
FROM l"""


def secret_scan() -> str:
    q = lambda s: s.replace("'", "''")
    either = "".join
    cased = lambda word: either(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    keys = "|".join(cased(k) for k in ("password", "passwd", "secret", "token", "api_?key"))
    assign = f"({keys})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    base = ((0, "assign", assign, 2, 12), (1, "access", "AKIA[A-Z0-9]+", 0, 18), (2, "hex", "[0-9a-f]+", 0, 16))

    def located(no, kind, pattern, group, least):
        p = q(pattern)
        return f"""
SELECT rid, {no} AS kind_no, '{kind}' AS kind, hit, part,
       CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
            + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a
FROM (SELECT rid, i, hits, gaps, hits[i] AS hit, parts[i] AS part
      FROM (SELECT rid, regexp_extract_all(t, '{p}', 0) AS hits, regexp_extract_all(t, '{p}', {group}) AS parts,
                   string_split_regex(t, '{p}') AS gaps FROM src), unnest(range(1, len(hits) + 1)) u(i))
WHERE length(part) >= {least}"""

    entropy, parts = [], q(S.ALLOW_PARTS)
    for no, c in enumerate(S.CLASSES, len(base)):
        allowed = " OR ".join(f"regexp_matches(hit, '{q(a)}')" for a in S.ALLOW)
        table = "[" + ", ".join(map(str, c.table()[1:])) + "]"
        entropy.append(f"""
SELECT rid, {no} AS kind_no, '{c.kind}' AS kind, min(a + i) AS a, max(a + i) + {c.window} AS b
FROM (SELECT rid, a, i, sum(CASE WHEN gap > {c.window} THEN 1 ELSE 0 END) OVER (PARTITION BY rid, a ORDER BY i) AS island
      FROM (SELECT rid, a, i, i - lag(i) OVER (PARTITION BY rid, a ORDER BY i) AS gap
            FROM (SELECT rid, a, i, sum({table}[n]) AS s
                  FROM (SELECT rid, a, i, ch, CAST(count(*) AS INTEGER) AS n
                        FROM (SELECT rid, a, i, unnest(string_split(substr(hit, CAST(i + 1 AS BIGINT), {c.window}), '')) AS ch
                              FROM (SELECT rid, a, hit, unnest(range(0, length(hit) - {c.window - 1})) AS i
                                    FROM ({located(no, c.kind, c.pattern, 0, c.window)}) WHERE NOT ({allowed})))
                        GROUP BY rid, a, i, ch)
                  GROUP BY rid, a, i) w
            WHERE s <= {c.most()}
              AND NOT EXISTS (SELECT 1 FROM base x WHERE x.rid = w.rid AND x.a <= w.a + w.i AND w.a + w.i + {c.window} <= x.b)
              AND NOT EXISTS (SELECT 1 FROM harmless{no} h WHERE h.rid = w.rid AND h.a = w.a
                              AND h.p < w.i + {c.window} AND w.i < h.p + length(h.part))))
GROUP BY rid, a, island""")
    harmless = "".join(f"""
harmless{no} AS (
  SELECT rid, a, hits[i] AS part,
         CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
              + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS p
  FROM (SELECT rid, a, regexp_extract_all(hit, '{parts}') AS hits, string_split_regex(hit, '{parts}') AS gaps
        FROM ({located(no, c.kind, c.pattern, 0, c.window)})), unnest(range(1, len(hits) + 1)) u(i)),"""
                       for no, c in enumerate(S.CLASSES, len(base)))
    fixed = " UNION ALL ".join(f"({located(*b)})" for b in base)
    spans = "coalesce(string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, kind_no) {0}, '')"
    return f"""
WITH src AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
base AS (SELECT rid, kind_no, kind, a, a + length(hit) AS b FROM ({fixed})),{harmless}
extra AS ({' UNION ALL '.join(f'({e})' for e in entropy)}),
found AS (
  SELECT rid, kind_no, kind, a, b FROM base
  UNION ALL SELECT rid, kind_no, kind, a, b FROM extra)
SELECT src.doc_id,
  count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
  count(*) FILTER (WHERE kind = 'hex') AS n_hex,
  sha256({spans.format("FILTER (WHERE kind_no < 3)")}) AS base_sha256,
  {spans.format("FILTER (WHERE kind IS NOT NULL)")} AS spans
FROM src LEFT JOIN found USING (rid) GROUP BY src.rid, src.doc_id"""


def url_filter() -> str:
    host = "regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1)"
    path = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
    day = "DATE '2024-01-01' + CAST({0} AS INTEGER)"
    return f"""
WITH c AS (SELECT row_number() OVER () AS rid, page_id, url, {day.format('(page_id * 37) % 365')} AS fetched_at FROM pages),
p AS (SELECT page_id, {host} AS host, {path} AS path FROM pages WHERE {host} <> ''),
l AS (SELECT *, string_split(host, '.') AS labels FROM p),
site AS (
  SELECT pattern, min(page_id) AS id
  FROM (SELECT page_id, CASE WHEN len(labels) > 3 THEN array_to_string(labels[2:], '.') ELSE host END AS pattern FROM l)
  GROUP BY 1),
section AS (
  SELECT pattern, min(page_id) AS id
  FROM (SELECT page_id, host || '/' || lower(regexp_extract(path, '^/([^/]+)', 1)) AS pattern FROM l) GROUP BY 1),
entry AS (
  SELECT 'sites' AS list, 'domain' AS kind, pattern, 'block' AS action, {day.format('(id * 11) % 300')} AS a,
         CASE WHEN id % 6 = 0 THEN {day.format('(id * 11) % 300 + 60')} END AS b
  FROM site WHERE id % 3 = 0
  UNION ALL
  SELECT 'sections', 'prefix', pattern, CASE WHEN id % 8 = 0 THEN 'allow' ELSE 'block' END,
         {day.format('(id * 7) % 300')}, NULL
  FROM section WHERE id % 4 = 0),
split AS (SELECT *, {host} AS host, list_filter(string_split({path}, '/'), lambda x: x <> '') AS segs FROM c),
key AS (
  SELECT rid, fetched_at, 0 AS rank, 'domain' AS kind,
         array_to_string(string_split(host, '.')[i:], '.') AS pattern
  FROM split, unnest(range(1, len(string_split(host, '.')) + 1)) u(i) WHERE host <> ''
  UNION ALL
  SELECT rid, fetched_at, 2, 'prefix', lower(host || '/' || array_to_string(segs[1:n], '/'))
  FROM split, unnest(range(0, len(segs) + 1)) u(n) WHERE host <> ''),
hit AS (
  SELECT k.rid, e.*, count(*) OVER (PARTITION BY k.rid) AS n,
         row_number() OVER (PARTITION BY k.rid ORDER BY k.rank DESC, length(k.pattern) DESC,
                            (e.action = 'block') DESC, e.list, e.pattern) AS nth
  FROM key k JOIN entry e ON e.kind = k.kind AND e.pattern = k.pattern
  WHERE e.a <= k.fetched_at AND (e.b IS NULL OR k.fetched_at < e.b))
SELECT c.page_id, c.url, c.fetched_at, coalesce(h.n, 0) AS n_active, h.kind, h.pattern, h.list,
       coalesce(h.action <> 'block', TRUE) AS kept
FROM c LEFT JOIN hit h ON h.rid = c.rid AND h.nth = 1"""


def oracle_sql() -> dict[str, str]:
    return {"op1_secret_scan": secret_scan(), "op5_quality_rules": quality_rules(),
            "op9_url_filters": url_filter()}
