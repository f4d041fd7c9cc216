"""Queries and oracle SQL of the filter and source audits."""

from __future__ import annotations

from sitewatch.llm import divergence as D
from sitewatch.llm import filter_audit as A
from sitewatch.llm.common import WS


def op12_filter_audit(spark, sf_dir):
    """What each of five filters removes, in every order, per language."""
    return A.audit(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                   spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_source_divergence(spark, sf_dir):
    """Divergence of all pairs of sources and the telling terms of each."""
    return D.audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


FILTER_SQL = f"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t
  FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[{WS}]+'), lambda x: x <> '') AS w,
  min(doc_id) OVER (PARTITION BY t) AS first FROM d),
marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY 1),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
  {{'A': len(w) < {A.MIN_WORDS},
   'B': 100 * len(list_distinct(w)) < {A.MIN_DISTINCT} * len(w),
   'C': 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > {A.MAX_CAPITALS} * length(t),
   'D': regexp_matches(t, '{A.SYMBOLS}'),
   'E': coalesce(first < w.doc_id, false)}} AS x
  FROM w LEFT JOIN marks ON w.doc_id = marks.doc_id),
fails AS (SELECT part, good, toxic,
  list_filter(['A', 'B', 'C', 'D', 'E'], lambda c: CASE c WHEN 'A' THEN x.A WHEN 'B' THEN x.B
    WHEN 'C' THEN x.C WHEN 'D' THEN x.D ELSE x.E END) AS fails FROM f),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step,
  substr(filter_order, CAST(step AS INTEGER), 1) AS own,
  list_filter(string_split(substr(filter_order, 1, CAST(step AS INTEGER) - 1), ''),
              lambda x: x <> '') AS before
  FROM orders, range(1, 6) r(step)),
judged AS (SELECT part, filter_order, step, own, good, toxic, fails,
  list_contains(fails, own) AS here, list_has_any(fails, before) AS gone FROM fails, steps),
counts AS (SELECT part, filter_order, step, own, count(*) FILTER (NOT here AND NOT gone) AS kept,
  count(*) FILTER (here AND NOT gone) AS removed, count(*) FILTER (here AND gone) AS redundant,
  count(*) FILTER (fails = [own]) AS unique_fails,
  count(*) FILTER (here AND NOT gone AND good) AS good_lost,
  count(*) FILTER (here AND NOT gone AND toxic) AS toxic_lost FROM judged GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM counts"""

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SMOOTH, WHOLE = D.SMOOTHING, D.WHOLE


def _share(count, total):
    return (f"CAST(1 + CAST({WHOLE} AS HUGEINT) * ({count} + {SMOOTH}) "
            f"// ({total} + {SMOOTH} * v) AS BIGINT)")


DIVERGENCE_SQL = f"""WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang,
  coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{TERM}') AS ts
  FROM documents),
found AS (SELECT rid, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM found GROUP BY ALL
  HAVING count(DISTINCT rid) >= {D.MIN_DOCS}),
langs AS (SELECT lang, count(*) AS v, CAST(sum(total) AS BIGINT) AS lang_n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
cells AS (SELECT g.lang, g.source, k.term, k.total, count(f.term) AS n FROM groups g
  JOIN kept k ON g.lang = k.lang
  LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term GROUP BY ALL),
shares AS (SELECT c.*, {_share('n', 'sum(n) OVER (PARTITION BY c.lang, c.source)')} AS p,
  {_share('total', 'lang_n')} AS q FROM cells c JOIN langs l ON c.lang = l.lang),
sums AS (SELECT x.lang, x.source, y.source AS item, CAST(sum(abs(x.p - y.p)) AS BIGINT) AS value
  FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
  GROUP BY ALL),
pairs AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item,
  coalesce(s.value, 0) AS value FROM groups x JOIN groups y
  ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN sums s ON s.lang = x.lang AND s.source = x.source AND s.item = y.source),
every AS (SELECT * FROM pairs UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part
  ORDER BY value DESC, item) AS INTEGER) AS rank FROM every)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {D.TOP_TERMS}"""

QUERIES = {"op12_filter_audit": op12_filter_audit,
           "op13_source_divergence": op13_source_divergence}
ORACLE = {"op12_filter_audit": FILTER_SQL, "op13_source_divergence": DIVERGENCE_SQL}
