"""Query and oracle SQL of the quality rules."""

from __future__ import annotations

from sitewatch.llm import quality_rules as QR

COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "base_failed", "kept"]


def op1_quality_rules(spark, sf_dir):
    """Quality rules over every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return QR.verdicts(docs).select(*COLUMNS)


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def judged_sql(documents: str = "documents", name: str = "judged") -> str:
    """CTEs ending in ``name``: every column of ``documents`` plus the verdict."""
    every = sorted({w for ws in QR.LANGUAGES.values() for w in ws})
    lists = " ".join(f"WHEN '{k}' THEN {_list(v)}" for k, v in QR.LANGUAGES.items())
    known = ", ".join(f"'{k}'" for k in QR.LANGUAGES)
    best = ", ".join(f"{{'n': len(list_filter(c, lambda x: list_contains({_list(v)}, x))), 'l': '{k}'}}"
                     for k, v in QR.LANGUAGES.items())
    lower, space, upper, punct = (c.replace("'", "''") for c in QR.CLASSES)

    def gone(col, cls):
        return f"regexp_replace({col}, '(?:{cls})+', '', 'g')"

    def distance(p, q):
        norm = "list_transform({0}, lambda x: x / greatest(list_sum({0}), 1))"
        return (f"CASE WHEN list_sum({p}) > 0 AND list_sum({q}) > 0 THEN sqrt(greatest(0, list_sum("
                f"list_transform(list_zip({norm.format(p)}, {norm.format(q)}), lambda z: "
                "CASE WHEN z[1] > 0 THEN z[1] * log2(z[1] / ((z[1] + z[2]) / 2)) / 2 ELSE 0 END + "
                "CASE WHEN z[2] > 0 THEN z[2] * log2(z[2] / ((z[1] + z[2]) / 2)) / 2 ELSE 0 END))))"
                " ELSE 0 END")

    bins_c, bins_w = len(QR.CLASSES) + 1, len(next(iter(QR.LANGUAGES.values()))) + 1

    def summed(col, n, keep):
        return "[" + ", ".join(f"CAST(sum(CASE WHEN {keep} THEN {col}[{i}] ELSE 0 END) AS DOUBLE)"
                               for i in range(1, n + 1)) + "]"

    return f"""d0 AS (SELECT *, row_number() OVER () AS rid, coalesce(text, '') AS t FROM {documents}),
d1 AS (SELECT *, list_filter(regexp_split_to_array(t, '[{QR.WS}]+'), lambda x: x <> '') AS w FROM d0),
d2 AS (SELECT *, len(w) AS n,
  list_filter(list_transform(w, lambda x: rtrim(lower(x), '{QR.TRIM}')),
              lambda x: list_contains({_list(every)}, x)) AS c,
  {gone('t', lower)} AS r1 FROM d1),
d3 AS (SELECT *, {gone('r1', space)} AS r2 FROM d2),
d4 AS (SELECT *, {gone('r2', upper)} AS r3 FROM d3),
d5 AS (SELECT *, {gone('r3', punct)} AS r4 FROM d4),
d6 AS (SELECT *, {gone('r4', QR.DIGITS)} AS r5,
  CASE WHEN lang IN ({known}) THEN lang ELSE list_max([{best}]).l END AS ref_lang,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{QR.WS}]')) AS ls FROM d5),
d7 AS (SELECT *, list_transform(CASE ref_lang {lists} END,
  lambda k: len(list_filter(c, lambda x: x = k))) AS h FROM d6),
tri AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS times
  FROM (SELECT rid, w, unnest(range(1, n - 1)) AS i FROM d7 WHERE n >= 3)),
cov AS (SELECT rid, sum(least(3, coalesce(nxt - i, 3))) AS n_repeat_words
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM tri WHERE times > 1)
  GROUP BY rid),
base AS (SELECT d7.*, CAST(n AS BIGINT) AS n_words,
  CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
  [length(t) - length(r1), length(r1) - length(r2), length(r2) - length(r3),
   length(r3) - length(r4), length(r5)] AS chars,
  list_append(h, n - coalesce(list_sum(h), 0)) AS commons
  FROM d7 LEFT JOIN cov USING (rid)),
feats AS (SELECT *, n_words < {QR.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM base),
ref0 AS (SELECT ref_lang, {summed('chars', bins_c, 'true')} AS rc,
  {summed('commons', bins_w, 'true')} AS rw FROM feats WHERE NOT base_failed GROUP BY ref_lang),
dist0 AS (SELECT f.*, {distance('chars', 'rc')} AS cd, {distance('commons', 'rw')} AS wd
  FROM feats f JOIN ref0 USING (ref_lang) WHERE NOT base_failed),
mid AS (SELECT ref_lang, quantile_disc(cd, 0.5) AS mc, quantile_disc(wd, 0.5) AS mw
  FROM dist0 GROUP BY ref_lang),
ref1 AS (SELECT ref_lang, {summed('chars', bins_c, 'cd <= mc')} AS rc,
  {summed('commons', bins_w, 'wd <= mw')} AS rw
  FROM dist0 JOIN mid USING (ref_lang) GROUP BY ref_lang),
dist1 AS (SELECT f.*, CASE WHEN rc IS NULL THEN 0 ELSE {distance('chars', 'rc')} END AS cd,
  CASE WHEN rw IS NULL THEN 0 ELSE {distance('commons', 'rw')} END AS wd
  FROM feats f LEFT JOIN ref1 USING (ref_lang)),
{name} AS (SELECT *, NOT base_failed AND NOT (cd > {QR.MAX_CHAR_DISTANCE}
  OR (n_words >= {QR.MIN_WORDS_HIST} AND wd > {QR.MAX_WORD_DISTANCE})) AS kept FROM dist1)"""


QUERIES = {"op1_quality_rules": op1_quality_rules}
ORACLE = {"op1_quality_rules": f"WITH {judged_sql()}\nSELECT {', '.join(COLUMNS)} FROM judged"}
