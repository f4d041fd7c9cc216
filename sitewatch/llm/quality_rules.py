"""Quality rules: distribution divergence, in DataFrame expressions only.

Each document becomes two histograms: character classes and the most common
function words of its language. Each is compared with its language's reference
by Jensen-Shannon distance (square root of the divergence in bits). References
are summed over the whole corpus in two steps: first every document that passes
the base rules, then only the half of them nearest to that first reference, so
that rejected forms do not blur what they are measured against. Documents under
the minimum length are not judged by a histogram they cannot fill.

Defined cases: NULL or empty text has no words (base_failed). A language outside
LANGUAGES, or NULL, is replaced by the one with the most function-word hits. A
language without a reference document is not judged (kept unless base_failed).
Repeated rows are judged alike and all returned. Extra columns, of any name, pass
through ``kept_documents`` and are left out of ``verdicts``.

Word windows are compared by a 64-bit hash of which the lowest bits are replaced
by the position (so one sort finds the repeats): at least 43 hash bits remain for
a text of a million words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewatch.llm.common import WS, written

# The most frequent function words of each language.
LANGUAGES = {
    "en": "the of and to a in is that for it as was with be by on not are this from".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par pas au sur avec".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "es": "de la que el en y a los se las del un por con no una su para es al".split(),
}

# Character classes in the order in which they are counted; digits are left out
# (numbers and keys say nothing about a language), the rest is the last class.
CLASSES = (r"\p{Ll}", r"[\x09-\x0D\x20]", r"\p{Lu}", r"[.,;:!?'\"()\-]")
DIGITS = r"\p{Nd}"
SYMBOLS = r"[#*$%&|<>]"
TRIM = ".,;:!?"

MIN_WORDS = 50          # base rule, and least words for the character histogram
MIN_WORDS_HIST = 100    # least words for the common-word histogram
MAX_CHAR_DISTANCE = 0.16
MAX_WORD_DISTANCE = 0.36


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _strip(col: str, cls: str) -> str:
    pattern = cls.replace("\\", "\\\\").replace("'", "\\'")
    return f"regexp_replace({col}, '(?:{pattern})+', '')"


def features(docs: DataFrame, carry: bool = False) -> DataFrame:
    """Counts and histograms of every whole text, one row per document.

    Adds to doc_id and lang: the base counts, ``chars`` (class counts) and
    ``commons`` (function-word counts of ``ref_lang``, the rest last); with
    ``carry`` also the whole input row as ``row``.
    """
    every = sorted({w for ws in LANGUAGES.values() for w in ws})
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    d = docs.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("_t"), *row)
    d = d.withColumn("_w", F.expr(f"array_remove(split(_t, '[{WS}]+'), '')".replace("\\x", "\\\\x")))
    d = d.withColumn("_n", F.size("_w"))
    # rest after taking out one class after the other; each pass is shorter
    rest = ["_t"]
    for i, cls in enumerate(CLASSES):
        d = d.withColumn(f"_r{i}", F.expr(_strip(rest[-1], cls)))
        rest.append(f"_r{i}")
    d = d.withColumn("_rd", F.expr(_strip(rest[-1], DIGITS)))
    d = d.withColumn("_lines", F.expr(f"filter(split(_t, '\\n'), x -> x rlike '[^{WS}]')"
                                      .replace("\\x", "\\\\x")))
    d = d.withColumn("_k", F.expr("length(bin(_n))"))
    d = d.withColumn("_mask", F.expr("shiftleft(1L, _k) - 1"))
    d = d.withColumn("_s", F.expr(
        "sort_array(transform(if(_n < 3, cast(array() as array<int>), sequence(0, _n - 3)), i -> "
        "(xxhash64(get(_w, i), get(_w, i + 1), get(_w, i + 2)) & ~_mask) | i))"))
    d = d.withColumn("_p", F.expr(
        "sort_array(transform(filter(_s, (x, i) -> shiftright(x, _k) = shiftright(get(_s, i - 1), _k)"
        " or shiftright(x, _k) = shiftright(get(_s, i + 1), _k)), x -> x & _mask))"))
    d = d.withColumn("_c", F.expr(
        f"filter(transform(_w, w -> rtrim('{TRIM}', lower(w))), w -> w in ({_quoted(every)}))"))
    hits = ", ".join(f"named_struct('n', size(filter(_c, w -> w in ({_quoted(ws)}))), 'l', '{lang}')"
                     for lang, ws in sorted(LANGUAGES.items(), reverse=True))
    d = d.withColumn("ref_lang", F.expr(
        f"case when lang in ({_quoted(LANGUAGES)}) then lang else array_max(array({hits})).l end"))
    lists = " ".join(f"when '{lang}' then array({_quoted(ws)})" for lang, ws in LANGUAGES.items())
    d = d.withColumn("_l", F.expr(f"case ref_lang {lists} end"))
    d = d.withColumn("_h", F.expr("transform(_l, k -> size(_c) - size(array_remove(_c, k)))"))
    spans = [f"length({a}) - length({b})" for a, b in zip(rest, rest[1:])]
    return d.select(
        "doc_id", "lang", "ref_lang",
        F.col("_n").cast("long").alias("n_words"),
        F.expr("cast(length(array_join(_w, '')) as long)").alias("word_chars"),
        F.expr(f"cast(length(regexp_replace(_rd, '[^#*$%&|<>]+', '')) as long)").alias("n_symbols"),
        F.expr("cast(size(_lines) - size(array_distinct(_lines)) as long)").alias("n_dup_lines"),
        F.expr("aggregate(transform(_p, (p, i) -> least(3L, coalesce(get(_p, i + 1), p + 3) - p)),"
               " 0L, (a, x) -> a + x)").alias("n_repeat_words"),
        F.expr(f"array({', '.join(spans)}, length(_rd))").alias("chars"),
        F.expr("concat(_h, array(_n - aggregate(_h, 0, (a, x) -> a + x)))").alias("commons"),
        *(["row"] if carry else []))


def base_failed():
    return F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words")


def js_distance(p: str, q: str):
    """Jensen-Shannon distance of two count arrays; 0 where either is empty."""
    total = "aggregate({0}, 0D, (a, x) -> a + x)"
    half = ("if({x} > 0, {x} * log2({x} / (({x} + {y}) / 2)) / 2, 0D)")
    terms = (f"zip_with(transform({p}, x -> x / greatest({total.format(p)}, 1D)), "
             f"transform({q}, y -> y / greatest({total.format(q)}, 1D)), (x, y) -> "
             f"{half.format(x='x', y='y')} + {half.format(x='y', y='x')})")
    return F.expr(f"if({total.format(p)} > 0 and {total.format(q)} > 0, "
                  f"sqrt(greatest(0D, {total.format(terms)})), 0D)")


def _reference(feats: DataFrame) -> DataFrame:
    """One row per language (at most len(LANGUAGES)): summed histograms."""
    def summed(name, n, keep):
        return F.array(*[F.sum(F.when(keep, F.get(F.col(name), F.lit(i))).otherwise(0)).cast("double")
                         for i in range(n)])
    n_words = len(next(iter(LANGUAGES.values()))) + 1
    return feats.groupBy("ref_lang").agg(
        summed("chars", len(CLASSES) + 1, F.col("_near_chars")).alias("_rc"),
        summed("commons", n_words, F.col("_near_words")).alias("_rw"))


def _distances(feats: DataFrame, refs: DataFrame) -> DataFrame:
    # refs has one row per fixed language: at most len(LANGUAGES) rows
    return (feats.join(F.broadcast(refs), "ref_lang", "left")
            .withColumn("char_distance", js_distance("chars", "_rc"))
            .withColumn("word_distance", js_distance("commons", "_rw"))
            .drop("_rc", "_rw"))


def judged(docs: DataFrame, carry: bool = False) -> DataFrame:
    """Features, base_failed, both distances and kept, one row per document.

    The features are written once: they feed the references and the verdict.
    """
    feats = written(features(docs, carry).withColumn("base_failed", base_failed()),
                    "quality-features")
    passed = feats.where(~F.col("base_failed")).select("ref_lang", "chars", "commons")
    yes = passed.withColumn("_near_chars", F.lit(True)).withColumn("_near_words", F.lit(True))
    # references have at most len(LANGUAGES) rows; written once, not computed per use
    start = written(_reference(yes), "quality-start")
    first = _distances(passed, start)
    middle = first.groupBy("ref_lang").agg(
        F.percentile_approx("char_distance", 0.5, 10000).alias("_mc"),
        F.percentile_approx("word_distance", 0.5, 10000).alias("_mw"))
    near = (first.join(F.broadcast(middle), "ref_lang")
            .withColumn("_near_chars", F.col("char_distance") <= F.col("_mc"))
            .withColumn("_near_words", F.col("word_distance") <= F.col("_mw")))
    refs = written(_reference(near), "quality-references")
    far = ((F.col("char_distance") > MAX_CHAR_DISTANCE)
           | ((F.col("n_words") >= MIN_WORDS_HIST) & (F.col("word_distance") > MAX_WORD_DISTANCE)))
    return _distances(feats, refs).withColumn("kept", ~F.col("base_failed") & ~far)


def verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, both distances and kept, per document."""
    return judged(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "char_distance", "word_distance", "kept")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged."""
    rows = judged(docs, carry=True).where("kept")
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
