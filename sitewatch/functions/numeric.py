"""Exact averages of any doubles.

A plain floating-point ``avg`` depends on the order in which partial sums are
merged, and loses small values beside large ones. Here the sum is exact: every finite
double is a whole number of some power of two. The exponents are divided into bins of
``WIDTH`` powers, and within a bin each value is a whole number (at most 2**76) of the
bin's unit, so that values of one bin are summed as wide decimals without any rounding.
Sums are kept by group and bin: an ordinary partial and final aggregate, whose parts
merge in any order. The bin of ordinary readings (0.001 to 2048, and 0) is bin 0, so a
group is usually one row there.

At the end a group's few bins (at most 102 for each column; groups of several columns
are kept by the combination of their bins) become one number. Bin 0 alone is cast to
double, which rounds once; other bins are written out as digits of one binary number,
whose leading digits and a sticky digit for the rest are cast, which rounds once too. The
average is that correctly rounded sum divided by the count: ``fsum(x) / n``. The power of
two is applied after the division, so a sum beyond the largest double still has its
average.

NaN and infinities are noted per row beside the sum and decide the result as in IEEE
addition: NaN, or infinities of both signs, give NaN; otherwise an infinity gives itself.
NULLs are ignored; no value gives NULL. No reading raises an error: a bin's sum has room
for 2**50 values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 21          # exponents in a bin; three digits of as many bits fit a long
LEAST = 10          # bin 0 begins at 2**-LEAST
UNIT = LEAST + 54   # bin b counts in units of 2**(WIDTH * b - UNIT): one bit to spare
BASE = 1 << WIDTH
HALF = float(2**40)
LEADING = 5         # digits that are cast at the end: 84 bits at least

# Bits of the marks of a row or group.
NAN, PLUS, MINUS = 1, 2, 4


def bin_of(c: str) -> str:
    """SQL: the bin of a value (0 for zero, NULL, NaN and infinities)."""
    x = f"`{c}`"
    return (f"CASE WHEN {x} IS NULL OR abs({x}) >= {2.0**-LEAST!r}D "
            f"AND abs({x}) < {2.0**(WIDTH - LEAST)!r}D OR {x} = 0D OR isnan({x}) "
            f"OR abs({x}) = double('infinity') THEN 0 "
            f"ELSE CAST(floor((log2(abs({x})) + {LEAST}) / {WIDTH}) AS INT) END")


def _power(exponent: str) -> str:
    """SQL: factors that multiply a double by 2**exponent, in halves that are both finite."""
    return f"pow(2D, ({exponent}) div 2) * pow(2D, ({exponent}) - ({exponent}) div 2)"


def scaled(c: str) -> str:
    """SQL: the value as a whole number of its bin's units, still a double (``_b_c``: bin)."""
    x, b = f"`{c}`", f"`_b_{c}`"
    return (f"CASE WHEN isnan({x}) OR abs({x}) = double('infinity') THEN NULL "
            f"WHEN {b} = 0 THEN {x} * {2.0**UNIT!r}D "
            f"ELSE {x} * {_power(f'{UNIT} - {WIDTH} * {b}')} END")


def units(v: str) -> str:
    """SQL: the decimal equal to ``v``, a whole double: in two halves, as longs are exact."""
    high = f"floor({v} / {HALF!r}D)"
    return (f"CAST(CAST({high} AS DECIMAL(20,0)) * {int(HALF)} "
            f"+ CAST({v} - {high} * {HALF!r}D AS BIGINT) AS DECIMAL(38,0))")


def marks(c: str) -> str:
    """SQL: NAN, PLUS or MINUS for a value that has no units, else 0 (NULL for NULL)."""
    x = f"`{c}`"
    return (f"CASE WHEN isnan({x}) THEN {NAN} WHEN {x} = double('infinity') THEN {PLUS} "
            f"WHEN {x} = double('-infinity') THEN {MINUS} WHEN {x} IS NOT NULL THEN 0 END")


def _bins(columns) -> list[str]:
    return [f"_b_{c}" for c in columns]


def binned_parts(df: DataFrame, keys, columns, having=()) -> DataFrame:
    """Mergeable parts of averages: per ``keys`` and bins, the sums in the bins' units
    (``_s_``), counts (``_n_``) and marks (``_x_``); ``having`` are further aggregates."""
    df = df.withColumns({f"_b_{c}": F.expr(bin_of(c)) for c in columns})
    df = df.withColumns({f"_v_{c}": F.expr(scaled(c)) for c in columns})
    df = df.withColumns({f"_{p}_{c}": F.expr(e) for c in columns
                         for p, e in (("u", units(f"`_v_{c}`")), ("m", marks(c)))})
    aggregates = [a for c in columns for a in (
        F.sum(f"_u_{c}").cast("decimal(38,0)").alias(f"_s_{c}"),
        F.count(f"_u_{c}").alias(f"_n_{c}"), F.bit_or(f"_m_{c}").alias(f"_x_{c}"))]
    return df.groupBy(*keys, *_bins(columns)).agg(*aggregates, *having)


def merged_parts(parts: DataFrame, keys, columns) -> DataFrame:
    """The parts of several groups merged into coarser ones."""
    return parts.groupBy(*keys, *_bins(columns)).agg(*[a for c in columns for a in (
        F.sum(f"_s_{c}").cast("decimal(38,0)").alias(f"_s_{c}"),
        F.sum(f"_n_{c}").alias(f"_n_{c}"), F.bit_or(f"_x_{c}").alias(f"_x_{c}"))])


def _digits(e: str) -> str:
    """SQL: the digits (BASE) of a list of parts, lowest first, and what is carried out.

    A sum of 126 bits is six signed digits, of its quotient and remainder by BASE**3.
    """
    cube = BASE**3
    pieces = []
    for at, half in ((0, f"CAST(p.s % {cube} AS BIGINT)"), (3, f"CAST(p.s div {cube} AS BIGINT)")):
        pieces += [f"named_struct('at', p.b + {at + i}, 'd', ({half} div {BASE**i}L) % {BASE}L)"
                   for i in range(2)]
        pieces.append(f"named_struct('at', p.b + {at + 2}, 'd', {half} div {BASE**2}L)")
    return f"flatten(transform({e}, p -> array({', '.join(pieces)})))"


def _carried(places: str, digit: str) -> str:
    """SQL: (carry, digits) of summing ``digit`` (of the place i) upwards with carries."""
    total = f"(a.c + {digit})"
    return (f"aggregate({places}, named_struct('c', 0L, 'd', CAST(array() AS ARRAY<BIGINT>)), "
            f"(a, i) -> named_struct('c', ({total} - pmod({total}, {BASE}L)) div {BASE}L, "
            f"'d', array_append(a.d, pmod({total}, {BASE}L))))")


def _with_sums(df: DataFrame, columns) -> DataFrame:
    """Adds ``_r_c``: (m, k), the exact sum of ``_z_c`` (bin 0) and ``_e_c`` (the others) as a
    correctly rounded double m (up to 2**127) times 2**k; NULL where bin 0 is all."""
    for c in columns:
        several = f"size(`_e_{c}`) > 0"
        e = f"`_l_{c}`"

        def only(sql):  # worked out for groups with other bins than bin 0 alone
            return F.expr(f"CASE WHEN {several} THEN {sql} END")
        df = df.withColumn(f"_l_{c}", only(
            f"CASE WHEN `_z_{c}` IS NULL THEN `_e_{c}` "
            f"ELSE array_append(`_e_{c}`, named_struct('b', 0, 's', `_z_{c}`)) END"))
        df = df.withColumn(f"_d_{c}", only(_digits(e)))
        d, low = f"`_d_{c}`", f"array_min({e}.b)"
        here = f"aggregate(filter({d}, x -> x.at = i), 0L, (s, x) -> s + x.d)"
        df = df.withColumn(f"_f_{c}", only(_carried(
            f"sequence({low}, array_max({e}.b) + 7)", here)))
        f = f"`_f_{c}`"  # carry -1: negative, and its digits are the complement
        df = df.withColumn(f"_f_{c}", only(
            f"CASE WHEN {f}.c < 0 THEN named_struct('c', -1L, 'd', "
            + _carried(f"sequence(1, size({f}.d))", f"(0L - element_at({f}.d, i))") + f".d) "
            f"ELSE {f} END"))
        # leading digits, and whether anything is below them
        df = df.withColumn(f"_j_{c}", only(
            f"greatest(1 + aggregate(sequence(1, size({f}.d)), 0, "
            f"(j, i) -> IF(element_at({f}.d, i) > 0, i, j)) - {LEADING}, 1)"))
        j = f"`_j_{c}`"
        lead = (f"aggregate(reverse(slice({f}.d, {j}, {LEADING})), CAST(0 AS DECIMAL(38,0)), "
                f"(m, x) -> CAST(m * {BASE} + x AS DECIMAL(38,0)))")
        rest = f"exists(slice({f}.d, 1, {j} - 1), x -> x > 0)"
        df = df.withColumn(f"_r_{c}", only(
            f"named_struct("
            f"'m', CAST(CAST({lead} * 2 + IF({rest}, 1, 0) AS DECIMAL(38,0)) AS DOUBLE) "
            f"* IF({f}.c < 0, -1D, 1D), 'k', {WIDTH} * ({low} + {j} - 1) - {UNIT} - 1)"))
    return df


def _average(c: str) -> Column:
    r, n, x = f"`_r_{c}`", f"`_n_{c}`", f"coalesce(`_x_{c}`, 0)"
    return F.expr(f"""
      CASE WHEN {x} & {NAN} > 0 OR {x} & {PLUS | MINUS} = {PLUS | MINUS} THEN double('nan')
           WHEN {x} & {PLUS} > 0 THEN double('infinity')
           WHEN {x} & {MINUS} > 0 THEN double('-infinity')
           WHEN {n} > 0 THEN coalesce(
             {r}.m / {n} * {_power(f'{r}.k')},
             CAST(`_z_{c}` AS DOUBLE) / {n} * {2.0**-UNIT!r}D) END""")


def finished(parts: DataFrame, keys, columns, having=()) -> DataFrame:
    """``keys`` (names) and the averages of ``columns`` under their own names, from parts;
    ``having`` are further aggregates over the parts."""
    grouped = parts.groupBy(*keys).agg(*[a for c in columns for a in (
        F.expr(f"sum(CASE WHEN `_b_{c}` = 0 THEN `_s_{c}` END)").cast("decimal(38,0)")
        .alias(f"_z_{c}"),
        F.expr(f"collect_list(CASE WHEN `_b_{c}` <> 0 AND `_n_{c}` > 0 THEN "
               f"named_struct('b', `_b_{c}`, 's', `_s_{c}`) END)").alias(f"_e_{c}"),
        F.sum(f"_n_{c}").alias(f"_n_{c}"), F.bit_or(f"_x_{c}").alias(f"_x_{c}"))], *having)
    summed = _with_sums(grouped, columns)
    rest = [c for c in grouped.columns if c in keys or not c.startswith(("_z_", "_e_", "_n_", "_x_"))]
    return summed.select(*rest, *[_average(c).alias(c) for c in columns])


def average(df: DataFrame, keys, columns) -> DataFrame:
    """``keys`` (columns) and the exact average of each of ``columns`` under its own name."""
    parts = binned_parts(df, keys, columns)
    return finished(parts, parts.columns[:len(keys)], columns)
