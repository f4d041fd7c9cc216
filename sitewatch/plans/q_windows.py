"""Queries over windowed averages and tier rollups (AGG-1, AGG-2, AGG-3)."""

from __future__ import annotations

from sitewatch import fixtures as FX
from sitewatch import schemas as S
from sitewatch.operators.windows import as_ntz, rollup, window_averages
from sitewatch.plans import oracle as O
from sitewatch.plans.catalog import register


def _avg_out(df):
    return df.select("site_id", as_ntz("end_time").alias("end_time"), "type",
                     "avg_tmp", "avg_hmt", "avg_lx")


def _site_avg(code):
    def q(spark, sf_dir):
        return _avg_out(window_averages(FX.reports(spark, sf_dir), tier=code))
    return q


for _t in S.TIERS:
    register(f"site_avg_{_t.name.lower()}",
             f"WITH {O.REPORTS},\n{O.tier_cte('t', _t.code)}\nSELECT * FROM t")(
        _site_avg(_t.code))


def _rollup(code, end_stamped=False):
    def q(spark, sf_dir):
        src = window_averages(FX.reports(spark, sf_dir), tier=code)
        return _avg_out(rollup(src, code, end_stamped=end_stamped))
    return q


for _t in S.TIERS[:-1]:
    _n = S.next_tier(_t.code)
    register(f"rollup_{_t.name.lower()}_to_{_n.name.lower()}",
             O.rollup_sql(_t.code))(_rollup(_t.code))

register("rollup_end_stamped", O.rollup_sql(2, end_stamped=True))(
    _rollup(2, end_stamped=True))


@register("avg_label_offset", f"""WITH {O.REPORTS},
{O.tier_cte('t', 2)}
SELECT site_id, end_time + INTERVAL 8 HOUR AS end_time, type, avg_tmp, avg_hmt, avg_lx FROM t""")
def q_label_offset(spark, sf_dir):
    """PRJ-13: HOUR averages labelled eight hours later, as the reference stores them."""
    return _avg_out(window_averages(FX.reports(spark, sf_dir), tier=2, label_offset_hours=8))
