"""Experiment results, statistics and decisions.

Tail probabilities have series of their own in the SQL twins, posteriors the same grid.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from agorakit.functions import fixed, half_up, tails
from agorakit.operators import assignment, bayes, experiments, stats
from agorakit.plans.oracle import hash_mod, msum, p_fisher, p_norm, p_student, pct, r, sql
from agorakit.plans.registry import register

register(
    "experiment_assignments",
    lambda m: m.assignments.select("customer_id", "experiment_id", "variant"),
    sql("SELECT customer_id, experiment_id, variant FROM assignments"),
)
register(
    "keyed_sample",
    lambda m: assignment.hash_sample(m.raw_customers, "customer_id", "audit", 0.1).select("customer_id"),
    sql(
        "SELECT customer_id FROM raw_customers WHERE "
        + hash_mod("customer_id || '|audit'")
        + " / 10000.0::DOUBLE < 0.1::DOUBLE"
    ),
)
register("fct_experiment_results", lambda m: m.results, sql("SELECT * FROM results"))
register(
    "experiment_frame",
    lambda m: m.frame.select(
        "customer_id", "experiment_id", "variant", "order_id", "converted", "order_total", "item_count", "review_score"
    ),
    sql(
        "SELECT customer_id, experiment_id, variant, order_id, converted, order_total, item_count, review_score FROM frame"
    ),
)
_SIDES = (("control", "c"), ("treatment", "t"))
_DESCRIBED = ", ".join(
    f"count(*) FILTER (variant = '{v}') AS n_{v}, count(*) FILTER (variant = '{v}' AND converted) AS conversions_{v}, "
    f"count(*) FILTER (variant = '{v}' AND converted) / count(*) FILTER (variant = '{v}')::DOUBLE AS conversion_rate_{v}, "
    f"{r(f'sum(order_total) FILTER (variant = {v!r})', 4)} / count(*) FILTER (variant = '{v}') AS revenue_mean_{v}, "
    f"{r(f'stddev_samp(order_total) FILTER (variant = {v!r})', 2)} AS revenue_std_{v}, "
    f"quantile_cont(order_total, 0.5) FILTER (variant = '{v}') AS revenue_median_{v}"
    for v, _ in _SIDES
)


def _described(m):
    d = stats.descriptives(m.frame_table)
    return d.withColumns({f"revenue_std_{v}": half_up(F.col(f"revenue_std_{v}"), 2) for v, _ in _SIDES})


register("descriptives", _described, sql(f"SELECT experiment_id, {_DESCRIBED} FROM frame GROUP BY 1"))


def _rates(m):
    return stats.descriptives(m.frame, medians=False)


_Z_OF = (
    "SELECT *, (conversions_control / n_control - conversions_treatment / n_treatment) / nullif(sqrt(p * (1 - p) * "
    "(1.0::DOUBLE / n_control + 1.0::DOUBLE / n_treatment)), 0) AS z FROM (SELECT *, (conversions_control + "
    "conversions_treatment) / (n_control + n_treatment) AS p FROM {rows})"
)
register(
    "z_test",
    lambda m: stats.z_test(_rates(m)).select(
        "experiment_id",
        half_up(F.col("z_statistic"), 9).alias("z_statistic"),
        *[half_up(F.col(c), 6).alias(c) for c in ("z_p_value", "z_p_greater", "z_p_less")],
    ),
    sql(
        f"SELECT experiment_id, {r('z', 9)} AS z_statistic, {r('p', 6)} AS z_p_value, {r('CASE WHEN z >= 0 THEN p / 2 ELSE 1 - p / 2 END', 6)} "
        f"AS z_p_greater, {r('CASE WHEN z >= 0 THEN 1 - p / 2 ELSE p / 2 END', 6)} AS z_p_less FROM "
        f"(SELECT experiment_id, z, {p_norm('z')} AS p FROM ({_Z_OF.format(rows='stats')}))"
    ),
)
_CELLS = (
    "SELECT *, conversions_control::DOUBLE AS a, (n_control - conversions_control)::DOUBLE AS b, "
    "conversions_treatment::DOUBLE AS c, (n_treatment - conversions_treatment)::DOUBLE AS d FROM stats"
)
_CHI2 = (
    "(a + b + c + d) * pow(greatest(abs(a * d - b * c) - (a + b + c + d) / 2, 0), 2) / "
    "((a + b) * (c + d) * (a + c) * (b + d))"
)
register(
    "chi_square",
    lambda m: stats.chi_square(_rates(m)).select(
        "experiment_id",
        half_up(F.col("chi2_statistic"), 9).alias("chi2_statistic"),
        half_up(F.col("chi2_p_value"), 6).alias("chi2_p_value"),
    ),
    sql(
        f"SELECT experiment_id, {r('s', 9)} AS chi2_statistic, {r(p_norm('sqrt(s)'), 6)} AS chi2_p_value FROM "
        f"(SELECT experiment_id, {_CHI2} AS s FROM cells)",
        cells=_CELLS,
    ),
)


def _fisher(m):
    """Exact test by state, where arms are small."""
    return stats.fisher(stats.descriptives(
        m.frame.withColumn("experiment_id", F.concat_ws("|", "experiment_id", "customer_state")), medians=False
    )).select(
        "experiment_id",
        half_up(F.col("odds_ratio"), 9).alias("odds_ratio"),
        half_up(F.col("fisher_p_value"), 6).alias("fisher_p_value"),
    )


register(
    "fisher_odds_by_state",
    _fisher,
    sql(
        f"SELECT experiment_id, {r('(a * d) / nullif(b * c, 0)', 9)} AS odds_ratio, {r(p_fisher('a', 'b', 'c', 'd'), 6)} "
        "AS fisher_p_value FROM (SELECT e AS experiment_id, "
        "(count(*) FILTER (variant = 'control' AND converted))::DOUBLE AS a, "
        "(count(*) FILTER (variant = 'control' AND NOT converted))::DOUBLE AS b, "
        "(count(*) FILTER (variant = 'treatment' AND converted))::DOUBLE AS c, "
        "(count(*) FILTER (variant = 'treatment' AND NOT converted))::DOUBLE AS d FROM "
        "(SELECT *, experiment_id || '|' || customer_state AS e FROM frame) GROUP BY 1)"
    ),
)
_MOMENTS = ", ".join(
    f"count(*) FILTER (variant = '{v}') AS n_{s}, {r(f'sum(order_total) FILTER (variant = {v!r})', 4)} / "
    f"count(*) FILTER (variant = '{v}') AS mean_{s}, var_samp(order_total) FILTER (variant = '{v}') AS var_{s}"
    for v, s in _SIDES
)
_SLOPE = "exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi()) * pow(1 + c * c / df, -(df + 1) / 2)"
_NEWTON = f"SELECT * EXCLUDE (c), c + ({p_student('c', 'df')} - 0.05::DOUBLE) / (2 * {_SLOPE}) AS c FROM {{0}}"


def _welch_critical(rows: str = "frame") -> dict[str, str]:
    """Moments, t and the critical value of t (c) by Newton's method from the normal one, in ``newton4``."""
    first = (
        f"SELECT *, {fixed.Z_95}::DOUBLE AS c, (mean_c - mean_t) / se AS t FROM (SELECT *, sqrt(v_c + v_t) AS se, "
        "(v_c + v_t) * (v_c + v_t) / (v_c * v_c / (n_c - 1) + v_t * v_t / (n_t - 1)) AS df FROM "
        f"(SELECT *, var_c / n_c AS v_c, var_t / n_t AS v_t FROM (SELECT experiment_id, {_MOMENTS} FROM {rows} GROUP BY 1)))"
    )
    steps = {"newton0": first}
    for i in range(1, 5):
        steps[f"newton{i}"] = _NEWTON.format(f"newton{i - 1}")
    return steps


register(
    "welch_t_test",
    lambda m: stats.welch(m.frame, "order_total").select(
        "experiment_id",
        "n_c",
        "n_t",
        "mean_c",
        "mean_t",
        "diff",
        half_up(F.col("t_statistic"), 6).alias("t_statistic"),
        half_up(F.col("df"), 3).alias("df"),
        half_up(F.col("t_p_value"), 6).alias("t_p_value"),
        *[half_up(F.col(c), 4).alias(c) for c in ("ci_lower", "ci_upper")],
    ),
    sql(
        "SELECT experiment_id, n_c, n_t, mean_c, mean_t, mean_t - mean_c AS diff, "
        f"{r('t', 6)} AS t_statistic, {r('df', 3)} AS df, {r(p_student('t', 'df'), 6)} AS t_p_value, "
        f"{r('mean_t - mean_c - c * se', 4)} AS ci_lower, {r('mean_t - mean_c + c * se', 4)} AS ci_upper FROM newton4",
        **_welch_critical(),
    ),
)
_UPPER = lambda z: f"(CASE WHEN {z} >= 0 THEN {p_norm(z)} / 2 ELSE 1 - {p_norm(z)} / 2 END)"


def _ranked(value: str, where: str, least: int = 0) -> str:
    """Means, U and its normal scores, by value counts."""
    z = lambda u: f"({u} - n_c * n_t / 2 - 0.5) / nullif(spread, 0)"
    return (
        f"SELECT experiment_id, n_c, n_t, {r('s_c', 4)} / nullif(n_c, 0) AS mean_c, {r('s_t', 4)} / nullif(n_t, 0) AS mean_t, u AS u_statistic, "
        f"{z('greatest(u, n_c * n_t - u)')} AS z_two, {z('u')} AS z_greater, {z('(n_c * n_t - u)')} AS z_less, "
        f"u IS NOT NULL AND ties = 0 AND least(n_c, n_t) BETWEEN 1 AND {tails.MW_EXACT_SAMPLE} AS exact FROM (SELECT * EXCLUDE (u), "
        f"CASE WHEN least(n_c, n_t) >= {least} THEN u END AS u FROM (SELECT *, r2 / 2 - n_c * (n_c + 1) / 2 AS u, sqrt(n_c::DOUBLE * n_t / 12 * "
        "(n_c + n_t + 1 - ties / nullif((n_c + n_t)::DOUBLE * (n_c + n_t - 1), 0))) AS spread FROM (SELECT experiment_id, CAST(sum(c) AS BIGINT) AS n_c, "
        "CAST(sum(t) AS BIGINT) AS n_t, sum(c * (2 * before + n + 1))::DOUBLE AS r2, sum(n::DOUBLE * n * n - n) AS ties, sum(v * c) AS s_c, sum(v * t) AS s_t FROM "
        "(SELECT *, coalesce(sum(n) OVER (PARTITION BY experiment_id ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND "
        f"1 PRECEDING), 0) AS before FROM (SELECT experiment_id, ({value})::DOUBLE AS v, count(*) FILTER (variant = 'control') AS c, "
        f"count(*) FILTER (variant = 'treatment') AS t, count(*) AS n FROM frame WHERE {where} GROUP BY 1, 2)) GROUP BY 1)))"
    )


# In how many ways m small and n large values give U: partitions of u into m parts of at most n, built up by n.
_WAYS = (
    "SELECT 0::BIGINT AS n, 0::BIGINT AS m, 0::BIGINT AS u, 1::DOUBLE AS ways UNION ALL SELECT n + 1, m + j, u + j * (n + 1), sum(ways) FROM ways, "
    f"(SELECT unnest(range(0, {tails.MW_EXACT_SAMPLE + 1})) AS j) WHERE m + j <= {tails.MW_EXACT_SAMPLE} AND "
    "n < (SELECT coalesce(max(greatest(n_c, n_t)), 0) FROM ranked_rows WHERE exact) GROUP BY n + 1, m + j, u + j * (n + 1)"
)


def _tail(z: str, at: str, factor: int) -> str:
    ways = (
        f"(SELECT coalesce(sum(w.ways) FILTER (w.u <= x.n_c * x.n_t - ceil({at})), 0) / sum(w.ways) FROM ways w "
        "WHERE w.n = greatest(x.n_c, x.n_t) AND w.m <= least(x.n_c, x.n_t))"
    )
    return f"CASE WHEN x.exact THEN least(1, {factor} * {ways}) ELSE coalesce(least(1, {factor} * {_UPPER('x.' + z)}), 1) END"


_OTHER = "(x.n_c * x.n_t - x.u_statistic)"
_RANK_TAILS = (
    ("mw_p_value", "z_two", f"greatest(x.u_statistic, {_OTHER})", 2),
    ("mw_p_greater", "z_greater", "x.u_statistic", 1),
    ("mw_p_less", "z_less", _OTHER, 1),
)
for _name, _value, _where in (
    ("mann_whitney_revenue", "order_total", "true"),
    ("mann_whitney_items", "item_count", "converted"),
    ("mann_whitney_reviews", "review_score", "review_score IS NOT NULL"),
):
    register(
        _name,
        lambda m, v=_value, w=_where: stats.mann_whitney(m.frame_table.where(w), v).select(
            "experiment_id",
            "n_c",
            "n_t",
            "mean_c",
            "mean_t",
            "u_statistic",
            *[half_up(F.col(c), 6).alias(c) for c in ("z_two", "z_greater", "z_less", "mw_p_value", "mw_p_greater", "mw_p_less")],
        ),
        sql(
            "SELECT experiment_id, n_c, n_t, mean_c, mean_t, u_statistic, "
            + ", ".join(f"{r(z, 6)} AS {z}, {r(_tail(z, at, k), 6)} AS {p}" for p, z, at, k in _RANK_TAILS)
            + " FROM ranked_rows x",
            ranked_rows=_ranked(_value, _where),
            ways=_WAYS,
        ),
    )
_SE = "sqrt(cr_c * (1 - cr_c) / n_control + cr_t * (1 - cr_t) / n_treatment)"
register(
    "rate_confidence_intervals",
    lambda m: stats.ci_rate(_rates(m)).select(
        "experiment_id",
        *[half_up(F.col(c), 9).alias(c) for c in ("absolute_lift", "relative_lift_pct", "ci_lower", "ci_upper")],
    ),
    sql(
        f"SELECT experiment_id, {r('cr_t - cr_c', 9)} AS absolute_lift, {r('(cr_t - cr_c) / cr_c * 100', 9)} "
        f"AS relative_lift_pct, {r(f'cr_t - cr_c - {fixed.Z_95}::DOUBLE * {_SE}', 9)} AS ci_lower, "
        f"{r(f'cr_t - cr_c + {fixed.Z_95}::DOUBLE * {_SE}', 9)} AS ci_upper FROM stats"
    ),
)
_H = "2 * (asin(sqrt(cr_t)) - asin(sqrt(cr_c)))"
_D = "(mean_t - mean_c) / sqrt(((n_c - 1) * var_c + (n_t - 1) * var_t) / (n_c + n_t - 2))"
_SIZE = "CASE WHEN abs({0}) < 0.2 THEN 'negligible' WHEN abs({0}) < 0.5 THEN 'small' WHEN abs({0}) < 0.8 THEN 'medium' ELSE 'large' END"
register(
    "effect_sizes",
    lambda m: stats.effect_size(_rates(m)).select(
        "experiment_id",
        half_up(F.col("cohens_h"), 6).alias("cohens_h"),
        half_up(F.col("cohens_d"), 6).alias("cohens_d"),
        "magnitude_h",
        "magnitude_d",
    ),
    sql(
        f"SELECT experiment_id, {r('h', 6)} AS cohens_h, {r('dd', 6)} AS cohens_d, {_SIZE.format('h')} AS magnitude_h, "
        f"{_SIZE.format('dd')} AS magnitude_d FROM (SELECT experiment_id, {_H} AS h, {_D} AS dd FROM stats JOIN "
        f"(SELECT experiment_id, {_MOMENTS} FROM frame GROUP BY 1) USING (experiment_id))"
    ),
)
def _assumed(m):
    checked = stats.assumptions(m.frame_table)
    return checked.withColumns(
        {c: half_up(F.col(c), 6) for c in checked.columns if c.startswith("shapiro_") or c.startswith("levene_")}
    )


def _series(coefficients, x: str) -> str:
    return "(" + " + ".join(f"{c}::DOUBLE * pow({x}, {k})" for k, c in enumerate(coefficients)) + ")"


# Normal scores: a rational start (Abramowitz & Stegun 26.2.23) and three Newton steps on the distribution function.
_BELOW = f"(CASE WHEN z < 0 THEN {p_norm('z')} / 2 ELSE 1 - {p_norm('z')} / 2 END)"
_SCORED = f"SELECT * EXCLUDE (z), z - ({_BELOW} - q) * sqrt(2 * pi()) * exp(z * z / 2) AS z FROM {{0}}"
_START = (
    "SELECT *, sign(q - 0.5) * (t - (2.515517::DOUBLE + 0.802853::DOUBLE * t + 0.010328::DOUBLE * t * t) / "
    "(1 + 1.432788::DOUBLE * t + 0.189269::DOUBLE * t * t + 0.001308::DOUBLE * t * t * t)) AS z FROM "
    "(SELECT n, i, q, sqrt(-2 * ln(least(q, 1 - q))) AS t FROM (SELECT n, i, (i - 0.375::DOUBLE) / (n + 0.25::DOUBLE) AS q FROM "
    "(SELECT n, unnest(range(1, n + 1)) AS i FROM (SELECT DISTINCT n FROM picked_sizes WHERE n > 3))))"
)
_ASSUMED = {
    "picked": "SELECT experiment_id, variant, x, row_number() OVER (PARTITION BY experiment_id, variant ORDER BY x) AS i FROM "
    "(SELECT experiment_id, variant, order_total AS x, row_number() OVER (PARTITION BY experiment_id, variant ORDER BY "
    f"sha256(customer_id || '|' || experiment_id || '|normality') || '|' || customer_id) AS place FROM frame) WHERE place <= {stats.NORMALITY_SAMPLE}",
    "picked_sizes": "SELECT experiment_id, variant, count(*) AS n, min(x) AS low, max(x) AS high FROM picked GROUP BY 1, 2",
    "scores0": _START,
    "scores1": _SCORED.format("scores0"),
    "scores2": _SCORED.format("scores1"),
    "scores3": _SCORED.format("scores2"),
    "outer_weights": "SELECT n, s2, zl, zn, l, CASE WHEN n > 5 THEN zn / sqrt(s2) + nx ELSE 0 END AS l2, l AS l1 FROM (SELECT *, zl / sqrt(s2) + "
    + _series(tails.SW_LAST, "u")
    + " AS l, "
    + _series(tails.SW_NEXT, "u")
    + " AS nx FROM (SELECT n, sum(z * z) AS s2, max(z) FILTER (i = n) AS zl, max(z) FILTER (i = n - 1) AS zn, 1 / sqrt(n) AS u FROM scores3 GROUP BY n))",
    "weights": "SELECT n, i, CASE WHEN i = n THEN l1 WHEN i = 1 THEN -l1 WHEN i = n - 1 AND n > 5 THEN l2 WHEN i = 2 AND n > 5 THEN -l2 ELSE z / "
    "sqrt((s2 - 2 * zl * zl - CASE WHEN n > 5 THEN 2 * zn * zn ELSE 0 END) / (1 - 2 * l1 * l1 - 2 * l2 * l2)) END AS a FROM scores3 JOIN outer_weights USING (n)",
    "shaped": "SELECT experiment_id, variant, n, CASE WHEN any_value(low) = any_value(high) THEN 1 ELSE least(1, pow(sum(a * x), 2) / (var_pop(x) * n)) END AS w FROM picked "
    "JOIN picked_sizes USING (experiment_id, variant) JOIN weights USING (n, i) GROUP BY 1, 2, 3",
    "judged_shapes": f"SELECT experiment_id, variant, w, CASE WHEN w = 1 THEN 1 WHEN n <= 11 AND y >= gamma THEN 0 ELSE CASE WHEN u >= 0 THEN {p_norm('u')} / 2 "
    f"ELSE 1 - {p_norm('u')} / 2 END END AS p FROM (SELECT *, CASE WHEN w = 1 THEN 0 WHEN n <= 11 THEN (-ln(greatest(gamma - y, 1e-300::DOUBLE)) - {_series(tails.SW_SMALL_MEAN, 'n')}) / "
    f"exp({_series(tails.SW_SMALL_LOG_SD, 'n')}) ELSE (y - {_series(tails.SW_MEAN, 'ln(n)')}) / exp({_series(tails.SW_LOG_SD, 'ln(n)')}) END AS u FROM "
    f"(SELECT *, CASE WHEN w < 1 THEN ln(1 - w) END AS y, {_series(tails.SW_SMALL_GAMMA, 'n')} AS gamma FROM shaped))",
    "levene": "SELECT experiment_id, n_c, n_t, "
    "(n_c + n_t - 2) * (n_c * pow(m_c - g, 2) + n_t * pow(m_t - g, 2)) / (w_c * (n_c - 1) + w_t * (n_t - 1)) AS f "
    "FROM (SELECT *, (n_c * m_c + n_t * m_t) / (n_c + n_t) AS g FROM (SELECT experiment_id, "
    + ", ".join(
        f"count(*) FILTER (variant = '{v}') AS n_{s}, avg(z) FILTER (variant = '{v}') AS m_{s}, "
        f"var_samp(z) FILTER (variant = '{v}') AS w_{s}"
        for v, s in _SIDES
    )
    + " FROM (SELECT *, abs(order_total - quantile_cont(order_total, 0.5) OVER (PARTITION BY experiment_id, variant)) "
    "AS z FROM frame) GROUP BY 1))",
    "assumed": "SELECT experiment_id, n_c AS n_control, n_t AS n_treatment, "
    + ", ".join(f"max({c}) FILTER (variant = '{v}') AS shapiro_{v}_{c}" for v in fixed.VARIANTS for c in ("w", "p"))
    + ", "
    + ", ".join(f"max(p) FILTER (variant = '{v}') >= 0.05 AS normal_{v}" for v in fixed.VARIANTS)
    + f", any_value(f) AS levene_statistic, any_value({p_student('sqrt(f)', '(n_c + n_t - 2)')}) AS levene_p FROM levene JOIN judged_shapes USING (experiment_id) "
    f"WHERE least(n_c, n_t) >= {stats.NORMALITY_LEAST} GROUP BY 1, 2, 3",
}
register(
    "test_assumptions",
    _assumed,
    sql(
        "SELECT experiment_id, n_control, n_treatment, "
        + ", ".join(f"{r(f'shapiro_{v}_{c}', 6)} AS shapiro_{v}_{c}" for v in fixed.VARIANTS for c in ("w", "p"))
        + f", normal_control, normal_treatment, {r('levene_statistic', 6)} AS levene_statistic, {r('levene_p', 6)} AS levene_p, "
        "levene_p >= 0.05 AS equal_variance FROM assumed",
        **_ASSUMED,
    ),
)
register(
    "selected_tests",
    lambda m: stats.select_test(stats.descriptives(m.frame_table, medians=False), m.catalog, stats.assumptions(m.frame_table)).select("experiment_id", "test_selected"),
    sql(
        "SELECT experiment_id, CASE WHEN test_type = 't_test' AND (least(s.n_control, s.n_treatment) < 20 OR NOT coalesce(normal_control AND normal_treatment, false)) "
        "THEN 'mann_whitney' WHEN test_type = 't_test' THEN 'welch_t' WHEN least(s.n_control, s.n_treatment) < 30 "
        "THEN 'fisher' ELSE 'z_test' END AS test_selected FROM stats s JOIN catalog USING (experiment_id) LEFT JOIN assumed USING (experiment_id)",
        **_ASSUMED,
    ),
)
_Z = fixed.Z_95 + fixed.Z_80_POWER
_GOAL = "2 * (asin(sqrt(baseline_rate * (1 + mde_percent / 100))) - asin(sqrt(baseline_rate)))"
_POWER = lambda shift: f"({_UPPER(f'({fixed.Z_95}::DOUBLE - {shift})')} + {_UPPER(f'({fixed.Z_95}::DOUBLE + {shift})')})"
register(
    "power_audit",
    lambda m: stats.power_audit(m.catalog, _rates(m)),
    sql(
        f"SELECT experiment_id, experiment_name, test_type, {r('baseline_rate', 4)} AS baseline_rate, mde_percent, "
        f"sample_per_variant AS planned_n, CAST(ceil({2 * _Z * _Z}::DOUBLE / (goal * goal)) AS BIGINT) AS required_n, "
        f"n_control AS actual_n_control, n_treatment AS actual_n_treatment, {r('cr_c', 4)} AS observed_cr_control, "
        f"{r('cr_t', 4)} AS observed_cr_treatment, {r('(cr_t - cr_c) / cr_c * 100')} AS observed_lift_pct, "
        f"{r('prospective', 4)} AS prospective_power, {r('achieved', 4)} AS achieved_power, achieved >= 0.8 AS adequate, "
        "achieved >= 0.99 AS overpowered FROM (SELECT *, "
        f"{_POWER('(abs(goal) * sqrt(sample_per_variant / 2.0::DOUBLE))')} AS prospective, "
        f"{_POWER('(abs(seen) * sqrt(1 / (1.0::DOUBLE / n_control + 1.0::DOUBLE / n_treatment)))')} AS achieved FROM "
        f"(SELECT *, {_GOAL} AS goal, CASE WHEN cr_c > 0 AND cr_t > 0 THEN {_H} ELSE 0 END AS seen FROM catalog JOIN stats USING (experiment_id)))"
    ),
)


def _power(m):
    return stats.achieved_power(stats.effect_size(_rates(m)), m.catalog).select(
        "experiment_id",
        "test_type",
        half_up(F.col("achieved_power"), 6).alias("achieved_power"),
        "adequate_power",
        "min_sample_for_80pct_power",
    )


_PLANNED = "2 * (asin(sqrt(cr_c * (1 + mde_percent / 100))) - asin(sqrt(cr_c)))"
register(
    "power_of_tests",
    _power,
    sql(
        f"SELECT experiment_id, test_type, {r('power', 6)} AS achieved_power, power >= 0.8 AS adequate_power, needed AS min_sample_for_80pct_power "
        f"FROM (SELECT experiment_id, test_type, {_POWER('(abs(h) * sqrt(1 / (1.0::DOUBLE / n_control + 1.0::DOUBLE / n_treatment)))')} AS power, "
        f"CAST(ceil({2 * _Z * _Z}::DOUBLE / (planned * planned)) AS BIGINT) AS needed FROM effects WHERE test_type <> 't_test' UNION ALL "
        "SELECT experiment_id, 't_test', max(power) FILTER (seen), min(n1) FILTER (NOT seen AND power >= 0.8) FROM powers GROUP BY 1)",
        effects=f"SELECT *, {_H} AS h, {_PLANNED} AS planned, {_D} AS dd FROM stats JOIN catalog USING (experiment_id) JOIN "
        f"(SELECT experiment_id, {_MOMENTS} FROM frame GROUP BY 1) USING (experiment_id)",
        # the observed arms, and equal arms of about as many users as the normal approximation asks for
        tries="SELECT experiment_id, true AS seen, abs(dd) AS e, n_control AS n1, n_treatment AS n2 FROM effects WHERE test_type = 't_test' UNION ALL "
        "SELECT experiment_id, false, e, n, n FROM (SELECT experiment_id, e, unnest(range(greatest(2, about - 2), about + 8)) AS n FROM "
        f"(SELECT experiment_id, e, CAST(ceil({2 * _Z * _Z}::DOUBLE / (e * e)) AS BIGINT) AS about FROM "
        "(SELECT experiment_id, CASE WHEN abs(dd) > 0 THEN abs(dd) ELSE 0.2 END AS e FROM effects WHERE test_type = 't_test')))",
        # the critical value by Newton's method from the normal one
        start=f"SELECT *, {fixed.Z_95}::DOUBLE AS c, (n1 + n2 - 2)::DOUBLE AS df, e * e * n1 * n2 / (n1 + n2) / 2 AS half FROM tries",
        newton1=_NEWTON.format("start"),
        newton2=_NEWTON.format("newton1"),
        newton3=_NEWTON.format("newton2"),
        newton4=_NEWTON.format("newton3"),
        terms="SELECT *, exp((k + 0.5::DOUBLE) * ln(c * c / (df + c * c)) + df / 2 * ln(df / (df + c * c)) + lgamma(df / 2 + k + 0.5::DOUBLE) - lgamma(df / 2) "
        "- lgamma(k + 1.5::DOUBLE)) AS term, exp(k * ln(greatest(half, 1e-300::DOUBLE)) - half - lgamma(k + 1.0::DOUBLE)) AS weight FROM "
        "(SELECT *, unnest(range(0, 500)) AS k FROM newton4)",
        powers="SELECT experiment_id, seen, n1, n2, 1 - sum(term * upto) AS power FROM (SELECT *, sum(weight) OVER (PARTITION BY experiment_id, seen, n1 ORDER BY k) "
        "AS upto FROM terms) GROUP BY 1, 2, 3, 4",
    ),
)


def _segment_p(m):
    """The z-test's p-value of every experiment and state with both arms and a rate between 0 and 1."""
    counts = m.frame.groupBy("experiment_id", "customer_state").agg(
        *[F.count_if(F.col("variant") == v).alias(f"n_{v}") for v in fixed.VARIANTS],
        *[F.count_if((F.col("variant") == v) & F.col("converted")).alias(f"conversions_{v}") for v in fixed.VARIANTS],
    )
    tested = stats.z_test(counts).where(F.col("z_p_value").isNotNull())
    return tested.select("experiment_id", "customer_state", half_up(F.col("z_p_value"), 6).alias("p_value"))


_BY_STATE = (
    "SELECT experiment_id, customer_state, "
    + ", ".join(
        f"count(*) FILTER (variant = '{v}') AS n_{v}, count(*) FILTER (variant = '{v}' AND converted) AS conversions_{v}"
        for v in fixed.VARIANTS
    )
    + " FROM frame GROUP BY 1, 2"
)
_P = (
    f"SELECT experiment_id, customer_state, {r(p_norm('z'), 6)} AS p FROM "
    f"({_Z_OF.format(rows=f'(SELECT * FROM ({_BY_STATE}) WHERE n_control > 0 AND n_treatment > 0)')}) WHERE z IS NOT NULL"
)
_ORDERED = (
    "SELECT *, count(*) OVER (PARTITION BY experiment_id) AS m, row_number() OVER (PARTITION BY experiment_id "
    "ORDER BY p, customer_state) AS i FROM pv"
)
_CORRECTED = {
    "none": "p",
    "bonferroni": "least(p * m, 1)",
    "holm": "least(max((m - i + 1) * p) OVER (PARTITION BY experiment_id ORDER BY i), 1)",
    "fdr_bh": "least(min(p * m / i) OVER (PARTITION BY experiment_id ORDER BY i DESC), 1)",
}
register(
    "multiple_testing",
    lambda m: stats.compare_corrections(_segment_p(m), ["experiment_id"]),
    sql(
        " UNION ALL ".join(
            f"SELECT experiment_id, customer_state, p AS p_value, '{k}' AS method, q AS corrected_p, "
            f"q {'<' if k == 'none' else '<='} 0.05 AS reject FROM (SELECT *, {v} AS q FROM ordered)"
            for k, v in _CORRECTED.items()
        ),
        pv=_P,
        ordered=_ORDERED,
    ),
)


def _metric_sql(metric) -> str:
    """One metric's row for each experiment, as ``stats.metric_tests`` gives it."""
    side = {"two-sided": 0, "greater": 1, "less": 2}[metric.direction]
    if metric.column is None:
        p = (p_norm("z"), f"CASE WHEN z >= 0 THEN {p_norm('z')} / 2 ELSE 1 - {p_norm('z')} / 2 END", f"CASE WHEN z >= 0 THEN 1 - {p_norm('z')} / 2 ELSE {p_norm('z')} / 2 END")[side]
        rows = f"SELECT experiment_id, cr_c AS c, cr_t AS t, z AS statistic, coalesce({p}, 1) AS p FROM ({_Z_OF.format(rows='stats')})"
    else:
        _, z, at, k = _RANK_TAILS[side]
        rows = f"SELECT experiment_id, mean_c AS c, mean_t AS t, u_statistic AS statistic, {_tail(z, at, k)} AS p FROM ranked_rows x WHERE of_metric = '{metric.name}'"
    diff = "CASE WHEN statistic IS NOT NULL THEN t - c ELSE 0 END"
    return (
        f"SELECT experiment_id, '{metric.name}' AS metric, '{metric.role}' AS role, coalesce(c, 0) AS control, coalesce(t, 0) AS treatment, coalesce({diff}, 0) AS absolute_diff, "
        f"{r(f'coalesce(({diff}) / nullif(c, 0) * 100, 0)')} AS relative_diff_pct, statistic, p FROM ({rows})"
    )


def _ranked_metric(metric) -> str:
    where = f"{metric.column} IS NOT NULL" + (" AND converted" if metric.converters_only else "")
    return f"SELECT *, '{metric.name}' AS of_metric FROM ({_ranked(metric.column, where, 5)})"


_GATED = {
    "ranked_rows": " UNION ALL ".join(_ranked_metric(metric) for metric in stats.STANDARD_METRICS if metric.column),
    "ways": _WAYS,
    "metric_rows": " UNION ALL ".join(_metric_sql(metric) for metric in stats.STANDARD_METRICS),
    "held": "SELECT *, least(1, max((size - place + 1) * p) OVER (PARTITION BY experiment_id, role ORDER BY place)) AS q, "
    "coalesce(min(CASE WHEN role = 'primary' THEN CAST(p < 0.05 AS INTEGER) END) OVER (PARTITION BY experiment_id) = 1, false) AS primary_passed FROM "
    "(SELECT *, count(*) OVER (PARTITION BY experiment_id, role) AS size, row_number() OVER (PARTITION BY experiment_id, role ORDER BY p, metric) AS place FROM metric_rows)",
    "gated": "SELECT *, coalesce(corrected < 0.05, false) AS significant, role = 'guardrail' AND coalesce(corrected < 0.05, false) AND absolute_diff < 0 AS triggered FROM "
    "(SELECT *, CASE WHEN role <> 'secondary' THEN p WHEN primary_passed THEN q END AS corrected FROM held)",
}
_METRIC_COLUMNS = ["experiment_id", "metric", "role", "control", "treatment", "absolute_diff", "relative_diff_pct"]
register(
    "multi_metric_values",
    lambda m: stats.metric_tests(m.frame_table).select(
        *_METRIC_COLUMNS, half_up(F.col("statistic"), 6).alias("statistic"), half_up(F.col("p_value"), 6).alias("p_value")
    ),
    sql(f"SELECT {', '.join(_METRIC_COLUMNS)}, {r('statistic', 6)} AS statistic, {r('p', 6)} AS p_value FROM metric_rows", **{k: _GATED[k] for k in ("ranked_rows", "ways", "metric_rows")}),
)


def _hierarchical(m):
    tested = stats.hierarchical(stats.metric_tests(m.frame_table))
    return tested.withColumns({c: half_up(F.col(c), 6) for c in ("statistic", "p_value", "corrected_p")})


register(
    "hierarchical_metrics",
    _hierarchical,
    sql(
        f"SELECT {', '.join(_METRIC_COLUMNS)}, {r('statistic', 6)} AS statistic, {r('p', 6)} AS p_value, {r('corrected', 6)} AS corrected_p, primary_passed, "
        "significant, triggered FROM gated",
        **_GATED,
    ),
)
register(
    "hierarchical_decisions",
    lambda m: stats.hierarchical_decision(stats.hierarchical(stats.metric_tests(m.frame_table))),
    sql(
        "SELECT experiment_id, primary_passed, NOT blocked AS guardrail_ok, CASE WHEN NOT primary_passed THEN 'FAIL' WHEN blocked THEN 'BLOCKED' "
        "WHEN secondary THEN 'STRONG LAUNCH' ELSE 'LAUNCH' END AS decision FROM (SELECT experiment_id, bool_and(primary_passed) AS primary_passed, "
        "bool_or(triggered) AS blocked, bool_or(role = 'secondary' AND significant) AS secondary FROM gated GROUP BY 1)",
        **_GATED,
    ),
)
register("experiment_report", lambda m: stats.experiment_report(m.frame_table, m.catalog))
register(
    "business_impact",
    lambda m: stats.impact(stats.ci_rate(_rates(m), True).withColumn("test_type", F.lit("chi_square"))).select(
        "experiment_id", "monthly_extra_conversions", "monthly_revenue_impact", "annual_revenue_impact", "ci_annual_lower", "ci_annual_upper"
    ),
    sql(
        f"SELECT experiment_id, {r('100000.0::DOUBLE * l', 0)} AS monthly_extra_conversions, "
        f"{r('100000.0::DOUBLE * l * rev')} AS monthly_revenue_impact, "
        f"{r('100000.0::DOUBLE * l * rev * 12')} AS annual_revenue_impact, "
        + ", ".join(f"{r(f'(l {op} {fixed.Z_95}::DOUBLE * {_SE}) * 100000.0::DOUBLE * rev * 12')} AS ci_annual_{e}" for op, e in (("-", "lower"), ("+", "upper")))
        + " FROM (SELECT *, cr_t - cr_c AS l FROM (SELECT experiment_id, n_control, n_treatment, "
        f"{r('cr_t', 4)} AS cr_t, {r('cr_c', 4)} AS cr_c, {r('mean_t')} AS rev FROM stats JOIN (SELECT experiment_id, {_MOMENTS} "
        "FROM frame GROUP BY 1) USING (experiment_id)))"
    ),
)


def _summary(m):
    """p-value and significance of the z-test, and the decision with the planned sample as adequacy."""
    s = stats.ci_rate(stats.z_test(_rates(m))).join(m.catalog.select("experiment_id", "sample_per_variant"), "experiment_id")
    p = half_up(F.col("z_p_value"), 6)
    hit = F.coalesce(p < 0.05, F.lit(False))
    adequate = F.least("n_control", "n_treatment") >= F.col("sample_per_variant")
    return s.select(
        "experiment_id",
        p.alias("p_value"),
        F.when(hit, "Yes").otherwise("No").alias("significant"),
        stats.decide(hit, F.col("relative_lift_pct"), F.col("absolute_lift") > 0, adequate).alias("recommendation"),
        half_up(F.col("absolute_lift") * F.lit(100_000.0), 2).alias("revenue_impact_monthly"),
    )


_SUMMARY = (
    "SELECT experiment_id, p_value, CASE WHEN hit THEN 'Yes' ELSE 'No' END AS significant, "
    "CASE WHEN hit AND lift > 0 AND abs(lift_pct) >= 10 THEN 'LAUNCH' WHEN hit AND lift > 0 THEN 'ITERATE' "
    "WHEN NOT hit AND least(n_control, n_treatment) < sample_per_variant THEN 'INCONCLUSIVE' ELSE 'ABANDON' END "
    f"AS recommendation, {r('lift * 100000.0::DOUBLE')} AS revenue_impact_monthly FROM (SELECT *, cr_t - cr_c AS lift, "
    "(cr_t - cr_c) / cr_c * 100 AS lift_pct, coalesce(p_value < 0.05, false) AS hit FROM (SELECT * EXCLUDE (p), "
    f"{r(p_norm('z'), 6)} AS p_value FROM ({_Z_OF.format(rows='stats')})) JOIN (SELECT experiment_id, sample_per_variant "
    "FROM catalog) USING (experiment_id))"
)
register("experiment_decisions", _summary, sql(_SUMMARY))


def _exported(m):
    """Results in the export form: one row per variant, users that convert."""
    e = experiments.export_variants(m.frame)
    return e.select(
        "experiment_id",
        "experiment_name",
        "variant",
        F.col("users").alias("unique_users"),
        F.col("conv_rate").alias("conversion_rate"),
        F.col("revenue").alias("total_revenue"),
        F.col("aov").alias("avg_order_value"),
    )


_EXPORT = (
    "SELECT experiment_id, experiment_name, upper(variant[1]) || variant[2:] AS variant, count(*) AS users, "
    f"count(*) FILTER (converted) AS conversions, {pct('count(*) FILTER (converted)', 'count(*)')} AS conv_rate, "
    f"{r(msum('order_total'))} AS revenue, coalesce({r('sum(order_total) FILTER (converted)', 4)} / "
    "nullif(count(*) FILTER (converted), 0), 0) AS raw_aov FROM frame GROUP BY 1, 2, 3"
)
register(
    "experiment_export",
    lambda m: experiments.export_variants(m.frame),
    sql(f"SELECT * EXCLUDE (raw_aov), {r('raw_aov')} AS aov FROM exported", exported=_EXPORT),
)
_PIVOT = ", ".join(
    f"max({c}) FILTER (variant = '{v.capitalize()}') AS {v}_{n}"
    for c, n in (("users", "users"), ("conv_rate", "conversion_rate"), ("revenue", "revenue"), ("raw_aov2", "aov"))
    for v in fixed.VARIANTS
)
_COMPARED = (
    "SELECT *, (treatment_conversion_rate - control_conversion_rate) / nullif(control_conversion_rate, 0) * 100 "
    f"AS lift_percent FROM (SELECT experiment_id, max(experiment_name) AS experiment_name, {_PIVOT} FROM "
    f"(SELECT *, {r('raw_aov')} AS raw_aov2 FROM exported) GROUP BY 1) JOIN summary USING (experiment_id)"
)
_CTX = {"exported": _EXPORT, "summary": _SUMMARY}
register(
    "experiment_comparison",
    lambda m: experiments.comparison(_exported(m), _summary(m)),
    sql(_COMPARED, **_CTX),
)
_LIST = (
    "SELECT experiment_id, experiment_name, p_value, p_value < 0.05 AS significant, recommendation, "
    f"revenue_impact_monthly, {r('lift_percent')} AS lift_percent, {r('lift_percent - w', 1)} AS ci_lower, "
    f"{r('lift_percent + w', 1)} AS ci_upper, 2 * CAST(floor({2 * 2.8 * 2.8}::DOUBLE * c * (1 - c) / "
    f"{0.02**2}::DOUBLE) AS BIGINT) AS sample_size_needed, control_users + treatment_users AS sample_size_current, "
    "control_users, xc AS control_conversions, control_conversion_rate, control_revenue, "
    f"{r('control_revenue / greatest(xc, 1)')} AS control_aov, treatment_users, xt AS treatment_conversions, "
    f"treatment_conversion_rate, treatment_revenue, {r('treatment_revenue / greatest(xt, 1)')} AS treatment_aov FROM "
    "(SELECT *, 1.96::DOUBLE * (sqrt(c * (1 - c) / greatest(control_users, 1) + t * (1 - t) / greatest(treatment_users, 1)) "
    "/ greatest(c, 0.001::DOUBLE) * 100) AS w, CAST(floor(control_users * c) AS BIGINT) AS xc, "
    "CAST(floor(treatment_users * t) AS BIGINT) AS xt FROM (SELECT *, control_conversion_rate / 100 AS c, "
    "treatment_conversion_rate / 100 AS t FROM compared))"
)


def _compared(m):
    return experiments.comparison(_exported(m), _summary(m))


register("experiment_list", lambda m: experiments.experiment_list(_compared(m)), sql(_LIST, **_CTX, compared=_COMPARED))
register(
    "experiment_detail",
    lambda m: experiments.experiment_detail(_compared(m), "exp_004"),
    sql(f"{_LIST} WHERE experiment_id = 'exp_004'", **_CTX, compared=_COMPARED),
)
register(
    "experiment_portfolio",
    lambda m: experiments.portfolio(_compared(m)),
    sql(
        f"SELECT experiment_name, lift_percent, ci_lower, ci_upper, significant, recommendation FROM ({_LIST})",
        **_CTX,
        compared=_COMPARED,
    ),
)
register(
    "portfolio_summary",
    lambda m: experiments.portfolio_summary(_summary(m), m.results),
    sql(
        "SELECT count(*) AS total_experiments, count(*) FILTER (significant = 'Yes') AS significant, "
        "count(*) FILTER (recommendation = 'LAUNCH') AS launch_ready, "
        f"{r('coalesce(sum(revenue_impact_monthly) FILTER (recommendation = ' + repr('LAUNCH') + '), 0)')} "
        "AS total_revenue_impact, (SELECT CAST(floor(avg(unique_users) + 0.5) AS BIGINT) FROM results) AS avg_sample_size "
        "FROM summary",
        summary=_SUMMARY,
    ),
)
register(
    "executive_summary",
    lambda m: experiments.executive_summary(_summary(m)),
    sql(
        f"SELECT *, {r('total_revenue_impact_monthly * 12')} AS total_revenue_impact_annual FROM (SELECT count(*) "
        "AS total_experiments, count(*) FILTER (significant = 'Yes') AS statistically_significant, "
        + ", ".join(
            f"count(*) FILTER (recommendation IN ({', '.join(map(repr, ds))})) AS {n}"
            for n, ds in (
                ("launched", ["LAUNCH"]),
                ("abandoned", ["ABANDON"]),
                ("iterate", ["ITERATE"]),
                ("inconclusive", ["INCONCLUSIVE"]),
                ("testing_continue", ["ITERATE", "INCONCLUSIVE"]),
            )
        )
        + f", {r('coalesce(sum(revenue_impact_monthly), 0)')} AS total_revenue_impact_monthly FROM summary)",
        summary=_SUMMARY,
    ),
)
register(
    "cumulative_conversion",
    lambda m: experiments.cumulative(m.clicks, "exp_001"),
    sql(
        "SELECT CAST(day AS INTEGER) AS day, "
        + ", ".join(f"coalesce(max(cr) FILTER (variant = '{v}'), 0) AS {v}" for v in fixed.VARIANTS)
        + " FROM (SELECT variant, row_number() OVER w AS day, "
        + pct("sum(x) OVER w", "sum(s) OVER w")
        + " AS cr FROM (SELECT CAST(event_timestamp AS DATE) AS d, variant, count(DISTINCT session_id) AS s, "
        "count(DISTINCT session_id) FILTER (event_type = 'checkout_complete') AS x FROM clicks GROUP BY 1, 2) "
        "WINDOW w AS (PARTITION BY variant ORDER BY d)) GROUP BY 1"
    ),
)
register(
    "covariate_balance",
    lambda m: experiments.balance(m.assignments, "customer_state"),
    sql(
        "SELECT experiment_id, customer_state, "
        + ", ".join(f"coalesce(max(share) FILTER (variant = '{v}'), 0) AS {v}" for v in fixed.VARIANTS)
        + f" FROM (SELECT *, {r('n / sum(n) OVER (PARTITION BY experiment_id, variant)', 6)} AS share FROM (SELECT "
        "experiment_id, variant, customer_state, count(*) AS n FROM assignments WHERE (experiment_id, customer_state) IN "
        "(SELECT (experiment_id, customer_state) FROM (SELECT experiment_id, customer_state, row_number() OVER "
        "(PARTITION BY experiment_id ORDER BY count(*) DESC, customer_state) AS i FROM assignments GROUP BY 1, 2) "
        "WHERE i <= 5) GROUP BY 1, 2, 3)) GROUP BY 1, 2"
    ),
)
register(
    "assignment_split_checks",
    lambda m: experiments.split_checks(m.assignments),
    sql(
        "SELECT *, control_pct BETWEEN 45 AND 55 AS balanced FROM (SELECT experiment_id, "
        "count(*) FILTER (variant = 'control') AS n_control, count(*) FILTER (variant = 'treatment') AS n_treatment, "
        "0::BIGINT AS in_both_arms, count(*) - count(DISTINCT customer_id) AS duplicate_pairs, "
        f"{pct('count(*) FILTER (variant = ' + repr('control') + ')', 'count(*)', 4)} AS control_pct FROM assignments "
        "GROUP BY 1)"
    ),
)
register(
    "free_shipping_cost",
    lambda m: experiments.band_cost(m.frame, 100_000.0, 300_000.0),
    sql(
        f"SELECT experiment_id, {r('s', 6)} AS pct_incremental, {r('cost')} AS monthly_shipping_cost, "
        f"{r('profit')} AS monthly_profit, {r('profit - cost')} AS monthly_net FROM (SELECT *, "
        "100000 * (xt / nt::DOUBLE) * s * 20.0::DOUBLE AS cost, 100000 * (xt / nt::DOUBLE - xc / nc::DOUBLE) * "
        "coalesce(rev / nullif(xt, 0), 0) * 0.15::DOUBLE AS profit FROM (SELECT *, "
        "coalesce(band / nullif(xt, 0)::DOUBLE, 0) AS s FROM (SELECT experiment_id, "
        "count(*) FILTER (variant = 'treatment') AS nt, count(*) FILTER (variant <> 'treatment') AS nc, "
        "count(*) FILTER (variant = 'treatment' AND converted) AS xt, "
        "count(*) FILTER (variant <> 'treatment' AND converted) AS xc, count(*) FILTER (variant = 'treatment' AND "
        "converted AND order_total >= 100000 AND order_total < 300000) AS band, "
        f"{r('sum(order_total) FILTER (variant = ' + repr('treatment') + ' AND converted)', 4)} AS rev FROM frame "
        "GROUP BY 1)))"
    ),
)
register(
    "results_by_segment",
    lambda m: experiments.by_segment(m.frame, "customer_state"),
    sql(
        f"SELECT *, {r('(x_treatment / nullif(n_treatment, 0) - x_control / nullif(n_control, 0)) / nullif(x_control / nullif(n_control, 0), 0) * 100', 4)} "
        "AS lift_percent FROM (SELECT experiment_id, customer_state, "
        + ", ".join(
            f"count(*) FILTER (variant = '{v}') AS n_{v}, count(*) FILTER (variant = '{v}' AND converted) AS x_{v}, "
            f"coalesce({r(f'sum(order_total) FILTER (variant = {v!r})', 4)}, 0) AS revenue_{v}"
            for v in fixed.VARIANTS
        )
        + " FROM frame GROUP BY 1, 2)"
    ),
)
_SRM_STAT = "(n_control - n_treatment)::DOUBLE * (n_control - n_treatment) / (n_control + n_treatment)"
_SRM = f"{r('s', 9)} AS srm_statistic, {r(p_norm('sqrt(s)'), 6)} AS srm_p_value, {p_norm('sqrt(s)')} < 0.01 AS mismatch"
register(
    "sample_ratio_mismatch",
    lambda m: stats.srm(experiments.arm_counts(m.assignments)).select(
        "experiment_id", "n_control", "n_treatment", half_up(F.col("srm_statistic"), 9).alias("srm_statistic"),
        half_up(F.col("srm_p_value"), 6).alias("srm_p_value"), "mismatch",
    ),
    sql(
        f"SELECT experiment_id, n_control, n_treatment, {_SRM} FROM (SELECT *, {_SRM_STAT} AS s FROM stats)"
    ),
)
register(
    "sample_ratio_by_state",
    lambda m: stats.srm(experiments.arm_counts(m.assignments, ["customer_state"])).select(
        "experiment_id", "customer_state", "n_control", "n_treatment", half_up(F.col("srm_statistic"), 9).alias("srm_statistic"),
        half_up(F.col("srm_p_value"), 6).alias("srm_p_value"), "mismatch",
    ),
    sql(
        f"SELECT * EXCLUDE (s), {_SRM} FROM (SELECT *, {_SRM_STAT} AS s FROM (SELECT experiment_id, customer_state, count(*) FILTER (variant = 'control') "
        "AS n_control, count(*) FILTER (variant = 'treatment') AS n_treatment FROM assignments GROUP BY 1, 2))"
    ),
)
register(
    "experiment_independence",
    lambda m: stats.independence(experiments.arm_pairs(m.assignments, fixed.EXPERIMENT_IDS)).select(
        "experiment_a", "experiment_b", "n00", "n01", "n10", "n11", half_up(F.col("chi2_statistic"), 9).alias("chi2_statistic"),
        half_up(F.col("chi2_p_value"), 6).alias("chi2_p_value"), "independent",
    ),
    sql(
        f"SELECT * EXCLUDE (a, b, c, d, s), {r('s', 9)} AS chi2_statistic, {r(p_norm('sqrt(s)'), 6)} AS chi2_p_value, "
        f"{p_norm('sqrt(s)')} > 0.05 AS independent FROM (SELECT *, {_CHI2} AS s FROM (SELECT *, n00::DOUBLE AS a, n01::DOUBLE "
        "AS b, n10::DOUBLE AS c, n11::DOUBLE AS d FROM (SELECT x.experiment_id AS experiment_a, y.experiment_id "
        "AS experiment_b, "
        + ", ".join(
            f"count(*) FILTER (x.variant = '{fixed.VARIANTS[i]}' AND y.variant = '{fixed.VARIANTS[j]}') AS n{i}{j}"
            for i in (0, 1)
            for j in (0, 1)
        )
        + " FROM assignments x JOIN assignments y ON x.customer_id = y.customer_id AND x.experiment_id < y.experiment_id "
        "GROUP BY 1, 2)))"
    ),
)

# --- Bayesian --------------------------------------------------------------------------------------------------

register(
    "bayes_posteriors",
    lambda m: bayes.posterior(_rates(m), 10.0, 90.0).select("experiment_id", *bayes._posterior_columns()),
    sql(
        "SELECT experiment_id, "
        + ", ".join(
            f"10.0::DOUBLE + conversions_{v} AS {v}_alpha, 90.0::DOUBLE + n_{v} - conversions_{v} AS {v}_beta"
            for v in fixed.VARIANTS
        )
        + " FROM stats"
    ),
)
def _compared_betas(key: str, params: str) -> dict[str, str]:
    """Expressions that compare two beta posteriors on one grid; ``params`` has the columns ``key``, a_c, b_c, a_t, b_t."""
    sd = lambda a, b: f"sqrt({a} * {b} / (({a} + {b}) * ({a} + {b}) * ({a} + {b} + 1)))"
    upto = lambda column, order: f"sum({column}) OVER (PARTITION BY {key} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    at = lambda q, mass, total, edge, order: f"arg_min({edge} + h * ({q}::DOUBLE - ({total} - {mass})) / {mass}, {order}) FILTER ({total} >= {q}::DOUBLE)"
    share = lambda x: f"sum(p * greatest(0, least(1, {x}::DOUBLE / h - (d - 0.5::DOUBLE))))"
    ends = (("low", bayes.LOW), ("high", bayes.HIGH))
    return {
        "params": params,
        "boxed": "SELECT *, greatest(0, least(mc - {0} * sc, mt - {0} * st)) AS lo, least(1, greatest(mc + {0} * sc, mt + {0} * st)) AS hi FROM "
        "(SELECT *, a_c / (a_c + b_c) AS mc, a_t / (a_t + b_t) AS mt, {1} AS sc, {2} AS st FROM params)".format(
            f"{bayes.REACH}::DOUBLE", sd("a_c", "b_c"), sd("a_t", "b_t")
        ),
        "sized": f"SELECT *, (hi - lo) / k AS h FROM (SELECT *, greatest(1, CAST(ceil((hi - lo) / (least(sc, st) / {bayes.FINE}::DOUBLE)) AS BIGINT)) AS k FROM boxed)",
        "curves": "SELECT *, (a_c - 1) * ln(x) + (b_c - 1) * ln(1 - x) AS lc, (a_t - 1) * ln(x) + (b_t - 1) * ln(1 - x) AS lt FROM "
        "(SELECT *, lo + (i + 0.5::DOUBLE) * h AS x FROM (SELECT *, unnest(range(0, k)) AS i FROM sized))",
        "masses": f"SELECT *, ec / sum(ec) OVER (PARTITION BY {key}) AS wc, et / sum(et) OVER (PARTITION BY {key}) AS wt FROM (SELECT *, "
        f"exp(lc - max(lc) OVER (PARTITION BY {key})) AS ec, exp(lt - max(lt) OVER (PARTITION BY {key})) AS et FROM curves)",
        "arms": f"SELECT {key}, "
        + ", ".join(f"{at(q, w, g, 'lo + i * h', 'i')} AS {v}_ci_{e}" for v, w, g in (("control", "wc", "gc"), ("treatment", "wt", "gt")) for e, q in ends)
        + f" FROM (SELECT *, {upto('wc', 'i')} AS gc, {upto('wt', 'i')} AS gt FROM masses) GROUP BY {key}",
        "lifted": f"SELECT {key}, any_value(t.h) AS h, t.i - c.i AS d, sum(t.wt * c.wc) AS p FROM masses t JOIN masses c USING ({key}) GROUP BY {key}, t.i - c.i",
        "zones": f"SELECT {key}, sum(CASE WHEN d > 0 THEN p WHEN d = 0 THEN p / 2 ELSE 0 END) AS prob_treatment_better, "
        + ", ".join(f"{at(q, 'p', 'g', '(d - 0.5::DOUBLE) * h', 'd')} AS lift_ci_{e}" for e, q in ends)
        + ", sum(p * h * CASE WHEN d > 0 THEN d WHEN d = 0 THEN 1 / 6.0::DOUBLE ELSE 0 END) AS expected_loss_control, "
        "sum(p * h * CASE WHEN d < 0 THEN -d WHEN d = 0 THEN 1 / 6.0::DOUBLE ELSE 0 END) AS expected_loss_treatment, "
        f"{share(-0.005)} AS below_rope, 1 - {share(0.005)} AS above_rope FROM (SELECT *, {upto('p', 'd')} AS g FROM lifted) GROUP BY {key}",
        "compared": f"SELECT {key}, mc AS control_mean, mt AS treatment_mean, mt - mc AS lift_mean, 1 - prob_treatment_better AS prob_control_better, "
        f"1 - below_rope - above_rope AS inside_rope, {r('(mt - mc) / mc * 100')} AS lift_relative_pct, "
        f"* EXCLUDE ({key}, a_c, b_c, a_t, b_t, mc, mt, sc, st, lo, hi) FROM boxed JOIN arms USING ({key}) JOIN zones USING ({key})",
    }


def _beta_params(a: str, b: str, key: str = "experiment_id", rows: str = "stats") -> str:
    return f"SELECT {key}, " + ", ".join(
        f"{a} + conversions_{v} AS a_{s}, {b} + n_{v} - conversions_{v} AS b_{s}" for v, s in _SIDES
    ) + f" FROM {rows}"


_BETAS = _compared_betas("experiment_id", _beta_params("1.0::DOUBLE", "1.0::DOUBLE"))
_BAYES_COLUMNS = [c for c in bayes._COMPARED] + ["prob_control_better"]


def _rounded(df, digits: int, sure: int = 6):
    """Probabilities to ``sure`` digits, all other values to ``digits``."""
    place = lambda c: sure if c.startswith("prob_") or c.endswith("_rope") else digits
    return df.withColumns({c: half_up(F.col(c), place(c)) for c in _BAYES_COLUMNS if c in df.columns})


def _rounded_sql(rows: str, digits: int, columns=tuple(_BAYES_COLUMNS), extra: str = "lift_relative_pct") -> str:
    place = lambda c: 6 if c.startswith("prob_") or c.endswith("_rope") else digits
    return "SELECT experiment_id, " + ", ".join(f"{r(c, place(c))} AS {c}" for c in columns) + f", {extra} FROM {rows}"


register(
    "bayes_conversion",
    lambda m: _rounded(bayes.bayes_rate(_rates(m)), 7).drop(*bayes._posterior_columns()),
    sql(_rounded_sql("compared", 7), **_BETAS),
)
_DECISION = (
    "CASE WHEN prob_treatment_better >= 0.95 THEN 'LAUNCH TREATMENT' WHEN prob_control_better >= 0.95 THEN 'KEEP CONTROL' "
    "WHEN expected_loss_treatment < 0.001 AND expected_loss_control < 0.001 THEN 'PRACTICALLY EQUIVALENT' ELSE 'CONTINUE TESTING' END AS decision"
)
register(
    "bayes_decisions",
    lambda m: _rounded(bayes.bayes_decide(bayes.bayes_rate(_rates(m))), 7),
    sql(
        _rounded_sql("compared", 7, ("prob_treatment_better", "expected_loss_treatment", "expected_loss_control", "lift_mean"), _DECISION),
        **_BETAS,
    ),
)
register(
    "bayes_rope",
    lambda m: bayes.rope(bayes.bayes_rate(_rates(m))),
    sql(
        "SELECT experiment_id, "
        + ", ".join(f"{r(f'{z}_rope', 4)} AS prob_{z}_rope" for z in ("below", "inside", "above"))
        + ", CASE WHEN inside_rope > 0.90 THEN 'Practically equivalent' WHEN above_rope > 0.95 THEN 'Treatment better' "
        "WHEN below_rope > 0.95 THEN 'Treatment worse' ELSE 'Inconclusive' END AS conclusion FROM compared",
        **_BETAS,
    ),
)
_PHI = lambda x: f"(CASE WHEN {x} < 0 THEN {p_norm(x)} / 2 ELSE 1 - {p_norm(x)} / 2 END)"
_GAIN = "s * exp(-({0} / s) * ({0} / s) / 2) / sqrt(2 * pi()) + {0} * {1}"
register(
    "bayes_revenue",
    lambda m: _rounded(bayes.bayes_mean(stats._moments(m.frame, "order_total")), 4),
    sql(
        _rounded_sql("normal", 4),
        normal="SELECT experiment_id, mean_c AS control_mean, mean_t AS treatment_mean, m AS lift_mean, better AS prob_treatment_better, "
        "1 - better AS prob_control_better, "
        + ", ".join(
            f"{c} {op} {fixed.Z_95}::DOUBLE * {e} AS {n}_ci_{side}"
            for n, c, e in (("control", "mean_c", "sc"), ("treatment", "mean_t", "st"), ("lift", "m", "s"))
            for op, side in (("-", "low"), ("+", "high"))
        )
        + f", {_GAIN.format('m', 'better')} AS expected_loss_control, {_GAIN.format('(-m)', '(1 - better)')} AS expected_loss_treatment, "
        f"below AS below_rope, upto - below AS inside_rope, 1 - upto AS above_rope, {r('m / mean_c * 100')} AS lift_relative_pct FROM "
        f"(SELECT *, {_PHI('m / s')} AS better, {_PHI('(-0.005 - m) / s')} AS below, {_PHI('(0.005 - m) / s')} AS upto FROM "
        "(SELECT *, mean_t - mean_c AS m, sqrt(var_c / n_c) AS sc, sqrt(var_t / n_t) AS st, sqrt(var_c / n_c + var_t / n_t) AS s FROM "
        f"(SELECT experiment_id, {_MOMENTS} FROM frame GROUP BY 1)))",
    ),
)
_PRIORS = ", ".join(f"({a}::DOUBLE, {b}::DOUBLE)" for a, b in fixed.PRIORS)
register(
    "bayes_prior_sensitivity",
    lambda m: bayes.prior_sensitivity(_rates(m)),
    sql(
        f"SELECT experiment_id, prior_alpha, prior_beta, {r('prior_alpha / (prior_alpha + prior_beta)', 4)} AS prior_mean, "
        f"{r('prob_treatment_better', 4)} AS prob_treatment_better, "
        + ", ".join(
            f"{r(c, 5)} AS {c}" for c in ("lift_mean", "lift_ci_low", "lift_ci_high", "expected_loss_control", "expected_loss_treatment")
        )
        + " FROM compared",
        **_compared_betas(
            "experiment_id, prior_alpha, prior_beta",
            _beta_params(
                "prior_alpha",
                "prior_beta",
                "experiment_id, prior_alpha, prior_beta",
                f"stats, (VALUES {_PRIORS}) AS v(prior_alpha, prior_beta)",
            ),
        ),
    ),
)
_SLICE = hash_mod("customer_id || '|' || experiment_id || '|slice'")
_CHECKPOINTS = (
        "SELECT *, step / 20.0::DOUBLE AS fraction, "
        + ", ".join(f"{r(f'coalesce(conversions_{v} / nullif(n_{v}, 0), 0)', 4)} AS cr_{v}" for v in fixed.VARIANTS)
        + " FROM (SELECT experiment_id, step, "
        + ", ".join(f"CAST(sum({c}_{v}) OVER w AS BIGINT) AS {c}_{v}" for c in ("n", "conversions") for v in fixed.VARIANTS)
        + f" FROM (SELECT experiment_id, CAST({_SLICE} % 20 + 1 AS INTEGER) AS step, "
        + ", ".join(
            f"count(*) FILTER (variant = '{v}') AS n_{v}, count(*) FILTER (variant = '{v}' AND converted) "
            f"AS conversions_{v}"
            for v in fixed.VARIANTS
        )
        + " FROM frame GROUP BY 1, 2) WINDOW w AS (PARTITION BY experiment_id ORDER BY step))"
)
register("sequential_counts", lambda m: bayes.sequential_counts(m.frame), sql(_CHECKPOINTS))
_STEP_KEY = "experiment_id, step"
register(
    "bayes_sequential",
    lambda m: bayes.sequential(m.frame),
    sql(
        "SELECT experiment_id, step, fraction, n_control, n_treatment, cr_control, cr_treatment, "
        f"{r('better', 4)} AS prob_treatment_better FROM checkpoints JOIN (SELECT {_STEP_KEY}, sum(wt * (gc - wc / 2)) AS better FROM (SELECT *, "
        f"sum(wc) OVER (PARTITION BY {_STEP_KEY} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gc FROM masses) "
        f"GROUP BY {_STEP_KEY}) USING ({_STEP_KEY})",
        checkpoints=_CHECKPOINTS,
        **{
            name: text
            for name, text in _compared_betas(_STEP_KEY, _beta_params("1.0::DOUBLE", "1.0::DOUBLE", _STEP_KEY, "checkpoints")).items()
            if name in ("params", "boxed", "sized", "curves", "masses")
        },
    ),
)

