"""Experiment statistics from sufficient statistics.

Spark computes counts, sums, moments and value histograms per experiment and
arm; the tests are column arithmetic on the one row per experiment this leaves.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from agorakit.functions import fixed, half_up, money_sum
from agorakit.functions.grouping import exact_median, ranked_counts
from agorakit.functions.tails import (
    MW_EXACT_SAMPLE,
    p_chi_square_1,
    p_f,
    p_fisher,
    p_mann_whitney,
    p_t,
    p_two_sided,
    p_upper,
    power_of_t,
    q_t,
    sample_for_t,
    shapiro,
)

ALPHA = 0.05
ARMS = (("control", "c"), ("treatment", "t"))


def _arm(name: str) -> Column:
    return F.col("variant") == name


def descriptives(frame: DataFrame, medians: bool = True) -> DataFrame:
    """Sample sizes, conversions, rates and revenue mean, median and deviation, one row per experiment."""
    columns: list[Column] = []
    for name, _ in ARMS:
        total = F.when(_arm(name), F.col("order_total"))
        columns += [
            F.count_if(_arm(name)).alias(f"n_{name}"),
            F.count_if(_arm(name) & F.col("converted")).alias(f"conversions_{name}"),
            F.try_divide(money_sum(total), F.count(total)).alias(f"revenue_mean_{name}"),
            F.stddev_samp(total).alias(f"revenue_std_{name}"),
        ]
    stats = frame.groupBy("experiment_id").agg(*columns)
    for name, _ in ARMS:
        stats = stats.withColumn(
            f"conversion_rate_{name}", F.coalesce(F.try_divide(f"conversions_{name}", f"n_{name}"), F.lit(0.0))
        )
    if medians:
        middle = exact_median(frame, ["experiment_id", "variant"], "order_total", "m")
        wide = middle.groupBy("experiment_id").agg(
            *[F.max(F.when(_arm(name), F.col("m"))).alias(f"revenue_median_{name}") for name, _ in ARMS]
        )
        stats = stats.join(wide, "experiment_id", "left")
    return stats


def _rates(round_rates: bool) -> tuple[Column, Column]:
    c, t = F.col("conversion_rate_control"), F.col("conversion_rate_treatment")
    return (half_up(c, 4), half_up(t, 4)) if round_rates else (c, t)


def z_test(stats: DataFrame) -> DataFrame:
    """Pooled two-proportion z (control minus treatment), two-sided and one-sided p."""
    x_c, x_t, n_c, n_t = (F.col(c) for c in ("conversions_control", "conversions_treatment", "n_control", "n_treatment"))
    pooled = F.try_divide(x_c + x_t, n_c + n_t)
    one = F.lit(1.0)
    variance = pooled * (one - pooled) * (F.try_divide(one, n_c) + F.try_divide(one, n_t))
    z = F.try_divide(F.try_divide(x_c, n_c) - F.try_divide(x_t, n_t), F.sqrt(variance))
    return (
        stats.withColumn("z_statistic", z)
        .withColumn("z_p_value", p_two_sided(F.col("z_statistic")))
        .withColumn("z_p_greater", p_upper(F.col("z_statistic")))
        .withColumn("z_p_less", p_upper(-F.col("z_statistic")))
    )


def chi2_2x2(a: Column, b: Column, c: Column, d: Column, yates: bool = True) -> Column:
    """Chi-square of a 2x2 table; the correction never exceeds the observed difference."""
    a, b, c, d = (x.cast("double") for x in (a, b, c, d))
    n = a + b + c + d
    off = F.abs(a * d - b * c)
    if yates:
        off = F.greatest(off - n / F.lit(2.0), F.lit(0.0))
    return F.try_divide(n * off * off, (a + b) * (c + d) * (a + c) * (b + d))


def _table(stats_prefix: str = "") -> tuple[Column, Column, Column, Column]:
    x_c, x_t = F.col("conversions_control"), F.col("conversions_treatment")
    return x_c, F.col("n_control") - x_c, x_t, F.col("n_treatment") - x_t


def chi_square(stats: DataFrame) -> DataFrame:
    return stats.withColumn("chi2_statistic", chi2_2x2(*_table())).withColumn(
        "chi2_p_value", p_chi_square_1(F.col("chi2_statistic"))
    )


def fisher(stats: DataFrame) -> DataFrame:
    """Fisher's exact test (meant for small arms): odds ratio and two-sided p."""
    a, b, c, d = _table()
    return stats.withColumn("odds_ratio", F.try_divide(a * d, b * c)).withColumn("fisher_p_value", p_fisher(a, b, c, d))


def _moments(frame: DataFrame, column: str) -> DataFrame:
    """Count, mean and sample variance of a column per arm, one row per experiment."""
    columns: list[Column] = []
    for name, s in ARMS:
        value = F.when(_arm(name), F.col(column).cast("double"))
        columns += [
            F.count(value).alias(f"n_{s}"),
            F.try_divide(money_sum(value), F.count(value)).alias(f"mean_{s}"),
            F.var_samp(value).alias(f"var_{s}"),
        ]
    return frame.groupBy("experiment_id").agg(*columns)


def welch(frame: DataFrame, column: str, confidence: float = 0.95) -> DataFrame:
    """Welch's t-test (control minus treatment) and the interval of treatment minus control."""
    m = _moments(frame, column)
    v_c, v_t = F.try_divide("var_c", "n_c"), F.try_divide("var_t", "n_t")
    spread = F.try_divide(v_c * v_c, F.col("n_c") - 1) + F.try_divide(v_t * v_t, F.col("n_t") - 1)
    df = F.coalesce(F.try_divide((v_c + v_t) * (v_c + v_t), spread), F.col("n_c") + F.col("n_t") - F.lit(2.0))
    m = (
        m.withColumn("se", F.sqrt(v_c + v_t))
        .withColumn("df", df)
        .withColumn("t_statistic", F.try_divide(F.col("mean_c") - F.col("mean_t"), F.col("se")))
        .withColumn("diff", F.col("mean_t") - F.col("mean_c"))
    )
    crit = F.col("_crit")
    return (
        m.withColumn("t_p_value", p_t(F.col("t_statistic"), F.col("df")))
        .withColumn("_crit", q_t(F.lit(1 - (1 - confidence) / 2), F.col("df")))
        .withColumn("ci_lower", F.col("diff") - crit * F.col("se"))
        .withColumn("ci_upper", F.col("diff") + crit * F.col("se"))
        .drop("_crit")
    )


def mann_whitney(frame: DataFrame, column: str, min_values: int = 0) -> DataFrame:
    """Mann-Whitney U of the control arm with ties and continuity correction.

    Where the smaller arm has at most 8 values and there are no ties, the distribution of U is exact.

    Ranks come from a histogram: values are counted per arm, and the rank of a
    value is the number of rows before it plus half its own. Below ``min_values``
    in an arm the statistic is null and p is 1.
    """
    named = frame.where(F.col(column).isNotNull() & F.col("variant").isin(fixed.VARIANTS)).withColumn(
        "_value", F.col(column).cast("double")
    )
    ranked = ranked_counts(
        named,
        ["experiment_id"],
        "_value",
        {
            "c": F.count_if(_arm("control")),
            "t": F.count_if(_arm("treatment")),
            "n": F.count(F.lit(1)),
        },
        "n",
    )
    wide = "decimal(38,0)"
    n, before = F.col("n").cast("decimal(18,0)"), F.col("n_before").cast("decimal(18,0)")
    # twice the rank keeps everything whole until the end
    double_rank = (before * 2 + n + 1).cast("decimal(19,0)")
    sums = ranked.groupBy("experiment_id").agg(
        F.sum("c").alias("n_c"),
        F.sum("t").alias("n_t"),
        F.sum((F.col("c").cast("decimal(18,0)") * double_rank).cast(wide)).cast("double").alias("r2"),
        F.sum(F.col("n").cast("double") * F.col("n") * F.col("n") - F.col("n")).alias("ties"),
        (F.sum(F.col("_value") * F.col("c"))).alias("s_c"),
        (F.sum(F.col("_value") * F.col("t"))).alias("s_t"),
    )
    n_c, n_t = F.col("n_c").cast("double"), F.col("n_t").cast("double")
    total = n_c + n_t
    u = F.col("r2") / F.lit(2.0) - n_c * (n_c + F.lit(1)) / F.lit(2.0)
    spread = F.sqrt(
        n_c * n_t / F.lit(12.0) * (total + F.lit(1) - F.try_divide(F.col("ties"), total * (total - F.lit(1))))
    )
    mean = n_c * n_t / F.lit(2.0)
    enough = (F.col("n_c") >= min_values) & (F.col("n_t") >= min_values)
    half = F.lit(0.5)
    out = sums.select(
        "experiment_id",
        "n_c",
        "n_t",
        F.try_divide(half_up(F.col("s_c"), 4), "n_c").alias("mean_c"),
        F.try_divide(half_up(F.col("s_t"), 4), "n_t").alias("mean_t"),
        F.when(enough, u).alias("u_statistic"),
        F.when(enough, F.try_divide(F.greatest(u, n_c * n_t - u) - mean - half, spread)).alias("z_two"),
        F.when(enough, F.try_divide(u - mean - half, spread)).alias("z_greater"),
        F.when(enough, F.try_divide(n_c * n_t - u - mean - half, spread)).alias("z_less"),
        (
            enough
            & (F.col("ties") == 0)
            & (F.least("n_c", "n_t").between(1, MW_EXACT_SAMPLE))
        ).alias("exact"),
    )
    pairs = F.col("n_c") * F.col("n_t")
    other = pairs - F.col("u_statistic")

    def tail(z: str, factor: float, at: Column) -> Column:
        # rows that need no exact table ask for an empty one
        m, n = (F.when(F.col("exact"), F.col(c)).otherwise(0) for c in ("n_c", "n_t"))
        ways = p_mann_whitney(F.when(F.col("exact"), at).otherwise(0.0), m, n)
        p = F.when(F.col("exact"), ways).otherwise(p_upper(F.col(z)))
        return F.coalesce(F.least(F.lit(1.0), F.lit(factor) * p), F.lit(1.0))

    return out.select(
        *[c for c in out.columns if c != "exact"],
        tail("z_two", 2.0, F.greatest("u_statistic", other)).alias("mw_p_value"),
        tail("z_greater", 1.0, F.col("u_statistic")).alias("mw_p_greater"),
        tail("z_less", 1.0, other).alias("mw_p_less"),
    )


def ci_rate(stats: DataFrame, round_rates: bool = False) -> DataFrame:
    """Wald interval of the rate difference (treatment minus control) and the relative lift."""
    c, t = _rates(round_rates)
    one = F.lit(1.0)
    se = F.sqrt(
        F.try_divide(c * (one - c), F.col("n_control")) + F.try_divide(t * (one - t), F.col("n_treatment"))
    )
    z = F.lit(fixed.Z_95)
    return stats.select(
        "*",
        (t - c).alias("absolute_lift"),
        F.coalesce(F.try_divide(t - c, c) * F.lit(100), F.lit(0.0)).alias("relative_lift_pct"),
        ((t - c) - z * se).alias("ci_lower"),
        ((t - c) + z * se).alias("ci_upper"),
    )


def magnitude(effect: Column) -> Column:
    size = F.abs(effect)
    return F.when(size < 0.2, "negligible").when(size < 0.5, "small").when(size < 0.8, "medium").otherwise("large")


def cohens_h(p1: Column, p2: Column) -> Column:
    return (F.asin(F.sqrt(p2)) - F.asin(F.sqrt(p1))) * F.lit(2.0)


def cohens_d(m_c: Column, m_t: Column, v_c: Column, v_t: Column, n_c: Column, n_t: Column) -> Column:
    pooled = F.sqrt(F.try_divide((n_c - 1) * v_c + (n_t - 1) * v_t, n_c + n_t - 2))
    return F.coalesce(F.try_divide(m_t - m_c, pooled), F.lit(0.0))


def effect_size(stats: DataFrame, round_rates: bool = False) -> DataFrame:
    """Cohen's h of the rates, Cohen's d of revenue and the magnitude of h."""
    c, t = _rates(round_rates)
    s_c, s_t = F.col("revenue_std_control"), F.col("revenue_std_treatment")
    d = cohens_d(
        F.col("revenue_mean_control"),
        F.col("revenue_mean_treatment"),
        s_c * s_c,
        s_t * s_t,
        F.col("n_control"),
        F.col("n_treatment"),
    )
    return (
        stats.withColumn("cohens_h", cohens_h(c, t))
        .withColumn("cohens_d", d)
        .withColumn("magnitude_h", magnitude(F.col("cohens_h")))
        .withColumn("magnitude_d", magnitude(F.col("cohens_d")))
    )


def keyed_sample(rows: DataFrame, keys: Sequence[str], order: Column, size: int) -> DataFrame:
    """The ``size`` rows of each group that come first by ``order``, a hash of the row's key.

    A uniform sample that a re-run draws again. Every task keeps only its first rows of a group, groups are cut into
    shares that are reduced on their own, and the last step sees at most ``size`` rows of each share.
    """
    share = Window.partitionBy(*keys, "_share").orderBy("_order")
    whole = Window.partitionBy(*keys).orderBy("_order")
    return (
        rows.withColumn("_order", order)
        .withColumn("_share", F.pmod(F.hash("_order"), F.lit(64)))
        .withColumn("_place", F.row_number().over(share))
        .where(F.col("_place") <= size)
        .withColumn("_place", F.row_number().over(whole))
        .where(F.col("_place") <= size)
        .drop("_share", "_place", "_order")
    )


NORMALITY_SAMPLE = 500
NORMALITY_LEAST = 8


def normality(frame: DataFrame, column: str = "order_total", size: int = NORMALITY_SAMPLE) -> DataFrame:
    """Shapiro-Wilk W and p of each arm, from a keyed sample of at most ``size`` customers."""
    arms = frame.where(F.col(column).isNotNull()).select(
        "experiment_id", "variant", "customer_id", F.col(column).cast("double").alias("x")
    )
    order = F.concat_ws("|", F.sha2(F.concat_ws("|", "customer_id", "experiment_id", F.lit("normality")), 256), "customer_id")
    picked = keyed_sample(arms, ["experiment_id", "variant"], order, size)
    values = picked.groupBy("experiment_id", "variant").agg(F.sort_array(F.collect_list("x")).alias("values"))
    tested = values.withColumn("test", shapiro(F.col("values")))
    return tested.select("experiment_id", "variant", F.col("test.w").alias("w"), F.col("test.p").alias("p"))


def assumptions(frame: DataFrame, column: str = "order_total") -> DataFrame:
    """Normality per arm (Shapiro-Wilk on a keyed sample) and equal variances (Levene around the median).

    With fewer than 8 values in an arm neither is judged.
    """
    arms = frame.where(F.col(column).isNotNull()).select(
        "experiment_id", "variant", F.col(column).cast("double").alias("x")
    )
    middle = exact_median(arms, ["experiment_id", "variant"], "x", "m")
    # |x - median| only needs the values counted, not every row
    counted = arms.groupBy("experiment_id", "variant", "x").agg(F.count(F.lit(1)).cast("double").alias("w"))
    away = counted.join(middle, ["experiment_id", "variant"]).withColumn("d", F.abs(F.col("x") - F.col("m")))
    w, d = F.col("w"), F.col("d")
    per_arm = away.groupBy("experiment_id", "variant").agg(
        F.sum(w).alias("n"), F.sum(w * d).alias("s"), F.sum(w * d * d).alias("q")
    )
    shape = normality(frame, column).select("experiment_id", "variant", F.col("w").alias("sw"), F.col("p").alias("sp"))

    def pick(name: str, value: str) -> Column:
        return F.max(F.when(_arm(name), F.col(value)))

    wide = per_arm.join(shape, ["experiment_id", "variant"]).groupBy("experiment_id").agg(
        *[pick(name, v).alias(f"{v}_{s}") for name, s in ARMS for v in ("n", "s", "q", "sw", "sp")]
    )
    n = F.col("n_c") + F.col("n_t")
    enough = F.least("n_c", "n_t") >= NORMALITY_LEAST
    grand = (F.col("s_c") + F.col("s_t")) / n
    means = {s: F.try_divide(f"s_{s}", f"n_{s}") for _, s in ARMS}
    between = sum(
        (F.col(f"n_{s}") * (means[s] - grand) * (means[s] - grand) for _, s in ARMS), start=F.lit(0.0)
    )
    within = sum(
        (F.col(f"q_{s}") - F.col(f"s_{s}") * means[s] for _, s in ARMS), start=F.lit(0.0)
    )
    judged = wide.withColumn("levene_statistic", F.when(enough, F.try_divide((n - F.lit(2)) * between, within)))
    return judged.withColumn("levene_p", p_f(F.col("levene_statistic"), F.lit(1.0), n - F.lit(2))).select(
        "experiment_id",
        F.col("n_c").cast("long").alias("n_control"),
        F.col("n_t").cast("long").alias("n_treatment"),
        *[F.when(enough, F.col(f"s{v}_{s}")).alias(f"shapiro_{name}_{v}") for name, s in ARMS for v in ("w", "p")],
        *[F.when(enough, F.col(f"sp_{s}") >= ALPHA).alias(f"normal_{name}") for name, s in ARMS],
        "levene_statistic",
        "levene_p",
        (F.col("levene_p") >= ALPHA).alias("equal_variance"),
    )


def select_test(stats: DataFrame, catalog: DataFrame, checked: DataFrame) -> DataFrame:
    """Which test fits each experiment, by its kind, sample size and normality."""
    small = F.least("n_control", "n_treatment")
    normal = F.col("normal_control") & F.col("normal_treatment")
    choice = (
        F.when((F.col("test_type") == "t_test") & ((small < 20) | ~F.coalesce(normal, F.lit(False))), "mann_whitney")
        .when(F.col("test_type") == "t_test", "welch_t")
        .when(small < 30, "fisher")
        .otherwise("z_test")
    )
    flags = checked.select("experiment_id", "normal_control", "normal_treatment")
    return (
        stats.join(catalog.select("experiment_id", "test_type"), "experiment_id")
        .join(flags, "experiment_id", "left")
        .withColumn("test_selected", choice)
    )


def power_normal(effect: Column, n1: Column, n2: Column) -> Column:
    """Two-sided power of a z-test at 5 % for a standardised effect."""
    one = F.lit(1.0)
    shift = F.abs(effect) * F.sqrt(F.try_divide(one, F.try_divide(one, n1) + F.try_divide(one, n2)))
    crit = F.lit(fixed.Z_95)
    return p_upper(crit - shift) + p_upper(shift + crit)


def required_n(effect: Column) -> Column:
    """Per-arm sample for 80 % power at 5 %, equal arms."""
    z = fixed.Z_95 + fixed.Z_80_POWER
    return F.ceil(F.try_divide(F.lit(2.0 * z * z), effect * effect)).cast("long")


def power_audit(catalog: DataFrame, stats: DataFrame, target: float = 0.80) -> DataFrame:
    """Planned against needed and actual sample, and prospective against achieved power."""
    baseline = F.col("baseline_rate")
    goal = cohens_h(baseline, baseline * (F.lit(1.0) + F.col("mde_percent") / F.lit(100.0)))
    planned = F.col("sample_per_variant")
    c = F.coalesce("conversion_rate_control", F.lit(0.0))
    t = F.coalesce("conversion_rate_treatment", F.lit(0.0))
    seen = F.when((c > 0) & (t > 0), cohens_h(c, t)).otherwise(0.0)
    achieved = power_normal(seen, F.col("n_control"), F.col("n_treatment"))
    return (
        catalog.join(stats, "experiment_id", "left")
        .withColumn("_power", achieved)
        .select(
            "experiment_id",
            "experiment_name",
            "test_type",
            half_up(baseline, 4).alias("baseline_rate"),
            "mde_percent",
            planned.alias("planned_n"),
            required_n(goal).alias("required_n"),
            F.coalesce("n_control", F.lit(0)).alias("actual_n_control"),
            F.coalesce("n_treatment", F.lit(0)).alias("actual_n_treatment"),
            half_up(power_normal(goal, planned, planned), 4).alias("prospective_power"),
            half_up(c, 4).alias("observed_cr_control"),
            half_up(t, 4).alias("observed_cr_treatment"),
            half_up(F.coalesce(F.try_divide(t - c, c) * F.lit(100), F.lit(0.0)), 2).alias("observed_lift_pct"),
            half_up(F.col("_power"), 4).alias("achieved_power"),
            F.coalesce(F.col("_power") >= target, F.lit(False)).alias("adequate"),
            F.coalesce(F.col("_power") >= 0.99, F.lit(False)).alias("overpowered"),
        )
    )


def achieved_power(stats: DataFrame, catalog: DataFrame) -> DataFrame:
    """Power at the observed effect and the sample the planned (rates) or observed (means) effect needs.

    Rates by the normal, means by the noncentral t distribution.
    """
    means = F.col("test_type") == "t_test"
    c = F.col("conversion_rate_control")
    planned = cohens_h(c, c * (F.lit(1.0) + F.col("mde_percent") / F.lit(100.0)))
    arms = [F.col("n_control"), F.col("n_treatment")]
    power = F.when(means, power_of_t(F.col("cohens_d"), *arms)).otherwise(power_normal(F.col("cohens_h"), *arms))
    of_means = F.when(F.abs("cohens_d") > 0, F.abs("cohens_d")).otherwise(0.2)
    # the effect is null for rates, so the search is only made where it counts
    needed = F.when(means, sample_for_t(F.when(means, of_means))).otherwise(required_n(planned))
    extra = catalog.select("experiment_id", "mde_percent", "sample_per_variant", "test_type")
    return (
        stats.join(extra, "experiment_id")
        .withColumn("achieved_power", power)
        .withColumn("adequate_power", F.coalesce(F.col("achieved_power") >= 0.80, F.lit(False)))
        .withColumn("min_sample_for_80pct_power", needed)
    )


def correct(pvals: DataFrame, family: Sequence[str], method: str, p: str = "p_value", alpha: float = ALPHA) -> DataFrame:
    """Corrected p-values within each family (a family is one experiment's metrics, or all experiments).

    ``none``, ``bonferroni``, ``holm`` (step-down) or ``fdr_bh`` (step-up).
    """
    within = Window.partitionBy(*family)
    up, down = within.orderBy(F.col(p).asc(), "_tie"), within.orderBy(F.col(p).desc(), F.col("_tie").desc())
    m = F.count(F.lit(1)).over(within)
    tied = pvals.withColumn("_tie", F.struct(*[c for c in pvals.columns if c != p]))
    if method == "none":
        adjusted = F.col(p)
    elif method == "bonferroni":
        adjusted = F.col(p) * m
    elif method == "holm":
        tied = tied.withColumn("_q", (m - F.row_number().over(up) + 1) * F.col(p))
        adjusted = F.max("_q").over(up.rowsBetween(Window.unboundedPreceding, 0))
    elif method == "fdr_bh":
        tied = tied.withColumn("_q", F.col(p) * m / F.row_number().over(up))
        adjusted = F.min("_q").over(down.rowsBetween(Window.unboundedPreceding, 0))
    else:
        raise ValueError(f"unknown method {method}")
    capped = F.least(adjusted, F.lit(1.0))
    reject = capped < alpha if method == "none" else capped <= alpha
    return (
        tied.withColumn("corrected_p", capped)
        .withColumn("reject", reject)
        .withColumn("method", F.lit(method))
        .select(*pvals.columns, "method", "corrected_p", "reject")
    )


def compare_corrections(pvals: DataFrame, family: Sequence[str], p: str = "p_value") -> DataFrame:
    out = None
    for method in ("none", "bonferroni", "holm", "fdr_bh"):
        one = correct(pvals, family, method, p)
        out = one if out is None else out.unionByName(one)
    return out


@dataclass(frozen=True)
class Metric:
    name: str
    role: str
    column: str | None = None
    converters_only: bool = False
    direction: str = "two-sided"


# The standard metrics: a rate as primary, three secondary, one guardrail.
STANDARD_METRICS = (
    Metric("conversion_rate", "primary"),
    Metric("aov", "secondary", "order_total", True),
    Metric("items_per_order", "secondary", "item_count", True),
    Metric("revenue_per_user", "secondary", "order_total"),
    Metric("review_score", "guardrail", "review_score", False, "greater"),
)


def metric_tests(frame: DataFrame, metrics: Sequence[Metric] = STANDARD_METRICS) -> DataFrame:
    """One row per experiment and metric with both values, statistic and uncorrected p."""
    out = None
    for metric in metrics:
        if metric.column is None:
            tested = z_test(descriptives(frame, medians=False))
            # the reports test (control, treatment) in this order
            p = {"two-sided": "z_p_value", "greater": "z_p_greater", "less": "z_p_less"}[metric.direction]
            c, t, stat = "conversion_rate_control", "conversion_rate_treatment", "z_statistic"
        else:
            kept = frame.where("converted") if metric.converters_only else frame
            tested = mann_whitney(kept, metric.column, min_values=5)
            p = {"two-sided": "mw_p_value", "greater": "mw_p_greater", "less": "mw_p_less"}[metric.direction]
            c, t, stat = "mean_c", "mean_t", "u_statistic"
        # an untested metric (too few values) reports no difference
        tried = F.col(stat).isNotNull()
        diff = F.when(tried, F.col(t) - F.col(c)).otherwise(0.0)
        one = tested.select(
            "experiment_id",
            F.lit(metric.name).alias("metric"),
            F.lit(metric.role).alias("role"),
            F.coalesce(c, F.lit(0.0)).alias("control"),
            F.coalesce(t, F.lit(0.0)).alias("treatment"),
            F.coalesce(diff, F.lit(0.0)).alias("absolute_diff"),
            half_up(F.coalesce(F.try_divide(diff, F.col(c)) * F.lit(100), F.lit(0.0)), 2).alias("relative_diff_pct"),
            F.col(stat).alias("statistic"),
            F.coalesce(p, F.lit(1.0)).alias("p_value"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def hierarchical(tests: DataFrame, method: str = "holm", alpha: float = ALPHA) -> DataFrame:
    """Primary uncorrected; secondary corrected and only if the primary passed; guardrails always.

    A guardrail is triggered by a significant drop.
    """
    corrected = correct(tests, ["experiment_id", "role"], method)
    passed = F.min(F.when(F.col("role") == "primary", (F.col("p_value") < alpha).cast("int"))).over(
        Window.partitionBy("experiment_id")
    )
    gated = corrected.withColumn("primary_passed", F.coalesce(passed == 1, F.lit(False)))
    secondary = F.col("role") == "secondary"
    p = F.when(~secondary, F.col("p_value")).when(F.col("primary_passed"), F.col("corrected_p"))
    return (
        gated.withColumn("corrected_p", p)
        .withColumn("significant", F.coalesce(F.col("corrected_p") < alpha, F.lit(False)))
        .withColumn(
            "triggered",
            (F.col("role") == "guardrail") & F.col("significant") & (F.col("absolute_diff") < 0),
        )
        .drop("reject", "method")
    )


def hierarchical_decision(tested: DataFrame) -> DataFrame:
    """FAIL, BLOCKED, STRONG LAUNCH or LAUNCH per experiment."""
    flags = tested.groupBy("experiment_id").agg(
        F.bool_and("primary_passed").alias("primary_passed"),
        F.bool_or("triggered").alias("blocked"),
        F.bool_or((F.col("role") == "secondary") & F.col("significant")).alias("secondary"),
    )
    decision = (
        F.when(~F.col("primary_passed"), "FAIL")
        .when(F.col("blocked"), "BLOCKED")
        .when(F.col("secondary"), "STRONG LAUNCH")
        .otherwise("LAUNCH")
    )
    return flags.select(
        "experiment_id", "primary_passed", (~F.col("blocked")).alias("guardrail_ok"), decision.alias("decision")
    )


def impact(stats: DataFrame, monthly_traffic: int = 100_000) -> DataFrame:
    """Monthly and annual revenue of the effect, with its interval.

    Needs ``ci_rate`` columns (lifts of means for ``t_test`` experiments) and ``test_type``.
    """
    per_unit = F.when(F.col("test_type") == "t_test", 1.0).otherwise(half_up(F.col("revenue_mean_treatment"), 2))
    traffic = F.lit(float(monthly_traffic))
    monthly = traffic * F.col("absolute_lift") * per_unit
    return stats.select(
        "*",
        half_up(traffic * F.col("absolute_lift"), 0).alias("monthly_extra_conversions"),
        half_up(monthly, 2).alias("monthly_revenue_impact"),
        half_up(monthly * F.lit(12), 2).alias("annual_revenue_impact"),
        half_up(F.col("ci_lower") * traffic * per_unit * F.lit(12), 2).alias("ci_annual_lower"),
        half_up(F.col("ci_upper") * traffic * per_unit * F.lit(12), 2).alias("ci_annual_upper"),
    )


def decide(significant: Column, lift_pct: Column, positive: Column, adequate: Column, min_lift: float = 10.0) -> Column:
    return (
        F.when(significant & positive & (F.abs(lift_pct) >= min_lift), "LAUNCH")
        .when(significant & positive, "ITERATE")
        .when(~significant & ~adequate, "INCONCLUSIVE")
        .otherwise("ABANDON")
    )


def experiment_report(frame: DataFrame, catalog: DataFrame, alpha: float = ALPHA, round_rates: bool = True) -> DataFrame:
    """Everything about each experiment in one row: description, test, interval, effect, power, impact, decision.

    ``round_rates`` takes rates at four digits into interval and effect, as the
    published reports do.
    """
    stats = descriptives(frame)
    means = F.col("test_type") == "t_test"
    chosen = select_test(stats, catalog, assumptions(frame)).drop("normal_control", "normal_treatment")
    rate_ci = ci_rate(chi_square(z_test(fisher(chosen))), round_rates)
    t = welch(frame, "order_total").select(
        "experiment_id",
        "t_statistic",
        "t_p_value",
        "diff",
        F.try_divide(F.col("diff"), F.col("mean_c")).alias("diff_ratio"),
        F.col("ci_lower").alias("mean_ci_lower"),
        F.col("ci_upper").alias("mean_ci_upper"),
    )
    mw = mann_whitney(frame, "order_total").select("experiment_id", "u_statistic", "mw_p_value")
    joined = rate_ci.join(t, "experiment_id", "left").join(mw, "experiment_id", "left")

    def by_kind(for_means: Column, for_rates: Column) -> Column:
        return F.when(means, for_means).otherwise(for_rates)

    def of_test(z: str, exact: str, welch_t: str, ranks: str) -> Column:
        test = F.col("test_selected")
        return (
            F.when(test == "z_test", F.col(z))
            .when(test == "fisher", F.col(exact))
            .when(test == "welch_t", F.col(welch_t))
            .otherwise(F.col(ranks))
        )

    merged = joined.select(
        *stats.columns,
        "test_type",
        "test_selected",
        of_test("z_statistic", "odds_ratio", "t_statistic", "u_statistic").alias("statistic"),
        of_test("z_p_value", "fisher_p_value", "t_p_value", "mw_p_value").alias("p_value"),
        by_kind(half_up(F.col("diff"), 2), half_up(F.col("absolute_lift"), 4)).alias("absolute_lift"),
        half_up(by_kind(F.coalesce(F.col("diff_ratio") * F.lit(100), F.lit(0.0)), F.col("relative_lift_pct")), 2).alias(
            "relative_lift_pct"
        ),
        by_kind(half_up(F.col("mean_ci_lower"), 2), half_up(F.col("ci_lower"), 4)).alias("ci_lower"),
        by_kind(half_up(F.col("mean_ci_upper"), 2), half_up(F.col("ci_upper"), 4)).alias("ci_upper"),
    )
    sized = achieved_power(effect_size(merged, round_rates).drop("test_type"), catalog)
    full = impact(sized)
    significant = F.coalesce(F.col("p_value") < alpha, F.lit(False))
    return full.join(catalog.select("experiment_id", "experiment_name", "primary_metric"), "experiment_id").select(
        "experiment_id",
        "experiment_name",
        "primary_metric",
        "test_type",
        "test_selected",
        "n_control",
        "n_treatment",
        "conversions_control",
        "conversions_treatment",
        half_up(F.col("conversion_rate_control"), 4).alias("conversion_rate_control"),
        half_up(F.col("conversion_rate_treatment"), 4).alias("conversion_rate_treatment"),
        *[
            half_up(F.col(f"revenue_{m}_{name}"), 2).alias(f"revenue_{m}_{name}")
            for m in ("mean", "median", "std")
            for name, _ in ARMS
        ],
        "statistic",
        "p_value",
        significant.alias("significant"),
        "absolute_lift",
        "relative_lift_pct",
        "ci_lower",
        "ci_upper",
        half_up(F.when(means, F.col("cohens_d")).otherwise(F.col("cohens_h")), 4).alias("effect_size"),
        F.when(means, F.col("magnitude_d")).otherwise(F.col("magnitude_h")).alias("magnitude"),
        half_up(F.col("achieved_power"), 4).alias("achieved_power"),
        "adequate_power",
        F.col("sample_per_variant").alias("planned_sample_per_variant"),
        "min_sample_for_80pct_power",
        "monthly_extra_conversions",
        "monthly_revenue_impact",
        "annual_revenue_impact",
        "ci_annual_lower",
        "ci_annual_upper",
        decide(significant, F.col("relative_lift_pct"), F.col("absolute_lift") > 0, F.col("adequate_power")).alias(
            "decision"
        ),
    )


def report_summary(report: DataFrame) -> DataFrame:
    """The summary table the comparison view joins: p-value, significance, decision, monthly impact."""
    return report.select(
        "experiment_id",
        "experiment_name",
        "p_value",
        F.when(F.col("p_value") < ALPHA, "Yes").otherwise("No").alias("significant"),
        F.col("decision").alias("recommendation"),
        half_up(F.coalesce("monthly_revenue_impact", F.lit(0.0)), 2).alias("revenue_impact_monthly"),
    )


def srm(counts: DataFrame) -> DataFrame:
    """Sample-ratio mismatch: chi-square of the arm counts against an even split."""
    n_c, n_t = F.col("n_control").cast("double"), F.col("n_treatment").cast("double")
    stat = F.try_divide((n_c - n_t) * (n_c - n_t), n_c + n_t)
    return (
        counts.withColumn("srm_statistic", stat)
        .withColumn("srm_p_value", p_chi_square_1(F.col("srm_statistic")))
        .withColumn("mismatch", F.col("srm_p_value") < 0.01)
    )


def independence(pairs: DataFrame) -> DataFrame:
    """Chi-square of the arms of two experiments; independent assignment gives p above 5 %."""
    return (
        pairs.withColumn("chi2_statistic", chi2_2x2(F.col("n00"), F.col("n01"), F.col("n10"), F.col("n11")))
        .withColumn("chi2_p_value", p_chi_square_1(F.col("chi2_statistic")))
        .withColumn("independent", F.col("chi2_p_value") > ALPHA)
    )
