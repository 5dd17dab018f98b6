import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from agorakit.functions import fixed, half_up
from agorakit.operators import bayes, experiments, stats
from agorakit.sources import adapters

# experiment, n and conversions per arm, p, lift %, interval, decision: recorded results of rate experiments.
RECORDED = [
    ("exp_001", 49782, 5981, 49659, 6679, 1.124369e-11, 11.99, 0.0103, 0.0185, "LAUNCH"),
    ("exp_002", 49741, 4017, 49700, 4622, 7.289899e-12, 15.1, 0.0087, 0.0157, "LAUNCH"),
    ("exp_003", 49700, 7437, 49741, 7885, 1.046230e-04, 5.95, 0.0044, 0.0134, "ITERATE"),
    ("exp_004", 49349, 10831, 50092, 13175, 6.603045e-58, 19.82, 0.0382, 0.0488, "LAUNCH"),
    ("exp_005", 49732, 4912, 49709, 5534, 1.060855e-10, 12.65, 0.0087, 0.0163, "LAUNCH"),
    ("exp_006", 49853, 7078, 49588, 7555, 3.856515e-06, 7.32, 0.006, 0.0148, "ITERATE"),
    ("exp_007", 49757, 5442, 49684, 5992, 2.841550e-08, 10.24, 0.0072, 0.0152, "LAUNCH"),
    ("exp_009", 49673, 4437, 49768, 5116, 5.650147e-13, 15.12, 0.0098, 0.0172, "LAUNCH"),
]


def counts(spark, rows):
    df = spark.createDataFrame(
        rows,
        "experiment_id string, n_control long, conversions_control long, n_treatment long, conversions_treatment long",
    )
    return df.withColumns({f"conversion_rate_{v}": F.col(f"conversions_{v}") / F.col(f"n_{v}") for v in fixed.VARIANTS})


def test_recorded_results(spark):
    s = stats.ci_rate(stats.z_test(counts(spark, [r[:5] for r in RECORDED])), round_rates=True)
    s = s.withColumn(
        "decision",
        stats.decide(F.col("z_p_value") < 0.05, half_up(F.col("relative_lift_pct"), 2), F.col("absolute_lift") > 0, F.lit(True)),
    )
    got = {r.experiment_id: r for r in s.collect()}
    for name, *_, p, lift, low, high, decision in RECORDED:
        r = got[name]
        assert math.isclose(r.z_p_value, p, rel_tol=1e-6)
        assert abs(r.relative_lift_pct - lift) < 0.0051
        assert abs(r.ci_lower - low) < 5.1e-5 and abs(r.ci_upper - high) < 5.1e-5
        assert r.decision == decision


def test_one_sided_and_chi_square(spark):
    r = stats.chi_square(stats.z_test(counts(spark, [("e", 100, 30, 120, 20)]))).collect()[0]
    assert r.z_statistic > 0 and math.isclose(r.z_p_greater + r.z_p_less, 1.0)
    assert math.isclose(r.z_p_value, 2 * r.z_p_greater)
    a, b, c, d = 30, 70, 20, 100
    n = a + b + c + d
    chi = n * (abs(a * d - b * c) - n / 2) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d))
    assert math.isclose(r.chi2_statistic, chi) and math.isclose(r.chi2_p_value, math.erfc(math.sqrt(chi / 2)))


def test_fisher(spark):
    r = stats.fisher(counts(spark, [("e", 10, 8, 6, 1)])).collect()[0]
    assert math.isclose(r.odds_ratio, 20.0) and math.isclose(r.fisher_p_value, 0.03496503496503495)


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(11)
    data = []
    for e in ("exp_001", "exp_008"):
        for i in range(600):
            v = "control" if rng.random() < 0.5 else "treatment"
            yes = rng.random() < (0.3 if v == "control" else 0.5)
            value = float(rng.randrange(1, 60)) if yes else 0.0
            score = float(rng.randrange(1, 6)) if yes and rng.random() < 0.8 else None
            data.append((e, f"c{i}", "SP", v, yes, value, rng.randrange(1, 5) if yes else 0, score))
    df = spark.createDataFrame(
        data,
        "experiment_id string, customer_id string, customer_state string, variant string, converted boolean, "
        "order_total double, item_count long, review_score double",
    ).cache()
    return df, data


def arms(data, e, column, keep=lambda r: True):
    pick = {"order_total": 5, "item_count": 6, "review_score": 7}[column]
    return [
        np.array([r[pick] for r in data if r[0] == e and r[3] == v and r[pick] is not None and keep(r)], dtype=float)
        for v in fixed.VARIANTS
    ]


def brute_mann_whitney(c, t):
    both = np.concatenate([c, t])
    order = np.array([(both < x).sum() + ((both == x).sum() + 1) / 2 for x in c])
    u = order.sum() - len(c) * (len(c) + 1) / 2
    n = len(both)
    _, k = np.unique(both, return_counts=True)
    sd = math.sqrt(len(c) * len(t) / 12 * (n + 1 - (k**3 - k).sum() / (n * (n - 1))))
    z = (max(u, len(c) * len(t) - u) - len(c) * len(t) / 2 - 0.5) / sd
    return u, math.erfc(z / math.sqrt(2))


@pytest.mark.parametrize("column", ["order_total", "item_count", "review_score"])
def test_mann_whitney(frame, column):
    df, data = frame
    for r in stats.mann_whitney(df, column).collect():
        u, p = brute_mann_whitney(*arms(data, r.experiment_id, column))
        assert r.u_statistic == u and math.isclose(r.mw_p_value, min(1.0, p), rel_tol=1e-9)


def test_mann_whitney_with_an_empty_arm(spark):
    df = spark.createDataFrame([("e", "control", 1.0), ("e", "control", 2.0)], "experiment_id string, variant string, x double")
    r = stats.mann_whitney(df, "x", 5).collect()[0]
    assert r.u_statistic is None and r.mw_p_value == 1.0


def test_mann_whitney_of_small_samples_is_exact(spark):
    import itertools

    c, t = [1.5, 3.0, 9.0, 10.0, 12.0], [2.0, 4.0, 5.0, 6.0, 7.0, 8.0, 11.0]
    both = sorted(c + t)

    def u_of(values):
        return sum(v > w for v in values for w in both if w not in values)

    seen = u_of(c)
    all_u = [u_of(pick) for pick in itertools.combinations(both, len(c))]
    top = max(seen, len(c) * len(t) - seen)
    rows = [("e", "control", v) for v in c] + [("e", "treatment", v) for v in t]
    r = stats.mann_whitney(spark.createDataFrame(rows, "experiment_id string, variant string, x double"), "x", 5).collect()[0]
    assert r.u_statistic == seen
    assert math.isclose(r.mw_p_value, min(1.0, 2 * sum(u >= top for u in all_u) / len(all_u)))
    assert math.isclose(r.mw_p_greater, sum(u >= seen for u in all_u) / len(all_u))
    assert math.isclose(r.mw_p_less, sum(u <= seen for u in all_u) / len(all_u))


def test_mann_whitney_is_exact_whatever_the_larger_arm(spark):
    from agorakit.functions.tails import mann_whitney_upper

    def ways(m, n):
        # ways[u] by adding the arms' values in order: the largest is of the small arm (and beats n) or of the large one
        table = {(0, j): [1] for j in range(n + 1)}
        for i in range(1, m + 1):
            table[i, 0] = [1]
            for j in range(1, n + 1):
                a, b = [0] * j + table[i - 1, j], table[i, j - 1]
                long = max(len(a), len(b))
                table[i, j] = [x + y for x, y in zip(a + [0] * (long - len(a)), b + [0] * (long - len(b)))]
        return table[m, n]

    for m, n in ((1, 5), (2, 9), (5, 7), (8, 8), (8, 40)):
        count = ways(m, n)
        for u in range(m * n + 2):
            assert mann_whitney_upper(u, m, n) == sum(count[u:]) / sum(count)
    # all of the small arm above 100,000 others: one way of all
    assert mann_whitney_upper(8 * 100_000, 8, 100_000) == 1 / math.comb(100_008, 8)
    rows = [("e", "treatment", float(v)) for v in range(2501)] + [("e", "control", 3000.0 + v) for v in range(8)]
    r = stats.mann_whitney(spark.createDataFrame(rows, "experiment_id string, variant string, x double"), "x", 5).collect()[0]
    assert math.isclose(r.mw_p_value, 2 / math.comb(2509, 8), rel_tol=1e-9)


def test_welch_levene_and_descriptives(frame):
    df, data = frame
    d = {r.experiment_id: r for r in stats.descriptives(df).collect()}
    levene = {r.experiment_id: r for r in stats.assumptions(df).collect()}
    for r in stats.welch(df, "order_total").collect():
        c, t = arms(data, r.experiment_id, "order_total")
        v = c.var(ddof=1) / len(c) + t.var(ddof=1) / len(t)
        assert math.isclose(r.t_statistic, (c.mean() - t.mean()) / math.sqrt(v), rel_tol=1e-9)
        assert r.ci_lower < t.mean() - c.mean() < r.ci_upper and 0 < r.t_p_value < 1
        row = d[r.experiment_id]
        assert row.revenue_median_control == np.median(c) and math.isclose(row.revenue_std_treatment, t.std(ddof=1))
        z = [abs(a - np.median(a)) for a in (c, t)]
        g = np.concatenate(z).mean()
        w = (len(c) + len(t) - 2) * sum(len(a) * (a.mean() - g) ** 2 for a in z) / sum(((a - a.mean()) ** 2).sum() for a in z)
        assert math.isclose(levene[r.experiment_id].levene_statistic, w, rel_tol=1e-9)


def brute_corrections(p):
    m = len(p)
    order = sorted(range(m), key=lambda i: p[i])
    holm, bh, top, low = [0.0] * m, [0.0] * m, 0.0, 1.0
    for rank, i in enumerate(order):
        top = max(top, (m - rank) * p[i])
        holm[i] = min(1.0, top)
    for rank in range(m - 1, -1, -1):
        low = min(low, p[order[rank]] * m / (rank + 1))
        bh[order[rank]] = low
    return {"none": p, "bonferroni": [min(1.0, x * m) for x in p], "holm": holm, "fdr_bh": bh}


def test_corrections_with_ties(spark):
    p = [0.01, 0.04, 0.03, 0.03, 0.5, 0.9, 0.001]
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(p)], "family string, i int, p_value double")
    want = brute_corrections(p)
    for r in stats.compare_corrections(df, ["family"]).collect():
        assert math.isclose(r.corrected_p, want[r.method][r.i])
        assert r.corrected_p >= r.p_value
        assert r.reject == (r.corrected_p < 0.05 if r.method == "none" else r.corrected_p <= 0.05)


def test_hierarchy(spark):
    rows = [
        ("fail", "m1", "primary", 0.5, 0.1),
        ("fail", "m2", "secondary", 0.001, 0.1),
        ("blocked", "m1", "primary", 0.01, 0.1),
        ("blocked", "g", "guardrail", 0.01, -0.1),
        ("strong", "m1", "primary", 0.01, 0.1),
        ("strong", "m2", "secondary", 0.02, 0.1),
        ("strong", "m3", "secondary", 0.9, 0.1),
        ("strong", "g", "guardrail", 0.01, 0.1),
        ("launch", "m1", "primary", 0.01, 0.1),
        ("launch", "m2", "secondary", 0.04, 0.1),
        ("launch", "m3", "secondary", 0.9, 0.1),
    ]
    df = spark.createDataFrame(rows, "experiment_id string, metric string, role string, p_value double, absolute_diff double")
    tested = stats.hierarchical(df)
    got = {r.experiment_id: r.decision for r in stats.hierarchical_decision(tested).collect()}
    assert got == {"fail": "FAIL", "blocked": "BLOCKED", "strong": "STRONG LAUNCH", "launch": "LAUNCH"}
    gate = {(r.experiment_id, r.metric): r.corrected_p for r in tested.collect()}
    assert gate["fail", "m2"] is None and math.isclose(gate["strong", "m2"], 0.04)


def test_power_and_sample_size(spark):
    s = counts(spark, [("exp_001", 49782, 5981, 49659, 6679)])
    r = stats.power_audit(adapters.experiment_catalog(spark), s).where("experiment_id = 'exp_001'").collect()[0]
    assert r.achieved_power > 0.999 and r.adequate and r.overpowered and r.actual_n_control == 49782
    # n per arm for 12 % against 13.2 % at 80 % power
    h = 2 * (math.asin(math.sqrt(0.132)) - math.asin(math.sqrt(0.12)))
    assert r.required_n == math.ceil(2 * ((fixed.Z_95 + fixed.Z_80_POWER) / h) ** 2)
    at_planned = spark.range(1).select(stats.power_normal(F.lit(h), F.lit(r.required_n), F.lit(r.required_n))).collect()[0][0]
    assert abs(at_planned - 0.80) < 1e-3


def test_report_has_one_row_per_experiment(frame, spark):
    df, data = frame
    report = {r.experiment_id: r for r in stats.experiment_report(df, adapters.experiment_catalog(spark)).collect()}
    assert set(report) == {"exp_001", "exp_008"}
    assert report["exp_001"].test_selected == "z_test" and report["exp_008"].test_selected == "mann_whitney"
    assert report["exp_001"].decision == "LAUNCH"
    _, p = brute_mann_whitney(*arms(data, "exp_008", "order_total"))
    assert math.isclose(report["exp_008"].p_value, p, rel_tol=1e-9)
    summary = {r.experiment_id: r for r in stats.report_summary(stats.experiment_report(df, adapters.experiment_catalog(spark))).collect()}
    assert summary["exp_001"].significant == "Yes" and summary["exp_001"].recommendation == "LAUNCH"


def test_metric_tests_cover_all_metrics(frame):
    df, _ = frame
    rows = stats.metric_tests(df).collect()
    assert len(rows) == 10 and {r.metric for r in rows} == {m.name for m in stats.STANDARD_METRICS}


def test_bayes(spark):
    s = counts(spark, [("better", 5000, 500, 5000, 650), ("same", 5000, 500, 5000, 500)])
    first = {r.experiment_id: r for r in bayes.bayes_rate(s).collect()}
    again = {r.experiment_id: r for r in bayes.bayes_rate(s.repartition(3)).collect()}
    assert first == again
    b = first["better"]
    assert b.prob_treatment_better > 0.999 and abs(b.lift_mean - 0.03) < 5e-4 and b.lift_ci_low < 0.03 < b.lift_ci_high
    assert 0.4 < first["same"].prob_treatment_better < 0.6
    decided = {r.experiment_id: r.decision for r in bayes.bayes_decide(bayes.bayes_rate(s)).collect()}
    assert decided == {"better": "LAUNCH TREATMENT", "same": "CONTINUE TESTING"}
    zones = {r.experiment_id: r for r in bayes.rope(bayes.bayes_rate(s)).collect()}
    assert zones["better"].conclusion == "Treatment better"
    assert abs(sum(zones["same"][c] for c in ("prob_below_rope", "prob_inside_rope", "prob_above_rope")) - 1) < 2e-4
    priors = bayes.prior_sensitivity(s).collect()
    assert len(priors) == 8 and {r.prior_mean for r in priors} == {0.5, 0.1}


def test_shapiro_wilk_values():
    from agorakit.functions.tails import shapiro_weights, shapiro_wilk

    # published results
    men = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    w, p = shapiro_wilk(men)
    assert (round(w, 5), round(p, 6)) == (0.78881, 0.006704)
    mpg = "21 21 22.8 21.4 18.7 18.1 14.3 24.4 22.8 19.2 17.8 16.4 17.3 15.2 10.4 10.4 14.7 32.4 30.4 33.9 21.5 15.5 15.2 13.3 19.2 27.3 26 30.4 15.8 19.7 15 21.4"
    w, p = shapiro_wilk([float(x) for x in mpg.split()])
    assert (round(w, 5), round(p, 4)) == (0.94756, 0.1229)
    assert shapiro_wilk([5.0] * 9) == (1.0, 1.0) and math.isnan(shapiro_wilk([1.0, 2.0])[0])
    assert shapiro_wilk([1.0, 2.0, 3.0]) == (pytest.approx(1.0), pytest.approx(1.0))
    for n in (3, 4, 5, 6, 11, 12, 500):
        a = shapiro_weights(n)
        assert a @ a == pytest.approx(1.0) and a.sum() == pytest.approx(0.0, abs=1e-12)
    rng = np.random.default_rng(2)
    found = [shapiro_wilk(rng.normal(5, 2, 100))[1] for _ in range(400)]
    assert 0.02 < np.mean(np.array(found) < 0.05) < 0.09  # holds its level
    assert shapiro_wilk(rng.exponential(1, 300))[1] < 1e-10


def test_keyed_sample_is_bounded_and_repeatable(spark):
    rows = spark.range(5000).selectExpr("'a' AS g", "id", "id * 1.5 AS x").union(spark.range(3).selectExpr("'b'", "id", "1.0"))
    pick = lambda df: sorted(tuple(r) for r in stats.keyed_sample(df, ["g"], F.sha2(F.col("id").cast("string"), 256), 40).collect())
    first = pick(rows)
    assert first == pick(rows.repartition(7)) and len(first) == 43
    order = sorted(range(5000), key=lambda i: hashlib.sha256(str(i).encode()).hexdigest())[:40]
    assert [r[1] for r in first if r[0] == "a"] == sorted(order)


def test_normality_of_arms(spark):
    rng = random.Random(5)
    rows = [("even", f"c{i}", v, rng.gauss(100, 9)) for i in range(300) for v in fixed.VARIANTS]
    rows += [("odd", f"c{i}", v, rng.expovariate(1) if v == "treatment" else rng.gauss(0, 1)) for i in range(300) for v in fixed.VARIANTS]
    rows += [("few", f"c{i}", v, float(i)) for i in range(5) for v in fixed.VARIANTS]
    df = spark.createDataFrame(rows, "experiment_id string, customer_id string, variant string, order_total double")
    got = {r.experiment_id: r for r in stats.assumptions(df).collect()}
    assert (got["even"].normal_control, got["even"].normal_treatment) == (True, True)
    assert (got["odd"].normal_control, got["odd"].normal_treatment) == (True, False)
    assert got["few"].normal_control is None and got["few"].levene_p is None and got["few"].n_control == 5


def test_power_of_the_t_test():
    """Against the integral of the power over the estimated variance, and recorded values."""
    import numpy as np

    from agorakit.functions.tails import power_t, sample_t, t_quantile

    def integrated(d, n1, n2):
        """Given the pooled deviation s, the difference is normal; s * s is chi-square."""
        df, shift = n1 + n2 - 2, d * math.sqrt(n1 * n2 / (n1 + n2))
        crit = t_quantile(0.975, df)
        u = np.linspace(1e-9, df + 14 * math.sqrt(2 * df) + 40, 200_001)
        mid, width = (u[1:] + u[:-1]) / 2, u[1] - u[0]
        density = np.exp((df / 2 - 1) * np.log(mid) - mid / 2 - df / 2 * math.log(2) - math.lgamma(df / 2))
        edge = crit * np.sqrt(mid / df)
        tail = np.array([0.5 * math.erfc((x - shift) / math.sqrt(2)) + 0.5 * math.erfc((x + shift) / math.sqrt(2)) for x in edge[::20]])
        return float((np.interp(mid, mid[::20], tail) * density).sum() * width)

    for d, n1, n2 in ((0.5, 64, 64), (0.2, 50, 400), (-0.8, 10, 12), (1.5, 4, 4), (0.05, 3000, 2500), (0.0, 30, 30)):
        assert power_t(d, n1, n2) == pytest.approx(integrated(d, n1, n2), abs=2e-6)
    # textbook sample sizes for 80 % at 5 %
    assert [sample_t(d) for d in (0.2, 0.5, 0.8, 1.0)] == [394.0, 64.0, 26.0, 17.0]
    assert power_t(0.5, 64, 64) == pytest.approx(0.8014596, abs=1e-6)
    assert power_t(0.001, 6e8, 6e8) == pytest.approx(1.0) and power_t(3.0, 5000, 5000) == 1.0
    assert math.isnan(power_t(0.5, 1, 1)) and math.isnan(sample_t(0.0)) and math.isnan(power_t(float("nan"), 5, 5))
    # continuous across the change to Stirling's series
    assert power_t(0.01, 9999, 10001) == pytest.approx(power_t(0.01, 10001, 10003), abs=1e-4)


def test_quadrature_of_betas():
    """Against exact values: symmetry, a closed form for whole parameters, and moments."""

    def exactly(a1, b1, a2, b2):
        """P(second > first) as a finite sum, for whole a2."""
        lbeta = lambda a, b: math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)
        return sum(math.exp(lbeta(a1 + i, b1 + b2) - math.log(b2 + i) - lbeta(1 + i, b2) - lbeta(a1, b1)) for i in range(a2))

    for c, t in (((5, 7), (6, 9)), ((1, 1), (1, 1)), ((501, 4501), (560, 4442)), ((1, 50), (4, 47)), ((2000, 18000), (11, 80))):
        got = dict(zip(bayes._COMPARED, bayes.compare_betas(*map(float, c + t), (-0.01, 0.01))))
        assert got["prob_treatment_better"] == pytest.approx(exactly(*c, *t), abs=2e-6)
        assert got["control_mean"] == c[0] / sum(c)
        # mean of the difference is the gain less the loss
        assert got["expected_loss_control"] - got["expected_loss_treatment"] == pytest.approx(got["lift_mean"], abs=1e-6)
        assert got["below_rope"] + got["inside_rope"] + got["above_rope"] == pytest.approx(1)
        back = dict(zip(bayes._COMPARED, bayes.compare_betas(*map(float, t + c), (-0.01, 0.01))))
        assert back["prob_treatment_better"] == pytest.approx(1 - got["prob_treatment_better"], abs=1e-9)
        assert back["below_rope"] == pytest.approx(got["above_rope"], abs=1e-9)
    uniform = dict(zip(bayes._COMPARED, bayes.compare_betas(1.0, 1.0, 1.0, 1.0, (-0.5, 0.5))))
    assert uniform["control_ci_low"] == pytest.approx(0.025) and uniform["treatment_ci_high"] == pytest.approx(0.975)
    assert uniform["expected_loss_control"] == pytest.approx(1 / 6, abs=1e-5) and uniform["inside_rope"] == pytest.approx(0.75, abs=1e-4)
    # far more users in one arm than the other: a finer grid, by Fourier transform
    wide = bayes.compare_betas(3.0, 40.0, 200_001.0, 1_800_001.0, (-0.005, 0.005))
    assert wide[0] == pytest.approx(1 - exactly(200_001, 1_800_001, 3, 40), abs=1e-5)


def test_normal_posterior(spark):
    m = spark.createDataFrame(
        [("a", 100, 10.0, 25.0, 100, 11.0, 25.0), ("flat", 5, 3.0, 0.0, 5, 4.0, 0.0), ("few", 1, 1.0, 1.0, 9, 1.0, 1.0)],
        "experiment_id string, n_c long, mean_c double, var_c double, n_t long, mean_t double, var_t double",
    )
    got = {r.experiment_id: r for r in bayes.bayes_mean(m).collect()}
    assert set(got) == {"a", "flat"}
    a, s = got["a"], math.sqrt(0.5)
    assert a.prob_treatment_better == pytest.approx(0.5 * math.erfc(-1 / s / math.sqrt(2)))
    assert a.lift_ci_high == pytest.approx(1 + 1.959963984540054 * s) and a.control_ci_low == pytest.approx(10 - 1.959963984540054 * 0.5)
    assert a.expected_loss_control - a.expected_loss_treatment == pytest.approx(1.0)
    flat = got["flat"]
    assert (flat.prob_treatment_better, flat.expected_loss_control, flat.expected_loss_treatment, flat.above_rope) == (1.0, 1.0, 0.0, 1.0)


def test_sequential_ends_with_all_data(frame):
    df, data = frame
    rows = [r for r in bayes.sequential(df, steps=5).collect() if r.experiment_id == "exp_001"]
    rows.sort(key=lambda r: r.step)
    assert [r.fraction for r in rows] == [0.2, 0.4, 0.6, 0.8, 1.0]
    assert rows[-1].n_control + rows[-1].n_treatment == 600
    assert all(a.n_control <= b.n_control for a, b in zip(rows, rows[1:]))


def test_srm_and_independence(spark):
    c = spark.createDataFrame([("even", 500, 500), ("skewed", 600, 400)], "experiment_id string, n_control long, n_treatment long")
    got = {r.experiment_id: r.mismatch for r in stats.srm(c).collect()}
    assert got == {"even": False, "skewed": True}
    people = [(f"c{i}", e, "control" if (i if e == "a" else i // 2) % 2 else "treatment") for i in range(400) for e in "ab"]
    people += [(f"c{i}", "c", "control" if i % 2 else "treatment") for i in range(400)]
    df = spark.createDataFrame(people, "customer_id string, experiment_id string, variant string")
    pairs = {(r.experiment_a, r.experiment_b): r.independent for r in stats.independence(experiments.arm_pairs(df, ["a", "b", "c"])).collect()}
    assert pairs == {("a", "b"): True, ("a", "c"): False, ("b", "c"): True}


def test_tails_of_large_samples():
    import time

    from agorakit.functions.tails import fisher_two_sided, t_two_sided

    start = time.perf_counter()
    n, x = 10**10, 10**9
    p = fisher_two_sided(x, n - x, x + 60_000, n - x - 60_000)
    assert time.perf_counter() - start < 1
    rate = (2 * x + 60_000) / (2 * n)
    z = 60_000 / n / math.sqrt(rate * (1 - rate) * 2 / n)
    assert p == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-2)
    assert fisher_two_sided(3, 1, 1, 3) == pytest.approx(0.4857142857)
    assert fisher_two_sided(10**9, 0, 0, 10**9) == 0.0 and fisher_two_sided(0, 0, 0, 0) == 1.0
    assert t_two_sided(2.0, 1e12) == pytest.approx(math.erfc(2 / math.sqrt(2)), rel=1e-6)
