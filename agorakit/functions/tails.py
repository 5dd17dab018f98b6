"""Tail probabilities and quantiles Spark has no built-in for.

They are applied to a handful of rows per experiment (never to raw events), as
Arrow-batched pandas UDFs over ``math.erfc`` and the continued fraction of the
incomplete beta function (Abramowitz & Stegun 26.5.8).
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StructField, StructType


# The functions travel to the executors with the query; nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _betainc(a: float, b: float, x: float, y: float | None = None) -> float:
    """Regularised incomplete beta by Lentz's continued fraction; ``y`` is 1 - x, given where x is close to 1.

    The fraction needs about as many steps as the square root of the larger parameter.
    """
    y = 1.0 - x if y is None else y
    if x <= 0.0:
        return 0.0
    if y <= 0.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - _betainc(b, a, y, x)
    log_x = math.log(x) if x < 0.5 else math.log1p(-y)
    log_y = math.log(y) if y < 0.5 else math.log1p(-x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * log_x + b * log_y) / a
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    frac = d
    for m in range(1, 500 + int(10 * math.sqrt(max(a, b)))):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            frac *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return min(1.0, front * frac)


def t_two_sided(t: float, df: float) -> float:
    if math.isnan(t) or math.isnan(df) or df <= 0:
        return float("nan")
    if df > 1e8:  # the normal tail is within 1e-8 there, and the gamma functions lose more digits
        return math.erfc(abs(t) / math.sqrt(2.0))
    total = df + t * t
    return _betainc(df / 2.0, 0.5, df / total, t * t / total)


def f_upper(f: float, d1: float, d2: float) -> float:
    if math.isnan(f) or d1 <= 0 or d2 <= 0:
        return float("nan")
    if f <= 0:
        return 1.0
    total = d2 + d1 * f
    return _betainc(d2 / 2.0, d1 / 2.0, d2 / total, d1 * f / total)


def t_quantile(p: float, df: float) -> float:
    """Upper quantile by bisection on the two-sided tail."""
    if math.isnan(df) or df <= 0:
        return float("nan")
    target, lo, hi = 2.0 * (1.0 - p), 0.0, 1.0
    while t_two_sided(hi, df) > target:
        hi *= 2.0
    for _ in range(200):
        mid = (lo + hi) / 2.0
        lo, hi = (mid, hi) if t_two_sided(mid, df) > target else (lo, mid)
    return (lo + hi) / 2.0


def _log_rising(b: float, a: float) -> float:
    """log(gamma(b + a) / gamma(b)); for a large b by Stirling's series, where the two gammas would cancel."""
    if b < 1e4:
        return math.lgamma(b + a) - math.lgamma(b)
    return (b + a - 0.5) * math.log1p(a / b) + a * math.log(b) - a + (1.0 / (b + a) - 1.0 / b) / 12.0


def power_t(effect: float, n1: float, n2: float, alpha: float = 0.05) -> float:
    """Power of the two-sided two-sample t-test for a standardised effect, from the noncentral t distribution.

    The square of a noncentral t is a Poisson mixture of beta variables: P(|T| < c) is the sum over j of
    Poisson(j; d^2 / 2) I_x(j + 1/2, df / 2) with x = c^2 / (c^2 + df). The incomplete betas follow from the last one by a recurrence
    that only adds, and the sum runs over the Poisson weights within 12 standard deviations.
    """
    df = n1 + n2 - 2.0
    if any(math.isnan(v) for v in (effect, n1, n2)) or df <= 0 or n1 <= 0 or n2 <= 0:
        return float("nan")
    crit = t_quantile(1.0 - alpha / 2.0, df)
    half = effect * effect * n1 * n2 / (n1 + n2) / 2.0
    if half == 0.0:
        return alpha
    if df > 1e8:
        shift = math.sqrt(2.0 * half)
        return 0.5 * math.erfc((crit - shift) / math.sqrt(2.0)) + 0.5 * math.erfc((crit + shift) / math.sqrt(2.0))
    b, total = df / 2.0, df + crit * crit
    log_x, log_y = math.log(crit * crit / total), -math.log1p(crit * crit / df)
    reach = 12.0 * math.sqrt(half) + 40.0
    low, high = max(0, int(half - reach)), int(half + reach)
    below = _betainc(high + 0.5, b, crit * crit / total, df / total)
    inside = 0.0
    for j in range(high, low - 1, -1):
        a = j + 0.5
        if j < high:  # I_x(a, b) = I_x(a + 1, b) + x^a y^b / (a B(a, b))
            below += math.exp(a * log_x + b * log_y + _log_rising(b, a) - math.lgamma(a + 1.0))
        inside += math.exp(j * math.log(half) - half - math.lgamma(j + 1.0)) * min(1.0, below)
    return min(1.0, max(0.0, 1.0 - inside))


def sample_t(effect: float, power: float = 0.80, alpha: float = 0.05) -> float:
    """The smallest arm, of two equal ones, with which the t-test reaches ``power``; not a number without an effect."""
    if math.isnan(effect) or effect == 0.0:
        return float("nan")
    low, high = 1, 2
    while power_t(effect, high, high, alpha) < power:
        low, high = high, high * 2
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if power_t(effect, mid, mid, alpha) < power else (low, mid)
    return float(high)


# Coefficients of the approximations of Royston (1995, algorithm AS R94), by rising power.
SW_LAST = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
SW_NEXT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
SW_SMALL_GAMMA = (-2.273, 0.459)
SW_SMALL_MEAN = (0.5440, -0.39978, 0.025054, -0.0006714)
SW_SMALL_LOG_SD = (1.3822, -0.77857, 0.062767, -0.0020322)
SW_MEAN = (-1.5861, -0.31082, -0.083751, 0.0038915)
SW_LOG_SD = (-0.4803, -0.082676, 0.0030302)


def _polynomial(coefficients: tuple[float, ...], x: float) -> float:
    return sum(c * x**k for k, c in enumerate(coefficients))


def shapiro_weights(n: int) -> np.ndarray:
    """Weights of the ordered values in W: normal scores, the outer ones corrected."""
    from statistics import NormalDist

    if n == 3:
        return np.array([-math.sqrt(0.5), 0.0, math.sqrt(0.5)])
    m = np.array([NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    square, u = float(m @ m), 1.0 / math.sqrt(n)
    last = m[-1] / math.sqrt(square) + _polynomial(SW_LAST, u)
    outer = [last] if n <= 5 else [last, m[-2] / math.sqrt(square) + _polynomial(SW_NEXT, u)]
    k = len(outer)
    scale = math.sqrt((square - 2 * float(m[-k:] @ m[-k:])) / (1 - 2 * sum(w * w for w in outer)))
    weights = m / scale
    for i, w in enumerate(outer):
        weights[-1 - i], weights[i] = w, -w
    return weights


def shapiro_wilk(values: np.ndarray) -> tuple[float, float]:
    """W and its p-value for 3 to 5000 values; equal values give 1, fewer than 3 not a number."""
    x = np.sort(np.asarray(values, dtype=float))
    n = len(x)
    if n < 3:
        return float("nan"), float("nan")
    if x[0] == x[-1]:
        return 1.0, 1.0
    away = x - x.mean()
    w = min(1.0, float(shapiro_weights(n) @ x) ** 2 / float(away @ away))
    if n == 3:
        return w, max(0.0, 6.0 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    if w == 1.0:
        return w, 1.0
    y = math.log(1.0 - w)
    if n <= 11:
        gamma = _polynomial(SW_SMALL_GAMMA, n)
        if y >= gamma:
            return w, 0.0
        y, mean, sd = -math.log(gamma - y), _polynomial(SW_SMALL_MEAN, n), math.exp(_polynomial(SW_SMALL_LOG_SD, n))
    else:
        mean, sd = _polynomial(SW_MEAN, math.log(n)), math.exp(_polynomial(SW_LOG_SD, math.log(n)))
    return w, 0.5 * math.erfc((y - mean) / sd / math.sqrt(2.0))


def fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    """Sum of the hypergeometric probabilities not above the observed one.

    Only tables within 40 standard deviations of the likeliest count (what lies beyond is below the
    smallest double), so the work grows with the square root of the table.
    """
    row, col, n = a + b, a + c, a + b + c + d
    if n == 0:
        return 1.0
    lo, hi = max(0, col - (n - row)), min(row, col)
    mode = min(max((row + 1) * (col + 1) // (n + 2), lo), hi)
    spread = math.sqrt(row / n * (n - row) * col / n * (n - col) / max(n - 1, 1))
    reach = int(40 * spread) + 60
    lo, hi = max(lo, mode - reach), min(hi, mode + reach)
    if not lo <= a <= hi:
        return 0.0
    ks = np.arange(lo, hi + 1, dtype=float)
    # log pmf by its ratio recurrence, so the support is one vector operation
    steps = np.log((row - ks[:-1]) * (col - ks[:-1])) - np.log((ks[:-1] + 1) * (n - row - col + ks[:-1] + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    probs = np.exp(logs - logs.max())
    probs /= probs.sum()
    observed = probs[a - lo]
    return float(min(1.0, probs[probs <= observed * (1 + 1e-7)].sum()))


def _partition_steps(m: int) -> tuple[int, list[int]]:
    """A period L, and N with ``sum N_j q^j / (1 - q^L)^(m+1)`` = 1 / ((1 - q) (1 - q) (1 - q^2) ... (1 - q^m))."""
    period = math.lcm(*range(1, m + 1))
    steps = np.ones(1, dtype=object)
    for part in (1, *range(1, m + 1)):
        # times (1 - q^period) / (1 - q^part), which is a polynomial
        longer = np.zeros(len(steps) + period, dtype=object)
        longer[: len(steps)] = steps
        longer[period:] -= steps
        for start in range(part):
            longer[start::part] = np.cumsum(longer[start::part])
        steps = longer[: len(steps) + period - part]
    return period, steps.tolist()


def _ways_up_to(u: int, m: int, n: int) -> int:
    """Number of orders of m and n values with U <= u; the work grows with m only."""
    period, steps = _partition_steps(m)
    # numerator of the Gaussian binomial: product over i of 1 - q^(n+i)
    signs = {0: 1}
    for i in range(1, m + 1):
        for at, sign in list(signs.items()):
            if at + n + i <= u:
                signs[at + n + i] = signs.get(at + n + i, 0) - sign
    total = 0
    for at, sign in signs.items():
        left = u - at
        for j in range(left % period, min(left, len(steps) - 1) + 1, period):
            total += sign * steps[j] * math.comb((left - j) // period + m, m)
    return total


def mann_whitney_upper(u: float, m: int, n: int) -> float:
    """P(U >= u) without ties, from the number of ways to reach each value of U; exact for any n, meant for a small m."""
    if m <= 0 or n <= 0:
        return 1.0
    # U and m * n - U have the same distribution
    below = m * n - max(0, math.ceil(u))
    return _ways_up_to(below, m, n) / math.comb(m + n, m) if below >= 0 else 0.0


@pandas_udf(DoubleType())
def _norm_two_sided(z: pd.Series) -> pd.Series:
    return z.map(lambda v: math.erfc(abs(v) / math.sqrt(2.0)), na_action="ignore").astype("float64")


@pandas_udf(DoubleType())
def _norm_upper(z: pd.Series) -> pd.Series:
    return z.map(lambda v: 0.5 * math.erfc(v / math.sqrt(2.0)), na_action="ignore").astype("float64")


@pandas_udf(DoubleType())
def _t_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided(float(x), float(d)) for x, d in zip(t, df)], dtype="float64")


@pandas_udf(DoubleType())
def _t_q(p: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_quantile(float(x), float(d)) for x, d in zip(p, df)], dtype="float64")


@pandas_udf(StructType([StructField("w", DoubleType()), StructField("p", DoubleType())]))
def _shapiro(values: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([shapiro_wilk(v) if v is not None else (float("nan"),) * 2 for v in values], columns=["w", "p"])


@pandas_udf(DoubleType())
def _t_power(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    return pd.Series([power_t(float(x), float(a), float(b)) for x, a, b in zip(d, n1, n2)], dtype="float64")


@pandas_udf(DoubleType())
def _t_sample(d: pd.Series) -> pd.Series:
    return pd.Series([sample_t(float(x)) for x in d], dtype="float64")


@pandas_udf(DoubleType())
def _f_p(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series([f_upper(float(x), float(a), float(b)) for x, a, b in zip(f, d1, d2)], dtype="float64")


@pandas_udf(DoubleType())
def _fisher_p(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    return pd.Series(
        [fisher_two_sided(int(w), int(x), int(y), int(z)) for w, x, y, z in zip(a, b, c, d)], dtype="float64"
    )


@pandas_udf(DoubleType())
def _mw_p(u: pd.Series, m: pd.Series, n: pd.Series) -> pd.Series:
    small, large = np.minimum(m, n), np.maximum(m, n)
    return pd.Series([mann_whitney_upper(float(x), int(a), int(b)) for x, a, b in zip(u, small, large)], dtype="float64")


# Where the smaller sample is up to this size and there are no ties, the distribution of U is exact, whatever
# the size of the larger; all others get its normal approximation.
MW_EXACT_SAMPLE = 8


def p_mann_whitney(u: Column, m: Column, n: Column) -> Column:
    """Exact P(U >= u); meant for small samples without ties."""
    return _mw_p(u.cast("double"), m.cast("long"), n.cast("long"))


def p_two_sided(z: Column) -> Column:
    """P(|N(0,1)| > |z|); accurate far into the tail."""
    return _norm_two_sided(z.cast("double"))


def p_upper(z: Column) -> Column:
    return _norm_upper(z.cast("double"))


def p_chi_square_1(stat: Column) -> Column:
    """Upper tail of chi-square with one degree of freedom."""
    return _norm_two_sided(F.sqrt(stat.cast("double")))


def _nan_safe(value: Column) -> Column:
    return F.coalesce(value.cast("double"), F.lit(float("nan")))


def p_t(t: Column, df: Column) -> Column:
    p = _t_p(_nan_safe(t), _nan_safe(df))
    return F.when(~F.isnan(p), p)


def q_t(p: Column, df: Column) -> Column:
    q = _t_q(_nan_safe(p), _nan_safe(df))
    return F.when(~F.isnan(q), q)


def power_of_t(effect: Column, n1: Column, n2: Column) -> Column:
    """Two-sided power of the t-test at 5 %; null without two arms."""
    power = _t_power(_nan_safe(effect), _nan_safe(n1), _nan_safe(n2))
    return F.when(~F.isnan(power), power)


def sample_for_t(effect: Column) -> Column:
    """Per-arm sample for 80 % power of the t-test at 5 %, equal arms; null without an effect."""
    n = _t_sample(_nan_safe(effect))
    return F.when(~F.isnan(n), n.cast("long"))


def shapiro(values: Column) -> Column:
    """W and p of the Shapiro-Wilk test for an array of at most a few thousand values, as a struct."""
    return _shapiro(values)


def p_f(f: Column, d1: Column, d2: Column) -> Column:
    p = _f_p(_nan_safe(f), _nan_safe(d1), _nan_safe(d2))
    return F.when(~F.isnan(p), p)


def p_fisher(a: Column, b: Column, c: Column, d: Column) -> Column:
    return _fisher_p(*[x.cast("long") for x in (a, b, c, d)])


def norm_cdf(z: Column) -> Column:
    """Normal distribution function as a Column (Abramowitz & Stegun 26.2.17).

    Absolute error below 7.5e-8: enough for power, not for small p-values.
    """
    x = F.abs(z)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.2316419) * x)
    poly = t * (
        F.lit(0.319381530)
        + t * (F.lit(-0.356563782) + t * (F.lit(1.781477937) + t * (F.lit(-1.821255978) + t * F.lit(1.330274429))))
    )
    upper = F.exp(-(x * x) / F.lit(2.0)) / F.lit(math.sqrt(2.0 * math.pi)) * poly
    return F.when(z >= 0, F.lit(1.0) - upper).otherwise(upper)
