"""Bayesian comparison of two arms, by quadrature instead of draws.

The posterior parameters come from counts and moments Spark has aggregated. Beta posteriors are laid on one grid of
equal cells that covers both arms to ``REACH`` standard deviations, ``FINE`` cells to the narrower arm's standard
deviation; inside a cell the density is flat. The difference of the arms is the convolution of the two gridded
densities, and probabilities, losses, zones and quantiles are sums over its cells. Normal posteriors have closed forms.
The work is one row per experiment and prior; the same row gives the same numbers on every run.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StructField, StructType

from agorakit.functions import fixed, half_up
from agorakit.functions.scalar import hash_mod
from agorakit.functions.tails import p_upper

# The quadrature travels to the executors with the query; nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

REACH = 8.0  # standard deviations from the mean that the grid covers
FINE = 64.0  # cells to the smaller standard deviation
LOW, HIGH = 0.025, 0.975  # ends of the credible intervals

_COMPARED = [
    "prob_treatment_better",
    "control_mean",
    "treatment_mean",
    "lift_mean",
    "control_ci_low",
    "control_ci_high",
    "treatment_ci_low",
    "treatment_ci_high",
    "lift_ci_low",
    "lift_ci_high",
    "expected_loss_control",
    "expected_loss_treatment",
    "below_rope",
    "inside_rope",
    "above_rope",
]
_COMPARED_TYPE = StructType([StructField(name, DoubleType()) for name in _COMPARED])


def beta_grid(arms: Sequence[tuple[float, float]]) -> tuple[float, float, list[np.ndarray]]:
    """The first edge and the width of the cells of a grid over all arms, and each arm's cell masses."""
    moments = [(a / (a + b), math.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))) for a, b in arms]
    low = max(0.0, min(m - REACH * sd for m, sd in moments))
    high = min(1.0, max(m + REACH * sd for m, sd in moments))
    cells = max(1, math.ceil((high - low) / (min(sd for _, sd in moments) / FINE)))
    width = (high - low) / cells
    x = low + (np.arange(cells) + 0.5) * width
    masses = []
    for a, b in arms:
        logs = (a - 1) * np.log(x) + (b - 1) * np.log1p(-x)
        mass = np.exp(logs - logs.max())
        masses.append(mass / mass.sum())
    return low, width, masses


def gridded_quantile(first_edge: float, width: float, mass: np.ndarray, q: float) -> float:
    """The q-quantile of a density that is flat inside the cells."""
    upto = np.cumsum(mass)
    i = min(int(np.searchsorted(upto, q)), len(mass) - 1)
    return first_edge + width * (i + (q - (upto[i] - mass[i])) / mass[i])


def gridded_share(first_edge: float, width: float, mass: np.ndarray, x: float) -> float:
    """The mass below x."""
    inside = np.clip((x - first_edge) / width - np.arange(len(mass)), 0.0, 1.0)
    return float(mass @ inside)


def _convolved(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if len(a) <= 4096:
        return np.convolve(a, b)
    size = len(a) + len(b) - 1
    return np.maximum(np.fft.irfft(np.fft.rfft(a, size) * np.fft.rfft(b, size), size), 0.0)


def compare_betas(ac: float, bc: float, at: float, bt: float, rope: tuple[float, float]) -> tuple:
    """All values of ``_COMPARED`` for two beta posteriors."""
    low, width, (control, treatment) = beta_grid([(ac, bc), (at, bt)])
    # cell k of the difference is k - (cells - 1) steps wide of zero
    lift = _convolved(treatment, control[::-1])
    step = np.arange(len(lift)) - (len(control) - 1)
    edge = (step[0] - 0.5) * width
    zero = len(control) - 1
    # two values in one cell differ by a sixth of it on average, counting one sign
    within = lift[zero] * width / 6
    below = gridded_share(edge, width, lift, rope[0])
    above = 1.0 - gridded_share(edge, width, lift, rope[1])
    means = ac / (ac + bc), at / (at + bt)
    return (
        float(lift[zero + 1 :].sum() + lift[zero] / 2),
        *means,
        means[1] - means[0],
        *[gridded_quantile(low, width, mass, q) for mass in (control, treatment) for q in (LOW, HIGH)],
        *[gridded_quantile(edge, width, lift, q) for q in (LOW, HIGH)],
        float((lift[zero + 1 :] * step[zero + 1 :]).sum() * width + within),
        float(-(lift[:zero] * step[:zero]).sum() * width + within),
        below,
        1.0 - below - above,
        above,
    )


def beta_comparison(rope: tuple[float, float]):
    @pandas_udf(_COMPARED_TYPE)
    def run(ac: pd.Series, bc: pd.Series, at: pd.Series, bt: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([compare_betas(*row, rope) for row in zip(ac, bc, at, bt)], columns=_COMPARED)

    return run


@pandas_udf(DoubleType())
def beta_better(ac: pd.Series, bc: pd.Series, at: pd.Series, bt: pd.Series) -> pd.Series:
    """P(treatment better) alone: no convolution is needed."""
    out = []
    for row in zip(ac, bc, at, bt):
        _, _, (control, treatment) = beta_grid([row[:2], row[2:]])
        out.append(float(treatment @ (np.cumsum(control) - control / 2)))
    return pd.Series(out, dtype="float64")


def posterior(stats: DataFrame, prior_alpha: Column | float = 1.0, prior_beta: Column | float = 1.0) -> DataFrame:
    """Beta posterior of both arms from their counts (output of ``descriptives``)."""
    a = prior_alpha if isinstance(prior_alpha, Column) else F.lit(prior_alpha)
    b = prior_beta if isinstance(prior_beta, Column) else F.lit(prior_beta)
    out = stats
    for name in fixed.VARIANTS:
        x, n = F.col(f"conversions_{name}"), F.col(f"n_{name}")
        out = out.withColumn(f"{name}_alpha", a + x).withColumn(f"{name}_beta", b + n - x)
    return out


def _posterior_columns() -> list[str]:
    return [f"{name}_{p}" for name in fixed.VARIANTS for p in ("alpha", "beta")]


def bayes_rate(
    stats: DataFrame, prior_alpha: float = 1.0, prior_beta: float = 1.0, rope: tuple[float, float] = (-0.005, 0.005)
) -> DataFrame:
    """Conversion rates: P(treatment better), credible intervals, expected losses and ROPE zones."""
    params = posterior(stats, prior_alpha, prior_beta).select("experiment_id", *_posterior_columns())
    return _flat(params.withColumn("_d", beta_comparison(rope)(*[F.col(c) for c in _posterior_columns()])))


def bayes_mean(moments: DataFrame, rope: tuple[float, float] = (-0.005, 0.005)) -> DataFrame:
    """Means under a vague prior: the posterior of a mean is normal around it with its standard error.

    ``moments``: experiment_id, n_c, mean_c, var_c, n_t, mean_t, var_t. The difference is normal too, so all values have closed
    forms. Where neither arm varies, the difference is certain.
    """
    lift = F.col("mean_t") - F.col("mean_c")
    errors = {s: F.sqrt(F.col(f"var_{s}") / F.col(f"n_{s}")) for s in ("c", "t")}
    spread = F.sqrt(errors["c"] * errors["c"] + errors["t"] * errors["t"])

    def below(x: Column) -> Column:
        """P(lift < x)"""
        sure = F.when(lift < x, 1.0).when(lift > x, 0.0).otherwise(0.5)
        return F.when(F.col("_s") > 0, p_upper(F.try_divide(lift - x, F.col("_s")))).otherwise(sure)

    def gain(sign: float) -> Column:
        """Mean of the part of the signed lift above zero."""
        m = F.lit(sign) * lift
        score = F.try_divide(m, F.col("_s"))
        density = F.exp(-score * score / F.lit(2.0)) / F.lit(math.sqrt(2.0 * math.pi))
        return F.when(F.col("_s") > 0, F.col("_s") * density + m * p_upper(-score)).otherwise(F.greatest(m, F.lit(0.0)))

    z = F.lit(fixed.Z_95)
    ends = [("control", F.col("mean_c"), errors["c"]), ("treatment", F.col("mean_t"), errors["t"]), ("lift", lift, F.col("_s"))]
    low, high = below(F.lit(rope[0])), below(F.lit(rope[1]))
    values = {
        "prob_treatment_better": F.lit(1.0) - below(F.lit(0.0)),
        "control_mean": F.col("mean_c"),
        "treatment_mean": F.col("mean_t"),
        "lift_mean": lift,
        **{f"{n}_ci_low": m - z * e for n, m, e in ends},
        **{f"{n}_ci_high": m + z * e for n, m, e in ends},
        "expected_loss_control": gain(1.0),
        "expected_loss_treatment": gain(-1.0),
        "below_rope": low,
        "inside_rope": high - low,
        "above_rope": F.lit(1.0) - high,
    }
    enough = moments.where((F.col("n_c") > 1) & (F.col("n_t") > 1)).withColumn("_s", spread)
    return _flat(enough.select("experiment_id", F.struct(*[values[n].alias(n) for n in _COMPARED]).alias("_d")))


def _flat(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "_d"]
    flat = df.select(*rest, "_d.*")
    relative = half_up(F.coalesce(F.try_divide("lift_mean", "control_mean") * F.lit(100), F.lit(0.0)), 2)
    return flat.withColumn("prob_control_better", F.lit(1.0) - F.col("prob_treatment_better")).withColumn(
        "lift_relative_pct", relative
    )


def prior_sensitivity(stats: DataFrame, priors: Sequence[tuple[float, float]] = fixed.PRIORS) -> DataFrame:
    """The rate comparison under several priors, one row per experiment and prior."""
    options = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in priors])
    each = stats.withColumn("prior", F.explode(options))
    params = posterior(each, F.col("prior.a"), F.col("prior.b"))
    compared = params.withColumn("_d", beta_comparison((-0.005, 0.005))(*[F.col(c) for c in _posterior_columns()]))
    return compared.select(
        "experiment_id",
        F.col("prior.a").alias("prior_alpha"),
        F.col("prior.b").alias("prior_beta"),
        half_up(F.col("prior.a") / (F.col("prior.a") + F.col("prior.b")), 4).alias("prior_mean"),
        half_up(F.col("_d.prob_treatment_better"), 4).alias("prob_treatment_better"),
        *[
            half_up(F.col(f"_d.{c}"), 5).alias(c)
            for c in ("lift_mean", "lift_ci_low", "lift_ci_high", "expected_loss_control", "expected_loss_treatment")
        ],
    )


def rope(result: DataFrame) -> DataFrame:
    """Zone shares of the lift and the conclusion they allow."""
    below, inside, above = F.col("below_rope"), F.col("inside_rope"), F.col("above_rope")
    conclusion = (
        F.when(inside > 0.90, "Practically equivalent")
        .when(above > 0.95, "Treatment better")
        .when(below > 0.95, "Treatment worse")
        .otherwise("Inconclusive")
    )
    return result.select(
        "experiment_id",
        half_up(below, 4).alias("prob_below_rope"),
        half_up(inside, 4).alias("prob_inside_rope"),
        half_up(above, 4).alias("prob_above_rope"),
        conclusion.alias("conclusion"),
    )


def bayes_decide(result: DataFrame, threshold: float = 0.95, loss: float = 0.001) -> DataFrame:
    decision = (
        F.when(F.col("prob_treatment_better") >= threshold, "LAUNCH TREATMENT")
        .when(F.col("prob_control_better") >= threshold, "KEEP CONTROL")
        .when(
            (F.col("expected_loss_treatment") < loss) & (F.col("expected_loss_control") < loss),
            "PRACTICALLY EQUIVALENT",
        )
        .otherwise("CONTINUE TESTING")
    )
    return result.select(
        "experiment_id",
        "prob_treatment_better",
        "expected_loss_treatment",
        "expected_loss_control",
        "lift_mean",
        decision.alias("decision"),
    )


def sequential_counts(frame: DataFrame, steps: int = 20) -> DataFrame:
    """Cumulative users and conversions of both arms at ``steps`` checkpoints.

    The order of arrival is the hash of the customer: a customer falls into one
    of ``steps`` slices, slices are counted, and only the counts are accumulated.
    """
    slice_no = (hash_mod(F.concat_ws("|", "customer_id", "experiment_id", F.lit("slice"))) % steps + 1).cast("int")
    counted = frame.groupBy("experiment_id", slice_no.alias("step")).agg(
        *[F.count_if(F.col("variant") == v).alias(f"n_{v}") for v in fixed.VARIANTS],
        *[F.count_if((F.col("variant") == v) & F.col("converted")).alias(f"conversions_{v}") for v in fixed.VARIANTS],
    )
    running = Window.partitionBy("experiment_id").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    names = [f"{m}_{v}" for m in ("n", "conversions") for v in fixed.VARIANTS]
    summed = counted.select("experiment_id", "step", *[F.sum(c).over(running).alias(c) for c in names])
    return summed.select(
        "experiment_id",
        "step",
        (F.col("step") / F.lit(steps)).alias("fraction"),
        *names,
        *[
            half_up(F.coalesce(F.try_divide(f"conversions_{v}", f"n_{v}"), F.lit(0.0)), 4).alias(f"cr_{v}")
            for v in fixed.VARIANTS
        ],
    )


def sequential(frame: DataFrame, steps: int = 20) -> DataFrame:
    """P(treatment better) at every checkpoint."""
    params = posterior(sequential_counts(frame, steps))
    better = beta_better(*[F.col(c) for c in _posterior_columns()])
    return params.select(
        "experiment_id",
        "step",
        "fraction",
        "n_control",
        "n_treatment",
        "cr_control",
        "cr_treatment",
        half_up(better, 4).alias("prob_treatment_better"),
    )
