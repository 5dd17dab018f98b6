"""Experiment marts and views: results, analysis frame, comparison, portfolio, cumulative curves, balance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from agorakit.functions import fixed, half_up, money_sum, ratio_pct
from agorakit.operators.assignment import hash_fraction


def fct_experiment_results(assignments: DataFrame, orders: DataFrame) -> DataFrame:
    """Users, orders, converters, rate, revenue, AOV and revenue per user of every experiment and variant.

    Orders shrink to one row per customer before they meet the assignments, and
    the distinct users are counted on the partitioning that join leaves behind.
    """
    bought = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("orders"),
        F.sum("order_total").alias("revenue"),
        F.count("order_total").alias("priced"),
    )
    per_user = (
        assignments.select("customer_id", "experiment_id", "experiment_name", "variant")
        .join(bought, "customer_id", "left")
        .groupBy("customer_id", "experiment_id", "experiment_name", "variant")
        .agg(F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"), F.sum("priced").alias("priced"))
    )
    sums = per_user.groupBy("experiment_id", "experiment_name", "variant").agg(
        F.count("customer_id").alias("unique_users"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
        F.count_if(F.col("orders") > 0).alias("converting_users"),
        half_up(F.coalesce(money_sum(F.col("revenue")), F.lit(0.0)), 2).alias("total_revenue"),
        F.sum("priced").alias("priced"),
    )
    users = F.col("unique_users")
    return sums.select(
        "experiment_id",
        "experiment_name",
        "variant",
        "unique_users",
        "total_orders",
        "converting_users",
        F.coalesce(ratio_pct(F.col("converting_users"), users, 4), F.lit(0.0)).alias("conversion_rate"),
        "total_revenue",
        F.coalesce(half_up(F.try_divide("total_revenue", "priced"), 2), F.lit(0.0)).alias("avg_order_value"),
        F.coalesce(half_up(F.try_divide("total_revenue", "unique_users"), 2), F.lit(0.0)).alias("revenue_per_user"),
    )


def experiment_frame(
    assignments: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    reviews: DataFrame | None = None,
    converted: Column | None = None,
) -> DataFrame:
    """One row per assignment: first order, summed totals, conversion flag, mean review of the first order.

    Non-converters have zero totals and no review. ``converted`` is an
    expression over the assignment and order columns (default: has an order).
    """
    totals = items.groupBy("order_id").agg(
        money_sum(F.col("price")).alias("order_total"), F.count("order_item_id").alias("item_count")
    )
    detail = orders.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ).join(totals, "order_id", "left")
    first = F.min_by(
        F.struct(
            "order_id",
            "order_status",
            "order_purchase_timestamp",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        ),
        F.struct("order_purchase_timestamp", "order_id"),
    )
    per_customer = (
        detail.groupBy("customer_id")
        .agg(
            first.alias("f"),
            money_sum(F.coalesce("order_total", F.lit(0.0))).alias("order_total"),
            F.sum(F.coalesce("item_count", F.lit(0))).alias("item_count"),
        )
        .select("customer_id", "f.*", "order_total", "item_count")
    )
    if reviews is None:
        per_customer = per_customer.withColumn("review_score", F.lit(None).cast("double"))
    else:
        scores = reviews.groupBy("order_id").agg(F.avg("review_score").alias("review_score"))
        per_customer = per_customer.join(scores, "order_id", "left")
    merged = assignments.join(per_customer, "customer_id", "left")
    flag = F.col("order_id").isNotNull() if converted is None else F.coalesce(converted, F.lit(False))
    yes = F.col("converted")
    return (
        merged.withColumn("converted", flag)
        .withColumn("order_total", F.when(yes, F.coalesce("order_total", F.lit(0.0))).otherwise(0.0))
        .withColumn("item_count", F.when(yes, F.coalesce("item_count", F.lit(0))).otherwise(0).cast("long"))
        .withColumn("review_score", F.when(yes, F.col("review_score")))
    )


def keyed_threshold(baseline: Column, lift_pct: Column) -> Column:
    """Conversion flag fixed by the hash of customer and experiment; treatment has the lifted rate."""
    rate = F.when(F.col("variant") == "treatment", baseline * (F.lit(1.0) + lift_pct / F.lit(100.0))).otherwise(baseline)
    return hash_fraction(F.col("customer_id"), F.col("experiment_id"), F.lit("outcome")) < rate


def comparison(results: DataFrame, summary: DataFrame) -> DataFrame:
    """Arms side by side per experiment, with p-value, decision and lift; arm names in any case."""

    def arm(name: str, column: str) -> Column:
        return F.max(F.when(F.lower("variant") == name, F.col(column)))

    def users(name: str) -> Column:
        return F.sum(F.when(F.lower("variant") == name, F.col("unique_users")).otherwise(0))

    pivoted = results.groupBy("experiment_id").agg(
        F.max("experiment_name").alias("experiment_name"),
        users("control").alias("control_users"),
        users("treatment").alias("treatment_users"),
        *[
            arm(name, column).alias(f"{name}_{short}")
            for column, short in (
                ("conversion_rate", "conversion_rate"),
                ("total_revenue", "revenue"),
                ("avg_order_value", "aov"),
            )
            for name in fixed.VARIANTS
        ],
    )
    facts = summary.select("experiment_id", "p_value", "significant", "recommendation", "revenue_impact_monthly")
    gain = F.try_divide(
        F.col("treatment_conversion_rate") - F.col("control_conversion_rate"), F.col("control_conversion_rate")
    )
    return pivoted.join(facts, "experiment_id", "left").withColumn("lift_percent", gain * F.lit(100))


def lift_interval(control: Column, treatment: Column, n_c: Column, n_t: Column, lift: Column) -> tuple[Column, Column]:
    """95 % interval of a relative lift in percent, as the reports print it."""
    se = F.sqrt(
        control * (F.lit(1) - control) / F.greatest(n_c, F.lit(1))
        + treatment * (F.lit(1) - treatment) / F.greatest(n_t, F.lit(1))
    )
    width = F.lit(fixed.API_Z_ALPHA) * (se / F.greatest(control, F.lit(0.001)) * F.lit(100))
    return half_up(lift - width, 1), half_up(lift + width, 1)


def experiment_list(compared: DataFrame) -> DataFrame:
    """All experiments with interval, needed and current sample and both arms' figures."""
    zero = F.lit(0.0)
    n_c, n_t = F.coalesce("control_users", F.lit(0)), F.coalesce("treatment_users", F.lit(0))
    c = F.coalesce("control_conversion_rate", zero) / F.lit(100)
    t = F.coalesce("treatment_conversion_rate", zero) / F.lit(100)
    lift = F.coalesce("lift_percent", zero)
    low, high = lift_interval(c, t, n_c, n_t, lift)
    z = fixed.API_Z_ALPHA + fixed.API_Z_BETA
    needed = F.floor(F.lit(2 * z * z) * c * (F.lit(1) - c) / F.lit(0.02**2)).cast("long") * 2
    x_c, x_t = F.floor(n_c * c).cast("long"), F.floor(n_t * t).cast("long")
    p = F.coalesce("p_value", F.lit(1.0))

    def aov(name: str, conversions: Column) -> Column:
        return half_up(F.coalesce(f"{name}_revenue", zero) / F.greatest(conversions, F.lit(1)), 2)

    return compared.select(
        "experiment_id",
        "experiment_name",
        p.alias("p_value"),
        (p < 0.05).alias("significant"),
        F.coalesce("recommendation", F.lit("MONITOR")).alias("recommendation"),
        F.coalesce("revenue_impact_monthly", zero).alias("revenue_impact_monthly"),
        half_up(lift, 2).alias("lift_percent"),
        low.alias("ci_lower"),
        high.alias("ci_upper"),
        needed.alias("sample_size_needed"),
        (n_c + n_t).alias("sample_size_current"),
        n_c.alias("control_users"),
        x_c.alias("control_conversions"),
        F.coalesce("control_conversion_rate", zero).alias("control_conversion_rate"),
        F.coalesce("control_revenue", zero).alias("control_revenue"),
        aov("control", x_c).alias("control_aov"),
        n_t.alias("treatment_users"),
        x_t.alias("treatment_conversions"),
        F.coalesce("treatment_conversion_rate", zero).alias("treatment_conversion_rate"),
        F.coalesce("treatment_revenue", zero).alias("treatment_revenue"),
        aov("treatment", x_t).alias("treatment_aov"),
    ).orderBy("experiment_id")


def experiment_detail(compared: DataFrame, experiment: str) -> DataFrame:
    return experiment_list(compared.where(F.col("experiment_id") == experiment))


def portfolio(compared: DataFrame) -> DataFrame:
    return (
        experiment_list(compared)
        .select("experiment_name", "lift_percent", "ci_lower", "ci_upper", "significant", "recommendation")
        .orderBy(F.col("lift_percent").desc(), "experiment_name")
    )


def portfolio_summary(summary: DataFrame, results: DataFrame) -> DataFrame:
    """Counts of experiments, significant and launch-ready ones, and the revenue of the latter."""
    users = results.agg(F.floor(F.avg("unique_users") + F.lit(0.5)).cast("long")).scalar()
    launch = F.col("recommendation") == "LAUNCH"
    return summary.agg(
        F.count(F.lit(1)).alias("total_experiments"),
        F.count_if(F.lower("significant").isin("true", "yes")).alias("significant"),
        F.count_if(launch).alias("launch_ready"),
        half_up(F.coalesce(F.sum(F.when(launch, F.col("revenue_impact_monthly"))), F.lit(0.0)), 2).alias(
            "total_revenue_impact"
        ),
    ).withColumn("avg_sample_size", F.coalesce(users, F.lit(0)))


def executive_summary(summary: DataFrame) -> DataFrame:
    """How many experiments ended in each decision, and the revenue in all."""

    def ended(*decisions: str) -> Column:
        return F.count_if(F.col("recommendation").isin(*decisions))

    impact = half_up(F.coalesce(F.sum("revenue_impact_monthly"), F.lit(0.0)), 2)
    return summary.agg(
        F.count(F.lit(1)).alias("total_experiments"),
        F.count_if(F.lower("significant").isin("true", "yes")).alias("statistically_significant"),
        ended("LAUNCH").alias("launched"),
        ended("ABANDON").alias("abandoned"),
        ended("ITERATE").alias("iterate"),
        ended("INCONCLUSIVE").alias("inconclusive"),
        ended("ITERATE", "INCONCLUSIVE").alias("testing_continue"),
        impact.alias("total_revenue_impact_monthly"),
    ).withColumn("total_revenue_impact_annual", half_up(F.col("total_revenue_impact_monthly") * F.lit(12), 2))


def export_variants(frame: DataFrame) -> DataFrame:
    """Per experiment and variant: users, conversions, rate, revenue and AOV of converters."""
    sums = frame.groupBy("experiment_id", "experiment_name", "variant").agg(
        F.count(F.lit(1)).alias("users"),
        F.count_if("converted").alias("conversions"),
        money_sum(F.col("order_total")).alias("rev"),
        money_sum(F.when(F.col("converted"), F.col("order_total"))).alias("rev_conv"),
    )
    return sums.select(
        "experiment_id",
        "experiment_name",
        F.initcap("variant").alias("variant"),
        "users",
        "conversions",
        F.coalesce(ratio_pct(F.col("conversions"), F.col("users"), 2), F.lit(0.0)).alias("conv_rate"),
        half_up(F.col("rev"), 2).alias("revenue"),
        F.coalesce(half_up(F.try_divide("rev_conv", "conversions"), 2), F.lit(0.0)).alias("aov"),
    )


def cumulative(events: DataFrame, experiment: str) -> DataFrame:
    """Cumulative conversion by arm and day number. Sessions are counted per day, as each day ends."""
    per_session = (
        events.where(F.col("experiment_id") == experiment)
        .groupBy(F.to_date("event_timestamp").alias("d"), "variant", "session_id")
        .agg(F.max(F.when(F.col("event_type") == "checkout_complete", 1).otherwise(0)).alias("bought"))
    )
    daily = per_session.groupBy("d", "variant").agg(
        F.count("session_id").alias("sessions"), F.sum("bought").alias("conversions")
    )
    by_day = Window.partitionBy("variant").orderBy("d")
    running = by_day.rowsBetween(Window.unboundedPreceding, 0)
    curve = daily.select(
        "variant",
        F.row_number().over(by_day).alias("day"),
        ratio_pct(F.sum("conversions").over(running), F.sum("sessions").over(running), 2).alias("cr"),
    )

    def arm(name: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("variant") == name, F.col("cr"))), F.lit(0.0)).alias(name)

    return curve.groupBy("day").agg(*[arm(v) for v in fixed.VARIANTS]).orderBy("day")


def balance(frame: DataFrame, column: str, top: int = 5, digits: int = 6) -> DataFrame:
    """Share of the ``top`` most frequent covariate values within each arm, per experiment."""
    counts = frame.where(F.col(column).isNotNull()).groupBy("experiment_id", "variant", column).agg(
        F.count(F.lit(1)).alias("n")
    )
    size = F.sum("n").over(Window.partitionBy("experiment_id", column))
    ranked = counts.withColumn("size", size).withColumn(
        "place", F.dense_rank().over(Window.partitionBy("experiment_id").orderBy(F.col("size").desc(), column))
    )
    total = F.sum("n").over(Window.partitionBy("experiment_id", "variant"))
    return (
        ranked.where(F.col("place") <= top)
        .withColumn("share", half_up(F.col("n") / total, digits))
        .groupBy("experiment_id", column)
        .pivot("variant", fixed.VARIANTS)
        .agg(F.first("share"))
        .fillna(0.0, subset=fixed.VARIANTS)
    )


def split_checks(assignments: DataFrame) -> DataFrame:
    """Arm shares (45-55 % expected) and customers in more than one arm, per experiment."""
    per_customer = assignments.groupBy("experiment_id", "customer_id").agg(
        F.count_if(F.col("variant") == "control").alias("c"), F.count_if(F.col("variant") == "treatment").alias("t")
    )
    sums = per_customer.groupBy("experiment_id").agg(
        F.sum("c").alias("n_control"),
        F.sum("t").alias("n_treatment"),
        F.count_if((F.col("c") > 0) & (F.col("t") > 0)).alias("in_both_arms"),
        F.count_if(F.col("c") + F.col("t") > 1).alias("duplicate_pairs"),
    )
    share = ratio_pct(F.col("n_control"), F.col("n_control") + F.col("n_treatment"), 4)
    return sums.withColumn("control_pct", share).withColumn("balanced", F.col("control_pct").between(45, 55))


def band_cost(
    frame: DataFrame,
    low: float = 35.0,
    high: float = 50.0,
    freight: float = 20.0,
    margin: float = 0.15,
    monthly_traffic: int = 100_000,
) -> DataFrame:
    """Cost and benefit of free shipping for orders in a price band, per experiment.

    The share of treatment converters in [low, high) newly ships free; against it
    stands the margin of the extra conversions.
    """
    yes, treated = F.col("converted"), F.col("variant") == "treatment"
    inside = yes & treated & (F.col("order_total") >= low) & (F.col("order_total") < high)
    sums = frame.groupBy("experiment_id").agg(
        F.count_if(treated).alias("n_t"),
        F.count_if(~treated).alias("n_c"),
        F.count_if(yes & treated).alias("x_t"),
        F.count_if(yes & ~treated).alias("x_c"),
        F.count_if(inside).alias("in_band"),
        money_sum(F.when(yes & treated, F.col("order_total"))).alias("rev"),
    )
    zero = F.lit(0.0)
    rate_t = F.coalesce(F.try_divide("x_t", "n_t"), zero)
    rate_c = F.coalesce(F.try_divide("x_c", "n_c"), zero)
    share = F.coalesce(F.try_divide("in_band", "x_t"), zero)
    cost = F.lit(monthly_traffic) * rate_t * share * F.lit(freight)
    profit = F.lit(monthly_traffic) * (rate_t - rate_c) * F.coalesce(F.try_divide("rev", "x_t"), zero) * F.lit(margin)
    return sums.select(
        "experiment_id",
        half_up(share, 6).alias("pct_incremental"),
        half_up(cost, 2).alias("monthly_shipping_cost"),
        half_up(profit, 2).alias("monthly_profit"),
        half_up(profit - cost, 2).alias("monthly_net"),
    )


def by_segment(frame: DataFrame, column: str) -> DataFrame:
    """Users, conversions and revenue per experiment, segment and arm, with the lift of the segment."""

    def arm(name: str, measure) -> Column:
        return measure(F.col("variant") == name)

    sums = frame.groupBy("experiment_id", column).agg(
        *[arm(v, F.count_if).alias(f"n_{v}") for v in fixed.VARIANTS],
        *[arm(v, lambda c: F.count_if(c & F.col("converted"))).alias(f"x_{v}") for v in fixed.VARIANTS],
        *[
            arm(v, lambda c: F.coalesce(money_sum(F.when(c, F.col("order_total"))), F.lit(0.0))).alias(f"revenue_{v}")
            for v in fixed.VARIANTS
        ],
    )
    c, t = F.try_divide("x_control", "n_control"), F.try_divide("x_treatment", "n_treatment")
    return sums.withColumn("lift_percent", half_up(F.try_divide(t - c, c) * F.lit(100), 4))


def arm_counts(assignments: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return assignments.groupBy("experiment_id", *by).agg(
        F.count_if(F.col("variant") == "control").alias("n_control"),
        F.count_if(F.col("variant") == "treatment").alias("n_treatment"),
    )


def arm_pairs(assignments: DataFrame, experiments: Sequence[str]) -> DataFrame:
    """2x2 counts of the arms of every two experiments.

    Each customer's arms become one row with a flag per experiment, and every
    pair is a count over those flags: the pairs are between the listed
    experiments, never between rows.
    """
    names = sorted(experiments)
    flags = assignments.groupBy("customer_id").agg(
        *[F.max(F.when(F.col("experiment_id") == e, (F.col("variant") == "treatment").cast("int"))).alias(e) for e in names]
    )
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    counted = flags.agg(
        *[
            F.struct(
                F.lit(a).alias("experiment_a"),
                F.lit(b).alias("experiment_b"),
                *[
                    F.count_if((F.col(a) == x) & (F.col(b) == y)).alias(f"n{x}{y}")
                    for x in (0, 1)
                    for y in (0, 1)
                ],
            ).alias(f"p{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return counted.select(F.explode(F.array(*[f"p{i}" for i in range(len(pairs))])).alias("p")).select("p.*")
