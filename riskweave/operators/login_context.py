"""What was known about a customer's logins at the moment of a transaction.

Two features per transaction: the customer's last login at or before it, and the
number of failed logins in the hours before it, both ends included. Logins at
the transaction's own instant count; of several logins at one instant the one
with the largest id is the last.

Neither form below pairs transactions with logins. Both put the two kinds of
events on one time line per customer and read running values off it, so the work
is linear in the number of events:

    failed in [t - 24 h, t]  =  failed up to t  -  failed strictly before t - 24 h
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.operators.ordered import (
    POSITION,
    SEGMENT,
    carried_forward,
    ordered_segments,
    partitions_for,
)
from riskweave.operators.skew import KeySkew, measure_skew

# Fixed value: length of the look-back for failed logins.
LOOKBACK_HOURS = 24

LAST = "last_login"
FAILED = "failed_logins"


def with_login_context(
    transactions: DataFrame,
    logins: DataFrame,
    hours: int = LOOKBACK_HOURS,
    skew: KeySkew | None = None,
    details: Sequence[str] = (),
) -> DataFrame:
    """Add ``last_login`` (a struct, null if none) and ``failed_logins``.

    The struct holds the login's time and id, and the columns named in ``details``.

    Customers small enough for one task share a single window pass, hot ones take
    the range-partitioned form. ``skew`` is measured on both inputs unless given.
    """
    skew = skew or measure_skew("customer_id", [transactions, logins])
    tx, hot_tx = skew.split(transactions)
    events, hot_events = skew.split(logins)
    context = context_by_window(tx, events, hours, details)
    if hot_tx is None:
        return context
    hot_context = context_by_segments(
        hot_tx, hot_events, hours, details, timeline_partitions(transactions, skew)
    )
    return context.unionByName(hot_context)


def timeline_partitions(transactions: DataFrame, skew: KeySkew) -> int:
    """Partitions for a hot time line: two probes per transaction, an event per login."""
    return partitions_for(transactions, 2 * skew.rows)


def _login_events(logins: DataFrame, details: Sequence[str]) -> DataFrame:
    """Logins as events: when, whether failed, and what a last login tells."""
    return logins.where("customer_id IS NOT NULL AND login_timestamp IS NOT NULL").select(
        "customer_id",
        F.col("login_timestamp").alias("_at"),
        F.coalesce(~F.col("is_success"), F.lit(False)).cast("int").alias("_failed"),
        F.struct("login_timestamp", "login_attempt_id", *details).alias("_login"),
    )


def context_by_window(
    transactions: DataFrame,
    logins: DataFrame,
    hours: int = LOOKBACK_HOURS,
    details: Sequence[str] = (),
) -> DataFrame:
    """One exchange by customer, one sort by time, one window operator.

    All three frames start at the first event and only ever grow, so each is a
    running value; a frame sliding over the last hours would be re-read for every
    row. The second one ends a microsecond before the look-back begins.
    """
    timeline = transactions.select(
        "*", F.col("transaction_timestamp").alias("_at"), F.lit(True).alias("_is_tx")
    ).unionByName(_login_events(logins, details), allowMissingColumns=True)
    over = "OVER (PARTITION BY customer_id ORDER BY _at RANGE BETWEEN UNBOUNDED PRECEDING AND {})"
    until_now = over.format("CURRENT ROW")
    until_lookback = over.format(f"INTERVAL '{hours}:00:00.000001' HOUR TO SECOND PRECEDING")
    running = timeline.select(
        *transactions.columns,
        "_is_tx",
        F.expr(f"max(_login) {until_now}").alias(LAST),
        F.expr(f"sum(_failed) {until_now}").alias("_failed_now"),
        F.expr(f"sum(_failed) {until_lookback}").alias("_failed_before"),
    )
    failed = F.coalesce("_failed_now", F.lit(0)) - F.coalesce("_failed_before", F.lit(0))
    return running.where("_is_tx").select(*transactions.columns, LAST, failed.alias(FAILED))


def context_by_segments(
    transactions: DataFrame,
    logins: DataFrame,
    hours: int = LOOKBACK_HOURS,
    details: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """The same for customers of any size: no task holds a whole customer.

    The time line is range-partitioned by customer and time. It carries, for each
    distinct (customer, transaction time), two probes: one behind the logins of
    that instant and one ahead of the logins a look-back earlier. Running values
    within a segment plus the total of the customer's earlier segments give the
    value at every probe.
    """
    instant = ["customer_id", "transaction_timestamp"]
    moments = (
        transactions.select(*instant)
        .where("customer_id IS NOT NULL AND transaction_timestamp IS NOT NULL")
        .distinct()
    )
    moment = F.col("transaction_timestamp")
    probes = moments.select(
        "*",
        F.explode(
            F.array(
                F.struct(moment.alias("_at"), F.lit(2).alias("_rank")),
                F.struct(
                    (moment - F.make_dt_interval(hours=F.lit(hours))).alias("_at"),
                    F.lit(0).alias("_rank"),
                ),
            )
        ).alias("_probe"),
    ).select(*instant, "_probe.*")
    events = _login_events(logins, details).withColumn("_rank", F.lit(1))
    timeline = events.unionByName(probes, allowMissingColumns=True).withColumn(
        "_tie", F.col("_login.login_attempt_id")
    )
    placed = ordered_segments(timeline, ["customer_id", "_at", "_rank", "_tie"], partitions)

    within = (
        Window.partitionBy(SEGMENT, "customer_id")
        .orderBy(POSITION)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = carried_forward(
        placed,
        ["customer_id"],
        {"_carried_failed": ("_failed", F.sum), "_carried_login": ("_login", F.max)},
    )
    running = (
        placed.withColumns(
            {
                "_run_failed": F.sum("_failed").over(within),
                "_run_login": F.max("_login").over(within),
            }
        )
        .where("_rank <> 1")
        .join(carried, ["customer_id", SEGMENT], "left")
    )
    failed = F.coalesce("_run_failed", F.lit(0)) + F.coalesce("_carried_failed", F.lit(0))
    signed = F.when(F.col("_rank") == 2, failed).otherwise(-failed)
    at_transaction = F.when(F.col("_rank") == 2, F.coalesce("_run_login", "_carried_login"))
    context = running.groupBy(*instant).agg(
        F.max(at_transaction).alias(LAST), F.sum(signed).alias(FAILED)
    )
    return transactions.join(context, instant, "left").select(
        *transactions.columns, LAST, F.coalesce(FAILED, F.lit(0)).alias(FAILED)
    )


def running_counts(
    timeline: DataFrame, hours: int = LOOKBACK_HOURS, measure: bool = True
) -> DataFrame:
    """Add to each transaction's ``n`` the failed logins of its look-back.

    ``timeline`` has the columns ``customer_id``, ``at``, ``is_tx``, ``n`` and
    ``is_new``: transactions with the count they have so far, and instants with
    ``n`` failed logins. A new transaction gains all logins of its look-back, an
    earlier one only the new ones. Transactions without a time or a customer
    gain nothing. Other columns are kept.

    Customers too large for one task are found, if ``measure`` is set, and
    counted over range-partitioned segments.
    """
    skew = measure_skew("customer_id", [timeline]) if measure else KeySkew("customer_id", None)
    ordinary, hot = skew.split(timeline)
    counted = _gained_by_window(ordinary, hours)
    if hot is None:
        return counted
    return counted.unionByName(_gained_by_segments(hot, hours, partitions_for(hot, 2 * skew.rows)))


def _gains(timeline: DataFrame) -> DataFrame:
    """Logins per row, all of them and the new ones."""
    login = F.when(F.col("is_tx"), F.lit(0)).otherwise(F.col("n"))
    return timeline.withColumns(
        {"_all": login, "_fresh": F.when(F.col("is_new"), login).otherwise(F.lit(0))}
    )


def _with_gain(df: DataFrame, gain_all: str, gain_fresh: str, columns: Sequence[str]) -> DataFrame:
    gain = F.when(F.col("is_new"), F.expr(gain_all)).otherwise(F.expr(gain_fresh))
    counted = F.col("is_tx") & F.col("at").isNotNull() & F.col("customer_id").isNotNull()
    n = F.when(counted, F.col("n") + F.coalesce(gain, F.lit(0))).otherwise(F.col("n"))
    return df.withColumn("n", n.cast("bigint")).select(*columns)


def _gained_by_window(timeline: DataFrame, hours: int) -> DataFrame:
    over = "OVER (PARTITION BY customer_id ORDER BY at RANGE BETWEEN UNBOUNDED PRECEDING AND {})"
    until_now = over.format("CURRENT ROW")
    until_lookback = over.format(f"INTERVAL '{hours}:00:00.000001' HOUR TO SECOND PRECEDING")
    running = _gains(timeline).select(
        "*",
        *[
            F.expr(f"sum({c}) {frame}").alias(f"{c}{name}")
            for c in ("_all", "_fresh")
            for name, frame in (("_now", until_now), ("_before", until_lookback))
        ],
    )
    return _with_gain(
        running,
        "_all_now - ifnull(_all_before, 0)",
        "_fresh_now - ifnull(_fresh_before, 0)",
        timeline.columns,
    )


def _gained_by_segments(timeline: DataFrame, hours: int, partitions: int | None) -> DataFrame:
    """Running sums over segments; each transaction instant is a probe now and one look-back ago."""
    instant = ["customer_id", "at"]
    moments = timeline.where("is_tx AND at IS NOT NULL AND customer_id IS NOT NULL").select(*instant).distinct()
    back = F.col("at") - F.make_dt_interval(hours=F.lit(hours))
    probes = moments.select(
        "customer_id",
        F.col("at").alias("_moment"),
        F.inline(
            F.array(
                F.struct(F.col("at").alias("_at"), F.lit(2).alias("_rank")),
                F.struct(back.alias("_at"), F.lit(0).alias("_rank")),
            )
        ),
    )
    logins = _gains(timeline).where("NOT is_tx AND at IS NOT NULL AND customer_id IS NOT NULL")
    events = logins.select("customer_id", F.col("at").alias("_at"), F.lit(1).alias("_rank"), "_all", "_fresh")
    placed = ordered_segments(
        events.unionByName(probes, allowMissingColumns=True), ["customer_id", "_at", "_rank"], partitions
    )
    within = (
        Window.partitionBy(SEGMENT, "customer_id")
        .orderBy(POSITION)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = carried_forward(
        placed,
        ["customer_id"],
        {"_all_carried": ("_all", F.sum), "_fresh_carried": ("_fresh", F.sum)},
    )
    sums = placed.withColumns({f"{c}_run": F.sum(c).over(within) for c in ("_all", "_fresh")})
    sums = sums.where("_rank <> 1").join(carried, ["customer_id", SEGMENT], "left")
    sign = F.when(F.col("_rank") == 2, 1).otherwise(-1)
    total = [
        F.sum(sign * (F.coalesce(f"{c}_run", F.lit(0)) + F.coalesce(f"{c}_carried", F.lit(0)))).alias(f"{c}_gain")
        for c in ("_all", "_fresh")
    ]
    gains = sums.groupBy("customer_id", F.col("_moment").alias("at")).agg(*total)
    joined = timeline.join(gains, instant, "left")
    return _with_gain(joined, "_all_gain", "_fresh_gain", timeline.columns)
