"""From the four source tables to the marts, as one lazy plan."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame

from riskweave.operators import dims, facts, layers, marts
from riskweave.operators.features import hot_features, ordinary_features
from riskweave.operators.rules import apply_rules
from riskweave.operators.skew import GROUP_LIMIT, KeySkew, measure_skew


class Warehouse:
    """Every layer by name. Nothing runs until a frame is used.

    ``run_ts`` stamps the load, ``as_of`` is the day account ages refer to; both
    are arguments, so a run can be repeated. Customers with more than
    ``group_limit`` events are split over tasks. ``watch`` gets each model on the
    way to the marts, under the name its checks have, and gives it back observed.
    """

    def __init__(
        self,
        sources: Mapping[str, DataFrame],
        run_ts: datetime | str,
        as_of: date | str,
        group_limit: int = GROUP_LIMIT,
        watch: Callable[[str, DataFrame], DataFrame] = lambda model, df: df,
    ) -> None:
        self.sources = dict(sources)
        self.loaded_at = layers.run_timestamp(run_ts)
        self.as_of = as_of
        self.group_limit = group_limit
        self.watch = watch

    # landing
    @cached_property
    def landing_customer(self) -> DataFrame:
        landed = layers.land_customers(self.sources["customers"], self.loaded_at)
        return self.watch("raw_customer", landed)

    @cached_property
    def landing_merchant(self) -> DataFrame:
        landed = layers.land_merchants(self.sources["merchants"], self.loaded_at)
        return self.watch("raw_merchant", landed)

    @cached_property
    def landing_transaction(self) -> DataFrame:
        landed = layers.land_transactions(self.sources["transactions"], self.loaded_at)
        return self.watch("raw_transaction", landed)

    @cached_property
    def landing_login_attempt(self) -> DataFrame:
        landed = layers.land_login_attempts(self.sources["login_attempts"])
        return self.watch("raw_login_attempt", landed)

    # staging
    @cached_property
    def stg_customer(self) -> DataFrame:
        return layers.stage_customers(self.landing_customer)

    @cached_property
    def stg_merchant(self) -> DataFrame:
        return layers.stage_merchants(self.landing_merchant)

    @cached_property
    def stg_transaction(self) -> DataFrame:
        return layers.stage_transactions(self.landing_transaction)

    @cached_property
    def stg_login_attempt(self) -> DataFrame:
        return layers.stage_login_attempts(self.landing_login_attempt)

    # dimensions
    @cached_property
    def customer_profile(self) -> DataFrame:
        return dims.customer_profile(self.stg_customer, self.as_of)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dims.customer_dimension(self.stg_customer, self.as_of)

    @cached_property
    def dim_merchant(self) -> DataFrame:
        return self.watch("dim_merchant", dims.merchant_dimension(self.stg_merchant))

    # facts
    @cached_property
    def fact_transaction(self) -> DataFrame:
        return facts.transaction_fact(self.stg_transaction, self.customer_profile)

    @cached_property
    def fact_login_attempt(self) -> DataFrame:
        return self.watch("fact_login_attempt", facts.login_fact(self.stg_login_attempt))

    # marts
    @cached_property
    def v_transaction(self) -> DataFrame:
        # The fact is part of the mart and not built apart.
        return self.watch("fact_transaction", self._mart_of(self.stg_transaction))

    def _mart_of(self, staged: DataFrame) -> DataFrame:
        return marts.transaction_mart(staged, self.customer_profile, self.dim_merchant)

    @cached_property
    def v_login_attempt(self) -> DataFrame:
        return marts.login_mart(self.fact_login_attempt, self.customer_profile)

    # features and rules
    @cached_property
    def customer_skew(self) -> KeySkew:
        """Measured on staging, where it costs two column scans and no join."""
        frames = [self.stg_transaction, self.stg_login_attempt]
        return measure_skew("customer_id", frames, self.group_limit)

    def _features(self, zscore: bool) -> DataFrame:
        """Features of the mart's transactions, hot customers split off at the source.

        Splitting before the joins keeps oversized customers out of them. The fact
        carries all login columns the features need, so the login mart is not built.
        """
        cold, hot = self.customer_skew.split(self.stg_transaction)
        cold_logins, hot_logins = self.customer_skew.split(self.stg_login_attempt)
        ordinary = ordinary_features(self._mart_of(cold), facts.login_fact(cold_logins), zscore)
        if hot is None:
            return ordinary
        return ordinary.unionByName(
            hot_features(
                self._mart_of(hot), facts.login_fact(hot_logins), zscore, self.customer_skew
            )
        )

    @cached_property
    def enriched_transactions(self) -> DataFrame:
        return self._features(zscore=False)

    @cached_property
    def features_for_rules(self) -> DataFrame:
        """``enriched_transactions`` with the amount's z-score."""
        return self._features(zscore=True)

    @cached_property
    def scored_transactions(self) -> DataFrame:
        return apply_rules(self.features_for_rules)
