"""Declared data-quality checks, run in as few passes as they allow.

A check's result is one row: model, column, kind and the number of failing rows
(zero means passed). All row-wise checks of a model share one aggregation.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from riskweave.functions.columns import CATEGORY_RISK, category_risk, or_false

NOT_NULL, BETWEEN, IN_SET, NOT_CONSTANT = "not_null", "between", "in_set", "not_constant"
UNIQUE, UNIQUE_COMBO, TYPE = "unique", "unique_combination", "type"


@dataclass(frozen=True)
class Check:
    model: str
    kind: str
    columns: tuple[str, ...]
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    type_name: str | None = None

    @property
    def label(self) -> str:
        return ",".join(self.columns)


def _not_null(model: str, *columns: str) -> list[Check]:
    return [Check(model, NOT_NULL, (column,)) for column in columns]


# The 57 checks and their bounds.
CHECKS: tuple[Check, ...] = (
    *_not_null(
        "raw_customer",
        "CustomerID",
        "AccountCreationDate",
        "Age",
        "PastFraudCount",
        "HomeDevice",
        "HomeIP",
        "HomeLat",
        "HomeLon",
    ),
    *_not_null("raw_login_attempt", "CustomerID", "LoginTimestamp", "Success", "ingestion_date"),
    *_not_null(
        "raw_merchant",
        "MerchantID",
        "MerchantName",
        "Category",
        "MerchantRiskScore",
        "ingestion_date",
    ),
    *_not_null(
        "raw_transaction",
        "TransactionID",
        "CustomerID",
        "Timestamp",
        "TransactionAmount",
        "DeviceID",
        "IP_Address",
        "Lat",
        "Lon",
        "Channel",
        "MerchantID",
    ),
    *_not_null("dim_customer", "customer_sk", "customer_id"),
    *_not_null("dim_merchant", "merchant_id"),
    *_not_null("fact_transaction", "transaction_id", "customer_id", "merchant_id"),
    *_not_null("fact_login_attempt", "login_attempt_id", "customer_id"),
    Check("raw_customer", BETWEEN, ("Age",), 18, 100),
    Check("raw_customer", BETWEEN, ("PastFraudCount",), 0),
    Check("raw_customer", BETWEEN, ("HomeLat",), -90, 90),
    Check("raw_customer", BETWEEN, ("HomeLon",), -180, 180),
    Check("raw_merchant", BETWEEN, ("MerchantRiskScore",), 0, 1),
    Check("raw_transaction", BETWEEN, ("TransactionAmount",), 0),
    Check("raw_transaction", BETWEEN, ("Lat",), -90, 90),
    Check("raw_transaction", BETWEEN, ("Lon",), -180, 180),
    Check("raw_login_attempt", IN_SET, ("Success",), values=(True, False)),
    Check("raw_login_attempt", NOT_CONSTANT, ("CustomerID",)),
    Check("raw_merchant", NOT_CONSTANT, ("MerchantID",)),
    Check("raw_merchant", NOT_CONSTANT, ("MerchantName",)),
    Check("raw_merchant", NOT_CONSTANT, ("Category",)),
    Check("raw_customer", UNIQUE, ("CustomerID",)),
    Check("raw_transaction", UNIQUE, ("TransactionID",)),
    Check("dim_customer", UNIQUE, ("customer_sk",)),
    Check("dim_customer", UNIQUE, ("customer_id",)),
    Check("fact_transaction", UNIQUE, ("transaction_id",)),
    Check("fact_login_attempt", UNIQUE, ("login_attempt_id",)),
    Check("raw_login_attempt", UNIQUE_COMBO, ("CustomerID", "LoginTimestamp")),
    Check("raw_customer", TYPE, ("CustomerID",), type_name="bigint"),
    Check("raw_login_attempt", TYPE, ("Success",), type_name="boolean"),
)


def _failing_rows(check: Check) -> Column:
    """The aggregate that counts a row-wise check's failing rows; nulls only fail not_null."""
    value = F.col(check.columns[0])
    if check.kind == NOT_NULL:
        return F.count_if(value.isNull())
    if check.kind == BETWEEN:
        outside = F.lit(False)
        if check.low is not None:
            outside = outside | (value < check.low)
        if check.high is not None:
            outside = outside | (value > check.high)
        return F.count_if(outside)
    if check.kind == IN_SET:
        return F.count_if(~value.isin(*check.values))
    if check.kind == NOT_CONSTANT:
        # Constant means one distinct value, which minimum and maximum tell.
        return F.coalesce((F.min(value) == F.max(value)).cast("bigint"), F.lit(0))
    raise ValueError(check.kind)


def _stored_type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def _type_failures(check: Check, stored: DataFrame) -> Column:
    """All rows if the column is stored as another type, else none."""
    differs = _stored_type(stored, check.columns[0]) != check.type_name
    return F.count("*") if differs else F.lit(0)


def _as_rows(one_row: DataFrame, checks: list[Check]) -> DataFrame:
    """A row of counts, one column per check, as one row per check."""
    entries = [
        F.struct(
            F.lit(check.model).alias("model"),
            F.lit(check.label).alias("column_name"),
            F.lit(check.kind).alias("check_kind"),
            F.col(f"c{i}").cast("bigint").alias("failing_rows"),
        )
        for i, check in enumerate(checks)
    ]
    return one_row.select(F.inline(F.array(*entries)))


def value_counts(df: DataFrame, keys: Sequence[Sequence[str]]) -> DataFrame:
    """Number of rows per value of each of several different keys, from one scan.

    Rows are grouped by every key at once as grouping sets. Each row becomes one
    row per key before the partial aggregation, where repeated values meet, so a
    value repeated very often arrives as one row per task. ``_key`` says which
    key a row belongs to; the columns of the other keys are null in it. Column
    types stay as they are.
    """
    names = list(dict.fromkeys(name for key in keys for name in key))
    # Plain names: those of the frame may be any, and a grouping set names no expression.
    plain = {name: f"_c{i}" for i, name in enumerate(names)}
    narrow = df.select(*[F.col(f"`{name}`").alias(plain[name]) for name in names])
    sets = [[F.col(plain[name]) for name in key] for key in keys]
    counts = narrow.groupingSets(sets, *[F.col(p) for p in plain.values()]).agg(
        F.grouping_id().alias("_absent"), F.count("*").alias("_n")
    )
    # The first column is the highest bit; a bit is set where the column is not of the set.
    width = len(names)
    masks = [sum(1 << (width - 1 - i) for i, n in enumerate(names) if n not in key) for key in keys]
    number = F.coalesce(*[F.when(F.col("_absent") == m, i) for i, m in enumerate(masks)])
    return counts.select(
        number.alias("_key"), *[F.col(p).alias(name) for name, p in plain.items()], "_n"
    )


def _duplicated_keys(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Per check, the number of key values that occur more than once; one scan for all."""
    keys = list(dict.fromkeys(tuple(sorted(check.columns)) for check in checks))
    counts = value_counts(df, keys)
    repeated = []
    for i, check in enumerate(checks):
        wrong = (F.col("_key") == keys.index(tuple(sorted(check.columns)))) & (F.col("_n") > 1)
        if check.kind == UNIQUE:
            wrong = wrong & F.col(f"`{check.columns[0]}`").isNotNull()
        repeated.append(F.count_if(wrong).alias(f"c{i}"))
    return _as_rows(counts.agg(*repeated), checks)


def run_checks(
    models: Mapping[str, DataFrame],
    checks: Iterable[Check] = CHECKS,
    stored: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Results of all given checks; ``models`` needs the models they name.

    Types are those of ``stored``, the same models over files read without a
    declared schema: a declared one would only give itself back.
    """
    stored = stored or {}
    by_model: dict[str, list[Check]] = {}
    keys: dict[str, list[Check]] = {}
    for check in checks:
        group = keys if check.kind in (UNIQUE, UNIQUE_COMBO) else by_model
        group.setdefault(check.model, []).append(check)
    parts = [_duplicated_keys(models[model], group) for model, group in keys.items()]
    for model, group in by_model.items():
        failing = [
            _type_failures(c, stored.get(model, models[model])) if c.kind == TYPE else _failing_rows(c)
            for c in group
        ]
        counts = models[model].agg(*[f.alias(f"c{i}") for i, f in enumerate(failing)])
        parts.append(_as_rows(counts, group))
    return reduce(DataFrame.unionByName, parts)


class ObservedChecks:
    """Row-wise checks counted while a frame is written to where it has to go anyway.

    A watched frame is not read for its checks: they are observed metrics of the
    plan it is part of. A frame that a plan reads twice, or a task that runs
    again, may count a failing row more than once; none failing stays zero, which
    is what a gate asks for. Watch frames of a session made for it
    (``session.sibling``).
    """

    def __init__(self) -> None:
        self._watched: list[tuple[list[Check], Observation]] = []

    @staticmethod
    def can_watch(check: Check) -> bool:
        return check.kind in (NOT_NULL, BETWEEN, IN_SET, NOT_CONSTANT)

    def watch(self, df: DataFrame, checks: Iterable[Check]) -> DataFrame:
        """``df``, its checks counted by the next action on it or on what is made from it."""
        checks = list(checks)
        if not checks:
            return df
        observation = Observation(f"checks_{uuid.uuid4().hex}")
        self._watched.append((checks, observation))
        counts = [_failing_rows(c).cast("bigint").alias(f"c{i}") for i, c in enumerate(checks)]
        return df.observe(observation, *counts)

    def found(self) -> dict[Check, int]:
        """Failing rows per check that was counted; to be called after the actions.

        Where Spark has proved a plan empty before it ran, it has no metrics to
        give: its checks are not among the result.
        """
        counted = {}
        for checks, observation in self._watched:
            try:
                metrics = observation.get
            except Py4JJavaError:
                continue
            counted.update({c: metrics[f"c{i}"] for i, c in enumerate(checks)})
        return counted

    def require_passed(self, models: Mapping[str, DataFrame]) -> None:
        """Raise if a watched check failed; those that no plan counted are run on ``models``."""
        counted = self.found()
        _raise_for([f"{c.model}.{c.label} {c.kind}" for c, rows in counted.items() if rows])
        rest = [c for checks, _ in self._watched for c in checks if c not in counted]
        if rest:
            require_passed(run_checks(models, rest))


def checks_of(*kinds: str) -> list[Check]:
    return [check for check in CHECKS if check.kind in kinds]


class QualityError(RuntimeError):
    pass


def require_passed(results: DataFrame) -> None:
    """Raise if a check failed, so that a load can stop before publishing."""
    failed = results.where("failing_rows > 0").collect()  # at most one row per check
    _raise_for([f"{r.model}.{r.column_name} {r.check_kind}" for r in failed])


def _raise_for(failed: list[str]) -> None:
    if failed:
        raise QualityError(f"{len(failed)} quality checks failed: {', '.join(failed)}")


def orphans(child: DataFrame, parent: DataFrame, key: str, relation: str) -> DataFrame:
    """Rows and distinct keys of ``child`` whose key ``parent`` does not have.

    Child rows are counted per key first: the join sees each key once, so neither
    a frequent key nor a frequent orphan makes a large partition.
    """
    per_key = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    missing = per_key.join(parent.select(key), key, "left_anti")
    return missing.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
        F.count("*").alias("orphan_keys"),
    ).select(F.lit(relation).alias("relation"), "orphan_rows", "orphan_keys")


def key_type_agreement(relations: Mapping[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Per relation, the stored types of both keys and whether they agree.

    Takes frames over files read without a declared schema; nothing is scanned.
    """
    spark = next(iter(relations.values()))[0].sparkSession
    rows = []
    for name, (child, child_key, parent, parent_key) in relations.items():
        types = _stored_type(child, child_key), _stored_type(parent, parent_key)
        rows.append((name, *types, int(types[0] != types[1])))
    return spark.createDataFrame(
        rows, "relation string, child_type string, parent_type string, failing_rows bigint"
    )


def key_sequence(df: DataFrame, key: str) -> DataFrame:
    """Whether a key runs without gap or repetition from its minimum."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    first, last = F.min(key), F.max(key)
    return counts.agg(
        first.alias("first_key"),
        last.alias("last_key"),
        (last - first + 1 - F.count("*")).alias("missing_keys"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
    )


def category_risk_consistency(merchants: DataFrame) -> DataFrame:
    """Merchants per category, unknown categories and scores off the fixed map."""
    category, score = F.col("Category"), F.col("MerchantRiskScore")
    known = or_false(category.isin(*CATEGORY_RISK))
    return merchants.groupBy(category.alias("category")).agg(
        F.count("*").alias("merchants"),
        F.count_if(~known).alias("unknown_category"),
        F.count_if(~score.eqNullSafe(category_risk(category))).alias("score_mismatch"),
    )


def ingestion_skew(models: Mapping[str, DataFrame], tolerance_seconds: int = 10) -> DataFrame:
    """Latest load time per model, and how far the models lie apart."""
    return _apart({name: (df, F.col("ingestion_date")) for name, df in models.items()}, tolerance_seconds)


def file_load_skew(tables: Mapping[str, DataFrame], tolerance_seconds: int = 10) -> DataFrame:
    """The same by the times at which the tables' files were stored, as the file system has them.

    ``tables`` are frames that read files directly. No column of theirs is read.
    A table's latest file counts; one without rows tells nothing.
    """
    stored = F.col("_metadata.file_modification_time").cast("timestamp_ntz")
    return _apart({name: (df, stored) for name, df in tables.items()}, tolerance_seconds)


def _apart(loads: Mapping[str, tuple[DataFrame, Column]], tolerance_seconds: int) -> DataFrame:
    latest = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.max(loaded).alias("latest_load")).select(F.lit(name).alias("model"), "latest_load")
            for name, (df, loaded) in loads.items()
        ],
    )
    apart = latest.agg(
        F.min("latest_load").alias("first_load"), F.max("latest_load").alias("last_load")
    )
    seconds = F.timestamp_diff("SECOND", F.col("first_load"), F.col("last_load"))
    return apart.select(
        "first_load",
        "last_load",
        seconds.alias("skew_seconds"),
        (seconds >= tolerance_seconds).cast("bigint").alias("failing_rows"),
    )


def require_loaded_together(tables: Mapping[str, DataFrame], tolerance_seconds: int) -> None:
    """Raise if some table's files are older than another's by the tolerance or more."""
    found = file_load_skew(tables, tolerance_seconds).first()
    if found.failing_rows:
        raise QualityError(f"the tables were loaded {found.skew_seconds} seconds apart")


def column_profile(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Minimum, maximum, distinct values and nulls per column, from one scan.

    Values are counted per column before the shuffle (``value_counts``), so what
    travels is a row per task and distinct value, one column wide. Counting all
    distinct values in one plain aggregate would send every row once per column,
    as wide as the table. Values are compared in their own type and shown as text.
    """
    columns = list(dict.fromkeys(columns))
    counts = value_counts(df, [(name,) for name in columns])
    figures = []
    for i, name in enumerate(columns):
        # Null in the rows of the other columns, so minimum and maximum see only this one.
        value, own = F.col(f"`{name}`"), F.col("_key") == i
        figures.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.min(value).cast("string").alias("min_value"),
                F.max(value).cast("string").alias("max_value"),
                F.count(value).alias("distinct_values"),
                F.coalesce(F.sum(F.when(own & value.isNull(), F.col("_n"))), F.lit(0)).alias(
                    "null_values"
                ),
            ).alias(f"p{i}")
        )
    one_row = counts.agg(*figures)
    return one_row.select(F.inline(F.array(*[f"p{i}" for i in range(len(columns))])))
