"""Declarative quality rules, applied in one pass.

A ruleset is an ordered list.  Every row carries the message of the first rule it
breaks; a row that broke one rule is out of the game for the later ones, so a
duplicate can only be displaced by a row that passed the rules before.  Nothing
is counted or collected: accepted and rejected rows are two filters on the same
tagged frame, and together they are exactly the input.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions.time import clock
from silverlode.operators.dedupe import RANK, RECENCY, rank_within_key
from silverlode.operators.skew import spread_lane

# Status labels and names of the validation columns.
PASSED, FAILED = "PASSED", "FAILED"
STATUS, CHECKED_AT, MESSAGE = "validation_status", "validation_timestamp", "error_message"

_VERDICT, _SLOT = "_verdict", "_slot"


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _reject(df: DataFrame, broken: Column, message: str) -> DataFrame:
    """Give ``message`` to rows that break a rule and have no message yet."""
    return df.withColumn(_VERDICT, F.coalesce(_VERDICT, F.when(broken, F.lit(message))))


@dataclass(frozen=True)
class NotNull:
    """Every listed column must have a value.  Empty text and NaN are values."""

    columns: list[str]
    message: str = "Null values in required fields"

    def broken(self) -> Column:
        return _any([F.col(c).isNull() for c in self.columns])

    def apply(self, df: DataFrame) -> DataFrame:
        return _reject(df, self.broken(), self.message)


@dataclass(frozen=True)
class Unique:
    """One row per key survives: the newest."""

    keys: list[str]
    newest_by: str = RECENCY
    ties: list[str] | None = None
    message: str | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        ties = self.ties
        if ties is None:
            ties = [c for c, t in df.dtypes
                    if c not in self.keys and c not in (self.newest_by, _VERDICT) and not t.startswith("map")]
        ranked = rank_within_key(
            df, self.keys, self.newest_by, ties, alive=F.col(_VERDICT).isNull())
        message = self.message or f"Duplicate {', '.join(self.keys)}"
        return _reject(ranked, F.col(RANK) > 1, message).drop(RANK)


@dataclass(frozen=True)
class Range:
    """Inclusive bounds.  A missing value is reported under its own message."""

    column: str
    low: float | None = None
    high: float | None = None

    def broken(self) -> Column:
        value, out = F.col(self.column), []
        if self.low is not None:
            out.append(value < self.low)
        if self.high is not None:
            out.append(value > self.high)
        return _any(out) if out else F.lit(False)

    @property
    def message(self) -> str:
        bounds = []
        if self.low is not None:
            bounds.append(f">= {self.low}")
        if self.high is not None:
            bounds.append(f"<= {self.high}")
        return f"{self.column} must be {' and '.join(bounds)}"

    @property
    def null_message(self) -> str:
        return f"{self.column} is null"

    def apply(self, df: DataFrame) -> DataFrame:
        if self.low is None and self.high is None:
            return df
        flagged = _reject(df, self.broken(), self.message)
        return _reject(flagged, F.col(self.column).isNull(), self.null_message)


@dataclass(frozen=True)
class ForeignKey:
    """The value must exist in the reference.

    Only values that the reference lacks are looked for in the rows: the distinct values of the
    ``source`` (the frame before any rule; its other columns are not read) without those of the reference,
    which is never broadcast for that (Spark would size it by its share of compressed files, far too low).
    Adaptive execution broadcasts them if their measured size allows, and then no row is
    shuffled.  Otherwise rows that need no lookup are spread by their input partition, and a hot value is split.
    """

    column: str
    reference: DataFrame
    ref_column: str | None = None

    @property
    def message(self) -> str:
        return f"Invalid {self.column}"

    def apply(self, df: DataFrame, source: DataFrame | None = None) -> DataFrame:
        known = (
            self.reference.select(F.col(self.ref_column or self.column).alias("_ref"))
            .where(F.col("_ref").isNotNull())
        )
        value = F.col(self.column)
        # an aggregate's zero, not a constant: it stays a key of the join beside the value, so the lookup
        # has a shuffle of its own and adaptive execution can split the rows' side
        given = (df if source is None else source).select(value.alias("_value")).where("_value IS NOT NULL")
        lacking = given.groupBy("_value").agg(F.min(F.lit(0)).alias("_zero")).join(
            known.hint("merge"), F.col("_value") == F.col("_ref"), "left_anti")
        needed = F.col(_VERDICT).isNull() & value.isNotNull()
        slotted = df.withColumn(_SLOT, F.when(needed, 0).otherwise(spread_lane() + 1))
        joined = slotted.join(lacking, (value == F.col("_value")) & (F.col(_SLOT) == F.col("_zero")), "left")
        return _reject(joined, value.isNull() | F.col("_zero").isNotNull(), self.message).drop("_value", "_zero", _SLOT)


@dataclass(frozen=True)
class Parses:
    """Text must be readable as a Spark type; NULL is left to ``NotNull``."""

    column: str
    type_name: str

    @property
    def message(self) -> str:
        return f"{self.column} is not a valid {self.type_name}"

    def apply(self, df: DataFrame) -> DataFrame:
        value = F.col(self.column)
        return _reject(df, value.isNotNull() & value.try_cast(self.type_name).isNull(), self.message)


@dataclass(frozen=True)
class Readable:
    """The raw text must have fitted the declared columns.  The reader leaves the text of rows that did
    not in a column of its own, which goes to quarantine with them."""

    column: str

    @property
    def message(self) -> str:
        return "Unreadable text"

    def apply(self, df: DataFrame) -> DataFrame:
        return _reject(df, F.col(self.column).isNotNull(), self.message)


Rule = NotNull | Unique | Range | ForeignKey | Parses | Readable


@dataclass(frozen=True)
class Ruleset:
    """``strict_parity`` leaves out rows whose range-checked value is missing
    (three-valued logic puts them on neither side); the default keeps them as
    rejects."""

    rules: list[Rule]
    strict_parity: bool = False
    extra: dict[str, str] = field(default_factory=dict)

    def tag(self, df: DataFrame, now: dt.datetime | None = None) -> DataFrame:
        tagged = df.withColumn(_VERDICT, F.lit(None).cast("string"))
        for rule in self.rules:
            tagged = rule.apply(tagged, df) if isinstance(rule, ForeignKey) else rule.apply(tagged)
        if self.strict_parity:
            silent = [r.null_message for r in self.rules if isinstance(r, Range)]
            if silent:
                tagged = tagged.where(F.col(_VERDICT).isNull() | ~F.col(_VERDICT).isin(silent))
        return stamp_verdict(tagged, F.col(_VERDICT), now).select(
            *df.columns, STATUS, CHECKED_AT, MESSAGE)

    def split(self, df: DataFrame, now: dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
        return split_tagged(self.tag(df, now))


def stamp_verdict(df: DataFrame, message: Column, now: dt.datetime | None = None) -> DataFrame:
    """Add the validation columns; a row passes when it has no (or an empty) message."""
    text = F.nullif(message, F.lit(""))
    return df.withColumns({
        STATUS: F.when(text.isNull(), F.lit(PASSED)).otherwise(F.lit(FAILED)),
        CHECKED_AT: clock(now),
        MESSAGE: text,
    })


def split_tagged(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    return tagged.where(F.col(STATUS) == PASSED), tagged.where(F.col(STATUS) == FAILED)


def verdict_counts(tagged: DataFrame) -> DataFrame:
    """Rows per message; the accepted rows are counted under NULL."""
    return tagged.groupBy(STATUS, MESSAGE).agg(F.count(F.lit(1)).alias("row_count"))


# Single rules as (accepted, rejected) pairs -----------------------------------

def split_nulls(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    broken = NotNull(columns).broken()
    return df.where(~broken), df.where(broken)


def split_range(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None,
    strict_parity: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Without bounds every row is accepted.  A missing value is rejected, or with
    ``strict_parity`` on neither side."""
    if low is None and high is None:
        return df, df.where(F.lit(False))
    broken = Range(column, low, high).broken()
    rejected = broken if strict_parity else F.coalesce(broken, F.lit(True))
    return df.where(~broken), df.where(rejected)


def split_foreign_key(
    df: DataFrame, column: str, reference: DataFrame, ref_column: str
) -> tuple[DataFrame, DataFrame]:
    known = reference.select(F.col(ref_column).alias("_ref")).distinct()
    match = F.col(column) == F.col("_ref")
    return df.join(known, match, "left_semi"), df.join(known, match, "left_anti")


# The rulesets of the three entities -------------------------------------------

def transaction_rules(
    customers: DataFrame | None = None,
    products: DataFrame | None = None,
    ties: list[str] | None = None,
    strict_parity: bool = False,
) -> Ruleset:
    rules: list[Rule] = [
        NotNull(["transaction_id", "customer_id", "product_id", "final_amount"]),
        Unique(["transaction_id"], ties=ties),
        Range("final_amount", low=0),
        Range("quantity", low=1),
    ]
    if customers is not None:
        rules.append(ForeignKey("customer_id", customers))
    if products is not None:
        rules.append(ForeignKey("product_id", products))
    return Ruleset(rules, strict_parity)


def customer_rules(ties: list[str] | None = None) -> Ruleset:
    return Ruleset([
        NotNull(["customer_id", "customer_name", "email"]),
        Unique(["customer_id"], ties=ties),
    ])


def product_rules(
    ties: list[str] | None = None, strict_parity: bool = False
) -> Ruleset:
    return Ruleset([
        NotNull(["product_id", "product_name", "price"]),
        Unique(["product_id"], ties=ties),
        Range("price", low=0),
    ], strict_parity)
