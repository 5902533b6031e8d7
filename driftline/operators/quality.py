"""Data-quality checks of inference snapshots: a list of rules in, a table of check rows out.

A rule says what is checked, on which column, against which limit, and what breaking it
means.  Rules are written one by one or derived from a schema; a rule without a column
stands for every column that no rule of its kind names.  Schema rules read the schema
only; row counts and null rates come from one grouped aggregate over the data (per
``group_cols``, e.g. per snapshot day).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DoubleType, FloatType, NumericType, StructType

# A column that may be empty warns above 50 % nulls; rules derived from a
# schema require every column, allow 10 % nulls and want at least 10 rows.
EMPTY_WARN_RATE = 0.5
DERIVED_NULL_RATE = 0.1
DERIVED_ROWS = 10
# the numeric pattern accepted by the coercion (plain decimal / exponent / inf / nan)
NUMERIC_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|inf|infinity|nan)\s*$"


class Rule(NamedTuple):
    check: str            # row_count, required_columns, numeric_type or null_rate
    column: str | None = None
    limit: float | None = None
    level: str = "error"


def least_rows(n: int) -> list[Rule]:
    return [Rule("row_count", limit=n)]


def required(*columns: str) -> list[Rule]:
    return [Rule("required_columns", c) for c in columns]


def numeric(*columns: str) -> list[Rule]:
    return [Rule("numeric_type", c) for c in columns]


def most_nulls(share: float, *columns: str) -> list[Rule]:
    """At most this share of nulls, in the named columns or in all others."""
    return [Rule("null_rate", c, share) for c in columns or (None,)]


def may_be_empty(*columns: str) -> list[Rule]:
    return [Rule("null_rate", c, EMPTY_WARN_RATE, "warning") for c in columns]


def rules_of_schema(schema: StructType) -> list[Rule]:
    """Every column must be there, numbers (no booleans) stay numbers, few nulls, ten rows."""
    return [*least_rows(DERIVED_ROWS), *required(*schema.names),
            *numeric(*(f.name for f in schema.fields if isinstance(f.dataType, NumericType))), *most_nulls(DERIVED_NULL_RATE)]


def _pct(rate: F.Column) -> F.Column:
    """``{rate:.1%}``: half-even to one decimal of a percent, then printed."""
    return F.format_string("%.1f%%", F.rint(rate * F.lit(1000.0)) / F.lit(10.0))


def _pct_lit(rate: float) -> str:
    return f"{rate:.1%}"


def _row(check: str, column: str | None, level: Column, observed: Column, limit: float | None, message: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), F.lit(column).cast("string").alias("column"), level.alias("level"),
                    observed.cast("double").alias("observed"), F.lit(limit).cast("double").alias("threshold"),
                    F.when(level != "ok", message).alias("message"))


def _judged(broken: Column, rule: Rule) -> Column:
    return F.when(broken, rule.level).otherwise("ok")


def _count_row(rule: Rule) -> Column:
    n = F.col("_rows")
    text = F.format_string("Snapshot has %d rows; minimum required is %d.", n, F.lit(int(rule.limit)))
    return _row(rule.check, None, _judged(n < rule.limit, rule), n, rule.limit, text)


def _required_row(rules: list[Rule], columns: list[str]) -> Column:
    """One row for all required columns together."""
    missing = [r.column for r in rules if r.column not in columns]
    level = F.lit(max((r.level for r in rules if r.column in missing), default="ok", key=("ok", "warning", "error").index))
    return _row("required_columns", None, level, F.lit(len(missing)), 0.0, F.lit(f"Missing required columns: {missing!r}"))


def _type_row(rule: Rule, kind: DataType) -> Column:
    is_number = isinstance(kind, (NumericType, BooleanType))  # booleans count as numbers here
    text = f"Column '{rule.column}' is expected to be numeric but has dtype '{kind.simpleString()}'."
    return _row(rule.check, rule.column, F.lit("ok" if is_number else rule.level), F.lit(None), None, F.lit(text))


def _null_row(rule: Rule, column: str) -> Column:
    rate = F.col(f"_n_{column}")
    if rule.level == "warning":
        text = F.concat(F.lit(f"Nullable column '{column}' has a high null rate: "), _pct(rate), F.lit("."))
    else:
        text = F.concat(F.lit(f"Column '{column}' null rate "), _pct(rate), F.lit(f" exceeds threshold {_pct_lit(rule.limit)}."))
    return _row(rule.check, column, _judged(rate > rule.limit, rule), rate, rule.limit, text)


def _empty(name: str, kind: DataType) -> Column:
    return F.col(name).isNull() | F.isnan(name) if isinstance(kind, (FloatType, DoubleType)) else F.col(name).isNull()


def check_table(df: DataFrame, rules: list[Rule], group_cols: list[str] | None = None) -> DataFrame:
    """One row per check (and group).  ``passed`` is false for errors and warnings;
    ``level`` is ``error`` / ``warning`` / ``ok``."""
    groups = list(group_cols or [])
    kinds = {f.name: f.dataType for f in df.schema.fields if f.name not in groups}
    by_check = {kind: [r for r in rules if r.check == kind] for kind in ("row_count", "required_columns", "numeric_type", "null_rate")}
    named = {r.column: r for r in by_check["null_rate"]}
    rows = [_count_row(r) for r in by_check["row_count"]]
    rows.append(_required_row(by_check["required_columns"], list(kinds)))
    rows += [_type_row(r, kinds[r.column]) for r in by_check["numeric_type"] if r.column in kinds]
    rows += [_null_row(rule, c) for c in kinds if (rule := named.get(c, named.get(None)))]
    measured = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_rows"),
                                       *[F.avg(_empty(c, kind).cast("double")).alias(f"_n_{c}") for c, kind in kinds.items()])
    out = measured.select(*groups, F.explode(F.array(*rows)).alias("r"))
    return out.select(*groups, "r.check", "r.column", "r.level", "r.observed", "r.threshold",
                      (F.col("r.level") == "ok").alias("passed"), "r.message")


def validation_summary(checks: DataFrame, group_cols: list[str]) -> DataFrame:
    """Per group: passed = no error (warnings do not fail), error / warning counts."""
    return checks.groupBy(*group_cols).agg(
        F.max(F.when(F.col("check") == "row_count", F.col("observed"))).cast("long").alias("rows_in"),
        (F.count_if(F.col("level") == "error") == 0).alias("passed"),
        F.count_if(F.col("level") == "error").alias("errors"),
        F.count_if(F.col("level") == "warning").alias("warnings"))


def stop_on_errors(checks: DataFrame) -> None:
    """Raise with the message of every failed check (a row per group and column at most)."""
    groups = [c for c in checks.columns if c not in ("check", "column", "level", "observed", "threshold", "passed", "message")]
    failed = checks.where(F.col("level") == "error").select(F.concat_ws(" ", *[F.col(g).cast("string") for g in groups], "message")).collect()
    if failed:
        raise ValueError(f"{len(failed)} snapshot checks failed:\n" + "\n".join(f"- {r[0]}" for r in sorted(failed)))


def coerce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Listed columns to DOUBLE; text that is not a number becomes NULL; columns
    that do not exist are ignored."""
    out = df
    for c in columns:
        if c not in df.columns:
            continue
        s = F.col(c).cast("string")
        num = F.when(s.rlike("(?i)" + NUMERIC_PATTERN), F.trim(s).try_cast("double"))
        out = out.withColumn(c, num)
    return out
