"""Column kinds of text sources and the schema-change check built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mastline.constants import BOOLEAN_TOKENS, EXPECTED_KINDS, REQUIRED_COLUMNS
from mastline.functions.messages import name_list, name_set
from mastline.functions.numeric import is_number_text, is_whole_text


class SchemaEvolutionError(RuntimeError):
    """A source column changed type; nothing was written."""


def _counters(df: DataFrame, column: str) -> Column:
    """How many values of one column read as each kind."""
    kind = df.schema[column].dataType
    c = F.col(column)
    present = c.isNotNull()
    if isinstance(kind, T.StringType):
        whole, number = is_whole_text(c), is_number_text(c)
        truth = c.isin(BOOLEAN_TOKENS)
    else:
        whole = present & F.lit(isinstance(kind, T.IntegralType))
        number = present & F.lit(isinstance(kind, T.NumericType))
        truth = present & F.lit(isinstance(kind, T.BooleanType))
    return F.struct(
        F.lit(column).alias("column_name"),
        F.count("*").alias("n_rows"),
        F.count_if(~present).alias("n_null"),
        F.count_if(whole).alias("n_int"),
        F.count_if(number).alias("n_float"),
        F.count_if(truth).alias("n_bool"),
    )


def _inferred_kind(at=F.col) -> Column:
    """The type a whole-file reader would infer from the counts; ``at`` gives a count by its name."""
    filled = at("n_rows") - at("n_null")
    gaps = at("n_null") > 0
    return (
        F.when(at("n_rows") == 0, "object")
        .when(filled == 0, "float64")
        .when(at("n_bool") == filled, F.when(gaps, "object").otherwise("bool"))
        .when((at("n_int") == filled) & ~gaps, "int64")
        .when(at("n_float") == filled, "float64")
        .otherwise("object")
    )


_COUNTS = "array<struct<column_name:string,n_rows:bigint,n_null:bigint,n_int:bigint,n_float:bigint,n_bool:bigint>>"


def kind_counts(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Aggregate: for each column, in order, how many values read as each kind."""
    names = [c for c in (columns or REQUIRED_COLUMNS) if c in df.columns]
    return F.array(*(_counters(df, c) for c in names)).cast(_COUNTS)


def counts_by_date(df: DataFrame, columns: list[str] | None = None, date: str = "_execution_date") -> DataFrame:
    """(execution_date, kinds): one aggregation over the scan; only counters are shuffled."""
    return df.groupBy(F.col(date).alias("execution_date")).agg(kind_counts(df, columns).alias("kinds"))


def column_kinds(df: DataFrame, columns: list[str] | None = None, date: str = "_execution_date") -> DataFrame:
    """One row per date and column: value counts by kind and the inferred kind."""
    counts = counts_by_date(df, columns, date)
    return counts.select("execution_date", F.inline("kinds")).withColumn("kind", _inferred_kind())


def _mismatch(strict: bool, at=F.col) -> Column:
    """Mismatch text of one column's counts, NULL when its kind is acceptable."""
    kind = _inferred_kind(at)
    expected = F.create_map(*(F.lit(x) for pair in EXPECTED_KINDS.items() for x in pair))[at("column_name")]
    wanted = F.when(expected == "object", "string/object").otherwise(expected)
    text = F.concat(at("column_name"), F.lit(": expected "), wanted, F.lit(", got "), kind)
    same = (
        ((expected == "int") & (kind == "int64"))
        | ((expected == "float") & (kind == "float64"))
        | ((expected == "object") & (kind == "object"))
    )
    if not strict:
        filled = at("n_rows") - at("n_null")
        same = (
            same
            | (filled == 0)
            | ((expected == "int") & (at("n_int") == filled))
            | ((expected == "float") & (at("n_float") == filled))
        )
    return F.when(~same, text)


def evolution_verdict(strict: bool = False) -> tuple[Column, Column]:
    """Status and message on a row with ``columns`` of a date's source and its ``kinds`` (NULL without rows).

    A changed type fails, a new or dropped column warns.  By default blanks in an integer column,
    whole numbers in a float column and files without rows are not changes;
    ``strict`` treats them as the whole-file type inference would.
    """
    required = F.array(*(F.lit(c) for c in REQUIRED_COLUMNS))
    added, dropped = F.array_except("columns", required), F.array_except(required, "columns")
    own = F.filter("kinds", lambda k: F.array_contains("columns", k["column_name"]))
    changed = F.filter(F.transform(own, lambda k: _mismatch(strict, lambda name: k[name])), lambda m: m.isNotNull())
    # A header without rows infers every column as object.
    empty = [f"{c}: expected {k}, got object" for c, k in EXPECTED_KINDS.items() if k != "object"] if strict else []
    untyped = F.filter(
        F.array(*map(F.lit, empty)).cast("array<string>"), lambda m: F.array_contains("columns", F.substring_index(m, ":", 1))
    )
    changed = F.coalesce(changed, untyped)
    status = F.when(F.size(changed) > 0, "fail").when((F.size(added) > 0) | (F.size(dropped) > 0), "warn").otherwise("pass")
    message = (
        F.when(
            F.size(changed) > 0,
            F.concat(
                F.lit("Column type mismatch detected: "),
                name_list(changed),
                F.lit(". Pipeline aborted to prevent data corruption."),
            ),
        )
        .when(
            F.size(added) > 0,
            F.concat(
                F.lit("New columns detected: "),
                name_set(added),
                F.lit(". Iceberg schema will be evolved automatically."),
            ),
        )
        .when(
            F.size(dropped) > 0,
            F.concat(
                F.lit("Columns no longer in source: "),
                name_set(dropped),
                F.lit(". Existing Iceberg rows will show NULL for these columns."),
            ),
        )
        .otherwise("No schema changes detected.")
    )
    return status, message


def schema_evolution(
    df: DataFrame,
    columns_by_date: DataFrame,
    date: str = "_execution_date",
    strict: bool = False,
) -> DataFrame:
    """Schema-change verdict per date: ``execution_date, check_name, status, message, failed_rows``.

    ``columns_by_date`` (``execution_date, columns``) lists each date's source
    columns; dates without rows still get a verdict.
    """
    per_date = columns_by_date.join(counts_by_date(df, date=date), "execution_date", "left")
    status, message = evolution_verdict(strict)
    return per_date.select(
        "execution_date",
        F.lit("schema_evolution").alias("check_name"),
        status.alias("status"),
        message.alias("message"),
        F.lit(0).cast("bigint").alias("failed_rows"),
    )


def require_stable_schema(verdicts: DataFrame) -> None:
    """Raise for any failing date; one row per failing date comes to the driver."""
    failed = verdicts.where("status = 'fail'").orderBy("execution_date").collect()
    if not failed:
        return
    detail = failed[0].message
    if len(failed) > 1:
        detail = "; ".join(f"{r.execution_date}: {r.message}" for r in failed)
    raise SchemaEvolutionError(f"Schema evolution check failed — aborting bronze write: {detail}")
