"""Data-quality checks. A check is a frame of rows (check_name, passed, message, details), where
``details`` is JSON text; all checks of one table share one aggregation pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalith.functions.names import col
from medalith.functions.values import AUDIT_COLUMNS
from medalith.functions.values import CHECK_MESSAGES as MESSAGES

SAMPLE_SIZE = 10


def check_row(df: DataFrame, name: Column, passed: Column, message: Column, details: list) -> DataFrame:
    return df.select(
        name.alias("check_name"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        message.alias("message"),
        F.to_json(F.struct(*details)).alias("details"),
    )


def union_checks(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def _one_row(*rows: DataFrame) -> DataFrame:
    """One-row frames with different columns side by side, without a join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def check_row_counts(
    old: DataFrame, new: DataFrame, name: str, tolerance: float | None = None, shrink_only: bool = False
) -> DataFrame:
    """Row counts are equal, or differ by less than ``tolerance`` of the old count; with
    ``shrink_only`` the new table must be smaller, by less than the tolerance."""
    counts = _one_row(_count(old, "old_count"), _count(new, "new_count"))
    counts = counts.withColumn("diff", F.col("new_count") - F.col("old_count"))
    share = F.when(F.col("old_count") > 0, F.abs("diff") / F.col("old_count")).otherwise(F.lit(0.0))
    if tolerance is None:
        passed = F.col("diff") == 0
    else:
        passed = (share < tolerance) & ((F.col("diff") < 0) if shrink_only else F.lit(True))
    return check_row(
        counts,
        name=F.lit(f"Row count: {name}"),
        passed=passed,
        message=F.format_string(MESSAGES["counts"], "old_count", "new_count"),
        details=["old_count", "new_count", "diff"],
    )


def value_sides(left: DataFrame, left_column: str, right: DataFrame, right_column: str) -> DataFrame:
    """Each non-null value of either column with its row count on both sides.

    One grouped pass over the union: rows are counted before the shuffle, so a value that fills a
    third of a table travels as one row per task.
    """

    def side(df: DataFrame, column: str, is_left: int) -> DataFrame:
        value = col(column).alias("value")
        return df.select(value, F.lit(is_left).alias("l"), F.lit(1 - is_left).alias("r"))

    both = side(left, left_column, 1).unionByName(side(right, right_column, 0))
    return (
        both.filter(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows"))
    )


def _with_samples(sides: DataFrame, aggregates: list[Column], samples: dict[str, Column]) -> DataFrame:
    """``aggregates`` over all values, plus for each name the first ten values that fulfil a condition."""
    rows = [sides.agg(*aggregates)]
    for name, condition in samples.items():
        first = sides.filter(condition).orderBy("value").limit(SAMPLE_SIZE)
        # A list of ten values at most.
        rows.append(first.agg(F.sort_array(F.collect_list(F.col("value").cast("string"))).alias(name)))
    return _one_row(*rows)


def check_values_preserved(
    old: DataFrame, old_column: str, new: DataFrame, new_column: str, name: str
) -> DataFrame:
    """Every value of the old column occurs in the new one; also counts and samples the added ones."""
    sides = value_sides(old, old_column, new, new_column)
    gone = (F.col("left_rows") > 0) & (F.col("right_rows") == 0)
    added = (F.col("left_rows") == 0) & (F.col("right_rows") > 0)
    totals = _with_samples(
        sides,
        [
            F.count_if(F.col("left_rows") > 0).alias("old_unique_count"),
            F.count_if(F.col("right_rows") > 0).alias("new_unique_count"),
            F.count_if(gone).alias("missing_count"),
            F.count_if(added).alias("added_count"),
        ],
        {"missing_samples": gone, "added_samples": added},
    )
    passed = F.col("missing_count") == 0
    return check_row(
        totals,
        name=F.lit(f"Unique values: {name}"),
        passed=passed,
        message=F.when(
            passed, F.format_string(MESSAGES["preserved"], "old_unique_count")
        ).otherwise(F.format_string(MESSAGES["missing"], "missing_count")),
        details=[
            "old_unique_count", "new_unique_count", "missing_count", "added_count",
            "missing_samples", "added_samples",
        ],
    )


def check_foreign_key(
    fact: DataFrame, fk: str, dimension: DataFrame, pk: str, name: str, max_orphan_ratio: float = 0.0
) -> DataFrame:
    """Non-null foreign keys occur in the dimension. ``max_orphan_ratio`` above 0 allows that share of
    the distinct keys to be orphaned. ``orphaned_rows`` counts the rows behind the orphaned keys."""
    sides = value_sides(fact, fk, dimension, pk)
    orphan = (F.col("left_rows") > 0) & (F.col("right_rows") == 0)
    totals = _with_samples(
        sides,
        [
            F.count_if(F.col("left_rows") > 0).alias("fk_count"),
            F.count_if(F.col("right_rows") > 0).alias("pk_count"),
            F.count_if(orphan).alias("orphaned_count"),
            F.coalesce(F.sum(F.when(orphan, F.col("left_rows"))), F.lit(0)).alias("orphaned_rows"),
        ],
        {"orphaned_samples": orphan},
    )
    if max_orphan_ratio > 0:
        passed = F.col("orphaned_count") < F.col("fk_count") * max_orphan_ratio
    else:
        passed = F.col("orphaned_count") == 0
    return check_row(
        totals,
        name=F.lit(f"FK: {name}"),
        passed=passed,
        message=F.when(F.col("orphaned_count") == 0, F.format_string(MESSAGES["fk_valid"], "fk_count"))
        .otherwise(F.format_string(MESSAGES["fk_orphaned"], "orphaned_count")),
        details=["fk_count", "pk_count", "orphaned_count", "orphaned_rows", "orphaned_samples"],
    )


def check_table(
    df: DataFrame,
    name: str,
    not_null: list[str] = (),
    unique: list[str] = (),
    forbidden: list[str] = (),
    rules: dict[str, Column] | None = None,
    ratios: dict[str, tuple[Column, float]] | None = None,
    audit: bool = False,
) -> DataFrame:
    """All single-table checks in one pass over the table.

    ``not_null`` columns hold no null, ``unique`` columns hold each value once and no null,
    ``forbidden`` columns are absent, every row fulfils each of ``rules`` (a null outcome does not
    count against it), each of ``ratios`` holds for at least the given share of rows, and with
    ``audit`` the four audit columns exist and are filled.
    """
    rules, ratios = dict(rules or {}), dict(ratios or {})
    audit_columns = list(AUDIT_COLUMNS) if audit else []
    present = [c for c in dict.fromkeys([*not_null, *unique, *audit_columns]) if c in df.columns]
    aggregates = [F.count(F.lit(1)).alias("total")]
    aggregates += [F.count_if(col(c).isNull()).alias(f"nulls:{c}") for c in present]
    aggregates += [F.count_distinct(col(c)).alias(f"distinct:{c}") for c in unique if c in df.columns]
    aggregates += [F.count_if(~rule).alias(f"broken:{r}") for r, rule in rules.items()]
    aggregates += [F.count_if(c).alias(f"kept:{r}") for r, (c, _) in ratios.items()]
    totals = df.agg(*aggregates)

    rows = []

    def add(check: str, passed: Column, message: Column, details: list[Column]) -> None:
        rows.append(
            F.struct(
                F.lit(check).alias("check_name"),
                F.coalesce(passed, F.lit(False)).alias("passed"),
                message.alias("message"),
                F.to_json(F.struct(*details)).alias("details"),
            )
        )

    def null_check(check: str, columns: list[str], good: str) -> None:
        gaps = [F.col(f"`nulls:{c}`").alias(c) if c in present else F.lit(None).cast("long").alias(c) for c in columns]
        bad = F.filter(
            F.array(*[F.when(F.coalesce(g != 0, F.lit(True)), F.lit(c)) for c, g in zip(columns, gaps)]),
            lambda c: c.isNotNull(),
        )
        passed = F.size(bad) == 0
        text = F.concat(F.lit(MESSAGES["nulls"]), F.concat_ws(", ", bad))
        add(check, passed, F.when(passed, F.lit(good)).otherwise(text), gaps)

    if not_null:
        null_check(f"No NULLs: {name}", list(not_null), MESSAGES["no_nulls"] % len(not_null))
    for c in unique:
        check = f"Unique key: {name}.{c}"
        if c not in df.columns:
            add(check, F.lit(False), F.lit(MESSAGES["no_column"] % c), [F.lit(c).alias("missing")])
            continue
        total, distinct, nulls = F.col("total"), F.col(f"`distinct:{c}`"), F.col(f"`nulls:{c}`")
        passed = (total == distinct) & (nulls == 0)
        add(
            check,
            passed,
            F.when(passed, F.format_string(MESSAGES["unique"], total)).otherwise(
                F.format_string(MESSAGES["duplicates"], total - distinct, nulls)
            ),
            [
                total.alias("total_count"),
                distinct.alias("unique_count"),
                nulls.alias("null_count"),
                (total - distinct).alias("duplicate_count"),
            ],
        )
    if audit_columns:
        null_check(f"Metadata columns: {name}", audit_columns, MESSAGES["audited"])
    for c in forbidden:
        gone = c not in df.columns
        add(f"Forbidden column: {name}.{c}", F.lit(gone), F.lit("absent" if gone else "present"), [F.lit(c).alias("column")])
    for r in rules:
        broken = F.col(f"`broken:{r}`")
        add(f"Rule: {name}.{r}", broken == 0, F.format_string("%d violations", broken), [broken.alias("violations")])
    for r, (_, least) in ratios.items():
        kept = F.col(f"`kept:{r}`")
        add(
            f"Ratio: {name}.{r}",
            (kept >= F.lit(least) * F.col("total")) & (F.col("total") > 0),
            F.format_string("%d of %d rows", kept, F.col("total")),
            [kept.alias("kept"), F.col("total").alias("total")],
        )
    return totals.select(F.inline(F.array(*rows)))


def quality_report(checks: DataFrame) -> DataFrame:
    """One row: how many checks ran, passed and failed, the success rate and the failed names."""
    total, passed = F.count(F.lit(1)), F.count_if("passed")
    return checks.agg(
        total.alias("total_validations"),
        passed.alias("passed"),
        (total - passed).alias("failed"),
        F.when(total > 0, F.format_string("%.1f%%", passed / total * 100)).otherwise(F.lit("N/A")).alias("success_rate"),
        # One entry per failed check; the checks are a list that the caller wrote down.
        F.concat_ws("; ", F.sort_array(F.collect_list(F.when(~F.col("passed"), F.col("check_name"))))).alias(
            "failed_validations"
        ),
    )


def check_naming(df: DataFrame, table: str, prefix: bool = True) -> DataFrame:
    """Naming rules of a table: lower case with underscores, and a ``dim_`` / ``fact_`` table name."""
    schema = df.sparkSession.createDataFrame(
        [(table, c) for c in df.columns], "table_name string, column_name string"
    )
    good = F.col("column_name").rlike("^[a-z][a-z0-9]*(_[a-z0-9]+)*$")
    if prefix:
        good &= F.col("table_name").rlike("^(dim|fact)_")
    return schema.withColumn("passed", good)
