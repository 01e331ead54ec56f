"""Column profiles: row, null and distinct counts, minimum and maximum.

A table is read twice whatever its column count: by a typed aggregate without a
data shuffle (counts, minimum, maximum), and by one aggregate over
(table, column, value) for the exact distinct counts. The second one is shared by
all tables of a run, deduplicates on the map side and spreads each column over
its values, so neither a wide table nor a dominant value concentrates on one
task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import measures, nested

RESULT_COLUMNS = [
    "profile_run_id",
    "database_name",
    "schema_name",
    "table_name",
    "column_name",
    "data_type",
    "total_rows",
    "null_count",
    "not_null_count",
    "null_percentage",
    "distinct_count",
    "distinct_percentage",
    "min_value",
    "max_value",
    "profile_timestamp",
]

# Carriers of a value while it is counted.
VALUE = ["number", "float", "digest"]
SKETCH = "sketch"
SKETCH_BITS = 14  # of a sketch's registers: 16 kB at most, a standard error under 1 %


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(value: str) -> str:
    return nested.quoted(value)


def _is_nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def _as_number(field: T.StructField) -> str | None:
    """SQL: a bigint that is equal exactly where the values are equal, for types that allow it."""
    col = _quoted(field.name)
    if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return f"cast({col} as bigint)"
    if isinstance(field.dataType, T.DateType):
        return f"cast(unix_date({col}) as bigint)"
    if isinstance(field.dataType, T.TimestampType):
        return f"unix_micros({col})"
    if isinstance(field.dataType, T.TimestampNTZType):
        return f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', {col})"
    return None


def _as_text(field: T.StructField) -> str:
    """SQL: the SHA-256 digest of a text that is equal exactly where the values are equal."""
    col = _quoted(field.name)
    if isinstance(field.dataType, T.VariantType):
        value = f"to_json({col})"
    elif _is_nested(field.dataType):
        value = f"if({col} is null, null, to_json(named_struct('v', {col})))"
    elif isinstance(field.dataType, T.BinaryType):
        value = f"hex({col})"
    else:
        value = f"cast({col} as string)"
    return f"unhex(sha2({value}, 256))"


def _countable(field: T.StructField) -> tuple[str, str, str]:
    """SQL: the value as (bigint, double, digest), one of them filled: numbers stay numbers."""
    no_number, no_float, no_text = "cast(null as bigint)", "cast(null as double)", "cast(null as binary)"
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        # minus zero equals zero
        return no_number, f"cast({_quoted(field.name)} as double) + 0.0D", no_text
    number = _as_number(field)
    return (number, no_float, no_text) if number else (no_number, no_float, _as_text(field))


def typed_facts(table: DataFrame, blanks_are_null: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """Rows `n` and, by column number, NULLs, minimum and maximum in the column's own type: one row, or one for each `by`."""
    facts = [F.expr("count(*)").alias("n")]
    for i, field in enumerate(f for f in table.schema.fields if f.name not in by):
        col = _quoted(field.name)
        missing = f"{col} is null"
        if blanks_are_null and isinstance(field.dataType, T.StringType):
            missing += f" or length(trim({col})) = 0"
        facts.append(F.expr(f"count_if({missing})").alias(f"missing{i}"))
        if not _is_nested(field.dataType):
            facts += [F.expr(f"{end}({col})").alias(f"{end}{i}") for end in ("min", "max")]
    return table.groupBy(*by).agg(*facts)


def merged_facts(facts: DataFrame, schema: T.StructType) -> DataFrame:
    """The one row of `typed_facts` for all rows together, from rows for parts of them (none: an empty table)."""
    merged = [F.expr("coalesce(sum(n), 0L)").alias("n")]
    for i, field in enumerate(schema.fields):
        merged.append(F.expr(f"coalesce(sum(missing{i}), 0L)").alias(f"missing{i}"))
        if not _is_nested(field.dataType):
            merged += [F.expr(f"{end}({end}{i})").alias(f"{end}{i}") for end in ("min", "max")]
    return facts.agg(*merged)


def _column_rows(facts: DataFrame, schema: T.StructType, name: str, start: int) -> DataFrame:
    """Per column: type, rows, nulls, minimum and maximum as text."""
    rows = []
    for i, field in enumerate(schema.fields):
        ends = ["cast(null as string)"] * 2
        if not _is_nested(field.dataType):
            ends = [f"cast(min{i} as string)", f"cast(max{i} as string)"]
        kind = _literal(field.dataType.simpleString())
        rows.append(", ".join([str(start + i), _literal(field.name), kind, "n", f"missing{i}", *ends]))
    columns = "slot, column_name, data_type, total_rows, null_count, min_value, max_value"
    stacked = f"stack({len(rows)}, {', '.join(rows)}) as ({columns})"
    return facts.selectExpr(f"{_literal(name)} as table_name", stacked)


def column_values(table: DataFrame, start: int = 0, by: Sequence[str] = ()) -> DataFrame:
    """Every non-NULL value as a (slot, value) row, with the columns `by`; slots number the other columns from `start`."""
    fields = [f for f in table.schema.fields if f.name not in by]
    entries = ", ".join(f"{start + i}, {', '.join(_countable(f))}" for i, f in enumerate(fields))
    stacked = f"stack({len(fields)}, {entries}) as (slot, {', '.join(VALUE)})"
    return table.selectExpr(*by, stacked).where(" or ".join(f"{v} is not null" for v in VALUE))


def _stacked(frames: list[DataFrame]) -> DataFrame:
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionAll(frame)
    return merged


def _starts(schemas: Mapping[str, T.StructType]) -> dict[str, int]:
    """First column slot of each table."""
    starts, total = {}, 0
    for name, schema in schemas.items():
        starts[name] = total
        total += len(schema)
    return starts


def _counted(values: DataFrame, approximate: bool = False) -> DataFrame:
    """(slot, distinct_count) of every column that has a value."""
    if approximate:
        return values.groupBy("slot").agg(
            F.approx_count_distinct(F.struct(*VALUE)).alias("distinct_count")
        )
    return values.distinct().groupBy("slot").agg(F.count("*").alias("distinct_count"))


def column_sketches(table: DataFrame, by: Sequence[str] = (), bits: int = SKETCH_BITS) -> DataFrame:
    """One (slot, sketch) row for each column that has a value, with the columns `by`; sketches merge, their size is bounded.

    Counts of up to some hundred distinct values come out exact, larger ones with a standard error of about 1/2^(bits/2).
    """
    value = F.coalesce(F.col("number").cast("string"), F.col("float").cast("string"), F.hex("digest"))
    return column_values(table, by=by).groupBy(*by, "slot").agg(F.hll_sketch_agg(value, bits).alias(SKETCH))


def _estimated(sketches: DataFrame) -> DataFrame:
    """(slot, distinct_count) from the merged sketches of each column."""
    return sketches.groupBy("slot").agg(F.hll_sketch_estimate(F.hll_union_agg(SKETCH)).alias("distinct_count"))


def profile_tables(
    tables: Mapping[str, DataFrame],
    *,
    run_id: str,
    database: str = "",
    schema: str = "",
    blanks_are_null: bool = True,
    approximate: bool = False,
    taken_at: Column | None = None,
) -> DataFrame:
    """One row per column of every table, in the layout of `RESULT_COLUMNS`.

    `blanks_are_null` counts blank text as null, while the distinct count still
    takes it as a value. Nested columns have no minimum or maximum.
    """
    starts = _starts({n: t.schema for n, t in tables.items()})
    typed = [_column_rows(typed_facts(t, blanks_are_null), t.schema, n, starts[n]) for n, t in tables.items()]
    values = _stacked([column_values(t, starts[n]) for n, t in tables.items()])
    return _results(_stacked(typed), _counted(values, approximate), run_id, database, schema, taken_at)


def profile_states(
    states: Mapping[str, tuple[T.StructType, DataFrame, DataFrame]],
    *,
    run_id: str,
    database: str = "",
    schema: str = "",
    taken_at: Column | None = None,
) -> DataFrame:
    """As `profile_tables`, from each table's schema, `typed_facts` of its parts and `column_values` or `column_sketches` of its parts."""
    starts = _starts({n: kind for n, (kind, _, _) in states.items()})
    typed = [_column_rows(merged_facts(facts, kind), kind, n, starts[n]) for n, (kind, facts, _) in states.items()]
    counted = []
    for columns, count in ((VALUE, _counted), ([SKETCH], _estimated)):
        rows = [
            kept.select((F.col("slot") + starts[n]).alias("slot"), *columns)
            for n, (_, _, kept) in states.items() if set(columns) <= set(kept.columns)
        ]
        if rows:
            counted.append(count(_stacked(rows)))
    return _results(_stacked(typed), _stacked(counted), run_id, database, schema, taken_at)


def _results(
    typed: DataFrame, counts: DataFrame, run_id: str, database: str, schema: str, taken_at: Column | None
) -> DataFrame:
    joined = typed.join(counts, "slot", "left")
    filled = F.col("total_rows") - F.col("null_count")
    distinct = F.coalesce("distinct_count", F.lit(0).cast("bigint"))
    return joined.select(
        F.lit(run_id).alias("profile_run_id"),
        F.lit(database).alias("database_name"),
        F.lit(schema).alias("schema_name"),
        "table_name",
        "column_name",
        "data_type",
        "total_rows",
        "null_count",
        filled.alias("not_null_count"),
        measures.percent_of(F.col("null_count"), F.col("total_rows")).alias("null_percentage"),
        distinct.alias("distinct_count"),
        measures.percent_of(distinct, filled).alias("distinct_percentage"),
        "min_value",
        "max_value",
        (F.current_timestamp() if taken_at is None else taken_at).alias("profile_timestamp"),
    )
