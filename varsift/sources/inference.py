"""Types of result columns guessed from their cells (A6), for result files of any origin.

A column's cells have a level in a lattice that merges: nothing < whole number (64 bits) < decimal (38 digits) < double
< text, next to true/false and to JSON arrays and objects, which join anything else as text. The level of a cell is one
bit, so the level of a column is a bitwise or over all cells: one aggregate over all columns of all files, partial in
every task. Cells are rows there (number of the column, text), so that the levels are one short piece of generated code
for any number of columns. Columns that may be JSON, and these only, are then parsed once and merged by Spark's schema
aggregate, for each run and (with more than one run) for all. Only one row a run and column reaches the driver.

Cells are read as they can be written back: ``007``, ``+5`` and ``True`` are text; a column with nothing but null texts
and empty cells is text.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOOL, LONG, DECIMAL, DOUBLE, JSON, TEXT = (1 << k for k in range(6))
_NUMBERS = LONG | DECIMAL | DOUBLE
_WHOLE = r"^-?(0|[1-9][0-9]{0,37})$"
_REAL = r"^-?[0-9]+(\.[0-9]*)?([eE][+-]?[0-9]+)?$|^-?\.[0-9]+([eE][+-]?[0-9]+)?$"
_LEADING_ZERO = r"^-?0[0-9]"
_JSON = r"^\s*[\[{]"
#: Characters that no text but a number or JSON begins with (line breaks and blanks may come before JSON).
_MARKS = list("-.0123456789[{ \t\n\x0b\f\r")


def _json(cell: Column) -> Column:
    return F.try_parse_json(F.when(cell.rlike(_JSON), cell))


def _rough_level(cell: Column) -> Column:
    """The bit of one text cell, with ``JSON`` for any text that begins like JSON; null and empty cells say nothing.

    No cast is tried on a text that it cannot read: each failing one costs an exception. Most texts are settled by their
    first character.
    """
    number = cell.try_cast(T.DecimalType(38, 0))
    small = (F.char_length(cell) <= 18) | number.between(F.lit(-(1 << 63)), F.lit((1 << 63) - 1))
    return (F.when(cell.isNull() | (cell == ""), F.lit(0))
            .when(cell.isin("true", "false"), BOOL)
            .when(~F.substring(cell, 1, 1).isin(_MARKS), TEXT)
            .when(cell.rlike(_WHOLE), F.when(small, LONG).otherwise(DECIMAL))
            .when(cell.rlike(_REAL) & ~cell.rlike(_LEADING_ZERO), DOUBLE)
            .when(cell.rlike(_JSON), JSON).otherwise(TEXT))


def cell_level(cell: Column) -> Column:
    """The bit of one text cell; null and empty cells say nothing."""
    rough = _rough_level(cell)
    return F.when((rough == JSON) & _json(cell).isNull(), TEXT).otherwise(rough)


def _ddl(schema: str) -> str:
    """A variant schema as the DDL of a column type: fractions are doubles, what has no common type is text."""
    parts = re.split(r"(`(?:[^`]|``)*`)", schema)
    for k in range(0, len(parts), 2):
        own = re.sub(r"DECIMAL\(\d+, ?0\)", "DECIMAL(38,0)", parts[k])
        own = re.sub(r"DECIMAL\(\d+, ?[1-9]\d*\)|FLOAT", "DOUBLE", own)
        parts[k] = re.sub(r"\b(VARIANT|VOID)\b", "STRING", own).replace("OBJECT<", "STRUCT<")
    return "".join(parts)


def guessed_type(level: int, schema: str | None) -> T.DataType:
    """The type of a column from its level and its merged JSON schema."""
    if level == BOOL:
        return T.BooleanType()
    if level and not level & ~_NUMBERS:
        return T.DoubleType() if level & DOUBLE else T.DecimalType(38, 0) if level & DECIMAL else T.LongType()
    if level == JSON and schema:
        try:
            kind = T.DataType.fromDDL(_ddl(schema))
        except ParseException:
            return T.StringType()
        if isinstance(kind, (T.ArrayType, T.StructType)) and not (isinstance(kind, T.StructType) and not kind.fields):
            return kind
    return T.StringType()


def _shown(cells: DataFrame, columns: Sequence[str], numbers: Sequence[int], by: Column) -> DataFrame:
    """(by, number of the column, cell) of every cell of the columns that says something, and one of no column (-1) for
    every row, so that a run without any text is known as well."""
    own = F.array(F.struct(F.lit(-1).alias("number"), F.lit("-").alias("cell")),
                  *[F.struct(F.lit(k).alias("number"), F.col(f"`{columns[k]}`").alias("cell")) for k in numbers])
    return cells.select(by.alias("by"), F.inline(own)).where("cell <> ''")


def _json_schemas(cells: DataFrame, columns: Sequence[str], numbers: Sequence[int], run: Column, many: bool
                  ) -> dict[tuple, str | None]:
    """The merged schema of the numbered columns by (total, run, number): null where some cell is not JSON."""
    parsed = _shown(cells, columns, numbers, run).withColumn("value", _json(F.col("cell")))
    asked = [F.count(F.lit(1)).alias("texts"), F.count("value").alias("read"), F.schema_of_variant_agg("value").alias("json")]
    grouped = (parsed.groupingSets([["by", "number"], ["number"]], "by", "number").agg(F.grouping("by").alias("total"), *asked)
               if many else parsed.groupBy("by", "number").agg(F.lit(0).alias("total"), *asked))
    return {(r["total"], r["by"], r["number"]): r["json"] if r["texts"] == r["read"] else None for r in grouped.collect()}


def guess_types(cells: DataFrame, columns: Sequence[str], run: Column | None = None, file: str | None = None
                ) -> tuple[dict[str, T.DataType], dict[str, dict[str, T.DataType]]]:
    """(type of each column over all rows, the same for each run) of a frame of text cells, in one aggregate, and a
    second one over the columns that may be JSON.

    ``run`` tells which run a row is from; if it follows from the column ``file`` alone, rows are counted by that first
    and ``run`` is not worked out for each of them. Null and empty cells say nothing about a type.
    """
    if not columns:
        return {}, {}
    run = F.lit("") if run is None else run
    rows = _shown(cells, columns, range(len(columns)), run if file is None else F.col(file))
    levels = rows.groupBy("by", "number").agg(F.bit_or(_rough_level(F.col("cell"))).alias("level"))
    if file is not None:
        levels = levels.withColumnRenamed("by", file).groupBy(run.alias("by"), "number").agg(F.bit_or("level").alias("level"))
    found: dict[str, dict[int, int]] = {}
    for r in levels.collect():  # one row a run and column
        found.setdefault(r["by"], {})[r["number"]] = r["level"]
    total = [0] * len(columns)
    for own in found.values():
        total = [level | own.get(k, 0) for k, level in enumerate(total)]
    maybe = [k for k in range(len(columns)) if any(own.get(k) == JSON for own in found.values())]
    schemas = _json_schemas(cells, columns, maybe, run, len(found) > 1) if maybe else {}
    runs = {name: {c: guessed_type(own.get(k, 0), schemas.get((0, name, k))) for k, c in enumerate(columns)}
            for name, own in found.items()}
    if len(found) == 1:
        return dict(next(iter(runs.values()))), runs
    return {c: guessed_type(total[k], schemas.get((1, None, k))) for k, c in enumerate(columns)}, runs


def is_nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ArrayType, T.StructType, T.MapType))


def parsed_json(text: Column, kind: T.DataType, column: str) -> Column:
    """A JSON cell as ``kind``; one that does not fit fails the read instead of becoming null."""
    value = F.from_json(text, kind, {"mode": "FAILFAST"})
    return or_unreadable(value, text, kind, column)


def or_unreadable(value: Column, text: Column, kind: T.DataType, column: str) -> Column:
    """The value of a text; a text without one fails the read. The value is worked out once."""
    message = F.concat(F.lit(f"unreadable value in column {column}: "), text)
    return F.coalesce(value, F.when(text.isNotNull(), F.raise_error(message).cast(kind)))
