"""Type boundary: what a column must be before any arithmetic touches it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facilitymetrics.schemas import DATE_LIKE


def conform(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Bring declared columns to safe types; undeclared columns pass through.

    * identifiers and other text: cast to text;
    * measures that arrive as text: parsed, unreadable text becomes null (as text, '9'
      would rank above '10');
    * floating point columns: NaN becomes null, so that it neither sorts as the largest
      value nor poisons a mean.

    Numeric columns keep their own numeric type.
    """
    changed = _changed(df, declared)
    return df.withColumns(changed) if changed else df


def lost_values(df: DataFrame, declared: T.StructType) -> dict[str, Column]:
    """For each declared column that ``conform`` changes, the number of values that it turns into null."""
    return {
        name: F.count_if(F.col(f"`{name}`").isNotNull() & fixed.isNull())
        for name, fixed in _changed(df, declared).items()
    }


def _changed(df: DataFrame, declared: T.StructType) -> dict[str, Column]:
    targets = {field.name.lower(): field.dataType for field in declared.fields}
    changed: dict[str, Column] = {}
    for field in df.schema.fields:
        target = targets.get(field.name.lower())
        if target is None or field.name.lower() in DATE_LIKE:
            continue
        fixed = _conformed(F.col(f"`{field.name}`"), field.dataType, target)
        if fixed is not None:
            changed[field.name] = fixed
    return changed


def _conformed(column: Column, have: T.DataType, want: T.DataType) -> Column | None:
    if isinstance(want, T.StringType):
        return None if isinstance(have, T.StringType) else column.cast("string")
    if isinstance(have, T.StringType):
        if isinstance(want, T.DateType):
            return column.try_cast("date")
        number = column.try_cast("double")
        number = F.when(~F.isnan(number), number)
        return number.try_cast("int") if isinstance(want, T.IntegerType) else number
    if isinstance(have, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(column), column)
    return None
