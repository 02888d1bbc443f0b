"""Column names, casts to a table's schema and numeric harmonisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchtide.model import LINEAGE_COLUMNS, TableSpec


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trim and lower every name; blanks and hyphens become underscores."""
    names = [c.strip().lower().replace(" ", "_").replace("-", "_") for c in df.columns]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"column names collide after normalisation: {repeated}")
    return df.toDF(*names)


def cast_to_schema(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Project to the table's columns in order.

    A value that cannot be cast becomes NULL, a missing column a typed NULL, an
    unknown column is dropped; lineage columns pass through when present.
    """
    df = normalize_columns(df)
    present = set(df.columns)
    kinds = dict(df.dtypes)

    def typed_value(name: str, kind: T.DataType) -> Column:
        if name not in present:
            return F.lit(None).cast(kind)
        value = F.col(name).try_cast(kind)
        if isinstance(kind, T.IntegralType) and kinds[name] == "string":
            # Text such as 12.0 is a number too; its fraction is cut off.
            return F.coalesce(value, F.col(name).try_cast("double").try_cast(kind))
        return value

    typed = [typed_value(name, kind).alias(name) for name, kind in spec.columns.items()]
    return df.select(*typed, *[c for c in LINEAGE_COLUMNS if c in present])


def harmonize_numbers(df: DataFrame) -> DataFrame:
    """Decimals to double and integers to long, everything else as it is."""

    def widened(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.IntegerType):
            return F.col(field.name).cast("long").alias(field.name)
        return F.col(field.name)

    return df.select(*[widened(f) for f in df.schema])
