"""Fit rows to a table contract before they are written."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.contracts import Table
from wattline.operators.decode import ERROR


def check_contract(rows: DataFrame, table: Table, *, key: Iterable[str] | None = None) -> None:
    """Raise unless the frame has every key column and no column unknown to the table.

    This is a test of names on the driver, before any query starts; types are fitted by ``conform``.
    """
    have = [name for name in rows.columns if not name.startswith("_")]
    missing = [name for name in (key or table.key) if name not in rows.columns]
    if missing:
        raise ValueError(f"table {table.name}: key columns missing from the frame: {', '.join(missing)}")
    unknown = [name for name in have if name not in table.types]
    if unknown:
        raise ValueError(f"table {table.name}: columns unknown to the table: {', '.join(unknown)}")


def conform(
    rows: DataFrame, table: Table, *, key: Iterable[str] | None = None, errors: bool = False
) -> DataFrame:
    """The table's columns, in its order and types; columns the frame lacks are null.

    A value that does not fit its type becomes null. With ``errors`` such rows, and rows with a null key,
    say so in ``_error`` (an ``_error`` already there wins). Columns starting with ``_`` pass through.
    """
    key = tuple(key or table.key)
    check_contract(rows, table, key=key)
    have = {field.name: field.dataType.simpleString() for field in rows.schema.fields}
    passed = [name for name in rows.columns if name.startswith("_") and name not in table.types]
    fitted, failures = [], []
    for name, kind in table.types.items():
        if name not in have:
            fitted.append(F.lit(None).cast(kind).alias(name))
        elif have[name] == kind:
            fitted.append(F.col(name))
        else:
            fitted.append(F.col(name).try_cast(kind).alias(name))
            failures.append((name, F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()))
    if not errors:
        return rows.select(*[name for name in passed if name != ERROR], *fitted)
    error = F.col(ERROR) if ERROR in passed else F.lit(None).cast("string")
    for name, failed in failures:
        error = F.coalesce(error, F.when(failed, f"{name} is not {table.types[name]}"))
    for name in key:
        error = F.coalesce(error, F.when(F.col(name).isNull(), f"null key {name}"))
    return rows.select(*[name for name in passed if name != ERROR], error.alias(ERROR), *fitted)
