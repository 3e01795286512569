"""Flattening, exploding, renaming and splitting of decoded records."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pick(rows: DataFrame, paths: Mapping[str, str], *, keep: Iterable[str] = ()) -> DataFrame:
    """``paths`` maps output column to nested path; one projection however deep the paths are."""
    return rows.select(*keep, *[F.col(path).alias(name) for name, path in paths.items()])


def leaf_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """Dotted paths of all non-struct fields, in schema order."""
    paths: list[str] = []
    for field in schema.fields:
        path = f"{prefix}`{field.name}`"
        if isinstance(field.dataType, T.StructType):
            paths += leaf_paths(field.dataType, f"{path}.")
        else:
            paths.append(path)
    return paths


def flatten(rows: DataFrame) -> DataFrame:
    """Every nested struct as flat columns named by leaf; a leaf name used twice keeps its whole path."""
    paths = leaf_paths(rows.schema)
    parts = [path.strip("`").split("`.`") for path in paths]
    uses = Counter(part[-1].lower() for part in parts)
    names = [part[-1] if uses[part[-1].lower()] == 1 else "_".join(part) for part in parts]
    _refuse_duplicates(names)
    return rows.select(*[F.col(path).alias(name) for path, name in zip(paths, names)])


def expand_siblings(rows: DataFrame, structs: Mapping[str, str], *, keep: Iterable[str] = ()) -> DataFrame:
    """The fields of several sibling structs side by side; ``structs`` maps struct path to column prefix."""
    keep = list(keep)
    columns = [(name, F.col(name)) for name in keep]
    for path, prefix in structs.items():
        fields = rows.select(path).schema.fields[0].dataType.names
        columns += [(f"{prefix}{name}", F.col(f"{path}.`{name}`")) for name in fields]
    _refuse_duplicates([name for name, _ in columns])
    return rows.select(*[column.alias(name) for name, column in columns])


def explode_rows(
    rows: DataFrame, array: str, into: str = "element", *, outer: bool = False, position: str | None = None
) -> DataFrame:
    """One row per element of ``array`` in a struct-or-scalar column ``into``, other columns kept.

    An empty or null array gives no row, or one row with a null element when ``outer``. ``position`` names an
    element-number column. The outer generator with a position test gives the same rows as a plain explode,
    without the size test that Catalyst would otherwise run on the array's source expression.
    """
    pos = position or "_pos"
    rows = rows.select("*", F.posexplode_outer(array).alias(pos, into))
    if not outer:
        rows = rows.filter(F.col(pos).isNotNull())
    return rows if position else rows.drop(pos)


def element_columns(rows: DataFrame, element: str = "element") -> DataFrame:
    """The fields of an exploded struct as columns, in place of the struct."""
    return rows.select(*[name for name in rows.columns if name != element], f"{element}.*")


def parallel_arrays(rows: DataFrame, array: str, fields: Mapping[str, str]) -> DataFrame:
    """Fields of a repeated group as parallel array columns, without exploding it."""
    kept = [name for name in rows.columns if name != array]
    return rows.select(*kept, *[F.col(f"{array}.{field}").alias(name) for name, field in fields.items()])


def lower_names(rows: DataFrame) -> DataFrame:
    """Lower-case column names."""
    names = [name.lower() for name in rows.columns]
    _refuse_duplicates(names)
    return rows.toDF(*names)


def rename(rows: DataFrame, names: Mapping[str, str], *, strict: bool = True) -> DataFrame:
    """Rename columns; an unknown name is an error unless ``strict`` is off."""
    missing = [name for name in names if name not in rows.columns]
    if strict and missing:
        raise ValueError(f"no such columns to rename: {', '.join(missing)}")
    _refuse_duplicates([names.get(name, name) for name in rows.columns])
    return rows.withColumnsRenamed(dict(names))


def drop(rows: DataFrame, *names: str) -> DataFrame:
    """Drop columns; a dotted name drops the field inside its struct."""
    nested = [name for name in names if "." in name and name not in rows.columns]
    for name in nested:
        struct, _, field = name.partition(".")
        rows = rows.withColumn(struct, F.col(struct).dropFields(field))
    return rows.drop(*[name for name in names if name not in nested])


def require(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows in which every named column is present."""
    for column in columns:
        rows = rows.filter(F.col(column).isNotNull())
    return rows


def split_change(
    rows: DataFrame,
    fields: Mapping[str, str],
    *,
    keep: Iterable[str] = (),
    previous: str = "previous",
    current: str = "current",
) -> DataFrame:
    """Both images of a change record as prefixed columns of one row; no join, so nothing can multiply."""
    sides = {
        f"{prefix}_{name}": f"{path}.{field}"
        for prefix, path in (("previous", previous), ("current", current))
        for name, field in fields.items()
    }
    return pick(rows, sides, keep=keep)


def _refuse_duplicates(names: list[str]) -> None:
    twice = [name for name, n in Counter(name.lower() for name in names).items() if n > 1]
    if twice:
        raise ValueError(f"columns would share a name: {', '.join(twice)}")
