"""How rows lie inside a partition directory, so that one device's rows are read without its neighbours'."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.streaming.storage import row_group_options

#: Row groups are the unit that readers skip; small enough that a device's rows fill few of them.
ROW_GROUP_BYTES = 16 << 20


def clustered(
    rows: DataFrame, directories: Sequence[str], key: Sequence[str], newest: Sequence[str] = (), files: int | None = None
) -> DataFrame:
    """Rows ranged and sorted by directory, key and, newest first, time.

    A range sort on all of these: a file holds a run of keys of one or few directories, so the statistics of its row
    groups tell which keys it can hold. A hot directory, or a hot key in it, spans several files, split by time.
    ``files`` is the number of ranges; by default that of shuffle partitions, as adaptive execution sizes them.
    """
    order = [*[F.col(name) for name in (*directories, *key)], *[F.col(name).desc_nulls_last() for name in newest]]
    ranged = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def write_clustered(
    rows: DataFrame,
    path: str,
    directories: Sequence[str],
    key: Sequence[str],
    newest: Sequence[str] = (),
    *,
    files: int | None = None,
    row_group_bytes: int = ROW_GROUP_BYTES,
    distinct_keys: int = 100_000,
    mode: str = "error",
) -> None:
    """Parquet under its directories, clustered by key, with statistics and Bloom filters on the key columns.

    Statistics skip the row groups whose range of keys does not reach a wanted key; the Bloom filter, made for
    ``distinct_keys`` in a row group, those that reach past it without holding it.
    """
    laid = clustered(rows, directories, key, newest, files)
    writer = laid.write.mode(mode).options(**row_group_options(row_group_bytes))
    for name in key:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{name}", str(distinct_keys))
    writer.partitionBy(*directories).parquet(path)
