"""What the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW = "_row"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def packed(df: DataFrame, keep: list[str] | None = None, /, **columns: Column) -> DataFrame:
    """The input row, or its columns ``keep``, as one struct beside working columns, so that no names can clash."""
    row = F.struct(*[F.col(quoted(c)) for c in (df.columns if keep is None else keep)]).alias(ROW)
    return df.select(row, *[column.alias(name) for name, column in columns.items()])


def unpacked(df: DataFrame, *columns: Column | str, new: tuple[str, ...] = ()) -> DataFrame:
    """The packed row again with ``columns``; an input column named as in ``new`` gives way."""
    taken = {name.lower() for name in new}
    kept = [F.col(f"{ROW}.{quoted(c)}").alias(c) for c in df.schema[ROW].dataType.names
            if c.lower() not in taken]
    return df.select(*kept, *columns)


def source_key(source: Column) -> Column:
    """A key that is never null and sorts as the source by code point, null last."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("~"))


def shuffle_key(seed: str, *parts: Column) -> Column:
    """A seeded hash of the row's content: a shuffle that is the same on every run."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def hex_bucket(key: Column) -> Column:
    """The first three hexadecimal digits of a hash: one of 4096 even buckets."""
    return F.conv(F.substring(key, 1, 3), 16, 10).cast("int")

