"""What the operators share: words, durable tables, row keys and ranks that need no single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wirelens.sources.tables import durable_folder as shared_folder
from wirelens.sources.tables import stored as durable

__all__ = ["durable", "let", "lower_ascii", "ranked", "same_keys", "shared_folder", "unused", "words"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Groups whose sizes the driver holds to rank their rows.
MOST_GROUPS = 1 << 16
TRIMMED = "\x20\x09\x0a\x0b\x0c\x0d"


def unused(columns: list[str], *stems: str) -> list[str]:
    """Names that begin with the stems and that none of ``columns`` has, whatever its case."""
    taken, out = {c.lower() for c in columns}, []
    for stem in stems:
        name = f"_{stem}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text in order; none for null."""
    spaced = F.translate(text, TRIMMED, " " * len(TRIMMED))
    return F.coalesce(F.array_remove(F.split(spaced, " ", -1), ""), F.array().cast("array<string>"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, where plain nesting would compute it at each use."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ranked(df: DataFrame, group: str, order: list[str | Column], rank: str, by: str | None = None, per_task: int = 4096, step: int | None = None) -> DataFrame:
    """``rank``: 0, 1, 2, ... within each group, in the order of a hash of ``order`` and then of ``order``.

    With ``by``, a column of whole numbers from 0, the order is that of ``by`` and then of ``order``; ``step`` numbers make a
    bucket, which is for numbers that few rows share but that aren't spread evenly.

    A group may hold any share of the rows. Its rows are dealt to buckets of about ``per_task`` rows, by hash or by ranges
    of ``by``, as many as the group's size asks for, ranked there, and shifted by the rows of the buckets before. At most
    ``MOST_GROUPS`` groups and their sizes reach the driver, and all tasks; more are an error. ``df`` is read three times,
    so it should be a stored table.
    """
    hash_, bucket, many, width, size, start, local = unused([*df.columns, rank], "hash", "bucket", "many", "width", "size", "start", "local")
    top = F.max(by) + 1 if by else F.lit(0)
    found = df.groupBy(group).agg(F.count(F.lit(1)), top.cast("long")).limit(MOST_GROUPS + 1).collect()
    if len(found) > MOST_GROUPS:
        raise ValueError(f"more than {MOST_GROUPS} groups")
    buckets = [(g, max(1, -(-n // per_task)), m or 0) for g, n, m in found]
    buckets = [(g, n, step or max(1, -(-m // n))) for g, n, m in buckets]
    kind = df.schema[group].dataType.simpleString()
    facts = df.sparkSession.createDataFrame(buckets, f"`{group}` {kind}, {many} long, {width} long")
    # at most MOST_GROUPS rows of three values
    sized = same_keys(df, F.broadcast(facts), [group])
    if by:
        hashed = sized.withColumn(hash_, F.col(by)).withColumn(bucket, F.floor(F.col(by) / F.col(width)))
    else:
        hashed = sized.withColumn(hash_, F.xxhash64(*order)).withColumn(bucket, F.pmod(hash_, many))
    hashed = hashed.drop(many, width)
    keys = [group, bucket]
    before = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias(size)).select(*keys, F.coalesce(F.sum(size).over(before), F.lit(0)).alias(start))
    numbered = hashed.withColumn(local, F.row_number().over(Window.partitionBy(*keys).orderBy(hash_, *order)))
    return same_keys(numbered, starts, keys).select(*df.columns, (F.col(start) + F.col(local) - 1).alias(rank))


def same_keys(rows: DataFrame, facts: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` with the other columns of ``facts``, which has one row for each value of ``keys`` (nulls are values)."""
    names = dict(zip(keys, unused([*rows.columns, *facts.columns], *[f"key_{k}" for k in keys]), strict=True))
    joined = rows.join(facts.withColumnsRenamed(names), [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()], how)
    return joined.drop(*names.values())
