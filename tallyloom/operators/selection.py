"""First-N and seeded selection that stay exact and never gather the kept rows in one task.

First N is a radix selection: rows are counted by ranges of their key, the range that holds the n-th row is counted again by finer
ranges, and so on down to one key value. Only counts leave the tasks, a few thousand at a time, and the rows are then filtered by
that value.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNHASHED = (T.MapType, T.VariantType)
_FINE = 11  # bits of a value that the first count tells apart, from its highest set bit on
_FINER = 12  # bits that every further count tells apart
_FEW = 4_096  # values that are looked at one by one
_CHUNK = 7  # bytes of a text that make one whole number


def _range_of(value: Column) -> Column:
    """A number that rises with ``value`` and is shared by values equal in sign, size and leading bits."""
    size = F.when(value < 0, F.bitwise_not(value)).otherwise(value)
    bits = F.greatest(F.length(F.bin(size)), F.lit(_FINE))
    own = (bits - _FINE).cast("long") * (1 << _FINE) + F.call_function("shiftright", size, bits - _FINE)
    return F.when(value < 0, -1 - own).otherwise(own)


def _bounds(own: int) -> tuple[int, int]:
    """The least and the greatest value of a range."""
    if own < 0:
        low, high = _bounds(-1 - own)
        return ~high, ~low
    shift, lead = divmod(own, 1 << _FINE)
    return lead << shift, (lead + 1 << shift) - 1


def _nth(values: DataFrame, n: int) -> tuple[int, int, int] | None:
    """The ``n``-th smallest value, how many are smaller, and how many equal it; None if there are no more than ``n``."""

    def find(counts: list, before: int) -> tuple[int, int, int]:
        for own, rows in sorted(counts):
            if before + rows >= n:
                return own, before, rows
            before += rows
        raise AssertionError("the counts of two runs differ: the input is not the same on every run")

    counts = [(r.own, r.rows) for r in values.groupBy(_range_of(F.col("v")).alias("own")).agg(F.count("*").alias("rows")).collect()]
    if sum(rows for _, rows in counts) <= n:
        return None
    own, before, rows = find(counts, 0)
    low, high = _bounds(own)
    while low < high:
        inside = values.filter(F.col("v").between(low, high))
        if rows <= _FEW:
            held = sorted(r.v for r in inside.collect())
            value = held[n - before - 1]
            return value, before + held.index(value), held.count(value)
        shift = max(0, (high - low).bit_length() - _FINER)
        finer = inside.groupBy(F.shiftright(F.col("v") - F.lit(low), shift).alias("own")).agg(F.count("*").alias("rows"))
        own, before, rows = find([(r.own, r.rows) for r in finer.collect()], before)
        low, high = low + (own << shift), min(high, low + (own + 1 << shift) - 1)
    return low, before, rows


def _digits(tied: DataFrame, name: str) -> Iterator[Column]:
    """Whole numbers that, one after the other, order the column as it orders itself, NULLs first."""
    column, field = F.col(f"`{name}`"), tied.schema[name]
    if field.nullable:
        yield column.isNotNull().cast("long")
    if isinstance(field.dataType, (T.IntegralType, T.BooleanType)):
        yield F.coalesce(column.cast("long"), F.lit(0).cast("long"))
    elif isinstance(field.dataType, T.DateType):
        yield F.coalesce(F.unix_date(column).cast("long"), F.lit(0).cast("long"))
    elif isinstance(field.dataType, T.TimestampType):
        yield F.coalesce(F.unix_micros(column), F.lit(0).cast("long"))
    elif isinstance(field.dataType, T.StringType):
        content = F.coalesce(column, F.lit("")).cast("binary")
        longest = tied.agg(F.max(F.octet_length(column))).first()[0] or 0
        for start in range(1, longest + 1, _CHUNK):
            yield F.conv(F.rpad(F.hex(F.substring(content, start, _CHUNK)), 2 * _CHUNK, "0"), 16, 10).cast("long")
        yield F.octet_length(content).cast("long")
    else:
        raise TypeError(f"cannot break ties by {name}: {field.dataType.simpleString()}")


def first_n(df: DataFrame, n: int | None, pos: str = "pos", tie_break: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows by ``pos`` (a whole number), then ``tie_break``, then row content; all rows when ``n`` is None.

    One way for every ``n``: see the module's text. Ties are resolved the same way, key by key, and only among the rows of
    the last position; rows equal in everything are taken as they come. The filter by position reaches the scan, and
    the rows stay where they are. A NULL position is an error.
    """
    if n is None:
        return df
    if not isinstance(df.schema[pos].dataType, T.IntegralType):
        raise TypeError(f"{pos} must be a whole number")
    missing = F.raise_error(F.lit(f"a row has no {pos}")).cast(df.schema[pos].dataType)
    checked = df.withColumn(pos, F.coalesce(F.col(pos), missing)) if df.schema[pos].nullable else df
    if n <= 0:
        return checked.limit(0)
    found = _nth(checked.select(F.col(pos).cast("long").alias("v")), n)
    if found is None:
        return checked
    cut, before, rows = found
    upto = df.filter(F.col(pos) <= cut)
    if before + rows == n:
        return upto
    left, smaller, same = n - before, F.col(pos) < cut, F.col(pos) == cut
    tied = df.filter(same)
    hashed = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, _UNHASHED)])
    for digit in [*(d for name in tie_break or [] for d in _digits(tied, name)), hashed]:
        found = _nth(df.filter(same).select(digit.alias("v")), left)
        if found is None:
            return upto.filter(smaller | same)
        cut, before, rows = found
        smaller, same, left = smaller | (same & (digit < cut)), same & (digit == cut), left - before
        if rows == left:
            return upto.filter(smaller | same)
    return upto.filter(smaller).unionByName(upto.filter(same).limit(left))


def seeded_rank(key: Column, seed: int) -> Column:
    """A 60-bit number that orders keys pseudo-randomly, the same on every run and partitioning."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def stable_fraction(df: DataFrame, key: str, share: float, seed: int = 0) -> DataFrame:
    """Rows whose key hashes below ``share``: the same rows on every run and partitioning, each key all or nothing.
    Rows without a key are left out."""
    return df.filter(seeded_rank(F.col(key), seed) < int(share * (1 << 60)))
