"""Key and NOT NULL constraints as checks, for tables whose catalog does not enforce them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from docpipe.functions.sqltext import quoted


#: Bits that new keys are noted in, by their hash: 16 MB, whatever the number of keys.
KEY_BITS = 27


class ConstraintViolation(ValueError):
    """A table does not satisfy a declared constraint."""


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows. Counts are combined
    before the shuffle, so a key that holds much of the table is one row per task."""
    return df.groupBy(*[quoted(c) for c in columns]).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: rows of the table, and rows in which the column is NULL."""
    counted = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(quoted(c)).isNull()).alias(f"_nulls{i}") for i, c in enumerate(columns)],
    )
    listed = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col("_rows").alias("n_rows"),
                F.col(f"_nulls{i}").alias("n_nulls"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return counted.select(F.inline(listed))


def assert_not_null(df: DataFrame, columns: Sequence[str]) -> None:
    """Raise if any of the columns holds NULL (one row per column comes to the driver)."""
    bad = [r for r in null_counts(df, columns).collect() if r.n_nulls]
    if bad:
        text = ", ".join(f"{r.column_name}: {r.n_nulls}" for r in bad)
        raise ConstraintViolation(f"NULL in NOT NULL columns ({text})")


def assert_primary_key(df: DataFrame, columns: Sequence[str]) -> None:
    """Raise if the columns hold NULL or do not identify a row."""
    assert_not_null(df, columns)
    example = duplicate_keys(df, columns).head(1)
    if example:
        raise ConstraintViolation(f"key {list(columns)} is not unique, e.g. {example[0]}")


def clashing_keys(existing: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values of ``new`` that ``existing`` has as well, once each. A key with a NULL in it
    equals no other.

    The keys of ``new`` are noted in a bit set of a fixed size, which goes to every task that reads
    ``existing``; rows whose bit is not set stay where they are, and only the keys of the others are
    moved to be compared. Keys that share a bit cost some rows that are moved in vain, nothing else.
    ``new`` is read twice, so it has to give the same rows each time.
    """
    names = [quoted(c) for c in columns]
    asked = new.select(*names)
    place = _bit_place(names)
    noted = (
        asked.select(
            F.bitmap_bucket_number(place).alias("_part"), F.bitmap_bit_position(place).alias("_at")
        )
        .groupBy("_part")
        .agg(F.bitmap_construct_agg("_at").alias("_bits"))
    )
    # of a fixed size, see KEY_BITS
    met = existing.select(*names).join(
        F.broadcast(noted), F.bitmap_bucket_number(place) == F.col("_part")
    )
    # "not deterministic", so that the test stays below the exact join
    may_clash = met.where(_bit_is_set(place) & (F.rand(0) + 1 > 0)).select(*names)
    # distinct first: a key with very many rows is one row per task when it is moved
    return may_clash.distinct().join(asked, list(columns), "left_semi")


def _bit_place(names: Sequence[str]) -> Column:
    return F.xxhash64(*names).bitwiseAND((1 << KEY_BITS) - 1) + 1


def _bit_is_set(place: Column) -> Column:
    at = F.bitmap_bit_position(place)
    byte = F.substring(F.col("_bits"), (at / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.call_function("shiftright", value, (at % 8).cast("int")).bitwiseAND(1) == 1


def assert_new_keys(existing: DataFrame, new: DataFrame, columns: Sequence[str]) -> None:
    """Raise if ``new`` cannot be added to ``existing`` without breaking the key."""
    assert_primary_key(new, columns)
    example = clashing_keys(existing, new, columns).head(1)
    if example:
        raise ConstraintViolation(f"key {list(columns)} is already there, e.g. {example[0]}")
