"""A set of 64-bit keys as bits of a fixed size, to let few rows through before they are moved.

Different keys can share a bit, so what passes still has to meet the exact set; nothing that
belongs to it is ever held back. Where very many keys are marked, more rows pass, no more.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from docpipe.llm.staging import written

#: 16 MB, whatever the number of keys.
MARK_BITS = 27
_PARTS = 1 << (MARK_BITS - 15)
#: Bytes that a row takes a copy of to look at one of them.
_PIECE = 1 << 8


def _place(key: Column) -> Column:
    return key.bitwiseAND((1 << MARK_BITS) - 1) + 1


def marks_of(df: DataFrame, key: str) -> DataFrame:
    """``part, bits`` of the keys in a ``bigint`` column; at most 4096 rows of 4 kB. Keys should
    be hashes, so that they spread over the bits."""
    place = _place(F.col(key))
    rows = df.select(F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("at"))
    parts = rows.repartition("part").groupBy("part").agg(F.bitmap_construct_agg("at").alias("bits"))
    return written(parts, "marks")


def marked(df: DataFrame, key: Column, marks: DataFrame) -> DataFrame:
    """The rows of ``df`` whose key may be marked; they stay where they are."""
    joined, bit = _with_bits(df, key, marks, "inner")
    # "not deterministic", so that no later join is moved below this filter
    return joined.where((bit == 1) & (F.rand(0) + 1 > 0)).select(*[df[c] for c in df.columns])


def with_mark(df: DataFrame, key: Column, marks: DataFrame, name: str) -> DataFrame:
    """All rows of ``df``, with ``name`` telling whether the key may be marked; where it is
    false the key is not."""
    joined, bit = _with_bits(df, key, marks, "left")
    return joined.select(*[df[c] for c in df.columns], F.coalesce(bit == 1, F.lit(False)).alias(name))


def _with_bits(df: DataFrame, key: Column, marks: DataFrame, how: str) -> tuple[DataFrame, Column]:
    place = _place(key)
    at = F.bitmap_bit_position(place)
    byte = (at / 8).cast("int")
    value = F.conv(F.hex(F.substring(F.col("_bits"), byte % _PIECE + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", value, (at % 8).cast("int")).bitwiseAND(1)
    pieces = F.sequence(F.lit(0), F.floor((F.length("bits") - 1) / _PIECE).cast("int"))
    known = marks.select("part", "bits", F.explode(pieces).alias("_piece")).select(
        _numbered(F.col("part"), F.col("_piece")).alias("_part"),
        F.substring("bits", F.col("_piece") * _PIECE + 1, F.lit(_PIECE)).alias("_bits"),
    )
    piece = _numbered(F.bitmap_bucket_number(place), F.floor(byte / _PIECE))
    # of a fixed size, see MARK_BITS
    return df.join(F.broadcast(known), piece == F.col("_part"), how), bit


def _numbered(part: Column, piece: Column) -> Column:
    return part * ((1 << 12) // _PIECE) + piece


def mark_array(marks: DataFrame) -> np.ndarray:
    """The bits as bytes, for tests in numpy; of a fixed size."""
    out = np.zeros(1 << (MARK_BITS - 3), np.uint8)
    for row in marks.collect():
        bits = np.frombuffer(row.bits, np.uint8)
        start = (row.part - 1) * len(bits)
        out[start : start + len(bits)] |= bits[: len(out) - start]
    return out
