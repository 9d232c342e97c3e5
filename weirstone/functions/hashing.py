"""Single-hash bitmap offset used to count visitors approximately."""

from pyspark.sql import Column, functions as F

BITMAP_BITS = 30


def bitmap_offset(text: Column, bits: int = BITMAP_BITS) -> Column:
    """Fold the characters with 32 * acc + code, modulo 2^bits."""
    codes = F.transform(
        F.sequence(F.lit(1), F.length(text)), lambda i: F.ascii(F.substring(text, i, F.lit(1)))
    )
    mask = F.lit((1 << bits) - 1).cast("long")
    return F.when(F.length(text) == 0, F.lit(0).cast("long")).otherwise(
        F.aggregate(codes, F.lit(0).cast("long"), lambda acc, c: (acc * 32 + c).bitwiseAND(mask))
    )
