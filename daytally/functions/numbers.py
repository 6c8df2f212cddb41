"""Numbers that arrive as text, and comparison of measured volumes."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Volumes have at most this many decimals and lie below this limit; larger doubles can't hold a millionth's place
# of a sum. Whole parts need 50 bits and a sign, millionths 20.
VOLUME_DIGITS = 6
VOLUME_LIMIT = 1e15
WHOLE_BITS, PART_BITS = 50, 20
# Below this, a number times a million is exact enough to tell its decimals; every double of 17 digits beyond it
# is told by its digits.
_SMALL = 2e9

# The usual default tolerances for comparing two floating-point numbers.
RELATIVE_TOLERANCE = 1e-5
ABSOLUTE_TOLERANCE = 1e-8


def fits(volume: Column) -> Column:
    """Whether a number can be summed exactly: finite, below ``VOLUME_LIMIT``, with at most ``VOLUME_DIGITS`` decimals.

    Null for null. What does not fit is rejected on landing, never rounded.
    """
    finite = ~F.isnan(volume) & (F.abs(volume) < VOLUME_LIMIT)
    million = F.lit(10.0**VOLUME_DIGITS)
    # Rounding by digits goes through decimal arithmetic, which costs more than all the rest of reading a number.
    few_digits = F.when(F.abs(volume) < _SMALL, F.rint(volume * million) / million == volume).otherwise(
        F.round(volume, VOLUME_DIGITS) == volume)
    return F.when(volume.isNotNull(), finite & few_digits)


def to_volume(text: Column) -> Column:
    """Volume of a text; null if it is unreadable or does not fit. ``bad_volume`` tells these from missing ones."""
    value = text.try_cast("double")
    return F.when(fits(value), value)


def bad_volume(text: Column) -> Column:
    """Whether a text is there and is no volume."""
    return text.isNotNull() & to_volume(text).isNull()


def _exact(volume: Column) -> Column:
    return volume.cast(f"decimal(28,{VOLUME_DIGITS})")


def _limb_sums(value: Column, size: int, bits: int) -> Column:
    """Sum of longs of ``size`` bits besides the sign, from the sums of their limbs of ``bits`` bits, as a decimal."""
    places = range(0, size, bits)
    total = None
    for at in places:
        # The highest limb has the sign; the others are what lies above their place, never negative.
        above = F.shiftright(value, at) if at else value
        limb = above if at == places[-1] else above.bitwiseAND(F.lit(2**bits - 1))
        part = F.sum(limb).cast("decimal(20,0)") * F.lit(2**at).cast("decimal(16,0)")
        total = part if total is None else total + part
    return total.cast("decimal(31,0)")


def exact_sum(volume: Column, bits: int = 25) -> Column:
    """Sum that does not depend on the order of the rows; null if there is no value.

    The limbs of whole numbers and of millionths are summed as longs, which stays in generated code and needs no decimal
    arithmetic per row; they are carried once, at the end. A group may have ``2 ** (63 - bits)`` rows, whatever
    the volumes: 270 billion, or with 13 bits and twice the sums 10 to the power of 15. More is an error, never a wrong sum.
    """
    whole = F.floor(volume)
    parts = F.rint((volume - whole) * F.lit(10.0**VOLUME_DIGITS)).cast("long")
    shift = F.lit(10**VOLUME_DIGITS).cast(f"decimal({VOLUME_DIGITS + 1},0)")
    millionths = _limb_sums(parts, PART_BITS + 1, bits).cast("decimal(22,0)")
    return (_limb_sums(whole, WHOLE_BITS, bits) + millionths / shift).cast("double")


def exact_total(*volumes: Column) -> Column:
    """Sum of several columns of a row; null if all are null."""
    zero = F.lit(0).cast(f"decimal(28,{VOLUME_DIGITS})")
    total = reduce(lambda a, b: a + b, [F.coalesce(_exact(v), zero) for v in volumes])
    return F.when(F.coalesce(*volumes).isNotNull(), total.cast("double"))


def volume_text(volume: Column) -> Column:
    """Fixed decimals, never an exponent."""
    return _exact(volume).cast("string")


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, null where the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def is_close(
    value: Column, reference: Column, rtol: float = RELATIVE_TOLERANCE, atol: float = ABSOLUTE_TOLERANCE
) -> Column:
    """True if ``value`` lies within the tolerance around ``reference``; null and NaN are never close.

    The tolerance scales with ``reference``, so the two sides are not interchangeable.
    """
    a, b = value.cast("double"), reference.cast("double")
    infinite = F.lit(float("inf"))
    unbounded = (F.abs(a) == infinite) | (F.abs(b) == infinite)
    close = (
        F.when(F.isnan(a) | F.isnan(b), F.lit(False))
        .when(unbounded, a == b)
        .otherwise(F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b))
    )
    return F.coalesce(close, F.lit(False))
