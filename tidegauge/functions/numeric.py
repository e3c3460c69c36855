"""Rounding, and averaging that does not depend on how rows were partitioned, for all doubles."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Readings below this size that are whole counts of 2^-63 (all from 2^-10 up are) are summed as integers,
# cut into a whole part and three limbs of 21 bits. No limb sum can overflow before 2^42 rows.
EXACT_BELOW = 2.0**20
UNIT = 2.0**-63
LIMB = 2**21
# All others are summed apart, by ranges of so many binades, each in a unit of its own.
BINADES = 16
ORDINARY = 0
_OFFSET = 100  # keeps the numbers of the other ranges positive


def round2(x: Column) -> Column:
    """Nearest double with two decimals, decided on the exact binary value, ties to even.

    Spark's ``round`` and ``bround`` decide on the shortest decimal form instead (2.675 becomes
    2.68). ``format_number`` with a pattern works on the binary value at every magnitude.
    """
    rounded = F.call_function("format_number", x, F.lit("0.00")).try_cast("double")
    # The formatter has no parseable text for infinities; they (and NaN) round to themselves.
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), x).otherwise(rounded)


def _is_exact(x: Column) -> Column:
    counts = x * (1 / UNIT)  # scaling by a power of two is exact
    return (F.abs(x) < EXACT_BELOW) & (F.rint(counts) == counts)


def _is_special(x: Column) -> Column:
    return F.isnan(x) | (F.abs(x) == float("inf"))


def number_range(x: Column) -> Column:
    """Which range of magnitude a reading is summed in: ``ORDINARY`` for nearly all, else by its exponent.

    A grouping key beside :func:`exact_sum`, whose unit it decides. A logarithm that is off by a little at a range's end
    does no harm, as a range holds some binades more than it is given.
    """
    ordinary = _is_exact(x) | _is_special(x) | x.isNull()
    by_exponent = F.floor(F.log2(F.abs(x)) / BINADES).cast("int") + _OFFSET
    return F.when(ordinary, ORDINARY).otherwise(by_exponent)


def _power(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent)


def _scaled(x: Column, exponent: Column) -> Column:
    """``x * 2^exponent`` in two steps, either of which alone is in the range of doubles."""
    half = F.floor(exponent / 2)
    return x * _power(half) * _power(exponent - half)


def _limbs(x: Column) -> list[Column]:
    """Integers with x = l0 + l1 / LIMB + l2 / LIMB^2 + l3 / LIMB^3; scaling by 2^n is exact."""
    cut = [(x * float(LIMB**i)).try_cast("bigint") for i in range(3)]
    rest = (x * float(LIMB**2) - cut[2].cast("double")) * float(LIMB)
    return [cut[0], cut[1] - cut[0] * LIMB, cut[2] - cut[1] * LIMB, rest.try_cast("bigint")]


def exact_sum(x: Column) -> Column:
    """Sum of the finite readings of one :func:`number_range`, as an integer.

    It counts 2^-63 for ordinary readings, and 2^(16 k - 63) in the k-th other range. Integer addition is
    associative, so neither the order of rows nor the partitioning matters.
    """
    of_range = number_range(x)
    small = F.when(of_range == ORDINARY, x).otherwise(_scaled(x, (F.lit(_OFFSET) - of_range) * BINADES))
    total = F.lit(0).cast("decimal(38,0)")
    for i, limb in enumerate(_limbs(small)):
        scale = F.lit(str(LIMB ** (3 - i))).cast("decimal(19,0)")
        total += F.sum(F.when(_is_special(x), 0).otherwise(limb)).cast("decimal(19,0)") * scale
    return total.cast("decimal(38,0)")


def float_sum(x: Column) -> Column:
    """Sum of the NaN and infinite readings, zero when there are none; the order does not matter to these."""
    return F.sum(F.when(_is_special(x), x).otherwise(0.0))


def mean_of_sums(exact: Column, floating: Column, n: Column) -> Column:
    """Mean from added-up sums of ordinary and special readings; the sum is rounded once."""
    return (exact.cast("double") * UNIT + floating) / n


def mean_of_ranges(ranges: Column, floating: Column, n: Column) -> Column:
    """Mean from the sums of every range, an array of structs (``range``, ``exact_sum``).

    The sum is the double nearest to the exact one, infinite beyond the largest double. Of a group there are as many
    entries as ranges, 133 at most, whatever the number of readings.
    """
    only = ranges[0]
    ordinary = (F.size(ranges) == 1) & (only["range"] == ORDINARY)
    total = rounded_sum(F.flatten(F.transform(ranges, lambda r: _pieces(r["range"], r["exact_sum"]))))
    return F.when(ordinary, mean_of_sums(only["exact_sum"], floating, n)).otherwise((total + floating) / n)


def _pieces(of_range: Column, exact: Column) -> Column:
    """Doubles that add up to a range's sum exactly: pieces of at most 32 bits."""

    def cut(x: Column, bits: int) -> tuple[Column, Column]:
        unit = F.lit(str(2**bits)).cast("decimal(20,0)")
        high = F.call_function("div", x, unit)
        return high, x - high.cast("decimal(19,0)") * unit

    top, rest = cut(exact, 64)
    middle, low = cut(rest.cast("decimal(20,0)"), 32)
    # All pieces have the sign of the sum, so that none is larger than it.
    high = F.call_function("div", top, F.lit(2**31).cast("bigint"))
    unit = F.when(of_range == ORDINARY, 0).otherwise((of_range - _OFFSET) * BINADES) - 63
    return F.array(
        *[
            _scaled(piece.cast("double"), unit + place)
            for piece, place in ((high, 95), (top - high * 2**31, 64), (middle, 32), (low, 0))
        ]
    )


def rounded_sum(numbers: Column) -> Column:
    """The double nearest to the exact sum of an array of doubles, ties to even.

    The sum is held as doubles that do not overlap, from the smallest to the largest; adding one more passes
    through them all and leaves the rounding error of each addition in its place.
    """

    def add(held: Column, x: Column) -> Column:
        def through(state: Column, y: Column) -> Column:
            swap = F.abs(state["sum"]) < F.abs(y)
            large, small = F.when(swap, y).otherwise(state["sum"]), F.when(swap, state["sum"]).otherwise(y)
            error = small - (large + small - large)
            kept = F.when(error != 0, F.array_append(state["kept"], error)).otherwise(state["kept"])
            return F.struct((large + small).alias("sum"), kept.alias("kept"))

        start = F.struct(x.alias("sum"), F.array().cast("array<double>").alias("kept"))
        return F.aggregate(held, start, through, lambda s: F.array_append(s["kept"], s["sum"]))

    held = F.aggregate(numbers, F.array().cast("array<double>"), add)

    def down(state: Column, y: Column) -> Column:
        high, low = state["high"], state["low"]
        total = high + y
        # Once an addition was inexact only the sign of what follows matters.
        return F.struct(
            F.when(low != 0, high).otherwise(total).alias("high"),
            F.when(low != 0, low).otherwise(y - (total - high)).alias("low"),
            F.when((low != 0) & (state["below"] == 0), y).otherwise(state["below"]).alias("below"),
        )

    def finish(state: Column) -> Column:
        high, twice = state["high"], state["low"] * 2
        up = high + twice
        # Halfway between two doubles, what is below decides instead of the even one.
        halfway = (F.signum(state["low"]) == F.signum(state["below"])) & (state["low"] != 0) & (up - high == twice)
        return F.when(halfway, up).otherwise(high)

    zeros = F.struct(*[F.lit(0.0).alias(name) for name in ("high", "low", "below")])
    exact = F.aggregate(F.reverse(held), zeros, down, finish)
    # Beyond the largest double the parts are infinite or NaN; the sum is infinite there.
    plain = F.aggregate(numbers, F.lit(0.0), lambda a, b: a + b)
    return F.when(F.isnan(exact), plain).otherwise(exact)
