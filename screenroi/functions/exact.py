"""Exact sums of doubles as Column expressions.

A sum of doubles depends on the order in which tasks deliver their parts. Here every finite double becomes
a whole number: its mantissa, moved up inside a band of 32 exponents. Whole numbers of one band are added
as 38-digit decimals, which no order changes (and none overflows below some 10^12 rows a group and band).
``exact_part`` gives a value's band and whole number; group and sum them by band, as often and in as many
steps as wanted; ``exact_total`` joins a group's bands once and rounds to the nearest double, so that the
result is that of ``math.fsum``. NaN and the infinities are bands of their own.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Exponents in a band; the number 1 of band b stands for 2^(_WIDTH b - _OFFSET).
_WIDTH = 32
_OFFSET = 1088
_LEAST = -1074  # exponent of the smallest double
_NAN, _PLUS, _MINUS = -1, -2, -3
_WIDE = "decimal(38,0)"


def _power(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent)


def exact_part(x: Column) -> Column:
    """struct(band int, part decimal(28,0)) of a double; null for null."""
    size = F.abs(x)
    # the logarithm may be one off: one spare bit below the mantissa makes the quotient whole all the same
    exponent = F.greatest(F.floor(F.log2(size)).cast("int") - 53, F.lit(_LEAST))
    exponent = F.when(size == 0, F.lit(_LEAST)).otherwise(exponent)
    place = exponent + _OFFSET
    number = (x / _power(exponent)).cast("long").cast("decimal(17,0)")
    part = number * F.call_function("shiftleft", F.lit(1).cast("long"), place % _WIDTH).cast("decimal(10,0)")
    infinite = size == float("inf")
    band = (
        F.when(F.isnan(x), F.lit(_NAN)).when(infinite & (x > 0), F.lit(_PLUS)).when(infinite, F.lit(_MINUS))
        .otherwise(F.floor(place / _WIDTH).cast("int"))
    )
    zero = F.lit(0).cast("decimal(28,0)")
    found = F.when(F.isnan(x) | infinite, zero).otherwise(part.cast("decimal(28,0)"))
    return F.when(x.isNotNull(), F.struct(band.alias("band"), found.alias("part")))


# Joining bands is stated as SQL text, which Spark parses at once: the same tree takes a second to build call by call.

def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` for ``value``, which is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _wide(text: str | int) -> str:
    return f"CAST({text} AS {_WIDE})"


_ONE = f"{1 << _WIDTH}"  # of the next band


def _limbs(parts: str, ends: str, sign: str) -> str:
    """struct(carry, limbs): the sum, or less it, in 32-bit limbs, lowest first; carry is -1 below zero, else 0."""
    own = f"aggregate(filter({parts}, p -> p.band = j), {_wide(0)}, (s, p) -> {_wide(f's {sign} p.part')})"
    low = f"pmod(t, {_wide(_ONE)})"
    step = _let("t", _wide(f"a.carry + {own}"), _let("low", low, (
        f"named_struct('carry', {_wide(f'(t - low) / {_wide(_ONE)}')}, 'limbs', concat(a.limbs, array(CAST(low AS BIGINT))))")))
    start = f"named_struct('carry', {_wide(0)}, 'limbs', CAST(array() AS ARRAY<BIGINT>))"
    # four limbs more than the highest band hold whatever is carried out of it
    return f"aggregate(sequence({ends}.low, {ends}.high + 4), {start}, (a, j) -> {step})"


def _scaled(number: str, exponent: str) -> str:
    """number * 2^exponent in two steps, since the power alone may leave the range of doubles."""
    return _let("e", exponent, f"CAST({number} AS DOUBLE) * pow(2D, floor(e / 2)) * pow(2D, e - floor(e / 2))")


def _rounded(limbs: str, lowest: str) -> str:
    """The nearest double, ties to even, of limbs whose first has band ``lowest``."""
    head = (f"{_wide(f'get({limbs}, top)')} * {_wide(1 << 64)} + {_wide(f'coalesce(get({limbs}, top - 1), 0L)')} * {_wide(1 << 32)}"
            f" + {_wide(f'coalesce(get({limbs}, top - 2), 0L)')}")
    below = f"exists(slice({limbs}, 1, greatest(top - 2, 0)), v -> v <> 0)"
    up = f"CASE WHEN r.rest * 2 > r.unit OR (r.rest * 2 = r.unit AND ({below} OR q % 2 = 1)) THEN 1 ELSE 0 END"
    number = _let("q", "CAST((h.head - r.rest) / r.unit AS BIGINT)", _scaled(
        f"(q + {up})", f"h.spare + ({lowest} + top - 2) * {_WIDTH} - {_OFFSET}"))
    unit = "CAST(shiftleft(1L, h.spare) AS DECIMAL(20,0))"
    found = _let("h", f"named_struct('head', {_wide(head)}, 'spare', length(bin(get({limbs}, top))) + {64 - 53})",
                 _let("r", f"named_struct('rest', pmod(h.head, {unit}), 'unit', {unit})", number))
    return _let("top", f"array_max(transform({limbs}, (v, i) -> CASE WHEN v <> 0 THEN i END))",
                f"CASE WHEN top IS NULL THEN 0D ELSE {found} END")


def _joined(parts: str) -> str:
    """The sum over any bands."""
    signed = _let("plus", _limbs("fin", "ends", "+"), f"CASE WHEN plus.carry = 0 THEN {_rounded('plus.limbs', 'ends.low')} ELSE "
                  + _let("minus", _limbs("fin", "ends", "-"), f"-{_rounded('minus.limbs', 'ends.low')}") + " END")
    ends = "named_struct('low', array_min(fin.band), 'high', array_max(fin.band))"
    total = _let("fin", f"filter({parts}, p -> p.band >= 0)", f"CASE WHEN size(fin) = 0 THEN 0D ELSE {_let('ends', ends, signed)} END")

    def has(band: int) -> str:
        return f"array_contains({parts}.band, {band})"

    return (f"CASE WHEN {has(_NAN)} OR ({has(_PLUS)} AND {has(_MINUS)}) THEN double('NaN') WHEN {has(_PLUS)} THEN double('Infinity') "
            f"WHEN {has(_MINUS)} THEN double('-Infinity') ELSE {total} END")


def exact_total(parts: str) -> Column:
    """The sum as a double from the column ``parts``, an array of struct(band, part); null if it is empty. Beyond
    the largest double it is infinite.

    One band, or two neighbours, hold 32 to 64 binary orders of magnitude, so nearly every group: their sum is one
    decimal, which Java rounds to the nearest double."""
    one, two = f"get({parts}, 0)", f"get({parts}, 1)"
    low, high = f"least({one}.band, {two}.band)", f"greatest({one}.band, {two}.band)"
    upper = f"if({one}.band > {two}.band, {one}.part, {two}.part)"
    lower = f"if({one}.band > {two}.band, {two}.part, {one}.part)"
    plain = f"{low} BETWEEN 3 AND 58"  # far from the ends of doubles
    unit = f"pow(2D, {low} * {_WIDTH} - {_OFFSET})"
    both = _wide(f"CAST({upper} AS DECIMAL(28,0)) * CAST({_ONE} AS DECIMAL(10,0)) + {lower}")
    return F.expr(f"""CASE WHEN size({parts}) = 0 THEN CAST(NULL AS DOUBLE)
        WHEN size({parts}) = 1 AND {plain} THEN CAST({one}.part AS DOUBLE) * {unit}
        WHEN size({parts}) = 2 AND {plain} AND {high} - {low} = 1 AND abs({upper}) < {_wide(10 ** 27)} THEN CAST({both} AS DOUBLE) * {unit}
        ELSE {_joined(parts)} END""")
