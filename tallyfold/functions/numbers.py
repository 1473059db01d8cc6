"""Strict number parsing, number text, and sums that cannot overflow midway."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings (fixed values). Digits may be grouped by single underscores.
_INT_TEXT = r"^[+-]?[0-9]+$"
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_EXPONENT = rf"[+-]?{_DIGITS}"
_DECIMAL_TEXT = (
    rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE]{_EXPONENT})?$"
)
_HEX = r"[0-9a-fA-F]+(?:_[0-9a-fA-F]+)*"
_HEX_TEXT = (
    rf"^[+-]?0[xX](?:_?{_HEX}(?:\.(?:{_HEX})?)?|\.{_HEX})[pP]{_EXPONENT}$"
)
_INFINITY_TEXT = r"^(?i)[+-]?inf(?:inity)?$"
_NAN_TEXT = r"^(?i)nan$"


def parse_int64(text: Column) -> Column:
    """Base-10 64-bit integer, or NULL: no blanks, no suffix, nothing out of range."""
    return F.when(text.rlike(_INT_TEXT), text.try_cast("bigint"))


def parse_float64(text: Column) -> Column:
    """Decimal or hexadecimal float, ``nan`` or ``inf`` in any case, or NULL.

    Finite text whose value would be infinite is out of range and gives NULL.
    """
    number = F.translate(text, "_", "").try_cast("double")
    finite = F.when(F.abs(number) < float("inf"), number)
    return (
        F.when(text.rlike(_DECIMAL_TEXT) | text.rlike(_HEX_TEXT), finite)
        .when(
            text.rlike(_INFINITY_TEXT),
            F.when(text.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))),
        )
        .when(text.rlike(_NAN_TEXT), F.lit(float("nan")))
    )


def counter_text(value: Column) -> Column:
    return value.cast("string")


def _shortest(value: Column) -> Column:
    """``d.ddde+XX`` with the fewest digits that read back, trailing zeros among them.

    15, 16 or 17 digits are tried: older JVMs print surplus ones, and round from those, so
    16 digits are tried rounded and cut off. Subnormals have fewer digits and start at 1.
    """
    def tried(digits: int) -> Column:
        return F.format_string(f"%.{digits - 1}e", value)

    usual = [tried(15), tried(16), F.regexp_replace(tried(17), "[0-9]e", "e"), tried(17)]
    few = [tried(digits) for digits in range(1, 15)]

    def first(tries: list[Column]) -> Column:
        return F.coalesce(*[F.when(t.try_cast("double") == value, t) for t in tries])

    return F.when(F.abs(value) < 2.2250738585072014e-308, first([*few, *usual])).otherwise(first(usual))


def json_number(value: Column) -> Column:
    """A double as a JSON number: plain digits for exponents -6 to 20, else ``e``; NULL for
    NaN and infinity, which JSON has not."""
    size, text = F.abs(value), value.cast("string")
    shortest = _shortest(value)
    plain = F.when(size >= 1, shortest.cast("decimal(38,16)").cast("string")).otherwise(
        shortest.cast("decimal(38,28)").cast("string")
    )
    powers = F.regexp_replace(F.regexp_replace(shortest, r"\.?0*e", "e"), "e-0([0-9])$", "e-$1")
    return (
        F.when((size >= 1e-3) & (size < 1e6) & (F.length(text) <= 16), F.regexp_replace(text, r"\.0$", ""))
        .when(size == 0, F.regexp_replace(text, r"\.0$", ""))
        .when((size >= 1e-6) & (size < 1e21), F.regexp_replace(plain, r"\.?0*$", ""))
        .when(size < float("inf"), powers)
    )


def gauge_text(value: Column) -> Column:
    """Shortest decimal text that reads back as the same double.

    Plain digits while the decimal exponent lies in [-4, 6), otherwise
    ``d.ddde+XX`` with at least two exponent digits. Where 17 digits are needed,
    the JVM may pick a neighbouring last digit; it still reads back the same.
    """
    size, text = F.abs(value), value.cast("string")
    shortest = _shortest(value)
    is_short = (size >= 1e-3) & (size < 1e6) & (F.length(text) <= 16)
    plain = shortest.cast("decimal(38,21)").cast("string")
    return (
        F.when(is_short, F.regexp_replace(text, r"\.0$", ""))
        .when(value.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(value), "NaN")
        .when(size == float("inf"), F.when(value > 0, "+Inf").otherwise("-Inf"))
        .when(size == 0, F.regexp_replace(text, r"\.0$", ""))
        .when((size >= 1e-4) & (size < 1e6), F.regexp_replace(plain, r"\.?0*$", ""))
        .otherwise(F.regexp_replace(shortest, r"\.?0*e", "e"))
    )


def value_text(metric_type: Column, counter_value: Column, gauge_value: Column) -> Column:
    """Text of a metric's value; an unknown type gives the empty text."""
    return (
        F.when(metric_type == "counter", counter_text(counter_value))
        .when(metric_type == "gauge", gauge_text(gauge_value))
        .otherwise("")
    )


_LIMB_BITS = 22
_LIMB_MASK = (1 << _LIMB_BITS) - 1


def exact_sum(value: Column) -> Column:
    """Aggregate: exact total of BIGINTs as DECIMAL(38,0).

    Summing BIGINT directly fails once a running total leaves 64 bits, even when
    the end result fits, and summing DECIMAL boxes every row. The value is split
    into three limbs whose BIGINT sums stay exact for 2^41 rows per key, and the
    limbs are put together once per group.
    """
    def total(limb: Column, shift: int) -> Column:
        return F.sum(limb).cast("decimal(19,0)") * F.lit(Decimal(1 << shift))

    low = value.bitwiseAND(F.lit(_LIMB_MASK))
    middle = F.shiftright(value, _LIMB_BITS).bitwiseAND(F.lit(_LIMB_MASK))
    high = F.shiftright(value, 2 * _LIMB_BITS)
    return (
        total(low, 0) + total(middle, _LIMB_BITS) + total(high, 2 * _LIMB_BITS)
    ).cast("decimal(38,0)")


def wrap_int64(total: Column) -> Column:
    """DECIMAL total reduced to 64 bits with two's-complement wrap-around."""
    half, full = F.lit(Decimal(1 << 63)), F.lit(Decimal(1 << 64))
    return (F.pmod(total + half, full) - half).cast("bigint")
