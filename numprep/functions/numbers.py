"""Text to number and back, as built-in column expressions (no UDF).

Everything here stays inside whole-stage codegen. Conditions are ordered so that the usual value takes
the cheapest branch: ``CASE WHEN`` evaluates only the branch it needs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Decimal number, optional sign and exponent, blanks around it. Possessive quantifiers: the pattern never
# backtracks, so malformed text costs no more than good text. It also keeps out what a Java cast to double
# would let through: "12d", "0x1p3", "NaN", "Infinity".
NUMBER_TEXT = r"^\s*+[+-]?+(?:\d++\.?+\d*+|\.\d++)(?:[eE][+-]?+\d++)?+\s*+$"

_WIDEST_SCALE = 21  # decimals of the smallest number written without exponent, 0.0001 and 17 digits


def compiled_apart(expression: Column) -> Column:
    """The same value, compiled as a method of its own.

    Code generation puts a projection of many columns into one method, and the JVM leaves methods beyond 8000
    bytes uncompiled, which makes twenty text columns four times slower. An expression named twice is
    computed once, in a separate method.
    """
    return F.coalesce(expression, expression)


def bare_text(text: Column, prefix: str = "", suffix: str = "") -> Column:
    """Drop ``len(prefix)`` characters in front and ``len(suffix)`` behind, whatever they are."""
    if not prefix and not suffix:
        return text
    return F.substring(text, len(prefix) + 1, F.length(text) - (len(prefix) + len(suffix)))


def is_number_text(text: Column, prefix: str = "", suffix: str = "", strict_affix: bool = False) -> Column:
    """True where the text without its affixes is a number."""
    ok = bare_text(text, prefix, suffix).rlike(NUMBER_TEXT)
    if strict_affix:
        if prefix:
            ok = text.startswith(prefix) & ok
        if suffix:
            ok = text.endswith(suffix) & ok
    return ok


def parse_number(
    column: Column,
    data_type: T.DataType,
    prefix: str = "",
    suffix: str = "",
    strict_affix: bool = False,
) -> Column:
    """Double value of a text or numeric column; NULL where there is none.

    NaN counts as missing, because Spark orders it above every number and one NaN would become the maximum.
    """
    if isinstance(data_type, T.StringType):
        bare = bare_text(column, prefix, suffix)
        value = bare.try_cast("double")
        if strict_affix:
            return compiled_apart(F.when(is_number_text(column, prefix, suffix, True), value))
        # The pattern costs more than the cast, which accepts more than it in blanks, names, hexadecimal numbers and type
        # letters. A text without x that goes from a sign, point or digit to a digit has none of these.
        first, last = F.ascii(bare), F.ascii(F.substring(bare, -1, 1))
        usual = first.between(ord("+"), ord("9")) & last.between(ord("0"), ord("9"))
        usual = usual & ~F.contains(F.lower(bare), F.lit("x"))
        return compiled_apart(F.when(usual, value).when(is_number_text(column, prefix, suffix), value))
    number = column.cast("double")
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return compiled_apart(F.when(~F.isnan(number), number))
    return number


def round_places(number: Column, places: int | None) -> Column:
    """Round half to even on the binary product, as numpy does. ``None`` leaves the value alone."""
    if places is None:
        return number
    if places == 0:
        return F.rint(number)
    power = F.lit(float(10 ** abs(places)))
    if places > 0:
        return F.rint(number * power) / power
    return F.rint(number / power) * power


def number_text(number: Column, places: int | None = None) -> Column:
    """Decimal text of a double, in the form Python prints: ``12.0``, ``0.5``, ``1e+16``.

    ``places`` is the number of decimals the value was rounded to. Zero is written without a sign. Numbers of
    up to 15 digits are written as they are, longer ones with the fewest digits that give the same double.
    """
    size = F.abs(number)
    scale = _WIDEST_SCALE if places is None else min(max(places, 1), _WIDEST_SCALE)
    tiny = places is None or places > 3  # else no value but zero is below 0.001
    # The JVM writes this range without exponent. No two numbers of up to 15 digits are the same double, so
    # a text that short is the shortest.
    jvm_text = (number + F.lit(0.0)).cast("string")
    as_is = (size < 1e7) & (F.length(jvm_text) <= 16)
    # Of longer texts, the fewest digits from 15 on that give the same double. Only rare values come this far.
    # The JVM rounds what it has rounded to 17 digits before, so whole numbers are written from their exact value.
    whole = number.try_cast("bigint").cast("decimal(20,0)")
    written = [
        F.call_function("format_number", value, F.lit("0." + "#" * (n - 1) + "E0"))
        for n in (15, 16, 17)
        for value in (whole, number)
    ]
    shorter = F.coalesce(*[F.when(text.try_cast("double") == number, text) for text in written], jvm_text)
    plain, exponent = size < 1e16, F.regexp_replace(shorter, r"(\.0)?E(\d)", "e+$2")
    if tiny:
        as_is = ((size >= 1e-3) | (size == 0)) & as_is
        plain = (size >= 1e-4) & plain
        exponent = F.regexp_replace(F.regexp_replace(exponent, r"(\.0)?E-", "e-"), r"e-(\d)$", "e-0$1")
    exact = number if places is not None and places <= 8 else shorter.try_cast(f"decimal(38,{scale})")
    plain_text = F.call_function("format_number", exact, F.lit("0.0" + "#" * (scale - 1)))
    return F.when(as_is, jvm_text).when(plain, plain_text).otherwise(exponent)


def write_number(
    number: Column,
    data_type: T.DataType,
    prefix: str = "",
    suffix: str = "",
    places: int | None = None,
) -> Column:
    """Number in the stored form of its column: affixed text, or the numeric type (NULL if it does not fit)."""
    if isinstance(data_type, T.StringType):
        text = number_text(number, places)
        affixed = [F.lit(prefix)] * bool(prefix) + [text] + [F.lit(suffix)] * bool(suffix)
        return F.concat(*affixed) if len(affixed) > 1 else text
    if isinstance(data_type, T.DoubleType):
        return number
    return number.try_cast(data_type.simpleString())
