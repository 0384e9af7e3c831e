"""Exact decimals as big-endian two's-complement bytes, without a UDF."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2^64, the weight of the high half of a 16-byte integer.
_HIGH_WEIGHT = Decimal(2**64)

# Scales up to this keep the product of a 64-bit integer and the unit within 38 digits.
_SCALE_BY_PRODUCT = 17


def _sign_digit(raw: Column) -> Column:
    return F.when(raw >= F.lit(b"\x80"), "F").otherwise("0")


def _signed_half(digits: Column) -> Column:
    return F.conv(digits, 16, -10).cast("bigint").cast("decimal(20,0)")


def _wide_integer(digits: Column, pad: Column) -> Column:
    """Up to 16 bytes of hexadecimal digits as ``decimal(38,0)``; null beyond 38 digits.

    A negative number is put together from above, so that no intermediate is larger than it.
    """
    full = F.lpad(digits, 32, pad)
    high = _signed_half(F.substring(full, 1, 16))
    low = F.conv(F.substring(full, 17, 16), 16, 10).cast("decimal(20,0)")
    weight = F.lit(_HIGH_WEIGHT)
    above = F.try_subtract(F.try_multiply((high + 1).cast("decimal(20,0)"), weight), weight - low)
    # The sign is that of the digits put before: nothing is converted to learn it.
    return F.when(pad == "F", above.cast("decimal(38,0)")).otherwise(
        F.try_add(F.try_multiply(high, weight), low).cast("decimal(38,0)")
    )


def _scaled_text(unscaled: Column, scale: int) -> Column:
    """An integer as text that is read as a number of that scale, whatever its size."""
    return F.concat(unscaled.cast("string"), F.lit(f"E-{scale}"))


def decode_decimal(
    raw: Column, precision: int = 20, scale: int = 2, on_overflow: str = "fail"
) -> Column:
    """Unscaled two's-complement bytes to ``decimal(precision, scale)``, exact at every scale.

    Empty bytes are zero and null stays null. A value that does not fit fails the query
    (``on_overflow="fail"``) or becomes null (``"null"``). Up to 8 bytes, the usual case, take
    one 64-bit conversion; up to 16 bytes take two halves; longer input is cut to its shortest
    form first, so sign padding of any length is accepted. Where a product with the unit could
    pass Spark's 38 digits and lose some, the digits go through text with an exponent instead, so
    all sizes of input give the same exact value.
    """
    if on_overflow not in ("fail", "null"):
        raise ValueError("on_overflow is 'fail' or 'null'")
    target = f"decimal({precision},{scale})"
    size = F.octet_length(raw)
    pad = _sign_digit(raw)
    narrow = _signed_half(F.lpad(F.hex(raw), 16, pad))
    if scale <= _SCALE_BY_PRODUCT:
        narrow = F.try_multiply(narrow, F.lit(Decimal(1).scaleb(-scale))).try_cast(target)
    else:
        narrow = _scaled_text(narrow, scale).try_cast(target)

    def wide(digits: Column) -> Column:
        return _scaled_text(_wide_integer(digits, pad), scale).try_cast(target)

    shortest = F.regexp_replace(
        F.regexp_replace(F.hex(raw), "^(00)+(?=[0-7][0-9A-F])", ""),
        "^(FF)+(?=[89A-F][0-9A-F])",
        "",
    )
    value = (
        F.when(size == 0, F.lit(Decimal(0)).cast(target))
        .when(size <= 8, narrow)
        .when(size <= 16, wide(F.hex(raw)))
        .when(F.length(shortest) <= 32, wide(shortest))
    )
    if on_overflow == "null":
        return value
    # A null for non-null bytes can only mean that the value does not fit.
    message = F.concat(F.lit(f"value does not fit {target}: 0x"), F.hex(raw))
    return F.coalesce(value, F.when(raw.isNotNull(), F.raise_error(message).cast(target)))


def _narrow_digits(number: Column) -> Column:
    """A 64-bit integer as hex digits of as many bytes as its value and sign need."""
    magnitude = number.bitwiseXOR(F.shiftright(number, 63))
    with_sign = F.shiftleft(magnitude, 1).bitwiseOR(F.lit(1))
    size = F.ceil(F.length(F.hex(with_sign)) / 2).cast("int")
    return F.right(F.lpad(F.hex(number), 16, "0"), size * 2)


def _wide_digits(unscaled: Column) -> Column:
    weight = F.lit(_HIGH_WEIGHT).cast("decimal(20,0)")
    quotient = F.call_function("div", unscaled, weight)
    rest = unscaled - quotient.cast("decimal(20,0)") * weight
    borrow = rest < 0
    high = F.hex(F.when(borrow, quotient - 1).otherwise(quotient))
    low = F.conv(
        F.when(borrow, rest + weight).otherwise(rest).cast("decimal(20,0)").cast("string"), 10, 16
    )
    digits = F.concat(F.lpad(high, 16, "0"), F.lpad(low, 16, "0"))
    return F.when(
        unscaled >= 0, F.regexp_replace(digits, "^(00)+(?=[0-7][0-9A-F])", "")
    ).otherwise(F.regexp_replace(digits, "^(FF)+(?=[89A-F][0-9A-F])", ""))


def _point_text(value: Column, scale: int) -> Column:
    """A decimal as text with ``scale`` digits behind the point.

    A number's own text is several times as fast as formatting it, and is taken where it is certain to be
    those digits: at that scale already, and not so small that it would have an exponent.
    """
    there = value.try_cast(f"decimal(38,{scale})")
    least = Decimal("0.000001")
    plain = (there == value) & ((there >= F.lit(least)) | (there <= F.lit(-least)))
    return F.when(plain, there.cast("string")).otherwise(F.format_number(value, scale))


def encode_decimal(value: Column, scale: int = 2, precision: int = 38) -> Column:
    """``decimal`` to the shortest two's-complement bytes of its unscaled integer.

    Up to 18 digits of ``precision``, the usual case, need 64-bit numbers only. Wider values lose
    their point as text, which no multiplication by a power of ten would do within 38 digits.
    """
    if precision <= 18:
        return F.unhex(_narrow_digits((value * F.lit(Decimal(10) ** scale)).cast("bigint")))
    unscaled = F.translate(_point_text(value, scale), ",.", "").cast("decimal(38,0)")
    narrow = unscaled.try_cast("bigint")
    return F.unhex(
        F.when(narrow.isNotNull(), _narrow_digits(narrow)).otherwise(_wide_digits(unscaled))
    )
