from rowtide.functions.decimals import decode_decimal, encode_decimal
from rowtide.functions.scalars import capitalise, money, uniform, uniform_int
from rowtide.functions.times import (
    from_micros,
    from_millis,
    to_micros,
    to_millis,
    utc_date,
    zoneless_utc,
)

__all__ = [
    "capitalise",
    "decode_decimal",
    "encode_decimal",
    "from_micros",
    "from_millis",
    "money",
    "to_micros",
    "to_millis",
    "uniform",
    "uniform_int",
    "utc_date",
    "zoneless_utc",
]
