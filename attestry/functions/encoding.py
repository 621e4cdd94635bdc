"""Typed binary payloads and fingerprints as Catalyst expressions.

A value is a tag byte, its length in eight big-endian bytes and its bytes; sequences nest. Two rows have equal payloads only
if they have equal typed values, so that null, zero and the empty text stay apart.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Default domain and prefix of this engine's fingerprints; both are parameters.
DOMAIN = b"attestry/row/v1\x00"
PREFIX = "at1:"


def _typed(tag: str, payload: Column) -> Column:
    size = F.unhex(F.lpad(F.hex(F.octet_length(payload).cast("long")), 16, "0"))
    return F.concat(F.lit(tag.encode()), size, payload)


def encode_string(value: Column) -> Column:
    return _typed("S", value.cast("string").cast("binary"))


def encode_null() -> Column:
    return _typed("N", F.lit(b""))


def encode_hex(digits: Column) -> Column:
    """An integer from its hexadecimal digits."""
    return _typed("I", F.unhex(F.concat(F.when(F.length(digits) % 2 == 1, F.lit("0")).otherwise(F.lit("")), digits)))


def encode_integer(value: Column) -> Column:
    """A non-negative integer, or its digits, of any size, in as few bytes as it needs, zero in one."""
    return encode_hex(to_hex(value))


def encode_sequence(*values: Column) -> Column:
    return _typed("L", F.concat(F.lit(b""), *values))


def encode_array(values: Column) -> Column:
    """A sequence from an array of encoded values."""
    return _typed("L", F.aggregate(values, F.lit(b""), lambda acc, x: F.concat(acc, x)))


def nullable(encode: Callable[[Column], Column], value: Column) -> Column:
    return F.when(value.isNull(), encode_null()).otherwise(encode(value))


def encode_field(name: str, value: Column) -> Column:
    return encode_sequence(encode_string(F.lit(name)), value)


def payload(fields: Mapping[str, Column]) -> Column:
    """Named encoded values, in the order given."""
    return encode_sequence(*(encode_field(name, value) for name, value in fields.items()))


def sha256_hex(value: Column) -> Column:
    return F.sha2(value, 256)


def fingerprint(material: Column, domain: bytes = DOMAIN, prefix: str = PREFIX, digest: Callable[[Column], Column] = sha256_hex) -> Column:
    """prefix and the digest of domain and material. digest can be replaced, as tests do to force collisions."""
    return F.concat(F.lit(prefix), digest(F.concat(F.lit(domain), material)))


#: Digits that a long and a decimal hold.
LONG_DIGITS, DECIMAL_DIGITS = 18, 38


@F.pandas_udf(T.StringType())
def _far_to_hex(values: pd.Series) -> pd.Series:
    return values.map(lambda x: None if x is None else format(_number(x), "x"))


@F.pandas_udf(T.StringType())
def _far_from_hex(values: pd.Series) -> pd.Series:
    return values.map(lambda x: None if x is None else _digits(int(x, 16)))


def _number(digits: str) -> int:
    """int() of digits of any length, which int() itself bounds."""
    if len(digits) <= 4000:
        return int(digits)
    half = len(digits) // 2
    return _number(digits[:-half]) * 10**half + _number(digits[-half:])


def _digits(number: int) -> str:
    """str() of a number of any size, which str() itself bounds."""
    if number.bit_length() <= 13_000:
        return str(number)
    half = number.bit_length() // 7
    high, low = divmod(number, 10**half)
    return _digits(high) + _digits(low).zfill(half)


def to_hex(value: Column) -> Column:
    """Lower-case hexadecimal, without leading zeros, of a non-negative integer or of its digits, of any size; for transport.

    Up to 38 digits are built-in arithmetic; Python gets null for those and works on longer ones alone.
    """
    digits = value.cast("string")
    size = F.length(digits)
    whole = F.when(size <= DECIMAL_DIGITS, digits).cast("decimal(38,0)")
    limb = F.lit(1 << 56).cast("decimal(38,0)")
    low = F.pmod(whole, limb)
    rest = ((whole - low) / limb).cast("decimal(38,0)")
    middle = F.pmod(rest, limb)
    parts = [((rest - middle) / limb), middle, low]
    hexes = [F.lpad(F.lower(F.hex(x.cast("long"))), 14, "0") for x in parts]
    wide = F.regexp_replace(F.concat(*hexes), r"\A0+", "")
    far = _far_to_hex(F.when(size > DECIMAL_DIGITS, digits))
    return F.when(size <= LONG_DIGITS, F.lower(F.hex(digits.cast("long")))).when(size <= DECIMAL_DIGITS, wide).otherwise(far)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _each_far_to_hex(values: pd.Series) -> pd.Series:
    return values.map(lambda xs: None if xs is None else [None if x is None else format(_number(x), "x") for x in xs])


def all_to_hex(values: Column) -> Column:
    """to_hex() of each of an array's digits; arrays with a number beyond a long go to Python, the others as null."""
    far = F.exists(values, lambda x: F.coalesce(F.length(x) > LONG_DIGITS, F.lit(False)))
    near = F.transform(values, lambda x: F.lower(F.hex(F.when(F.length(x) <= LONG_DIGITS, x).cast("long"))))
    return F.coalesce(_each_far_to_hex(F.when(far, values)), near)


def from_hex(value: Column) -> Column:
    """The digits that to_hex() was given; null for text that it can't have made. Python gets those that don't fit a long alone."""
    good = value.rlike(r"\A(0|[1-9a-f][0-9a-f]*)\z")
    near = F.length(value) <= 15
    return F.when(good, F.when(near, F.conv(value, 16, 10)).otherwise(_far_from_hex(F.when(good & ~near, value))))
