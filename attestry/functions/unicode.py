"""What Spark has no function for: normal form C, case folding, control characters. Arrow UDFs, which get nulls for ASCII texts where those are as they should be."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attestry.functions.scalars import collapse_whitespace


@F.pandas_udf(T.StringType())
def nfc(values: pd.Series) -> pd.Series:
    return values.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


@F.pandas_udf(T.StringType())
def folded_name(values: pd.Series) -> pd.Series:
    """Normal form C, white space collapsed, case folded (which lower() is not)."""
    return values.map(lambda x: None if x is None else " ".join(unicodedata.normalize("NFC", x).split()).casefold())


@F.pandas_udf(T.BooleanType())
def has_control(values: pd.Series) -> pd.Series:
    """Whether a character of Unicode category C is in the text."""
    return values.map(lambda x: x is not None and any(unicodedata.category(c)[0] == "C" for c in x))


@F.pandas_udf(T.ArrayType(T.StringType()))
def nfc_each(values: pd.Series) -> pd.Series:
    return values.map(lambda xs: None if xs is None else [None if x is None else unicodedata.normalize("NFC", x) for x in xs])


def _wide(value: Column) -> Column:
    return value.rlike(r"[^\x00-\x7f]")


def normal_form(value: Column) -> Column:
    """Normal form C; texts of ASCII, which are in it, don't go to Python."""
    return F.coalesce(nfc(F.when(_wide(value), value)), value)


def normal_forms(values: Column) -> Column:
    """Normal form C of each text of an array."""
    return F.coalesce(nfc_each(F.when(F.exists(values, lambda x: F.coalesce(_wide(x), F.lit(False))), values)), values)


def folded(value: Column) -> Column:
    """Normal form C with white space collapsed and case folded; lower() does that for ASCII."""
    return F.coalesce(folded_name(F.when(_wide(value), value)), F.lower(collapse_whitespace(value)))
