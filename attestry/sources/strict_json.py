"""JSON without leniency: duplicate keys, NaN, infinities and trailing text are errors, which from_json accepts silently."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def loads(text: str):
    def pairs(items):
        if len({k for k, _ in items}) != len(items):
            raise ValueError("duplicate key")
        return dict(items)

    def constant(name):
        raise ValueError(f"{name} is not JSON")

    return json.loads(text, object_pairs_hook=pairs, parse_constant=constant)


@F.pandas_udf(T.StringType())
def canonical_json(values: pd.Series) -> pd.Series:
    """The value with sorted keys and no spaces; null for text that is not strict JSON."""

    def one(text):
        try:
            return None if text is None else json.dumps(loads(text), sort_keys=True, ensure_ascii=False, separators=(",", ":"))
        except (ValueError, RecursionError):
            return None

    return values.map(one)


CELLS = "array<struct<heading:string,salary_text:string,marker_text:string>>"


@F.pandas_udf(T.StringType())
def checked_cells(values: pd.Series) -> pd.Series:
    """Cells as canonical JSON, or `!` and the code of the first thing wrong with them."""
    names = {"heading", "salary_text", "marker_text"}

    def one(text):
        try:
            cells = loads(text or "")
        except (ValueError, RecursionError):
            return "!invalid_json"
        if not isinstance(cells, list) or not cells:
            return "!wrong_json_shape"
        if any(not isinstance(c, dict) or c.keys() != names for c in cells):
            return "!invalid_cell_shape"
        if any(not isinstance(x, str) for c in cells for x in c.values()):
            return "!invalid_cell_type"
        return json.dumps(cells, ensure_ascii=False)

    return values.map(one)


_CODE = T.StructType([T.StructField("code", T.StringType()), T.StructField("cell", T.IntegerType())])
_CELL = T.StructType([T.StructField(n, T.StringType()) for n in ("heading", "salary_text", "marker_text")])


@F.pandas_udf(T.StructType([T.StructField("codes", T.ArrayType(_CODE)), T.StructField("cells", T.ArrayType(_CELL))]))
def cell_report(values: pd.Series) -> pd.DataFrame:
    """The cells of a JSON text, null for those of another shape or type, and the codes of what the text itself breaks; nulls for null."""
    names = {"heading", "salary_text", "marker_text"}

    def one(text):
        if text is None:
            return None, None
        try:
            cells = loads(text)
        except (ValueError, RecursionError):
            return [{"code": "invalid_json", "cell": 0}], None
        if not isinstance(cells, list) or not cells:
            return [{"code": "wrong_json_shape", "cell": 0}], None
        codes, out = [], []
        for i, c in enumerate(cells, start=1):
            shape = isinstance(c, dict) and c.keys() == names
            sound = shape and all(isinstance(x, str) for x in c.values())
            if not sound:
                codes.append({"code": "invalid_cell_type" if shape else "invalid_cell_shape", "cell": i})
            out.append(c if sound else None)
        return codes, out

    return pd.DataFrame([one(x) for x in values], columns=["codes", "cells"])
