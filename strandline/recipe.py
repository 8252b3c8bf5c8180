"""Data recipes: nested steps, as they stand in YAML, become one DataFrame plan.

A step is ``{"collate": [steps]}``, ``{"product": name, "measurements": […], "filters": {column: [low, high] or value}}``, or
``{"transform": "expressions" or "apply_mask", "input": step, …}``. Formulas are SQL expressions; ``==``, ``|`` and ``&``
of the usual notation are understood. Masks keep rows and make measurements NULL where they don't hold.
"""

import re
from collections.abc import Mapping
from typing import Any

import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators.composites import collate

#: Columns that identify an observation: every step keeps them as they are.
KEYS = ("tile", "time", "solar_day", "yi", "xi", "y", "x", "sensor", "scene")
_CASTS = {"float32": "float", "float64": "double", "int16": "smallint", "int32": "int", "bool": "boolean"}


def load_config(text: str) -> dict:
    """YAML text to a dict."""
    return yaml.safe_load(text)


def formula_sql(formula: str) -> str:
    """A formula as SQL: comparisons and logic renamed, divisions that give NULL for a zero divisor."""
    out = re.sub(r"==", "=", formula)
    out = re.sub(r"\s*&\s*", " AND ", re.sub(r"\s*\|\s*", " OR ", out))
    whole = re.fullmatch(r"\s*(\([^()]*\)|\w+)\s*/\s*(\([^()]*\)|\w+)\s*", out)
    return f"try_divide(CAST({whole[1]} AS DOUBLE), {whole[2]})" if whole else out


def build(step: Mapping[str, Any], products: Mapping[str, DataFrame]) -> DataFrame:
    """The plan of a step over the named products; filters and columns reach the scans by themselves."""
    if "recipe" in step:
        return build(step["recipe"], products)
    if "collate" in step:
        return collate({s.get("product", str(i)): build(s, products) for i, s in enumerate(step["collate"])})
    if "product" in step:
        df = products[step["product"]]
        for column, want in step.get("filters", {}).items():
            df = df.where(F.col(column).between(*want) if isinstance(want, list) else F.col(column) == want)
        names = step.get("measurements")
        keys = [c for c in df.columns if c in KEYS]
        return df.select(*keys, *(n for n in names if n not in keys)) if names else df
    source = build(step["input"], products)
    if step["transform"] == "expressions":
        made = {}
        for name, how in step["output"].items():
            how = how if isinstance(how, Mapping) else {"formula": how}
            value = F.expr(formula_sql(str(how["formula"])))
            made[name] = value.cast(_CASTS[how["dtype"]]) if how.get("dtype") in _CASTS else value
        keys = [c for c in source.columns if c in KEYS]
        return source.select(*(k for k in keys if k not in made), *(v.alias(k) for k, v in made.items()))
    if step["transform"] == "apply_mask":
        mask = step["mask_measurement_name"]
        return source.withColumns({c: F.when(F.col(mask), F.col(c)) for c in source.columns if c not in (*KEYS, mask)}).drop(mask)
    raise ValueError(f"unknown step: {dict(step)}")
