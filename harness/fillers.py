"""Values for pitch columns that no given table has, by one rule on both engines."""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column, functions as F

from sabermill.schemas import RAW

# Pitch columns by name with their kind: "i", "s" or "d" and the decimal places.
TYPES = re.compile(r"(\w+) (INT|STRING|DECIMAL\(\d+,(\d+)\))")
KINDS = {
    name: {"I": "i", "S": "s", "D": f"d{places}"}[kind[0]]
    for name, kind, places in TYPES.findall(RAW["statcast"])
}
NUMBERS = {name: i for i, name in enumerate(KINDS)}


def value(name: str, floating: bool = False) -> Column:
    """The column's value over line items; ``floating`` as it lands in files."""
    i, kind, part = NUMBERS[name], KINDS[name], F.col("l_partkey")
    if kind == "s":
        return F.concat(F.lit("v"), ((part + i) % 5).cast("string"))
    n = (part * 3 + i) % 300
    if floating:
        return n / F.lit(10.0 ** int(kind[1:] or 0)) if kind != "i" else n.cast("double")
    places = int(kind[1:] or 0)
    return n if kind == "i" else (n.cast("decimal(10,0)") * F.lit(Decimal(1).scaleb(-places))).cast(f"decimal(10,{places})")


def sql(name: str) -> str:
    """The same in SQL; decimals as whole numbers of their last place."""
    i = NUMBERS[name]
    return f"'v' || ((l_partkey + {i}) % 5)" if KINDS[name] == "s" else f"(l_partkey * 3 + {i}) % 300"
