"""Scalar text expressions used by reports and exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortloom.functions import maps


def plain_number(value: Column, places: int = 6) -> Column:
    """Number as text without an exponent and without trailing zeros."""
    text = value.cast(f"decimal(38,{places})").cast("string")
    return F.when(
        F.contains(text, F.lit(".")), F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", "")
    ).otherwise(text)


def four_places(value: Column) -> Column:
    """Double as text with four places, rounded half up."""
    return F.round(value.cast("decimal(38,12)"), 4).cast("decimal(38,4)").cast("string")


def pack_nonzero(names: Sequence[str], values: Sequence[Column]) -> Column:
    """``"name,name=value,value"`` over the values that are neither blank nor zero; numbers with a
    decimal point are rounded to four places."""
    cells = F.array(
        *[F.struct(F.lit(n).alias("n"), v.cast("string").alias("v")) for n, v in zip(names, values, strict=True)]
    )
    # Patterns instead of casts: a failed cast of ordinary text is far slower than a test.
    rounded = F.transform(
        cells,
        lambda c: F.struct(
            c["n"].alias("n"),
            F.when(c["v"].rlike(r"^[+-]?[0-9]*\.[0-9]+$"), four_places(c["v"])).otherwise(c["v"]).alias("v"),
        ),
    )
    kept = F.filter(rounded, lambda c: ~(maps.is_blank(c["v"]) | c["v"].rlike(r"^[+-]?0*\.?0*$")))
    # A one-element array binds the list once for both halves of the text.
    packed = F.transform(
        F.array(kept),
        lambda k: F.when(
            F.size(k) > 0,
            F.concat(
                F.array_join(F.transform(k, lambda c: c["n"]), ","),
                F.lit("="),
                F.array_join(F.transform(k, lambda c: c["v"]), ","),
            ),
        ),
    )
    return packed[0]


def flatten_struct(names: Sequence[str], values: Sequence[Column], separator: str = ",") -> Column:
    """``k=v,k=v`` text of the given fields; null values print as empty."""
    return F.concat_ws(
        separator,
        *[F.concat(F.lit(f"{n}="), F.coalesce(v.cast("string"), F.lit(""))) for n, v in zip(names, values, strict=True)],
    )


def unhex_text(value: Column) -> Column:
    return F.unhex(value).cast("string")


def strip_suffix(value: Column, suffix: str, exceptions: dict[str, str]) -> Column:
    """Drop ``suffix`` from the end; names listed in ``exceptions`` map as given."""
    out = F.when(
        F.endswith(value, F.lit(suffix)), F.substr(value, F.lit(1), F.length(value) - len(suffix))
    ).otherwise(value)
    for name, target in exceptions.items():
        out = F.when(value == name, F.lit(target)).otherwise(out)
    return out


def code_of(value: Column, codes: dict[str, str], default: str) -> Column:
    """Fixed name -> code table with a default for blank and unknown names."""
    out = F.lit(default)
    for name, code in codes.items():
        out = F.when(value == name, F.lit(code)).otherwise(out)
    return out
