"""Folds of documents by their id, as the queries fix them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def remainder(id_col: str, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds


def held_out(id_col: str, folds: int, fold: int) -> Column:
    return remainder(id_col, folds) == fold
