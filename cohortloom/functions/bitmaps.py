"""Thirteen-slot activity bitmaps.

Slot 0 holds the current month, slots 1-12 the calendar months; bit ``d - 1`` of a slot
stands for day ``d``.
"""

from __future__ import annotations

from calendar import monthrange
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

SLOTS = 13


def day_bit(day: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), F.dayofmonth(day) - 1)


def slot_of(day: Column, current: date) -> Column:
    """0 for the current month, otherwise the calendar month."""
    in_current = (F.year(day) == current.year) & (F.month(day) == current.month)
    return F.when(in_current, F.lit(0)).otherwise(F.month(day))


def section_mask(first: int, last: int) -> int:
    return sum(1 << (d - 1) for d in range(first, last + 1))


def month_mask(year: int, month: int) -> int:
    return section_mask(1, monthrange(year, month)[1])


def interval_masks(start: date, end: date, current: date) -> list[int]:
    """Thirteen masks with every day of ``[start, end]`` set; none where the end is before the start."""
    masks = [0] * SLOTS
    if end < start:
        return masks
    year, month = start.year, start.month
    while (year, month) <= (end.year, end.month):
        first = start.day if (year, month) == (start.year, start.month) else 1
        last = end.day if (year, month) == (end.year, end.month) else monthrange(year, month)[1]
        slot = 0 if (year, month) == (current.year, current.month) else month
        masks[slot] |= section_mask(first, last)
        year, month = (year + 1, 1) if month == 12 else (year, month + 1)
    return masks


def hits(bitmap: Column, masks: list[int]) -> Column:
    """True when a day of the interval is set; a null bitmap hits nothing."""
    tests = [bitmap[slot].bitwiseAND(F.lit(mask)) != 0 for slot, mask in enumerate(masks) if mask]
    hit = F.lit(False)
    for test in tests:
        hit = hit | test
    return F.coalesce(hit, F.lit(False))


def misses(bitmap: Column, masks: list[int]) -> Column:
    """True when the bitmap exists and no day of the interval is set."""
    return bitmap.isNotNull() & ~hits(bitmap, masks)


def set_bits(bitmap: Column) -> Column:
    """Number of days set over all slots."""
    return F.aggregate(bitmap, F.lit(0), lambda acc, slot: acc + F.bit_count(slot))


def merge(left: Column, right: Column) -> Column:
    """Slot-wise OR; a null side counts as empty."""
    return F.coalesce(F.zip_with(left, right, lambda a, b: a.bitwiseOR(b)), left, right)


def close_month(bitmap: Column, month: int) -> Column:
    """Move slot 0 into its calendar month and clear it."""
    return F.transform(
        bitmap,
        lambda slot, i: F.when(i == month, bitmap[0]).when(i == 0, F.lit(0)).otherwise(slot),
    )
