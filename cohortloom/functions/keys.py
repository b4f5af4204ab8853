"""Entity-key digests, canonical forms and the cleaning chain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(key: Column, kind: str) -> Column:
    """Lower-case hex digest: ``md5``, ``md5_16`` (middle 16 digits) or ``sha256``."""
    if kind == "md5":
        return F.md5(key)
    if kind == "md5_16":
        return F.substring(F.md5(key), 9, 16)
    if kind == "sha256":
        return F.sha2(key, 256)
    raise ValueError(f"unknown digest {kind!r}")


def encrypt_text(value: Column, secret: Column, iv: Column) -> Column:
    """AES-CBC with PKCS padding; base64 text of iv + cipher."""
    return F.base64(F.aes_encrypt(value, secret, F.lit("CBC"), F.lit("PKCS"), iv))


def decrypt_text(value: Column, secret: Column) -> Column:
    """Inverse of :func:`encrypt_text`; null when the text does not decrypt."""
    plain = F.try_aes_decrypt(F.unbase64(value), secret, F.lit("CBC"), F.lit("PKCS"))
    return plain.cast("string")


def insert_colons(key: Column) -> Column:
    """``001122`` -> ``00:11:22``."""
    return F.regexp_replace(key, r"(.{2})(?=.)", "$1:")


def canonical(key: Column, case: str = "lower", colons: bool = False, kind: str | None = None) -> Column:
    """The join form of a plain key: trimmed, one letter case, optional colons, optional digest."""
    out = F.trim(key)
    out = F.upper(out) if case == "upper" else F.lower(out)
    if colons:
        out = F.when(F.contains(out, F.lit(":")), out).otherwise(insert_colons(out))
    return digest(out, kind) if kind else out


def check_digit(digits: Column) -> Column:
    """Luhn check digit of a digit string (weights 1, 2, 1, 2, ... from the left)."""
    doubled = F.transform(
        F.split(digits, ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            (d.cast("int") * 2) % 10 + F.floor(d.cast("int") * 2 / 10).cast("int")
        ),
    )
    total = F.aggregate(doubled, F.lit(0), lambda acc, d: acc + F.coalesce(d, F.lit(0)))
    return F.pmod(F.lit(10) - F.pmod(total, F.lit(10)), F.lit(10)).cast("string")


def clean(
    value: Column,
    lower: str | None = None,
    delete: Sequence[str] = (),
    fill_check_digit: bool = False,
) -> Column:
    """Cleaning chain: letter case (``"0"`` upper, anything else lower), regex
    deletions in order, and last the check digit of all-digit 14-character keys."""
    if lower is not None:
        value = F.upper(value) if lower == "0" else F.lower(value)
    for pattern in delete:
        value = F.regexp_replace(value, pattern, "")
    if fill_check_digit:
        value = F.when(value.rlike(r"^[0-9]{14}$"), F.concat(value, check_digit(value))).otherwise(value)
    return value


def is_valid_hex_key(key: Column, width: int = 40) -> Column:
    """Hex text of the given width that is not all zeros."""
    return F.coalesce(key.rlike(f"^[a-f0-9]{{{width}}}$") & ~key.rlike("^0+$"), F.lit(False))


def digest_elements(values: Column, kind: str) -> Column:
    return F.transform(values, lambda v: digest(v, kind))


def truncate_elements(values: Column, width: int) -> Column:
    """Elements cut to ``width`` characters; shorter ones are dropped."""
    return F.transform(
        F.filter(values, lambda v: F.length(v) >= width), lambda v: F.substring(v, 1, width)
    )


def numeric_elements(values: Column, times: Column) -> Column:
    """(value, time) pairs whose value is all digits, positions kept aligned."""
    pairs = F.zip_with(values, times, lambda v, t: F.struct(v.alias("value"), t.alias("time")))
    return F.filter(pairs, lambda p: p["value"].rlike("^[0-9]+$"))


def uncovered_digests(plain: Column, digests: Column, kind: str = "md5") -> Column:
    """``plain`` followed by the digests that no plain element covers."""
    return F.concat(plain, F.array_except(digests, digest_elements(plain, kind)))
