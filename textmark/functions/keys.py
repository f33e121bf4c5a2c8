"""Choices that depend only on a row's key, so they repeat exactly."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_digest(key: Column, salt: str = "") -> Column:
    """Hex digest that orders rows at random, the same way every time."""
    return F.md5(F.concat(F.lit(salt), key.cast("string")).cast("binary"))


def share_limit(share: float) -> str:
    """First eight hex digits below which a ``share`` of all digests lies."""
    if not 0.0 < share < 1.0:
        raise ValueError("a share lies strictly between 0 and 1")
    return format(math.ceil(share * 2**32), "08x")


def in_share(key: Column, share: float, salt: str = "") -> Column:
    """True for about ``share`` of the keys."""
    return F.substring(key_digest(key, salt), 1, 8) < F.lit(share_limit(share))
