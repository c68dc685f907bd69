"""Key-stable sampling: the same keys are kept on every run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillflow.checks import positive


def sample_slot(key: str, n: int) -> Column:
    """One of ``n`` slots for each key: the first 32 bits of the MD5 of its text, modulo n.

    A checksum that other engines have too, so that a sample can be checked elsewhere.
    """
    bits = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(bits, F.lit(positive("n", n))).cast("int")


def keep_one_in(key: str, n: int) -> Column:
    """Condition that keeps all rows of about one key in ``n``."""
    return sample_slot(key, n) == 0
