"""Spelling of names in filings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def spelling(c: Column) -> Column:
    """Letter case, blanks and a prefix up to a colon aside. Null stays null."""
    return F.upper(F.regexp_replace(F.regexp_replace(c, r"^[^:]*:", ""), r"[\s ​﻿]+", ""))
