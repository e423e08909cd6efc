"""Item text and category path helpers.

The original split with Java's ``String.split``, which drops trailing empty
tokens; Spark's ``split`` keeps them.  Trailing separators are therefore
removed before splitting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(text: Column) -> Column:
    """Lower-cased words split on single spaces (inner empty tokens kept)."""
    return F.split(F.regexp_replace(F.lower(text), " +$", ""), " ")


def category_of_path(cat_path: Column) -> Column:
    """Second part of an 'a-b-c' path if it has two or more parts, else the first."""
    parts = F.split(F.regexp_replace(cat_path, "-+$", ""), "-")
    return F.when(F.size(parts) >= 2, parts.getItem(1)).otherwise(parts.getItem(0))
