"""Cleaning of text columns. All of it is JVM-side column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings read as yes and as no, compared in lower case.
YES_WORDS = ("yes", "y", "true", "1")
NO_WORDS = ("no", "n", "false", "0")


def key_text(column: Column) -> Column:
    """Trim spaces. A blank key stays a blank key."""
    return F.trim(column)


def clean_text(column: Column) -> Column:
    """Trim spaces (only spaces; tabs stay) and read a blank as missing."""
    return F.nullif(F.trim(column), F.lit(""))


def yes_no(column: Column) -> Column:
    """Three-valued flag: yes words, no words, and NULL for everything else."""
    word = F.lower(F.trim(column.cast("string")))
    known = word.isin(*YES_WORDS, *NO_WORDS)
    return F.when(known, word.isin(*YES_WORDS))


def zip5(column: Column) -> Column:
    """ZIP number as text, zero-padded to five characters; longer numbers are cut to five."""
    return F.lpad(column.cast("string"), 5, "0")


def is_zip_cut(column: Column) -> Column:
    """True where :func:`zip5` loses digits, so that the loss can be counted."""
    return F.length(column.cast("string")) > 5
