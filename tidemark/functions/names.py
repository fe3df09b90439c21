"""Snake-case column names, free of duplicates. Metadata only, no job runs."""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import DataFrame

SMALL_OR_DIGIT = frozenset(string.ascii_lowercase + string.digits)
CAPITAL = frozenset(string.ascii_uppercase)


def begins_word(before: str, here: str, after: str) -> bool:
    """A capital that follows a small letter or digit, or that ends a run of capitals before a small letter."""
    if here not in CAPITAL:
        return False
    return before in SMALL_OR_DIGIT or before in CAPITAL and after in string.ascii_lowercase


def snake_case(name: str) -> str:
    """``'Price Per Unit'`` → ``price_per_unit``; other than ASCII letters and digits are dropped;
    a name left empty is ``col``."""
    words = [""]
    for before, here, after in zip(" " + name, name, name[1:] + " "):
        if here in "._-" or here.isspace() or begins_word(before, here, after):
            words.append("")
        if here in SMALL_OR_DIGIT or here in CAPITAL:
            words[-1] += here.lower()
    return "_".join(filter(None, words)) or "col"


def unique_names(names: Iterable[str]) -> list[str]:
    """A name that is taken gets the least number from 2 that makes it free."""
    taken: set[str] = set()
    number: dict[str, int] = {}

    def free(name: str) -> str:
        if name in taken:
            number.setdefault(name, 2)
            while f"{name}_{number[name]}" in taken:
                number[name] += 1
            name = f"{name}_{number[name]}"
        taken.add(name)
        return name

    return [free(name) for name in names]


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*unique_names(map(snake_case, df.columns)))
