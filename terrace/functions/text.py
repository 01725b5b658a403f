"""Text standardisation."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Connectives written in lower case inside a name.
CONNECTIVES = ("De", "Da", "Do", "Das", "Dos", "E")


def squeeze(col: Column) -> Column:
    """Runs of white space become one blank, none at either end."""
    return F.trim(F.regexp_replace(col, r"\s+", " "))


def standardize_name(
    col: Column, connectives: Sequence[str] = CONNECTIVES, separator: str = "-",
) -> Column:
    """Capitalise every word and every hyphenated part; connectives that
    are neither first nor last word go to lower case.

    A blank put after each separator lets one ``initcap`` see the parts as words.
    Connectives with the same initial share one replacement, which lowers the
    initial and keeps the rest.
    """
    seam = f"{separator}\u0001 "
    parts = F.replace(squeeze(col), F.lit(separator), F.lit(seam))
    name = F.replace(F.initcap(parts), F.lit(seam), F.lit(separator))
    by_initial: dict[str, list[str]] = {}
    for word in connectives:
        by_initial.setdefault(word[0], []).append(re.escape(word[1:]))
    for initial, rests in by_initial.items():
        inner = rf"(?<=[ {re.escape(separator)}]){initial}({'|'.join(rests)})(?= )"
        name = F.regexp_replace(name, inner, f"{initial.lower()}$1")
    return name
