"""Status codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonicalise(code: Column, spellings: Mapping[str, Sequence[str]]) -> Column:
    """Canonical code for a spelling in any case; NULL for one that is not listed."""
    pairs = [(spelling, canonical) for canonical, accepted in spellings.items() for spelling in accepted]
    lookup = F.create_map(*[F.lit(text) for text in chain.from_iterable(pairs)])
    return lookup[F.lower(code)]
