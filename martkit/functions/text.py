"""Text clean-up with native string functions."""
from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, functions as F

_BLANK = r"(?U)\s"


@cache
def _decompositions() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """What compatibility decomposition makes of characters outside ASCII once all that is not ASCII is dropped.

    Characters with one ASCII character left are translated, those with none are dropped later, and those with several are
    replaced one by one; white space that decomposes to a blank is among the first.
    """
    one, to, more = [], [], []
    for code in range(128, 0x20000):
        c = chr(code)
        if 0xD800 <= code < 0xE000:
            continue
        # Decomposed after lower-casing, as the text is: what is left of it may be an upper-case letter.
        left = unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()
        if len(left) == 1:
            one.append(c)
            to.append(left)
        elif left:
            more.append((c, left))
    return "".join(one), "".join(to), tuple(more)


def strip_space(c: Column) -> Column:
    """Drop leading and trailing white space of any kind, no-break and wide spaces too (``trim`` removes blanks only)."""
    return F.regexp_replace(F.regexp_replace(c, rf"{_BLANK}+$", ""), rf"^{_BLANK}+", "")


def zero_pad(c: Column, width: int = 5) -> Column:
    """Left-pad with zeros and never truncate."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def fold_city(c: Column) -> Column:
    """Lower-case, strip, decompose (NFKD), drop what is not ASCII, collapse runs of white space."""
    one, to, more = _decompositions()
    plain = strip_space(F.lower(c))
    plain = F.when(plain.rlike(r"[^\x00-\x7F]"), _expanded(F.translate(plain, one, to), more)).otherwise(plain)
    return F.regexp_replace(F.regexp_replace(plain, r"[^\x00-\x7F]", ""), r"[\s\x1c-\x1f]+", " ")


def _expanded(c: Column, more: tuple[tuple[str, str], ...]) -> Column:
    """Characters that stand for several: looked up one by one, only in texts that hold one of them."""
    table = F.map_from_arrays(F.array(*[F.lit(k) for k, _ in more]), F.array(*[F.lit(v) for _, v in more]))
    spelled = F.array_join(F.transform(F.split(c, ""), lambda x: F.when(x.rlike(r"[^\x00-\x7F]"), F.coalesce(F.element_at(table, x), F.lit(""))).otherwise(x)), "")
    return F.when(c.rlike(r"[^\x00-\x7F]"), spelled).otherwise(c)


def title_case(c: Column) -> Column:
    """``health_beauty`` -> ``Health Beauty``."""
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def short_label(c: Column, prefix: str = "S-", length: int = 6) -> Column:
    return F.concat(F.lit(prefix), F.upper(F.substring(c.cast("string"), 1, length)))
