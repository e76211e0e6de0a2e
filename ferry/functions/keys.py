"""Identity match keys built from e-mail-like strings.

A key is ``local@label``: the text before the first ``@``, then the first domain label (the text
after the first ``@`` up to the first dot), with company aliases folded to one label, all
lower-cased. ``a@b@c.com`` gives ``a@b@c``; a value without ``@`` gives ``value@``; ``''`` gives
``@``; null stays null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ferry.constants import DOMAIN_ALIASES, DOMAIN_CANONICAL

_FIRST_LABEL = r"@([^.]+)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def domain_label(c: str | Column) -> Column:
    """First domain label after the first ``@``; ``''`` when there is none."""
    return F.regexp_extract(_col(c), _FIRST_LABEL, 1)


def fold_label(label: Column, aliases: Sequence[str] = DOMAIN_ALIASES,
               canonical: str = DOMAIN_CANONICAL, case_insensitive: bool = False) -> Column:
    """Map alias labels to the canonical label.

    By default the label is compared as written (``BigCo`` is not an alias of ``bigco``), which
    is what the original jobs did; ``case_insensitive=True`` compares it lower-cased.
    """
    probe = F.lower(label) if case_insensitive else label
    if not aliases:
        return label
    return F.when(probe.isin(list(aliases)), F.lit(canonical)).otherwise(label)


def email_match_key(c: str | Column, aliases: Sequence[str] = DOMAIN_ALIASES,
                    canonical: str = DOMAIN_CANONICAL, case_insensitive: bool = False) -> Column:
    """``lower(local_part || '@' || fold(first_label))``; null in, null out."""
    value = _col(c)
    local = F.substring_index(value, "@", 1)
    label = fold_label(domain_label(value), aliases, canonical, case_insensitive)
    return F.lower(F.concat(local, F.lit("@"), label))
