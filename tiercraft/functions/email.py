"""E-mail addresses: validity and the spellings one mailbox goes by."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tiercraft.functions.columns import trim_lower, trimmed

# What counts as an address, and the prefix and suffix that aliases carry.
ADDRESS_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
PREFIXED_ADDRESS = r"^10[^@]*@"
PREFIXED_DIGITS = r"^10[0-9]+$"
ALIAS_SUFFIX = ".st"


def valid_email(value: Column) -> Column:
    """Whether the trimmed text is an address; missing and blank text is not."""
    return F.coalesce(trimmed(value).rlike(ADDRESS_PATTERN), F.lit(False))


def local_part(address: Column) -> Column:
    """Text before the first ``@``; NULL when there is none."""
    return F.when(address.contains("@"), F.split_part(address, F.lit("@"), F.lit(1)))


def strip_prefix10(address: Column) -> Column:
    """The address without a leading ``10`` (whatever follows it); NULL when it has none."""
    return F.when(address.rlike(PREFIXED_ADDRESS), F.substr(address, F.lit(3)))


def email_variants(value: Column) -> dict[str, Column]:
    """The spellings the priority rules compare, NULL where a rule does not apply.

    ``without_10`` needs digits only after the ``10``, unlike :func:`strip_prefix10`.
    """
    address = trim_lower(value)
    before_at = F.split_part(address, F.lit("@"), F.lit(1))
    local = local_part(address)
    suffix = ALIAS_SUFFIX.replace(".", r"\.")
    return {
        "normalized": address,
        "without_10": F.when(before_at.rlike(PREFIXED_DIGITS), F.substr(address, F.lit(3))),
        "without_st": F.when(before_at.endswith(ALIAS_SUFFIX), F.regexp_replace(address, suffix + "@", "@")),
        "without_domain": local,
        "without_st_domain": F.when(local.endswith(ALIAS_SUFFIX), F.regexp_replace(local, suffix + "$", "")),
    }
