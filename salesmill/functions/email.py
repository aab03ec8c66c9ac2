"""E-mail domain and validity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Both patterns decide which results come out.
DOMAIN_PATTERN = r"@(.+)$"
ADDRESS_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def email_domain(email: Column | str) -> Column:
    """What follows the first ``@``; null for a null address or one without ``@``."""
    return F.nullif(F.regexp_extract(email, DOMAIN_PATTERN, 1), F.lit(""))


def email_validity(email: Column | str) -> Column:
    """``Yes`` for a well-formed address, ``No`` for any other, null included."""
    well_formed = F.regexp_like(email, F.lit(ADDRESS_PATTERN))
    return F.when(well_formed, F.lit("Yes")).otherwise(F.lit("No"))
