"""Column expressions; all of them stay inside the JVM."""

from .dates import day_first_date, day_first_parts, days_between
from .email import email_domain, email_validity
from .money import cents, exact, exact_sum

__all__ = [
    "cents",
    "day_first_date",
    "day_first_parts",
    "days_between",
    "email_domain",
    "email_validity",
    "exact",
    "exact_sum",
]
