"""Cleaning steps for the extended customer record, as Column expressions.

The reference describes these steps in its data-quality notes but leaves them undone:
upper-case addresses, one spelling for "Street", two-letter state codes, and "invalid" in
place of malformed e-mail style contact ids. The state lookup is a literal map inside the
expression (51 fixed entries), so it needs neither a join nor a broadcast.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# US state (and district) names with their two-letter postal codes,
# alphabetical by name.
US_STATES = (
    ("Alabama", "AL"),
    ("Alaska", "AK"),
    ("Arizona", "AZ"),
    ("Arkansas", "AR"),
    ("California", "CA"),
    ("Colorado", "CO"),
    ("Connecticut", "CT"),
    ("Delaware", "DE"),
    ("District of Columbia", "DC"),
    ("Florida", "FL"),
    ("Georgia", "GA"),
    ("Hawaii", "HI"),
    ("Idaho", "ID"),
    ("Illinois", "IL"),
    ("Indiana", "IN"),
    ("Iowa", "IA"),
    ("Kansas", "KS"),
    ("Kentucky", "KY"),
    ("Louisiana", "LA"),
    ("Maine", "ME"),
    ("Maryland", "MD"),
    ("Massachusetts", "MA"),
    ("Michigan", "MI"),
    ("Minnesota", "MN"),
    ("Mississippi", "MS"),
    ("Missouri", "MO"),
    ("Montana", "MT"),
    ("Nebraska", "NE"),
    ("Nevada", "NV"),
    ("New Hampshire", "NH"),
    ("New Jersey", "NJ"),
    ("New Mexico", "NM"),
    ("New York", "NY"),
    ("North Carolina", "NC"),
    ("North Dakota", "ND"),
    ("Ohio", "OH"),
    ("Oklahoma", "OK"),
    ("Oregon", "OR"),
    ("Pennsylvania", "PA"),
    ("Rhode Island", "RI"),
    ("South Carolina", "SC"),
    ("South Dakota", "SD"),
    ("Tennessee", "TN"),
    ("Texas", "TX"),
    ("Utah", "UT"),
    ("Vermont", "VT"),
    ("Virginia", "VA"),
    ("Washington", "WA"),
    ("West Virginia", "WV"),
    ("Wisconsin", "WI"),
    ("Wyoming", "WY"),
)

# Street suffix spellings folded to one form, and the contact-id shape.
STREET_PATTERN = r"\b(STREET|ST)\b\.?"
STREET_FORM = "ST"
CONTACT_PATTERN = r"^[^@\s]+@[^@\s]+\.[A-Za-z]{2,}$"
INVALID = "invalid"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def upper_address(c: Column | str) -> Column:
    return F.upper(_col(c))


def clean_street(c: Column | str) -> Column:
    """Upper case, and ``St.``/``St``/``Street`` folded to ``ST``."""
    return F.regexp_replace(F.upper(_col(c)), STREET_PATTERN, STREET_FORM)


def state_code(c: Column | str) -> Column:
    """Full state name (any case) to its code; anything else is kept, upper-cased."""
    lookup = F.create_map(
        *chain.from_iterable((F.lit(n.upper()), F.lit(code)) for n, code in US_STATES)
    )
    c = _col(c)
    return F.coalesce(F.try_element_at(lookup, F.upper(c)), F.upper(c))


def valid_contact(c: Column | str) -> Column:
    """The contact id when it looks like ``name@domain.tld``, else ``invalid``."""
    c = _col(c)
    return F.when(c.rlike(CONTACT_PATTERN), c).otherwise(F.lit(INVALID))
