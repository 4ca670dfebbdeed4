"""Q7: all details of the customers living at a street address."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.sources.schema import STREET_KEY


def customers_at_address(
    customers_extended: DataFrame,
    street: str,
    address: str = "current_address",
    pattern: bool = False,
) -> DataFrame:
    """Rows whose ``address.street_address`` equals ``street``, ignoring case.

    The reference compares with LIKE and no wildcard, which Catalyst turns into an
    equality; equality is the default so ``%`` or ``_`` in an address stay literal.
    ``pattern=True`` keeps LIKE semantics for callers that pass wildcards.
    """
    column = F.upper(F.col(f"{address}.street_address"))
    if pattern:
        return customers_extended.filter(column.like(street.upper()))
    cond = column == F.lit(street.upper())
    if address == "current_address" and STREET_KEY in customers_extended.columns:
        # the ingested key equals upper(street): a plain column equality parquet can push
        cond = (F.col(STREET_KEY) == F.lit(street.upper())) & cond
    return customers_extended.filter(cond)
