"""Table specs for the five pipe-delimited input files.

A spec lists the fields in file order (position matters: there is no header) and the kind
of each one. Kinds decide the parser and the Spark type:

* ``text``   string, kept as is (names keep trailing blanks; nothing is trimmed)
* ``money``  double via :func:`tillroll.functions.parse.money`
* ``stamp``  timestamp_ntz via :func:`tillroll.functions.parse.timestamp`
* ``int``    int via :func:`tillroll.functions.parse.integer`

``groups`` folds consecutive fields into a struct column (the three addresses of the
extended customer record).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

SEPARATOR = "|"

_TYPES = {
    "text": T.StringType(),
    "money": T.DoubleType(),
    "stamp": T.TimestampNTZType(),
    "int": T.IntegerType(),
}


@dataclass(frozen=True)
class TableSpec:
    name: str
    fields: tuple[tuple[str, str], ...]
    # struct name -> (first field index, struct field names)
    groups: tuple[tuple[str, int, tuple[str, ...]], ...] = field(default=())
    # trailing fields that a good line may lack (they are then empty)
    optional: int = 0

    @property
    def arity(self) -> int:
        return len(self.fields)

    @property
    def required(self) -> int:
        return self.arity - self.optional

    def flat_schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, _TYPES[k]) for n, k in self.fields])

    def schema(self) -> T.StructType:
        """Typed output schema, with grouped fields folded into structs."""
        if not self.groups:
            return self.flat_schema()
        grouped = {}
        for struct_name, start, names in self.groups:
            for i in range(len(names)):
                grouped[start + i] = (struct_name, start)
        out = []
        for i, (n, k) in enumerate(self.fields):
            if i not in grouped:
                out.append(T.StructField(n, _TYPES[k]))
                continue
            struct_name, start = grouped[i]
            if i != start:
                continue
            names = next(g[2] for g in self.groups if g[0] == struct_name)
            kinds = [self.fields[start + j][1] for j in range(len(names))]
            out.append(
                T.StructField(
                    struct_name,
                    T.StructType(
                        [T.StructField(sn, _TYPES[sk]) for sn, sk in zip(names, kinds)]
                    ),
                )
            )
        return T.StructType(out)


ADDRESS_FIELDS = ("street_address", "city", "state", "country", "zip")


def _address(prefix: str) -> tuple[tuple[str, str], ...]:
    return tuple((f"{prefix}_{f}", "text") for f in ADDRESS_FIELDS)


# Field order of each input file, as the files are laid out.
PRODUCT = TableSpec(
    "product",
    (
        ("product_id", "text"),
        ("product_name", "text"),
        ("product_type", "text"),
        ("product_version", "text"),
        ("product_price", "money"),
    ),
)

SALES = TableSpec(
    "sales",
    (
        ("transaction_id", "text"),
        ("customer_id", "text"),
        ("product_id", "text"),
        ("timestamp", "stamp"),
        ("total_amount", "money"),
        ("total_quantity", "int"),
    ),
)

REFUND = TableSpec(
    "refund",
    (
        ("refund_id", "text"),
        ("original_transaction_id", "text"),
        ("customer_id", "text"),
        ("product_id", "text"),
        ("timestamp", "stamp"),
        ("refund_amount", "money"),
        ("refund_quantity", "int"),
    ),
    # a refund whose amount and quantity are missing is one of 0.0
    optional=2,
)

CUSTOMER = TableSpec(
    "customer",
    (
        ("customer_id", "text"),
        ("customer_first_name", "text"),
        ("customer_last_name", "text"),
        ("phone_number", "text"),
    ),
)

CUSTOMER_EXTENDED = TableSpec(
    "customer_extended",
    (
        ("id", "text"),
        ("first_name", "text"),
        ("last_name", "text"),
        ("home_phone", "text"),
        ("mobile_phone", "text"),
        ("gender", "text"),
        *_address("current"),
        *_address("permanent"),
        *_address("office"),
        ("personal_email_address", "text"),
        ("work_email_address", "text"),
        ("twitter_id", "text"),
        ("facebook_id", "text"),
        ("linkedin_id", "text"),
    ),
    groups=(
        ("current_address", 6, ADDRESS_FIELDS),
        ("permanent_address", 11, ADDRESS_FIELDS),
        ("office_address", 16, ADDRESS_FIELDS),
    ),
)

SPECS = {s.name: s for s in (PRODUCT, SALES, REFUND, CUSTOMER, CUSTOMER_EXTENDED)}

# Written at ingest for extended customers: upper(current street), so an address search
# is a plain column equality that parquet can filter with statistics and dictionaries.
STREET_KEY = "_current_street"

# File name of each table inside a data directory.
FILE_NAMES = {
    "product": "Product.txt",
    "sales": "Sales.txt",
    "refund": "Refund.txt",
    "customer": "Customer.txt",
    "customer_extended": "Customer_Extended.txt",
}
