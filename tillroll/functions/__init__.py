from tillroll.functions.clean import clean_street, state_code, upper_address, valid_contact
from tillroll.functions.money import as_double, cents, sum_cents, total
from tillroll.functions.parse import integer, money, timestamp

__all__ = [
    "as_double",
    "clean_street",
    "cents",
    "integer",
    "money",
    "state_code",
    "sum_cents",
    "timestamp",
    "total",
    "upper_address",
    "valid_contact",
]
