"""Small literal tables with the edge cases of the six questions (FIXTURES.md section 4)."""

from __future__ import annotations

import datetime as dt

from tillroll.sources.schema import CUSTOMER, PRODUCT, REFUND, SALES


def ts(y, m, d, h=10):
    return dt.datetime(y, m, d, h, 0, 0)


PRODUCTS = [
    ("P1", "Desktop ", "P106", "v1", 900.0),
    ("P2", "Laptop ", "P105", "v1", 700.0),
    ("P3", "Tablet ", "P105", "v2", 300.0),
    ("P4", "Drone ", "P102", "v1", 100.0),  # never sold
    ("P5", "Laptop ", "P105", "v2", 750.0),  # same name/type as P2
]

CUSTOMERS = [
    ("C1", "ANN", "LEE", "1"),
    ("C2", "BOB", "RAY", "2"),
    ("C3", "", "NOFIRST", "3"),  # blank first name
    ("C4", "DAN", "FOX", "4"),
    ("C5", "EVE", "KIM", "5"),
]

SALES_ROWS = [
    # May 2013
    ("T1", "C1", "P1", ts(2013, 5, 1), 1000.0, 1),  # two partial refunds
    ("T2", "C2", "P2", ts(2013, 5, 2), 700.0, 1),
    ("T3", "C3", "P3", ts(2013, 5, 3), 400.0, 1),  # ties with C4 at 400
    ("T4", "C4", "P2", ts(2013, 5, 3), 400.0, 1),
    ("T5", "CX", "P3", ts(2013, 5, 4), 50.0, 1),  # customer unknown to the customer table
    ("T6", "C5", "P5", ts(2013, 5, 5, 9), 100.0, 1),  # repeat: same day/product/customer
    ("T7", "C5", "P5", ts(2013, 5, 5, 17), 100.0, 1),
    ("T8", "C5", "P3", ts(2013, 5, 5, 9), 10.0, 1),  # C5 repeats a second product
    ("T9", "C5", "P3", ts(2013, 5, 5, 11), 10.0, 1),
    # other months / years
    ("T10", "C1", "P1", ts(2013, 7, 1), 500.0, 1),  # refunded in 2012 (before the sale)
    ("T11", "C2", "P2", ts(2012, 5, 1), 300.0, 1),
    ("T12", "C3", "P3", ts(2014, 6, 1), 200.0, 1),  # a month with a single customer
]

REFUND_ROWS = [
    ("R1", "T1", "C1", "P1", ts(2013, 5, 10), 100.0, 1),
    ("R2", "T1", "C1", "P1", ts(2013, 6, 10), 150.0, 1),
    ("R3", "T10", "C1", "P1", ts(2012, 12, 1), 50.0, 1),  # dated before its sale
    ("R4", "T2", "C2", "P2", ts(2013, 5, 20), 700.0, 1),  # full refund
]


def frames(spark):
    return {
        "product": spark.createDataFrame(PRODUCTS, PRODUCT.schema()),
        "customer": spark.createDataFrame(CUSTOMERS, CUSTOMER.schema()),
        "sales": spark.createDataFrame(SALES_ROWS, SALES.schema()),
        "refund": spark.createDataFrame(REFUND_ROWS, REFUND.schema()),
    }
