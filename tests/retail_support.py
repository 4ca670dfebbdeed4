"""Helpers that test modules import (fixtures stay in ``conftest.py``, whose module name
other test folders share)."""

from __future__ import annotations

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")
