"""Property tests: the Column parsers against plain-Python models of the rules."""

from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.functions import parse as P

ALPHABET = st.sampled_from(list("0123456789.,$-() eE") + ["N/A", "٣", "é", "|"])


def model_money(text: str | None) -> float:
    """Keep ASCII digits and dots, parse as a number, 0.0 when that fails."""
    if text is None:
        return 0.0
    kept = "".join(ch for ch in text if ch in "0123456789.")
    try:
        return float(kept)
    except ValueError:
        return 0.0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(ALPHABET, max_size=12).map("".join)), min_size=50, max_size=200))
def test_money_matches_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(P.money("s")).collect()]
    assert got == [model_money(t) for t in texts]


STAMPS = st.datetimes(min_value=dt.datetime(1000, 1, 1), max_value=dt.datetime(9999, 12, 31)).map(
    lambda d: d.replace(microsecond=0)
)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(STAMPS, st.booleans()), min_size=50, max_size=200))
def test_timestamp_round_trip(spark, stamps):
    def text(d, padded):
        if padded:
            return d.strftime("%m/%d/%Y %H:%M:%S")
        return f"{d.month}/{d.day}/{d.year} {d.hour}:{d.minute}:{d.second}"

    df = spark.createDataFrame([(text(d, p),) for d, p in stamps], "s string")
    got = [r[0] for r in df.select(P.timestamp("s")).collect()]
    assert got == [d for d, _ in stamps]


@settings(max_examples=5, deadline=None)
@given(st.lists(STAMPS, min_size=20, max_size=100))
def test_format_then_parse_is_identity(spark, stamps):
    df = spark.createDataFrame([(d,) for d in stamps], "t timestamp_ntz")
    for padded in (True, False):
        back = df.select(P.timestamp(P.format_timestamp("t", padded=padded))).collect()
        assert [r[0] for r in back] == stamps
