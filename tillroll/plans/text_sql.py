"""The load in SQL: text lines to typed views by temporary SQL functions.

The reference's SQL program parses its files in Scala before it registers views.  Here the
SQL formulation starts at the lines: ``register_functions`` creates the field parsers as SQL
functions (``CREATE TEMPORARY FUNCTION ... RETURN``), which are inlined into the plan like
the Column expressions of ``functions.parse``; ``parse_sql`` writes the statement that turns a
view of lines into a typed table; ``register_text_views`` makes the five views of a folder, on
which the statements of ``plans.sql`` run.  No Python takes part in the plans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.functions.parse import MONEY_DROP, TIMESTAMP_LAYOUT
from tillroll.plans.sql import _prefix
from tillroll.sources.schema import FILE_NAMES, SPECS, TableSpec
from tillroll.sources.text import BAD_INTEGER, BAD_TIMESTAMP, SHORT_LINE

# view of each table, as the SQL statements name it
VIEW_NAMES = {"customer_extended": "customer_extnd"}


def register_functions(spark: SparkSession, prefix: str = "") -> None:
    """``<prefix>money(text)``, ``<prefix>signed_money(text)``, ``<prefix>stamp(text)`` and
    ``<prefix>whole(text)``: double, double, timestamp_ntz and int, as ``functions.parse``."""
    p = _prefix(prefix)
    value = f"coalesce(try_cast(regexp_replace(s, r'{MONEY_DROP}', '') AS DOUBLE), 0.0D)"
    bodies = {
        "money": ("DOUBLE", value),
        "signed_money": (
            "DOUBLE",
            f"{value} * CASE WHEN {value} <> 0 AND s RLIKE r'^\\s*(-|\\()' THEN -1.0D ELSE 1.0D END",
        ),
        "stamp": (
            "TIMESTAMP_NTZ",
            f"try_cast(CASE WHEN s RLIKE r'{TIMESTAMP_LAYOUT}' THEN "
            f"regexp_replace(s, r'{TIMESTAMP_LAYOUT}', '$3-$1-$2 $4') END AS TIMESTAMP_NTZ)",
        ),
        "whole": ("INT", "try_cast(s AS INT)"),
    }
    for name, (kind, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {p}{name}(s STRING) RETURNS {kind} RETURN {body}")


def _flagged(spec: TableSpec, lines: str, p: str) -> str:
    checked, reasons = [], [f"WHEN coalesce(size(parts) < {spec.required}, true) THEN '{SHORT_LINE}'"]
    for i, (name, kind) in enumerate(spec.fields):
        if kind == "stamp":
            checked.append(f"{p}stamp(get(parts, {i})) AS {name}")
            reasons.append(f"WHEN {name} IS NULL THEN '{BAD_TIMESTAMP}'")
        elif kind == "int":
            checked.append(f"{p}whole(get(parts, {i})) AS {name}")
            reasons.append(f"WHEN length(get(parts, {i})) > 0 AND {name} IS NULL THEN '{BAD_INTEGER}'")
    return f"""split_lines AS (SELECT value, split(value, r'\\|', -1) AS parts FROM {lines}),
        checked AS (SELECT {', '.join(['value', 'parts', *checked])} FROM split_lines),
        flagged AS (SELECT *, CASE {' '.join(reasons)} END AS reason FROM checked)"""


def parse_sql(
    spec: TableSpec | str, lines: str, prefix: str = "", mode: str = "quarantine",
    signed_money: bool = False,
) -> str:
    """The statement that gives the good rows of the lines in the view ``lines``.

    As in ``sources.text.parse``, good lines come out of a generator that carries the split
    line and its checked fields, so the checks run once and other fields only if they are read.
    """
    spec, p = SPECS[spec] if isinstance(spec, str) else spec, _prefix(prefix)
    if mode not in ("quarantine", "failfast"):
        raise ValueError(f"unknown mode {mode!r}")
    names = [n for n, kind in spec.fields if kind in ("stamp", "int")]
    row = "array(named_struct('parts', parts" + "".join(f", '{n}', {n}" for n in names) + "))"
    bad = "raise_error(concat(reason, ': ', coalesce(value, '')))" if mode == "failfast" else "NULL"
    money = f"{p}signed_money" if signed_money else f"{p}money"

    def field(i: int) -> str:
        name, kind = spec.fields[i]
        if kind == "money":
            return f"{money}(get(good.parts, {i}))"
        return f"good.{name}" if kind in ("stamp", "int") else f"get(good.parts, {i})"

    columns, i = [], 0
    groups = {start: (name, fields) for name, start, fields in spec.groups}
    while i < spec.arity:
        if i in groups:
            name, fields = groups[i]
            members = ", ".join(f"'{f}', {field(i + j)}" for j, f in enumerate(fields))
            columns.append(f"named_struct({members}) AS {name}")
            i += len(fields)
        else:
            columns.append(f"{field(i)} AS {spec.fields[i][0]}")
            i += 1
    return f"""WITH {_flagged(spec, lines, p)}
        SELECT {', '.join(columns)}
        FROM flagged LATERAL VIEW inline(CASE WHEN reason IS NULL THEN {row} ELSE {bad} END) good
             AS {', '.join(['parts', *names])}"""


def quarantine_sql(spec: TableSpec | str, lines: str, prefix: str = "") -> str:
    """The statement that gives (value, reason) of the bad lines."""
    spec, p = SPECS[spec] if isinstance(spec, str) else spec, _prefix(prefix)
    return f"""WITH {_flagged(spec, lines, p)}
        SELECT bad.value, bad.reason FROM flagged LATERAL VIEW inline(
            CASE WHEN reason IS NOT NULL THEN array(named_struct('value', value, 'reason', reason)) END
        ) bad AS value, reason"""


def register_text_views(
    spark: SparkSession, text_dir: str, prefix: str = "", mode: str = "failfast",
    signed_money: bool = False,
) -> None:
    """Views ``<prefix>product``, ``sales``, ``refund``, ``customer``, ``customer_extnd`` over the
    files of a folder (and ``<prefix><table>_lines`` over their lines), all in SQL."""
    p = _prefix(prefix)
    register_functions(spark, p)
    for name, file in FILE_NAMES.items():
        path = f"{text_dir.rstrip('/')}/{file}".replace("'", "\\'")
        lines, view = f"{p}{name}_lines", f"{p}{VIEW_NAMES.get(name, name)}"
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {lines} (value STRING) USING text OPTIONS (path '{path}')")
        statement = parse_sql(name, lines, p, mode, signed_money)
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} AS {statement}")


def parse_lines(spark: SparkSession, lines: DataFrame, name: str, prefix: str = "tillroll_") -> DataFrame:
    """Good rows of a DataFrame of lines, by SQL."""
    p = _prefix(prefix)
    register_functions(spark, p)
    lines.createOrReplaceTempView(f"{p}{name}_lines")
    return spark.sql(parse_sql(name, f"{p}{name}_lines", p))


def quarantined_lines(spark: SparkSession, lines: DataFrame, name: str, prefix: str = "tillroll_") -> DataFrame:
    """(value, reason) of the bad lines of a DataFrame of lines, by SQL."""
    p = _prefix(prefix)
    register_functions(spark, p)
    lines.createOrReplaceTempView(f"{p}{name}_lines")
    return spark.sql(quarantine_sql(name, f"{p}{name}_lines", p))
