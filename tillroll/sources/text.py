"""Pipe-delimited text to typed DataFrames.

``parse`` takes any DataFrame with a string ``value`` column (``spark.read.text``, a
streaming text source, or lines built in Spark) and returns typed rows plus quarantined
lines. It is a few narrow projections and one generator, all Column expressions inside
whole-stage codegen: no RDD, no Python UDF, no shuffle.

Differences from a plain ``String.split``: trailing empty fields are kept (limit -1), so
``a|b||`` has four fields; a line with fewer fields than the spec requires is quarantined
instead of failing the job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import parse as P
from tillroll.sources.schema import SPECS, TableSpec

REASON = "_reason"
_PARTS = "_parts"

# Quarantine reasons, checked in this order (first one wins).
SHORT_LINE = "short line"
BAD_TIMESTAMP = "bad timestamp"
BAD_INTEGER = "bad integer"


@dataclass(frozen=True)
class Parsed:
    """Typed rows and rejected lines, both lazy views of the same parse."""

    good: DataFrame
    bad: DataFrame
    tagged: DataFrame  # typed columns + value + _reason (NULL for good rows)
    mode: str = "quarantine"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line in ``value``; Spark splits big files by maxPartitionBytes."""
    return spark.read.text(path)


def _field(parts: Column, i: int) -> Column:
    # get() is NULL past the end of the array, also under ANSI mode
    return F.get(parts, i)


def parse(
    lines: DataFrame,
    spec: TableSpec | str,
    mode: str = "quarantine",
    signed_money: bool = False,
) -> Parsed:
    """Parse ``lines.value`` into the typed table ``spec`` (lines that are split already, by
    ``operators.quality.observe_checks``, are not split again).

    mode ``quarantine``: bad lines go to ``Parsed.bad`` with a reason.
    mode ``failfast``: the first bad line fails the job when an action reaches it, as the
    reference does; ``Parsed.bad`` is then empty by construction.
    """
    if isinstance(spec, str):
        spec = SPECS[spec]
    if mode not in ("quarantine", "failfast"):
        raise ValueError(f"unknown mode {mode!r}")

    # Stage 1 splits each line once; stage 2 converts only what decides whether a line is
    # good (timestamps and integers), stage 3 derives the reason.  Each stage references
    # the previous one's columns more than once, so Catalyst keeps them as projections of
    # their own instead of evaluating the split or a timestamp per reference.
    split = F.col(_PARTS) if _PARTS in lines.columns else F.split(F.col("value"), r"\|", -1).alias(_PARTS)
    staged = lines.select("value", split)
    parts = F.col(_PARTS)
    short = F.coalesce(F.size(parts) < spec.required, F.lit(True))
    checks: list[Column] = [F.when(short, F.lit(SHORT_LINE))]
    checked: list[Column] = []
    for i, (name, kind) in enumerate(spec.fields):
        raw = _field(parts, i)
        if kind == "stamp":
            checked.append(P.timestamp(raw).alias(name))
            checks.append(F.when(F.col(name).isNull(), F.lit(BAD_TIMESTAMP)))
        elif kind == "int":
            checked.append(P.integer(raw).alias(name))
            checks.append(F.when((F.length(raw) > 0) & F.col(name).isNull(), F.lit(BAD_INTEGER)))
    names = [c for c, kind in spec.fields if kind in ("stamp", "int")]
    flagged = staged.select("value", _PARTS, *checked).select(
        "value", _PARTS, *names, F.coalesce(*checks).alias(REASON)
    )

    # Good and bad rows are emitted by a generator (0 or 1 row per line) rather than a
    # filter: a filter on the reason would be pushed below the projections and evaluate
    # the checks a second time inside the predicate.  The generator carries the split line
    # and the checked fields; every other field is converted above it, so a query pays
    # only for the fields it reads.
    ok = F.col(REASON).isNull()
    row = F.array(F.struct(_PARTS, *names))
    rejected = F.array(F.struct("value", F.col(REASON).alias("reason")))
    if mode == "failfast":
        message = F.concat(F.col(REASON), F.lit(": "), F.col("value"))
        passed = flagged.select(F.inline(F.when(ok, row).otherwise(F.raise_error(message))))
        bad = flagged.select(F.inline(F.when(F.lit(False), rejected)))
    else:
        passed = flagged.select(F.inline(F.when(ok, row)))
        bad = flagged.select(F.inline(F.when(~ok, rejected)))
    good = _typed(passed, spec, (), signed_money)
    tagged = _typed(flagged, spec, ("value", REASON), signed_money)
    return Parsed(good=good, bad=bad, tagged=tagged, mode=mode)


def _typed(df: DataFrame, spec: TableSpec, keep: tuple[str, ...], signed_money: bool) -> DataFrame:
    """The typed columns of ``spec`` from split lines with their checked fields."""
    parts = F.col(_PARTS)
    typed: list[Column] = []
    for i, (name, kind) in enumerate(spec.fields):
        if kind == "text":
            typed.append(_field(parts, i).alias(name))
        elif kind == "money":
            typed.append(P.money(_field(parts, i), signed=signed_money).alias(name))
        elif kind in ("stamp", "int"):
            typed.append(F.col(name))
        else:
            raise ValueError(f"unknown field kind {kind!r}")
    return _fold_groups(df.select(*keep, *typed), spec, keep)


def _fold_groups(flat: DataFrame, spec: TableSpec, keep: tuple[str, ...]) -> DataFrame:
    if not spec.groups:
        return flat.select(*keep, *[n for n, _ in spec.fields])
    grouped_at = {start: (name, names) for name, start, names in spec.groups}
    cols: list[Column | str] = list(keep)
    i = 0
    while i < spec.arity:
        if i in grouped_at:
            struct_name, names = grouped_at[i]
            members = [
                F.col(spec.fields[i + j][0]).alias(sn) for j, sn in enumerate(names)
            ]
            cols.append(F.struct(*members).alias(struct_name))
            i += len(names)
        else:
            cols.append(spec.fields[i][0])
            i += 1
    return flat.select(*cols)


def load_table(
    spark: SparkSession, path: str, spec: TableSpec | str, mode: str = "failfast"
) -> DataFrame:
    """Read and parse one text file or directory; the reference's fail-fast default."""
    return parse(read_lines(spark, path), spec, mode=mode).good


def flatten_struct(df: DataFrame, struct_name: str, prefix: str | None = None) -> DataFrame:
    """Replace a struct column by its fields, named ``{prefix}_{field}``."""
    prefix = prefix if prefix is not None else struct_name.removesuffix("_address")
    fields = df.schema[struct_name].dataType.fieldNames()
    cols = []
    for c in df.columns:
        if c == struct_name:
            cols += [F.col(f"{c}.{f}").alias(f"{prefix}_{f}") for f in fields]
        else:
            cols.append(F.col(c))
    return df.select(*cols)
