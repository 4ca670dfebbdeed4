"""Data-quality report over raw lines, and the cleaning pass for extended customers.

The report is one aggregation (partial per task, then a single merge of one row per
task) followed by an unpivot into (table_name, field, check_name, n) rows. It never looks at rows
on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import clean as C
from tillroll.functions import parse as P
from tillroll.sources.schema import SPECS, TableSpec

# The one money layout counted as uniform, "$1,234.50".
UNIFORM_MONEY = r"^\$[0-9]{1,3}(,[0-9]{3})*\.[0-9]{2}$"

# more than two digits after the point of an amount, zeros not counted
SUB_CENT_MONEY = r"\.[0-9]{2}[0-9]*[1-9]"
TWO_LETTERS = r"^[A-Z]{2}$"
CONTACTS = (
    "personal_email_address",
    "work_email_address",
    "twitter_id",
    "facebook_id",
    "linkedin_id",
)


def _checks(spec: TableSpec) -> list[tuple[str, str, Column]]:
    parts = F.col("_parts")
    out: list[tuple[str, str, Column]] = [
        ("*", "rows", F.lit(True)),
        ("*", "short_line", F.coalesce(F.size(parts) < spec.required, F.lit(True))),
    ]
    if spec.optional:
        size = F.size(parts)
        missing = (size >= spec.required) & (size < spec.arity)
        out.append(("*", "missing_tail", missing))
    for i, (name, kind) in enumerate(spec.fields):
        raw = F.get(parts, i)
        out.append((name, "blank", raw == ""))
        if kind == "money":
            out.append((name, "non_uniform_money", (raw != "") & ~raw.rlike(UNIFORM_MONEY)))
            out.append((name, "sub_cent_money", raw.rlike(SUB_CENT_MONEY)))
        elif kind == "stamp":
            out.append((name, "bad_timestamp", raw.isNotNull() & P.timestamp(raw).isNull()))
        elif kind == "int":
            out.append((name, "bad_integer", P.is_bad_integer(raw)))
        out += [(name, check, cond) for check, cond in _text_checks(name, raw)]
    return out


def _text_checks(name: str, raw: Column) -> list[tuple[str, Column]]:
    """Checks of the extended customers' addresses and contacts, by field name."""
    if name.endswith("_street_address"):
        return [
            ("mixed_case", raw != F.upper(raw)),
            ("street_suffix", F.upper(raw).rlike(C.STREET_PATTERN)),
        ]
    if name.endswith("_state"):
        return [("not_two_letters", (raw != "") & ~raw.rlike(TWO_LETTERS))]
    if name in CONTACTS:
        return [("invalid_contact", (raw != "") & ~raw.rlike(C.CONTACT_PATTERN))]
    return []


def _counts(checks: list[tuple[str, str, Column]]) -> list[Column]:
    return [
        F.count_if(F.coalesce(cond, F.lit(False))).alias(f"c{i}")
        for i, (_, _, cond) in enumerate(checks)
    ]


def _split(lines: DataFrame) -> DataFrame:
    return lines.select("value", F.split(F.col("value"), r"\|", -1).alias("_parts"))


def dq_report(lines: DataFrame, spec: TableSpec | str) -> DataFrame:
    """(table_name, field, check_name, n) for every check of every field of ``spec``."""
    if isinstance(spec, str):
        spec = SPECS[spec]
    checks = _checks(spec)
    counts = _split(lines).agg(*_counts(checks))
    rows = [
        F.struct(
            F.lit(field).alias("field"),
            F.lit(check).alias("check_name"),
            F.col(f"c{i}").alias("n"),
        )
        for i, (field, check, _) in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows))).select(
        F.lit(spec.name).alias("table_name"), "field", "check_name", "n"
    )


def observe_checks(lines: DataFrame, spec: TableSpec | str) -> tuple[DataFrame, Observation]:
    """The lines, split, and an observation that counts the checks of ``dq_report`` while
    another job (the ingest's write) reads them: no pass of its own.  ``parse`` takes the
    split lines as they are.

    An observation is the sum of the tasks that ended, so it is exact for a job without a
    shuffle above it, as ``sources.batches`` writes; if executors are lost, tasks that are run
    again below a shuffle may count twice.
    """
    if isinstance(spec, str):
        spec = SPECS[spec]
    seen = Observation(f"checks of {spec.name}")
    return _split(lines).observe(seen, *_counts(_checks(spec))), seen


def observed_report(spark: SparkSession, spec: TableSpec | str, seen: Observation) -> DataFrame:
    """The report of ``observe_checks``, as ``dq_report`` gives it; waits for the job."""
    if isinstance(spec, str):
        spec = SPECS[spec]
    found = seen.get
    rows = [
        (spec.name, field, check, found[f"c{i}"])
        for i, (field, check, _) in enumerate(_checks(spec))
    ]
    return spark.createDataFrame(rows, "table_name string, field string, check_name string, n long")


def state_codes_from(
    customers_extended: DataFrame, lookup: DataFrame, broadcast_bytes: int = 8 << 20
) -> DataFrame:
    """``customers_extended`` with the states of its addresses replaced by their codes in a
    table (name, code); same schema.

    Names match whatever their case.  A state that the table lacks is kept in upper case, a
    null stays null; of several codes of one name the least counts, rows with a null are
    ignored.  The table is counted first: up to ``broadcast_bytes`` it is broadcast, beyond
    that the planner joins by shuffle, where adaptive execution splits a state that very many
    customers have.
    """
    codes = (
        lookup.select(F.upper("name").alias("_name"), F.col("code").alias("_code"))
        .dropna().groupBy("_name").agg(F.min("_code").alias("_code"))
    )
    size = codes.agg(F.sum(F.octet_length("_name") + F.octet_length("_code") + 64)).first()[0] or 0
    out = customers_extended
    for name in [c for c in out.columns if c.endswith("_address") and c not in CONTACTS]:
        own = codes.select(F.col("_name").alias(f"{name}_name"), F.col("_code").alias(f"{name}_code"))
        own = F.broadcast(own) if size <= broadcast_bytes else own
        state = F.upper(F.col(name)["state"])
        out = out.join(own, state == F.col(f"{name}_name"), "left").withColumn(
            name,
            F.col(name).withField("state", F.coalesce(F.col(f"{name}_code"), state)),
        )
    return out.select(*customers_extended.columns)


def clean_customers_extended(customers_extended: DataFrame) -> DataFrame:
    """Upper-case streets with one suffix spelling, two-letter states, and ``invalid``
    for malformed contact ids. Same schema as the input."""
    def address(name: str) -> Column:
        a = F.col(name)
        return F.struct(
            C.clean_street(a["street_address"]).alias("street_address"),
            F.upper(a["city"]).alias("city"),
            C.state_code(a["state"]).alias("state"),
            F.upper(a["country"]).alias("country"),
            a["zip"].alias("zip"),
        ).alias(name)

    cols: list[Column] = []
    for c in customers_extended.columns:
        if c.endswith("_address") and c not in CONTACTS:
            cols.append(address(c))
        elif c in CONTACTS:
            cols.append(C.valid_contact(c).alias(c))
        else:
            cols.append(F.col(c))
    return customers_extended.select(*cols)
