"""Sums of doubles that depend neither on the order of rows nor on the partitioning.

A sum is kept as a state of five columns, each an ordinary Spark sum: numbers are
split by their size into decimals that 38 digits hold exactly, for 1e10 rows of the
largest of their kind (more of them raise an error, as any sum in Spark does).

==========  ==========================================================================
``plain``   numbers below 1e20 with at most eight digits behind the point: amounts of money
``part``    other numbers from 0.01, with eighteen digits behind the point
``fine``    other numbers from 1e-14 up to 0.01, with thirty digits
``high``    numbers from 1e20 up to 1e37, in units of 1e20 (the remainder goes to ``plain``)
``beyond``  everything else, as a double: 1e37 and more, infinities, and what lies closer to zero than 1e-14
==========  ==========================================================================

A double counts as the shortest decimal that stands for it, so a thousand times
0.1 is 100. States can be added up again, over groups or windows, and become a
double at the very end, rounded once. Numbers in ``beyond`` are added as doubles:
their last digit may depend on the order, and no row is left out. One infinity
makes the sum infinite, two of different sign make it NaN. NaN itself and null are
missing; the sum of nothing is null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELDS = ("plain", "part", "fine", "high", "beyond")

# Types of a number in a field, and of the field.
_ADDENDS = {"plain": "decimal(28,8)", "part": "decimal(38,18)", "fine": "decimal(30,30)", "high": "decimal(28,0)", "beyond": "double"}
_SUMS = _ADDENDS | {"plain": "decimal(38,8)", "fine": "decimal(38,30)", "high": "decimal(38,0)"}
_HIGH = "CAST('1" + "0" * 20 + "' AS decimal(21,0))"
_ONE = "CAST(1 AS decimal(1,0))"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _pieces(name: str) -> dict[str, str]:
    """One number split into the fields of a state, as SQL."""
    c = _quoted(name)
    number, plain = f"try_cast({c} AS double)", f"try_cast({c} AS decimal(28,8))"
    # Decimals are compared digit by digit, all else as doubles.
    same = f"CASE WHEN typeof({c}) LIKE 'decimal%' THEN {plain} = try_cast({c} AS decimal(38,18)) ELSE CAST({plain} AS double) = {number} END"
    size = f"abs({number})"
    kind = (
        f"CASE WHEN {same} THEN 0 WHEN {size} >= 1e-2D AND {size} < 1e20D THEN 1 WHEN {size} >= 1e-14D AND {size} < 1e-2D THEN 2 "
        f"WHEN {size} >= 1e20D AND {size} < 1e37D THEN 3 WHEN NOT isnan({number}) THEN 4 END"
    )
    large = f"try_cast({c} AS decimal(38,0))"
    low = f"pmod({large}, {_HIGH})"
    values = {
        "plain": {0: plain, 3: low},
        "part": {1: f"try_cast({c} AS decimal(38,18))"},
        "fine": {2: f"try_cast({c} AS decimal(30,30))"},
        "high": {3: f"({large} - {low}) / {_HIGH}"},
        "beyond": {4: number},
    }
    return {
        field: f"CASE {kind} " + " ".join(f"WHEN {k} THEN CAST({v} AS {_ADDENDS[field]})" for k, v in cases.items()) + " END"
        for field, cases in values.items()
    }


def _struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {sql}" for name, sql in fields.items()) + ")"


def _summed(name: str) -> dict[str, str]:
    return {field: f"CAST(sum({piece}) AS {_SUMS[field]})" for field, piece in _pieces(name).items()}


def _merged(name: str, over: str | None = None) -> dict[str, str]:
    window = f" OVER ({over})" if over else ""
    return {field: f"CAST(sum({_quoted(name)}.{field}){window} AS {_SUMS[field]})" for field in FIELDS}


def _value(fields: dict[str, str]) -> str:
    """Fields put together as a double, as SQL."""
    plain, part, fine, high = (f"coalesce({fields[n]}, CAST(0 AS {_SUMS[n]}))" for n in ("plain", "part", "fine", "high"))
    # The number is an integer and digits behind the point that are not negative.
    integer = f"({high} * {_HIGH} + floor({plain}) + floor({part}) + floor({fine}))"
    behind = f"(CAST(pmod({plain}, {_ONE}) AS decimal(9,8)) + pmod({part}, {_ONE}) + pmod({fine}, {_ONE}))"
    exact = f"""CASE
        WHEN {fields["part"]} IS NULL AND {fields["fine"]} IS NULL AND {fields["high"]} IS NULL THEN CAST({fields["plain"]} AS double)
        WHEN abs({high}) >= 100000000000000000
            THEN CAST(concat(CAST(CAST({high} + round({plain} / {_HIGH}) AS decimal(38,0)) AS string), '{"0" * 20}') AS double)
        WHEN abs({integer}) >= CAST('1{"0" * 18}' AS decimal(19,0)) THEN CAST({integer} AS double)
        WHEN abs({integer}) < 10000 THEN CAST(CAST({integer} AS decimal(5,0)) + {behind} AS double)
        ELSE CAST(CAST({integer} AS decimal(19,0)) + CAST({behind} AS decimal(20,18)) AS double) END"""
    return f"CASE WHEN {fields['beyond']} IS NULL THEN {exact} ELSE {fields['beyond']} + coalesce({exact}, 0D) END"


def sum_state(column: str) -> Column:
    """The state of a column's sum, as an aggregate."""
    return F.expr(_struct(_summed(column)))


def merged_state(column: str) -> Column:
    """A column of states added up, as an aggregate."""
    return F.expr(_struct(_merged(column)))


def _put_together(state: str) -> Column:
    """A state given as SQL, named once, as a double."""
    value = _value({field: f"s.{field}" for field in FIELDS})
    return F.expr(f"transform(array({state}), s -> {value})[0]")


def merged_value(column: str, over: str | None = None) -> Column:
    """A column of states added up to a double, as an aggregate, or over a window given as SQL."""
    return _put_together(_struct(_merged(column, over)))


def state_value(column: str) -> Column:
    """A state as a double."""
    return F.expr(_value({field: f"{_quoted(column)}.{field}" for field in FIELDS}))


def exact_sum(column: str) -> Column:
    """Sum of what is there as a double, whatever the order of rows."""
    return _put_together(_struct(_summed(column)))
