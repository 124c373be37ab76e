import random
from datetime import date, timedelta

import pytest

from tidemark.operators import scd2
from tidemark.operators.scd2 import HistorySpec

SPEC = HistorySpec(tiebreak=("seq",), versioned={"salary": "new_salary"})
HISTORY = "employee_id string, effective_date date, previous_salary double, new_salary double, change_reason string, seq int"
SNAPSHOT = "employee_id string, full_name string, salary double, hire_date date"
DAY = date(2025, 3, 2)


def collapse(spark, changes):
    """changes: (previous, new) of one person on one day."""
    data = [("e", DAY, p, n, "r", i) for i, (p, n) in enumerate(changes)]
    return [(r.previous_salary, r.new_salary, r.terminal_states)
            for r in scd2.collapse_same_day(spark.createDataFrame(data, HISTORY), SPEC).collect()]


@pytest.mark.parametrize(
    "changes, kept",
    [
        ([(15217.0, 16314.0), (16314.0, 23354.0)], (16314.0, 23354.0, 1)),  # chain
        ([(16314.0, 23354.0), (15217.0, 16314.0)], (16314.0, 23354.0, 1)),  # same chain, other order
        ([(10.0, 20.0), (30.0, 40.0)], (30.0, 40.0, 2)),  # unrelated: last by tie-break
        ([(1.0, 2.0), (2.0, 1.0)], (2.0, 1.0, 0)),  # cycle: one is kept
        ([(50.0, 50.0)], (50.0, 50.0, 1)),  # unchanged value does not supersede itself
        ([(40.0, 50.0), (50.0, 50.0)], (50.0, 50.0, 1)),  # raise, then role change
        ([(50.0, 50.0), (50.0, 50.0)], (50.0, 50.0, 0)),  # two role changes supersede each other
        ([(None, 5.0)], (None, 5.0, 1)),
        ([(5.0, None), (None, 7.0)], (None, 7.0, 2)),  # null never links
    ],
)
def test_same_day_rules(spark, changes, kept):
    assert collapse(spark, changes) == [kept]


def test_collapse_equals_the_pairwise_rule(spark, rows):
    rng = random.Random(6)
    data = [
        (rng.choice(["hot", "hot", "a", "b"]), DAY + timedelta(days=rng.randrange(8)),
         rng.choice([None, 1.0, 2.0, 3.0, 4.0]), rng.choice([None, 1.0, 2.0, 3.0, 4.0]), "r", i)
        for i in range(160)
    ]
    want = []
    for who, day in {(d[0], d[1]) for d in data}:
        mine = [d for d in data if d[:2] == (who, day)]
        ends = [d for d in mine if not any(x is not d and x[2] is not None and x[2] == d[3] for x in mine)]
        best = max(ends or mine, key=lambda d: d[5])
        want.append((*best, len(ends)))
    got = scd2.collapse_same_day(spark.createDataFrame(data, HISTORY), SPEC)
    assert rows(got) == sorted(want, key=repr)


@pytest.fixture(scope="module")
def built(spark):
    history = spark.createDataFrame(
        [
            ("h", date(2020, 1, 1), None, 100.0, "hired", 0),
            ("h", date(2021, 1, 1), 100.0, 120.0, "raise", 1),
            ("h", date(2022, 6, 1), 120.0, 150.0, "promotion", 2),
            ("ghost", date(2020, 1, 1), None, 1.0, "no such person", 3),
        ],
        HISTORY,
    )
    snapshot = spark.createDataFrame(
        [("h", "Hana", 155.0, date(2019, 12, 1)), ("n", "Noor", 80.0, date(2018, 5, 5)), ("u", "Umi", 70.0, None)], SNAPSHOT
    )
    changes = scd2.collapse_same_day(history, SPEC).drop("terminal_states")
    return scd2.build_versions(changes, snapshot, spec=SPEC, slices=2).cache(), changes, snapshot


def test_versions(built, rows):
    end = date(9999, 12, 31)
    got = rows(built[0], "employee_key", "employee_id", "salary", "valid_from", "valid_to", "is_current", "change_reason")
    assert got == [
        (1, "h", 100.0, date(2020, 1, 1), date(2020, 12, 31), False, "hired"),
        (2, "h", 120.0, date(2021, 1, 1), date(2022, 5, 31), False, "raise"),
        (3, "h", 155.0, date(2022, 6, 1), end, True, None),
        (4, "n", 80.0, date(2018, 5, 5), end, True, None),
        (5, "u", 70.0, date(1900, 1, 1), end, True, None),
    ]


def test_checks_are_clean(built):
    dimension, changes, snapshot = built
    assert scd2.several_current(dimension).count() == 0
    assert scd2.version_overlaps(dimension, slices=2).count() == 0
    assert scd2.version_gaps(dimension).count() == 0
    equation = scd2.row_equation(dimension, changes, snapshot).first()
    assert equation.actual_rows == equation.expected_rows == 5
    assert [tuple(r) for r in scd2.version_counts(dimension, top=1).collect()] == [("h", 3)]


def test_checks_find_faults(spark, built):
    broken = spark.createDataFrame(
        [
            ("x", 1, date(2020, 1, 1), date(2020, 6, 30), True),
            ("x", 2, date(2020, 6, 1), date(2020, 12, 31), True),
            ("x", 3, date(2021, 2, 1), date(9999, 12, 31), True),
        ],
        "employee_id string, employee_key long, valid_from date, valid_to date, is_current boolean",
    )
    assert scd2.several_current(broken).first().current_count == 3
    overlap = scd2.version_overlaps(broken).collect()
    assert [(r.version_a, r.version_b) for r in overlap] == [(1, 2)]
    assert sorted(r.employee_key for r in scd2.version_gaps(broken).collect()) == [1, 2]


def test_random_history_keeps_the_invariants(spark):
    rng = random.Random(7)
    data = [
        (f"p{rng.randrange(12)}", DAY + timedelta(days=rng.randrange(60)), float(rng.randrange(4)), float(rng.randrange(4)), "r", i)
        for i in range(300)
    ]
    people = [(f"p{i}", f"N{i}", 1.0, rng.choice([None, DAY])) for i in range(15)]
    snapshot = spark.createDataFrame(people, SNAPSHOT)
    changes = scd2.collapse_same_day(spark.createDataFrame(data, HISTORY), SPEC).drop("terminal_states").cache()
    dimension = scd2.build_versions(changes, snapshot, spec=SPEC, slices=3).cache()
    assert changes.groupBy("employee_id", "effective_date").count().filter("count > 1").count() == 0
    assert scd2.several_current(dimension).count() == 0
    assert scd2.version_overlaps(dimension, slices=3).count() == 0
    assert scd2.version_gaps(dimension).count() == 0
    equation = scd2.row_equation(dimension, changes, snapshot).first()
    assert equation.actual_rows == equation.expected_rows
    keys = [r.employee_key for r in dimension.orderBy("employee_id", "valid_from").collect()]
    assert keys == list(range(1, len(keys) + 1))


def test_largest_increase(built, rows):
    got = scd2.adjacent_increases(built[0], top=1).collect()
    assert [(r.employee_id, r.change_date, r.increase_amount, r.increase_pct) for r in got] == [
        ("h", date(2022, 6, 1), 35.0, 29.17)
    ]


def test_increase_from_zero_has_no_percentage(spark):
    data = [("z", "Z", 0.0, date(2020, 1, 1), date(2020, 1, 31)), ("z", "Z", 9.0, date(2020, 2, 1), date(9999, 12, 31))]
    df = spark.createDataFrame(data, "employee_id string, full_name string, salary double, valid_from date, valid_to date")
    assert scd2.adjacent_increases(df).first().increase_pct is None


def test_a_history_spread_by_its_key_is_not_shuffled_again(spark):
    data = [(f"e{k % 7}", DAY + timedelta(days=k % 5), float(k), float(k + 5), "r", k) for k in range(60)]
    history = spark.createDataFrame(data, HISTORY)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = scd2.collapse_same_day(history.repartition("employee_id"), SPEC)
        assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
        assert found.columns == [*history.columns, "terminal_states"] and found.count() == 35
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
