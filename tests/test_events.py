from datetime import datetime, timedelta

import pytest
from pyspark.sql import Observation

from tidemark.plans import events as ev
from tidemark.plans.event_batch import run_event_batch
from tidemark.sources import schemas
from tidemark.sources.files import read_table

T0 = datetime(2024, 1, 1, 9)


@pytest.fixture(scope="module")
def raw(spark):
    def event(eid, kind, minute, user="u1", project="P1", **payload):
        return (eid, kind, project, user, T0 + timedelta(minutes=minute), payload)

    return spark.createDataFrame(
        [
            event("e1", "login", 0, project=None, device="desktop"),
            event("e2", "task_completed", 5),
            event("e2", "task_completed", 3),
            event("e3", "escalation_raised", 61, severity="Critical"),
            event("e4", "escalation_resolved", 121, user="u2", resolved_by="u9"),
            event("e5", "document_uploaded", 24 * 60, user="u2"),
            event("e6", "logout", 24 * 60 + 1, user="u2", project=None),
            event(None, "login", 1),
            event("e8", "login", 1, user=None),
        ],
        schemas.EVENTS,
    )


def test_validate(spark, raw):
    before, keyed = Observation(), Observation()
    clean = ev.validate_events(raw, raw=before, with_keys=keyed)
    got = {r.event_id: r for r in clean.collect()}
    assert set(got) == {"e1", "e2", "e3", "e4", "e5", "e6"}
    assert got["e2"].timestamp == T0 + timedelta(minutes=3)
    assert (str(got["e5"].event_date), got["e3"].event_hour, got["e3"].event_month) == ("2024-01-02", 10, "2024-01")
    assert (before.get["rows"], keyed.get["rows"]) == (9, 7)


def test_equal_times_are_settled_by_the_tiebreak(spark):
    same = [("e", kind, "P", user, T0, {}) for user, kind in (("u2", "login"), ("u1", "logout"), ("u1", "login"))]
    for data in (same, same[::-1]):
        row = ev.validate_events(spark.createDataFrame(data, schemas.EVENTS)).first()
        assert (row.user_id, row.event_type) == ("u1", "login")


def test_marts(spark, raw):
    clean = ev.validate_events(raw).cache()
    project = ev.project_activity_summary(clean).collect()
    assert len(project) == 1
    row = project[0]
    assert (row.total_events, row.escalation_count, row.task_completions, row.document_uploads) == (4, 1, 1, 1)
    assert (row.unique_users, row.unique_event_types, row.last_event_timestamp) == (2, 4, T0 + timedelta(days=1))
    users = {r.user_id: r for r in ev.user_activity_summary(clean).collect()}
    assert (users["u1"].login_count, users["u1"].actions_taken, users["u1"].projects_touched, users["u1"].active_days) == (1, 2, 1, 1)
    assert (users["u2"].logout_count, users["u2"].actions_taken, users["u2"].active_days) == (1, 2, 2)
    daily = ev.show_order("daily_event_volume", ev.daily_event_volume(clean)).collect()
    assert [str(r.event_date) for r in daily] == sorted(str(r.event_date) for r in daily)
    assert all(r.event_count == r.cumulative_count == 1 for r in daily)
    peak = ev.peak_usage_analysis(clean, top=1).first()
    assert (str(peak.event_date), peak.event_hour, peak.total_events, peak.unique_users) == ("2024-01-01", 9, 2, 1)
    approx = ev.project_activity_summary(clean, approx=True).first()
    assert approx.unique_users == 2
    log = ev.escalation_log(clean).first()
    assert (log.resolved, log.resolved_by, log.resolution_time_hours) == (True, "u9", 1.0)


def test_batch_writes_everything_and_can_be_repeated(spark, raw, tmp_path):
    out = str(tmp_path / "marts")
    for _ in range(2):
        times, rows = run_event_batch(raw, out)
        assert rows == {
            "raw": 9, "with_keys": 7, "clean": 6, "project_activity_summary": 1, "user_activity_summary": 2,
            "escalation_log": 1, "daily_event_volume": 6, "peak_usage_analysis": 4,
        }
        for name in ev.MARTS:
            assert read_table(spark, f"{out}/{name}").count() == rows[name]
    assert times.lines(9)[-1].startswith("total:")
    assert len(times.stages) == 6
