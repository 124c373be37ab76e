"""The event batch: read, validate, build the five marts and write them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation

from tidemark.plans import events as ev
from tidemark.session import stage
from tidemark.sinks.files import write_table


def run_event_batch(events: DataFrame, out: str) -> tuple[ev.StageTimes, dict[str, int]]:
    """Write all marts below ``out``; returns stage times and row counts.

    The validated events are written once and read by the five marts.
    """
    raw, keyed = Observation("raw"), Observation("keyed")
    times = ev.StageTimes()
    held: list[DataFrame] = []

    def validate() -> int:
        held.append(stage(ev.validate_events(events, raw=raw, with_keys=keyed), "events"))
        return raw.get["rows"]

    raw_rows = times.run("validate", validate)
    clean = held[0]
    rows = {"raw": raw_rows, "with_keys": keyed.get["rows"], "clean": clean.count()}
    for name, build in ev.MARTS.items():
        mart = build(clean)
        layout = {"partition_by": ["event_date"]} if name == "daily_event_volume" else {}
        rows[name] = times.run(name, lambda m=mart, n=name, kw=layout: write_table(m, f"{out}/{n}", **kw))
    return times, rows
