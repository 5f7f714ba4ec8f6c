"""Rows from rows with state: runs of equal events of a user."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.functions import arrow_udtf, col, lit, pmod, xxhash64

from millrace.session import shuffle_parts

RUNS = "user_id bigint, event_type string, first_event bigint, last_event bigint, events bigint, gap_seconds double"


@arrow_udtf(returnType=RUNS)
class EventRuns:
    """Runs of one kind of event of a user on a day.

    The allowed gap follows the run: an event joins when it comes within three times the mean gap of the run (a
    run of one event takes any), so where a run ends depends on all that it has taken, and no window can say it.
    """

    def __init__(self):
        self.open: list | None = None  # user, kind, first, last, events, time of the first and of the last, day

    def _row(self) -> tuple:
        user, kind, first, last, n, began, at, _ = self.open
        return user, kind, first, last, n, (at - began) / (n - 1) if n > 1 else None

    @staticmethod
    def _table(rows: list[tuple]) -> pa.Table:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        names = [c.split()[0] for c in RUNS.split(", ")]
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:
        out = []
        for user, day, kind, event, at in zip(*(rows.column(c).to_pylist() for c in ("user_id", "day", "event_type", "event_id", "at"))):
            run = self.open
            if run is not None and run[0] == user and run[7] == day and run[1] == kind and (run[4] == 1 or at - run[6] <= 3 * (run[6] - run[5]) / (run[4] - 1)):
                run[3], run[4], run[6] = event, run[4] + 1, at
                continue
            if run is not None:
                out.append(self._row())
            self.open = [user, kind, event, event, 1, at, at, day]
        if out:
            yield self._table(out)

    def terminate(self) -> Iterator[pa.Table]:
        if self.open is not None:
            yield self._table([self._row()])


def event_runs(events: DataFrame) -> DataFrame:
    """A row per run of ``user_id, day, event_type, event_id, at`` (seconds), in order of time; only the open run is held.

    Runs end with the day, so a user with very many events is many groups.  Many users and days are dealt to one call of
    the function, a few per task, and come one after the other; a call for each would cost more than its few events.
    """
    bucket = pmod(xxhash64("user_id", "day"), lit(4 * shuffle_parts(events.sparkSession)))
    return EventRuns(events.withColumn("bucket", bucket).asTable().partitionBy("bucket").orderBy(
        col("user_id"), col("day"), col("at"), col("event_id")))
