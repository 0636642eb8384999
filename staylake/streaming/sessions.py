"""Sessions as changes: what a micro-batch touches is written, not the whole table.

The state of a key is its open sessions. New events extend, begin or join them; an event between two sessions
makes them one. Each session has a number within its key that it keeps; where sessions become one the smallest
number stays and the others are written once more as gone. Under a watermark a timer closes sessions that no
event can reach any more and drops them from the state.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

STATE = "next bigint, number array<bigint>, first array<bigint>, last array<bigint>, events array<bigint>, bytes array<bigint>"
FIELDS = ["number", "first", "last", "events", "bytes"]


def merged(open_: list[tuple], pieces: list[tuple], gap: int, number: int) -> tuple[list[tuple], list[tuple], list[int], int]:
    """Open sessions after ``pieces``, which of them changed, the numbers that are gone, and the next number.

    Sessions are (number, first, last, events, bytes), pieces the same with None for their number; at most one
    gap apart belongs together.
    """
    out, changed, gone = [], [], []
    for item in sorted([*open_, *pieces], key=lambda s: (s[1], s[2])):
        if out and item[1] - out[-1][2] <= gap:
            a, touched = out[-1], changed[-1]
            numbers = sorted(n for n in (a[0], item[0]) if n is not None)
            gone += numbers[1:]
            total = None if a[4] is None and item[4] is None else (a[4] or 0) + (item[4] or 0)
            out[-1] = (numbers[0] if numbers else None, a[1], max(a[2], item[2]), a[3] + item[3], total)
            changed[-1] = True if touched or item[0] is None or a[0] is None or len(numbers) > 1 else touched
        else:
            out.append(item)
            changed.append(item[0] is None)
    for i, session in enumerate(out):
        if session[0] is None:
            out[i] = (number, *session[1:])
            number += 1
    return out, [s for s, c in zip(out, changed) if c], gone, number


class Sessions(StatefulProcessor):
    """Takes and returns rows: a key has a few pieces a batch, for which a frame costs more than the work."""

    def __init__(self, keys: Sequence[str], gap: int, timed: bool):
        self.gap, self.timed = gap, timed
        self.row = Row(*keys, "session", *FIELDS[1:], "closed", "gone")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("open", STATE)

    def _read(self) -> tuple[list[tuple], int]:
        kept = self.state.get()
        return ([], 0) if kept is None else (list(zip(*kept[1:])), kept[0])

    def _store(self, sessions: list[tuple], number: int) -> None:
        columns = [list(c) for c in zip(*sessions)] if sessions else [[] for _ in FIELDS]
        self.state.update((number, *columns))

    def _rows(self, key, sessions, gone=(), closed=False) -> Iterator[Row]:
        for s in sessions:
            yield self.row(*key, *s, closed, False)
        for number in gone:
            yield self.row(*key, number, None, None, None, None, False, True)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        pieces = [(None, r["first"], r["last"], r["events"], r["bytes"]) for r in rows]
        known, number = self._read()
        sessions, changed, gone, number = merged(known, pieces, self.gap, number)
        self._store(sessions, number)
        if self.timed and sessions:
            self.handle.registerTimer((min(s[2] for s in sessions) + self.gap) // 1000 + 1)
        yield from self._rows(key, changed, gone)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        bound = timerValues.getCurrentWatermarkInMs() * 1000
        known, number = self._read()
        over = [s for s in known if s[2] + self.gap < bound]
        left = [s for s in known if s[2] + self.gap >= bound]
        self._store(left, number)
        if left:
            self.handle.registerTimer((min(s[2] for s in left) + self.gap) // 1000 + 1)
        yield from self._rows(key, over, closed=True)

    def close(self) -> None:
        pass


def session_changes(rows: DataFrame, keys: Sequence[str], gap_seconds: float, watermark: str | None = None) -> DataFrame:
    """Changes of sessions of a streaming table with ``ts`` and ``bytes``: the ``keys``, ``session``, ``first``, ``last``
    (microseconds), ``events``, ``bytes``, ``closed`` and ``gone``. The newest change of each session is the table.

    Rows without a key or a time belong to no session. Without a watermark every session stays open, as any late
    event may still reach it; there a task first merges the events of its rows that lie less than a gap apart.
    """
    gap = int(gap_seconds * 1_000_000)
    rows = rows.dropna(subset=[*keys, "ts"])
    at = F.unix_micros("ts")
    if watermark:
        rows = rows.withWatermark("ts", watermark)
    columns = [*keys, at.alias("first"), at.alias("last"), F.lit(1).cast("bigint").alias("events"), F.col("bytes").cast("bigint")]
    pieces = rows.select(*columns, "ts") if watermark else _stretches(rows.select(*columns), keys, gap)
    out = StructType([rows.schema[k] for k in keys])
    for name in ("session", *FIELDS[1:]):
        out.add(name, "long")
    out.add("closed", "boolean").add("gone", "boolean")
    return pieces.groupBy(*keys).transformWithState(
        statefulProcessor=Sessions(keys, gap, bool(watermark)),
        outputStructType=out,
        outputMode="Update",
        timeMode="EventTime" if watermark else "None",
    )


def _stretches(rows: DataFrame, keys: Sequence[str], gap: int) -> DataFrame:
    """Events of a task's rows that share a key and a stretch of one gap, as one piece."""

    def merge(frames):
        for frame in frames:
            groups = frame.groupby([*keys, (frame["first"] // gap).rename("stretch")])
            pieces = groups.agg(first=("first", "min"), last=("last", "max"), events=("events", "sum"))
            pieces["bytes"] = groups["bytes"].sum(min_count=1)
            yield pieces.reset_index()[list(frame.columns)]

    return rows.mapInPandas(merge, rows.schema)
