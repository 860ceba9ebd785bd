"""Task outcomes with event-time timers: the state of a task outlives its timeout, so a late completion corrects it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

OUTCOME_SCHEMA = "task_id {id}, task_type {type}, started_us bigint, outcome string, finished_us bigint, revision int"
_NOTHING, _TIMED_OUT, _COMPLETED = 0, 1, 2  # what was told last
_NONE = np.iinfo(np.int64).min              # no time
_COLUMNS = ["task_id", "task_type", "started_us", "finished_us", "told"]


def _times(column: pd.Series) -> np.ndarray:
    return np.array([_NONE if pd.isna(x) else int(x) for x in column], np.int64) if column.hasnans else column.to_numpy(np.int64)


def _nullable(times: np.ndarray) -> pd.Series:
    return pd.Series(pd.arrays.IntegerArray(times.copy(), times == _NONE))


class TaskLifecycle(StatefulProcessor):
    """The tasks of one bucket of ids: starts, earliest completions in time, and what was told of each.

    Rows are (task_id, task_type, started_us, finished_us), a start or a completion.
    When the watermark is past a start's timeout the task is told as timed out, and kept
    for ``keep_us`` more; a completion that arrives in that time, but happened before the
    timeout, is told as the next revision.  Then the task goes, as does a completion that
    found no start for so long, so the state is bounded by the tasks of one span.  A
    bucket has a timer at its next due time, and one value, so that a batch costs a few
    exchanges with the state store per bucket and not per task.
    """

    def __init__(self, timeout_us: int, keep_us: int):
        self.timeout_us, self.keep_us = timeout_us, keep_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("tasks", "rows binary")

    def _read(self) -> pd.DataFrame | None:
        held = self.held.get()
        return None if held is None else pa.ipc.open_stream(held[0]).read_all().to_pandas()

    def _write(self, tasks: pd.DataFrame) -> None:
        if not len(tasks):
            self.held.clear()
            return
        table = pa.Table.from_pandas(tasks[_COLUMNS], preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        self.held.update((sink.getvalue().to_pybytes(),))
        self.handle.registerTimer(int(self._due(tasks).min()) // 1000 + 1)

    def _due(self, tasks: pd.DataFrame) -> np.ndarray:
        """When the next thing happens to each task by itself: its timeout, or its end."""
        started, finished, told = (tasks[c].to_numpy() for c in ("started_us", "finished_us", "told"))
        waits = (started != _NONE) & (told == _NOTHING)
        ends = np.where(started != _NONE, started + self.timeout_us, finished) + self.keep_us
        return np.where(waits, started + self.timeout_us, ends)

    def _told(self, tasks: pd.DataFrame, outcome: str, revision: np.ndarray) -> pd.DataFrame:
        finished = tasks["finished_us"].to_numpy() if outcome == "completed" else np.full(len(tasks), _NONE)
        return pd.DataFrame({
            "task_id": tasks["task_id"].to_numpy(), "task_type": tasks["task_type"].to_numpy(), "started_us": tasks["started_us"].to_numpy(),
            "outcome": outcome, "finished_us": _nullable(finished), "revision": revision.astype(np.int32),
        })

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = pd.concat(list(rows), ignore_index=True)
        fresh["started_us"], fresh["finished_us"] = _times(fresh["started_us"]), _times(fresh["finished_us"])
        fresh["told"] = _NOTHING
        known = self._read()
        everything = fresh if known is None else pd.concat([known, fresh[_COLUMNS]], ignore_index=True)
        everything["row"] = np.arange(len(everything))
        everything["fresh"] = everything["row"] >= (0 if known is None else len(known))
        # a task's start is the one known, else the earliest that came
        starts = everything[everything["started_us"] != _NONE].sort_values(["fresh", "started_us", "row"]).drop_duplicates("task_id")
        tasks = everything.groupby("task_id", sort=False, as_index=False)["told"].max()
        tasks = tasks.merge(starts[["task_id", "task_type", "started_us"]], "left", "task_id")
        tasks["started_us"] = _times(tasks["started_us"].astype("Int64")) if len(starts) < len(tasks) else tasks["started_us"]
        ends = everything.loc[everything["finished_us"] != _NONE, ["task_id", "finished_us"]].merge(tasks[["task_id", "started_us"]], on="task_id")
        open_ended = ends["started_us"] == _NONE
        ends = ends[open_ended | ((ends["finished_us"] >= ends["started_us"]) & (ends["finished_us"] <= ends["started_us"] + self.timeout_us))]
        first = ends.groupby("task_id")["finished_us"].min()
        tasks["finished_us"] = _times(tasks["task_id"].map(first).astype("Int64")) if len(first) < len(tasks) else tasks["task_id"].map(first)
        done = ((tasks["started_us"] != _NONE) & (tasks["finished_us"] != _NONE) & (tasks["told"] != _COMPLETED)).to_numpy()
        if done.any():
            yield self._told(tasks[done], "completed", (tasks["told"] == _TIMED_OUT).to_numpy()[done])
            tasks.loc[done, "told"] = _COMPLETED
        tasks["task_type"] = tasks["task_type"].astype(object).where(tasks["task_type"].notna(), None)
        self._write(tasks[(tasks["started_us"] != _NONE) | (tasks["finished_us"] != _NONE)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        tasks = self._read()
        if tasks is None:
            return
        reached = timerValues.getCurrentWatermarkInMs()
        late = ((tasks["started_us"] != _NONE) & (tasks["told"] == _NOTHING)).to_numpy() & (self._due(tasks) // 1000 < reached)
        if late.any():
            yield self._told(tasks[late], "timed_out", np.zeros(int(late.sum())))
            tasks.loc[late, "told"] = _TIMED_OUT
        left = self._due(tasks) // 1000 >= reached
        if late.any() or not left.all():
            self._write(tasks[left])
