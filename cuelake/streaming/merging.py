"""Merging of cues as they arrive: an extension.

Merging works on runs, between which a gap or a marker breaks. The stateful part puts
cues of a title in order and cuts runs; its state is the open run, and cues that came
before their turn. A run that is whole goes on to the fold that the batch uses, so both
give the same rows.

Cues carry `pos`, counted from 1 without gaps, and `arrived`, the time at which they came
in. A title that hears nothing for `wait` gives up on what is missing: what it holds is
taken in order, and its run closed. A cue whose turn has passed then, or that comes a
second time, is late: it is given as a merged cue by itself, marked as such, not dropped.

Needs spark.sql.streaming.stateStore.providerClass to name the RocksDB provider; with
it state is kept on disk and in the checkpoint, and a title costs what its open run has.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cuelake.operators import merge
from cuelake.operators.timing import NL

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_CUE = "pos bigint, idx int, start_ms bigint, end_ms bigint, m string, clean string"
_CUT = f"title_id string, late boolean, c {merge.RUN}"


class RunCutter(StatefulProcessor):
    """Cuts the cues of a title into runs."""

    def __init__(self, gap_threshold_ms: int, wait_ms: int):
        self.gap, self.wait = gap_threshold_ms, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", _CUE)
        self.early = handle.getListState("early", _CUE)
        self.at = handle.getValueState("at", "turn bigint, timer bigint")

    def _take(self, cue: tuple, run: list[tuple]) -> list[tuple] | None:
        """Adds a cue whose turn it is; returns the run that it ends, if it does."""
        if run and (cue[2] - run[-1][3] > self.gap or cue[4] == "NM"):
            whole = list(run)
            run[:] = [cue]
            return whole
        run.append(cue)
        return None

    def _keep(self, run: list[tuple], early: list[tuple], turn: int, timer: int) -> None:
        for state, rows in ((self.open, run), (self.early, early)):
            if rows:
                state.put(rows)
            elif state.exists():
                state.clear()
        self.at.update((turn, timer))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:  # noqa: N802, N803
        turn, timer = self.at.get() if self.at.exists() else (1, 0)
        run = [tuple(c) for c in self.open.get()] if self.open.exists() else []
        early = {c[0]: tuple(c) for c in self.early.get()} if self.early.exists() else {}
        latest = 0
        for r in rows:
            cue = (r["pos"], r["idx"], r["start_ms"], r["end_ms"], r["m"], r["clean"])
            latest = max(latest, r["arrived_ms"])
            if cue[0] < turn or cue[0] in early:
                yield Row(title_id=key[0], late=True, c=[cue])
            else:
                early[cue[0]] = cue
        while turn in early:
            whole = self._take(early.pop(turn), run)
            turn += 1
            if whole:
                yield Row(title_id=key[0], late=False, c=whole)
        due = max(timer, latest + self.wait)
        if due != timer:
            if timer:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
        self._keep(run, sorted(early.values()), turn, due)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[Row]:  # noqa: N802, N803
        turn, _ = self.at.get()
        run = [tuple(c) for c in self.open.get()] if self.open.exists() else []
        for c in sorted(tuple(c) for c in self.early.get()) if self.early.exists() else []:
            whole = self._take(c, run)
            turn = c[0] + 1
            if whole:
                yield Row(title_id=key[0], late=False, c=whole)
        if run:
            yield Row(title_id=key[0], late=False, c=run)
        self._keep([], [], turn, 0)

    def close(self) -> None:
        pass


def cut_runs(cues: DataFrame, gap_threshold_ms: int = 1000, wait_ms: int = 600_000) -> DataFrame:
    """(title_id, late, c) of a stream of cues with `arrived`: whole runs, and late cues one by one. Rows that arrived earlier than the watermark, `wait_ms` behind the newest, are dropped by the engine and counted in its progress."""
    own = merge.marked(cues.withWatermark("arrived", f"{wait_ms} milliseconds"))
    own = own.withColumn("arrived_ms", F.unix_millis("arrived")).select("title_id", "pos", "idx", "start_ms", "end_ms", "m", "clean", "arrived", "arrived_ms")
    return own.groupBy("title_id").transformWithState(statefulProcessor=RunCutter(gap_threshold_ms, wait_ms), outputStructType=_CUT, outputMode="Append", timeMode="EventTime")


def merge_stream(cues: DataFrame, gap_threshold_ms: int = 1000, max_duration_ms: int = NL["max_duration_ms"], most_lines: int = 2, width: int = 42, wait_ms: int = 600_000) -> DataFrame:
    """Merged cues of a stream of cues: (title_id, late, first_pos, start_ms, end_ms, text, source_count, source_indices, source_timecodes, gap_ms), as merge_cues has them but for the number in the title."""
    return merge.fold_runs(cut_runs(cues, gap_threshold_ms, wait_ms), max_duration_ms, most_lines, width)
