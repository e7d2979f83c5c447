"""Per-key state of the streaming operators, in the columns of a RocksDB state store. Rows are taken a frame at a time."""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor


def _keep(state, rows: list) -> None:
    """A list state can't hold an empty list."""
    state.put(rows) if rows else state.clear()


#: Stands for a null among whole numbers.
_NONE = np.iinfo(np.int64).min


def _whole(column) -> np.ndarray:
    return pd.array(column, dtype="Int64").to_numpy(np.int64, na_value=_NONE)


class Gaps(StatefulProcessor):
    """Gaps of a symbol's updates. State: the last update that was placed, and at most `reorder` rows that wait for those before them, as runs.

    Spark gives a batch's rows in any order, so none is placed, or called late, before all are there. A run is a row, or rows of consecutive numbers, whose own gaps are
    given as they meet: (first seq, last seq, first row's first id, last row's last id). So what is in memory of a batch that comes nearly in order is a few runs.
    """

    def __init__(self, reorder: int | None, consecutive: bool):
        self.reorder, self.consecutive = reorder, consecutive and reorder is not None

    def init(self, handle):
        self.last = handle.getValueState("last", "id long, seq long")
        self.held = handle.getListState("held", "seq long, end long, first long, last long")

    @staticmethod
    def _frame(symbol, seq, first, prev, late=False):
        """The rows of gaps; late: of rows that came too late."""
        columns = {"seq": seq, "expected_u": np.full(len(seq), _NONE) if late else prev + 1, "first_u": first, "prev_u": np.full(len(seq), _NONE) if late else prev}
        return pd.DataFrame({"symbol": symbol, **{k: pd.array(v, dtype="Int64") for k, v in columns.items()}}).replace({_NONE: pd.NA})

    @staticmethod
    def _gaps(runs: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """seq, first id and previous id of the gaps before the runs at these places."""
        first, prev = runs[2, at], runs[3, at - 1]
        gap = (first != _NONE) & (prev != _NONE) & (first != prev + 1)
        return runs[0, at][gap], first[gap], prev[gap]

    def handleInputRows(self, key, rows, timerValues):
        last, seq = self.last.get() if self.last.exists() else (None, None)
        begun = seq is not None
        # the last placed row is the run before all others; nothing is known of what stands before the first row of all
        head = np.array([[seq if begun else -1 if self.consecutive else _NONE]] * 2 + [[_NONE], [_NONE if last is None else last]], np.int64)
        held = np.array([tuple(r) for r in self.held.get()], object).reshape(-1, 4)
        runs = np.concatenate([head, *[np.array([[_NONE if x is None else x for x in r]], np.int64).T for r in held]], axis=1)
        parts = []
        for f in rows:
            new = np.stack([_whole(f[c]) for c in ("seq", "seq", "first_update_id", "last_update_id")])
            new = new[:, np.lexsort((new[3], new[2], new[0]))]
            if self.reorder is not None:
                late = (new[0] <= head[1, 0]) | (new[0] == _NONE) if begun or self.consecutive else new[0] == _NONE
                if self.consecutive:  # a row that is there
                    known = np.searchsorted(runs[0], new[0], "right") - 1
                    late |= (known >= 0) & (new[0] <= runs[1, known])
                    late[1:] |= new[0, 1:] == new[0, :-1]
                if late.any():
                    yield self._frame(key[0], new[0, late], new[2, late], None, True)
                new = new[:, ~late]
            if not self.consecutive:
                parts.append(new)
                continue
            runs = np.concatenate([runs, new], axis=1)
            runs = runs[:, np.argsort(runs[0], kind="stable")]
            meets = np.flatnonzero(runs[0, 1:] == runs[1, :-1] + 1) + 1
            if len((found := self._gaps(runs, meets))[0]):
                yield self._frame(key[0], *found)
            start = np.setdiff1d(np.arange(runs.shape[1]), meets, assume_unique=True)
            stop = np.append(start[1:], runs.shape[1]) - 1
            runs = np.stack([runs[0, start], runs[1, stop], runs[2, start], runs[3, stop]])
        if parts:
            more = np.concatenate([runs[:, 1:], *parts], axis=1)
            runs = np.concatenate([runs[:, :1], more[:, np.lexsort((more[3], more[2], more[0]))]], axis=1)
        left = np.cumsum((runs[1, 1:] - runs[0, 1:] + 1)[::-1])[::-1]  # rows of each run and those behind it
        out = int(np.count_nonzero(left > (self.reorder or 0)))
        if out and len((found := self._gaps(runs, np.arange(1, out + 1)))[0]):
            yield self._frame(key[0], *found)
        seq, last = runs[1, out].item(), runs[3, out].item()
        none = lambda x: None if x == _NONE else x
        if out or begun or (self.consecutive and seq >= 0):
            self.last.update((none(last), none(seq)))
        if self.reorder is not None:
            _keep(self.held, [tuple(none(x) for x in r) for r in runs[:, out + 1 :].T.tolist()])


class Admit(StatefulProcessor):
    """Greedy admission under a sliding-window limit. State: the admitted times of the window, at most `limit`."""

    def __init__(self, limit: int, window: int):
        self.limit, self.window = limit, window

    def init(self, handle):
        self.times = handle.getListState("times", "at long")

    def handleInputRows(self, key, rows, timerValues):
        held = deque(r[0] for r in self.times.get())
        at = sorted(t for f in rows for t in f["at"].tolist())
        out = []
        for now in at:
            while held and held[0] <= now - self.window:
                held.popleft()
            out.append(len(held) < self.limit)
            if out[-1]:
                held.append(now)
        yield pd.DataFrame({"key": key[0], "at": at, "admitted": out})
        _keep(self.times, [(t,) for t in held])


class Idle(StatefulProcessor):
    """Connections that fall silent. State: the last activity, and the timer that it has set."""

    def __init__(self, seconds: int, activity: tuple[str, ...]):
        self.wait, self.activity = seconds * 1000, activity

    def init(self, handle):
        self.handle = handle
        self.last = handle.getValueState("last", "at long, timer long")

    def _clear(self):
        if self.last.exists():
            self.handle.deleteTimer(self.last.get()[1])
            self.last.clear()

    def handleInputRows(self, key, rows, timerValues):
        closed, active, first = None, None, None
        for f in rows:
            closed = max([x for x in (closed,) if x is not None] + f["at"][f["opcode"] == "Close"].tolist(), default=None)
            active = max([x for x in (active,) if x is not None] + f["at"][f["opcode"].isin(self.activity)].tolist(), default=None)
            first = min([x for x in (first,) if x is not None] + f["at"].tolist())
        if closed is not None:
            self._clear()
            if active is None or active <= closed:
                return iter([])
        elif active is None and self.last.exists():
            return iter([])  # neither a pong nor anything else shows that it lives
        self._clear()
        timer = timerValues.getCurrentProcessingTimeInMs() + self.wait
        self.last.update((first if active is None else active, timer))
        self.handle.registerTimer(timer)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if not self.last.exists():
            return
        at, timer = self.last.get()
        self.last.clear()
        yield pd.DataFrame({"connection": [key[0]], "last_activity": [at], "timeout_at": [timer * 1000]})


class Interleave(StatefulProcessor):
    """One log of two kinds of rows, in order. State: rows that the watermark hasn't passed, and how many have left."""

    def init(self, handle):
        self.handle = handle
        self.held = handle.getListState("held", "recv_nanos long, tag_byte int, payload binary")
        self.count = handle.getValueState("count", "n long")

    def _release(self, key, rows: list, watermark: int):
        rows.sort(key=lambda r: (r[0], r[1] == 82, bytes(r[2] or b"")))
        n = sum(1 for r in rows if r[0] < watermark * 1_000_000)
        start = self.count.get()[0] if self.count.exists() else 0
        _keep(self.held, [(r[0], r[1], None if r[2] is None else bytes(r[2])) for r in rows[n:]])
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if n < len(rows):
            self.handle.registerTimer(rows[n][0] // 1_000_000 + 1)
        if n:
            self.count.update((start + n,))
            yield pd.DataFrame({"symbol": key[0], "seq": range(start, start + n), "recv_nanos": [r[0] for r in rows[:n]], "tag_byte": [r[1] for r in rows[:n]], "payload": [r[2] for r in rows[:n]]})

    def handleInputRows(self, key, rows, timerValues):
        held = [tuple(r) for r in self.held.get()]
        for f in rows:
            held += zip(f["recv_nanos"].tolist(), f["tag_byte"].tolist(), f["payload"].tolist(), strict=True)
        yield from self._release(key, held, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._release(key, [tuple(r) for r in self.held.get()], timerValues.getCurrentWatermarkInMs())
