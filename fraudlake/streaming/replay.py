"""Was a request answered from a cache with a fixed time to live?

A request is a hit if the same key was STORED at most ``ttl`` seconds before; a
hit does not renew the entry, so the flag depends on the last miss, not on the
previous request. Times are whole seconds.
"""

import tempfile

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import config as C

CHUNK_SECONDS = 1 << 20
BLOCK_ROWS = 1 << 17
SPAN_MS = 3_600_000


def _successors(t: np.ndarray, ttl: int) -> np.ndarray:
    """Place of the first second later than t + ttl: the next miss, if t is one."""
    return np.searchsorted(t, t + ttl, side="right")


def cache_flags(df: DataFrame, key: str, time: str, row_id: str,
                ttl: int = C.CACHE_TTL_SECONDS, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Batch form: adds ``cached``.

    Only the first request of a key in a second can be a miss, so a key is first
    reduced to its distinct seconds (pre-aggregated before the shuffle). After a miss the
    next one is the first second more than ``ttl`` later, wherever in the timeline that
    is. So the timeline is cut into chunks of ``chunk_seconds`` (at least two lives), and
    each is walked on its own for every second at which the misses may enter it: those of its
    first ``ttl`` seconds and the one after them. What is left per key is one line of
    (chunk, entry, last miss), walked once; then each chunk is walked from its one true
    entry. A task holds one chunk of a key, however many rows a hot key has and however
    long its timeline is, or one key's line, of at most ``ttl`` + 1 rows a chunk.

    The misses go back to the rows by the unique row id. A row without a time is no miss.
    """
    width = max(2 * ttl, chunk_seconds)
    kinds = dict(df.dtypes)
    seconds = (
        df.where(F.col(time).isNotNull()).groupBy(key, time).agg(F.min(row_id).alias("_id"))
        .select(key, F.col(time).cast("long").alias("_t"), "_id",
                F.floor(F.col(time) / width).cast("long").alias("_chunk")))

    def exits(rows: pa.Table) -> pa.Table:
        t = np.sort(rows["_t"].to_numpy())
        after, n = _successors(t, ttl), len(t)
        last = np.where(after < n, after, np.arange(n))
        while (further := last[last]).tolist() != last.tolist():  # doubles its stride
            last = further
        begin = int(rows["_chunk"][0].as_py()) * width
        entry = np.arange(min(n, np.searchsorted(t, begin + ttl) + 1))
        return pa.table([rows[key].slice(0, 1).take([0] * len(entry)), rows["_chunk"].slice(0, 1).take([0] * len(entry)),
                         pa.array(t[entry]), pa.array(t[last[entry]])], names=[key, "_chunk", "_entry", "_last"])

    def line(rows: pa.Table) -> pa.Table:
        chunk, entry, last = (rows[c].to_numpy() for c in ("_chunk", "_entry", "_last"))
        order = np.lexsort((entry, chunk))
        chunk, entry, last = chunk[order], entry[order], last[order]
        cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
        found, dead_until = [], None
        for lo, hi in zip(cuts, cuts[1:]):
            i = lo if dead_until is None else lo + int(np.searchsorted(entry[lo:hi], dead_until, side="right"))
            if i < hi:
                found.append(i)
                dead_until = last[i] + ttl
        return pa.table([rows[key].slice(0, 1).take([0] * len(found)), pa.array(chunk[found]), pa.array(entry[found])],
                        names=[key, "_chunk", "_entry"])

    def walk(rows: pa.Table, entries: pa.Table) -> pa.Table:
        found = []
        if entries.num_rows:
            rows = rows.sort_by("_t")
            t = rows["_t"].to_numpy()
            after, i = _successors(t, ttl), int(np.searchsorted(t, entries["_entry"][0].as_py()))
            while i < len(t):
                found.append(i)
                i = int(after[i])
        return pa.table([rows["_id"].take(pa.array(found, pa.int64()))], names=["_miss_id"])

    lines = seconds.groupBy(key, "_chunk").applyInArrow(
        exits, f"{key} {kinds[key]}, _chunk long, _entry long, _last long")
    entries = lines.groupBy(key).applyInArrow(line, f"{key} {kinds[key]}, _chunk long, _entry long")
    misses = seconds.groupBy(key, "_chunk").cogroup(entries.groupBy(key, "_chunk")).applyInArrow(
        walk, f"_miss_id {kinds[row_id]}")
    return (df.join(misses, df[row_id] == misses["_miss_id"], "left")
            .withColumn("cached", F.col("_miss_id").isNull()).drop("_miss_id"))


def _first_rows(t: np.ndarray, ids: np.ndarray, *more: np.ndarray) -> list[np.ndarray]:
    """Each second once, in order, with its first row by id; ``more`` goes along."""
    order = np.lexsort((ids, t))
    order = order[np.append(True, np.diff(t[order]) != 0)] if len(order) else order
    return [x[order] for x in (t, ids, *more)]


def _misses(t: np.ndarray, last, ttl: int) -> np.ndarray:
    """Places of the misses among sorted distinct seconds after a miss at ``last`` (or None)."""
    found, i = [], 0 if last is None else int(np.searchsorted(t, last + ttl, side="right"))
    while i < len(t):
        found.append(i)
        i = int(np.searchsorted(t, t[i] + ttl, side="right"))
    return np.array(found, np.int64)


class _Marker:
    """Tells the misses' rows from the others, block by block; of equal rows the first is the miss."""

    def __init__(self, t: np.ndarray, ids: np.ndarray):
        self.t, self.ids, self.done = t, ids, np.zeros(len(t), bool)

    def cached(self, t: np.ndarray, ids: np.ndarray) -> np.ndarray:
        out = np.ones(len(t), bool)
        if len(self.t):
            at = np.minimum(np.searchsorted(self.t, t), len(self.t) - 1)
            mine = np.flatnonzero((self.t[at] == t) & (self.ids[at] == ids) & ~self.done[at])
            which, place = np.unique(at[mine], return_index=True)
            out[mine[place]], self.done[which] = False, True
        return out


class _Replay(StatefulProcessor):
    """Holds a key's rows until no earlier one can come, then walks them in order.

    Rows wait in blocks of at most ``BLOCK_ROWS``, packed by span of time (an hour or one of
    ``every``, if longer). A span is walked in two readings of its blocks: the first keeps one row
    a second, the second hands out the flags. So a worker holds one block and one span's seconds,
    however many rows a key has."""

    def __init__(self, names: tuple[str, str, str], ttl: int, every_ms: int):
        self.names, self.ttl, self.every = names, ttl, every_ms
        self.width = every_ms * max(1, SPAN_MS // every_ms)

    def init(self, handle):
        self.handle = handle
        self.spans = handle.getMapState("spans", "span long", "n long, first long")  # blocks, earliest row
        self.blocks = handle.getMapState("blocks", "span long, number long", "packed binary")
        self.miss = handle.getValueState("miss", "t long, ms long")

    def handleInputRows(self, key, rows, timerValues):
        held, n, first = [], 0, None
        for part in rows:
            if len(part):
                # names may come changed; (seconds, ids, milliseconds)
                block = np.stack([part.iloc[:, i].to_numpy(np.int64) for i in (1, 2, 4)])
                first = int(block[2].min()) if first is None else min(first, int(block[2].min()))
                held.append(block)
                n += len(part)
                if n >= BLOCK_ROWS:
                    self._keep(np.concatenate(held, 1))
                    held, n = [], 0
        if held:
            self._keep(np.concatenate(held, 1))
        if first is not None:
            self._wake(first)
        return iter(())

    def _keep(self, rows: np.ndarray):
        span = rows[2] // self.width
        order = np.argsort(span, kind="stable")
        rows, span = rows[:, order], span[order]
        for part in np.split(rows, np.flatnonzero(np.diff(span)) + 1, axis=1):
            first = int(part[2].min())
            place = (first // self.width,)
            n, before = self.spans.getValue(place) if self.spans.containsKey(place) else (0, first)
            self.blocks.updateValue((*place, n), (part.tobytes(),))
            self.spans.updateValue(place, (n + 1, min(first, before)))

    def _read(self, span: int, n: int):
        for i in range(n):
            yield np.frombuffer(self.blocks.getValue((span, i))[0], np.int64).reshape(3, -1)

    def _wake(self, ms):
        """A timer for the end of the row's span; one for a key's earliest row is enough."""
        due = (ms // self.every + 1) * self.every
        if due not in set(self.handle.listTimers()):
            self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs()
        due = now // self.every * self.every  # all rows of times that end by now
        last = self.miss.get() if self.miss.exists() else None
        for span in sorted(x[0] for x in self.spans.keys()):
            n, first = self.spans.getValue((span,))
            if first >= due:
                break
            seconds = np.empty((3, 0), np.int64)
            for rows in self._read(span, n):
                seconds = np.stack(_first_rows(*np.concatenate([seconds, rows[:, rows[2] < due]], 1)))
            at = _misses(seconds[0], None if last is None else last[0], self.ttl)
            marker = _Marker(seconds[0][at], seconds[1][at])
            if len(at):
                last = (int(seconds[0][at[-1]]), int(seconds[2][at[-1]]))
                self.miss.update(last)
            rest = 0
            for number, rows in enumerate(self._read(span, n)):
                ready, later = rows[:, rows[2] < due], rows[:, rows[2] >= due]
                self.blocks.removeKey((span, number))
                if later.shape[1]:  # numbered anew, never past the block just read
                    self.blocks.updateValue((span, rest), (later.tobytes(),))
                    rest, first = rest + 1, int(later[2].min()) if not rest else min(first, int(later[2].min()))
                if ready.shape[1]:
                    yield pd.DataFrame({self.names[0]: key[0], self.names[1]: ready[0], self.names[2]: ready[1],
                                        "cached": marker.cached(ready[0], ready[1])})
            if rest:
                self.spans.updateValue((span,), (rest, first))
            else:
                self.spans.removeKey((span,))
        waiting = [first for _, first in self.spans.values()]
        if waiting:
            self._wake(min(waiting))
        elif last is not None:  # the entry is forgotten when its life has passed
            end = last[1] + (self.ttl + 1) * 1000
            if now > end:
                self.miss.clear()
            else:
                self._wake(int(end))

    def close(self):
        pass


def cache_flags_ordered(df: DataFrame, key: str, time: str, row_id: str, event_time: str,
                        ttl: int = C.CACHE_TTL_SECONDS, lateness: str = "1 hour", every: int = 60) -> DataFrame:
    """Streaming form that gives what the batch form gives, whatever the order in which rows come
    within ``lateness``: a row waits in state until the watermark has passed the end of its
    ``every`` seconds, then leaves in order of (time, id) with the others of its key. Rows
    behind the watermark are dropped by the engine and counted in the query's progress
    (``runner.late_rows``). ``time`` (whole seconds) and ``event_time`` tick alike.

    The state of a key is its last miss, until that entry's life has passed, and the rows of one
    lateness, in packed blocks; a worker holds one block and the distinct seconds of one hour. Needs a state store with column families, which
    ``runner`` sets where none is set."""
    kinds = dict(df.dtypes)
    rows = (df.select(key, F.col(time).cast("long").alias(time), F.col(row_id).cast("long").alias(row_id), event_time)
            .withColumn("_ms", F.unix_millis(event_time)).withWatermark(event_time, lateness))
    return rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=_Replay((key, time, row_id), ttl, every * 1000),
        outputStructType=f"{key} {kinds[key]}, {time} long, {row_id} long, cached boolean",
        outputMode="append", timeMode="eventTime")


def _trigger_flags(key: str, time: str, row_id: str, event_time: str, ttl: int):
    """The function that flags a key's rows of one trigger, see ``cache_flags_stream``."""
    def flags(k, chunks, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        parts, newest, n = [[np.empty(0, np.int64)] * 2], None, 0
        with tempfile.TemporaryFile() as kept:
            for rows in chunks:
                t, ids = rows[time].to_numpy(), rows[row_id].to_numpy()
                np.save(kept, t)
                np.save(kept, ids)
                newest, n = max(newest or rows[event_time].max(), rows[event_time].max()), n + 1
                parts.append(_first_rows(t, ids))
                if sum(len(x) for x, _ in parts[1:]) > max(BLOCK_ROWS, len(parts[0][0])):
                    parts = [_first_rows(*map(np.concatenate, zip(*parts)))]
            seconds = _first_rows(*map(np.concatenate, zip(*parts)))
            early = last  # an entry of the future is no hit
            t, ids = (x if last is None else x[np.searchsorted(seconds[0], last):] for x in seconds)
            at = _misses(t, last, ttl)
            marker = _Marker(t[at], ids[at])
            if len(at):
                last = int(t[at[-1]])
            state.update((last,))
            state.setTimeoutTimestamp(max(int(newest.timestamp() * 1000) + (ttl + 1) * 1000,
                                          state.getCurrentWatermarkMs() + 1))
            kept.seek(0)
            for _ in range(n):
                t, ids = np.load(kept), np.load(kept)
                cached = marker.cached(t, ids)
                if early is not None:
                    cached &= t >= early
                yield pd.DataFrame({key: k[0], time: t, row_id: ids, "cached": cached})

    return flags


def cache_flags_stream(df: DataFrame, key: str, time: str, row_id: str, event_time: str,
                       ttl: int = C.CACHE_TTL_SECONDS, lateness: str = "1 hour") -> DataFrame:
    """Streaming form over a frame with the timestamp ``event_time``. The state of a
    key is the second of its last miss; it is dropped once the watermark passes the
    end of that entry's life. Rows of one trigger are ordered by (time, id), and rows leave with the
    trigger they came in; ``cache_flags_ordered`` waits for those that come late.

    A key's rows of a trigger are read twice, the second time from a temporary file of the worker,
    which holds one Arrow batch of them and the distinct seconds."""
    kinds = dict(df.dtypes)
    schema = f"{key} {kinds[key]}, {time} long, {row_id} long, cached boolean"
    return (
        df.select(key, time, row_id, event_time).withWatermark(event_time, lateness).groupBy(key)
        .applyInPandasWithState(_trigger_flags(key, time, row_id, event_time, ttl), schema, "last_miss long", "append",
                                GroupStateTimeout.EventTimeTimeout)
    )
