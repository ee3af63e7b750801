"""Arrow-batch helpers that run inside tasks.

Spark partitions, sorts and shuffles the rows; these only walk the batches of one sorted partition. The module
is pickled by value, so executors need numpy and pyarrow but not this package.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PREFIX = ("prefix_add", "prefix_low", "prefix_high")
IDENTITY = (0.0, -float("inf"), float("inf"))


def _prefixes(starts: np.ndarray, steps: list[np.ndarray]) -> list[np.ndarray]:
    """Inclusive compositions within runs, by doubling the span that each row covers."""
    add, low, high = steps
    row = np.arange(len(add))
    first = np.maximum.accumulate(np.where(starts, row, 0))
    span, longest = 1, int((row - first).max())
    while span <= longest:
        at = np.flatnonzero(row - span >= first)
        before, b, m, n = at - span, add[at], low[at], high[at]
        new_low = np.minimum(np.maximum(low[before] + b, m), n)
        new_high = np.minimum(np.maximum(high[before] + b, m), n)
        new_add = add[before] + b
        add[at], low[at], high[at] = new_add, new_low, new_high
        span *= 2
    return [add, low, high]


def _run_starts(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    starts = np.zeros(batch.num_rows, dtype=bool)
    starts[0] = True
    for key in keys:
        ends = pc.run_end_encode(batch.column(key)).run_ends.to_numpy(zero_copy_only=False)
        starts[ends[:-1]] = True
    return starts


def _mark_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add ``chunk_end``: true on the very last row of the partition. Holds back one batch to know it."""
    def with_mark(batch: pa.RecordBatch, final: bool) -> pa.RecordBatch:
        mark = np.zeros(batch.num_rows, dtype=bool)
        mark[-1] = final
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(mark)], names=[*batch.schema.names, "chunk_end"])

    held = None
    for batch in batches:
        if held is not None:
            yield with_mark(held, False)
        held = batch
    if held is not None:
        yield with_mark(held, True)


def chunk_kernel(keys: Sequence[str], step: Sequence[str]):
    """Arrow batches of one sorted partition -> same rows plus position and exclusive prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, carry, offset = None, IDENTITY, 0
        for batch in batches:
            size = batch.num_rows
            if size == 0:
                continue
            starts = _run_starts(batch, keys)
            steps = [batch.column(c).to_numpy(zero_copy_only=False).astype("float64").copy() for c in step]
            head = tuple(batch.column(k)[0].as_py() for k in keys)
            if head == last_key:  # the open run continues: start it from what was carried
                b, m, n = (s[0] for s in steps)
                steps[0][0] = carry[0] + b
                steps[1][0] = min(max(carry[1] + b, m), n)
                steps[2][0] = min(max(carry[2] + b, m), n)
                opening = carry
            else:
                opening = IDENTITY
            inclusive = _prefixes(starts, steps)
            exclusive = []
            for values, neutral, begin in zip(inclusive, IDENTITY, opening):
                shifted = np.empty_like(values)
                shifted[1:] = values[:-1]
                shifted[starts] = neutral
                shifted[0] = begin
                exclusive.append(pa.array(shifted))
            last_key = tuple(batch.column(k)[size - 1].as_py() for k in keys)
            carry = tuple(float(v[-1]) for v in inclusive)
            position = pa.array(np.arange(offset, offset + size, dtype="int64"))
            offset += size
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, position, *exclusive],
                names=[*batch.schema.names, "chunk_pos", *PREFIX])

    return lambda batches: _mark_end(run(batches))


def sum_kernel(keys: Sequence[str], sums: Sequence[str], previous: Sequence[str]):
    """Arrow batches of one sorted partition -> same rows plus position, sums before the row, and previous values.

    Sums are over integer columns, so they are exact; both restart at every new key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, totals, lasts, offset = None, [0] * len(sums), [None] * len(previous), 0
        for batch in batches:
            size = batch.num_rows
            if size == 0:
                continue
            starts = _run_starts(batch, keys)
            row = np.arange(size)
            first = np.maximum.accumulate(np.where(starts, row, 0))
            same = tuple(batch.column(k)[0].as_py() for k in keys) == last_key
            out = [*batch.columns, pa.array(np.arange(offset, offset + size, dtype="int64"))]
            for i, name in enumerate(sums):
                own = batch.column(name).to_numpy(zero_copy_only=False).astype("int64")
                before = np.cumsum(own) - own
                before = before - before[first]
                if same:
                    before[first == 0] += totals[i]
                totals[i] = int(before[-1] + own[-1])
                out.append(pa.array(before))
            for i, name in enumerate(previous):
                values = batch.column(name)
                at = pa.array(np.where(starts, -1, row - 1), mask=starts)
                prior = values.take(at)
                if same:
                    head = pa.array([lasts[i]], type=values.type)
                    prior = pa.concat_arrays([head, prior.slice(1)])
                lasts[i] = values[size - 1].as_py()
                out.append(prior)
            last_key = tuple(batch.column(k)[size - 1].as_py() for k in keys)
            offset += size
            names = [*batch.schema.names, "chunk_pos", *[f"before_{c}" for c in sums],
                     *[f"previous_{c}" for c in previous]]
            yield pa.RecordBatch.from_arrays(out, names=names)

    return lambda batches: _mark_end(run(batches))


def walk_periods(clock: np.ndarray, period: np.ndarray, limit: np.ndarray, until: int | None,
                 used: int) -> tuple[np.ndarray, int | None, int]:
    """Which firings of one key, in order, are accepted; goes from opener to opener, starting inside the period that ends at
    ``until`` (None: no period is open) with ``used`` firings accepted. Also gives the last period's end and count."""
    accepted = np.zeros(len(clock), bool)
    at = 0
    while at < len(clock):
        if until is None or clock[at] >= until:
            until, used = int(clock[at] + period[at]), 0
        # All firings of the open period at once: the first ones that its limit leaves room for.
        end = at + int(np.searchsorted(clock[at:], until))
        take = max(0, min(end - at, int(limit[at]) - used))
        accepted[at: at + take] = True
        used += take
        at = max(end, at + 1)
    return accepted, until, used


def period_kernel(keys: Sequence[str]):
    """Firings of one sorted partition -> same rows, with what is accepted if every run of a key starts without an open period, and
    for the first and last run of the partition what an opener at each row leads to.

    ``at`` is the place in the run. ``until`` is the end of the last period of the walk that starts at the row, ``rest`` the rows from that
    period's opener to the end of the run. ``near`` marks rows of the first run that a walk from before the partition can open at
    first: those inside one period of the run's first row, and one more. ``begins`` marks the first row of the last run.
    """

    def finish(parts: list[pa.RecordBatch], offset: int, final: bool) -> pa.RecordBatch:
        batch = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        size = batch.num_rows
        bounds = np.append(np.flatnonzero(_run_starts(batch, keys)), size)
        clock, period, limit = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("clock", "period", "max_in_period"))
        accepted, near, begins = (np.zeros(size, bool) for _ in range(3))
        until, rest = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            run = slice(low, high)
            accepted[run] = walk_periods(clock[run], period[run], limit[run], None, 0)[0]
            first, last = offset == 0 and low == 0, final and high == size
            if first or last:
                n = high - low
                ends = clock[run] + period[run]
                following = np.searchsorted(clock[run], ends)
                opener = np.where(following < n, following, np.arange(n))
                while (opener[opener] != opener).any():
                    opener = opener[opener]
                until[run], rest[run] = ends[opener], n - opener
                near[run] = first & (np.arange(n) <= following[0])
                begins[low] = last
        at = np.arange(size) - np.repeat(bounds[:-1], np.diff(bounds))
        out = [accepted, at, until, rest, near, begins, np.arange(offset, offset + size)]
        return pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, out)],
                                          names=[*batch.schema.names, "accepted", "at", "until", "rest", "near", "begins", "chunk_pos"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        offset = 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            begin = np.flatnonzero(_run_starts(batch, keys))
            if held and all(held[-1].column(k)[-1] == batch.column(k)[0] for k in keys):
                begin = begin[1:]
            if not len(begin):
                held.append(batch)
                continue
            done = [*held, batch.slice(0, begin[-1])] if begin[-1] else held
            if done:
                yield finish(done, offset, False)
                offset += sum(p.num_rows for p in done)
            held = [batch.slice(begin[-1])]
        if held:
            yield finish(held, offset, True)

    return lambda batches: _mark_end(run(batches))


def resumed_kernel():
    """First runs of partitions, by chunk and in order -> same rows with what is accepted, starting in the period that the
    row's ``carried_until`` and ``carried_used`` describe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, until, used = None, None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            chunks = batch.column("chunk").to_numpy()
            bounds = np.append(np.flatnonzero(np.append(True, chunks[1:] != chunks[:-1])), len(chunks))
            clock, period, limit, ends, counts = (batch.column(c).to_numpy(zero_copy_only=False) for c in (
                "clock", "period", "max_in_period", "carried_until", "carried_used"))
            accepted = np.zeros(len(chunks), bool)
            for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if chunks[low] != chunk:
                    chunk, until, used = chunks[low], int(ends[low]), int(counts[low])
                part = slice(low, high)
                accepted[part], until, used = walk_periods(clock[part], period[part], limit[part], until, used)
            names = batch.schema.names
            columns = [pa.array(accepted) if n == "accepted" else c for n, c in zip(names, batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def target_kernel(chains: dict[tuple[int, bool], tuple[list[int], list[int]]]):
    """Nodes (chunk, start, until, ...) -> with the chunk that holds the first firing at or after ``until``, or null. ``chains`` gives for
    a chunk, and whether its last key starts there or its first one goes on, that key's later chunks and the last clock of each but the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks, until = batch.column("chunk").to_numpy(), batch.column("until").to_numpy()
            target = np.full(len(chunks), -1, np.int64)
            start = batch.column("start").to_numpy(zero_copy_only=False)
            for c, s in set(zip(chunks.tolist(), start.tolist())):
                later, lasts = chains[c, s]
                rows = np.flatnonzero((chunks == c) & (start == s))
                if later:
                    target[rows] = np.array(later)[np.searchsorted(lasts, until[rows])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(target, mask=target < 0)], names=[*batch.schema.names, "target"])

    return run


def next_openers():
    """Nodes whose target is a chunk, and that chunk's nodes -> (node, next): the first of its nodes at or after ``until``."""

    def run(asking: pa.Table, there: pa.Table) -> pa.Table:
        order = np.argsort(there.column("node").to_numpy())
        clock, node = there.column("clock").to_numpy()[order], there.column("node").to_numpy()[order]
        at = np.searchsorted(clock, asking.column("until").to_numpy())
        found = at < len(clock)
        return pa.table({"node": asking.column("node").to_numpy()[found], "next": node[at[found]]},
                        schema=pa.schema([("node", pa.int64()), ("next", pa.int64())]))

    return run


class DecayMap:
    """A monotone piecewise-linear map of scores on [low, high], with pieces of slope 0 and 1, as its break points.

    Each decay makes one more flat piece at least as long as the points it takes, so there are at most about range / points pieces.
    """

    def __init__(self, low: float, high: float):
        self.x, self.y = np.array([low, high]), np.array([low, high])

    def _cut(self, value: float) -> None:
        at = int(np.searchsorted(self.y, value))
        if 0 < at < len(self.y) and self.y[at - 1] < value < self.y[at]:
            self.x = np.insert(self.x, at, self.x[at - 1] + value - self.y[at - 1])
            self.y = np.insert(self.y, at, value)

    def decay(self, lost: float, floor: float) -> None:
        self._cut(floor)
        self._cut(floor + lost)
        self.y = np.where(self.y <= floor, self.y, np.maximum(self.y - lost, floor))
        self._tidy()

    def step(self, add: float, low: float, high: float) -> None:
        self._cut(low - add)
        self._cut(high - add)
        self.y = np.minimum(np.maximum(self.y + add, low), high)
        self._tidy()

    def _tidy(self) -> None:
        inner = (self.y[:-2] == self.y[1:-1]) & (self.y[1:-1] == self.y[2:])
        keep = np.append(np.append(True, ~inner), True)
        self.x, self.y = self.x[keep], self.y[keep]


class DecayWalk:
    """One key's bounded score along its events, with points lost per whole day above a floor."""

    def __init__(self, low: float, high: float, points: float, floor: float):
        self.low, self.high, self.points, self.floor = low, high, points, floor

    def opened(self, score: float, idle: int) -> float:
        if idle <= 0 or score <= self.floor:
            return score
        return max(score - self.points * idle, self.floor)

    def walk(self, score: float, day: int | None, days: list[int], changes: list[float]) -> tuple[list[float], float]:
        """Scores before each event, and the last one after it."""
        before = []
        for d, change in zip(days, changes):
            if day is not None and d != day:
                score = self.opened(score, d - day)
            day = d
            before.append(score)
            score = min(max(score + change, self.low), self.high)
        return before, score

    def extend(self, so_far: DecayMap, day: int | None, days: np.ndarray, changes: list[float]) -> None:
        """Put more events of a key behind a map: a decay and one bounded step per day."""
        cuts = np.append(np.flatnonzero(np.append(True, days[1:] != days[:-1])), len(days)).tolist()
        for a, b in zip(cuts[:-1], cuts[1:]):
            d = int(days[a])
            if day is not None and d > day:
                so_far.decay(self.points * (d - day), self.floor)
            day = d
            add, low, high = 0.0, -float("inf"), float("inf")
            for change in changes[a:b]:
                add, low, high = (add + change, min(max(low + change, self.low), self.high), min(max(high + change, self.low), self.high))
            so_far.step(add, low, high)


_EDGE = ("edge_map_x", "edge_map_y", "edge_score", "edge_first", "edge_last", "edge_whole")


def decay_kernel(key: str, walker: DecayWalk):
    """Events of one sorted partition -> same rows with ``before`` (the score they meet, if the partition's first key starts in it),
    ``chunk_pos`` and ``head`` (row of the first key). One or two rows more tell what the partition's first and last key lead to: the
    first key's map, the last score and the first and last day."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, score, day, first_day, offset, head, schema = None, 0.0, None, None, 0, True, None
        so_far, first_edge = DecayMap(walker.low, walker.high), None
        for batch in batches:
            size = batch.num_rows
            if size == 0:
                continue
            schema = batch.schema
            keys = batch.column(key)
            bounds = np.append(np.flatnonzero(_run_starts(batch, [key])), size).tolist()
            days = batch.column("day").to_numpy(zero_copy_only=False)
            changes = batch.column("score_change").to_pylist()
            before, heads = [], np.zeros(size, bool)
            for a, b in zip(bounds[:-1], bounds[1:]):
                own = keys[a].as_py()
                if (offset == 0 and a == 0) or own != name:
                    if offset or a:
                        if head:
                            first_edge = (name, so_far, score, first_day, day, False)
                        head = False
                    name, score, day = own, batch.column("opening_score")[a].as_py(), batch.column("since")[a].as_py()
                    first_day = int(days[a])
                    known = None
                else:
                    known = day
                if head:
                    walker.extend(so_far, known, days[a:b], changes[a:b])
                    heads[a:b] = True
                part, score = walker.walk(score, day, days[a:b].tolist(), changes[a:b])
                before += part
                day = int(days[b - 1])
            none = [pa.nulls(size, t) for t in (pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64(), pa.int32(), pa.int32(),
                                                pa.bool_())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(before, pa.float64()), pa.array(np.arange(offset, offset + size)), pa.array(heads), *none],
                names=[*schema.names, "before", "chunk_pos", "head", *_EDGE])
            offset += size
        if schema is None:
            return
        last_edge = (name, so_far if head else None, score, first_day, day, head)
        edges = [e for e in (first_edge, last_edge) if e]
        n = len(edges)
        own = {key: pa.array([e[0] for e in edges], schema.field(key).type), "chunk": batch.column("chunk").slice(0, 1)}
        if n == 2:
            own["chunk"] = pa.concat_arrays([own["chunk"], own["chunk"]])
        columns = [own.get(f.name, pa.nulls(n, f.type)) for f in schema]
        columns += [pa.nulls(n, pa.float64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_())]
        columns += [pa.array([e[1].x.tolist() if e[1] else None for e in edges], pa.list_(pa.float64())),
                    pa.array([e[1].y.tolist() if e[1] else None for e in edges], pa.list_(pa.float64())),
                    pa.array([e[2] for e in edges], pa.float64()), pa.array([e[3] for e in edges], pa.int32()),
                    pa.array([e[4] for e in edges], pa.int32()), pa.array([e[5] for e in edges], pa.bool_())]
        yield pa.RecordBatch.from_arrays(columns, names=[*schema.names, "before", "chunk_pos", "head", *_EDGE])

    return run


def resumed_decay_kernel(walker: DecayWalk):
    """First keys of partitions, by chunk and in order -> same rows with ``before`` from the score and day their chunk is entered with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, score, day = None, 0.0, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            chunks = batch.column("chunk").to_numpy()
            days, changes = batch.column("day").to_pylist(), batch.column("score_change").to_pylist()
            bounds = np.append(np.flatnonzero(np.append(True, chunks[1:] != chunks[:-1])), len(chunks)).tolist()
            before = []
            for a, b in zip(bounds[:-1], bounds[1:]):
                if chunks[a] != chunk:
                    chunk, score, day = chunks[a], batch.column("carried_score")[a].as_py(), batch.column("carried_day")[a].as_py()
                part, score = walker.walk(score, day, days[a:b], changes[a:b])
                before += part
                day = days[b - 1]
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays(
                [pa.array(before, pa.float64()) if n == "before" else c for n, c in zip(names, batch.columns)], names=names)

    return run


def stream_fold(low: float, high: float, baseline: float, grid: float):
    """State function of the streaming score: one subject's new changes, in time order, onto its stored score."""

    def run(key, frames, state):
        import math

        import pandas as pd

        rows = pd.concat(list(frames), ignore_index=True).sort_values(["ts", "event_id"], kind="stable")
        if state.exists:
            score, seen = state.get
        else:
            opening = rows["opening_score"].iloc[0]
            score, seen = (baseline if opening is None or math.isnan(opening) else float(opening)), 0
        before, after = [], []
        for change in rows["score_change"].tolist():
            before.append(score)
            score = min(max(score + change, low), high)
            after.append(score)
        state.update((score, seen + len(rows)))

        def settle(values):
            return np.floor(np.asarray(values) * grid + 0.50001) / grid

        yield pd.DataFrame({"subject_id": rows["subject_id"].to_numpy(), "event_id": rows["event_id"].to_numpy(),
                            "ts": rows["ts"].to_numpy(), "score_change": rows["score_change"].to_numpy(),
                            "previous_score": settle(before), "new_score": settle(after)})

    return run
