"""Records of CSV byte ranges, line by line in Arrow batches: a task reads its ranges in order and keeps one open record at most."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

COUNTS = "fid long, start long, odd long, begun0 long, begun1 long"
RECORDS = "fid long, start long, number long, record string"


def _by_range(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """Rows of one batch by their range, in order."""
    fid, start = batch.column("fid").to_numpy(), batch.column("start").to_numpy()
    cuts = [0, *(np.flatnonzero((fid[1:] != fid[:-1]) | (start[1:] != start[:-1])) + 1).tolist(), len(fid)]
    for low, high in zip(cuts, cuts[1:]):
        if high > low:
            yield (int(fid[low]), int(start[low])), batch.slice(low, high - low)


def count_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Quote parity of each range and the records begun in it, if it begins outside of quotes (0) or inside (1)."""
    found: dict[tuple[int, int], list[int]] = {}
    for batch in batches:
        for key, some in _by_range(batch):
            odd, *begun = found.setdefault(key, [0, 0, 0])
            total = odd + np.cumsum(some.column("quotes").to_numpy(), dtype=np.int64)
            inside = np.append(odd, total[:-1]) % 2
            within = int(inside.sum())
            found[key] = [int(total[-1] % 2), begun[0] + len(inside) - within, begun[1] + within]
    rows = [(*key, *counts) for key, counts in found.items()]
    names = [field.split()[0] for field in COUNTS.split(", ")]
    yield pa.RecordBatch.from_arrays([pa.array([row[i] for row in rows], pa.int64()) for i in range(5)], names)


class _Range:
    """A range being read: the number of the last record begun, whether the next line lies inside quotes, the lines of an open record."""

    def __init__(self, key: tuple[int, int], opened: int, records: int):
        self.key, self.inside, self.number = key, opened, records
        self.lines: list[str] = []
        self.begun = False  # the open record began in this range

    def read(self, values: pa.Array) -> tuple[list[tuple[int, str]], list[tuple[int, str]], np.ndarray, pa.Array | None]:
        """(whole, parts, numbers, records) by these lines: ended open records, and the records that begin and end here."""
        total = self.inside + np.cumsum(pc.count_substring(values, '"').to_numpy(zero_copy_only=False), dtype=np.int64)
        begins = np.flatnonzero(np.append(self.inside, total[:-1]) % 2 == 0)
        self.inside = int(total[-1] % 2)
        if not len(begins):
            self.lines += values.to_pylist()
            return [], [], begins, None
        self.lines += values.slice(0, begins[0]).to_pylist()
        whole, parts = self.end(closed=True)
        ends = np.append(begins, len(values)).astype(np.int32) if not self.inside else begins.astype(np.int32)
        numbers = self.number + np.arange(1, len(ends), dtype=np.int64)
        self.number += len(begins)
        if self.inside:
            self.lines, self.begun = values.slice(begins[-1]).to_pylist(), True
        records = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), values), "\n") if len(numbers) else None
        return whole, parts, numbers, records

    def end(self, closed: bool) -> tuple[list[tuple[int, str]], list[tuple[int, str]]]:
        """The open record, if there is one: whole if it began here and is closed, else a part."""
        found = [(self.number, "\n".join(self.lines))] if self.lines else []
        whole = self.begun and closed
        self.lines, self.begun = [], False
        return (found, []) if whole else ([], found)


def records_of(parts_only: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Whole records of each range, or else the parts of records that reach into another one."""

    def out(key: tuple[int, int], numbers: pa.Array, records: pa.Array) -> pa.RecordBatch:
        n = len(numbers)
        columns = [pa.repeat(pa.scalar(k, pa.int64()), n) for k in key]
        return pa.RecordBatch.from_arrays([*columns, numbers, records], ["fid", "start", "number", "record"])

    def listed(key: tuple[int, int], some: list[tuple[int, str]]) -> Iterator[pa.RecordBatch]:
        if some:
            yield out(key, pa.array([n for n, _ in some], pa.int64()), pa.array([text for _, text in some], pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Range | None = None
        for batch in batches:
            for key, some in _by_range(batch):
                if now is None or now.key != key:
                    if now is not None:
                        yield from listed(now.key, now.end(closed=not now.inside)[parts_only])
                    now = _Range(key, some.column("open")[0].as_py(), some.column("records")[0].as_py())
                whole, parts, numbers, records = now.read(some.column("value").cast(pa.string()))
                yield from listed(key, parts if parts_only else whole)
                if records is not None and not parts_only:
                    yield out(key, pa.array(numbers, pa.int64()), records)
        if now is not None:
            yield from listed(now.key, now.end(closed=not now.inside)[parts_only])

    return run
