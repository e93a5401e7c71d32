"""Places and running folds within keys of which one may hold most of the rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from addrspark.shared import materialize

#: The base of folds that serve as fingerprints.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def powers(exponents: np.ndarray, base: int = BASE) -> np.ndarray:
    """``base ** exponents`` modulo 2 ** 64."""
    out, rest, square = np.ones(len(exponents), np.uint64), exponents.astype(np.uint64), base
    while rest.any():
        out = np.where(rest & np.uint64(1), out * np.uint64(square), out)
        rest, square = rest >> np.uint64(1), square * square % (1 << 64)
    return out


def running(rows: DataFrame, key: str, order: list[Column], columns: list[str], base: int, label: str) -> DataFrame:
    """``rows`` with ``at``, their place from 0 among those of a key in an order, and the running folds of ``columns``.

    The fold of values x0, x1, ... is ``(x0 * base + x1) * base + ...`` modulo 2 ** 64: a running sum for base 1. ``key`` and the
    columns are of type long, and not null. Rows are sorted by range, a task folds its own, and what a key had in the tasks before is
    added from a list of one row per task. ``order`` should tell rows apart, so that a key can be divided.
    """
    inverse = pow(base, -1, 1 << 64)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, done, folds = TaskContext.get().partitionId(), None, 0, [0] * len(columns)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(key).to_numpy()
            starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1 if now is None or keys[0] != now else now))
            first = np.zeros(n, np.int64)  # of each row, the first row of its key in the batch
            first[starts] = starts
            first = np.maximum.accumulate(first)
            going_on = np.arange(n) < (starts[0] if len(starts) else n)  # rows of the key that the last batch ended with
            steps = np.arange(n, dtype=np.int64) - first + 1
            at = steps - 1 + np.where(going_on, done, 0)
            power, out = powers(steps, base), []
            place = np.arange(n, dtype=np.int64)
            for k, column in enumerate(columns):
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(batch.column(column).to_numpy().view(np.uint64) * powers(place, inverse))])
                values = (sums[1:] - sums[first]) * powers(place, base)
                out.append(values + np.where(going_on, np.uint64(folds[k]) * power, np.uint64(0)))
            now, done, folds = int(keys[-1]), int(at[-1]) + 1, [int(v[-1]) for v in out]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int64)), pa.array(at), *[pa.array(v.view(np.int64)) for v in out]], names=names)

    runs = [f"{c}_run" for c in columns]
    names = [*rows.columns, "part", "at", *runs]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema], "part long", "at long", *[f"{r} long" for r in runs]])
    keys = [F.col(key), *order]
    stored = materialize(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(local, schema), label)
    last = F.max(F.struct(key, "at", *runs)).alias("last")  # the greatest key of a part is its last one
    edges = stored.groupBy("part").agg(last, F.min(key).alias("first")).collect()  # one row per task
    carried: dict[int, tuple] = {}
    held = (None, 0, [0] * len(columns))
    for edge in sorted(edges, key=lambda e: e.part):
        if held[0] == edge.first:
            carried[edge.part] = held
        count, folds = edge.last.at + 1, [edge.last[r] % (1 << 64) for r in runs]
        if held[0] == edge.last[key]:
            folds = [(f + h * pow(base, count, 1 << 64)) % (1 << 64) for f, h in zip(folds, held[2])]
            count += held[1]
        held = (edge.last[key], count, folds)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, at = batch.column("part").to_numpy(), batch.column("at").to_numpy()
            keys, steps = batch.column(key).to_numpy(), at + 1
            values = [batch.column(r).to_numpy().view(np.uint64) for r in runs]
            for part in np.unique(parts).tolist():
                if part in carried:
                    of, count, folds = carried[part]
                    mine = (parts == part) & (keys == of)
                    at = np.where(mine, at + count, at)
                    power = powers(steps, base)
                    values = [np.where(mine, v + np.uint64(f) * power, v) for v, f in zip(values, folds)]
            columns = dict(zip(names, batch.columns)) | {"at": pa.array(at)} | {r: pa.array(v.view(np.int64)) for r, v in zip(runs, values)}
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    return stored.mapInArrow(finish, schema).drop("part")
