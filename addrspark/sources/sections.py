"""Comments, CDATA sections and instructions that run over the pieces of a text file cut by many tasks.

A piece is a row (value, _file, _block): text of a file after a separator, and the start of the part of the file that
its task reads. The tasks see the pieces of a part in order. The state at a place is the kind of section it lies in,
0 for none. A section ends at the first of its end marks, and nothing begins inside it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

# The marks that begin and end a section, by state.
BEGIN = {1: "<!--", 2: "<![CDATA[", 3: "<?"}
END = {1: "-->", 2: "]]>", 3: "?>"}
STATES = range(len(BEGIN) + 1)
BEGINS = re.compile("|".join(f"({re.escape(mark)})" for mark in BEGIN.values()))
MARK = "|".join(re.escape(mark) for mark in [*BEGIN.values(), *END.values()])

PIECES = "value string, _file string, _block long, outside int"
ENDS = "_file string, _block long, ends array<int>"


def state_after(text: str, state: int) -> int:
    """The state at the end of a text that begins in ``state``."""
    at = 0
    while True:
        if state:
            found = text.find(END[state], at)
            if found < 0:
                return state
            at, state = found + len(END[state]), 0
        else:
            begin = BEGINS.search(text, at)
            if begin is None:
                return 0
            at, state = begin.end(), begin.lastindex


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Ranges of rows of one part."""
    files, blocks = (batch.column(name) for name in ("_file", "_block"))
    n = batch.num_rows
    if not n:
        return
    same = pc.and_(pc.equal(files.slice(1), files.slice(0, n - 1)), pc.equal(blocks.slice(1), blocks.slice(0, n - 1)))
    cuts = [0, *(np.flatnonzero(~same.to_numpy(zero_copy_only=False)) + 1), n]
    yield from zip(cuts[:-1], cuts[1:])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list]]:
    """Each batch, with a bit per state for each piece, set where the piece begins outside of sections if the part
    began in that state; and the parts that ended before or in the batch, with the state at their end for each state."""
    part, states = None, list(STATES)
    for batch in batches:
        marked = np.flatnonzero(pc.match_substring_regex(batch.column("value"), MARK).to_numpy(zero_copy_only=False))
        outside, ended = np.zeros(batch.num_rows, np.int32), []
        for first, last in _runs(batch):
            key = (batch.column("_file")[first].as_py(), batch.column("_block")[first].as_py())
            if key != part:
                if part is not None:
                    ended.append((*part, states))
                part, states = key, list(STATES)
            done = first
            for row in (int(i) for i in marked[np.searchsorted(marked, first):np.searchsorted(marked, last)]):
                outside[done:row + 1] = sum(1 << began for began in STATES if states[began] == 0)
                text = batch.column("value")[row].as_py()
                after = {state: state_after(text, state) for state in set(states)}
                states, done = [after[state] for state in states], row + 1
            outside[done:last] = sum(1 << began for began in STATES if states[began] == 0)
        yield batch, outside, ended
    if part is not None:
        yield None, None, [(*part, states)]


def _piece_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, outside, _ in _walk(batches):
        if batch is not None:
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in ("value", "_file", "_block")] + [pa.array(outside)],
                ["value", "_file", "_block", "outside"],
            )


def _end_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, _, ended in _walk(batches):
        if ended:
            files, blocks, ends = (list(column) for column in zip(*ended))
            yield pa.RecordBatch.from_arrays(
                [pa.array(files, pa.string()), pa.array(blocks, pa.int64()), pa.array(ends, pa.list_(pa.int32()))],
                ["_file", "_block", "ends"],
            )


def part_ends(pieces: DataFrame) -> DataFrame:
    """Per part of a file: the state at its end, for each state at its start."""
    return pieces.mapInArrow(_end_batches, ENDS)


def part_starts(ends: DataFrame) -> DataFrame:
    """Per part of a file: the state at its start. Parts are grouped by file: few beside the text."""
    parts = ends.groupBy("_file").agg(F.array_sort(F.collect_list(F.struct("_block", "ends"))).alias("parts"))
    start = F.struct(
        F.lit(0).alias("state"), F.array().cast("array<struct<_block:bigint,state:int>>").alias("starts")
    )
    along = F.aggregate(
        "parts", start,
        lambda found, part: F.struct(
            F.get(part["ends"], found["state"]).alias("state"),
            F.array_append(found["starts"], F.struct(part["_block"].alias("_block"), found["state"].alias("state"))).alias("starts"),
        ),
    )
    return parts.select("_file", F.inline(along["starts"]))


def outside(pieces: DataFrame, starts: DataFrame) -> DataFrame:
    """The pieces that begin outside of sections. ``starts`` must be of the same parts: if the files were cut
    otherwise in between, that is an error."""
    told = pieces.mapInArrow(_piece_batches, PIECES).where("outside <> 0")
    other = F.raise_error(F.lit("the files were cut into other parts than before")).cast("int")
    rows = told.join(starts, ["_file", "_block"], "left")
    began = F.coalesce("state", F.when(F.col("state").isNull(), other))
    return rows.where(F.getbit("outside", began) == 1).select("value", "_file")
