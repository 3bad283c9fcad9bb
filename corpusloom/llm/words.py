"""Text clean-up and exact sums of arrays over partitions, shared by the operators of this subpackage."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: characters that show nothing.
_INVISIBLE = re.compile("[­​-‏⁠﻿]")

#: Rows of an array that travel together.
SLOT_ROWS = 1024


def hash_sample(rows: DataFrame, id_col: str, most: int, ids: DataFrame | None = None) -> DataFrame:
    """The ``most`` rows with the least hash of their id, for fitting a model; about all that leave the executors is the sample itself.

    ``ids`` is counted in the rows' place if given, where counting the rows would read more than ids.
    """
    total = (rows if ids is None else ids).count()
    share = min(1.0, 2.0 * most / max(total, 1))
    place = F.pmod(F.xxhash64(F.lit(97), F.col(id_col)), F.lit(1 << 40))
    return rows.where(place < F.lit(int(share * (1 << 40)))).orderBy(place, id_col).limit(most)


def clean(text: str) -> str:
    """Character references resolved and invisible characters dropped."""
    if "&" in text:
        text = html.unescape(text)
    return text if text.isascii() else _INVISIBLE.sub("", text)


def pieces(texts: list, most: int = 1_000_000) -> Iterator[list]:
    """Runs of ``texts`` of about ``most`` characters, so that working memory stays bounded."""
    at, n = 0, 0
    for i, t in enumerate(texts):
        n += len(t) if t else 0
        if n >= most:
            yield texts[at : i + 1]
            at, n = i + 1, 0
    if at < len(texts):
        yield texts[at:]


def slots(total: np.ndarray) -> pa.RecordBatch:
    """The non-zero slots of an array of rows, to be added up by :func:`add_up`."""
    n = range(0, len(total), SLOT_ROWS)
    keep = [i for i in n if total[i : i + SLOT_ROWS].any()]
    return pa.RecordBatch.from_arrays(
        [pa.array([i // SLOT_ROWS for i in keep], pa.int32()), pa.array([total[i : i + SLOT_ROWS].tobytes() for i in keep], pa.binary())], names=["slot", "data"]
    )


SLOT_DDL = "slot int, data binary"


def add_up(parts: DataFrame, shape: tuple[int, int], dtype, op=np.add) -> np.ndarray:
    """Sum (or combine by ``op``) the slots that all partitions gave.  Each slot is added up by one task as a stream; only one array of ``shape`` reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for slot, data in zip(b.column("slot").to_pylist(), b.column("data").to_pylist()):
                a = np.frombuffer(data, dtype)
                if slot in sums:
                    op(sums[slot], a, out=sums[slot])
                else:
                    sums[slot] = a.copy()
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array([a.tobytes() for a in sums.values()], pa.binary())], names=["slot", "data"])

    out = np.zeros(shape, dtype)
    for row in parts.repartition("slot").mapInArrow(run, SLOT_DDL).toLocalIterator():
        a = np.frombuffer(row.data, dtype).reshape(-1, shape[1])
        out[row.slot * SLOT_ROWS : row.slot * SLOT_ROWS + len(a)] = a
    return out
