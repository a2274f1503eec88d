"""Adding up one fixed-size numpy vector per task, slice by slice."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from nestfold.llm.files import arrow_schema, trimmed

SLICES = 64
ROW = "slice int, part binary"


def cut(vector: np.ndarray) -> list[bytes]:
    """A task's vector as ``SLICES`` byte strings; none if it is all zero."""
    return [x.tobytes() for x in np.array_split(vector, SLICES)] if vector.any() else []


def added(parts: DataFrame, kind: type, size: int) -> np.ndarray:
    """The sum of all tasks' vectors of ``size`` numbers; of float16 vectors with
    a ``weight``, the weighted mean. Each slice is added up in a stream on one
    task, so memory does not depend on the number of tasks; the driver gets
    ``SLICES`` rows, one vector in all."""
    mean, out_kind = kind == np.float16, np.float64 if kind == np.float16 else kind

    def run(batches):
        total: dict[int, np.ndarray] = {}
        weights: dict[int, float] = {}
        for batch in batches:
            for i, p, *w in zip(*(c.to_pylist() for c in batch.columns)):
                part = np.frombuffer(p, kind)
                if mean:
                    part = part.astype(out_kind) * w[0]
                    weights[i] = weights.get(i, 0.0) + w[0]
                total[i] = total[i] + part if i in total else part
        for i, w in weights.items():
            total[i] = total[i] / w
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], schema=arrow_schema(ROW))

    out = np.array_split(np.zeros(size, out_kind), SLICES)
    columns = ["slice", "part", "weight"] if mean else ["slice", "part"]
    for i, p in parts.select(*columns).repartition(SLICES, "slice").mapInArrow(trimmed(run), ROW).collect():
        out[i] = np.frombuffer(p, out_kind)
    return np.concatenate(out)
