"""Files that tasks write and read below a folder all executors share."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyarrow import fs

ARROW = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "float": pa.float32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, ARROW[t]) for n, t in (x.split() for x in ddl.split(", "))])


def batch_of(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    schema = arrow_schema(ddl)
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def trimmed(run):
    """``run``, a task's function over batches, giving free memory back to the
    system at its end: the worker stays while the executor does other work."""

    def out(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return out


class Files:
    """The folder at ``root``, a uri."""

    def __init__(self, root: str):
        self.fs, self.root = fs.FileSystem.from_uri(root)

    def temp(self, name: str):
        """A new file under a name no other attempt uses: path and stream."""
        path = f"{self.root}/temp/{name}-{uuid.uuid4().hex}"
        return path, self.fs.open_output_stream(path, compression=None)

    def rename(self, temp: str, name: str) -> None:
        """Give a file its name, also over one that an earlier run left; if it
        has no temporary file, another attempt has done so."""
        if self.fs.get_file_info(temp).type != fs.FileType.NotFound:
            self.fs.move(temp, f"{self.root}/{name}")
        elif self.fs.get_file_info(f"{self.root}/{name}").type == fs.FileType.NotFound:
            raise FileNotFoundError(temp)

    def open(self, name: str):
        return self.fs.open_input_stream(f"{self.root}/{name}", compression=None)
