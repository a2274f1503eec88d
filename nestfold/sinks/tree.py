"""A tree of files written by tasks: one row, one file under its own path."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from posixpath import dirname

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "filetree"
RENAMES = 32


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def checked(path: str) -> str:
    """``path`` if it names a place below a root, else an error."""
    parts = path.split("/")
    if not path or path.startswith("/") or any(p in ("", ".", "..") for p in parts):
        raise ValueError(f"not a path below the root: {path!r}")
    return path


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: its folder and how many files."""

    folder: str
    files: int


class TreeWriter(DataSourceArrowWriter):
    """Each task attempt writes into a folder of its own below a staging folder
    beside the root. The commit moves the files of the attempts that count,
    and of no others, into one tree and then gives that its name in a single
    rename: the root is there as a whole or not at all."""

    def __init__(self, root: str, overwrite: bool):
        self.root, self.overwrite = root.rstrip("/"), overwrite
        self.staging = f"{self.root}.staging-{uuid.uuid4().hex[:12]}"
        store, base = _store(self.staging)
        store.create_dir(f"{base}/tasks")

    def write(self, iterator) -> Written:
        store, base = _store(self.staging)
        folder, made, n = f"{base}/tasks/{uuid.uuid4().hex}", set(), 0

        def make(name: str) -> None:
            # never with its parents: a task that goes on after the job was
            # aborted must not bring the staging folder back
            if name not in made:
                if name != folder:
                    make(dirname(name))
                store.create_dir(name, recursive=False)
                made.add(name)

        make(folder)
        for batch in iterator:
            for path, content in zip(batch.column("path"), batch.column("content")):
                name = f"{folder}/{checked(path.as_py())}"
                make(dirname(name))
                if store.get_file_info(name).type.name != "NotFound":
                    raise ValueError(f"two rows name the file {path.as_py()!r}")
                with store.open_output_stream(name, compression=None) as out:
                    out.write(content.as_buffer() if content.is_valid else b"")
                n += 1
        return Written(folder, n)

    def commit(self, messages) -> None:
        from pyarrow import fs

        store, base = _store(self.staging)
        _, root = _store(self.root)
        tree, made, names = f"{base}/tree", set(), set()
        store.create_dir(tree)
        try:
            with ThreadPoolExecutor(RENAMES) as pool:
                for m in messages:
                    if m is None:
                        continue
                    files = [i.path for i in store.get_file_info(fs.FileSelector(m.folder, recursive=True)) if i.is_file]
                    if len(files) != m.files:
                        raise RuntimeError(f"{m.folder} has {len(files)} files, not {m.files}")
                    moves = [(f, f"{tree}/{f[len(m.folder) + 1 :]}") for f in files]
                    for folder in {dirname(to) for _, to in moves} - made:
                        store.create_dir(folder)
                        made.add(folder)

                    for _, to in moves:
                        if to in names:
                            raise ValueError(f"two rows name the file {to[len(tree) + 1 :]!r}")
                        names.add(to)
                    list(pool.map(lambda pair: store.move(*pair), moves))
            there = store.get_file_info(root).type.name != "NotFound"
            if there and not self.overwrite:
                raise FileExistsError(f"{self.root} is there already")
            if there:
                store.move(root, f"{base}/before")
            store.move(tree, root)
        finally:
            self._drop(store, base)

    def abort(self, messages) -> None:
        store, base = _store(self.staging)
        if store.get_file_info(base).type.name != "NotFound":
            self._drop(store, base)

    def _drop(self, store, base: str) -> None:
        """Delete the staging folder under another name, where no task writes."""
        store.move(base, f"{base}.gone")
        store.delete_dir(f"{base}.gone")


class TreeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, content binary"

    def writer(self, schema, overwrite: bool) -> TreeWriter:
        return TreeWriter(self.options["root"], overwrite)


def write_tree(df: DataFrame, root: str, path: str | Column = "path", content: str | Column = "content", mode: str = "append") -> str:
    """Write each row's ``content`` (bytes or text) to its own file ``path``
    below ``root``, folders and all.

    The root must not be there yet unless ``mode`` is ``"overwrite"``. A path
    that leaves the root or that two rows have is an error, and then, as after
    any failed task, nothing of the tree is left. Null content is an empty
    file. Contents pass through tasks one row at a time; the driver lists each
    task's files while it commits."""
    # a name of its own for each write: sessions copied from one another, as the
    # queries' are, neither share nor replace a registered source
    name = f"{FORMAT}_{uuid.uuid4().hex}"
    source = type("NamedTree", (TreeSource,), {"name": classmethod(lambda cls: name)})
    for session in (df.sparkSession, SparkSession.active()):  # names are looked up in the active one
        try:
            session.dataSource.register(source)
        except AnalysisException as e:  # one and the same session
            if e.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":
                raise
    root = f"file://{root}" if root.startswith("/") else root
    c = F.col(content) if isinstance(content, str) else content
    p = F.col(path) if isinstance(path, str) else path
    df.select(p.cast("string").alias("path"), c.cast("binary").alias("content")).write.format(name).option("root", root).mode(mode).save()
    return root
