"""A sink for ready CSV lines: one folder per key, part files with the key's header.

Spark's own CSV writer has one header for all rows of a job.  Here the rows say
which layout (folder prefix and header) they belong to, so files of any number of
layouts are written by one job, without a sort or shuffle by key.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

#: Columns that ``write_lines`` expects.
COLUMNS = ["layout", "key", "part", "line"]


def csv_line(names: Sequence[str]) -> str:
    """Column names as one CSV line, quotes doubled."""
    import csv
    import io

    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow(names)
    return out.getvalue()


def folder_name(key: str) -> str:
    """A key as part of a folder name, escaped as Spark escapes partition values."""
    # The characters that a partition folder cannot hold.
    special = set("\"#%'*/:=?\\\x7f{[]^") | {chr(c) for c in range(1, 32)}
    return "".join(f"%{ord(c):02X}" if c in special else c for c in key)


def local(path: str) -> str | None:
    """The plain path of a ``file:`` URI."""
    return "/" + path[len("file:"):].lstrip("/") if path.startswith("file:") else None


def csv_sink(sink_name: str):
    """The data source behind ``write_lines``.

    Rows of one key and part follow each other.  A part file is named by its part and the
    task's attempt, and has its final name while it is written.  The commit deletes every
    other file of the folders (an earlier version, a lost attempt); a task that fails
    deletes its own files and an abort all files of its run, so a failed job leaves the
    earlier version alone.  A null line stands for a key without rows.
    """
    from dataclasses import dataclass

    from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

    def store(path):
        from pyarrow import fs as pafs

        return (pafs.LocalFileSystem(), path) if path.startswith("/") else pafs.FileSystem.from_uri(path)

    def delete(parts):
        for folder, name in parts:
            system, inner = store(folder)
            system.delete_file(f"{inner}/{name}")

    @dataclass
    class Written(WriterCommitMessage):
        parts: list

    class Writer(DataSourceArrowWriter):
        def __init__(self, options):
            self.base, self.run, self.end = options["base"], options["run"], options["line_end"]
            self.layouts, self.keys = json.loads(options["layouts"]), json.loads(options["keys"])

        def write(self, iterator):
            import numpy as np
            import pyarrow as pa
            import pyarrow.compute as pc
            from pyspark import TaskContext

            attempt, parts, now, out = TaskContext.get().taskAttemptId(), [], None, None
            ends = [pa.scalar(x, pa.large_string()) for x in ("", self.end)]
            try:
                for batch in iterator:
                    if not batch.num_rows:
                        continue
                    columns = [batch.column(i).dictionary_encode() for i in range(3)]
                    codes = np.stack([c.indices.to_numpy() for c in columns])
                    cuts = [0, *(np.flatnonzero(np.diff(codes).any(axis=0)) + 1).tolist(), batch.num_rows]
                    for a, b in zip(cuts, cuts[1:]):
                        layout, key, part = (c.dictionary[int(c.indices[a].as_py())].as_py() for c in columns)
                        if (layout, key, part) != now:
                            if out is not None:
                                out.close()
                            prefix, header = self.layouts[layout]
                            folder = f"{self.base}/{prefix}{folder_name(key)}"
                            system, inner = store(folder)
                            system.create_dir(inner, recursive=True)
                            name = f"part-{part}-{attempt:012d}-{len(parts):06d}-{self.run}.csv"
                            out, now = system.open_output_stream(f"{inner}/{name}"), (layout, key, part)
                            parts.append((folder, name))
                            out.write((header + self.end).encode())
                        line = batch.column(3).slice(a, b - a).drop_null()
                        if len(line):
                            text = pc.binary_join_element_wise(line.cast(pa.large_string()), *ends)
                            at = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset: text.offset + len(text) + 1]
                            out.write(text.buffers()[2].slice(int(at[0]), int(at[-1] - at[0])))
                if out is not None:
                    out.close()
            except BaseException:
                if out is not None:
                    out.close()
                delete(parts)
                raise
            return Written(parts)

        def commit(self, messages):
            from pyarrow import fs as pafs

            held = {}
            for m in messages:
                for folder, name in m.parts if m else ():
                    held.setdefault(folder, set()).add(name)
            for folder, names in held.items():
                system, inner = store(folder)
                for f in system.get_file_info(pafs.FileSelector(inner)):
                    if f.type == pafs.FileType.File and f.base_name not in names:
                        system.delete_file(f.path)

        def abort(self, messages):
            # tasks that ended after the first failure are not among the messages
            from pyarrow import fs as pafs

            if self.keys is None:
                roots = {f"{self.base}/{prefix.rpartition('/')[0]}" for prefix, _ in self.layouts}
            else:
                roots = {f"{self.base}/{self.layouts[i][0]}{folder_name(key)}" for i, key in self.keys}
            for root in roots:
                system, inner = store(root)
                for f in system.get_file_info(pafs.FileSelector(inner, recursive=True, allow_not_found=True)):
                    if f.type == pafs.FileType.File and self.run in f.base_name:
                        system.delete_file(f.path)

    class CsvLines(DataSource):
        @classmethod
        def name(cls):
            return sink_name

        def schema(self):
            return "layout int, key string, part string, line string"

        def writer(self, schema, overwrite):
            return Writer(self.options)

    return CsvLines


def write_lines(lines: DataFrame, base: str, layouts: Sequence[tuple[str, str]], line_end: str = "\n",
                keys: Sequence[tuple[int, str]] | None = None) -> None:
    """Write (layout, key, part, line) below ``base``: the folder of a key is its layout's
    prefix and the key; ``layouts`` are (prefix, header), one entry a layout.  ``keys``, if
    they are few and known, are (layout, key): a failed job is cleaned up there alone."""
    from lapsewise.session import ship_package

    session = lines.sparkSession
    ship_package(session)
    # names are registered in, and looked up through, the session that is active in the JVM's
    # thread: a thread pool's or a stream's may be another one than the frame's
    sessions = session.sparkContext._jvm.org.apache.spark.sql.classic.SparkSession
    active = sessions.getActiveSession()
    sessions.setActiveSession(session._jsparkSession)
    try:
        if getattr(session, "_lapsewise_csv_sink", None) is None:
            session._lapsewise_csv_sink = f"lapsewise_csv_{uuid.uuid4().hex[:12]}"
            session.dataSource.register(csv_sink(session._lapsewise_csv_sink))
        _save(lines, session._lapsewise_csv_sink, base, layouts, line_end, keys)
    finally:
        if active.isDefined():
            sessions.setActiveSession(active.get())
        else:
            sessions.clearActiveSession()


def _save(lines: DataFrame, name: str, base: str, layouts, line_end: str, keys) -> None:
    (
        lines.select(*COLUMNS).write.format(name).mode("append")
        .option("base", local(base) or base.rstrip("/")).option("run", uuid.uuid4().hex)
        .option("line_end", line_end).option("layouts", json.dumps(list(layouts)))
        .option("keys", json.dumps(keys)).save()
    )
