"""Files of any format, put together from parts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from wavelane.session import shared_dir


def write_files(parts: DataFrame, folder: str) -> DataFrame:
    """Write each ``name``'s ``data`` in order of ``position`` into a file of that name below ``folder``, and
    return the stored list: name, bytes.

    Parts stream through; no file is held in memory. A file gets its name when it is complete, so a task that
    is run again, or twice, leaves one whole file. A file is written by one task: parts of a file that is too
    long for that belong under several names.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as pafs

        files, root = pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder.removeprefix("file:"))
        files.create_dir(root, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        name, out, written = None, None, []

        def close() -> None:
            if out is not None:
                size = out.tell()
                out.close()
                files.move(f"{root}/_{attempt}-{name}", f"{root}/{name}")
                written.append((name, size))

        for batch in batches:
            for part_of, data in zip(batch.column("name").to_pylist(), batch.column("data")):
                if part_of != name:
                    close()
                    name = part_of
                    out = files.open_output_stream(f"{root}/_{attempt}-{name}", compression=None)
                if data.is_valid:
                    out.write(data.as_buffer())
        close()
        yield pa.RecordBatch.from_arrays([pa.array([w[0] for w in written], pa.string()), pa.array([w[1] for w in written], pa.int64())], names=["name", "bytes"])

    dealt = parts.select("name", "position", "data").repartition("name").sortWithinPartitions("name", "position")
    listed = shared_dir(parts.sparkSession, "files")
    dealt.mapInArrow(write, "name string, bytes long").write.parquet(listed)
    return parts.sparkSession.read.parquet(listed)
