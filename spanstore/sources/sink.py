"""A sink for content-addressed bytes with commit and abort.

``df.write.format("blobs").option("path", folder).mode("append").save()`` writes rows with a ``shard`` column
as Parquet files below ``folder/shard=xx``.  Tasks write to a hidden folder of this write; only when all
have ended does the driver move their files to their names, so a reader of the folder never
sees a part of a task, nor what a killed or repeated attempt left behind.  A failed
write removes the hidden folder.

Rows should come sorted by shard within their partition: each run of equal shards is a file.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage


@dataclass
class Written(WriterCommitMessage):
    """Files of a task: hidden name and shard."""

    files: list[tuple[str, str]]


class BlobWriter(DataSourceArrowWriter):
    def __init__(self, folder: str):
        self.folder = folder
        self.hidden = os.path.join(folder, f"_writing-{uuid.uuid4().hex}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files: list[tuple[str, str]] = []
        out, current = None, None
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                shards = np.asarray(batch["shard"].to_pylist(), object)
                cuts = np.flatnonzero(np.concatenate([[True], shards[1:] != shards[:-1]]))
                rows = batch.drop_columns(["shard"])
                for start, end in zip(cuts.tolist(), [*cuts[1:].tolist(), batch.num_rows]):
                    if out is None or shards[start] != current:
                        if out is not None:
                            out.close()
                        current, name = shards[start], f"{uuid.uuid4().hex}.parquet"
                        os.makedirs(self.hidden, exist_ok=True)
                        out = pq.ParquetWriter(os.path.join(self.hidden, name), rows.schema, compression="zstd")
                        files.append((name, current))
                    out.write_batch(rows.slice(start, end - start))
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        os.makedirs(self.folder, exist_ok=True)
        for name, shard in (f for m in messages if m for f in m.files):
            place = os.path.join(self.folder, f"shard={shard}")
            os.makedirs(place, exist_ok=True)
            os.replace(os.path.join(self.hidden, name), os.path.join(place, name))
        shutil.rmtree(self.hidden, ignore_errors=True)

    def abort(self, messages: list[Written | None]) -> None:
        shutil.rmtree(self.hidden, ignore_errors=True)


class BlobSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "blobs"

    def writer(self, schema, overwrite: bool) -> BlobWriter:
        if overwrite:
            raise ValueError("stored bytes are never overwritten: use mode append")
        return BlobWriter(self.options["path"])
