"""A committed sink of lines: one output file for each input file.

``df.write.format("lines_per_file").option("path", folder)`` takes rows (file,
name, line), sorted by file within each task, and writes the lines of each
``file`` to ``folder/name``. Tasks write under ``folder/_temporary/<job>``, which
readers skip; the driver moves the files into place when every task has
succeeded, and an aborted job leaves nothing but what was there before. A task
that is tried again writes to names of its own, so half-written files of a lost
executor are never moved.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from grist.sources.locate import locate


@dataclass
class Written(WriterCommitMessage):
    outputs: list[tuple[str, str, str]]          # (input file, name, temporary file)


class PerFileWriter(DataSourceArrowWriter):
    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")
        self.job = f"{self.folder}/_temporary/{uuid.uuid4().hex}"

    def write(self, batches) -> Written:
        outputs, out, current = [], None, None
        try:
            for batch in batches:
                for file, name, line in zip(*(c.to_pylist() for c in batch.columns)):
                    if file != current or out is None:
                        if out is not None:
                            out.close()
                        current, own = file, f"{self.job}/{uuid.uuid4().hex}"
                        system, path = locate(own)
                        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                        out = system.open_output_stream(path)
                        outputs.append((file, name, own))
                    out.write(line.encode() + b"\n")
        finally:
            if out is not None:
                out.close()
        return Written(outputs)

    def commit(self, messages) -> None:
        outputs = [o for m in messages if m for o in m.outputs]
        if len({name for _, name, _ in outputs}) < len(outputs):
            self.abort(messages)
            raise ValueError("two input files, or two tasks, have outputs of one name")
        for _, name, own in outputs:
            system, path = locate(own)
            system.move(path, locate(f"{self.folder}/{name}")[1])
        self._clear()

    def abort(self, messages) -> None:
        self._clear()

    def _clear(self) -> None:
        system, path = locate(self.job)
        if system.get_file_info(path).type != fs.FileType.NotFound:
            system.delete_dir(path)


class PerFileSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "lines_per_file"

    def schema(self) -> str:
        return "file string, name string, line string"

    def writer(self, schema, overwrite: bool) -> PerFileWriter:
        if not self.options.get("path"):
            raise ValueError("lines_per_file needs a path")
        return PerFileWriter(self.options["path"])
