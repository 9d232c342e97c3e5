"""Custom row sink with open / process / close, for `writeStream.foreach`."""

from __future__ import annotations

import json
from collections.abc import Sequence


class JsonLineWriter:
    """Writes each task's rows of an epoch to one JSON-lines file in a shared folder.

    The name is fixed by (epoch, partition): a retried task replaces its own file,
    and a failed one leaves none.
    """

    def __init__(self, folder: str, fields: Sequence[str]) -> None:
        self.folder, self.fields = folder, list(fields)

    def _target(self):
        from pyarrow import fs

        if "://" in self.folder or self.folder.startswith("file:"):
            return fs.FileSystem.from_uri(self.folder)
        return fs.LocalFileSystem(), self.folder

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.system, root = self._target()
        self.system.create_dir(root, recursive=True)
        self.final = f"{root}/{epoch_id}-{partition_id}.json"
        self.staged = f"{root}/_{epoch_id}-{partition_id}.json"
        self.stream = self.system.open_output_stream(self.staged)
        return True

    def process(self, row) -> None:
        record = {name: row[name] for name in self.fields}
        self.stream.write((json.dumps(record, default=str) + "\n").encode("utf-8"))

    def close(self, error: Exception | None) -> None:
        self.stream.close()
        if error is None:
            self.system.move(self.staged, self.final)
