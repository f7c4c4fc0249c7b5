"""Plain binary files in the shared folder, written and read inside tasks."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark import TaskContext


def create(root: str, suffix: str) -> tuple[str, object]:
    """A new file of this task attempt and its stream.

    The name is unique per attempt: a lost or speculative attempt leaves a file that no manifest
    row names, so readers never see it.
    """
    path = f"{root}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}{suffix}"
    system, inner = fs.FileSystem.from_uri(path)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return path, system.open_output_stream(inner)


class Reader:
    """Byte ranges of files; keeps the last file open."""

    def __init__(self):
        self.path, self.handle = None, None

    def read(self, path: str, offset: int, length: int) -> bytes:
        if path != self.path:
            self.close()
            system, inner = fs.FileSystem.from_uri(path)
            self.path, self.handle = path, system.open_input_file(inner)
        return self.handle.read_at(length, offset)

    def close(self) -> None:
        if self.handle is not None:
            self.handle.close()
        self.path, self.handle = None, None
