"""Binary files that tasks write to the shared folder; Spark's ``binaryFile`` reader reads them."""

from __future__ import annotations

import uuid

from pyarrow import fs


def write_file(uri: str, content: bytes) -> None:
    """Write under a name of its own, then move into place: a task that runs again, or twice at once,
    leaves one whole file."""
    system, path = fs.FileSystem.from_uri(uri)
    folder = path.rpartition("/")[0]
    system.create_dir(folder, recursive=True)
    part = f"{folder}/_{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        out.write(content)
    system.move(part, path)
