"""Files in the shared folder, opened on the driver or on an executor by their address."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import pyarrow.fs as pafs


def opened(address: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path of an address; without a scheme it is a local path."""
    if address.startswith("file:/") and not address.startswith("file://"):
        address = "file://" + address[len("file:") :]
    if "://" not in address:
        return pafs.LocalFileSystem(), address
    return pafs.FileSystem.from_uri(address)


@contextmanager
def new_file(address: str):
    """Write a file under another name and give it its name at the end.

    A task that is repeated writes the same bytes again and replaces the file; one that dies leaves no
    file of that name.
    """
    system, path = opened(address)
    folder = path.rsplit("/", 1)[0]
    system.create_dir(folder, recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    with system.open_output_stream(draft) as out:
        yield out
    system.move(draft, path)
