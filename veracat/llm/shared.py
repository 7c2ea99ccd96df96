"""Files in the shared folder, opened by tasks through the file system that their address names."""

from __future__ import annotations

import re


def open_shared(name: str, mode: str):
    """A binary file for reading (random access) or writing. The folder is made where the store has folders."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", name) if "://" in name or name.startswith("file:") else f"file://{name}")
    if mode == "r":
        return system.open_input_file(path)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)
