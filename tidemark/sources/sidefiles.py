"""Small JSON files that the ranges of a batch leave for its sink, in a local folder or any that pyarrow reaches."""

from __future__ import annotations

import json
from typing import Any

from pyarrow import fs


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def write(folder: str, name: str, value: Any) -> None:
    """A whole file or none: written aside, then moved."""
    store, root = _at(folder)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/.{name}.new") as f:
        f.write(json.dumps(value).encode())
    store.move(f"{root}/.{name}.new", f"{root}/{name}")


def names(folder: str | None) -> list[str]:
    if not folder:
        return []
    store, root = _at(folder)
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(i.base_name for i in found if i.is_file and i.base_name.endswith(".json") and not i.base_name.startswith("."))


def read(folder: str, name: str) -> Any:
    store, root = _at(folder)
    with store.open_input_stream(f"{root}/{name}") as f:
        return json.loads(f.read())


def remove(folder: str, some: list[str]) -> None:
    store, root = _at(folder)
    for name in some:
        if store.get_file_info(f"{root}/{name}").type != fs.FileType.NotFound:
            store.delete_file(f"{root}/{name}")


def listing(folder: str) -> list[str]:
    """All files of a folder, whatever their names; none if it is not there."""
    store, root = _at(folder)
    return sorted(i.base_name for i in store.get_file_info(fs.FileSelector(root, allow_not_found=True)) if i.is_file)


def text(folder: str, name: str) -> str:
    store, root = _at(folder)
    with store.open_input_stream(f"{root}/{name}") as f:
        return f.read().decode()
