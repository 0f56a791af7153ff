"""Where datasets live, and in which format."""

from __future__ import annotations

from collections.abc import Mapping

from lakeweir.functions.columns import blank_to_none

# Extensions and the format each one stands for, in order of precedence.
EXTENSIONS = (
    (".csv", "csv"),
    (".txt", "csv"),
    (".parquet", "parquet"),
    (".orc", "orc"),
    (".json", "json"),
)

RAW = "raw"

# Format of a path that shows none: CSV with Spark's defaults, so no header and
# every column a string.
PLAIN = "plain"


def dataset_path(
    zones: Mapping[str, str],
    zone: str,
    container: str,
    folder: str | None = None,
    file: str | None = None,
) -> str:
    """Full path of a dataset; a folder without a file is the whole directory.

    A zone root may place the container itself, as object stores need it
    (``abfss://{container}@account/``); otherwise it is the first directory.
    """
    if zone not in zones:
        raise ValueError(f"unknown zone {zone!r}; known are {sorted(zones)}")
    folder, file = blank_to_none(folder), blank_to_none(file)
    if folder is None and file is None:
        raise ValueError("a dataset needs a folder, a file, or both")
    root = zones[zone]
    if "{container}" in root:
        parts = [root.replace("{container}", container)]
    else:
        parts = [root, container]
    parts += [part for part in (folder, file) if part is not None]
    head = parts[0].rstrip("/")
    return "/".join([head, *[part.strip("/") for part in parts[1:]]])


def choose_format(path: str, fmt: str | None = None) -> str:
    """The named format, or the one the last path segment shows."""
    fmt = blank_to_none(fmt)
    if fmt is not None:
        return "csv" if fmt.lower() in ("csv", "txt") else fmt.lower()
    segment = path.rstrip("/").rsplit("/", 1)[-1].lower()
    for extension, name in EXTENSIONS:
        if segment.endswith(extension) or extension + "." in segment:
            return name
    return PLAIN
