"""Tables whose content is replaced at once, as folders with a pointer.

A replaced table is written to a folder of its own under the table's path. Only
when it is complete is a pointer made: an empty file whose name holds a number
and the folder's name. Readers go by the highest number, so they see the old
content or the new one, and a write that is killed leaves the old one. There is
one writer of a table at a time. A path without pointers is a plain table.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from sitewright.sources import files

POINTERS = "_current"
#: Versions that stay after a new one is made: the new one, and the one that readers may still be at.
KEPT = 2


def _pointers(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Numbers and folders of the pointers, in order."""
    found = (name.partition("=") for name in files.names(spark, f"{path}/{POINTERS}"))
    return sorted((int(number), folder) for number, sign, folder in found if sign and number.isdigit())


def current(spark: SparkSession, path: str) -> str:
    """Where the table's content is."""
    path = path.rstrip("/")
    pointers = _pointers(spark, path)
    return f"{path}/{pointers[-1][1]}" if pointers else path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the table was ever written whole, here or as a plain table."""
    path = path.rstrip("/")
    return bool(_pointers(spark, path)) or any(not name.startswith(("v-", POINTERS)) for name in files.names(spark, path))


def replace(spark: SparkSession, path: str, write: Callable[[str], None], keep: int = KEPT) -> str:
    """Let `write` fill a new folder and make it the table's content; returns the folder.

    Content older than the last `keep` versions is removed afterwards.
    """
    path = path.rstrip("/")
    pointers = _pointers(spark, path)
    number = pointers[-1][0] + 1 if pointers else 1
    folder = f"v-{number:06d}-{uuid.uuid4().hex[:8]}"
    write(f"{path}/{folder}")
    files.touch(spark, f"{path}/{POINTERS}/{number:06d}={folder}")
    _drop_old(spark, path, keep)
    return f"{path}/{folder}"


def _drop_old(spark: SparkSession, path: str, keep: int) -> None:
    """Remove what no pointer to keep leads to: old versions, writes that were killed, and a plain table's files."""
    pointers = _pointers(spark, path)
    stay = {folder for _, folder in pointers[-keep:]}
    if len(pointers) < keep:  # the plain table was the version before
        return
    for number, folder in pointers[:-keep]:
        files.delete(spark, f"{path}/{POINTERS}/{number:06d}={folder}")
    for name in files.names(spark, path):
        if name not in stay and name != POINTERS:
            files.delete(spark, f"{path}/{name}")
