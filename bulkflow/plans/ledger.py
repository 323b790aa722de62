"""Which names use which folder, and what may be deleted.

Folders of tables lie side by side below one root.  A name (a table, a partition of it, a published
name) that shows rows of a folder is written down as its owner: an empty file, whose time says when it
was last taken.  A folder may have several owners, after an exchange or a refresh without copying.

What no name owns is left over: by a truncate, a swap, a load that failed.  :func:`vacuum` deletes it
once it has been untouched for a grace time, so that readers that are under way can finish and writers
that have not published yet are left alone.  A folder with an owner is never deleted.
"""

from __future__ import annotations

import time
from urllib.parse import quote

from pyspark.sql import SparkSession

from bulkflow.session import children, delete_dir, list_dirs, modified, table_root, touch

OWNERS = "_owners"


def _managed(spark: SparkSession, path: str) -> tuple[str, str] | None:
    """(root, folder) of a path below a root of tables, however the path is spelled; None elsewhere."""
    root = table_root(spark)
    plain = root.split(":", 1)[1] if root.startswith("file:") else root
    at = path.find(plain.rstrip("/").lstrip("/") + "/")
    if at < 0:
        return None
    rest = path[at + len(plain.strip("/")) + 1 :].strip("/")
    return (root, rest.split("/", 1)[0]) if rest else None


def own(spark: SparkSession, path: str, name: str) -> None:
    """Write down that ``name`` shows rows of the folder that ``path`` lies in."""
    found = _managed(spark, path)
    if found:
        touch(spark, f"{found[0]}/{OWNERS}/{found[1]}/{quote(name, safe='')}")


def disown(spark: SparkSession, path: str, name: str) -> None:
    found = _managed(spark, path)
    if found:
        delete_dir(spark, f"{found[0]}/{OWNERS}/{found[1]}/{quote(name, safe='')}")


def move(spark: SparkSession, old: str | None, new: str, name: str) -> None:
    """``name`` shows ``new`` from now on.  The new folder is owned before the old one is given up."""
    own(spark, new, name)
    if old and _managed(spark, old) != _managed(spark, new):
        disown(spark, old, name)


def owners(spark: SparkSession, path: str) -> list[str]:
    """The names that own the folder, quoted as in a URL."""
    found = _managed(spark, path)
    return [c.rsplit("/", 1)[1] for c in children(spark, f"{found[0]}/{OWNERS}/{found[1]}")] if found else []


def vacuum(spark: SparkSession, grace_seconds: float = 3600.0) -> list[str]:
    """Delete the folders below the root that have no owner and were not touched lately; gives their names.

    A folder's time is that of its newest direct child, so a write that goes on keeps it.
    """
    root, gone = table_root(spark), []
    limit = (time.time() - grace_seconds) * 1000
    for path in list_dirs(spark, root):
        folder = path.rsplit("/", 1)[1]
        if folder == OWNERS or children(spark, f"{root}/{OWNERS}/{folder}"):
            continue
        if max(modified(spark, p) for p in (path, *children(spark, path))) <= limit:
            delete_dir(spark, path)
            delete_dir(spark, f"{root}/{OWNERS}/{folder}")
            gone.append(folder)
    return gone
