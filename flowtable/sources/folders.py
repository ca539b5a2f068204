"""Listing of a real folder, one level of directories at a time.

The directories of a level are rows; tasks list them and return their
children, and the children that are directories (and pass the name filter) are
the next level. So the listing is as parallel as the tree is wide, a name
filter keeps whole subtrees from being read, and nothing but the number of
levels depends on the driver. Each level is written to the shared folder.
"""

from __future__ import annotations

import os
import stat
from functools import lru_cache, reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtable.session import cluster_cores, stored
from flowtable.sources.stores import is_local, open_store

ENTRY = ("path string, name string, parent string, length long, mtime_ms long, owner string, `group` string, "
         "replication int, mode int, is_dir boolean")
_NAMES = ["path", "name", "parent", "length", "mtime_ms", "owner", "group", "replication", "mode", "is_dir"]
_KINDS = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.bool_()]
ROWS = 10_000


@lru_cache(maxsize=4096)
def _user(uid: int) -> str:
    import pwd

    try:
        return pwd.getpwuid(uid).pw_name
    except KeyError:
        return str(uid)


@lru_cache(maxsize=4096)
def _group(gid: int) -> str:
    import grp

    try:
        return grp.getgrgid(gid).gr_name
    except KeyError:
        return str(gid)


def _local_children(folder: str):
    with os.scandir(folder) as entries:
        for e in entries:
            try:
                s = e.stat(follow_symlinks=False)
            except FileNotFoundError:  # gone since the folder was read
                continue
            is_dir = e.is_dir(follow_symlinks=False)
            yield (e.path, e.name, folder, None if is_dir else s.st_size, s.st_mtime_ns // 1_000_000, _user(s.st_uid),
                   _group(s.st_gid), None, stat.S_IMODE(s.st_mode), is_dir)


def _store_children(store: fs.FileSystem, folder: str, uri: str):
    for e in store.get_file_info(fs.FileSelector(folder)):
        is_dir = e.type == fs.FileType.Directory
        mtime = None if e.mtime_ns is None else e.mtime_ns // 1_000_000
        yield (f"{uri.rstrip('/')}/{e.base_name}", e.base_name, uri, None if is_dir else e.size, mtime, None, None, None, None, is_dir)


def _list(batches):
    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], names=_NAMES)

    rows: list[tuple] = []
    for batch in batches:
        for uri in batch.column("path").to_pylist():
            store, folder = open_store(uri)
            try:
                for row in _local_children(folder) if is_local(store) else _store_children(store, folder, uri):
                    rows.append(row)
                    if len(rows) == ROWS:
                        yield table(rows)
                        rows = []
            except (FileNotFoundError, NotADirectoryError):
                continue  # gone since the level above was listed
    if rows:
        yield table(rows)


def list_folder(spark: SparkSession, root: str, recurse: bool = True, descend=None) -> DataFrame:
    """Every file and directory below ``root``, hidden names included: path,
    name, parent, length, mtime_ms, owner, group, replication, mode, is_dir.

    Owner, group and mode are null where the store does not tell them (they
    are known for local and mounted folders), replication always is; a
    directory has no length. ``descend`` is a condition on these columns: a
    directory that fails it is listed itself, but not read. Links are entries,
    never followed. A root that is no folder is an error; directories that
    vanish meanwhile have no entries.
    """
    store, folder = open_store(root)
    info = store.get_file_info(folder)
    if info.type != fs.FileType.Directory:
        raise FileNotFoundError(f"no folder: {root}")
    root = folder if is_local(store) else root.rstrip("/")
    cores = cluster_cores(spark)
    level = spark.createDataFrame([(root,)], "path string")
    levels, width = [], 1
    while width:
        # At most a few directories a task while there are few; else many tasks.
        found = stored(level.repartition(min(width, 8 * cores)).mapInArrow(_list, ENTRY), "folder-level")
        levels.append(found)
        folders = found.where("is_dir")
        level = (folders if descend is None else folders.where(descend)).select("path")
        width = level.count() if recurse else 0
    return reduce(DataFrame.unionByName, levels)
