"""The folder every executor can reach."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

HOME = "entityloom"
# Where an application's tables lie below a shared folder.
HOMES: dict[tuple[str, str], str] = {}
# Folders that the executors of an application were seen to share.
SHARED: set[tuple[str, str]] = set()
# What a writer of an application is told below such a folder.
OPTIONS: dict[tuple[str, str], dict[str, str]] = {}
UMASK = "fs.permissions.umask-mode"
TRYING = threading.Lock()


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a local session (tests) may do without; it gets a temporary folder as
    its checkpoint folder.  On a cluster a folder of the local file system, named so or by
    default, is refused unless ``spark.entityloom.sharedFiles`` says that all machines mount
    the same one, or a trial table shows it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder:
        mounted = spark.conf.get("spark.entityloom.sharedFiles", "false") == "true"
        on_disk = not context.master.startswith("local") and _scheme(context, folder) == "file"
        if on_disk and not mounted:
            _check_shared(spark, folder.rstrip("/"))
        return folder.rstrip("/")
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="entityloom-"))
    return context.getCheckpointDir()


def _check_shared(spark: SparkSession, folder: str) -> None:
    """Refuse a folder that driver and executors do not have in common."""
    refusal = f"executors on other machines may not see {folder}"
    try:
        shared = _tried(spark, folder)
    except Exception as error:  # the trial table could not be written or read
        raise RuntimeError(refusal) from error
    if not shared:
        raise RuntimeError(refusal)


def _tried(spark: SparkSession, folder: str) -> bool:
    """Whether what all cores write into ``folder`` is found again, asked once per application.

    A file on a machine's own disk is missed by the driver, which publishes what tasks wrote, or by
    the task that reads it.  Executors that come later are not asked.  The table is as open as
    ``folder``; who owns its files tells whether those after it have to be.
    """
    context = spark.sparkContext
    asked = context.applicationId, folder
    with TRYING:
        if asked not in SHARED:
            cores = context.defaultParallelism
            path = f"{_home(context, folder)}/trial-{uuid.uuid4().hex}"
            options = _as_open_as(context, folder)
            spark.range(0, cores, 1, cores).write.options(**options).parquet(path)
            found = spark.read.schema("id bigint").parquet(path).count()
            files, trial = _located(context, path)
            others = _by_others(files, trial)
            files.delete(trial, True)
            if found != cores:
                return False
            OPTIONS[asked] = options if others else {}
            SHARED.add(asked)
    return True


def _by_others(files, table) -> bool:
    """Whether tasks wrote a table as another user than the driver, which made its folder."""
    own = files.getFileStatus(table).getOwner()
    return any(file.getOwner() != own for file in files.listStatus(table))


def _as_open_as(context, folder: str) -> dict[str, str]:
    """Options under which a write makes folders that are as open to other users as ``folder``."""
    files, located = _located(context, folder)
    if not files.exists(located):
        return {}
    usual = context._jvm.org.apache.hadoop.fs.permission.FsPermission.getUMask(files.getConf())
    umask = usual.toShort() & ~files.getFileStatus(located).getPermission().toShort()
    if umask == usual.toShort():
        return {}
    # A file system that is at hand already would keep to the usual one.
    return {UMASK: f"{umask:03o}", "fs.file.impl.disable.cache": "true"}


def write_options(spark: SparkSession, path: str) -> dict[str, str]:
    """Options for a Spark writer of ``path``.

    What the driver makes, the tasks cannot write to where executors run as other users.  So
    below a shared folder on a cluster's local file system folders are then made as open as
    that one; anywhere else, and where all run as one user, there are no options.
    """
    context, folder = spark.sparkContext, spark.conf.get("spark.checkpoint.dir", None)
    if not folder or re.match(r"local(\[|$)", context.master):
        return {}
    folder = folder.rstrip("/")
    if not path.startswith(f"{folder}/") or _scheme(context, folder) != "file":
        return {}
    asked = context.applicationId, folder
    if asked not in OPTIONS:
        try:
            _tried(spark, folder)
        except Exception:  # the write that follows says what is wrong
            pass
    return OPTIONS.setdefault(asked, {})


def _home(context, folder: str) -> str:
    """The folder for tables below ``folder``, one that this user can make folders in.

    ``entityloom``, or on the local file system ``entityloom-<user>`` where another user's run
    made the first.  Asked once per application.
    """
    if _scheme(context, folder) != "file":
        return f"{folder}/{HOME}"
    asked = context.applicationId, folder
    if asked not in HOMES:
        group = context._jvm.org.apache.hadoop.security.UserGroupInformation
        homes = [f"{folder}/{HOME}", f"{folder}/{HOME}-{group.getCurrentUser().getShortUserName()}"]
        HOMES[asked] = next((home for home in homes if _takes_folders(context, home)), homes[0])
    return HOMES[asked]


def _takes_folders(context, home: str) -> bool:
    files, trial = _located(context, f"{home}/trial-{uuid.uuid4().hex}")
    try:
        return files.mkdirs(trial) and files.delete(trial, True)
    except Py4JJavaError:
        return False


def _located(context, path: str, options: dict[str, str] | None = None):
    """The file system of a path, and the path as that knows it."""
    located = context._jvm.org.apache.hadoop.fs.Path(path)
    settings = context._jsc.hadoopConfiguration()
    if options:
        settings = context._jvm.org.apache.hadoop.conf.Configuration(settings)
        for name, value in options.items():
            settings.set(name, value)
    return located.getFileSystem(settings), located


def _scheme(context, folder: str) -> str:
    """The kind of file system a folder is on; a path without one is on the session's default."""
    named = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", folder)
    default = named[0] if named else context._jsc.hadoopConfiguration().get("fs.defaultFS")
    return default.partition(":")[0].lower()


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has written to yet."""
    home = _home(spark.sparkContext, shared_folder(spark))
    return f"{home}/{name}-{uuid.uuid4().hex}"


def new_folder(spark: SparkSession, name: str) -> str:
    """An empty folder under the shared one, for clients on the executors to write to."""
    path = new_path(spark, name)
    files, folder = _located(spark.sparkContext, path, write_options(spark, path))
    files.mkdirs(folder)
    return path
