"""Folders and scratch databases that every executor of the session can reach."""

from __future__ import annotations

import re
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder.

    ``spark.checkpoint.dir`` names it. Where that is unset (a bare test session)
    a folder below the warehouse is used, because the warehouse must be reachable
    from every executor anyway.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_transfer"
    return root.rstrip("/")


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:16]}"


def scratch_path(spark: SparkSession, prefix: str) -> str:
    """A path in the shared folder that nobody has used before."""
    return f"{shared_dir(spark)}/{unique_name(prefix)}"


def scratch_database(spark: SparkSession, prefix: str = "transfer") -> str:
    """Create a database whose tables live in the shared folder; returns its name."""
    name = unique_name(prefix)
    path = f"{shared_dir(spark)}/{name}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


def hadoop_path(spark: SparkSession, path: str):
    """(FileSystem, Path) of ``path`` in the session's Hadoop configuration."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def replace_folder(spark: SparkSession, staged: str, path: str) -> None:
    """Put a finished folder in the place of another one by renaming; the old one is deleted last."""
    fs, new = hadoop_path(spark, staged)
    _, final = hadoop_path(spark, path)
    if not fs.exists(final):
        if not fs.rename(new, final):
            raise OSError(f"could not move {staged} to {path}")
        return
    _, old = hadoop_path(spark, f"{path.rstrip('/')}_{unique_name('old')}")
    if not fs.rename(final, old):
        raise OSError(f"could not set {path} aside")
    if not fs.rename(new, final):
        fs.rename(old, final)
        raise OSError(f"could not move {staged} to {path}")
    fs.delete(old, True)


def write_new_note(spark: SparkSession, path: str, text: str) -> bool:
    """Write a few bytes to a file unless it exists; False if it does. The store decides between several writers."""
    fs, p = hadoop_path(spark, path)
    try:
        out = fs.create(p, False)
    except Py4JJavaError:
        if fs.exists(p):
            return False
        raise
    try:
        out.write(text.encode())
    finally:
        out.close()
    return True


def read_note(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none, or none yet."""
    fs, p = hadoop_path(spark, path)
    try:
        stream = fs.open(p)
    except Py4JJavaError:
        if fs.exists(p):
            raise
        return None
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8") or None
    finally:
        stream.close()


def note_age(spark: SparkSession, path: str) -> float:
    """Seconds since a file was written; 0 if it is gone."""
    fs, p = hadoop_path(spark, path)
    try:
        return time.time() - fs.getFileStatus(p).getModificationTime() / 1000
    except Py4JJavaError:
        return 0.0


def same_path(a: str | None, b: str | None) -> bool:
    """Whether two paths name one place, with or without a scheme."""
    plain = lambda path: "/" + (path or "").partition(":")[2].lstrip("/") if ":" in (path or "") else path
    return plain(a) == plain(b)


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """Put a few bytes into a file that appears whole, replacing an older one.

    The new bytes are a file of their own, ``path`` with a rising number, before the older one is deleted, so a crash at any
    moment leaves one of the two. ``newest_notes`` finds them.
    """
    folder, _, name = path.rpartition("/")
    fs, _ = hadoop_path(spark, folder)
    stem, dot, kind = name.rpartition(".")
    older = _versions(spark, folder).get(name, [])
    number = older[-1][0] + 1 if older else 1
    _, draft = hadoop_path(spark, f"{folder}/_{unique_name(name)}")
    _, final = hadoop_path(spark, f"{folder}/{stem}.v{number:09d}{dot}{kind}")
    out = fs.create(draft, True)
    try:
        out.write(text.encode())
    finally:
        out.close()
    if not fs.rename(draft, final):
        raise OSError(f"could not write {path}")
    for _, old in older:
        fs.delete(hadoop_path(spark, old)[1], False)


_VERSION = re.compile(r"(.*)\.v(\d{9})(\.\w+)")


def _versions(spark: SparkSession, folder: str) -> dict[str, list[tuple[int, str]]]:
    """The files that ``write_note`` left, by name; a plain file of that name counts as the oldest version."""
    fs, p = hadoop_path(spark, folder)
    found: dict[str, list[tuple[int, str]]] = {}
    if fs.exists(p):
        for status in fs.listStatus(p):
            name = status.getPath().getName()
            if not name.startswith(("_", ".")):
                match = _VERSION.fullmatch(name)
                key, number = (match[1] + match[3], int(match[2])) if match else (name, 0)
                found.setdefault(key, []).append((number, status.getPath().toString()))
    return {name: sorted(files) for name, files in found.items()}


def newest_notes(spark: SparkSession, folder: str) -> dict[str, str]:
    """The newest file of each note below ``folder``, by the note's name."""
    return {name: files[-1][1] for name, files in _versions(spark, folder).items()}


def path_usage(spark: SparkSession, path: str) -> tuple[int, int]:
    """(data files, bytes) below ``path``, in one call whatever the number of files."""
    fs, p = hadoop_path(spark, path)
    summary = fs.getContentSummary(p)
    marker = int(path_exists(spark, f"{path}/_SUCCESS"))
    return summary.getFileCount() - marker, summary.getLength()


def configure(spark: SparkSession) -> SparkSession:
    """Session settings that suit wide rows; call it once, or set them yourself.

    The JVM does not compile methods above 8000 bytes of bytecode. With this limit Spark
    generates smaller ones for projections over many columns, such as the text codec's.
    Adaptive execution splits hot keys and merges small partitions.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark
