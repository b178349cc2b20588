"""Zip archives listed and expanded by the executors, a stream at a time."""

from __future__ import annotations

import shutil
import uuid
import zipfile
from collections.abc import Iterator
from typing import IO
from urllib.parse import unquote, urlparse

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from ..functions.codes import with_delimiter
from .layers import shared_uri

HEAD_CHARS = 16_000  # fixed value: characters looked at to find the delimiter
MAX_HEADER = 16 << 20
CHUNK = 8 << 20
MEMBERS = "path string, year int, member string, size long, tables int"
STAGED = "path string, year int, member string, source string, staged string, head string"


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a file named with its scheme."""
    parts = urlparse(uri)
    if not parts.scheme:
        raise ValueError(f"name the file system of {uri}")
    if parts.scheme == "file":
        return fs.LocalFileSystem(), unquote(parts.path)
    return fs.FileSystem.from_uri(uri)


def _tables(members: list[str], year: int, by_year: bool) -> list[str]:
    """The members to read: tables at the top, or the text files of the year."""
    if by_year:
        return [m for m in members if "/" not in m and ".txt" in m.lower() and str(year) in m]
    return [m for m in members if "/" not in m and m.endswith((".txt", ".csv"))]


def _head(source: IO[bytes]) -> str:
    """The whole header line and what follows it, HEAD_CHARS or the header if that is longer."""
    header = source.readline(MAX_HEADER)
    if len(header) == MAX_HEADER and not header.endswith(b"\n"):
        raise ValueError("the file has no line break after its header")
    return (header + source.read(max(0, HEAD_CHARS - len(header)))).decode("latin-1")


def _one_task_each(rows: DataFrame) -> DataFrame:
    # a fixed number of tasks: the listing is tiny, the work behind each row is not
    return rows.repartition(max(1, rows.count()))


def list_members(archives: DataFrame, by_year: bool = False) -> DataFrame:
    """One row per table in the archives (path, year), with the number of tables beside it.

    Only the directory at the end of an archive is read. An archive without tables gives no row.
    """

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, year in zip(batch["path"], batch["year"], strict=True):
                files, name = _filesystem(path)
                with files.open_input_file(name) as raw, zipfile.ZipFile(raw) as archive:
                    found = _tables(archive.namelist(), int(year), by_year)
                    sizes = [archive.getinfo(m).file_size for m in found]
                if found:
                    yield pd.DataFrame({"path": path, "year": int(year), "member": found, "size": sizes, "tables": len(found)})

    return _one_task_each(archives.select("path", F.col("year").cast("int"))).mapInPandas(members, MEMBERS)


def expand_members(members: DataFrame, staging: str) -> DataFrame:
    """Unpack the members (path, year, member, source) under ``staging``, a folder per source.

    Each member is its own task and is copied in chunks. It is written under a name of its own
    attempt and then renamed, so a task run twice leaves one whole file. Returns the staged
    path, the text head and its delimiter.
    """
    root = shared_uri(members.sparkSession, staging)

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, year, member, source in zip(*(batch[c] for c in ("path", "year", "member", "source")), strict=True):
                files, name = _filesystem(path)
                target_files, folder = _filesystem(f"{root}/{source}")
                with files.open_input_file(name) as raw, zipfile.ZipFile(raw) as archive:
                    target_files.create_dir(folder, recursive=True)
                    attempt = f"{folder}/.{member}.{uuid.uuid4().hex}"
                    with archive.open(member) as stream, target_files.open_output_stream(attempt) as sink:
                        shutil.copyfileobj(stream, sink, CHUNK)
                    target_files.move(attempt, f"{folder}/{member}")
                    with archive.open(member) as stream:
                        head = _head(stream)
                row = {"path": path, "year": int(year), "member": member, "source": source, "staged": f"{root}/{source}/{member}", "head": head}
                yield pd.DataFrame([row])

    rows = members.select("path", F.col("year").cast("int"), "member", "source")
    return with_delimiter(_one_task_each(rows).mapInPandas(expand, STAGED))
