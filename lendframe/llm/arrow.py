"""Arrow batches to numpy: bounded chunks of texts, ragged gathers, files in shared storage."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs

CHUNK_BYTES = 1 << 20


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text; a longer row makes its own range."""
    sizes = lengths(texts).tolist()
    start, held = 0, 0
    for row, size in enumerate(sizes):
        if held and held + size > limit:
            yield start, row
            start, held = row, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def lengths(texts: pa.Array) -> np.ndarray:
    """Bytes of every text; 0 for null."""
    return pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and the offset of each; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions ``start, start+1, ...`` of every run, one run after another."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, counts)


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that all tasks share."""
    if "://" not in uri and ":/" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
