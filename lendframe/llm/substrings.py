"""Long passages that occur more than once, found by recompression and removed at every place.

A window is WIDTH consecutive words of one document. Every word is removed that a window
covers whose words also start at another place, in the same document or any other; windows
are judged on the texts as given.

Documents are packed into blocks of bounded size, written once. Two rounds of messages go
between blocks:

1. Every block compresses its words (``recompression``) and sends the names of the symbols
   that anchor its windows. Names met at one place only rule out all windows they anchor.
2. Of the windows left, blocks send the names of all their words, 96 bits. Those met twice
   go back to the blocks that hold them, which drop the words covered.

A block sends a name once, however often it holds it, so a passage in a third of all
documents makes one message a block. Names return only to blocks that sent them; no name,
link or document passes through the driver, and nothing is held that isn't a block.

Words are told apart by 64 bits, windows by 96. Null text has no words. A row is a document,
whether its id repeats or not: rows with the same long text lose all of it. Rows without id
are treated alike. Empty tables give no rows; columns other than ``doc_id`` and ``text`` are
not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from lendframe.llm.arrow import chunks, column, ragged, utf8
from lendframe.llm.recompression import anchors, window_names, windows, word_names
from lendframe.llm.shingles import words
from lendframe.session import cut_lineage

WIDTH = 35
#: Bytes of text in a block, but for longer documents.
BLOCK = 2 << 20
#: Blocks of a task, about.
TOGETHER = 8
#: Tasks at most; of more blocks a task reads more, one after another.
PARTS = 100_000
#: Lists that the messages of a block are collected in.
SLICES = 32
_CODEC = ("zstd", 6)


def pack(docs: DataFrame) -> DataFrame:
    """``block, ids, sizes, texts``: whole documents in blocks, their texts compressed as one."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, size = TaskContext.get().partitionId() << 32, [], 0

        def row() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            texts = table["text"].combine_chunks()
            data, offsets = utf8(texts if isinstance(texts, pa.Array) else pa.concat_arrays(texts.chunks))
            ids = table["doc_id"].combine_chunks()
            ids = ids if isinstance(ids, pa.Array) else pa.concat_arrays(ids.chunks)
            listed = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            texts = pa.Codec(*_CODEC).compress(data.tobytes(), asbytes=True)
            return pa.RecordBatch.from_arrays([pa.array([made], pa.int64()), listed, pa.array([np.diff(offsets).tobytes()], pa.binary()), pa.array([texts], pa.binary())], ["block", "ids", "sizes", "texts"])

        for batch in batches:
            for low, high in chunks(column(batch, "text"), BLOCK // 4):
                held.append(batch.slice(low, high - low))
                size += column(held[-1], "text").nbytes
                if size >= BLOCK:
                    yield row()
                    made, held, size = made + 1, [], 0
        if held:
            yield row()

    return docs.select("doc_id", "text").mapInArrow(run, f"block long, ids array<{kind}>, sizes binary, texts binary")


class Block:
    """The documents of a row of ``pack``, and their words."""

    def __init__(self, batch: pa.RecordBatch, k: int):
        self.number, self.ids = column(batch, "block")[k], column(batch, "ids")[k].values
        sizes = np.frombuffer(column(batch, "sizes")[k].as_py(), np.int64)
        self.offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        self.data = np.frombuffer(pa.decompress(column(batch, "texts")[k].as_buffer(), int(self.offsets[-1]), _CODEC[0]), np.uint8)
        self.starts, self.stops, self.counts = words(self.data, self.offsets)
        self.names = word_names(self.data, self.starts, self.stops)

    def kept(self, removed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the words that stay, joined by one space, and how many bytes each document has."""
        doc = np.repeat(np.arange(len(self.counts)), self.counts)
        stay = np.flatnonzero(~removed)
        # between two words of a document there is a byte of white space to put the blank into
        last = np.ones(len(stay), bool)
        last[:-1] = doc[stay[1:]] != doc[stay[:-1]]
        data, edges = self.data.copy(), np.zeros(len(self.data) + 1, np.int8)
        edges[self.starts[stay]] += 1
        edges[self.stops[stay]] -= 1
        mask = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
        blanks = self.stops[stay[~last]]
        data[blanks], mask[blanks] = 0x20, True
        before = np.concatenate([np.zeros(1, np.int64), np.cumsum(mask)])
        return data[mask], np.diff(before[self.offsets])


def _messages(names: np.ndarray, checks: np.ndarray, block: pa.Scalar) -> pa.RecordBatch:
    """Each name once, twice if the block has it at several places."""
    order = np.lexsort((checks, names))
    names, checks = names[order], checks[order]
    third = np.zeros(len(names), bool)
    third[2:] = (names[2:] == names[:-2]) & (checks[2:] == checks[:-2])
    names, checks = names[~third], checks[~third]
    return pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(checks.view(np.int32)), pa.repeat(block, len(names))], ["name", "check", "block"])


_MESSAGE = "name long, check int, block long"


def _repeated(messages: DataFrame) -> DataFrame:
    """``block, name, check`` of the names met at two places or more."""
    everywhere = F.count(F.lit(1)).over(Window.partitionBy("name", "check"))
    return messages.withColumn("everywhere", everywhere).filter("everywhere > 1").select("block", "name", "check")


def _deliver(dealt: DataFrame, parts: int, messages: DataFrame, read: Callable[[Block, np.ndarray, np.ndarray], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Bring messages to their blocks, as lists, and read both block by block.

    ``dealt`` is hashed to ``parts`` by block, and messages are dealt alike, so the join moves nothing.
    """
    to_blocks = messages.repartition(parts, "block")
    lists = to_blocks.groupBy("block", F.pmod("name", F.lit(SLICES)).alias("slice")).agg(F.collect_list("name").alias("names"), F.collect_list("check").alias("checks"))
    lists = lists.groupBy("block").agg(F.collect_list(F.struct("names", "checks")).alias("lists"))

    def flat(lists: pa.ListArray, k: int) -> Iterator[np.ndarray]:
        if not lists[k].is_valid:
            return (np.zeros(0, x) for x in (np.uint64, np.uint32))
        names, checks = lists[k].values.flatten()
        return (x.flatten().to_numpy(zero_copy_only=False).view(kind) for x, kind in ((names, np.uint64), (checks, np.uint32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from read(Block(batch, k), *flat(column(batch, "lists"), k))

    return dealt.join(lists, "block", "left").mapInArrow(run, schema)


def _known(names: np.ndarray, checks: np.ndarray, wanted: np.ndarray, wanted_checks: np.ndarray) -> np.ndarray:
    """Which names are among the wanted ones. The first bits of a name rule most others out."""
    shift = np.uint64(64 - max(10, (8 * len(wanted)).bit_length()))
    near = np.zeros(1 << (64 - int(shift)), bool)
    near[wanted >> shift] = True
    order = np.lexsort((wanted_checks, wanted))
    wanted, wanted_checks = wanted[order], wanted_checks[order]
    found, open_ = np.zeros(len(names), bool), np.flatnonzero(near[names >> shift])
    at = np.searchsorted(wanted, names[open_])
    while len(open_):
        fits = at < len(wanted)
        fits[fits] = wanted[at[fits]] == names[open_[fits]]
        open_, at = open_[fits], at[fits]
        same = wanted_checks[at] == checks[open_]
        found[open_[same]] = True
        open_, at = open_[~same], at[~same] + 1
    return found


def send_anchors(blocks: DataFrame, width: int = WIDTH) -> DataFrame:
    """First messages: symbols that anchor the windows of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block = Block(batch, k)
                _, _, names, places = anchors(block.names, block.counts, width)
                new = np.ones(len(names), bool)
                new[1:] = (names[1:] != names[:-1]) | (places[1:] != places[:-1])
                yield _messages(names[new], np.zeros(int(new.sum()), np.uint32), block.number)

    return blocks.mapInArrow(run, _MESSAGE)


def send_windows(dealt: DataFrame, parts: int, shared: DataFrame, width: int = WIDTH) -> DataFrame:
    """Second messages: windows whose anchor occurs elsewhere too."""

    def read(block: Block, wanted: np.ndarray, unused: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(wanted):
            return
        window, size, names, _ = anchors(block.names, block.counts, width)
        hit = _known(names, np.zeros(len(names), np.uint32), wanted, unused)
        starts = windows(block.counts, width)[ragged(window[hit], size[hit])]
        yield _messages(*window_names(block.names, starts, width), block.number)

    return _deliver(dealt, parts, shared, read, _MESSAGE)


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: the words that stay, joined by one space."""
    blocks = cut_lineage(pack(docs))
    parts = min(-(-blocks.count() // TOGETHER) or 1, PARTS)
    # both rounds read the blocks dealt out once
    dealt = blocks.repartition(parts, "block")
    shared = _repeated(send_anchors(blocks, width))
    repeated = _repeated(send_windows(dealt, parts, shared, width))
    kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def read(block: Block, wanted: np.ndarray, wanted_checks: np.ndarray) -> Iterator[pa.RecordBatch]:
        removed = np.zeros(len(block.names), bool)
        if len(wanted):
            starts = windows(block.counts, width)
            hit = starts[_known(*window_names(block.names, starts, width), wanted, wanted_checks)]
            edges = np.zeros(len(block.names) + 1, np.int64)
            edges[hit] += 1
            edges[hit + width] -= 1
            removed = np.cumsum(edges)[:-1] > 0
        data, sizes = block.kept(removed)
        offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        before = np.concatenate([np.zeros(1, np.int64), np.cumsum(removed)])
        ends = np.cumsum(block.counts)
        gone = before[ends] - before[ends - block.counts]
        texts = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))
        for low, high in chunks(texts):
            columns = [block.ids[low:high], pa.array(block.counts[low:high], pa.int64()), pa.array(gone[low:high], pa.int64()), texts[low:high].cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept"])

    return _deliver(dealt, parts, repeated, read, f"doc_id {kind}, n_words long, n_removed long, kept string")


def digest_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every document."""
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
h AS (SELECT doc, i, md5_number(array_to_string(w[i : i + 34], ' ')) AS h FROM s JOIN d USING (doc)),
r AS (SELECT doc, i FROM h WHERE h IN (SELECT h FROM h GROUP BY h HAVING count(*) > 1)),
c AS (SELECT DISTINCT doc, unnest(range(i, i + 35)) AS j FROM r),
g AS (SELECT doc, list(j) AS gone, count(*) AS n FROM c GROUP BY doc),
k AS (SELECT doc, list(x ORDER BY j) AS kept FROM (SELECT d.doc, unnest(w) AS x, generate_subscripts(w, 1) AS j FROM d) ANTI JOIN c USING (doc, j) GROUP BY doc)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc) LEFT JOIN k USING (doc)
"""
