"""Token ids in Arrow files of equal-length sequences.

A file holds record batches of ``SEQUENCES`` rows with two fixed-size lists: ``tokens``
(the smallest unsigned type that holds the vocabulary) and ``mask`` (true for real ids;
only the last sequence of a file is filled up). Documents lie end to end in ascending
order of ``doc_id``, each closed by an end id. Every full batch has the same number of
rows, so sequence ``s`` is row ``s % SEQUENCES`` of batch ``s // SEQUENCES`` and is read
from a mapped file without a copy.

Null texts count as empty: they hold the end id alone. Rows with one ``doc_id`` keep a
place each, ordered by a hash of their text; a null ``doc_id`` comes first.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lendframe.llm.arrow import chunks, column, open_folder, ragged, utf8
from lendframe.session import shared_folder

LENGTH = 2048
SEQUENCES = 256
#: Distinct words a task keeps encoded; beyond it the store starts anew.
KEPT_WORDS = 800_000
#: Text encoded at once: words that recur in it are looked up once.
ENCODED_BYTES = 1 << 22


class WordEncoder:
    """The tokenizer, asked once for each distinct word between ASCII white space.

    Its pattern drops white space and its normaliser joins no characters across it, so
    a text's ids are those of its words in a row.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype(np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)
        #: Ids that end a run of the tokenizer's pattern.
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.closes[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.ids, self.starts, self.counts = np.zeros(0, self.dtype), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def keep(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        first = len(self.counts)
        self.known.update(zip(words, range(first, first + len(words)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.counts, self.ids = np.concatenate([self.counts, counts]), np.concatenate([self.ids, ids])

    def ask(self, words: list[str]) -> None:
        """Have the tokenizer encode words.

        A word of letters is one run of its pattern, and the id that ends a run is marked
        as such in the vocabulary; so many such words go as one text.
        """
        plain = [w for w in words if w.isalpha()]
        for at in range(0, len(plain), 2000):
            some = plain[at : at + 2000]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, self.dtype)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):
                self.keep(some, ids, np.diff(np.r_[0, ends]))
        rest = [w for w in words if w not in self.known]
        if rest:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
            counts = np.fromiter(map(len, found), np.int64, len(found))
            self.keep(rest, np.fromiter(chain.from_iterable(found), self.dtype, int(counts.sum())), counts)

    def learn(self, words: list[str]) -> None:
        """Encode new words.

        The pattern parts letters and digits from marks, so a word's ids are those of its
        stem and of the plain marks at its end.
        """
        stems, tails, plain = [], [], []
        for word in words:
            stem = word.rstrip(MARKS)
            if len(stem) < len(word) and stem and stem[-1].isalnum() and "<|" not in word:
                stems.append(stem)
                tails.append(word[len(stem) :])
            else:
                plain.append(word)
        new = {w for part in (plain, stems, tails) for w in part}
        self.ask([w for w in new if w not in self.known])
        if stems:
            parts = np.empty(2 * len(stems), np.int64)
            parts[::2] = list(map(self.known.__getitem__, stems))
            parts[1::2] = list(map(self.known.__getitem__, tails))
            counts = self.counts[parts]
            self.keep([s + t for s, t in zip(stems, tails, strict=True)], self.ids[ragged(self.starts[parts], counts)], counts[::2] + counts[1::2])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and their number per text."""
        cut = pc.ascii_split_whitespace(lowered(texts))
        coded = cut.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(self.known) > KEPT_WORDS:
            self.forget()
        new = [w for w in words if w not in self.known]
        if new:
            self.learn(new)
        place = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        flat = place[coded.indices.to_numpy()]
        counts = self.counts[flat]
        ends = np.cumsum(np.r_[0, pc.list_value_length(cut).to_numpy()])
        sums = np.r_[0, np.cumsum(counts)]
        return self.ids[ragged(self.starts[flat], counts)], np.diff(sums[ends])


def lowered(texts: pa.Array) -> pa.Array:
    """A to Z in lower case, but in texts that may hold special tokens; null as empty.

    The tokenizer lower-cases all else itself; doing it before leaves fewer distinct words.
    """
    data, offsets = utf8(texts)
    small = SMALL_LETTERS[data]
    kept = pc.fill_null(pc.match_substring(texts, "<|"), False).to_numpy(zero_copy_only=False)
    for row in np.flatnonzero(kept).tolist():
        small[offsets[row] : offsets[row + 1]] = data[offsets[row] : offsets[row + 1]]
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(small))


SMALL_LETTERS = np.arange(256, dtype=np.uint8)
SMALL_LETTERS[65:91] += 32
#: Marks that form a token run of their own after a letter or digit.
MARKS = ".,!?;:#$%&*"


@lru_cache(maxsize=2)
def load(path: str) -> WordEncoder:
    return WordEncoder(path)


class SequenceWriter:
    """Packs ids into sequences and writes whole batches as they fill."""

    def __init__(self, folder: str, name: str, dtype: np.dtype, length: int):
        files, root = open_folder(folder)
        self.length, self.total = length, 0
        self.schema = sequence_schema(dtype, length)
        self.sink = files.open_output_stream(f"{root}/{name}")
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.held: list[np.ndarray] = []
        self.waiting = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.waiting += len(ids)
        self.total += len(ids)
        size = self.length * SEQUENCES
        if self.waiting >= size:
            joined = np.concatenate(self.held)
            whole = len(joined) // size * size
            for at in range(0, whole, size):
                self._write(joined[at : at + size], size)
            self.held, self.waiting = [joined[whole:].copy()], len(joined) - whole

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = np.zeros(len(ids), bool)
        mask[:real] = True
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((ids, mask), self.schema, strict=True)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        if self.waiting:
            joined = np.concatenate(self.held)
            filled = np.zeros(-(-len(joined) // self.length) * self.length, joined.dtype)
            filled[: len(joined)] = joined
            self._write(filled, len(joined))
        self.writer.close()
        self.sink.close()


def sequence_schema(dtype: np.dtype, length: int) -> pa.Schema:
    return pa.schema([("tokens", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])


class SequenceFile:
    """Random access to a written file; local files are mapped, not read."""

    def __init__(self, folder: str, name: str):
        files, root = open_folder(folder)
        path = f"{root}/{name}"
        source = pa.memory_map(path) if files.type_name == "local" else files.open_input_file(path)
        self.file = pa.ipc.open_file(source)
        self.length = self.file.schema.field("tokens").type.list_size

    def sequence(self, number: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of one sequence."""
        batch = self.file.get_batch(number // SEQUENCES)
        row = number % SEQUENCES
        return batch.column(0)[row].values.to_numpy(), batch.column(1)[row].values

    def span(self, start: int, count: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, as views of the batches that hold them."""
        size = self.length * SEQUENCES
        while count > 0:
            batch = self.file.get_batch(start // size)
            part = batch.column(0).flatten().to_numpy()[start % size :][:count]
            yield part
            start, count = start + len(part), count - len(part)


def write_sequences(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, length: int = LENGTH) -> DataFrame:
    """Write all documents in order; one index row per document, itself stored in the folder.

    Index: ``doc_id, file, part, first`` (place of its first id in the file)`, n_tokens`.
    A file that a lost task left is named by no index row.
    """
    spark = docs.sparkSession
    files, root = open_folder(folder)
    files.create_dir(f"{root}/sequences", recursive=True)
    kind = docs.schema["doc_id"].dataType.simpleString()
    tie = F.xxhash64("text")
    ordered = docs.select("doc_id", "text", tie.alias("__tie")).repartitionByRange("doc_id", "__tie").sortWithinPartitions("doc_id", "__tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, part = load(tokenizer_path), None, TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.arrow"
        for batch in batches:
            doc, text = column(batch, "doc_id"), column(batch, "text")
            for a, b in chunks(text, ENCODED_BYTES):
                if writer is None:
                    writer = SequenceWriter(f"{folder}/sequences", name, encoder.dtype, length)
                ids, counts = encoder.encode(text[a:b])
                ends = np.cumsum(counts)
                closed = np.insert(ids, ends, end_id)
                first = writer.total + np.r_[0, ends[:-1] + np.arange(1, b - a)] if b > a else ends
                writer.add(closed)
                columns = [doc[a:b], pa.array([name] * (b - a)), pa.array(np.full(b - a, part, np.int32)), pa.array(first, pa.int64()), pa.array(counts + 1, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "file", "part", "first", "n_tokens"])
        if writer is not None:
            writer.close()

    schema = f"doc_id {kind}, file string, part int, first long, n_tokens long"
    ordered.select("doc_id", "text").mapInArrow(run, schema).write.parquet(f"{folder}/index")
    return spark.read.schema(schema).parquet(f"{folder}/index")


def read_digests(index: DataFrame, folder: str) -> DataFrame:
    """Read every document's ids back from the files: ``doc_id, start, n_tokens, ids_crc32``.

    Where each file starts in the whole is a running sum over files: one small number per
    file goes through the driver. Documents are read in order, a run of them per task.
    """
    spark = index.sparkSession
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    ends = np.cumsum([0, *(r["n"] for r in totals)]).tolist()
    offsets = spark.createDataFrame([(r["part"], at) for r, at in zip(totals, ends, strict=False)], "part int, offset long")
    placed = index.join(F.broadcast(offsets), "part").withColumn("start", F.col("offset") + F.col("first"))
    kind = index.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[str, SequenceFile] | None = None
        for batch in batches:
            sums = []
            for name, first, count in zip(*(column(batch, c).to_pylist() for c in ("file", "first", "n_tokens")), strict=True):
                if opened is None or opened[0] != name:
                    opened = (name, SequenceFile(f"{folder}/sequences", name))
                crc = 0
                for ids in opened[1].span(first, count):
                    crc = zlib.crc32(ids.astype("<u4"), crc)
                sums.append(crc)
            columns = [*(column(batch, c) for c in ("doc_id", "start", "n_tokens")), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    run_of = placed.select("doc_id", "file", "first", "start", "n_tokens").repartitionByRange("start").sortWithinPartitions("start")
    return run_of.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def fresh_folder(docs: DataFrame) -> str:
    return f"{shared_folder(docs.sparkSession)}/{uuid.uuid4().hex}"


def store_and_verify(docs: DataFrame, tokenizer_path: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    folder = folder or fresh_folder(docs)
    return read_digests(write_sequences(docs, folder, tokenizer_path, end_id), folder)
