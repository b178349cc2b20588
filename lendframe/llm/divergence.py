"""How sources differ in their words: each source against its language and against the others.

Terms are maximal runs of letters of any script, A to Z lower-cased. A language keeps the
terms that occur in at least DOCS of its documents. The kept terms are sorted and built into
minimal acyclic transducers of bounded size, whose ordinals number the terms of a language
in byte order. Then all text streams through the transducers: counts, shares and ties work
on ordinals, and only the terms reported are spelled out again, by walking back.

A row of the table is a document, whether its id repeats or not. Null text, language and
source count as empty text. A language without kept terms gives its sources the value 0; a
source alone in its language has no partner. Empty tables give no rows, and extra columns
are not read.

Shares are whole numbers out of 10**9; products that leave 64 bits are taken as decimals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from lendframe.llm.arrow import chunks, column, utf8
from lendframe.llm.transducer import Streamer, Transducer
from lendframe.session import cut_lineage

DOCS = 10
REPORTED = 10
#: Most terms of a transducer.
SEGMENT = 1 << 17
#: Bytes of transducers that tasks hold at once; a larger vocabulary takes several passes over the text.
PASS_BYTES = 64 << 20
CHUNK = 2 << 20
#: Counts that a task holds before it adds up equal ones, and gives them away if that helps little.
HELD = 1 << 20
#: Ordinals and sources of a block in which sources are compared pair by pair.
BLOCK, TILE = 1024, 256

#: What a byte of a term becomes; blank for all others.
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[0x41:0x5B] = _FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)


def _keyed(table: DataFrame) -> DataFrame:
    return table.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")), "text")


def document_counts(docs: DataFrame) -> DataFrame:
    """``lang, term, docs`` (long) of every term, from partial counts of bounded chunks of text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = column(batch, "lang").dictionary_encode()
            owner = langs.indices.to_numpy(zero_copy_only=False)
            for low, high in chunks(column(batch, "text"), CHUNK):
                data, offsets = utf8(column(batch, "text")[low:high])
                folded = pa.LargeStringArray.from_buffers(high - low, pa.py_buffer(offsets), pa.py_buffer(_FOLD[data]))
                split = pc.split_pattern(folded, " ")
                words, doc = split.flatten(), pc.list_parent_indices(split)
                there = pc.greater(pc.binary_length(words), 0)
                coded = words.filter(there).dictionary_encode()
                size = len(coded.dictionary)
                if not size:
                    continue
                # once per document, then once per language
                seen = np.unique(doc.filter(there).to_numpy() * size + coded.indices.to_numpy())
                pairs, docs_ = np.unique(owner[low + seen // size].astype(np.int64) * size + seen % size, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [langs.dictionary.take(pa.array(pairs // size)), coded.dictionary.take(pa.array(pairs % size)).cast(pa.string()), pa.array(docs_, pa.int64())],
                    ["lang", "term", "docs"],
                )

    partial = docs.select("lang", "text").mapInArrow(count, "lang string, term string, docs long")
    return partial.groupBy("lang", "term").agg(F.sum("docs").alias("docs"))


_SEGMENT = "lang string, first string, size long, keys binary, targets binary, skips binary, ends binary"


def build_transducers(kept: DataFrame, most: int = SEGMENT) -> DataFrame:
    """One row per transducer of the kept terms (``lang, term``), numbered, with the ordinal of its first term."""

    def row(lang: str, terms: list[str]) -> pa.RecordBatch:
        made = Transducer.build(t.encode() for t in terms)
        fields = [lang, terms[0], len(terms), *(x.tobytes() for x in made)]
        names = [f.split()[0] for f in _SEGMENT.split(", ")]
        kinds = [pa.string(), pa.string(), pa.int64(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(fields, kinds, strict=True)], names)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, held = None, []
        for batch in batches:
            for own, term in zip(column(batch, "lang").to_pylist(), column(batch, "term").to_pylist(), strict=True):
                if held and (own != lang or len(held) >= most):
                    yield row(lang, held)
                    held = []
                lang = own
                held.append(term)
        if held:
            yield row(lang, held)

    parts = -(-kept.count() // most) or 1
    dealt = kept.select("lang", "term").repartitionByRange(parts, "lang", "term").sortWithinPartitions("lang", "term")
    built = cut_lineage(dealt.mapInArrow(build, _SEGMENT))
    # few rows: one per transducer, without its arcs
    order = Window.orderBy("lang", "first")
    within = Window.partitionBy("lang").orderBy("first")
    size = F.length("keys") + F.length("targets") + F.length("skips") + F.length("ends")
    bounds = built.select("lang", "first", "size", size.alias("bytes")).select(
        "lang",
        "first",
        F.row_number().over(order).alias("number"),
        (F.sum("size").over(within) - F.col("size")).alias("start"),
        F.floor((F.sum("bytes").over(order) - 1) / PASS_BYTES).cast("int").alias("pass"),
    )
    return cut_lineage(built.join(cut_lineage(bounds), ["lang", "first"]))


def _restored(row) -> Transducer:
    kinds = (np.int64, np.int32, np.int32, bool)
    return Transducer(*(np.frombuffer(row[c], k) for c, k in zip(("keys", "targets", "skips", "ends"), kinds, strict=True)))


def recount(docs: DataFrame, transducers: DataFrame) -> DataFrame:
    """``lang, source, number, ordinal, count`` of the kept terms that occur in a source, all text streamed through the transducers."""
    spark = docs.sparkSession
    passes = [r["pass"] for r in transducers.select("pass").distinct().collect()]
    counted = None
    for own in sorted(passes):
        rows = transducers.filter(F.col("pass") == own).orderBy("lang", "first").collect()
        codes: dict[str, int] = {}
        parts = [(codes.setdefault(r["lang"], len(codes)), r["first"].encode(), r["number"], r["start"], _restored(r)) for r in rows]
        shared = spark.sparkContext.broadcast((codes, parts))

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            codes, parts = shared.value
            streamer = Streamer(parts)
            held = _Counts()
            for batch in batches:
                langs, sources = (column(batch, c).to_pylist() for c in ("lang", "source"))
                pair = np.array([held.group(*x) for x in zip(langs, sources, strict=True)], np.int64)
                lang = np.array([codes.get(x, -1) for x in langs], np.int64)
                for low, high in chunks(column(batch, "text"), CHUNK):
                    data, offsets = utf8(column(batch, "text")[low:high])
                    folded = _FOLD[data]
                    starts, stops, docs_ = _bounds(folded, offsets)
                    doc = low + np.repeat(np.arange(high - low), docs_)
                    ordinal, number = streamer.look_up(folded, starts, stops, lang[doc])
                    hit = ordinal >= 0
                    if held.add(pair[doc[hit]], number[hit], ordinal[hit]):
                        yield held.take()
            yield held.take()

        part = docs.mapInArrow(count, "lang string, source string, number long, ordinal long, count long")
        part = cut_lineage(part.groupBy("lang", "source", "number", "ordinal").agg(F.sum("count").alias("count")))
        counted = part if counted is None else counted.unionAll(part)
    if counted is None:
        return spark.createDataFrame([], "lang string, source string, number long, ordinal long, count long")
    return counted


class _Counts:
    """Occurrences by (language, source), transducer and ordinal, added up as they come."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.rows = [np.zeros(0, np.int64)] * 4
        self.fresh: list[list[np.ndarray]] = []
        self.waiting = 0

    def group(self, lang: str, source: str) -> int:
        return self.groups.setdefault((lang, source), len(self.groups))

    def add(self, group: np.ndarray, number: np.ndarray, ordinal: np.ndarray) -> bool:
        """Whether so many different ones are held that they should be given away."""
        for block in self._summed([group, number, ordinal, np.ones(len(group), np.int64)]):
            self.fresh.append(block)
            self.waiting += len(block[0])
        if self.waiting >= HELD:
            self._settle()
        return len(self.rows[0]) >= HELD

    @staticmethod
    def _summed(rows: list[np.ndarray]) -> list[list[np.ndarray]]:
        if not len(rows[0]):
            return []
        order = np.lexsort((rows[2], rows[0]))
        rows = [x[order] for x in rows]
        new = np.ones(len(order), bool)
        new[1:] = (rows[0][1:] != rows[0][:-1]) | (rows[2][1:] != rows[2][:-1])
        at = np.flatnonzero(new)
        return [[*(x[at] for x in rows[:3]), np.add.reduceat(rows[3], at)]]

    def _settle(self) -> None:
        merged = self._summed([np.concatenate(x) for x in zip(self.rows, *self.fresh, strict=True)])
        self.rows = merged[0] if merged else self.rows
        self.fresh, self.waiting = [], 0

    def take(self) -> pa.RecordBatch:
        self._settle()
        group, *numbers = self.rows
        self.rows = [np.zeros(0, np.int64)] * 4
        names = list(self.groups) or [("", "")]
        columns = [pa.array([n[k] for n in names], pa.string()).take(pa.array(group)) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([*columns, *(pa.array(x, pa.int64()) for x in numbers)], ["lang", "source", "number", "ordinal", "count"])


def _bounds(folded: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every term and how many each text has; texts end terms."""
    solid = folded != 0x20
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    inner = offsets[(offsets > 0) & (offsets < len(folded))]
    begins[inner] = solid[inner]
    ends[inner - 1] = solid[inner - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.diff(np.searchsorted(starts, offsets))


def share(count: str, total: str, terms: str) -> Column:
    """1 + floor(10**9 * (count + 2) / (total + 2 * terms)); null where there are no terms."""
    wide = "cast({} as decimal(20, 0))".format
    return F.expr(f"1 + 1000000000 * {wide(f'{count} + 2')} div nullif({wide(f'{total} + 2 * {terms}')}, 0)")


def divergence(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})")


def source_totals(docs: DataFrame, counts: DataFrame, transducers: DataFrame) -> DataFrame:
    """``lang, source, place, total, terms, floor`` of every source: its place in its language,
    counts of kept terms, kept terms of the language, and the share of a term that doesn't occur."""
    sizes = transducers.groupBy("lang").agg(F.sum("size").alias("terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    known = groups.select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "terms")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    return cut_lineage(known.withColumn("place", place).withColumn("floor", share("0", "total", "terms")))


def compare_sources(counts: DataFrame, sources: DataFrame, block_of: int = BLOCK, tiles_of: int = TILE) -> DataFrame:
    """``lang, source, item, value`` of all ordered pairs of sources of a language.

    Sources in tiles against sources in tiles, over blocks of ordinals: no task holds more
    than two tiles of one block. Terms of blocks that no source of two tiles uses add a
    product, as every share there is the floor.
    """
    tile = F.floor(F.col("place") / tiles_of)
    shares = counts.join(sources, ["lang", "source"]).select(
        "lang", "terms", F.col("place").alias("i"), tile.alias("own"), F.floor(F.col("ordinal") / block_of).alias("block"), (F.col("ordinal") % block_of).alias("at"), share("count", "total", "terms").alias("p")
    )
    tiles = cut_lineage(sources.groupBy("lang", tile.alias("tile")).agg(F.collect_list(F.struct("place", "floor")).alias("floors")))
    known = shares.join(tiles.groupBy("lang").agg(F.max("tile").alias("last")), "lang")
    dealt = known.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
    cells = F.collect_list(F.struct("i", "at", "p")).alias("cells")
    blocks = dealt.groupBy("lang", "terms", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "block").agg(cells)
    for side in "ab":
        blocks = blocks.join(tiles.select("lang", F.col("tile").alias(side), F.col("floors").alias(f"floors_{side}")), ["lang", side])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                cells, *floors = (_fields(column(batch, c), k) for c in ("cells", "floors_a", "floors_b"))
                a, b, block, terms = (column(batch, c)[k].as_py() for c in ("a", "b", "block", "terms"))
                width = min(block_of, terms - block * block_of)
                x, y = (_table(cells, tiles_of * t, *f, tiles_of, width) for t, f in zip((a, b), floors, strict=True))
                i, j = (np.flatnonzero(t[:, 0]) for t in (x, y))
                for row in i.tolist():
                    to = j[j > row] if a == b else j
                    gap = x[row] - y[to]
                    value = (gap * gap // (x[row] + y[to])).sum(axis=1)
                    if len(to):
                        ends = (np.full(len(to), tiles_of * a + row), tiles_of * b + to, value, np.full(len(to), width))
                        yield pa.RecordBatch.from_arrays([pa.repeat(column(batch, "lang")[k], len(to)), *(pa.array(e, pa.int64()) for e in ends)], ["lang", "i", "j", "value", "covered"])

    made = blocks.mapInArrow(run, "lang string, i long, j long, value long, covered long")
    made = made.groupBy("lang", "i", "j").agg(F.sum("value").alias("value"), F.sum("covered").alias("covered"))
    ends = [sources.select("lang", F.col("source").alias(c), F.col("place").cast("long").alias(e), F.col("floor").alias(f"floor_{e}"), "terms") for c, e in (("source", "i"), ("item", "j"))]
    pairs = ends[0].join(ends[1].drop("terms"), "lang").filter("i < j").join(made, ["lang", "i", "j"], "left")
    rest = (F.col("terms") - F.coalesce("covered", F.lit(0))) * F.coalesce(divergence("floor_i", "floor_j"), F.lit(0))
    pairs = cut_lineage(pairs.select("lang", "source", "item", (F.coalesce("value", F.lit(0)) + rest).alias("value")))
    return pairs.unionAll(pairs.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))


def _fields(lists: pa.ListArray, k: int) -> list[np.ndarray]:
    own = lists[k].values
    return [f.to_numpy(zero_copy_only=False).astype(np.int64) for f in own.flatten()]


def _table(cells: list[np.ndarray], first: int, places: np.ndarray, floors: np.ndarray, sources: int, width: int) -> np.ndarray:
    """Shares of a tile's sources in a block; rows without a source are 0."""
    table = np.zeros((sources, width), np.int64)
    table[places - first] = floors[:, None]
    i, at, p = cells
    own = (i >= first) & (i < first + sources)
    table[i[own] - first, at[own]] = p[own]
    return table


def leading_terms(counts: DataFrame, sources: DataFrame, transducers: DataFrame, most: int = REPORTED) -> DataFrame:
    """``lang, source, item, value, rank`` of the terms that a source has more of than its language, largest divergence first."""
    languages = sources.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    whole = counts.groupBy("lang", "ordinal").agg(F.sum("count").alias("lang_count"))
    rows = counts.join(whole, ["lang", "ordinal"]).join(sources, ["lang", "source"]).join(languages, "lang")
    rows = rows.select("lang", "source", "number", "ordinal", share("count", "total", "terms").alias("p"), share("lang_count", "lang_total", "terms").alias("q")).filter("p > q")
    rows = rows.withColumn("value", divergence("p", "q"))
    # the order of ordinals is the byte order of terms
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    top = cut_lineage(rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most).drop("p", "q"))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                made, wanted = _restored(row), row["wanted"]
                terms = [made.term(x - row["start"]).decode() for x in wanted]
                yield pa.RecordBatch.from_arrays([pa.array([row["number"]] * len(terms), pa.int64()), pa.array(wanted, pa.int64()), pa.array(terms, pa.string())], ["number", "ordinal", "item"])

    wanted = top.groupBy("number").agg(F.collect_set("ordinal").alias("wanted"))
    spelled = transducers.join(wanted, "number").mapInArrow(spell, "number long, ordinal long, item string")
    return top.join(spelled, ["number", "ordinal"]).select("lang", "source", "item", "value", "rank")


def audit(docs: DataFrame, segment: int = SEGMENT, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` compares sources, part ``term`` names leading terms."""
    docs = _keyed(docs)
    kept = cut_lineage(document_counts(docs).filter(F.col("docs") >= DOCS))
    transducers = build_transducers(kept, segment)
    counts = recount(docs, transducers)
    sources = source_totals(docs, counts, transducers)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = compare_sources(counts, sources, block, tile).withColumn("rank", F.row_number().over(order))
    parts = [part.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank") for name, part in (("pair", pairs), ("term", leading_terms(counts, sources, transducers)))]
    return parts[0].unionAll(parts[1])


ORACLE = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT lang, source, doc, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * v.v) AS p
  FROM g JOIN kept k USING (lang) JOIN v USING (lang)
  LEFT JOIN t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), l AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 2)) // (any_value(s.total) + 2 * any_value(v.v)) AS q
  FROM c JOIN v USING (lang) JOIN (SELECT lang, sum(total) AS total FROM t GROUP BY lang) s USING (lang) GROUP BY lang, term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
  ) x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
), terms AS (
  SELECT p.lang, p.source, p.term AS item, (p.p - l.q) * (p.p - l.q) // (p.p + l.q) AS value
  FROM p JOIN l USING (lang, term) WHERE p.n > 0 AND p.p > l.q
), ranked AS (
  SELECT *, 'pair' AS part FROM pairs UNION ALL SELECT *, 'term' AS part FROM terms
), r AS (
  SELECT lang, source, part, item, value::BIGINT AS value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM ranked
)
SELECT * FROM r WHERE part = 'pair' OR rank <= 10
"""
