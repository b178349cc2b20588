"""Near-duplicate documents by an exact Jaccard join of word-shingle sets with prefix trees.

A document's set are its distinct five-word shingles as 64-bit hashes. All sets are put in
one global order: shingles by hash, but those that many documents share last, by how often
they occur. Two sets within the threshold then share a shingle among their first few. The
documents of such a shingle are compared: all of them where they are few; where they are
many, first each with the most central ones (those with fewest rarer shingles), and after
their components are known, all that lie in different components. So links between texts
of one component may go unchecked, but none between components does.

Sketches of a thirtieth of a set's size first rule out pairs that differ too much. Of the
others each document meets its first partner, and the rest is compared only across the
components found then, so sets are sent about once per document, however large its group.

Pairs are verified per document and block of partners. The partners' ordered sets form a
trie, walked in order: partners that start alike share the overlap counted so far, and a
subtree ends as soon as what remains cannot reach the threshold.

Documents with one set of shingles are one node of the join. Null texts, and texts without
words, have no shingles, are linked with nothing and are their own component. Rows that
repeat a ``doc_id`` are told apart by their text. A row without ``doc_id`` takes part; a
component takes the smallest id that there is.

The join is exact but for collisions of hashes: a text of ten million distinct shingles
counts one too few in about three of a million cases, one of a million in three of 10 ** 8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lendframe.llm.arrow import chunks, column, list_array, utf8
from lendframe.llm.components import connect
from lendframe.llm.naming import free_names
from lendframe.llm.shingles import mix, text_shingles
from lendframe.session import cut_lineage

#: 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Groups of up to so many documents are compared in full at once.
SMALL = 64
HUBS = 3
#: Partners of one document that a trie holds.
TRIE = 512
#: The most frequent shingles that are ordered by frequency; the order decides speed only.
FREQUENT = 1 << 16
#: A task counts shingles over about so many at a time, and reports those seen often enough.
COUNTED = 1 << 21
SEEN = 4
MAP_BITS = 1 << 24
LOW = (1 << 32) - 1


def document_sets(text: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Row and sorted distinct shingles, chunk by chunk."""
    for a, b in chunks(text):
        hashed, made = text_shingles(*utf8(text[a:b]))
        parts = np.split(hashed, np.cumsum(made)[:-1]) if b > a else []
        yield a, [np.unique(p) for p in parts]


def set_key(items: np.ndarray) -> int:
    """64 bits of a set."""
    both = mix(items + np.uint64(0x632BE59BD9B4E019))
    return int(mix(np.array([both.sum(dtype=np.uint64) ^ np.uint64(len(items))], np.uint64)).astype(np.int64)[0])


def describe(docs: DataFrame) -> DataFrame:
    """``doc_id, version, n, key`` of every row, and rows with ``n = -1`` that list shingles seen often (``items, counts``).

    ``version`` is a hash of the text.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "version", "n", "key", "items", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size, known = 0, set()

        def frequent(doc_type: pa.DataType) -> pa.RecordBatch:
            items, counts = np.unique(np.concatenate(held), return_counts=True)
            items, counts = items[counts >= SEEN], counts[counts >= SEEN]
            one = np.array([len(items)])
            return pa.RecordBatch.from_arrays(
                [pa.nulls(1, doc_type), pa.nulls(1, pa.int64()), pa.array([-1], pa.int32()), pa.array([0], pa.int64()), list_array(items.view(np.int64), one, pa.int64()), list_array(counts.astype(np.int32), one, pa.int32())], names
            )

        doc_type = None
        for batch in batches:
            doc, text, version = column(batch, "doc_id"), column(batch, "text"), column(batch, "version")
            doc_type = doc.type
            for at, sets in document_sets(text):
                keys = [set_key(s) for s in sets]
                sizes = [len(s) for s in sets]
                empty = pa.nulls(len(sets), pa.list_(pa.int64())), pa.nulls(len(sets), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([doc[at : at + len(sets)], version[at : at + len(sets)], pa.array(sizes, pa.int32()), pa.array(keys, pa.int64()), *empty], names)
                for key, items in zip(keys, sets, strict=True):
                    if key not in known:
                        known.add(key)
                        held.append(items)
                        size += len(items)
                if size >= COUNTED:
                    yield frequent(doc_type)
                    held, size = [], 0
                if len(known) > 500_000:
                    known.clear()
        if size:
            yield frequent(doc_type)

    rows = docs.select("doc_id", F.xxhash64("text").alias("version"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, version long, n int, key long, items array<long>, counts array<int>")


def pack(sets: list[np.ndarray]) -> pa.Array:
    """Each set as bytes, in its order."""
    return pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())


def unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u8").astype(np.uint64)


class GlobalOrder:
    """Shingles by hash, frequent ones last by frequency."""

    def __init__(self, items: np.ndarray, counts: np.ndarray):
        """Frequent shingles, least frequent first."""
        self.place = np.lexsort((items, counts)).argsort()
        order = np.argsort(items)
        self.items, self.place = items[order], self.place[order]

    def arrange(self, items: np.ndarray) -> np.ndarray:
        """A sorted set in global order."""
        if not len(self.items):
            return items
        at = np.minimum(np.searchsorted(self.items, items), len(self.items) - 1)
        frequent = self.items[at] == items
        late = items[frequent]
        return np.concatenate([items[~frequent], late[np.argsort(self.place[at[frequent]])]])


def prefix_length(n: np.ndarray | int):
    """So many first shingles hold one that any set within the threshold shares."""
    return n - (PERCENT * n + 99) // 100 + 1


def least_overlap(n, m):
    """Shingles that sets of n and m must share."""
    return -(-(PERCENT * (n + m)) // (100 + PERCENT))


def prefixes(docs: DataFrame, order) -> DataFrame:
    """``item, key, spot`` for the first shingles of every set; spot packs set size and position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in batches:
            for _, sets in document_sets(column(batch, "text")):
                items, keys, spots = [], [], []
                for own in sets:
                    if not len(own) or (key := set_key(own)) in known:
                        continue
                    known.add(key)
                    first = order.value.arrange(own)[: prefix_length(len(own))]
                    items.append(first)
                    keys.append(np.full(len(first), key))
                    spots.append((len(own) << 32) + np.arange(len(first)))
                if len(known) > 500_000:
                    known.clear()
                if items:
                    columns = [np.concatenate(items).view(np.int64), np.concatenate(keys), np.concatenate(spots)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "key", "spot"])

    return docs.select("text").mapInArrow(run, "item long, key long, spot long")


def propose(first: DataFrame) -> DataFrame:
    """Pairs to verify, and members of large groups.

    Shingles are dealt to tasks and sorted, and a task streams through them: it holds the
    current shingle's first members only. Rows with ``item`` null are a pair ``a < b`` that
    shares a shingle, with the ``sizes`` of both sets and the ``spots`` of the shingle in
    them packed; ``full`` is 1 if all pairs of that shingle are listed. Others say that
    ``a`` is a member of the large group of ``item``, with its ``spot`` in ``b``.
    """
    names = ["a", "b", "item", "sizes", "spots", "full"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item, members, last = None, [], None
        out: tuple[list, ...] = ([], [], [], [], [], [])

        def pair(x: tuple[int, int], y: tuple[int, int], full: int) -> None:
            (key, spot), (other, place) = (x, y) if x[0] < y[0] else (y, x)
            n, m = spot >> 32, place >> 32
            if 100 * min(n, m) >= PERCENT * max(n, m):
                spots = ((spot & LOW) << 32) + (place & LOW)
                for values, value in zip(out, (key, other, None, (n << 32) + m, spots, full), strict=True):
                    values.append(value)

        def member(x: tuple[int, int]) -> None:
            for values, value in zip(out, (*x, item, None, None, None), strict=True):
                values.append(value)

        def close() -> None:
            """Members of a group that stayed small: each with each."""
            if 1 < len(members) <= SMALL:
                for k, x in enumerate(members):
                    for y in members[:k]:
                        pair(x, y, 1)

        def add(x: tuple[int, int]) -> None:
            """Members come most central first; past SMALL each meets the first few only."""
            if len(members) < SMALL:
                members.append(x)
                return
            if len(members) == SMALL:
                members.append(x)
                for k, y in enumerate(members):
                    member(y)
                    for z in members[: min(k, HUBS)]:
                        pair(y, z, 0)
                return
            member(x)
            for z in members[:HUBS]:
                pair(x, z, 0)

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)
            for c in out:
                c.clear()
            return batch

        for batch in batches:
            items, keys, spots = (column(batch, c).to_numpy() for c in ("item", "key", "spot"))
            # most shingles belong to one set: leave them out before any loop
            same = items[1:] == items[:-1]
            inside = np.zeros(len(items), bool)
            inside[1:] |= same
            inside[:-1] |= same
            if len(items):
                inside[[0, -1]] = True
            for i, key, spot in zip(items[inside].tolist(), keys[inside].tolist(), spots[inside].tolist(), strict=True):
                if i != item:
                    close()
                    item, members, last = i, [], None
                if key != last:
                    add((key, spot))
                    last = key
                if len(out[0]) >= 50_000:
                    yield flush()
        close()
        if out[0]:
            yield flush()

    central = F.col("spot").bitwiseAND(F.lit(LOW))
    dealt = first.repartition("item").sortWithinPartitions("item", central, "key")
    return dealt.mapInArrow(run, "a long, b long, item long, sizes long, spots long, full long")


def _need(n: Column, m: Column) -> Column:
    return F.ceil(F.lit(PERCENT) * (n + m) / F.lit(100 + PERCENT))


def _after_prefix(n: Column) -> Column:
    return n - (n - F.ceil(F.lit(PERCENT) * n / F.lit(100)) + F.lit(1))


def _may_link(n: Column, m: Column, met: Column, p: Column, q: Column, unseen: Column) -> Column:
    """Whether sets of n and m may share enough.

    ``met`` shingles they share in both prefixes, the last at places p and q, but for up to
    ``unseen`` more. What else they share lies past the prefix that ends first, and, if
    none is unseen, behind the last one in both.
    """
    past = met + unseen + F.greatest(_after_prefix(n), _after_prefix(m))
    behind = F.when(unseen == 0, met + F.least(n - p, m - q) - 1).otherwise(past)
    return F.least(past, behind) >= _need(n, m)


def count_pairs(proposed: DataFrame) -> DataFrame:
    """``a, b, n, m, met, p, q, unseen`` of every pair proposed."""
    large = cut_lineage(proposed.filter("item is not null").groupBy("a").agg(F.count("*").alias("large")))
    counted = F.col("full") == 1
    pairs = proposed.filter("item is null").groupBy("a", "b").agg(
        F.sum("full").alias("met"),
        F.min("sizes").alias("sizes"),
        F.max(F.when(counted, F.expr("spots >> 32"))).alias("p"),
        F.max(F.when(counted, F.col("spots").bitwiseAND(F.lit(LOW)))).alias("q"),
    )
    pairs = pairs.join(large, "a", "left").withColumnRenamed("large", "large_a").join(large.withColumnRenamed("a", "b"), "b", "left")
    unseen = F.least(F.coalesce("large_a", F.lit(0)), F.coalesce("large", F.lit(0)))
    n, m = F.expr("sizes >> 32"), F.col("sizes").bitwiseAND(F.lit(LOW))
    return pairs.select("a", "b", n.alias("n"), m.alias("m"), "met", "p", "q", unseen.alias("unseen"))


def bit_map(ids: DataFrame, name: str) -> np.ndarray:
    """Which residues of a hash the ids have: a filter of fixed size, whatever their number."""
    spots = ids.select(F.pmod(F.xxhash64(name), F.lit(MAP_BITS)).alias("spot"))
    bit = F.expr("shiftleft(1L, cast(spot % 32 as int))")
    words = spots.groupBy(F.expr("cast(spot div 32 as int)").alias("word")).agg(F.bit_or(bit).alias("bits"))
    found = np.zeros(MAP_BITS // 32, np.uint32)
    got = words.toArrow()
    found[got["word"].to_numpy()] = got["bits"].to_numpy().astype(np.uint32)
    return found


def sketch(items: np.ndarray) -> bytes:
    """Parities of how many shingles fall on each bit, of two to four bits a shingle."""
    bits = max(64, 1 << (2 * len(items) - 1).bit_length())
    odd = np.bincount((items & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def sketch_distance(x: bytes, y: bytes) -> int:
    """At most so many shingles as are in one set only; the longer sketch is folded to the other's size."""
    short, long = sorted((np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")), key=len)
    folded = np.bitwise_xor.reduce(long.reshape(-1, len(short)), axis=0)
    return int(np.bitwise_count(folded ^ short).sum())


def fetch_sets(docs: DataFrame, holders: DataFrame, pairs: DataFrame, order) -> DataFrame:
    """``key, n, sketch, items`` in global order for all keys in ``pairs``, made anew from their holders' texts.

    Holders are told by a filter of fixed size. What it lets through besides is not asked
    for, or the same set again.
    """
    keys = pairs.select(F.col("a").alias("key")).unionAll(pairs.select(F.col("b").alias("key"))).distinct()
    bits = docs.sparkSession.sparkContext.broadcast(bit_map(keys.join(holders, "key"), "holder"))
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(MAP_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in batches:
            place = column(batch, "spot").to_numpy()
            may = (bits.value[place // 32] >> (place % 32).astype(np.uint32)) & 1
            text = column(batch, "text").take(pa.array(np.flatnonzero(may)))
            for _, sets in document_sets(text):
                found = {k: s for s in sets if (k := set_key(s)) not in known}
                known |= found.keys()
                if found:
                    own = list(found.values())
                    sizes, sketches = pa.array(list(map(len, own)), pa.int32()), pa.array(list(map(sketch, own)), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), sizes, sketches, pack([order.value.arrange(s) for s in own])], ["key", "n", "sketch", "items"])
                if len(known) > 500_000:
                    known.clear()

    return cut_lineage(docs.select("text", spot.alias("spot")).mapInArrow(run, "key long, n int, sketch binary, items binary"))


def sift(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sketches let them link; none that links is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (column(batch, c).to_numpy() for c in ("n", "m"))
            most = n + m - 2 * least_overlap(n, m)
            drawn = zip(column(batch, "x").to_pylist(), column(batch, "y").to_pylist(), most.tolist(), strict=True)
            kept = pa.array([sketch_distance(x, y) <= d for x, y, d in drawn], pa.bool_())
            yield pa.RecordBatch.from_arrays([column(batch, c).filter(kept) for c in ("a", "b")], ["a", "b"])

    left = sets.select(F.col("key").alias("a"), "n", F.col("sketch").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("y"))
    return pairs.select("a", "b").join(right, "b").join(left, "a").mapInArrow(run, "a long, b long")


def trie_links(probe: np.ndarray, partners: list[np.ndarray]) -> np.ndarray:
    """Which partners' sets link with the probe's; all are in global order.

    Partners sorted as sequences are the trie's leaves from left to right. The overlap of
    the path so far is kept per depth; the next leaf goes on from where it branches off.
    """
    names = np.sort(probe)
    leaves = sorted(range(len(partners)), key=lambda k: partners[k].astype(">u8").tobytes())
    linked = np.zeros(len(partners), bool)
    path, overlap, depth = np.zeros(0, np.uint64), np.zeros(1, np.int64), 0
    for k in leaves:
        own = partners[k]
        need = least_overlap(len(probe), len(own))
        shared = min(depth, len(own))
        differ = np.flatnonzero(path[:shared] != own[:shared])
        shared = int(differ[0]) if len(differ) else shared
        counts, at = [overlap[: shared + 1]], shared
        so_far = int(overlap[shared])
        step = 64
        while at < len(own) and so_far + len(own) - at >= need:
            part = own[at : at + step]
            spots = np.minimum(np.searchsorted(names, part), len(names) - 1)
            grown = so_far + np.cumsum(names[spots] == part)
            counts.append(grown)
            so_far, at, step = int(grown[-1]), at + len(part), step * 2
        path, overlap, depth = own, np.concatenate(counts), at
        linked[k] = at == len(own) and so_far >= need
    return linked


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that link.

    Each ``a`` meets its partners in tries of about TRIE; its own set is sent to each.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / TRIE).cast("int").alias("blocks"))
    sizes = cut_lineage(sizes)
    placed = pairs.join(sizes, "a").withColumn("block", F.expr("cast(pmod(xxhash64(b), blocks) as int)")).select("a", "b", "block")
    partners = placed.join(sets.select(F.col("key").alias("b"), "items"), "b").select("a", "block", "b", "items")
    own = sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).join(sets.select(F.col("key").alias("a"), "items"), "a")
    rows = partners.unionByName(own.select("a", "block", F.lit(None).cast("long").alias("b"), "items"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, probe, names, partners = None, None, [], []

        def close() -> pa.RecordBatch | None:
            if probe is None or not partners:
                return None
            found = np.array(names)[trie_links(probe, partners)]
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(found), current[0]), pa.int64()), pa.array(found, pa.int64())], ["a", "b"]) if len(found) else None

        for batch in batches:
            for a, block, b, items in zip(*(column(batch, c).to_pylist() for c in ("a", "block", "b", "items")), strict=True):
                if (a, block) != current:
                    if (done := close()) is not None:
                        yield done
                    current, probe, names, partners = (a, block), None, [], []
                if b is None:
                    probe = unpack(items)
                elif not names or names[-1] != b:
                    names.append(b)
                    partners.append(unpack(items))
        if (done := close()) is not None:
            yield done

    dealt = rows.repartition("a", "block").sortWithinPartitions("a", "block", "b")
    return dealt.mapInArrow(run, "a long, b long")


def find_links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``a, b`` among the pairs that give the same components as all of them."""
    likely = cut_lineage(sift(pairs, sets))
    first = cut_lineage(likely.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    links = cut_lineage(verify(first, sets))
    labels = connect(links)
    named = likely.join(first, ["a", "b"], "left_anti")
    for end, label in (("a", "x"), ("b", "y")):
        named = named.join(labels.select(F.col("node").alias(end), F.col("component").alias(label)), end, "left")
    apart = named.filter(F.coalesce("x", "a") != F.coalesce("y", "b")).select("a", "b")
    rest = cut_lineage(apart)
    if rest.isEmpty():
        return links
    return links.unionAll(cut_lineage(verify(rest, sets)))


def second_phase(groups: DataFrame, labels: DataFrame, checked: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of large groups that lie in different components, may link and were not checked before.

    A pair comes up at a shingle that leaves room enough behind it in both sets, as the
    first one that they share does if they link.
    """
    named = groups.select("item", F.col("a").alias("key"), F.col("b").alias("spot")).join(labels.withColumnRenamed("node", "key"), "key", "left")
    place = F.col("spot").bitwiseAND(F.lit(LOW))
    named = cut_lineage(named.select("item", "key", F.coalesce("component", "key").alias("label"), F.expr("spot >> 32").alias("n"), place.alias("p")))
    mixed = named.groupBy("item").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("item")
    named = cut_lineage(named.join(mixed, "item"))
    x, y = named.alias("x"), named.alias("y")
    fits = (
        (F.col("x.item") == F.col("y.item"))
        & (F.col("x.key") < F.col("y.key"))
        & (F.col("x.label") != F.col("y.label"))
        & (100 * F.least("x.n", "y.n") >= PERCENT * F.greatest("x.n", "y.n"))
        & (F.least(F.col("x.n") - F.col("x.p"), F.col("y.n") - F.col("y.p")) >= _need(F.col("x.n"), F.col("y.n")))
    )
    pairs = x.join(y, fits).select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct()
    return pairs.join(checked, ["a", "b"], "left_anti")


def join_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, version, key, n_shingles, component_id, leads`` of every row.

    ``leads`` marks the rows of one set and one id in each component, that of the smallest id.
    """
    context = docs.sparkSession.sparkContext
    told = cut_lineage(describe(docs))
    listed = told.filter("n = -1").select(F.explode(F.arrays_zip("items", "counts")).alias("x"))
    often = listed.groupBy(F.col("x.items").alias("item")).agg(F.sum("x.counts").alias("n")).orderBy(F.desc("n"), "item").limit(FREQUENT).toArrow()
    order = context.broadcast(GlobalOrder(often["item"].to_numpy().view(np.uint64), often["n"].to_numpy()))
    rows = told.filter("n >= 0").select("doc_id", "version", "n", "key")
    holders = cut_lineage(rows.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("holder")))
    proposed = cut_lineage(propose(prefixes(docs, order)))
    counted = cut_lineage(count_pairs(proposed))
    may = _may_link(*(F.col(c) for c in ("n", "m", "met")), F.coalesce("p", F.lit(0)), F.coalesce("q", F.lit(0)), F.col("unseen"))
    pairs = cut_lineage(counted.filter(may).select("a", "b"))
    links = find_links(pairs, fetch_sets(docs, holders, pairs, order))
    labels = connect(links)
    later = cut_lineage(second_phase(proposed.filter("item is not null"), labels, pairs))
    if not later.isEmpty():
        labels = connect(links.unionAll(find_links(later, fetch_sets(docs, holders, later, order))))
    named = holders.join(labels.withColumnRenamed("node", "key"), "key", "left").select("key", "holder", F.coalesce("component", "key").alias("label"))
    named = cut_lineage(named)
    first = F.min(F.struct(F.col("holder").isNull(), F.col("holder"), F.col("key").alias("first_key"))).alias("m")
    smallest = cut_lineage(named.groupBy("label").agg(first).select("label", F.col("m.holder").alias("component_id"), F.col("m.first_key").alias("first_key")))
    named = cut_lineage(named.join(smallest, "label").select("key", "component_id", (F.col("key") == F.col("first_key")).alias("first")))
    leads = F.col("first") & F.col("doc_id").eqNullSafe(F.col("component_id"))
    full = rows.filter("n > 0").join(named, "key").select("doc_id", "version", "key", F.col("n").cast("long").alias("n_shingles"), "component_id", leads.alias("leads"))
    alone = rows.filter("n = 0").select("doc_id", "version", F.lit(None).cast("long"), F.lit(0).cast("long"), F.col("doc_id"), F.lit(True))
    return full.unionAll(alone)


def join_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    return join_rows(docs).select("doc_id", "n_shingles", "component_id")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, that of its smallest id; texts without words stay.

    The chosen rows are found by id and text. Where several rows are alike in both, one
    of them stays.
    """
    found = cut_lineage(join_rows(docs).withColumn("alone", F.col("key").isNull()))
    own, seen, again = free_names(docs, "__id", "__version", "__again")
    chosen = found.filter("leads").groupBy(F.col("doc_id").alias(own), "key", "alone").agg(F.min("version").alias(seen), F.count("*").alias("rows"))
    chosen = cut_lineage(chosen.select(own, seen, ((F.col("rows") > 1) & ~F.col("alone")).alias(again)).distinct())
    columns = [F.col(f"`{c}`") for c in docs.columns]
    version = F.xxhash64("text")
    kept = docs.join(chosen, F.col("doc_id").eqNullSafe(F.col(own)) & (version == F.col(seen)))
    if chosen.filter(F.col(again)).isEmpty():
        return kept.select(*columns)
    once = kept.filter(F.col(again)).dropDuplicates([own, seen])
    return kept.filter(~F.col(again)).select(*columns).unionAll(once.select(*columns))
