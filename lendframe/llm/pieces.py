"""SentencePiece encoding and decoding in vectorised merge rounds.

Texts are cut into segments across which no vocabulary piece reaches (blanks with the
word after them, characters unknown to the vocabulary). Every distinct segment becomes
a run of symbols in one flat array. Each round finds the best pair of every segment,
merges its leftmost occurrences, and drops what was merged; segments without a pair
leave the arrays, until none is left. Merging several occurrences of a pair in one
round is done only for pairs whose piece takes part in no better pair, so that the
result is that of merging one pair at a time. A segment of more than LONG symbols is merged
alone, in rounds that touch only the positions of the best rank.

Null texts count as empty and encode to no ids. Repeated rows and ids give a row each.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lendframe.llm.arrow import chunks, column, list_array, ragged

BLANK = "▁"
#: Distinct segments a task keeps encoded; beyond it the store starts anew.
KEPT_SEGMENTS = 150_000
NONE = np.iinfo(np.int64).max
#: Segments of more symbols are merged by themselves.
LONG = 2048
#: Merges so many times the longest piece apart don't touch each other.
REACH = 3


def _check_rules(raw: bytes) -> None:
    """Refuse a model whose texts are prepared in another way than by blanks turned into marks, one put before."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(raw)
    rules, made = model.normalizer_spec, model.trainer_spec
    odd = {
        "no pair merges": made.model_type != made.BPE,
        "a character map": bool(rules.precompiled_charsmap),
        "no blank before the text": not rules.add_dummy_prefix,
        "blanks that are squeezed": rules.remove_extra_whitespaces,
        "blanks that stay blanks": not rules.escape_whitespaces,
        "blanks after words": made.treat_whitespace_as_suffix,
        "no byte pieces": not made.byte_fallback,
        "symbols of users": any(p.type == p.USER_DEFINED for p in model.pieces),
    }
    if any(odd.values()):
        raise ValueError(f"this model has {', '.join(k for k, v in odd.items() if v)}")


class PieceModel:
    """Vocabulary, merge table and byte pieces of a BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        _check_rules(model.serialized_model_proto())
        size = model.get_piece_size()
        text = [model.id_to_piece(i) for i in range(size)]
        skipped = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
        normal = {text[i]: i for i in range(size) if not skipped[i]}
        letters = sorted({c for p in normal for c in p} - normal.keys())
        #: Symbols: pieces by id, then characters that occur in pieces only.
        symbol = normal | {c: size + k for k, c in enumerate(letters)}
        self.size, self.symbols = size, size + len(letters)
        self.first_byte = next(i for i in range(size) if model.is_byte(i))
        scores = sorted({model.get_score(i) for i in normal.values()}, reverse=True)
        rank = {s: r for r, s in enumerate(scores)}
        ranks = {p: rank[model.get_score(i)] for p, i in normal.items()}
        pairs, grows = [], dict.fromkeys(normal, NONE)
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in symbol and right in symbol:
                    pairs.append((symbol[left] * self.symbols + symbol[right], ranks[piece], i))
                    for part in (left, right):
                        if part in grows:
                            grows[part] = min(grows[part], ranks[piece])
        pairs.sort()
        self.pair_key, self.pair_rank, self.pair_piece = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        #: Per piece: no pair that it takes part in is as good as the pair that made it.
        self.calm = np.zeros(self.symbols, bool)
        for piece, i in normal.items():
            self.calm[i] = grows[piece] > ranks[piece]
        self.longest = max(map(len, normal))
        self.of_char = np.full(0x110000, -1, np.int32)
        for piece, i in symbol.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i
        split_line = "" if any("\n" in p for p in normal) else "\n"
        if any(BLANK in p.lstrip(BLANK) for p in normal):
            raise ValueError("a piece of this vocabulary reaches over the start of a word")
        self.segment = re.compile(f"[\n]|{BLANK}*[^{BLANK}\n]+|{BLANK}+" if split_line else f"{BLANK}*[^{BLANK}]+|{BLANK}+")
        raw = [b"" if skipped[i] else text[i].replace(BLANK, " ").encode() for i in range(size)]
        for i in range(256):
            raw[self.first_byte + i] = bytes([i])
        self.raw_count = np.array([len(x) for x in raw], np.int64)
        self.raw_start = np.cumsum(self.raw_count) - self.raw_count
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.is_byte = np.zeros(size, bool)
        self.is_byte[self.first_byte : self.first_byte + 256] = True
        self.unknown = model.unk_id()
        self.forget()

    def forget(self) -> None:
        """Drop the encoded segments."""
        self.known: dict[str, int] = {}
        self.written: list[str] = []
        self.ids, self.starts, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Row of each pair in the merge table, -1 if there is none."""
        key = left * self.symbols + right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where((self.pair_key[at] == key) & (left >= 0) & (right >= 0), at, -1)

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over segments laid end to end; final symbols, and their number per segment."""
        owner = np.repeat(np.arange(len(lengths)), lengths)
        origin = np.arange(len(symbols))
        found: list[tuple[np.ndarray, ...]] = []
        at = np.full(len(symbols), -1, np.int64)
        if len(symbols) > 1:
            inside = owner[1:] == owner[:-1]
            at[:-1][inside] = self.pair(symbols[:-1][inside], symbols[1:][inside])
        while len(symbols):
            rank = np.where(at >= 0, self.pair_rank[at], NONE)
            heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[heads, len(owner)])
            best = np.minimum.reduceat(rank, heads)
            if (best == NONE).any():
                stay = np.repeat(best != NONE, sizes)
                found.append((origin[~stay], owner[~stay], symbols[~stay]))
                symbols, owner, origin, at, rank = symbols[stay], owner[stay], origin[stay], at[stay], rank[stay]
                sizes, best = sizes[best != NONE], best[best != NONE]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, sizes))
            first = np.r_[True, owner[hit[1:]] != owner[hit[:-1]]]
            # of hits that overlap, every second one counts, from the left
            run_head = np.r_[True, hit[1:] != hit[:-1] + 1] | first
            place = np.arange(len(hit))
            place -= np.maximum.accumulate(np.where(run_head, place, 0))
            hit = hit[(place % 2 == 0) & (first | self.calm[self.pair_piece[at[hit]]])]
            symbols[hit] = self.pair_piece[at[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            touched = np.zeros(len(symbols), bool)
            touched[hit] = True
            touched[np.maximum(hit - 1, 0)] = True
            symbols, owner, origin, at, touched = symbols[keep], owner[keep], origin[keep], at[keep], touched[keep]
            # the symbol before a merged one may itself be one that was dropped
            merged_now = np.zeros(len(keep), bool)
            merged_now[hit] = True
            merged_now = np.flatnonzero(merged_now[keep])
            touched[np.maximum(merged_now - 1, 0)] = True
            again = np.flatnonzero(touched)
            follow = np.minimum(again + 1, len(symbols) - 1)
            inside = (again + 1 < len(symbols)) & (owner[again] == owner[follow])
            at[again] = np.where(inside, self.pair(symbols[again], symbols[follow]), -1)
        if not found:
            return np.zeros(0, np.int64), np.zeros(len(lengths), np.int64)
        origin, owner, symbols = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(origin, kind="stable")
        return symbols[order], np.bincount(owner, minlength=len(lengths))

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """Merge rounds over one long segment, whose cost follows the hits and not the length.

        Positions wait by the rank of their pair, and a round takes the best rank that waits.
        Leftmost occurrences merge together, but for those whose merged symbol makes a still
        better pair: what such a pair can grow to is a piece, so it touches no occurrence that
        lies REACH pieces' lengths away. Of occurrences nearer to each other, those behind the
        first such one wait until its better pairs are done.
        """
        symbols, far = symbols.copy(), REACH * self.longest
        n = len(symbols)
        after, before, alive = np.arange(1, n + 1), np.arange(-1, n - 1), np.ones(n, bool)
        after[-1] = -1
        pair = np.append(self.pair(symbols[:-1], symbols[1:]), -1)
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def wait(at: np.ndarray) -> None:
            at = at[pair[at] >= 0]
            own = self.pair_rank[pair[at]]
            order = np.argsort(own, kind="stable")
            at, own = at[order], own[order]
            edges = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else []
            for part, rank in zip(np.split(at, edges[1:]), own[edges].tolist() if len(own) else []):
                if rank not in waiting:
                    waiting[rank] = []
                    heapq.heappush(ranks, rank)
                waiting[rank].append(part)

        def rank_of(left: np.ndarray, right: np.ndarray) -> np.ndarray:
            row = self.pair(left, right)
            return np.where(row >= 0, self.pair_rank[row], NONE)

        wait(np.arange(n))
        while ranks:
            rank = heapq.heappop(ranks)
            hit = np.unique(np.concatenate(waiting.pop(rank)))
            hit = hit[alive[hit] & (pair[hit] >= 0)]
            hit = hit[self.pair_rank[pair[hit]] == rank]
            if not len(hit):
                continue
            # of hits that overlap, every second one counts, from the left
            run_head = np.r_[True, after[hit[:-1]] != hit[1:]]
            place = np.arange(len(hit))
            place -= np.maximum.accumulate(np.where(run_head, place, 0))
            hit = hit[place % 2 == 0]
            made = self.pair_piece[pair[hit]]
            second = after[hit]
            third, ahead = after[second], before[hit]
            if not self.calm[made].all():
                beside = np.r_[False, second[:-1] == ahead[1:]]
                left = np.where(ahead >= 0, symbols[ahead], -1)
                left[beside] = made[:-1][beside[1:]]
                right = np.where(third >= 0, symbols[third], -1)
                hot = (rank_of(left, made) < rank) | (rank_of(made, right) < rank)
                cluster = np.cumsum(np.r_[True, hit[1:] - hit[:-1] > far])
                passed = np.cumsum(hot) - hot
                first = np.r_[True, cluster[1:] != cluster[:-1]]
                now = passed == np.maximum.accumulate(np.where(first, passed, 0))
                if not now.all():
                    wait(hit[~now])
                    hit, made, second, third = hit[now], made[now], second[now], third[now]
            symbols[hit] = made
            alive[second] = False
            after[hit] = third
            before[third[third >= 0]] = hit[third >= 0]
            ahead = before[hit]
            touched = np.unique(np.concatenate([hit, ahead[ahead >= 0]]))
            touched = touched[alive[touched]]
            follow = after[touched]
            pair[touched] = np.where(follow >= 0, self.pair(symbols[touched], symbols[follow]), -1)
            wait(touched)
        return symbols[alive]

    def merge_all(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols of segments end to end, and their number per segment; long segments go by themselves."""
        points = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        symbols, sizes = self.of_char[points].astype(np.int64), np.array([len(s) for s in segments], np.int64)
        long = np.flatnonzero(sizes > LONG)
        if not len(long):
            return self.merge(symbols, sizes)
        starts = np.cumsum(sizes) - sizes
        short = np.repeat(sizes <= LONG, sizes)
        merged, counts = self.merge(symbols[short], np.where(sizes <= LONG, sizes, 0))
        parts, at = [], np.cumsum(counts) - counts
        done = 0
        for k in long.tolist():
            own = self.merge_long(symbols[starts[k] : starts[k] + sizes[k]])
            parts += [merged[done : at[k]], own]
            done, counts[k] = at[k], len(own)
        return np.concatenate([*parts, merged[done:]]), counts

    def learn(self, segments: list[str]) -> None:
        """Encode new distinct segments and keep them."""
        symbols, counts = self.merge_all(segments)
        odd = (symbols < 0) | (symbols >= self.size)
        if odd.any():
            symbols, counts = self._fall_back(segments, symbols, counts, odd)
        flat = symbols.astype(np.int32)
        base, first = len(self.ids), len(self.counts)
        self.starts = np.r_[self.starts, base + np.cumsum(counts) - counts]
        self.counts = np.r_[self.counts, counts]
        self.ids = np.r_[self.ids, flat]
        listed, stops = list(map(str, flat.tolist())), np.cumsum(counts).tolist()
        begin = 0
        for k, (segment, stop) in enumerate(zip(segments, stops, strict=True)):
            self.known[segment] = first + k
            self.written.append(",".join(listed[begin:stop]))
            begin = stop

    def _fall_back(self, segments, symbols, counts, odd):
        """Write characters outside the vocabulary as byte pieces.

        Such a character never merges, so the n-th of a segment's is its n-th one of those
        that stayed single.
        """
        owner = np.repeat(np.arange(len(counts)), counts)
        wide = np.ones(len(symbols), np.int64)
        parts: dict[int, bytes] = {}
        # characters before symbol: those that earlier symbols of the segment cover
        covers = np.ones(len(symbols), np.int64)
        covers[~odd] = self.piece_chars[symbols[~odd]]
        before = np.cumsum(covers) - covers
        segment_at = np.cumsum([len(s) for s in segments]) - [len(s) for s in segments]
        for k in np.flatnonzero(odd).tolist():
            char = segments[owner[k]][int(before[k] - segment_at[owner[k]])]
            parts[k] = char.encode()
            wide[k] = len(parts[k])
        out = np.empty(int(wide.sum()), np.int64)
        at = np.cumsum(wide) - wide
        out[at[~odd]] = symbols[~odd]
        for k, raw in parts.items():
            out[at[k] : at[k] + len(raw)] = np.frombuffer(raw, np.uint8).astype(np.int64) + self.first_byte
        return out, np.bincount(owner, weights=wide, minlength=len(counts)).astype(np.int64)

    @property
    def piece_chars(self) -> np.ndarray:
        """Code points of every piece."""
        if not hasattr(self, "_chars"):
            lead = (self.raw & 0xC0) != 0x80
            sums = np.r_[0, np.cumsum(lead)]
            self._chars = sums[self.raw_start + self.raw_count] - sums[self.raw_start]
        return self._chars

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Ids of all texts in a row, their number per text, and each text's ids written out."""
        cut = [self.segment.findall(BLANK + t.replace(" ", BLANK)) if t else [] for t in texts]
        if len(self.known) > KEPT_SEGMENTS:
            self.forget()
        new = list(dict.fromkeys(s for s in set(chain.from_iterable(cut)) if s not in self.known))
        if new:
            self.learn(new)
        known, written = self.known, self.written
        rows = [list(map(known.__getitem__, segments)) for segments in cut]
        flat = np.fromiter(chain.from_iterable(rows), np.int64, sum(map(len, rows)))
        ids = self.ids[ragged(self.starts[flat], self.counts[flat])]
        sums = np.r_[0, np.cumsum(self.counts[flat])]
        ends = np.cumsum([0, *map(len, rows)])
        return ids, np.diff(sums[ends]), [",".join(map(written.__getitem__, r)) for r in rows]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Texts in UTF-8: piece bytes laid end to end, without the blank put before the text.

        Bytes that form no character become the replacement character; control ids give
        nothing, the unknown id its usual mark.
        """
        wide = self.raw_count[ids]
        flat = self.raw[ragged(self.raw_start[ids], wide)]
        ends = np.r_[0, np.cumsum(counts)]
        at = np.r_[0, np.cumsum(wide)][ends]
        odd = np.r_[0, np.cumsum(self.is_byte[ids] & (ids >= self.first_byte + 0x80) | (ids == self.unknown))][ends]
        shown = (self.raw_count > 0) | (np.arange(self.size) == self.unknown)
        out = []
        for k in range(len(counts)):
            if odd[k + 1] > odd[k] and not _valid(text := flat[at[k] : at[k + 1]].tobytes()) or (ids[ends[k] : ends[k + 1]] == self.unknown).any():
                text = self._decode_slow(ids[ends[k] : ends[k + 1]].tolist())
            else:
                text = flat[at[k] : at[k + 1]].tobytes()
            seen = ids[ends[k] : ends[k + 1]]
            lead = next((i for i in map(int, seen) if shown[i]), None) if text[:1] == b" " else None
            out.append(text[1:] if lead is not None and lead != self.unknown and not self.is_byte[lead] else text)
        return out

    def _decode_slow(self, ids: list[int]) -> bytes:
        out, run = [], bytearray()
        for i in [*ids, None]:
            if i is not None and self.is_byte[i]:
                run.append(i - self.first_byte)
                continue
            out.append(_replace(bytes(run)))
            run.clear()
            if i is not None:
                start = self.raw_start[i]
                out.append(" ⁇ ".encode() if i == self.unknown else self.raw[start : start + self.raw_count[i]].tobytes())
        return b"".join(out)


def _valid(raw: bytes) -> bool:
    try:
        raw.decode()
    except UnicodeDecodeError:
        return False
    return True


def _replace(raw: bytes) -> bytes:
    """Every byte that starts no whole character becomes the replacement character."""
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            if at + size <= len(raw) and _valid(raw[at : at + size]):
                out.append(raw[at : at + size])
                at += size
                break
        else:
            out.append("�".encode())
            at += 1
    return b"".join(out)


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    return PieceModel(path)


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """Ids and decoded text: ``doc_id, ids array<int>, decoded string``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for batch in batches:
            doc, text = column(batch, "doc_id"), column(batch, "text")
            for a, b in chunks(text):
                texts = text[a:b].fill_null("").to_pylist()
                ids, counts, _ = model.encode(texts)
                back = pa.array([x.decode() for x in model.decode(ids, counts)], pa.string())
                yield pa.RecordBatch.from_arrays([doc[a:b], list_array(ids, counts, pa.int32()), back], ["doc_id", "ids", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def digest_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row, without moving ids to the JVM."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        sha = lambda raw: hashlib.sha256(raw).hexdigest()
        for batch in batches:
            doc, text = column(batch, "doc_id"), column(batch, "text")
            for a, b in chunks(text):
                ids, counts, written = model.encode(text[a:b].fill_null("").to_pylist())
                columns = [
                    doc[a:b],
                    pa.array(counts, pa.int64()),
                    pa.array([sha(w.encode()) for w in written], pa.string()),
                    pa.array([sha(t) for t in model.decode(ids, counts)], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
