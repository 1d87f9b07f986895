"""Byte-level BPE encoding and decoding with a two-tier lookup.

First tier: a minimal perfect hash over the vocabulary resolves every pre-token
that is an entry as a whole. Polynomial hashes of all pre-tokens of a chunk come
from running sums over its bytes, so hashing, probing and the comparison of the
bytes with the entry found are array operations. Second tier: all other
pre-tokens are merged over linked bytes, the pair of lowest rank (the leftmost of
equal ones) first, by a heap. Merged words are kept in a table that is started
anew at ``table_limit`` entries, some 100 MB of a worker's memory.

The pattern's letters and numbers are those that the `tiktoken` library knows;
characters that its Unicode version lacks count as neither.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ticktide.llm.bytepair import RANKS_FILE, vocabulary
from ticktide.llm.tables import byte_slices, id_and_text, text_slices

BASE = 0x9E3779B97F4A7C15
CHUNK = 1 << 20
STAND_IN = ""  # a character that is no letter, number or white space


def mixed(x: np.ndarray) -> np.ndarray:
    """Scattered 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) ^ x


class PerfectHash:
    """A minimal perfect hash: n distinct 64-bit numbers to the slots 0 .. n - 1.

    Numbers fall into buckets; each bucket, the fullest first, gets the first
    displacement that sends its numbers to slots still free. A bucket of one
    stores a free slot itself, as a negative number.
    """

    def __init__(self, keys: np.ndarray):
        self.size, self.buckets = len(keys), max(1, len(keys) // 3)
        self.shift = np.zeros(self.buckets, dtype=np.int64)
        bucket = (mixed(keys) % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        free = np.ones(self.size, dtype=bool)
        tries = np.arange(1, 257, dtype=np.int64)
        for b in np.argsort(starts[:-1] - starts[1:], kind="stable").tolist():
            own = keys[order[starts[b]:starts[b + 1]]]
            if len(own) == 1:
                break
            first = 0
            while len(own):
                slots = self._slots(own[None, :], (first + tries)[:, None])
                good = free[slots].all(axis=1) & (np.diff(np.sort(slots, axis=1), axis=1) > 0).all(axis=1)
                if good.any():
                    at = int(np.argmax(good))
                    self.shift[b] = first + tries[at]
                    free[slots[at]] = False
                    break
                first += len(tries)
                if first > 1 << 22:
                    raise ValueError("two entries have the same hash")
        alone = np.nonzero(np.diff(starts) == 1)[0]
        self.shift[alone] = -1 - np.nonzero(free)[0]

    def _slots(self, keys: np.ndarray, shift: np.ndarray) -> np.ndarray:
        moved = mixed(keys + shift.astype(np.uint64) * np.uint64(BASE))
        return (moved % np.uint64(max(1, self.size))).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Of any numbers; those that are no keys get some slot, too."""
        shift = self.shift[(mixed(keys) % np.uint64(self.buckets)).astype(np.int64)]
        return np.where(shift < 0, -1 - shift, self._slots(keys, shift))


class Vocabulary:
    """Ranks of a vocabulary file and what encoding and decoding need of them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = pattern
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.byte_pairs = np.array([ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)],
                                   dtype=np.int64)
        self.longest = max(map(len, ranks))
        # A pair merges when its bytes are an entry, however that entry is usually made.
        self.pairs = {ranks[t[:i]] << 32 | ranks[t[i:]]: rank for t, rank in ranks.items()
                      for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        self.powers = self.inverses = np.ones(1, dtype=np.uint64)
        self._extend(CHUNK)
        tokens = list(ranks)
        blob = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        ends = np.cumsum([len(t) for t in tokens])
        starts = ends - [len(t) for t in tokens]
        keys = self._hashes(blob, starts, ends)
        self.perfect = PerfectHash(keys)
        order = np.argsort(self.perfect.slots(keys))
        self.starts, self.sizes, self.blob = starts[order], (ends - starts)[order], blob
        self.ids = np.array([ranks[t] for t in tokens], dtype=np.int64)[order]
        self.newer = newer_characters(pattern)

    def _extend(self, size: int) -> None:
        """Powers of the base and of its inverse for ``size`` bytes."""
        more = size + 1 - len(self.powers)
        if more > 0:
            for name, factor in (("powers", BASE), ("inverses", pow(BASE, -1, 1 << 64))):
                have = getattr(self, name)
                new = have[-1] * np.cumprod(np.full(more, factor, dtype=np.uint64))
                setattr(self, name, np.concatenate([have, new]))

    def _hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._extend(len(data))
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[:len(data)], out=sums[1:])
        return (sums[ends] - sums[starts]) * self.inverses[starts]

    def whole(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Ids of the pre-tokens that are entries, -1 for others."""
        slots = self.perfect.slots(self._hashes(data, starts, ends))
        found = np.where(self.sizes[slots] == ends - starts, self.ids[slots], -1)
        open_ = np.nonzero(found >= 0)[0]
        for i in range(self.longest):
            open_ = open_[ends[open_] - starts[open_] > i]
            if not len(open_):
                break
            differ = data[starts[open_] + i] != self.blob[self.starts[slots[open_]] + i]
            found[open_[differ]] = -1
            open_ = open_[~differ]
        return found

    def merge_all(self, words: list[bytes]) -> Iterator[list[int]]:
        """Ids of pre-tokens by merging; the pairs of single bytes are looked up for all at once."""
        data = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        ids = self.bytes[data].tolist()
        ranks = self.byte_pairs[data[:-1] << 8 | data[1:]].tolist() + [-1]
        at = 0
        for word in words:
            end = at + len(word)
            ranks[end - 1] = -1
            yield self.merge(ids[at:end], ranks[at:end])
            at = end

    def merge(self, ids: list[int], ranks: list[int]) -> list[int]:
        """Merge linked ids; ``ranks[i]`` is that of the pair that begins at i, or -1."""
        pair, n = self.pairs.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # In the heap a rank and its place are one number.
        heap = [rank << 32 | i for i, rank in enumerate(ranks) if rank >= 0]
        heapify(heap)
        while heap:
            top = heappop(heap)
            rank, i = top >> 32, top & 0xFFFFFFFF
            if ranks[i] != rank:
                continue
            j = after[i]
            after[i] = k = after[j]
            ids[i], ids[j], ranks[i], ranks[j] = rank, -1, -1, -1
            if k < n:
                before[k] = i
                ranks[i] = new = pair(rank << 32 | ids[k], -1)
                if new >= 0:
                    heappush(heap, new << 32 | i)
            h = before[i]
            if h >= 0:
                ranks[h] = new = pair(ids[h] << 32 | rank, -1)
                if new >= 0:
                    heappush(heap, new << 32 | h)
        return [i for i in ids if i >= 0]


def newer_characters(pattern: str) -> str:
    """Characters that `regex` takes for letters or numbers and the `tiktoken` library does not.

    The library itself says which ones: over the bytes as vocabulary, what it
    matches of all characters comes back.
    """
    import regex
    import tiktoken
    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    single = {bytes([b]): b for b in range(256)}
    newer = set()
    for kind in (r"\p{L}", r"\p{N}"):
        known = tiktoken.Encoding("bytes", pat_str=kind, mergeable_ranks=single, special_tokens={})
        newer |= set(regex.findall(kind, every)) - set(bytes(known.encode_ordinary(every)).decode())
    return "".join(sorted(newer))


def read_ranks(folder: str | None) -> dict[bytes, int]:
    with open(vocabulary(folder, RANKS_FILE), "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


class Encoder:
    """Encodes texts in one task."""

    def __init__(self, vocabulary: Vocabulary, table_limit: int):
        import regex
        self.vocabulary, self.limit, self.table = vocabulary, table_limit, {}
        self.split = regex.compile(vocabulary.pattern).findall
        self.border = regex.compile(r"(?<=\S)[ \n]")
        self.newer = frozenset(vocabulary.newer)
        self.stand_in = dict.fromkeys(map(ord, vocabulary.newer), STAND_IN)

    def parts(self, text: str) -> Iterator[str]:
        """A long text in parts, cut where white space follows another character: never inside a match."""
        at = 0
        while len(text) - at > CHUNK and (cut := self.border.search(text, at + CHUNK // 2)):
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:]

    def words(self, part: str) -> list[str]:
        if part.isascii() or self.newer.isdisjoint(part):
            return self.split(part)
        words, at = [], 0
        for size in map(len, self.split(part.translate(self.stand_in))):
            words.append(part[at:at + size])
            at += size
        return words

    def chunk(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive pre-tokens, and how many each has."""
        joined = "".join(words)
        data = np.frombuffer(joined.encode(), dtype=np.uint8)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
        if len(data) > len(joined):
            ends = np.append(np.nonzero((data & 0xC0) != 0x80)[0], len(data))[ends]
        starts = np.concatenate([[0], ends[:-1]])
        found = self.vocabulary.whole(data, starts, ends)
        misses = np.nonzero(found < 0)[0]
        table, sizes = self.table, np.ones(len(words), dtype=np.int64)
        if not len(misses):
            return found, sizes
        if len(table) > self.limit:
            table.clear()
        missed = list(map(words.__getitem__, misses.tolist()))
        new = list(set(missed).difference(table))
        for word, ids in zip(new, self.vocabulary.merge_all([word.encode() for word in new])):
            table[word] = array("i", ids).tobytes()
        merged = list(map(table.__getitem__, missed))
        sizes[misses] = np.fromiter(map(len, merged), dtype=np.int64, count=len(merged)) // 4
        flat = np.repeat(found, sizes)
        flat[flat < 0] = np.frombuffer(b"".join(merged), dtype=np.int32)
        return flat, sizes

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, one after the other, and where each text ends."""
        out, counts, words, held, size = [], np.zeros(len(texts), dtype=np.int64), [], [], 0

        def flush() -> None:
            nonlocal words, held, size
            flat, sizes = self.chunk(words)
            out.append(flat)
            np.add.at(counts, np.repeat([h[0] for h in held], [h[1] for h in held]), sizes)
            words, held, size = [], [], 0

        for row, text in enumerate(texts):
            for part in self.parts(text) if text else ():
                own = self.words(part)
                words += own
                held.append((row, len(own)))
                size += len(part)
                if size >= CHUNK:
                    flush()
        if words:
            flush()
        return np.concatenate(out) if out else np.zeros(0, dtype=np.int64), np.cumsum(counts)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None,
           pattern: str | None = None, table_limit: int = 400_000) -> DataFrame:
    """Per row: doc_id and ids, an array of int, without special tokens.

    A null or empty text has no ids. Strings of special tokens in a text are
    ordinary characters. Repeated rows are encoded each, a null id stays null,
    an empty table gives no rows; other columns are not looked at.
    """
    if pattern is None:
        import public_tokenizers
        pattern = public_tokenizers.PATTERN
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(read_ranks(folder), pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, table_limit)
        for batch in byte_slices(batches):
            flat, ends = encoder.texts(batch.column(1).to_pylist())
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                                           pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", folder: str | None = None) -> DataFrame:
    """Per row: doc_id, ids and bytes. Null ids give no bytes; ids out of the vocabulary are an error."""
    shared = encoded.sparkSession.sparkContext.broadcast({r: t for t, r in read_ranks(folder).items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.__getitem__
        for batch in text_slices(batches):
            ends, values = batch.column(1).offsets.to_numpy(), batch.column(1).values.to_numpy()
            texts = [b"".join(map(token, values[a:b].tolist())) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], ["doc_id", "ids", "bytes"])

    ids = F.coalesce(F.col(f"`{ids_col}`"), F.array().cast("array<int>"))
    return encoded.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), ids.alias("ids")).mapInArrow(
        run, "doc_id long, ids array<int>, bytes binary")
