"""SentencePiece encoding and decoding by batched Viterbi search.

A text gets the dummy prefix, spaces become the mark U+2581, and it is cut before
every run of marks: no piece reaches over such a cut (checked when the model is
read). Distinct words of a batch are sorted by length, and words of equal length
advance together: polynomial hashes of all their substrings probe the sorted
hashes of the pieces, and for each end position the best piece ending there is
kept as a back-pointer for all words at once.

*Unigram* models: the best piece maximises the sum of scores, equal sums go to
the longer piece.

*BPE* models: the ids must be those of the merges, which maximise no sum. But a
segmentation is the merges' own exactly when every two neighbours are: when
merging their characters stops at just these two pieces. Of the pieces ending at
a position exactly one fits behind the piece kept for its start, so the same
search runs with "fits" in place of the sum. Two pieces fit unless, undoing their
last merges from the latest on, some pair across the border would have merged
earlier. Pairs are judged in arrays and remembered. Words with several marks in a
row, whose merges all have the same score, are merged one by one.

Ids of words are kept in a table that is started anew at ``table_limit`` entries,
some 200 MB of a worker's memory.
"""

from __future__ import annotations

import heapq
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ticktide.llm.tables import byte_slices, id_and_text, text_slices

MARK = "▁"
UNIGRAM, BPE = 1, 2                                              # fixed values: model types
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)  # fixed values: piece types
NEVER = 1 << 40
BASE = np.uint64(0x9E3779B97F4A7C15)
MEMO = 1 << 20


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value: object = varint()
        elif kind == 2:
            size = varint()
            value, at = data[at:at + size], at + size
        else:
            size = 4 if kind == 5 else 8
            value, at = struct.unpack("<f" if kind == 5 else "<d", data[at:at + size])[0], at + size
        yield key >> 3, value


class Vocabulary:
    """Pieces of a model file and what the search needs of them."""

    def __init__(self, data: bytes):
        self.pieces, self.scores, self.kinds = [], [], []
        trainer, normaliser = {}, {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.scores.append(float(piece.get(2, 0.0)))
                self.kinds.append(int(piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        if normaliser.get(2) or normaliser.get(4, 1):
            raise ValueError("only models that leave characters and white space as they are can be used")
        self.model_type = int(trainer.get(3, UNIGRAM))
        if self.model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models can be used")
        self.prefix = bool(normaliser.get(3, 1))
        self.usable = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k in (NORMAL, USER_DEFINED)}
        if any(MARK in p.lstrip(MARK) for p in self.usable):
            raise ValueError("a piece reaches over the start of a word")
        self.bytes = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.unknown = self.kinds.index(UNKNOWN)
        self._index()
        if self.model_type == BPE:
            self._merges()

    def _index(self) -> None:
        """Sorted hashes of the pieces of each length."""
        self.longest = max(map(len, self.usable), default=1)
        by_length: dict[int, list[int]] = {}
        for piece, i in self.usable.items():
            by_length.setdefault(len(piece), []).append(i)
        self.sorted = {}
        for length, ids in by_length.items():
            codes = np.array([list(map(ord, self.pieces[i])) for i in ids], dtype=np.uint64)
            hashes = self.hashes(codes)
            order = np.argsort(hashes)
            self.sorted[length] = hashes[order], np.array(ids)[order], codes[order]

    @staticmethod
    def hashes(codes: np.ndarray) -> np.ndarray:
        value = np.zeros(codes.shape[:-1], dtype=np.uint64)
        for i in range(codes.shape[-1]):
            value = value * BASE + codes[..., i] + np.uint64(1)
        return value

    def _merges(self) -> None:
        """Ranks, last merges, and which pairs merge; pieces that merging never makes are dropped."""
        size = len(self.pieces)
        levels = {s: r for r, s in enumerate(sorted({self.scores[i] for i in self.usable.values()}, reverse=True))}
        self.rank = np.full(size + 1, -1, dtype=np.int64)   # the last entry: an unknown character
        self.left, self.right = np.arange(size + 1), np.arange(size + 1)
        pairs = {}
        for piece, i in self.usable.items():
            if len(piece) > 1:
                self.rank[i] = levels[self.scores[i]]
                for cut in range(1, len(piece)):
                    a, b = self.usable.get(piece[:cut]), self.usable.get(piece[cut:])
                    if a is not None and b is not None:
                        pairs[a * (size + 1) + b] = self.rank[i]
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int64)
        self.reached = np.zeros(size + 1, dtype=bool)
        self.reached[size] = True
        for piece, i in self.usable.items():
            merged, last = self.merge(piece)
            self.reached[i] = merged == [i] and MARK * 2 not in piece
            if last is not None:
                self.left[i], self.right[i] = last
        self.sorted = {length: tuple(part[self.reached[ids]] for part in (keys, ids, codes))
                       for length, (keys, ids, codes) in self.sorted.items() if self.reached[ids].any()}
        self.memo_keys = np.full(MEMO, -1, dtype=np.int64)
        self.memo_values = np.zeros(MEMO, dtype=bool)

    def merge(self, word: str) -> tuple[list[int], tuple[int, int] | None]:
        """Ids of a word by merging, -1 for characters without a piece; and the last pair merged."""
        parts = list(word)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if 0 <= i and j < len(parts) and (i_ := self.usable.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-self.scores[i_], i, parts[i] + parts[j]))

        for i in range(len(parts)):
            offer(i)
        last = None
        while heap:
            _, i, text = heapq.heappop(heap)
            j = after[i] if parts[i] else len(parts)
            if j >= len(parts) or not parts[i] or parts[i] + parts[j] != text:
                continue
            last = self.usable.get(parts[i]), self.usable.get(parts[j])
            parts[i], parts[j], after[i] = text, "", after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [self.usable.get(p, -1) for p in parts if p], last

    def fit(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether merging leaves each pair of pieces as it is."""
        keys = first * len(self.rank) + second
        slot = (keys.astype(np.uint64) * BASE >> np.uint64(44)).astype(np.int64)
        known = self.memo_keys[slot] == keys
        out = self.memo_values[slot]
        if not known.all():
            new = np.unique(keys[~known])
            judged = self._judge(new // len(self.rank), new % len(self.rank))
            out[~known] = judged[np.searchsorted(new, keys[~known])]
            slot = (new.astype(np.uint64) * BASE >> np.uint64(44)).astype(np.int64)
            self.memo_keys[slot], self.memo_values[slot] = new, judged
            # Of two new pairs in one slot only one was written; its value must be its own.
            self.memo_values[slot] = judged[np.searchsorted(new, self.memo_keys[slot])]
        return out

    def _judge(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        fits = np.ones(len(first), dtype=bool)
        limit = np.full(len(first), NEVER)
        open_ = np.arange(len(first))
        while len(open_):
            a, b = first[open_], second[open_]
            keys = a * len(self.rank) + b
            at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            # Ranks are doubled, so that a limit can lie between two of them.
            across = np.where(self.pair_keys[at] == keys, 2 * self.pair_ranks[at], NEVER)
            broken = across < limit[open_]
            fits[open_[broken]] = False
            rank_a, rank_b = 2 * self.rank[a], 2 * self.rank[b]
            undo_first = rank_a > rank_b
            limit[open_] = np.where(undo_first, rank_a, rank_b + 1)
            first[open_] = np.where(undo_first, self.right[a], a)
            second[open_] = np.where(undo_first, b, self.left[b])
            open_ = open_[~broken & (undo_first | (rank_b >= 0))]
        return fits

    def search(self, words: list[str]) -> list[list[int]]:
        """Pieces of words of one length; -1 for a character without a piece."""
        n = len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(len(words), n).astype(np.uint64)
        bpe, unknown = self.model_type == BPE, len(self.pieces)
        scores = np.append(np.array(self.scores), min(self.scores) - 10)
        # found[k][w, s]: the piece of length k + 1 that starts at s in word w, or -1.
        found, hashes = [], np.zeros((len(words), n), dtype=np.uint64)
        for length in range(1, min(n, self.longest) + 1):
            hashes = hashes[:, :n - length + 1] * BASE + codes[:, length - 1:] + np.uint64(1)
            piece = np.full(hashes.shape, -1, dtype=np.int64)
            if length in self.sorted:
                keys, ids, own = self.sorted[length]
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                w, s = np.nonzero(keys[at] == hashes)
                same = np.ones(len(w), dtype=bool)
                for i in range(length):
                    same &= own[at[w, s], i] == codes[w, s + i]
                piece[w[same], s[same]] = ids[at[w[same], s[same]]]
            if length == 1:
                piece[piece < 0] = unknown
            found.append(piece)
        kept = np.full((len(words), n + 1), -1, dtype=np.int64)
        size = np.zeros((len(words), n + 1), dtype=np.int64)
        best = np.full((len(words), n + 1), -np.inf)
        best[:, 0] = 0
        for end in range(1, n + 1):
            for length in range(min(end, self.longest), 0, -1):
                start = end - length
                piece = found[length - 1][:, start]
                if bpe:
                    rows = np.nonzero((piece >= 0) & (kept[:, end] < 0))[0]
                    if start:
                        rows = rows[self.fit(kept[rows, start], piece[rows])]
                else:
                    total = best[:, start] + scores[piece]
                    rows = np.nonzero((piece >= 0) & (total > best[:, end]))[0]
                    best[rows, end] = total[rows]
                kept[rows, end], size[rows, end] = piece[rows], length
        out: list[list[int]] = [[] for _ in words]
        at, rows = np.full(len(words), n), np.arange(len(words))
        while len(rows):
            for row, piece in zip(rows.tolist(), kept[rows, at[rows]].tolist()):
                out[row].append(-1 if piece == unknown else piece)
            at[rows] -= size[rows, at[rows]]
            rows = rows[at[rows] > 0]
        return [pieces[::-1] for pieces in out]

    def ids(self, word: str, pieces: list[int]) -> list[int]:
        """Pieces to ids: unknown characters become bytes, or one unknown id a run."""
        if -1 not in pieces:
            return pieces
        out, at = [], 0
        for piece in pieces:
            length = len(self.pieces[piece]) if piece >= 0 else 1
            if piece >= 0:
                out.append(piece)
            elif self.bytes:
                out.extend(self.bytes[b] for b in word[at:at + 1].encode())
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
            at += length
        return out

    def encode_words(self, words: list[str]) -> dict[str, list[int]]:
        """Ids of distinct words."""
        out, groups = {}, {}
        for word in words:
            if self.model_type == BPE and word.startswith(MARK * 2):
                out[word] = self.ids(word, self.merge(word)[0])
            else:
                groups.setdefault(len(word), []).append(word)
        for length, group in groups.items():
            step = max(1, 2_000_000 // (length * min(length, self.longest)))
            for at in range(0, len(group), step):
                part = group[at:at + step]
                out.update((w, self.ids(w, p)) for w, p in zip(part, self.search(part)))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: marks become spaces, byte pieces UTF-8, bad bytes U+FFFD; the prefix goes."""
        if not hasattr(self, "plain"):
            self.plain = [
                bytes([int(p[1:-1], 16)]) if k == BYTE else " ⁇ ".encode() if k == UNKNOWN
                else b"" if k == CONTROL else p.replace(MARK, " ").encode()
                for p, k in zip(self.pieces, self.kinds)]
        text = b"".join(map(self.plain.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def read_model(path: str | None) -> bytes:
    """A model file's bytes; the public 32k model by default."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(os.fspath(path), "rb") as file:
        return file.read()


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None,
           table_limit: int = 900_000) -> DataFrame:
    """Per row: doc_id and ids, an array of int, without begin and end ids.

    A null or empty text has no ids. Special strings in a text are ordinary
    characters. Repeated rows are encoded each; other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(Vocabulary(read_model(model))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.__new__(Vocabulary)
        vars(vocabulary).update(shared.value)
        split, table = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+").findall, {}
        for batch in byte_slices(batches):
            words = [split(_marked(vocabulary, text)) for text in batch.column(1).to_pylist()]
            if len(table) > table_limit:
                table.clear()
            new = {w for row in words for w in row if w not in table}
            table.update((w, np.array(ids, dtype="<i4").tobytes())
                         for w, ids in vocabulary.encode_words(list(new)).items())
            rows = [b"".join(map(table.__getitem__, row)) for row in words]
            ends = np.cumsum([0, *(len(r) // 4 for r in rows)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(rows), dtype="<i4")))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def _marked(vocabulary: Vocabulary, text: str) -> str:
    text = text.replace(" ", MARK)
    return MARK + text if vocabulary.prefix and text else text


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str | None = None) -> DataFrame:
    """Per row: doc_id, ids and text. Null ids give an empty text; ids out of the vocabulary are an error."""
    shared = encoded.sparkSession.sparkContext.broadcast(vars(Vocabulary(read_model(model))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.__new__(Vocabulary)
        vars(vocabulary).update(shared.value)
        for batch in text_slices(batches):
            ends, values = batch.column(1).offsets.to_numpy(), batch.column(1).values.to_numpy()
            texts = [vocabulary.decode(values[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    ids = F.coalesce(F.col(f"`{ids_col}`"), F.array().cast("array<int>"))
    return encoded.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), ids.alias("ids")).mapInArrow(
        run, "doc_id long, ids array<int>, text string")
