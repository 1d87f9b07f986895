"""Alignment of two tokenisers of the same text by merge-path partitioning.

The tokens of a text under vocabularies A and B tile the same bytes, so their
links, the pairs of tokens that overlap, are the steps of merging the two sorted
lists of token ends: between two neighbouring ends lies one pair. The texts of a
batch are laid end to end. Diagonals of the merge, ``WIDTH`` steps apart, are cut
by binary search, all at once; the pieces between them have equal work and know
where they start, so they advance together, one step of every piece at a time.
Where both ends meet a group closes; groups that run on over a border of pieces
are stitched when the pieces are put in a row.

Counts of id pairs are corpus-wide. Tasks count the pairs of a text, then those
of a block of texts; one row per block and pair is dealt by pair and summed, and
the sums go back to the blocks that hold the pair. Texts meet the sums of their
block only, so a task holds one block, whatever the corpus.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ticktide.llm.bytepair import JSON_FILE, vocabulary
from ticktide.llm.byte_bpe import read_ranks
from ticktide.llm.tables import byte_slices, id_and_text
from ticktide.session import shared_folder

MODEL_FILE = "piece_bpe_32k.model"
MARK = "▁"
WIDTH = 128
BLOCK_BYTES = 16 << 20
PER_TASK = 1 << 24
STORED = ("doc_id long, block long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "pairs binary, times binary, block_pairs binary, block_times binary")
ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")


def merge_path(a: np.ndarray, b: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links of two sorted lists of ends with the same last entry.

    Returns, in order, the token of A and of B of each link, where it ends, and
    whether both tokens end there.
    """
    total = len(a) + len(b)
    diagonal = np.minimum(np.arange(0, total + width, width), total)
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (open_ := np.nonzero(low < high)[0]).size:
        middle = (low[open_] + high[open_]) // 2
        first = a[middle] <= b[diagonal[open_] - 1 - middle]  # of equal ends that of A comes first
        low[open_[first]] = middle[first] + 1
        high[open_[~first]] = middle[~first]
    i, j = low[:-1].copy(), (diagonal - low)[:-1].copy()
    left, steps = np.diff(diagonal), int(np.diff(diagonal).max(initial=0))
    far = np.iinfo(np.int64).max
    padded_a, padded_b = np.append(a, far), np.append(b, far)
    tokens_a, tokens_b = (np.empty((len(i), steps), dtype=np.int64) for _ in range(2))
    ends = np.full((len(i), steps), -1, dtype=np.int64)
    for step in range(steps):
        end_a, end_b = padded_a[i], padded_b[j]
        first = (end_a <= end_b) & (left > step)
        tokens_a[:, step], tokens_b[:, step] = i, j
        ends[:, step] = np.where(left > step, np.minimum(end_a, end_b), -1)
        i += first
        j += ~first & (left > step)
    # Pieces in a row: a step that ends where the one before it ended is the other side of a common end.
    tokens_a, tokens_b, ends = (x.ravel()[ends.ravel() >= 0] for x in (tokens_a, tokens_b, ends))
    again = np.diff(ends, prepend=-1) == 0
    both = np.append(again[1:], False)[~again]
    return tokens_a[~again], tokens_b[~again], ends[~again], both


class Coder:
    """Both tokenisers and the bytes of their tokens; to be made inside a task."""

    def __init__(self, folder: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import regex
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(vocabulary(folder, JSON_FILE))
        self.exact.encode_special_tokens = True
        ranks = read_ranks(folder)
        # The same ids, faster, for texts below U+0250: see bytepair.
        self.fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})
        self.unusual = regex.compile("[^\x00-ɏ]").search
        self.piece = sentencepiece.SentencePieceProcessor(model_file=vocabulary(folder, MODEL_FILE))
        self.tokens_a = [b""] * self.exact.get_vocab_size()
        for token, rank in ranks.items():
            self.tokens_a[rank] = token
        for i, token in self.exact.get_added_tokens_decoder().items():
            self.tokens_a[i] = token.content.encode()
        self.tokens_b = [self._bytes(i) for i in range(self.piece.get_piece_size())]
        self.sizes_a = np.array(list(map(len, self.tokens_a)))
        self.sizes_b = np.array(list(map(len, self.tokens_b)))
        # Ids in decimals with what may follow one, at most one separator wide.
        self.written = [np.array([f"{i}{mark}".encode() for mark in ",|;" for i in range(n)])
                        for n in (len(self.tokens_a), len(self.tokens_b))]

    def _bytes(self, i: int) -> bytes:
        text = self.piece.id_to_piece(i)
        return bytes([int(text[1:-1], 16)]) if self.piece.is_byte(i) else text.replace(MARK, " ").encode()

    def ids_a(self, text: str) -> np.ndarray:
        if text.isascii() or not self.unusual(text):
            return self.fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=()).astype(np.int64)
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype=np.int64)

    def both(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """Ids under A and B and the bytes of each text; none where the tokens do not give the text back."""
        nothing = np.zeros(0, dtype=np.int64)
        for text, ids_b in zip(texts, self.piece.encode(texts, num_threads=1)):
            data = f" {text}".encode()
            if text and b"".join(map(self.tokens_b.__getitem__, ids_b)) == data:
                a = self.ids_a(f" {text}")
                if b"".join(map(self.tokens_a.__getitem__, a.tolist())) == data:
                    yield a, np.array(ids_b, dtype=np.int64), len(data)
                    continue
            yield nothing, nothing, 0


def _written(coder: Coder, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> bytes:
    """``a1,a2|b1;a3|b2`` of one text; groups are numbers from 0 on."""
    last_a, last_b = np.append(np.diff(group_a) > 0, True), np.append(np.diff(group_b) > 0, True)
    place_a = np.arange(len(a)) + np.searchsorted(group_b, group_a)
    place_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")
    table_a, table_b = coder.written
    out = np.empty(len(a) + len(b), dtype=max(table_a.dtype, table_b.dtype))
    out[place_a] = table_a[a + last_a * len(coder.tokens_a)]
    out[place_b] = table_b[b + 2 * last_b * len(coder.tokens_b)]
    return out.tobytes().replace(b"\0", b"")[:-1]


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    starts = np.nonzero(np.diff(keys, prepend=-1))[0]
    return keys[starts], np.add.reduceat(times, starts) if len(starts) else times


def stored(docs: DataFrame, id_col: str, text_col: str, folder: str | None, block_bytes: int,
           groups: bool = False) -> DataFrame:
    """A row per text with its groups' digest and pair counts, and a row per block with those of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, task = Coder(folder), TaskContext.get().partitionId()
        block, size, seen = task * PER_TASK, 0, []
        names = [part.split()[0] for part in STORED.split(", ")]
        types = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[part.split()[1]]
                 for part in STORED.split(", ")]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        def close() -> pa.RecordBatch:
            nonlocal block, size, seen
            keys, times = _summed(*(np.concatenate(x) for x in zip(*seen)))
            row = (None, block, *(None,) * 7, keys.astype("<u4").tobytes(), times.astype("<i8").tobytes())
            block, size, seen = block + 1, 0, []
            return batch([row])

        for rows in byte_slices(batches):
            texts = rows.column(1).to_pylist()
            encoded = list(coder.both(texts))
            ids_a, ids_b = (np.concatenate([e[side] for e in encoded]) for side in (0, 1))
            count_a, count_b = (np.array([len(e[side]) for e in encoded]) for side in (0, 1))
            ends = np.cumsum([e[2] for e in encoded])
            end_a, end_b = np.cumsum(coder.sizes_a[ids_a]), np.cumsum(coder.sizes_b[ids_b])
            link_a, link_b, link_end, closes = merge_path(end_a, end_b)
            # A group's number; the common end itself still belongs to the group it closes.
            number = np.cumsum(closes) - closes
            group_a, group_b = (number[np.searchsorted(link_end, e)] for e in (end_a, end_b))
            owner = np.searchsorted(ends, link_end)
            keys = owner << 32 | ids_a[link_a] * len(coder.tokens_b) + ids_b[link_b]
            keys, times = _summed(keys, np.ones(len(keys), dtype=np.int64))
            pair_ends = np.searchsorted(keys >> 32, np.arange(len(texts)), side="right")
            keys &= 0xFFFFFFFF
            n_links = np.bincount(owner, minlength=len(texts)).tolist()
            n_groups = np.bincount(owner, weights=closes, minlength=len(texts)).astype(np.int64).tolist()
            out, at, at_a, at_b = [], 0, 0, 0
            for i, doc_id in enumerate(rows.column(0).to_pylist()):
                to, to_a, to_b = int(pair_ends[i]), at_a + int(count_a[i]), at_b + int(count_b[i])
                written = _written(coder, ids_a[at_a:to_a], ids_b[at_b:to_b], group_a[at_a:to_a], group_b[at_b:to_b]) \
                    if to_a > at_a else b""
                digest = "" if not written else written.decode() if groups else hashlib.sha256(written).hexdigest()
                out.append((doc_id, block, to_a - at_a, to_b - at_b, n_groups[i], n_links[i], digest,
                            keys[at:to].astype("<u4").tobytes(), times[at:to].astype("<u4").tobytes(), None, None))
                at, at_a, at_b = to, to_a, to_b
            yield batch(out)
            seen.append(_summed(keys, times))
            size += int(ends[-1])
            if size >= block_bytes:
                yield close()
        if seen:
            yield close()

    return id_and_text(docs, id_col, text_col).mapInArrow(run, STORED)


def _read(value: object, kind: str) -> np.ndarray:
    return np.frombuffer(value.as_py() or b"", dtype=kind)


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None,
          block_bytes: int = BLOCK_BYTES, groups: bool = False) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A null or empty text, and one whose tokens do not give it back, has zeros
    and an empty string. With ``groups`` the last column holds the groups
    themselves. Repeated rows count each; null ids stay null; other columns are
    not looked at; an empty table gives no rows.
    """
    spark = docs.sparkSession
    path = shared_folder(spark, "alignment")
    stored(docs, id_col, text_col, folder, block_bytes, groups).write.option("compression", "zstd").parquet(path)
    passed = spark.read.schema(STORED).parquet(path)

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, times in zip(*batch.columns):
                keys, counts = _read(pairs, "<u4"), _read(times, "<i8")
                for at in range(0, len(keys), 1 << 16):
                    part = keys[at:at + (1 << 16)].astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), block.as_py())), pa.array(part), pa.array(counts[at:at + (1 << 16)])],
                        ["block", "pair", "times"])

    size_b = _pieces(folder)
    by_block = (passed.filter(F.col("block_pairs").isNotNull()).select("block", "block_pairs", "block_times")
                .mapInArrow(exploded, "block long, pair long, times long"))
    totals = (by_block.groupBy("pair").agg(F.sum("times").alias("total"))
              .withColumn("b", F.col("pair") % size_b))
    best = totals.groupBy("b").agg(F.max("total").alias("most"))
    # At most one row an entry of B: the size of its vocabulary.
    judged = (totals.join(F.broadcast(best), "b")
              .select("pair", "total", (F.col("total") == F.col("most")).alias("is_best")))
    known = by_block.select("block", "pair").join(judged, "pair")

    def scored(texts: pa.Table, pairs: pa.Table) -> pa.Table:
        keys = pairs.column("pair").to_numpy()
        order = np.argsort(keys)
        keys, total = keys[order], pairs.column("total").to_numpy()[order]
        is_best = pairs.column("is_best").to_numpy()[order].astype(bool)
        n_best, count_sum = [], []
        for own, times in zip(texts.column("pairs"), texts.column("times")):
            at, n = np.searchsorted(keys, _read(own, "<u4")), _read(times, "<u4").astype(np.int64)
            n_best.append(int(n[is_best[at]].sum()))
            count_sum.append(int((n * total[at]).sum()))
        kept = {name: texts.column(name) for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        return pa.table(kept | {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64()),
                                "groups_sha256": texts.column("groups_sha256")})

    texts = passed.filter(F.col("block_pairs").isNull()).drop("block_pairs", "block_times")
    return (texts.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(scored, ALIGNED))


def _pieces(folder: str | None) -> int:
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=vocabulary(folder, MODEL_FILE)).get_piece_size()
