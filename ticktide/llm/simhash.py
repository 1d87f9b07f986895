"""SimHash near-duplicates, found by vantage-point trees or by blocks of bits.

Fingerprints: a bit is set when it is set in over half of the XXH64 values (seed
42) of a text's word shingles. Texts with one fingerprint form one node, so
copies never meet each other. `drop_near_copies` removes near copies by their
five-word shingles: it searches several fingerprints of each text, over its set of
words, which near copies hardly change, and then measures the similarity itself.
There a link is more than a small distance, so every pair of near texts counts:
it is measured, or a bound from sketches of the shingles shows that it is no copy,
or its texts are connected by measured pairs already.

Search: the upper levels of a vantage-point tree are fitted on a bounded sample
of fingerprints and sent to the tasks. A fingerprint goes to the inside of a
vantage point when its Hamming distance is at most the median there, else to the
outside, and from a border strip as wide as the threshold to the inside, too: by
the triangle inequality no pair is parted. Each shard goes on in the same way
down to blocks that are compared in full. Shards that hold more than
``shard_rows`` fingerprints are cut into parts, and every pair of parts is a
task. A shard returns a spanning forest of its links, never all pairs.

The sample decides where the borders lie and how even the shards are, not which
pairs are found: the result is that of comparing everything with everything.

A deeper tree has more borders, so a row is in ever more leaves the more rows there
are. `drop_near_copies`, whose rows carry sketches, searches by blocks of bits: of
one block more than bits may differ, two near fingerprints agree in one block at
least. So a text has one row per view and block, however many texts there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ticktide.llm.components import components
from ticktide.llm.tables import checkpointed, hex64, id_and_text, text_slices

SEED = 42
LEAF = 4096            # fingerprints a shard should hold
MOST_LEAVES = 4096     # bound of the tree that is sent to the tasks
SAMPLE_PER_LEAF = 16   # so the sample has at most 65,536 fingerprints
BLOCK = 1024           # compared in full
PAIRS = 1 << 20        # pairs looked at together
MOST_ROOM = 1 << 22    # pairs that a cell may propose beside a spanning forest
SKETCH = 512           # bits of the parity sketch of a text's shingles


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = 3) -> DataFrame:
    """Per row: doc_id and ``fp``, a signed 64-bit number.

    A-Z are lower-cased; words are runs without ASCII white space; shingles are
    ``words`` words joined by spaces, repeats included. Fewer words make one
    shingle of them all; a null or empty text has the fingerprint 0.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        digest = xxhash.xxh64_digest
        lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
        for batch in text_slices(batches):
            values = np.zeros(batch.num_rows, dtype=">u8")
            for row, text in enumerate(batch.column(1).to_pylist()):
                found = text.encode().translate(lower).split()
                if not found:
                    continue
                shingles = (map(b" ".join, zip(*(found[i:] for i in range(words))))
                            if len(found) >= words else [b" ".join(found)])
                hashes = np.frombuffer(b"".join([digest(s, SEED) for s in shingles]), dtype=np.uint8)
                hashes, total = hashes.reshape(-1, 8), np.zeros(64, dtype=np.int64)
                for at in range(0, len(hashes), 65_536):
                    total += np.unpackbits(hashes[at:at + 65_536], axis=1).sum(axis=0, dtype=np.int64)
                values[row] = np.packbits(2 * total > len(hashes)).view(">u8")[0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values.astype(np.uint64).view(np.int64))], ["doc_id", "fp"])

    return id_and_text(docs, id_col, text_col).mapInArrow(compute, "doc_id long, fp long")


def distances(values: np.ndarray, point) -> np.ndarray:
    return np.bitwise_count(values ^ point).astype(np.int16)


def fit_tree(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and median distances, as a heap of 2**depth - 1 nodes."""
    points = np.zeros(2 ** depth - 1, dtype=np.uint64)
    medians = np.full(2 ** depth - 1, 64, dtype=np.int16)
    parts = {0: sample}
    for node in range(2 ** depth - 1):
        part = parts.pop(node, sample[:0])
        if not len(part):
            continue
        points[node] = part[0]
        away = distances(part, part[0])
        medians[node] = np.median(away)
        inside = away <= medians[node]
        parts[2 * node + 1], parts[2 * node + 2] = part[inside][::-1], part[~inside]
    return points, medians


def route(values: np.ndarray, points: np.ndarray, medians: np.ndarray, depth: int,
          most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into values, leaf, moved) of every place a fingerprint has to be.

    ``moved`` has a bit for each level where the place was reached out of the strip.
    Two fingerprints out of one strip meet on the outside, too; so any near pair
    has exactly one leaf where no bit is set for both.
    """
    index, node = np.arange(len(values)), np.zeros(len(values), dtype=np.int64)
    moved = np.zeros(len(values), dtype=np.int64)
    for level in range(depth):
        away, median = distances(values[index], points[node]), medians[node]
        outside = away > median
        strip = outside & (away <= median + most)
        child = 2 * node + 1 + outside
        index = np.concatenate([index, index[strip]])
        node = np.concatenate([child, 2 * node[strip] + 1])
        moved = np.concatenate([moved, moved[strip] | 1 << level])
    return index, node, moved


def near_pairs(values: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of distinct values at most ``most`` bits apart, block by block."""
    todo = [np.arange(len(values))]
    while todo:
        index = todo.pop()
        own = values[index]
        if len(index) > BLOCK:
            away = distances(own, own[len(own) // 2])
            median = int(np.median(away))
            inside, outside = index[away <= median + most], index[away > median]
            if len(inside) <= 0.9 * len(index):
                todo += [inside, outside]
                continue
        rows = max(1, min(256, PAIRS // max(1, len(index))))
        for at in range(0, len(index), rows):
            x, y = np.nonzero(np.bitwise_count(own[at:at + rows, None] ^ own[None, at:]) <= most)
            keep = x < y
            yield index[x[keep] + at], index[y[keep] + at]


def _forest(values: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs that connect the values as all near pairs do: fewer than there are values."""
    parent = np.arange(len(values))

    def roots(index: np.ndarray) -> np.ndarray:
        while True:
            above = parent[index]
            if np.array_equal(above, index):
                return index
            index = parent[above]

    first, second = [], []
    for x, y in near_pairs(values, most):
        order = np.argsort(np.bitwise_count(values[x] ^ values[y]), kind="stable")
        x, y = x[order], y[order]
        while len(x):
            a, b = roots(x), roots(y)
            open_ = a != b
            x, y, a, b = x[open_], y[open_], a[open_], b[open_]
            # The closest pair of each larger root hooks it to the smaller one.
            upper, at = np.unique(np.maximum(a, b), return_index=True)
            parent[upper] = np.minimum(a, b)[at]
            first.append(x[at])
            second.append(y[at])
    return (values[np.concatenate(first)], values[np.concatenate(second)]) if first else (values[:0], values[:0])


def block_keys(values: np.ndarray, block: int, most: int) -> np.ndarray:
    """The bits of one of ``most`` + 1 blocks."""
    low, high = 64 * block // (most + 1), 64 * (block + 1) // (most + 1)
    return values >> np.uint64(low) & np.uint64((1 << high - low) - 1)


def near_in_block(values: np.ndarray, block: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """As `near_pairs`, of the pairs that agree in this block and in none before it, with the smaller index first."""
    if not len(values):
        return

    def counted(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        differ = values[x] ^ values[y]
        keep = np.bitwise_count(differ) <= most
        for earlier in range(block):
            keep &= block_keys(differ, earlier, most) != 0
        return x[keep], y[keep]

    key = block_keys(values, block, most)
    order = np.argsort(key, kind="stable")
    key = key[order]
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(begin, len(key)))
    for at in np.flatnonzero(size > BLOCK):
        own = order[begin[at]:begin[at] + size[at]]
        for x, y in near_pairs(values[own], most):
            yield counted(own[x], own[y])
    # The others meet all that come behind them under their key.
    behind = np.repeat(begin + size, size) - np.arange(len(key)) - 1
    behind[np.repeat(size > BLOCK, size)] = 0
    total, at = np.cumsum(behind), 0
    while at < len(key):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, side="right")))
        n = behind[at:to]
        x = np.repeat(np.arange(at, to), n)
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
        yield counted(order[x], order[y])
        at = to


def placed_in_blocks(texts: DataFrame, most: int, shard_rows: int) -> DataFrame:
    """(view, moved, leaf, i, j, fp, node, sketch): any two texts that agree in a block of a view share a cell.

    ``moved`` is the block. A leaf holds the keys of a block with one remainder. A leaf
    with more than ``shard_rows`` rows, of a key that very many texts have, is cut into
    parts, and every pair of parts is a cell.
    """
    leaves = max(1, -(-texts.count() // (2 * LEAF)))

    def views(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(batch, view, block, values, leaf)"""
        for batch in batches:
            if not batch.num_rows:
                continue
            prints = batch.column(1).flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(batch.num_rows, -1)
            for view in range(prints.shape[1]):
                values = np.ascontiguousarray(prints[:, view])
                for block in range(most + 1):
                    mixed = block_keys(values, block, most) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
                    yield batch, view, block, values, (mixed % np.uint64(leaves)).astype(np.int64)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, int], np.ndarray] = {}
        for _, view, block, _, leaf in views(batches):
            counts[view, block] = counts.get((view, block), 0) + np.bincount(leaf, minlength=leaves)
        for at, n in counts.items():
            own = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(own), c, dtype=np.int32)) for c in at] + [pa.array(own), pa.array(n[own])],
                ["view", "moved", "leaf", "n"])

    given = texts.select(F.col("text_hash").alias("node"), "prints", "sketch")
    # One row per crowded leaf, of which there are fewer than rows / shard_rows.
    crowded: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for row in (given.select("node", "prints").mapInArrow(sizes, "view int, moved int, leaf long, n long")
                .groupBy("view", "moved", "leaf").agg(F.sum("n").alias("n")).filter(F.col("n") > shard_rows).collect()):
        crowded.setdefault((row["view"], row["moved"]), []).append((row["leaf"], -(-row["n"] // shard_rows)))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, view, block, values, leaf in views(batches):
            cut = np.ones(len(leaf), dtype=np.int64)
            for one, parts in crowded.get((view, block), []):
                cut[leaf == one] = parts
            node, sketch = batch.column(0), batch.column(2)
            own = (node.to_numpy(zero_copy_only=False).view(np.uint64) % cut.astype(np.uint64)).astype(np.int64)
            # A row of part p meets every part k in cell (min, max).
            at = np.repeat(np.arange(len(leaf)), cut)
            k = np.arange(len(at)) - np.repeat(np.cumsum(cut) - cut, cut)
            if len(at) > len(leaf):
                node, sketch = node.take(pa.array(at)), sketch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(np.full(len(at), c, dtype=np.int32)) for c in (view, block)), pa.array(leaf[at]),
                 pa.array(np.minimum(own[at], k)), pa.array(np.maximum(own[at], k)),
                 pa.array(values[at].view(np.int64)), node, sketch], [*CELL, "fp", "node", "sketch"])

    return given.mapInArrow(
        cells, "view int, moved int, leaf long, i long, j long, fp long, node long, sketch array<long>")


def placed_in_cells(nodes: DataFrame, most: int, shard_rows: int) -> DataFrame:
    """(view, fp, leaf, moved, i, j): any two rows of a view at most ``most`` bits apart share a cell."""
    count = nodes.groupBy("view").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    depth = max(0, min(MOST_LEAVES, -(-count // LEAF)) - 1).bit_length()
    step = max(1, count // (SAMPLE_PER_LEAF * 2 ** depth))
    sample = nodes.filter(F.pmod(F.xxhash64("fp"), F.lit(step)) == 0).select("view", "fp").toPandas()
    trees = {int(view): fit_tree(np.sort(part["fp"].to_numpy(np.int64).view(np.uint64)), depth)
             for view, part in sample.groupby("view")}
    # A view without a sample is small: all of it goes inside, to one shard.
    empty = fit_tree(np.zeros(0, dtype=np.uint64), depth)

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            views, values = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for view in np.unique(views):
                own = values[views == view]
                index, leaf, moved = route(own.view(np.uint64), *trees.get(int(view), empty), depth, most)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(index), view, dtype=np.int32)), pa.array(own[index]),
                     pa.array(leaf), pa.array(moved)], ["view", "fp", "leaf", "moved"])

    placed = nodes.select("view", "fp").mapInArrow(routed, "view int, fp long, leaf long, moved long")
    # One row per view and leaf that is too large, so at most MOST_LEAVES a view.
    parts = {(row["view"], row["leaf"]): -(-row["n"] // shard_rows)
             for row in placed.groupBy("view", "leaf").agg(F.count("*").alias("n"))
             .filter(F.col("n") > shard_rows).collect()}

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            views, values, leaves, moved = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            cut = np.array([parts.get(key, 1) for key in zip(views.tolist(), leaves.tolist())], dtype=np.int64)
            own = (values.view(np.uint64) % cut.astype(np.uint64)).astype(np.int64)
            # A row of part p meets every part k in cell (min, max).
            at = np.repeat(np.arange(len(views)), cut)
            k = np.arange(len(at)) - np.repeat(np.cumsum(cut) - cut, cut)
            yield pa.RecordBatch.from_arrays(
                [pa.array(views[at]), pa.array(values[at]), pa.array(leaves[at]), pa.array(moved[at]),
                 pa.array(np.minimum(own[at], k)), pa.array(np.maximum(own[at], k))],
                ["view", "fp", "leaf", "moved", "i", "j"])

    return placed.mapInArrow(cells, "view int, fp long, leaf long, moved long, i long, j long")


def links(nodes: DataFrame, most: int = 3, shard_rows: int = 65_536) -> DataFrame:
    """Links (view, a, b) between the distinct fingerprints (view, fp) of a view.

    Every link is a pair at most ``most`` bits apart, and the links connect
    exactly the fingerprints that all such pairs connect.
    """

    def linked(pdf: pd.DataFrame) -> pd.DataFrame:
        values = np.sort(pdf["fp"].to_numpy(np.int64)).view(np.uint64)
        a, b = _forest(values, most)
        return pd.DataFrame({"view": pdf["view"].iloc[0], "a": a.view(np.int64), "b": b.view(np.int64)})

    return placed_in_cells(nodes, most, shard_rows).drop("moved").groupBy("view", "leaf", "i", "j").applyInPandas(
        linked, "view int, a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                    most: int = 3) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id, n_same.

    Fingerprints at most ``most`` bits apart are linked; component_id is the
    smallest doc_id reached, the own one included. n_same counts the rows with
    the same fingerprint. Rows with a null id take part and get the component of
    their fingerprint; a component without any id is null. Null and empty texts
    share the fingerprint 0. Repeated rows are returned each. Other columns are
    not looked at.
    """
    prints = checkpointed(fingerprints(docs, id_col, text_col, words))
    nodes = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n_same")))
    roots = components(links(nodes.withColumn("view", F.lit(0)), most))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "n_same", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(smallest, "root").select("fp", "n_same", "component_id")
    return prints.join(classes, "fp").select("doc_id", hex64(F.col("fp")).alias("fingerprint"),
                                             "component_id", "n_same")


LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_set(found: list[bytes], words: int) -> set[bytes]:
    if len(found) < words:
        return {b" ".join(found)}
    return set(map(b" ".join, zip(*(found[i:] for i in range(words)))))


def views_of(docs: DataFrame, id_col: str, text_col: str, views: int, words: int) -> DataFrame:
    """Per row: doc_id, text_hash, the fingerprints of the set of words under several seeds, and a sketch.

    The sketch is the number of distinct shingles and, per bit, the parity of those that hash to it.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        digest, number = xxhash.xxh3_128_digest, xxhash.xxh3_64_intdigest
        for batch in text_slices(batches):
            values = np.zeros((batch.num_rows, views), dtype=np.int64)
            sketches = np.zeros((batch.num_rows, 1 + SKETCH // 64), dtype=np.int64)
            for row, text in enumerate(batch.column(2).to_pylist()):
                in_order = text.encode().translate(LOWER).split()
                shingles = shingle_set(in_order, words)
                bits = np.fromiter(map(number, shingles), dtype=np.uint64, count=len(shingles)) % np.uint64(SKETCH)
                sketches[row, 0] = len(shingles)
                sketches[row, 1:] = np.packbits(np.bincount(bits.astype(np.int64), minlength=SKETCH) & 1).view(np.int64)
                distinct = list(set(in_order))
                total = np.zeros(views * 64, dtype=np.int64)
                for at in range(0, len(distinct), 16_384):
                    part = distinct[at:at + 16_384]
                    hashes = [np.frombuffer(b"".join([digest(w, seed) for w in part]), dtype=np.uint8).reshape(-1, 16)
                              for seed in range(-(-views // 2))]
                    bits = np.concatenate(hashes, axis=1)[:, :views * 8]
                    total += np.unpackbits(bits, axis=1).sum(axis=0, dtype=np.int64)
                values[row] = np.packbits(2 * total > len(distinct)).view(">u8").astype(np.uint64).view(np.int64)
            lists = [pa.ListArray.from_arrays(
                pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))
                for rows in (values, sketches)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists],
                                             ["doc_id", "text_hash", "prints", "sketch"])

    return id_and_text(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        compute, "doc_id long, text_hash long, prints array<long>, sketch array<long>")


def shingle_similarity(pairs: DataFrame, words: int) -> DataFrame:
    """(a, b, similarity) for rows a, b, text_a, text_b: Jaccard of the sets of word shingles."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            out = []
            for one, two in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = (shingle_set(t.encode().translate(LOWER).split(), words) for t in (one, two))
                both = len(x & y)
                out.append(both / (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())],
                                             ["a", "b", "similarity"])

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(compute, "a long, b long, similarity double")


CELL = ["view", "moved", "leaf", "i", "j"]


def may_be_copies(size_x: np.ndarray, size_y: np.ndarray, bits_x: np.ndarray, bits_y: np.ndarray,
                  similarity: float) -> np.ndarray:
    """Whether sketches allow pairs of shingle sets to be so similar.

    Sets of m and n shingles with d in only one of them: similarity (m + n - d) / (m + n + d).
    d is no less than the difference of the sizes, nor than that of the parities.
    """
    least = np.maximum(np.abs(size_x - size_y), np.bitwise_count(bits_x ^ bits_y).sum(axis=1, dtype=np.int64))
    return least * (1 + similarity) <= (size_x + size_y) * (1 - similarity) + 1e-6


def _sketches(members: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of shingles, and parities."""
    sketch = np.stack(members["sketch"].to_numpy()).astype(np.int64)
    return sketch[:, 0], sketch[:, 1:].copy().view(np.uint64)


def _touched(members: pd.DataFrame, most: int, similarity: float) -> np.ndarray:
    """Which rows of a cell are in a pair that is near, counts here and may be copies by the sketches."""
    size, bits = _sketches(members)
    open_ = np.zeros(len(members), dtype=bool)
    values, block = members["fp"].to_numpy(np.int64).view(np.uint64), int(members["moved"].iloc[0])
    for all_x, all_y in near_in_block(values, block, most):
        for at in range(0, len(all_x), PAIRS // 16):
            x, y = all_x[at:at + PAIRS // 16], all_y[at:at + PAIRS // 16]
            asked = ~(open_[x] & open_[y])
            x, y = x[asked], y[asked]
            may = may_be_copies(size[x], size[y], bits[x], bits[y], similarity)
            open_[x[may]] = open_[y[may]] = True
    return open_


def _plausible(members: pd.DataFrame, done: pd.DataFrame, most: int, similarity: float,
               room: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a cell that may be copies, between texts not known to be connected nor measured before.

    A spanning forest of all such pairs, and ``room`` pairs beside it.
    """
    members = members.sort_values("node")
    node, values = members["node"].to_numpy(np.int64), members["fp"].to_numpy(np.int64).view(np.uint64)
    root, own = np.unique(members["root"].to_numpy(np.int64), return_inverse=True)
    if len(root) < 2:
        return node[:0], node[:0]
    (size, bits), block = _sketches(members), int(members["moved"].iloc[0])
    known = (np.searchsorted(node, done["a"].to_numpy(np.int64)) * len(node)
             + np.searchsorted(node, done["b"].to_numpy(np.int64)))
    parent = np.arange(len(root))

    def roots(index: np.ndarray) -> np.ndarray:
        while True:
            above = parent[index]
            if np.array_equal(above, index):
                return index
            index = parent[above]

    first, second = [node[:0]], [node[:0]]
    for all_x, all_y in near_in_block(values, block, most):
        for at in range(0, len(all_x), PAIRS // 16):
            x, y = all_x[at:at + PAIRS // 16], all_y[at:at + PAIRS // 16]
            open_ = own[x] != own[y] if room > 0 else roots(own[x]) != roots(own[y])
            x, y = x[open_], y[open_]
            open_ = may_be_copies(size[x], size[y], bits[x], bits[y], similarity)
            open_ &= ~np.isin(x * len(node) + y, known)
            x, y = x[open_], y[open_]
            if room > 0:
                first.append(node[x[:room]])
                second.append(node[y[:room]])
                room -= len(x)
            while len(x):
                a, b = roots(own[x]), roots(own[y])
                open_ = a != b
                x, y, a, b = x[open_], y[open_], a[open_], b[open_]
                upper, take = np.unique(np.maximum(a, b), return_index=True)
                parent[upper] = np.minimum(a, b)[take]
                first.append(node[x[take]])
                second.append(node[y[take]])
    return np.concatenate(first), np.concatenate(second)


def copies(texts: DataFrame, shown: DataFrame, most: int, words: int, similarity: float,
           shard_rows: int = 16_384) -> DataFrame:
    """(node, root) of the texts that pairs near in a view and similar enough connect.

    ``texts`` has text_hash, prints and sketch once per text, ``shown`` node and
    text. In rounds: every cell proposes a spanning forest of the pairs that are
    near, may be similar by their sketches and are neither measured nor connected
    so far; they are measured, and the similar ones connect. It ends when no cell
    has such a pair. Later rounds propose ever more pairs, so that the rounds stay
    few where many texts look alike and are not.
    """
    spark = texts.sparkSession
    texts = checkpointed(texts)

    def touched(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf[_touched(pdf, most, similarity)]

    # Near fingerprints are ever more common the more texts there are; pairs that may be
    # copies, each in one block, are not.
    cells = placed_in_blocks(texts, most, shard_rows)
    cells = checkpointed(cells.groupBy(*CELL).applyInPandas(touched, cells.schema))
    roots = spark.createDataFrame([], "node long, root long")
    proposed = spark.createDataFrame([], "view int, moved int, leaf long, i long, j long, a long, b long")
    measured = spark.createDataFrame([], "a long, b long, similarity double")
    turn = 0
    while True:
        def propose(members: pd.DataFrame, done: pd.DataFrame, turn: int = turn) -> pd.DataFrame:
            a, b = _plausible(members, done, most, similarity,
                              min(MOST_ROOM, len(members) * 4 ** min(turn, 11)) if turn else 0)
            return pd.DataFrame({c: members[c].iloc[0] for c in CELL} | {"a": a, "b": b}, index=range(len(a)))

        now = cells.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        found = checkpointed(now.groupBy(*CELL).cogroup(proposed.groupBy(*CELL)).applyInPandas(
            lambda members, done: propose(members, done) if len(members) else done, proposed.schema))
        if found.isEmpty():
            return roots
        new = checkpointed(found.select("a", "b").distinct().join(measured, ["a", "b"], "left_anti"))
        wanted = new.select(F.col("a").alias("node")).union(new.select("b")).distinct()
        own = shown.join(wanted, "node", "left_semi").dropDuplicates(["node"])
        pairs = new.join(own.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
            own.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        measured = checkpointed(measured.unionByName(shingle_similarity(pairs, words)))
        proposed = proposed.unionByName(found)
        roots = components(measured.filter(F.col("similarity") >= similarity).select("a", "b"))
        turn += 1


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", views: int = 8,
                     most: int = 3, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs``, with all columns, of which one of each group of near copies stays.

    Texts are linked when their sets of ``words``-word shingles have a Jaccard
    similarity of at least ``similarity``; equal texts always are. Candidates are
    all pairs with a fingerprint at most ``most`` bits apart in one of the views. Of a
    group the smallest id stays; a null id stays only where there is no other.
    Rows equal in id and text are one document and share its fate. Null and empty
    texts are equal. An empty table stays empty.
    """
    rows = checkpointed(views_of(docs, id_col, text_col, views, words))
    texts = rows.groupBy("text_hash").agg(F.min("prints").alias("prints"), F.min("sketch").alias("sketch"))
    shown = id_and_text(docs, id_col, text_col).select(F.xxhash64("text").alias("node"), "text")
    roots = copies(texts, shown, most, words, similarity)
    group = rows.select("doc_id", "text_hash").join(
        roots, F.col("text_hash") == F.col("node"), "left").select(
        "doc_id", "text_hash", F.coalesce("root", "text_hash").alias("root"))
    stays = group.groupBy("root").agg(F.min("doc_id").alias("stays"), F.count("*").alias("n")).filter("n > 1")
    gone = group.join(stays, "root").filter(~F.col("doc_id").eqNullSafe(F.col("stays"))).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.join(gone, F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("__id"))
                     & (F.xxhash64(text) == F.col("__hash")), "left_anti")
