"""Substring dedup: content-defined chunks by a gear rolling hash, deduplicated by digest.

A gear hash over the last 16 bytes ends a chunk where its top five bits are zero,
32 bytes apart on average, so borders depend on nearby bytes alone and an
insertion shifts no border beyond it. Chunks of at least ``least_chunk`` bytes are
keyed by a 64-bit digest; digests that several documents have point to their
first document, the one with the smallest id, and to the place there. Chunks of a
document that agree in first document and shift form a candidate. Each candidate
is then compared byte by byte with the first document's text, so a passage is
removed only if it really stands there, with its exact ends, and only if it has
at least ``least_words`` whole words. The first document keeps it.

Chunks of one passage may have different first documents, none of which has the
whole passage. So windows of ``least_words`` whole words are looked up, too, each
with its own first document, wherever every chunk inside the window stands in
another document: a window that an earlier document has, too, cannot be without
that. The windows of a passage cover it, whatever documents had its parts before.
A window that a document repeats, as in a text of few words over and over, is looked
up once a document; where it was found, the text's own repeats of it go, too.

A shared passage meets the texts of later documents one to one: no pairs among
later documents, and rows by digest are combined in the tasks before they move.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ticktide.llm.tables import text_slices

WINDOW, TOP_BITS, MOST = 16, 5, 128
MARGIN = 4 * MOST
SHIFT = 1 << 32
# One pseudo-random number per byte value, from a rule: powers of an odd constant.
GEAR = np.array([pow(0x9E3779B97F4A7C15, b + 3, 1 << 64) >> 40 & 0xFFFF for b in range(256)], dtype=np.uint16)
SPACES = b" \t\n\x0b\x0c\r"


def borders(data: np.ndarray, ends: np.ndarray | None) -> np.ndarray:
    """Ends of all chunks of texts that lie one behind the other; ``ends`` are the ends of the texts.

    Without ``ends`` only those that the bytes of the window before them decide.
    """
    value = GEAR[data]
    width = 1
    while width < WINDOW:
        # Sum of the last 2 * width bytes from that of the last width.
        older = np.zeros_like(value)
        older[width:] = value[:-width] << width
        value = value + older
        width *= 2
    cuts = np.flatnonzero(value < (1 << (16 - TOP_BITS))) + 1
    if ends is None:
        return cuts
    cuts = np.union1d(cuts, ends[ends > 0])
    begin = np.concatenate([[0], cuts[:-1]])
    # A stretch without a border, such as one word over and over, is cut at the
    # least hash in the second half of the longest chunk: the content decides
    # there, too, so that stretches of any length and shift give equal chunks.
    open_ = cuts - begin > MOST
    begin, end, extra = begin[open_], cuts[open_], []
    reach = np.arange(MOST // 2, MOST)
    while len(begin):
        begin = begin + MOST // 2 + value[begin[:, None] + reach].argmin(axis=1) + 1
        extra.append(begin)
        open_ = end - begin > MOST
        begin, end = begin[open_], end[open_]
    return np.union1d(cuts, np.concatenate(extra)) if extra else cuts


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chunk: int = 16) -> DataFrame:
    """(digest, doc_id, start, size) of every chunk that is long enough; rows without an id have none."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        digest = xxhash.xxh3_64_intdigest
        for batch in text_slices(batches):
            texts = [t.encode() for t in batch.column(1).to_pylist()]
            whole, ends = b"".join(texts), np.cumsum([len(t) for t in texts], dtype=np.int64)
            data = np.frombuffer(whole, dtype=np.uint8)
            if not len(data):
                continue
            stop = borders(data, ends)
            start = np.concatenate([[0], stop[:-1]])
            keep = stop - start >= least_chunk
            start, stop = start[keep], stop[keep]
            row = np.searchsorted(ends, start, side="right")
            ids = batch.column(0).to_numpy(zero_copy_only=False)[row]
            own = start - (ends - np.array([len(t) for t in texts]))[row]
            digests = np.fromiter((digest(whole[a:b]) for a, b in zip(start.tolist(), stop.tolist())),
                                  dtype=np.uint64, count=len(start))
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests.view(np.int64)), pa.array(ids, pa.int64()), pa.array(own, pa.int64()),
                 pa.array((stop - start).astype(np.int32))], ["digest", "doc_id", "start", "size"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.filter(F.col("doc_id").isNotNull() & (F.col("text") != "")).mapInArrow(
        cut, "digest long, doc_id long, start long, size int")


def _firsts(pieces: DataFrame) -> DataFrame:
    """(digest, first, first_start, last): first document of every digest, the place there, and the last document."""
    # One sortable number for (document, place) keeps this a hash aggregate.
    place = F.col("doc_id").cast("decimal(20,0)") * SHIFT + F.col("start")
    firsts = pieces.groupBy("digest").agg(F.min(place).alias("place"), F.max("doc_id").alias("last"))
    start = F.pmod("place", F.lit(SHIFT))
    return firsts.select("digest", "last", start.cast("long").alias("first_start"),
                         F.expr(f"CAST((place - pmod(place, {SHIFT})) / {SHIFT} AS long)").alias("first"))


def _with_firsts(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """``rows`` with the first document of their digest.

    A line in a third of all texts is one digest. Joined by another form of the
    digest than the one they were summed by, the first documents get a shuffle of
    their own, and then Spark may split a hot partition of ``rows``.
    """
    other = firsts.withColumn("form", F.bitwise_not("digest")).drop("digest")
    return rows.withColumn("form", F.bitwise_not("digest")).join(other, "form").drop("form")


def shared_chunks(pieces: DataFrame) -> DataFrame:
    """The chunks that several documents have, with first, first_start and last."""
    return _with_firsts(pieces, _firsts(pieces).filter(F.col("first") < F.col("last")))


def candidates(shared: DataFrame, least_bytes: int = 48) -> DataFrame:
    """(doc_id, first, shift, low, high): a stretch of a document that its first document may have, too."""
    later = shared.filter(F.col("doc_id") > F.col("first"))
    return (later.groupBy("doc_id", "first", (F.col("first_start") - F.col("start")).alias("shift"))
            .agg(F.sum("size").alias("n"), F.min("start").alias("low"), F.max(F.col("start") + F.col("size")).alias("high"))
            .filter(F.col("n") >= least_bytes).drop("n"))


def _word_windows(data: bytes, least_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of all windows of ``least_words`` whole words."""
    text = np.frombuffer(data, dtype=np.uint8)
    inner = np.concatenate([[False], ~np.isin(text, np.frombuffer(SPACES, dtype=np.uint8)), [False]])
    edges = np.flatnonzero(inner[1:] != inner[:-1])
    start, end = edges[::2], edges[1::2]
    return start[:max(0, len(start) - least_words + 1)], end[least_words - 1:]


def _open_windows(data: bytes, keys: np.ndarray, least_words: int, least_chunk: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the windows of a text that other texts may have.

    ``keys`` has start * 2 * MOST + size of the chunks that other documents have. Only
    chunks whose borders depend on the window's own bytes count against it.
    """
    start, end = _word_windows(data, least_words)
    if not len(start):
        return start, end
    cuts = borders(np.frombuffer(data, dtype=np.uint8), None)
    low, high = cuts[:-1], cuts[1:]
    plain = (low >= WINDOW) & (high - low >= least_chunk) & (high - low <= MOST)
    low, high = low[plain], high[plain]
    against = ~np.isin(low * (2 * MOST) + (high - low), keys)
    begins, ends = low[against], np.append(high[against], len(data) + 1)
    open_ = ends[np.searchsorted(begins, start + WINDOW)] >= end
    return start[open_], end[open_]


def windows(dealt: DataFrame, shared: DataFrame, grouped: DataFrame, least_words: int, least_chunk: int,
            source: bool) -> DataFrame:
    """(digest, doc_id, start, size) of the windows that an earlier document, or as ``source`` a later one, may have.

    ``grouped`` has the stretches that chunks propose. A window inside a passage found
    by them is cut anyway, and the document that has it first is its source. Of equal
    windows of a document there is the first.
    """
    flags = (F.col("first") < F.col("doc_id")).cast("int") + 2 * (F.col("last") > F.col("doc_id")).cast("int")
    # One number per chunk: place, size up to 2 * MOST, flags.
    lists = shared.groupBy("doc_id").agg(
        F.collect_list((F.col("start") * (2 * MOST) + F.col("size")) * 4 + flags).alias("chunks"))

    flag = 2 if source else 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        digest = xxhash.xxh3_64_intdigest
        for batch in text_slices(batches, 64):
            ids, parts = batch.column(0).to_pylist(), []
            for doc_id, text, own, near in zip(ids, batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                data = text.encode()
                codes = np.array(own.as_py() or [], dtype=np.int64)
                start, end = _open_windows(data, codes[codes & flag > 0] >> 2, least_words, least_chunk)
                for low, high, _ in _passages(data, near.as_py(), least_words) if near.is_valid and len(start) else []:
                    # At the ends the other document's words may go on: a source stays there.
                    open_ = (start <= low) | (end >= high) if source else (start < low) | (end > high)
                    start, end = start[open_], end[open_]
                keys = np.fromiter((digest(data[a:b]) for a, b in zip(start.tolist(), end.tolist())),
                                   dtype=np.uint64, count=len(start))
                keys, at = np.unique(keys, return_index=True)
                start, end = start[at], end[at]
                parts.append((keys.view(np.int64), np.full(len(start), doc_id, dtype=np.int64), start.astype(np.int64),
                              (end - start).astype(np.int32)))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)],
                                                 ["digest", "doc_id", "start", "size"])

    joined = dealt.select("doc_id", "text").join(lists, "doc_id", "left").join(grouped, "doc_id", "left")
    return joined.select("doc_id", "text", "chunks", "found").mapInArrow(
        cut, "digest long, doc_id long, start long, size int")


def window_candidates(queries: DataFrame, sources: DataFrame) -> DataFrame:
    """As `candidates`, from windows: those of one shift may leave gaps, which the comparison sees."""
    later = queries.join(_firsts(sources).drop("last"), "digest")
    return later.filter(F.col("doc_id") > F.col("first")).groupBy(
        "doc_id", "first", (F.col("first_start") - F.col("start")).alias("shift")).agg(
        F.min("start").alias("low"), F.max(F.col("start") + F.col("size")).alias("high"))


def _passages(data: bytes, found: list[dict], least_words: int) -> list[tuple[int, int, int]]:
    """(start, end, first document) of whole words that stand in a first document, too."""
    text, spans = np.frombuffer(data, dtype=np.uint8), []
    for item in found:
        at, other = item["at"], np.frombuffer(item["bytes"], dtype=np.uint8)
        own = text[at:at + len(other)]
        same = np.concatenate([[False], own == other[:len(own)], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1]) + at
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start < 2 * least_words - 1:
                continue
            # Words cut by the ends do not belong to the passage.
            if start and data[start - 1] not in SPACES:
                while start < end and data[start] not in SPACES:
                    start += 1
            if end < len(data) and data[end] not in SPACES:
                while end > start and data[end - 1] not in SPACES:
                    end -= 1
            # White space on either side stays, to part the words around the cut.
            start = end - len(data[start:end].lstrip(SPACES))
            end = start + len(data[start:end].rstrip(SPACES))
            if len(data[start:end].split()) >= least_words:
                spans.append((start, end, item["first"]))
    return sorted(spans)


def _repeats(data: bytes, passages: list[tuple[int, int, int]], least_words: int) -> list[tuple[int, int, int]]:
    """As `_passages`, the windows outside of these passages that equal one inside."""
    import xxhash
    starts, ends = _word_windows(data, least_words)
    source, known, others = np.full(len(starts), -1), {}, []
    for at, (low, high, _) in enumerate(passages):
        source[(starts >= low) & (ends <= high)] = at
    keys = [xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
    for key, start, end, at in zip(keys, starts.tolist(), ends.tolist(), source.tolist()):
        if at >= 0:
            known.setdefault(key, (data[start:end], passages[at][2]))
        else:
            others.append((key, start, end))
    return [(start, end, known[key][1]) for key, start, end in others
            if key in known and known[key][0] == data[start:end]]


def _cut(docs: DataFrame, id_col: str, text_col: str, least_words: int, least_chunk: int) -> DataFrame:
    """Per row: doc_id, the kept text, what was removed, and ``row``, a struct of any other columns."""
    others = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")]
    # An id that needs no cast and no name stays a plain column: only then Spark sees
    # that the two joins below read the same shuffle.
    plain = id_col == "doc_id" and docs.schema[id_col].dataType == T.LongType()
    rows = docs.select(F.col("doc_id") if plain else F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                       *(others if len(docs.columns) > 2 else []))
    shared = shared_chunks(chunks(docs, id_col, text_col, least_chunk))
    # Texts are dealt by id once for all joins: for windows, as first documents, and as those to be cut.
    dealt = rows.filter(F.col("doc_id").isNotNull()).repartition("doc_id")
    firsts = dealt.select(F.col("doc_id").alias("first"), F.col("text").cast("binary").alias("bytes"))

    def shown(near: DataFrame) -> DataFrame:
        """(doc_id, found): the bytes of the first documents at the proposed places."""
        begin = F.greatest(F.lit(0), F.col("low") + F.col("shift") - MARGIN, F.col("shift"))
        items = near.join(firsts, "first").select(
            "doc_id", F.struct(
                "first", (begin - F.col("shift")).alias("at"),
                F.substring("bytes", (begin + 1).cast("int"),
                            (F.col("high") + F.col("shift") + MARGIN - begin).cast("int")).alias("bytes")).alias("item"))
        return items.groupBy("doc_id").agg(F.collect_list("item").alias("found"))

    by_chunks = shown(candidates(shared))
    by_windows = shown(window_candidates(*(
        windows(dealt, shared, by_chunks, least_words, least_chunk, source) for source in (False, True))))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["text", "n_spans", "n_removed", "spans", "firsts"]
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]
        for batch in text_slices(batches):
            out = []
            for text, *found in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                data = text.encode()
                near, more = (_passages(data, items, least_words) if items else [] for items in found)
                passages = sorted(near + more + (_repeats(data, more, least_words) if more else []))
                spans: list[list[int]] = []
                for start, end, _ in passages:
                    if spans and start <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], end)
                    else:
                        spans.append([start, end])
                kept, written, at, points = [], [], 0, 0
                for start, end in spans:
                    kept.append(data[at:start])
                    points += len(kept[-1].decode())
                    removed = len(data[start:end].decode())
                    written.append((points, points + removed))
                    points, at = points + removed, end
                kept.append(data[at:])
                out.append((b"".join(kept).decode(), len(spans), sum(b - a for a, b in written),
                            ",".join(f"{a}:{b}" for a, b in written), sorted({f for _, _, f in passages})))
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types)), *batch.columns[4:]],
                ["doc_id", *names, *batch.schema.names[4:]])

    joined = dealt.join(by_chunks, "doc_id", "left").join(
        by_windows.withColumnRenamed("found", "more"), "doc_id", "left").unionByName(
        rows.filter(F.col("doc_id").isNull()), allowMissingColumns=True)
    joined = joined.select("doc_id", "text", "found", "more", *rows.columns[2:])
    schema = T.StructType(T.StructType.fromDDL(
        "doc_id long, text string, n_spans long, n_removed long, spans string, firsts array<long>").fields
        + rows.schema.fields[2:])
    return joined.mapInArrow(remove, schema)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 50,
                least_chunk: int = 16) -> DataFrame:
    """Per row: doc_id, text (what is kept), n_spans, n_removed, spans, firsts.

    ``spans`` are ``start:end`` in code points of the given text, joined by
    commas; n_removed counts their code points, and ``firsts`` lists the documents
    that keep the passages. Only repeats across documents count, and of equal
    passages that of the smallest id stays: a run of ``least_words`` words goes
    wherever an earlier document has it as whole words. Rows that share an id count as one
    document. A null text is empty; rows with a null id and empty texts are
    returned as they are. Other columns are not looked at.
    """
    return _cut(docs.select(f"`{id_col}`", f"`{text_col}`"), id_col, text_col, least_words, least_chunk)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 50,
                   least_chunk: int = 16) -> DataFrame:
    """``docs`` with the same columns and the repeats cut out of the texts.

    A document of which no word is left goes; one without any repeat stays as it
    is, a null text among them.
    """
    cut = _cut(docs, id_col, text_col, least_words, least_chunk)
    left = cut.filter((F.col("n_spans") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    whole = len(docs.columns) > 2
    return left.select(*[F.col("text").alias(c) if c == text_col else
                         F.col(f"row.`{c}`" if whole else "doc_id").alias(c) for c in docs.columns])
