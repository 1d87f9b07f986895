"""Token counts: pieces are counted once per distinct pre-token.

A text is cut before each run of spaces or line feeds that follows a character
which is no white space. The vocabulary's own splitting never joins such a
character with white space after it and looks at nothing before a run, so every
cut is one of its own borders and each pre-token has the same ids alone as in
its text.

Two passes over the texts. The first finds the common pre-tokens: those that a
task met in several documents, ranked by documents, at most ``head_size`` of
them. Their pieces are counted once, and the table, whose size has that bound,
goes to every task. The second pass makes the frequencies of each document,
joins the common ones with that table in place and sends the rest, row by row,
to where all rows of a pre-token meet in order: there its pieces are counted
once and joined to each row. What returns to a document are numbers, summed
with those of its common pre-tokens; no ids of documents come into being.

Every pre-token with a noticeable share of the rows is a common one, so no
partition of the second pass has a hot key. Which ones are common changes where
they are counted, never the counts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ticktide.llm.bytepair import encoder
from ticktide.llm.tables import id_and_text, text_slices

PRE_TOKEN = r"[ \n]*[^ \n]+(?:(?<=\s)[ \n]+[^ \n]*)*|[ \n]+"
LONG = 64  # pre-tokens of more characters stand in the common table by their digest
STEPS = 8  # ranks of document counts per power of two


def _entry(piece: str) -> str | bytes:
    return piece if len(piece) <= LONG else xxhash.xxh3_128_digest(piece.encode())


def common_pre_tokens(texts: DataFrame, head_size: int, folder: str | None,
                      table_limit: int) -> dict[str | bytes, int]:
    """Pieces of the pre-tokens that most documents have, at most ``head_size``.

    A task forgets what it has seen in one document only when its table is full
    or it ends, so no frequent pre-token is missed. The driver gets the numbers of
    pre-tokens by rank (some hundred) and the table itself.
    """

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, documents = re.compile(PRE_TOKEN).findall, Counter()

        def flushed() -> pa.RecordBatch:
            several = {piece: n for piece, n in documents.items() if n > 1}
            documents.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(several.keys(), pa.string()), pa.array(several.values(), pa.int64())],
                ["piece", "documents"])

        for batch in text_slices(batches):
            for text in batch.column(1).to_pylist():
                documents.update(set(split(text)))
                if len(documents) > table_limit:
                    yield flushed()
        yield flushed()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = encoder(folder)
        for batch in batches:
            pieces = batch.column(0).to_pylist()
            entries = [_entry(piece) for piece in pieces]
            yield pa.RecordBatch.from_arrays(
                [pa.array([e if isinstance(e, str) else None for e in entries], pa.string()),
                 pa.array([e if isinstance(e, bytes) else None for e in entries], pa.binary()),
                 pa.array([len(ids(piece)) for piece in pieces], pa.int64())],
                ["piece", "digest", "pieces"])

    found = (texts.mapInArrow(seen, "piece string, documents long")
             .groupBy("piece").agg(F.sum("documents").alias("documents"))
             .withColumn("rank", F.floor(F.log2("documents") * STEPS))).persist()
    try:
        lowest, taken = None, 0
        for rank, n in sorted(found.groupBy("rank").count().collect(), reverse=True):
            if taken + n > head_size:
                break
            lowest, taken = rank, taken + n
        if lowest is None:
            return {}
        table = (found.where(F.col("rank") >= lowest).select("piece")
                 .mapInArrow(count, "piece string, digest binary, pieces long").toArrow())
    finally:
        found.unpersist()
    names, digests, pieces = (column.to_pylist() for column in table.columns)
    return {digest if name is None else name: n for name, digest, n in zip(names, digests, pieces)}


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024, folder: str | None = None, head_size: int = 262_144,
                 table_limit: int = 400_000) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit, n_pre_tokens, n_distinct.

    A null or empty text has 0 bytes and 0 tokens. Repeated rows are counted
    each, a null id stays null, other columns are not looked at.

    Rows equal in id and text are one document on the way and as many rows again
    at its end. An id and a 64-bit hash of the text tell documents apart; for rows
    without an id a second hash stands for it.
    """
    texts = id_and_text(docs, id_col, text_col)
    common = texts.sparkSession.sparkContext.broadcast(
        common_pre_tokens(texts, head_size, folder, table_limit))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, known = re.compile(PRE_TOKEN).findall, common.value.get
        for batch in text_slices(batches):
            rows = []
            for doc_id, text, own, mark in zip(*(column.to_pylist() for column in batch.columns)):
                frequency, tokens = Counter(split(text)), 0
                for piece, n in frequency.items():
                    pieces = known(_entry(piece))
                    if pieces is None:
                        rows.append((own, mark, piece, n, None, None, None, None))
                    else:
                        tokens += n * pieces
                rows.append((own, mark, None, tokens, doc_id, len(text.encode()),
                             frequency.total(), len(frequency)))
            columns = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.string() if at == 2 else pa.int64()) for at, column in enumerate(columns)],
                ["own", "mark", "piece", "n", "doc_id", "n_bytes", "n_pre_tokens", "n_distinct"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, last, pieces = encoder(folder), None, 1
        for batch in batches:
            tokens = []
            for piece, n in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if piece != last:
                    last, pieces = piece, len(ids(piece))
                tokens.append(n * pieces)
            yield batch.set_column(3, "n", pa.array(tokens, pa.int64()))

    fields = ("own long, mark long, piece string, n long, doc_id long, n_bytes long, "
              "n_pre_tokens long, n_distinct long")
    marked = texts.select("doc_id", "text",
                          F.coalesce("doc_id", F.xxhash64(F.lit("no id"), "text")).alias("own"),
                          F.xxhash64("text").alias("mark"))
    # A document's own row has no piece: it comes first in order and keeps its number.
    met = (marked.mapInArrow(frequencies, fields)
           .repartition(F.when(F.col("piece").isNull(), F.xxhash64("own", "mark")).otherwise(F.xxhash64("piece")))
           .sortWithinPartitions(F.asc_nulls_first("piece")))
    sums = (met.mapInArrow(count, fields).groupBy("own", "mark")
            .agg(F.sum("n").alias("tokens"), F.count("n_bytes").alias("copies"),
                 *[F.max(c).alias(c) for c in ("doc_id", "n_bytes", "n_pre_tokens", "n_distinct")]))
    tokens = F.expr("tokens div copies")
    return (sums.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select("doc_id", "n_bytes", tokens.alias("n_tokens"), (tokens > limit).alias("over_limit"),
                    "n_pre_tokens", "n_distinct"))
