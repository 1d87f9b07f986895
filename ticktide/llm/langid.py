"""Language identification by prediction with partial matching.

Training: for each language, a sample of whole texts, chosen by hash and bounded
by ``sample_docs`` in expectation, gives the counts of every byte after each
context of up to ``order`` bytes. Contexts seen often enough form one tree for
all languages, at most ``nodes`` of them. In a language, a byte seen c times in a
context of T bytes, D of them distinct, has the probability c / (T + D); the
escape D / (T + D) goes to the bytes not seen there, in the proportions of the
next shorter context, down to the uniform distribution. These are proper
distributions, frozen into a table of code lengths by context, byte and language.

Prediction: the contexts are the states of an automaton, so the code lengths of a
text in all languages are sums of table rows along its bytes. A state depends on
the last ``order`` bytes only; texts are cut into segments that start with so many
bytes of run-up, and all segments of a batch advance together. The lengths are
those of whole texts.

The table has nodes x bytes x languages entries; ``table_mb`` bounds it, and more
languages get fewer nodes. It does not grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


SEGMENT, BYTES_AT_ONCE = 1024, 4 << 20
HASHES = 1 << 24


@dataclass
class Model:
    languages: list[str]
    order: int
    symbol: np.ndarray      # byte -> column of the tables
    following: np.ndarray   # (state, symbol) -> state
    bits: np.ndarray        # (state * symbols + symbol, language)


def _grams(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct byte strings of a length, as big-endian numbers, and their counts."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.uint64)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(data))
    codes = np.zeros(max(0, len(data) - length + 1), dtype=np.uint64)
    for i in range(length):
        codes = (codes << np.uint64(8)) | data[i:len(data) - length + 1 + i]
    return np.unique(codes[left[:len(codes)] >= length], return_counts=True)


def fit(counts: pd.DataFrame, order: int, nodes: int, table_mb: int) -> Model:
    """``counts``: lang, length (of the byte string), gram, n; the last byte follows the others."""
    languages = sorted(counts["lang"].unique())
    ordered = counts["gram"].to_numpy(np.int64).view(np.uint64)
    last = (ordered & np.uint64(255)).astype(np.int64)
    seen = np.unique(last)
    symbol = np.full(256, len(seen), dtype=np.uint8 if len(seen) < 256 else np.uint16)
    symbol[seen] = np.arange(len(seen))
    width = len(seen) + (len(seen) < 256)
    nodes = max(1, min(nodes, (table_mb << 20) // (4 * width * len(languages))))
    rows = pd.DataFrame({"depth": counts["length"].to_numpy() - 1, "context": ordered >> np.uint64(8),
                         "symbol": symbol[last], "lang": counts["lang"].map(languages.index).to_numpy(),
                         "n": counts["n"].to_numpy()})
    totals = rows.groupby(["depth", "context"], sort=True)["n"].sum().reset_index()
    # A threshold keeps the tree closed: a part of a context is at least as frequent.
    if len(totals) > nodes:
        least = np.sort(totals["n"].to_numpy())[-nodes]
        chosen = totals[totals["n"] >= least]
        chosen = chosen if len(chosen) <= nodes else totals[totals["n"] > least]
    else:
        chosen = totals
    if not (chosen["depth"] == 0).any():
        chosen = totals[totals["depth"] == 0]
    state = {(int(d), int(c)): i for i, (d, c) in enumerate(zip(chosen["depth"], chosen["context"]))}

    def longest(depth: int, context: int) -> int:
        while (depth, context) not in state:
            depth, context = depth - 1, context & ((1 << 8 * (depth - 1)) - 1)
        return state[depth, context]

    probability = np.empty((len(state), width, len(languages)))
    following = np.zeros((len(state), width), dtype=np.int32)
    rows = rows.merge(chosen.assign(state=np.arange(len(chosen)))[["depth", "context", "state"]],
                      on=["depth", "context"]).sort_values(["state", "lang"], kind="stable")
    cell = rows["state"].to_numpy() * len(languages) + rows["lang"].to_numpy()
    borders = np.searchsorted(cell, np.arange(len(state) * len(languages) + 1))
    all_symbols, all_counts = rows["symbol"].to_numpy(), rows["n"].to_numpy()
    # The symbol of bytes never seen stands for each of them alike.
    uniform = np.full((width, len(languages)), 1 / 256)
    weight = np.ones(width)
    weight[len(seen):] = 256 - len(seen)
    for (depth, context), at in state.items():
        shorter = probability[longest(depth - 1, context & ((1 << 8 * (depth - 1)) - 1))] if depth else uniform
        for k in range(len(languages)):
            own = slice(*borders[at * len(languages) + k:][:2])
            hit, n = all_symbols[own], all_counts[own]
            total, distinct = n.sum(), len(n)
            if not total:
                probability[at, :, k] = shorter[:, k]
                continue
            unseen = (shorter[:, k] * weight).sum() - shorter[hit, k].sum()
            escape = distinct / (total + distinct)
            probability[at, :, k] = escape * shorter[:, k] / max(unseen, 1e-12)
            probability[at, hit, k] = n / (total + distinct)
        for column, byte in enumerate(seen):
            grown = ((context << 8) | int(byte)) & ((1 << 8 * order) - 1)
            following[at, column] = longest(min(depth + 1, order), grown)
        following[at, len(seen):] = state[0, 0]
    bits = -np.log2(np.maximum(probability, 1e-12)).astype(np.float32).reshape(-1, len(languages))
    return Model(languages, order, symbol, following, bits)


def code_lengths(model: Model, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Bits of each text (ends: n + 1 borders in data) in each language."""
    begin, length = ends[:-1], np.diff(ends)
    pieces = -(-length // SEGMENT)
    text = np.repeat(np.arange(len(length)), pieces)
    number = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    run_up = np.where(number > 0, model.order, 0)
    start = begin[text] + number * SEGMENT - run_up
    size = np.minimum(length[text] - number * SEGMENT, SEGMENT) + run_up
    order = np.argsort(-size, kind="stable")
    text, run_up, start, size = text[order], run_up[order], start[order], size[order]
    symbols, width = model.symbol[data], model.following.shape[1]
    # The context of no bytes comes first, so every segment starts in state 0.
    following, state = model.following.ravel(), np.zeros(len(start), dtype=np.int64)
    total = np.zeros((len(start), len(model.languages)))
    for step in range(int(size.max(initial=0))):
        active = int(np.searchsorted(-size, -step, side="left"))
        cell = state[:active] * width + symbols[start[:active] + step]
        if step >= model.order:
            total[:active] += model.bits[cell]
        else:
            counted = run_up[:active] <= step
            total[:active][counted] += model.bits[cell[counted]]
        state[:active] = following[cell]
    out = np.zeros((len(length), len(model.languages)))
    np.add.at(out, text, total)
    return out


def trained(rows: DataFrame, order: int = 4, sample_docs: int = 400, nodes: int = 8192,
            table_mb: int = 64) -> Model | None:
    """A model from ``rows`` with doc_id, text and lang; None without any labelled text."""
    labelled = rows.filter(F.col("lang").isNotNull() & (F.col("text") != ""))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    share = F.create_map(*[v for lang, n in sizes.items()
                           for v in (F.lit(lang), F.lit(min(HASHES, -(-HASHES * sample_docs // n))))])
    sample = labelled.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(HASHES)) < F.element_at(share, F.col("lang")))

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        texts, parts = [t.encode() for t in pdf["text"]], []
        for length in range(1, order + 2):
            grams, n = _grams(texts, length)
            keep = n >= (1 if length <= 2 else 2)
            parts.append(pd.DataFrame({"lang": pdf["lang"].iloc[0], "length": length,
                                       "gram": grams[keep].view(np.int64), "n": n[keep]}))
        return pd.concat(parts)

    counts = sample.groupBy("lang").applyInPandas(count, "lang string, length long, gram long, n long")
    return fit(counts.toPandas(), order, nodes, table_mb)


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, bits_per_byte."""
    shared = rows.sparkSession.sparkContext.broadcast(vars(model))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        names = np.array([*model.languages, "und"], dtype=object)
        for whole in batches:
            texts = whole.column(2).cast(pa.large_binary())
            ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
            at = 0
            while at < len(texts):
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + BYTES_AT_ONCE)))
                to = min(to, len(texts))
                batch = whole.slice(at, to - at)
                own = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[ends[at]:ends[to]]
                bits = code_lengths(model, own, ends[at:to + 1] - ends[at])
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(best)), best]
                score = 1 / np.exp2(-(bits - least[:, None])).sum(axis=1)
                letters = np.array([any(map(str.isalpha, t)) for t in batch.column(2).to_pylist()], dtype=bool)
                best[~letters], score[~letters] = len(model.languages), 0.0
                size = np.maximum(np.diff(ends[at:to + 1]), 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(names[best], pa.string()),
                     pa.array(score, pa.float64()), pa.array(least / size, pa.float64())],
                    ["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"])
                at = to

    return rows.select("doc_id", "held_out", "text").mapInArrow(
        predict, "doc_id long, held_out boolean, lang_pred string, score double, bits_per_byte double")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             **options) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, bits_per_byte.

    Rows held out, those whose id has a checksum of 2 modulo 4, are not learned
    from; nor are rows with a null id, language or text. The score is the
    posterior probability of the language under equal priors. A null or empty
    text, or one without a letter, is ``und`` with score 0; equal code lengths go
    to the first language by name. Without any labelled row all are ``und``.
    Repeated rows are scored each; other columns are not looked at.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                       F.col(f"`{lang_col}`").cast("string").alias("lang"))
    rows = rows.withColumn("held_out", held_out(F.col("doc_id")))
    model = trained(rows.filter(~F.col("held_out") & F.col("doc_id").isNotNull()), **options)
    if model is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(0.0).alias("bits_per_byte"))
    return scored(rows, model)
