"""Repair of conversations by Four-Russians block tables.

A repaired conversation may open with a system turn, then user and assistant take
turns; its role initials match ``(s?(ua)+)?``. Edits of a turn: Keep (0), Rerole
to user or assistant (3), Delete (4, the only one for blank and repeated turns);
Insert an empty turn anywhere (3). A truncated turn that stays costs 3 more. Of
the cheapest edits those win whose initials are least in ASCII order.

A turn is one of twelve symbols. What the rest of a conversation costs from each
of the automaton's four states is a vector; less its least entry it is one of a
few dozen, and a symbol sends one to another at a fixed price. For every block of
``BLOCK`` symbols and every vector behind it, tables hold the vector before it,
the price, and in which state the best edits leave it from each state. A
conversation is taken block by block from its end, by lookup; then each block is
expanded backward from the vector kept behind it and its edits are read off
forward, so that ties are settled exactly.

The tables compose: a run of turns is one map of vectors and states, whatever its
length. Turns are dealt by ranges of (conversation, turn), so that a long
conversation lies in several partitions; each gives the map of its run, the maps
of a conversation, one a partition, are put together, and every run is traced by
itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ticktide.llm.tables import checkpointed

WHITE = " \t\n\v\f\r"
BLOCK = 4
SYSTEM, USER, ASSISTANT, OTHER, NAMELESS = range(5)  # by initial; + 5: truncated
DELETED, NOTHING, SYMBOLS = 10, 11, 12
KINDS = {"s": SYSTEM, "u": USER, "a": ASSISTANT, "": NAMELESS}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3       # fixed values: prices
# States: nothing yet, after system, after user, after assistant; the first and the last may end.
AFTER = {SYSTEM: (1, None, None, None), USER: (2, 2, None, 2), ASSISTANT: (None, None, 3, None),
         OTHER: (None,) * 4, NAMELESS: (0, 1, 2, 3)}
NEXT = (2, 2, 3, 2)                                  # the state after the turn that fits
ROLE_OF = {2: "user", 3: "assistant"}
ENDING = (0, 6, 3, 0)
DEALT = "conv_id long, turn long, role string, text string, gone boolean, seg int, pos long, seen boolean"
PIECE = ("conv_id long, seg int, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
         "repaired string, edits long, first string, last string, low long, high long, turns long")


def _options(symbol: int, behind: tuple[int, ...], here: list[int], state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, price of all that follows, next state) in ASCII order, Insert staying before the turn."""
    if symbol == NOTHING:
        return
    yield "D", DELETE + behind[state], state
    yield "I", INSERT + here[NEXT[state]], NEXT[state]
    if symbol != DELETED:
        extra, to = (symbol >= 5) * TRUNCATED, AFTER[symbol % 5][state]
        if to is not None:
            yield "K", extra + behind[to], to
        yield "R", REROLE + extra + behind[NEXT[state]], NEXT[state]


def _before(symbol: int, behind: tuple[int, ...]) -> list[int]:
    """The vector before a symbol from the one behind it."""
    if symbol == NOTHING:
        return list(behind)
    here = [min(p for e, p, _ in _options(symbol, behind, [10 ** 9] * 4, q) if e != "I") for q in range(4)]
    for _ in range(2):
        here = [min(here[q], INSERT + here[NEXT[q]]) for q in range(4)]
    return here


class Tables:
    """Transitions of single symbols and of blocks."""

    def __init__(self) -> None:
        vectors, number = [ENDING], {ENDING: 0}
        to, price = [], []
        for vector in vectors:  # grows while it is read
            rows = []
            for symbol in range(SYMBOLS):
                here = _before(symbol, vector)
                least = min(here)
                key = tuple(c - least for c in here)
                if key not in number:
                    number[key] = len(vectors)
                    vectors.append(key)
                rows.append((number[key], least))
            to.append([r[0] for r in rows])
            price.append([r[1] for r in rows])
        self.vectors = vectors
        self.to = np.array(to, dtype=np.int32).T.copy()        # [symbol, vector behind]
        self.price = np.array(price, dtype=np.int32).T.copy()
        self.edits = [[[self._trace(s, v, q) for q in range(4)] for v in vectors] for s in range(SYMBOLS)]
        state = np.array([[[e[1] for e in of_v] for of_v in of_s] for of_s in self.edits], dtype=np.int8)
        # Blocks: twice as long until BLOCK symbols are reached.
        self.block_to, self.block_price, self.block_state = self.to, self.price, state
        size = 1
        while size < BLOCK:
            t, p, s = self.block_to, self.block_price, self.block_state
            n = len(t)
            self.block_to = t[:, t].reshape(n * n, -1)          # [first half, second half, vector]
            self.block_price = (p[:, t] + p[None, :, :]).reshape(n * n, -1)
            inner = s[:, t, :]                                  # state after the first half
            second = np.broadcast_to(s[None], (n, n, *s.shape[1:]))
            self.block_state = np.take_along_axis(second, inner.astype(np.int64), axis=3).reshape(n * n, -1, 4)
            size *= 2
        self.weights = SYMBOLS ** np.arange(BLOCK - 1, -1, -1)

    def _trace(self, symbol: int, vector: tuple[int, ...], state: int) -> tuple[str, int]:
        """Least cheapest edits of one symbol from a state, and the state they lead to."""
        here, audit = _before(symbol, vector), ""
        while symbol != NOTHING:
            edit, _, to = next(o for o in _options(symbol, vector, here, state) if o[1] == here[state])
            audit, state = audit + edit, to
            if edit != "I":
                break
        return audit, state

    def codes(self, symbols: bytes) -> np.ndarray:
        padded = symbols + bytes([NOTHING]) * (-len(symbols) % BLOCK)
        return np.frombuffer(padded, dtype=np.uint8).reshape(-1, BLOCK).astype(np.int64) @ self.weights

    def run_map(self, symbols: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a run of turns, for every vector behind it: the one before it, the price, and the state after it by state."""
        codes, vector = self.codes(symbols), np.arange(len(self.vectors))
        kept, price = np.empty((len(codes), len(vector)), dtype=np.int16), np.zeros(len(vector), dtype=np.int64)
        for i in range(len(codes) - 1, -1, -1):
            kept[i] = vector
            price += self.block_price[codes[i], vector]
            vector = self.block_to[codes[i], vector]
        state = np.tile(np.arange(4), (len(self.vectors), 1))
        for code, behind in zip(codes.tolist(), kept):
            state = np.take_along_axis(self.block_state[code][behind], state, axis=1).astype(np.int64)
        return vector, price, state

    def trace(self, symbols: bytes, behind: int, state: int, last: bool) -> tuple[int, list[str]]:
        """Price of a run and the edits of each of its turns, after the last one those at the end."""
        codes = self.codes(symbols).tolist()
        kept, price, vector = [], 0, behind
        for code in reversed(codes):
            kept.append(vector)
            price += int(self.block_price[code, vector])
            vector = int(self.block_to[code, vector])
        # Prices are those above the least entry; from this state the run may begin higher, and end so.
        price += self.vectors[vector][state]
        edits = []
        for at in range(0, len(symbols), BLOCK):
            block, vector = symbols[at:at + BLOCK], kept.pop()
            inside = []
            for symbol in reversed(block):
                inside.append(vector)
                vector = int(self.to[symbol, vector])
            for symbol in block:
                audit, state = self.edits[symbol][inside.pop()][state]
                edits.append(audit)
        price -= self.vectors[behind][state]
        tail = "" if not last else "II" if state == 1 else "I" if state == 2 else ""
        return price + INSERT * len(tail), [*edits, tail]


def damage(conversations: DataFrame) -> DataFrame:
    """The stated damage: conv_id, turn, role, text, gone; turns that are dropped stay as ``gone`` rows.

    Null texts and roles are one space, as are null numbers in the hashed key.
    """
    def key(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(key("conv_id"), F.lit(":"), key("turn"))) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                key("role").alias("role"), key("text").alias("text"), kind.alias("kind"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), "").when(
            F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("gone"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of one conversation in one part at a time; batches are in order."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if held and (row[0], row[5]) != (held[0][0], held[0][5]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _faults(rows: list[tuple]) -> tuple[bytes, list[tuple], list[int]]:
    """Symbols of the turns that are not gone, these turns, and counts of blank, duplicate, truncated."""
    symbols, live, faults, met = bytearray(), [], [0, 0, 0], set()
    for row in rows:
        _, _, role, text, gone, _, _, seen = row[:8]
        if gone:
            continue
        if seen is None:  # a conversation that lies in one part
            key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
            seen = key in met
            met.add(key)
        body, symbol = text.rstrip(WHITE), KINDS.get(role[:1], OTHER)
        if not body or seen:
            faults[0 if not body else 1] += 1
            symbol = DELETED
        elif body[-1] not in ".!?":
            faults[2] += 1
            symbol += 5
        symbols.append(symbol)
        live.append(row)
    return bytes(symbols), live, faults


def _repaired(live: list[tuple], edits: list[str], state: int) -> Iterator[str]:
    """``role:text`` of the turns that are left."""
    for row, edit in zip([*live, None], edits):
        for e in edit:
            if e == "K":
                yield f"{row[2]}:{row[3]}"
                state = AFTER[KINDS.get(row[2][:1], OTHER)][state]
            elif e != "D":
                state = NEXT[state]
                yield f"{ROLE_OF[state]}:{row[3] if e == 'R' else ''}"


def _piece(rows: list[tuple], tables: Tables, behind: int, state: int, last: bool) -> tuple:
    symbols, live, faults = _faults(rows)
    cost, edits = tables.trace(symbols, behind, state, last) if live else (0, [""])
    lines = list(_repaired(live, edits, state))
    initials = [r[2][:1] for r in live]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    turns = [r[1] for r in live if r[1] is not None]
    return (rows[0][0], rows[0][5], *faults, illegal, cost, "".join(edits), "\n".join(lines), len(lines),
            initials[0] if live else None, initials[-1] if live else None,
            min(turns, default=None), max(turns, default=None), len(set(turns)))


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], at_once: int = 512) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == at_once:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)


def pieces(turns: DataFrame) -> DataFrame:
    """Repaired runs of conversations: faults, price, edits and the repaired text, one row a run.

    ``turns`` has conv_id, turn, role, text and ``gone`` as `damage` gives them.
    A conversation is taken by turn, nulls first; rows of one turn by a hash of
    role and text, equal rows side by side. A conversation that lies in one
    partition is one run with ``seg`` null.
    """
    tables = turns.sparkSession.sparkContext.broadcast(Tables())
    names = [part.split()[0] for part in PIECE.split(", ")]
    types = [pa.string() if part.endswith("string") else pa.int32() if part.endswith("int") else pa.int64()
             for part in PIECE.split(", ")]
    order = ["conv_id", "turn", "tie"]
    dealt = checkpointed(
        turns.select("conv_id", "turn", "role", "text", "gone", F.xxhash64("role", "text").alias("tie"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .select("conv_id", "turn", "role", "text", "gone", F.spark_partition_id().alias("seg"),
                F.monotonically_increasing_id().alias("pos")))

    # A border between partitions cuts one conversation at most, so there are fewer of these than partitions.
    cut = dealt.groupBy("conv_id").agg(F.min("seg").alias("low"), F.max("seg").alias("high")).filter("low < high")
    cut = F.broadcast(cut.select(F.col("conv_id").alias("cut_id")))
    is_cut = F.col("conv_id").eqNullSafe(F.col("cut_id"))
    inside = dealt.join(cut, is_cut, "left_anti").withColumn("seen", F.lit(None).cast("boolean"))
    across = dealt.join(cut, is_cut, "left_semi")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = tables.value
        rows = (_piece(run, of, 0, 0, True) for run in _runs(batches))
        yield from _batches((((p[0], None) + p[2:]) for p in rows), names, types)

    done = inside.sortWithinPartitions("pos").mapInArrow(whole, PIECE)

    # The first place of each turn; within a part at most one row a turn is left before they meet.
    digest = F.sha2(F.concat(F.length("role"), F.lit(":"), F.col("role"), F.col("text")), 256)
    first = (across.filter(~F.col("gone")).groupBy("conv_id", digest.alias("digest")).agg(F.min("pos").alias("pos"))
             .select("pos", F.lit(False).alias("repeated")))
    marked = checkpointed(
        across.join(first, "pos", "left").select(
            "conv_id", "turn", "role", "text", "gone", "seg", "pos",
            F.coalesce("repeated", F.lit(True)).alias("seen"))
        .repartition("seg").sortWithinPartitions("seg", "pos"))

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = tables.value

        def rows() -> Iterator[tuple]:
            for run in _runs(batches):
                to, price, state = of.run_map(_faults(run)[0])
                yield run[0][0], run[0][5], to.tolist(), state.ravel().tolist()

        yield from _batches(rows(), ["conv_id", "seg", "to", "state"],
                            [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32())])

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seg", ignore_index=True)
        behind, vector = [], 0
        for to in reversed(pdf["to"].tolist()):
            behind.append(vector)
            vector = int(to[vector])
        begins, state = [], 0
        for of, v in zip(pdf["state"].tolist(), reversed(behind)):
            begins.append(state)
            state = int(of[v * 4 + state])
        return pd.DataFrame({"conv": pdf["conv_id"].astype("Int64"), "part": pdf["seg"], "behind": behind[::-1],
                             "begin": begins, "last": [False] * (len(pdf) - 1) + [True]})

    places = (marked.mapInArrow(maps, "conv_id long, seg int, to array<int>, state array<int>")
              .groupBy("conv_id").applyInPandas(joined, "conv long, part int, behind int, begin int, last boolean"))
    # One row a run; a partition holds at most two runs of conversations that are cut.
    placed = marked.join(F.broadcast(places), F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("seg") == F.col("part")))

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = tables.value
        rows = (_piece(run, of, *run[0][8:11]) for run in _runs(batches))
        yield from _batches(rows, names, types)

    rest = (placed.sortWithinPartitions("seg", "pos")
            .select("conv_id", "turn", "role", "text", "gone", "seg", "pos", "seen", "behind", "begin", "last")
            .mapInArrow(traced, PIECE))
    return done.unionByName(rest)


def conversations(repaired: DataFrame) -> DataFrame:
    """One row per conversation from its runs; the digest of a long text is taken piece by piece."""
    columns = ["blank", "duplicate", "truncated", "illegal", "cost", "audit"]

    def gaps(low: str, high: str, turns: str) -> Column:
        return F.coalesce(F.col(high) - F.col(low) + 1 - F.col(turns), F.lit(0)).alias("gaps")

    done = repaired.filter(F.col("seg").isNull()).select(
        "conv_id", gaps("low", "high", "turns"), *columns, F.sha2("repaired", 256).alias("repaired_sha256"))
    rest = repaired.filter(F.col("seg").isNotNull())
    # Runs of a conversation, one a partition at most; a turn may go on behind a border.
    by_run = Window.partitionBy("conv_id").orderBy("seg")
    before = F.last("last", ignorenulls=True).over(by_run.rowsBetween(Window.unboundedPreceding, -1))
    highest = F.max("high").over(by_run.rowsBetween(Window.unboundedPreceding, -1))
    border = (before.isNotNull() & F.col("first").isNotNull()
              & ~F.concat(before, F.col("first")).isin("su", "ua", "au")).cast("long")
    sums = (rest.drop("repaired").withColumn("border", border)
            .withColumn("again", F.coalesce((highest == F.col("low")).cast("long"), F.lit(0)))
            .groupBy("conv_id").agg(
                F.min("low").alias("low"), F.max("high").alias("high"), F.sum(F.col("turns") - F.col("again")).alias("turns"),
                *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "cost")),
                F.sum(F.col("illegal") + F.col("border")).alias("illegal"),
                F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg", "audit"))),
                                         lambda x: x["audit"]), "").alias("audit")))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            held, state, any_line = (), hashlib.sha256(), False
            for batch in batches:
                for conv_id, text, lines in zip(*(column.to_pylist() for column in batch.columns)):
                    if held != (conv_id,):
                        if held:
                            yield held[0], state.hexdigest()
                        held, state, any_line = (conv_id,), hashlib.sha256(), False
                    if lines:
                        state.update(("\n" + text if any_line else text).encode())
                        any_line = True
            if held:
                yield held[0], state.hexdigest()

        yield from _batches(rows(), ["id", "repaired_sha256"], [pa.int64(), pa.string()])

    hashed = (rest.select("conv_id", "seg", "repaired", "edits").repartition("conv_id")
              .sortWithinPartitions("conv_id", "seg").select("conv_id", "repaired", "edits")
              .mapInArrow(digests, "id long, repaired_sha256 string"))
    return done.unionByName(
        sums.join(hashed, F.col("conv_id").eqNullSafe(F.col("id")))
        .select("conv_id", gaps("low", "high", "turns"), *columns, "repaired_sha256"))


def repair(turns: DataFrame) -> DataFrame:
    """Per damaged conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    A conversation without rows after the damage has zeros, an empty audit and
    the digest of the empty text. Null ids are one conversation; other columns
    are not looked at; an empty table gives no rows.
    """
    return conversations(pieces(damage(turns)))
