"""Byte-level BPE, alignment of tokenisers and repair of conversations against libraries and brute force."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from ticktide.llm import alignment, byte_bpe, dialogue, queries

ODD = ["", "a", "<|endoftext|> x", "\n\n  a  \t b", "  ", "漢字漢字テスト😀" * 50, "x" * 5000, "▁ mark", "<s> </s> <unk>",
       "a b" * 400_000 + " " * 70, "tab\tnul\x00end", "é   ÷", "Ꟍ Ᲊ \U00012550"]


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def odd_texts(seed=1):
    rng = random.Random(seed)
    some = ["".join(rng.choice("abe ' \n\tst0123é漢.,ll've'") for _ in range(rng.randrange(60))) for _ in range(300)]
    wide = [chr(rng.choice([rng.randrange(1, 0x250), rng.randrange(0x250, 0xD000), rng.randrange(0x10000, 0x20000), 32]))
            for _ in range(20_000)]
    return ODD + some + ["".join(wide)]


def test_byte_bpe_against_the_library(spark, sf_dir, texts, ranks):
    exact = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = queries.QUERIES["op11_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = exact.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(" ".join(map(str, ids))))
        assert r.decoded_sha256 == sha(texts[r.doc_id])


def test_byte_bpe_odd_texts(ranks):
    exact = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    given = odd_texts()
    # A table of five words: it is started anew all the time.
    for limit in (5, 100_000):
        encoder = byte_bpe.Encoder(byte_bpe.Vocabulary(ranks, public_tokenizers.PATTERN), limit)
        flat, ends = encoder.texts(given)
        for text, a, b in zip(given, [0, *ends], ends):
            assert flat[a:b].tolist() == exact.encode_ordinary(text), text[:40]


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 3000).astype(np.uint64))
    for some in (keys, keys[:1], keys[:2]):
        assert sorted(byte_bpe.PerfectHash(some).slots(some).tolist()) == list(range(len(some)))


def test_byte_bpe_decode_awkward(spark):
    rows = spark.createDataFrame([(1, [15496, 995]), (2, None), (None, [])], "doc_id long, ids array<int>")
    got = {r.doc_id: bytes(r.bytes) for r in byte_bpe.decode(rows).collect()}
    assert got == {1: b"Hello world", 2: b"", None: b""}


def test_merge_path_against_sets():
    rng = random.Random(2)
    for _ in range(200):
        size = rng.randrange(1, 60)
        a, b = (sorted({size, *(rng.randrange(1, size + 1) for _ in range(rng.randrange(size)))}) for _ in "ab")
        for width in (1, 3, 128):
            got = list(zip(*(x.tolist() for x in alignment.merge_path(np.array(a), np.array(b), width))))
            want = [(sum(x < e for x in a), sum(x < e for x in b), e, e in a and e in b) for e in sorted({*a, *b})]
            assert got == want


def brute_alignment(texts):
    """Everything by overlap of all token pairs of a group."""
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        bytes_of = {int(b): base64.b64decode(a) for a, b in map(bytes.split, lines)}

    def piece(i):
        name = second.id_to_piece(i)
        return bytes([int(name[1:-1], 16)]) if second.is_byte(i) else name.replace("▁", " ").encode()

    out, count = {}, Counter()
    for key, text in texts.items():
        a, b = first.encode(" " + (text or ""), add_special_tokens=False).ids, second.encode(text or "")
        ta, tb = [bytes_of.get(i, b"?") for i in a], [piece(i) for i in b]
        if not text or not b"".join(ta) == b"".join(tb) == (" " + text).encode():
            out[key] = None
            continue
        spans_a, spans_b = ([(sum(map(len, t[:n])), sum(map(len, t[:n + 1]))) for n in range(len(t))]
                            if len(text) < 3000 else list(zip(np.cumsum([0, *map(len, t[:-1])]), np.cumsum(list(map(len, t)))))
                            for t in (ta, tb))
        links, start = [], 0
        for i, (s, e) in enumerate(spans_a):
            while spans_b[start][1] <= s:
                start += 1
            j = start
            while j < len(spans_b) and spans_b[j][0] < e:
                links.append((a[i], b[j]))
                j += 1
        cuts = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
        groups, i, j = [], 0, 0
        for cut in cuts:
            ga, gb = [], []
            while i < len(a) and spans_a[i][1] <= cut:
                ga.append(a[i])
                i += 1
            while j < len(b) and spans_b[j][1] <= cut:
                gb.append(b[j])
                j += 1
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
        count.update(links)
        out[key] = len(a), len(b), len(groups), links, ";".join(groups)
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return {k: (0, 0, 0, 0, 0, 0, "") if v is None else (
        *v[:3], len(v[3]), sum(count[x] == most[x[1]] for x in v[3]), sum(count[x] for x in v[3]), sha(v[4]))
        for k, v in out.items()}


def found_alignment(df):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()}


def test_alignment_against_brute_force(spark, sf_dir, texts):
    assert found_alignment(queries.QUERIES["op12_alignment"](spark, sf_dir)) == brute_alignment(texts)


def test_alignment_odd_texts_in_many_blocks(spark):
    given = dict(enumerate([*odd_texts(3), None]))
    given[9] = "a b" * 4000
    docs = spark.createDataFrame(list(given.items()), "doc_id long, text string").repartition(5)
    assert found_alignment(alignment.align(docs, block_bytes=500)) == brute_alignment(given)


def test_alignment_shows_groups(spark):
    docs = spark.createDataFrame([(1, "Hello")], "doc_id long, text string")
    row = alignment.align(docs, groups=True).first()
    assert row.groups_sha256 == "18435|22557" and row.count_sum == row.n_links == 1


STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}  # the automaton


def brute_repair(rows):
    """Faults, cost, audit and repaired text of (turn, role, text) in order, over whole audit strings."""
    seen, kinds = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        kinds.append("b" if not body else "d" if (role, text) in seen else "" if body[-1] in ".!?" else "t")
        seen.add((role, text))

    def inserted(layer):
        for _ in range(3):
            for state, (cost, audit, lines) in list(layer.items()):
                for role in ("user", "assistant"):
                    offer(layer, STEP.get((state, role[0])), (cost + 3, audit + "I", (*lines, role + ":")))
        return layer

    def offer(layer, state, found):
        if state is not None and (state not in layer or found < layer[state]):
            layer[state] = found

    layer = inserted({"": (0, "", ())})
    for (_, role, text), kind in zip(rows, kinds):
        new = {}
        for state, (cost, audit, lines) in layer.items():
            offer(new, state, (cost + 4, audit + "D", lines))
            if kind not in ("b", "d"):
                more = 3 * (kind == "t")
                kept = state if not role else STEP.get((state, role[0]))
                offer(new, kept, (cost + more, audit + "K", (*lines, f"{role}:{text}")))
                for to in ("user", "assistant"):
                    offer(new, STEP.get((state, to[0])), (cost + 3 + more, audit + "R", (*lines, f"{to}:{text}")))
        layer = inserted(new)
    cost, audit, lines = min(layer[s] for s in ("", "a") if s in layer)
    turns = {t for t, _, _ in rows if t is not None}
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, kinds.count("b"), kinds.count("d"), kinds.count("t"), illegal, cost, audit, sha("\n".join(lines)))


def brute_damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        out[conv]
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.replace(".", "").replace("!", "").replace("?", "")
        if kind == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for of in out.values():
        of.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    return {conv: brute_repair(of) for conv, of in out.items()}


def found_repair(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
            for r in df.collect()}


def test_dialogue_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    assert found_repair(queries.QUERIES["op13_dialogue"](spark, sf_dir)) == brute_damage(rows)


def odd_conversations():
    rng, rows = random.Random(4), []
    for conv in [None, *range(40)]:
        for turn in rng.sample(range(-5, 400), 300 if conv in (None, 7, 8) else rng.randrange(1, 9)):
            rows.append((conv, None if turn == 0 else turn, rng.choice(["user", "assistant", "system", "tool", "", None]),
                         rng.choice(["a.", "b", "c!", "", " \n", "d? ", "e.", None, f"t{turn}.", "längère\nzwei."])))
    return rows


@pytest.mark.parametrize("parts", [1, 40])
def test_dialogue_over_many_partitions(spark, parts):
    """Conversations of 300 turns, cut into parts; nulls everywhere; extra columns with names used inside."""
    rows = odd_conversations()
    df = spark.createDataFrame([(*r, 1, True, "x") for r in rows],
                               "conv_id long, turn long, role string, text string, seg long, gone boolean, first string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = dialogue.pieces(dialogue.damage(df))
        got = found_repair(dialogue.conversations(pieces))
        assert pieces.filter("seg is not null").count() > 10 or parts == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == brute_damage(rows)
    assert dialogue.repair(df.filter("false")).collect() == []


def test_dialogue_of_one_text(spark):
    """Repeated rows of one turn, and a single text in every turn."""
    rows = [(1, 5, "user", "same.")] * 3 + [(2, t, "user", "same.") for t in range(50)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert found_repair(dialogue.repair(df)) == brute_damage(rows)


def test_block_tables_against_strings():
    rng, tables = random.Random(5), dialogue.Tables()
    for _ in range(1500):
        rows = [(i, rng.choice(["user", "assistant", "system", "tool", " ", ""]), rng.choice(["a.", "b", "c!", "", "d?"]))
                for i in range(rng.randrange(1, 14))]
        piece = dialogue._piece([(1, *r, False, 0, r[0], None) for r in rows], tables, 0, 0, True)
        want = brute_repair(rows)
        assert (piece[2:8], sha(piece[8])) == (want[1:7], want[7])
