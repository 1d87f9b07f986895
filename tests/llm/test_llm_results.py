"""Results against libraries, brute force, round trips and held-out labels, over the small tables."""

import hashlib
import re
import sys
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece as library
import xxhash
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from compare import connect, difference  # noqa: E402

from ticktide.llm import fingerprints, pii, quality, queries, simhash, substring_dedup, url_filter  # noqa: E402
from ticktide.llm.bytepair import encoder  # noqa: E402
from ticktide.llm.sentencepiece import Vocabulary, read_model  # noqa: E402

WORD = "[^\x20\x09-\x0d]+"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def run(spark, sf_dir, name):
    return queries.QUERIES[name](spark, sf_dir).toPandas()


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def ids(texts):
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {k: exact.encode(t, add_special_tokens=False).ids for k, t in texts.items()}


def test_one_query_per_operator():
    assert sorted({int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES}) == list(range(1, 14))


def test_sentencepiece_ids_and_round_trip(spark, sf_dir, texts):
    exact = library.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in run(spark, sf_dir, "op1_sentencepiece").itertuples():
        want = exact.encode(texts[r.doc_id])
        assert (r.n_ids, r.ids_sha256) == (len(want), sha(" ".join(map(str, want))))
        assert r.text_sha256 == sha(texts[r.doc_id])


def test_sentencepiece_odd_strings():
    own, exact = Vocabulary(read_model(None)), library.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    draw = np.random.default_rng(3)
    for alphabet in ("aab ", "the reion ant  ", "éß漢😀 \n", "0.-_a", "  ▁", "ab\x00\t "):
        for _ in range(60):
            text = "".join(draw.choice(list(alphabet), draw.integers(0, 40)))
            words = re.findall("▁+[^▁]*", "▁" + text.replace(" ", "▁")) if text else []
            table = own.encode_words(list(set(words)))
            got = [i for w in words for i in table[w]]
            assert got == exact.encode(text)
            assert own.decode(np.array(got, dtype=int)) == exact.decode(got)


def test_viterbi_of_a_unigram_model():
    own = Vocabulary(read_model(None))
    own.model_type = 1
    own.scores = list(np.random.default_rng(5).uniform(-9, -1, len(own.pieces)))
    floor = min(own.scores) - 10
    words = ["▁there", "▁andin", "▁xqzw漢"]
    for word in words:
        best = [(0.0, [])]
        for end in range(1, len(word) + 1):
            options = []
            for start in range(max(0, end - own.longest), end):
                piece = own.usable.get(word[start:end])
                if piece is not None or end - start == 1:
                    score = floor if piece is None else own.scores[piece]
                    options.append((best[start][0] + score, best[start][1] + [-1 if piece is None else piece]))
            best.append(max(options, key=lambda o: o[0]))
        assert own.search([word])[0] == best[-1][1]


def test_fast_encoder_is_the_library():
    exact, fast = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), encoder()
    odd = [chr(c) for c in range(0x250)]
    cases = [f"a{c}b {c}{c} x{c}" for c in odd] + [f" {c} \n{c}" for c in odd]
    cases += ["a<|endoftext|> b", "  <|endoftext|>\n\n", "漢字 x", "it's  I'LL \t\n x", "", " ", "a" * 3000]
    for text in cases:
        assert fast(text).tolist() == exact.encode(text, add_special_tokens=False).ids, repr(text)


def test_token_counts(spark, sf_dir, texts, ids):
    for r in run(spark, sf_dir, "op2_token_counts").itertuples():
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (
            len(texts[r.doc_id].encode()), len(ids[r.doc_id]), len(ids[r.doc_id]) > 1024)


def test_token_counts_of_odd_white_space(spark):
    from ticktide.llm.token_counts import token_counts
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    draw, alphabet = np.random.default_rng(1), list("ab'\t\n\r \x1c\x85\xa0 .s1") + ["<|endoftext|>", "  "]
    texts = ["".join(draw.choice(alphabet, draw.integers(0, 30))) for _ in range(800)]
    got = token_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {
        i: len(exact.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


@pytest.mark.parametrize("head_size, table_limit", [(0, 10), (7, 3), (40, 400_000)])
def test_token_counts_wherever_a_pre_token_is_counted(spark, head_size, table_limit):
    """Repeated rows, one id on several texts, no id, no text, long pre-tokens: the same counts for any common table."""
    from ticktide.llm.token_counts import token_counts
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    draw, words = np.random.default_rng(5), ["the", "of", "x" * 70, "y" * 3000, "é", "1999", "\n", "it's"]
    texts = [" ".join(draw.choice(words, draw.integers(0, 12))) for _ in range(60)] + [None, "", "the of"]
    rows = [(i % 40 if i % 5 else None, text) for i, text in enumerate(texts)] + [(3, "the of"), (None, "the of")] * 4
    got = token_counts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
                       head_size=head_size, table_limit=table_limit).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == Counter(
        (i, len((t or "").encode()), len(exact.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)


def test_packing(spark, sf_dir, ids):
    got = run(spark, sf_dir, "op9_packing")
    assert set(got.doc_id) == set(ids)
    for doc_id, pieces in got.sort_values("start").groupby("doc_id"):
        whole, at = np.array([*ids[doc_id], 0], dtype="<u4"), 0
        for p in pieces.itertuples():
            assert (p.start, p.doc_tokens) == (at, len(whole))
            assert zlib.crc32(whole[p.start:p.start + p.length]) == p.ids_crc32
            at += p.length
        assert at == len(whole)
    for _, pieces in got.sort_values("offset").groupby("sequence_id"):
        assert list(pieces.offset) == [0, *pieces.length.cumsum()[:-1]] and pieces.length.sum() <= 1024
    assert 1 - got.length.sum() / (1024 * got.sequence_id.nunique()) < 0.01


def test_substring_dedup_catches_shared_prose(spark, texts):
    """All windows of 50 words that an earlier document has are found, but for texts of one repeated word."""
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in substring_dedup.deduplicate(rows).collect()}
    first = {}
    for doc_id in sorted(texts):
        words = texts[doc_id].split()
        hit = set()
        for i in range(len(words) - 49):
            window = tuple(words[i:i + 50])
            if first.setdefault(window, doc_id) < doc_id and len(set(window)) > 10:
                hit |= set(range(i, i + 50))
        kept = got[doc_id]["text"].split()
        if hit:
            assert got[doc_id]["n_spans"] > 0
            assert len(kept) <= len(words) - len(hit) + 50
    clean = [d for d, r in got.items() if r["n_spans"] == 0]
    assert all(got[d]["text"] == texts[d] for d in clean) and len(clean) > len(texts) / 2


def test_substring_dedup_survives_insertions(spark):
    draw = np.random.default_rng(2)
    passage = " ".join("".join(draw.choice(list("abcdefgh"), 6)) for _ in range(60))
    noise = lambda n: " ".join("".join(draw.choice(list("ijklmnop"), 6)) for _ in range(n))
    rows = [(i, f"{noise(40 + i)} {passage} {noise(50)}") for i in range(40)]
    got = {r["doc_id"]: r for r in substring_dedup.deduplicate(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0]["n_spans"] == 0
    for i in range(1, 40):
        start = rows[i][1].index(passage)
        assert got[i]["spans"] == f"{start}:{start + len(passage)}" and got[i]["firsts"] == [0]


def test_substring_dedup_of_joined_passages(spark):
    """Passages made of parts that stand alone earlier, against every window of 50 words."""
    draw = np.random.default_rng(5)
    prose = lambda n: " ".join("".join(draw.choice(list("abcdefghij"), draw.integers(2, 8))) for _ in range(n))
    rows, at = [], 0
    for k in range(25):
        a, b, c = prose(45), prose(45), prose(8 + k)
        outer = [prose(30) for _ in range(5)]
        rows += [(at, f"{outer[0]} {a} {outer[1]}"), (at + 1, f"{b} {outer[2]}"), (at + 2, c),
                 (at + 3, f"{outer[3]} {a} {b} {c}"), (at + 4, f"{a} {b} {c} {outer[4]}"), (at + 5, f"{b} {c} {a} {b}")]
        at += 6
    rows += [(at, "ja " * 300), (at + 1, "nein " + "ja " * 200)]
    got = {r["doc_id"]: r for r in substring_dedup.deduplicate(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    seen = {}
    for doc_id, text in rows:
        words, hit = text.split(), set()
        for i in range(len(words) - 49):
            if seen.setdefault(tuple(words[i:i + 50]), doc_id) < doc_id:
                hit |= set(range(i, i + 50))
        assert got[doc_id]["text"].split() == [w for i, w in enumerate(words) if i not in hit], doc_id


def test_substring_dedup_looks_up_repeated_windows_once(spark):
    """A document's equal windows are one row, and every place of one that an earlier document has is cut."""
    draw = np.random.default_rng(6)
    prose = lambda n: " ".join("".join(draw.choice(list("abcdefghij"), draw.integers(2, 8))) for _ in range(n))
    a, b, n1, n2 = prose(45), prose(45), prose(20), prose(20)
    rows = [(0, f"{a} {n1}"), (1, f"{n2} {b}"), (2, f"{a} {b}"), (3, f"{n1} {a} {b} {n2} {a} {b} {n1} {b} {a}"),
            (4, "ja " * 300), (5, "nein " + "ja " * 200), (6, "nein ja " * 150), (7, "ja " * 60 + "so " + "ja " * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, start long, size int, first long, last long")
    near = spark.createDataFrame([], "doc_id long, found array<struct<first: long, at: long, bytes: binary>>")
    found = substring_dedup.windows(docs, none, near, 50, 16, False).toPandas()
    assert len(found) > 0 and not found.duplicated(["doc_id", "digest"]).any()
    assert found[found.doc_id == 4].start.tolist() == [0] and len(found[found.doc_id == 6]) == 2
    got = {r["doc_id"]: r for r in substring_dedup.deduplicate(docs.repartition(3)).collect()}
    seen = {}
    for doc_id, text in rows:
        words, hit = text.split(), set()
        for i in range(len(words) - 49):
            if seen.setdefault(tuple(words[i:i + 50]), doc_id) < doc_id:
                hit |= set(range(i, i + 50))
        assert got[doc_id]["text"].split() == [w for i, w in enumerate(words) if i not in hit], doc_id
    assert got[3]["n_spans"] == 2 and got[7]["text"].split() == ["so"]


def base_statistics(text):
    words = re.findall(WORD, text)
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_quality(spark, sf_dir, texts):
    got = run(spark, sf_dir, "op4_quality")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for r in got.itertuples():
        n, *rest = base_statistics(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *rest)
        assert r.base_failed == (n < 50 or 100 * rest[-1] > 50 * n)
        assert not (r.base_failed and r.kept)
        if not r.base_failed and r.doc_id in labels:
            assert r.kept == bool(labels[r.doc_id])


def test_robust_estimate_is_the_brute_force_one(spark):
    """Concentration steps against numpy, on one pool with a tenth of outliers."""
    draw = np.random.default_rng(4)
    good, bad = draw.normal(0.5, 0.1, (900, 4)), draw.normal(3, 0.2, (100, 4))
    rows = np.vstack([good, bad])
    df = spark.createDataFrame([("p", *map(float, r)) for r in rows], ["pool", *quality.VECTOR])
    found = quality.with_distance(df, quality.estimates(df)).toPandas()
    centre, floor = rows, np.diag(np.square(quality.FLOORS))
    scale = 0.75 / quality.chi2_share(quality.chi2_quantile(0.75, 4), 6)
    off = np.abs(rows - np.median(rows, axis=0))
    d = np.square(off / (1.4826 * np.median(off, axis=0) + quality.FLOORS)).sum(axis=1)

    def step(core, scale):
        centre = core.mean(axis=0)
        inverse = np.linalg.inv(scale * np.cov(core.T, bias=True) + floor)
        return np.einsum("ij,jk,ik->i", rows - centre, inverse, rows - centre)

    for _ in range(5):
        d = step(rows[d <= np.sort(d)[749]], scale)
    d = step(rows[d <= quality.chi2_quantile(0.975, 4)], 1.0)
    got = found.set_index(quality.VECTOR[0])["distance"].loc[rows[:, 0]].to_numpy()
    assert np.allclose(got, d, rtol=0.02)
    assert (d[900:] > quality.chi2_quantile(0.99999, 4)).all()


PATTERNS = {  # the contract's own
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def test_repeats_alone_reject_in_a_tight_pool(spark):
    """49 % repeated words and nothing else odd, among texts without any."""
    def words(i, n):
        return [f"w{(i * 7919 + k * 104729) % 9973:04d}" for k in range(n)]
    rows = [(i, " ".join(words(i, 120)), "en", "s") for i in range(300)]
    odd = words(900, 90)
    rows.append((999, " ".join([*odd[:30], *odd[:29], *odd[30:90]]), "en", "s"))
    got = {r["doc_id"]: r for r in quality.quality(
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert 100 * got[999]["n_repeat_words"] / got[999]["n_words"] > 48 and not got[999]["base_failed"]
    assert not got[999]["kept"] and all(got[i]["kept"] for i in range(300))


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in doubled) % 10 == 0


def base_pii(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                    "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii(spark, sf_dir, texts):
    for r in run(spark, sf_dir, "op5_pii").itertuples():
        want = base_pii(texts[r.doc_id])
        assert r.base_sha256 == sha(",".join(want))
        assert r.spans.split(",")[:len(want)] == want or not want


def test_pii_odd_texts(spark):
    draw = np.random.default_rng(7)
    odd = ["".join(draw.choice(list("a@.-_+ 01234(é😀"), draw.integers(0, 60))) for _ in range(1500)]
    odd += ["see 10.0.0.1 now", "127.0.0.1", "0.0.0.0 000.1.1.1", "8.8.8.8, 256.0.0.1, 1.1.1.0255 00.00.00.00",
            "x@1.2.3.4" + ".5.6.7.8" * 900 + " 4111 1111 1111 1111", "10.0.0.1 " * 1000]
    odd += ["1.2.3.4.5.6.7.8", "a@b.c-_x@d.e", "999.1.1.1 00255.1.2.3", "4111-1111 1111 1111", "1" * 50_000,
            "a" * 50_000 + "@", "a@b" + ".c" * 20_000]
    rows = pii.pii(spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")).collect()
    for r in rows:
        assert r["base_sha256"] == sha(",".join(base_pii(odd[r["doc_id"]]))), odd[r["doc_id"]][:80]


def test_pii_of_a_very_long_list(spark):
    """Some 32,000 addresses in one text; replaced in order, in time that grows with the text."""
    text = " ".join(f"10.0.{i % 256}.{i // 256 % 256} x{i}" for i in range(32_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = docs.select(pii.base_spans(docs["text"], "ip").alias("s"))
    began = time.perf_counter()
    got = spans.first()["s"]
    assert time.perf_counter() - began < 20
    assert [(s["start"], s["end"]) for s in got] == [m.span() for m in re.finditer(r"10\.[0-9.]+", text)]
    assert pii.sanitise(docs).first()["text"] == re.sub(r"10\.[0-9.]+", "<IP>", text)


def test_overlapping_marks(spark):
    """The first mark covers what overlaps it, however many marks lie below one."""
    rng, rows = np.random.default_rng(3), []
    for i in range(20):
        text = "".join(rng.choice(list("abcdé😀 "), 3000))
        marks = sorted({(int(a), int(a + rng.integers(1, 4)), f"<{a}>") for a in rng.integers(0, 2990, 700)}
                       | {(40, 1900, "<long>")} if i % 2 else {(5, 6, "")})
        rows.append((text, marks))
    df = spark.createDataFrame(rows, "text string, marks array<struct<start:int,end:int,mark:string>>")
    for (text, marks), got in zip(rows, df.select("text", pii.sanitised_text(df["text"], df["marks"])).collect()):
        out, at = [], 0
        for start, end, mark in marks:
            out.append(text[at:max(at, start)] + (mark if start >= at else ""))
            at = max(at, end)
        assert got[1] == "".join(out) + text[at:]


def test_terms_that_disclose_are_marked(spark):
    """A rare word met only beside one address, in different texts, gives it away; common words do not."""
    rows = [(i, f"text {i} says Zorblax wrote from zor@blax.example today about item{i}") for i in range(6)]
    rows += [(100 + i, f"plain text {i} says many wrote from here today about item{i} and x{i}@many.example") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.pii(docs).collect()}
    for i in range(6):
        start = rows[i][1].index("Zorblax")
        assert f"term:{start}:{start + 7}" in got[i]["spans"].split(",") and got[i]["n_terms"] == 1
    assert all(got[100 + i]["n_terms"] == 0 for i in range(300))
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert "Zorblax" not in clean[0] and "<EMAIL>" in clean[0] and clean[100].endswith("<EMAIL>")


def test_terms_far_from_the_address(spark):
    """A disclosing word counts in the whole document, and is marked in all documents."""
    filler = " ".join(["plain words of text that many wrote today"] * 6)
    rows = [(i, f"Zorblax item{i} {filler} line{i} from zor@blax.example today about thing{i} {filler} Zorblax end")
            for i in range(6)]
    rows += [(50, f"{filler} Zorblax without any address")]
    rows += [(100 + i, f"{filler} item{i} about thing{i} line{i} end without any address from x{i}@many.example")
             for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.pii(docs).collect()}
    for doc_id, text in rows:
        want = [f"term:{m.start()}:{m.end()}" for m in re.finditer("Zorblax", text)]
        assert [s for s in got[doc_id]["spans"].split(",") if s.startswith("term")] == want
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert not any("Zorblax" in text for text in clean.values()) and "<EMAIL>" in clean[0]


def test_language(spark, sf_dir):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = run(spark, sf_dir, "op6_language")
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got.itertuples())
    held = got[got.held_out]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held.itertuples()]) > 0.97
    assert got.score.between(0, 1).all()


def test_code_lengths_are_those_of_whole_texts(spark):
    """Segments with a run-up against one pass over the bytes; every state's distribution sums to one."""
    from ticktide.llm import langid
    rows = spark.createDataFrame([(i, f"the cat {i} sat on the mat " * 9, "en") for i in range(9)]
                                 + [(50 + i, f"die katze {i} sass auf der matte " * 9, "de") for i in range(9)],
                                 "doc_id long, text string, lang string")
    model = langid.trained(rows, nodes=200)
    weight = np.bincount(model.symbol, minlength=model.following.shape[1])
    total = (np.exp2(-model.bits.astype(float)).reshape(len(model.following), -1, 2) * weight[None, :, None]).sum(axis=1)
    assert np.allclose(total, 1, atol=1e-4)
    text = ("the matte sat auf the katze ü " * 200).encode()
    data, state, bits = np.frombuffer(text, dtype=np.uint8), 0, np.zeros(2)
    for byte in data:
        symbol = model.symbol[byte]
        bits += model.bits[state * model.following.shape[1] + symbol]
        state = model.following[state, symbol]
    got = langid.code_lengths(model, np.concatenate([data, data[:7]]), np.array([0, len(data), len(data) + 7]))
    assert np.allclose(got[0], bits)


def test_fingerprints(spark, sf_dir, texts):
    got = run(spark, sf_dir, "op7_fingerprints").set_index("doc_id")
    order = sorted(texts, reverse=True)
    by_text = {}
    for i, doc_id in enumerate(order):
        text, following = texts[doc_id], texts[order[(i + 1) % len(order)]]
        half = len(text) // 2
        r = got.loc[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), sha(text[:len(text) - half] + following[:half]))
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
    assert len(set(by_text.values())) == len({tuple(sorted(x for x in t.split("\n") if x.strip())) for t in by_text})
    assert got.near_edited.between(0, 1).all() and got.near_next.between(0, 1).all()
    assert got.near_edited.mean() > got.near_next.mean() + 0.1


def test_fingerprint_algebra(one):
    from pyspark.sql import functions as F
    r = one("a string, b string, c string", ("x\ny\nz\ny", "y\nz\n\ny\nx", "x\ny\nz"),
            a=fingerprints.as_text(fingerprints.fingerprint(F.col("a"))),
            b=fingerprints.as_text(fingerprints.fingerprint(F.col("b"))),
            grown=fingerprints.as_text(fingerprints.with_paragraph(fingerprints.fingerprint(F.col("c")), F.lit("y"))),
            shrunk=fingerprints.as_text(fingerprints.without_paragraph(fingerprints.fingerprint(F.col("a")), F.lit("y"))),
            c=fingerprints.as_text(fingerprints.fingerprint(F.col("c"))))
    assert r["a"] == r["b"] == r["grown"] and r["c"] == r["shrunk"] != r["a"]


def test_urls_against_sql(spark, sf_dir):
    assert difference(queries.QUERIES["op8_url_filter"](spark, sf_dir), connect(sf_dir),
                      queries.ORACLES["op8_url_filter"]) is None


def test_rules_are_filed_under_rare_tokens(spark):
    subjects = spark.createDataFrame([("a.net/es/",), ("b.net/x",), ("c.com/x",)], "subject string")
    rules = [url_filter.host_rule("block", "net/es/"), url_filter.Rule("*ads*", "*ads*", "block")]
    assert list(url_filter.rarest_tokens(subjects, rules).values()) == ["es", None]
    pages = spark.createDataFrame([(1, "http://x.org/loads/1"), (2, "http://x.org/l/1")], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, host_rules=[rules[0]], pattern_rules=[rules[1]]).collect()}
    assert got == {1: "block", 2: "allow"}


def brute_fingerprint(text):
    words = [w.encode() for w in re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {n: find(n) for n in nodes}


def test_simhash(spark, sf_dir, texts):
    got = run(spark, sf_dir, "op10_simhash").set_index("doc_id")
    prints = {d: brute_fingerprint(t) for d, t in texts.items()}
    assert {d: int(x, 16) for d, x in got.fingerprint.items()} == prints
    order = sorted(prints)
    pairs = [(a, b) for i, a in enumerate(order) for b in order[i + 1:] if (prints[a] ^ prints[b]).bit_count() <= 3]
    assert got.component_id.to_dict() == groups(pairs, order)


@pytest.mark.parametrize("shard_rows", [100_000, 300])
def test_tree_search_finds_every_pair(spark, monkeypatch, shard_rows):
    """Small leaves and cut shards, with a dense ball of near fingerprints."""
    monkeypatch.setattr(simhash, "LEAF", 250)
    monkeypatch.setattr(simhash, "BLOCK", 64)
    draw = np.random.default_rng(9)
    base = draw.integers(0, 1 << 63, 1500, dtype=np.uint64)
    near = base[:400] ^ (np.uint64(1) << draw.integers(0, 63, 400).astype(np.uint64))
    ball = base[0] ^ (np.uint64(1) << draw.integers(0, 63, 500).astype(np.uint64)) ^ (
        np.uint64(1) << draw.integers(0, 63, 500).astype(np.uint64))
    values = np.unique(np.concatenate([base, near, ball]))
    nodes = spark.createDataFrame([(0, int(v)) for v in values], "view int, fp long")
    found = [(r["a"], r["b"]) for r in simhash.links(nodes, 3, shard_rows).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    every = [(int(values[i]), int(values[j])) for i in range(len(values))
             for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[i + 1:]) <= 3) + i + 1]
    nodes = values.tolist()
    assert len(every) > 1000 and groups(found, nodes) == groups(every, nodes)


def test_components_of_a_long_path(spark):
    from ticktide.llm.components import components
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_near_copies(spark):
    draw = np.random.default_rng(11)
    word = lambda: "".join(draw.choice(list("abcdefghijkl"), 7))
    rows, kept = [], []
    for g in range(12):
        words = [word() for _ in range(220)]
        rows.append((g * 10, " ".join(words)))
        kept.append(g * 10)
        for c in range(1, 5):
            copy = list(words)
            for at in draw.choice(220, 3, replace=False):
                copy[at] = word()
            rows.append((g * 10 + c, " ".join(copy)))
    got = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in got) == kept


def test_near_copies_among_shuffled_texts(spark):
    """Texts of one vocabulary share their fingerprints; every similar pair counts, whatever text comes first."""
    draw = np.random.default_rng(11)
    vocabulary = np.array([f"word{i}" for i in range(400)])
    rows = []
    for group in range(40):
        words = draw.permutation(vocabulary)
        swapped = words.copy()
        swapped[[100, 101]] = swapped[[101, 100]]
        rows += [(2 * group, " ".join(words)), (2 * group + 1, " ".join(swapped))]

    def shingles(text):
        words = text.split()
        return set(zip(*(words[i:] for i in range(5))))

    sets = [shingles(t) for _, t in rows]
    near = [(i, j) for i in range(80) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    smallest = groups(near, range(80))
    got = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(set(smallest.values())) == list(range(0, 80, 2))


def test_rounds_measure_every_near_pair(spark):
    """Sketches that tell nothing: all pairs of one fingerprint are measured or connected in the end."""
    draw = np.random.default_rng(12)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(draw.permutation(words))) for i in range(14)]
    rows += [(20, rows[5][1] + " w3"), (21, rows[5][1] + " w3 w4")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = simhash.views_of(docs, "doc_id", "text", 2, 5).selectExpr(
        "text_hash", "prints", "transform(sketch, (x, i) -> IF(i = 0, x, 0L)) AS sketch")
    shown = docs.selectExpr("xxhash64(text) AS node", "text")
    own = {r["text"]: r["node"] for r in shown.collect()}
    got = {r["node"]: r["root"] for r in simhash.copies(texts, shown, 3, 5, 0.8).collect()}
    alike = [own[rows[i][1]] for i in (5, 14, 15)]
    assert set(got) | {min(alike)} == set(alike) and set(got.values()) == {min(alike)}


def test_near_fingerprints_alone_are_not_carried():
    """Texts that share a fingerprint, but too few shingles by their sketches, leave no row for the rounds."""
    draw = np.random.default_rng(13)
    n = 300
    sketch = np.concatenate([np.full((n, 1), 100), draw.integers(-2**62, 2**62, (n, simhash.SKETCH // 64))], axis=1)
    sketch[7] = sketch[250]
    sketch[7, 0] += 2
    cell = pd.DataFrame({"fp": np.full(n, 5), "sketch": list(sketch), "moved": np.zeros(n, dtype=int)})
    assert np.flatnonzero(simhash._touched(cell, 3, 0.8)).tolist() == [7, 250]


@pytest.mark.parametrize("shard_rows", [100_000, 200])
def test_block_search_meets_every_near_pair(spark, monkeypatch, shard_rows):
    """One row per text, view and block, whatever their number; a near pair counts in one block of a view."""
    monkeypatch.setattr(simhash, "LEAF", 100)
    monkeypatch.setattr(simhash, "BLOCK", 64)
    draw = np.random.default_rng(15)
    texts = {}
    for n in (400, 2000):
        prints = draw.integers(-2**63, 2**63, (n, 2))
        for bits in (1, 2, 3):
            flips = np.bitwise_or.reduce(np.uint64(1) << draw.integers(0, 64, (bits, n // 8)).astype(np.uint64))
            prints[bits * n // 8:(bits + 1) * n // 8, 0] = (prints[:n // 8, 0].view(np.uint64) ^ flips).view(np.int64)
        texts[n] = spark.createDataFrame([(i, p.tolist(), [5] * 9) for i, p in enumerate(prints)],
                                         "text_hash long, prints array<long>, sketch array<long>")
        if shard_rows > n:
            assert simhash.placed_in_blocks(texts[n], 3, shard_rows).count() == 8 * n
    # A crowded key: many texts agree in one block.
    prints[1000:1300, 1] = prints[1000:1300, 1] & ~0xFFFF | 7
    prints[1300:1400, 1] = prints[1000:1100, 1] ^ (1 << 40)
    rows = spark.createDataFrame([(i, p.tolist(), [5] * 9) for i, p in enumerate(prints)],
                                 "text_hash long, prints array<long>, sketch array<long>")
    seen = Counter()
    for (view, block, *_), cell in simhash.placed_in_blocks(rows, 3, shard_rows).toPandas().groupby(simhash.CELL):
        node, values = cell.node.to_numpy(), cell.fp.to_numpy().view(np.uint64)
        seen.update({(view, *sorted(p)) for x, y in simhash.near_in_block(values, block, 3)
                     for p in zip(node[x].tolist(), node[y].tolist())})
    every = set()
    for view in range(2):
        own = np.ascontiguousarray(prints[:, view]).view(np.uint64)
        x, y = np.nonzero(np.triu(np.bitwise_count(own[:, None] ^ own) <= 3, 1))
        every |= {(view, a, b) for a, b in zip(x.tolist(), y.tolist())}
    assert set(seen) == every and len(every) > 1000
    assert shard_rows == 200 or set(seen.values()) == {1}


def test_a_near_pair_counts_in_one_leaf():
    draw = np.random.default_rng(14)
    values = draw.integers(0, 2**63, 400).astype(np.uint64)
    for bits in (1, 2, 3):
        flips = np.bitwise_or.reduce(np.uint64(1) << draw.integers(0, 64, (bits, 400)).astype(np.uint64))
        values = np.concatenate([values, values[:400] ^ flips])
    points, medians = simhash.fit_tree(np.sort(values)[::3], 6)
    index, leaf, moved = simhash.route(values, points, medians, 6, 3)
    seen, shared = Counter(), 0
    for one in np.unique(leaf):
        own, masks = index[leaf == one], moved[leaf == one]
        x, y = np.nonzero(np.triu(np.bitwise_count(values[own][:, None] ^ values[own]) <= 3, 1))
        shared += len(x)
        seen.update(tuple(sorted(p)) for p in zip(own[x[m]], own[y[m]])) if (m := masks[x] & masks[y] == 0).any() else None
    x, y = np.nonzero(np.triu(np.bitwise_count(values[:, None] ^ values) <= 3, 1))
    assert set(seen) == set(zip(x, y)) and set(seen.values()) == {1} and shared > len(x)
