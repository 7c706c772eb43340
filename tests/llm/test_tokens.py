"""Byte-level BPE and unigram counts against the public libraries."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from searchlake.llm import bpe, token_count
from searchlake.llm.queries import BPE_PATH, UNIGRAM_PATH, bpe_digests, op7_byte_bpe

ODD = [
    "", " ", "  a", "a  b ", "\n\n x\t y", "it's we'll 's ''t !'s 'S they're", "a b  c", "x\x1cy \x1c z", "=" * 700, "ab" * 900,
    "日本語テキスト " * 30, "\U0001F600 ok", "aaaa " * 5 + "a" * 1500, "1234 5678.90", "a \u0085 b   c　d", "don't  stop",
    "﻿x", "é a", " ", "   x", "x \n y", " \n", "a\r\n\r\n b", "'ll 've", "_under_score__", "\x00\x01 \x02",
]


@pytest.fixture(scope="module")
def ranks():
    with open(BPE_PATH, "rb") as f:
        return bpe.parse_ranks(f.read())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_the_library_and_decode_to_the_text(ranks, library):
    rnd = random.Random(1)
    texts = ODD + ["".join(rnd.choice("ab '\n\té日 1.") for _ in range(rnd.randrange(60))) for _ in range(400)]
    tok = bpe.Tokenizer(ranks, public_tokenizers.PATTERN)
    ids = tok.encode(texts)
    assert [x.tolist() for x in ids] == [library.encode_ordinary(t) for t in texts]
    assert tok.decode(ids) == [t.encode() for t in texts]
    assert tok.decode([np.array([10**6], np.int32)]) == [None]


def test_long_matches_contract_like_single_steps(ranks):
    tok, rnd = bpe.Tokenizer(ranks, public_tokenizers.PATTERN), random.Random(2)
    words = [bytes(rnd.choice(b"aaabn") for _ in range(n)) for n in (65, 90, 200)]
    for w in words:
        (long,), _ = tok._contract([w], bpe._STEP_LONG)
        (single,), _ = tok._contract([w], bpe._STEP)
        assert long == single


def test_a_lower_new_rank_is_noticed():
    """A vocabulary whose merges make a pair of lower rank falls back."""
    ranks = {bytes([i]): i for i in range(256)} | {b"xab": 300, b"ab": 301, b"xa": 999999}
    tok = bpe.Tokenizer(ranks, r".+")
    word = b"xab" * 40
    (ids,), broken = tok._contract([word], bpe._STEP_LONG)
    assert broken
    assert tok.encode_matches([word]) == tok._contract([word], bpe._STEP)[0]


def test_digests_of_odd_rows(odd_docs, no_docs, library, spark):
    out = bpe.encode(odd_docs, BPE_PATH, public_tokenizers.PATTERN, decode=True)
    got = sorted(tuple(-1 if x is None else x for x in r) for r in bpe_digests(out).collect())
    want = []
    for r in odd_docs.collect():
        ids = library.encode_ordinary(r["text"] or "")
        want.append((-1 if r["doc_id"] is None else r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert got == sorted(want)
    back = bpe.decode(out.select("doc_id", "ids"), BPE_PATH, public_tokenizers.PATTERN)
    assert sorted(bytes(r["decoded"]) for r in back.collect()) == sorted((r["text"] or "").encode() for r in odd_docs.collect())
    assert bpe.encode(no_docs, BPE_PATH, public_tokenizers.PATTERN, decode=True).count() == 0


def test_query_equals_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    rows = {r["doc_id"]: r for r in op7_byte_bpe(spark, sf).collect()}
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode_ordinary(d["text"])
        assert rows[d["doc_id"]]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[d["doc_id"]]["decoded_sha256"] == hashlib.sha256(d["text"].encode()).hexdigest()


# --- count-only Viterbi ---------------------------------------------------------------


def unigram(pieces, byte_fallback):
    tok = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], 0, byte_fallback))
    tok.pre_tokenizer = pre_tokenizers.Metaspace(replacement=token_count.SPACE, prepend_scheme="always", split=True)
    return lambda t: len(tok.encode(t, add_special_tokens=False).ids)


MORE = [" a", "  ", "▁a", "x▁y", " q ", "a ", "▁", "日本 \U0001F600\U0001F601 z", "<0x0A> b", "\U0001F600 " * 3, "    x", "a" * 300]


def test_counts_equal_the_library():
    pieces = token_count.load_pieces(UNIGRAM_PATH)
    rnd = random.Random(3)
    texts = ODD + MORE + ["".join(rnd.choice("abcdeth ▁\n日\U0001F600") for _ in range(rnd.randrange(50))) for _ in range(300)]
    for own, fallback in ((pieces, True), ([p for p in pieces if not p[0].startswith("<0x")], False)):
        count, library = token_count.Counter(own), unigram(own, fallback)
        assert [count.text(t) for t in texts] == [library(t) for t in texts]


def test_ties_follow_the_library():
    pieces = [(token_count.SPACE, -1.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0)]
    count, library = token_count.Counter(pieces), unigram(pieces, False)
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("aab c") for _ in range(rnd.randrange(30))) for _ in range(300)]
    assert [count.text(t) for t in texts] == [library(t) for t in texts]


def test_count_table(odd_docs, no_docs):
    count = token_count.Counter(token_count.load_pieces(UNIGRAM_PATH), cache=3)
    got = {(r["doc_id"], r["n_chars"], r["n_tokens"]) for r in token_count.count_tokens(odd_docs, UNIGRAM_PATH).collect()}
    assert got == {(r["doc_id"], len(r["text"] or ""), count.text(r["text"] or "")) for r in odd_docs.collect()}
    assert token_count.count_tokens(no_docs, UNIGRAM_PATH).count() == 0
    assert odd_docs.where(F.col("doc_id") == 3).count() == 1


def test_texts_without_spaces_are_cut_where_no_token_crosses():
    """Long matches equal the library's ids, at about the cost of spaced text."""
    import random
    import time

    import public_tokenizers
    import tiktoken

    from searchlake.llm import bpe

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = bpe.parse_ranks(f.read())
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(4)
    cjk = ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(300)) for _ in range(60)] + ["漢字仮名交じり文の長い文章" * 300]
    runs = ["a" * 5000, "ab" * 2000, "é" * 400, "aaab" * 500 + "b" * 300, "x" * 65, "0" * 200, "-" * 300 + "=" * 300]
    spaced = [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(150)) for _ in range(60)]
    for texts in (cjk, runs, spaced):
        got = bpe.Tokenizer(ranks, public_tokenizers.PATTERN).encode(texts)
        assert [x.tolist() for x in got] == [library.encode_ordinary(t) for t in texts]
    took = []
    for texts in (spaced, cjk):
        tokenizer = bpe.Tokenizer(ranks, public_tokenizers.PATTERN)
        tokenizer.encode([texts[0]])
        start = time.perf_counter()
        tokenizer.encode(texts)
        took.append((time.perf_counter() - start) / sum(len(t.encode()) for t in texts))
    assert took[1] < 3 * took[0]
    # A word is cut only where the parts can't meet: never inside a token.
    tokenizer = bpe.Tokenizer(ranks, public_tokenizers.PATTERN)
    for word in ("漢字かな交じり文".encode(), b"tionthereand", b"\xff\x00\xff"):
        assert b"".join(tokenizer.cut(word)) == word


def test_forgetting_pieces_changes_no_ids(monkeypatch):
    import random

    import public_tokenizers

    from searchlake.llm import bpe

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = bpe.parse_ranks(f.read())
    rng = random.Random(5)
    words = ["".join(rng.choice("etaoin'sr,.") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=60)) + rng.choice(["", "  ", "\n\n x", " " * 5]) + "y" * rng.choice([1, 200]) for _ in range(60)]
    want = [x.tolist() for x in bpe.Tokenizer(ranks, public_tokenizers.PATTERN).encode(texts)]
    monkeypatch.setattr(bpe, "CACHE_BYTES", 20_000)
    tokenizer = bpe.Tokenizer(ranks, public_tokenizers.PATTERN)
    for _ in range(2):
        assert [x.tolist() for t in texts for x in tokenizer.encode([t])] == want
    assert tokenizer.size < 40_000 and not any(len(p) > bpe.LONG for p in tokenizer.old_tails)
