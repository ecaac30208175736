"""Range coder and token-id files: exact round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ratelake.llm import tokenids
from ratelake.llm.common import scratch
from ratelake.llm.queries import op2_token_ids
from ratelake.llm.rangecoder import decode_block, encode_block
from tests.llm.util import SF, frame, spark_rows

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 70000).flatmap(lambda m: st.tuples(st.just(m), st.lists(st.integers(0, m - 1), max_size=300))))
def test_any_ids_round_trip(case):
    alphabet, ids = case
    assert decode_block(encode_block(np.array(ids, np.int64), alphabet)).tolist() == ids


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 128, 5000, 300_000])
def test_shapes_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 49408, n), np.zeros(n, int), np.resize(rng.integers(0, 900, 40), n)):
        assert (decode_block(encode_block(ids, 49408)) == ids).all()


def test_model_compresses_what_repeats():
    rng = np.random.default_rng(0)
    assert len(encode_block(np.resize(rng.integers(0, 49408, 500), 200_000), 49408)) < 2 * 200_000 / 4
    assert len(encode_block(np.minimum(rng.geometric(0.1, 200_000), 49407), 49408)) < 2 * 200_000 / 2


def test_damage_and_bad_ids_are_refused():
    block = bytearray(encode_block(np.arange(200), 300))
    block[40] ^= 1
    for bad in (bytes(block), b"", bytes(block[:10])):
        with pytest.raises(ValueError):
            decode_block(bad)
    with pytest.raises(ValueError):
        encode_block(np.array([300]), 300)


TEXTS = [None, "", " \n\t ", "It's the CAT'S 12 dogs!!  a\tb", "ÀÉ ß µ ÿ çà", "İstanbul ΟΔΟΣ é ﬁ", "a\x1cb\x85c\xa0d",
         "<|endoftext|> x <|startoftext|>", "don't we'll 's", "日本語 テキスト 😀", "x" * 5000, "word " * 3000, "soft\xadhyphen"]


def plain(texts):
    tok = Tokenizer.from_file(PATH)
    return [tok.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_files_hold_the_ids(spark):
    rows = [(t, 10 - i, "x") for i, t in enumerate(TEXTS)] + [("same", 3, "y"), ("same", 3, "y"), ("none", None, "z")]
    docs = frame(spark, rows, "text string, doc_id int, start string")
    path = scratch(spark, "test-ids")
    tokenids.write_token_ids(docs, path, PATH, block_ids=100)
    got = sorted(((r.start, r.doc_id, r.ids) for r in tokenids.read_token_ids(spark, path).collect()))
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0] or ""))
    want, at = [], 0
    for r, ids in zip(order, plain([r[0] for r in order])):
        want.append((at, r[1], ids))
        at += len(ids)
    assert got == want
    assert spark.read.parquet(path).count() > 1


def test_empty_table(spark):
    path = scratch(spark, "test-ids")
    tokenids.write_token_ids(frame(spark, [], "doc_id long, text string"), path, PATH)
    assert tokenids.read_token_digests(spark, path).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    at = 0
    got = {r["doc_id"]: r for r in spark_rows(op2_token_ids(spark, SF))}
    assert len(got) == len(docs)
    for (doc_id, _), ids in zip(docs, plain([d.text for d in docs])):
        r = got[doc_id]
        assert (r["start"], r["n_tokens"]) == (at, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def _encoder():
    with open(PATH, encoding="utf-8") as f:
        return tokenids.TextEncoder(f.read())


def test_words_kept_take_little_memory():
    import gc
    import tracemalloc

    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("abcdefghijkl") for _ in range(8)) + rng.choice(["", ",", "!?"]) for _ in range(1000)) for _ in range(60)]
    encoder = _encoder()
    encoder.encode(texts[:1])
    tracemalloc.start()
    for i in range(0, len(texts), 20):
        encoder.encode(texts[i : i + 20])
    gc.collect()
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 6 << 20


def test_ids_stay_when_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(tokenids, "TABLE_WORDS", 50, raising=False)
    rng = random.Random(9)
    words = ["don't", "it's", "''s", "a1b22", "½x", "caf\u00e9,", "ÉTÉ", "#tag", "\u00b5m", "x" * 300, "'", "we'll", "--", "5"]
    words += ["".join(rng.choice("abcde'1.") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    encoder = _encoder()
    for _ in range(30):
        texts = [" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(8)] + ["", " \n ", "\u4e2d\u6587 <|endoftext|> x"]
        want = [encoder.tok.encode(t, add_special_tokens=False).ids for t in texts]
        assert [x.tolist() for x in encoder.encode(texts)] == want
