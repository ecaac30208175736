"""SentencePiece ids by backtracking: against the library and against plain merging."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from ratelake.llm import pieces
from ratelake.llm.queries import op12_sentencepiece
from tests.llm.util import SF, frame

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [
    "a", "▁", " ", "  ", "e", "th", "é", "\n", "\t", "\0", "🙂", "aaaa", "執", "0", "00", "1234", "ing", "s", "<s>", "日本",
    "İ", "ß", "𝔘", "-----", "====", "......", "ab", "​", "\r", "the", " " * 18, "<0x41>", "</s>", "﷽", "é",
]


@pytest.fixture(scope="module")
def vocabulary():
    with open(MODEL, "rb") as f:
        return pieces.MergeVocabulary(f.read())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def plain_merges(vocabulary, text):
    """The definition: best-scored adjacent pair first, leftmost first."""
    parts = list(text)
    while True:
        scored = [(-vocabulary.score[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in vocabulary.score]
        if not scored:
            return parts
        _, i = min(scored)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_random_texts(vocabulary, library):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 40))) for _ in range(4000)]
    assert [x.tolist() for x in vocabulary.encode(texts)] == library.encode(texts)


def test_split_is_plain_merging(vocabulary):
    rnd = random.Random(6)
    for _ in range(400):
        text = "".join(rnd.choice("▁abethingsao") for _ in range(rnd.randint(1, 30)))
        assert vocabulary.split(text) == plain_merges(vocabulary, text)


def test_failed_positions(vocabulary):
    # Somewhere the longest piece first leads astray, so positions fail and are given up.
    rnd = random.Random(7)
    astray = 0
    for _ in range(300):
        text = "".join(rnd.choice("▁theringaso") for _ in range(20))
        greedy, pos = [], 0
        while pos < len(text):
            k = next((k for k in range(16, 0, -1) if text[pos : pos + k] in vocabulary.shorter), 1)
            greedy.append(text[pos : pos + k])
            pos += k
        astray += greedy != vocabulary.split(text)
    assert astray > 30


@pytest.mark.parametrize("text", ["a" * 50_000, " " * 30_000 + "x", "ab" * 40_000, "日" * 20_000, "x\n" * 20_000])
def test_long_texts(vocabulary, library, text):
    assert vocabulary.encode([text])[0].tolist() == library.encode(text)


def test_models_it_cannot_follow():
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(MODEL, "rb") as f:
        m.ParseFromString(f.read())
    m.pieces[300].type = pb.ModelProto.SentencePiece.UNUSED
    with pytest.raises(ValueError):
        pieces.MergeVocabulary(m.SerializeToString())


SCHEMA = "doc_id bigint, text string, ids string, decoded string"
ROWS = [
    (1, "Hello  world, and so on.", "x", "y"), (1, "Hello  world, and so on.", "x", "y"), (2, None, None, None),
    (3, "", "x", "y"), (None, "no id\n", "x", "y"), (4, "▁ <s> 🙂 \0 é" * 300, "x", "y"), (5, "long " * 40_000, "x", "y"),
]


def test_rows(spark, library):
    docs = frame(spark, ROWS, SCHEMA)
    rows = pieces.encode(docs, MODEL)
    assert rows.columns == ["doc_id", "ids"]
    want = sorted([(repr(d), library.encode(t or "")) for d, t, *_ in ROWS])
    assert sorted((repr(r.doc_id), list(r.ids)) for r in rows.collect()) == want
    back = sorted((repr(r.doc_id), r.text) for r in pieces.decode(rows, MODEL).collect())
    assert back == sorted((repr(d), library.decode(library.encode(t or ""))) for d, t, *_ in ROWS)
    assert pieces.encode(docs.where("false"), MODEL).count() == 0
    assert pieces.decode(frame(spark, [(1, None)], "doc_id bigint, ids array<int>"), MODEL).collect()[0].text == ""


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_query(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {}
    for d in docs:
        ids = library.encode(d.text or "")
        want[d.doc_id] = (len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids)))
    out = op12_sentencepiece(spark, SF)
    assert dict(out.dtypes)["n_tokens"] == "bigint"
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out.collect()}
    assert got == want and len(docs) == len(got)
