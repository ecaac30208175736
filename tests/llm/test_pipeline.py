"""The pipeline against its stages' plain meanings, stage by stage."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from ratelake.llm import mixing
from ratelake.llm.common import fold, scratch, table
from ratelake.llm.queries import op8_quality
from tests.llm.test_decontaminate import literal as windows
from tests.llm.test_neardup import literal as groups
from tests.llm.util import SF


def test_every_stage(spark):
    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = scratch(spark, f"test-{name}")
        stage(spark, kept[-1], SF).write.parquet(path)
        kept.append(spark.read.parquet(path))
    assert all(d.columns == columns for d in kept[:-1])
    rows = [[(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()] for d in kept[:-1]]

    good = {r.doc_id for r in op8_quality(spark, SF).collect() if r.predicted}
    assert sorted(rows[1]) == sorted(r for r in rows[0] if r[0] in good)
    assert 0.5 * len(rows[0]) < len(rows[1]) < len(rows[0])

    first = {d for d, _, _, keep in groups(rows[1]) if keep}
    assert sorted(rows[2]) == sorted(r for r in rows[1] if r[0] in first)

    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    clean = {int(r[0]) for r in windows(rows[2], items) if not r[-1]}
    assert sorted(rows[3]) == sorted(r for r in rows[2] if r[0] in clean)

    times = {r.doc_id: r.repeats for r in mixing.mix(kept[3]).collect()}
    assert sorted(rows[4]) == sorted(r for r in rows[3] for _ in range(times[r[0]]))

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    at, want = 0, []
    for d, t in sorted(rows[4]):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = sorted(tuple(r[c] for c in ("doc_id", "start", "n_tokens", "ids_crc32")) for r in kept[5].collect())
    assert got == sorted(want)


def test_empty_documents(spark):
    none = table(spark, SF, "documents").where("doc_id < 0")
    for name, stage in corpus_pipeline.STAGES:
        path = scratch(spark, f"test-{name}")
        stage(spark, none, SF).write.parquet(path)
        none = spark.read.parquet(path)
    assert none.count() == 0


def test_folds_are_by_crc(spark):
    df = spark.createDataFrame([(5,), (None,)], "doc_id long")
    assert [r[0] for r in df.select(fold("doc_id", 4)).collect()] == [zlib.crc32(b"5") % 4, 0]
