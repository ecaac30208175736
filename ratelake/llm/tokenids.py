"""Token-ID output: texts to ids, ids to range-coded blocks, and back.

Documents are range-partitioned by id, so each partition (shard) is a stretch
of the corpus in id order. A task encodes its documents one after the other
and closes a block once it holds ``block_ids`` ids; documents are never split
over blocks. Files are Parquet with one row per block: shard, block, document
ids, document lengths, and the coded bytes (see ``rangecoder``), so Spark's
commit keeps output whole when executors are lost. Blocks are decoded alone.

Defined cases: NULL and empty text give the end id only; equal doc_ids stand
next to each other, ordered by text; NULL doc_ids come first; an empty table
gives no blocks.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratelake.llm.rangecoder import decode_block, encode_block
from ratelake.llm.text import SMALL, Words, slices

END_ID = 1
BLOCK_IDS = 1 << 20
#: Words kept by ``Recent``, and words and pieces of words kept with their ids in each worker.
CACHE_WORDS, TABLE_WORDS = 200_000, 1_000_000
#: Fixed: how the tokenizer splits a word into pieces that it encodes one by one.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Latin-1 characters that lower-casing, normalisation and white space treat
#: alike in Python and in the tokenizer: words of such texts can be looked up.
_PLAIN = bytes([9, 10, 13, *range(0x20, 0x7F), *[c for c in range(0xA1, 0x100) if c != 0xAD]])

_BLOCKS = "shard int, block int, n_ids bigint, doc_ids array<bigint>, lengths array<int>, coded binary"


class Recent:
    """A table of bounded size that forgets what was not asked for lately."""

    def __init__(self):
        self.now: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def missing(self, keys: set[str]) -> list[str]:
        """Which keys are not known; the others are in ``now`` after the call."""
        if len(self.now) > CACHE_WORDS:
            self.now, self.before = {}, self.now
        new = []
        for k in keys - self.now.keys():
            known = self.before.get(k)
            if known is None:
                new.append(k)
            else:
                self.now[k] = known
        return new


class WordTable:
    """Ids of words by the words' 64-bit hashes, in arrays sorted by hash."""

    def __init__(self, kind: np.dtype):
        self.hash = np.zeros(0, np.uint64)
        self.at, self.n = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.used = np.zeros(0, np.int32)
        self.ids = np.zeros(0, kind)
        self.turn = 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of words, -1 where a word is not known; they hold until the next ``add``."""
        if not len(self.hash):
            return np.full(len(hashes), -1)
        i = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        i[self.hash[i] != hashes] = -1
        self.used[i[i >= 0]] = self.turn
        return i

    def add(self, hashes: np.ndarray, n: np.ndarray, ids: np.ndarray) -> None:
        """New words: hashes in ascending order, numbers of ids, ids in a row."""
        if len(self.hash) > TABLE_WORDS:
            self._forget()
        spot = np.searchsorted(self.hash, hashes)
        self.hash = np.insert(self.hash, spot, hashes)
        self.at = np.insert(self.at, spot, len(self.ids) + np.cumsum(n) - n)
        self.n = np.insert(self.n, spot, n)
        self.used = np.insert(self.used, spot, self.turn)
        self.ids = np.concatenate([self.ids, ids])

    def _forget(self) -> None:
        """The half that was not asked for lately goes, words of this turn stay."""
        middle = np.partition(self.used, len(self.used) // 2)[len(self.used) // 2]
        keep = np.flatnonzero(self.used > min(middle, self.turn - 1))
        self.ids = self.of(keep)
        self.hash, self.n, self.used = self.hash[keep], self.n[keep], self.used[keep]
        self.at = np.cumsum(self.n) - self.n

    def of(self, places: np.ndarray) -> np.ndarray:
        """The ids of words one after the other."""
        n = self.n[places]
        return self.ids[np.repeat(self.at[places] - np.cumsum(n) + n, n) + np.arange(n.sum())]


class TextEncoder:
    """Ids of texts by a public tokenizer, words that recur looked up.

    The tokenizer splits at white space before merging, so a text's ids are
    the ids of its words in a row. Texts with other characters or special
    token strings go to the tokenizer whole.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.pieces_of = regex.compile(PIECES).findall
        self.tok = Tokenizer.from_str(definition)
        self.size = self.tok.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.table = WordTable(self.kind)

    def _plain(self, text: str) -> bool:
        try:
            return not text.encode("latin-1").translate(None, _PLAIN) and "<|" not in text
        except UnicodeEncodeError:
            return False

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _piece_ids(self, pieces: list[str], at_once: int = 2000) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids, and ids, of single pieces, many in one text: the tokenizer numbers them in order."""
        n, ids = [np.zeros(0, np.int64)], [np.zeros(0, self.kind)]
        for i in range(0, len(pieces), at_once):
            part = pieces[i : i + at_once]
            e = self.tok.encode(" ".join(part), add_special_tokens=False)
            number = np.array(e.word_ids, np.int64)
            if number[-1] + 1 == len(part):
                n.append(np.bincount(number, minlength=len(part)))
                ids.append(np.array(e.ids, self.kind))
            else:
                raw = self._ids(part)
                n.append(np.array([len(r) // self.kind.itemsize for r in raw], np.int64))
                ids.append(np.frombuffer(b"".join(raw), self.kind))
        return np.concatenate(n), np.concatenate(ids)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Enter words that the table does not hold, those of several pieces by their pieces."""
        single = np.array([w.isalpha() for w in words], bool)
        several = np.flatnonzero(~single).tolist()
        split = [self.pieces_of(words[i]) for i in several]
        pieces = list(set().union(*split))
        known = _hashes(pieces)
        missing = self.table.find(known) < 0
        ones, first = np.unique(np.concatenate([hashes[single], known[missing]]), return_index=True)
        asked = [words[i] for i in np.flatnonzero(single)] + [pieces[i] for i in np.flatnonzero(missing)]
        self.table.add(ones, *self._piece_ids([asked[i] for i in first]))
        # Words that are one piece are entered; the others are their pieces in a row.
        hashes = hashes[several]
        left = np.flatnonzero(self.table.find(hashes) < 0)
        if not len(left):
            return
        number = dict(zip(pieces, range(len(pieces))))
        rows = [split[i] for i in left]
        places = self.table.find(known)[[number[p] for ps in rows for p in ps]]
        start = np.cumsum([0] + [len(ps) for ps in rows[:-1]])
        self.table.add(hashes[left], np.add.reduceat(self.table.n[places], start), self.table.of(places))

    def _looked_up(self, texts: list[str]) -> list[np.ndarray]:
        words, table = Words(pa.array(texts, pa.large_string())), self.table
        table.turn += 1
        own, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
        new = np.flatnonzero(table.find(own) < 0)
        if len(new):
            cuts = zip(words.starts[first[new]].tolist(), words.ends[first[new]].tolist())
            raw = words.data.tobytes()
            self._learn(own[new], [raw[a:b].decode() for a, b in cuts])
        places = table.find(own)[which]
        ends = np.concatenate([[0], np.cumsum(table.n[places])])[words.off]
        ids = table.of(places)
        return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        plain = [self._plain(t) for t in texts]
        whole = iter(self._ids([t for t, p in zip(texts, plain) if not p]))
        words = iter(self._looked_up([t.lower() for t, p in zip(texts, plain) if p]))
        return [next(words) if p else np.frombuffer(next(whole), self.kind) for p in plain]


def _hashes(words: list[str]) -> np.ndarray:
    return Words(pa.array(words, pa.large_string())).hashes()


_encoders: dict[int, TextEncoder] = {}


def _encoder(definition: str) -> TextEncoder:
    key = zlib.crc32(definition.encode())
    if key not in _encoders:
        _encoders[key] = TextEncoder(definition)
    return _encoders[key]


def write_token_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode every text with the tokenizer file and write id blocks to ``path``."""
    with open(tokenizer, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        encoder = _encoder(definition.value)
        shard, block = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        who: list[int | None] = []
        held = 0
        end = np.array([end_id], encoder.kind)

        def close():
            lengths = np.array([len(x) for x in ids], np.int32)
            coded = encode_block(np.concatenate(ids), encoder.size)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.array([int(lengths.sum())], pa.int64()),
                    pa.array([who], pa.list_(pa.int64())),
                    pa.array([lengths], pa.list_(pa.int32())),
                    pa.array([coded], pa.binary()),
                ],
                names=["shard", "block", "n_ids", "doc_ids", "lengths", "coded"],
            )

        for batch in batches:
            for part in slices(batch, "text", 2 * SMALL):
                names = part.column(0).to_pylist()
                for name, x in zip(names, encoder.encode(part.column(1).to_pylist())):
                    ids.append(np.concatenate([x, end]))
                    who.append(name)
                    held += len(x) + 1
                    if held >= block_ids:
                        yield close()
                        ids, who, held, block = [], [], 0, block + 1
        if who:
            yield close()

    rows.mapInArrow(run, _BLOCKS).write.parquet(path)


def _decoded(spark: SparkSession, path: str, schema: str, columns) -> DataFrame:
    """Rows per document of every block, with columns made from its ids."""

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                ids = decode_block(row["coded"])
                lengths = np.array(row["lengths"], np.int64)
                if int(lengths.sum()) != len(ids):
                    raise ValueError("lengths and ids of a block disagree")
                off = np.concatenate([[0], np.cumsum(lengths)])
                n = len(lengths)
                made = columns(ids, off)
                for i in range(0, n, 4096):
                    j = min(n, i + 4096)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["shard"]] * (j - i), pa.int32()),
                            pa.array([row["block"]] * (j - i), pa.int32()),
                            pa.array(row["doc_ids"][i:j], pa.int64()),
                            pa.array(off[i:j]),
                            pa.array(lengths[i:j]),
                            made(i, j),
                        ],
                        names=["shard", "block", "doc_id", "inside", "n_tokens", "made"],
                    )

    blocks = spark.read.schema(_BLOCKS).parquet(path)
    cols = blocks.select("shard", "block", "doc_ids", "lengths", "coded")
    rows = cols.mapInArrow(run, f"shard int, block int, doc_id bigint, inside bigint, n_tokens bigint, made {schema}")
    # Ids before each block: a running sum over shards, then over the blocks of a shard.
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    inner = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("shard", "block", F.coalesce(F.sum("n_ids").over(inner), F.lit(0)).alias("block_start")).join(sizes, "shard")
    out = rows.join(starts, ["shard", "block"])
    return out.withColumn("start", F.col("shard_start") + F.col("block_start") + F.col("inside")).select("doc_id", "start", "n_tokens", "made")


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from written blocks."""

    def columns(ids, off):
        return lambda i, j: pa.array([ids[off[d] : off[d + 1]] for d in range(i, j)], pa.list_(pa.int64()))

    return _decoded(spark, path, "array<bigint>", columns).withColumnRenamed("made", "ids")


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): CRC-32 over the decoded ids."""

    def columns(ids, off):
        raw = ids.astype("<u4")
        return lambda i, j: pa.array([zlib.crc32(raw[off[d] : off[d + 1]]) for d in range(i, j)], pa.int64())

    return _decoded(spark, path, "bigint", columns).withColumnRenamed("made", "ids_crc32")
