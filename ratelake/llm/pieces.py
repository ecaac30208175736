"""SentencePiece encoding by backtracking, and decoding.

A merge-type (BPE) vocabulary starts from single characters and keeps merging
the adjacent pair whose joined piece scores best, leftmost first. The result
has a local property: a row of pieces is the encoding of its text exactly if
every two neighbours are *compatible*, that is if re-merging their joined text
alone gives those two pieces again. So no merge queue runs over a text:

* an Aho-Corasick automaton over the vocabulary gives the longest piece at
  every position of a text;
* from the left, the longest piece compatible with the piece before is taken;
  where none is, the piece before is given up for the next shorter one. Each
  text has one encoding, so a position that failed once always fails: a bit
  field of failed positions keeps the search linear in the text;
* compatibility of a pair is found by re-merging its characters and remembered.

Where no piece holds the space mark after another character (checked on the
model; otherwise a text is one stretch), no merge crosses into the next word,
nor past a character that only single-character pieces hold. Texts are cut
there, and the ids of recurring words are looked up in a table of bounded size.

Defined cases: NULL and empty texts have no ids and decode to the empty text;
characters that no piece holds become byte pieces; repeated rows give repeated
rows; an empty table gives an empty result. Texts are taken whole, one slice of
a few MB (or one longer text) at a time.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.llm.text import slices
from ratelake.llm.tokenids import Recent

MARK = "▁"
#: Pairs of pieces whose compatibility a worker remembers.
CACHE_PAIRS = 1_000_000
#: Words longer than this are encoded each time they occur.
LONG_WORD = 64


class MergeVocabulary:
    """Pieces and scores of a merge-type model file, and its encoder."""

    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.library = sp
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes = {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif sp.is_unused(i):
                raise ValueError("unused pieces are not supported")
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                self.score[piece] = sp.get_score(i)
                self.ids[piece] = i
        if len(self.bytes) != 256:
            raise ValueError("the model must fall back to bytes")
        self.words_of = re.compile(self._word_pattern()).findall
        # Only pieces that merging their own characters builds can ever be chosen.
        self.automaton = ahocorasick.Automaton()
        built = [p for p in self.ids if self._merged(p, 0)]
        for p in built:
            self.automaton.add_word(p, len(p))
        self.automaton.make_automaton()
        known = set(built)
        #: Length of the longest shorter piece that a piece starts with (0: none).
        self.shorter = {p: next((k for k in range(len(p) - 1, 0, -1) if p[:k] in known), 0) for p in built}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words = Recent()

    def _word_pattern(self) -> str:
        """Stretches of text that no piece reaches across the borders of."""
        long = [p for p in self.ids if len(p) > 1]
        if any(MARK in p.lstrip(MARK) for p in long):
            return "(?s:.+)"
        inner = "".join(map(re.escape, sorted(set("".join(long)) - {MARK})))
        return f"{MARK}*[{inner}]+|{MARK}+|(?s:.)" if inner else "(?s:.+)"

    def _merged(self, text: str, border: int) -> bool:
        """Whether merging ``text`` ends in two pieces that meet at ``border`` (0: in one piece)."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            before = sum(map(len, parts[:at]))
            if before < border < before + len(parts[at]):
                return False
        return len(parts) == (2 if border else 1)

    def compatible(self, left: str, right: str) -> bool:
        """Whether the two pieces stay apart when their joined text is merged anew."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._merged(left + right, len(left))
        return known

    def split(self, text: str) -> list[str]:
        """The pieces of a normalised text (characters without a piece stand alone)."""
        n = len(text)
        # Matches come by their end, so the last one to start at a place is the longest.
        longest = [1] * n if n < 1024 else array("H", [1]) * n
        for end, length in self.automaton.iter(text):
            longest[end - length + 1] = length
        failed = bytearray(n // 8 + 1)
        pairs, shorter, compatible = self.pairs, self.shorter, self.compatible
        out: list[str] = []
        last, pos, length = "", 0, longest[0] if n else 0
        while pos < n:
            while length:
                end = pos + length
                piece = text[pos:end]
                if not failed[end >> 3] >> (end & 7) & 1:
                    fits = not last or pairs.get((last, piece))
                    if fits or (fits is None and compatible(last, piece)):
                        break
                length = shorter.get(piece, 0)
            if length:
                out.append(piece)
                last, pos = piece, end
                length = longest[pos] if pos < n else 0
            else:
                failed[pos >> 3] |= 1 << (pos & 7)
                out.pop()
                pos -= len(last)
                length = shorter.get(last, 0)
                last = out[-1] if out else ""
        return out

    def _word_ids(self, word: str) -> bytes:
        out = array("i")
        for p in self.split(word):
            i = self.ids.get(p)
            if i is None:
                out.extend([self.bytes[b] for b in p.encode("utf-8")])
            else:
                out.append(i)
        return out.tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids per text."""
        rows = [self.words_of(t) for t in self.library.normalize(texts)]
        for w in self.words.missing(set().union(*rows)):
            if len(w) <= LONG_WORD:
                self.words.now[w] = self._word_ids(w)
        get = self.words.now.get
        return [np.frombuffer(b"".join([get(w) or self._word_ids(w) for w in r]), "<i4") for r in rows]

    def decode(self, ids: list[list[int]]) -> list[str]:
        """Texts of rows of ids."""
        return self.library.decode(ids) if ids else []


_loaded: dict[int, MergeVocabulary] = {}


def _vocabulary(model: bytes) -> MergeVocabulary:
    key = zlib.crc32(model)
    if key not in _loaded:
        _loaded[key] = MergeVocabulary(model)
    return _loaded[key]


def _model(docs: DataFrame, path: str):
    with open(path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def _id_arrays(rows: list[np.ndarray]) -> pa.Array:
    off = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, "<i4"), *rows]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat))


def encode(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", decode: bool = False) -> DataFrame:
    """(doc_id, ids) of every text by the model file; with ``decode`` also ``decoded``."""
    held = _model(docs, model)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>" + (", decoded string" if decode else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(held.value)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = vocabulary.encode(part.column(1).to_pylist())
                made = [part.column(0), _id_arrays(ids)]
                if decode:
                    made.append(pa.array(vocabulary.decode([x.tolist() for x in ids]), pa.string()))
                yield pa.RecordBatch.from_arrays(made, names=["doc_id", "ids", "decoded"][: len(made)])

    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, model: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, text) of rows of ids by the model file (NULL ids: empty text)."""
    held = _model(rows, model)
    rows = rows.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>")).alias("ids"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(held.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                texts = vocabulary.decode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.mapInArrow(run, schema)


def digest_rows(rows: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of :func:`encode` rows with ``decoded``."""
    return rows.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
