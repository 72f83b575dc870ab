"""Token-id output in bit-plane shuffled chunks.

Layout of a chunk (all numbers little-endian):

    bytes 0-3    magic ``TPL1``
    bytes 4-7    ids in a block
    bytes 8-15   ids in the chunk
    then, for each block, 4 entries (one per byte plane) of 8 bytes:
                 offset of the compressed plane from the end of the index, its length
    then the planes, each a zstandard frame

Ids are cut into blocks of a fixed number of ids. A block of 32-bit ids is transposed into four byte
planes (all lowest bytes, then all second bytes, ...); the two upper planes of a vocabulary below
65,536 are constant and cost a few bytes, and each plane is compressed on its own. The index at the
head gives the place of every plane, so one block can be read without the others.

Chunks hold whole documents in ascending id order, and are rows of a Parquet table: Spark's writer
commits them, so any store that Spark knows will do and a lost executor's half-written files never
count. Beside the chunk the row holds what the chunk index needs: part and chunk number, number of ids,
and the ids and lengths of its documents.
"""

from __future__ import annotations

import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ledgerstar.llm.common import arrow_map, arrow_schema, ident, shared_path

MAGIC = b"TPL1"
BLOCK_IDS = 1 << 14
CHUNK_IDS = 1 << 19      # a chunk is closed at the first document end at or beyond this many ids
END_ID = 1
LEVEL = 3
CACHE_WORDS = 800_000    # words whose ids a Python worker remembers


# ---- chunks -------------------------------------------------------------------------------------

def pack_chunk(ids: np.ndarray, block_ids: int = BLOCK_IDS, level: int = LEVEL) -> bytes:
    """The ids (unsigned 32-bit) as a chunk."""
    import zstandard

    zip_ = zstandard.ZstdCompressor(level=level)
    index, planes, at = [], [], 0
    for k in range(0, len(ids), block_ids):
        octets = np.ascontiguousarray(ids[k:k + block_ids], dtype="<u4").view(np.uint8).reshape(-1, 4)
        for plane in np.ascontiguousarray(octets.T):
            z = zip_.compress(plane.tobytes())
            index.append(struct.pack("<II", at, len(z)))
            planes.append(z)
            at += len(z)
    return b"".join([MAGIC, struct.pack("<IQ", block_ids, len(ids)), *index, *planes])


def unpack_block(chunk: bytes, block: int) -> np.ndarray:
    """The ids of one block."""
    import zstandard

    if chunk[:4] != MAGIC:
        raise ValueError("not a chunk of token planes")
    block_ids, n = struct.unpack_from("<IQ", chunk, 4)
    blocks = -(-n // block_ids)
    if not 0 <= block < blocks:
        raise IndexError(block)
    size, base = min(block_ids, n - block * block_ids), 16 + 32 * blocks
    unzip = zstandard.ZstdDecompressor()
    octets = np.empty((size, 4), dtype=np.uint8)
    for p in range(4):
        at, length = struct.unpack_from("<II", chunk, 16 + 32 * block + 8 * p)
        octets[:, p] = np.frombuffer(unzip.decompress(chunk[base + at:base + at + length], max_output_size=size), dtype=np.uint8)
    return octets.reshape(-1).view("<u4")


def unpack_chunk(chunk: bytes) -> np.ndarray:
    """All ids of a chunk."""
    block_ids, n = struct.unpack_from("<IQ", chunk, 4)
    parts = [unpack_block(chunk, k) for k in range(-(-n // block_ids))]
    return np.concatenate(parts) if parts else np.empty(0, dtype="<u4")


# ---- encoding -----------------------------------------------------------------------------------

class WordEncoder:
    """Encodes texts with a public tokenizer whose pre-tokens never span white space.

    The ids of a text are those of its white-space separated pieces in order (its normaliser and its
    splitter treat white space as a border), so ids of pieces are remembered. As the tokenizer lower-cases,
    texts of characters below U+0300 (which its Unicode normalisation leaves alone) are lower-cased first,
    which makes fewer pieces; a piece that ends in one comma or full stop behind a letter (that in lower case and
    normal form still ends in a letter) is looked up without it. Texts that hold a special token's text or a separator on which Python's and the tokenizer's
    idea of white space differ go through the library whole; ``whole=True`` does so for all texts, for
    tokenizers of another kind.
    """

    def __init__(self, path: str, whole: bool = False):
        from tokenizers import Tokenizer

        self.tok, self.whole = Tokenizer.from_file(path), whole
        self.odd = [t.content for t in self.tok.get_added_tokens_decoder().values()] + ["\x1c", "\x1d", "\x1e", "\x1f"]
        self.ends = np.zeros(self.tok.get_vocab_size(), dtype=bool)  # ids that end a word
        for token, k in self.tok.get_vocab().items():
            self.ends[k] = token.endswith("</w>")
        self.known: dict[str, bytes] = {}
        self.marks = {m: self._library([m])[0] for m in ",."}

    def _library(self, texts: list[str]) -> list[bytes]:
        """The library's ids of each text, as little-endian unsigned 32-bit integers."""
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of words of letters: one call for all, cut behind the ids that end a word."""
        if not words:
            return []
        ids = np.frombuffer(self._library([" ".join(words)])[0], dtype="<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words):  # a word that is more than one pre-token
            return self._library(words)
        flat, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]

    def _learn(self, pieces: set[str]) -> None:
        known = self.known
        marked = [p for p in pieces if p[-1] in ",." and len(p) > 1 and p[-2].isalpha() and unicodedata.normalize("NFKC", p[-2].lower())[-1].isalpha()]
        new = pieces.difference(marked)
        new.update(s for p in marked if (s := p[:-1]) not in known)
        plain = [s for s in new if s.isalpha()]
        other = list(new.difference(plain))
        known.update(zip(plain, self._words(plain)))
        known.update(zip(other, self._library(other)))
        for p in marked:
            known[p] = known[p[:-1]] + self.marks[p[-1]]

    @staticmethod
    def _lowered(text: str) -> str:
        """The text in lower case where that commutes with Unicode normalisation, else as it is."""
        plain = text.isascii() or np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8).max() < 0xCC
        return text.lower() if plain else text

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Unsigned 32-bit ids of every text."""
        low = texts if self.whole else [self._lowered(t) for t in texts]
        whole = [self.whole or any(s in t for s in self.odd) for t in low]
        direct = iter(self._library([t for t, w in zip(texts, whole) if w]))
        split = [None if w else t.split() for t, w in zip(low, whole)]
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        new = set().union(*[p for p in split if p]).difference(self.known)
        if new:
            self._learn(new)
        get = self.known.__getitem__
        return [np.frombuffer(next(direct) if p is None else b"".join(map(get, p)), dtype="<u4") for p in split]


_ENCODERS: dict[tuple, WordEncoder] = {}


def encoder(path: str, whole: bool) -> WordEncoder:
    """One encoder per Python worker."""
    key = (path, whole)
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(path, whole)
    return _ENCODERS[key]


# ---- writing and reading ------------------------------------------------------------------------

CHUNK = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("chunk", T.IntegerType()), T.StructField("n_ids", T.LongType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("lengths", T.ArrayType(T.LongType())),
    T.StructField("data", T.BinaryType())])


def write_planes(df: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None,
                 end_id: int = END_ID, block_ids: int = BLOCK_IDS, chunk_ids: int = CHUNK_IDS, whole: bool = False) -> str:
    """Encode every text (NULL: empty), append ``end_id``, write chunks in ascending id order to ``path``.

    NULL ids come first; rows that repeat an id are ordered by the digest of their text. ``parts`` is the
    number of range partitions (default: Spark's shuffle partitions). Other columns are not written.
    """
    src = df.select(ident(id_col).cast("long").alias("id"), F.coalesce(ident(text_col).cast("string"), F.lit("")).alias("t"))
    src = src.withColumn("tie", F.xxhash64("t"))
    dealt = (src.repartitionByRange(parts, "id", "tie") if parts else src.repartitionByRange("id", "tie")).sortWithinPartitions("id", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema, enc, part, chunk = arrow_schema(CHUNK), encoder(tokenizer, whole), TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        docs: list[int | None] = []
        lengths: list[int] = []
        held = 0

        def close() -> pa.RecordBatch:
            data = pack_chunk(np.concatenate(ids), block_ids)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((part, chunk, held, docs, lengths, data), schema)], schema=schema)

        end = np.array([end_id], dtype="<u4")
        for b in batches:
            texts = b.column(1).to_pylist()
            for doc, got in zip(b.column(0).to_pylist(), enc.encode(texts)):
                ids += [got, end]
                docs.append(doc)
                lengths.append(len(got) + 1)
                held += len(got) + 1
                if held >= chunk_ids:
                    yield close()
                    ids, docs, lengths, held, chunk = [], [], [], 0, chunk + 1
        if docs:
            yield close()

    arrow_map(dealt.select("id", "t"), run, CHUNK).write.parquet(path)
    return path


DOC = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("chunk", T.IntegerType())])


def read_planes(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the written files, decoded from them.

    ``start`` counts the ids of all documents before it: chunk totals are summed within each part, part
    totals (one row per written part) over the parts, and the place inside the chunk is added.
    """
    chunks = spark.read.schema(CHUNK).parquet(path)
    sizes = chunks.select("part", "chunk", "n_ids")
    inside = sizes.withColumn("before", F.sum("n_ids").over(W.partitionBy("part").orderBy("chunk")) - F.col("n_ids"))
    totals = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = totals.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("base"))
    offsets = inside.join(parts, "part").select("part", "chunk", (F.col("before") + F.col("base")).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(DOC)
        for b in batches:
            for r in b.to_pylist():
                ids = unpack_chunk(r["data"])
                n = np.array(r["lengths"], dtype=np.int64)
                ends = np.cumsum(n)
                crc = [zlib.crc32(ids[e - k:e]) for e, k in zip(ends, n)]
                cols = [r["doc_ids"], ends - n, n, crc, [r["part"]] * len(n), [r["chunk"]] * len(n)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    docs = arrow_map(chunks.select("part", "chunk", "doc_ids", "lengths", "data"), run, DOC)
    return docs.join(offsets, ["part", "chunk"]).select("doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "part", "chunk")


def token_rows(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``df`` to a fresh folder in the shared place and read it back (see above)."""
    spark = df.sparkSession
    path = write_planes(df, shared_path(spark, "token-planes"), tokenizer, id_col, text_col)
    return read_planes(spark, path)
