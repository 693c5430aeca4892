"""Token ids in fixed-width bit packing.

Documents are dealt by ranges of their id, encoded, and written as blocks of whole documents: every id takes the
minimum number of bits that the vocabulary needs, most significant bit first, without gaps; beside the packed ids, a
block has its documents' ids and lengths and the number of ids before it in its part. Prefix sums of the parts' totals
give every document's global start, so any document or range of ids is found by one part, one block and one offset, and
a block is unpacked by numpy at once. Spark's writer stores the blocks as Parquet, so that a part appears whole or not
at all, on any file system, whichever executors are lost.

A text is cut into pieces, each of which the tokenizer encodes once and a Python worker remembers, up to a number: this
vocabulary's rules never look across white space or from a letter to the signs that end its word, so a text's ids are
those of its pieces in order.

Defined results: a null or empty text has the end id alone; null ids come first; rows with equal ids are ordered by
text; each repeated row is written; an empty table gives no rows; a text of any length stays one document of one block.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultline.llm import text as T
from vaultline.llm.common import documents, map_arrow, shared_folder

END_ID = 2
BLOCK_IDS = 1 << 16
REMEMBERED = 1_000_000

BLOCK_SCHEMA = "part int, block int, first_id long, n_ids long, doc_ids array<long>, lengths array<int>, bits int, packed binary"
OUT_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def width(vocabulary: int) -> int:
    """Bits for ids below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    raw = np.ascontiguousarray(ids, dtype=">u4").view(np.uint8).reshape(-1, 4)
    if bits % 8 == 0:
        return raw[:, 4 - bits // 8:].tobytes()
    return np.packbits(np.unpackbits(raw, axis=1)[:, 32 - bits:].reshape(-1)).tobytes()


def unpack(packed: bytes, bits: int, count: int, first: int = 0) -> np.ndarray:
    """``count`` ids from the ``first``; only their bytes are read."""
    low, high = first * bits // 8, -(-(first + count) * bits // 8)
    raw = np.frombuffer(packed, np.uint8)[low:high]
    out = np.zeros((count, 4), np.uint8)
    if bits % 8 == 0:
        out[:, 4 - bits // 8:] = raw.reshape(count, bits // 8)
    elif count:
        skip = first * bits - 8 * low
        ones = np.unpackbits(raw)[skip: skip + count * bits].reshape(count, bits)
        wide = np.zeros((count, 32), np.uint8)
        wide[:, 32 - bits:] = ones
        out = np.packbits(wide, axis=1)
    return out.reshape(-1).view(">u4").astype(np.uint32)


#: Signs that the vocabulary always splits from a letter or digit before them, when they end a word.
_TAIL = np.zeros(256, bool)
_TAIL[list(b"!#$%&()*+,-./:;=?@[]^_`{}~\"\\")] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True


def pieces_of(chunk: T.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of a chunk's pieces, that is words, each without the signs that end it and these by themselves;
    and per document the first piece's index."""
    starts, ends, _ = chunk.runs(T.NON_SPACE)
    if not len(starts):
        return starts, ends, np.zeros(chunk.n + 1, np.int64)
    last = np.maximum.accumulate(np.where(_TAIL[chunk.data], -1, np.arange(len(chunk.data))))[ends - 1]
    split = (last >= starts) & (last < ends - 1) & _PLAIN[chunk.data[last]]
    cuts = np.sort(np.concatenate([starts, last[split] + 1]))
    return cuts, np.sort(np.concatenate([ends, last[split] + 1])), np.searchsorted(cuts, chunk.offsets)


class WordEncoder:
    """Ids of texts by way of their pieces, of which up to a number are remembered by a 64-bit hash."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.remembered = Tokenizer.from_file(path), remembered
        self.forget()

    def forget(self) -> None:
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.starts, self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint32)

    def learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        """Adds pieces by their hashes, in ascending order."""
        got = [e.ids for e in self.tokenizer.encode_batch_fast([p.decode("utf-8") for p in pieces], add_special_tokens=False)]
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.place = np.insert(self.place, at, np.arange(len(self.sizes), len(self.sizes) + len(hashes), dtype=np.int32))
        sizes = np.fromiter(map(len, got), np.int32, len(got))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes, dtype=np.int64) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(got), np.uint32, int(sizes.sum()))])

    def encode(self, chunk: T.Chunk, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a chunk with the end id after each, and the documents' lengths. The vocabulary
        lower-cases; only names of special ids, which begin with ``<|``, depend on case."""
        starts, ends, first = pieces_of(chunk)
        data = chunk.data.tobytes()
        if b"<|" not in data:
            data = data.lower()
            chunk = T.Chunk(np.frombuffer(data, np.uint8), chunk.offsets, chunk.first)
        hashes, sample, back = np.unique(chunk.hashes(starts, ends), return_index=True, return_inverse=True)
        # Both are sorted: what is remembered is found by a search that moves on, without an object for each piece.
        at = np.searchsorted(self.known, hashes)
        inside = at < len(self.known)
        inside[inside] = self.known[at[inside]] == hashes[inside]
        new = np.flatnonzero(~inside)
        if len(self.known) + len(new) > self.remembered:
            self.forget()
            new = np.arange(len(hashes))
        if len(new):
            a, b = starts[sample[new]].tolist(), ends[sample[new]].tolist()
            self.learn(hashes[new], [data[x:y] for x, y in zip(a, b)])
            at = np.searchsorted(self.known, hashes)
        place = self.place[at][back]
        sizes = self.sizes[place]
        piece_end = np.zeros(len(place) + 1, np.int64)
        np.cumsum(sizes, out=piece_end[1:])
        lengths = piece_end[first[1:]] - piece_end[first[:-1]] + 1
        out = np.full(int(lengths.sum()), end_id, np.uint32)
        source = np.repeat(self.starts[place] - piece_end[:-1], sizes) + np.arange(piece_end[-1])
        target = np.arange(piece_end[-1]) + np.repeat(np.arange(chunk.n), lengths - 1)
        out[target] = self.ids[source]
        return out, lengths


_encoders: dict[str, WordEncoder] = {}


def encoder_of(path: str) -> WordEncoder:
    """One encoder for all tasks of a Python worker."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, vocabulary: int | None = None) -> DataFrame:
    """Writes all documents in ascending order of id, and returns the stored blocks."""
    from tokenizers import Tokenizer

    bits = width(vocabulary or max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1))
    ordered = (
        documents(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
        .repartitionByRange(F.asc_nulls_first("doc_id"), "tie").sortWithinPartitions(F.asc_nulls_first("doc_id"), "tie", "text")
        .select("doc_id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = encoder_of(tokenizer), TaskContext.get().partitionId()
        block, before, ids, lengths, doc_ids = 0, 0, [], [], []

        def flush() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            row = [part, block, before, len(flat), pa.concat_arrays(doc_ids).to_pylist(), np.concatenate(lengths).tolist(), bits, pack(flat, bits)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], [x.split()[0] for x in BLOCK_SCHEMA.split(", ")])

        for batch in batches:
            for chunk in T.chunks(batch.column("text"), BLOCK_IDS * 8):
                some, sizes = encoder.encode(chunk, end_id)
                ids.append(some)
                lengths.append(sizes)
                doc_ids.append(batch.column("doc_id").slice(chunk.first, chunk.n))
                if sum(map(len, ids)) >= BLOCK_IDS:
                    yield (done := flush())
                    block, before = block + 1, before + done.column("n_ids")[0].as_py()
                    ids, lengths, doc_ids = [], [], []
        if ids:
            yield flush()

    map_arrow(ordered, run, BLOCK_SCHEMA).write.option("compression", "lz4").parquet(path)
    return read_blocks(docs.sparkSession, path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The stored blocks with ``start``: the number of ids in all blocks before."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("part_start"))
    return blocks.join(F.broadcast(starts), "part").withColumn("start", F.col("part_start") + F.col("first_id"))


def read_documents(blocks: DataFrame) -> DataFrame:
    """Every document's place and checksum, from the unpacked ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                lengths = np.asarray(row["lengths"].values, np.int64)
                ids = unpack(row["packed"].as_py(), row["bits"].as_py(), int(lengths.sum())).astype("<u4")
                ends = np.cumsum(lengths)
                sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [row["doc_ids"].values, pa.array(row["start"].as_py() + ends - lengths), pa.array(lengths), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return map_arrow(blocks.select("doc_ids", "lengths", "bits", "packed", "start"), run, OUT_SCHEMA)


def token_files(docs: DataFrame, tokenizer: str, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """Writes the ids (to ``path``, or a new folder of those that the cluster shares) and reads them back."""
    return read_documents(write_ids(docs, path or shared_folder(docs.sparkSession, "token-ids"), tokenizer, end_id))
