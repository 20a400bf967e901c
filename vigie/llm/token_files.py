"""Token-id output: texts to ids, ids to compressed blocks, and back.

Documents are range-partitioned by id, tokenised in that order and cut into
blocks of ``BLOCK_IDS`` ids.  Each block is range-coded on its own (see
``idcodec``), carries the CRC-32 of its ids and the list of document pieces it
holds, and is one row of a Parquet table, so Spark's commit protocol, splits
and any of its stores serve the format:

  shard     range of document ids (shards in order hold ascending ids)
  seq       block number in the shard
  first_doc position in the shard of the document of the first piece
  first_id  position in the shard of the block's first id
  n_ids, crc32 (of the ids as little-endian unsigned 32-bit integers), payload
  doc_ids, doc_lens  the pieces: a document's id and its ids within this block

Reading needs no order: blocks are decoded and checked wherever they are; a
document that crosses blocks gets its checksum from its pieces' checksums, and
only the number of ids per shard is summed up globally.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from vigie.llm.common import read, shared_path
from vigie.llm.idcodec import BlockError, decode_blocks, encode_blocks

BLOCK_IDS = 4096
#: blocks coded side by side; bounds a task's memory
LANES = 1024
#: words whose ids a worker remembers (some 50 bytes each); bounds its memory
MEMO = 1 << 18
#: bytes of text tokenised at once
STEP_BYTES = 4 << 20
END_ID = 2

FILE_SCHEMA = ("shard int, seq long, first_doc long, first_id long, n_ids int, crc32 long, "
               "doc_ids array<bigint>, doc_lens array<int>, payload binary")


#: white space before a space (what Python's ``\s`` takes): there the tokenizer's rule for runs of white space applies
_RUN = (r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
        r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] ")
#: words encoded as one text
_TOGETHER = 1000


class _Memo:
    """Word -> ids of a space and the word; bounded, and exact with or without an entry.

    ``flat`` holds the ids of all ``words``, ``at`` and ``size`` where a word's start and their count.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        vocabulary = tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.spaced[[i for t, i in vocabulary.items() if t[:1] == "\u0120"]] = True  # a space, byte-level
        self.words = pa.array([], pa.large_string())
        self.flat, self.at, self.size = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.array(e.ids, np.uint32) for e in found]

    def _learn(self, words: list[str]) -> None:
        """Add new words.  Words joined by spaces are encoded together: a word starts at each id that starts with a space."""
        odd = [w for w in words if not w or w[-1].isspace()]  # these need their own end of text
        even = [w for w in words if w and not w[-1].isspace()]
        parts = [even[i:i + _TOGETHER] for i in range(0, len(even), _TOGETHER)]
        ids, sizes, order = [], [], []
        for part, found in zip(parts, self.encode([" " + " ".join(p) for p in parts])):
            start = np.flatnonzero(self.spaced[found])
            if len(start) == len(part) and start[0] == 0:
                ids.append(found)
                sizes.append(np.diff(start, append=len(found)))
                order += part
            else:
                odd += part
        alone = self.encode([" " + w for w in odd])
        sizes = np.concatenate([*sizes, np.array([len(x) for x in alone], np.int64)])
        self.words = pa.concat_arrays([self.words, pa.array(order + odd, pa.large_string())])
        self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.flat = np.concatenate([self.flat, *ids, *alone])

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The places of different words; they hold until ``bound`` is called."""
        known = len(self.words)
        found = pc.index_in(words, self.words)
        if found.null_count:
            missed = words.filter(found.is_null())
            self._learn(missed.to_pylist())
            found = pc.replace_with_mask(found, found.is_null(), pc.add(pc.index_in(missed, self.words[known:]), known).cast("int32"))
        return np.asarray(found)

    def bound(self) -> None:
        """Forget the words beyond the bound, the last learned, and give back what Arrow holds for itself."""
        if len(self.words) > MEMO:
            self.words = pa.concat_arrays([self.words[:MEMO]])
            self.flat = self.flat[:self.at[MEMO]].copy()
            self.at, self.size = self.at[:MEMO].copy(), self.size[:MEMO].copy()
        pa.default_memory_pool().release_unused()


#: a worker's memos by tokenizer file: a task finds the words of the worker's earlier tasks
_MEMOS: dict[str, _Memo] = {}


def _memo(tokenizer_path: str) -> _Memo:
    if tokenizer_path not in _MEMOS:
        from tokenizers import Tokenizer
        _MEMOS.clear()
        _MEMOS[tokenizer_path] = _Memo(Tokenizer.from_file(tokenizer_path))
    return _MEMOS[tokenizer_path]


def tokenise(texts: pa.Array, memo: _Memo) -> tuple[np.ndarray, np.ndarray]:
    """Ids of whole texts, end id appended, one after the other, and the number of ids of each; null is empty.

    Byte-level pre-tokenization never joins a space to what precedes it, so a
    text may be cut before each single space after a non-space: the ids of the
    pieces, put together, are the ids of the text.  A text where white space
    meets a space is encoded in one piece.
    """
    n = len(texts)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    whole = pc.match_substring_regex(texts, _RUN)
    cut = pc.split_pattern(pc.if_else(whole, "", texts), " ")
    offsets = np.asarray(cut.offsets).astype(np.int64) - cut.offsets[0].as_py()
    words = cut.flatten()
    heads = memo.encode(pc.if_else(whole, texts, words.take(pa.array(offsets[:-1]))).to_pylist())
    coded = words.dictionary_encode()
    number = memo.numbers(coded.dictionary)[np.asarray(coded.indices)]
    # pieces: each text's words, the first one as it is without a space, and the end id
    more = np.array([len(h) for h in heads], np.int64)
    flat = np.concatenate([memo.flat, *heads, np.array([END_ID], np.uint32)])
    text = np.arange(n)
    at, size = (np.empty(len(words) + n, np.int64) for _ in range(2))
    place = np.arange(len(words)) + np.repeat(text, np.diff(offsets))
    at[place], size[place] = memo.at[number], memo.size[number]
    first, last = offsets[:-1] + text, offsets[1:] + text
    at[first], size[first] = len(memo.flat) + np.cumsum(more) - more, more
    at[last], size[last] = len(flat) - 1, 1
    memo.bound()
    ends = np.cumsum(size)
    stream = flat[np.repeat(at - (ends - size), size) + np.arange(ends[-1] if n else 0)]
    return stream, np.diff(ends[last], prepend=0)


def _encoder(tokenizer_path: str):
    """Task body: sorted (doc_id, text) batches to rows of the file schema."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        memo = _memo(tokenizer_path)
        shard = TaskContext.get().partitionId()
        ids, docs, n = [], [], 0        # waiting ids and their documents [id, length, position in shard]
        seq = first_id = n_docs = 0

        def rows(last: bool):
            nonlocal ids, docs, n, seq, first_id
            stream = np.concatenate(ids)
            take = len(stream) if last else len(stream) // BLOCK_IDS * BLOCK_IDS
            blocks = [stream[i:min(i + BLOCK_IDS, take)] for i in range(0, take, BLOCK_IDS)]
            out = []
            for block, payload in zip(blocks, encode_blocks(blocks)):
                left, pieces, first_doc = len(block), [], docs[0][2]
                while left:
                    doc = docs[0]
                    part = min(left, doc[1])
                    pieces.append((doc[0], part))
                    left -= part
                    doc[1] -= part
                    if not doc[1]:
                        docs.pop(0)
                out.append((shard, seq, first_doc, first_id, len(block), zlib.crc32(block.tobytes()),
                            [p[0] for p in pieces], [p[1] for p in pieces], payload))
                seq, first_id = seq + 1, first_id + len(block)
            ids, n = [stream[take:].copy()], len(stream) - take
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(_ARROW.types)], schema=_ARROW)

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            step = max(1, min(len(keys), STEP_BYTES * len(keys) // max(texts.nbytes, 1)))
            for i in range(0, len(keys), step):
                stream, sizes = tokenise(texts.slice(i, step), memo)
                ids.append(stream)
                n += len(stream)
                for key, size in zip(keys[i:i + step], sizes.tolist()):
                    docs.append([key, size, n_docs])
                    n_docs += 1
                if n >= LANES * BLOCK_IDS:
                    yield rows(False)
        if n:
            yield rows(True)
    return run


_ARROW = pa.schema([("shard", pa.int32()), ("seq", pa.int64()), ("first_doc", pa.int64()), ("first_id", pa.int64()),
                    ("n_ids", pa.int32()), ("crc32", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                    ("doc_lens", pa.list_(pa.int32())), ("payload", pa.binary())])


def write(docs: DataFrame, path: str, tokenizer_path: str, text: str = "text", id_col: str = "doc_id") -> None:
    """Encode all texts and write the block table at ``path``, documents in ascending id order (null first).

    Rows with the same id follow each other in the order of a hash of their text.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    d = d.select("doc_id", "text", F.xxhash64("text").alias("__tie"))
    d = d.repartitionByRange("doc_id", "__tie").sortWithinPartitions("doc_id", "__tie").select("doc_id", "text")
    d.mapInArrow(_encoder(tokenizer_path), FILE_SCHEMA).write.option("compression", "none").parquet(path)


def _decode(rows: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ids) of a batch of blocks, each checked against its checksum."""
    sizes, sums, payloads = (rows.column(c).to_pylist() for c in ("n_ids", "crc32", "payload"))
    for i in range(0, rows.num_rows, LANES):
        for j, ids in enumerate(decode_blocks(payloads[i:i + LANES], sizes[i:i + LANES]), i):
            if zlib.crc32(ids.tobytes()) != sums[j]:
                raise BlockError(f"block {rows.column('seq')[j]} of shard {rows.column('shard')[j]}: checksum differs")
            yield j, ids


def _batched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join small batches, so that many blocks are decoded side by side."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= LANES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


_PIECE = "shard int, doc long, seq long, doc_id long, n long, crc long, first_id long"


def _pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks -> one row per document piece with the checksum of its ids."""
    for rows in _batched(batches):
        cols = {c: rows.column(c).to_pylist() for c in ("shard", "seq", "first_doc", "first_id", "doc_ids", "doc_lens")}
        out = []
        for j, ids in _decode(rows):
            data, at = memoryview(ids.tobytes()), 0
            for k, (doc_id, n) in enumerate(zip(cols["doc_ids"][j], cols["doc_lens"][j])):
                out.append((cols["shard"][j], cols["first_doc"][j] + k, cols["seq"][j], doc_id, n,
                            zlib.crc32(data[4 * at:4 * (at + n)]), cols["first_id"][j] + at))
                at += n
        names = [x.split()[0] for x in _PIECE.split(", ")]
        types = [pa.int32()] + [pa.int64()] * 6
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)


def _shift_matrices(bits: int = 48) -> np.ndarray:
    """CRC-32 after 2^k more zero bytes, for each k, as images of the 32 unit vectors."""
    def times(m, v):
        return np.bitwise_xor.reduce(np.where((v[:, None] >> np.arange(32)) & 1, m[None, :], 0), axis=1)

    unit = 1 << np.arange(32, dtype=np.int64)
    one_bit = np.where(unit == 1, 0xEDB88320, unit >> 1)  # the reflected CRC-32 polynomial
    m = one_bit
    for _ in range(3):
        m = times(m, m)
    out = [m]
    for _ in range(bits - 1):
        out.append(times(out[-1], out[-1]))
    return np.array(out)


def join_checksums(crcs: np.ndarray, more: np.ndarray, lengths: np.ndarray, matrices: np.ndarray) -> np.ndarray:
    """CRC-32 of a || b from crc(a), crc(b) and the number of bytes of b, for many pairs at once."""
    v = crcs.astype(np.int64)
    for k in range(len(matrices)):
        on = (lengths >> k) & 1 == 1
        if on.any():
            w = v[on]
            v[on] = np.bitwise_xor.reduce(np.where((w[:, None] >> np.arange(32)) & 1, matrices[k][None, :], 0), axis=1)
    return v ^ more.astype(np.int64)


def _joined(ns: pd.Series, crcs: pd.Series) -> pd.Series:
    """Checksum of a document from its pieces' lengths (in ids) and checksums."""
    matrices = _shift_matrices()
    n = np.array([len(x) for x in ns])
    out = np.array([c[0] for c in crcs], np.int64)
    for i in range(1, int(n.max()) if len(n) else 0):
        on = np.flatnonzero(n > i)
        out[on] = join_checksums(out[on], np.array([crcs.iat[j][i] for j in on]),
                                 4 * np.array([ns.iat[j][i] for j in on], np.int64), matrices)
    return pd.Series(out)


def documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a block table: doc_id, start, n_tokens, ids_crc32; every block is decoded and checked."""
    table = spark.read.schema(FILE_SCHEMA).parquet(path)
    w = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    shards = table.groupBy("shard").agg(F.sum("n_ids").alias("__n")) \
        .select("shard", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__before"))
    pieces = table.mapInArrow(_pieces_of, _PIECE)
    # a document's pieces: as many as its ids fill blocks
    d = pieces.groupBy("shard", "doc").agg(
        F.first("doc_id").alias("doc_id"), F.min("first_id").alias("first_id"), F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("seq", "n", "crc"))).alias("p"))
    joined = pandas_udf(_joined, "long")
    crc = F.when(F.size("p") == 1, F.element_at("p.crc", 1)).otherwise(joined("p.n", "p.crc"))
    return d.join(shards, "shard").select(
        "doc_id", (F.col("__before") + F.col("first_id")).alias("start"), "n_tokens", crc.alias("ids_crc32"))


def block_ids(spark: SparkSession, path: str) -> DataFrame:
    """The ids themselves: shard, seq, doc_ids, doc_lens, ids (array) of every block, decoded and checked."""
    def run(batches):
        for rows in _batched(batches):
            ids = [x for _, x in _decode(rows)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(c) for c in ("shard", "seq", "doc_ids", "doc_lens")] + [pa.array(ids, pa.list_(pa.int64()))],
                names=["shard", "seq", "doc_ids", "doc_lens", "ids"])

    return spark.read.schema(FILE_SCHEMA).parquet(path).mapInArrow(
        run, "shard int, seq long, doc_ids array<bigint>, doc_lens array<int>, ids array<bigint>")


def encode(docs: DataFrame, tokenizer_path: str | None = None, path: str | None = None, text: str = "text",
           id_col: str = "doc_id") -> DataFrame:
    """Write ``docs`` as a block table and return what its documents read back as.

    ``tokenizer_path``: a file of the tokenizers library that every node has.
    Result for odd input: a null or empty text has the end id alone; a null id
    is written as null and comes first; repeated rows are documents of their
    own; no rows give an empty table; further columns are not written.
    """
    spark = docs.sparkSession
    if tokenizer_path is None:
        import public_tokenizers
        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    path = path or shared_path(spark, "ids")
    write(docs, path, tokenizer_path, text, id_col)
    return documents(spark, path)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, encoded, written, and read back."""
    return encode(read(spark, sf_dir, "documents").select("doc_id", "text"))
