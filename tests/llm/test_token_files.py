"""Block files: exact round trips against the tokenizer itself."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigie.llm import idcodec as C
from vigie.llm import token_files as K

public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")


def expected(rows):
    """doc_id, start, n_tokens, crc of rows in ascending id order, by the library alone."""
    from tokenizers import Tokenizer
    t, out, start = Tokenizer.from_file(PATH), [], 0
    for doc_id, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_codec_round_trip_of_odd_blocks():
    rng = np.random.default_rng(2)
    blocks = [np.array([], np.uint32), np.array([7]), np.zeros(3000, int), rng.integers(0, 50257, 999),
              np.array([2 ** 29 - 2, 0, 65535, 65536, 2 ** 20] * 40), np.tile(rng.integers(0, 50257, 30), 50)]
    payloads = C.encode_blocks(blocks)
    back = C.decode_blocks(payloads, [len(b) for b in blocks])
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back))
    assert len(payloads[5]) < 600 and C.encode_blocks([blocks[3]]) == [payloads[3]]  # predicted; independent of its batch


def test_codec_id_range():
    """Every id up to the greatest comes back, predicted or not; one beyond or below is an error."""
    blocks = [np.array([2 ** 31 - 2, 0, 2 ** 29 - 1, 2 ** 29, 2 ** 30] * 40), np.full(500, 2 ** 31 - 2)]
    back = C.decode_blocks(C.encode_blocks(blocks), [len(b) for b in blocks])
    assert C.MAX_ID == 2 ** 31 - 2 and all(np.array_equal(a, b) for a, b in zip(blocks, back))
    for bad in (2 ** 31 - 1, -1):
        with pytest.raises(ValueError, match="ids are from 0"):
            C.encode_blocks([np.array([5, bad])])


def test_documents_read_back_like_the_library(spark, scratch, monkeypatch):
    rng = random.Random(4)
    odd = [None, "", " ", "a", "#", "x  y", "end \n next", "tab\t tab", "a  b", "  lead", "trail  ", "été naïve", "'s it's", "\n\n", "a b " * 9000,
           "日本語 テキスト", "é x", "a b  c", "1234567 89"]
    odd += [" ".join(rng.choices(["the", "of", "theatr", "x1", "###", "foo,", "Bar."], k=rng.randint(1, 900))) for _ in range(60)]
    rows = [(i * 3 - 20, t) for i, t in enumerate(odd)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "doc_id long, text string").withColumn("start", F.lit("clash"))
    path = f"{scratch}/ids"
    got = sorted(tuple(r) for r in K.encode(df, PATH, path).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == expected(rows)
    flat = {(r.shard, r.seq): r.ids for r in K.block_ids(spark, path).collect()}
    assert sum(map(len, flat.values())) == got[-1][1] + got[-1][2] and max(map(len, flat.values())) == K.BLOCK_IDS


def test_words_are_encoded_once_a_worker(monkeypatch):
    """A text's ids come from the memo, with any bound; a later task of the worker encodes only what is new to it."""
    import pyarrow as pa
    from tokenizers import Tokenizer
    t, rng = Tokenizer.from_file(PATH), random.Random(6)
    parts = ["a", "the", " ", " ", "\n", "\u00a0", "\u3000", "\x85", "\x1c", "é", "'s", "<|endoftext|>", "12", "!", "日", "x y"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(1500)] + [None, "", "w " * 3000]
    want = [t.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]
    monkeypatch.setattr(K, "_MEMOS", {})
    memo, given = K._memo(PATH), []
    encode = memo.encode
    monkeypatch.setattr(memo, "encode", lambda x: given.append(sum(map(len, x))) or encode(x))
    for most in (1 << 20, 7):
        monkeypatch.setattr(K, "MEMO", most)
        for part in (texts[:700], texts[700:], texts[700:]):
            flat, sizes = K.tokenise(pa.array(part, pa.string()), K._memo(PATH))
            assert [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] == want[texts.index(part[0]):][:len(part)]
        assert len(memo.words) <= most or most > 7
        if most > 7:
            assert len(given) == 7 and given[-1] <= sum(map(len, filter(None, texts[700:])))  # heads and whole texts alone
    assert K._memo(PATH) is memo


def test_wide_and_narrow_blocks_of_a_batch():
    """Blocks with ids over 29 bits are coded beside the others; a block's payload depends on the block alone."""
    rng = np.random.default_rng(9)
    blocks = [rng.integers(0, 2 ** b, n) for b, n in ((3, 900), (31, 70), (29, 200), (16, 4096), (30, 1), (16, 0), (1, 65))]
    blocks = [np.minimum(b, C.MAX_ID) for b in blocks] + [np.full(40, 2 ** 29 - 2), np.full(40, 2 ** 29 - 1)]
    payloads = C.encode_blocks(blocks)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, C.decode_blocks(payloads, list(map(len, blocks)))))
    assert [C.encode_blocks([b])[0] for b in blocks] == payloads


def test_repeated_rows_null_ids_and_no_rows(spark):
    df = spark.createDataFrame([(None, "a b"), (3, "x"), (3, "x"), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id is not None, r.n_tokens, r.start) for r in K.encode(df, PATH).collect())
    assert [g[:2] for g in got] == [(False, 1), (False, 3), (True, 2), (True, 2)] and {g[2] for g in got[2:]} == {4, 6}
    assert K.encode(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_damage_is_found(spark, scratch):
    path = f"{scratch}/a"
    K.write(spark.createDataFrame([(1, "some text to be damaged " * 50)], "doc_id long, text string"), path, PATH)
    bad = spark.read.parquet(path).withColumn("payload", F.expr("cast(concat(substring(payload, 1, 20), x'ffff', substring(payload, 23)) as binary)"))
    bad.write.parquet(f"{scratch}/b")
    with pytest.raises(Exception, match="checksum differs"):
        K.documents(spark, f"{scratch}/b").collect()


def test_checksums_join():
    m = K._shift_matrices()
    a, b = b"some bytes" * 7, b"and more of them" * 1000
    got = K.join_checksums(np.array([zlib.crc32(a)]), np.array([zlib.crc32(b)]), np.array([len(b)]), m)
    assert got[0] == zlib.crc32(a + b)
