"""Content-defined chunks against a byte-by-byte rolling hash and a brute-force keeper."""

import random

import numpy as np
import xxhash

from vigie.llm import chunk_dedup as D


def rolling_cuts(text: bytes) -> list[int]:
    h, ends, last = 0, [], 0
    for b in b"\0" * D.WINDOW:
        h = (h << 1) + int(D._GEAR[b]) & 0xFFFF
    for i, b in enumerate(text):
        h = (h << 1) + int(D._GEAR[b]) & 0xFFFF
        nxt = text[i + 1] if i + 1 < len(text) else 0
        if i + 1 - last >= D.MIN_BYTES and h >> (16 - D.MASK_BITS) == 0 and nxt & 0xC0 != 0x80 and i + 1 < len(text):
            ends.append(i + 1)
            last = i + 1
    return ends + [len(text)] if text else ends


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefgéß", k=rng.randint(1, 9))) for _ in range(n))


def test_cuts_are_those_of_the_rolling_hash():
    rng = random.Random(1)
    texts = [prose(rng, n).encode() for n in (0, 1, 5, 40, 400)] + [b"", b"x"]
    got = D.cut(texts)
    assert [g for g in got] == [rolling_cuts(t) for t in texts] or max(np.diff([0] + got[4])) == D.MAX_BYTES
    for t, ends in zip(texts, got):
        assert (ends[-1:] or [0]) == [len(t)] and all(0 < b - a <= D.MAX_BYTES for a, b in zip([0] + ends, ends))
        for a, b in zip([0] + ends, ends):
            t[a:b].decode()


def test_same_bytes_and_inserted_bytes():
    one = b"z" * 3000
    assert max(np.diff([0] + D.cut([one])[0])) <= D.MAX_BYTES
    rng = random.Random(3)
    t = prose(rng, 800).encode()
    at = len(t) // 2
    while t[at] & 0xC0 == 0x80:
        at += 1
    new = t[:at] + b" inserted " + t[at:]
    cutting = lambda x: {x[a:b] for e in D.cut([x]) for a, b in zip([0] + e, e)}
    assert len(cutting(t) - cutting(new)) <= 6


def brute(rows):
    """id -> (repeated chunks, text left) for distinct ids."""
    keeper, chunks = {}, {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        ends = D.cut([b])[0]
        chunks[i] = [(a, z, xxhash.xxh128_hexdigest(b[a:z])) for a, z in zip([0] + ends, ends)]
        for a, z, h in chunks[i]:
            keeper.setdefault(h, (i, a))
    out = {}
    for i, t in rows:
        b, left, n = (t or "").encode(), b"", 0
        run = []
        for a, z, h in chunks[i] + [(None, None, None)]:
            if h is not None and keeper[h] != (i, a):
                run.append((a, z))
                n += 1
                continue
            if run:
                piece = b[run[0][0]:run[-1][1]]
                before = b[:run[0][0]]
                starts = sum(1 for k in range(len(piece)) if not piece[k:k + 1].isspace() and (piece[k - 1:k] if k else before[-1:] or b" ").isspace())
                left += b"" if starts >= D.MIN_WORDS else piece
                run = []
            if h is not None:
                left += b[a:z]
        out[i] = (n, None if t is None else left.decode())
    return out


def test_documents_against_brute_force(spark):
    rng = random.Random(7)
    shared = [prose(rng, 60) for _ in range(3)] + [prose(rng, 8)]
    rows = []
    for i in range(60):
        t = prose(rng, rng.randint(0, 120))
        for s in rng.sample(shared, rng.randint(0, 2)):
            t += "\n" + s + " " + prose(rng, 30)
        rows.append((i * 2 + 1, t))
    rows += [(500, rows[5][1]), (501, rows[5][1] + " tail"), (502, ""), (503, None), (504, shared[0] + " mid " + shared[0])]
    clean = [(600 + i, prose(rng, 200)) for i in range(10)]
    df = spark.createDataFrame(rows + clean, "doc_id long, text string").withColumn("spans", D.F.lit(1)).withColumn("n", D.F.lit(2))
    got = {r.doc_id: r for r in D.dedup(df).collect()}
    want = brute(rows + clean)
    assert {i: (r.n_repeated, r.text) for i, r in got.items()} == want
    assert not any(got[i].has_repeat for i, _ in clean) and got[500].text == "" and got[504].has_repeat and got[1].n == 2
    caught = [i for i, t in rows if t and any(s in t for s in shared[:3])]
    first = {min(i for i, t in rows if t and s in t) for s in shared[:3]}
    assert all(got[i].has_repeat for i in caught if i not in first)


def test_repeated_rows_null_ids_and_no_rows(spark):
    t = prose(random.Random(2), 80)
    df = spark.createDataFrame([(4, t), (4, t), (None, t), (9, t)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.text == t) for r in D.dedup(df).collect())
    assert got == [("4", False), ("4", False), ("9", False), ("None", True)]
    assert D.dedup(df.where("false")).count() == 0
