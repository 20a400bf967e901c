"""Fuzzy lines against brute force over all pairs."""

import random

import pytest

from vigie.llm import line_dedup as D


def grams(line):
    return {line} if len(line) < 5 else {line[i:i + 5] for i in range(len(line) - 4)}


def similar(a, b):
    x, y = grams(a), grams(b)
    return len(x & y) >= 0.8 * len(x | y)


def brute(docs):
    """doc -> text left, by union-find over all pairs of different lines."""
    first, n = {}, 0
    for i, t in sorted(docs):
        for no, line in enumerate((t or "").split("\n")):
            if line.strip(" \t\r\x0b\x0c"):
                first.setdefault(line, (i, no))
    lines = sorted(first, key=first.get)
    root = {x: x for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for k, a in enumerate(lines):
        for b in lines[:k]:
            if similar(a, b):
                ra, rb = find(a), find(b)
                if ra != rb:
                    root[max(ra, rb, key=first.get)] = min(ra, rb, key=first.get)
                n += 1
    keep = {first[find(x)] for x in lines}
    return {i: t if t is None else "\n".join(x for no, x in enumerate(t.split("\n")) if not x.strip(" \t\r\x0b\x0c") or (i, no) in keep)
            for i, t in docs}, n


def corpus():
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijé", k=rng.randint(1, 9)))
    base = [" ".join(word() for _ in range(rng.choice([3, 8, 12, 20, 22, 25, 60]))) for _ in range(60)] + ["日本語のとても長い行です" * 4, "Of.", "x"]
    docs = []
    for i in range(80):
        out = []
        for _ in range(rng.randint(0, 5)):
            line = rng.choice(base)
            if rng.random() < 0.6 and len(line) > 12:
                words = line.split(" ")
                for _ in range(rng.choice([1, 1, 2])):
                    words[rng.randrange(len(words))] = word()
                line = " ".join(words)
            out.append(line)
            if rng.random() < 0.2:
                out.append(rng.choice(["", "  ", "\t"]))
        docs.append((i * 3, "\n".join(out)))
    return docs + [(900, None), (901, ""), (902, "x" * 9000)]


@pytest.mark.parametrize("all_pairs", [32, 2])
def test_against_brute_force(spark, monkeypatch, all_pairs):
    monkeypatch.setattr(D, "ALL_PAIRS", all_pairs)
    docs = corpus()
    want, links = brute(docs)
    df = spark.createDataFrame([(*d, 1, "k") for d in docs], "doc_id long, text string, n_lines int, __no string")
    got = {r.doc_id: r for r in D.dedup(df.drop("__no")).collect()}
    wrong = [i for i in want if got[i].text != want[i]]
    assert links > 40 and len(wrong) <= (2 if all_pairs == 32 else 4), wrong
    for i, t in docs:
        assert got[i].n_lines == (0 if t is None else t.count("\n") + 1) and got[i].n_removed == len(got[i].removed_lines)


def test_recall_of_the_bands(spark):
    """Of the pairs at 0.8 and more, at least 95 in 100 are candidates."""
    lines = sorted({x for _, t in corpus() for x in (t or "").split("\n") if x.strip()})
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "n long, line string").withColumn("id", D.F.xxhash64("line"))
    ids = {r.id: r.line for r in df.collect()}
    found = {frozenset((ids[r.a], ids[r.b])) for r in D.candidates(D.written(D._signatures(df.select("id", "line")), "t")).collect()}
    want = {frozenset((a, b)) for k, a in enumerate(lines) for b in lines[:k] if similar(a, b)}
    assert len(want & found) >= 0.95 * len(want) and len(want) > 40


def found_of(spark, lines):
    """The candidates among the lines, as sets of two."""
    ids = spark.createDataFrame([(x,) for x in lines], "line string").withColumn("id", D.F.xxhash64("line"))
    name = {r.id: r.line for r in ids.collect()}
    return {frozenset((name[r.a], name[r.b])) for r in D.candidates(D.written(D._signatures(ids.select("id", "line")), "t")).collect()}


def test_pairs_on_either_side_of_a_length(spark):
    """Every length has the same shingles: one character more is found at any length, and repeats count as in the check."""
    rng = random.Random(12)
    pairs = []
    for short in (31, 39, 99, 150):
        for _ in range(40):
            x = "".join(rng.choices("abcdefghij ", weights=[1] * 10 + [2], k=short - 1)) + "."
            pairs.append((x, x + rng.choice("!?:")))
    pairs += [("-" * n, "-" * m) for n, m in ((30, 36), (90, 170), (12, 400))]
    found = found_of(spark, sorted({x for p in pairs for x in p}))
    for at in range(0, 160, 40):
        part = pairs[at:at + 40]
        assert all(similar(*p) for p in part) and sum(frozenset(p) in found for p in part) >= 39, len(part[0][0])
    assert all(frozenset(p) in found for p in pairs[160:])


def test_recall_by_similarity(spark):
    """Single-character edits down to the threshold: 97 in 100 are candidates even just above 0.8."""
    rng = random.Random(21)
    near, far = [], []
    while len(near) < 300 or len(far) < 300:
        n = rng.choice([50, 140, 200, 300])
        x = y = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
        for _ in range(max(1, n // 45)):
            at = rng.randrange(n)
            y = y[:at] + rng.choice("0123456789") + y[at + 1:]
        s = len(grams(x) & grams(y)) / len(grams(x) | grams(y))
        for part, lo, hi in ((near, 0.8, 0.85), (far, 0.85, 1)):
            if lo <= s < hi and len(part) < 300:
                part.append((x, y))
    found = found_of(spark, sorted({x for p in near + far for x in p}))
    assert sum(frozenset(p) in found for p in near) >= 291 and sum(frozenset(p) in found for p in far) >= 297


def template(twins):
    """Lines on one template: twins are similar, two of different pairs are not (about 0.7)."""
    rng = random.Random(17)
    frame = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(14)]
    lines = []
    for _ in range(twins):
        word = "".join(rng.choices("qrstuvwxyz", k=12))
        lines += [" ".join(frame[:7] + [w] + frame[7:]) for w in (word, word[:-1] + "0")]
    return lines


def test_large_buckets_give_all_links(spark, monkeypatch):
    """60 twin pairs on one template: what all pairs of every bucket give, though few lines are similar to the first."""
    lines = template(60)
    docs = list(enumerate(lines))
    want, _ = brute(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {}
    for most in (32, 10 ** 9):
        monkeypatch.setattr(D, "ALL_PAIRS", most)
        got[most] = {r.doc_id: r.text for r in D.dedup(df).collect()}
    assert got[32] == got[10 ** 9] and sum(got[32][i] != want[i] for i in want) <= 1 and sum(x == "" for x in want.values()) >= 55


def test_rest_is_an_exact_join(spark):
    lines = sorted({x for _, t in corpus() for x in (t or "").split("\n") if x.strip()}) + template(20)
    df = spark.createDataFrame([(x,) for x in lines], "line string").withColumn("id", D.F.xxhash64("line"))
    name = {r.id: r.line for r in df.collect()}
    none = spark.createDataFrame([], "node long, root long")
    texts = df.select("id", "line")
    pairs = D.rest(texts.select(D.F.lit(1).alias("key"), "id"), texts, none)
    got = sorted(sorted((name[r.a], name[r.b])) for r in D.verified(pairs, D.sized(texts)).collect())
    want = sorted(sorted((a, b)) for k, a in enumerate(lines) for b in lines[:k] if similar(a, b))
    assert got == want and len(want) > 60


def family(n, changes):
    """Lines that each replace so many of the same 70 words; the words put in come from the same vocabulary."""
    rng = random.Random(23)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(50)]
    base, lines = [rng.choice(words) for _ in range(70)], set()
    while len(lines) < n:
        line = base[:]
        for at in rng.sample(range(70), changes):
            line[at] = rng.choice(words)
        lines.add(" ".join(line))
    return sorted(lines)


def test_rest_leaves_out_pairs_that_cannot_be_similar(spark, monkeypatch):
    """Near copies in two buckets, nearly all pairs below 0.8: all similar pairs and few others, in one place or in many."""
    lines = family(60, 5)
    df = spark.createDataFrame([(x,) for x in lines], "line string").withColumn("id", D.F.xxhash64("line"))
    name = {r.id: r.line for r in df.collect()}
    none = spark.createDataFrame([], "node long, root long")
    large = df.select(D.F.explode(D.F.array(D.F.lit(1), D.F.lit(2))).alias("key"), "id")
    want = {frozenset((a, b)) for k, a in enumerate(lines) for b in lines[:k] if similar(a, b)}
    got = []
    for pairs in (1 << 27, 50):
        monkeypatch.setattr(D, "PLACE_PAIRS", pairs, raising=False)
        got.append([frozenset((name[r.a], name[r.b])) for r in D.rest(large, df.select("id", "line"), none).collect()])
    assert set(got[0]) == set(got[1]) and len(got[0]) == len(set(got[0])) == len(got[1])
    assert want <= set(got[0]) and len(want) >= 5 and len(got[0]) <= 100


def test_first_place_is_kept(spark):
    """Of copies and similar lines the first by id, then by position, stays, also within one document."""
    long = "a line of some length that comes again and again in these documents, nearly"
    rows = [(7, f"{long}\n{long}\n{long}!"), (3, f"own line\n{long}!\n{long}"), (5, long), (None, "x\nx")]
    got = {r.doc_id: (r.text, r.removed_lines) for r in D.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {7: ("", [0, 1, 2]), 3: (f"own line\n{long}!", [2]), 5: ("", [0]), None: ("x", [1])}


def test_repeated_rows_null_ids_and_no_rows(spark):
    df = spark.createDataFrame([(4, "same line here\nown"), (4, "same line here\nown"), (None, "same line here"), (9, "same line here")],
                               "doc_id long, text string")
    got = sorted((str(r.doc_id), r.text) for r in D.dedup(df).collect())
    assert got == [("4", "own"), ("4", "own"), ("9", ""), ("None", "same line here")]
    assert D.dedup(df.where("false")).count() == 0
