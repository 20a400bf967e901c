"""Quality classifier: gated-attention multiple-instance learning.

A document is a bag of passages (``PASSAGE_WORDS`` words each, all of the text).
Every passage is encoded as a vector of character and word statistics, then by
a learned layer; gated attention, learned from document labels alone, weighs
the passages, and the weighted passage representation is scored.

Fitting uses a bounded sample of labelled documents (``sample`` per class,
whole texts); scoring covers every document, one streaming pass without a
shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigie.llm.common import private_columns, read, written

PASSAGE_WORDS = 96
#: bytes encoded at once; bounds a task's memory.  A longer text is encoded in
#: parts of this size, and a word counts as seen before within its part.
PART_BYTES = 4 << 20
_PAIRS = 64
_GROUPS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", "\t\r\x0b\x0c", ".", ",", "!", "?",
           "|", "#$%&*", "<>", "'\"", "-_=+/\\", ":;()[]{}@^`~")


def _groups() -> np.ndarray:
    """Byte -> character group; the last two are bytes beyond ASCII and other control characters."""
    table = np.full(256, len(_GROUPS) + 1, np.uint8)
    table[128:] = len(_GROUPS)
    for i, chars in enumerate(_GROUPS):
        table[list(chars.encode())] = i
    return table


_TABLE = _groups()
_C = len(_GROUPS) + 2
_SPACE = [3, 4, 5]
N_FEATURES = _C + _PAIRS + 5


def encode_passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features [passages, N_FEATURES], text of each passage).  A text without words is one passage."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    first = np.cumsum(sizes) - sizes
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    group = _TABLE[data]
    gap = (group >= _SPACE[0]) & (group <= _SPACE[-1])
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap]).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    text_of = np.searchsorted(first, starts, "right") - 1
    n_words = np.bincount(text_of, minlength=len(texts))
    n_pass = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    pass0 = np.cumsum(n_pass) - n_pass
    total = int(n_pass.sum())
    nth = np.arange(len(starts)) - np.repeat(np.cumsum(n_words) - n_words, n_words)
    pass_of = pass0[text_of] + nth // PASSAGE_WORDS
    bag = np.repeat(np.arange(len(texts)), n_pass)
    out = np.zeros((total, N_FEATURES), np.float32)
    if not len(starts):
        return out, bag
    # bytes from one word to the next belong to the word's passage
    body = slice(int(starts[0]), len(data))
    per_byte = np.repeat(pass_of, np.diff(np.append(starts, len(data))))
    chars = np.bincount(per_byte * _C + group[body], minlength=total * _C).reshape(total, _C)
    pair = (data[body].astype(np.uint16) * 7 + np.append(data[body][1:], 32) * 29) >> 2 & (_PAIRS - 1)
    pairs = np.bincount(per_byte * _PAIRS + pair, minlength=total * _PAIRS).reshape(total, _PAIRS)
    length = np.maximum(chars.sum(axis=1, keepdims=True), 1)
    out[:, :_C] = np.sqrt(chars / length)
    out[:, _C:_C + _PAIRS] = np.sqrt(pairs / length)
    # words: number, mean and spread of lengths, distinct in the passage, seen earlier in the text
    words = np.bincount(pass_of, minlength=total)
    n = np.maximum(words, 1)
    size = (ends - starts).astype(np.float64)
    mean = np.bincount(pass_of, size, total) / n
    spread = np.sqrt(np.maximum(np.bincount(pass_of, size * size, total) / n - mean * mean, 0))
    mixed = (data.astype(np.uint64) + 1) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    inside = np.zeros(len(data), np.int64)  # position in the word
    inside[body] = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    mixed *= (inside.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(0x94D049BB133111EB)) | np.uint64(1)
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    word = run[ends] - run[starts]

    def repeated(owner: np.ndarray) -> np.ndarray:
        """Words that occur earlier with the same owner."""
        key = word ^ (owner.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        order = np.argsort(key, kind="stable")
        again = np.zeros(len(key), bool)
        again[order[1:]] = key[order[1:]] == key[order[:-1]]
        return np.bincount(pass_of, again, total) / n

    out[:, -5] = mean / 10
    out[:, -4] = spread / 10
    out[:, -3] = repeated(pass_of)
    out[:, -2] = repeated(text_of)
    out[:, -1] = np.log1p(words) / 5
    return out, bag


def _parts(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Runs of texts of about PART_BYTES; a longer text comes in several parts."""
    owners, parts, size = [], [], 0
    for i, t in enumerate(texts):
        for a in range(0, max(len(t), 1), PART_BYTES):
            owners.append(i)
            parts.append(t[a:a + PART_BYTES])
            size += len(parts[-1])
            if size >= PART_BYTES:
                yield owners, parts
                owners, parts, size = [], [], 0
    if parts:
        yield owners, parts


@dataclass(frozen=True)
class MilModel:
    """Weights: encoder W b1, attention V U w, score c c0, and the features' scaling."""

    params: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8).astype(np.float32)

    def passage_terms(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(attention logit, passage representation)."""
        p = self.params
        h = np.tanh(self.scaled(x) @ p["W"] + p["b1"])
        gate = np.tanh(h @ p["V"]) / (1 + np.exp(-(h @ p["U"])))
        return gate @ p["w"], h

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Score of each text: running attention sums over its passages, however many parts it has."""
        d = self.params["c"].shape[0]
        top, total, z = np.full(len(texts), -np.inf), np.zeros(len(texts)), np.zeros((len(texts), d))
        for owners, parts in _parts(texts):
            x, bag = encode_passages(parts)
            s, h = self.passage_terms(x)
            text = np.array(owners)[bag]
            new = top.copy()
            np.maximum.at(new, text, s)
            with np.errstate(invalid="ignore"):
                shrink = np.exp(np.where(np.isfinite(top), top - new, -np.inf))
            e = np.exp(s - new[text])
            total = total * shrink + np.bincount(text, e, len(texts))
            z *= shrink[:, None]
            np.add.at(z, text, e[:, None] * h)
            top = new
        logit = (z / np.maximum(total, 1e-30)[:, None]) @ self.params["c"] + self.params["c0"]
        return 1 / (1 + np.exp(-logit.astype(np.float64)))


def loss_and_gradient(p: dict[str, np.ndarray], x: np.ndarray, bag: np.ndarray, y: np.ndarray):
    """Mean cross entropy over bags and its gradient; ``bag`` ascending from 0, every bag with a passage."""
    n = len(y)
    h = np.tanh(x @ p["W"] + p["b1"])
    t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
    s = (t * g) @ p["w"]
    at = np.flatnonzero(np.diff(bag, prepend=-1))
    e = np.exp(s - np.maximum.reduceat(s, at)[bag])
    a = e / np.add.reduceat(e, at)[bag]
    z = np.add.reduceat(a[:, None] * h, at)
    logit = z @ p["c"] + p["c0"]
    prob = 1 / (1 + np.exp(-logit))
    loss = np.mean(np.logaddexp(0, logit) - y * logit)
    dl = (prob - y) / n
    dz = dl[:, None] * p["c"]
    da = (h * dz[bag]).sum(axis=1)
    ds = a * (da - np.add.reduceat(a * da, at)[bag])
    dt, dg = ds[:, None] * p["w"] * g * (1 - t * t), ds[:, None] * p["w"] * t * g * (1 - g)
    dh = a[:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T
    dx = dh * (1 - h * h)
    grad = {"W": x.T @ dx, "b1": dx.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ ds,
            "c": z.T @ dl, "c0": dl.sum(keepdims=True)}
    return loss, grad


def start_params(rng: np.random.Generator, features: int, width: int = 32, gate: int = 16) -> dict[str, np.ndarray]:
    normal = lambda *s: (rng.normal(size=s) / np.sqrt(s[0])).astype(np.float32)
    return {"W": normal(features, width), "b1": np.zeros(width, np.float32), "V": normal(width, gate), "U": normal(width, gate),
            "w": normal(gate), "c": normal(width), "c0": np.zeros(1, np.float32)}


def train(bags: list[np.ndarray], labels: np.ndarray, epochs: int = 40, batch: int = 64, rate: float = 0.004,
          decay: float = 1e-4, seed: int = 1) -> MilModel:
    """Adam over bags of passage features; deterministic."""
    rng = np.random.default_rng(seed)
    x = np.concatenate(bags)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 0.01)
    model = MilModel(start_params(rng, x.shape[1]), mean, scale)
    bags = [model.scaled(b) for b in bags]
    p = model.params
    m, v = ({k: np.zeros_like(w) for k, w in p.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), batch):
            pick = order[i:i + batch]
            bag = np.repeat(np.arange(len(pick)), [len(bags[j]) for j in pick])
            _, grad = loss_and_gradient(p, np.concatenate([bags[j] for j in pick]), bag, labels[pick].astype(np.float32))
            step += 1
            lr = rate * (1 - 0.9 * epoch / epochs) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for k in p:
                gk = grad[k].astype(np.float32) + decay * p[k]
                m[k] += 0.1 * (gk - m[k])
                v[k] += 0.001 * (gk * gk - v[k])
                p[k] -= lr * m[k] / (np.sqrt(v[k]) + 1e-8)
    return model


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text is divisible by 5 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = 1500, text: str = "text",
        id_col: str = "doc_id") -> MilModel:
    """Fit on at most ``sample`` labelled documents per class, none of them held out.

    The sample is the documents with the smallest hash of their id, so it is the
    same on every run.  With labels of one class or none, the model scores every
    text alike.
    """
    known = labels.select(F.col(id_col).alias("__id"), F.col(label).cast("int").alias("__y")) \
        .where(F.col("__id").isNotNull() & F.col("__y").isin(0, 1) & ~held_out("__id"))
    known = known.withColumn("__h", F.xxhash64("__id")).groupBy("__id", "__h").agg(F.min("__y").alias("__y"))
    picked = [known.where(F.col("__y") == y).orderBy("__h", "__id").limit(sample) for y in (0, 1)]
    picked = written(picked[0].unionByName(picked[1]), "labelled")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, ys, texts = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()
            rows = []
            for i, t in enumerate(texts):
                x = np.concatenate([encode_passages(parts)[0] for _, parts in _parts([t or b""])])
                rows.append((keys[i], ys[i], x.astype("<f4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                                              pa.array([r[2] for r in rows], pa.binary())], names=["id", "y", "x"])

    bags = docs.select(F.col(id_col).alias("__id"), F.col(text).cast("binary").alias("__t")).join(picked, "__id") \
        .select(F.col("__id").cast("long"), "__y", "__t").mapInArrow(run, "id long, y int, x binary")
    rows = sorted(bags.collect(), key=lambda r: (r.id, r.x))  # bounded by the sample
    y = np.array([r.y for r in rows])
    if len(set(y.tolist())) < 2:
        p = start_params(np.random.default_rng(0), N_FEATURES)
        p["c"][:] = 0
        p["c0"][:] = (4.0 if y[0] else -4.0) if len(y) else 0.0
        return MilModel(p, np.zeros(N_FEATURES), np.ones(N_FEATURES))
    return train([np.frombuffer(r.x, "<f4").reshape(-1, N_FEATURES) for r in rows], y)


@private_columns("text")
def score(docs: DataFrame, model: MilModel, text: str = "text", threshold: float = 0.3,
          drop: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``docs`` without ``drop``, with score (0 to 1) and predicted (1 if score >= threshold).

    Result for odd input: null and empty texts are one passage without words and
    are scored like any other; repeated rows score alike; no rows give no rows;
    input columns of these two names are replaced.
    """
    d = docs.withColumn("__t", F.col(text).cast("binary")).drop("score", "predicted", *drop)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                part = b.slice(i, 1024)
                s = model.score([t or b"" for t in part.column("__t").to_pylist()])
                keep = [c for c in part.schema.names if c != "__t"]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(s, pa.float64())], names=[*keep, "score"])

    schema = T.StructType([f for f in d.schema.fields if f.name != "__t"] + [T.StructField("score", T.DoubleType())])
    return d.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op1_attention_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of ``labels.quality``."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read(spark, sf_dir, "labels"))
    return score(docs, model, drop=("text",)).select("doc_id", held_out().alias("held_out"), "score", "predicted")
