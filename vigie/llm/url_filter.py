"""URL filters by a sorted array of 64-bit digests.

The list (rules and blocked hosts) is a sorted array of XXH64 digests with the
full strings beside it, in two plain files that every task memory-maps.  A URL
gives one key per host suffix and path length that the list knows; all keys of
a batch are looked up at once by binary search, and a hit counts only if the
stored string is the key itself, so digest collisions never decide.

A list beyond ``MAX_LOCAL_BYTES`` is not shipped to the executors: the keys are
joined with the list as a table instead, with the same result.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigie.llm.common import private_columns, read, with_results, written

#: bound of the list (bytes of its strings) up to which it is shipped as files
MAX_LOCAL_BYTES = 64 << 20

# Fixed values of the filter: rules (verdict, host, path) and blocked hosts.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
BLOCKED_HOSTS = (
    "adult-x.example.com", "adult-x.example.net", "adult-x.example.org",
    "ads-track.example.com", "ads-track.example.net", "ads-track.example.org",
    "casino-win.example.com", "casino-win.example.net", "casino-win.example.org",
    "cheap-pills.example.com", "cheap-pills.example.net", "cheap-pills.example.org",
    "free-bets.example.com", "free-bets.example.net", "free-bets.example.org",
    "spam-farm.example.com", "spam-farm.example.net", "spam-farm.example.org",
)


def host_column(url: Column) -> Column:
    """Text after the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; empty without '://'."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_column(url: Column) -> Column:
    """Text after the host up to '?', '#' or the end; empty without '://'."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def entries(spark: SparkSession, rules=RULES, hosts=BLOCKED_HOSTS) -> DataFrame:
    """The list as a table (key, verdict, is_rule): key = host and path; a blocked host covers every path."""
    rows = [(h + p, v, True, len(p)) for v, h, p in rules] + [(h, "block", False, 0) for h in hosts]
    return spark.createDataFrame(rows, "key string, verdict string, is_rule boolean, path_len int")


# --------------------------------------------------------------------------- the digest array

def build(rows: list[tuple[str, str, bool, int]], folder: str) -> tuple[str, str]:
    """Write digests.bin (sorted records) and strings.bin (the keys, in that order)."""
    keys = [r[0].encode() for r in rows]
    digests = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
    order = np.argsort(digests, kind="stable")
    lengths = np.array([len(keys[i]) for i in order], np.uint64)
    table = np.zeros((4, len(keys)), np.uint64)  # column by column: the search runs on the mapped digests
    table[0] = digests[order]
    table[1] = np.cumsum(lengths) - lengths
    table[2] = lengths
    table[3] = [(rows[i][1] == "block") | 2 * rows[i][2] | rows[i][3] << 2 for i in order]
    tag = uuid.uuid4().hex
    paths = f"{folder}/digests-{tag}.bin", f"{folder}/strings-{tag}.bin"
    table.tofile(paths[0])
    with open(paths[1], "wb") as f:
        f.write(b"".join(keys[i] for i in order))
    return paths


class DigestArray:
    """The two files, memory-mapped."""

    def __init__(self, digests: str, strings: str):
        empty = not os.path.getsize(digests)
        self.table = np.zeros((4, 0), np.uint64) if empty else np.memmap(digests, np.uint64, "r").reshape(4, -1)
        self.digests = self.table[0]
        self.strings = np.zeros(0, np.uint8) if empty else np.memmap(strings, np.uint8, "r")
        self.path_lens = sorted({int(x) >> 2 for x in np.unique(self.table[3])})

    def find(self, keys: list[bytes]) -> list[list[int]]:
        """Rows of each key: none, or several where a rule and a blocked host are the same text."""
        out: list[list[int]] = [[] for _ in keys]
        if not len(self.digests) or not keys:
            return out
        probe = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        left = np.searchsorted(self.digests, probe, "left")
        right = np.searchsorted(self.digests, probe, "right")
        for i in np.flatnonzero(right > left):
            for row in range(left[i], right[i]):  # more than one only for colliding digests
                a, n = int(self.table[1, row]), int(self.table[2, row])
                if self.strings[a:a + n].tobytes() == keys[i]:
                    out[i].append(row)
        return out


def keys_of(host: str, path: str, path_lens: list[int]) -> list[str]:
    """Keys a URL can match: every host suffix at a dot, with every listed path length the path has."""
    if not host:
        return []
    parts = host.split(".")
    suffixes = [".".join(parts[i:]) for i in range(len(parts))]
    return [s + path[:n] for s in suffixes for n in path_lens if n <= len(path)]


def _prober(digests: str, strings: str, shipped: bool):
    """Task body: (row, host, path) -> (row, rule, verdict)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = SparkFiles.get if shipped else str
        array = DigestArray(where(digests), where(strings))
        for batch in batches:
            hosts, paths = batch.column("__host").to_pylist(), batch.column("__path").to_pylist()
            keys = [keys_of(h, p, array.path_lens) for h, p in zip(hosts, paths)]
            flat = [k for ks in keys for k in ks]
            rows = iter(array.find([k.encode() for k in flat]))
            rules, verdicts = [], []
            for ks in keys:
                best, blocked = None, False
                for k in ks:  # longest host first, so it wins among keys of one length
                    for row in next(rows):
                        flags = int(array.table[3, row])
                        if not flags & 2:
                            blocked = True
                        elif best is None or len(k) > len(best[0]):
                            best = (k, flags)
                rules.append(best[0] if best else None)
                verdicts.append("block" if (best[1] & 1 if best else blocked) else "allow")
            cols = [batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
                                             names=[*batch.schema.names, "__rule", "__verdict"])
    return run


@private_columns("url")
def judge(pages: DataFrame, listed: DataFrame | None = None, url: str = "url",
          max_local_bytes: int = MAX_LOCAL_BYTES) -> DataFrame:
    """The rows of ``pages`` with host, path, rule and verdict.

    The longest rule that fits decides (of rules of one length, host and path
    together, that with the longest host); without one, a URL on a listed host (or
    a subdomain) is blocked and any other allowed.  Result for odd input: null
    and text without '://' have an empty host and path and are allowed; repeated
    rows are judged alike; no rows give no rows; input columns of these four
    names are replaced.  Repeated list entries are one entry; if two rules with
    the same host and path disagree, block wins.
    """
    spark = pages.sparkSession
    listed = entries(spark) if listed is None else listed
    listed = written(listed.where("key is not null").groupBy("key", "is_rule", "path_len")
                     .agg(F.max("verdict").alias("verdict")), "url-list")  # 'block' sorts after 'allow'
    d = pages.withColumns({"__host": host_column(F.col(url)), "__path": path_column(F.col(url))})
    size = listed.agg(F.coalesce(F.sum(F.octet_length("key") + 64), F.lit(0))).first()[0]
    if size <= max_local_bytes:
        # rows of a list of checked size; the files are built here and shipped once per executor
        rows = [(r.key, r.verdict, r.is_rule, r.path_len) for r in listed.collect()]
        digests, strings = build(rows, tempfile.mkdtemp(prefix="vigie-urls-"))
        spark.sparkContext.addFile(digests)
        spark.sparkContext.addFile(strings)
        run = _prober(os.path.basename(digests), os.path.basename(strings), shipped=True)
        schema = T.StructType([*d.schema.fields, T.StructField("__rule", T.StringType()), T.StructField("__verdict", T.StringType())])
        d = d.mapInArrow(run, schema)
    else:
        d = _joined(d, listed)
    return with_results(d, host=F.col("__host"), path=F.col("__path"), rule=F.col("__rule"), verdict=F.col("__verdict")) \
        .drop("__host", "__path", "__rule", "__verdict")


def _joined(d: DataFrame, listed: DataFrame) -> DataFrame:
    """The same judgement with the list as a table: keys joined per distinct (host, path)."""
    # as many values as there are different path lengths in the rules
    lens = F.array(*[F.lit(r.path_len) for r in listed.select("path_len").distinct().collect()])
    urls = d.select("__host", "__path").distinct().where("__host <> ''")
    parts = F.split("__host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    keys = urls.select("__host", "__path", F.explode(suffixes).alias("s")) \
        .select("__host", "__path", "s", F.explode(lens).alias("path_len")).where("path_len <= length(__path)") \
        .withColumn("key", F.expr("concat(s, substring(__path, 1, path_len))"))
    hits = keys.join(listed, ["key", "path_len"]).groupBy("__host", "__path").agg(
        F.max(F.when(F.col("is_rule"), F.struct(F.length("key").alias("n"), F.length("s").alias("host"), "key", "verdict"))).alias("best"),
        F.max(~F.col("is_rule")).alias("blocked"))
    d = d.join(hits, ["__host", "__path"], "left")
    verdict = F.coalesce(F.col("best.verdict"), F.when(F.col("blocked"), "block"), F.lit("allow"))
    return d.withColumns({"__rule": F.col("best.key"), "__verdict": verdict}).drop("best", "blocked")


def op10_url_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages against the rules and blocked hosts."""
    return judge(read(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
_HOST_ROWS = ", ".join(f"('{h}')" for h in BLOCKED_HOSTS)

#: The same judgement as one DuckDB query, rule by rule.
SQL = f"""
with u as (select page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                  regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path from pages),
r(verdict, rhost, rpath) as (values {_RULE_ROWS}),
b(bhost) as (values {_HOST_ROWS}),
m as (select page_id, host, path, arg_max(rhost || rpath, (length(rhost || rpath), length(rhost))) as rule,
             arg_max(verdict, (length(rhost || rpath), length(rhost))) as verdict
      from u join r on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by all)
select u.page_id, u.host, u.path, m.rule,
       coalesce(m.verdict, case when exists (select 1 from b where u.host = bhost or ends_with(u.host, '.' || bhost))
                                then 'block' else 'allow' end) as verdict
from u left join m using (page_id)
"""
