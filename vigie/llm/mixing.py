"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, its source's
target over its source's size.  The prefix sum of expected copies along a fixed
order within the source, shifted by one offset per source, crosses an integer
boundary once per copy that is emitted.  The order runs through size classes,
so every class is sampled at its own rate and the words taken stay near the
target.

Nothing of the size of a source is ever in one task: positions come from a
histogram of (source, size class, hash slice) and a window inside each slice,
whose expected number of rows is bounded by ``SLICE_ROWS``.  Copies are counted
in whole units of 2^-32, so prefix sums are exact and reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigie.llm.common import SPACES, private_columns, read, written

SLICE_ROWS = 20_000
UNIT = 1 << 32
MAX_COPIES = 3


def size_column(text: Column) -> Column:
    """Number of words of a text; null counts 0."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{SPACES}|{SPACES}$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACES))).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), limit: int = MAX_COPIES) -> DataFrame:
    """(source, source_size) -> with ``target``: shares of all words by weight, at most ``limit`` x size.

    Sources in code point order, null last, take the weights in turn.  What a
    source cannot take is shared again by weight among the others.  Filling in
    closed form: a source with a small limit per weight fills first, so one
    sorted pass over the sources finds the common level; a source's target is
    the smaller of its limit and level x weight.
    """
    w = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    n = len(weights)
    turn = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.row_number().over(w) - 1) % n + 1)
    d = sizes.select("source", "source_size", turn.cast("long").alias("__w"),
                     (F.lit(limit) * F.col("source_size")).alias("__cap"))
    by_level = Window.orderBy((F.col("__cap") / F.col("__w")).asc(), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    d = d.select("*", F.coalesce(F.sum("__cap").over(before), F.lit(0)).alias("__full"),
                 F.sum("__w").over(after).alias("__rest"), F.sum("source_size").over(Window.partitionBy()).alias("__all"))
    # the level if exactly the sources before this one were full
    d = d.withColumn("__level", (F.col("__all") - F.col("__full")) / F.col("__rest"))
    level = F.max(F.when(F.col("__level") * F.col("__w") <= F.col("__cap"), F.col("__level"))).over(Window.partitionBy())
    return d.select("source", "source_size", F.least(level * F.col("__w"), F.col("__cap").cast("double")).alias("target"))


def with_copies(df: DataFrame, expected: str, group: Column, order_class: Column, tie: Column, seed: int,
                out: str) -> DataFrame:
    """Systematic sampling: add ``out``, the number of copies of each row (0 and up).

    ``expected``: column with the expected copies, in units of 2^-32.  ``group``:
    rows with the same value are sampled as one sequence with one random offset
    of their own.  Order within a group: ``order_class`` (few values), then
    ``tie`` (hexadecimal text, evenly spread).  Rows that agree in all of these
    are interchangeable.
    """
    keys = ["__grp", "__class", "__slice"]
    d = df.withColumns({"__grp": group, "__class": order_class, "__tie": tie})
    count = d.groupBy("__grp", "__class").agg(F.count(F.lit(1)).alias("__n"))
    # a slice is a range of the tie order, so class, slice and tie together sort like class and tie
    count = count.select("__grp", "__class", F.ceil(F.col("__n") / SLICE_ROWS).alias("__slices"))
    hashed = F.conv(F.substring("__tie", 1, 8), 16, 10).cast("long")
    d = d.join(count, ["__grp", "__class"]) \
        .withColumn("__slice", F.floor(hashed * F.col("__slices") / UNIT)).drop("__slices")
    d = written(d, "slices")
    total = d.groupBy(*keys).agg(F.sum(F.col(expected).cast("decimal(38,0)")).alias("__sum"))
    along = Window.partitionBy("__grp").orderBy("__class", "__slice").rowsBetween(Window.unboundedPreceding, -1)
    start = total.select(*keys, F.coalesce(F.sum("__sum").over(along), F.lit(0)).cast("decimal(38,0)").alias("__start"))
    inside = Window.partitionBy(*keys).orderBy("__tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col("__grp"))), 1, 8), 16, 10).cast("decimal(38,0)")
    d = d.join(start, keys).withColumn(
        "__end", F.col("__start") + offset + F.sum(F.col(expected).cast("decimal(38,0)")).over(inside))
    crossed = F.expr(f"cast(__end div {UNIT} as bigint) - cast((__end - {expected}) div {UNIT} as bigint)")
    return d.withColumn(out, crossed).drop(*keys, "__tie", "__start", "__end")


@private_columns("text", "source", "id_col")
def mix(df: DataFrame, seed: int = 17, weights: tuple[int, ...] = (1, 2, 3), text: str = "text", source: str = "source",
        id_col: str = "doc_id", drop: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``df`` with size, source_size, target, copies and taken (= copies x size).

    Result for odd input: a null text has size 0; a null source is a source of
    its own, last in order; a source without words has target 0 and no copies;
    repeated rows are sampled like others; no rows give no rows; input columns
    named like a result are replaced.
    """
    names = ("size", "source_size", "target", "copies", "taken")
    d = df.drop(*[c for c in names if c in df.columns])
    grp = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("-"))
    content = F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.lit("x"), F.col(text)))
    d = d.withColumns({"size": size_column(F.col(text)), "__source": grp, "__content": content}).drop(*drop)
    d = written(d, "sizes")
    per = d.groupBy("__source").agg(F.sum("size").alias("source_size"))
    named = per.select(F.when(F.col("__source") != "-", F.expr("substring(__source, 2)")).alias("source"), "source_size")
    goal = targets(named, weights).select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-")).alias("__source"), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT)).otherwise(0)
    goal = written(goal.withColumn("__rate", rate.cast("long")), "targets")
    d = d.join(goal, "__source")
    size_class = F.floor(8 * F.log2(F.col("size") + 1) + 1e-9).cast("long")
    d = with_copies(d, "__rate", F.col("__source"), size_class, F.col("__content"), seed, "copies")
    return d.withColumn("taken", F.col("copies") * F.col("size")).drop("__source", "__content", "__rate")


def sample(df: DataFrame, seed: int = 17, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """The mixed rows, each as often as it is taken, with the columns of ``df``.

    Copies are decided on narrow rows; texts move once, to meet their count.
    Rows that agree in every column are interchangeable: one of them stands for
    the copies of all.
    """
    own = [f"__c{i}" for i in range(len(df.columns))]
    at = dict(zip(df.columns, own))
    row = [F.xxhash64(*own).alias("__k0"), F.xxhash64(F.lit("second"), *own).alias("__k1")]
    d = df.toDF(*own).select("*", *row)
    narrow = d.select("__k0", "__k1", at["text"], at["source"], at["doc_id"])
    taken = mix(narrow, seed, weights, at["text"], at["source"], at["doc_id"], drop=(at["text"],)).where("copies > 0")
    taken = written(taken.groupBy("__k0", "__k1").agg(F.sum("copies").cast("int").alias("__n")), "copies")
    d = d.join(taken, ["__k0", "__k1"]).dropDuplicates(["__k0", "__k1"])
    d = d.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__n"))))
    return d.select(*[F.col(o).alias(c) for c, o in at.items()])


def op7_mix_systematic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, weights 1, 2, 3 in turn."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs, drop=("text",)).select("doc_id", "size", "source_size", "target", "taken", "copies")


#: The same mix as one DuckDB query: levels by a self join over sources, positions by one window.
SQL = f"""
with d as (
  select doc_id, source, coalesce('=' || source, '-') as g,
         cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size,
         md5(concat_ws('|', cast(doc_id as varchar), 'x', text)) as tie
  from documents),
s as (select g, any_value(source) as source, cast(sum(size) as bigint) as source_size from d group by g),
w as (select *, (row_number() over (order by source nulls last) - 1) % 3 + 1 as w, 3 * source_size as cap from s),
l as (select a.g, (select sum(source_size) from s) as total,
             coalesce(sum(b.cap) filter (where b.cap * a.w < a.cap * b.w), 0) as full_words,
             sum(b.w) filter (where b.cap * a.w >= a.cap * b.w) as rest
      from w a, w b group by a.g),
v as (select max((total - full_words) / cast(rest as double)) filter (where (total - full_words) / cast(rest as double) * w <= cap) as level
      from l join w using (g)),
t as (select g, source_size, least(level * w, cast(cap as double)) as target from w, v),
r as (select *, case when source_size > 0 then cast(floor(target / source_size * {UNIT}) as hugeint) else 0::hugeint end as rate,
             cast(('0x' || substr(md5('17|' || g), 1, 8)) as hugeint) as off from t),
p as (select doc_id, size, source_size, target, rate, off,
             cast(row_number() over (partition by d.g order by cast(floor(8 * log2(size + 1) + 1e-9) as bigint), tie) as hugeint) as k
      from d join r using (g))
select doc_id, size, source_size, target,
       cast((off + rate * k) // {UNIT} - (off + rate * (k - 1)) // {UNIT} as bigint) as copies,
       cast((off + rate * k) // {UNIT} - (off + rate * (k - 1)) // {UNIT} as bigint) * size as taken
from p
"""
