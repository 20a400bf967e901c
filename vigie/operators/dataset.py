"""Dataset scan: filter, reproducible sample, flatten, project, pad ids.

``DatasetSpec`` holds the query parameters of one data set (immutable: a
quota sample never rewrites its own size or outcome).  ``fetch`` turns a panel
DataFrame and a spec into one lazy plan with the stage order

    match (F1-F7) -> sort by random_order desc -> limit -> flatten -> project -> pad ids

Filters sit directly above the scan, so Catalyst pushes them to parquet
(``PushedFilters``) and prunes columns to what the projection needs.
"""

from __future__ import annotations

import logging
import math
import sys
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigie.functions.features import pad_id
from vigie.schema import MIN_EFFECTIF, panel_type
from vigie.session import written_table

log = logging.getLogger(__name__)

# Up to this many rows are sorted in one task (orderBy().limit()); a larger n is
# found by histograms and, inside the last range, by ranks over sorted partitions.
DIRECT_N = 2_000
# Rows of the range that holds the n-th row: above, the range is cut by another histogram.
CUT_ROWS = 20_000_000
# Rows of a partition of that range while it is sorted.
RANGE_ROWS = 100_000
# Equal-width score ranges of a histogram.
RANGES = 4_096
# Id lists up to this length are sent as IN-list literals; longer ones are joined.
INLIST_LIMIT = 1_000


class EmptyDataset(Exception):
    """Raised by ``raise_if_empty``."""


@dataclass(frozen=True)
class DatasetSpec:
    date_min: str = "1970-01-01"
    date_max: str = "3000-01-01"
    fields: tuple[str, ...] | None = None
    sample_size: int | None = 1_000
    min_effectif: int | None = None
    outcome: bool | None = None
    sirets: Any = None  # list of str, or a DataFrame with a ``siret`` column
    sirens: Any = None  # list of str, or a DataFrame with a ``siren`` column
    categorical_filters: dict = field(default_factory=dict)
    proportion_positive_class: float | None = None

    def __post_init__(self):
        p = self.proportion_positive_class
        if p is not None and not 0 <= p <= 1:
            raise ValueError("proportion_positive_class must be between 0 and 1")
        if self.fields is not None and not isinstance(self.fields, tuple):
            object.__setattr__(self, "fields", tuple(self.fields))

    def with_(self, **changes) -> "DatasetSpec":
        return replace(self, **changes)

    def effective_min_effectif(self) -> int:
        return MIN_EFFECTIF if self.min_effectif is None else int(self.min_effectif)


def month_window_end(date_min: str) -> str:
    """Prediction window of a month: ``date_min <= periode < day 28`` (X11)."""
    return date_min[:-2] + "28"


def flatten(df: DataFrame) -> DataFrame:
    """Nested feature records ``{_id:{...}, value:{...}}`` -> ``value.*``."""
    if "value" in df.columns and df.schema["value"].dataType.typeName() == "struct":
        return df.select("value.*")
    return df


def _id_filter(df: DataFrame, column: str, ids: Any) -> DataFrame:
    if isinstance(ids, DataFrame):
        # Unknown size: let AQE pick broadcast or shuffle from runtime stats.
        return df.join(ids.select(column).distinct(), column, "left_semi")
    ids = [str(i) for i in ids]
    if len(ids) <= INLIST_LIMIT:
        return df.filter(F.col(column).isin(ids))
    spark = df.sparkSession
    small = spark.createDataFrame([(i,) for i in ids], f"{column} string")
    return df.join(small.distinct(), column, "left_semi")


def match(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """F1-F7 as one conjunction of predicates."""
    conds: list[Column] = [
        F.col("random_order") >= 0,
        F.col("periode") >= F.to_date(F.lit(spec.date_min)),
        F.col("periode") < F.to_date(F.lit(spec.date_max)),
        # NaN counts as missing, although it compares above every number
        F.col("effectif") >= F.lit(spec.effective_min_effectif()),
        ~F.isnan(F.col("effectif")),
    ]
    for name, value in spec.categorical_filters.items():
        if isinstance(value, (list, tuple)):
            conds.append(F.col(name).isin(list(value)))
        elif isinstance(value, (int, float, str)):  # bool is an int: equality
            conds.append(F.col(name) == F.lit(value))
        else:
            log.warning("category %s: a filter of type %s is not applied", name, type(value).__name__)
    if spec.outcome is None:
        conds.append(F.col("outcome").isNotNull())
    else:
        conds.append(F.col("outcome") == F.lit(bool(spec.outcome)))
    cond = conds[0]
    for c in conds[1:]:
        cond = cond & c
    out = df.filter(cond)
    if spec.sirets is not None:
        out = _id_filter(out, "siret", spec.sirets)
    if spec.sirens is not None:
        out = _id_filter(out, "siren", spec.sirens)
    return out


def _order(score: str, ties: Iterable[str], descending: bool) -> list[Column]:
    first = F.col(score).desc() if descending else F.col(score).asc()
    return [first] + [F.col(t).asc() for t in ties]


def _scored(df: DataFrame, score: str) -> DataFrame:
    """Rows that can be selected: a null or NaN score never is."""
    s = F.col(score)
    return df.filter(s.isNotNull() & ~F.isnan(s.cast("double")))


def top_n(
    df: DataFrame,
    n: int | None,
    score: str = "random_order",
    ties: tuple[str, ...] = ("siret", "periode"),
    descending: bool = True,
    direct_limit: int | None = None,
    cut_limit: int | None = None,
) -> DataFrame:
    """Exact top-``n`` rows by ``score`` (then ``ties``), distributed for any n.

    Up to ``DIRECT_N`` rows: ``orderBy().limit()`` (per-partition top-n, then a
    merge in one task).  Beyond: ``top_n_per`` with a single class.
    ``direct_limit`` and ``cut_limit`` replace ``DIRECT_N`` and ``CUT_ROWS``.
    Rows with a null or NaN score are never selected.
    """
    if n is None:
        return df
    n = int(n)
    if n <= 0:
        return df.limit(0)
    if n <= (DIRECT_N if direct_limit is None else direct_limit):
        return _scored(df, score).orderBy(*_order(score, ties, descending)).limit(n)
    return top_n_per(df, {None: n}, None, score, ties, descending, direct_limit, cut_limit)


def top_n_per(
    df: DataFrame,
    quotas: dict[Any, int],
    by: str | None,
    score: str = "random_order",
    ties: tuple[str, ...] = ("siret", "periode"),
    descending: bool = True,
    direct_limit: int | None = None,
    cut_limit: int | None = None,
) -> DataFrame:
    """The exact top rows of each class of column ``by``: ``quotas[value]`` rows each (``by`` None: one class).

    All classes share every pass.  One aggregation counts them and finds their
    score ranges, one histogram (``RANGES`` equal-width ranges per class) finds the
    range that holds each class's last row; what lies before is kept by a plain
    filter.  Of that last range the needed rows are taken by rank: the range is
    partitioned and sorted by (class, score, ties), written with each row's place
    in its partition, and the partitions' counts turn places into ranks.  No task
    merges more than ``DIRECT_N`` rows; a range above ``CUT_ROWS`` (a skewed score)
    is cut by another histogram first.
    """
    direct = DIRECT_N if direct_limit is None else direct_limit
    most = CUT_ROWS if cut_limit is None else cut_limit
    cls = F.lit(0) if by is None else F.col(by)
    of = (lambda v: F.lit(True)) if by is None else (lambda v: cls == F.lit(v))
    quotas = {v: int(n) for v, n in quotas.items() if int(n) > 0}
    if not quotas:
        return df.limit(0)
    df = _scored(df, score)
    if by is not None:
        df = df.filter(cls.isin(list(quotas)))
    # infinities join the largest numbers: ranges need finite ends
    s = F.least(F.greatest(F.col(score).cast("double"), F.lit(-sys.float_info.max)), F.lit(sys.float_info.max))
    stats = {(None if by is None else r["c"]): r for r in df.groupBy(cls.alias("c")).agg(
        F.count(F.lit(1)).alias("n"), F.min(s).alias("lo"), F.max(s).alias("hi")).collect()}
    quotas = {v: n for v, n in quotas.items() if v in stats}
    whole = [v for v, n in quotas.items() if stats[v]["n"] <= n]
    cut = {v: n for v, n in quotas.items() if v not in whole}
    taken = [of(v) for v in whole]
    if not cut:
        return df
    bucket = F.lit(0)
    for v in cut:
        lo, hi = stats[v]["lo"], stats[v]["hi"]
        if lo < hi:
            # scaled ends: their difference may exceed the largest double
            place = (s / 2 - F.lit(lo / 2)) / F.lit(hi / 2 - lo / 2) if hi / 2 > lo / 2 else F.when(s == hi, 1.0).otherwise(0.0)
            place = F.least(F.floor(place * RANGES), F.lit(RANGES - 1)).cast("int")
            bucket = F.when(of(v), place if not descending else F.lit(RANGES - 1) - place).otherwise(bucket)
    hist: dict[Any, dict[int, int]] = {v: {} for v in cut}
    tall = df.filter(_any([of(v) for v in cut])).groupBy(cls.alias("c"), bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    for r in tall.collect():  # at most RANGES rows per class
        hist[None if by is None else r["c"]][r["b"]] = r["n"]
    last, need, size = [], {}, {}
    for v, n in cut.items():
        at, above = _cut(hist[v], sorted(hist[v]), n)
        taken.append(of(v) & (bucket < F.lit(at)))
        last.append(of(v) & (bucket == F.lit(at)))
        need[v], size[v] = n - above, hist[v][at]
    keep, rest = df.filter(_any(taken)), df.filter(_any(last))
    narrower = any(size[v] < stats[v]["n"] for v in cut)
    if by is None and size[None] <= direct:
        rest = rest.orderBy(*_order(score, ties, descending)).limit(need[None])
    elif max(size.values()) > most and narrower:
        rest = top_n_per(rest, need, by, score, ties, descending, direct_limit, cut_limit)
    else:
        rest = _by_rank(rest, need, size, by, _order(score, ties, descending))
    return keep.unionByName(rest)


def _any(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds, F.lit(False))


def _cut(hist: dict, order: list, n: int) -> tuple[Any, int]:
    """The range that holds the n-th row, and the rows in the ranges before it."""
    above = 0
    for b in order:
        if above + hist[b] >= n:
            return b, above
        above += hist[b]
    raise ValueError("fewer rows than asked for")


def _by_rank(df: DataFrame, need: dict, size: dict, by: str | None, order: list[Column]) -> DataFrame:
    """The first ``need[v]`` of the ``size[v]`` rows of each class, by rank over range-sorted partitions.

    Rows that agree in the whole order are told apart by a hash of all their
    columns, so a repeated key spreads over partitions and reruns agree.
    """
    classes = list(need)
    rank = {v: i for i, v in enumerate(classes)}
    cls = F.lit(0)
    for v in classes[1:]:
        cls = F.when(F.col(by) == F.lit(v), F.lit(rank[v])).otherwise(cls)
    order = [F.col("__class").asc(), *order, F.xxhash64(*[F.col(c) for c in df.columns]).asc()]
    parts = max(1, math.ceil(sum(size.values()) / RANGE_ROWS))
    placed = df.withColumn("__class", cls).repartitionByRange(parts, *order).sortWithinPartitions(*order) \
        .withColumn("__part", F.spark_partition_id()) \
        .withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    placed = written_table(placed, "sample-range")
    counts = sorted((r["__class"], r["__part"], r["lo"], r["n"]) for r in placed.groupBy("__class", "__part").agg(
        F.count(F.lit(1)).alias("n"), F.min("__at").alias("lo")).collect())  # one row per class and partition
    conds, before = [], dict.fromkeys(range(len(classes)), 0)
    for c, part, lo, n in counts:
        want = min(n, need[classes[c]] - before[c])
        before[c] += n
        here = (F.col("__class") == c) & (F.col("__part") == part)
        if want > 0:
            conds.append(here if want == n else here & (F.col("__at") < lo + want))
    return placed.filter(_any(conds)).drop("__class", "__part", "__at")


def project(df: DataFrame, fields: Iterable[str] | None) -> DataFrame:
    """F8: keep ``fields`` in the given order, creating absent ones as nulls."""
    if fields is None:
        return df
    present = set(df.columns)
    cols = []
    for f in fields:
        if f in present:
            cols.append(F.col(f))
        else:
            log.info("column %s is absent: nulls", f)
            cols.append(F.lit(None).cast(panel_type(f)).alias(f))
    return df.select(*cols)


def normalise_ids(df: DataFrame) -> DataFrame:
    """ids as zero-padded strings (never truncated; nulls stay null)."""
    out = df
    if "siren" in df.columns:
        out = out.withColumn("siren", pad_id("siren", 9))
    if "siret" in df.columns:
        out = out.withColumn("siret", pad_id("siret", 14))
    return out


def fetch(panel: DataFrame, spec: DatasetSpec) -> DataFrame:
    """The data set described by ``spec`` (quota sample when
    ``proportion_positive_class`` is set)."""
    if spec.proportion_positive_class is not None:
        return fetch_quota(panel, spec)
    df = match(flatten(panel), spec)
    df = top_n(df, spec.sample_size)
    df = project(df, spec.fields)
    return normalise_ids(df)


def quota_sizes(sample_size: int, proportion: float) -> tuple[int, int]:
    """Positive / negative quotas; Python's round (half to even)."""
    n_true = round(proportion * sample_size)
    return n_true, sample_size - n_true


def fetch_quota(panel: DataFrame, spec: DatasetSpec, direct_limit: int | None = None,
                cut_limit: int | None = None) -> DataFrame:
    """O3 + U1: ``round(p*n)`` top rows with outcome true, the rest false.

    Small quotas are two sorted samples; beyond ``DIRECT_N`` rows both classes
    are cut in the same passes (``top_n_per``).  A class with fewer rows than its quota is not topped up.  The spec itself is
    left unchanged.  Without a sample size there is no quota: every labelled
    row is kept.
    """
    if spec.sample_size is None:
        return fetch(panel, spec.with_(proportion_positive_class=None))
    n_true, n_false = quota_sizes(int(spec.sample_size), float(spec.proportion_positive_class))
    base = spec.with_(proportion_positive_class=None, outcome=None)
    if max(n_true, n_false) <= (DIRECT_N if direct_limit is None else direct_limit):
        pos = fetch(panel, base.with_(outcome=True, sample_size=n_true))
        return pos.unionByName(fetch(panel, base.with_(outcome=False, sample_size=n_false)))
    df = top_n_per(match(flatten(panel), base), {True: n_true, False: n_false}, "outcome",
                   direct_limit=direct_limit, cut_limit=cut_limit)
    return normalise_ids(project(df, spec.fields))


def raise_if_empty(df: DataFrame | None) -> DataFrame:
    """F15 (eager): raise ``EmptyDataset`` when there is no row."""
    if df is None or df.isEmpty():
        raise EmptyDataset("no row matches")
    return df
