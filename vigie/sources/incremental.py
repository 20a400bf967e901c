"""A panel that grows month by month.

``PanelStore`` keeps the panel as tables under one folder of the shared store:

* ``monthly``: one row per customer and month, straight from the order tables;
* ``core``: the panel without the outcome, partitioned by month;
* ``state``: per customer what later months need of all earlier ones (running
  hours, last payment delay, month of the last failure), one snapshot per month
  at which an append may start.

``append`` reads the order tables from its first month on, twelve months of
``monthly`` before it (the longest look-back of the panel's windows) for the
customers that have new rows, and one snapshot of ``state``.  It rewrites the
months it covers by dynamic partition overwrite and nothing else.  The outcome
depends on months still to come, so it isn't stored: ``read`` joins the latest
snapshot's failure month, one row per customer, and the result equals the panel
built from all orders at once.

Readers follow a log of finished appends.  One that stops half way leaves all months
before its first untouched and new months invisible; run it again (months that it was
to replace may be replaced in part until then).  A month whose orders are all gone
from the order tables keeps its rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigie.schema import PANEL_COLUMNS
from vigie.sources.panel import at_risk, attributed, described, history_columns, monthly_rows, time_til_outcome, with_outcome

#: months that a window of the panel may look back
LOOK_BACK = 12
_STATE = ("o_custkey", "hours", "paydex", "last_mi", "last_failure")


def month_number(col: str) -> Column:
    return F.year(col) * 12 + F.month(col)


class PanelStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # -- tables ---------------------------------------------------------------
    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def _write(self, df: DataFrame, name: str, by: str = "periode") -> None:
        """Replace the partitions that ``df`` (rebalanced by its caller) holds; others stay as they are."""
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(by).parquet(f"{self.path}/{name}"))

    def _log(self) -> list[tuple[int, str, str]]:
        """(number, first month or '', end) of the finished appends, oldest first: one line per append."""
        try:
            lines = [r[0].split("|") for r in self.spark.read.text(f"{self.path}/published").collect()]
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return []
        return sorted((int(n), since, end) for n, since, end in lines)

    def months(self) -> list[str]:
        """Months at which an append may start from a kept snapshot; the last is the end of the panel."""
        there: list[str] = []
        for _, since, end in self._log():
            # snapshots after the first month of an append tell of rows that it replaced
            there = [m for m in there if m <= since] + [end]
        return there

    # -- growth ---------------------------------------------------------------
    def append(self, sf_dir: str, since: str | None = None, until: str | None = None) -> None:
        """Take in the orders of the months from ``since`` on and before ``until``.

        Both are first days of months.  Without ``since``: everything before
        ``until``, into an empty store.  Months from ``since`` on that are in the
        store already are replaced by what the order tables hold now, so ``until``
        must not lie before the end of the store.
        """
        for day in (since, until):
            if day is not None and not day.endswith("-01"):
                raise ValueError(f"{day} is not the first day of a month")
        there = self.months()
        if since is None and there:
            raise ValueError("the store holds months already: say from which one on to append")
        if since is not None and not there:
            raise ValueError("an empty store takes everything: no first month")
        if since is not None and since > there[-1]:
            raise ValueError(f"the store ends before {there[-1]}: months up to {since} would be left out")
        if there and until is not None and until < there[-1]:
            raise ValueError(f"the store goes up to {there[-1]}: {until} would cut its months")

        self._write(monthly_rows(self.spark, sf_dir, since, until).hint("rebalance", "periode"), "monthly")
        monthly = self._table("monthly")
        if until is not None:
            monthly = monthly.where(F.col("periode") < F.lit(until).cast("date"))
        if since is None:
            known, fresh, seen = None, monthly, monthly
        else:
            known = self._state(monthly, since, there)
            fresh = monthly.where(F.col("periode") >= F.lit(since).cast("date"))
            # the look-back of customers with new rows; other customers' months are not read again
            back = monthly.where((F.col("periode") < F.lit(since).cast("date"))
                                 & (F.col("periode") >= F.add_months(F.lit(since).cast("date"), -LOOK_BACK)))
            seen = back.join(fresh.select("o_custkey").distinct(), "o_custkey", "left_semi").unionByName(fresh)
        self._write(self._core(sf_dir, seen, known, since), "core")

        end = self._end(fresh, until)
        self._write(self._advanced(known, fresh).withColumn("asof", F.lit(end).cast("date")).hint("rebalance", "asof"), "state", "asof")
        # readers follow this line, written once the tables are complete
        line = f"{len(self._log())}|{since or ''}|{end}"
        self.spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(f"{self.path}/published")

    def _end(self, fresh: DataFrame, until: str | None) -> str:
        if until is not None:
            return until
        last = fresh.agg(F.add_months(F.max("periode"), 1).cast("string")).first()[0]
        if last is None:
            raise ValueError("no order in these months")
        return last

    def _state(self, monthly: DataFrame, since: str, there: list[str]) -> DataFrame:
        """Per customer what the months before ``since`` leave behind: a snapshot, or summed again where none was kept."""
        if since in there:
            return self._table("state").where(F.col("asof") == F.lit(since).cast("date")).select(*_STATE)
        return self._advanced(None, monthly.where(F.col("periode") < F.lit(since).cast("date")))

    @staticmethod
    def _advanced(known: DataFrame | None, fresh: DataFrame) -> DataFrame:
        mi = month_number("periode")
        new = fresh.select("o_custkey", F.col("apart_heures_consommees").alias("hours"), F.col("paydex_nb_jours").alias("paydex"),
                           mi.alias("last_mi"), F.when(F.col("_has_f"), mi).alias("last_failure"))
        rows = new if known is None else known.unionByName(new)
        return rows.groupBy("o_custkey").agg(
            F.sum("hours").alias("hours"), F.max_by("paydex", "last_mi").alias("paydex"),
            F.max("last_mi").alias("last_mi"), F.max("last_failure").alias("last_failure")).select(*_STATE)

    def _core(self, sf_dir: str, seen: DataFrame, known: DataFrame | None, since: str | None) -> DataFrame:
        """Panel rows of the new months, without the outcome."""
        base = attributed(self.spark, sf_dir, seen)
        by_month = Window.partitionBy("o_custkey").orderBy("mi")
        so_far = by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        is_new = F.lit(True) if since is None else F.col("periode") >= F.lit(since).cast("date")
        rows = base.select(
            "*", F.sum(F.when(is_new, F.col("apart_heures_consommees"))).over(so_far).alias("__hours"),
            F.lag("paydex_nb_jours").over(by_month).alias("__paydex"), F.lag("mi").over(by_month).alias("__before"),
            *[e.alias(n) for n, e in history_columns(by_month).items()]).where(is_new)
        hours, paydex = F.col("__hours"), F.col("__paydex")
        if known is not None:
            earlier = known.select("o_custkey", F.col("hours").alias("__h"), F.col("paydex").alias("__p"))
            rows = rows.join(earlier, "o_custkey", "left")
            hours = F.when(F.col("__h").isNull(), hours).otherwise(F.col("__h") + F.coalesce(hours, F.lit(0.0)))
            paydex = F.when(F.col("__before").isNull(), F.col("__p")).otherwise(paydex)
        stored = [c for c in PANEL_COLUMNS if c not in ("time_til_outcome", "outcome", "random_order")]
        rows = rows.withColumn("apart_heures_consommees_cumulees", hours).withColumn("paydex_nb_jours_past_12", paydex)
        # what a row alone gives is added after the rows have moved to their months
        return described(rows.hint("rebalance", "periode")).select("o_custkey", "mi", "c_acctbal", *stored)

    # -- reading --------------------------------------------------------------
    def read(self) -> DataFrame:
        """The panel of all published months, with the outcome as known today."""
        there = self.months()
        if not there:
            raise ValueError("nothing was published yet")
        end = F.lit(there[-1]).cast("date")
        last = self._table("state").where(F.col("asof") == end).select("o_custkey", "last_failure")
        core = self._table("core").where(F.col("periode") < end)
        # the outcome of a customer that is not at risk reads no failure: those rows need not meet the snapshot
        risk = F.coalesce(at_risk(), F.lit(False))
        core = core.where(risk).join(last, "o_custkey", "left") \
            .unionByName(core.where(~risk).withColumn("last_failure", F.lit(None).cast(last.schema["last_failure"].dataType)))
        return with_outcome(core.withColumn("time_til_outcome", time_til_outcome(F.col("last_failure")))).select(*PANEL_COLUMNS)
