"""Quality rules: robust multivariate outliers per language and source.

Every text gives a vector of transformed statistics.  A minimum-covariance-
determinant (MCD) estimate of centre and scatter is fitted per (lang, source)
by C-steps, each of which is one distributed aggregation: the half of the rows
closest to the current estimate defines the next one.  A document whose squared
Mahalanobis distance from its group's estimate exceeds the cut-off is rejected.

DataFrame functions only.  Exact and repeatable: the vector is kept as whole
numbers, so sums do not depend on the order in which tasks finish, and the
"closest half" is cut by an exact count per distance bin.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigie.llm.common import SPACES, counted, let, private_columns, read, with_results, words_of, written

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_X = ("x0", "x1", "x2", "x3", "x4")
#: rows of a table with one row per group and coordinate that are broadcast (some 10 MB)
GROUP_ROWS = 100_000
_P = len(_X)


@dataclass(frozen=True)
class QualityParams:
    """Production parameters.

    scale_floor: smallest standard deviation that a coordinate is given, in the
    coordinate's unit (thousandths of a natural logarithm).  Most clean texts
    have no symbol and no repeated line at all, so without it those coordinates
    would have zero scatter and any single symbol would be an outlier.
    cutoff: squared distance beyond which a text is rejected.
    min_group: a (lang, source) group with fewer fitted texts is judged by its
    language's estimate, that one in turn by the estimate over all texts.
    """

    min_words: int = 50
    max_repeat_pct: int = 50
    support: float = 0.75
    steps: int = 4
    prior_words: int = 60
    scale_floor: tuple[float, ...] = (60.0, 250.0, 350.0, 400.0, 180.0)
    cutoff: float = 80.0
    min_group: int = 60


# --------------------------------------------------------------------------- statistics of a text

def _covered(hashes: Column) -> Column:
    """Words covered by 3-word windows whose hash occurs twice or more."""
    def spans(pos: Column) -> Column:
        gaps = F.transform(pos, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(pos, i + 1) - p, F.lit(3))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def repeated(s: Column) -> Column:
        same = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
        return let(F.sort_array(F.transform(same, lambda x: x["p"])), spans)

    pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
    return let(F.sort_array(pairs), repeated)


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the base statistics (see ``BASE``) and ``n_upper``; null text counts as no words.

    Windows are compared by a 64-bit hash within one text.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    d = df.withColumn("__w", words_of(F.col(text)))
    w, n = F.col("__w"), F.size("__w")
    d = d.withColumn("__h", F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))))
    h = F.col("__h")
    lines = let(F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
                lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return with_results(
        d,
        n_words=n.cast("long"),
        word_chars=F.length(F.array_join(w, "")).cast("long"),
        n_symbols=F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long"),
        n_dup_lines=lines.cast("long"),
        n_repeat_words=F.when(h.isNull() | (F.size(F.array_distinct(h)) == F.size(h)), F.lit(0))
        .otherwise(_covered(h)).cast("long"),
        n_upper=F.length(F.regexp_replace(t, r"[^A-Z]+", "")).cast("long"),
    ).drop("__w", "__h")


def _vector(p: QualityParams) -> dict[str, str]:
    """SQL text of the coordinates, whole numbers: 1000 x logarithm of a rate.

    Rates are drawn towards a typical value by ``prior_words`` words, since a
    short text's rates vary more.
    """
    k = p.prior_words
    def log1p(num: str, base: str) -> str:
        return f"cast(round(1000 * ln(1 + 100 * {num} / ({base} + {k}))) as bigint)"
    return {
        "x0": f"cast(round(1000 * ln((word_chars + 5 * {k} + 0.0) / (n_words + {k}))) as bigint)",
        "x1": log1p("(n_symbols + 0.0)", "n_words"),
        "x2": log1p("(n_dup_lines + 0.0)", "n_words"),
        "x3": log1p("(n_repeat_words + 0.0)", "n_words"),
        "x4": log1p("(n_upper + 0.0)", "word_chars"),
    }


# --------------------------------------------------------------------------- MCD

def _cut(df: DataFrame, keys: list[str], value: str, weight: str, share: float, out: str) -> DataFrame:
    """Per key, the smallest ``value`` at or below which ``share`` of the weight lies (exact).

    ``value`` is a whole number from a bounded range, so the window sorts a
    bounded histogram per key, however many rows the key has.
    """
    hist = df.groupBy(*keys, value).agg(F.sum(weight).alias("__n"))
    w = Window.partitionBy(*keys)
    cum = hist.select(*keys, value, F.sum("__n").over(w.orderBy(value)).alias("__c"), F.sum("__n").over(w).alias("__t"))
    return cum.where(F.col("__c") >= F.ceil(F.lit(share) * F.col("__t"))).groupBy(*keys).agg(F.min(value).alias(out))


def _moments(df: DataFrame, keys: list[str]) -> DataFrame:
    """Mean m0.. and covariance s00, s01.. per key, from exact whole-number sums."""
    sums = [F.sum("w").alias("n")]
    sums += [F.sum(F.col("w") * F.col(x)).alias(f"a{i}") for i, x in enumerate(_X)]
    sums += [F.sum(F.col("w") * F.col(_X[i]) * F.col(_X[j])).alias(f"b{i}{j}") for i in range(_P) for j in range(i + 1)]
    d = df.groupBy(*keys).agg(*sums)
    mean = [f"cast(a{i} as double) / n as m{i}" for i in range(_P)]
    cov = [f"cast(b{i}{j} as double) / n - (cast(a{i} as double) / n) * (cast(a{j} as double) / n) as s{i}{j}"
           for i in range(_P) for j in range(i + 1)]
    return d.selectExpr(*keys, "n", *mean, *cov)


def _cholesky(d: DataFrame, keep: list[str], floor: tuple[float, ...]) -> DataFrame:
    """Lower Cholesky factor l00, l10.. of the covariance with the floors' squares on its diagonal; log-determinant."""
    d = d.select("*", *[(F.col(f"s{i}{i}") + floor[i] ** 2).alias(f"v{i}") for i in range(_P)])
    for j in range(_P):
        left = " - ".join([f"v{j}", *[f"l{j}{k} * l{j}{k}" for k in range(j)]])
        d = d.selectExpr("*", f"sqrt({left}) as l{j}{j}")
        below = [f"({' - '.join([f's{i}{j}', *[f'l{i}{k} * l{j}{k}' for k in range(j)]])}) / l{j}{j} as l{i}{j}"
                 for i in range(j + 1, _P)]
        d = d.selectExpr("*", *below)
    logdet = " + ".join(f"2 * ln(l{i}{i})" for i in range(_P))
    low = [f"l{i}{j}" for i in range(_P) for j in range(i + 1)]
    return d.selectExpr(*keep, "n", *[f"m{i}" for i in range(_P)], *low, f"{logdet} as logdet")


def _distance(d: DataFrame, out: str) -> DataFrame:
    """Squared Mahalanobis distance by forward substitution with the factor."""
    for i in range(_P):
        left = " - ".join([f"(x{i} - m{i})", *[f"l{i}{k} * z{k}" for k in range(i)]])
        d = d.selectExpr("*", f"({left}) / l{i}{i} as z{i}")
    return d.selectExpr("*", f"{' + '.join(f'z{i} * z{i}' for i in range(_P))} as {out}").drop(*[f"z{i}" for i in range(_P)])


def fit(vectors: DataFrame, p: QualityParams) -> DataFrame:
    """MCD estimate per ``grp``: grp, n_rows, n, m*, l* from (grp, x0.., w = multiplicity).

    Two deterministic starts (coordinate-wise median and spread; all rows) are
    improved by ``p.steps`` C-steps, and the smaller determinant wins.  Each
    step reads the small vector table, cuts every group at its h-th distance
    and aggregates; nothing is collected.
    """
    long = vectors.select("grp", "w", F.posexplode(F.array(*_X)).alias("dim", "x"))
    # one row per group, or group and coordinate: broadcast by count, so a group with very many vectors is not dealt to one task
    med = counted(written(_cut(long, ["grp", "dim"], "x", "w", 0.5, "med"), "medians"), GROUP_ROWS)
    dev = long.join(med, ["grp", "dim"]).withColumn("x", F.abs(F.col("x") - F.col("med")))
    mad = _cut(dev, ["grp", "dim"], "x", "w", 0.5, "mad").join(med, ["grp", "dim"])
    floors = F.element_at(F.array(*[F.lit(f) for f in p.scale_floor]), F.col("dim") + 1)
    spread = mad.withColumn("v", F.sqrt(F.pow(1.4826 * F.col("mad"), 2) + F.pow(floors, 2)))
    pick = [F.max(F.when(F.col("dim") == i, F.col("med"))).cast("double").alias(f"m{i}") for i in range(_P)]
    pick += [F.max(F.when(F.col("dim") == i, F.col("v"))).alias(f"l{i}{i}") for i in range(_P)]
    pick += [F.lit(0.0).alias(f"l{i}{j}") for i in range(_P) for j in range(i)]
    cols = ["grp", "start", *[f"m{i}" for i in range(_P)], *[f"l{i}{j}" for i in range(_P) for j in range(i + 1)]]
    est = spread.groupBy("grp").agg(*pick).withColumn("start", F.lit(0)).select(*cols)
    classic = _cholesky(_moments(vectors, ["grp"]), ["grp"], p.scale_floor).withColumn("start", F.lit(1)).select(*cols)
    est = written(est.unionByName(classic), "mcd")
    for _ in range(p.steps):
        d = _distance(vectors.join(counted(est, GROUP_ROWS), "grp"), "d2")
        d = d.withColumn("bin", F.least(F.lit(6000), F.floor(200 * F.log1p("d2"))).cast("long"))
        cut = _cut(d, ["grp", "start"], "bin", "w", p.support, "cut")
        cut = counted(written(cut, "cuts"), GROUP_ROWS)
        core = d.join(cut, ["grp", "start"]).where("bin <= cut").select("grp", "start", "w", *_X)
        full = _cholesky(_moments(core, ["grp", "start"]), ["grp", "start"], p.scale_floor)
        est = written(full.select(*cols, "n", "logdet"), "mcd")
    best = est.groupBy("grp").agg(F.min_by("start", F.struct("logdet", "start")).alias("start"))
    rows = vectors.groupBy("grp").agg(F.sum("w").alias("n_rows"))
    return est.join(best, ["grp", "start"]).join(rows, "grp")


@private_columns("text", "lang", "source")
def judge(df: DataFrame, params: QualityParams = QualityParams(), text: str = "text", lang: str = "lang",
          source: str = "source", drop: tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``df`` with the base statistics, ``base_failed``, ``distance`` and ``kept``.

    Result for odd input: null or empty text has no words and fails the base
    rule; null language or source form groups of their own; repeated rows are
    judged alike; no rows give no rows; input columns named like a result are
    replaced.  With fewer than ``min_group`` fitted texts in all, only the base
    rule rejects.  ``drop``: input columns that are not carried along.
    """
    p = params
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    d = df.withColumns({"__lang": part(lang), "__src": part(source)})
    d = with_statistics(d, text).drop(*drop)
    d = d.withColumn("base_failed", F.expr(
        f"n_words < {p.min_words} or 100 * n_repeat_words > {p.max_repeat_pct} * n_words"))
    d = d.selectExpr("*", *[f"{e} as __{x}" for x, e in _vector(p).items()])
    d = written(d, "quality")
    levels = {"g0": F.concat_ws("\x01", F.lit("s"), "__lang", "__src"), "g1": F.concat_ws("\x01", F.lit("l"), "__lang"), "g2": F.lit("all")}
    # distinct vectors first: a group of copies counts as one row with its multiplicity
    vectors = d.where("not base_failed").select("__lang", "__src", *[F.col(f"__{x}").alias(x) for x in _X]) \
        .groupBy("__lang", "__src", *_X).agg(F.count(F.lit(1)).alias("w"))
    vectors = vectors.select(F.explode(F.array(*levels.values())).alias("grp"), *_X, "w") \
        .groupBy("grp", *_X).agg(F.sum("w").alias("w"))
    est = fit(written(vectors, "vectors"), p).where(F.col("n_rows") >= p.min_group)
    # one row per group, its most specific estimate
    groups = d.select("__lang", "__src").distinct().select(
        "__lang", "__src", F.posexplode(F.array(*levels.values())).alias("level", "grp"))
    use = est.select("grp", F.struct(*[f"m{i}" for i in range(_P)], *[f"l{i}{j}" for i in range(_P) for j in range(i + 1)]).alias("e"))
    use = groups.join(use, "grp").groupBy("__lang", "__src").agg(F.min_by("e", "level").alias("e"))
    use = written(use.select("__lang", "__src", "e.*"), "estimates")
    est_cols = [c for c in use.columns if c not in ("__lang", "__src")]
    out = _distance(d.withColumnsRenamed({f"__{x}": x for x in _X}).join(use, ["__lang", "__src"], "left"), "distance")
    out = out.drop(*_X, *est_cols, "__lang", "__src")
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= p.cutoff, F.lit(True)))


def keep_good(df: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """The rows that ``judge`` keeps, with the columns of ``df``."""
    own = [f"__c{i}" for i in range(len(df.columns))]
    plain = df.toDF(*own).select("*", *[F.col(own[df.columns.index(c)]).alias(c) for c in ("text", "lang", "source")])
    return judge(plain, params, drop=("text", "lang", "source")).where("kept").select(
        *[F.col(o).alias(c) for o, c in zip(own, df.columns)])


def op9_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``judge`` over the whole documents table."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return judge(docs, drop=("text",)).select("doc_id", *BASE, "base_failed", "kept", "n_upper")


# --------------------------------------------------------------------------- the same result as one DuckDB query

def _sql(p: QualityParams = QualityParams()) -> str:
    """Statistics, the unrolled C-steps and the verdicts, step by step as named subqueries."""
    words = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
    dims, pairs = range(_P), [(i, j) for i in range(_P) for j in range(i + 1)]
    ms, ls, xs = (", ".join(f"{c}" for c in cols) for cols in ([f"m{i}" for i in dims], [f"l{i}{j}" for i, j in pairs], _X))
    steps: list[str] = []

    def add(name: str, body: str) -> str:
        steps.append(f"{name} as ({body})")
        return name

    def quantile(name: str, source: str, keys: str, value: str, share: float, out: str) -> str:
        h = add(f"{name}_h", f"select {keys}, {value}, sum(w) as n from {source} group by all")
        c = add(f"{name}_c", f"select *, sum(n) over (partition by {keys} order by {value}) as c, sum(n) over (partition by {keys}) as t from {h}")
        return add(name, f"select {keys}, min({value}) as {out} from {c} where c >= ceil({share} * t) group by {keys}")

    def estimate(name: str, source: str, keys: str) -> str:
        """Moments of ``source``, then the Cholesky factor column by column."""
        sums = ", ".join([f"cast(sum(w * x{i}) as double) / sum(w) as m{i}" for i in dims]
                         + [f"cast(sum(w * x{i} * x{j}) as double) / sum(w) - (cast(sum(w * x{i}) as double) / sum(w)) * "
                            f"(cast(sum(w * x{j}) as double) / sum(w)) + {p.scale_floor[i] ** 2 if i == j else 0.0} as s{i}{j}" for i, j in pairs])
        last = add(f"{name}_m", f"select {keys}, {sums} from {source} group by {keys}")
        for j in dims:
            diagonal = " - ".join([f"s{j}{j}", *[f"l{j}{k} * l{j}{k}" for k in range(j)]])
            last = add(f"{name}_d{j}", f"select *, sqrt({diagonal}) as l{j}{j} from {last}")
            below = "".join(f", ({' - '.join([f's{i}{j}', *[f'l{i}{k} * l{j}{k}' for k in range(j)]])}) / l{j}{j} as l{i}{j}"
                            for i in range(j + 1, _P))
            last = add(f"{name}_l{j}", f"select *{below} from {last}")
        return add(name, f"select {keys}, {ms}, {ls}, {' + '.join(f'2 * ln(l{i}{i})' for i in dims)} as logdet from {last}")

    def distance(name: str, source: str) -> str:
        last = source
        for i in dims:
            left = " - ".join([f"(x{i} - m{i})", *[f"l{i}{k} * z{k}" for k in range(i)]])
            last = add(f"{name}_z{i}", f"select *, ({left}) / l{i}{i} as z{i} from {last}")
        return add(name, f"select *, {' + '.join(f'z{i} * z{i}' for i in dims)} as d2 from {last}")

    add("words", f"select doc_id, lang, source, coalesce(text, '') as text, {words} as w from documents")
    add("grams", "select doc_id, i, array_to_string(w[i:i + 2], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from words)")
    add("twice", "select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from grams) where n > 1")
    add("again", "select doc_id, count(distinct k) as n_repeat_words from (select doc_id, unnest(range(i, i + 3)) as k from twice) group by doc_id")
    add("lines", "select doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l from words")
    add("base", "select doc_id, coalesce('=' || lang, '-') as lg, coalesce('=' || source, '-') as sc, cast(len(w) as bigint) as n_words, "
                "cast(length(array_to_string(w, '')) as bigint) as word_chars, "
                "cast(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as bigint) as n_symbols, "
                "cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words, "
                "cast(length(regexp_replace(text, '[^A-Z]+', '', 'g')) as bigint) as n_upper "
                "from words join lines using (doc_id) left join again using (doc_id)")
    add("docs", f"select *, n_words < {p.min_words} or 100 * n_repeat_words > {p.max_repeat_pct} * n_words as base_failed, "
                + ", ".join(f"{e} as {x}" for x, e in _vector(p).items()) + " from base")
    add("groups", "select distinct lg, sc, unnest([0, 1, 2]) as level, unnest(['s|' || lg || '|' || sc, 'l|' || lg, 'all']) as grp from docs")
    add("v", f"select grp, {xs}, count(*) as w from docs join groups using (lg, sc) where not base_failed group by all")
    tall = add("tall", " union all ".join(f"select grp, {i} as dim, x{i} as x, w from v" for i in dims))
    quantile("med", tall, "grp, dim", "x", 0.5, "med")
    add("dev", "select grp, dim, abs(x - med) as x, w from tall join med using (grp, dim)")
    quantile("mad", "dev", "grp, dim", "x", 0.5, "mad")
    floors = "case dim " + " ".join(f"when {i} then {f}" for i, f in enumerate(p.scale_floor)) + " end"
    add("spread", f"select grp, dim, med, sqrt(pow(1.4826 * mad, 2) + pow({floors}, 2)) as s from mad join med using (grp, dim)")
    first = ", ".join([f"max(case when dim = {i} then med end) as m{i}" for i in dims]
                      + [f"max(case when dim = {i} then s end) as l{i}{j}" if i == j else f"0.0 as l{i}{j}" for i, j in pairs])
    estimate("classic", "v", "grp")
    est = add("e0", f"select grp, 0 as start, {first} from spread group by grp union all select grp, 1, {ms}, {ls} from classic")
    for k in range(1, p.steps + 1):
        joined = add(f"j{k}", f"select v.*, e.* exclude (grp) from v join {est} e using (grp)")
        d = distance(f"d{k}", joined)
        b = add(f"b{k}", f"select grp, start, w, {xs}, cast(least(6000, floor(200 * ln(1 + d2))) as bigint) as bin from {d}")
        cut = quantile(f"q{k}", b, "grp, start", "bin", p.support, "cut")
        core = add(f"k{k}", f"select b.* from {b} b join {cut} using (grp, start) where bin <= cut")
        est = estimate(f"e{k}", core, "grp, start")
    add("fitted", f"select grp, {ms}, {ls} from (select *, row_number() over (partition by grp order by logdet, start) as r from {est}) "
                  f"where r = 1 and grp in (select grp from v group by grp having sum(w) >= {p.min_group})")
    add("use", "select * from (select *, row_number() over (partition by lg, sc order by level) as r from groups join fitted using (grp)) where r = 1")
    distance("judged", add("placed", f"select docs.*, {ms}, {ls} from docs left join use using (lg, sc)"))
    return ("with " + ",\n".join(steps) + f"\nselect doc_id, {', '.join(BASE)}, base_failed, "
            f"not base_failed and coalesce(d2 <= {p.cutoff}, true) as kept, n_upper from judged")


SQL = _sql()
