"""Global ranks, quantiles, scaling, folds and top lists.

A window without a partition key would put every row into one task.  Global ranks here
partition by range instead: each range is ranked on its own and shifted by the number of
rows before it, so only one small row per range is gathered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearset.storage import checked_broadcast, materialize, release

#: Added to the divisor of scaled ranks.
RANK_EPSILON = 1e-8


def _ranged(df: DataFrame, order: list[str], amount: str | None) -> DataFrame:
    """``df`` with __before: the sum of ``amount`` (rows, if None) over all rows that come
    earlier in the global order, which has to be unique; and __total: the sum over all rows."""
    # ranges come from a sample: written once, so that every later use sees the same ones
    d = df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    d = materialize(d, "ranges")
    step = F.col(amount) if amount else F.lit(1)
    sums = d.groupBy("__range").agg(F.sum(step).alias("__sum"))
    so_far = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    all_rows = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sums.select("__range", F.coalesce(F.sum("__sum").over(so_far), F.lit(0)).alias("__offset"), F.sum("__sum").over(all_rows).alias("__total"))
    within = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("__within", F.coalesce(F.sum(step).over(within), F.lit(0)))
    return d.join(F.broadcast(offsets), "__range").withColumn("__before", F.col("__offset") + F.col("__within")).drop("__range", "__within", "__offset")


def ordinal_rank(df: DataFrame, col: str, out: str, id_col: str = "id") -> DataFrame:
    """0, 1, ... by ``col``, ties by ``id_col``, divided by (rows - 1 + 1e-8).  Nulls last."""
    key = df.withColumn("__null", F.col(col).isNull())
    ranked = _ranged(key, ["__null", col, id_col], None)
    return ranked.withColumn(out, F.col("__before") / (F.col("__total") - 1 + RANK_EPSILON)).drop("__before", "__total", "__null")


def _long(df: DataFrame, cols: list[str], *others: str) -> DataFrame:
    """(others, feature, x): a row for each column, whose place in ``cols`` is the feature."""
    every = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(c).cast("double").alias("x")) for i, c in enumerate(cols)])
    return df.select(*others, F.explode(every).alias("__f")).select(*others, "__f.*")


def _wide(ranked: DataFrame, cols: list[str], id_col: str) -> DataFrame:
    """(id, cols, r_ and their names) of (id, feature, x, rank)."""
    of = lambda i, what: F.max(F.when(F.col("feature") == i, F.col(what)))
    return ranked.groupBy(id_col).agg(*[of(i, "x").alias(c) for i, c in enumerate(cols)], *[of(i, "rank").alias(f"r_{c}") for i, c in enumerate(cols)])


def ordinal_ranks(df: DataFrame, cols: list[str], id_col: str = "id") -> DataFrame:
    """(id, cols as doubles, r_<col>): the ``ordinal_rank`` of every column, all of them in one order by
    (column, value, id), so that one table of ranges is written.  Ids have to be unique."""
    long = _long(df, cols, id_col).withColumn("__null", F.col("x").isNull())
    d = _ranged(long, ["feature", "__null", "x", id_col], None)
    n = F.col("__total") / len(cols)  # rows of each column
    rank = (F.col("__before") - F.col("feature") * n) / (n - 1 + RANK_EPSILON)
    return _wide(d.withColumn("rank", rank), cols, id_col)


def _value_ranks(df: DataFrame, cols: list[str], descending: bool = False) -> DataFrame:
    """(feature, x, rank): the average rank of each value of each column, from one table of ranges.
    Values are counted first, so that a value of very many rows is ranked once."""
    counts = _long(df, cols).where("x IS NOT NULL").groupBy("feature", "x").agg(F.count("*").alias("n"))
    d = _ranged(counts, ["feature", "x"], "n")
    ends = d.groupBy("feature").agg(F.min("__before").alias("__first"), F.max(F.col("__before") + F.col("n")).alias("__last"))  # one row a column
    d = d.join(F.broadcast(ends), "feature")
    rank = F.col("__before") - F.col("__first") + (F.col("n") + 1) / 2
    if descending:
        rank = F.col("__last") - F.col("__first") + 1 - rank
    return d.select("feature", "x", rank.alias("rank"))


def cumulative_shares(df: DataFrame, cols: list[str], steps: int = 4096) -> DataFrame:
    """(feature, x, share): for each column (its place in ``cols``) at most ``steps`` + 1 of its values in
    order, with the average rank of each divided by the rows that have a value.

    All values of a column of up to ``steps`` rows are kept; of more, the first value of each step of
    the ranks, so that a share read from the table is at most 1 / ``steps`` too low.
    """
    ranks = materialize(_value_ranks(df, cols), "value-ranks")
    sizes = _long(df, cols).where("x IS NOT NULL").groupBy("feature").agg(F.count("*").alias("n"))  # one row a column
    d = ranks.join(F.broadcast(sizes), "feature").withColumn("share", F.col("rank") / F.col("n"))
    kept = d.groupBy("feature", F.floor(F.col("share") * steps).alias("step")).agg(F.min(F.struct("x", "share")).alias("v"))
    return kept.select("feature", "v.x", "v.share")


def average_ranks(df: DataFrame, cols: list[str], id_col: str = "id") -> DataFrame:
    """(id, cols as doubles, r_<col>): the ``average_rank`` of every column, from one table of ranges.
    Ids have to be unique."""
    ranks = _value_ranks(df, cols)
    return _wide(_long(df, cols, id_col).join(ranks, ["feature", "x"], "left"), cols, id_col)


def with_average_ranks(df: DataFrame, outs: dict[str, str], descending: bool = False) -> DataFrame:
    """``df`` with the average rank of each column {column: name of its rank}; null stays null."""
    cols = list(outs)
    ranks = _value_ranks(df, cols, descending)
    for i, (c, out) in enumerate(outs.items()):
        own = ranks.where(F.col("feature") == i).select(F.col("x").alias("__x"), F.col("rank").alias(out))
        df = df.join(own, F.col(c).cast("double") == F.col("__x"), "left").drop("__x")
    return df


def average_rank(df: DataFrame, col: str, out: str, descending: bool = False) -> DataFrame:
    """1 .. rows by ``col``; equal values share the mean of their ranks; null stays null."""
    return with_average_ranks(df, {col: out}, descending)


def position(df: DataFrame, col: str, out: str, id_col: str = "id", descending: bool = True) -> DataFrame:
    """1, 2, ... from the largest value on, ties by ``id_col``."""
    sign = -F.col(col) if descending else F.col(col)
    ranked = _ranged(df.withColumn("__key", sign), ["__key", id_col], None)
    return ranked.withColumn(out, (F.col("__before") + 1).cast("long")).drop("__key", "__before", "__total")


def rank_change(df: DataFrame, before: str, after: str, out: str = "rank_change") -> DataFrame:
    """Descending average ranks of two columns and how far each row moved up."""
    d = with_average_ranks(df, {before: "rank_before", after: "rank_after"}, True)
    return d.withColumn(out, F.col("rank_before") - F.col("rank_after"))


#: Values up to which quantiles come from one aggregate that holds them all; beyond, bins of a pass, and
#: values that are told apart one by one in the last pass.
DIRECT, BINS, LAST = 100_000, 1024, 1024


def group_quantiles(long: DataFrame, shares: dict[str, float], group: str = "axis", value: str = "x", direct: int | None = None) -> DataFrame:
    """(group, a column for each name of ``shares``): exact, linearly interpolated quantiles of each
    group.  Nulls and NaN take no part; a group without values has no row.

    Beyond ``direct`` values (DIRECT) they are found by narrowing ranges: each pass counts the values of
    the range around every wanted rank in BINS bins, for all groups and ranks at once, and goes on
    inside the bin that holds the rank, until that has one value.  No task holds more than the bins.
    """
    d = long.select(F.col(group).alias("g"), F.col(value).cast("double").alias("x")).where("x IS NOT NULL AND NOT isnan(x)")
    direct = DIRECT if direct is None else direct
    if d.limit(direct + 1).count() <= direct:
        return d.groupBy(F.col("g").alias(group)).agg(*[F.percentile("x", F.lit(p)).alias(k) for k, p in shares.items()])
    d = materialize(d, "quantile-values")
    sizes = d.groupBy("g").agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    place = lambda p: (F.col("n") - 1) * F.lit(float(p))
    ranks = F.array_distinct(F.array(*[f(place(p)).cast("long") for p in shares.values() for f in (F.floor, F.ceil)]))
    open_ = materialize(sizes.select("g", F.explode(ranks).alias("rank"), F.lit(0).cast("long").alias("before"), "n", "lo", "hi"), "quantile-ranges")
    spent, found = [d], [open_.where("lo = hi")]
    while not open_.where("lo < hi").isEmpty():
        t = open_.where("lo < hi")
        inside = d.join(checked_broadcast(t.withColumnRenamed("g", "tg")), F.col("g").eqNullSafe(F.col("tg")) & F.col("x").between(F.col("lo"), F.col("hi")))
        ends = F.when(F.col("x") == F.col("lo"), 0.0).when(F.col("x") == F.col("hi"), 2.0).otherwise(1.0)  # of an infinite range
        part = F.floor((F.col("x") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * BINS)
        infinite = (F.col("lo") == float("-inf")) | (F.col("hi") == float("inf"))
        bin_ = F.when(F.col("n") <= LAST, F.col("x")).when(infinite, ends).otherwise(F.least(part, F.lit(BINS - 1)).cast("double"))
        bins = inside.groupBy("g", "rank", "before", bin_.alias("bin")).agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        upto = F.col("before") + F.sum("n").over(Window.partitionBy("g", "rank").orderBy("bin"))  # at most BINS or LAST rows
        bins = bins.withColumn("upto", upto).where("rank < upto AND rank >= upto - n")
        spent.append(open_)
        open_ = materialize(bins.select("g", "rank", (F.col("upto") - F.col("n")).alias("before"), "n", "lo", "hi"), "quantile-ranges")
        found.append(open_.where("lo = hi"))
    values = reduce(DataFrame.unionByName, found).groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("rank", "lo"))).alias("at"))  # two ranks a share
    both = sizes.join(values.withColumnRenamed("g", "vg"), F.col("g").eqNullSafe(F.col("vg")))

    def between(p: float) -> Column:
        low = F.col("at")[F.floor(place(p)).cast("long")]
        return low + (F.col("at")[F.ceil(place(p)).cast("long")] - low) * (place(p) - F.floor(place(p)))

    out = materialize(both.select(F.col("g").alias(group), *[between(p).alias(k) for k, p in shares.items()]), "quantiles")
    release(*spent, open_)
    return out


def quantiles(df: DataFrame, cols: dict[str, float], direct: int | None = None) -> DataFrame:
    """One row of exact, linearly interpolated quantiles: {column: share}."""
    names = list(cols)
    every = {f"q{i}": p for i, p in enumerate(cols.values())}
    found = group_quantiles(_long(df, names), every, "feature", direct=direct)
    return found.agg(*[F.max(F.when(F.col("feature") == i, F.col(f"q{i}"))).alias(c) for i, c in enumerate(names)])


def with_thresholds(df: DataFrame, cols: dict[str, float], suffix: str = "_cut") -> DataFrame:
    """``df`` with the quantile of each column on every row (a broadcast of one row)."""
    cuts = quantiles(df, cols).select(*[F.col(c).alias(c + suffix) for c in cols])
    return df.join(F.broadcast(cuts), how="cross")


def min_max(df: DataFrame, col: str, out: str, style: str = "zero", inverted: bool = False) -> DataFrame:
    """Scale to 0 .. 1.  ``zero``: a constant column gives 0; ``epsilon``: 1e-8 is added to
    the range."""
    ends = df.agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"))
    d = df.join(F.broadcast(ends), how="cross")
    width = F.col("__hi") - F.col("__lo")
    if style == "epsilon":
        scaled = (F.col(col) - F.col("__lo")) / (width + F.lit(1e-8))
    else:
        scaled = F.when(width == 0, F.lit(0.0)).otherwise((F.col(col) - F.col("__lo")) / F.when(width != 0, width))
    return d.withColumn(out, 1 - scaled if inverted else scaled).drop("__lo", "__hi")


def seeded_order(*cols: str, seed: int = 42) -> Column:
    """A shuffled order that other engines can repeat: md5 of seed and ids as text."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]).cast("binary"))


def effective_folds(df: DataFrame, k: int, label: str = "label") -> int:
    """max(2, min(k, rows of the smallest class))."""
    least = df.groupBy(label).count().agg(F.min("count")).first()[0] or 0
    return max(2, min(k, least))


def stratified_folds(df: DataFrame, k: int, label: str = "label", id_col: str = "id", seed: int = 42) -> DataFrame:
    """``fold`` 0 .. k-1, dealt in shuffled order within each label.  The two or so labels
    are no partition keys: places within a label come from the global order by label."""
    d = df.withColumn("__order", seeded_order(id_col, seed=seed))
    placed = _ranged(d, [label, "__order", id_col], None)
    first = placed.groupBy(label).agg(F.min("__before").alias("__first"))
    placed = placed.join(F.broadcast(first), label)  # one row a label
    return placed.withColumn("fold", ((F.col("__before") - F.col("__first")) % k).cast("int")).drop("__before", "__total", "__first", "__order")


def stratified_holdout(df: DataFrame, share: float = 0.2, label: str = "label", id_col: str = "id", seed: int = 42) -> DataFrame:
    """``held_out`` for about ``share`` of each label; of all rows together where a class has
    fewer than two rows or the held-out part has fewer rows than there are classes."""
    classes = df.groupBy(label).count().agg(F.count("*"), F.min("count"), F.sum("count")).first()
    n_classes, least, n = classes[0], classes[1] or 0, classes[2] or 0
    strata = F.col(label) if least >= 2 and n * share >= n_classes else F.lit(0)
    d = df.withColumn("__stratum", strata.cast("string")).withColumn("__order", seeded_order(id_col, seed=seed))
    placed = _ranged(d, ["__stratum", "__order", id_col], None)
    sizes = placed.groupBy("__stratum").agg(F.min("__before").alias("__first"), F.count("*").alias("__n"))
    placed = placed.join(F.broadcast(sizes), "__stratum")
    return placed.withColumn("held_out", F.col("__before") - F.col("__first") < F.round(F.col("__n") * share)).drop("__before", "__total", "__first", "__n", "__order", "__stratum")


def top_n(df: DataFrame, col: str, n: int, id_col: str = "id", descending: bool = True) -> DataFrame:
    """The ``n`` largest (or smallest) rows, ties by id; an unknown column is an error."""
    if col not in df.columns:
        raise ValueError(f"no column {col!r} among {df.columns}")
    return df.orderBy(F.desc(col) if descending else F.asc(col), F.asc(id_col)).limit(n)


def alternate(df: DataFrame, col: str, id_col: str = "id") -> DataFrame:
    """``df`` with __second: every second row in descending order of ``col``."""
    return position(df, col, "__place", id_col).withColumn("__second", F.col("__place") % 2 == 0).drop("__place")
