"""Operators on closed intervals: as-of, overlap, containment, merging, clipping, shifting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _carried(rows: DataFrame, by: list[str], value: Column) -> DataFrame:
    """by, __bin and __carry: the last value (not null) of the bins before each one, given a value a row.

    One row a bin goes through the window, so a crowded key costs as many rows as it has bins.
    """
    last = rows.groupBy(*by, "__bin").agg(value.alias("__value"))
    before = W.partitionBy(*by).orderBy("__bin").rowsBetween(W.unboundedPreceding, -1)
    return last.select(*by, "__bin", F.last("__value", ignorenulls=True).over(before).alias("__carry"))


def _joined(rows: DataFrame, carried: DataFrame, by: list[str]) -> DataFrame:
    """rows with what is carried to their bin; nulls in the key or the place are a key and a bin of their own."""
    keys = [*by, "__bin"]
    named = carried.withColumnsRenamed({c: f"__of_{c}" for c in keys})
    same = F.lit(True)
    for c in keys:
        same = same & rows[c].eqNullSafe(named[f"__of_{c}"])
    return rows.join(named, same).drop(*(f"__of_{c}" for c in keys))


def _known(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.na.drop(subset=columns)


def running(rows: DataFrame, by: list[str], at: str, columns: list[str], bin_size: int) -> DataFrame:
    """rows (one a key and place) with the columns summed up to and with each place, and next_<at>: the next place of the key.

    Sums run within bins of places; what bins before hold, and where the next one begins, comes by a join with a row a bin.
    """
    binned = rows.withColumn("__bin", F.floor(F.col(at) / bin_size))
    own = W.partitionBy(*by, "__bin").orderBy(at)
    upto = own.rowsBetween(W.unboundedPreceding, W.currentRow)
    inner = binned.withColumns({**{c: F.sum(c).over(upto) for c in columns}, "__next": F.lead(at).over(own)})
    bins = binned.groupBy(*by, "__bin").agg(F.min(at).alias("__first"), *(F.sum(c).alias(f"__sum_{c}") for c in columns))
    over = W.partitionBy(*by).orderBy("__bin")
    before = over.rowsBetween(W.unboundedPreceding, -1)
    carried = bins.select(*by, "__bin", F.lead("__first").over(over).alias("__later"), *(F.coalesce(F.sum(f"__sum_{c}").over(before), F.lit(0)).alias(f"__before_{c}") for c in columns))
    out = _joined(inner, carried, by)
    return out.select(*(c for c in rows.columns if c not in columns), *((F.col(c) + F.col(f"__before_{c}")).alias(c) for c in columns), F.coalesce("__next", "__later").alias(f"next_{at}"))


def as_of(left: DataFrame, right: DataFrame, by: list[str], on: str, take: list[str], bin_size: int | None = None) -> DataFrame:
    """left with the `take` columns of the last row of right whose `on` lies strictly before; null if there is none.

    One sort on (by, on) for both sides; with a bin_size (of a number `on`) a sort in each bin, and the last row of the bins
    before it comes by a join, so a crowded key spreads over tasks. Rows of right with equal `on`: the greatest values of `take`.
    Rows of left with a null key or place stay and find nothing, those of right are nobody's.
    """
    right = _known(right, [*by, on])
    row = F.struct(*left.columns)
    bin_ = F.floor(F.col(on) / bin_size) if bin_size else F.lit(0)
    l = left.select(*by, bin_.alias("__bin"), F.col(on).alias("__at"), F.lit(0).alias("__kind"), row.alias("__row"), F.lit(None).cast(right.select(F.struct(*take).alias("s")).schema["s"].dataType).alias("__take"))
    r = right.select(*by, bin_.alias("__bin"), F.col(on).alias("__at"), F.lit(1).alias("__kind"), F.lit(None).cast(left.select(row.alias("s")).schema["s"].dataType).alias("__row"), F.struct(*take).alias("__take"))
    rows = l.unionByName(r)
    w = W.partitionBy(*by, "__bin").orderBy("__at", "__kind", "__take").rowsBetween(W.unboundedPreceding, W.currentRow)
    found = rows.withColumn("__last", F.last("__take", ignorenulls=True).over(w)).where("__kind = 0")
    if bin_size:
        bins = l.select(*by, "__bin", "__at", "__kind", "__take").unionByName(r.select(*by, "__bin", "__at", "__kind", "__take"))
        top = F.max(F.when(F.col("__kind") == 1, F.struct("__at", "__take")))["__take"]
        found = _joined(found, _carried(bins, by, top), by).withColumn("__last", F.coalesce("__last", "__carry"))
    return found.select("__row.*", *(F.col(f"__last.{c}").alias(c) for c in take))


def overlaps(left: DataFrame, right: DataFrame, by: list[str], bin_size: int) -> DataFrame:
    """Pairs of rows that share `by` and a position. left: start, end, ...; right: r_start, r_end, ...

    Both sides are dealt to bins of positions, so a key with very many intervals spreads over tasks; a pair is taken in the first bin they share.
    """
    bins = lambda a, z: F.explode(F.sequence(F.floor(F.col(a) / bin_size), F.floor(F.col(z) / bin_size)))
    l, r = left.withColumn("__bin", bins("start", "end")), right.withColumn("__bin", bins("r_start", "r_end"))
    meet = F.greatest(F.floor(F.col("start") / bin_size), F.floor(F.col("r_start") / bin_size)) == F.col("__bin")
    return l.join(r, [*by, "__bin"]).where(meet & (F.col("start") <= F.col("r_end")) & (F.col("r_start") <= F.col("end"))).drop("__bin")


def outside(children: DataFrame, parents: DataFrame, by: list[str], bin_size: int = 1 << 16) -> DataFrame:
    """Children that lie in no interval of the parent rows of their key, whose bounds are r_start and r_end.

    An interval holds a child if, of those that begin no later, the one that reaches farthest reaches its end: a running
    maximum in each bin of positions, and the maximum of the bins before it by a join; no pairs of one key are made.
    A child with a null key or place lies in nothing; intervals with a null are nobody's.
    """
    parents = _known(parents, [*by, "r_start", "r_end"])
    row = F.struct(*children.columns)
    kind = children.select(row.alias("s")).schema["s"].dataType
    bin_ = lambda c: F.floor(F.col(c) / bin_size).alias("__bin")
    c = children.select(*by, bin_("start"), F.col("start").alias("__at"), F.lit(1).alias("__kind"), F.lit(None).cast("bigint").alias("__reach"), row.alias("__row"))
    p = parents.select(*by, bin_("r_start"), F.col("r_start").alias("__at"), F.lit(0).alias("__kind"), F.col("r_end").cast("bigint").alias("__reach"), F.lit(None).cast(kind).alias("__row"))
    rows = c.unionByName(p)
    w = W.partitionBy(*by, "__bin").orderBy("__at", "__kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    found = rows.withColumn("__own", F.max("__reach").over(w)).where("__kind = 1")
    bins = c.select(*by, "__bin", "__reach").unionByName(p.select(*by, "__bin", "__reach")).groupBy(*by, "__bin").agg(F.max("__reach").alias("__reach"))
    before = W.partitionBy(*by).orderBy("__bin").rowsBetween(W.unboundedPreceding, -1)  # a row a bin
    found = _joined(found, bins.select(*by, "__bin", F.max("__reach").over(before).alias("__carry")), by)
    reach = F.greatest(F.col("__own"), F.col("__carry"))
    inside = reach >= F.col("__row.end")
    placed = F.col("__row.start").isNotNull()
    return found.where(~F.coalesce(inside & placed, F.lit(False))).select("__row.*")


def _turns(df: DataFrame, by: list[str], sides: list[Column], bin_size: int) -> DataFrame:
    """by, at, next_at and, for each side n, how many of its intervals cover [at, next_at) (cover_n). sides: a condition a side."""
    known = _known(df, [*by, "start", "end"]).where("start <= end")
    own = [F.when(s, F.lit(1)).otherwise(0).cast("bigint") for s in sides]
    event = lambda at, sign: F.struct(at.cast("bigint").alias("at"), *((s * sign).alias(f"cover_{i}") for i, s in enumerate(own)))
    events = known.select(*by, F.explode(F.array(event(F.col("start"), 1), event(F.col("end") + 1, -1))).alias("e")).select(*by, "e.*")
    counts = [f"cover_{i}" for i in range(len(sides))]
    return running(events.groupBy(*by, "at").agg(*(F.sum(c).alias(c) for c in counts)), by, "at", counts, bin_size)


def merge(df: DataFrame, by: list[str], gap: int = 1, bin_size: int = 1 << 20) -> DataFrame:
    """Maximal covered intervals of each key, and of how many parts; intervals join if the next begins at most `gap` after the end so far.

    The end so far and the number of islands run within bins of starts; what the bins before hold comes by a join with a row a
    bin, so a crowded key spreads over tasks. Inverted intervals and nulls are left out.
    """
    over = W.partitionBy(*by).orderBy("__bin").rowsBetween(W.unboundedPreceding, -1)
    rows = _known(df.select(*by, "start", "end"), [*by, "start", "end"]).where("start <= end").withColumn("__bin", F.floor(F.col("start") / bin_size))
    own = W.partitionBy(*by, "__bin").orderBy("start", "end")
    reach = rows.groupBy(*by, "__bin").agg(F.max("end").alias("__most")).select(*by, "__bin", F.max("__most").over(over).alias("__carry"))
    before = F.greatest(F.max("end").over(own.rowsBetween(W.unboundedPreceding, -1)), F.col("__carry"))
    opened = rows.join(reach, [*by, "__bin"]).withColumn("__opens", (before.isNull() | (F.col("start") > before + gap)).cast("bigint"))
    islands = opened.groupBy(*by, "__bin").agg(F.sum("__opens").alias("__n")).select(*by, "__bin", F.coalesce(F.sum("__n").over(over), F.lit(0)).alias("__islands"))
    numbered = opened.withColumn("__own", F.sum("__opens").over(own.rowsBetween(W.unboundedPreceding, W.currentRow))).join(islands, [*by, "__bin"])
    return numbered.groupBy(*by, (F.col("__own") + F.col("__islands")).alias("__island")).agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("parts")).drop("__island")


def coverage_differences(left: DataFrame, right: DataFrame, by: list[str], bin_size: int = 1 << 20) -> DataFrame:
    """by, start, end and side (left or right): where the intervals of only one side cover a key. Equal coverages give no rows.

    However a coverage is cut into intervals, overlapping or touching ones, it is the same; a key may hold any number of them.
    """
    both = left.select(*by, "start", "end", F.lit("left").alias("side")).unionByName(right.select(*by, "start", "end", F.lit("right").alias("side")))
    turns = _turns(both, by, [F.col("side") == "left", F.col("side") == "right"], bin_size)
    alone = F.when((F.col("cover_0") > 0) & (F.col("cover_1") == 0), "left").when((F.col("cover_1") > 0) & (F.col("cover_0") == 0), "right")
    pieces = turns.select(*by, F.col("at").alias("start"), (F.col("next_at") - 1).alias("end"), alone.alias("side")).where("side is not null")
    return merge(pieces, [*by, "side"], 1, bin_size).select(*by, "start", "end", "side")


def merged_parts(parts: Column) -> Column:
    """The same for an array<struct<start, end>> of a row: sorted, overlapping or touching ones joined."""
    none = F.filter(parts, lambda p: F.lit(False))

    def add(done: Column, p: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        longer = last.withField("end", F.greatest(last["end"], p["end"]))
        return F.when((F.size(done) > 0) & (p["start"] <= last["end"] + 1), F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(p)))

    return F.aggregate(F.array_sort(parts), none, add)


def clip(df: DataFrame, by: list[str], order: list, trim: str, reverse: str) -> DataFrame:
    """Takes `trim` positions off the beginning of the intervals of a key, read in this order; what is used up goes.

    reverse: a boolean column; true where reading runs from high to low positions, so ends move instead of starts.
    """
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    length = F.col("end") - F.col("start") + 1
    off = F.least(length, F.greatest(F.lit(0), F.col(trim) - F.coalesce(F.sum(length).over(w), F.lit(0))))
    cut = df.withColumn("__off", off).where(F.col("__off") < length)
    start = F.when(F.col(reverse), F.col("start")).otherwise(F.col("start") + F.col("__off"))
    end = F.when(F.col(reverse), F.col("end") - F.col("__off")).otherwise(F.col("end"))
    return cut.withColumns({"start": start, "end": end}).drop("__off")


def within(df: DataFrame, lengths: DataFrame, key: str) -> DataFrame:
    """Intervals cut to [1, length] of their sequence; those left empty go. lengths: key, length."""
    out = df.join(lengths.select(key, "length"), key).withColumns({"start": F.greatest(F.col("start"), F.lit(1)), "end": F.least("end", "length")})
    return out.where("start <= end").drop("length")


def shift(positions: DataFrame, edits: DataFrame, by: str) -> DataFrame:
    """Boundaries after runs were rewritten: the last edit that begins before a position moves it.

    positions: by, position and kind (start or end), any more columns; edits: by, start0 (from 0), old_len, new_len.
    Within a run the place in it is cut to its new length; in a run that vanished a start goes to the next base, an end to the one before.
    """
    w = W.partitionBy(by).orderBy("start0").rowsBetween(W.unboundedPreceding, -1)
    moved = edits.withColumn("offset", F.coalesce(F.sum(F.col("new_len") - F.col("old_len")).over(w), F.lit(0))).withColumn("position", F.col("start0"))
    found = as_of(positions, moved, [by], "position", ["start0", "old_len", "new_len", "offset"], 1 << 20)
    place = F.col("position") - F.col("start0")  # from 1 within the run
    begin = F.col("start0") + F.col("offset")
    in_run = F.when(F.col("new_len") == 0, F.when(F.col("kind") == "start", begin + 1).otherwise(begin)).otherwise(begin + F.least(place, F.col("new_len")))
    after = F.col("position") + F.col("offset") + F.col("new_len") - F.col("old_len")
    new = F.when(F.col("start0").isNull(), F.col("position")).when(place <= F.col("old_len"), in_run).otherwise(after)
    return found.withColumn("shifted", new).drop("start0", "old_len", "new_len", "offset")


def shared_segments(df: DataFrame, locus: str, segment: list[str]) -> DataFrame:
    """Segments that two or more loci use, with the number of loci."""
    return df.groupBy(*segment).agg(F.countDistinct(locus).alias("loci")).where("loci > 1")
