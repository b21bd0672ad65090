"""Ordered folds over rows as window functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .staging import stage


def carry_forward(df: DataFrame, part: str, order: list[str], value: str, resets: Column) -> DataFrame:
    """`value` filled from the last row that has one; a row with `resets` empties what is carried."""
    w = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    state = F.when(resets, F.struct(F.lit(None).cast(df.schema[value].dataType).alias("v"))).when(F.col(value).isNotNull(), F.struct(F.col(value).alias("v")))
    return df.withColumn(value, F.coalesce(value, F.last(state, ignorenulls=True).over(w).v))


def or_groups(df: DataFrame, part: str, order: list[str], is_or: Column, row: str) -> DataFrame:
    """Adds choice_group, the least row of a chain: the rows before and after a separator
    belong together; null outside chains."""
    w = Window.partitionBy(part).orderBy(*order)
    df = df.withColumn("_pos", F.row_number().over(w)).withColumn("_joined", F.coalesce(F.lag(is_or).over(w), F.lit(False)) & (F.col("_pos") > 2))
    side = Window.partitionBy(part, F.col("_pos") % 2).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_side", F.col("_pos") % 2).withColumn("_island", F.sum(F.when(F.col("_joined"), 0).otherwise(1)).over(side))
    island = Window.partitionBy(part, "_side", "_island")
    return df.withColumn("choice_group", F.when(F.count("*").over(island) > 1, F.min(row).over(island))).drop("_pos", "_joined", "_side", "_island")


def fold_tags(df: DataFrame, part: list[str], order: list[str], slot: str, is_tag: Column, url: str) -> DataFrame:
    """Adds head, the number within `part` of the source a cell belongs to: a tag belongs to
    the source before it if that has its slot and a url, otherwise it is a source itself."""
    w = Window.partitionBy(*part).orderBy(*order)
    has = F.coalesce(F.col(url) != "", F.lit(False))
    df = df.withColumn("_pos", F.row_number().over(w)).withColumn("_tag", is_tag)
    starts = ~F.col("_tag") | F.coalesce(~F.lag(slot).over(w).eqNullSafe(F.col(slot)), F.lit(True)) | (F.col("_pos") == 1)
    df = df.withColumn("_start", starts)
    df = df.withColumn("_run", F.sum(F.col("_start").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy(*part, "_run").orderBy("_pos")
    before = F.coalesce(F.max(has).over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))
    df = df.withColumn("_own", F.col("_start") | ~before)
    return df.withColumn("head", F.max(F.when(F.col("_own"), F.col("_pos"))).over(run.rowsBetween(Window.unboundedPreceding, 0))).drop("_pos", "_tag", "_start", "_run", "_own")


def slot_intervals(df: DataFrame, part: str, start: str, last: Column) -> DataFrame:
    """Adds end: each header reaches to the one before the next, the last to `last`."""
    return df.withColumn("end", F.coalesce(F.lead(start).over(Window.partitionBy(part).orderBy(start)) - 1, last))


def _key(place) -> tuple:
    return tuple(place.values()) if isinstance(place, dict) else tuple(place)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("k", T.LongType()), T.StructField("kept", T.BooleanType())])))
def _contested(children: pd.Series, firsts: pd.Series, taken: pd.Series) -> pd.Series:
    """Per base, of its children (k, first row) by k: whether the child's first row comes to the
    id base-k before the base's own rows (`firsts`, in order) get that far. Children that they
    never reach are left out. `taken`: the base itself is another one's id already."""
    out = []
    for own, rows, gone in zip(children, firsts, taken, strict=True):
        found, passed = [], int(gone)  # ids passed over so far, up to the child's
        for child in own:
            n = child["k"] - passed  # the row, from 1, that comes to this id
            if n > len(rows):
                break
            kept = _key(child["first"]) < _key(rows[n - 1])
            passed += kept
            found.append({"k": child["k"], "kept": kept})
        out.append(found)
    return pd.Series(out)


def numbered_ids(df: DataFrame, base: str, order: list[str]) -> DataFrame:
    """Adds id, unique: in order of first sight a base, or base-2, base-3 … where that is in
    use, be it as another row's own base.

    The id base-k is wanted by two bases only: by `base` for one of its rows, and by the base
    that is spelled base-k for its first. Which of them gets it depends on nothing else but
    whether `base` is free itself, so contested bases are settled from the shortest on, all of
    a length together, by the first rows of each; then an id is the row's number within its
    base and the ids passed over before it, a running sum. Only the numbering of one base's
    rows is in order; lists hold contested bases only."""
    place = F.struct(*(F.col(o).alias(f"o{i}") for i, o in enumerate(order)))
    n = F.row_number().over(Window.partitionBy(base).orderBy(*order))
    rows = stage(df.withColumn("_n", n))  # read by every step below
    bases = rows.groupBy(F.col(base).alias("b")).agg(F.min(place).alias("first"), F.count("*").alias("rows"))
    number = r"^(.*)-([2-9]|[1-9][0-9]{1,9})$"
    children = bases.where(F.col("b").rlike(number)).select(F.regexp_extract("b", number, 1).alias("parent"), F.regexp_extract("b", number, 2).cast("long").alias("k"), "b", "first")
    parents = bases.select(F.col("b").alias("parent"), F.col("rows").alias("_rows"))
    links = stage(children.join(parents, "parent").withColumn("depth", F.size(F.regexp_extract_all("parent", F.lit("-[0-9]+"), F.lit(0)))).select("parent", "k", "b", "first", "depth", "_rows"))
    depths = [r[0] for r in links.select("depth").distinct().orderBy("depth").collect()]  # how often "-number" stands in a base
    settled = None
    for depth in depths:
        own = links.where(F.col("depth") == depth)
        reach = own.groupBy("parent").agg(F.max("k").alias("reach"), F.array_sort(F.collect_list(F.struct("k", "first"))).alias("children"))
        firsts = rows.join(reach.select(F.col("parent").alias(base), "reach"), base).where(F.col("_n") <= F.col("reach"))
        firsts = firsts.groupBy(F.col(base).alias("parent")).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col("_n"), place.alias("p")))), lambda x: x.p).alias("firsts"))
        gone = F.lit(False)
        asked = reach.join(firsts, "parent")
        if settled is not None:
            lost = settled.where(~F.col("kept")).select(F.concat_ws("-", "parent", "k").alias("parent"), F.lit(True).alias("_gone"))
            asked, gone = asked.join(lost, "parent", "left"), F.coalesce("_gone", F.lit(False))
        found = asked.select("parent", F.explode(_contested("children", "firsts", gone)).alias("x")).select("parent", "x.k", "x.kept")
        settled = stage(found if settled is None else found.unionByName(settled))
    if settled is None:
        passed = rows.withColumn("_passed", F.lit(0).cast("long"))
    else:
        # ids that a base passes over: its own where another has it, and those that children keep
        over = settled.where("kept").select(F.col("parent").alias(base), "k").unionByName(settled.where(~F.col("kept")).select(F.concat_ws("-", "parent", "k").alias(base), F.lit(1).cast("long").alias("k")))
        nth = F.row_number().over(Window.partitionBy(base).orderBy("k"))
        over = over.select(base, (F.col("k") - nth + 1).cast("int").alias("_n"), F.lit(1).cast("long").alias("_one"))  # from this row on
        marks = over.groupBy(base, "_n").agg(F.sum("_one").alias("_one"))
        tangled = rows.join(marks.select(base).distinct(), base, "left_semi")
        both = tangled.select(base, "_n", F.lit(0).cast("long").alias("_one"), F.lit(True).alias("_row")).unionByName(marks.withColumn("_row", F.lit(False)))
        running = Window.partitionBy(base).orderBy("_n", "_row").rowsBetween(Window.unboundedPreceding, 0)
        sums = both.withColumn("_passed", F.sum("_one").over(running)).where("_row").select(base, "_n", "_passed")
        passed = rows.join(sums, [base, "_n"], "left").withColumn("_passed", F.coalesce("_passed", F.lit(0).cast("long")))
    at = F.col("_n") + F.col("_passed")
    return passed.select(*df.columns, F.when(at == 1, F.col(base)).otherwise(F.concat_ws("-", F.col(base), at.cast("string"))).alias("id"))


def primary_rows(df: DataFrame, part: list[str], row: str) -> DataFrame:
    """Adds merged_into: null on the first row of a group, its row on the others."""
    first = F.min(row).over(Window.partitionBy(*part))
    return df.withColumn("merged_into", F.when(F.col(row) != first, first))


def neighbours(df: DataFrame, part: str, order: list[str], value: str, is_or: Column) -> DataFrame:
    """Adds left and right, the nearest values on both sides that are not separators, and
    back_to_back where the row before is a separator too."""
    w = Window.partitionBy(part).orderBy(*order)
    # rows that follow are read as rows before in the other order: a frame that reaches to the
    # end of its partition is summed up anew for every row, in the square of the rows
    back = Window.partitionBy(part).orderBy(F.desc("_pos")).rowsBetween(Window.unboundedPreceding, -1)
    plain = F.when(~is_or, F.col(value))
    return (
        df.withColumn("left", F.last(plain, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("back_to_back", F.coalesce(F.lag(is_or).over(w), F.lit(False)) & is_or)
        .withColumn("_pos", F.row_number().over(w))
        .withColumn("right", F.last(plain, ignorenulls=True).over(back))
        .drop("_pos")
    )
