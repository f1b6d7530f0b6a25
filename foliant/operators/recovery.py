"""Lost numbers found again: fills over a session's volumes, and recovery passes repeated until none finds more.

A stream of acts has a session, its volumes in order, pages, and a number for those whose number is certain.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..sources.paths import stored
from . import sequence as S

# How far a printed number may be from the one interpolated, in numbers and as a share of all.
FAR, FAR_SHARE = 12, 0.03

# --- fill over a session's volumes ------------------------------------------------------------------------

_FAR = -(1 << 40)


def forced_columns(weight: Callable[[int], np.ndarray], rows: int, columns: int) -> list[int]:
    """For each row its column, if it has the same one in every best assignment, else -1.

    An assignment gives each row a column, in rising order; the best ones have the greatest sum of weights. ``weight``
    gives a row's weights. Sums from both ends are held for a block of rows at a time, and at the blocks' ends.
    """
    block = max(1, isqrt(rows))

    def before(sums: np.ndarray, i: int) -> np.ndarray:
        return np.maximum.accumulate(np.r_[_FAR, sums[:-1] + weight(i)])

    def behind(sums: np.ndarray, i: int) -> np.ndarray:
        return np.maximum.accumulate(np.r_[sums[1:] + weight(i), _FAR][::-1])[::-1]

    ends, sums = {}, np.zeros(columns + 1, np.int64)
    for i in reversed(range(rows)):
        if i + 1 == rows or (i + 1) % block == 0:
            ends[i + 1] = sums
        sums = behind(sums, i)
    out: list[int] = []
    sums = np.zeros(columns + 1, np.int64)
    for start in range(0, rows, block):
        stop = min(start + block, rows)
        held = [ends[stop]]
        for i in reversed(range(start + 1, stop)):
            held.append(behind(held[-1], i))
        for i in range(start, stop):
            value = sums[:-1] + weight(i) + held.pop()[1:]
            best = np.flatnonzero(value == value.max()) if columns else []
            out.append(int(best[0]) if len(best) == 1 and value.max() > _FAR // 2 else -1)
            sums = before(sums, i)
    return out


def assigned(reads: Sequence[int | None], slots: Sequence[int]) -> list[int | None]:
    """The open number of each candidate, in order, where all best assignments agree.

    As many as possible are paired; a candidate's own reading counts for its number and against any other.
    """
    read = np.array([-1 if r is None else r for r in reads], np.int64)
    open_ = np.array(slots, np.int64)
    few = len(read) <= len(open_)
    own, other = (read, open_) if few else (open_, read)
    known = lambda i: own[i] >= 0 if few else other >= 0
    at = forced_columns(lambda i: np.where(known(i), np.where(other == own[i], 1, -1), 0), len(own), len(other))
    if few:
        return [None if k < 0 else int(open_[k]) for k in at]
    out: list[int | None] = [None] * len(read)
    for i, k in enumerate(at):
        if k >= 0:
            out[k] = int(open_[i])
    return out


def session_fill(acts: DataFrame, session: str, order: Sequence[str], page: Sequence[str], n: str, anchor: Column, read: str, total: str | None = None, taken: DataFrame | None = None) -> DataFrame:
    """(session, order, filled, lo, hi) of acts that take the numbers missing between certain ones in a session.

    ``order`` is that of the session's acts over its volumes, ``page`` the columns that say a page. Anchors are certain
    numbers that one act of the session has, rising in order. Between two of them, and up to ``total`` behind the last
    one, the numbers that neither a certain act nor ``taken`` (session, n) has are open; candidates are pages without a
    certain act, each its first act. :func:`assigned` pairs them; where there are as many of both, in order.
    """
    rows = acts.withColumn("certain_", F.coalesce(anchor, F.lit(False)))
    certain = rows.filter("certain_")
    single = certain.withColumn("same_", F.count("*").over(Window.partitionBy(session, n))).filter("same_ = 1")
    anchors = S.records(single, [session], order, n).select(session, *order, F.col(n).cast("long").alias("anchor_"))
    first = Window.partitionBy(session, *page).orderBy(*order)
    free = rows.withColumn("held_", F.max("certain_").over(Window.partitionBy(session, *page))).withColumn("k_", F.row_number().over(first)).filter("NOT held_ AND k_ = 1")
    both = free.select(session, *order, F.col(read).cast("long").alias("read_")).unionByName(anchors, allowMissingColumns=True)
    by = Window.partitionBy(session).orderBy(*order)
    gap = F.count("anchor_").over(by)
    gaps = both.withColumn("gap_", gap)
    top = acts.groupBy(session).agg(F.max(total).cast("long").alias("top_")) if total else acts.select(session).distinct().withColumn("top_", F.lit(None).cast("long"))
    sides = anchors.withColumns({"gap_": F.row_number().over(by).cast("long"), "hi": F.lead("anchor_").over(by)}).select(session, "gap_", F.col("anchor_").alias("lo"), "hi")
    heads = anchors.groupBy(session).agg(F.min("anchor_").alias("hi")).select(session, F.lit(0).cast("long").alias("gap_"), F.lit(0).cast("long").alias("lo"), "hi")
    sides = sides.unionByName(heads).join(top, session).withColumn("hi", F.coalesce("hi", F.col("top_") + 1)).drop("top_").filter("hi > lo + 1")
    slots = sides.select(session, "gap_", "lo", "hi", F.explode(F.sequence(F.col("lo") + 1, F.col("hi") - 1)).alias("slot_"))
    used = certain.select(session, F.col(n).cast("long").alias("slot_"))
    if taken is not None:
        used = used.unionByName(taken.select(session, F.col(n).cast("long").alias("slot_")))
    slots = slots.join(used.distinct(), [session, "slot_"], "left_anti").groupBy(session, "gap_", "lo", "hi").agg(F.array_sort(F.collect_list("slot_")).alias("slots_"))
    found = gaps.filter("anchor_ IS NULL").groupBy(session, "gap_").agg(F.array_sort(F.collect_list(F.struct(*order, "read_"))).alias("found_"))
    pairs = found.join(slots, [session, "gap_"]).select(session, "lo", "hi", "found_", "slots_")
    schema = T.StructType([acts.schema[session], T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType()), *(acts.schema[c] for c in order), T.StructField("filled", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                numbers = assigned([x["read_"] for x in r["found_"]], r["slots_"])
                rows = [{session: r[session], "lo": r["lo"], "hi": r["hi"], **{c: x[c] for c in order}, "filled": v} for x, v in zip(r["found_"], numbers) if v is not None]
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return pairs.mapInArrow(run, schema)


# --- windows without headings -----------------------------------------------------------------------------


def silent_windows(pages: DataFrame, key: str, page: str, heading: Column, body: Column, size: int = 75, step: int = 37, sample: int = 10, share: float = 0.4) -> DataFrame:
    """(key, first_page, last_page) of merged windows of ``size`` pages, ``step`` apart from page 1 on, without a heading.

    Of each window every ``sample``-th page from its first one is looked at; if more than ``share`` of these are ``body``,
    the pages are those of one long act and the window isn't reported. Volumes of under two windows have none. A page
    is counted for the windows that it lies in, of which there are few, so that a volume's pages needn't meet.
    """
    sampled = -(-size // sample)
    own = pages.select(key, F.col(page).cast("long").alias("p_"), F.coalesce(heading, F.lit(False)).alias("h_"), F.coalesce(body, F.lit(False)).alias("b_"))
    totals = own.groupBy(key).agg(F.max("p_").alias("n_")).filter(F.col("n_") >= 2 * size)
    wide = totals.select(key, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_") - size - 1) / step).cast("long"))).alias("w_"))
    first = F.greatest(F.lit(0), F.ceil((F.col("p_") - size) / step)).cast("long")
    inside = own.select("*", F.explode(F.sequence(first, F.floor((F.col("p_") - 1) / step).cast("long"))).alias("w_"))
    seen = (F.col("p_") - 1 - F.col("w_") * step) % sample == 0
    counts = inside.groupBy(key, "w_").agg(F.count_if("h_").alias("headings_"), F.count_if(F.col("b_") & seen).alias("bodies_"))
    bare = wide.join(counts, [key, "w_"], "left").fillna(0, ["headings_", "bodies_"]).filter((F.col("headings_") == 0) & (F.col("bodies_") <= share * sampled))
    begin = 1 + F.col("w_") * step
    bare = bare.select(key, begin.alias("begin_"), (begin + size - 1).alias("end_"))
    by = Window.partitionBy(key).orderBy("begin_")
    runs = bare.withColumn("new_", F.when(F.col("begin_") <= F.lag("end_").over(by) + 1, 0).otherwise(1)).withColumn("run_", F.sum("new_").over(by))
    return runs.groupBy(key, "run_").agg(F.min("begin_").alias("first_page"), F.max("end_").alias("last_page")).drop("run_")


# --- recovery passes --------------------------------------------------------------------------------------

#: Acts of the sessions to look at, with ``number`` where it is known by now, to (session, pos, filled).
Pass = Callable[[DataFrame], DataFrame]


def agreed_by_readers(acts: DataFrame) -> DataFrame:
    """The number that two readers or more have, and no other number so."""
    each = acts.filter("number IS NULL").select("session", "pos", F.explode("readings").alias("filled")).filter("filled IS NOT NULL")
    often = each.groupBy("session", "pos", "filled").agg(F.count("*").alias("n_")).filter("n_ >= 2")
    return often.withColumn("others_", F.count("*").over(Window.partitionBy("session", "pos"))).filter("others_ = 1").select("session", "pos", "filled")


def printed(acts: DataFrame) -> DataFrame:
    """The number printed with an act, if it lies between its neighbours' and near where it would by its place."""
    near = S.neighbours(acts, ["session"], ["pos"], F.col("number").isNotNull(), ["pos", "number"]).filter("number IS NULL AND printed > prev_number AND printed < next_number")
    want = F.expr("prev_number + (next_number - prev_number) * (pos - prev_pos) / (next_pos - prev_pos)")
    fits = F.abs(F.col("printed") - want) <= F.greatest(F.lit(float(FAR)), FAR_SHARE * F.col("total"))
    return near.filter(fits).select("session", "pos", F.col("printed").alias("filled"))


def counted(acts: DataFrame) -> DataFrame:
    """Acts between known numbers, as many as there are numbers between these."""
    rows = S.gap_fill(acts, ["session"], ["pos"], "number", F.col("number").isNotNull(), total="total")
    return rows.filter("status = 'filled'").select("session", "pos", "filled")


def over_volumes(acts: DataFrame) -> DataFrame:
    """:func:`session_fill`, one act a page, by what is printed."""
    found = session_fill(acts, "session", ["pos"], ["volume", "page"], "number", F.col("number").isNotNull(), "printed", "total")
    return found.select("session", "pos", "filled")


PASSES: tuple[tuple[str, Pass], ...] = (("readers", agreed_by_readers), ("printed", printed), ("counted", counted), ("over_volumes", over_volumes))


def recovered(acts: DataFrame, passes: Sequence[tuple[str, Pass]] = PASSES) -> tuple[DataFrame, list[tuple[int, str, int]]]:
    """(session, pos, number, origin, step) of acts with a number, and what each step gained (step, pass, acts).

    ``acts``: (session, pos, volume, page, number or null, readings, printed, total). Passes run in turn, round after
    round, until a round gains nothing. A pass looks only at sessions in which something was found since it last ran.
    What is known never changes: a pass only adds numbers from 1 to the session's total to acts that have none, if the
    number isn't known in the session and one act alone is given it.
    """
    acts = stored(acts, "acts")
    known = acts.filter("number IS NOT NULL").select("session", "pos", F.col("number").cast("long").alias("number"), F.lit("certain").alias("origin"), F.lit(0).alias("step"))
    known = stored(known, "known")
    ran = dict.fromkeys((name for name, _ in passes), -1)
    gains: list[tuple[int, str, int]] = []
    step, idle = 0, 0
    while idle < len(passes):
        name, of = passes[step % len(passes)]
        step += 1
        fresh = known.filter(F.col("step") > ran[name]).select("session").distinct()
        ran[name] = step - 1
        some = acts if ran[name] < len(passes) else acts.join(fresh, "session", "left_semi")
        state = some.drop("number").join(known.select("session", "pos", "number"), ["session", "pos"], "left")
        found = of(state).select("session", "pos", F.col("filled").cast("long").alias("number"))
        found = found.join(some.select("session", "pos", "total"), ["session", "pos"]).filter(F.col("number").between(1, F.col("total")))
        found = found.join(known, ["session", "pos"], "left_anti").join(known, ["session", "number"], "left_anti")
        found = found.withColumn("claims_", F.count("*").over(Window.partitionBy("session", "number"))).filter("claims_ = 1")
        found = stored(found.select("session", "pos", "number", F.lit(name).alias("origin"), F.lit(step).alias("step")), "found")
        gained = found.count()
        gains.append((step, name, gained))
        idle = 0 if gained else idle + 1
        if gained:
            known = stored(known.unionByName(found), "known")
    return known, gains
