"""Mixing sources to target weights as a time-varying curriculum.

Sources, in the order of their names' code points and null last, are dealt the given weight schedules in turn. A
schedule says a source's weight at each time between the begin of training (0) and its end (1), linear between knots;
its integral is the source's weight in the mix. Targets are the weights' shares of ``share`` times all words, but none
above ``most`` times its source's words: what lies above goes to the others by weight, until none is above. The level
that the others reach is found by Newton's steps on sums over sources, each of which raises it until it holds.

A source's words are used in the order of a digest of its documents, pass after pass, until its target is reached; the
last document may be used in part. The source's cumulative demand at a time is its target times the integral of its
schedule up to there; the time at which demand reaches a document's middle word is its position. Training order is a
sort by ranges of position.

How many words stand before a document in its source is summed over two levels of digest ranges, so that no task gets a
source: ranges of about ``RANGE_ROWS`` documents, and stretches of ``STRETCH`` ranges.

Defined cases: a null text has no words, takes none and stands where its digest puts it; a null source is one source; documents
equal in id and text share a digest, rows equal in all else too are interchangeable; an empty table gives an empty
table; sources without words have a target of 0; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import picked, written

#: (time, weight) at each knot, from time 0 to time 1.
Schedule = Sequence[tuple[float, float]]

#: Weights 3, 1 and 2 over the whole time: early, throughout and late.
SCHEDULES: tuple[Schedule, ...] = (((0.0, 4.0), (1.0, 2.0)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.0), (0.5, 1.5), (1.0, 4.0)))
SHARE, MOST = 1.5, 2
RANGE_ROWS, STRETCH = 1_000, 1_024
WORD = r"[^\x20\x09-\x0D]+"


def integral(schedule: Schedule) -> float:
    return sum((t - s) * (v + w) / 2 for (s, v), (t, w) in zip(schedule, schedule[1:]))


def checked(schedules: Sequence[Schedule]) -> None:
    for s in schedules:
        times = [t for t, _ in s]
        if len(s) < 2 or times[0] != 0 or times[-1] != 1 or sorted(set(times)) != times or min(w for _, w in s) < 0 or integral(s) <= 0:
            raise ValueError(f"a schedule goes from time 0 to time 1 in rising times, with weights that aren't all 0: {s}")


def reached_at(part: Column, schedule: Schedule) -> Column:
    """The time at which the integral of ``schedule`` reaches ``part`` (0 to 1) of its whole: the root of a square in the
    segment where it does."""
    whole, done, out = integral(schedule), 0.0, None
    segments = []
    for (s, v), (t, w) in zip(schedule, schedule[1:]):
        area = (t - s) * (v + w) / 2
        slope = (w - v) / (t - s)
        more = F.greatest(part * whole - done, F.lit(0.0))
        # v x + slope x^2 / 2 = more, in the form that holds for a slope of 0 as well
        root = F.sqrt(F.greatest(F.lit(v * v) + 2 * slope * more, F.lit(0.0)))
        time = F.lit(s) + F.when(F.lit(v) + root > 0, 2 * more / (F.lit(v) + root)).otherwise(0.0)
        segments.append((done, area, F.least(time, F.lit(t))))
        done += area
    for begin, area, time in reversed(segments):
        out = time if out is None else F.when(part * whole <= begin + area, time).otherwise(out)
    return out


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``id, source, size, digest`` of each document; texts are read once here."""
    rows = picked(docs, id=id_col, text=text_col, source=source_col)
    text = F.coalesce("text", F.lit(""))
    return rows.select(
        "id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.md5(F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("")), text)).alias("digest")
    )


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` from 0 in the order of code points, null last: the places in files written in order."""
    spark = sources.sparkSession
    ordered, path = written(sources.orderBy(F.col("source").asc_nulls_last()), "sources")
    placed = spark.read.schema(ordered.schema).parquet(path).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    files = placed.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    files = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return placed.join(files, "file").select(*sources.columns, (F.col("before") + F.col("row")).alias("rank"))


def targets(sizes: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, source_size, plan, target`` of each source of ``sized`` documents; ``plan`` numbers its schedule."""
    checked(schedules)
    if share > most:
        raise ValueError("no targets under the bound have this share")
    sources = _ranked(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    sources = sources.withColumn("plan", (F.col("rank") % len(schedules)).cast("int")).drop("rank")
    weights = F.array(*(F.lit(float(integral(s))) for s in schedules))
    sources, _ = written(sources.withColumn("weight", weights[F.col("plan")]), "weighted-sources")
    bound = F.col("source_size") * float(most)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    words, weight = share * total, None
    while True:
        # those above the level so far are held at their bounds
        held = F.lit(False) if weight is None else bound * weight < F.col("weight") * words
        free = sources.agg(F.sum(F.when(held, 0.0).otherwise(F.col("weight"))).alias("w"), F.sum(F.when(held, bound).otherwise(0.0)).alias("b")).first()
        now = (share * total - (free.b or 0.0), free.w or 0.0)
        if now == (words, weight) or not now[1]:
            break
        words, weight = now
    target = F.least(bound, F.col("weight") * words / weight) if weight else bound
    return sources.select("source", "source_size", "plan", target.cast("double").alias("target"))


def assigned(docs: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, share: float = SHARE, most: float = MOST, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """A row for each document: id, source, ``size``, ``source_size``, ``target``, ``takes``.

    ``takes`` has an entry for each pass that uses it: ``position`` in training, 0 to 1, and ``words``, its first so many.
    """
    sizes, _ = written(sized(docs, id_col, text_col, source_col), "document-sizes")
    goals = targets(sizes, schedules, share, most)
    ranges = max(1, sizes.count() // RANGE_ROWS)
    # 32 bits of the digest as a fraction of all
    fine = F.floor(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") * ranges / 2**32).cast("long")
    rows = sizes.withColumn("fine", fine)
    coarse = F.floor(F.col("fine") / STRETCH).alias("coarse")
    sums = rows.groupBy("source", "fine").agg(F.sum("size").alias("words"))
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    running = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    sums, _ = written(sums.select("*", coarse), "range-words")
    upper = sums.groupBy("source", "coarse").agg(F.sum("words").alias("words"))
    upper = upper.select("source", "coarse", running("words", before("source").orderBy("coarse")).alias("above"))
    upper = upper.join(goals, upper.source.eqNullSafe(goals.source)).drop(goals.source)
    sums = sums.withColumn("inside", running("words", before("source", "coarse").orderBy("fine")))
    same = lambda a, b, *keys: [a[k].eqNullSafe(b[k]) for k in keys]
    sums = sums.join(upper, same(sums, upper, "source", "coarse")).drop(upper.source, upper.coarse)
    sums = sums.select("source", "fine", (F.col("above") + F.col("inside")).alias("begin"), "source_size", "plan", "target")
    rows = rows.withColumn("own", running("size", before("source", "fine").orderBy("digest", F.col("id").asc_nulls_first(), "size")))
    rows = rows.join(sums, same(rows, sums, "source", "fine")).drop(sums.source, sums.fine)
    goal = F.round("target").cast("long")
    at = F.col("begin") + F.col("own")

    def take(k: int) -> Column:
        begin = at + k * F.col("source_size")
        words = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), goal - begin))
        part = F.when(F.col("target") > 0, F.least((begin + words / 2) / F.col("target"), F.lit(1.0))).otherwise(0.0)
        plan = F.col("plan")
        time = reached_at(part, schedules[0])
        for j, schedule in enumerate(schedules[1:], 1):
            time = F.when(plan == j, reached_at(part, schedule)).otherwise(time)
        return F.struct(time.alias("position"), words.alias("words"))

    passes = F.array(*(take(k) for k in range(int(-(-most // 1)))))
    return rows.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", F.filter(passes, lambda x: x["words"] > 0).alias("takes")
    )


def training_order(docs: DataFrame, **options) -> DataFrame:
    """A row for each use of a document, sorted by ranges of ``position``: id, source, ``position`` and ``words``."""
    taken = assigned(docs, **options)
    names = taken.columns[:2]
    used = taken.select(*(F.col(f"`{n}`") for n in names), F.explode("takes").alias("take")).select(*(F.col(f"`{n}`") for n in names), "take.*")
    return used.orderBy("position", F.col(f"`{names[0]}`").asc_nulls_first())


def mixed(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """A row for each document, sorted by ranges of its first position (unused ones last): id, ``size``, ``source_size``,
    ``target`` of its source, ``taken`` words, repeats counted, and ``position``."""
    taken = F.aggregate("takes", F.lit(0).cast("long"), lambda n, x: n + x["words"])
    rows = assigned(docs, id_col=id_col, **options).select(
        F.col(f"`{id_col}`"), "size", "source_size", "target", taken.alias("taken"), F.when(F.size("takes") > 0, F.col("takes")[0]["position"]).alias("position")
    )
    return rows.orderBy(F.col("position").asc_nulls_last(), F.col(f"`{id_col}`").asc_nulls_first())
