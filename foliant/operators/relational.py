"""Joins, set operations, aggregates and samples with a defined order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def orphans(parents: DataFrame, key: str, *children: DataFrame) -> DataFrame:
    """Parents that no child table refers to; each child has the key under the same name."""
    for c in children:
        parents = parents.join(c.select(key).distinct(), key, "left_anti")
    return parents


def insert_missing(current: DataFrame, fresh: DataFrame, key: Sequence[str]) -> DataFrame:
    """``current`` and the rows of ``fresh`` whose key it lacks; the first of repeated keys by all columns."""
    new = fresh.join(current.select(*key).distinct(), list(key), "left_anti").select(*current.columns)
    return current.unionByName(first_by(new, key, current.columns))


def lookup_or_create(facts: DataFrame, dimension: DataFrame, natural: Sequence[str], ident: str) -> DataFrame:
    """Ids of the facts' natural keys: those of the dimension, else a hash of the key, negative so that it can't clash
    with given ids."""
    keys = facts.select(*natural).distinct().join(dimension.select(*natural, ident), list(natural), "left")
    made = -F.shiftrightunsigned(F.xxhash64(*natural), 1) - 1
    return keys.select(*natural, F.coalesce(F.col(ident), made).alias(ident), F.col(ident).isNull().alias("is_new"))


def first_by(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row for each key, the first in ``order``; a partial aggregate, no sort."""
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r_")).select(*key, "r_.*").select(*df.columns)


def priority_merge(sources: Sequence[DataFrame], key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The union of sources, of each key the row of the earliest source, then of ``order``."""
    out = None
    for k, s in enumerate(sources):
        s = s.withColumn("source_rank", F.lit(k))
        out = s if out is None else out.unionByName(s)
    return first_by(out, key, ["source_rank", *order])


def additive_merge(base: DataFrame, more: DataFrame, key: Sequence[str]) -> DataFrame:
    """All of ``base`` and what ``more`` has for keys that it lacks: a merge can only add."""
    return base.unionByName(more.join(base.select(*key).distinct(), list(key), "left_anti").select(*base.columns))


def gained_and_lost(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys in one of two tables, with ``side`` gained or lost; one shuffle."""
    tagged = before.select(*key, F.lit(1).alias("b_"), F.lit(0).alias("a_")).unionByName(after.select(*key, F.lit(0).alias("b_"), F.lit(1).alias("a_")))
    both = tagged.groupBy(*key).agg(F.max("b_").alias("b_"), F.max("a_").alias("a_")).filter("a_ <> b_")
    return both.select(*key, F.when(F.col("a_") == 1, "gained").otherwise("lost").alias("side"))


def field_diff(before: DataFrame, after: DataFrame, key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(key, change, fields): added, removed or changed rows, and which fields differ, nulls being equal to nulls."""
    b = before.select(*key, F.struct(*fields).alias("b_"))
    a = after.select(*key, F.struct(*fields).alias("a_"))
    both = b.join(a, list(key), "full_outer")
    changed = F.filter(F.array(*(F.when(~F.col(f"b_.{f}").eqNullSafe(F.col(f"a_.{f}")), f) for f in fields)), lambda x: x.isNotNull())
    return (
        both.withColumn("f_", F.array_join(changed, ","))
        .withColumn("change", F.when(F.col("b_").isNull(), "added").when(F.col("a_").isNull(), "removed").when(F.col("f_") != "", "changed"))
        .filter("change IS NOT NULL")
        .select(*key, "change", F.when(F.col("change") == "changed", F.col("f_")).otherwise("").alias("fields"))
    )


def overlay(base: DataFrame, key: Sequence[str], value: str, layers: Sequence[DataFrame]) -> DataFrame:
    """``base`` with the value of the last layer that has one; layers have one row for each key."""
    out, found = base, [F.col(value)]
    for k, layer in enumerate(layers):
        out = out.join(layer.select(*key, F.col(value).alias(f"l{k}_")), list(key), "left")
        found.insert(0, F.col(f"l{k}_"))
    return out.withColumn(value, F.coalesce(*found)).drop(*(f"l{k}_" for k in range(len(layers))))


def resolve(rows: DataFrame, key: str, maps: Sequence[tuple[DataFrame, str, str]], fallback: Column, name: str) -> DataFrame:
    """``name`` from the first map (table, key column, value column) that knows the key, else ``fallback``."""
    out, found = rows, []
    for k, (table, on, value) in enumerate(maps):
        out = out.join(table.select(F.col(on).alias(key), F.col(value).alias(f"m{k}_")), key, "left")
        found.append(F.col(f"m{k}_"))
    return out.withColumn(name, F.coalesce(*found, fallback)).drop(*(f"m{k}_" for k in range(len(maps))))


def pages_in_spans(spans: DataFrame, pages: DataFrame, key: str, lo: str, hi: str, page: str) -> DataFrame:
    """Span rows with each page row that they contain. Spans are bounded, so each becomes its pages and the join is by
    equal keys, which a range join isn't. Pages are many for each row that they are made of: they are never broadcast."""
    each = spans.withColumn(page, F.explode(F.sequence(F.col(lo), F.greatest(F.col(lo), F.col(hi)))))
    return each.join(pages.hint("merge"), [key, page])


def mode_first_seen(df: DataFrame, key: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """(key, value, count) of each key's most frequent value; of equal ones that seen first."""
    counts = df.groupBy(*key, value).agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("seen_"))
    return counts.groupBy(*key).agg(F.min_by(F.struct(value, "n"), F.struct(-F.col("n"), F.col("seen_"))).alias("m_")).select(*key, "m_.*")


def first_n(df: DataFrame, key: Sequence[str], order: Sequence[str], value: str, n: int, name: str) -> DataFrame:
    """(key, name): the first ``n`` values in order; ranks are cut before anything is collected."""
    by = Window.partitionBy(*key).orderBy(*order)
    top = df.withColumn("r_", F.row_number().over(by)).filter(F.col("r_") <= n)
    return top.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("r_", value))), lambda s: s[value]).alias(name))


def floor_percent(part: Column, whole: Column) -> Column:
    """Percent to two decimals, rounded down, so that 100 means all; null for a whole of 0."""
    return F.when(whole > 0, F.floor(part * 10000 / whole) / 100)


def ratio(part: Column, whole: Column, digits: int = 6) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.round(part / whole, digits))


def confusion(df: DataFrame, truth: str, guess: str) -> DataFrame:
    return df.groupBy(truth, guess).agg(F.count("*").alias("n"))


def precision_recall(df: DataFrame, truth: Column, guess: Column, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn, precision, recall, f1 and agreement; 0 where a denominator is 0."""
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    out = df.groupBy(*by).agg(n(truth & guess).alias("tp"), n(~truth & guess).alias("fp"), n(truth & ~guess).alias("fn"), n(~truth & ~guess).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return out.select(
        *by, "tp", "fp", "fn", "tn",
        ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), ratio(tp + tn, tp + fp + fn + tn).alias("agreement"),
    )


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def stratified_sample(df: DataFrame, strata: Sequence[str], ident: str, n: int, seed: str = "0") -> DataFrame:
    """``n`` rows of each stratum in the order of a hash: the same rows each time, on any number of partitions."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(ident).cast("string")))
    return df.withColumn("r_", F.row_number().over(Window.partitionBy(*strata).orderBy(order, ident))).filter(F.col("r_") <= n).drop("r_")


def hash_sample(df: DataFrame, ident: str, n: int, seed: str = "0") -> DataFrame:
    """``n`` rows in all: each task keeps its own least hashes, so little is sent on."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(ident).cast("string"))), ident).limit(n)


def completeness(have: DataFrame, totals: DataFrame, key: str, n: str, total: str) -> DataFrame:
    """(key, total, found, percent, bucket): distinct numbers within 1 to the total."""
    inside = have.join(totals, key).filter(F.col(n).between(1, F.col(total))).groupBy(key).agg(F.countDistinct(n).alias("found"))
    out = totals.select(key, total).join(inside, key, "left").withColumn("found", F.coalesce("found", F.lit(0)))
    lost = F.col(total) - F.col("found")
    return out.withColumns(
        {
            "percent": floor_percent(F.col("found"), F.col(total)),
            "bucket": F.when(lost == 0, "CLEAN").when(lost <= 5, "SMALL").when(F.col("found") * 2 >= F.col(total), "LARGE").otherwise("ANOMALY"),
        }
    )


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, n): rows that break each rule, in one pass; a rule that is null isn't broken."""
    one = df.agg(*(F.sum(F.when(~ok, 1).otherwise(0)).cast("long").alias(name) for name, ok in rules.items()))
    each = F.array(*(F.struct(F.lit(name).alias("rule"), F.coalesce(F.col(name), F.lit(0)).alias("n")) for name in rules))
    return one.select(F.explode(each).alias("r")).select("r.*")


def dangling(child: DataFrame, column: str, parent: DataFrame, key: str, name: str) -> DataFrame:
    """(constraint, n): child rows whose non-null reference has no parent."""
    lost = child.select(F.col(column).alias("k_")).filter("k_ IS NOT NULL").join(parent.select(F.col(key).alias("k_")).distinct(), "k_", "left_anti")
    return lost.agg(F.lit(name).alias("constraint"), F.count("*").alias("n"))


def purged(kept: DataFrame, tables: Sequence[tuple[str, DataFrame, str]]) -> dict[str, DataFrame]:
    """Each table without the rows whose ancestors are gone: child before parent in the result, parents first in reading.

    ``tables`` go from parent to child: (name, rows, the column that names the row above), keys in ``id``. A first table's
    rows stay if ``kept`` has their parent's ``id``; a later one's if their parent's row stays. Null parents are orphans.
    """
    out: dict[str, DataFrame] = {}
    above = kept.select("id")
    for name, rows, parent in tables:
        rows = rows.join(above.select(F.col("id").alias(parent)).distinct(), parent, "left_semi")
        out[name], above = rows, rows
    return dict(reversed(out.items()))
