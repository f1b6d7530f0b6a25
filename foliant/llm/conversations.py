"""Conversation structure repair by signature deduplication.

A conversation's rows are encoded as a string, a character for each row: its role's initial (``x`` for other roles;
upper case if the text is truncated), or ``d`` where the row must go (blank or duplicate). Strings are cut into
stretches of ``STRETCH`` rows, so that none grows with a conversation. Each distinct stretch is solved once, by
memoised recursion on halves: a solution says for each state before and each state after the stretch which edits are
cheapest, the ASCII-least where several are. The states are those of the grammar ``(s?(ua)+)?``: nothing yet, after
``s``, after ``u``, after ``a``. Solutions of adjacent stretches compose; of edits with equal states and costs none is a
proper prefix of another, so that the least of compositions is the composition of the least. The solutions are joined
back to the conversations, each conversation's are composed in its order, and the edits are replayed on its rows.

Edits, in the letters of an audit: Keep costs 0, Rerole to user or assistant 2, Delete 3 (required for blank and
duplicate rows), Insert an empty row of user or assistant 2; a truncated row that isn't deleted adds 1.

A conversation's rows are streamed in sorted order by one task, in bounded memory but for its audit, since a digest of
its text can't be computed in parts; nothing else of a conversation meets in one place.

Defined cases: a null role or text is one space; null turns come first; rows of one turn are ordered by role and text;
null ids are one conversation; repeated rows are duplicates; a conversation without rows has zeros, an empty audit and
the digest of the empty string; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import greatest, picked, sliced, spread_join, written

STRETCH = 64
#: Stretches whose solutions a worker remembers.
REMEMBERED = 20_000
BLANKS = " \t\n\x0b\x0c\r"
#: States of the grammar, those in which a conversation may end, and the state after a role's initial.
STATES, ENDS = range(4), (0, 3)
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: What may be said next, other than by a system.
NEXT = "uuau"
ROLES = {"u": "user", "a": "assistant"}

Solution = tuple[tuple[int, str] | None, ...]  # (cost, audit) from state p to state q at 4 * p + q


def _least(*edits: tuple[int, str] | None) -> tuple[int, str] | None:
    return min((e for e in edits if e is not None), default=None)


def _insertions() -> Solution:
    out: list[tuple[int, str] | None] = [None] * 16
    for p in STATES:
        q = p
        for n in range(3):  # a third insertion comes back to a state at a higher cost
            out[4 * p + q] = _least(out[4 * p + q], (2 * n, "I" * n))
            q = AFTER[q, NEXT[q]]
    return tuple(out)


def composed(one: Solution, two: Solution) -> Solution:
    """The cheapest edits of a stretch and the one behind it."""
    out = []
    for p in STATES:
        for q in STATES:
            ways = ((x, y) for m in STATES if (x := one[4 * p + m]) and (y := two[4 * m + q]))
            out.append(_least(*((x[0] + y[0], x[1] + y[1]) for x, y in ways)))
    return tuple(out)


#: What stands before a row or at the end.
INSERTED = _insertions()


def _row(sign: str) -> Solution:
    """A row alone."""
    out: list[tuple[int, str] | None] = [None] * 16
    for p in STATES:
        out[5 * p] = (3, "D")
        if sign != "d":
            extra = int(sign.isupper())
            if (q := AFTER.get((p, sign.lower()))) is not None:
                out[4 * p + q] = _least(out[4 * p + q], (extra, "K"))
            q = AFTER[p, NEXT[p]]
            out[4 * p + q] = _least(out[4 * p + q], (2 + extra, "R"))
    return tuple(out)


@lru_cache(maxsize=REMEMBERED)
def solved(signature: str) -> Solution:
    """The cheapest edits of a stretch of rows, by recursion on its halves; what a half shares is solved once."""
    if len(signature) == 1:
        return composed(INSERTED, _row(signature))
    half = 1 << (len(signature) - 1).bit_length() - 1
    return composed(solved(signature[:half]), solved(signature[half:]))


START: Solution = tuple((0, "") if p == q else None for p in STATES for q in STATES)


class Folded:
    """Solutions composed in their order; runs of equal lengths are joined first, so that audits are copied few times."""

    def __init__(self):
        self.runs: list[tuple[int, Solution]] = []

    def add(self, solution: Solution, size: int = 1) -> None:
        while self.runs and self.runs[-1][0] == size:
            solution, size = composed(self.runs.pop()[1], solution), 2 * size
        self.runs.append((size, solution))

    def least(self) -> tuple[int, str]:
        """Cost and audit of a conversation of the stretches so far."""
        out = INSERTED
        for _, solution in reversed(self.runs):
            out = composed(solution, out)
        return _least(*(out[q] for q in ENDS))


def damaged(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations with planted faults, by the CRC of ``id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2
    takes out its sentence ends, 3 repeats it, 4 makes its role user; null values become one space.

    The columns keep their names; a row that stands for a dropped one has ``gone`` set.
    """
    space = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    df = picked(rows, id=id_col, turn=turn_col, role=role_col, text=text_col)
    fault = F.crc32(F.concat_ws(":", space(F.col("id")), space(F.col("turn")))) % 20
    df = df.select("id", "turn", space(F.col("role")).alias("role"), space(F.col("text")).alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return df.select(
        F.col("id").alias(id_col), F.col("turn").alias(turn_col), role.alias(role_col), text.alias(text_col), (F.col("fault") == 0).alias("gone"), copies.alias("_")
    ).drop("_")


def _numbered(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``id, n, turn, role, text, sign, fault, illegal`` of each row, ``n`` counting those of a conversation from 0; a
    conversation's dropped rows stand behind the others, without a number."""
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    space = lambda c: F.coalesce(c, F.lit(" "))
    df = rows.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{turn_col}`").alias("turn"), space(F.col(f"`{role_col}`")).alias("role"), space(F.col(f"`{text_col}`")).alias("text"), gone.alias("gone")
    )
    own = Window.partitionBy("id").orderBy("gone", F.col("turn").asc_nulls_first(), "role", "text")
    df = df.withColumn("n", F.row_number().over(own) - 1)
    initial = F.substring("role", 1, 1)
    pair = F.concat(F.lag(initial).over(own), initial)
    df = df.withColumn("illegal", ~pair.isin("su", "ua", "au")).withColumn("earlier", F.lag("turn").over(own))
    again = F.row_number().over(Window.partitionBy("id", "role", "text").orderBy("n")) > 1
    last = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    fault = F.when(last == "", "blank").when(again, "duplicate").when(~last.isin(".", "!", "?"), "truncated")
    df = df.withColumn("fault", F.when(~F.col("gone"), fault))
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    sign = F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", F.upper(known)).otherwise(known)
    new_turn = F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("earlier"))
    return df.select("id", "n", "turn", "role", "text", "gone", "fault", F.when(~F.col("gone"), sign).alias("sign"), (F.coalesce("illegal", F.lit(False)) & ~F.col("gone")).alias("illegal"), (new_turn & ~F.col("gone")).alias("new_turn"))


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")


def _stretches(rows: DataFrame) -> DataFrame:
    """A row for each stretch of a conversation: its signature and counts."""
    sum_of = lambda c: F.coalesce(F.sum(F.when(c, 1)), F.lit(0)).cast("long")
    ordered = F.transform(F.array_sort(F.collect_list(F.when(~F.col("gone"), F.struct("n", "sign")))), lambda x: x["sign"])
    kept_turn = F.when(~F.col("gone"), F.col("turn"))
    return (
        # dropped rows stand behind all others and make stretches of their own of any size, without characters
        rows.groupBy("id", F.when(~F.col("gone"), F.floor(F.col("n") / STRETCH)).alias("stretch"))
        .agg(
            F.array_join(ordered, "").alias("signature"),
            *(sum_of(F.col("fault") == f).alias(f) for f in _COUNTS[:3]),
            sum_of(F.col("illegal")).alias("illegal"),
            sum_of(F.col("new_turn")).alias("turns"),
            F.min(kept_turn).alias("first_turn"),
            F.max(kept_turn).alias("last_turn"),
        )
    )


_SOLVED = T.StructType(
    [T.StructField("signature", T.StringType()), T.StructField("copies", T.LongType()), T.StructField("costs", T.ArrayType(T.IntegerType())), T.StructField("audits", T.ArrayType(T.StringType()))]
)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [solved(s) if s else START for s in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_pydict(
            {
                "signature": b.column(0),
                "copies": b.column(1),
                "costs": pa.array([[-1 if e is None else e[0] for e in x] for x in found], pa.list_(pa.int32())),
                "audits": pa.array([["" if e is None else e[1] for e in x] for x in found], pa.list_(pa.string())),
            }
        )


class _Conversation:
    """One conversation while its stretches and then its rows stream by."""

    def __init__(self, key):
        self.id, self.parts, self.audit, self.cost, self.at, self.state = key, Folded(), None, 0, 0, 0
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.first = self.last = None

    def stretch(self, r: dict) -> None:
        self.parts.add(tuple(None if c < 0 else (c, a) for c, a in zip(r["costs"], r["audits"])))
        for k in _COUNTS:
            self.counts[k] += r[k]
        if r["first_turn"] is not None:
            self.first = r["first_turn"] if self.first is None else min(self.first, r["first_turn"])
            self.last = r["last_turn"] if self.last is None else max(self.last, r["last_turn"])

    def decide(self) -> None:
        if self.audit is None:
            self.cost, self.audit = self.parts.least()

    def inserted(self) -> Iterator[str]:
        """Roles of rows to insert here."""
        while self.audit[self.at : self.at + 1] == "I":
            yield ROLES[NEXT[self.state]]
            self.state = AFTER[self.state, NEXT[self.state]]
            self.at += 1

    def replayed(self, role: str) -> tuple[str, str | None]:
        """The edit of the next row and the role that it ends with, None if it is deleted."""
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return edit, None
        if edit == "R":
            role = ROLES[NEXT[self.state]]
        self.state = AFTER[self.state, role[0]]
        return edit, role

    @property
    def gaps(self) -> int:
        return 0 if self.first is None else self.last - self.first + 1 - self.counts["turns"]


def _streamed(stretches: DataFrame, rows: DataFrame) -> DataFrame:
    """Each conversation's stretches in order and then its rows in order."""
    some = stretches.select("id", F.lit(0).alias("kind"), F.col("stretch").cast("long").alias("n"), "costs", "audits", *_COUNTS, "first_turn", "last_turn")
    rest = rows.filter(~F.col("gone")).select("id", F.lit(1).alias("kind"), F.col("n").cast("long").alias("n"), "turn", "role", "text")
    both = some.unionByName(rest, allowMissingColumns=True)
    return both.repartition(F.col("id")).sortWithinPartitions("id", "kind", F.col("n").asc_nulls_last())


def _conversations(batches: Iterator[pa.RecordBatch], on_row, on_end) -> Iterator[dict]:
    """What ``on_row`` and ``on_end`` yield of each conversation of a stream."""
    now: _Conversation | None = None
    for r in (r for batch in batches for b in sliced(batch) for r in b.to_pylist()):
        if now is None or now.id != r["id"]:
            if now is not None:
                now.decide()
                yield from on_end(now)
            now = _Conversation(r["id"])
        if r["kind"] == 0:
            now.stretch(r)
        else:
            now.decide()
            yield from on_row(now, r)
    if now is not None:
        now.decide()
        yield from on_end(now)


def _batched(rows: Iterator[dict], schema: pa.Schema, most: int = 1_000) -> Iterator[pa.RecordBatch]:
    some: list[dict] = []
    for r in rows:
        some.append(r)
        if len(some) >= most:
            yield pa.RecordBatch.from_pylist(some, schema=schema)
            some = []
    if some:
        yield pa.RecordBatch.from_pylist(some, schema=schema)


def _solutions(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """The stream of solutions and rows, from which audits and repaired rows are read."""
    rows, _ = written(_numbered(conversations, id_col, turn_col, role_col, text_col), "numbered-turns")
    stretches, _ = written(_stretches(rows), "stretches")
    distinct, _ = written(stretches.groupBy("signature").agg(F.count(F.lit(1)).alias("copies")).mapInArrow(_solve, _SOLVED), "solved")
    joined = spread_join(stretches, distinct, "signature", stretches.count(), greatest(distinct))
    return _streamed(joined, rows)


def audits(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A row for each conversation: its gaps and faults, the cost and audit of its repair and the digest of what is left.

    Counts are of the rows that aren't ``gone`` (see ``damaged``; without such a column no row is). ``illegal`` counts
    adjacent rows whose roles' initials aren't ``su``, ``ua`` or ``au``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    stream = _solutions(conversations, id_col, turn_col, role_col, text_col)
    schema = T.StructType(
        [T.StructField(id_col, conversations.schema[id_col].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
        + [T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]
    )
    arrow = to_arrow_schema(schema)

    def run(batches):
        digest = {"sha": hashlib.sha256(), "empty": True}

        def add(role, text):
            digest["sha"].update(("" if digest["empty"] else "\n").encode() + f"{role}:{text}".encode())
            digest["empty"] = False

        def on_row(c, r):
            for role in c.inserted():
                add(role, "")
            _, role = c.replayed(r["role"])
            if role is not None:
                add(role, r["text"])
            return ()

        def on_end(c):
            for role in c.inserted():
                add(role, "")
            out = {id_col: c.id, "gaps": c.gaps, "cost": c.cost, "audit": c.audit, "repaired_sha256": digest["sha"].hexdigest()}
            digest.update(sha=hashlib.sha256(), empty=True)
            yield out | {k: c.counts[k] for k in ("blank", "duplicate", "truncated", "illegal")}

        yield from _batched(_conversations(batches, on_row, on_end), arrow)

    return stream.mapInArrow(run, schema)


def repaired(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows of repaired conversations: id, ``place`` from 0, turn (null for inserted rows), role, text and ``edit``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    stream = _solutions(conversations, id_col, turn_col, role_col, text_col)
    schema = T.StructType(
        [
            T.StructField(id_col, conversations.schema[id_col].dataType),
            T.StructField("place", T.LongType()),
            T.StructField(turn_col, conversations.schema[turn_col].dataType),
            T.StructField(role_col, T.StringType()),
            T.StructField(text_col, T.StringType()),
            T.StructField("edit", T.StringType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches):
        place = [0]

        def row(c, turn, role, text, edit):
            place[0] += 1
            return {id_col: c.id, "place": place[0] - 1, turn_col: turn, role_col: role, text_col: text, "edit": edit}

        def on_row(c, r):
            for role in c.inserted():
                yield row(c, None, role, "", "I")
            edit, role = c.replayed(r["role"])
            if role is not None:
                yield row(c, r["turn"], role, r["text"], edit)

        def on_end(c):
            for role in c.inserted():
                yield row(c, None, role, "", "I")
            place[0] = 0

        yield from _batched(_conversations(batches, on_row, on_end), arrow)

    return stream.mapInArrow(run, schema)
