"""Alignment of two tokenizers' tokens by a cogroup of postings.

Tokenizer A encodes a space and the text, tokenizer B the text, before which it puts a space itself; both give the same
bytes. Two tokens are linked where their byte ranges overlap. Between two neighbouring offsets at which any token ends
lies exactly one link, so that links are counted by merging offsets. Offsets at which tokens of both end cut the tokens
into groups.

How often a pair of ids is linked is counted over all documents, and a link is a best one if its pair's count is the
highest of its B id. Each batch of documents gives, for each B id, its A ids, how often it is linked to each, and the
documents in which it is (postings). Counts are summed over batches and then brought to the postings: both are shuffled
by slices of B ids and groups of batches and sorted, so that in each stream a B id's counts (no more of them than A has
ids) come before its postings, however many these are. A task adds up what a group's documents get from its slice and
gives it out, and sums by document follow. A frequent B id has its postings in as many groups as there are.

Text is cut before spaces into units that neither tokenizer's tokens span, if B's vocabulary allows it, and a batch's
distinct units are encoded once.

Defined cases: texts that are null, empty or whose tokens of A or B don't give their bytes have no tokens, zeros and an
empty ``groups_sha256``; special tokens' strings are plain text; null ids pass through; repeated rows each get their own
result and count each; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import SPACE, byte_alphabet, default_tokenizer, read_spec
from .common import picked, sliced, written
from .token_output import gathered

#: Documents whose contributions a task adds up at once, and slices of B ids.
GROUP_DOCS, SLICES = 100_000, 16
BATCH_BYTES = 4 << 20
#: How many bytes of new units one call encodes.
JOINED_BYTES = 1 << 16


def cut_at_spaces(pieces: list[str]) -> bool:
    """Whether no piece goes on from another character to a space. A's pattern of words doesn't either."""
    return not any("▁" in p.lstrip("▁") for p in pieces)


_OTHER = SPACE.replace(r"\r ", r"\r")
#: Units of a text that begins with a space: each goes up to the next space that stands behind another character.
_UNITS = re.compile(rf" [{SPACE}]*[^{SPACE}]*(?:[{_OTHER}][{SPACE}]*[^{SPACE}]*)*")
#: Texts that aren't cut at every space.
_ODD = "^ |[" + re.sub(r"\\u(....)|\\x(..)", lambda m: rf"\x{{{m[1] or m[2]}}}", SPACE) + "] "


def _decimals() -> tuple[np.ndarray, np.ndarray]:
    """All decimal numbers of 16 bits and then the separators ``,``, ``|`` and ``;``: bytes and sizes."""
    texts = [b"%d" % k for k in range(1 << 16)] + [b",", b"|", b";"]
    return np.frombuffer(b"".join(texts), np.uint8), np.fromiter(map(len, texts), np.int64, len(texts))


COMMA, BAR, SEMICOLON = (1 << 16) + np.arange(3)
#: A unit that stands before others.
FIRST = "a"
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
#: Links as ``B << 16 | A``, the text of groups with a ``;`` behind each, and counts of A, B and groups.
Aligned = tuple[bytes, bytes, int, int, int]
NOTHING: Aligned = (b"", b"", 0, 0, 0)
#: What a worker remembers: the late units and those before them, up to this each. ``ENTRY_BYTES``: a unit's share
#: beside its text. Longer units aren't remembered.
REMEMBERED_BYTES = 48 << 20
ENTRY_BYTES = 320
LONG_RUN = 64


class Units:
    """Links and groups of a batch's distinct units."""

    def __init__(self, spec: str, model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(spec)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor()
        self.b.LoadFromSerializedProto(model)
        back = byte_alphabet()
        # A's ids and B's ids as they stand in links have 16 bits each
        if max(self.a.get_vocab_size(), self.b.vocab_size()) > 1 << 16:
            raise ValueError("vocabularies of over 65,536 ids")
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for t, i in self.a.get_vocab(with_added_tokens=True).items():
            self.a_bytes[i] = bytes(back[c] for c in t) if all(c in back for c in t) else t.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.cut = cut_at_spaces([p for i, p in enumerate(pieces) if not self.b.is_byte(i)])
        self.size_a, self.size_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes))
        self.decimals, self.decimal_size = _decimals()
        self.late: dict[str, Aligned] = {}
        self.before: dict[str, Aligned] = {}
        self.size = 0

    def _joined(self, units: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Both tokenizers' ids of adjacent units, each with a space before it, None if they don't give the units' bytes."""
        text = " ".join(units)
        a, b = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.b.encode(text, num_threads=1)
        raw = b" " + text.encode()
        if b"".join([self.a_bytes[i] for i in a]) != raw or b"".join([self.b_bytes[i] for i in b]) != raw:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def _encoded(self, units: list[str]) -> Iterator[tuple[list[str], tuple[np.ndarray, np.ndarray] | None]]:
        """Units, some at a time, with their ids. Before each lot stands a unit of its own."""
        some, size = [FIRST], 0
        for u in units:
            # white space at a unit's end can't stand before another unit, and B gives a space for its mark
            if not self.cut or not u or u[-1].isspace() or "▁" in u:
                yield (lot := [FIRST, u] if self.cut else [u]), self._joined(lot)
                continue
            some.append(u)
            size += len(u)
            if size > JOINED_BYTES:
                yield some, self._joined(some)
                some, size = [FIRST], 0
        if len(some) > 1:
            yield some, self._joined(some)

    def of(self, units: list[str]) -> list[Aligned | None]:
        """Links and groups of distinct units, None where a tokenizer loses something; remembered up to a bound."""
        out = list(map(self.late.get, units))
        lacking = [k for k, x in enumerate(out) if x is None]
        if self.before:
            for k in lacking:
                out[k] = self.before.get(units[k])
        learnt = self._learnt([units[k] for k in lacking if out[k] is None])
        for k in lacking:
            if out[k] is None:
                out[k] = learnt[units[k]]
            if out[k] is not None and len(units[k]) <= LONG_RUN:
                self.late[units[k]] = out[k]
                self.size += ENTRY_BYTES + len(units[k])
        if self.size > REMEMBERED_BYTES:
            self.late, self.before, self.size = {}, self.late, 0
        return out

    def _learnt(self, units: list[str]) -> dict[str, Aligned | None]:
        out: dict[str, Aligned | None] = {}
        for some, ids in self._encoded(units):
            if ids is not None:
                out.update(zip(some, self._aligned(some, *ids)))
            elif len(some) == 2 or not self.cut:
                out[some[-1]] = None
            else:  # something in one of them
                for u in some[1:]:
                    ids = self._joined([FIRST, u])
                    out[u] = None if ids is None else self._aligned([FIRST, u], *ids)[1]
        return out

    def _aligned(self, units: list[str], a: np.ndarray, b: np.ndarray) -> list[Aligned]:
        n = len(units)
        last = np.cumsum([1 + len(u.encode()) for u in units])
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        cuts = np.union1d(ends_a, ends_b)
        link = (b[np.searchsorted(ends_b, cuts)] << 16 | a[np.searchsorted(ends_a, cuts)]).astype(np.uint32)
        links = np.r_[0, np.searchsorted(cuts, last, "right")].tolist()
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        # tokens of A and then of B in each group, a separator behind each
        at_a = np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")
        at_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")
        codes = np.empty((len(a) + len(b), 2), np.int64)
        codes[at_a, 0], codes[at_b, 0] = a, b
        codes[at_a, 1] = np.where(ends_a == both[group_a], BAR, COMMA)
        codes[at_b, 1] = np.where(ends_b == both[group_b], SEMICOLON, COMMA)
        flat, end = gathered(self.decimals, self.decimal_size, codes.ravel())
        of_unit = lambda ends: np.r_[0, np.searchsorted(ends, last, "right")]
        tokens_a, tokens_b, groups = of_unit(ends_a), of_unit(ends_b), of_unit(both)
        ends = np.r_[0, end[2 * (tokens_a + tokens_b)[1:] - 1]].tolist()
        link, text, counts = link.tobytes(), flat.tobytes(), np.c_[np.diff(tokens_a), np.diff(tokens_b), np.diff(groups)].tolist()
        return [(link[4 * links[k] : 4 * links[k + 1]], text[ends[k] : ends[k + 1]], *counts[k]) for k in range(n)]


@lru_cache(maxsize=1)
def units(spec: str, model: bytes) -> Units:
    return Units(spec, model)


class Aligner:
    """The documents and postings of one batch after the other."""

    def __init__(self, known: Units, block: int):
        self.units, self.block = known, block

    def _cut(self, texts: pa.Array) -> tuple[list[str], list[np.ndarray]]:
        """Distinct units of texts, each without the space before it, and the units of each text."""
        empty = pc.equal(pc.utf8_length(pc.fill_null(texts, "")), 0).to_numpy(zero_copy_only=False)
        if not self.units.cut:
            whole = pc.fill_null(texts, "").dictionary_encode()
            codes = whole.indices.to_numpy().astype(np.int64)
            return whole.dictionary.to_pylist(), [codes[k : k + 1] if not empty[k] else codes[:0] for k in range(len(texts))]
        odd = pc.fill_null(pc.match_substring_regex(texts, _ODD), False)
        split = pc.split_pattern(pc.if_else(odd, "", pc.fill_null(texts, "")), " ")
        numbered = split.values.dictionary_encode()
        code, at = numbered.indices.to_numpy().astype(np.int64), split.offsets.to_numpy().tolist()
        units = numbered.dictionary.to_pylist()
        codes = [code[at[k] : at[k + 1]] if not e else code[:0] for k, e in enumerate(empty.tolist())]
        if len(places := np.flatnonzero(odd.to_numpy(zero_copy_only=False))):
            index = {u: k for k, u in enumerate(units)}
            for k in places.tolist():
                codes[k] = np.array([index.setdefault(u[1:], len(index)) for u in _UNITS.findall(" " + texts[k].as_py())], np.int64)
            units = list(index)
        return units, codes

    def __call__(self, texts: pa.Array) -> tuple[dict, dict]:
        """Columns of documents and of postings."""
        distinct, codes = self._cut(texts)
        parts = self.units.of(distinct)
        whole = np.array([p is not None for p in parts], bool)
        parts = [p or NOTHING for p in parts]
        codes = [c if whole[c].all() else c[:0] for c in codes]
        group_texts = [p[1] for p in parts]
        digests = ["" if not len(c) else hashlib.sha256(b"".join(map(group_texts.__getitem__, c.tolist()))[:-1]).hexdigest() for c in codes]
        counts = np.array([p[2:] for p in parts], np.int64).reshape(-1, 3)
        size = np.array([len(p[0]) for p in parts], np.int64) // 4
        flat = np.frombuffer(b"".join([p[0] for p in parts]), np.uint32)
        sums = np.array([[*counts[c].sum(0), size[c].sum()] for c in codes], np.int64).reshape(-1, 4)
        links, _ = gathered(flat, size, np.concatenate(codes) if codes else np.zeros(0, np.int64))
        doc = np.repeat(np.arange(len(codes), dtype=np.uint64), sums[:, 3])
        key, many = np.unique(links.astype(np.uint64) << np.uint64(32) | doc, return_counts=True)
        documents = {"seq": np.arange(len(codes), dtype=np.int32), **dict(zip(COUNTS, sums.T)), "groups_sha256": digests}
        return documents, self._postings(key, many, len(codes))

    def _postings(self, key: np.ndarray, many: np.ndarray, docs: int) -> dict:
        pair = key >> np.uint64(32)
        first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, np.int64)
        b = (pair[first] >> np.uint64(16)).astype(np.int32)
        row = np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if len(b) else np.zeros(0, np.int64)
        ends, stops = np.r_[row, len(first)], np.r_[first, len(key)]
        lists = lambda at, values, kind: pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, kind))
        return {
            "b": b[row],
            "docs": np.full(len(row), docs, np.int32),
            "a": lists(ends, (pair[first] & np.uint64(0xFFFF)).astype(np.int32), pa.int32()),
            "n": lists(ends, np.add.reduceat(many, first) if len(first) else many, pa.int64()),
            "sizes": lists(ends, np.diff(stops), pa.int32()),
            "seqs": lists(stops[ends], (key & np.uint64(0xFFFFFFFF)).astype(np.int32), pa.int32()),
            "many": lists(stops[ends], many, pa.int32()),
        }


def _encoded(docs: DataFrame, tokenizer: str | None, model: str | None, id_col: str, text_col: str) -> DataFrame:
    """Rows of documents (``b`` null) and rows of postings, one for each batch and B id."""
    from pyspark import TaskContext
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = picked(docs, id=id_col, text=text_col)
    with open(model or default_tokenizer("piece_bpe_32k.model"), "rb") as f:
        files = rows.sparkSession.sparkContext.broadcast((read_spec(tokenizer or default_tokenizer("byte_bpe_50k.json")), f.read()))
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType(
        [T.StructField("block", T.LongType()), T.StructField("id", rows.schema["id"].dataType), T.StructField("seq", T.IntegerType())]
        + [T.StructField(c, T.LongType()) for c in COUNTS]
        + [T.StructField("groups_sha256", T.StringType()), T.StructField("b", T.IntegerType()), T.StructField("docs", T.IntegerType())]
        + [T.StructField("a", ints), T.StructField("n", T.ArrayType(T.LongType())), T.StructField("sizes", ints), T.StructField("seqs", ints), T.StructField("many", ints)]
    )
    arrow = to_arrow_schema(schema)

    def filled(n: int, columns: dict) -> pa.RecordBatch:
        arrays = [columns.get(f.name) for f in arrow]
        return pa.RecordBatch.from_arrays([pa.nulls(n, f.type) if x is None else x if isinstance(x, pa.Array) else pa.array(x, f.type) for f, x in zip(arrow, arrays)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, block = units(*files.value), TaskContext.get().partitionId() << 32
        for batch in batches:
            for b in sliced(batch, BATCH_BYTES):
                documents, postings = Aligner(known, block)(b.column(1).cast(pa.string()))
                yield filled(b.num_rows, documents | {"id": b.column(0), "block": np.full(b.num_rows, block)})
                n = len(postings["b"])
                yield filled(n, postings | {"block": np.full(n, block)})
                block += 1

    return rows.mapInArrow(run, schema)


_SUMS = T.StructType([T.StructField("block", T.LongType()), T.StructField("seq", T.IntegerType()), T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])


def _slices(column: pa.Array) -> tuple[list[int], np.ndarray]:
    return column.offsets.to_pylist(), column.values.to_numpy(zero_copy_only=False)


def _contributions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by document of a stream in which a B id's counts come before its postings."""
    sums: dict[int, np.ndarray] = {}
    share = None
    ids = counts = None
    top = 0

    def given() -> Iterator[pa.RecordBatch]:
        for block, x in sums.items():
            seq = np.flatnonzero(x[1]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seq), block)), pa.array(seq), pa.array(x[0, seq]), pa.array(x[1, seq])], names=_SUMS.names)
        sums.clear()

    for batch in batches:
        for part in sliced(batch):
            kind, share_of, block, docs = (part.column(c).to_pylist() for c in ("kind", "share", "block", "docs"))
            (at, a), (_, n), (_, sizes), (to, seqs), (_, many) = (_slices(part.column(c)) for c in ("a", "n", "sizes", "seqs", "many"))
            at_n, at_sizes = part.column("n").offsets.to_pylist(), part.column("sizes").offsets.to_pylist()
            for k in range(part.num_rows):
                if share_of[k] != share:
                    yield from given()
                    share = share_of[k]
                here = a[at[k] : at[k + 1]]
                if kind[k] == 0:
                    ids, counts = here, n[at_n[k] : at_n[k + 1]]
                    top = counts.max()
                    continue
                count = np.repeat(counts[np.searchsorted(ids, here)], sizes[at_sizes[k] : at_sizes[k + 1]])
                if (x := sums.get(block[k])) is None:
                    x = sums[block[k]] = np.zeros((2, docs[k]), np.int64)
                seq, links = seqs[to[k] : to[k + 1]], many[to[k] : to[k + 1]].astype(np.int64)
                best = count == top
                np.add.at(x[0], seq[best], links[best])
                np.add.at(x[1], seq, links * count)
    yield from given()


def aligned(docs: DataFrame, tokenizer: str | None = None, model: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of ``docs``: id, ``n_a`` and ``n_b`` tokens, ``n_groups``, ``n_links``, ``n_best`` (links whose
    pair's count is the highest of its B id), ``count_sum`` (pairs' counts over all links) and ``groups_sha256``."""
    table, _ = written(_encoded(docs, tokenizer, model, id_col, text_col), "aligned")
    documents = table.filter(F.col("b").isNull()).select("block", "seq", "id", *COUNTS, "groups_sha256")
    postings = table.filter(F.col("b").isNotNull())
    counts = pair_counts(postings)
    groups = max(1, -(-documents.count() // GROUP_DOCS))
    both = (
        postings.select(F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("group"), F.lit(1).alias("kind"), "b", "block", "docs", "a", "n", "sizes", "seqs", "many")
        .unionByName(counts.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(0).alias("kind"), "b", "a", "n"), allowMissingColumns=True)
        .withColumn("share", F.col("group").cast("long") * SLICES + F.col("b") % SLICES)
        .repartition("share")
        .sortWithinPartitions("share", "b", "kind")
    )
    sums = both.drop("group").mapInArrow(_contributions, _SUMS).groupBy("block", "seq").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    out = documents.join(sums, ["block", "seq"], "left")
    return out.select(
        F.col("id").alias(id_col), *COUNTS, *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")), "groups_sha256"
    )


def pair_counts(postings: DataFrame) -> DataFrame:
    """``b``, its A ids in order and how often each is linked to it: no more than A has ids."""
    pairs = postings.select("b", F.inline(F.arrays_zip("a", "n"))).groupBy("b", "a").agg(F.sum("n").alias("n"))
    lists = pairs.groupBy("b").agg(F.array_sort(F.collect_list(F.struct("a", "n"))).alias("x"))
    return lists.select("b", F.col("x.a").alias("a"), F.col("x.n").alias("n"))
