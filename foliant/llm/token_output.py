"""Token ids as ORC tables.

Documents are dealt out by ranges of their id, encoded, sorted and written, so that files and the stripes in them
follow the order of ids. ORC keeps integers run-length encoded, minima and maxima in row indexes for each
``row_index_stride`` rows, and Bloom filters on the id column, so that a read of some ids skips stripes and a whole
read splits by stripe.

The order is that of (id, CRC of ids); rows equal in both are interchangeable. Each document's ids end with
``end_id``.

Encoding works on runs of characters other than white space: the tokenizer drops white space and no token spans it.
Arrow splits a batch's texts and numbers their distinct runs, the library encodes each of these once, and the ids of
all texts are put together from them as arrays. What is remembered between batches is bounded in bytes. Texts with a
special token's string are encoded as a whole, and so are all texts where the tokenizer's file is of another kind.

Defined cases: a null text counts as empty and has the end id alone; null ids come first; repeated rows are all
written; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import default_tokenizer, packed, read_spec
from .common import new_path, picked, rowwise, written

END_ID = 1
STRIPE_BYTES = 16 << 20
ROW_INDEX_STRIDE = 2_000
#: What a worker remembers: the late words and those before them, up to this each. ``ENTRY_BYTES``: an entry's share
#: beside its text.
REMEMBERED_BYTES = 64 << 20
ENTRY_BYTES = 200
#: Texts that are encoded at once.
BATCH_BYTES = 4 << 20
#: Words that one call of the library encodes as one text.
JOINED = 256
#: Longer runs aren't remembered.
LONG_RUN = 64
#: Arrow's split takes these for white space, the tokenizer doesn't.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_WORD = r"^(?P<letters>[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]+)(?P<rest>[!-&(-/:-@\[-`{-~]*)$"


def gathered(flat: np.ndarray, size: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries ``code`` of a list of entries, one behind the other, and where each ends.

    ``flat`` holds all entries one behind the other, ``size`` their sizes.
    """
    begin, many = np.cumsum(size) - size, size[code]
    end = np.cumsum(many)
    if not len(end) or not end[-1]:
        return flat[:0], end
    return flat[np.repeat(begin[code] - end + many, many) + np.arange(end[-1])], end


def entries(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4


class RunEncoder:
    """Encodes texts with the tokenizers library, each distinct word once.

    A run of Latin letters and then punctuation is cut there, as the tokenizer cuts it, and its letters are lower-cased
    as the tokenizer does, so that a word is encoded once however it is written. Words go to the library many at a
    time, as one text: a token with the end-of-word suffix says where each ends.
    """

    def __init__(self, spec: str, remembered: int = REMEMBERED_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        file = json.loads(spec)
        suffix = file["model"].get("end_of_word_suffix")
        first = ((file.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        lower = any(n.get("type") == "Lowercase" for n in (file.get("normalizer") or {}).get("normalizers", []))
        self.by_runs = bool(suffix) and lower and first.get("behavior") == "Removed" and bool(first.get("invert"))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if self.by_runs:
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.odd = "|".join([f"[{_SEPARATORS}]", *map(re.escape, self.special)])
        self.most, self.size = remembered, 0
        self.late: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def library(self, texts: list[str]) -> list[bytes]:
        return [packed(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, words: list[str]) -> list[bytes]:
        """Encodings of distinct lower-case words of letters."""
        out: list[bytes] = []
        some = [words[k : k + JOINED] for k in range(0, len(words), JOINED)]
        for own, ids in zip(some, self.library([" ".join(x) for x in some])):
            cuts = (4 * np.flatnonzero(self.ends[np.frombuffer(ids, "<u4")]) + 4).tolist()
            # a count of its own says that some word isn't one for the tokenizer
            out += [ids[s:e] for s, e in zip([0, *cuts], cuts)] if len(cuts) == len(own) else self.library(own)
        return out

    def _of(self, texts: list[str], library: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """Encodings of distinct texts, remembered up to a bound."""
        out = list(map(self.late.get, texts))
        lacking = [k for k, x in enumerate(out) if x is None]
        if lacking and self.before:
            for k in lacking:
                out[k] = self.before.get(texts[k])
        new = [k for k in lacking if out[k] is None]
        for k, ids in zip(new, library([texts[k] for k in new])):
            out[k] = ids
        keep = {texts[k]: out[k] for k in lacking if len(texts[k]) <= LONG_RUN}
        self.late.update(keep)
        self.size += sum(map(len, keep)) + sum(map(len, keep.values())) + ENTRY_BYTES * len(keep)
        if self.size > self.most:
            self.late, self.before, self.size = {}, self.late, 0
        return out

    def of_runs(self, runs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Encodings of distinct runs: all ids, and how many each run has."""
        cut = pc.extract_regex(runs, _WORD)
        letters, rest = pc.utf8_lower(pc.struct_field(cut, "letters")), pc.if_else(cut.is_valid(), pc.struct_field(cut, "rest"), runs)
        parts = []
        for some, library in ((letters, self._joined), (rest, self.library)):
            numbered = pc.fill_null(some, "").dictionary_encode()
            texts = numbered.dictionary.to_pylist()
            parts.append((texts, numbered.indices.to_numpy().astype(np.int64), library))
        ids, base, codes = [], 0, np.empty(2 * len(runs), np.int64)
        for k, (texts, code, library) in enumerate(parts):
            codes[k::2] = base + code
            full = [t for t in texts if t]
            found = iter(self._of(full, library))
            ids += [next(found) if t else b"" for t in texts]
            base += len(texts)
        flat, end = gathered(*entries(ids), codes)
        return flat, np.diff(end[1::2], prepend=0)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where each text's ids end among all, and all ids."""
        texts = pc.fill_null(texts, "")
        if not self.by_runs:
            ids, size = entries(self.library(texts.to_pylist()))
            return np.cumsum(size), ids
        odd = pc.match_substring_regex(texts, self.odd)
        at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        split = pc.utf8_split_whitespace(pc.if_else(odd, "", texts) if len(at) else texts)
        numbered = split.values.dictionary_encode()
        code, last = numbered.indices.to_numpy().astype(np.int64), split.offsets.to_numpy()[1:].astype(np.int64)
        flat, size = self.of_runs(numbered.dictionary)
        if len(at):  # each odd text is one more run
            whole, whole_size = entries(self.library(texts.take(pa.array(at)).to_pylist()))
            code = np.insert(code, last[at], len(size) + np.arange(len(at)))
            last += np.cumsum(np.bincount(at, minlength=len(last)))
            flat, size = np.r_[flat, whole], np.r_[size, whole_size]
        ids, end = gathered(flat, size, code)
        return np.r_[0, end][last], ids


@lru_cache(maxsize=2)
def run_encoder(spec: str) -> RunEncoder:
    return RunEncoder(spec)


def write_token_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    files: int | None = None,
    stripe_bytes: int = STRIPE_BYTES,
    row_index_stride: int = ROW_INDEX_STRIDE,
) -> None:
    """Write (``id_col``, ``ids``, ``ids_crc32``) as ORC files in the order of ids."""
    spark = docs.sparkSession
    rows = picked(docs, id=id_col, text=text_col)
    spec = spark.sparkContext.broadcast(read_spec(tokenizer or default_tokenizer("word_bpe_49k.json")))
    schema = T.StructType(
        [
            T.StructField(id_col, rows.schema["id"].dataType),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )
    def build():
        encode = run_encoder(spec.value).encode

        def step(b):
            ends, ids = encode(b.column(1).cast(pa.string()))
            ids = np.insert(ids, ends, np.uint32(end_id))  # behind each document
            ends = ends + np.arange(1, len(ends) + 1)
            starts = np.r_[0, ends[:-1]]
            raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            return {
                id_col: b.column(0),
                "ids": pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(ids.view(np.int32))),
                "ids_crc32": [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(starts.tolist(), ends.tolist())],
            }

        return step

    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    encoded = rowwise(rows.repartitionByRange(n, F.col("id").asc_nulls_first()), schema, build, BATCH_BYTES)
    (
        encoded.sortWithinPartitions(F.col(f"`{id_col}`").asc_nulls_first(), "ids_crc32")
        .write.option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", row_index_stride)
        .option("orc.bloom.filter.columns", id_col)
        .option("orc.bloom.filter.fpp", 0.01)
        .orc(path)
    )


def read_token_ids(spark: SparkSession, path: str, id_col: str = "doc_id", id_type: T.DataType = T.LongType()) -> DataFrame:
    """The documents of written files: ids, how many there are and where they begin among all documents' ids."""
    stored = T.StructType(
        [T.StructField(id_col, id_type), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("ids_crc32", T.LongType())]
    )
    return spark.read.schema(stored).orc(path).withColumn("file", F.col("_metadata.file_name"))


def token_offsets(stored: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``start``, ``n_tokens`` and ``ids_crc32`` of each stored document, computed from its ids.

    Counts of files are summed over the files' order, and counts of documents within each file.
    """
    rows = stored.select(F.col(f"`{id_col}`").alias("id"), "file", "ids")
    schema = T.StructType(
        [
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("file", T.StringType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )

    def step(b):
        ids = b.column(2)
        offsets, values = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        return {
            "id": b.column(0),
            "file": b.column(1),
            "n_tokens": np.diff(offsets).astype(np.int64),
            "ids_crc32": [zlib.crc32(values[s:e].tobytes()) for s, e in zip(offsets[:-1], offsets[1:])],
        }

    counted, _ = written(rowwise(rows, schema, lambda: step), "counted")  # read twice below, ids only once
    files = counted.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    # one row a file, in the order of part numbers
    ordered = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    before = files.select("file", F.coalesce(F.sum("n").over(ordered), F.lit(0)).alias("before"))
    inside = Window.partitionBy("file").orderBy(F.col("id").asc_nulls_first(), "ids_crc32").rowsBetween(Window.unboundedPreceding, -1)
    return (
        counted.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(before, "file")
        .select(F.col("id").alias(id_col), (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
    )


def documents_by_id(spark: SparkSession, path: str, ids: list[int], id_col: str = "doc_id") -> DataFrame:
    """Stored documents with one of ``ids``; row indexes and Bloom filters let the reader skip the other stripes."""
    return read_token_ids(spark, path, id_col).filter(F.col(f"`{id_col}`").isin(ids)).drop("file")


def token_output(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Write ``docs`` and read them back: id, ``start``, ``n_tokens`` and ``ids_crc32`` of each document."""
    spark = docs.sparkSession
    path = path or new_path(spark, "token-ids")
    write_token_ids(docs, path, tokenizer, id_col, text_col)
    return token_offsets(read_token_ids(spark, path, id_col, docs.schema[id_col].dataType), id_col)
