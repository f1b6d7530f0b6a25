"""Byte-level BPE by prefix-sharing trie traversal, and decoding.

For each prefix of a word, the last token of the prefix's encoding says all that is needed: the encoding of the
whole word is found by walking back over last tokens. The last token t of a prefix is the one suffix of it that is a
token and that may follow the last token of what stands before t. So the distinct words of a batch form a trie, and
a depth-first traversal carries the last tokens of the path from the root; what words share is computed once. The
trie is held as its words in sorted order, which is its depth-first order, and the path as a stack.

Two tokens may stand side by side if no merge crosses the line between them. While the pieces left and right of the
line grow from single bytes to the two tokens, each adjacent pair (x, y) on the way is looked at once: the merge of
x and y would come first if its rank is under that of x's own next merge and not over that of y's.

Text is cut at white space first: the tokenizer's pattern never lets a word begin before a single space and end
after it, so pieces of an optional space and other characters are encoded once and remembered, up to a bound.

Defined cases: a null text counts as empty and has no tokens; a null id passes through; repeated rows each get
their own result. A special token's string in a text becomes that token, as in the library.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import picked, rowwise

#: Unicode white space.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECES = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: The pattern of byte-level pre-tokenizers.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: What a worker remembers of pieces, in bytes, and what an entry takes beside its text and ids.
REMEMBERED_BYTES = 32 << 20
ENTRY_BYTES = 200
#: Words and pairs of tokens that a trie encoder remembers with that many bytes of pieces; in proportion with fewer.
TRIE_WORDS = 120_000
PAIRS_REMEMBERED = 400_000
#: Longer words aren't remembered.
LONG_PIECE = 64


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()


class Generations:
    """What is remembered of words: those of late and those before them, each up to a bound."""

    def __init__(self, most: int):
        self.most, self.new, self.old = most, {}, {}

    def of(self, words: set[str], learn: Callable[[list[str]], dict[str, bytes]]) -> dict[str, bytes]:
        """The values of ``words``; ``learn`` gives those that aren't remembered."""
        new, old = self.new, self.old
        unknown = []
        for w in words - new.keys():
            if (v := old.get(w)) is None:
                unknown.append(w)
            else:
                new[w] = v
        out = new
        if unknown:
            learnt = learn(unknown)
            new.update((w, v) for w, v in learnt.items() if len(w) <= LONG_PIECE)
            if any(len(w) > LONG_PIECE for w in unknown):
                out = {w: new[w] if w in new else learnt[w] for w in words}
        if len(new) > self.most:
            self.new, self.old = {}, new
        return out


class TrieBPE:
    """Encoder and decoder of a byte-level tokenizer file of the tokenizers library."""

    def __init__(self, spec: str, remembered: int | None = None):
        self.most = remembered or REMEMBERED_BYTES
        self.pairs = int(PAIRS_REMEMBERED * self.most / REMEMBERED_BYTES)
        spec = json.loads(spec)
        model, back = spec["model"], byte_alphabet()
        raw = lambda token: bytes(back[c] for c in token)
        self.ids = {raw(t): i for t, i in model["vocab"].items()}
        self.bytes: list[bytes] = [b""] * (max([*model["vocab"].values(), *(a["id"] for a in spec["added_tokens"])]) + 1)
        for b, i in self.ids.items():
            self.bytes[i] = b
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        for s, i in self.special.items():
            self.bytes[i] = s.encode()
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}  # token -> left part, right part, rank of the merge
        for r, m in enumerate(model["merges"]):
            a, b = (raw(t) for t in (m if isinstance(m, list) else m.split(" ")))
            x, y, z = self.ids[a], self.ids[b], self.ids[a + b]
            self.rank[x, y] = r
            self.parts.setdefault(z, (x, y, r))
        self.longest = max(map(len, self.ids))
        self.last = {}  # (left, right) -> whether they may stand side by side
        self.pieces: dict[str, bytes] = {}
        self.size = 0
        self.words = Generations(int(TRIE_WORDS * self.most / REMEMBERED_BYTES))
        self._edges: tuple[dict, dict] = ({}, {})
        self._special = re.compile("|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The pieces at one side of a token as it grows from a byte, each with the rank of its next merge."""
        if (found := self._edges[side].get(token)) is None:
            up, found, at = 1 << 30, [], token
            while True:
                found.append((at, up))
                if at not in self.parts:
                    break
                up, at = self.parts[at][2], self.parts[at][side]
            found.reverse()
            self._edges[side][token] = found
        return found

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the encoding of both tokens' bytes is these two tokens."""
        if (known := self.last.get(key := (left << 20) | right)) is None:
            a, b, i, j, known = self._edge(left, 1), self._edge(right, 0), 0, 0, True
            while True:
                (x, up_x), (y, up_y) = a[i], b[j]
                if (r := self.rank.get((x, y))) is not None and r < up_x and r <= up_y:
                    known = False
                    break
                if up_x <= up_y:
                    i += 1
                    if i == len(a):
                        break
                else:
                    j += 1
                    if j == len(b):
                        break
            if len(self.last) > self.pairs:
                self.last.clear()
            self.last[key] = known
        return known

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, list[int]]:
        """The encodings of distinct words, by a depth-first traversal of their trie."""
        out: dict[bytes, list[int]] = {}
        ids, longest, fits = self.ids, self.longest, self.may_follow
        path: list[int] = []  # the last token of each prefix of the current word
        before = b""
        for word in sorted(words):
            n, shared = len(word), 0
            most = min(n, len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del path[shared:]
            for end in range(shared + 1, n + 1):
                for start in range(max(0, end - longest), end):
                    token = ids.get(word[start:end])
                    if token is not None and (start == 0 or fits(path[start - 1], token)):
                        path.append(token)
                        break
            tokens, end = [], n
            while end:
                tokens.append(path[end - 1])
                end -= len(self.bytes[path[end - 1]])
            tokens.reverse()
            out[word] = tokens
            before = word
        return out

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Encodings of new pieces, as little-endian 32-bit integers."""
        cut = [_WORDS.findall(p) for p in pieces]
        words = self.words.of({w for ws in cut for w in ws}, self._encode)
        return {p: words[ws[0]] if len(ws) == 1 else b"".join([words[w] for w in ws]) for p, ws in zip(pieces, cut)}

    def _encode(self, words: list[str]) -> dict[str, bytes]:
        found = self.encode_words(w.encode() for w in words)
        return {w: packed(found[w.encode()]) for w in words}

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        cut: list[list[tuple[bytes, list[str]]]] = []
        for t in texts:
            at, parts = 0, []
            if self._special and "<|" in t:
                for m in self._special.finditer(t):
                    parts.append((np.array([self.special[m[0]]], "<u4").tobytes(), _PIECES.findall(t[at : m.start()])))
                    at = m.end()
            parts.append((b"", _PIECES.findall(t[at:])))
            cut.append(parts)
        known = self.pieces
        learnt = self._learn(list({p for parts in cut for _, ps in parts for p in ps if p not in known}))
        known.update(learnt)
        out = [b"".join([b"".join([known[p] for p in ps]) + special for special, ps in parts]) for parts in cut]
        for p, ids in learnt.items():
            if len(p) > LONG_PIECE:
                del known[p]
            else:
                self.size += ENTRY_BYTES + len(p) + len(ids)
        if self.size > self.most:
            known.clear()
            self.size = 0
        return out

    def decode(self, ids: bytes) -> bytes:
        """The UTF-8 text of ids; bytes that aren't UTF-8 become replacement characters."""
        table = self.bytes
        raw = b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])
        return raw.decode("utf-8", "replace").encode()


@lru_cache(maxsize=2)
def encoder(spec: str, remembered: int | None = None) -> TrieBPE:
    """One encoder for each tokenizer and worker; what it remembers outlives tasks."""
    return TrieBPE(spec, remembered)


def read_spec(path: str) -> str:
    """The driver reads the tokenizer's file; tasks get its text, so that executors need no such file."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def default_tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def bpe_roundtrip(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True, remembered: int | None = None) -> DataFrame:
    """A row for each row of ``docs``: its id, ``ids``, ``n_tokens``, ``decoded`` and digests of ids and decoded text.

    ``with_ids`` False leaves out ``ids`` and ``decoded``. ``remembered`` bounds the bytes of pieces that a worker remembers.
    """
    rows = picked(docs, id=id_col, text=text_col)
    spec = rows.sparkSession.sparkContext.broadcast(read_spec(tokenizer or default_tokenizer("byte_bpe_50k.json")))
    fields = [
        T.StructField(id_col, rows.schema["id"].dataType),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    if with_ids:
        fields += [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]

    def build():
        bpe = encoder(spec.value, remembered)

        def step(b):
            all_ids = bpe.encode_batch([t or "" for t in b.column(1).to_pylist()])
            text = [bpe.decode(x) for x in all_ids]
            out = {
                id_col: b.column(0),
                "n_tokens": [len(x) // 4 for x in all_ids],
                "ids_sha256": [hashlib.sha256(x).hexdigest() for x in all_ids],
                "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in text],
            }
            if with_ids:
                out |= {"ids": lists(all_ids), "decoded": pa.array([x.decode() for x in text], pa.string())}
            return out

        return step

    return rowwise(rows, T.StructType(fields), build)


def lists(packed: list[bytes]) -> pa.Array:
    """Packed 32-bit integers as an Arrow list column."""
    ends = np.cumsum([0, *(len(x) // 4 for x in packed)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<i4"), pa.int32()))
