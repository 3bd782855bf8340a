"""Byte-level BPE encoding of a corpus by backtracking over longest matches.

The encoder never applies merges.  At each position it takes the longest token there (found by an
Aho-Corasick automaton) and keeps it only if it can stand next to the token before it; if not, it
falls back to the next shorter token that is a prefix, and when none is left it takes back the
token before.  Two tokens can stand next to each other if merging their bytes by rank would leave
them so, which is read off the table of splits by unwinding both tokens.  No end position is tried
twice in vain, so the time is linear in the text.  Decoding cuts one byte buffer by an offset table.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the pattern that splits text before byte_bpe_50k's merges.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Words remembered per Python worker.
REMEMBERED = 200_000
_MANY = 2**62


class Backtracker:
    """Exact BPE over tokens with ranks (``ranks``: token bytes to id, where lower ids merge first)."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * size
        for t, i in ranks.items():
            self.tokens[i] = t
        self.ranks = ranks
        self.shorter = [-1] * size  # longest token that is a proper prefix
        self.merged: dict[tuple[int, int], int] = {}  # pair -> token it merges into
        self.left, self.right = list(range(size)), list(range(size))
        for i in range(size):
            t = self.tokens[i]
            for n in range(len(t) - 1, 0, -1):
                if (p := ranks.get(t[:n])) is not None:
                    self.shorter[i] = p
                    break
        for i in sorted(ranks.values()):
            t, p = self.tokens[i], self.shorter[i]
            while p >= 0:
                q = ranks.get(t[len(self.tokens[p]):], _MANY)
                if p < i and q < i and self.fits(p, q):
                    self.merged[p, q] = i
                    self.left[i], self.right[i] = p, q
                    break
                p = self.shorter[p]
        self.finder = ahocorasick.Automaton()
        for t, i in ranks.items():
            self.finder.add_word(t.decode("latin-1"), (len(t), i))
        self.finder.make_automaton()
        self.buffer = b"".join(self.tokens)
        self.offsets = [0]
        for t in self.tokens:
            self.offsets.append(self.offsets[-1] + len(t))

    def fits(self, a: int, b: int) -> bool:
        """Whether BPE leaves token ``a`` followed by token ``b`` as they are.

        Unwinds the later-made of the two at the seam; a pair at the seam that would have merged before
        the tokens around it were complete is a contradiction.
        """
        limit = _MANY
        while True:
            if self.merged.get((a, b), _MANY) < limit:
                return False
            if a > b:
                limit, a = a, self.right[a]
                if a == limit:
                    limit, b = b + 1, self.left[b]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, self.left[b]
                if b + 1 == limit:
                    limit, a = a, self.right[a]
                    if a == limit:
                        return True

    def encode(self, data: bytes) -> list[int]:
        """Ids of one pre-split word of any length."""
        n = len(data)
        longest = array("q", [-1]) * n
        reach = array("q", [0]) * n
        for end, (size, i) in self.finder.iter(data.decode("latin-1")):
            start = end - size + 1
            if size > reach[start]:
                reach[start], longest[start] = size, i
        open_ = bytearray(b"\1") * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0] if n else -1
        while at < n:
            last = out[-1] if out else -1
            while token >= 0:
                end = at + len(self.tokens[token])
                if open_[end] and (last < 0 or self.fits(last, token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                at = end
                token = longest[at] if at < n else -1
            else:
                open_[at] = 0
                token = out.pop()
                at -= len(self.tokens[token])
                token = self.shorter[token]
        return out

    def decode(self, ids) -> bytes:
        return b"".join(self.buffer[self.offsets[i]:self.offsets[i + 1]] for i in ids)


class Tokenizer:
    """Splits text and encodes its words; words are remembered, so each is worked out once per worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = SPLIT_PATTERN):
        self.engine = Backtracker(ranks)
        self.split = regex.compile(pattern).findall
        self.known: dict[str, list[int]] = {}

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        known = self.known
        for word in self.split(text):
            ids = known.get(word)
            if ids is None:
                ids = self.engine.encode(word.encode("utf-8"))
                if len(known) >= REMEMBERED:
                    known.clear()
                if len(word) < 256:
                    known[word] = ids
            out += ids
        return out

    def decode(self, ids) -> str:
        return self.engine.decode(ids).decode("utf-8", errors="replace")


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """A rank file: one base64 token and its id a line."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


_TOKENIZERS: dict[tuple[str, str], Tokenizer] = {}


def worker_tokenizer(raw: bytes, pattern: str) -> Tokenizer:
    """One tokenizer per Python worker and vocabulary."""
    key = (hashlib.sha256(raw).hexdigest(), pattern)
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = Tokenizer(read_ranks(raw), pattern)
    return _TOKENIZERS[key]


def _vocabulary(df: DataFrame, path: str):
    """The rank file as a broadcast (its size is that of the file, under 1 MB for 50k tokens)."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode_corpus(df: DataFrame, id_column: str, text: str, path: str, pattern: str = SPLIT_PATTERN) -> DataFrame:
    """``id_column`` and ids (list of int) of every row's whole text, without special tokens.

    Null and empty texts have the empty list.  Strings that spell special tokens are ordinary text.  Rows are
    kept one for one, repeats too.  A map over partitions: nothing is shuffled.  Text longer than memory allows
    for one value is the only limit.
    """
    raw = _vocabulary(df, path)
    kind = df.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = worker_tokenizer(raw.value, pattern)
        for b in batches:
            for lo in range(0, b.num_rows, 512):  # bounds the ids held at once
                part = b.slice(lo, 512)
                ends, flat = [0], array("i")
                for text_ in part.column(1):
                    flat.extend(t.encode(text_.as_py()))
                    ends.append(len(flat))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=[id_column, "ids"])

    return df.select(id_column, text).mapInArrow(run, f"`{id_column}` {kind}, ids array<int>")


def count_tokens(df: DataFrame, keep: list[str], text: str, path: str, pattern: str = SPLIT_PATTERN) -> DataFrame:
    """Columns ``keep`` and n_tokens of every row; null and empty texts have 0."""
    raw = _vocabulary(df, path)
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep) + ", n_tokens bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = worker_tokenizer(raw.value, pattern)
        for b in batches:
            n = pa.array([len(t.encode(x.as_py())) for x in b.column(b.num_columns - 1)], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], n], names=[*keep, "n_tokens"])

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def decode_corpus(df: DataFrame, id_column: str, ids: str, path: str, pattern: str = SPLIT_PATTERN) -> DataFrame:
    """``id_column`` and text of every row of ids; null ids have null text.  Ids outside the vocabulary are an error."""
    raw = _vocabulary(df, path)
    kind = df.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = worker_tokenizer(raw.value, pattern)
        for b in batches:
            texts = [None if x.as_py() is None else t.decode(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[id_column, "text"])

    return df.select(id_column, ids).mapInArrow(run, f"`{id_column}` {kind}, text string")
