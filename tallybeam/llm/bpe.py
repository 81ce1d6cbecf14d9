"""BPE encoding and decoding with a public byte-level vocabulary.

Each piece that the split pattern finds is merged by a segment tree over the ranks of its adjacent pairs:
a leaf holds (rank, position) of the pair that starts there, so the root yields the leftmost pair of the
lowest rank. A merge updates three leaves, each in logarithmic time, until no pair can be merged.

Defined results: null and empty texts have no ids and decode to "". The strings of special tokens in a
text are those tokens, as in the library. Repeated rows are encoded like any other; extra columns are ignored.
Ids that decode to broken UTF-8 give U+FFFD, as in the library. Decoding an id that is null or outside the vocabulary skips it.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybeam.llm.common import map_batches, texts

#: The split pattern of byte-level BPE.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces of SHORT characters at most that a process remembers, in each of two generations, so memory stays bounded on any corpus.
REMEMBERED, SHORT = 1 << 18, 40
#: Pieces that are merged in lockstep.
LOCKSTEP = 1 << 12
SHIFT = 28
POSITION, NONE = (1 << SHIFT) - 1, 1 << 62


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself if printable Latin-1, else the next one from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in printable}
    for b in range(256):
        if b not in out:
            out[b] = chr(0x100 + len(out) - len(printable))
    return [out[b] for b in range(256)]


class Memo(dict):
    """Values of a function of a piece. When a generation is full it becomes the older one, whose pieces return when they are asked for."""

    def __init__(self, function):
        super().__init__()
        self.function, self.older = function, {}

    def __missing__(self, piece: str) -> list[int]:
        found = self.older.get(piece)
        if found is None:
            found = self.function(piece.encode())
        if len(piece) <= SHORT:
            if len(self) >= REMEMBERED:
                self.turn()
            self[piece] = found
        return found

    def turn(self) -> None:
        self.older = dict(self)
        self.clear()

    def forget(self) -> None:
        self.older = {}
        self.clear()


class Codec:
    """Encoder and decoder of one vocabulary, given as the JSON text of a tokenizers file."""

    def __init__(self, text: str):
        data = json.loads(text)
        model, split = data["model"], data["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or data["normalizer"]:
            raise ValueError("only byte-level BPE without a prefix space or normalizer is supported")
        vocab, alphabet = model["vocab"], byte_alphabet()
        back = {c: bytes([b]) for b, c in enumerate(alphabet)}
        self.byte_ids = [vocab[c] for c in alphabet]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        #: A pair of ids, as one number, to its rank above SHIFT bits; a rank to the merged id.
        self.ranks = {vocab[a] << SHIFT | vocab[b]: rank << SHIFT for rank, (a, b) in enumerate(pairs)}
        self.merged = [vocab[a + b] for a, b in pairs]
        self.byte_array, self.merged_array = np.array(self.byte_ids, np.int64), np.array([*self.merged, 0], np.int64)
        self.numbers = np.array(range(max(vocab.values(), default=0) + 1), object)  # one int object for each id, shared by all remembered pieces
        self.keys = np.array(sorted(self.ranks) or [-1], np.int64)
        self.key_ranks = np.array([self.ranks.get(k, NONE) for k in self.keys.tolist()], np.int64)
        self.pieces: dict[int, bytes] = {i: b"".join(map(back.__getitem__, t)) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.pieces |= {i: t.encode() for t, i in self.special.items()}
        self.find = regex.compile(SPLIT).findall
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")").split if self.special else None
        self.known = Memo(self.merge)
        self.decimal = [b"%d" % i for i in range(max(self.pieces) + 1)]
        self.text_of = [self.pieces.get(i, b"") for i in range(max(self.pieces) + 1)]

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece.

        tree is a segment tree of minima: leaf base + i holds rank and position of the pair of symbol i with the next
        living one (or NONE), so tree[1] is the leftmost pair of the lowest rank.
        """
        ids = [self.byte_ids[b] for b in piece]
        n, ranks, merged = len(ids), self.ranks.get, self.merged
        if n < 2:
            return ids
        base = 1 << (n - 2).bit_length()
        tree = [NONE] * (2 * base)
        a = ids[0]
        for i in range(1, n):
            b = ids[i]
            if (rank := ranks(a << SHIFT | b)) is not None:
                tree[base + i - 1] = rank | (i - 1)
            a = b
        for i in range(base - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (least := tree[1]) != NONE:
            i = least & POSITION
            j = after[i]
            ids[i] = new = merged[least >> SHIFT]
            ids[j] = -1
            k = after[i] = after[j]
            changed = [(i, NONE)]
            if k < n:
                before[k] = i
                changed = [(j, NONE), (i, NONE if (rank := ranks(new << SHIFT | ids[k])) is None else rank | i)]
            if (h := before[i]) >= 0:
                changed.append((h, NONE if (rank := ranks(ids[h] << SHIFT | new)) is None else rank | h))
            for leaf, value in changed:
                at = base + leaf
                tree[at] = value
                while at > 1:
                    other = tree[at ^ 1]
                    at >>= 1
                    if other < value:
                        value = other
                    if tree[at] == value:
                        break
                    tree[at] = value
        return [x for x in ids if x >= 0]

    def merge_all(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of many pieces: merge() in lockstep, with one column of numpy arrays a piece.

        tree is as in merge(), with an axis of pieces: each round takes every root, merges there, sets the three
        changed leaves and repairs the paths above them, until no piece has a pair left.
        """
        if not pieces:
            return []
        n = np.fromiter(map(len, pieces), np.int64, len(pieces))
        width = max(2, int(n.max()))
        base = 1 << (width - 1).bit_length()
        flat = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in pieces]), np.uint8).reshape(-1, width)
        ids = np.ascontiguousarray(self.byte_array[flat].T)
        ids[np.arange(width)[:, None] >= n] = -1
        rows = np.arange(width)[:, None]
        tree = np.full((2 * base, len(pieces)), NONE)
        tree[base : base + width - 1] = self.leaves(ids[:-1], ids[1:], rows[:-1])
        for i in range(base - 1, 0, -1):
            np.minimum(tree[2 * i], tree[2 * i + 1], out=tree[i])
        after, before = (np.repeat(x, len(pieces), axis=1) for x in (rows + 1, np.arange(-1, width)[:, None]))
        piece = np.flatnonzero(tree[1] != NONE)
        while len(piece):
            least = tree[1, piece]
            i = least & POSITION
            new = self.merged_array[least >> SHIFT]
            j = after[i, piece]
            k = after[j, piece]
            ids[i, piece], ids[j, piece], after[i, piece], before[k, piece] = new, -1, k, i
            h = before[i, piece]
            left = np.maximum(h, 0)
            tree[base + j, piece] = NONE
            tree[base + i, piece] = np.where(k < n[piece], self.leaves(new, ids[np.minimum(k, width - 1), piece], i), NONE)
            tree[base + np.where(h < 0, j, h), piece] = np.where(h < 0, NONE, self.leaves(ids[left, piece], new, h))
            at = base + np.stack([i, j, left])
            while at[0, 0] > 1:
                at >>= 1
                tree[at, piece] = np.minimum(tree[2 * at, piece], tree[2 * at + 1, piece])
            piece = piece[tree[1, piece] != NONE]
        living = ids.T >= 0
        ends = np.cumsum(living.sum(axis=1)).tolist()
        flat_ids = tuple(self.numbers[ids.T[living]].tolist())
        return [flat_ids[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def leaves(self, left: np.ndarray, right: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Rank and position of each pair of ids, or NONE."""
        key = left << SHIFT | right
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[found] == key) & (left >= 0) & (right >= 0), self.key_ranks[found] | position, NONE)

    def learn(self, pieces: set[str]) -> None:
        """Remember the ids of the short ones among the pieces."""
        new = [p for p in pieces.difference(self.known, self.known.older) if len(p) <= SHORT]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.turn()
        raw = [*map(str.encode, new)]
        order = np.argsort(np.fromiter(map(len, raw), np.int64, len(raw)), kind="stable").tolist()
        for i in range(0, len(order), LOCKSTEP):
            part = order[i : i + LOCKSTEP]
            self.known.update(zip(map(new.__getitem__, part), self.merge_all([*map(raw.__getitem__, part)]), strict=True))

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """The ids of many texts; the pieces that they have in common are merged once and together."""
        ids_of = self.known.__getitem__
        parts = [[p if k % 2 else self.find(p) for k, p in enumerate(self.cut(x))] if self.cut and any(t in x for t in self.special) else [self.find(x)] for x in texts]
        seen: set[str] = set()
        for part in parts:
            seen.update(*part[::2])
        self.learn(seen)
        return [[*chain.from_iterable(map(ids_of, part[0]))] if len(part) == 1 else [*chain.from_iterable([self.special[x]] if k % 2 else chain.from_iterable(map(ids_of, x)) for k, x in enumerate(part))] for part in parts]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> str:
        """Special tokens are kept as their strings."""
        try:
            return b"".join(map(self.text_of.__getitem__, ids)).decode("utf-8", errors="replace")
        except IndexError:
            return b"".join([self.pieces.get(i, b"") for i in ids]).decode("utf-8", errors="replace")


@lru_cache(maxsize=4)
def _codec(text: str) -> Codec:
    return Codec(text)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _shared_codec(spark: SparkSession, path: str | None):
    """Executors get the vocabulary (a file of fixed size) from the driver; each Python process builds it once."""
    with open(path or default_vocabulary(), encoding="utf-8") as f:
        text = spark.sparkContext.broadcast(f.read())
    return lambda: _codec(text.value)


def encode(docs: DataFrame, vocabulary: str | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, ids array<int> of each text."""
    codec, kind = _shared_codec(docs.sparkSession, vocabulary), docs.schema[key].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = codec()
        ids = c.encode_all([x.decode() for x in texts(batch.column(1))])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], [key, "ids"])

    return map_batches(docs.select(key, text), work, f"`{key}` {kind}, ids array<int>", text, lambda: codec().known.forget())


def decode(encoded: DataFrame, vocabulary: str | None = None, key: str = "doc_id") -> DataFrame:
    """key, text of each row's ids; null ids decode to ""."""
    codec, kind = _shared_codec(encoded.sparkSession, vocabulary), encoded.schema[key].dataType.simpleString()

    def run(batches):
        c = codec()
        for batch in batches:
            out = [c.decode([i for i in x or [] if i is not None and i >= 0]) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], [key, "text"])

    return encoded.select(key, "ids").mapInArrow(run, f"`{key}` {kind}, text string")


def encode_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, source, n_tokens, ids array<int>, round_trip boolean (the ids decode to the text): the pipeline's tokens."""
    codec = _shared_codec(docs.sparkSession, vocabulary)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = codec()
        whole = [x.decode() for x in texts(batch.column(2))]
        ids = c.encode_all(whole)
        same = [c.decode(i) == x for i, x in zip(ids, whole, strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(map(len, ids), pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(same, pa.bool_())],
            ["doc_id", "source", "n_tokens", "ids", "round_trip"],
        )

    return map_batches(docs.select(F.col("doc_id").cast("long"), "source", "text"), work, "doc_id long, source string, n_tokens long, ids array<int>, round_trip boolean", "text", lambda: codec().known.forget())


def digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 of every whole text.

    Encoding and decoding run in one pass, so the ids of a corpus never leave the process that made them.
    """
    codec = _shared_codec(docs.sparkSession, vocabulary)
    sha = lambda x: hashlib.sha256(x).hexdigest()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        c, counts, ids_sha, decoded_sha = codec(), [], [], []
        for ids in c.encode_all([x.decode() for x in texts(batch.column(1))]):
            counts.append(len(ids))
            ids_sha.append(sha(b",".join(map(c.decimal.__getitem__, ids))))
            decoded_sha.append(sha(c.decode(ids).encode()))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", "text", lambda: codec().known.forget())
