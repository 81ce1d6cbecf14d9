"""BPE encoding and decoding by a file of ranks, with recursive queries of DuckDB inside the tasks.

The split pattern cuts a text into words. A word that is a token is that token. Of each other word there is a row for each byte (word, position, token); a
recursive query joins neighbours with the merge table, contracts the leftmost pair of the least rank of each word, and feeds the changed rows to the next
round, until no word has a pair left. The table of rows is kept by key, so it never grows. Decoding joins the ids with the vocabulary and puts the bytes
together by an ordered aggregation. Spark deals the rows out and bounds the batches; each Python process holds one connection in memory, on one thread.

Words of more than LONG bytes go through a second form of the query, which contracts all pairs of the least rank that do not overlap at once where that
cannot change the result: where no merge of the new token has a smaller rank than its own. For other ranks it contracts the leftmost pair, as the first.

Defined results: null and empty texts have no ids and decode to nothing. No text is a special token. Repeated rows are encoded like any other; extra
columns are not looked at. An id that is null or outside the vocabulary decodes to nothing.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybeam.llm.bpe import SPLIT
from tallybeam.llm.common import bound_batches, map_batches, texts

#: Words of one recursive query, and their bytes (one word at least).
WORDS, WORD_BYTES = 20_000, 1 << 18
#: Bytes from which on a word's equal pairs are contracted together.
LONG = 256
#: Words that a process remembers, from task to task; when they are too many, it begins anew with those of the batch at hand.
REMEMBERED = 1 << 20
MEMORY = "384MB"

#: A row's key is its word's number above 32 bits and its place in the word below. Rows with their neighbours, and the pairs that can be merged; {order} numbers the rows where that is needed.
_PAIRS = """
    near AS (SELECT key, token, lead(key) OVER w AS next_key, lead(token) OVER w AS next_token {order} FROM recurring.symbols WHERE token IS NOT NULL WINDOW w AS (ORDER BY key)),
    pairs AS (SELECT key >> 32 AS word, n.*, m.merged, m.alone FROM near n JOIN merges m ON m.a = n.token AND m.b = n.next_token WHERE next_key >> 32 = key >> 32)"""
_LEFTMOST = """
    least AS (SELECT word, min((merged::BIGINT << 32) | (key & 4294967295)) AS pair, arg_min(next_key, (merged::BIGINT << 32) | (key & 4294967295)) AS next_key FROM pairs GROUP BY word),
    chosen AS (SELECT (word << 32) | (pair & 4294967295) AS key, next_key, (pair >> 32)::INT AS merged FROM least)"""
_TOGETHER = """
    least AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY key) AS j FROM (SELECT *, min(merged) OVER (PARTITION BY word) AS best FROM pairs) WHERE merged = best),
    chosen AS (SELECT key, next_key, merged FROM (SELECT *, row_number() OVER (PARTITION BY word, i - j ORDER BY key) AS k FROM least) WHERE CASE WHEN alone THEN j = 1 ELSE k % 2 = 1 END)"""


def _contract(together: bool) -> str:
    pairs = _PAIRS.format(order=", row_number() OVER w AS i" if together else "")
    return f"""WITH RECURSIVE symbols(key, token) USING KEY (key) AS (SELECT key, token FROM bytes UNION (
        WITH {pairs}, {_TOGETHER if together else _LEFTMOST} SELECT key, merged FROM chosen UNION ALL SELECT next_key, NULL FROM chosen))
    SELECT key, token FROM symbols WHERE token IS NOT NULL ORDER BY key"""


class Codec:
    """One vocabulary in DuckDB: the tables merges (a, b, merged, alone) and vocabulary (id, piece): a byte is the character of its number there,
    as aggregations join characters only."""

    def __init__(self, text: str, pattern: str):
        lines = [line.split() for line in text.splitlines() if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        ranks = self.ranks
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the ranks must hold every byte")
        self.byte_tokens = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        merges = [(ranks[t[:k]], ranks[t[k:]], rank) for t, rank in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        early = {side for a, b, merged in merges for side in (a, b) if merged < side}
        a, b, merged = (np.array(x, np.int32) for x in zip(*merges)) if merges else (np.empty(0, np.int32),) * 3
        alone = np.isin(merged, np.array([*early], np.int32))
        self.find = regex.compile(pattern).findall
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        self._keep("merges", pa.table({"a": a, "b": b, "merged": merged, "alone": alone}))
        self._keep("vocabulary", pa.table({"id": pa.array(ranks.values(), pa.int32()), "piece": pa.array([t.decode("latin-1") for t in ranks], pa.string())}))
        self.decimals = pa.array([str(i) for i in range(max(ranks.values()) + 1)], pa.string())
        #: The number of each remembered word, and the lists of ids by number; the tokens that are words come first and stay.
        whole = {t.decode(): rank for t, rank in ranks.items() if _is_text(t)}
        self.tokens = {word: i for i, word in enumerate(whole)}
        self.token_ids = pa.ListArray.from_arrays(pa.array(range(len(whole) + 1), pa.int32()), pa.array(whole.values(), pa.int32()))
        self.known, self.known_ids = dict(self.tokens), self.token_ids

    def _keep(self, name: str, rows: pa.Table) -> None:
        self.db.register("_given", rows)
        self.db.execute(f"CREATE TABLE {name} AS FROM _given")
        self.db.unregister("_given")

    def merge_all(self, words: list[bytes]) -> pa.ListArray:
        """The ids of words of one byte or more. Words of like length share a query, so that all take about as many rounds."""
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        out = [pa.array([], pa.list_(pa.int32()))]
        for numbers in _parts(order, [len(words[i]) for i in order]):
            part = [words[i] for i in numbers]
            n = np.fromiter(map(len, part), np.int64, len(part))
            word = np.repeat(np.arange(len(part)), n)
            key = word << 32 | np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)
            self.db.register("bytes", pa.table({"key": key, "token": self.byte_tokens[np.frombuffer(b"".join(part), np.uint8)]}))
            found = self.db.sql(_contract(together=len(part[0]) > LONG)).to_arrow_table().combine_chunks()
            self.db.unregister("bytes")
            ends = np.searchsorted(found.column(0).to_numpy() >> 32, np.arange(len(part) + 1))
            out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found.column(1).combine_chunks()))
        back = np.empty(len(words), np.int64)
        back[order] = np.arange(len(words))
        return pa.concat_arrays(out).take(pa.array(back))

    def encode_all(self, whole: list[str]) -> pa.ListArray:
        """The ids of many texts; the words that they have in common are merged once and together."""
        split = [self.find(x) for x in whole]
        coded = pa.array(chain.from_iterable(split), pa.string()).dictionary_encode()
        words = coded.dictionary.to_pylist()
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > len(self.tokens) + REMEMBERED:
            self.known, self.known_ids = dict(self.tokens), self.token_ids
            new = [w for w in words if w not in self.known]
        self.known.update((w, i) for i, w in enumerate(new, len(self.known)))
        self.known_ids = pa.concat_arrays([self.known_ids, self.merge_all([w.encode() for w in new])])
        number = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        ids = self.known_ids.take(pa.array(number[coded.indices.to_numpy()]))
        starts = np.append(0, np.cumsum(ids.value_lengths().to_numpy()))[np.append(0, np.cumsum([len(x) for x in split])).astype(np.int64)]
        return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), ids.flatten())

    def decode_all(self, ids: pa.ListArray) -> list[bytes]:
        """The bytes of each list of ids, in order."""
        n = ids.value_lengths().fill_null(0).to_numpy()
        row, place = np.repeat(np.arange(len(ids), dtype=np.int32), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        self.db.register("tokens", pa.table({"row": row, "place": place.astype(np.int32), "id": ids.flatten()}))
        content = "SELECT row, string_agg(piece, '' ORDER BY place) AS content FROM tokens JOIN vocabulary USING (id) GROUP BY row"
        found = self.db.sql(f"SELECT content FROM range({len(ids)}) r(row) LEFT JOIN ({content}) USING (row) ORDER BY row").to_arrow_table().column(0).to_pylist()
        self.db.unregister("tokens")
        return [(x or "").encode("latin-1") for x in found]


def _is_text(token: bytes) -> bool:
    try:
        token.decode()
        return True
    except UnicodeDecodeError:
        return False


def _parts(numbers: list[int], sizes: list[int]) -> Iterator[list[int]]:
    """Runs of words for one query each, in order of rising size; short and long words are never in one."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and (i - start >= WORDS or total + size > WORD_BYTES or sizes[start] <= LONG < size):
            yield numbers[start:i]
            start, total = i, 0
        total += size
    if start < len(numbers):
        yield numbers[start:]


@lru_cache(maxsize=2)
def _codec(text: str, pattern: str) -> Codec:
    return Codec(text, pattern)


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _shared_codec(spark: SparkSession, path: str | None, pattern: str):
    """Executors get the ranks (a file of fixed size) from the driver; each Python process builds its tables once."""
    with open(path or default_ranks(), encoding="ascii") as f:
        text = spark.sparkContext.broadcast(f.read())
    return lambda: _codec(text.value, pattern)


def encode(docs: DataFrame, ranks: str | None = None, text: str = "text", key: str = "doc_id", pattern: str = SPLIT) -> DataFrame:
    """key, ids array<int> of each text."""
    codec, kind = _shared_codec(docs.sparkSession, ranks, pattern), docs.schema[key].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = codec().encode_all([x.decode() for x in texts(batch.column(1))])
        return pa.RecordBatch.from_arrays([batch.column(0), ids], [key, "ids"])

    return map_batches(docs.select(F.col(key), F.col(text)), work, f"`{key}` {kind}, ids array<int>", text)


def decode(encoded: DataFrame, ranks: str | None = None, key: str = "doc_id") -> DataFrame:
    """key, content binary of each row's ids."""
    codec, kind = _shared_codec(encoded.sparkSession, ranks, SPLIT), encoded.schema[key].dataType.simpleString()
    bound_batches(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content = codec().decode_all(batch.column(1).cast(pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(content, pa.binary())], [key, "content"])

    return encoded.select(F.col(key), F.col("ids").cast("array<int>")).mapInArrow(run, f"`{key}` {kind}, content binary")


def digests(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by spaces), decoded_sha256 of every whole text; encoded and decoded in one pass."""
    codec = _shared_codec(docs.sparkSession, ranks, SPLIT)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = codec()
        ids = c.encode_all([x.decode() for x in texts(batch.column(1))])
        sha = lambda x: hashlib.sha256(x).hexdigest()
        decimals = pc.binary_join(pa.ListArray.from_arrays(ids.offsets, c.decimals.take(ids.values)), " ")
        columns = [batch.column(0), ids.value_lengths().cast(pa.int64()), pa.array((sha(x.encode()) for x in decimals.to_pylist()), pa.string()), pa.array(map(sha, c.decode_all(ids)), pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), work, schema, "text")
