"""Byte-level BPE by recursive DuckDB queries inside the tasks of a Spark job.

Spark deals out the documents; a task cuts its texts into words by the public pattern, hands the
words it has not met yet to DuckDB as token lists, and a recursive query joins the token positions
with the merge table and contracts every word's leftmost pair of least rank until none is left.
Decoding joins token positions with the vocabulary and aggregates the bytes in order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import batch, lists, slices, text_of

#: Words above so many bytes take the query that contracts all occurrences of a pair in one round.
LONG_WORD = 64
#: Words, units and runs a worker remembers. It forgets all of them beyond that.
MOST_WORDS, MOST_UNITS = 600_000, 300_000
BLOCK = 100_000

#: A space behind any other white space. The pattern may match across it.
_OTHER_SPACE = re.compile("[\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000] ")

# One pair of each word a round: the leftmost of the least rank.
_SHORT = """
WITH RECURSIVE step(word, ids) USING KEY (word) AS (
  SELECT word, ids FROM words
  UNION ALL (
    WITH best AS (
      SELECT p.word, min(m.merged::BIGINT << 16 | p.i) AS k
      FROM (SELECT word, generate_subscripts(ids[2:], 1) AS i, unnest(ids[:-2]) AS l, unnest(ids[2:]) AS r FROM step) p
      JOIN merges m ON m.l = p.l AND m.r = p.r
      GROUP BY p.word)
    SELECT s.word, ids[:(b.k & 65535) - 1] || [(b.k >> 16)::INTEGER] || ids[(b.k & 65535) + 2:]
    FROM step s JOIN best b ON s.word = b.word))
SELECT word, ids FROM step ORDER BY word
"""

# All occurrences of the least pair in one round, every second one within an overlapping run. That
# equals one at a time when no merge with the new token ranks below it ("safe"); else the leftmost.
_LONG = """
WITH RECURSIVE step(word, ids) USING KEY (word) AS (
  SELECT word, ids FROM words
  UNION ALL (
    WITH tok AS (SELECT word, generate_subscripts(ids, 1) AS i, unnest(ids) AS id, unnest(ids[2:]) AS r FROM step),
    hit AS (SELECT t.word, t.i, m.merged, m.safe FROM tok t JOIN merges m ON m.l = t.id AND m.r = t.r),
    best AS (SELECT word, min(merged) AS merged FROM hit GROUP BY word),
    least AS (
      SELECT h.*, row_number() OVER (PARTITION BY h.word ORDER BY h.i) AS nth
      FROM hit h JOIN best b ON h.word = b.word AND h.merged = b.merged),
    pick AS (
      SELECT word, i, merged FROM (SELECT *, i - min(i) OVER (PARTITION BY word, i - nth) AS into_run FROM least)
      WHERE (safe AND into_run % 2 = 0) OR nth = 1)
    SELECT t.word, list(coalesce(c.merged, t.id) ORDER BY t.i)
    FROM tok t SEMI JOIN best b ON b.word = t.word
    LEFT JOIN pick c ON c.word = t.word AND c.i = t.i
    ANTI JOIN pick g ON g.word = t.word AND g.i = t.i - 1
    GROUP BY t.word))
SELECT word, ids FROM step ORDER BY word
"""

_DECODE = """
SELECT t.run, string_agg(v.hex, '' ORDER BY t.pos) AS hex
FROM tokens t JOIN vocab v ON v.id = t.id GROUP BY t.run ORDER BY t.run
"""


class _Coder:
    """A worker's DuckDB tables of one vocabulary, and the words it has met."""

    def __init__(self, path: str, pattern: str):
        import base64

        import duckdb
        import numpy as np
        import regex

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        if max(ranks.values()) > 65535:
            raise ValueError("ids above 65535 need a wider code")
        merges = [
            (ranks[token[:k]], ranks[token[k:]], rank)
            for token, rank in ranks.items() for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        ]
        left, right, merged = np.array(merges, np.int32).reshape(-1, 3).T
        lowest = np.full(65536, 65536)
        np.minimum.at(lowest, left, merged)
        np.minimum.at(lowest, right, merged)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "300MB"})
        self._table("merges", pa.table({"l": left, "r": right, "merged": merged, "safe": lowest[merged] > merged}))
        self._table("vocab", pa.table({"id": pa.array(ranks.values(), pa.int32()), "hex": [t.hex() for t in ranks]}))
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.spaced = np.zeros(65536, bool)
        self.spaced[[rank for token, rank in ranks.items() if token[:1] == b" "]] = True
        self.letters_match = pattern == _pattern()
        self.words: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.runs: dict[bytes, bytes] = {}

    def _table(self, name: str, rows: pa.Table) -> None:
        self.con.register("given", rows)
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def _contract(self, words: list[str], query: str) -> None:
        import numpy as np

        for start in range(0, len(words), BLOCK):
            some = words[start : start + BLOCK]
            coded = [w.encode() for w in some]
            flat = self.byte[np.frombuffer(b"".join(coded), np.uint8)]
            self.con.register("words", pa.table({
                "word": np.arange(len(some), dtype=np.int32), "ids": lists(flat, [len(c) for c in coded], pa.int32()),
            }))
            for table in self.con.sql(query).to_arrow_table().to_batches():
                ids = table.column(1)
                cut = ids.offsets.to_numpy() * 2
                raw = ids.values.to_numpy(zero_copy_only=False).astype("<u2").tobytes()
                for word, a, b in zip(table.column(0).to_pylist(), cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                    self.words[some[word]] = raw[a:b]
            self.con.unregister("words")

    def _learn(self, words: set[str]) -> None:
        if len(self.words) > MOST_WORDS:
            self.words.clear()
        new = sorted(words.difference(self.words))
        rest = []
        for word in new:  # a word of the vocabulary is its own token
            rank = self.ranks.get(word.encode())
            if rank is None:
                rest.append(word)
            else:
                self.words[word] = rank.to_bytes(2, "little")
        self._contract([w for w in rest if len(w.encode()) <= LONG_WORD], _SHORT)
        self._contract([w for w in rest if len(w.encode()) > LONG_WORD], _LONG)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian 16-bit numbers.

        A space after what is no white space always starts a word, so texts fall into units at their
        spaces. Texts with a space after any white space, or at their end, are matched whole.
        """
        find = self.pattern.findall
        if len(self.heads) + len(self.tails) > MOST_UNITS:
            self.heads.clear()
            self.tails.clear()
        whole = {i: find(t) for i, t in enumerate(texts) if "  " in t or t.endswith(" ") or _OTHER_SPACE.search(t)}
        cut = {i: t.split(" ") for i, t in enumerate(texts) if i not in whole}
        heads, tails, words = set(), set(), set()
        for parts in cut.values():
            heads.add(parts[0])
            tails.update(parts[1:])
        sides = [("", heads.difference(self.heads), self.heads), (" ", tails.difference(self.tails), self.tails)]
        # Letters alone are one match, with the space before them.
        letters = [[k for k in new if k.isalpha()] if self.letters_match else [] for _, new, _ in sides]
        mixed = [{k: find(lead + k) for k in new.difference(alone)} for (lead, new, _), alone in zip(sides, letters, strict=True)]
        for (lead, _, _), alone in zip(sides, letters, strict=True):
            words.update([lead + k for k in alone])
        for found in (*mixed[0].values(), *mixed[1].values(), *whole.values()):
            words.update(found)
        self._learn(words)
        get = self.words.__getitem__
        for (lead, _, known), alone, some in zip(sides, letters, mixed, strict=True):
            for k in alone:
                known[k] = get(lead + k)
            for k, found in some.items():
                known[k] = b"".join(map(get, found))
        tail = self.tails.__getitem__
        return [
            b"".join(map(get, whole[i])) if i in whole else self.heads[cut[i][0]] + b"".join(map(tail, cut[i][1:]))
            for i in range(len(texts))
        ]

    def decode(self, flat, sizes) -> list[bytes]:
        """Bytes of every list of ids. Lists fall into runs at ids that start with a space."""
        import numpy as np

        if len(self.runs) > MOST_UNITS:
            self.runs.clear()
        ends = np.cumsum(sizes)
        opens = self.spaced[flat]
        opens[(ends - sizes)[np.asarray(sizes) > 0]] = True
        starts = np.flatnonzero(opens)
        cut = [*(starts * 2).tolist(), 2 * len(flat)]
        raw = flat.astype("<u2").tobytes()
        runs = [raw[a:b] for a, b in zip(cut, cut[1:], strict=False)]
        new = list(set(runs).difference(self.runs))
        for start in range(0, len(new), BLOCK):
            some = new[start : start + BLOCK]
            n = np.array([len(r) // 2 for r in some])
            ids = np.frombuffer(b"".join(some), "<u2").astype(np.int32)
            run = np.repeat(np.arange(len(some), dtype=np.int32), n)
            self.con.register("tokens", pa.table({"run": run, "pos": np.arange(len(ids), dtype=np.int32), "id": ids}))
            got = self.con.execute(_DECODE).fetchnumpy()
            self.con.unregister("tokens")
            if len(got["run"]) != len(some):
                raise ValueError("ids outside the vocabulary")
            for key, hexed in zip(some, got["hex"], strict=True):
                self.runs[key] = bytes.fromhex(hexed)
        at = np.searchsorted(starts, np.concatenate([[0], ends])).tolist()
        get = self.runs.__getitem__
        return [b"".join(map(get, runs[a:b])) for a, b in zip(at, at[1:], strict=False)]


_CODERS: dict[tuple[str, str], _Coder] = {}


def _coder(path: str, pattern: str) -> _Coder:
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = _Coder(path, pattern)
    return _CODERS[path, pattern]


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def encode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", pattern: str | None = None) -> DataFrame:
    """``key`` and ``ids`` (array of int) of every whole text.

    ``vocabulary`` is a file of base64 tokens and ranks that every worker can open. Null and empty
    texts have no ids; equal texts or keys are separate rows; other columns are not read. Ids equal
    those of the library that the file belongs to, without special tokens. An empty table gives none.
    """
    pattern = pattern or _pattern()
    kind = docs.schema[key].dataType.simpleString()
    schema = pa.schema([("key", _arrow(kind)), ("ids", pa.list_(pa.int32()))])

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        coder = _coder(vocabulary, pattern)
        for part in parts:
            texts = part.column(1).to_pylist()
            for a, b in slices(texts):
                coded = coder.encode(texts[a:b])
                flat = np.frombuffer(b"".join(coded), "<u2").astype(np.int32)
                yield batch(schema, part.column(0).slice(a, b - a).cast(schema.field(0).type), lists(flat, [len(c) // 2 for c in coded], pa.int32()))

    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    return rows.mapInArrow(work, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(coded: DataFrame, vocabulary: str, key: str = "doc_id", ids: str = "ids", pattern: str | None = None) -> DataFrame:
    """``key``, ``ids`` and ``decoded`` (binary): the bytes of the ids, in order. Null ids decode to no bytes."""
    pattern = pattern or _pattern()
    kind = coded.schema[key].dataType.simpleString()
    schema = pa.schema([("key", _arrow(kind)), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        coder = _coder(vocabulary, pattern)
        for part in parts:
            column = part.column(1).cast(pa.list_(pa.int32()))
            sizes = np.diff(column.offsets.to_numpy())
            ends = np.cumsum(sizes)
            start = 0
            while start < len(sizes):  # about a million ids at once
                done = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, done + 1_000_000, side="right")))
                some = column.slice(start, stop - start)
                yield batch(schema, part.column(0).slice(start, stop - start).cast(schema.field(0).type), some, coder.decode(some.flatten().to_numpy(zero_copy_only=False), sizes[start:stop]))
                start = stop

    rows = coded.select(F.col(key).alias("key"), F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(work, f"key {kind}, ids array<int>, decoded binary").select(F.col("key").alias(key), "ids", "decoded")


def _arrow(kind: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_type(_parse_datatype_string(kind))
