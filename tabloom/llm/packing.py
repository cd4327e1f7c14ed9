"""Packing of documents into token windows by lexical retrieval.

Each document is tokenised once. Its full windows are sequences of their own; what is left over, less
than a window, is dealt by content over shards of bounded size: by its best BM25 term that enough
documents hold, and, where a term has more than a shard, by a least hash of its best terms. A shard
holds a BM25 inverted index of its leftovers, with document frequencies and the mean length of the
whole table. Seed by seed, the window is filled greedily with the best unused neighbours of the seed,
cut where the window is full.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.bpe import _arrow
from tabloom.llm.common import batch, slices, text_of
from tabloom.plans.storage import written

WINDOW, END = 4096, 2
#: Tokens of a shard on average, and the terms of a seed that ask the index (its best by BM25).
SHARD, TERMS = 1_000_000, 24
#: Leftovers that share a dealing term are at least this part of a shard's, if their terms allow it.
DEAL_PART = 1 / 8
K1, B = 1.2, 0.75
#: Chunks a worker remembers; it forgets all of them beyond that.
MOST_KNOWN = 700_000

_ODD = re.compile(r"[\x1c-\x1f]")
#: Marks beyond ASCII, letters that may compose or have two characters in lower case, apostrophes of
#: contractions, and those separators.
_SPECIAL = re.compile(r"[^\x00-\x7fÀ-ɏ]|[×÷İ'\x1c-\x1f]")
#: Of each byte: white space 0, a mark or control of ASCII but the apostrophe 2, anything else 1.
_KIND = np.ones(256, np.uint8)
_KIND[list(b" \t\n\v\f\r")] = 0
_KIND[[*range(9), *range(14, 28), *range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), *range(123, 128)]] = 2


def _plain(text: str) -> bool:
    """No character that _SPECIAL finds; most texts show it without the search."""
    if text.isascii():
        return "'" not in text and not any(c in text for c in "\x1c\x1d\x1e\x1f")
    return not _SPECIAL.search(text)


def _chunks(texts: list[str]) -> list[list[str]]:
    """The chunks of plain lower-case texts: runs between white space, cut where marks and others meet."""
    if not texts:
        return []
    raw = np.frombuffer("\x1e".join(texts).encode(), np.uint8)  # no plain text has the separator
    kind = _KIND[raw]
    cut = np.flatnonzero(kind[1:] * kind[:-1] == 2) + 1
    return [part.split() for part in np.insert(raw, cut, 32).tobytes().decode().split("\x1e")]


class _Tokens:
    """A worker's tokenizer, and the ids of the chunks between white space that it has met.

    The tokenizer's words never span white space, so a text's ids are those of its chunks in order;
    its words end in a token that is marked as an end, which tells the ids of joined words apart.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        if self.size > 65536:
            raise ValueError("ids above 65535 need a wider code")
        self.last = np.zeros(65536, bool)
        self.last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}
        # Added tokens match in the raw text, or in the lower-case one if they are normalized.
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # What each of them has at its beginning, whatever the case, rules most texts out.
        self.begins = {re.match(r"[^\w]*", t)[0] for t in added}
        self.added = re.compile("|".join(map(re.escape, sorted(added))) or r"(?!)", re.IGNORECASE)

    def _alone(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u2").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_words(self, words: list[str]) -> None:
        for a in range(0, len(words), 20_000):
            some = words[a : a + 20_000]
            raw = self._alone([" ".join(some)])[0]
            cut = np.flatnonzero(self.last[np.frombuffer(raw, "<u2")]) + 1
            if len(cut) == len(some):
                ends = (cut * 2).tolist()
                self.known.update((w, raw[s:e]) for w, s, e in zip(some, [0, *ends], ends, strict=False))
            else:  # some word is more than one to the tokenizer
                self.known.update(zip(some, self._alone(some), strict=True))

    def _learn(self, new: set[str]) -> None:
        if len(self.known) > MOST_KNOWN:
            self.known.clear()
        words, other = [], []
        for chunk in new.difference(self.known):
            (words if chunk.isalpha() else other).append(chunk)
        self._learn_words(words)
        self.known.update(zip(other, self._alone(other), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian 16-bit numbers.

        Runs of ASCII marks between letters are words of their own, so they are cut off first, in
        lower case, where nothing in the text could make that differ. Other texts keep their chunks,
        and those with an added token are encoded whole.
        """
        cut: list[list[str] | None] = []
        plain: list[int] = []
        for i, text in enumerate(texts):
            cut.append(None)
            if any(b in text for b in self.begins) and self.added.search(text):
                continue  # added tokens may hold marks, and take white space beside them
            if _plain(text):
                plain.append(i)
            elif not _ODD.search(text):  # separators of Python that are not white space to the tokenizer need the whole text
                cut[i] = text.split()
        for i, parts in zip(plain, _chunks([texts[i].lower() for i in plain]), strict=True):
            cut[i] = parts
        seen: set[str] = set()
        for parts in cut:
            seen.update(parts or ())
        self._learn(seen)
        get = self.known.__getitem__
        return [self._alone([t])[0] if parts is None else b"".join(map(get, parts)) for t, parts in zip(texts, cut, strict=True)]


_TOKENS: dict[str, _Tokens] = {}


def _crc(ids: bytes) -> int:
    return zlib.crc32(np.frombuffer(ids, "<u2").astype("<u4").tobytes())


def tokenised(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, end: int = END) -> DataFrame:
    """Pieces (key, start, length, crc, doc_tokens, ids): full windows without ids, and leftovers with them.

    Each task adds rows with a null length: how many of its documents hold each term (``ids`` has the
    terms, ``counts`` the numbers).
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = pa.schema([
        ("key", _arrow(kind)), ("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary()),
    ])
    mark = int(end).to_bytes(2, "little")

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _TOKENS:
            _TOKENS[vocabulary] = _Tokens(vocabulary)
        coder = _TOKENS[vocabulary]
        frequency = np.zeros(65536, np.int64)
        for part in parts:
            texts, keys = part.column(1).to_pylist(), part.column(0).cast(schema.field(0).type)
            for a, b in slices(texts, 2_000_000):
                coded = [c + mark for c in coder.encode(texts[a:b])]
                sizes = np.array([len(c) // 2 for c in coded])
                flat = np.frombuffer(b"".join(coded), "<u2")
                both = np.sort(np.repeat(np.arange(len(coded), dtype=np.uint64) << np.uint64(16), sizes) | flat)
                once = both[np.concatenate([[True], both[1:] != both[:-1]])] & np.uint64(65535)
                frequency += np.bincount(once.astype(np.int64), minlength=65536)
                rows, start, length, crc, ids = [], [], [], [], []
                for i, raw in enumerate(coded):
                    n = len(raw) // 2
                    for s in range(0, n, window):
                        piece = raw[2 * s : 2 * (s + window)]
                        rows.append(i)
                        start.append(s)
                        length.append(len(piece) // 2)
                        full = len(piece) == 2 * window
                        crc.append(_crc(piece) if full else None)
                        ids.append(None if full else piece)
                yield batch(schema, keys.slice(a, b - a).take(pa.array(rows, pa.int64())), start, length, crc, sizes[rows], ids, pa.nulls(len(rows), pa.binary()))
        terms = np.flatnonzero(frequency)
        if len(terms):
            raw = [terms.astype("<u2").tobytes()], [frequency[terms].astype("<i8").tobytes()]
            yield batch(schema, pa.nulls(1, schema.field(0).type), *(pa.nulls(1, pa.int64()) for _ in range(4)), *raw)

    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    return rows.mapInArrow(work, f"key {kind}, start bigint, length bigint, crc bigint, doc_tokens bigint, ids binary, counts binary")


def _frequencies(counts: DataFrame) -> np.ndarray:
    """Documents of the whole table that hold each term; the vocabulary bounds what reaches the driver."""
    schema = pa.schema([("term", pa.int32()), ("n", pa.int64())])

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(65536, np.int64)
        for part in parts:
            for terms, numbers in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                total[np.frombuffer(terms, "<u2")] += np.frombuffer(numbers, "<i8")
        terms = np.flatnonzero(total)
        yield batch(schema, terms.astype(np.int32), total[terms])

    out = np.zeros(65536, np.int64)
    for row in counts.select("ids", "counts").mapInArrow(work, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[row["term"]] = row["n"]
    return out


def _hashed(terms: np.ndarray) -> np.ndarray:
    """A mixed 32-bit number of each term."""
    x = (terms.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)


def topics(raw: list[bytes], idf: np.ndarray, mean: float, dealt: np.ndarray, terms: int = TERMS) -> tuple[np.ndarray, np.ndarray]:
    """Of each leftover its best term among those ``dealt`` (-1: none), and the least hash of its best terms."""
    sizes = np.array([len(r) // 2 for r in raw], np.int64)
    both = np.sort(np.repeat(np.arange(len(raw), dtype=np.int64), sizes) << 16 | np.frombuffer(b"".join(raw), "<u2"))
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
    tf = np.diff(np.concatenate([first, [len(both)]]))
    doc, term = both[first] >> 16, both[first] & 65535
    weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[doc] / mean))
    usable = dealt[term]
    order = np.lexsort((term, -weight, ~usable, doc))
    doc, term, usable = doc[order], term[order], usable[order]
    start = np.searchsorted(doc, np.arange(len(raw)))
    best = np.where(usable[start], term[start], -1)
    # Words that no second document holds say nothing about what belongs together, unless there are no others.
    top = (np.arange(len(doc)) - start[doc] < terms) & (usable | ~usable[start][doc])
    least = np.minimum.reduceat(np.where(top, _hashed(term), np.uint64(2**32)), start)
    return best, least.astype(np.int64)


def _deal(rows: DataFrame, idf: np.ndarray, mean: float, frequency: np.ndarray, shards: int, shard: int, n_left: int) -> DataFrame:
    """``rows`` with a shard each: whole terms side by side up to a shard, larger ones split by the least hash."""
    if shards == 1:
        return rows.withColumn("shard", F.lit(0))
    enough = max(2, int(DEAL_PART * n_left / shards))
    dealt = frequency >= enough
    if not dealt.any():
        dealt = frequency >= 2
    schema = pa.schema([*((f.name, _arrow(f.dataType.simpleString())) for f in rows.schema), ("topic", pa.int32()), ("least", pa.int64())])

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            raw = part.column(part.schema.get_field_index("ids")).to_pylist()
            for a, b in slices(raw, 4_000_000):
                best, least = topics(raw[a:b], idf, mean, dealt)
                yield batch(schema, *(c.slice(a, b - a).cast(f.type) for c, f in zip(part.columns, schema, strict=False)), best.astype(np.int32), least)

    spec = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    known = written(rows.mapInArrow(work, f"{spec}, topic int, least bigint"), "topics")
    # At most as many rows as the vocabulary has terms.
    sums = known.groupBy("topic").agg(F.sum("length").alias("n")).orderBy("topic").collect()
    places, at, room = [], 0, 0
    for r in sums:
        if r["n"] > shard:
            parts = -(-r["n"] // shard)
            places.append((r["topic"], at + (room > 0), parts))
            at, room = at + (room > 0) + parts, 0
        else:
            if room + r["n"] > shard:
                at, room = at + 1, 0
            places.append((r["topic"], at, 1))
            room += r["n"]
    table = rows.sparkSession.createDataFrame(places, "topic int, first long, parts long")
    known = known.join(F.broadcast(table), "topic").withColumn("shard", F.col("first") + F.pmod(F.xxhash64("least"), F.col("parts")))
    known = known.drop("topic", "least", "first", "parts")
    # Near copies beyond a shard's size have one hash; any of them belong together.
    hot, number = [], places[-1][1] + places[-1][2]
    for r in known.groupBy("shard").agg(F.sum("length").alias("n")).filter(F.col("n") > 2 * shard).orderBy("shard").collect():
        hot.append((r["shard"], number, -(-r["n"] // shard)))
        number += hot[-1][2]
    if not hot:
        return known
    known = known.join(F.broadcast(rows.sparkSession.createDataFrame(hot, "shard long, first long, parts long")), "shard", "left")
    salted = F.col("first") + F.pmod(F.xxhash64("key", "ids", "start"), F.col("parts"))
    return known.withColumn("shard", F.coalesce(salted, "shard")).drop("first", "parts")


class Index:
    """BM25 postings of a shard: for each term the leftovers with it, and their weights."""

    def __init__(self, texts: list[np.ndarray], idf: np.ndarray, mean: float):
        sizes = np.array([len(t) for t in texts], np.int64)
        flat = np.concatenate(texts).astype(np.int64)
        both = np.sort(flat << 32 | np.repeat(np.arange(len(texts)), sizes))
        first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
        tf = np.diff(np.concatenate([first, [len(both)]]))
        both = both[first]
        term, self.doc = both >> 32, both & 0xFFFFFFFF
        self.weight = (idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[self.doc] / mean))).astype(np.float32)
        self.start = np.searchsorted(term, np.arange(65537))
        by_doc = np.argsort(self.doc, kind="stable")
        self.terms, self.weights = term[by_doc], self.weight[by_doc]
        self.own = np.searchsorted(self.doc[by_doc], np.arange(len(texts) + 1))
        self.score = np.zeros(len(texts), np.float32)

    def neighbours(self, seed: int, terms: int) -> tuple[np.ndarray, np.ndarray]:
        """Leftovers that share one of the seed's best terms, and their scores."""
        a, b = self.own[seed], self.own[seed + 1]
        best = self.terms[a:b]
        if len(best) > terms:
            best = best[np.argpartition(-self.weights[a:b], terms)[:terms]]
        touched = []
        for t in best:
            docs = self.doc[self.start[t] : self.start[t + 1]]
            self.score[docs] += self.weight[self.start[t] : self.start[t + 1]]
            touched.append(docs)
        docs = np.unique(np.concatenate(touched)) if touched else np.zeros(0, np.int64)
        scores = self.score[docs].copy()
        self.score[docs] = 0
        return docs, scores


def fill(index: Index, sizes: list[int], window: int, terms: int = TERMS) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (leftover, start, length), each full but the last. Seeds go from long to short."""
    left, taken = np.array(sizes, np.int64), np.zeros(len(sizes), np.int64)
    order = [(-n, i) for i, n in enumerate(sizes)]
    heapq.heapify(order)

    def put(i: int, room: int) -> tuple[int, int, int]:
        n = int(min(left[i], room))
        piece = (i, int(taken[i]), n)
        left[i] -= n
        taken[i] += n
        if left[i]:
            heapq.heappush(order, (-int(left[i]), i))
        return piece

    def longest() -> int | None:
        while order:
            n, i = order[0]
            if left[i] == -n and left[i] > 0:
                return i
            heapq.heappop(order)
        return None

    while (seed := longest()) is not None:
        heapq.heappop(order)
        found = [put(seed, window)]
        room = window - found[0][2]
        if room:
            docs, scores = index.neighbours(seed, terms)
            open_ = left[docs] > 0
            docs, scores = docs[open_], scores[open_]
            ranked = docs[np.lexsort((docs, -scores))]
            for i in ranked:
                if room == 0:
                    break
                found.append(put(int(i), room))
                room -= found[-1][2]
        while room and (i := longest()) is not None:  # no neighbour is left: whatever is unused
            heapq.heappop(order)
            found.append(put(i, room))
            room -= found[-1][2]
        yield found


def _powers(found: list[tuple[int, int, int]], window: int) -> Iterator[list[tuple[int, int, int]]]:
    """A last window that isn't full, dealt over sequences of powers of two, which need no padding."""
    room = sum(n for _, _, n in found)
    if room == window:
        yield found
        return
    parts = list(found)
    while room:
        size = 1 << (room.bit_length() - 1)
        room -= size
        some = []
        while size:
            i, s, n = parts.pop(0)
            take = min(n, size)
            some.append((i, s, take))
            size -= take
            if take < n:
                parts.insert(0, (i, s + take, n - take))
        yield some


def pack(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, end: int = END, shard: int = SHARD, with_ids: bool = False
) -> DataFrame:
    """One row for each piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ``ids``).

    A document's ids are the tokenizer's and then ``end``; each lies in exactly one piece. Sequences
    have ``window`` ids or, at the end of a shard, a power of two, so none is padded. Null and empty
    texts have the end alone. Repeated rows are packed each. Other columns are not read; an empty
    table gives none. ``with_ids`` adds the ids of pieces, as little-endian 16-bit numbers.
    """
    if window & (window - 1):
        raise ValueError("the window is a power of two")
    kind = docs.schema[key].dataType.simpleString()
    pieces = written(tokenised(docs, vocabulary, key, text, window, end), "pieces")
    rows = pieces.filter("length IS NOT NULL")
    size = rows.agg(
        F.sum("length").alias("tokens"), F.count(F.when(F.col("start") == 0, 1)).alias("docs"),
        F.sum(F.when(F.col("crc").isNull(), F.col("length"))).alias("left"), F.count(F.when(F.col("crc").isNull(), 1)).alias("n_left"),
    ).first()
    frequency = _frequencies(pieces.filter("length IS NULL"))
    n = size["docs"] or 0
    idf = np.log1p((n - frequency + 0.5) / (frequency + 0.5)).clip(min=0.0)
    mean = max(1.0, (size["left"] or 0) / max(1, size["n_left"]))
    shards = max(1, -(-(size["left"] or 0) // shard))
    out = pa.schema([
        ("key", _arrow(kind)), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
        *([("ids", pa.binary())] if with_ids else []),
    ])

    def work(part: pa.Table) -> pa.Table:
        part = part.combine_chunks()
        raw, first = part.column("ids").to_pylist(), part.column("start").to_pylist()
        index = Index([np.frombuffer(r, "<u2") for r in raw], idf, mean)
        number = int(part.column("shard")[0].as_py()) << 32
        at, start, length, crc, sequence, offset, ids = [], [], [], [], [], [], []
        for window_of in fill(index, [len(r) // 2 for r in raw], window):
            for some in _powers(window_of, window):
                done = 0
                for i, s, m in some:
                    piece = raw[i][2 * s : 2 * (s + m)]
                    at.append(i)
                    start.append(first[i] + s)
                    length.append(m)
                    crc.append(_crc(piece))
                    sequence.append(2 * number)
                    offset.append(done)
                    ids.append(piece)
                    done += m
                number += 1
        columns = [part.column(c).combine_chunks().take(pa.array(at, pa.int64())) for c in ("key", "doc_tokens")]
        made = batch(out, columns[0].cast(out.field(0).type), start, length, crc, columns[1], sequence, offset, *([ids] if with_ids else []))
        return pa.Table.from_batches([made])

    more = ", ids binary" if with_ids else ""
    spec = f"key {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint{more}"
    dealt = _deal(rows.filter("crc IS NULL").select("key", "start", "length", "doc_tokens", "ids"), idf, mean, frequency, shards, shard, size["n_left"])
    packed = dealt.select("key", "start", "doc_tokens", "ids", "shard").groupBy("shard").applyInArrow(work, spec)
    full = rows.filter("crc IS NOT NULL").select(
        "key", "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens", (2 * F.monotonically_increasing_id() + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        *([F.lit(None).cast("binary").alias("ids")] if with_ids else []),
    )
    return packed.unionByName(full).withColumnRenamed("key", key)
