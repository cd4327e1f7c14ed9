"""Near duplicates: documents whose sets of word n-grams have a Jaccard similarity of a threshold or more.

N-grams have one order everywhere: those known to be frequent last, by their counts, the rest by hash.
Two similar sets share one of the first n - ceil(t n) + 1 n-grams of each (the prefix), so documents
meet under shared n-grams of prefixes only. Where they meet, a block of whole sets is stored in a trie and
joined with itself: a set walks down the trie with the overlap that a shared path has so far, and
leaves a subtree as soon as what remains can't reach the overlap that its sizes ask for.

What is wanted are the classes of linked documents, so a group of copies needs no list of its pairs:
1. Equal sets are one class, stood for by its smallest id.
2. Under each prefix n-gram the documents fall into runs by size: two runs differ too much for any link
   between them. Every document is paired with the smallest id of its run (its pivot), and one that is
   alone there is not copied at all. Blocks of a pivot and some of its documents are joined by tries;
   links give first components.
3. Runs whose documents are still in several components are joined again, pairs of blocks each, so every pair that can be similar has been in one trie or is linked by others already.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import batch, lists, slices, text_of
from tabloom.plans.storage import checkpointed, dropped, written

WORDS, THRESHOLD = 5, (75, 100)
#: Documents in a trie, and slots by which the pivots of a hot n-gram are found in two steps.
BLOCK, SLOTS = 128, 32
#: Short texts go on filling one side of a pair of blocks up to so many n-grams, so they are copied less.
GRAMS = 65_536
#: N-grams found so often within one task count as frequent; so many of them are put in order by count.
FREQUENT, MOST_FREQUENT = 8, 200_000
#: N-grams with a hash below this (36 %) are shown beyond the prefix, which tells how much of a text others share.
LOW = 36 * (2**63 // 100)
SLICE = 500_000
#: Bits of the bitmap by which rows of ids that don't matter are left out before anything moves.
BITS = 2**25
#: Marks of n-grams by probes that a block holds at once.
TOGETHER = 8_000_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = [np.uint64(m) for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _ODD[0]
    x = (x ^ (x >> np.uint64(27))) * _ODD[1]
    return x ^ (x >> np.uint64(31))


#: Separators, the lower case of A-Z, and a fixed number for every byte.
_IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_VALUE = _mix(np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint64) + _MIX)
_BASE = 0x2545F4914F6CDD1D
_INVERSE = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(0, n - 1), base, np.uint64)]), dtype=np.uint64)[:n]


def shingles(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """For each text its distinct word n-grams as sorted 63-bit numbers; of fewer words the whole sequence as one.

    All texts are hashed at once: a word's hash is the difference of two running sums over the bytes.
    """
    coded = [t.encode() for t in texts]
    raw = np.frombuffer(b" ".join([*coded, b""]), np.uint8)  # a separator ends every text
    bounds = np.cumsum([0, *(len(c) + 1 for c in coded)])
    space = _IS_SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
    start, stop = edge[0::2], edge[1::2]
    if not len(start):
        return [np.zeros(0, np.int64) for _ in texts]
    value = _VALUE[raw]
    value[space] = 0
    total = np.concatenate([[np.uint64(0)], np.cumsum(value * _powers(_BASE, len(raw)), dtype=np.uint64)])
    word = _mix((total[stop] - total[start]) * _powers(_INVERSE, len(raw))[start] + (stop - start).astype(np.uint64) * _MIX)
    first = np.searchsorted(start, bounds)  # of each text among the words
    # A row of n-grams of the full length, and for short texts one of all their words.
    gram = np.zeros(max(0, len(word) - words + 1), np.uint64)
    for i in range(words):
        gram = _mix(gram * _MIX + word[i : len(word) - words + 1 + i]) if len(gram) else gram
    gram = (gram >> np.uint64(1)).astype(np.int64)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(gram[a : b - words + 1]))
        elif b > a:
            short = np.array([b - a], np.uint64)
            for i in range(a, b):
                short = _mix(short * _MIX + word[i : i + 1])
            out.append((short >> np.uint64(1)).astype(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def _frequent(docs: DataFrame, words: int) -> np.ndarray:
    """Frequent n-grams of the whole table, the least frequent first. It only puts n-grams in order.

    An n-gram in more than ``FREQUENT`` documents of any task is counted; the driver gets the most
    frequent ones up to a fixed number.
    """
    schema = pa.schema([("gram", pa.int64()), ("n", pa.int64())])

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts, waiting, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            new = np.sort(np.concatenate([np.zeros(0, np.int64), *waiting]))
            first = np.flatnonzero(np.concatenate([[True], new[1:] != new[:-1]])) if len(new) else np.zeros(0, np.int64)
            number = np.diff(np.concatenate([first, [len(new)]]))
            every, number = np.concatenate([grams, new[first]]), np.concatenate([counts, number])
            order = np.argsort(every, kind="stable")
            every, number = every[order], number[order]
            first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
            return every[first], np.add.reduceat(number, first) if len(first) else number

        for part in parts:
            texts = part.column(0).to_pylist()
            for a, b in slices(texts, SLICE):
                waiting += shingles(texts[a:b], words)
                size += sum(map(len, waiting[a - b :]))
                if size > 1_000_000:  # what was seen once in so many n-grams is let go
                    grams, counts = merged()
                    grams, counts, waiting, size = grams[counts > 1], counts[counts > 1], [], 0
        grams, counts = merged()
        often = counts >= FREQUENT
        yield batch(schema, grams[often], counts[often])

    found = docs.select(text_of("text").alias("text")).mapInArrow(work, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    rows = found.orderBy(F.desc("n"), "gram").limit(MOST_FREQUENT).toArrow()
    return rows.column("gram").combine_chunks().to_numpy(zero_copy_only=False)[::-1].copy()


def prefix_length(n: int, threshold: tuple[int, int] = THRESHOLD) -> int:
    """How many of the first n-grams a set must show so that every similar set shares one."""
    top, bottom = threshold
    return n - (-(-n * top // bottom)) + 1 if n else 0


def _sets(rows: DataFrame, words: int, threshold: tuple[int, int], frequent: np.ndarray | None) -> DataFrame:
    """(id, n, low, digest, grams) of every whole text: the size of its set, a digest, and the set in no special order.

    ``low`` counts its n-grams that are not frequent and whose hash is low; with ``frequent`` the sets are left out.
    """
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("low", pa.int64()), ("digest", pa.binary()), ("grams", pa.list_(pa.int64()))])

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for part in parts:
            texts, ids = part.column(1).to_pylist(), part.column(0)
            for a, b in slices(texts, SLICE):
                sets = shingles(texts[a:b], words)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                low = [0] * len(sets) if frequent is None else [int((~_hot(s[: np.searchsorted(s, LOW)], frequent)).sum()) for s in sets]
                shown = sets if frequent is None else [s[:0] for s in sets]
                sizes = [len(s) for s in shown]
                yield batch(schema, ids.slice(a, b - a), [len(s) for s in sets], low, digests, lists(np.concatenate([np.zeros(0, np.int64), *shown]), sizes, pa.int64()))

    return rows.mapInArrow(work, "id bigint, n bigint, low bigint, digest binary, grams array<bigint>")


def _hot(grams: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Which n-grams are among the sorted frequent ones."""
    if not len(frequent):
        return np.zeros(len(grams), bool)
    at = np.searchsorted(frequent, grams)
    at[at == len(frequent)] = 0
    return frequent[at] == grams


def _shown(rows: DataFrame, words: int, threshold: tuple[int, int], frequent: np.ndarray) -> DataFrame:
    """(gram, slot, id, size): each document under the n-grams of its prefix, and under its others of low hash.

    ``size`` is that of its set. Slot -1 holds an n-gram that isn't known as frequent; frequent ones, which come last in the order
    and are shown in prefixes only, are dealt over slots by id.
    """
    schema = pa.schema([("gram", pa.int64()), ("slot", pa.int32()), ("id", pa.int64()), ("size", pa.int32())])
    ranks = np.argsort(frequent, kind="stable")
    by_gram = frequent[ranks]

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        smallest: dict[bytes, int] = {}
        for part in parts:
            texts, ids = part.column(1).to_pylist(), part.column(0).to_numpy(zero_copy_only=False)
            for a, b in slices(texts, SLICE):
                cold, hot, of, size = [], [], [], []
                for s, doc in zip(shingles(texts[a:b], words), ids[a:b].tolist(), strict=True):
                    digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    if smallest.get(digest, doc) < doc or not len(s):
                        continue
                    smallest[digest] = doc
                    of.append(doc)
                    size.append(len(s))
                    is_hot = _hot(s, by_gram)
                    rare, often = s[~is_hot], s[is_hot]
                    prefix = prefix_length(len(s), threshold)
                    cold.append(rare[: max(min(prefix, len(rare)), int(np.searchsorted(rare, LOW)))])
                    order = np.argsort(ranks[np.searchsorted(by_gram, often)], kind="stable") if len(often) else slice(0)
                    hot.append(often[order][: max(0, prefix - len(rare))])
                at = np.arange(len(of))
                at = np.concatenate([np.repeat(at, [len(s) for s in cold]), np.repeat(at, [len(s) for s in hot])])
                doc, n_cold = np.array(of, np.int64)[at], sum(map(len, cold))
                slots = np.concatenate([np.full(n_cold, -1), (_mix(doc[n_cold:].astype(np.uint64)) % np.uint64(SLOTS)).astype(np.int64)])
                yield batch(schema, np.concatenate([np.zeros(0, np.int64), *cold, *hot]), slots.astype(np.int32), doc, np.array(size, np.int32)[at])

    return rows.filter("id IS NOT NULL").mapInArrow(work, "gram bigint, slot int, id bigint, size int")


def _nearly_among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """All rows whose id is among ``ids``, and few others: a bitmap of hashes goes to the tasks, of 4 MB at most, so the rows stay where they are."""
    hashed = F.pmod(F.xxhash64("id"), F.lit(BITS))
    word, bit = F.shiftright(hashed, 6), F.pmod(hashed, F.lit(64)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    bitmap = ids.groupBy(word.alias("_word")).agg(F.bit_or(one).alias("_bits"))
    marked = rows.withColumn("_word", word).join(F.broadcast(bitmap), "_word")
    return marked.filter(F.col("_bits").bitwiseAND(one) != 0).select(rows.columns)


class _Trie:
    """Sets as paths of n-gram numbers, commonest first; a node holds a run of n-grams without a branch."""

    def __init__(self, paths: list[np.ndarray], sizes: np.ndarray):
        self.paths, self.sizes = paths, sizes
        self.run: list[np.ndarray] = []
        self.child: list[list[int]] = []
        self.ends: list[list[int]] = []
        self.least: list[int] = []  # size of the smallest set at or below a node
        self.most: list[int] = []  # and of the largest
        self.longest: list[int] = []  # n-grams from the node's run on to the deepest end
        order = sorted(range(len(paths)), key=lambda i: paths[i].tolist())
        self.root = self._build(order, 0)

    def _build(self, members: list[int], depth: int) -> int:
        # Nodes are made from an explicit stack, since paths may be long.
        root = self._node(members, depth)
        stack = [(root, members, depth)]
        while stack:
            node, some, start = stack.pop()
            stop = start + len(self.run[node])
            at = 0
            while at < len(some):
                if len(self.paths[some[at]]) == stop:
                    self.ends[node].append(some[at])
                    at += 1
                    continue
                head, end = self.paths[some[at]][stop], at + 1
                while end < len(some) and self.paths[some[end]][stop] == head:
                    end += 1
                made = self._node(some[at:end], stop)
                self.child[node].append(made)
                stack.append((made, some[at:end], stop))
                at = end
        return root

    def _node(self, members: list[int], start: int) -> int:
        a, b = self.paths[members[0]][start:], self.paths[members[-1]][start:]  # first and last in order
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        shared = int(differ[0]) if len(differ) else n
        self.run.append(a[:shared])
        self.child.append([])
        self.ends.append([])
        self.least.append(min(int(self.sizes[i]) for i in members))
        self.most.append(max(int(self.sizes[i]) for i in members))
        self.longest.append(max(len(self.paths[i]) for i in members) - start)
        return len(self.run) - 1

    def similar(self, probes: np.ndarray, width: int, threshold: tuple[int, int]) -> Iterator[tuple[int, int]]:
        """(probe, set) for the sets of the trie that are similar to each probe; n-gram numbers are below ``width``.

        The probes walk down together: a node adds to the overlap of all that are still with it.
        """
        top, bottom = threshold
        n, length = self.sizes[probes], np.array([len(self.paths[p]) for p in probes])
        start = np.cumsum(length) - length
        flat = np.concatenate([self.paths[p] + i * width for i, p in enumerate(probes)])
        has = np.zeros((width, len(probes)), bool)
        has[flat % width, flat // width] = True

        def left(who: np.ndarray, gram: int, side: str) -> np.ndarray:  # n-grams a probe has from this one on, or after it
            return start[who] + length[who] - np.searchsorted(flat, who * width + gram, side=side)

        stack = [(self.root, np.arange(len(probes)), np.zeros(len(probes), np.int64))]
        while stack:
            node, who, overlap = stack.pop()
            size, least, run, longest = n[who], self.least[node], self.run[node], self.longest[node]
            stay = bottom * np.minimum(size, self.most[node]) >= top * np.maximum(size, least)  # sizes near enough
            # overlap / (n + m - overlap) >= top / bottom for the smallest size m that is near enough
            m = np.maximum(least, -(-top * size // bottom))
            need = -(-top * (size + m) // (top + bottom))
            if len(run):
                stay &= overlap + np.minimum(longest, left(who, run[0], "left")) >= need
            who, overlap, need, size = who[stay], overlap[stay], need[stay], size[stay]
            if len(run) and len(who):
                overlap = overlap + has[run[:, None], who].sum(0)
                stay = overlap + np.minimum(longest - len(run), left(who, run[-1], "right")) >= need
                who, overlap, size = who[stay], overlap[stay], size[stay]
            if not len(who):
                continue
            for i in self.ends[node]:
                for w in who[bottom * overlap >= top * (size + self.sizes[i] - overlap)].tolist():
                    yield int(probes[w]), i
            stack.extend((c, who, overlap) for c in self.child[node])


def linked(sets: list[np.ndarray], groups: list | None = None, threshold: tuple[int, int] = THRESHOLD) -> list[tuple[int, int]]:
    """Links that connect all similar sets of a block (a spanning forest of them).

    ``groups`` tells which sets are connected already.
    """
    every, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Commonest first, so that similar sets share long paths; n-grams of one set alone add to its size only.
    number = np.empty(len(every), np.int64)
    number[np.argsort(-counts, kind="stable")] = np.arange(len(every))
    shared = int((counts > 1).sum())
    sizes = np.array([len(s) for s in sets])
    paths = []
    for numbers in np.split(number[inverse.ravel()], np.cumsum(sizes)[:-1]):
        paths.append(np.sort(numbers[numbers < shared]))
    trie = _Trie(paths, sizes)
    parent = list(range(len(sets)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first: dict = {}
    for i, g in enumerate(groups or []):
        parent[find(i)] = find(first.setdefault(g, i))
    out, width = [], max(1, shared)
    step = max(1, TOGETHER // width)  # so that long texts do not fill the memory
    for first_probe in range(0, len(sets), step):
        for probe, other in trie.similar(np.arange(first_probe, min(first_probe + step, len(sets))), width, threshold):
            a, b = find(probe), find(other)
            if a != b:
                parent[a] = b
                out.append((probe, other))
    return out


def _runs(rows: DataFrame, by: list[str], threshold: tuple[int, int]) -> DataFrame:
    """Adds ``run``, a number by size (``least`` to ``most``) within ``by``: ids of different runs can't be similar."""
    top, bottom = threshold
    order = Window.partitionBy(*by).orderBy("least", "id")
    before, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    cut = F.col("least") * top > F.max("most").over(before) * bottom
    return rows.withColumn("run", F.coalesce(cut, F.lit(False)).cast("int")).withColumn("run", F.sum("run").over(upto))


def _join_blocks(blocks: DataFrame, sets: DataFrame, by: list[str], threshold: tuple[int, int]) -> DataFrame:
    """Links (a, b) within each block: ``blocks`` has the columns ``by``, id and comp; ``sets`` has id and grams."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def work(part: pa.Table) -> pa.Table:
        ids, comps = part.column("id").to_pylist(), part.column("comp").to_pylist()
        if len(set(comps)) < 2:
            return pa.Table.from_batches([], schema)
        grams = part.column("grams").combine_chunks()
        flat, cut = grams.values.to_numpy(), grams.offsets.to_numpy()
        found = linked([flat[a:b] for a, b in zip(cut, cut[1:], strict=False)], comps, threshold)
        return pa.Table.from_batches([batch(schema, [ids[i] for i, _ in found], [ids[j] for _, j in found])])

    return blocks.join(sets, "id").groupBy(*by).applyInArrow(work, "a bigint, b bigint")


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(id, comp): the smallest id that links (a, b) reach, for every id in a link, by alternating stars."""
    both = lambda e: e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = checkpointed(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(most_rounds):
        near = both(edges)
        least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Large star: larger neighbours of a node hang on its least one; small star: so do the smaller ones and itself.
        large = near.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.filter("a <> b").distinct()
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = checkpointed(small.select("e.a", "e.b").filter("a <> b").distinct())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("comp")).unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("comp")).distinct())


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, threshold: tuple[int, int] = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """For every row: ``key``, ``n_shingles`` and ``component_id``, the smallest key that links reach, itself included.

    Two documents link when ``bottom * shared >= top * union`` for the threshold (top, bottom). Null
    and empty texts have no n-grams and link with nothing; texts of fewer words have one. Rows that
    repeat a key are one document; keys are integers, and rows with a null key come back alone with
    no component. Other columns are not read; an empty table gives none.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), text_of(text).alias("text"))
    frequent = _frequent(rows, words)
    sets = written(_sets(rows, words, threshold, np.sort(frequent)).select("id", "n", "low", "digest"), "sets")
    reps = sets.filter("n > 0 AND id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("low").alias("low"))
    reps = written(reps, "set-classes")

    # A set that a similar one exists for lacks at most n - ceil(t n) of its n-grams there; those of low hash that no
    # other document has are among the lacking ones. Sets with more of them go, with most chance meetings.
    here = Window.partitionBy("gram", "slot")
    met = _shown(rows, words, threshold, frequent).withColumn("n", F.count(F.lit(1)).over(here)).filter("n > 1 OR slot >= 0")
    met = written(met.select("gram", "slot", "id", "size"), "shared-grams")
    shared = met.filter(f"slot < 0 AND gram < {LOW}").groupBy("id").agg(F.count(F.lit(1)).alias("shared"))
    top, bottom = threshold
    may = reps.join(shared, F.col("rep") == F.col("id"), "left").filter(F.expr(f"low - coalesce(shared, 0) <= n - (n * {top} + {bottom - 1}) DIV {bottom}"))
    may = written(may.select(F.col("rep").alias("id"), F.col("n").alias("size")), "open-sets")
    sized = _nearly_among(met, may).select("gram", "slot", "id", F.col("size").alias("least"), F.col("size").alias("most"))
    open_met = _runs(sized, ["gram", "slot"], threshold)
    here = Window.partitionBy("gram", "slot", "run")
    open_met = open_met.withColumn("pivot", F.min("id").over(here)).withColumn("n", F.count(F.lit(1)).over(here)).filter("n > 1 OR slot >= 0")
    open_met = written(open_met.drop("n", "run"), "open-shared-grams")
    dropped(met)
    met = open_met

    # Every document with the smallest id of its run; runs in the slots of one n-gram meet at their smallest.
    of_slots = met.filter("slot >= 0").groupBy("gram", F.col("pivot").alias("id")).agg(F.min("least").alias("least"), F.max("most").alias("most"))
    of_slots = _runs(of_slots, ["gram"], threshold).withColumn("pivot", F.min("id").over(Window.partitionBy("gram", "run")))
    of_slots = written(of_slots.select("gram", "id", "pivot"), "slot-pivots")
    pairs = met.select("pivot", "id").unionByName(of_slots.select("pivot", "id")).filter("pivot <> id").distinct()
    per_pivot = F.ceil(F.count(F.lit(1)) / (block - 1)).cast("int").alias("parts")
    whole_pairs = written(pairs, "pairs")
    sizes = whole_pairs.groupBy("pivot").agg(per_pivot)
    pairs = written(whole_pairs.join(sizes, "pivot").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))), "parted-pairs")
    dropped(whole_pairs)
    active = pairs.select("id").unionByName(pairs.select(F.col("pivot").alias("id"))).distinct()
    whole = written(_sets(_nearly_among(rows, active), words, threshold, None).select("id", "grams"), "active-sets")
    blocks = pairs.select("pivot", "part", "id").unionByName(pairs.select("pivot", "part", F.col("pivot").alias("id")).distinct())
    links = written(_join_blocks(blocks.withColumn("comp", F.col("id")), whole, ["pivot", "part"], threshold), "links")
    comps = written(components(links), "components")

    # What no single block has held: runs in slots, or of a pivot with several blocks, in more than one component.
    split = pairs.filter("parts > 1").select("pivot").distinct()
    in_slots = met.filter("slot >= 0").select("gram", F.col("pivot").alias("slot_pivot"), "id")
    in_slots = in_slots.join(of_slots.withColumnRenamed("id", "slot_pivot"), ["gram", "slot_pivot"]).select("gram", "pivot", "id")
    open_ = in_slots.unionByName(met.filter("slot < 0").join(split, "pivot", "left_semi").select("gram", "pivot", "id"))
    open_ = open_.join(comps, "id", "left").select("gram", "pivot", "id", F.coalesce("comp", "id").alias("comp"))
    open_ = written(open_, "open-grams")
    dropped(met, pairs, of_slots)
    # A run's largest component is compared with the other documents there; runs with the same others are one group.
    parts = open_.groupBy("gram", "pivot", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("sign"))
    size = F.struct("n", "comp")
    parts = parts.groupBy("gram", "pivot").agg(
        F.max_by("comp", size).alias("main"), (F.sum("n") - F.max("n")).alias("n_out"), (F.sum("sign") - F.max_by("sign", size)).alias("sign")
    ).filter("n_out > 0")
    group = ["main", "n_out", "sign"]
    members = written(open_.join(parts, ["gram", "pivot"]).select(*group, "id", "comp").distinct().join(may, "id"), "open-groups")
    dropped(open_, may)
    is_main, half = F.col("comp") == F.col("main"), block // 2
    n_blocks = lambda side: F.least(F.ceil(F.count_if(side) / half), F.ceil(F.sum(F.when(side, F.col("size"))) / GRAMS)).cast("int")
    left = members.join(members.groupBy(*group).agg(n_blocks(is_main).alias("k_main"), n_blocks(~is_main).alias("k_out")), group)
    at = F.pmod(F.xxhash64("id"), F.when(is_main, F.col("k_main")).otherwise(F.col("k_out"))).cast("int")
    up_to = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    cells = F.when(is_main, F.transform(up_to("k_out"), lambda t: F.struct(F.lit("main").alias("kind"), F.col("at").alias("i"), t.alias("j")))).otherwise(F.concat(
        F.transform(up_to("k_main"), lambda m: F.struct(F.lit("main").alias("kind"), m.alias("i"), F.col("at").alias("j"))),
        F.transform(up_to("k_out"), lambda t: F.struct(F.lit("rest").alias("kind"), F.least(t, "at").alias("i"), F.greatest(t, "at").alias("j"))),
    ))
    left = left.withColumn("at", at).select(*group, "id", "comp", F.explode(cells).alias("c")).select(*group, "c.kind", "c.i", "c.j", "id", "comp")
    more = written(_join_blocks(left, whole, [*group, "kind", "i", "j"], threshold), "links")
    dropped(members, whole)
    if not more.isEmpty():
        dropped(comps)
        comps = written(components(links.unionByName(more)), "components")
    dropped(links, more)

    of_class = reps.join(comps, F.col("rep") == F.col("id"), "left").select("digest", F.coalesce("comp", "rep").alias("comp"))
    return sets.alias("s").join(of_class.alias("c"), (F.col("s.digest") == F.col("c.digest")) & (F.col("s.n") > 0) & F.col("s.id").isNotNull(), "left").select(
        F.col("s.id").alias(key), F.col("s.n").alias("n_shingles"), F.coalesce("c.comp", "s.id").alias("component_id")
    )
