"""The prefix trie of conversations by the Euler-tour technique.

A node is a distinct sequence of first turns; its name is the smallest conversation that starts with it, and
its depth. Each node gives an arc that enters it and one that leaves it, each linked to the arc that follows in
the tour. The list of arcs is ranked distributedly: blocks of neighbouring nodes shorten the pieces of the
list that lie in them, and what remains is halved again and again by merging every other pair of pieces that
a coin picks, until it fits one block. The prefix sums of leaves and of saved words at the two arcs of a node
then differ by what its subtree holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import batch
from tabloom.plans.runs import numbered
from tabloom.plans.storage import written

#: Turns of one conversation that a window may hold at once; longer ones are cut.
CHUNK = 4096
#: Nodes that a block of the first shortening holds, and pieces of the list that one task may rank.
BLOCK, LAST = 65_536, 262_144
EMPTY = hashlib.sha256(b"").hexdigest()
#: White space between words, fixed by the contract of the counts.
WORD = r"[^\x20\x09-\x0D]+"


def ordered_turns(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv``, ``pos`` (from 1), ``digest`` of role and text, and ``words``.

    Turns go by ``turn`` (null first), then by role and the digest of the text. A null role or text is empty,
    rows without a conversation are left out, and repeated rows are turns like any other.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    whole = F.concat(F.length(said(role)).cast("string"), F.lit(":"), said(role), said(text)).cast("binary")
    rows = conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), said(role).alias("role"),
        F.unhex(F.sha2(whole, 256)).alias("digest"), F.regexp_count(said(text), F.lit(WORD)).cast("long").alias("words"),
    )
    return numbered(rows, ["conv"], [F.asc_nulls_first("turn"), "role", "digest"], "pos").select("conv", "pos", "digest", "words")


def share_heads(turns: DataFrame, base: Column, taken: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """The turns with the first ``taken`` (at most ``most``) of each conversation put in place by those of ``base``.

    Returns the turns and every conversation, those left without a turn too. Both columns may use ``conv`` only.
    A conversation meets its base once for every ``CHUNK`` of its turns, so a long one is not held together.
    """
    heads = turns.filter(F.col("pos") <= most).groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "words"))).alias("head"))
    marks = turns.filter((F.col("pos") - 1) % CHUNK == 0).select("conv", F.expr(f"(pos - 1) div {CHUNK}").alias("chunk"), base.alias("_base"), taken.alias("taken"))
    head = F.slice(F.coalesce("head", F.array()), F.lit(1), F.col("taken").cast("int"))
    marks = marks.join(heads.withColumnRenamed("conv", "_base"), "_base", "left").select("conv", "chunk", "taken", head.alias("head"))
    first = marks.filter("chunk = 0")
    given = first.select("conv", F.explode("head").alias("h")).select("conv", "h.pos", "h.digest", "h.words")
    own = turns.withColumn("chunk", F.expr(f"(pos - 1) div {CHUNK}")).join(marks, ["conv", "chunk"]).filter("pos > taken")
    own = own.select("conv", (F.col("pos") - F.col("taken") + F.size("head")).alias("pos"), "digest", "words")
    return given.unionByName(own), first.select("conv")


def _prefixes(turns: DataFrame) -> DataFrame:
    """For every turn the 128-bit names (a, b) of the prefix that ends in it and (pa, pb) of the one before, and ``last``.

    A name is the exclusive or of keyed hashes of (place, SHA-256 of the turn), so it sums over chunks.
    """
    cut = turns.withColumn("chunk", F.expr(f"(pos - 1) div {CHUNK}")).select(
        "conv", "chunk", "pos", "words", F.xxhash64("digest", "pos").alias("f"), F.xxhash64("pos", "digest").alias("g")
    )
    inside = Window.partitionBy("conv", "chunk").orderBy("pos")
    whole = inside.rowsBetween(Window.unboundedPreceding, 0)
    cut = cut.select("*", F.bit_xor("f").over(whole).alias("a"), F.bit_xor("g").over(whole).alias("b"), F.lead("pos").over(inside).isNull().alias("ends"))
    ends = cut.filter("ends").select("conv", "chunk", "a", "b")
    chunks = Window.partitionBy("conv").orderBy("chunk")
    before = chunks.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(
        "conv", "chunk", F.bit_xor("a").over(before).alias("xa"), F.bit_xor("b").over(before).alias("xb"), F.lead("chunk").over(chunks).isNull().alias("last")
    ).filter("chunk > 0 or not last")
    out = cut.join(ends, ["conv", "chunk"], "left")
    a, b = (F.col(c).bitwiseXOR(F.coalesce(F.col(f"x{c}"), F.lit(0))) for c in "ab")
    return out.select(
        "conv", "pos", "words", a.alias("a"), b.alias("b"), a.bitwiseXOR(F.col("f")).alias("pa"), b.bitwiseXOR(F.col("g")).alias("pb"),
        (F.col("ends") & F.coalesce("last", F.lit(True))).alias("last"),
    )


_FAMILY = pa.schema([
    ("kind", pa.int32()), ("conv", pa.int64()), ("depth", pa.int64()), ("next", pa.int64()), ("parent", pa.int64()), ("n", pa.int64()), ("w", pa.int64()),
    ("children", pa.int64()), ("ends", pa.string()), ("sha", pa.string()), ("task", pa.int32()), ("seq", pa.int64()), ("open", pa.bool_()),
])
_FAMILY_SQL = "kind int, conv long, depth long, next long, parent long, n long, w long, children long, ends string, sha string, task int, seq long, open boolean"
NODE, CHILD, PART, EDGE = 0, 1, 2, 3


def _families(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come as a node, then its children, then the conversations that end in it, each by conversation.

    Gives NODE rows (first child in ``next``), CHILD rows (next sibling in ``next``, ``parent``), PART rows with
    children and ended conversations of a node that the batch cuts, and an EDGE row: the first row and last
    node of the task. ``open`` marks a last row, whose ``next`` is not known; what lies before the task is null.
    """
    task, seq = TaskContext.get().partitionId(), 0
    node: tuple[int, int] | None = None  # the node that the rows belong to
    started, first = False, (None, None)
    late = None  # the last row of the batch before, waiting for its follower

    def family(rows: np.ndarray, follower) -> pa.RecordBatch:
        """``rows``: kind, conv, depth, n, w in columns; ``follower`` is (kind, conv) of the row behind, None if unknown."""
        nonlocal node, seq
        kind, conv, depth, n, w = rows
        size = len(kind)
        after_kind, after_conv = np.append(kind[1:], follower[0] if follower else EDGE), np.append(conv[1:], follower[1] if follower else 0)
        at = np.arange(size)
        own = np.maximum.accumulate(np.where(kind == NODE, at, -1))
        inside = own >= 0
        known = inside | (node is not None)
        holder, holder_depth = node or (0, 0)
        of = np.where(inside, conv[np.maximum(own, 0)], holder)
        of_depth = np.where(inside, depth[np.maximum(own, 0)], holder_depth)
        bounds = np.flatnonzero(kind == NODE)
        segments = np.concatenate([[0], bounds]) if not len(bounds) or bounds[0] else bounds
        ends = np.append(segments[1:], size)
        children = np.add.reduceat((kind == CHILD).astype(np.int64), segments)
        over = kind == 2
        texts = {}
        for s in np.flatnonzero(np.add.reduceat(over.astype(np.int64), segments)):
            chosen = conv[segments[s] : ends[s]][over[segments[s] : ends[s]]]
            texts[int(s)] = ",".join(map(str, chosen.tolist()))
        closed = np.array([kind[s] == NODE for s in segments]) & np.append(np.ones(len(segments) - 1, bool), follower is not None and follower[0] == NODE)
        out: list[tuple] = []
        columns = {f.name: [] for f in _FAMILY}
        for s in np.flatnonzero(~closed):
            if children[s] or s in texts:
                i = segments[s]
                name = (int(of[i]), int(of_depth[i])) if known[i] else (None, None)
                out.append((PART, *name, int(children[s]), texts.get(s)))
        # whole rows: nodes and children
        keep = kind <= CHILD
        lead = (after_kind == CHILD) & keep
        unknown = (at == size - 1) & (follower is None) & keep
        count = np.zeros(size, np.int64)
        sha = np.full(size, None, object)
        for s in np.flatnonzero(closed):
            count[segments[s]] = children[s]
            sha[segments[s]] = hashlib.sha256(texts[s].encode()).hexdigest() if s in texts else EMPTY
        is_child = keep & (kind == CHILD)
        columns["kind"] = [*kind[keep], *(PART for _ in out)]
        columns["conv"] = [*conv[keep].tolist(), *(o[1] for o in out)]
        columns["depth"] = [*(depth + is_child)[keep].tolist(), *(o[2] for o in out)]
        columns["next"] = [*np.where(lead, after_conv, None)[keep], *(None for _ in out)]
        columns["parent"] = [*np.where(is_child & known, of, None)[keep], *(None for _ in out)]
        columns["n"] = [*np.where(kind == NODE, n, None)[keep], *(None for _ in out)]
        columns["w"] = [*np.where(kind == NODE, w, None)[keep], *(None for _ in out)]
        columns["children"] = [*count[keep].tolist(), *(o[3] for o in out)]
        columns["ends"] = [*(None for _ in range(int(keep.sum()))), *(o[4] for o in out)]
        columns["sha"] = [*sha[keep], *(None for _ in out)]
        columns["task"] = [task] * (int(keep.sum()) + len(out))
        columns["seq"] = list(range(seq, seq + int(keep.sum()) + len(out)))
        columns["open"] = [*unknown[keep].tolist(), *(False for _ in out)]
        seq += int(keep.sum()) + len(out)
        if len(bounds):
            node = (int(conv[bounds[-1]]), int(depth[bounds[-1]]))
        return batch(_FAMILY, *(columns[f.name] for f in _FAMILY))

    for part in parts:
        if not part.num_rows:
            continue
        rows = np.stack([part.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)])
        if not started:
            started, first = True, (int(rows[0, 0]), int(rows[1, 0]))
        rows = rows if late is None else np.concatenate([late, rows], axis=1)
        rows, late = rows[:, :-1], rows[:, -1:]
        if rows.shape[1]:
            yield family(rows, (int(late[0, 0]), int(late[1, 0])))
    if late is not None:
        yield family(late, None)
        end = node or (None, None)
        yield batch(_FAMILY, [EDGE], [end[0]], [end[1]], [first[1]], [None], [first[0]], [None], [None], [None], [None], [task], [seq], [False])


def _ended(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the texts of each (conv, depth), whose rows come in order; one text is in memory at a time."""
    schema = pa.schema([("conv", pa.int64()), ("depth", pa.int64()), ("sha", pa.string())])
    node, state = None, None
    for part in parts:
        done = []
        for conv, depth, text in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
            if (conv, depth) != node:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (conv, depth), hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if done:
            yield batch(schema, *map(list, zip(*done, strict=True)))
    if node is not None:
        yield batch(schema, [node[0]], [node[1]], [state.hexdigest()])


def family_links(occurrences: DataFrame, convs: DataFrame) -> DataFrame:
    """Every node with its parent, first child, next sibling, members, children, and digest of the conversations ending there."""
    nodes = occurrences.groupBy("pos", "a", "b").agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"), F.first("words").alias("words"), F.first("pa").alias("pa"), F.first("pb").alias("pb")
    )
    root = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n")).filter("n > 0").select(
        F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), "conv", "n", F.lit(0).cast("long").alias("words"),
        F.lit(None).cast("long").alias("pa"), F.lit(None).cast("long").alias("pb"),
    )
    nodes = written(nodes.unionByName(root), "trie-nodes")
    none = F.lit(0).cast("long")
    silent = convs.join(occurrences.filter("pos = 1").select("conv"), "conv", "left_anti")
    row = lambda a, b, depth, kind, n=none, w=none: [F.col(a).alias("a"), F.col(b).alias("b"), (F.col("pos") + depth).alias("depth"), F.lit(kind).alias("kind"), "conv", n.alias("n"), w.alias("w")]
    rows = (
        nodes.select(*row("a", "b", 0, NODE, F.col("n"), (F.col("n") - 1) * F.col("words")))
        .unionByName(nodes.filter("pos > 0").select(*row("pa", "pb", -1, CHILD)))
        .unionByName(occurrences.filter("last").select(*row("a", "b", 0, 2)))
        .unionByName(silent.select(none.alias("a"), none.alias("b"), none.alias("pos"), "conv").select(*row("a", "b", 0, 2)))
    )
    sorted_rows = rows.orderBy("a", "b", "depth", "kind", "conv").select("kind", "conv", "depth", "n", "w")
    found = written(sorted_rows.mapInArrow(_families, _FAMILY_SQL), "trie-families")

    # One row a task tells the others what lies before and behind.
    every = Window.orderBy("task")
    before = every.rowsBetween(Window.unboundedPreceding, -1)
    edges = found.filter(F.col("kind") == EDGE).select(
        "task", F.last("conv", True).over(before).alias("held_conv"), F.last("depth", True).over(before).alias("held_depth"),
        F.lead(F.when(F.col("n") == CHILD, F.col("next"))).over(every).alias("behind"),
    )
    found = found.filter(F.col("kind") != EDGE).join(F.broadcast(edges), "task")  # a row a task
    child, part = F.col("kind") == CHILD, F.col("kind") == PART
    own = lambda c: F.when(part, F.coalesce(F.col(c), F.col(f"held_{c}"))).otherwise(F.col(c)).alias(c)
    found = found.select(
        "kind", own("conv"), own("depth"), F.when(F.col("open"), F.col("behind")).otherwise(F.col("next")).alias("next"),
        F.when(child, F.coalesce("parent", "held_conv")).alias("parent"), "n", "w", "children", "ends", "sha", "task", "seq",
    )
    ended = found.filter("ends is not null").select("conv", "depth", "ends", "task", "seq").repartition("conv", "depth").sortWithinPartitions("conv", "depth", "task", "seq")
    ended = ended.select("conv", "depth", "ends").mapInArrow(_ended, "conv long, depth long, sha string")
    ended = ended.select("conv", "depth", F.lit(PART).alias("kind"), *(F.lit(None).cast("long").alias(c) for c in ("next", "parent", "n", "w")), none.alias("children"), "sha")
    links = found.select("conv", "depth", "kind", "next", "parent", "n", "w", "children", "sha").unionByName(ended)
    # Neighbours by name lie together; a grouping by the same columns moves nothing again.
    is_node = F.col("kind") == NODE
    return links.repartitionByRange("conv", "depth").groupBy("conv", "depth").agg(
        F.max("parent").alias("parent"), F.max(F.when(is_node, F.col("next"))).alias("child"), F.max(F.when(F.col("kind") == CHILD, F.col("next"))).alias("sibling"),
        F.max("n").alias("n"), F.max("w").alias("w"), F.sum("children").alias("children"), F.coalesce(F.max("sha"), F.lit(EMPTY)).alias("sha"),
    )


def chase(before: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every item of lists given by predecessors (-1 at heads): its head, and the weights of all items before it."""
    at = np.arange(len(before))
    head = np.where(before < 0, at, before)
    sums = np.where((before >= 0)[:, None], weights[head], 0)
    while np.any(before[head] >= 0):
        sums = sums + np.where((head != at)[:, None], sums[head], 0)
        head = head[head]
    return head, sums


_SIDES = ("in", "out")
_WEIGHTS = ("rank", "leaves", "saved")
_KEPT = ("conv", "depth", "parent", "n", "children", "sha")


def _shorten(block: int):
    """Blocks of neighbouring nodes: every arc gets the head of its piece of the tour and the sums since then."""
    names = [f"{s}_{c}" for s in _SIDES for c in ("head_conv", "head_at", *_WEIGHTS, "is_head", "next_conv", "next_at", *(f"whole_{w}" for w in _WEIGHTS))]
    schema = pa.schema([*((c, pa.string() if c == "sha" else pa.int64()) for c in _KEPT), *((n, pa.bool_() if n.endswith("is_head") else pa.int64()) for n in names)])

    def shortened(table: pa.Table) -> pa.RecordBatch:
        size = table.num_rows
        number = {c: table[c].fill_null(0).to_numpy() for c in ("conv", "depth", "parent", "child", "sibling", "w")}
        conv, depth = number["conv"], number["depth"]
        has = {c: table[c].is_valid().to_numpy() for c in ("parent", "child", "sibling")}
        # The nodes of one conversation are consecutive depths, so a search for the first of them finds each.
        starts = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))

        def place(c: np.ndarray, d: np.ndarray) -> np.ndarray:
            first = starts[np.minimum(np.searchsorted(conv[starts], c), len(starts) - 1)]
            at = first + d - depth[first]
            fits = (at >= 0) & (at < size)
            at = np.where(fits, at, 0)
            return np.where(fits & (conv[at] == c) & (depth[at] == d), at, -1)

        own = np.arange(size)
        # Arc i enters node i, arc size + i leaves it. A node (c, d) has arcs (c, 2d) and (c, 2d + 1).
        to_conv = np.concatenate([np.where(has["child"], number["child"], conv), np.where(has["sibling"], number["sibling"], number["parent"])])
        to_depth = np.concatenate([depth + has["child"], np.where(has["sibling"], depth, depth - 1)])
        leaving = np.concatenate([~has["child"], ~has["sibling"]])
        exists = np.concatenate([np.ones(size, bool), has["sibling"] | has["parent"]])
        inside = place(to_conv, to_depth)
        inside[:size] = np.where(has["child"], inside[:size], own)
        following = np.where(exists & (inside >= 0), inside + size * leaving, -1)
        before = np.full(2 * size, -1)
        linked = np.flatnonzero(following >= 0)
        before[following[linked]] = linked
        weights = np.zeros((2 * size, 3), np.int64)
        weights[:, 0] = 1
        weights[:size, 1], weights[:size, 2] = ~has["child"], number["w"]
        head, sums = chase(before, weights)
        whole = np.zeros((2 * size, 3), np.int64)
        follow_conv, follow_at = np.zeros(2 * size, np.int64), np.zeros(2 * size, np.int64)
        tails = np.flatnonzero(following < 0)
        whole[head[tails]] = sums[tails] + weights[tails]
        open_end = np.ones(2 * size, bool)
        follow_conv[head[tails]], follow_at[head[tails]] = to_conv[tails], (2 * to_depth + leaving)[tails]
        open_end[head[tails]] = exists[tails]
        name_conv, name_at = np.concatenate([conv, conv]), np.concatenate([2 * depth, 2 * depth + 1])
        columns = [table[c].combine_chunks() for c in _KEPT]
        for side in (slice(0, size), slice(size, 2 * size)):
            is_head = before[side] < 0
            last = ~(is_head & open_end[side])
            columns += [name_conv[head[side]], name_at[head[side]], *sums[side].T, is_head]
            columns += [pa.array(follow_conv[side], mask=last), pa.array(follow_at[side], mask=last), *whole[side].T]
        return batch(schema, *columns)

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for part in parts:
            while part.num_rows:
                piece = part.slice(0, block - rows)
                held.append(piece)
                rows += piece.num_rows
                part = part.slice(piece.num_rows)
                if rows == block:
                    yield shortened(pa.Table.from_batches(held))
                    held, rows = [], 0
        if rows:
            yield shortened(pa.Table.from_batches(held))

    sql = ", ".join(f"{f.name} {'string' if pa.types.is_string(f.type) else 'boolean' if pa.types.is_boolean(f.type) else 'long'}" for f in schema)
    return work, sql


def _rank_last(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rank the remaining pieces, which fit one task by the bound of ``LAST``."""
    pieces = [p for p in parts if p.num_rows]
    if not pieces:
        return
    table = pa.Table.from_batches(pieces)
    conv, at = table["conv"].to_numpy(), table["at"].to_numpy()
    order = np.lexsort((at, conv))
    keys = np.array(list(zip(conv[order], at[order], strict=True)), dtype=[("c", np.int64), ("a", np.int64)])
    there = np.flatnonzero(table["next_conv"].is_valid().to_numpy())
    wanted = np.array(list(zip(table["next_conv"].fill_null(0).to_numpy()[there], table["next_at"].fill_null(0).to_numpy()[there], strict=True)), dtype=keys.dtype)
    before = np.full(table.num_rows, -1)
    before[order[np.searchsorted(keys, wanted)]] = there
    _, sums = chase(before, np.stack([table[w].to_numpy() for w in _WEIGHTS], axis=1))
    schema = pa.schema([(c, pa.int64()) for c in ("conv", "at", *_WEIGHTS)])
    yield batch(schema, conv, at, *sums.T)


def rank_pieces(pieces: DataFrame, last: int = LAST) -> DataFrame:
    """``conv``, ``at`` and the sums before every piece of one linked list of ``conv, at, next_conv, next_at, rank, leaves, saved``.

    While more than ``last`` remain, a coin for each name and round merges a piece that shows heads with the
    one before it that shows tails: about a quarter goes each round. Merged pieces are placed again in
    reverse order. Every round is a stored table.
    """
    rounds = []
    while pieces.count() > last:
        coin = lambda c, a, r=len(rounds): F.when(F.col(c).isNotNull(), F.xxhash64(F.col(c), F.col(a), F.lit(r)).bitwiseAND(F.lit(1))).otherwise(0)
        pieces = pieces.withColumn("_own", coin("conv", "at")).withColumn("_next", coin("next_conv", "next_at"))
        takers, stay = pieces.filter("_own = 0 and _next = 1"), pieces.filter("_own = 0 and _next = 0")
        takers = takers.select(F.col("conv").alias("t_conv"), F.col("at").alias("t_at"), F.col("next_conv").alias("conv"), F.col("next_at").alias("at"), *(F.col(w).alias(f"t_{w}") for w in _WEIGHTS))
        met = written(pieces.filter("_own = 1").drop("_own", "_next").join(takers, ["conv", "at"], "left"), "trie-round")
        merged = met.select(
            F.coalesce("t_conv", "conv").alias("conv"), F.coalesce("t_at", "at").alias("at"), "next_conv", "next_at",
            *((F.col(w) + F.coalesce(F.col(f"t_{w}"), F.lit(0))).alias(w) for w in _WEIGHTS),
        )
        rounds.append(met.filter("t_conv is not null").select("conv", "at", "t_conv", "t_at", *(f"t_{w}" for w in _WEIGHTS)))
        pieces = written(merged.unionByName(stay.select(*merged.columns)), "trie-round")
    kinds = ", ".join(f"{c} long" for c in ("conv", "at", *_WEIGHTS))
    placed = pieces.select("conv", "at", "next_conv", "next_at", *_WEIGHTS).coalesce(1).mapInArrow(_rank_last, kinds)  # at most ``last`` rows
    for gone in reversed(rounds):
        base = placed.select(F.col("conv").alias("t_conv"), F.col("at").alias("t_at"), *_WEIGHTS)
        back = gone.join(base, ["t_conv", "t_at"]).select("conv", "at", *((F.col(w) + F.col(f"t_{w}")).alias(w) for w in _WEIGHTS))
        placed = written(placed.unionByName(back), "trie-placed")
    return placed


def prefix_trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK, last: int = LAST) -> DataFrame:
    """One row for every node of the trie of ``turns`` (``conv, pos`` from 1 without gaps, ``digest, words``).

    ``conv`` and ``depth`` name the node (``conv`` is its smallest member), ``parent`` is the parent's ``conv``, null
    at the root; ``n`` members, ``children``, ``leaves`` and ``saved`` of the subtree, the node included, ``sha`` of
    the conversations that end there, and the places ``enter`` and ``leave`` of its arcs in the tour. ``convs``
    has every conversation, those without turns too. Without conversations there is no node.
    """
    occurrences = written(_prefixes(turns), "trie-prefixes")
    nodes = family_links(occurrences, convs).sortWithinPartitions("conv", "depth")
    work, kinds = _shorten(block)
    arcs = written(nodes.mapInArrow(work, kinds), "trie-arcs")
    heads = [
        arcs.filter(f"{s}_is_head").select(
            F.col("conv"), (2 * F.col("depth") + i).alias("at"), F.col(f"{s}_next_conv").alias("next_conv"), F.col(f"{s}_next_at").alias("next_at"),
            *(F.col(f"{s}_whole_{w}").alias(w) for w in _WEIGHTS),
        )
        for i, s in enumerate(_SIDES)
    ]
    placed = rank_pieces(written(heads[0].unionByName(heads[1]), "trie-pieces"), last)
    for s in _SIDES:
        starts = placed.select(F.col("conv").alias(f"{s}_head_conv"), F.col("at").alias(f"{s}_head_at"), *(F.col(w).alias(f"{s}_start_{w}") for w in _WEIGHTS))
        arcs = arcs.join(starts, [f"{s}_head_conv", f"{s}_head_at"])
    at = lambda s, w: F.col(f"{s}_start_{w}") + F.col(f"{s}_{w}")
    return arcs.select(
        *_KEPT, (at("out", "leaves") - at("in", "leaves")).alias("leaves"), (at("out", "saved") - at("in", "saved")).alias("saved"),
        at("in", "rank").alias("enter"), at("out", "rank").alias("leave"),
    )
