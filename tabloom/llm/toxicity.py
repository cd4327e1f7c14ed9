"""Toxicity from a learned lexicon, matched with misspellings, and the windows around the matches.

The lexicon's stems lie in a trie. An automaton of one edit (a letter changed, dropped or added, or two
neighbours swapped) runs over the trie: a state is the set of (node, edit, letter due) that a word's
beginning can reach, and each state's moves are worked out once, so a word costs one lookup a letter.
A wrong beginning counts in whole words, or with long stems. Logistic weights over the counts of matches (exact or
misspelt, in quotation or not), their log odds and closeness give the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.bpe import _arrow
from tabloom.llm.common import batch, text_of
from tabloom.plans.storage import written

#: Labelled rows to learn from, at most; stems in the lexicon, at most.
SAMPLE, MOST_STEMS = 20_000, 5_000
LEAST_STEM, FUZZY_FROM, LEAST_ODDS = 4, 5, 2.5
#: Shorter terms, from here on, count as whole words. Stems so long may go on after an edit of the first letter.
LEAST_WORD, ROOT_FROM = 2, 7
#: Gain in nats that a stem needs; among a million beginnings chance hardly reaches it.
LEAST_GAIN = 15
WINDOW = 20
_WORD = re.compile(r"\w+")
_PAIRS = {"«": "»", "“": "”", "„": "“", "‹": "›"}
_SAYS = frozenset("said says called calls quote quoted quotes wrote writes term word phrase slur insult".split())


class Matcher:
    """The automaton over the trie of (stem, misspellings allowed)."""

    def __init__(self, stems: dict[str, bool], rooted: frozenset[str] | None = None):
        """``rooted`` are the stems whose first letter may be wrong, too; all that allow misspellings if not given."""
        self.child: list[dict[str, int]] = [{}]
        self.stem: list[str | None] = [None]
        for stem in sorted(stems):
            at = 0
            for c in stem:
                if c not in self.child[at]:
                    self.child[at][c] = len(self.child)
                    self.child.append({})
                    self.stem.append(None)
                at = self.child[at][c]
            self.stem[at] = stem
        self.fuzzy = stems
        self.rooted = frozenset(s for s, allowed in stems.items() if allowed) if rooted is None else rooted
        self.states: list[frozenset[tuple[int, int, str]]] = []
        self.numbers: dict[frozenset[tuple[int, int, str]], int] = {}
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[int, str] | None] = []
        self.whole: list[tuple[int, str] | None] = []
        self.start = self._state({(0, 0, "")})

    def _state(self, some: set[tuple[int, int, str]]) -> int:
        """The number of a state of (node, edit, letter due); edits are 1 inside the stem and 2 at its first letter."""
        grown = set(some)
        for node, edit, due in some:  # a letter of the stem that the word lacks
            if edit == 0 and not due:
                grown.update((n, 1 if node else 2, "") for n in self.child[node].values())
        state = frozenset(grown)
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
            ends = [(e, self.stem[n]) for n, e, due in state if self.stem[n] and not due]
            ends = [(min(e, 1), s, e) for e, s in ends if e == 0 or (s in self.rooted if e == 2 else self.fuzzy[s])]
            begins = [x[:2] for x in ends if len(x[1]) >= (ROOT_FROM if x[2] == 2 else LEAST_STEM)]
            self.accepts.append(min(begins) if begins else None)
            self.whole.append(min(x[:2] for x in ends) if ends else None)
        return self.numbers[state]

    def _move(self, state: int, c: str) -> int:
        reached = set()
        for node, edit, due in self.states[state]:
            if due:
                if due == c:
                    reached.add((node, edit, ""))
                continue
            wrong = 1 if node else 2
            for letter, n in self.child[node].items():
                if letter == c:
                    reached.add((n, edit, ""))
                elif edit == 0:  # another letter, or the next one before it
                    reached.add((n, wrong, ""))
                    if c in self.child[n]:
                        reached.add((self.child[n][c], wrong, letter))
            if edit == 0:  # a letter too many
                reached.add((node, wrong, ""))
        self.moves[state][c] = number = self._state(reached) if reached else -1
        return number

    def match(self, word: str) -> tuple[int, str] | None:
        """Least edits and the stem that the word starts with, or is; None without one."""
        state, best = self.start, None
        for c in word:
            state = self.moves[state][c] if c in self.moves[state] else self._move(state, c)
            if state < 0:
                return best
            hit = self.accepts[state]
            if hit is not None and (best is None or hit < best):
                best = hit
        hit = self.whole[state]
        return hit if hit is not None and (best is None or hit < best) else best


@dataclass
class Model:
    """Stems with whether misspellings count, their log odds for one match and for more, the weights, and the
    stems whose first letter may be wrong (None: all whose misspellings count)."""

    stems: dict[str, bool]
    odds: dict[str, tuple[float, float]]
    weights: np.ndarray
    rooted: frozenset[str] | None = None
    _matcher: Matcher | None = field(default=None, repr=False, compare=False)
    _known: dict = field(default_factory=dict, repr=False, compare=False)

    def __getstate__(self):
        return {"stems": self.stems, "odds": self.odds, "weights": self.weights, "rooted": self.rooted, "_matcher": None, "_known": {}}

    def hits(self, text: str) -> tuple[int, list[tuple[int, int, str, bool]]]:
        """Number of words, and (word number, edits, stem, quoted) of each match in the whole text."""
        if self._matcher is None:
            self._matcher = Matcher(self.stems, self.rooted)
        words = _WORD.findall(text.lower())
        known = self._known
        if len(known) > 800_000:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self._matcher.match(w)
        at = [i for i, hit in enumerate(map(known.__getitem__, words)) if hit is not None]
        if not at:
            return len(words), []
        quoted = _quoted_words(text, at, words)
        return len(words), [(i, *known[words[i]], q) for i, q in zip(at, quoted, strict=True)]


def _quoted_words(text: str, at: list[int], words: list[str]) -> list[bool]:
    """Whether each of the words lies in quotation marks of its line, or follows a word of saying."""
    out, wanted, k = [], set(at), 0
    n = 0
    for line in text.lower().split("\n"):
        straight = line.count('"')
        for m in _WORD.finditer(line):
            if n in wanted:
                before = line[: m.start()]
                inside = before.count('"') % 2 == 1 and before.count('"') < straight
                inside = inside or any(before.rfind(o) > before.rfind(c) and c in line[m.end() :] for o, c in _PAIRS.items())
                out.append(inside or any(w in _SAYS for w in words[max(0, n - 3) : n]))
                k += 1
            n += 1
    return out if k == len(at) else [False] * len(at)


def features(n_words: int, hits: list[tuple[int, int, str, bool]], odds: dict[str, tuple[float, float]]) -> list[float]:
    """Evidence of the stems by misspelling and quotation, the densest window outside quotation, and the share of words."""
    evidence = []
    for edits, quoted in ((0, False), (0, True), (1, False), (1, True)):
        counts = Counter(s for _, e, s, q in hits if e == edits and q == quoted)
        evidence.append(min(30.0, sum(odds[s][c > 1] for s, c in counts.items())))
    places = [i for i, _, _, q in hits if not q]
    densest, a = 0, 0
    for b in range(len(places)):
        while places[b] - places[a] > WINDOW:
            a += 1
        densest = max(densest, b - a + 1)
    plain = sum(e == 0 for _, e, _, _ in hits)
    return [1.0, *evidence, math.log1p(densest), math.log1p(plain), math.sqrt(min(1.0, plain / max(1, n_words)))]


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _count_stems(sample: DataFrame) -> DataFrame:
    """(stem, toxic, clean, toxic2, clean2): texts with a word of that beginning, and those with two or more."""
    names = ("toxic", "clean", "toxic2", "clean2")
    schema = pa.schema([("stem", pa.string()), *((n, pa.int64()) for n in names)])

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {n: Counter() for n in names}
        for part in parts:
            for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                stems: Counter = Counter()
                for w, c in Counter(_WORD.findall(text.lower())).items():
                    for n in range(LEAST_STEM, min(len(w), 12) + 1):
                        stems[w[:n]] += c
                    if LEAST_WORD <= len(w) < LEAST_STEM:
                        stems[w] += c
                kind = "toxic" if toxic else "clean"
                counts[kind].update(stems.keys())
                counts[kind + "2"].update(s for s, c in stems.items() if c > 1)
        stems = list(counts["toxic"].keys() | counts["clean"].keys())
        for start in range(0, len(stems), 50_000):
            some = stems[start : start + 50_000]
            yield batch(schema, some, *([counts[n][s] for s in some] for n in names))

    parts = sample.select("text", "toxic").mapInArrow(work, "stem string, toxic bigint, clean bigint, toxic2 bigint, clean2 bigint")
    return parts.groupBy("stem").agg(*(F.sum(n).alias(n) for n in names))


def _odds(a: float, b: float, toxic: int, clean: int) -> float:
    return math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))


def _gain(a: int, b: int, toxic: int, clean: int) -> float:
    """Bits about the label that an event in ``a`` toxic and ``b`` clean texts carries, times the texts."""
    total, out = toxic + clean, 0.0
    for inside, n in ((a, toxic), (b, clean)):
        for x, both in ((inside, a + b), (n - inside, total - a - b)):
            if x:
                out += x * math.log(x * total / (n * both))
    return out


def _pick_stems(rows: list, toxic: int, clean: int, least: int) -> dict[str, tuple[float, float]]:
    """Stems by falling gain, the longer first among equals, none within another; log odds of one and of more."""
    found = []
    for r in rows:
        events = [(_gain(a, b, toxic, clean), _odds(a, b, toxic, clean)) for a, b in ((r["toxic"], r["clean"]), (r["toxic2"], r["clean2"]))]
        if max(events)[0] >= LEAST_GAIN and max(events)[1] >= LEAST_ODDS and r["toxic"] >= least:
            found.append((round(max(events)[0], 6), r["stem"], events[0][1], max(events[0][1], events[1][1])))
    picked: dict[str, tuple[float, float]] = {}
    beginnings: set[str] = set()
    for _, stem, one, more in sorted(found, key=lambda x: (-x[0], -len(x[1]), x[1])):
        if stem not in beginnings and not any(stem[:n] in picked for n in range(LEAST_STEM, len(stem))):
            picked[stem] = (one, more)
            beginnings.update(stem[:n] for n in range(LEAST_STEM, len(stem) + 1))
            if len(picked) == MOST_STEMS:
                break
    return picked


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> np.ndarray:
    """Newton's method with a ridge on all but the first weight."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w = w + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _sample_features(sample: DataFrame, model: Model, flat: bool) -> DataFrame:
    """Of every sample row its features, or else its matched stems with their least edits."""
    schema = pa.schema([("toxic", pa.int32()), ("x", pa.list_(pa.float64())), ("stems", pa.list_(pa.string()))])

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [model.hits(t) for t in part.column(0).to_pylist()]
            x = [features(*r, model.odds) if flat else [] for r in rows]
            stems = [[] if flat else sorted({s for _, e, s, _ in r[1] if e}) for r in rows]
            yield batch(schema, part.column(1).cast(pa.int32()), x, stems)

    return sample.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(work, "toxic int, x array<double>, stems array<string>")


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Learn stems and weights from at most ``sample`` labelled rows outside the held-out quarter.

    The rows are chosen by a hash of their key; copies of a text count once. Only texts and labels are
    used. Without toxic rows the lexicon is empty and every score is the same.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key)).select(key, F.col(label).cast("int").alias("_toxic"))
    known = known.orderBy(F.xxhash64(key), key).limit(sample).groupBy(key).agg(F.max("_toxic").alias("toxic"))
    rows = docs.select(F.col(key), text_of(text).alias("text")).join(F.broadcast(known), key)  # bounded by ``sample``
    # Copies and most near copies of a text share the least hash of three words running, and count once.
    words = F.split(F.lower("text"), r"\s+")
    runs = F.transform(F.sequence(F.lit(1), F.size("_w") - 2), lambda i: F.xxhash64(F.slice("_w", i, 3)))
    least_run = F.when(F.size("_w") > 2, F.array_min(runs)).otherwise(F.xxhash64("text"))
    rows = written(rows.withColumn("_w", words).select("text", "toxic", least_run.alias("run"), F.xxhash64("text").alias("h")), "toxic-sample")
    rows = written(rows.groupBy("run").agg(F.min_by("text", "h").alias("text"), F.max("toxic").alias("toxic")).drop("run"), "toxic-sample")
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    least = max(3, round(0.004 * toxic))
    # A first cut by the odds in the plan; the driver gets a bounded number of the commonest stems.
    likelier = lambda a, b: (F.col(a) + 0.5) * (clean + 1) >= (F.col(b) + 0.5) * (toxic + 1) * math.exp(LEAST_ODDS)
    counted = _count_stems(rows).filter((F.col("toxic") >= least) & (likelier("toxic", "clean") | likelier("toxic2", "clean2")))
    odds = _pick_stems(counted.orderBy(F.desc("toxic"), "stem").limit(10 * MOST_STEMS).collect(), toxic, clean, least)
    model = Model({s: len(s) >= FUZZY_FROM for s in odds}, odds, np.zeros(8))
    # A stem keeps its misspellings unless they are found in clean texts nearly as often as in toxic ones; then,
    # in the same way, those of its first letter.
    common = lambda model: {
        r["stem"] for r in _sample_features(rows, model, False).select("toxic", F.explode("stems").alias("stem")).groupBy("stem").agg(
            F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")
        ).collect() if (r["clean"] + 0.5) / (clean + 1) * 8 > (r["toxic"] + 0.5) / (toxic + 1)
    }
    model.rooted = frozenset()
    for stem in common(model):
        model.stems[stem] = False
    model = Model(model.stems, odds, model.weights)
    model = Model(model.stems, odds, model.weights, frozenset(s for s, fuzzy in model.stems.items() if fuzzy) - common(model))
    data = _sample_features(rows, model, True).select("toxic", "x").collect()
    if data:
        model.weights = _logistic(np.array([r["x"] for r in data]), np.array([r["toxic"] for r in data], float))
    return model


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``score`` and ``hits``: array of (word, edits, stem, quoted), for every whole text.

    Null and empty texts have no hits and the score of such texts. Repeated rows score alike. Other
    columns, lang and source among them, are not read. An empty table gives no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    one = pa.struct([("word", pa.int64()), ("edits", pa.int32()), ("stem", pa.string()), ("quoted", pa.bool_())])
    schema = pa.schema([("key", _arrow(kind)), ("score", pa.float64()), ("hits", pa.list_(one))])

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [model.hits(t) for t in part.column(1).to_pylist()]
            scores = [1 / (1 + math.exp(-max(-30.0, min(30.0, float(np.dot(features(*r, model.odds), model.weights)))))) for r in rows]
            hits = [[dict(zip(("word", "edits", "stem", "quoted"), h, strict=True)) for h in r[1]] for r in rows]
            yield batch(schema, part.column(0).cast(schema.field(0).type), scores, hits)

    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    out = "key {}, score double, hits array<struct<word:bigint,edits:int,stem:string,quoted:boolean>>"
    return rows.mapInArrow(work, out.format(kind)).withColumnRenamed("key", key)


def drop_toxic(docs: DataFrame, model: Model, least: float, text: str = "text") -> DataFrame:
    """The rows whose whole text scores below ``least``, with all their columns. Null texts count as empty."""
    at = docs.columns.index(text)

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            scores = [float(np.dot(features(*model.hits(t or ""), model.odds), model.weights)) for t in part.column(at).to_pylist()]
            yield part.filter(pa.array([1 / (1 + math.exp(-max(-30.0, min(30.0, s)))) < least for s in scores], pa.bool_()))

    return docs.mapInArrow(work, docs.schema)
