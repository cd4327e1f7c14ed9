"""Secrets in texts: fixed patterns, and a linear-chain conditional random field over tokens.

The field tags the tokens of every chunk that could hold a secret as begin, inside or outside, from
their shape, the words around them and features of the whole text. Plain words that follow no cue
can't carry a tag, so the chain of a text falls apart at them and each chunk is decoded by Viterbi on
its own, exactly.
Weights are fitted on a bounded sample in which the fixed patterns give the labels.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import batch, text_of
from tabloom.llm.bpe import _arrow

# The patterns of the three base kinds, their least lengths, and their order.
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs are maximal, so this equals runs of any length kept from 32 on
KINDS = ("assign", "access", "hex", "crf")

#: Rows of the training sample at most.
SAMPLE = 2000

_DIGITS = re.compile(r"[0-9]+")
_LONG = re.compile(r"[A-Za-z]{24,}")
_CHUNK_LEFT = re.compile(r"[A-Za-z0-9+/_.=~-]")
_MIXED = re.compile(r"[a-z][A-Z]")
_PLAIN = re.compile(r"(?<![\w/+=.-])[A-Z]?[a-z]{1,14}(?![\w/+=-])")
#: A word that announces a secret, and what follows it behind a sign or white space; one value may be a cue itself.
_AFTER_CUE = re.compile(
    r"""(?i:pass(?:word|wd|phrase)?|pwd|secret|token|api_?key|credential|auth(?:orization|entication)?|bearer|private|key)s?["']?(?:\s*[:=]\s*|\s+)["']?(?=([A-Za-z0-9+/_.=~-]+))"""
)
#: What every text with a chunk has, for the plan.
_SEEDED = "[0-9]|[A-Za-z]{24}|[a-z][A-Z]|(?i:pass|pwd|secret|token|key|credential|auth|bearer|private)"
_TOKEN = re.compile(r"[A-Za-z0-9]+|[^A-Za-z0-9]")
_SIDE = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=~-")
_CUE = re.compile(r"pass(?:word|wd|phrase)?|pwd|secret|token|api_?key|credential|auth|bearer|private|key", re.IGNORECASE)
_WORD_BEFORE = re.compile(r"([^\W\d_]+)[^\w]*$")
_LEAD = 24  # characters before a chunk that hold its neighbouring word and marks

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Whole matches of the base patterns, by start and then kind."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def chunks(text: str) -> list[tuple[int, int]]:
    """Runs of secret-like characters with a digit, 24 letters in a row or mixed case, or after an assignment or a cue."""
    found: list[tuple[int, int]] = []
    seeds = [m.span() for m in _DIGITS.finditer(text)] + [m.span() for m in _LONG.finditer(text)] + [m.span(2) for m in ASSIGN.finditer(text)]
    seeds += [m.span() for m in _MIXED.finditer(text)] + [m.span(1) for m in _AFTER_CUE.finditer(text)]
    done = 0
    for a, b in sorted(seeds):
        if a < done:
            continue
        while a > done and text[a - 1] in _SIDE:
            a -= 1
        while b < len(text) and text[b] in _SIDE:
            b += 1
        found.append((a, b))
        done = b
    return found


def _tokens(text: str, a: int, b: int) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text, a, b)]


def _token_features(word: str) -> list[float]:
    n = len(word)
    digits = sum(c.isdigit() for c in word)
    upper = sum(c.isupper() for c in word)
    alpha = sum(c.isalpha() for c in word)
    kinds = [1 if c.isdigit() else 2 if c.isupper() else 3 for c in word[:256]]
    turns = sum(x != y for x, y in zip(kinds, kinds[1:], strict=False))
    hexed = all(c in "0123456789abcdef" for c in word)
    return [
        1.0, n == 1 and not word.isalnum(), n < 4, 4 <= n < 8, 8 <= n < 16, 16 <= n < 24, 24 <= n < 32, n >= 32,
        digits == n, digits > 0 and alpha > 0, hexed and digits > 0 and alpha > 0, upper > 0 and alpha == upper and digits > 0,
        0 < upper < alpha, turns >= 4, turns >= 8, digits == 0, bool(_CUE.fullmatch(word)),
    ]


def features(text: str, a: int, b: int, tokens: list[tuple[int, int]], whole: list[float]) -> np.ndarray:
    """One row for each token: its shape, the neighbours' shape classes, the words around, the whole text."""
    before, after = text[max(0, a - _LEAD) : a], text[b : b + 8]
    word = _WORD_BEFORE.search(before)
    stripped = before.rstrip(" \"'")
    around = [
        bool(word and _CUE.search(word[1])), stripped.endswith(("=", ":")), before[-1:] in ("'", '"') and before[-1:] != "",
        "@" in (before[-1:], after[:1]), before[-1:] in ("+", "(") and before[-1:] != "", after[:1] in ("'", '"') and after[:1] != "",
        before[-1:].isspace() or not before, text.count(".", a, b) >= 3, text[a:b].startswith("AKIA"), text.startswith("-----BEGIN", max(0, a - 11)),
    ]
    own = np.array([_token_features(text[x:y]) for x, y in tokens], np.float64)
    cue = np.array([bool(_CUE.search(text[x:y])) for x, y in tokens])
    sign = np.array([text[x:y] in ("=", ":") for x, y in tokens])
    seen_cue = np.concatenate([[False], np.maximum.accumulate(cue)[:-1]])
    seen_sign = np.concatenate([[False], np.maximum.accumulate(sign & (seen_cue | around[0]))[:-1]])
    shape = own[:, [1, 8, 9, 13, 15]]
    previous = np.vstack([np.zeros((1, shape.shape[1])), shape[:-1]])
    following = np.vstack([shape[1:], np.zeros((1, shape.shape[1]))])
    first = np.arange(len(tokens)) == 0
    shared = np.tile(np.array(around + whole, np.float64), (len(tokens), 1))
    return np.hstack([own, previous, following, first[:, None], seen_cue[:, None], seen_sign[:, None], shared, own[:, 4:8].any(1)[:, None] * shared[:, :10]])


#: 1 for the columns of ``features`` that do not look beyond the chunk.
_SHAPE_ONLY = np.array([1.0] * (17 + 5 + 5 + 1) + [0.0] * (2 + 10 + 5 + 10))


def whole_features(text: str) -> list[float]:
    n = max(1, len(text))
    cues = sum(text.count(c) for c in ("password", "secret", "token", "key"))
    return [cues > 0, cues > 3, text.count("=") / n > 0.01, n < 400, n > 20_000]


@dataclass
class Field:
    """Emission weights (features x tags O, B, I) and transitions; I never follows O."""

    emit: np.ndarray
    move: np.ndarray

    def decode(self, rows: np.ndarray) -> list[int]:
        """The best tags by Viterbi."""
        score = rows @ self.emit
        best = score[0] + np.array([0.0, 0.0, -1e9])
        back = np.zeros((len(rows), 3), np.int8)
        for t in range(1, len(rows)):
            paths = best[:, None] + self.move
            back[t] = paths.argmax(0)
            best = paths.max(0) + score[t]
        tags = [int(best.argmax())]
        for t in range(len(rows) - 1, 0, -1):
            tags.append(int(back[t, tags[-1]]))
        return tags[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(sequences: list[tuple[np.ndarray, list[int]]], steps: int = 200, rate: float = 0.1, ridge: float = 1e-3) -> Field:
    """Maximum likelihood by forward-backward over all sequences, those of one length at a time, with Adam."""
    width = sequences[0][0].shape[1]
    by_length: dict[int, list[tuple[np.ndarray, list[int]]]] = {}
    for rows, tags in sequences:
        by_length.setdefault(len(tags), []).append((rows, tags))
    packs = [(np.stack([r for r, _ in some]), np.array([t for _, t in some])) for some in by_length.values()]
    never = np.zeros((3, 3))
    never[0, 2] = -1e9
    weights = np.zeros(width * 3 + 9)
    m, v, count = np.zeros_like(weights), np.zeros_like(weights), len(sequences)
    for step in range(1, steps + 1):
        emit, move = weights[: width * 3].reshape(width, 3), weights[width * 3 :].reshape(3, 3) + never
        d_emit, d_move = np.zeros_like(emit), np.zeros_like(move)
        for rows, tags in packs:
            n, length, _ = rows.shape
            score = rows @ emit
            score[:, 0, 2] -= 1e9
            ahead = np.zeros((length, n, 3))
            ahead[0] = score[:, 0]
            for t in range(1, length):
                ahead[t] = _log_sum(ahead[t - 1][:, :, None] + move, 1) + score[:, t]
            behind = np.zeros((length, n, 3))
            for t in range(length - 2, -1, -1):
                behind[t] = _log_sum(move + (score[:, t + 1] + behind[t + 1])[:, None, :], 2)
            total = _log_sum(ahead[-1], 1)
            part = np.exp(ahead + behind - total[None, :, None])
            gap = np.eye(3)[tags].transpose(1, 0, 2) - part
            d_emit += np.einsum("nlf,lnk->fk", rows, gap)
            for t in range(1, length):
                pair = np.exp(ahead[t - 1][:, :, None] + move + (score[:, t] + behind[t])[:, None, :] - total[:, None, None])
                d_move -= pair.sum(0)
                np.add.at(d_move, (tags[:, t - 1], tags[:, t]), 1)
        grad = -np.concatenate([d_emit.ravel(), d_move.ravel()]) / count + ridge * weights
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        weights = weights - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(weights[: width * 3].reshape(width, 3), weights[width * 3 :].reshape(3, 3) + never)


def _labelled(text: str) -> Iterator[tuple[np.ndarray, list[int]]]:
    """Chunks of a text with the tags that the base patterns give; an assignment's secret is its value."""
    spans = [m.span(2) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    spans += [(a, b) for kind, a, b in base_spans(text) if kind != "assign"]
    whole = whole_features(text)
    for a, b in chunks(text):
        tokens = _tokens(text, a, b)
        if len(tokens) > 64:  # only training skips these
            continue
        tags, inside = [], -1
        for x, y in tokens:
            at = next((i for i, (s, e) in enumerate(spans) if s <= x and y <= e), -1)
            tags.append(0 if at < 0 else 2 if at == inside else 1)
            inside = at
        yield features(text, a, b, tokens, whole), tags


#: How a secret is announced in the views for training, and whether a sign parts it from its cue.
_ANNOUNCED = (("password = ", True), ("pwd: ", True), ("passphrase: ", True), ("credential=", True), ("private_key='", True), ("Authorization: Bearer ", False), ("auth token ", False))


def _letter_views(text: str, draw: np.random.Generator) -> Iterator[tuple[np.ndarray, list[int]]]:
    """The base patterns rarely label a value of letters, so each labelled one is seen as such, after other cues, too.

    Words of the text in the same places, and two of them run together without a cue, are no secrets.
    """
    whole = whole_features(text)
    words = _PLAIN.findall(text) or ["word"]
    plain = lambda: str(draw.choice(words))
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) < 8:
            continue
        for cue, sign in _ANNOUNCED:
            mixed = not sign or draw.random() < 0.5
            letters = list("abcdefghijklmnopqrstuvwxyz" + "ABCDEFGHIJKLMNOPQRSTUVWXYZ" * mixed)
            if mixed and sign and draw.random() < 0.5:  # words run together
                value = plain().lower() + "".join(plain().capitalize() for _ in range(2))
            else:
                value = "".join(draw.choice(letters, draw.integers(12 if sign else 16, 41)))
            joined = plain().capitalize() + plain().capitalize()
            for before, word, tag in ((cue, value, 1), (cue, plain().lower(), 0), (cue, plain().capitalize(), 0), ("", joined, 0), ("Authorization: ", "Bearer", 0)):
                lead = f"{text[max(0, m.start() - 100) : m.start()]} {before}"
                other = f"{lead}{word} {plain()} {text[m.end() : m.end() + 100]}"
                at, to = len(lead), len(lead) + len(word)
                for a, b in chunks(other):
                    if a < to and at < b and (len(word) >= 12) >= tag:
                        tokens = _tokens(other, a, b)
                        yield features(other, a, b, tokens, whole), [tag * int(at <= x and y <= to) for x, y in tokens]


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Field | None:
    """Fit on at most ``sample`` texts with a chunk, those of the lowest hash of the key; None without any.

    Labelled assignments are also seen with values of letters only, after other cues.
    Only the lowest hashes, forty rows for each one wanted, are looked at, so that the tasks together
    send a bounded number of texts to the driver however many there are.
    """
    rows = docs.select(text_of(text).alias("text"), F.xxhash64(key).alias("_h"))
    if (n := docs.count()) > 40 * sample:
        rows = rows.filter(F.col("_h") < int(2**64 * (40 * sample / n)) - 2**63)
    rows = rows.filter(F.col("text").rlike(_SEEDED) & (F.length("text") < 20_000))
    picked = rows.orderBy("_h", "text").limit(sample).collect()
    sequences = [x for row in picked for x in _labelled(row["text"])]
    # Half the weight goes to copies that don't see the words around, so a secret's shape alone can tell.
    blind = [(rows * _SHAPE_ONLY, tags) for rows, tags in sequences if any(tags)]
    draw = np.random.default_rng(0)
    letters = [x for row in picked for x in _letter_views(row["text"], draw)]
    return train(sequences + blind + letters) if sequences else None


def spans_of(text: str, field: Field | None) -> list[Span]:
    """All spans: the base ones, and those of the field that no base span covers."""
    found = base_spans(text)
    if field is None:
        return found
    whole, more = None, []
    for a, b in chunks(text):
        if whole is None:
            whole = whole_features(text)
        tokens = _tokens(text, a, b)
        tags = field.decode(features(text, a, b, tokens, whole))
        for (x, y), tag in zip(tokens, tags, strict=True):
            if tag == 1:
                more.append([x, y])
            elif tag == 2:
                more[-1][1] = y
    found += [("crf", x, y) for x, y in more if not any(s <= x and y <= e for _, s, e in found)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def find(docs: DataFrame, field: Field | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``spans``, array of (kind, start, end) in code points, end exclusive, for every whole text.

    Kinds are assign, access, hex and crf; order is by start, then kind. Null and empty texts have no
    spans; repeated rows have equal ones; other columns are not read. An empty table gives none.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = pa.schema([("key", _arrow(kind)), ("spans", pa.list_(_SPAN))])

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans_of(t, field)] for t in part.column(1).to_pylist()]
            yield batch(schema, part.column(0).cast(schema.field(0).type), rows)

    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    return rows.mapInArrow(work, f"key {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>").withColumnRenamed("key", key)


def redact(docs: DataFrame, field: Field | None, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with every span replaced by the mark; null texts stay null."""
    names = docs.columns

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            for t in part.column(names.index(text)).to_pylist():
                if t:
                    done, pieces = 0, []
                    for _, a, b in spans_of(t, field):
                        if b > done:
                            pieces += [t[done : max(a, done)], mark if a >= done else ""]
                            done = b
                    t = "".join(pieces) + t[done:] if pieces else t
                out.append(t)
            yield part.set_column(names.index(text), part.schema.field(names.index(text)), pa.array(out, part.schema.field(names.index(text)).type))

    return docs.mapInArrow(work, docs.schema)
