"""Tokens, packing, duplicates and pseudonyms against plain computations."""

import base64
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabloom.llm import bpe, dedup, jaccard, packing, pii
from tabloom.llm.queries import ORACLES, QUERIES
from tools.check_queries import canonical

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


def test_bpe(spark, small, odd, none):
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    extra = ["  a   b  ", "x\n \n y  ", "a" * 3000, " " * 500 + "q", "don't we'll 12345  \t\n", "=\n  =", "日本語 \x85 z"]
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(extra)], "doc_id long, text string")
    for docs in (documents(spark, small).select("doc_id", "text"), odd.select("doc_id", "text").union(more)):
        want = Counter((r.doc_id, tuple(coder.encode_ordinary(r.text or "")), (r.text or "").encode()) for r in docs.collect())
        got = bpe.decode(bpe.encode(docs, RANKS), RANKS).collect()
        assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in got) == want
    assert bpe.decode(bpe.encode(none, RANKS), RANKS).count() == 0


def check_packing(rows, docs):
    tokenizer = Tokenizer.from_file(WORDS)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc_id, text in docs.items():
        ids, at = tokenizer.encode(text or "", add_special_tokens=False).ids + [2], 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for some in sequences.values():
        at = 0
        for r in sorted(some, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096 and at & (at - 1) == 0


def test_packing(spark, small, odd, none):
    check_packing(QUERIES["op5_bm25_packing"](spark, small).collect(), {r.doc_id: r.text for r in documents(spark, small).collect()})
    once = odd.filter("key IS NOT NULL")
    check_packing(packing.pack(once, WORDS).collect(), {r.doc_id: r.text for r in once.collect()})
    assert packing.pack(none, WORDS).count() == 0


def test_packing_prefers_neighbours(spark):
    rows = [(i, " ".join(f"{topic}{j}" for j in range(900))) for i, topic in enumerate(["apple", "brick"] * 2)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), WORDS).collect()
    first = min(got, key=lambda r: (r.sequence_id, r.offset))
    mates = [r.doc_id for r in got if r.sequence_id == first.sequence_id]
    assert (first.doc_id + 2) % 4 in mates


def brute_classes(rows):
    def shingles(text):
        words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
        return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()

    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            x, y = sets[a], sets[b]
            if a < b and x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)) and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_jaccard(spark, small, odd, none):
    docs = documents(spark, small)
    want = brute_classes([(r.doc_id, r.text) for r in docs.collect()])
    got = QUERIES["op7_ngram_jaccard"](spark, small).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    got = jaccard.near_classes(odd).collect()
    assert Counter(r.doc_id for r in got) == Counter({2: 2} | {i: 1 for i in (0, 1, 3, 4, 5, 6, 7, 8)})
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_classes([(r.doc_id, r.text) for r in odd.collect()])
    assert jaccard.near_classes(none).count() == 0


def test_jaccard_hot_groups_and_chains(spark, monkeypatch):
    """Frequent n-grams, small blocks and slots: groups of near copies that no single block holds."""
    draw = np.random.default_rng(5)
    monkeypatch.setattr(jaccard, "FREQUENT", 3)
    monkeypatch.setattr(jaccard, "GRAMS", 1)  # blocks of two documents
    monkeypatch.setattr(jaccard, "TOGETHER", 64)
    base = [[f"w{draw.integers(1000)}" for _ in range(60)] for _ in range(3)]
    rows = []
    for i in range(150):
        words = list(base[i % 3])
        for _ in range(draw.integers(0, 4)):
            words[draw.integers(60)] = f"z{draw.integers(10**6)}"
        rows.append((i, " ".join(words[: 60 - int(draw.integers(0, 8))])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = jaccard.near_classes(docs, block=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_classes(rows)


def test_exact(spark, duck, small, odd, none):
    got = QUERIES["op10_exact_dedup"](spark, small).toPandas()
    assert canonical(got) == canonical(duck.execute(ORACLES["op10_exact_dedup"]).fetchdf())
    weak = dedup.exact_groups(odd, digest=lambda t: F.substring(t, 1, 1).cast("binary"))
    for got in (dedup.exact_groups(odd), weak):
        found = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect())
        assert found == Counter([(0, 1, 2, False), (1, 1, 2, True), (2, 3, 3, False), (2, 3, 3, False), (3, 3, 3, True), (4, 5, 2, False), (5, 5, 2, True), (6, 6, 1, True), (7, 7, 1, True), (8, 8, 1, True)])
    assert dedup.exact_groups(none).count() == 0
    kept = dedup.drop_exact(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 5, 6, 7, 8]


def test_pseudonyms(spark, small, odd, none):
    values = [
        "a 2024-02-29, 31/12/1999 12/31/1999 01.02.2003 2023-02-30 x", "mail Bob.Smith+1@sub.Example.co.uk!", "GB82 WEST 1234 5698 7654 32, DE89370400440532013000, DE88370400440532013000",
        "123-45-6789 666-12-3456", "192.168.1.300 10.0.0.1", "+1 (778) 555-8933, 4111 1111 1111 1111, 4111-1111-1111-1112", None, "",
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(values)], "doc_id long, text string, private string")
    out = pii.pseudonymise(docs, "k")
    found = {r.doc_id: [p.value for p in r.private] for r in out.collect()}
    assert [len(found[i]) for i in range(8)] == [4, 1, 2, 1, 1, 2, 0, 0]
    assert [r.text for r in pii.pseudonymise(out, "k", back=True).orderBy("doc_id").collect()] == values
    again = pii.pseudonymise(out, "other").collect()  # pseudonyms are valid values of their kind
    assert [len(r.private) for r in sorted(again, key=lambda r: r.doc_id)] == [4, 1, 2, 1, 1, 2, 0, 0]
    both = QUERIES["op4_pii_pseudonyms"](spark, small).collect()
    pairs = {(k, v, p) for r in both for k, v, p in zip(r.kinds, r.found, r.pseudonyms, strict=True)}
    assert len({(k, v) for k, v, _ in pairs}) == len(pairs) == len({(k, p) for k, _, p in pairs})
    texts = {r.doc_id: r.text for r in documents(spark, small).collect()}
    for r in both:
        rest = texts[r.doc_id]
        for v, p in zip(r.found, r.pseudonyms, strict=True):
            rest = rest.replace(v, p, 1)
        assert rest == r.text or r.n_private > 1
    assert pii.mask(odd, "k").count() == odd.count() and pii.mask(none, "k").count() == 0


def test_pseudonyms_end_before_what_follows(spark):
    """Cards and IBANs whose greedy match runs on; what follows them is searched as well."""
    card, iban = "4111 1111 1111 1111", "ES91 2100 0418 4502 0005 1332"
    values = {
        f"{card} 12/27": [card], f"{card} 123": [card], f"x {card} 12/27/2025 {card} 999 y": [card, "12/27/2025", card], f"{card} 123-45-6789": [card, "123-45-6789"],
        f"pay {iban} BIC now": [iban], f"{iban} ABC {card} 12 a@b.cc": [iban, card, "a@b.cc"], "ES91 2100 0418 4502 0005 1333 BIC": [], "4111 1111 1111 1112 123": [], "378282246310005 1234": ["378282246310005"],
    }
    more = [f"{card[:-7]}{i:02d} {i * 7 % 10}{i % 10}11 {i:02d}/27" for i in range(100)]  # chance lets longer ends pass, too
    docs = spark.createDataFrame(list(enumerate([*values, *more])), "doc_id long, text string")
    for key in ("k", "other"):
        out = pii.pseudonymise(docs, key)
        found = {r.doc_id: r for r in out.collect()}
        for i, (text, want) in enumerate(values.items()):
            assert [p.value for p in found[i].private] == want, text
            for p in found[i].private:
                text = text.replace(p.value, p.pseudonym, 1) if len(set(want)) == len(want) else text
            assert found[i].text == text or len(set(want)) < len(want)
        back = pii.pseudonymise(out, key, back=True).orderBy("doc_id").collect()
        assert [r.text for r in back] == [*values, *more]


def test_packing_related_documents_meet_in_many_shards(spark):
    draw = np.random.default_rng(4)
    common, rows = [f"common{i}" for i in range(300)], []
    for topic in range(40):
        own = [f"{chr(97 + topic % 26)}{chr(97 + topic // 26)}q{j}z" for j in range(30)]
        for copy in range(4):
            rows.append((4 * topic + copy, " ".join([*draw.choice(common, 60), *draw.choice(own, 60)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = packing.pack(docs, WORDS, window=1024, shard=6000).collect()
    shard = {r.doc_id: r.sequence_id >> 33 for r in got}
    assert len(set(shard.values())) >= 10
    together = sum(shard[4 * t + a] == shard[4 * t + b] for t in range(40) for a in range(4) for b in range(a)) / 240
    assert together > 0.6  # by chance one in the number of shards
    text = " ".join(f"word{i}" for i in range(150))
    same = spark.createDataFrame([(i, f"{text} end{i}") for i in range(200)], "doc_id long, text string")  # one hot term for all
    got = packing.pack(same, WORDS, window=512, shard=4000).collect()
    tokenizer = Tokenizer.from_file(WORDS)
    load = Counter()
    for r in got:
        load[r.sequence_id >> 33] += r.length
    assert len(load) > 5 and max(load.values()) <= 2 * 4000 * 1.5
    assert sum(r.length for r in got) == sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in same.collect())


def test_packing_added_tokens(spark):
    texts = ["end <|endoftext|> next", "a<|startoftext|>b", "<|endoftext|>", "End <|ENDOFTEXT|> x", "é <|startoftext|>’s <|endoftext|>", "no <| endoftext |> here"]
    check_packing(packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), WORDS).collect(), dict(enumerate(texts)))


def test_packing_odd_characters(spark):
    texts = ["a\x01b!c", "x\x7f!y", "a\x00!b", "\u0130!", "x'y's", "tab\t!\n.x", "\u00c9 \u00d6!!\u00df", "a\x1cb", "a<|b", "!!!", "a1!2", "\u00d7!x", "a\u0301!b"]
    check_packing(packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), WORDS).collect(), dict(enumerate(texts)))


def test_names_that_clash(spark):
    docs = spark.createDataFrame([(1, "a b", 5, "p", "q"), (2, "a b", 6, "r", "s"), (3, None, 7, "t", "mail x@y.org")], "doc_id long, text string, _null int, _parts string, _hits string")
    kept = dedup.drop_exact(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [(2, "a b", 6, "r", "s"), (3, None, 7, "t", "mail x@y.org")]
    out = pii.pseudonymise(docs, "key", text="_hits")
    assert out.columns == [*docs.columns, "private"]
    got = {r.doc_id: r for r in out.collect()}
    assert got[1]["_parts"] == "p" and got[1]["_hits"] == "q" and got[3]["_null"] == 7
    assert got[3]["_hits"] != "mail x@y.org" and got[3]["private"][0]["value"] == "x@y.org"


def test_bpe_spaces_after_other_white_space(spark):
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["a \xa0 \xa0 b", "x\n \ny", "a\t b", "\xa0 \xa0 \xa0", "p\u2003 q \x85 r", "one two", "end "]
    got = bpe.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), RANKS).collect()
    assert {r.doc_id: list(r.ids) for r in got} == {i: coder.encode_ordinary(t) for i, t in enumerate(texts)}


def test_jaccard_copies_only_sets_of_near_sizes(spark, monkeypatch):
    """Texts that share n-grams but differ too much in size for a link are not copied to a common block."""
    words = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join(words[:n] + [f"own{k}x{i}" for i in range(n // 8)])) for k, n in enumerate((20, 20, 60, 180, 360))]
    seen, join = [], jaccard._join_blocks

    def counted(blocks, *rest):
        seen.append({r.id for r in blocks.select("id").collect()})
        return join(blocks, *rest)

    monkeypatch.setattr(jaccard, "_join_blocks", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for frequent in (jaccard.FREQUENT, 1):  # n-grams of no slot, and in slots
        monkeypatch.setattr(jaccard, "FREQUENT", frequent)
        got = jaccard.near_classes(docs).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_classes(rows)
    assert seen[0] <= {0, 1} and seen[2] <= {0, 1}
