"""Collocations, benchmark passages and prefix tries: against SQL, brute force and made-up edges."""

import hashlib
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from oracle_check import connect, difference, rows_of_spark, rows_of_sql
from stationflow.llm import collocations as co
from stationflow.llm import decontamination as dc
from stationflow.llm import prefix_trie as pt
from stationflow.llm.queries import ORACLES, QUERIES


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("name", ["op11_vertical_collocations", "op12_winnowed_passages", "op13_screened_prefix_trie"])
def test_query_equals_sql(spark, small, name):
    assert difference(rows_of_spark(QUERIES[name](spark, small)), rows_of_sql(connect(small), ORACLES[name])) is None


# ---- collocations ------------------------------------------------------------------------------------------


def plain_collocations(rows, mining):
    f, n, out = defaultdict(Counter), Counter(), set()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f[lang].update(tuple(w[i : i + k]) for i in range(len(w)) for k in range(1, 4) if i + k <= len(w))
    for lang, g in f.items():
        candidates = [p for p in g if len(p) > 1 and g[p] >= mining.least]
        inside = Counter()
        for p in candidates:
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    inside[q] = max(inside[q], g[p])
        found = []
        for p in candidates:
            if inside[p] and 100 * inside[p] >= mining.swallowed * g[p]:
                continue
            score, k = min((1000000 * g[p] ** 2 // (g[p[:k]] * g[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -g[p], " ".join(p).encode(), g[p[:k]], g[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[: mining.top], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return out


@pytest.mark.parametrize(
    "mining",
    [co.Mining(), co.Mining(least=2, top=40), co.Mining(least=3, budget=300, classes=16, flush=500, slice_bytes=200)],
    ids=["whole", "short lists", "small groups"],
)
def test_collocations_of_odd_texts(spark, mining):
    rng = random.Random(1)
    words = ["the", "The", "a", "b", "ñandú", "x\x00y", "İ", "c d", " ", "'", "of"] + [f"w{i}" for i in range(30)]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "!?", "\x1f"]

    def text(n):
        return "".join(rng.choice(words) + rng.choice(ends) for _ in range(n))

    hot = "the a " * 400
    rows = [(rng.choice(["en", "de", None, "und"]), text(rng.randrange(60))) for _ in range(150)]
    rows += [("en", None), ("en", ""), (None, " \t\n"), ("de", hot), ("de", hot), ("en", text(4000)), ("xx", "." * 50), ("en", "z" * 5000)]
    df = spark.createDataFrame([(l, t, 1, "k") for l, t in rows], "lang string, text string, f int, phrase string")
    got = {tuple(r) for r in co.collocations(df.repartition(5), mining=mining).collect()}
    assert got == plain_collocations(rows, mining)


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert co.collocations(empty).collect() == []
    assert co.collocations(spark.createDataFrame([(None, None)], "lang string, text string")).collect() == []


def test_scores_beyond_64_bits(spark):
    """Products of counts are exact: phrases of a word with itself score a floor of a ratio of 128-bit numbers."""
    text = "p q " * 9 + ". " + "q " * 4
    rows = [("en", text)] * 40
    got = {r["phrase"]: r for r in co.collocations(spark.createDataFrame(rows, "lang string, text string")).collect()}
    f = plain_collocations(rows, co.Mining())
    assert {(r["phrase"], r["score"]) for r in got.values()} == {(x[2], x[7]) for x in f}


def test_groups_keep_their_budget():
    mining = co.Mining(budget=100, classes=8)
    import numpy as np

    one = np.array([60, 50, 30, 20, 500, 0, 100, 1])
    two = np.array([90, 80, 70, 60, 50, 50, 50, 50])
    groups, n = co.packed_groups([one, two], mining)
    total = Counter()
    for of, sizes in zip(groups, (one, two)):
        for g, size in zip(of, sizes):
            total[int(g)] += int(size)
    assert groups[0][4] == -1 and groups[0][5] == -1
    assert all(size <= 100 for g, size in total.items() if g >= 0)
    assert sorted(g for g in total if g >= 0) == list(range(n))


# ---- passages ----------------------------------------------------------------------------------------------

ITEM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_passages(docs, items, length=10):
    windows = defaultdict(set)
    for item, text in items:
        w = ITEM_WORD.findall(lower(text))
        n = min(length, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = ITEM_WORD.findall(lower(text)), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def found_passages(docs, items, **options):
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r) for r in dc.find_passages(docs, items, **options).select(columns).collect()), key=repr)


@pytest.mark.parametrize("length, broadcast_rows", [(1, 1_000_000), (3, 0), (7, 1_000_000), (10, 1_000_000), (10, 0)])
def test_passages_equal_brute_force(spark, monkeypatch, length, broadcast_rows):
    monkeypatch.setattr(dc, "BROADCAST_ROWS", broadcast_rows)
    rng = random.Random(length)
    words = ["a", "A", "b", "c", "é", "É", "ß", "7"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(i, text(rng.randrange(0, 25))) for i in range(12)] + [(3, text(12)), (None, text(11)), (20, None), (21, "...")]
    items += [(100 + i, items[0][1]) for i in range(3)]
    docs = [(i, text(rng.randrange(0, 40))) for i in range(40)]
    docs += [(i, text(8) + items[i][1] + " " + text(8)) for i in range(12)]
    docs += [(None, None), (7, ""), (8, items[1][1]), (8, items[1][1]), (9, "a " * 300)]
    many = spark.createDataFrame([(d, t, 0, "x") for d, t in docs], "doc_id long, text string, seat int, window string")
    few = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, names int")
    assert found_passages(many.repartition(3), few, length=length) == plain_passages(docs, items, length)


def test_passages_without_items_or_documents(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert found_passages(docs, none) == plain_passages([(1, "a b"), (2, None)], [])
    assert found_passages(spark.createDataFrame([], "doc_id long, text string"), none) == []


def test_hits_are_named_and_few_fingerprints_kept(spark):
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(30))
    text = " ".join(f"n{rng.randrange(5000)}" for _ in range(4000))
    docs = spark.createDataFrame([(1, text + " " + passage + " " + text)], "doc_id long, text string")
    items = spark.createDataFrame([(5, passage)], "item_id long, text string")
    row = dc.find_passages(docs, items).first()
    assert row["items"] == ["5"] and [h["first"] for h in row["hits"]] == list(range(4000, 4021))
    kept = docs.select(dc.lower_words(docs["text"]).alias("words")).select(dc.winnowed([10]).alias("p")).first()["p"]
    assert len(kept) < 0.35 * 8030
    assert max(b["at"] - a["at"] for a, b in zip(kept, kept[1:])) <= 10 - dc.gram_words(10) + 1


def test_passages_use_no_python(spark, small, capsys):
    QUERIES["op12_winnowed_passages"](spark, small).explain()
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)


# ---- tries -------------------------------------------------------------------------------------------------


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(v, key=lambda t: t[0])] for c, v in own.items()}
    nodes, built = defaultdict(list), {}
    for c, turns in own.items():
        base, h = c - int(c - 100 * int(c / 100)), zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(base, [])[:h] + turns[h:]
        for d in range(len(built[c]) + 1):
            nodes[tuple(built[c][:d])].append(c)
    children, leaves, saved = Counter(k[:-1] for k in nodes if k), Counter(), Counter()
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(members) - 1) * len(k[-1][1]) if k else 0
    out = set()
    for k, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(built[c]) == len(k))))
        parent = min(nodes[k[:-1]]) if k else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.add((min(members), len(k), parent, len(members), children[k], leaves[k], saved[k], digest))
    return out


TRIES = {
    "wide": pt.Trie(),
    "blocks": pt.Trie(block_rows=7, many_children=1, prefixes_a_sketch=50),
    "full sketch": pt.Trie(hashes=1, most_counters=1),
}


@pytest.mark.parametrize("trie", TRIES.values(), ids=TRIES)
def test_trie_equals_brute_force(spark, monkeypatch, trie):
    if trie.most_counters == 1:
        # Too few counters: nothing is proven single, all is grouped, results stay.
        monkeypatch.setattr(pt, "SEGMENT", 8)
    rng = random.Random(5)
    rows = []
    for c in [0, 1, 2, 7, 99, 100, 101, 102, 150, 199, 205, 250, -3, -100, -150, 10**12, 10**12 + 7, *range(300, 420)]:
        turns = rng.choice([0, 1, 2, 3, 6, 12, 40])
        same = rng.random() < 0.5
        for t in range(turns):
            said = f"turn {t}" if same else rng.choice(["", "é😀", "x" * t, None])
            rows.append((c, t, rng.choice(["user", None]) if not same else "user", said))
    rows += [(500, None, "user", "first"), (500, 0, "user", "second"), (None, 0, "user", "none"), (None, 1, None, None)]
    rows += [(600, 5, "user", "same"), (600, 5, "user", "same"), (601, 1, "us", "er"), (602, 1, "u", "ser")]
    columns = "conv_id long, turn long, role string, text string, depth int, h1 string"
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], columns).repartition(4)
    got = [tuple(r) for r in pt.prefix_trie(df, trie=trie).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_trie(rows)


def test_trie_of_nothing(spark):
    columns = "conv_id long, turn long, role string, text string"
    assert pt.prefix_trie(spark.createDataFrame([], columns)).collect() == []
    assert pt.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], columns)).collect() == []


def test_sketch_never_counts_too_little(spark):
    """Digests that come twice are always marked; of single ones, few are in a sketch of twice their number."""
    rng = random.Random(2)
    single = [(rng.getrandbits(63), rng.getrandbits(63)) for _ in range(20_000)]
    twice = [(rng.getrandbits(63), rng.getrandbits(63)) for _ in range(500)]
    rows = spark.createDataFrame(single + twice + twice, "d1 long, d2 long").repartition(6)
    trie = pt.Trie(prefixes_a_sketch=5_000)
    width = pt.sketch_width(21_000, trie)
    import numpy as np

    table = np.frombuffer(pt.shared_counters(rows, 21_000, trie), np.uint8)

    def marked(pairs):
        d1, d2 = (np.array(x, np.int64) for x in zip(*pairs))
        out = np.ones(len(d1), bool)
        for row in range(trie.hashes):
            cell = pt._cells(d1, d2, row, width) + row * width
            out &= (table[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
        return out

    assert marked(twice).all()
    assert marked(single).mean() < 0.2
