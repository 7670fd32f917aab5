"""SimHash groups, top-k search, source mix, URL verdicts: against brute force."""

import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stationflow.llm import components, mixing, search, simhash, urls
from stationflow.llm.queries import QUERIES, RULES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_print(text, width=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = WORD.findall(lower)
    shingles = [" ".join(found[i : i + width]) for i in range(len(found) - width + 1)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, most):
    """Smallest index reachable over links of at most ``most`` bits."""
    value = np.array(prints, np.uint64)
    near = np.bitwise_count(value[:, None] ^ value[None, :]) <= most
    name = np.arange(len(value))
    while True:
        now = np.array([name[row].min() for row in near])
        if (now == name).all():
            return name
        name = now


def test_fingerprints_and_groups_of_whole_table(spark, small):
    docs = sorted(((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()))
    prints = [plain_print(t) for _, t in docs]
    names = plain_groups(prints, 3)
    got = {r["doc_id"]: r for r in QUERIES["op4_pigeonring_simhash"](spark, small).collect()}
    assert len(got) == len(docs)
    for at, (doc, _) in enumerate(docs):
        assert got[doc]["fingerprint"] == f"{prints[at]:016x}"
        assert got[doc]["component_id"] == docs[names[at]][0]


@pytest.mark.parametrize("most", [0, 1, 2, 3])
@pytest.mark.parametrize("block", [2048, 16])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, most, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(most)
    prints = {0, (1 << 64) - 1}
    for _ in range(12):
        center = rng.getrandbits(64)
        for _ in range(40):
            value = center
            for _ in range(rng.randint(0, 5)):
                value ^= 1 << rng.randrange(64)
            prints.add(value)
    prints = sorted(prints)
    names = plain_groups(prints, most)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    root = {r["fp"]: r["root"] for r in simhash.group_prints(df, most).collect()}
    parts, want = {}, {}
    for at, s in enumerate(signed):
        parts.setdefault(root.get(s, s), set()).add(at)
        want.setdefault(names[at], set()).add(at)
    assert sorted(map(sorted, parts.values())) == sorted(map(sorted, want.values()))


def test_pigeonring_never_prunes_a_link():
    rng = np.random.default_rng(3)
    for most in range(4):
        for _ in range(3000):
            value = 0
            for bit in rng.choice(64, rng.integers(0, most + 1), replace=False):
                value |= 1 << int(bit)
            assert simhash.in_chain(np.array([value], np.uint64), most)[0]
            one = np.array([rng.integers(0, 1 << 63)], np.uint64)
            other = one ^ np.uint64(value)
            assert any((a == b).all() for a, b in zip(simhash.chain_keys(one, most), simhash.chain_keys(other, most)))


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)] + [(5, 5), (None, 3)]
    star = [(9, i) for i in range(1000, 1100)]
    df = spark.createDataFrame(path + star, "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components.components(df).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 9 for i in [9, *range(1000, 1100)]}
    assert components.components(df.where("false")).count() == 0


def test_awkward_documents(spark):
    text = "one two three four five six seven eight"
    rows = [(None, text), (7, text), (3, text.upper()), (3, text.upper()), (None, "quite another text here"), (None, None), (8, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for name in ("fp", "seat", "root", "least", "_least", "fingerprint", "component_id", "key"):
        df = df.withColumn(name, F.lit("z"))
    out = simhash.simhash_groups(df, width=3)
    assert sorted(out.columns) == sorted(df.columns)
    got = sorted((str(r["text"]), r["component_id"]) for r in out.select("text", "component_id").collect())
    assert got == sorted([(text, 3), (text, 3), (text.upper(), 3), (text.upper(), 3), ("quite another text here", None), ("None", 8), ("", 8)])
    kept = simhash.keep_one(df, width=3)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "8", "None"]
    assert simhash.keep_one(df.where("false")).count() == 0 and simhash.simhash_groups(df.where("false")).count() == 0


def test_top_k_of_awkward_vectors(spark):
    rng = random.Random(6)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(120)]
    rows += [(i, rows[7][1]) for i in range(120, 150)] + [(100, rows[3][1])]
    rows += [(None, rows[0][1]), (500, None), (550, [1.0, None]), (600, [nan] * 6), (650, [inf] * 6), (700, []), (750, [0.5])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("v", F.lit(1)).withColumn("id", F.lit(1))
    small = search.Blocks(vectors=25, queries=2, rescored=3)
    got = search.top_k(df, F.pmod(F.col("vec_id"), F.lit(50)) == 0, blocks=small).collect()
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = set()
    for q in sorted({i for i, _ in whole if i % 50 == 0}):
        found = set()
        for vector in (v for i, v in whole if i == q):
            found |= {(-sum(a * b for a, b in zip(vector, w)), j) for j, w in whole if j != q and len(w) == len(vector)}
        want |= {(q, rank + 1, j, -s) for rank, (s, j) in enumerate(sorted(found)[:5])}
    single = {w for w in want if w[0] != 100}  # the id that occurs twice has two vectors
    assert {tuple(r) for r in got if r["query_id"] != 100} == single
    assert search.top_k(df.where("false"), F.lit(True)).count() == 0


def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while True:
        share = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if share * weight[s] > cap * sizes[s]}
        if not over:
            return target | {s: share * weight[s] for s in free}
        for s in over:
            target[s] = float(cap * sizes[s])
            left -= target[s]
        free -= over


def test_mix_meets_targets(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    text = {r["doc_id"]: (r["text"], r["source"]) for r in docs.collect()}
    rows = QUERIES["op10_multinomial_mix"](spark, folder).collect()
    again = QUERIES["op10_multinomial_mix"](spark, folder).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again)) and len(rows) == len(text)
    sizes, taken, target = {}, {}, {}
    for r in rows:
        words, source = len(WORD.findall(text[r["doc_id"]][0] or "")), text[r["doc_id"]][1]
        assert r["size"] == words and 0 <= r["taken"] <= 3 * words
        sizes[source] = sizes.get(source, 0) + words
        taken[source] = taken.get(source, 0) + r["taken"]
        target[source] = r["target"]
    want = plain_targets(sizes)
    for s in sizes:
        assert math.isclose(target[s], want[s], rel_tol=1e-9)
        assert abs(taken[s] - want[s]) < 0.005 * want[s] + 64


def test_mixed_blocks_hold_the_words_that_are_taken(spark):
    rng = random.Random(6)
    spaces = [" ", "\n", " \t ", "\n\n"]
    rows = [(i, rng.choice(["", " "]) + "".join(f"d{i}w{k}" + rng.choice(spaces) for k in range(rng.choice([0, 1, 5, 40, 300]))), rng.choice(["a", "b", None])) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("words", F.lit(1))
    mix = mixing.Mix(shard_blocks=64)
    blocks = mixing.mix_blocks(df, mix=mix).collect()
    texts, taken, passes = {i: WORD.findall(t) for i, t, _ in rows}, {}, set()
    whole = {i: t for i, t, _ in rows}
    for r in blocks:
        want = []
        for d in r["documents"]:
            want += texts[d["doc_id"]][d["first_word"] : d["first_word"] + d["words"]]
            taken[d["doc_id"]] = taken.get(d["doc_id"], 0) + d["words"]
            assert rows[d["doc_id"]][2] == r["source"]
        assert WORD.findall(r["text"]) == want and len(want) == r["n_words"] <= 32
        if len(r["documents"]) == 1:
            assert r["text"] in whole[r["documents"][0]["doc_id"]]
        passes.add((r["source"], r["pass"], r["block"]))
    assert len(passes) == len(blocks) > 100
    n = len(blocks)
    assert {(r["shard"], r["slot"]) for r in blocks} == {(i // 64, i % 64) for i in range(n)}
    assert {r["doc_id"]: r["taken"] for r in mixing.mix_sources(df, mix=mix).collect()} == {i: taken.get(i, 0) for i in texts}
    assert mixing.mix_blocks(df.where("false")).count() == 0


def test_mix_of_awkward_rows(spark):
    rows = [(i, "w " * (i % 9), s) for i, s in enumerate(["a", "b", None, "Ä", "z"] * 30)]
    rows += [(None, "one two three", "a"), (5, None, "b"), (5, None, "b"), (6, "x " * 70_000, None), (7, "", "empty")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    for name in ("size", "number", "block", "seat", "taken", "tie"):
        df = df.withColumn(name, F.lit(3))
    out = mixing.mix_sources(df)
    assert out.count() == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want = plain_targets(sizes)
    assert {round(r["target"], 6) for r in out.collect()} == {round(v, 6) for v in want.values()}
    same = mixing.mix_sources(df.repartition(13).orderBy(F.rand(3)))
    assert sorted(map(str, out.collect())) == sorted(map(str, same.collect()))
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    counts = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert "empty" not in counts and counts["a"] > 0
    assert mixing.mix_sources(df.where("false")).count() == 0 and mixing.mixed_documents(df.where("false")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutation_is_one(spark, n):
    df = spark.range(n).withColumnRenamed("id", "i")
    got = [r["p"] for r in mixing.permuted(df, "i", F.lit(n), [F.lit(5)], 8, "p").collect()]
    assert sorted(got) == list(range(n))
    if n == 1000:
        assert abs(np.corrcoef(np.arange(n), got)[0, 1]) < 0.1


def test_shards_hold_the_mix(spark):
    sized = spark.createDataFrame([("a", 40_000), ("b", 30_000), ("c", 30_000)], "source string, size bigint")
    mix = mixing.Mix(shard_blocks=512)
    slots = mixing.shard_slots(mixing.plan_blocks(mixing.source_targets(sized, mix), mix), mix).cache()
    assert slots.count() == slots.select("shard", "slot").distinct().count()
    assert slots.count() == slots.select("number", "pass", "block").distinct().count()
    total = slots.count()
    for r in mixing.shard_counts(slots).collect():
        expected = min(512, total - r["shard"] * 512) * {1: 5, 2: 2, 3: 1}[r["number"]] / 8
        assert abs(r["draws"] - expected) < 6 * math.sqrt(expected) + 6
    slots.unpersist()


def plain_url(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def test_urls_of_whole_table(spark, small):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    rows = QUERIES["op2_url_trees"](spark, small).collect()
    assert len(rows) == len(pages)
    for r in rows:
        host, path = plain_url(pages[r["page_id"]])
        rule = plain_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule.text if rule else None)
        assert r["verdict"] == (rule.verdict if rule else "block" if r["block_score"] >= 0.5 else "allow")


def test_awkward_urls(spark):
    found = [None, "", "no scheme", "http://", "HTTP://NET", "http://A.Net/x", "http://notnet/x", "x://example.com/de/1://y",
             "http://ÄÖ.net/?a=1&b=2#c", "http://a.net:80/", "http://a.net\n/x", "http://org/fr/" + "9" * 50_000, "http://net/", "http://net/"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(found)], "page_id int, url string")
    for name in ("host", "path", "rule", "label", "row", "suffix", "length"):
        df = df.withColumn(name, F.lit(1))
    out = urls.judge_urls(df, RULES)
    assert out.columns == [*df.columns, "url_verdict"]
    for r in out.collect():
        host, path = plain_url(found[r["page_id"]])
        rule = plain_rule(host, path)
        got = r["url_verdict"]
        assert (got["host"], got["path"], got["rule"]) == (host, path, rule.text if rule else None)
        assert got["verdict"] == rule.verdict if rule else got["verdict"] in ("allow", "block")
    assert urls.judge_urls(df.where("false"), RULES).count() == 0


def test_trees_learn_labelled_urls(spark):
    rng = random.Random(4)
    rows = []
    for i in range(1200):
        bad = i % 3 == 0
        name = "".join(rng.choice("abcdefgh") for _ in range(6))
        tail = f"?id={rng.randint(10**8, 10**9)}&s={rng.randint(1, 99)}" if bad else f"{name}/page"
        rows.append((i, f"https://{name}.site.info/{tail}", int(bad)))
    df = spark.createDataFrame(rows, "page_id int, url string, bad int")
    known = F.when(F.col("page_id") % 2 == 0, F.col("bad"))
    out = urls.judge_urls(df, (), labels=known).where("page_id % 2 = 1")
    right = out.where((F.col("url_verdict.verdict") == "block") == (F.col("bad") == 1)).count()
    assert right >= 0.98 * 600


def labelled_urls(spark, n, bad):
    """Block URLs (those ``bad`` names) have a long number in their query."""
    tail = F.when(bad, F.concat(F.lit("?id="), F.col("page_id") + 10**9)).otherwise(F.concat(F.lit("page/"), F.col("page_id")))
    pages = spark.range(n).select(F.col("id").alias("page_id")).withColumn("bad", bad.cast("int"))
    return pages.withColumn("url", F.concat(F.lit("https://h"), F.col("page_id") % 7, F.lit(".site.info/"), tail))


def test_a_rare_label_is_drawn(spark):
    df = labelled_urls(spark, 30_000, F.col("page_id") % 7500 == 0)
    out = urls.judge_urls(df, (), labels=F.col("bad"))
    found = {(r["bad"], r["v"]): r["n"] for r in out.groupBy("bad", F.col("url_verdict.verdict").alias("v")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert found == {(0, "allow"): 29_996, (1, "block"): 4}


def test_copies_neither_fill_the_sample_nor_vanish(spark):
    few = labelled_urls(spark, 200, F.lit(True))
    copies = spark.range(12_000).select(F.lit(-1).cast("bigint").alias("page_id"), F.lit(0).alias("bad"), F.lit("https://a.site.info/page/1").alias("url"))
    df = few.unionByName(copies).withColumn("pick", F.xxhash64("page_id", "url")).withColumn("label", F.col("bad").cast("double"))
    cut = df.withColumn("host", urls.host_of(F.col("url"))).withColumn("path", urls.path_of(F.col("url")))
    drawn = urls.draw(urls.with_suffix_statistics(urls.lexical(cut)), "label", urls.Trees(train_rows=200))
    rows = drawn.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w")).collect()
    found = {r["target"]: r for r in rows}
    assert found[0.0]["n"] == 1 and 60 < found[1.0]["n"] < 140
    assert abs(found[0.0]["w"] - 200 * 12_000 / 12_200) < 1 and 12 < found[1.0]["w"] < 28
    out = urls.judge_urls(df.select("page_id", "url", "bad"), (), labels=F.col("bad"))
    assert out.where((F.col("url_verdict.verdict") == "block") != (F.col("bad") == 1)).count() == 0


def test_held_out_urls_that_rules_decide(spark):
    """Trees that learn from the even half of the URLs with a rule judge the odd half."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    host, path = urls.host_of(F.col("url")), urls.path_of(F.col("url"))
    decided = pages.withColumn("ruled", urls.rule_of(host, path, RULES, "verdict")).where("ruled is not null")
    known = F.when(F.col("page_id") % 2 == 0, (F.col("ruled") == "block").cast("double"))
    out = urls.judge_urls(decided, (), labels=known).where("page_id % 2 = 1")
    right, block = F.col("url_verdict.verdict") == F.col("ruled"), F.col("ruled") == "block"
    row = out.agg(F.avg(right.cast("double")).alias("right"), F.avg(block.cast("double")).alias("base")).first()
    print("held out", row)
    assert row["right"] > max(row["base"], 1 - row["base"])


def test_urls_run_without_python(spark, small):
    plan = QUERIES["op2_url_trees"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    plan = QUERIES["op10_multinomial_mix"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
