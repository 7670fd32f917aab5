"""Quality bands, toxicity, license scan: against plain versions, and on awkward rows."""

import random
import re
import textwrap
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from stationflow.llm import licenses, quality, toxicity
from stationflow.llm.queries import QUERIES, fold

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    found = WORD.findall(text)
    n = len(found)
    windows = Counter(tuple(found[i : i + 8]) for i in range(n - 7))
    inside = [False] * n
    for i in range(n - 7):
        if windows[tuple(found[i : i + 8])] > 1:
            inside[i : i + 8] = [True] * 8
    earlier, lines = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in earlier
            earlier.add(line)
    repeat = sum(inside)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return n, sum(map(len, found)), symbols, lines, repeat, n < 20 or 100 * repeat > 30 * n


def test_counts_equal_plain_version_on_whole_table(spark, small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op1_compression_bands"](spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert got == plain_counts(texts[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])


def test_counts_equal_plain_version_on_made_up_texts():
    rng = random.Random(4)
    judge = quality._judge(quality.Bands())
    alphabet = ["a", "b", "é", "#x", "\n", " ", "\t", "\x0b", "\x85", "\xa0", "ab "]
    for _ in range(400):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 90))) * rng.randint(1, 2)
        got = judge(text.encode())
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        assert tuple(got[c] for c in names) == plain_counts(text)


def test_bands_reject_repetitive_and_incompressible_text():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    usual = lambda n: " ".join(rng.choice(words[:400] if rng.random() < 0.6 else words) for _ in range(n))
    judge = quality._judge(quality.Bands())
    for n in (40, 200, 900, 5000):
        assert judge(usual(n).encode())["kept"], n
    noise = " ".join("".join(chr(rng.randint(33, 0x2FF)) for _ in range(12)) for _ in range(400))
    assert judge(noise.encode())["reason"] == "incompressible"
    pairs = " ".join(f"row {i % 7} value {i % 5} and {i % 11} again" for i in range(400))
    assert judge(pairs.encode())["kept"] is False
    half = usual(600) + " " + " ".join(f"{rng.choice('abc')}{rng.choice('xyz')}" for _ in range(6000))
    assert judge(half.encode())["kept"] is False


def plain_verdict(text, bands):
    """The bands, read off one by one."""
    data, press = (text or "").encode(), zstandard.ZstdCompressor(level=bands.level, write_content_size=False)
    if plain_counts(text)[-1]:
        return "base"
    ratio = lambda b: len(press.compress(b)) / len(b)
    for least, low, high in reversed(bands.limits):
        if len(data) >= least:
            if ratio(data) < low:
                return "repetitive"
            if ratio(data) > high:
                return "incompressible"
            break
    chunks = [data[i : i + bands.chunk_bytes] for i in range(0, len(data), bands.chunk_bytes)]
    chunks = [c for c in chunks if len(c) == bands.chunk_bytes]
    low, high = bands.chunk_band
    return "chunks" if 2 * sum(not low <= ratio(c) <= high for c in chunks) > len(chunks) else None


def test_verdict_equals_plain_version_and_tells_junk_from_good_text(spark):
    """On labelled rows with odd ids; the limits were read from even ones."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(spark.read.parquet(f"{folder}/labels.parquet").withColumnRenamed("quality", "label"), "doc_id")
    bands, gone, all_of, reasons = quality.Bands(), Counter(), Counter(), Counter()
    for r in quality.judge_quality(docs.where("doc_id % 2 = 1")).collect():
        reason = plain_verdict(r["text"], bands)
        assert (r["quality"].reason, r["quality"].kept) == (reason, reason is None)
        reasons[reason] += 1
        if reason != "base":
            all_of[r["label"]] += 1
            gone[r["label"]] += reason is not None
    assert reasons["chunks"] and reasons["repetitive"]
    assert gone[0] >= 0.8 * all_of[0] > 0 and gone[1] <= 0.025 * all_of[1]


def test_lowest_ratios_are_quantiles_of_good_texts(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (300, 310, 350, 700, 1024, 1448, 1449)]
    df = spark.createDataFrame([(t, 1) for t in texts] + [(None, 1), ("", 1), ("aa" * 200, 0)], "text string, mark int")
    rows = quality.lowest_ratios(df, F.col("mark") == 1).collect()
    assert [(r["least_bytes"], r["n"]) for r in rows] == [(256, 3), (512, 1), (1024, 2), (1449, 1)]
    press = zstandard.ZstdCompressor(level=3, write_content_size=False)
    ratios = [len(press.compress(t.encode())) / len(t) for t in texts]
    assert rows[0]["lowest_ratio"] == min(ratios[:3]) and rows[2]["lowest_ratio"] == min(ratios[4:6])
    assert quality.lowest_ratios(df, F.lit(False)).count() == 0


AWKWARD = [
    (None, None, "x"),
    (1, "", None),
    (1, "", None),
    (2, " \n\t ", "x"),
    (3, "word " * 200_000, "x"),
    (4, "a calm line about gardens.\nReleased under the MIT License.", "y"),
]


def awkward(spark, more=()):
    df = spark.createDataFrame([*AWKWARD, *more], "doc_id bigint, text string, source string")
    for name in ("fp", "seat", "size", "number", "bucket", "key", "n", "quality", "toxicity", "licenses", "tokens"):
        df = df.withColumn(name, F.lit(7))
    return df


def test_awkward_rows_keep_their_columns(spark):
    df = awkward(spark)
    model = toxicity.Model({"calm": 3.0}, -4.0)
    for out in (
        quality.judge_quality(df),
        toxicity.score_toxicity(df, model),
        licenses.scan_licenses(df),
    ):
        assert out.columns == df.columns
        assert out.count() == 6
        assert out.where("false").count() == 0
    judged = {r["doc_id"]: r["quality"] for r in quality.judge_quality(df).collect()}
    assert judged[None]["base_failed"] and judged[1]["n_words"] == 0 and judged[3]["n_repeat_words"] == 200_000
    empty = spark.createDataFrame([], df.schema)
    assert quality.judge_quality(empty).count() == 0
    assert licenses.license_rows(licenses.scan_licenses(empty)).count() == 0


def test_noisy_or_is_learned_from_document_labels_and_points_at_sentences(spark):
    rng = random.Random(2)
    plain = ["garden", "river", "stone", "window", "paper", "cloud", "bread", "music"]
    rows, labels = [], []
    for i in range(900):
        lines = [" ".join(rng.choice(plain) for _ in range(6)) + "." for _ in range(rng.randint(2, 12))]
        bad = i % 4 == 0
        if bad:
            lines[rng.randrange(len(lines))] = "you vile " + rng.choice(["grobble", "grobbler", "grobbling"]) + " go."
        rows.append((i, " ".join(lines), "s"))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    marks = spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, marks, usable=fold("_id", 3) != 1)
    for r in toxicity.score_toxicity(docs, model).collect():
        assert r["toxicity"]["predicted"] == (r["doc_id"] % 4 == 0)
        assert 0 <= r["toxicity"]["score"] <= 1
        for s in r["toxicity"]["sentences"]:
            assert "vile" in r["text"][s["start"] : s["stop"]]
    judged = toxicity.score_toxicity(docs.withColumn("lang", F.lit("zz")).drop("source"), model)
    assert judged.agg(F.max("toxicity.score")).first()[0] > 0.7
    one_class = toxicity.train(docs, marks.where("toxic = 0"))
    assert one_class.weights == {} and toxicity.score_toxicity(docs, one_class).where("toxicity.predicted = 1").count() == 0


def test_of_a_word_and_its_stems_one_carries_weight():
    ranked = ["achlich-", "achlichau", "achl-", "idi-", "idiot", "moron", "moro-", "mor-", "ab", "achlich"]
    assert toxicity.one_of_each_chain(ranked) == ["achlich-", "idi-", "moron", "ab", "achlich"]


def test_repeated_documents_train_once(spark):
    rows = [(i, "you vile grobble." if i % 4 == 0 else "a river of stones.") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(80)], "doc_id bigint, toxic int")
    many = docs.unionByName(docs.where("doc_id = 0").crossJoin(spark.range(50).select()))
    one, two = toxicity.train(docs, marks), toxicity.train(many, marks)
    assert one.weights.keys() == two.weights.keys() and np.isclose(one.bias, two.bias)


def test_held_out_toxicity(spark):
    folder = "/root/testdata/sf0.01"
    scored = QUERIES["op9_multiple_instance_toxicity"](spark, folder).where("held_out").drop("sentences")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = scored.join(labels, "doc_id").select("toxic", "predicted").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert np.mean(toxic) > 0.6 and np.mean(clean) < 0.03


@pytest.mark.parametrize(
    "line, name, exact",
    [
        ("Released under the MIT License.", "MIT", True),
        ("released under  the mit license", "MIT", True),
        ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0", True),
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0", True),
        ("This work was licensed under the GNU General Public License, version 2.", "GPL-2.0", False),
    ],
)
def test_licenses_are_named_with_their_differences(line, name, exact):
    text = "ofer thing to be\n" * 40 + line + "\nother words the and of\n" * 3
    found = licenses._scanner(licenses.TEMPLATES, licenses.Scan())(text.encode())
    assert [(f["license"], f["exact"]) for f in found] == [(name, exact)]
    assert found[0]["different_words"] == (0 if exact else 1)
    assert text[found[0]["start"] : found[0]["stop"]].lower().startswith(line.split()[0].lower())


SHORT = ("Apache-2.0", "CC-BY-4.0", "CC-BY-NC-4.0", "GPL-2.0", "MIT", "MPL-2.0")


@pytest.mark.parametrize("between", ["\n", " ", "\n\n"])
def test_both_of_two_near_notices_are_found(between):
    find = licenses._scanner(licenses.TEMPLATES, licenses.Scan())
    for one in SHORT:
        for two in SHORT:
            text = "some words before\n" + licenses.TEMPLATES[one] + between + licenses.TEMPLATES[two] + "\nand after\n"
            assert [(f["license"], f["exact"]) for f in find(text.encode())] == [(one, True), (two, True)], (one, two)


def test_wrapped_notices_are_found_from_their_first_word():
    find = licenses._scanner(licenses.TEMPLATES, licenses.Scan())
    wrapped = "This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0."
    for name, notice in [("MPL-2.0", wrapped), ("Apache-2.0-header", licenses.TEMPLATES["Apache-2.0-header"].replace("; ", ";\n"))]:
        text = "a line of code\nanother one\n\n" + notice + "\nthe end\n"
        found = find(text.encode())
        assert [(f["license"], f["exact"]) for f in found] == [(name, True)]
        assert found[0]["start"] == text.index(notice[:10])


@pytest.mark.parametrize("width", [45, 76])
def test_every_template_is_told_from_the_others_when_wrapped(width):
    find = licenses._scanner(licenses.TEMPLATES, licenses.Scan())
    assert {"AGPL-3.0-header", "CC0-1.0-header", "EPL-2.0-header", "ISC", "LGPL-3.0-header", "Unlicense"} <= set(licenses.TEMPLATES)
    for name, wording in licenses.TEMPLATES.items():
        notice = "\n# ".join(textwrap.wrap(wording, width, break_on_hyphens=False))
        found = find(("code here\n\n# " + notice + "\nmore code\n").encode())
        assert [(f["license"], f["exact"]) for f in found] == [(name, True)], name


def test_a_talk_about_licenses_is_no_license():
    text = "The license of a driver is checked by the office, and copyright is another matter to discuss at length."
    assert licenses._scanner(licenses.TEMPLATES, licenses.Scan())(text.encode()) == []


def test_every_planted_license_line_is_found(spark, small):
    lines = re.compile(
        r"This work is licensed under the GNU General Public License, version (\d)\.|Licensed under CC (BY-NC) 4\.0\."
        r"|Released under the (MIT) License\.|Licensed under the (Apache) License, Version 2\.0\."
    )
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    want = {(i, m.start()) for i, t in texts.items() for m in lines.finditer(t)}
    assert {(r["doc_id"], r["start"]) for r in QUERIES["op7_conditional_licenses"](spark, small).collect()} >= want
