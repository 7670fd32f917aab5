"""The gated language model: gradients, probabilities that sum to one, exact counts, held-out gain."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stationflow.llm import language_model as lm
from stationflow.llm.queries import QUERIES, fold

SMALL = lm.Settings(head=64, common=12, class_size=5, rare_classes=3, hidden=6, lanes=4, window=5)


def known(spark, texts, settings=SMALL):
    return lm.lexicon(lm.word_counts(spark.createDataFrame([(t,) for t in texts], "text string")), settings)


def test_gradients_agree_with_differences(spark):
    lex = known(spark, ["a b c d e f g h a b a", "a b k l m n o p q", "b"])
    p = {k: v.astype(np.float64) for k, v in lm.first_parameters(lex).items()}
    rng = np.random.default_rng(0)
    symbols = len(p["x"])
    inputs, targets = (rng.integers(0, symbols, (5, 3)) for _ in range(2))
    inputs[0] = 0

    def loss(q):
        h, total = np.zeros((3, 6)), 0.0
        for t in range(5):
            h = np.where((inputs[t] == 0)[:, None], 0.0, h)
            h = lm.step(q, inputs[t], h)[0]
            total -= lm.log_probability(q, h, targets[t]).sum()
        return total / 15

    value, g, _ = lm.gradients(p, inputs, targets, np.zeros((3, 6)))
    assert math.isclose(value, loss(p), rel_tol=1e-5)
    for name in p:
        for at in rng.integers(0, p[name].size, 12):
            q = {k: v.copy() for k, v in p.items()}
            q[name].flat[at] += 1e-4
            up = loss(q)
            q[name].flat[at] -= 2e-4
            assert abs((up - loss(q)) / 2e-4 - g[name].flat[at]) < 1e-4, name


def test_symbols_and_words_have_proper_probabilities(spark):
    lex = known(spark, ["a b c d e f g h i j k l m n o p a b", "x1 x2 x3 a", None])
    p = lm.first_parameters(lex)
    state = np.random.default_rng(1).standard_normal((1, 6)).astype(np.float32)
    symbols = np.arange(len(p["x"]))
    logs = lm.log_probability(p, np.repeat(state, len(symbols), 0), symbols)
    assert abs(np.exp(logs).sum() - 1) < 1e-4
    # Within a rare class the known words and one unseen word share all of it.
    rare = Counter()
    for word, at in lex.head.items():
        if lex.symbol[at] >= lex.common:
            k = lex.symbol[at] - lex.common
            rare[k] += 10 ** (lex.log_count[at] - lex.rare_log[k])
    assert all(abs(share + 10 ** -lex.rare_log[k] - 1) < 1e-9 for k, share in rare.items())


def test_state_is_carried_over_windows_and_lanes(spark):
    lex = known(spark, ["a b c d e f g h a b a"])
    p = lm.first_parameters(lex)
    rng = np.random.default_rng(2)
    docs = [rng.integers(1, len(p["x"]), n) for n in (1, 3, 40, 41, 7, 100)]
    docs = [np.append(d, 0).astype(np.int32) for d in docs]
    got = lm.sequence_logs(p, docs, lm.Settings(score_lanes=4, score_window=7))
    for doc, log in zip(docs, got):
        h, before, total = np.zeros((1, 6), np.float32), np.zeros(1, np.int32), 0.0
        for symbol in doc:
            h = lm.step(p, before, h)[0]
            before = np.array([symbol])
            total += float(lm.log_probability(p, h, before)[0])
        assert math.isclose(log, total, rel_tol=1e-4)


def test_lanes_do_not_wait_for_the_longest_document(spark, monkeypatch):
    lex = known(spark, ["a b c d e f g h a b a"])
    rng = np.random.default_rng(4)
    docs = [np.append(rng.integers(1, 8, n - 1), 0).astype(np.int32) for n in [100, *[10] * 30]]
    steps, real = [], lm._step
    monkeypatch.setattr(lm, "_step", lambda *a: steps.append(a[2].shape[0]) or real(*a))
    lm.sequence_logs(lm.first_parameters(lex), docs, lm.Settings(score_lanes=4, score_window=7))
    # 400 tokens in four lanes; group by group, each as long as its longest document, it takes 180 steps.
    assert len(steps) <= 105 and sum(steps) <= 420


def test_each_distinct_word_is_looked_up_once(spark):
    class Counted(dict):
        looked = 0

        def get(self, *a):
            self.looked += 1
            return super().get(*a)

    lex = known(spark, ["a b a"])
    lex.head = Counted(lex.head)
    coded = lm.encode(lex, pa.array(["a B A a", None, "", " a\tz\x1cz  b\n"] * 50))
    assert lex.head.looked == 4  # a, b, an unseen word and the end
    assert coded.starts.tolist()[:5] == [0, 5, 6, 7, 11]


def test_words_are_cut_as_python_cuts_them():
    texts = [f"{chr(i)}X{chr(i)}y Z{chr(i)}{chr(i)}" for i in range(0x250)] + [None, "", " ", "\u2003\u00a0É", "last"]
    for at in (0, 1, 7, 600):  # a slice of a batch begins inside its buffers
        found, place, sizes = lm.cut_words(pa.array(texts).slice(at))
        want = [(t or "").encode().lower().split() for t in texts[at:]]
        each = found.to_pylist()
        assert [each[i] for i in place] == [w for some in want for w in some] and sizes.tolist() == [*map(len, want)]


def test_rows_of_each_symbol_are_added_up():
    rng = np.random.default_rng(5)
    symbols, rows = np.minimum(rng.zipf(1.3, 500) - 1, 39), rng.standard_normal((3, 500, 2))
    want = np.zeros((40, 6))
    np.add.at(want, symbols, rows.transpose(1, 0, 2).reshape(500, 6))
    assert np.allclose(lm._sums_by(symbols, rows, 40), want)


def test_counts_and_base_scores_of_whole_table(spark, small):
    docs = {r["doc_id"]: (r["text"] or "").encode().lower().split() + [b""] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in docs}
    counts = Counter(w for d, found in docs.items() if not held[d] for w in found)
    n, v = sum(counts.values()), len(counts)
    rows = QUERIES["op5_gated_language_model"](spark, small).collect()
    assert len(rows) == len(docs)
    for r in rows:
        found = docs[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(found), n)
        assert r["n_known"] == sum(counts[w] > 0 for w in found)
        want = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in found)
        assert math.isclose(r["base_score"], want, rel_tol=1e-9)
        assert r["score"] < 0


def test_small_head_gives_the_same_counts(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    get = lambda s: {r["doc_id"]: r for r in lm.score_documents(docs, fold("doc_id", 7) != 2, settings=s).collect()}
    quick = {"common": 64, "hidden": 8}
    one, two = get(lm.Settings(**quick)), get(lm.Settings(head=300, **quick))
    for d in one:
        assert one[d]["n_known"] == two[d]["n_known"]
        assert math.isclose(one[d]["base_score"], two[d]["base_score"], rel_tol=1e-9)


def test_held_out_gain(spark):
    rows = QUERIES["op5_gated_language_model"](spark, "/root/testdata/sf0.01").where("held_out")
    s = rows.agg(F.sum("base_score"), F.sum("score"), F.sum("n_tokens")).first()
    assert (s[1] - s[0]) / s[2] > 0.2


def test_every_training_document_reaches_the_network(spark):
    """Each document holds a word of its own, whose vector moves only if the document is trained on."""
    settings = lm.Settings(common=512, hidden=6, lanes=4, window=5, replica_tokens=500)
    docs = spark.createDataFrame([(i, f"w{i} " * 5) for i in range(400)], "doc_id bigint, text string")
    lex = lm.lexicon(lm.word_counts(docs), settings)
    moved = np.abs(lm.train(docs, lex)["x"] - lm.first_parameters(lex)["x"]).max(axis=1)
    assert all(moved[lex.symbol[lex.head[f"w{i}".encode()]]] > 1e-5 for i in range(400))


def test_awkward_rows(spark):
    rows = [(None, None), (1, ""), (1, ""), (2, "a " * 50_000), (3, "A b"), (4, "never seen")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("seat", F.lit(1)).withColumn("c", F.lit(1))
    quick = lm.Settings(common=8, hidden=4, turns=1)
    got = lm.score_documents(df, F.col("doc_id") < 4, settings=quick).collect()
    assert len(got) == 6
    by = {r["doc_id"]: r for r in got}
    assert by[None]["n_tokens"] == 1 and not by[None]["training"] and by[2]["n_tokens"] == 50_001
    assert by[4]["n_known"] == 1 and all(math.isfinite(r["score"]) for r in got)
    assert lm.score_documents(df.where("false"), F.lit(True), settings=quick).count() == 0
    none = lm.score_documents(df, F.lit(False), settings=quick).collect()
    assert len(none) == 6 and all(r["base_score"] == 0 and r["n_known"] == 0 and r["train_tokens"] == 0 for r in none)
