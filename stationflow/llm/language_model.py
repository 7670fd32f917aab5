"""Language-model scores of whole documents by a gated recurrent network.

The output softmax is factored by classes: common words share classes of equal size, with a softmax inside the
class; every other word belongs to a rare class, chosen by its ending, and has its smoothed share of that class.
Word counts of the whole corpus give the shares and the first biases; the network learns the rest by truncated
backpropagation in numpy.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heapreplace
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import SLICE_BYTES, quoted, slices
from stationflow.storage import stage

# Fixed value: the end of a document, which no word can be.
END = b""
COUNTED = 400_000
LN10 = float(np.log(10.0))
SHORT_RUN = 4


@dataclass(frozen=True)
class Settings:
    """``head`` bounds the words that every task holds, ``common`` those with a vector of their own (the end among
    them). Training reads every training document once, dealt to ``turns`` rounds. Replicas of about
    ``replica_tokens`` tokens start a round from the same parameters, and their averages, weighted by tokens, begin the
    next. A stream is cut into ``least_lanes`` lanes, or more while that leaves ``many_windows`` windows, up to
    ``lanes``: wide windows cost less time a token, few windows learn less."""

    head: int = 1 << 18
    common: int = 1024
    class_size: int = 32
    rare_classes: int = 24
    hidden: int = 32
    turns: int = 2
    replica_tokens: int = 4_000_000
    lanes: int = 192
    least_lanes: int = 48
    many_windows: int = 1_000
    window: int = 20
    rate: float = 0.01
    score_lanes: int = 192
    score_window: int = 24
    seed: int = 3


def rare_class(word: bytes, classes: int) -> int:
    return zlib.crc32(word[-2:]) % classes


def cut_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Lower-cased texts (null: empty) as words: the distinct ones, the place of each word among them, and how many
    words each text has. Arrow cuts at the same bytes as ``bytes.split``, but leaves empty words at the edges."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    found, ends = cut.flatten(), np.diff(cut.offsets.to_numpy()).cumsum()
    full = pc.binary_length(found).to_numpy() > 0
    if not full.all():
        ends = np.r_[0, full.cumsum()][ends]
        found = found.filter(pa.array(full))
    coded = found.dictionary_encode()
    return coded.dictionary.cast(pa.binary()), coded.indices.to_numpy(), np.diff(ends, prepend=0)


def listed(found: pa.Array) -> list[bytes]:
    """What ``to_pylist`` gives, without a scalar of Arrow for each word."""
    return found.to_numpy(zero_copy_only=False).tolist()


# --- corpus counts


def _task_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the task's texts with their counts; emptied when it has grown large."""
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.record_batch([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "c"])
        counts.clear()
        return out

    for batch in batches:
        for part in slices(batch.column(0), SLICE_BYTES // 4):
            found, at, _ = cut_words(part)
            counts[END] += len(part)
            counts.update(dict(zip(listed(found), np.bincount(at, minlength=len(found)).tolist())))
            if len(counts) > COUNTED:
                yield flush()
    if counts:
        yield flush()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over all rows of the one column ``text``; the end counts as the word of no letters."""
    counted = texts.select("text").mapInArrow(_task_counts, "word binary, c bigint")
    return counted.where("c > 0").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Lexicon:
    """What all tasks know of the counts: bounded by ``head`` words and the rare classes."""

    head: dict[bytes, int]  # word: place in the arrays below
    log_count: np.ndarray  # log10(c + 1)
    symbol: np.ndarray  # input and output symbol: common word, or number of common words + rare class
    rare_log: np.ndarray  # log10 of the denominator of each rare class
    symbol_counts: np.ndarray
    tokens: int
    distinct: int
    settings: Settings

    @property
    def base_log(self) -> float:
        return float(np.log10(self.tokens + self.distinct + 1))

    @property
    def common(self) -> int:
        return len(self.symbol_counts) - self.settings.rare_classes


def lexicon(counts: DataFrame, settings: Settings) -> Lexicon:
    """Totals, the most frequent words (all words of a count or none), and the sums of the rare classes."""
    totals = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    floor, kept = 1, 0
    # One row for each different count; those of the frequent words come first, and there are at most ``head``.
    for row in counts.groupBy("c").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).limit(settings.head).collect():
        if kept + row["n"] > settings.head:
            floor = row["c"] + 1
            break
        kept, floor = kept + row["n"], row["c"]
    top = [(bytes(r["word"]), r["c"]) for r in counts.where(F.col("c") >= floor).collect()]
    top.sort(key=lambda x: (x[0] != END, -x[1], x[0]))
    k, classes = settings.common, settings.rare_classes
    if not top or top[0][0] != END:
        top.insert(0, (END, 0))
    common = [c for _, c in top[:k]]
    symbol = [i if i < k else len(common) + rare_class(w, classes) for i, (w, _) in enumerate(top)]
    ending = F.pmod(F.crc32(F.substring(F.col("word"), -2, 2)), F.lit(classes))
    mass, kinds = np.zeros(classes), np.zeros(classes)
    for row in counts.groupBy(ending.alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect():
        mass[row["k"]], kinds[row["k"]] = row["c"], row["v"]
    for word, c in top[:k]:
        if c:
            mass[rare_class(word, classes)] -= c
            kinds[rare_class(word, classes)] -= 1
    return Lexicon(
        head={w: i for i, (w, _) in enumerate(top)},
        log_count=np.log10(np.array([c for _, c in top], float) + 1),
        symbol=np.array(symbol, np.int32),
        rare_log=np.log10(mass + kinds + 1),
        symbol_counts=np.concatenate([np.array(common, float), mass]),
        tokens=totals["n"] or 0,
        distinct=totals["v"] or 0,
        settings=settings,
    )


# --- network


def first_parameters(known: Lexicon) -> dict[str, np.ndarray]:
    """Small random weights; biases so that the untrained network is the unigram model of the counts."""
    s = known.settings
    rng = np.random.default_rng(s.seed)
    common, h = known.common, s.hidden
    classes = -(-common // s.class_size)
    counts = known.symbol_counts + 0.5
    in_class = np.full(classes * s.class_size, -30.0)
    in_class[:common] = np.log(counts[:common])
    sums = np.add.reduceat(counts[:common], np.arange(0, common, s.class_size))
    in_class[:common] -= np.repeat(np.log(sums), s.class_size)[:common]
    draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    return {
        "x": draw(common + s.rare_classes, 3 * h, scale=0.1),
        "u": draw(h, 3 * h, scale=h**-0.5),
        "c": draw(h, classes + s.rare_classes, scale=0.02),
        "cb": np.log(np.concatenate([sums, counts[common:]]) / counts.sum()).astype(np.float32),
        "o": draw(classes, h, s.class_size, scale=0.02),
        "ob": in_class.reshape(classes, s.class_size).astype(np.float32),
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    with np.errstate(over="ignore"):  # beyond the range of exp the result is 0, as it should be
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def parts_of(p: dict) -> tuple[np.ndarray, np.ndarray]:
    """Input and recurrent weights of update, reset and candidate as three planes, so that steps work on whole rows."""
    x, u = p["x"], p["u"]
    return tuple(np.ascontiguousarray(w.reshape(len(w), 3, -1).transpose(1, 0, 2)) for w in (x, u))


def step(p: dict, symbols: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """One gated step of many lanes: (new state, update, reset, candidate, recurrent part of the candidate)."""
    x, u = parts_of(p)
    both, candidate, new = np.empty((3, *h.shape), h.dtype), np.empty_like(h), np.empty_like(h)
    return _step(x.take(symbols, axis=1), u, h, both, candidate, new)


def _step(x, u, h, both, candidate, new) -> tuple[np.ndarray, ...]:
    """``step`` from the inputs of the three parts into arrays given, ``both`` for update, reset and recurrent part."""
    np.matmul(h, u, out=both)
    gates, own = both[:2], both[2]
    gates += x[:2]
    _sigmoid(gates)
    np.multiply(gates[1], own, out=candidate)
    candidate += x[2]
    np.tanh(candidate, out=candidate)
    np.subtract(h, candidate, out=new)
    new *= gates[0]
    new += candidate
    return new, gates[0], gates[1], candidate, own


def class_of(p: dict, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each symbol, and its place in the class (-1 for rare classes)."""
    classes, _, size = p["o"].shape
    common = len(p["x"]) - (p["c"].shape[1] - classes)
    rare = symbols >= common
    return np.where(rare, classes + symbols - common, symbols // size), np.where(rare, -1, symbols % size)


def _log_sum(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exponentials of the logits, their sums and the log of the sums of the original logits. Rows are shifted by
    their maxima only if some exponential would leave the range of the numbers."""
    ones = np.ones(logits.shape[1], logits.dtype)
    with np.errstate(over="ignore"):
        out = np.exp(logits)
    sums = out @ ones
    if not len(sums) or (sums.max() < 1e30 and sums.min() > 1e-30):
        return out, sums, np.log(sums)
    top = logits.max(axis=1)
    out = np.exp(logits - top[:, None])
    sums = out @ ones
    return out, sums, np.log(sums) + top


def _by_class(p: dict, states: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, ...]:
    """States and targets in order of the target's class, so that a class is a slice: (order, states, class, place,
    edges of the classes with words of their own)."""
    kind, place = class_of(p, targets)
    order = np.argsort(kind.astype(np.int16), kind="stable")
    kind = kind[order]
    return order, states.take(order, axis=0), kind, place[order], np.searchsorted(kind, np.arange(len(p["o"]) + 1))


def _inside(p: dict, states: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Logits of the words of the class of each row."""
    inside = np.empty((edges[-1], p["o"].shape[2]), states.dtype)
    for c, (a, b) in enumerate(zip(edges, edges[1:])):
        if b > a:
            np.matmul(states[a:b], p["o"][c], out=inside[a:b])
            inside[a:b] += p["ob"][c]
    return inside


def log_probability(p: dict, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log probability of each target symbol after each state."""
    order, states, kind, place, edges = _by_class(p, np.asarray(states, p["c"].dtype), targets)
    logits = states @ p["c"]
    logits += p["cb"]
    logs = logits[np.arange(len(kind)), kind] - _log_sum(logits)[2]
    inside, m = _inside(p, states, edges), edges[-1]
    logs[:m] += inside[np.arange(m), place[:m]] - _log_sum(inside)[2]
    out = np.empty_like(logs)
    out[order] = logs
    return out


def _share_less_one(logits: np.ndarray, wanted: np.ndarray) -> tuple[float, np.ndarray]:
    """Summed loss of the wanted columns, and its derivative by the logits."""
    at = np.arange(len(wanted))
    picked = logits[at, wanted]
    share, sums, log_sum = _log_sum(logits)
    share *= np.reciprocal(sums)[:, None]
    share[at, wanted] -= 1
    return float((log_sum - picked).sum(dtype=np.float64)), share


def _sums_by(symbols: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sum of the rows of each symbol below ``size``, planes side by side. Rows are ordered by symbol; most symbols of
    a window have few rows, which are added one after another for all symbols at once, and longer runs are a product
    each."""
    order = np.argsort(symbols.astype(np.int16) if size < 1 << 15 else symbols, kind="stable")
    number = np.bincount(symbols, minlength=size)
    first = np.cumsum(number) - number
    wide = np.empty((len(order), len(rows), rows.shape[2]), rows.dtype)
    for k, plane in enumerate(rows):
        wide[:, k] = plane.take(order, axis=0)
    wide = wide.reshape(len(order), -1)
    out = np.zeros((size, wide.shape[1]), rows.dtype)
    few = number <= SHORT_RUN
    for place in range(SHORT_RUN):
        here = np.flatnonzero((number > place) & few)
        out[here] += wide.take(first[here] + place, axis=0)
    ones = np.ones(len(wide), rows.dtype)
    long = np.flatnonzero(~few)
    for symbol, a, b in zip(long.tolist(), first[long].tolist(), (first + number)[long].tolist()):
        np.matmul(ones[a:b], wide[a:b], out=out[symbol])
    return out


def gradients(p: dict, inputs: np.ndarray, targets: np.ndarray, h: np.ndarray) -> tuple[float, dict, np.ndarray]:
    """Mean negative log probability of a window (steps x lanes), its gradients truncated at the window, last state."""
    steps, lanes = inputs.shape
    n, kind_of = h.shape[1], p["u"].dtype
    starts = inputs == 0  # a document begins: symbol 0 is the end
    opens = starts.any(axis=1)
    before, states, candidate = (np.empty((steps, lanes, n), kind_of) for _ in range(3))
    both = np.empty((steps, 3, lanes, n), kind_of)
    x, u = parts_of(p)
    for t in range(steps):
        before[t] = h
        if opens[t]:
            before[t][starts[t]] = 0
        h = _step(x.take(inputs[t], axis=1), u, before[t], both[t], candidate[t], states[t])[0]
    g = {}
    order, flat, kind, place, edges = _by_class(p, states.reshape(-1, n), targets.ravel())
    logits = flat @ p["c"]
    logits += p["cb"]
    loss, share = _share_less_one(logits, kind)
    ones = np.ones(len(kind), kind_of)
    g["c"], g["cb"] = flat.T @ share, ones @ share
    sorted_down = share @ p["c"].T
    more, share = _share_less_one(_inside(p, flat, edges), place[: edges[-1]])
    g["o"], g["ob"] = np.zeros_like(p["o"]), np.zeros_like(p["ob"])
    for c, (a, b) in enumerate(zip(edges, edges[1:])):
        if b > a:
            np.matmul(flat[a:b].T, share[a:b], out=g["o"][c])
            g["ob"][c] = ones[a:b] @ share[a:b]
            sorted_down[a:b] += share[a:b] @ p["o"][c].T
    down = np.empty_like(sorted_down)
    down[order] = sorted_down
    down = down.reshape(steps, lanes, n)
    back = np.zeros((lanes, n), kind_of)
    inner, moved = np.empty((3, steps, lanes, n), kind_of), np.empty((steps, lanes, n), kind_of)
    turned = np.ascontiguousarray(u.transpose(0, 2, 1))
    rest, through, part = (np.empty((lanes, n), kind_of) for _ in range(3))
    for t in reversed(range(steps)):
        update, reset, own = both[t]
        by_update, by_reset, by_own = inner[:, t]
        back += down[t]
        np.subtract(1, update, out=rest)
        rest *= back
        # The state before less the candidate, times update times (1 - update).
        np.subtract(before[t], candidate[t], out=by_update)
        by_update *= update
        by_update *= rest
        np.multiply(candidate[t], candidate[t], out=part)
        np.subtract(1, part, out=part)
        np.multiply(rest, part, out=moved[t])
        np.multiply(moved[t], reset, out=by_own)
        np.subtract(1, reset, out=part)
        part *= own
        np.multiply(part, by_own, out=by_reset)
        back *= update
        for k in range(3):
            back += np.matmul(inner[k, t], turned[k], out=through)
        if opens[t]:
            back[starts[t]] = 0
    flat_before = before.reshape(-1, n).T
    g["u"] = np.concatenate([flat_before @ k.reshape(-1, n) for k in inner], axis=1)
    inner[2] = moved
    g["x"] = _sums_by(inputs.ravel(), inner.reshape(3, -1, n), len(p["x"]))
    size = kind_of.type(steps * lanes)
    for v in g.values():
        v /= size
    return (loss + more) / float(size), g, h


def train_stream(p: dict, stream: np.ndarray, settings: Settings) -> dict:
    """Adam over the windows of a stream of documents, each opened and closed by the end symbol, cut into lanes.

    The state goes on from window to window; gradients stop at the window's edge.
    """
    wide = max(settings.least_lanes, len(stream) // (settings.many_windows * settings.window))
    lanes = max(1, min(settings.lanes, wide, len(stream) // (4 * settings.window)))
    length = -(-(len(stream) - 1) // lanes)
    if length < 2:
        return p
    # The last lane is filled up from the first documents, so no token of the stream is left out.
    stream = np.resize(stream, lanes * length + 1)
    inputs = stream[: lanes * length].reshape(lanes, length).T
    targets = stream[1 : lanes * length + 1].reshape(lanes, length).T
    p = {k: v.copy() for k, v in p.items()}
    mean, square = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    h = np.zeros((lanes, settings.hidden), np.float32)
    count = 0
    total = -(-length // settings.window)
    for at in range(0, length, settings.window):
        _, g, h = gradients(p, inputs[at : at + settings.window], targets[at : at + settings.window], h)
        count += 1
        norm = sum(float(np.vdot(v, v)) for v in g.values()) ** 0.5
        scale = min(1.0, 1.0 / (norm + 1e-9))
        rate = settings.rate * (1 - 0.8 * count / total) / (1 - 0.9**count)
        for k, v in g.items():
            v *= scale
            mean[k] *= 0.9
            mean[k] += 0.1 * v
            v *= v
            v *= 0.005
            square[k] *= 0.995
            square[k] += v
            size = np.sqrt(square[k])
            size *= (1 - 0.995**count) ** -0.5
            size += 1e-8
            np.divide(mean[k], size, out=size)
            size *= rate
            p[k] -= size
    return p


# --- Spark: training and scoring


@dataclass
class Encoded:
    """Words of some texts, an end after each text. Arrays ``of_word`` have a row for each distinct word and one, the
    last, for the end."""

    words: pa.Array  # distinct words
    place: np.ndarray  # of_word: place in the head, or -1
    symbol: np.ndarray  # of_word: input and output symbol
    at: np.ndarray  # distinct word of each token
    starts: np.ndarray  # first token of each text


def encode(known: Lexicon, texts: pa.Array) -> Encoded:
    """Texts as tokens; each distinct word is looked up once."""
    found, at, sizes = cut_words(texts)
    each = [*listed(found), END]
    place = np.fromiter(map(known.head.get, each, repeat(-1)), np.int64, len(each))
    symbol = known.symbol[place]
    lost, classes = np.flatnonzero(place < 0).tolist(), known.settings.rare_classes
    symbol[lost] = [rare_class(each[i], classes) for i in lost]
    symbol[lost] += known.common
    ends = sizes.cumsum() + np.arange(len(sizes))
    tokens = np.full(len(at) + len(sizes), len(found), np.int32)
    inside = np.ones(len(tokens), bool)
    inside[ends] = False
    tokens[inside] = at
    return Encoded(found, place, symbol, tokens, np.r_[0, ends[:-1] + 1] if len(ends) else ends)


def _pack(p: dict) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def _unpack(flat: np.ndarray, like: dict) -> dict:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _average(rows: DataFrame, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = None, 0
        for batch in batches:
            for w, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(data, np.float32) * np.float64(w)
                total, weight = part if total is None else total + part, weight + w
        if weight:
            yield pa.record_batch([pa.array([weight], pa.int64()), pa.array([(total / weight).astype(np.float32).tobytes()], pa.binary())], ["tokens", "p"])

    return rows.repartition(parts).mapInArrow(run, "tokens bigint, p binary")


def train(texts: DataFrame, known: Lexicon) -> dict[str, np.ndarray]:
    """Parameters learned from the columns doc_id and text of the training documents by replicas, whose number grows
    with the tokens."""
    s = known.settings
    p = first_parameters(known)
    sample = texts.select("doc_id", "text")
    sc = texts.sparkSession.sparkContext
    replicas = max(1, round(known.tokens / s.turns / s.replica_tokens))
    shared = sc.broadcast(known)
    for turn in range(s.turns):
        now = sc.broadcast(p)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lex = shared.value
            parts = [np.zeros(1, np.int32)]
            for batch in batches:
                for part in slices(batch.column(0), SLICE_BYTES // 4):
                    coded = encode(lex, part)
                    parts.append(coded.symbol[coded.at])
            stream = np.concatenate(parts)
            if len(parts) > 1:
                flat = _pack(train_stream(now.value, stream, lex.settings))
                yield pa.record_batch([pa.array([len(stream)], pa.int64()), pa.array([flat.tobytes()], pa.binary())], ["tokens", "p"])

        turn_of = F.pmod(F.xxhash64("doc_id", "text", F.lit(s.seed + 1)), F.lit(s.turns))
        mine = sample.where(turn_of == turn).select("text")
        rows = mine.repartition(replicas).mapInArrow(run, "tokens bigint, p binary")
        parts = replicas
        while parts > 16:
            parts = -(-parts // 16)
            rows = _average(rows, parts)
        found = _average(rows, 1).collect()
        if found:
            p = _unpack(np.frombuffer(found[0]["p"], np.float32), p)
    return p


def _lanes(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents dealt to at most ``most`` lanes, long ones first and each to the shortest lane: the documents lane
    by lane, longest lane first, and the number of documents of each lane."""
    fill = [(0, lane) for lane in range(min(most, len(lengths)))]
    heapify(fill)
    lane_of = np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        size, lane = fill[0]
        lane_of[i] = lane
        heapreplace(fill, (size + int(lengths[i]), lane))
    rank = np.empty(len(fill), np.int64)
    rank[[lane for _, lane in sorted(fill, key=lambda x: (-x[0], x[1]))]] = np.arange(len(fill))
    return np.argsort(rank[lane_of], kind="stable"), np.bincount(rank[lane_of], minlength=len(fill))


def sequence_logs(p: dict, documents: list[np.ndarray], settings: Settings) -> np.ndarray:
    """Natural log probability of each list of symbols, end included; states go on to the document's last word.

    Lanes read one document after another, so that they stay busy however the lengths differ.
    """
    out = np.zeros(len(documents))
    if not documents:
        return out
    lengths = np.array([len(d) for d in documents])
    order, held = _lanes(lengths, settings.score_lanes)
    stream = np.concatenate([documents[i] for i in order])
    begins = np.cumsum(lengths[order]) - lengths[order]
    lane_at = np.r_[begins, len(stream)][np.r_[0, held.cumsum()]]
    lane_at, left = lane_at[:-1], np.diff(lane_at)
    n = p["u"].shape[0]
    logs = np.empty(len(stream), p["c"].dtype)
    h, before = np.zeros((len(held), n), np.float32), np.zeros(len(held), np.int32)
    x, u = parts_of(p)
    for at in range(0, int(left[0]), settings.score_window):
        live = int(np.searchsorted(-left, -at, "left"))  # lanes are ordered by length
        wide = min(settings.score_window, int(left[0]) - at)
        seats = np.arange(at, at + wide)[:, None] + lane_at[:live]
        seen = np.arange(at, at + wide)[:, None] < left[:live]
        block = stream.take(seats, mode="clip")
        states = np.empty((wide, live, n), np.float32)
        # Each state comes from the symbol before its target, and a document's first one from the end symbol.
        inputs = np.concatenate([before[None, :live], block[:-1]])
        both, candidate = np.empty((3, live, n), np.float32), np.empty((live, n), np.float32)
        now, opens = h[:live], inputs == 0
        for t, some in enumerate(opens.any(axis=1).tolist()):
            if some:
                now = now.copy()
                now[opens[t]] = 0
            now = _step(x.take(inputs[t], axis=1), u, now, both, candidate, states[t])[0]
        h, before = now, block[-1]
        if seen[-1, -1]:
            logs[seats.ravel()] = log_probability(p, states.reshape(-1, n), block.ravel())
        else:
            logs[seats[seen]] = log_probability(p, states[seen], block[seen])
    out[order] = np.add.reduceat(logs, begins, dtype=np.float64)
    return out


SCORED = (
    "n_tokens bigint, n_known bigint, log_counts double, log_model double, "
    "tail array<struct<word: binary, n: int>>"
)


def _scored(known: Lexicon, p: dict, texts: pa.Array, kind: pa.StructType) -> pa.Array:
    """For each text: tokens, known ones and the sum of log10(c + 1) as far as the head goes, log10 probability but
    for the counts of tail words, and those words."""
    s, coded = known.settings, encode(known, texts)
    tails = kind.field("tail").type
    if not len(texts):
        return pa.array([], kind)
    starts, inside = coded.starts, coded.place >= 0
    logs = np.where(inside, known.log_count[coded.place], 0.0)
    rare = coded.symbol >= known.common
    shares = np.where(rare, logs - known.rare_log[np.where(rare, coded.symbol - known.common, 0)], 0.0)
    symbols = coded.symbol[coded.at]
    sizes = np.diff(starts, append=len(symbols))
    log_model = np.add.reduceat(shares[coded.at], starts)
    log_model += sequence_logs(p, np.split(symbols, starts[1:]), s) / LN10
    # Each tail word of a text once, with its number there.
    lost = np.flatnonzero(~inside[coded.at])
    text_of = np.searchsorted(starts, lost, "right") - 1
    pair, n = np.unique(text_of * len(inside) + coded.at[lost], return_counts=True)
    ends = np.searchsorted(pair, np.arange(len(starts) + 1) * len(inside))
    pairs = pa.StructArray.from_arrays(
        [coded.words.take(pa.array(pair % len(inside))), pa.array(n, pa.int32())], fields=list(tails.value_type)
    )
    columns = [
        pa.array(sizes, pa.int64()),
        pa.array(np.add.reduceat((logs > 0)[coded.at], starts, dtype=np.int64)),
        pa.array(np.add.reduceat(logs[coded.at], starts)),
        pa.array(log_model),
        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs, type=tails),
    ]
    return pa.StructArray.from_arrays(columns, fields=list(kind))


def score_documents(
    df: DataFrame,
    training: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    settings: Settings | None = None,
) -> DataFrame:
    """doc_id, training, n_tokens, n_known, train_tokens, base_score, score: one row for each row of ``df``.

    Counts come from all rows with a true ``training``: words are counted in the tasks, then shuffled with their
    counts. Every task knows the ``head`` most frequent words, so frequent words never meet in a shuffle; the rest
    of a document's words, once for each document, are joined with the counts and added to what the head gave.
    Null texts count as empty and consist of the end. Null ids are ordinary, repeated rows are scored and counted
    as often as they come. Without training rows every count is zero and base scores are 0. An empty frame gives
    an empty frame.
    """
    settings = settings or Settings()
    rows = df.select(quoted(doc_id).alias("doc_id"), F.coalesce(training, F.lit(False)).alias("training"), quoted(text).alias("text"))
    learn = rows.where("training")
    counts = stage(word_counts(learn), "word-counts")
    known = lexicon(counts, settings)
    shared = df.sparkSession.sparkContext.broadcast(known)
    parameters = df.sparkSession.sparkContext.broadcast(train(learn, known))
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import DataType

    kind = to_arrow_type(DataType.fromDDL(SCORED))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for part in slices(batch, 4 * SLICE_BYTES):
                yield _scored(shared.value, parameters.value, part, kind)

    judged = F.arrow_udf(run, SCORED).asNondeterministic()(F.col("text"))
    staged = stage(
        rows.select("doc_id", "training", F.monotonically_increasing_id().alias("seat"), judged.alias("s")).select(
            "doc_id", "training", "seat", "s.*"
        ),
        "lm-scores",
    )
    tail = staged.select("seat", F.inline("tail")).join(counts, "word").groupBy("seat").agg(
        F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("tail_logs"), F.sum("n").alias("tail_known")
    )
    joined = staged.drop("tail").join(tail, "seat", "left").na.fill({"tail_logs": 0.0, "tail_known": 0})
    return joined.select(
        "doc_id",
        "training",
        "n_tokens",
        (F.col("n_known") + F.col("tail_known")).alias("n_known"),
        F.lit(known.tokens).cast("bigint").alias("train_tokens"),
        (F.col("log_counts") + F.col("tail_logs") - F.col("n_tokens") * known.base_log).alias("base_score"),
        (F.col("log_model") + F.col("tail_logs")).alias("score"),
    )
