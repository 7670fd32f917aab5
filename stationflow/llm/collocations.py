"""Phrase collocations, counted in depth-truncated suffix subtrees of vertically partitioned word prefixes."""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.common import quoted, raw_texts
from stationflow.storage import broadcast_if_small, stage

# Lower-cases A-Z, turns what ends a piece into the byte FF, which no UTF-8 text holds, and tabs into blanks.
PIECE_END = b".,;:!?\n\x0b\x0c\r"
_MAP = bytes(0xFF if b in PIECE_END else 0x20 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
END = b"\xff"
ID_BITS = 21
NO_WORD = (1 << ID_BITS) - 1
RANK_PARTS = 64


@dataclass(frozen=True)
class Mining:
    """``longest``: words of the longest phrase, two or three. ``least``: occurrences a candidate needs.
    ``swallowed``: percent of a phrase's occurrences inside one longer candidate that drop it.
    ``budget``: suffixes of a group, which one task builds in memory. ``classes``: hash classes of prefixes, whose
    frequencies the driver packs into groups. ``flush``: words a reader numbers before it sends them."""

    longest: int = 3
    least: int = 10
    swallowed: int = 50
    top: int = 2000
    budget: int = 1 << 20
    classes: int = 1 << 16
    flush: int = 1 << 20
    slice_bytes: int = 1 << 22


# ---- words of texts ----------------------------------------------------------------------------------------


def _tokens(data: bytes) -> list[bytes]:
    """Words, and END between pieces."""
    return data.translate(_MAP).replace(END, b" \xff ").split(b" ")


def _slices(data: bytes, most: int) -> Iterator[tuple[bytes, bool]]:
    """A text in slices of about ``most`` bytes that end at a blank, and whether the text ends with it."""
    at = 0
    while len(data) - at > most:
        cut = max(data.rfind(b" ", at, at + most), data.rfind(b"\n", at, at + most))
        if cut <= at:
            found = [x for x in (data.find(b" ", at + most), data.find(b"\n", at + most)) if x >= 0]
            if not found:
                break
            cut = min(found)
        yield data[at:cut], False
        at = cut
    yield data[at:], True


class _Numbered:
    """Words of one language numbered in the order met, and the numbers of a stretch of texts, -1 between pieces."""

    def __init__(self, lang: bytes) -> None:
        self.lang, self.parts, self.words = lang, [], 0
        self.ids: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.ids[END], self.ids[b""]  # 0 and 1

    def add(self, data: bytes) -> None:
        found = _tokens(data)
        codes = np.fromiter(map(self.ids.__getitem__, found), np.int64, len(found))
        codes = codes[codes != 1]
        self.parts.append(codes - 2)
        self.words += len(codes)

    def table(self) -> list[bytes]:
        return list(self.ids)[2:]


def _suffixes(codes: np.ndarray, longest: int, rest: int) -> np.ndarray:
    """Suffixes cut to ``longest`` words as rows of numbers, NO_WORD past the piece's end; ``rest`` starts no more."""
    n = len(codes) - rest
    padded = np.r_[codes, np.full(longest, -1 - 1, np.int64)]
    columns, open_ = [codes[:n]], codes[:n] >= 0
    for k in range(1, longest):
        following = padded[k : k + n]
        open_ = open_ & (following >= 0)
        columns.append(np.where(open_, following, NO_WORD))
    return np.stack(columns, 1)[codes[:n] >= 0]


def _stretches(batches: Iterator[pa.RecordBatch], mining: Mining) -> Iterator[tuple[bytes, list[bytes], np.ndarray, np.ndarray]]:
    """Over batches of (lang, text): language, words, unique suffixes cut to ``longest``, their counts.

    Long texts go through in slices; the last words of a slice are read again with the next one.
    """
    state: dict[bytes, _Numbered] = {}
    ready: dict[bytes, list[np.ndarray]] = defaultdict(list)

    def settle(lang: bytes, whole: bool) -> None:
        now = state[lang]
        codes = np.concatenate(now.parts) if now.parts else np.empty(0, np.int64)
        # END is -2 in a stretch of one language; a text's end is one too.
        rest = 0 if whole else min(len(codes), mining.longest - 1)
        if len(codes):
            ready[lang].append(_suffixes(codes, mining.longest, rest))
        now.parts = [codes[len(codes) - rest :]] if rest else []

    def flush(lang: bytes) -> tuple[bytes, list[bytes], np.ndarray, np.ndarray]:
        settle(lang, True)
        found, now = ready.pop(lang, []), state.pop(lang)
        rows = np.concatenate(found) if found else np.empty((0, mining.longest), np.int64)
        packed = rows[:, 0]
        for k in range(1, mining.longest):
            packed = packed << ID_BITS | rows[:, k]
        packed, counts = np.unique(packed, return_counts=True)
        columns = [packed >> (ID_BITS * (mining.longest - 1 - k)) & NO_WORD for k in range(mining.longest)]
        return lang, now.table(), np.stack(columns, 1), counts

    def add(lang: bytes, data: bytes) -> Iterator[tuple]:
        for part, ends in _slices(data, mining.slice_bytes):
            if lang not in state:
                state[lang] = _Numbered(lang)
            now = state[lang]
            now.add(part)
            settle(lang, ends)
            if ends and (now.words >= mining.flush or len(now.ids) >= NO_WORD // 2):
                yield flush(lang)
            elif not ends and now.words >= mining.flush:
                # Inside a text: what is open goes along to the next stretch as words.
                kept = [now.table()[c] if c >= 0 else END for c in np.concatenate(now.parts or [np.empty(0, np.int64)])]
                now.parts = []
                yield flush(lang)
                state[lang] = _Numbered(lang)
                fresh = state[lang]
                codes = [fresh.ids[w] - 2 for w in kept]
                fresh.parts = [np.array(codes, np.int64)]

    for batch in batches:
        langs = raw_texts(batch.column(0))
        grouped: dict[bytes, list[bytes]] = defaultdict(list)
        held: dict[bytes, int] = defaultdict(int)
        for lang, text in zip(langs, batch.column(1)):
            data = text.as_buffer() if text.is_valid else None
            if data is None or not len(data):
                continue
            name = b"und" if lang is None else lang
            if len(data) >= mining.slice_bytes:
                yield from add(name, data.to_pybytes())
                continue
            grouped[name].append(data.to_pybytes())
            held[name] += len(data)
            if held[name] >= mining.slice_bytes:
                held.pop(name)
                yield from add(name, b"\n".join(grouped.pop(name)))
        for name, texts in grouped.items():
            yield from add(name, b"\n".join(texts))
    for lang in list(state):
        yield flush(lang)


# ---- prefixes and groups -----------------------------------------------------------------------------------


def _word_hashes(lang: bytes, table: list[bytes]) -> np.ndarray:
    seed = zlib.crc32(lang)
    return np.array([zlib.crc32(w, seed) for w in table] + [0x5BD1E995], np.uint64)


def _classes(hashes: np.ndarray, rows: np.ndarray, depth: int, classes: int) -> np.ndarray:
    """Hash class of the first ``depth`` words of each suffix."""
    at = np.where(rows == NO_WORD, len(hashes) - 1, rows)
    mixed = np.zeros(len(rows), np.uint64)
    for k in range(depth):
        mixed = (mixed ^ hashes[at[:, k]]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed >> np.uint64(24)).astype(np.int64) % classes


def _depth_of(hashes: np.ndarray, rows: np.ndarray, over: list[np.ndarray], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Length of the prefix that places each suffix, and its class: longer while the class is over the budget."""
    depth, name = np.ones(len(rows), np.int64), _classes(hashes, rows, 1, classes)
    for k, full in enumerate(over, 1):
        more = (depth == k) & full[name]
        depth[more] = k + 1
        name = np.where(more, _classes(hashes, rows, k + 1, classes), name)
    return depth, name


def prefix_frequencies(texts: DataFrame, mining: Mining) -> tuple[list[np.ndarray], DataFrame]:
    """Suffixes by class of their prefix, for prefixes of one word, of two where one is over the budget, and so on;
    and (lang, n), the words of each language.

    Each length is one pass. The driver gets ``classes`` numbers a pass, whatever the corpus.
    """
    found: list[np.ndarray] = []
    over: list[np.ndarray] = []
    totals = None
    for depth in range(1, mining.longest + 1):

        def tally(batches: Iterator[pa.RecordBatch], depth=depth, over=tuple(over)) -> Iterator[pa.RecordBatch]:
            total, words = np.zeros(mining.classes, np.int64), defaultdict(int)
            for lang, table, rows, counts in _stretches(batches, mining):
                words[lang.decode()] += int(counts.sum())
                hashes = _word_hashes(lang, table)
                at, name = _depth_of(hashes, rows, list(over), mining.classes)
                here = at == depth
                total += np.bincount(name[here], counts[here], mining.classes).astype(np.int64)
            some = np.flatnonzero(total)
            names = pa.array([None] * len(some) + list(words), pa.string())
            places = pa.array(np.r_[some, np.full(len(words), -1, np.int64)])
            numbers = pa.array(np.r_[total[some], np.array(list(words.values()), np.int64)])
            yield pa.record_batch([names, places, numbers], ["lang", "name", "n"])

        rows = texts.mapInArrow(tally, "lang string, name bigint, n bigint")
        rows = stage(rows.groupBy("lang", "name").agg(F.sum("n").alias("n")), "frequencies")
        if totals is None:
            totals = rows.where("name < 0").select("lang", "n")
        total = np.zeros(mining.classes, np.int64)
        for row in rows.where("name >= 0").toLocalIterator():
            total[row["name"]] = row["n"]
        found.append(total)
        if not (total > mining.budget).any():
            break
        over.append(total > mining.budget)
    return found, totals


def packed_groups(frequencies: list[np.ndarray], mining: Mining) -> tuple[list[np.ndarray], int]:
    """Group of each class of each prefix length, -1 where it goes by longer prefixes; groups within the budget.

    First fit in descending order over the open groups. Classes of full-length prefixes that are over the budget by
    themselves are groups of their own; their suffixes are few different ones or many of a hash class.
    """
    groups, n = [], 0
    for depth, total in enumerate(frequencies, 1):
        group = np.full(len(total), -1, np.int64)
        last = depth == mining.longest
        some = np.flatnonzero((total > 0) & ((total <= mining.budget) | last))
        left: list[list[int]] = []
        for name in some[np.argsort(-total[some], kind="stable")]:
            place = next((g for g in left if g[1] >= total[name]), None)
            if place is None:
                place = [n, max(mining.budget, int(total[name]))]
                n += 1
                left.append(place)
            place[1] -= int(total[name])
            group[name] = place[0]
            if place[1] < mining.budget // 1000:
                left.remove(place)
        groups.append(group)
    return groups, n


# ---- subtrees ----------------------------------------------------------------------------------------------


def _blocks(groups: list[np.ndarray], over: list[np.ndarray], mining: Mining):
    """Per stretch and group: prefix length, words in use, suffixes and counts, as one compressed row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, table, rows, counts in _stretches(batches, mining):
            if not len(rows):
                continue
            depth, name = _depth_of(_word_hashes(lang, table), rows, over, mining.classes)
            group = np.empty(len(rows), np.int64)
            for k, of in enumerate(groups, 1):
                group[depth == k] = of[name[depth == k]]
            order = np.lexsort((depth, group))
            rows, counts, depth, group = rows[order], counts[order], depth[order], group[order]
            edges = np.flatnonzero(np.r_[True, (np.diff(group) != 0) | (np.diff(depth) != 0), True])
            words = np.array(table, object)
            for a, b in zip(edges[:-1], edges[1:]):
                used, codes = np.unique(rows[a:b], return_inverse=True)
                known = used[used != NO_WORD]
                codes = codes.reshape(rows[a:b].shape).astype("<i4")
                payload = b"\x20".join(words[known].tolist())
                body = codes.T.tobytes() + counts[a:b].astype("<i8").tobytes()
                yield pa.record_batch(
                    [
                        pa.array([int(group[a])], pa.int64()),
                        pa.array([lang], pa.binary()),
                        pa.array([int(depth[a])], pa.int32()),
                        pa.array([int(b - a)], pa.int64()),
                        pa.array([zlib.compress(payload, 1)], pa.binary()),
                        pa.array([zlib.compress(body, 1)], pa.binary()),
                    ],
                    ["grp", "lang", "depth", "n", "words", "body"],
                )

    return run


class _Subtree:
    """Suffixes of one group, language and prefix length: numbers of the group's words, merged as they come."""

    def __init__(self, longest: int) -> None:
        self.longest, self.packed, self.counts, self.size = longest, [], [], 0
        self.ids: defaultdict[bytes, int] = defaultdict(count().__next__)

    def add(self, n: int, words: bytes, body: bytes) -> None:
        table = zlib.decompress(words).split(b"\x20")
        ids = np.fromiter(map(self.ids.__getitem__, table), np.int64, len(table))
        ids = np.r_[ids, -1]  # the number past the words stands for the end of a piece
        raw = zlib.decompress(body)
        codes = np.frombuffer(raw, "<i4", n * self.longest).reshape(self.longest, n)
        self.packed.append(ids[codes].astype(np.int32).T)
        self.counts.append(np.frombuffer(raw, "<i8", n, n * self.longest * 4))
        self.size += n
        if self.size > 1 << 21 and len(self.packed) > 8:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        """Leaves in order of their numbers, equal ones added up."""
        rows, counts = np.concatenate(self.packed), np.concatenate(self.counts)
        order = np.lexsort(rows.T[::-1])
        rows, counts = rows[order], counts[order]
        edge = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)])
        rows, counts = rows[edge], np.add.reduceat(counts, edge)
        self.packed, self.counts, self.size = [rows], [counts], 0
        return rows, counts

    def nodes(self, depth: int, least: int) -> Iterator[tuple[list[bytes], np.ndarray]]:
        """Phrases and counts of the nodes, from the totals of the leaves below each.

        Nodes below the prefix are whole here, so rare ones go. Those above it are parts, and all of them count.
        """
        rows, counts = self.merge()
        words = np.array(list(self.ids), object)
        differ = np.zeros(len(rows), bool)
        differ[0] = True
        for k in range(self.longest):
            differ[1:] |= rows[1:, k] != rows[:-1, k]
            edge = np.flatnonzero(differ)
            total = np.add.reduceat(counts, edge)
            good = rows[edge, k] >= 0
            if k + 1 >= depth:
                good &= total >= least
            edge, total = edge[good], total[good]
            parts = [words[rows[edge, j]] for j in range(k + 1)]
            yield [b" ".join(x) for x in zip(*parts)], total


def _grown(mining: Mining):
    """Over blocks sorted by (grp, lang, depth): rows (lang, words, phrase, f) of the nodes of each subtree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tree = None, None

        def out() -> Iterator[pa.RecordBatch]:
            for k, (phrases, total) in enumerate(tree.nodes(now[2], mining.least), 1):
                for at in range(0, len(phrases), 1 << 16):
                    part = phrases[at : at + (1 << 16)]
                    yield pa.record_batch(
                        [
                            pa.array([now[1]] * len(part), pa.binary()).cast(pa.string()),
                            pa.array([k] * len(part), pa.int32()),
                            pa.array(part, pa.binary()).cast(pa.string()),
                            pa.array(total[at : at + (1 << 16)]),
                        ],
                        ["lang", "words", "phrase", "f"],
                    )

        for batch in batches:
            for at in range(batch.num_rows):
                grp, lang, depth, n, words, body = (batch.column(k)[at].as_py() for k in range(6))
                if (grp, lang, depth) != now:
                    if now is not None:
                        yield from out()
                    now, tree = (grp, lang, depth), _Subtree(mining.longest)
                tree.add(n, words, body)
        if now is not None:
            yield from out()

    return run


def frequent_phrases(df: DataFrame, text: str, lang: str, mining: Mining) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, f) of all phrases of up to ``longest`` words that come ``least`` times, and (lang, n)."""
    texts = df.select(quoted(lang).cast("string").alias("lang"), quoted(text).alias("text"))
    frequencies, totals = prefix_frequencies(texts, mining)
    groups, n = packed_groups(frequencies, mining)
    over = [total > mining.budget for total in frequencies[: mining.longest - 1]]
    over = over[: len(groups) - 1]
    spark = df.sparkSession
    sent = texts.mapInArrow(
        _blocks(groups, over, mining), "grp bigint, lang binary, depth int, n bigint, words binary, body binary"
    )
    width = max(n, int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = sent.repartition(min(width, max(1, n)), "grp").sortWithinPartitions("grp", "lang", "depth")
    nodes = blocks.mapInArrow(_grown(mining), "lang string, words int, phrase string, f bigint")
    nodes = stage(nodes, "nodes")
    # Nodes above a longer prefix come in parts, one from each group.
    nodes = nodes.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= mining.least)
    return stage(nodes, "phrases"), totals


# ---- collocations ------------------------------------------------------------------------------------------


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", mining: Mining | None = None) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score.

    Phrases are runs of two to ``longest`` words within pieces of a text. Null texts are empty, a null language is
    ``und``, repeated rows count repeatedly, other columns are not used whatever their names; without candidates
    there are no rows. All counts cover every text whole.

    Every suffix of a piece, cut to ``longest`` words, goes to the group of its prefix: prefixes are counted by hash
    class, classes are packed into groups of ``budget`` suffixes, and a class over the budget goes by prefixes of one
    word more, so a word that holds a third of the text is spread. A group is built by one task into a subtree in
    sorted array form, independently of the others; the count of a node is the total of its leaves.
    """
    mining = mining or Mining()
    phrases, totals = frequent_phrases(df, text, lang, mining)
    cut = F.split("phrase", " ")
    pairs = phrases.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"))
    cuts = pairs.withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
    cuts = cuts.withColumns(
        {
            "first": F.array_join(F.slice(cut, F.lit(1), F.col("k")), " "),
            "rest": F.array_join(F.slice(cut, F.col("k") + 1, F.col("words")), " "),
        }
    )
    parts = phrases.where(F.col("words") < mining.longest).select("lang", "phrase", "f")
    parts = broadcast_if_small(parts)
    cuts = cuts.join(parts.toDF("lang", "first", "l"), ["lang", "first"]).join(parts.toDF("lang", "rest", "r"), ["lang", "rest"])
    wide = {c: F.col(c).cast("decimal(19,0)") for c in "alr"}
    score = F.expr("1000000BD * a_ * a_ div (l_ * r_)")
    cuts = cuts.withColumns({f"{c}_": x for c, x in wide.items()}).withColumn("score", score)
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    scored = cuts.groupBy("lang", "words", "phrase", "a").agg(best).select("lang", "words", "phrase", "a", "best.*")

    inner = F.expr("flatten(transform(sequence(2, words - 1), s -> transform(sequence(1, words - s + 1), i -> array_join(slice(split(phrase, ' '), i, s), ' '))))")
    longer = pairs.where("words > 2").select("lang", F.explode(inner).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("inside"))
    kept = scored.join(longer, ["lang", "phrase"], "left")
    share = F.col("inside").cast("decimal(19,0)") * 100 >= F.col("a").cast("decimal(19,0)") * mining.swallowed
    kept = kept.where(F.col("inside").isNull() | ~share)

    # The best of a language are among the best of its parts, so no task orders all phrases of a language.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    parted = Window.partitionBy("lang", part).orderBy(*order)
    kept = kept.withColumn("rank", F.row_number().over(parted)).where(F.col("rank") <= mining.top)
    whole = Window.partitionBy("lang").orderBy(*order)
    ranked = kept.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= mining.top)
    ranked = ranked.join(broadcast_if_small(totals), "lang")
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score"))
