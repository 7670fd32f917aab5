"""Quality rules by compression bands: zstandard ratios of whole texts and of fixed chunks."""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import per_text, quoted, words

SYMBOLS = b"#*$%&|<>"
VERDICT = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, ratio double, n_chunks bigint, bad_chunk_share double, reason string"
)


@dataclass(frozen=True)
class Bands:
    """Limits of compressed by original size.

    ``limits`` holds (least bytes, lowest ratio, highest ratio) by rising length, in half octaves: short texts
    compress badly, long ones well. Below the first length nothing is judged. The lowest ratios are those that
    ``lowest_ratios`` gives for labelled good texts (1 in 200 lies below); the highest ones leave room for noise
    only. Texts of ``chunk_bytes`` and more are also cut into chunks of that size, which ``chunk_band`` judges; what
    is left over at the end is too short for it. A text goes if its own ratio leaves its band, or if more than
    ``chunk_share`` of its chunks do.
    """

    chunk_bytes: int = 1024
    chunk_band: tuple[float, float] = (0.509, 0.70)
    chunk_share: float = 0.5
    level: int = 3
    limits: tuple[tuple[int, float, float], ...] = (
        (64, 0.60, 1.30),
        (128, 0.65, 1.00),
        (182, 0.62, 1.00),
        (256, 0.59, 0.86),
        (363, 0.548, 0.86),
        (512, 0.538, 0.77),
        (725, 0.511, 0.77),
        (1024, 0.493, 0.67),
        (1449, 0.479, 0.67),
        (2048, 0.465, 0.61),
        (2897, 0.451, 0.61),
        (4096, 0.438, 0.60),
        (5793, 0.428, 0.60),
        (8192, 0.423, 0.58),
        (11586, 0.415, 0.58),
        (16384, 0.410, 0.58),
        (23171, 0.400, 0.58),
        (65536, 0.30, 0.58),
    )
    least_words: int = 20
    most_repeated_percent: int = 30


def repeated_words(found: list[bytes], width: int = 8) -> int:
    """Words inside windows of ``width`` (a power of two) words that occur at least twice in the list.

    Windows are named exactly by doubling: equal pairs get equal numbers, then pairs of pairs, and so on.
    """
    n = len(found)
    if n <= width:
        return 0
    seen: dict[bytes, int] = {}
    name = np.fromiter((seen.setdefault(w, len(seen)) for w in found), np.int64, n)
    step = 1
    while step < width:
        joined = name[:-step] * np.int64(n + 1) + name[step:]
        distinct, name, times = np.unique(joined, return_inverse=True, return_counts=True)
        if len(distinct) == len(joined):
            return 0
        step *= 2
    twice = np.flatnonzero(times[name] > 1)
    if not len(twice):
        return 0
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + width, -1)
    return int(np.count_nonzero(np.cumsum(edge)[:n]))


def _ratio(bands: Bands):
    """Compressed by original size of a text that is not empty."""
    press = zstandard.ZstdCompressor(level=bands.level, write_content_size=False, write_checksum=False)
    return lambda data: len(press.compress(data)) / len(data)


def _judge(bands: Bands):
    floors = [limit[0] for limit in bands.limits]
    ratio_of = _ratio(bands)
    low_chunk, high_chunk = bands.chunk_band

    def outside(data: bytes) -> tuple[float, int]:
        """Ratio, and -1 or 1 where it is under or over its band."""
        ratio = ratio_of(data)
        at = bisect.bisect_right(floors, len(data)) - 1
        if at < 0:
            return ratio, 0
        _, low, high = bands.limits[at]
        return ratio, (ratio > high) - (ratio < low)

    def judge(data: bytes | None) -> dict:
        data = data or b""
        found = words(data)
        n = len(found)
        lines = [line for line in data.split(b"\n") if line.strip()]
        repeat = repeated_words(found)
        base = n < bands.least_words or 100 * repeat > bands.most_repeated_percent * n
        ratio, side = outside(data) if data else (None, 0)
        wrong = 0
        chunks = len(data) // bands.chunk_bytes
        for at in range(0, chunks * bands.chunk_bytes, bands.chunk_bytes):
            wrong += not low_chunk <= ratio_of(data[at : at + bands.chunk_bytes]) <= high_chunk
        share = wrong / chunks if chunks else 0.0
        reason = (
            "base"
            if base
            else "repetitive"
            if side < 0
            else "incompressible"
            if side > 0
            else "chunks"
            if share > bands.chunk_share
            else None
        )
        return {
            "n_words": n,
            "word_chars": len(b"".join(found).decode("utf-8", "replace")),
            "n_symbols": sum(map(data.count, SYMBOLS)),
            "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": repeat,
            "base_failed": base,
            "kept": reason is None,
            "ratio": ratio,
            "n_chunks": chunks,
            "bad_chunk_share": share,
            "reason": reason,
        }

    return judge


def judge_quality(df: DataFrame, text: str = "text", into: str = "quality", bands: Bands | None = None) -> DataFrame:
    """``df`` with a struct ``into`` of counts, ratios and the verdict of the compression bands.

    One map over the rows, no shuffle; memory is a few times one text. A null or empty text has no words and fails
    the base rule. Repeated rows and null ids are judged row by row, other columns pass through untouched; an
    existing column ``into`` is replaced. An empty frame gives an empty frame.
    """
    bands = bands or Bands()
    return df.withColumn(into, per_text(lambda: _judge(bands), VERDICT)(quoted(text)))


def lowest_ratios(
    df: DataFrame, good: Column, text: str = "text", below: float = 0.005, bands: Bands | None = None
) -> DataFrame:
    """least_bytes, n, lowest_ratio: under which ratio the share ``below`` of the good texts of each half octave lies.

    This is where the limits of ``Bands`` come from. Texts are those that ``good`` marks, without null and empty ones;
    one shuffle of partial quantiles, at most 64 rows out. An empty frame gives an empty frame.
    """
    bands = bands or Bands()
    kind = "struct<bytes: bigint, ratio: double>"

    def start():
        ratio = _ratio(bands)
        return lambda data: {"bytes": len(data), "ratio": ratio(data)} if data else None

    found = df.where(good).select(per_text(start, kind)(quoted(text)).alias("x")).where("x is not null").select("x.*")
    step = F.floor(2 * F.log2("bytes"))
    return (
        found.groupBy(F.ceil(F.pow(F.lit(2.0), step / 2)).alias("least_bytes"))
        .agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("ratio", below, 10_000).alias("lowest_ratio"))
        .orderBy("least_bytes")
    )
