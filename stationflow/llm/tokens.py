"""Byte-level BPE: token ids of texts, and exact token counts of all their prefixes by dynamic programming."""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache
from operator import sub

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import is_plain, per_text, quoted

# The splitting pattern of the byte-level tokenizer, written for texts that is_plain() accepts, the
# contractions of three characters in it, and the pattern as tiktoken takes it.
PIECE = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
PIECE_TIKTOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_CONTRACTIONS = ("'re", "'ve", "'ll")
INNER_GAP = re.compile(r"[^\S\x1c-\x1f]{2,}(?=[\S\x1c-\x1f])")

CACHE_ENTRIES = 300_000
CACHED_CHARS = 48
PAIR_ENTRIES = 1_000_000
# The fast encoder is used for texts up to this many characters; it gives the same ids as the library.
FAST_CHARS = 1_000_000


def _byte_of_char() -> dict[str, int]:
    """The byte behind each character of the vocabulary file: printable ones stand for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """A byte-level BPE file of the tokenizers library: tokens, merges, special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        table = _byte_of_char()

        def raw(token: str) -> bytes:
            return bytes(table[c] for c in token)

        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in self.specials}
        self.merges: dict[tuple[bytes, bytes], int] = {}
        self.made: dict[bytes, tuple[bytes, bytes, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = map(raw, pair if isinstance(pair, list) else pair.split(" "))
            self.merges[left, right] = rank
            self.made.setdefault(left + right, (left, right, rank))


class PrefixCounter:
    """Exact token counts of every prefix of a text.

    Within a piece of the splitting pattern, byte prefix i has exactly one last token: the token t that ends at i
    and may follow the last token of the prefix before t. So count[i] = count[i - len(t)] + 1, and each position is
    solved once. Two tokens may be neighbours if merging their bytes together would never merge across the border.
    Pieces recur, so their steps are kept; texts are then a lookup per piece and one cumulative sum.
    """

    def __init__(self, path: str):
        import ahocorasick
        from tokenizers import Tokenizer

        self.vocabulary = Vocabulary(path)
        self.split = Tokenizer.from_file(path).pre_tokenizer
        self.tokens = list(self.vocabulary.ids)
        self.endings = ahocorasick.Automaton()
        for number, token in enumerate(self.tokens):
            self.endings.add_word(token.decode("latin-1"), (len(token), number))
        self.endings.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.steps: dict[str, bytes] = {}
        self.spines: dict[tuple[bytes, int], list[tuple[bytes, float]]] = {}
        self.special = re.compile("|".join(map(re.escape, self.vocabulary.specials)) or r"(?!)")

    def _spine(self, token: bytes, side: int) -> list[tuple[bytes, float]]:
        """The symbols at one edge of a token while it is merged, each with the rank of the merge that ends it."""
        found = self.spines.get((token, side))
        if found is None:
            found, symbol, ends = [], token, float("inf")
            while True:
                found.append((symbol, ends))
                if symbol not in self.vocabulary.made or len(symbol) == 1:
                    break
                left, right, ends = self.vocabulary.made[symbol]
                symbol = right if side else left
            self.spines[token, side] = found
        return found

    def may_follow(self, left: bytes, right: bytes) -> bool:
        rank = self.vocabulary.merges.get
        for x, x_ends in self._spine(left, 1):
            for y, y_ends in self._spine(right, 0):
                m = rank((x, y))
                # Equal ranks merge from the left: the border waits for x, and goes before y.
                if m is not None and m < x_ends and m <= y_ends:
                    return False
        return True

    def _learn(self, left: int, right: int) -> bool:
        if len(self.pairs) >= PAIR_ENTRIES:
            self.pairs.clear()
        known = self.pairs[left << 20 | right] = self.may_follow(self.tokens[left], self.tokens[right])
        return known

    def byte_counts(self, piece: bytes) -> list[int]:
        """Token count of every byte prefix of one piece."""
        count, last = [0] * (len(piece) + 1), [-1] * (len(piece) + 1)
        known = self.pairs.get
        for end, (length, token) in self.endings.iter(piece.decode("latin-1")):
            i = end + 1
            if last[i] >= 0:
                continue
            j = i - length
            if j:
                before = last[j]
                ok = known(before << 20 | token)
                if ok is None:
                    ok = self._learn(before, token)
                if not ok:
                    continue
            last[i], count[i] = token, count[j] + 1
        return count

    def _steps(self, piece: str) -> bytes:
        """What each character of a piece adds to the count, as 16-bit integers."""
        data = piece.encode("utf-8", "surrogatepass")
        counts = self.byte_counts(data)
        if len(data) == len(piece):
            at = counts
        else:
            at = [0] + [c for c, b in zip(counts[1:], [*data[1:], 0]) if b & 0xC0 != 0x80]
        if piece in LONG_CONTRACTIONS:
            at[2] = 2
        found = array("h", map(sub, at[1:], at)).tobytes()
        if len(piece) <= CACHED_CHARS:
            if len(self.steps) >= CACHE_ENTRIES:
                self.steps.clear()
            self.steps[piece] = found
        return found

    def pieces(self, text: str) -> list[str]:
        if is_plain(text):
            return PIECE.findall(text)
        return [text[a:b] for _, (a, b) in self.split.pre_tokenize_str(text)]

    def _segment(self, text: str) -> np.ndarray:
        known, solve = self.steps.get, self._steps
        joined = b"".join([known(p) or solve(p) for p in self.pieces(text)])
        counts = np.zeros(len(text) + 1, np.int32)
        np.cumsum(np.frombuffer(joined, np.int16), dtype=np.int32, out=counts[1:])
        # A prefix that ends in white space keeps the whole run as one piece; the full text gives its end away.
        for gap in INNER_GAP.finditer(text):
            a, b = gap.span()
            counts[b] = counts[a] + self.byte_counts(gap.group().encode())[-1]
        return counts

    def prefixes(self, text: str) -> np.ndarray:
        """Counts of the prefixes of 0, 1, ... len(text) code points. Special strings count as one token."""
        if self.special.search(text) is None:
            return self._segment(text)
        out, total, at = [np.zeros(1, np.int32)], 0, 0
        for hit in self.special.finditer(text):
            before = text[at : hit.start()]
            counts = self._segment(before)
            out.append(counts[1:] + total)
            name = hit.group()
            cut = [self._segment(before + name[:k])[-1] + total for k in range(1, len(name))]
            total += int(counts[-1]) + 1
            out.append(np.array([*cut, total], np.int32))
            at = hit.end()
        out.append(self._segment(text[at:])[1:] + total)
        return np.concatenate(out)


@lru_cache(maxsize=2)
def prefix_counter(path: str) -> PrefixCounter:
    """One counter for each Python worker, kept from task to task."""
    return PrefixCounter(path)


def add_prefix_counts(df: DataFrame, path: str, text: str = "text", into: str = "prefix_tokens") -> DataFrame:
    """``df`` with an array of the token count of every prefix of ``text``, from 0 to all its code points.

    Store it once; ``tokens_of_prefix`` and ``longest_prefix`` then answer without encoding again. A null text
    counts as empty: one zero. Rows are independent; an existing column ``into`` is replaced.
    """

    def start():
        counter = prefix_counter(path)
        return lambda value: counter.prefixes(value or "")

    return df.withColumn(into, per_text(start, "array<int>", as_bytes=False)(quoted(text)))


def tokens_of_prefix(prefix_tokens: Column, n_chars: Column | int) -> Column:
    """Tokens of the first ``n_chars`` code points; of the whole text if it is shorter, of none if negative."""
    at = n_chars if isinstance(n_chars, Column) else F.lit(n_chars)
    return F.get(prefix_tokens, F.greatest(F.lit(0), F.least(at, F.size(prefix_tokens) - 1)).cast("int"))


def longest_prefix(prefix_tokens: Column, budget: Column | int) -> Column:
    """Code points of the longest prefix of at most ``budget`` tokens; counts may fall as a text grows."""
    limit = budget if isinstance(budget, Column) else F.lit(budget)
    return F.array_max(F.transform(prefix_tokens, lambda c, i: F.when(c <= limit, i).otherwise(F.lit(0))))


def count_tokens(
    df: DataFrame, path: str, text: str = "text", into: str = "tokens", limit: int = 1024
) -> DataFrame:
    """``df`` with a struct ``into``: n_bytes, n_tokens, over_limit, and fit_chars, the longest prefix within ``limit``.

    All four come from the prefix counts, which stay inside the task: no shuffle, memory of a few times one text.
    Null texts count as empty. Rows are independent; an existing column ``into`` is replaced.
    """

    def start():
        counter = prefix_counter(path)

        def count(data: bytes | None) -> dict:
            data = data or b""
            counts = counter.prefixes(data.decode("utf-8", "replace"))
            n = int(counts[-1])
            fits = len(counts) - 1 if n <= limit else int(np.flatnonzero(counts <= limit)[-1])
            return {"n_bytes": len(data), "n_tokens": n, "over_limit": n > limit, "fit_chars": fits}

        return count

    kind = "n_bytes bigint, n_tokens bigint, over_limit boolean, fit_chars bigint"
    return df.withColumn(into, per_text(start, kind)(quoted(text)))


class Encoder:
    """Token ids as the tokenizers library gives them.

    Ordinary texts go through tiktoken with the same vocabulary, which is several times faster and gives the same
    ids; texts with characters that libraries may class differently, and very long ones, go through the library.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        vocabulary = Vocabulary(path)
        self.library = Tokenizer.from_file(path)
        self.fast = tiktoken.Encoding(
            "byte-bpe",
            pat_str=PIECE_TIKTOKEN,
            mergeable_ranks=vocabulary.ids,
            special_tokens=vocabulary.specials,
        )

    def ids(self, text: str) -> np.ndarray:
        if len(text) <= FAST_CHARS and is_plain(text):
            return self.fast.encode_to_numpy(text, allowed_special="all")
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
