"""Helpers shared by the corpus operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StructType

from stationflow.storage import reach_workers as reach_workers

WORD_SQL = r"[^\x20\x09-\x0D]+"
# A task turns at most so many bytes of texts into Python objects at a time, or one longer text.
SLICE_BYTES = 16 << 20


def words(data: bytes) -> list[bytes]:
    """Words of a UTF-8 text: what lies between the bytes 20 and 09 to 0D, which is where ``bytes.split`` cuts."""
    return data.split()


def raw_texts(array: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string array."""
    return array.cast(pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary()).to_pylist()


def slices(array: pa.Array, most_bytes: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """``array`` in runs of texts that together hold at most ``most_bytes``, or one longer text each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(array), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(array):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most_bytes, "right")))
        yield array.slice(at, stop - at)
        at = stop


def per_text(
    start: Callable[[], Callable[[bytes | None], object]], returns: StructType | DataType | str, as_bytes: bool = True
) -> Callable[[Column], Column]:
    """A column function that applies ``start()`` to each text, by slices of Arrow batches of bounded size in bytes.

    ``start`` runs once per task and builds what the texts share. Its function gets null for a null text. The
    result counts as non-deterministic so that the optimiser does not evaluate it twice.
    """
    kind = DataType.fromDDL(returns) if isinstance(returns, str) else returns
    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        judge = start()
        for batch in batches:
            if not len(batch):
                yield pa.array([], type=arrow)
            for part in slices(batch):
                texts = raw_texts(part) if as_bytes else part.to_pylist()
                yield pa.array([judge(text) for text in texts], type=arrow)

    return F.arrow_udf(run, kind).asNondeterministic()


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, or ``wish`` with underscores until no column of ``df`` has that name."""
    taken = {name.lower() for name in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def is_plain(text: str, _odd=re.compile("[^\x00-\x1b\x20-\x84\x86-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ]")) -> bool:
    """Whether letters, digits and white space of a text are classed alike by every regular expression library in use."""
    return _odd.search(text) is None
