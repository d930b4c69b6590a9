"""Words of Arrow text columns as 64-bit hashes, computed block by block with NumPy.

Everything here works on UTF-8 bytes. The two word classes treat every byte above 0x7F as part of
a word, so that byte positions and code points give the same words.
"""

from __future__ import annotations

import contextlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

BLOCK_BYTES = 1 << 21
_PIECE_BYTES = 1 << 22


def _letters_and_digits() -> np.ndarray:
    table = np.zeros(256, np.uint64)
    for byte in range(256):
        if byte >= 0x80 or chr(byte).isalnum():
            table[byte] = ord(chr(byte).lower()) + 1 if byte < 0x80 else byte + 1
    return table


def _not_space() -> np.ndarray:
    table = np.arange(1, 257, dtype=np.uint64)
    table[[0x20, *range(0x09, 0x0E)]] = 0
    return table


#: Value of a byte within a word, 0 for a byte between words.
LOWER_ALNUM = _letters_and_digits()  # A-Z as a-z, digits, everything beyond ASCII
NOT_SPACE = _not_space()  # everything but space and tab to carriage return

_STEP = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Let Python tasks get Arrow batches of few rows, as the rows hold whole texts."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def shield(df: DataFrame) -> tuple[DataFrame, dict[str, str], dict[str, str]]:
    """``df`` with other names for columns that begin with an underscore, as internal ones do.

    Also the new name of each renamed column and the way back, to be applied to a result that has
    kept the columns.
    """
    new: dict[str, str] = {}
    taken = {c.lower() for c in df.columns}
    for name in df.columns:
        if name.startswith("_"):
            free = "own" + name
            while free.lower() in taken:
                free = "own_" + free
            taken.add(free.lower())
            new[name] = free
    return df.withColumnsRenamed(new), new, {free: name for name, free in new.items()}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``BLOCK_BYTES``: first row, their bytes, the rows' offsets in them.

    A null is an empty text. A row longer than a block is a block of its own.
    """
    wide = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    raw = wide.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(wide):
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(wide))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, table: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (exclusive) and hash of every word, and where each row's words begin.

    The last array has one entry more than there are rows.
    """
    parts = []
    at = 0
    while at < len(data):
        upto = min(at + _PIECE_BYTES, len(data))
        while upto < len(data) and table[data[upto]]:  # a piece ends between two words
            gap = np.flatnonzero(table[data[upto : upto + _PIECE_BYTES]] == 0)
            upto = upto + int(gap[0]) if len(gap) else min(upto + _PIECE_BYTES, len(data))
        inner = offsets[(offsets >= at) & (offsets < upto)] - at
        starts, ends, hashes = _piece(data[at:upto], inner, table)
        parts.append((starts + at, ends + at, hashes))
        at = upto
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    starts, ends, hashes = (np.concatenate(x) for x in zip(*parts))
    return starts, ends, hashes, np.searchsorted(starts, offsets)


def _piece(data: np.ndarray, row_starts: np.ndarray, table: np.ndarray):
    global _POWERS
    value = table[data]
    inside = value > 0
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[row_starts] = False
    starts = np.flatnonzero(inside & ~before)
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[row_starts[row_starts > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    longest = int((ends - starts).max())
    if len(_POWERS) < longest:
        _POWERS = np.cumprod(np.full(longest + 64, _STEP, np.uint64), dtype=np.uint64)
    lengths = ends - starts
    # the bytes of all words, one word after the other, with each byte's place in its word
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    hashes = np.add.reduceat(value[inside] * _POWERS[place], firsts)
    return starts, ends, mix(hashes)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    factor = np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(size):
            total += hashes[k : k + n] * factor
            factor = factor * _STEP
    return mix(total)


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int = 2000) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for the jobs that run inside; then as before."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _crc_steps() -> np.ndarray:
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(0xEDB88320), steps >> 1)
    return steps.astype(np.uint32)


_CRC_STEPS = _crc_steps()
#: Longest word whose CRC is computed beside that of others, a byte of each at a time.
_CRC_BYTES = 64


def crc32_after(
    before: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> np.ndarray:
    """CRC-32 of the bytes whose CRC-32 is ``before`` (0: none), each followed by its word."""
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    register = ~before.astype(np.uint32)[order]
    at, sizes = starts[order], lengths[order]
    long = int(np.searchsorted(-sizes, -_CRC_BYTES, "left"))  # words over _CRC_BYTES come first
    for k in range(long):
        word = data[at[k] : at[k] + sizes[k]].tobytes()
        register[k] = ~np.uint32(zlib.crc32(word, int(~register[k])))
    register_rest, at, sizes = register[long:], at[long:], sizes[long:]
    for place in range(int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -place, "left"))  # words longer than ``place``
        some = register_rest[:n]
        index = (some ^ data[at[:n] + place]) & np.uint32(0xFF)
        register_rest[:n] = _CRC_STEPS[index] ^ (some >> np.uint32(8))
    out = np.empty_like(register)
    out[order] = ~register
    return out


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z as a-z."""
    return data + (((data >= 0x41) & (data <= 0x5A)).astype(np.uint8) << 5)
