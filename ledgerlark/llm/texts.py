"""Byte-level helpers that the text operators use inside their tasks.

Texts travel as UTF-8 bytes.  A task works through blocks of about one
megabyte, so memory does not depend on the size of an Arrow batch, and a very
long text is cut into parts between words.  Word hashes come from one
polynomial prefix hash of a block: a few passes of numpy over the bytes instead
of a Python step for each word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

# Byte classes: 0 space, 1 letters, digits and everything beyond ASCII, 2 other signs.
WORD = np.ones(256, np.uint8)
WORD[list(SPACES)] = 0
RUN = np.full(256, 2, np.uint8)
RUN[list(SPACES)] = 0
RUN[128:] = 1
RUN[[b for b in range(128) if chr(b).isalnum()]] = 1

_VALUE = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ np.uint64(0xA0761D6478BD642F)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; the longest list made so far is kept."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, BLOCK + 4096)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans of a block; equal spans have equal hashes."""
    prefix = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(_VALUE[buffer] * _power(_BASE, len(buffer)), out=prefix[1:])
    raw = (prefix[ends] - prefix[starts]) * _power(_INVERSE, len(buffer) + 1)[starts]
    return mix(raw ^ (ends - starts).astype(np.uint64))


def as_bytes(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column; null is the empty text."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def blocks(sizes: list[int], limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, or of one row."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total + size > limit and i > start:
            yield start, i
            start, total = i, 0
        total += size + 1
    if start < len(sizes):
        yield start, len(sizes)


def spans(buffer: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of one class, class 0 left out."""
    kind = np.zeros(len(buffer) + 2, np.uint8)
    kind[1:-1] = classes[buffer]
    edges = np.flatnonzero(kind[1:] != kind[:-1])
    left = edges[kind[edges + 1] != 0]
    right = edges[kind[edges] != 0]
    return left, right


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text cut after spaces into parts of a block or, for a longer word, more."""
    at = 0
    while len(text) - at > 2 * BLOCK:
        cut = max(text.rfind(bytes([s]), at, at + BLOCK) for s in SPACES)
        if cut < 0:
            later = [c for c in (text.find(bytes([s]), at + BLOCK) for s in SPACES) if c >= 0]
            cut = min(later) if later else len(text) - 1
        yield text[at : cut + 1]
        at = cut + 1
    yield text[at:]


def span_prefixes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """The first ``width`` (at most 7) bytes of each span as a number; shorter spans are numbers of fewer bytes."""
    out = np.zeros(len(starts), np.uint64)
    for i in range(width):
        byte = buffer[np.minimum(starts + i, len(buffer) - 1)].astype(np.uint64)
        out |= np.where(starts + i < ends, byte, np.uint64(0)) << np.uint64(8 * i)
    return out


def signs_apart(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans with each sign of a script without blanks as a span of its own.

    These are Han (also beyond the basic plane), Hiragana, Katakana, Thai, Lao, Myanmar and Khmer, told by the first
    two bytes of a sign.  What stands between two such signs inside a span is a span too.
    """
    lead = np.flatnonzero((buffer >= 0xE0) & (buffer <= 0xF0))
    lead = lead[lead + 1 < len(buffer)]
    first, second = buffer[lead], buffer[lead + 1]
    apart = (first == 0xE3) & (second >= 0x81) | (first >= 0xE4) & (first <= 0xE9)
    apart |= (first == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
    apart |= (first == 0xE1) & ((second >= 0x80) & (second <= 0x82) | (second == 0x9E) | (second == 0x9F))
    apart |= (first == 0xF0) & (second >= 0xA0) & (second <= 0xB3)
    lead = lead[apart]
    if not len(lead):
        return starts, ends
    cuts = np.union1d(lead, lead + np.where(buffer[lead] == 0xF0, 4, 3))
    cuts = np.setdiff1d(cuts, np.concatenate([starts, ends]), assume_unique=False)
    return np.union1d(starts, cuts), np.union1d(ends, cuts)


def word_hashes(
    texts: list[bytes], classes: np.ndarray = WORD, of: Callable = span_hashes, apart: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and the places where each text's words begin (one more than texts).

    ``of`` makes a 64-bit number of each span of a block; with ``apart``, signs of scripts without blanks are words.
    """

    def found_in(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = spans(buffer, classes)
        return signs_apart(buffer, *found) if apart else found

    out, counts = [], np.zeros(len(texts), np.int64)
    for first, last in blocks([len(t) for t in texts]):
        if last - first == 1 and len(texts[first]) > 2 * BLOCK:
            for part in _parts(texts[first]):
                buffer = np.frombuffer(part, np.uint8)
                found = of(buffer, *found_in(buffer))
                counts[first] += len(found)
                out.append(found)
            continue
        buffer = np.frombuffer(b" ".join(texts[first:last]), np.uint8)
        starts, ends = found_in(buffer)
        ends_of = np.cumsum([len(t) + 1 for t in texts[first:last]])
        counts[first:last] = np.diff(np.searchsorted(starts, ends_of), prepend=0)
        out.append(of(buffer, starts, ends))
    places = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(counts, out=places[1:])
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), places


def owners(places: np.ndarray) -> np.ndarray:
    """For every word, the position of its text."""
    return np.repeat(np.arange(len(places) - 1), np.diff(places))


def windows(hashes: np.ndarray, places: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words inside one text, and the position of each window's text."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    joined = hashes[:n].copy()
    for i in range(1, width):
        joined = mix(joined * np.uint64(_BASE) + hashes[i : i + n])
    owner = owners(places)
    inside = owner[:n] == owner[width - 1 :]
    return joined[inside], owner[:n][inside]


def per_text(owner: np.ndarray, n_texts: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(owner, weights=weights, minlength=n_texts)


def batches_of(batch: pa.RecordBatch, column: str = "text", limit: int = BLOCK) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of an Arrow batch of about ``limit`` bytes of text, with their texts."""
    values = as_bytes(batch.column(batch.schema.get_field_index(column)))
    for first, last in blocks([len(v) for v in values], limit):
        yield batch.slice(first, last - first), values[first:last]
