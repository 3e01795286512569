"""Words of many texts at once, as arrays: the numpy counterpart of ``common.words``."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on together; a longer text is a chunk of its own.
CHUNK = 1 << 17

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[ord("0") : ord("9") + 1] = True
_IN_WORD[ord("a") : ord("z") + 1] = True
_IN_WORD[128:] = True

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


class _Tables:
    """Powers of the base, grown when a longer chunk comes."""

    up = _powers(_BASE, 1)
    down = _powers(_INVERSE, 1)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_BASE, n), _powers(_INVERSE, n)
        return cls.up[:n], cls.down[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@dataclass
class Words:
    """Words of a chunk of texts; ``first[d]`` to ``first[d + 1]`` are those of the chunk's text ``d``."""

    low: np.ndarray  # lower-cased bytes of all texts
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte after it
    first: np.ndarray
    sums: np.ndarray  # running polynomial over the bytes
    down: np.ndarray
    text_start: np.ndarray  # first byte of each text, and the end

    def hashes(self, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """64-bit hashes of the words, or of the given byte ranges."""
        start = self.start if start is None else start
        end = self.end if end is None else end
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])


Raw = bytes | memoryview


def views(column: pa.Array) -> list[memoryview]:
    """The texts of an Arrow column as the bytes that they are, without a copy; null is empty."""
    if not len(column):
        return []
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].tolist()
    whole = memoryview(data if data is not None else b"")
    out = [whole[a:b] for a, b in zip(at, at[1:])]
    for i in np.flatnonzero(column.is_null().to_numpy(zero_copy_only=False)) if column.null_count else ():
        out[i] = whole[:0]
    return out


def raw(text: str | Raw | None) -> Raw:
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b"" if text is None else text


def chunks(texts: Sequence[str | Raw | None], size: int = CHUNK) -> Iterator[tuple[int, list[Raw]]]:
    """Runs of texts of about ``size`` bytes, with the number of the first; null counts as empty."""
    held: list[Raw] = []
    begun = total = 0
    for i, text in enumerate(texts):
        own = raw(text)
        if held and total + len(own) > size:
            yield begun, held
            begun, held, total = i, [], 0
        held.append(own)
        total += len(own) + 1
    if held:
        yield begun, held


def tokenize(raws: list[Raw]) -> Words:
    low = _LOWER[np.frombuffer(b" " + b" ".join(raws) + b" ", dtype=np.uint8)]
    inside = _IN_WORD[low]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    lengths = np.fromiter((len(own) + 1 for own in raws), dtype=np.int64, count=len(raws))
    text_start = 1 + np.concatenate([[0], np.cumsum(lengths)])
    first = np.searchsorted(start, text_start)
    up, down = _Tables.of(len(low) + 1)
    sums = np.empty(len(low) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[: len(low)], out=sums[1:])
    return Words(low, start, end, first, sums, down, text_start)


def rolling(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words inside a text, and where each text's begin.

    A text with fewer words, but at least one, has one run: all its words.
    """
    n = len(hashes)
    counts = np.diff(first)
    whole = np.zeros(n, dtype=np.uint64)
    for k in range(min(width, n)):
        part = hashes[k:] * np.uint64(pow(_BASE, k + 1, 1 << 64))
        whole[: n - k] += part
    text = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(n) - first[:-1][text]
    keep = place <= np.maximum(counts[text] - width, 0)
    for d in np.flatnonzero((counts > 0) & (counts < width)):
        own = hashes[first[d] : first[d + 1]]
        factors = np.array([pow(_BASE, k + 1, 1 << 64) for k in range(len(own))], dtype=np.uint64)
        whole[first[d]] = (own * factors).sum() ^ np.uint64(counts[d])
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    return mixed(whole[keep]), np.concatenate([[0], np.cumsum(runs)])
