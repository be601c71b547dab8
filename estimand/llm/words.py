"""Words and word hashes of a block of texts, by array operations on the UTF-8 bytes.

Words are runs of bytes other than ``20 09-0D`` (hex); no byte of a multi-byte
character is one of these.  A hash is a polynomial of the bytes modulo 2^64 with
random byte values, taken from prefix sums and mixed.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled together; a longer text is alone in its block.
BLOCK_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rng = np.random.default_rng(20240521)
_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = 0xD1342543DE82EF95 | 1
_STEP2 = 0xA0761D6478BD642F | 1


def mix(x):
    """A bijection of 64-bit words that spreads every bit."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS = {}


def powers(base, n):
    """base^0 .. base^(n-1) and those of the inverse, modulo 2^64; kept in each process."""
    up, down = _POWERS.get(base, (None, None))
    if up is None or len(up) < n:
        size = max(n, 1 << 12)
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
        for x in (up, down):
            x[0] = 1
            np.cumprod(x, out=x)
        _POWERS[base] = up, down
    return up[:n], down[:n]


class Sums:
    """Polynomial hashes of any ranges of a sequence."""

    def __init__(self, values, base):
        n = len(values)
        up, self.down = powers(base, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * up[:n], out=self.sums[1:])

    def of(self, start, end):
        return (self.sums[end] - self.sums[start]) * self.down[start]


class Words:
    """``start``, ``end`` (bytes in ``data``) and ``hash`` of all words; text i has the words ``bounds[i]:bounds[i+1]``."""

    def __init__(self, texts, lower=False):
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        texts = texts.cast(pa.large_string()).fill_null("")
        n = len(texts)
        at = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8) if n else np.zeros(1, np.int64)
        raw = texts.buffers()[2] if n else None
        data = np.frombuffer(raw, np.uint8)[at[0] : at[-1]] if raw is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
        self.texts, self.data = texts, _LOWER[data] if lower else data
        at = at - at[0]
        seen = np.zeros(len(data) + 1, bool)
        seen[:-1] = ~_SPACE[data]
        first = seen.copy()
        first[1:] &= ~seen[:-1]
        last = seen[:-1] & ~seen[1:]
        edge = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]
        first[edge] = seen[edge]
        last[edge - 1] = seen[edge - 1]
        self.start, self.end = np.flatnonzero(first[:-1] if len(data) else first[:0]), np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.start, at)
        self.bytes = Sums(_VALUES[self.data], _BASE)
        self.hash = mix(self.bytes.of(self.start, self.end))

    def __len__(self):
        return len(self.start)

    @property
    def text(self):
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def windows(self, n):
        """Positions of the first words of all runs of n words of one text."""
        left = np.repeat(self.bounds[1:], np.diff(self.bounds)) - np.arange(len(self.start))
        return np.flatnonzero(left >= n)

    def run_hash(self, first, last, step=_STEP):
        """64-bit hashes of the word sequences first..last-1."""
        return mix(Sums(self.hash, step).of(first, last) + (np.asarray(last) - first).astype(np.uint64))

    def shingles(self, n):
        """(text, hash) of every run of n words; of the whole sequence where a text has fewer."""
        first = self.windows(n)
        size = np.diff(self.bounds)
        short = np.flatnonzero((size > 0) & (size < n))
        start = np.concatenate([first, self.bounds[short]])
        end = np.concatenate([first + n, self.bounds[short + 1]])
        text = np.concatenate([self.text[first], short])
        return text, self.run_hash(start, end)

    def joined(self, first, last):
        """The bytes of words first..last-1, one space between neighbours."""
        if last <= first:
            return b""
        out = self.data[self.start[first] : self.end[last - 1]].tobytes()
        if last - first > 1 and ((self.start[first + 1 : last] - self.end[first : last - 1]) > 1).any() or any(c in out for c in b"\t\n\v\f\r"):
            return b" ".join(out.split())
        return out


def blocks(batch, column="text", limit=BLOCK_BYTES):
    """Slices of an Arrow batch with about ``limit`` bytes of text each; a longer text is alone."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    start, held = 0, 0
    for i, n in enumerate(size):
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(size):
        yield batch.slice(start)


STEPS = (_STEP, _STEP2)
