"""Words of many texts at a time: where they lie and a 64-bit hash of each, in numpy.

A word is a run of bytes other than space and tab to carriage return. Hashes only bring equal
things together (with a chance of 2^-64 that two different ones meet); they never decide
alone that two passages are equal.
"""

import numpy as np

_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTES = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(h):
    """Spreads the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(n, base=_STEP):
    """base^0 .. base^(n-1) modulo 2^64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


class Words:
    """Words of several texts: `starts` and `ends` in `data`, `owner` text of each, `first`
    word of each text (one more entry than texts), and `hashes`."""

    def __init__(self, texts, lower=False):
        encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.data = b"\n".join(encoded) + b"\n"
        raw = np.frombuffer(self.data, dtype=np.uint8)
        if lower:
            raw = _LOWER[raw]
        space = _SPACE[raw]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            edge = np.concatenate([[0], edge])
        self.starts, self.ends = edge[0::2], edge[1::2]
        bounds = np.cumsum([0] + [len(e) + 1 for e in encoded])
        self.first = np.searchsorted(self.starts, bounds)
        self.owner = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.hashes = self._hashes(raw, space)

    def _hashes(self, raw, space):
        sizes = self.ends - self.starts
        if not len(sizes):
            return np.zeros(0, dtype=np.uint64)
        before = np.cumsum(sizes) - sizes
        place = np.arange(sizes.sum()) - np.repeat(before, sizes)
        values = _BYTES[raw[~space]] * powers(int(sizes.max()))[place]
        return mixed(np.add.reduceat(values, before) + sizes.astype(np.uint64))

    def runs(self, size):
        """Hash of the `size` words from each word on, and whether they lie in one text."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
        total = np.zeros(n, dtype=np.uint64)
        for i, p in enumerate(powers(size)):
            total += self.hashes[i:i + n] * p
        return mixed(total), self.owner[:n] == self.owner[size - 1:]

    def text(self, a, b):
        """Words a..b-1 joined by one space."""
        return b" ".join(self.data[s:e] for s, e in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist()))
