"""A character n-gram model with modified Kneser-Ney smoothing.

A code point below U+0800 (the Latin, Greek, Cyrillic, Hebrew and Arabic
scripts among others) stands for itself, those above share 2,048 numbers by a
hash; so an n-gram of order 4 is a 48-bit number, and a model holds as many
as the corpus has. Spark counts the n-grams of the highest order (see
``quality``); everything below them are continuation counts, which follow
from the list of distinct n-grams.

The finished model of a language is a set of arrays sorted by hash, one set
per order: hash of the n-gram, log probability, and for contexts the log
back-off weight. Lookups are binary searches.
"""

from __future__ import annotations

import numpy as np

ORDER, BITS = 4, 12
OWN = 1 << BITS - 1                 # code points below stand for themselves
BOUNDARY = 0
_MASKS = [np.uint64((1 << BITS * k) - 1) for k in range(ORDER + 1)]
_HASH = np.uint64(0x9E3779B97F4A7C15)   # odd: multiplying by it is one-to-one on 64 bits
_STEP = np.uint64(BITS)
CACHE_BITS = 20                     # remembered n-grams of a scorer


def characters(text: str) -> np.ndarray:
    """The numbers of a text's characters; none is the boundary's."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    shared = OWN + (cp * np.uint32(0x9E3779B1) >> np.uint32(8)) % np.uint32(OWN)
    return np.where(cp < OWN, np.maximum(cp, 1), shared).astype(np.uint64)


def grams(text: str) -> np.ndarray:
    """The n-grams of a text, one for each character and one for its end;
    ORDER - 1 boundaries stand before it."""
    own = characters(text)
    c = np.full(len(own) + ORDER, BOUNDARY, np.uint64)
    c[ORDER - 1:-1] = own
    g = c[ORDER - 1:].copy()
    for k in range(1, ORDER):
        g |= c[ORDER - 1 - k:len(c) - k] << np.uint64(BITS * k)
    return g


def merge_counts(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum the counts of equal codes; codes come out ascending."""
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.empty(0, int)
    return codes[first], np.add.reduceat(counts, first) if len(codes) else counts


def _discounts(counts: np.ndarray) -> np.ndarray:
    """D1, D2, D3+ from the counts of counts; where a count of counts is
    missing (tiny corpora), the usual 0.5, 1 and 1.5."""
    n = [float((counts == k).sum()) for k in (1, 2, 3, 4)]
    if min(n) <= 0:
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n[0] / (n[0] + 2 * n[1])
    d = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return np.array([0.0, *(min(max(x, 0.05), k) for k, x in zip((1, 2, 3), d))])


def _grouped(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    return codes[first], first


class Model:
    """One language: for each order the sorted hashes, their log
    probabilities, and of each context the log back-off weight."""

    def __init__(self, orders: list[tuple[np.ndarray, np.ndarray]], contexts: list[tuple[np.ndarray, np.ndarray]]):
        self.orders, self.contexts = orders, contexts

    @classmethod
    def fit(cls, codes: np.ndarray, counts: np.ndarray) -> "Model":
        """From the counts of the highest order (codes ascending)."""
        levels = [(codes.astype(np.int64), counts.astype(np.float64))]
        for k in range(ORDER - 1, 0, -1):                   # continuation counts of order k
            suffix = np.sort(levels[0][0] & ((1 << BITS * k) - 1))
            types, first = _grouped(suffix)
            levels.insert(0, (types, np.diff(np.append(first, len(suffix))).astype(np.float64)))
        below = np.full(1, 2.0 ** -BITS)                    # the uniform distribution
        below_codes = np.zeros(1, np.int64)
        orders, contexts = [], []
        for k, (types, n) in enumerate(levels, 1):
            d = _discounts(n)
            cut = d[np.minimum(n, 3).astype(int)]
            context, first = _grouped(types >> BITS)
            total = np.add.reduceat(n, first)
            weight = np.add.reduceat(cut, first) / total
            of = np.repeat(np.arange(len(context)), np.diff(np.append(first, len(types))))
            if k == 1:
                lower = below[0]
            else:
                lower = below[np.searchsorted(below_codes, types & ((1 << BITS * (k - 1)) - 1))]
            p = (n - cut) / total[of] + weight[of] * lower
            orders.append(_by_hash(types, np.log(p)))
            contexts.append(_by_hash(context, np.log(np.maximum(weight, 1e-9))))
            below, below_codes = p, types
        return cls(orders, contexts)

    def log_prob(self, codes: np.ndarray) -> np.ndarray:
        """Log probability of the last character given those before it."""
        out = np.full(len(codes), -BITS * np.log(2.0))
        for k in range(1, ORDER + 1):                       # a longer match overrides, a missing one backs off
            own = codes & _MASKS[k]
            value, found = _find(*self.orders[k - 1], own)
            back, seen = _find(*self.contexts[k - 1], own >> _STEP)
            out = np.where(found, value, out + np.where(seen, back, 0.0))
        return out

    def dump(self) -> list[bytes]:
        return [x.tobytes() for pair in (*self.orders, *self.contexts) for x in pair]

    @classmethod
    def load(cls, parts: list[bytes]) -> "Model":
        pairs = [(np.frombuffer(parts[i], np.uint64), np.frombuffer(parts[i + 1], np.float32))
                 for i in range(0, len(parts), 2)]
        return cls(pairs[:ORDER], pairs[ORDER:])


def _by_hash(codes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = codes.astype(np.uint64) * _HASH
    order = np.argsort(h)
    return h[order], values[order].astype(np.float32)


def _find(hashes: np.ndarray, values: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = codes * _HASH
    at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
    return values[at].astype(np.float64), hashes[at] == h


class Scorer:
    """Mean log probability of texts. Each n-gram has one place by its hash
    in a table of fixed size that remembers the last one looked up there, so
    frequent n-grams are searched once."""

    def __init__(self, model: Model):
        self.model = model
        self.codes = np.full(1 << CACHE_BITS, np.iinfo(np.uint64).max)         # no n-gram
        self.values = np.zeros(1 << CACHE_BITS, np.float32)

    def log_prob(self, codes: np.ndarray) -> np.ndarray:
        place = (codes * _HASH >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
        out = self.values[place]
        missing = np.flatnonzero(self.codes[place] != codes)
        if len(missing):
            new, at = np.unique(codes[missing], return_inverse=True)
            value = self.model.log_prob(new).astype(np.float32)
            out[missing] = value[at]
            place = (new * _HASH >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
            self.values[place], self.codes[place] = value, new      # of two with one place the last stays in both
        return out

    def mean_log_prob(self, texts: list[str]) -> np.ndarray:
        parts = [grams(t) for t in texts]
        sizes = np.array([len(p) for p in parts])
        return np.add.reduceat(self.log_prob(np.concatenate(parts)), np.cumsum(sizes) - sizes, dtype=np.float64) / sizes
