"""LM scoring: online logistic context mixing over the bytes of a text's tokens.

Tokens are words, lower-cased in A-Z, and one end. A word is coded as its bytes and a space, the end as a line
break, each byte as eight binary decisions. Six predictors look the decision up under a hash of its context: the
place in the word, the one, two, three and four bytes before, and the whole word so far. Their counts are
gathered from every word of every training text; the last predictor has contexts only where a word begins that makes up
``FREQUENT`` of all tokens or more, whose number is bounded, so that its table isn't flooded as a corpus grows. The predictions, in the logistic domain, are
combined by weights that a gate picks (how often the word so far and the last four bytes were seen),
then refined by an adaptive map over the decision and the mixed probability. Weights and map are
learned online from every distinct word of all training texts, with its count: in each of ``EPOCHS`` passes the tasks take
gradient steps over their parts of the vocabulary from the same start, and what they come to is averaged, each gate and
cell by the decisions that a part has there. A token's own count is left out of contexts seen fewer than ``FEW`` times, where it
matters. The contexts of bytes reach back over the words before, through the space between them. Within four bytes only a word's first ``HEAD``
symbols see these, so heads (those symbols after the three bytes before the space) are gathered, learned from and coded apart from the rest of the words:
each head and each word is coded once however often it stands in a group of texts.

Contexts across words come before the bytes (``across``): where the two words before, or else the one before, stood earlier in
the text, the word that followed there last is predicted, and one more binary decision says whether it comes. Two
predictors see it, by the length of the match and by whether both contexts agree and the last prediction held; their rates are counted and
their weights are stepped online along each text as it is scored, from the same start in each, so that a score doesn't depend on
other texts. Only if the prediction fails, or there is none, the word's bytes are coded. A text's score is the sum of its decisions' log probabilities.

The base model needs every token's exact count. Words are summed in each task and travel as packed
blocks; those that make up ``HEAVY`` of all tokens or more (at most 1 / HEAVY words) are broadcast,
the others of each text are looked up by a shuffle to where their counts are. Gathered counts grow
with the corpus; the predictors' tables have a fixed size.

Defined cases: a null or empty text is the end alone; repeated rows are scored each; a null id isn't held
out; without any training text every count is 0; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetscape.llm import tokens as T
from streetscape.llm.graph import written

FOLDS, HELD_OUT = 7, 2
HEAVY = 1e-6
FREQUENT = 2e-6
#: Slots of the set of those contexts, as a power of two.
BEGUN_BITS = 22
#: Sizes of the predictors' tables, as powers of two: place, one to four bytes, word so far.
BITS = (12, 16, 20, 20, 21, 21)
SLOTS = np.array([1 << b for b in BITS])
BASE = np.concatenate([[0], np.cumsum(SLOTS)])
PRIOR, SCALE = 0.15, 256
GATES = 8
#: Passes over the vocabulary, and words of a gradient step: a part's words in ``STEPS`` steps, if that is between the two.
EPOCHS, RATE, STEPS, STEP_WORDS = 2, 0.02, 64, (64, 4096)
FEW = 64
MAP_STEPS, MAP_LIMIT = 24, 8.0
GROUP_TOKENS, PART_BYTES, SLICES = 2_000_000, 12 << 20, 128
#: Words whose cost a task keeps for its next groups of texts.
KEPT_WORDS = 1_000_000
#: Rows in which a pass's sums reach the driver.
FOLDED = 8
#: Start of the online rates (by length of the match; by agreement), what it counts as, decisions of an online step and its rate.
MATCH_RATES = np.array([0.05, 0.2, 0.4, 0.6, 0.75, 0.85, 0.92, 0.96])
AGREE_RATES = np.array([0.05, 0.4, 0.2, 0.3, 0.9, 0.5])
RATE_COUNT, ONLINE_STEP, ONLINE_RATE = 2.0, 16, 0.02
SPACE, END = 0x20, 0x0A
#: Symbols of a word that have bytes of the words before in their contexts.
HEAD = 3
END_HASH = 0x5851F42D4C957F2D
_U = np.uint64
OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double"


# ---- words of a group of texts, each once ----


def grouped(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct values ascending, a place of each, the index of each value among them)."""
    order = np.argsort(h)
    ordered = h[order]
    new = np.append(True, ordered[1:] != ordered[:-1])[: len(h)]
    which = np.empty(len(h), np.int64)
    which[order] = np.cumsum(new) - 1
    return ordered[new], order[new], which


class Words:
    """Distinct words with their counts: hashes, counts, and their bytes one after another."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, h: np.ndarray, count: np.ndarray, raw: np.ndarray, off: np.ndarray) -> None:
        self.parts.append((h, count, raw, off))

    def merged(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hashes ascending, counts, bytes, offsets)."""
        if not self.parts:
            return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(1, np.int64)
        h = np.concatenate([p[0] for p in self.parts])
        count = np.concatenate([p[1] for p in self.parts])
        raw = np.concatenate([p[2] for p in self.parts])
        size = np.concatenate([np.diff(p[3]) for p in self.parts])
        start = np.concatenate([[0], np.cumsum(size)])[:-1]
        distinct, first, which = grouped(h)
        total = np.bincount(which, weights=count, minlength=len(distinct)).astype(np.int64)
        taken, off = take_spans(raw, start[first], start[first] + size[first])
        self.parts = [(distinct, total, taken, off)]
        return self.parts[0]


def take_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the spans one after another, and their offsets."""
    size = ends - starts
    off = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(int(off[-1]), np.uint8)
    lo = 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + T.CHUNK, "right")) - 1)
        a, b = int(off[lo]), int(off[hi])
        out[a:b] = raw[np.arange(a, b) + np.repeat(starts[lo:hi] - off[lo:hi], size[lo:hi])]
        lo = hi
    return out, off


def tokens(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text) of each word, and their spans."""
    starts, ends = T.spans(buf, off)
    return T.hashes(buf, starts, ends, fold=True), T.owners(starts, off), starts, ends


def distinct_words(buf: np.ndarray, h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hashes ascending, index of each word in them, bytes, offsets)."""
    u, first, which = grouped(h)
    raw, at = take_spans(buf, starts[first], ends[first])
    return u, which, T.lower(raw), at


# ---- contexts ----


def _history(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, one: np.ndarray, two: np.ndarray) -> list[np.ndarray]:
    """The three bytes before the space behind words ``one``, the nearest first, over a space into words ``two`` if need be; -1 is no word, 0 no byte. A text begins as if behind a space."""
    low = lambda at, there: np.where(there, T.lower(buf[np.where(there, at, 0)]), 0).astype(np.int64)
    if not len(starts):
        return [np.zeros(len(one), np.int64)] * 3
    size, end = np.where(one >= 0, ends[one] - starts[one], 0), ends[one]
    second = np.where(size == 1, SPACE, low(end - 2, size > 1))
    third = np.where(size == 1, low(ends[two] - 1, two >= 0), np.where(size == 2, SPACE, low(end - 3, size > 2)))
    return [low(end - 1, size > 0), second, third]


def heads(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The heads of all words, and of the ends of ``n`` texts: the bytes before, the first bytes and how many these are, as one number."""
    at = np.arange(len(starts))
    before = lambda k: np.where((at >= k) & (doc[at - k] == doc), at - k, -1)
    size = ends - starts
    first = [np.where(size > k, T.lower(buf[np.minimum(starts + k, len(buf) - 1)]), 0) if len(buf) else np.zeros(0, np.int64) for k in range(HEAD)]
    last, has = np.searchsorted(doc, np.arange(n), "right") - 1, T.counts(doc, n)
    of_words = [*_history(buf, starts, ends, before(1), before(2)), *first, np.minimum(size, HEAD)]
    of_ends = _history(buf, starts, ends, np.where(has > 0, last, -1), np.where(has > 1, last - 1, -1))
    return tuple(sum(c.astype(_U) << _U(8 * k) for k, c in enumerate(columns)) for columns in (of_words, of_ends))


def headed(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, the bytes before as ``decisions`` takes them) of heads."""
    byte = (key[:, None] >> (np.arange(7, dtype=_U) * _U(8))).astype(np.uint8)
    size = byte[:, 6].astype(np.int64)
    raw = byte[:, 3:6][np.arange(HEAD) < size[:, None]]
    before = byte[:, :3].astype(np.int64)
    return raw, np.concatenate([[0], np.cumsum(size)]), before + (before > 0)


def coded(raw: np.ndarray, off: np.ndarray, before: np.ndarray | None, low: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """The ``decisions`` of heads (``before`` is told), or of words from place ``low`` on."""
    sym, contexts, word = decisions(raw, off, before)
    if before is None and not low:
        return sym, contexts, word
    keep = np.flatnonzero(contexts[0] < HEAD if before is not None else contexts[0] >= low)
    return sym[keep], [c[keep] for c in contexts], word[keep]


def decisions(raw: np.ndarray, off: np.ndarray, before: np.ndarray | None = None) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(symbols, the contexts of each, its word) of words, each followed by a space; an empty word is the end. ``before``: of each word
    the three bytes in front of the space before it, the nearest first and each plus one; 0 is none."""
    n = len(off) - 1
    size = np.diff(off)
    total = int(off[-1]) + n
    word = np.repeat(np.arange(n), size + 1)
    start = off[:-1] + np.arange(n)
    place = np.arange(total) - start[word]
    sym = np.empty(total, np.uint8)
    inner = place < size[word]
    sym[inner] = raw
    sym[~inner] = np.where(size == 0, END, SPACE)
    last = [np.zeros(total, np.int64) for _ in range(4)]
    for k in range(4):
        has = np.flatnonzero(place > k)
        last[k][has] = sym[has - k - 1].astype(np.int64) + 1
        last[k][place == k] = SPACE + 1
        for j in range(k if before is not None else 0):
            far = np.flatnonzero(place == k - 1 - j)
            last[k][far] = before[word[far], j]
    # hash of the word so far, for all words side by side
    so_far = np.zeros(total, _U)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + T.CHUNK, "right")) - 1)
        seg = raw[off[lo] : off[hi]]
        T._POWERS.to(len(seg) + 1)
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(T._VALUES[seg] * T._POWERS.up[: len(seg)])])
        a, b = start[lo], start[hi - 1] + size[hi - 1] + 1
        at = off[word[a:b]] - off[lo]
        so_far[a:b] = (sums[at + place[a:b]] - sums[at]) * T._POWERS.down[at]
        lo = hi
    two = last[0] + (last[1] << 9)
    three = two + (last[2] << 18)
    four = three + (last[3] << 27)
    contexts = [np.minimum(place, 15).astype(_U), last[0].astype(_U), *(T.mix(c.astype(_U) + _U(k << 40)) for k, c in enumerate((two, three, four))), T.mix(so_far + place.astype(_U))]
    return sym, contexts, word


def slots(contexts: list[np.ndarray], node: np.ndarray) -> list[np.ndarray]:
    """Index of a decision (``node``: 1 and the byte's bits so far) in each table."""
    wide = node.view(_U)
    out = [(contexts[0] << _U(8) | wide).view(np.int64), ((contexts[1] & _U(255)) << _U(8) | wide).view(np.int64)]
    wide = wide * _U(0x9E3779B97F4A7C15)
    for c, bits in zip(contexts[2:], BITS[2:]):
        x = c ^ wide
        x *= _U(0xBF58476D1CE4E5B9)
        x >>= _U(64 - bits)
        out.append(x.view(np.int64))
    return out


def nodes(sym: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(node, bit) of the eight decisions of each symbol."""
    for k in range(8):
        yield (1 << k) | (sym >> (8 - k)).astype(np.int64) if k else np.ones(len(sym), np.int64), ((sym >> (7 - k)) & 1).astype(bool)


# ---- model ----


class Model:
    """Packed tables (prediction in the logistic domain times ``SCALE``, with the gate's count class in the lowest
    three bits), weights by gate, and the final map."""

    def __init__(self, counts: np.ndarray, begun: np.ndarray) -> None:
        """``counts``: [2, slots] of zeros and ones seen; ``begun``: where frequent words begin."""
        self.begun = begun
        self.table = np.concatenate([pack(counts[0, a : a + T.CHUNK], counts[1, a : a + T.CHUNK]) for a in range(0, counts.shape[1], T.CHUNK)])
        # at first, the word so far where it is known well, else the last bytes
        self.weights = np.tile(np.array([0, 0, 0.1, 0.3, 0.3, 0.3, 0], np.float32), (GATES * GATES, 1))
        self.weights[4 * GATES :] = np.array([0, 0, 0, 0, 0.1, 0.9, 0], np.float32)
        grid = np.linspace(-MAP_LIMIT, MAP_LIMIT, MAP_STEPS + 1)
        self.map = np.tile(grid.astype(np.float32), (256, 1))  # kept in the logistic domain

    def inputs(self, contexts: list[np.ndarray], node: np.ndarray, begun: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        packed = [self.table[BASE[i] : BASE[i + 1]].take(s) for i, s in enumerate(slots(contexts, node))]
        packed[-1] = packed[-1] * begun
        gate = (packed[5] & 7).astype(np.int64) * GATES + (packed[4] & 7)
        return [(p >> 3).astype(np.float32) * np.float32(1 / SCALE) for p in packed], gate

    def mixed(self, inputs: list[np.ndarray], gate: np.ndarray) -> np.ndarray:
        columns = np.ascontiguousarray(self.weights.T)
        total = columns[-1].take(gate)
        for w, x in zip(columns, inputs):
            w = w.take(gate)
            w *= x
            total += w
        return np.clip(total, -MAP_LIMIT + 0.001, MAP_LIMIT - 0.001)

    def refined(self, s: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(final value, lower cell, share of the upper cell): half the mixed value, half the map's."""
        x = (s + np.float32(MAP_LIMIT)) * np.float32(MAP_STEPS / (2 * MAP_LIMIT))
        low = x.astype(np.int64)
        share = x - low
        cell = node * (MAP_STEPS + 1) + low
        flat = self.map.ravel()
        return 0.5 * s + 0.5 * (flat.take(cell) * (1 - share) + flat.take(cell + 1) * share), cell, share

    def cost(self, raw: np.ndarray, off: np.ndarray, before: np.ndarray | None = None, low: int = 0) -> np.ndarray:
        """Natural log probability of each word from place ``low`` on, or of each head."""
        n = len(off) - 1
        out = np.zeros(n)
        lo = 0
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + (1 << 16), "right")) - 1)
            sym, contexts, word = coded(raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], before if before is None else before[lo:hi], low)
            odds = np.ones(len(sym))  # of all decisions: each at most 1 + e^12, so the product stays finite
            begun = self.begun[begins(contexts)]
            for node, bit in nodes(sym):
                s, _, _ = self.refined(self.mixed(*self.inputs(contexts, node, begun)), node)
                np.negative(s, out=s, where=bit)
                odds *= 1 + np.exp(s)
            out[lo:hi] = np.bincount(word, weights=-np.log(odds), minlength=hi - lo)
            lo = hi
        return out

    def train(self, raw: np.ndarray, off: np.ndarray, count: np.ndarray, counts: np.ndarray) -> None:
        """All passes over one part of words with their counts in training."""
        few = scarce(counts)
        for k in range(EPOCHS):
            self.learn(raw, off, count, few, k)

    def learn(self, raw: np.ndarray, off: np.ndarray, count: np.ndarray, few: np.ndarray, epoch: int, before: np.ndarray | None = None, low: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Online steps over words from place ``low`` on, or heads, with their counts in training; returns the decisions seen by gate and by cell of the
        map. ``few``: the tables' counts, up to ``FEW``."""
        rng = np.random.default_rng(5 + epoch)
        n = len(off) - 1
        size = int(np.clip(n // STEPS, *STEP_WORDS))
        steps = max(1, -(-n // size))
        first, second = np.zeros_like(self.weights), np.zeros_like(self.weights)
        by_gate, by_cell = np.zeros(GATES * GATES), np.zeros(self.map.size)
        order = rng.permutation(n)
        for step in range(1, steps + 1):
            pick = np.sort(order[(step - 1) * size : step * size])
            sym, contexts, word = coded(*take_spans(raw, off[pick], off[pick + 1]), before if before is None else before[pick], low)
            times = count[pick][word].astype(np.float32)
            begun = self.begun[begins(contexts)]
            gradient, seen = np.zeros_like(self.weights), np.zeros(GATES * GATES)
            gap, mass = np.zeros(self.map.size), np.zeros(self.map.size)
            for node, bit in nodes(sym):
                packed = []
                for i, s in enumerate(slots(contexts, node)):
                    at = BASE[i] + s
                    p = self.table[at]
                    rare = np.flatnonzero((p & 7) < GATES - 1)
                    if len(rare):
                        zero, one = few[0][at[rare]].astype(np.int64), few[1][at[rare]].astype(np.int64)
                        p[rare] = _SCARCE[np.maximum(zero - ~bit[rare], 0), np.maximum(one - bit[rare], 0)]
                    packed.append(p)
                packed[-1] = packed[-1] * begun
                gate = (packed[5] & 7).astype(np.int64) * GATES + (packed[4] & 7)
                inputs = [(p >> 3).astype(np.float32) * np.float32(1 / SCALE) for p in packed]
                s = self.mixed(inputs, gate)
                error = times * (1 / (1 + np.exp(-s)) - bit)
                seen += np.bincount(gate, weights=times, minlength=len(seen))
                for i, x in enumerate([*inputs, np.ones(len(s), np.float32)]):
                    gradient[:, i] += np.bincount(gate, weights=error * x, minlength=len(seen))
                _, cell, share = self.refined(s, node)
                flat = self.map.ravel()
                for c, weight in ((cell, times * (1 - share)), (cell + 1, times * share)):
                    gap += np.bincount(c, weights=weight * (bit - 1 / (1 + np.exp(-flat[c]))), minlength=len(gap))
                    mass += np.bincount(c, weights=weight, minlength=len(gap))
            gradient /= (seen + 1)[:, None]
            first += 0.1 * (gradient - first)
            second += 0.01 * (gradient**2 - second)
            rate = RATE * (1 - (epoch + step / (steps + 1)) / EPOCHS)
            self.weights -= (rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
            self.map = np.clip(self.map + (2 * gap / (mass + 30)).reshape(self.map.shape), -12, 12).astype(np.float32)
            by_gate += seen
            by_cell += mass
        return by_gate, by_cell


def scarce(counts: np.ndarray) -> np.ndarray:
    """The tables' counts of zeros and ones, up to ``FEW``."""
    return np.stack([np.minimum(c, FEW).astype(np.uint8) for c in counts])


def pack(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
    n = zero + one
    value = np.clip(np.rint((np.log(one + PRIOR) - np.log(zero + PRIOR)) * SCALE), -3000, 3000).astype(np.int16)
    level = np.minimum(np.ceil(np.log2(n + 1)), GATES - 1).astype(np.int16)
    return (value << 3) | level


#: ``pack`` of all counts up to ``FEW``.
_SCARCE = pack(*np.meshgrid(np.arange(FEW + 1.0), np.arange(FEW + 1.0), indexing="ij"))


def begins(contexts: list[np.ndarray]) -> np.ndarray:
    """Slot of the word so far in the set of beginnings."""
    return (contexts[-1] >> _U(64 - BEGUN_BITS)).astype(np.int64)


def gather(raw: np.ndarray, off: np.ndarray, count: np.ndarray, counts: np.ndarray, begun: np.ndarray, before: np.ndarray | None = None, low: int = 0) -> None:
    """Add the decisions of words from place ``low`` on, or of heads, ``count`` times each, to the tables; to the last one those after ``begun`` beginnings."""
    n = len(off) - 1
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + (1 << 18), "right")) - 1)
        sym, contexts, word = coded(raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], before if before is None else before[lo:hi], low)
        times = count[lo:hi][word].astype(np.int64)
        often = np.flatnonzero(begun[begins(contexts)])
        flat, total = counts.reshape(-1), counts.shape[1]
        for node, bit in nodes(sym):
            of_bit = total * bit.astype(np.int64)
            for i, s in enumerate(slots(contexts, node)):
                at = BASE[i] + s + of_bit
                if i == len(BITS) - 1:
                    np.add.at(flat, at[often], times[often])
                else:
                    np.add.at(flat, at, times)
        lo = hi


class Costs:
    """A model's costs of words, or of heads, kept from one group of texts to the next."""

    def __init__(self, model: Model, low: int = 0) -> None:
        self.model, self.low, self.h, self.cost = model, {"low": low} if low else {}, np.zeros(0, _U), np.zeros(0)

    def of(self, h: np.ndarray, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Natural log probability of each word; hashes come ascending."""
        return self._of(h, lambda new: self.model.cost(*take_spans(raw, off[new], off[new + 1]), **self.low))

    def of_heads(self, key: np.ndarray) -> np.ndarray:
        """Natural log probability of each head; they come ascending."""
        return self._of(key, lambda new: self.model.cost(*headed(key[new])))

    def _of(self, h: np.ndarray, cost) -> np.ndarray:
        at = np.searchsorted(self.h, h)
        known = np.append(self.h, _U(0))[at] == h
        known &= at < len(self.h)
        out = np.empty(len(h))
        out[known] = self.cost[at[known]]
        new = np.flatnonzero(~known)
        out[new] = cost(new)
        if len(self.h) + len(new) <= KEPT_WORDS:
            self.h, self.cost = np.insert(self.h, at[new], h[new]), np.insert(self.cost, at[new], out[new])
        elif len(h) <= KEPT_WORDS:
            self.h, self.cost = h, out
        return out


# ---- contexts across words, refined along each text ----


def _sorted_places(key: np.ndarray) -> np.ndarray:
    """Places ordered by the upper bits of a hash, equal ones as they come."""
    bits = _U(max(1, len(key).bit_length()))
    packed = (key >> bits << bits) | np.arange(len(key)).astype(_U)
    packed.sort()
    return (packed & ((_U(1) << bits) - _U(1))).astype(np.int64)


def last_places(key: np.ndarray) -> np.ndarray:
    """The place before each with the same key, or -1."""
    out = np.full(len(key), -1)
    order = _sorted_places(key)
    a, b = order[:-1], order[1:]
    same = key[a] == key[b]
    out[b[same]] = a[same]
    return out


def _rates(own: np.ndarray, kind: np.ndarray, hit: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The rate of hits of each one's kind among those before it in its text, in the logistic domain."""
    key = own * len(start) + kind
    bits = max(1, len(key).bit_length())
    packed = key << bits | np.arange(len(key))
    packed.sort()
    order, key = packed & ((1 << bits) - 1), packed >> bits
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))[: len(key)]
    size = np.diff(np.append(first, len(key)))
    found = hit[order]
    hits = np.cumsum(found) - found
    hits -= np.repeat(hits[first], size)
    before = np.arange(len(key)) - np.repeat(first, size)
    yes = hits + RATE_COUNT * start[key % len(start)]
    out = np.empty(len(key))
    out[order] = np.log(yes / (before + RATE_COUNT - yes))
    return out


def _by_step(step: np.ndarray) -> np.ndarray:
    bits = max(1, len(step).bit_length())
    packed = step << bits | np.arange(len(step))
    packed.sort()
    return packed & ((1 << bits) - 1)


def _online(own: np.ndarray, inputs: np.ndarray, hit: np.ndarray, n: int) -> np.ndarray:
    """Log probability of each decision: the inputs combined by weights that are stepped along each text, ``ONLINE_STEP``
    decisions at a time, all texts side by side."""
    weights = np.tile(np.array([0.5, 0.5, 0.0]), (n, 1))
    out = np.empty(len(own))
    first = np.searchsorted(own, np.arange(n))
    step = (np.arange(len(own)) - first[own]) // ONLINE_STEP
    order = _by_step(step)
    cut = np.append(np.flatnonzero(np.append(True, step[order][1:] != step[order][:-1]))[: len(own)], len(own))
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        at = order[a:b]
        text, x = own[at], inputs[at]
        s = np.clip((weights[text] * x).sum(axis=1), -MAP_LIMIT, MAP_LIMIT)
        out[at] = -np.logaddexp(0, np.where(hit[at], -s, s))
        error = hit[at] - 1 / (1 + np.exp(-s))
        heads = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        weights[text[heads]] += ONLINE_RATE * np.add.reduceat(error[:, None] * x, heads)
    return out


def across(h: np.ndarray, own: np.ndarray, cost: np.ndarray, n: int, end_cost: np.ndarray | float) -> np.ndarray:
    """Natural log probability of each of ``n`` texts, from its words' hashes and the log probabilities of their bytes, and of the texts' ends."""
    size = np.bincount(own, minlength=n)
    ends = np.cumsum(size + 1) - 1
    word, text, alone = np.full(len(h) + n, _U(END_HASH)), np.empty(len(h) + n, np.int64), np.empty(len(h) + n)
    at = np.arange(len(h)) + own
    word[at], text[at], alone[at] = h, own, cost
    text[ends], alone[ends] = np.arange(n), end_cost
    place = np.arange(len(word)) - (ends - size)[text]
    one, two = np.zeros(len(word), _U), np.zeros(len(word), _U)
    one[1:], two[2:] = word[:-1], word[:-2]  # at a text's head the end of the text before, which no word equals
    salt = T.mix(text.astype(_U))
    last = last_places(T.mix(one * _U(0xD6E8FEB86659FD93) + salt))
    last[place < 1] = -1
    far = last_places(T.mix((one * _U(0xD6E8FEB86659FD93) + two) * _U(0xA0761D6478BD642F) + salt))
    far[place < 2] = -1
    where = np.where(far >= 0, far, last)
    hit = (where >= 0) & (word[where] == word)
    goes_on = np.append(False, (far[1:] == far[:-1] + 1) & (far[:-1] >= 0))
    run = np.arange(len(word)) - np.maximum.accumulate(np.where(goes_on, 0, np.arange(len(word))))
    long = np.where(far >= 0, np.minimum(1 + np.log2(run + 1.0), len(MATCH_RATES) - 1), 0).astype(np.int64)
    held = np.append(False, hit[:-1])
    agree = np.where(far < 0, 0, np.where(word[last] == word[far], 1, 2)) + 3 * held
    told = np.flatnonzero(where >= 0)
    seen, of = hit[told], text[told]
    inputs = np.stack([_rates(of, long[told], seen, MATCH_RATES), _rates(of, agree[told], seen, AGREE_RATES), np.ones(len(told))], axis=1)
    decided = _online(of, inputs, seen, n)
    alone[told] = decided + np.where(seen, 0, alone[told])
    return np.bincount(text, weights=alone, minlength=n)


# ---- Spark ----


def _part(h: np.ndarray, parts: int) -> np.ndarray:
    return (((h >> _U(32)) * _U(parts)) >> _U(32)).astype(np.int64)


def held_out(name: str = "doc_id") -> F.Column:
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def _count_words(parts: int):
    """Distinct words of the task's training texts, packed by part: hashes, counts, lengths, bytes. Their heads go with no lengths or bytes
    to parts of their own, from ``parts`` on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, ends = Words(), 0, 0
        first = Words()
        for b in batches:
            ends += b.num_rows
            for _, _, buf, off in T.chunks(b.column("text")):
                h, h_doc, starts, stops = tokens(buf, off)
                u, which, raw, at = distinct_words(buf, h, starts, stops)
                words.add(u, np.bincount(which, minlength=len(u)), raw, at)
                key, times = np.unique(np.concatenate(heads(buf, starts, stops, h_doc, len(off) - 1)), return_counts=True)
                first.add(key, times, np.zeros(0, np.uint8), np.zeros(len(key) + 1, np.int64))
                held += len(u) + len(key)
                if held > 1_000_000:
                    words.merged()
                    first.merged()
                    held = len(words.parts[0][0]) + len(first.parts[0][0])
                    if held > 800_000:
                        yield from rows(words)
                        yield from head_rows(first)
                        words, first, held = Words(), Words(), 0
        words.add(np.array([END_HASH], _U), np.array([ends]), np.zeros(0, np.uint8), np.zeros(2, np.int64))
        yield from rows(words)
        yield from head_rows(first)

    def head_rows(words: Words) -> Iterator[pa.RecordBatch]:
        key, count, _, _ = words.merged()
        part = _part(T.mix(key), parts)
        order = np.argsort(part, kind="stable")
        cut = np.searchsorted(part[order], np.arange(parts + 1))
        for p in range(parts):
            at = order[cut[p] : cut[p + 1]]
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array([parts + p]), *(pa.array([v], pa.binary()) for v in (key[at].tobytes(), count[at].astype("<i8").tobytes(), b"", b""))], names=["part", "h", "n", "size", "raw"])

    def rows(words: Words) -> Iterator[pa.RecordBatch]:
        h, count, raw, off = words.merged()
        part = _part(h, parts)  # ascending, as the hashes are
        cut = np.searchsorted(part, np.arange(parts + 1))
        for p in range(parts):
            a, c = int(cut[p]), int(cut[p + 1])
            if a < c:
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([h[a:c].tobytes()], pa.binary()), pa.array([count[a:c].astype("<i8").tobytes()], pa.binary()), pa.array([np.diff(off[a : c + 1]).astype("<u4").tobytes()], pa.binary()), pa.array([raw[off[a] : off[c]].tobytes()], pa.binary())], names=["part", "h", "n", "size", "raw"])

    return run


_VOCABULARY = "part long, h binary, n binary, size binary, raw binary, words long, tokens long"


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each part and their counts. Rows come by part."""

    def done(part: int, words: Words) -> pa.RecordBatch:
        h, n, raw, off = words.merged()
        columns = [h.tobytes(), n.astype("<i8").tobytes(), b"" if of_heads else np.diff(off).astype("<u4").tobytes(), raw.tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([part]), *(pa.array([c], pa.binary()) for c in columns), pa.array([len(h)]), pa.array([int(n.sum())])], names=[x.split()[0] for x in _VOCABULARY.split(", ")])

    part, words, of_heads = None, Words(), False
    for b in batches:
        for p, *row in zip(*(b.column(k).to_pylist() for k in range(5))):
            if p != part and words.parts:
                yield done(part, words)
                words = Words()
            part, of_heads = p, not row[2]
            words.add(*_unpacked(*row))
    if words.parts:
        yield done(part, words)


def _unpacked(h: bytes, n: bytes, size: bytes, raw: bytes) -> tuple[np.ndarray, ...]:
    off = np.concatenate([[0], np.cumsum(np.frombuffer(size, "<u4").astype(np.int64))]) if size else np.zeros(len(h) // 8 + 1, np.int64)
    return np.frombuffer(h, "<u8"), np.frombuffer(n, "<i8"), np.frombuffer(raw, np.uint8), off


def _units(h: bytes, n: bytes, size: bytes, raw: bytes, low: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict]:
    """(bytes, offsets, counts, what else ``coded`` takes) of a row's words from place ``low`` on, or of its heads."""
    if h and not size:
        raw, off, before = headed(np.frombuffer(h, "<u8"))
        return raw, off, np.frombuffer(n, "<i8"), {"before": before}
    _, n, raw, off = _unpacked(h, n, size, raw)
    return raw, off, n, {"low": low}


def _beginnings(least: float):
    """Slots of all beginnings of the words counted ``least`` times or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in zip(*(b.column(k).to_pylist() for k in ("h", "n", "size", "raw"))):
                h, n, raw, off = _unpacked(*row)
                at = np.flatnonzero(n >= least)
                _, contexts, _ = decisions(*take_spans(raw, off[at], off[at + 1]))
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(begins(contexts)))], names=["slot"])

    return run


def _tables(begun: np.ndarray, low: int):
    """Slices of the tables gathered from the task's parts of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        for b in batches:
            for row in zip(*(b.column(k).to_pylist() for k in ("h", "n", "size", "raw"))):
                if counts is None:
                    counts = np.zeros((2, int(BASE[-1])), np.int64)
                raw, off, n, more = _units(*row, low)
                gather(raw, off, n, counts, begun, **more)
        if counts is not None:
            for k, piece in enumerate(np.array_split(counts.reshape(-1), SLICES)):
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([piece.tobytes()], pa.binary())], names=["part", "n"])

    return run


def _add_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for k, raw in zip(b.column("part").to_pylist(), b.column("n")):
            total[k] = total.get(k, 0) + np.frombuffer(raw.as_buffer(), "<i8")
    for k, v in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([v.tobytes()], pa.binary())], names=["part", "n"])


_SUMS_OF_PASS = "weights binary, map binary, by_gate binary, by_cell binary"


def _pass(shared: Broadcast, weights: np.ndarray, cells: np.ndarray, epoch: int, low: int):
    """A pass over the task's parts of the vocabulary, each from the same weights and map: sums of what they come
    to, times the decisions seen, and of these decisions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for row in zip(*(b.column(k).to_pylist() for k in ("h", "n", "size", "raw"))):
                raw, off, n, more = _units(*row, low)
                table, begun, few = shared.value
                model = Model.__new__(Model)
                model.table, model.begun, model.weights, model.map = table, begun, weights.copy(), cells.copy()
                by_gate, by_cell = model.learn(raw, off, n, few, epoch, **more)
                found = [model.weights * by_gate[:, None], model.map.ravel() * by_cell, by_gate, by_cell]
                total = [x + y for x, y in zip(total, found)] if total else found
        if total:
            yield _sums_row(total)

    return run


def _sums_row(total: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x.astype("<f8").tobytes()], pa.binary()) for x in total], names=[x.split()[0] for x in _SUMS_OF_PASS.split(", ")])


def _add_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for b in batches:
        for row in zip(*(b.column(k) for k in range(4))):
            found = [np.frombuffer(x.as_buffer(), "<f8") for x in row]
            total = [x + y for x, y in zip(total, found)] if total else found
    if total:
        yield _sums_row(total)


def trained(model: Model, vocabulary: DataFrame, few: np.ndarray, low: int = 0) -> None:
    """Weights and map of the model, learned from the whole vocabulary, of words from place ``low`` on. Of each pass the driver gets ``FOLDED`` rows of
    about 110 KB at most."""
    shared = vocabulary.sparkSession.sparkContext.broadcast((model.table, model.begun, few))
    for epoch in range(EPOCHS):
        sums = vocabulary.select("h", "n", "size", "raw").mapInArrow(_pass(shared, model.weights, model.map, epoch, low), _SUMS_OF_PASS)
        rows = sums.repartition(FOLDED).mapInArrow(_add_sums, _SUMS_OF_PASS).collect()
        if not rows:
            break
        weights, cells, by_gate, by_cell = (np.sum([np.frombuffer(bytes(r[k]), "<f8") for r in rows], axis=0) for k in range(4))
        weights = weights.reshape(model.weights.shape)
        seen, met = by_gate > 0, (by_cell > 0).reshape(model.map.shape)
        model.weights[seen] = (weights[seen] / by_gate[seen, None]).astype(np.float32)
        model.map[met] = (cells.reshape(model.map.shape)[met] / by_cell.reshape(model.map.shape)[met]).astype(np.float32)
    shared.unpersist()


def _heavy(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for h, n in zip(b.column("h").to_pylist(), b.column("n").to_pylist()):
                h, n = np.frombuffer(h, "<u8"), np.frombuffer(n, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(h[n >= least].view(np.int64)), pa.array(n[n >= least])], names=["h", "n"])

    return run


_SCORED = "kind int, part long, block long, rid long, doc_id long, n_tokens long, n_known long, log_count double, score double, n_bytes long, rids binary, h binary, times binary"


def _score(model: Model, heavy: np.ndarray, heavy_n: np.ndarray, parts: int):
    """Kind 0: a row per text with the sums over its heavy words. Kind 1: the other words of a group of texts,
    packed by part, to be looked up. ``block`` is the group's first ``rid``."""
    names = [x.split()[0] for x in _SCORED.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id = TaskContext.get().partitionId() << 33
        costs, of_heads = Costs(model, HEAD), Costs(model)
        ids, hs, owners, firsts, group, held = [], [], [], [], Words(), 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal next_id, ids, hs, owners, firsts, group, held
            n = len(ids)
            u, _, raw, off = group.merged()
            h = np.concatenate([*hs, np.zeros(0, _U)])
            own = np.concatenate([*owners, np.zeros(0, np.int64)])
            which = np.searchsorted(u, h)
            key, _, of = grouped(np.concatenate([k for k, _ in firsts] + [e for _, e in firsts]))
            first = of_heads.of_heads(key)[of]  # of the words, then of the texts' ends
            score = costs.of(u, raw, off)[which] + first[: len(h)]
            at = np.searchsorted(heavy, u)
            found = (at < len(heavy)) & (heavy[np.minimum(at, max(0, len(heavy) - 1))] == u) if len(heavy) else np.zeros(len(u), bool)
            count = np.where(found, heavy_n[np.minimum(at, max(0, len(heavy) - 1))], 0) if len(heavy) else np.zeros(len(u), np.int64)
            log_count = np.log10(count + 1.0)
            k = np.searchsorted(heavy, np.array([END_HASH], _U))[0]
            end = int(heavy_n[k]) if k < len(heavy) and heavy[k] == _U(END_HASH) else 0
            rid = next_id + np.arange(n)
            next_id += n
            size = np.diff(off)
            cols = [np.zeros(n, np.int32), np.zeros(n, np.int64), np.full(n, rid[0]), rid, ids, T.counts(own, n) + 1, np.bincount(own, weights=found[which], minlength=n).astype(np.int64) + (end > 0), np.bincount(own, weights=log_count[which], minlength=n) + np.log10(end + 1), across(h, own, score, n, first[len(h) :]) / np.log(10), np.bincount(own, weights=size[which] + 1, minlength=n).astype(np.int64) + 1]
            for a in range(0, n, 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[a : a + 10_000], t) for c, t in zip(cols, kinds)] + [pa.nulls(min(10_000, n - a), pa.binary())] * 3, names=names)
            rare = ~found[which]
            pair = which[rare] * max(1, n) + own[rare]
            pair, times = np.unique(pair, return_counts=True)
            w, d = np.divmod(pair, max(1, n))
            cut = np.searchsorted(_part(u[w], parts), np.arange(parts + 1))
            for p in range(parts):
                a, c = int(cut[p]), int(cut[p + 1])
                if a < c:
                    row = (1, p, int(rid[0]), None, None, None, None, None, None, None, rid[d[a:c]].astype("<i8").tobytes(), u[w[a:c]].tobytes(), times[a:c].astype("<u4").tobytes())
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=names)
            ids, hs, owners, firsts, group, held = [], [], [], [], Words(), 0

        for b in batches:
            doc_ids = b.column("doc_id").to_pylist()
            for i, j, buf, off in T.chunks(b.column("text")):
                h, doc, starts, stops = tokens(buf, off)
                u, which, raw, at = distinct_words(buf, h, starts, stops)
                group.add(u, np.bincount(which, minlength=len(u)), raw, at)
                hs.append(h)
                owners.append(doc + len(ids))
                firsts.append(heads(buf, starts, stops, doc, j - i))
                ids += doc_ids[i:j]
                held += len(h)
                if held >= GROUP_TOKENS:
                    yield from flush()
        if ids:
            yield from flush()

    return run


_SUMS = "kind int, block long, rids binary, sums binary, known binary"


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts' sums over the words of a part, packed as they were asked. Rows come by part, its words first."""
    part, h, n = None, np.zeros(0, _U), np.zeros(0, np.int64)
    for b in batches:
        for kind, p, block, rids, hs, times in zip(*(b.column(k).to_pylist() for k in ("kind", "part", "block", "rids", "h", "times"))):
            if p != part:
                part, h, n = p, np.zeros(0, _U), np.zeros(0, np.int64)
            if kind == 0:
                h, n = np.frombuffer(hs, "<u8"), np.frombuffer(times, "<i8")
                continue
            rid, want, k = np.frombuffer(rids, "<i8"), np.frombuffer(hs, "<u8"), np.frombuffer(times, "<u4")
            at = np.searchsorted(h, want)
            hit = np.zeros(len(want), bool)
            inside = at < len(h)
            hit[inside] = h[at[inside]] == want[inside]
            count = np.zeros(len(want), np.int64)
            count[hit] = n[at[hit]]
            own, which = np.unique(rid, return_inverse=True)
            packed = [own.astype("<i8"), np.bincount(which, weights=k * np.log10(count + 1.0)).astype("<f8"), np.bincount(which, weights=k * hit).astype("<i8")]
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([block]), *(pa.array([c.tobytes()], pa.binary()) for c in packed)], names=["kind", "block", "rids", "sums", "known"])


_ADDED = "doc_id long, n_tokens long, n_known long, log_count double, score double, n_bytes long"


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts with the sums of their group added. Rows come by block, its sums first."""
    block, more, known = None, np.zeros(0), np.zeros(0, np.int64)
    for b in batches:
        at = np.array(b.column("block").to_pylist(), np.int64)
        kind = b.column("kind").to_numpy()
        first = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (kind[1:] != kind[:-1]) | (kind[1:] == 0)))
        for a, c in zip(first.tolist(), [*first[1:].tolist(), len(at)]):
            if at[a] != block:
                block, more, known = at[a], np.zeros(0), np.zeros(0, np.int64)
            if kind[a] == 0:
                place = np.frombuffer(b.column("rids")[a].as_py(), "<i8") - block
                if place[-1] >= len(more):
                    wider = int(place[-1]) + 1 - len(more)
                    more, known = np.append(more, np.zeros(wider)), np.append(known, np.zeros(wider, np.int64))
                more[place] += np.frombuffer(b.column("sums")[a].as_py(), "<f8")
                known[place] += np.frombuffer(b.column("known")[a].as_py(), "<i8")
                continue
            rows = b.slice(a, c - a)
            place = rows.column("rid").to_numpy() - block
            some = place < len(more)
            extra, seen = np.zeros(len(place)), np.zeros(len(place), np.int64)
            extra[some], seen[some] = more[place[some]], known[place[some]]
            columns = [rows.column("doc_id"), rows.column("n_tokens"), pa.array(rows.column("n_known").to_numpy() + seen), pa.array(rows.column("log_count").to_numpy() + extra), rows.column("score"), rows.column("n_bytes")]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _ADDED.split(", ")])


def _top(vocabulary: DataFrame, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(hashes ascending, counts) of the words counted ``least`` times or more: at most all tokens / least words."""
    top = vocabulary.select("h", "n").mapInArrow(_heavy(least), "h long, n long").toArrow()
    h, n = top.column("h").to_numpy().view(np.uint64), top.column("n").to_numpy()
    order = np.argsort(h)
    return h[order], n[order]


def score(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    learn = docs.where(~held_out())
    volume = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(4, int(volume // (3 * PART_BYTES)))  # packed words take about a third of the texts' bytes
    packed = learn.select("text").mapInArrow(_count_words(parts), "part long, h binary, n binary, size binary, raw binary")
    units = written(packed.repartition(2 * parts, "part").sortWithinPartitions("part").mapInArrow(_vocabulary, _VOCABULARY), "vocabulary")
    vocabulary = units.where(F.col("part") < parts)
    total = vocabulary.agg(F.sum("tokens"), F.sum("words")).first()
    n_tokens, n_words = int(total[0] or 0), int(total[1] or 0)

    counts = np.zeros(2 * int(BASE[-1]), np.int64)
    pieces = np.array_split(np.arange(len(counts)), SLICES)
    least = FREQUENT * n_tokens
    begun = np.zeros(1 << BEGUN_BITS, bool)
    begun[vocabulary.select("h", "n", "size", "raw").mapInArrow(_beginnings(least), "slot long").distinct().toArrow().column("slot").to_numpy()] = True
    for k, raw in units.select("h", "n", "size", "raw").mapInArrow(_tables(begun, HEAD), "part long, n binary").repartition(SLICES // 4, "part").mapInArrow(_add_slices, "part long, n binary").toLocalIterator():
        counts[pieces[k][0] : pieces[k][-1] + 1] = np.frombuffer(raw, "<i8")
    counts = counts.reshape(2, -1)
    model = Model(counts, begun)
    few = scarce(counts)
    del counts
    trained(model, units, few, HEAD)
    del few
    heavy, heavy_n = _top(vocabulary, max(1, HEAVY * n_tokens))

    scored = written(docs.mapInArrow(_score(model, heavy, heavy_n, parts), _SCORED), "scored")
    asked = scored.where("kind = 1").select("kind", "part", "block", "rids", "h", "times")
    known = vocabulary.select(F.lit(0).alias("kind"), "part", F.lit(None).cast("long").alias("block"), F.lit(None).cast("binary").alias("rids"), "h", F.col("n").alias("times"))
    sums = asked.union(known).repartition(parts, "part").sortWithinPartitions("part", "kind").mapInArrow(_look_up, _SUMS)
    texts = scored.where("kind = 0").select(F.lit(1).alias("kind"), "block", "rid", "doc_id", "n_tokens", "n_known", "log_count", "score", "n_bytes")
    both = texts.unionByName(sums, allowMissingColumns=True)
    rows = both.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(_add, _ADDED)
    scale = float(np.log10(n_tokens + n_words + 1))
    return rows.select(
        "doc_id",
        held_out().alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("log_count") - F.col("n_tokens") * F.lit(scale)).alias("base_score"),
        "score",
        "n_bytes",
        (-F.col("score") * F.lit(float(np.log2(10))) / F.col("n_bytes")).alias("bits_per_byte"),
    )
