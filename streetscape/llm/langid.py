"""Language ID: a bidirectional gated recurrent network over bytes.

Every text is cut into blocks of ``BLOCK`` bytes. Two gated recurrent layers read each block, one
from either end; at every byte their states give a distribution over the learned languages, and a
document's distribution is the mean over all its bytes that belong to letters. The network is
trained in numpy by backpropagation through time on a bounded sample of labelled rows (at most
``SLOTS`` documents a language, ``WINDOWS`` windows of each); prediction reads every byte of every
text inside Spark tasks, block by block, so memory doesn't grow with a text.

Defined cases: a null text and one without a letter are ``und`` with score 0; repeated rows get
equal predictions; ties go to the language first in order; rows whose lang is null train nothing;
with no language to learn everything is ``und``; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from streetscape.llm import tokens as T

HIDDEN, BLOCK, LANES = 8, 128, 2048
#: The labelled sample: documents of each language, windows of each document, bytes of a window.
SLOTS, WINDOWS, WINDOW = 384, 6, 48
STEPS, BATCH, RATE, SEED = 400, 256, 0.02, 7
#: Remainder of crc32(doc_id) modulo 4 that is held out.
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
OUT = "doc_id long, held_out boolean, lang_pred string, score double"
_LETTER = regex.compile(r"\p{L}")
#: Bytes whose distribution counts: ASCII letters and all bytes of other characters.
_COUNTED = np.array([(chr(b).isalpha() and b < 128) or b >= 128 for b in range(256)])


@dataclass
class Model:
    """Weights by direction (0 from the left, 1 from the right). Gates in order: update, reset,
    candidate; those of ``x`` and ``u`` for the sigmoid gates are halved, as sigmoid(v) is
    (1 + tanh(v / 2)) / 2."""

    langs: list[str]
    x: np.ndarray  # [2, 3H, 256]
    u: np.ndarray  # [2, 3H, H]
    b: np.ndarray  # [2, H, 1], inside the reset product
    v: np.ndarray  # [K, 2H]
    c: np.ndarray  # [K, 1]


def _forward(m: Model, blocks: np.ndarray, mask: np.ndarray | None, keep: list | None = None) -> np.ndarray:
    """States [T, 2, H, B]; ``blocks`` is [T, B] of bytes, ``mask`` 0 where a block has ended."""
    t_max, lanes = blocks.shape
    hid = m.u.shape[2]
    states = np.empty((t_max, 2, hid, lanes), np.float32)
    h = np.zeros((2, hid, lanes), np.float32)
    gx = np.empty((2, 3 * hid, lanes), np.float32)
    gu = np.empty_like(gx)
    for t in range(t_max):
        np.take(m.x[0], blocks[t], axis=1, out=gx[0], mode="clip")
        np.take(m.x[1], blocks[t_max - 1 - t], axis=1, out=gx[1], mode="clip")
        np.matmul(m.u, h, out=gu)
        zr = gx[:, : 2 * hid]
        zr += gu[:, : 2 * hid]
        np.tanh(zr, out=zr)
        zr += 1
        zr *= 0.5
        z, r = zr[:, :hid], zr[:, hid:]
        un = gu[:, 2 * hid :]
        un += m.b
        n = gx[:, 2 * hid :]
        n += r * un
        np.tanh(n, out=n)
        if keep is not None:
            keep.append((h.copy(), z.copy(), r.copy(), un.copy(), n.copy()))
        h = n + z * (h - n)
        if mask is not None:
            h[0] *= mask[t]
            h[1] *= mask[t_max - 1 - t]
        states[t] = h
    return states


def _softmax(logits: np.ndarray) -> np.ndarray:
    """Over axis 1."""
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def positions(m: Model, blocks: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
    """Probabilities [T, K, B] of each language at each byte."""
    states = _forward(m, blocks, mask)
    hid = m.u.shape[2]
    return _softmax(np.matmul(m.v[:, :hid], states[:, 0]) + np.matmul(m.v[:, hid:], states[::-1, 1]) + m.c)


def train(langs: list[str], windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray, hidden: int = HIDDEN, steps: int = STEPS, seed: int = SEED) -> Model:
    """Backpropagation through time with Adam over windows [N, T] of bytes, batches balanced over
    the languages."""
    rng = np.random.default_rng(seed)
    k, hid = len(langs), hidden
    u = rng.normal(0, 1 / np.sqrt(hid), (2, 3 * hid, hid))
    u[:, : 2 * hid] *= 0.5
    m = Model(langs, *(a.astype(np.float32) for a in (rng.normal(0, 0.3, (2, 3 * hid, 256)), u, np.zeros((2, hid, 1)), rng.normal(0, 0.1, (k, 2 * hid)), np.zeros((k, 1)))))
    by_lang = [np.flatnonzero(labels == i) for i in range(k)]
    by_lang = [a for a in by_lang if len(a)]
    names = ("x", "u", "b", "v", "c")
    first = {n: np.zeros_like(getattr(m, n)) for n in names}
    second = {n: np.zeros_like(getattr(m, n)) for n in names}
    for step in range(1, steps + 1):
        pick = np.concatenate([a[rng.integers(0, len(a), max(1, BATCH // len(by_lang)))] for a in by_lang])
        grads = _gradients(m, windows[pick].T, lengths[pick], labels[pick])
        rate = RATE * min(1, 4 * (1 - step / (steps + 1)))
        for n in names:
            g = np.clip(grads[n], -1, 1)
            first[n] += 0.1 * (g - first[n])
            second[n] += 0.01 * (g * g - second[n])
            w = getattr(m, n)
            w -= (rate * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return m


def _gradients(m: Model, blocks: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    t_max, lanes = blocks.shape
    hid = m.u.shape[2]
    mask = (np.arange(t_max)[:, None] < lengths).astype(np.float32)
    kept: list = []
    states = _forward(m, blocks, mask, kept)
    left, right = states[:, 0], states[::-1, 1]
    d = _softmax(np.matmul(m.v[:, :hid], left) + np.matmul(m.v[:, hid:], right) + m.c)
    d[:, labels, np.arange(lanes)] -= 1
    d *= (mask / mask.sum())[:, None, :]
    g = {n: np.zeros_like(getattr(m, n)) for n in ("x", "u", "b", "v", "c")}
    g["v"][:, :hid] = np.einsum("tkb,thb->kh", d, left, optimize=True)
    g["v"][:, hid:] = np.einsum("tkb,thb->kh", d, right, optimize=True)
    g["c"][:, 0] = d.sum(axis=(0, 2))
    out = np.stack([np.matmul(m.v[:, :hid].T, d), np.matmul(m.v[:, hid:].T, d)[::-1]], axis=1)  # [T, 2, H, B] in each direction's order
    dh = np.zeros((2, hid, lanes), np.float32)
    ut = m.u.transpose(0, 2, 1)
    flat = np.zeros((2, 256, 3 * hid), np.float32)
    for t in range(t_max - 1, -1, -1):
        h, z, r, un, n = kept[t]
        dh += out[t]
        dh[0] *= mask[t]
        dh[1] *= mask[t_max - 1 - t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * z * (1 - z) * 2  # of the halved argument
        dr = dn * un * r * (1 - r) * 2
        dun = dn * r
        da = np.concatenate([dz, dr, dn], axis=1)
        du = np.concatenate([dz, dr, dun], axis=1)
        g["u"] += np.matmul(du, h.transpose(0, 2, 1))
        g["b"] += dun.sum(axis=2, keepdims=True)
        for k, at in ((0, t), (1, t_max - 1 - t)):
            np.add.at(flat[k], blocks[at], da[k].T)
        dh = dh * z + np.matmul(ut, du)
    g["x"] = flat.transpose(0, 2, 1)
    return g


def _predict(m: Model, texts) -> tuple[np.ndarray, np.ndarray]:
    """(sum of probabilities by language [N, K], counted bytes [N]) of a string array."""
    k = len(m.langs)
    n = len(texts)
    total, count = np.zeros((n, k)), np.zeros(n)
    lanes: list[tuple[np.ndarray, int]] = []

    def flush() -> None:
        block = np.zeros((BLOCK, len(lanes)), np.uint8)
        lengths = np.empty(len(lanes), np.int64)
        owner = np.empty(len(lanes), np.int64)
        for q, (seg, d) in enumerate(lanes):
            block[: len(seg), q] = seg
            lengths[q], owner[q] = len(seg), d
        t_max = int(lengths.max())
        block = block[:t_max]
        inside = np.arange(t_max)[:, None] < lengths
        p = positions(m, block, None if inside.all() else inside.astype(np.float32))
        weight = (_COUNTED[block] & inside).astype(np.float32)
        pooled = np.einsum("tkb,tb->kb", p, weight)
        for i in range(k):
            total[:, i] += np.bincount(owner, weights=pooled[i], minlength=n)
        count[:] += np.bincount(owner, weights=weight.sum(axis=0), minlength=n)
        lanes.clear()

    for i, _, buf, off in T.chunks(texts):
        for d in range(len(off) - 1):
            for a in range(int(off[d]), int(off[d + 1]), BLOCK):
                lanes.append((buf[a : min(a + BLOCK, int(off[d + 1]))], i + d))
                if len(lanes) == LANES:
                    flush()
    if lanes:
        flush()
    return total, count


def predictor(m: Model | None):
    """For ``mapInArrow`` over any rows with a ``text``: the rows with ``lang_pred`` and ``score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text")
            lettered = np.fromiter((t is not None and _LETTER.search(t) is not None for t in texts.to_pylist()), bool, len(texts))
            pred, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if m is not None and len(texts):
                total, count = _predict(m, texts)
                p = total / np.maximum(count, 1)[:, None]
                best = p.argmax(axis=1)
                pred = [m.langs[i] if ok else UNKNOWN for i, ok in zip(best, lettered)]
                score = np.where(lettered, np.clip(p.max(axis=1), 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(score)], names=[*b.schema.names, "lang_pred", "score"])

    return run


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Evenly spaced windows of each text, the first and the last included."""
    for b in batches:
        lang, data = [], []
        for name, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
            raw = text.encode()
            for at in sorted({(len(raw) - WINDOW) * q // (WINDOWS - 1) for q in range(WINDOWS)} if len(raw) > WINDOW else {0}):
                lang.append(name)
                data.append(raw[at : at + WINDOW])
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(data, pa.binary())], names=["lang", "window"])


def held_out() -> F.Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def sample(documents: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(lang, window) of at most ``slots`` training documents a language: the least hash of an id
    in each of ``slots`` classes. Only ids and languages are aggregated; texts are read for the
    chosen ids alone."""
    rows = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    key = F.xxhash64(F.col("doc_id").cast("string"), "lang")
    least = rows.groupBy("lang", F.pmod(key, F.lit(slots)).alias("slot")).agg(F.min(key).alias("chosen")).select("chosen")
    texts = rows.select("lang", "text", key.alias("key")).join(F.broadcast(least), F.col("key") == F.col("chosen"), "left_semi").dropDuplicates(["key"])
    return texts.select("lang", "text").mapInArrow(_windows, "lang string, window binary")


def fit(documents: DataFrame, slots: int = SLOTS) -> Model | None:
    """The network learned from ``sample`` (at most slots * WINDOWS windows a language)."""
    rows = sample(documents, slots).toArrow()
    pairs = sorted((a, w) for a, w in zip(rows.column("lang").to_pylist(), rows.column("window").to_pylist()) if w)
    if not pairs:
        return None
    langs = sorted({a for a, _ in pairs})
    windows = np.zeros((len(pairs), WINDOW), np.uint8)
    for i, (_, w) in enumerate(pairs):
        windows[i, : len(w)] = np.frombuffer(w, np.uint8)
    index = {a: i for i, a in enumerate(langs)}
    return train(langs, windows, np.array([len(w) for _, w in pairs]), np.array([index[a] for a, _ in pairs]))


def identify(rows: DataFrame, m: Model | None) -> DataFrame:
    """``rows`` with ``lang_pred`` and ``score`` appended; ``rows`` has neither."""
    schema = S.StructType([*rows.schema.fields, S.StructField("lang_pred", S.StringType()), S.StructField("score", S.DoubleType())])
    return rows.mapInArrow(predictor(m), schema)


def _recognised(m: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for out in predictor(m)(iter([b.select(["text"])])):
                yield b.filter(pa.compute.not_equal(out.column("lang_pred"), UNKNOWN))

    return run


def keep_recognised(documents: DataFrame, m: Model | None) -> DataFrame:
    """The documents, all their columns kept, whose language isn't ``und``."""
    return documents.mapInArrow(_recognised(m), documents.schema)


def language_id(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    m = fit(docs)
    return identify(docs.select("doc_id", "text"), m).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def crc_fold(doc_id: int | None) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS
