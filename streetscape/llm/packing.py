"""Packing: hierarchical multi-length packing of documents into training sequences.

Contexts come in tiers (256, 512, 1024, 2048 tokens). A document longer than the largest context
gives whole windows of that size; what remains of it, and every shorter document, is routed to the
smallest tier that holds it. Tiers are packed from the longest down: a window starts with the
longest waiting piece of its tier, its gap is filled best-fit with whole pieces of the same or
shorter tiers, and when none fits, the last gap takes the head of a shorter piece, whose rest
waits on. So windows are full; only what is left at the end of a task (under 256 tokens) is padded.
Sequences of one context are dealt by attention cost (the sum of squared piece lengths), to and
fro, over step groups of ``STEP_TOKENS`` tokens, so that steps cost about the same.

Everything happens in the task that tokenizes: no shuffle and no state beyond ``GROUP_TOKENS``
waiting tokens, so a retried task gives the same rows. Tokens of words are kept in a bounded cache
of the worker.

Defined cases: strings of special tokens inside a text are those tokens, as the tokenizer's default has it; a null or empty text is the end id alone; repeated rows are packed each on its own;
a text is tokenized in slices cut at white space, however long it is; an empty table gives no rows.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIERS = (256, 512, 1024, 2048)
END_ID = 1
STEP_TOKENS = 8 * 2048
GROUP_TOKENS = 2_000_000
SLICE_CHARS = 1 << 20
#: Sizes of the caches of words and of their parts; longer strings aren't kept.
CACHE_WORDS, CACHE_PARTS, CACHE_CHARS = 300_000, 400_000, 48
OUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, context int, step_id long, step_cost long"

#: Words of printable ASCII and Latin-1 letters: composed and lower-cased character by character.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+").fullmatch
#: The tokenizer's own word pattern, for such words in lower case.
_PRETOKENS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+").findall


class WordIds(dict):
    """Little-endian 32-bit ids of the words between ASCII spaces, which no token crosses."""

    def __init__(self, tokenizer_json: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.special = re.compile("|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()) or r"\b\B").search
        self.one = self.tokenizer.model.tokenize
        self.parts: dict[str, bytes] = {}
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0xC0, 0x100)]
        self.byte_level = str.maketrans({c: level.pre_tokenize_str(c)[0][0] for c in letters})

    def part(self, part: str) -> bytes:
        out = self.parts.get(part)
        if out is None:
            ids = [t.id for t in self.one(part if part.isascii() else part.translate(self.byte_level))]
            out = struct.pack(f"<{len(ids)}I", *ids)
            if len(self.parts) < CACHE_PARTS and len(part) <= CACHE_CHARS:
                self.parts[part] = out
        return out

    def __missing__(self, word: str) -> bytes:
        if _PLAIN(word) and not self.special(word):
            out = b"".join(map(self.part, _PRETOKENS(word.lower())))
        else:
            out = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) < CACHE_WORDS and len(word) <= CACHE_CHARS:
            self[word] = out
        return out

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, text.replace("\n", " ").split(" "))), "<u4")


_WORD_IDS: dict[int, WordIds] = {}


def word_ids(tokenizer_json: str) -> WordIds:
    """One per tokenizer in each worker process."""
    key = zlib.crc32(tokenizer_json.encode())
    if key not in _WORD_IDS:
        _WORD_IDS[key] = WordIds(tokenizer_json)
    return _WORD_IDS[key]


def slices(text: str, size: int = SLICE_CHARS) -> Iterator[str]:
    """The text in slices that end at an ASCII space or line break."""
    at = 0
    while len(text) - at > size:
        cut = max(text.rfind(" ", at, at + size), text.rfind("\n", at, at + size))
        if cut < at:
            ends = [x for x in (text.find(" ", at + size), text.find("\n", at + size)) if x >= 0]
            if not ends:
                break
            cut = min(ends)
        yield text[at : cut + 1]
        at = cut + 1
    yield text[at:]


class Packer:
    """Pieces waiting for a window, and the windows made of them."""

    def __init__(self, tiers: tuple[int, ...] = TIERS, first_id: int = 0) -> None:
        self.tiers, self.top = tiers, tiers[-1]
        self.waiting: dict[int, list] = defaultdict(list)
        self.lengths: list[int] = []
        self.tokens = 0
        self.next_sequence = self.next_step = first_id
        self.windows: list[tuple[int, list]] = []  # (context, pieces)

    def add(self, piece: tuple) -> None:
        """A piece is (document, start, ids)."""
        n = len(piece[2])
        if n == self.top:
            self.windows.append((self.top, [piece]))
        elif n:
            if not self.waiting[n]:
                insort(self.lengths, n)
            self.waiting[n].append(piece)
            self.tokens += n

    def _pop(self, k: int) -> tuple:
        n = self.lengths[k]
        piece = self.waiting[n].pop()
        if not self.waiting[n]:
            del self.lengths[k]
        self.tokens -= n
        return piece

    def _fill(self, gap: int) -> tuple:
        """The longest waiting piece that fits, or the head of the shortest one that doesn't."""
        k = bisect_right(self.lengths, gap) - 1
        if k >= 0:
            return self._pop(k)
        doc, start, ids = self._pop(0)
        self.add((doc, start + gap, ids[gap:]))
        return doc, start, ids[:gap]

    def pack(self, until: int) -> None:
        """Open windows until fewer than ``until`` tokens wait."""
        while self.lengths and self.tokens >= until:
            piece = self._pop(len(self.lengths) - 1)
            pieces, used = [piece], len(piece[2])
            context = self.tiers[bisect_left(self.tiers, used)]
            while used < context and self.lengths:
                pieces.append(self._fill(context - used))
                used += len(pieces[-1][2])
            if used == context:
                self.windows.append((context, pieces))
            else:
                self._tail(pieces, used)

    def _tail(self, pieces: list, used: int) -> None:
        """Nothing waits any more: cut what there is into whole contexts; the rest is padded."""
        while used >= self.tiers[0]:
            context = self.tiers[bisect_right(self.tiers, used) - 1]
            head, room = [], context
            while room:
                doc, start, ids = pieces.pop(0)
                head.append((doc, start, ids[:room]))
                if len(ids) > room:
                    pieces.insert(0, (doc, start + room, ids[room:]))
                room -= len(head[-1][2])
            self.windows.append((context, head))
            used -= context
        if pieces:
            self.windows.append((self.top, pieces))

    def flush(self) -> Iterator[tuple]:
        """The rows of all windows so far, dealt over step groups."""
        by_context: dict[int, list] = defaultdict(list)
        for context, pieces in self.windows:
            by_context[context].append((sum(len(p[2]) ** 2 for p in pieces), pieces))
        self.windows = []
        for context in sorted(by_context):
            rows = sorted(by_context[context], key=lambda x: -x[0])
            steps = -(-len(rows) * context // STEP_TOKENS)
            cost = [0] * steps
            dealt = []
            for i, (c, pieces) in enumerate(rows):
                lap, at = divmod(i, steps)
                step = at if lap % 2 == 0 else steps - 1 - at
                cost[step] += c
                dealt.append((step, pieces))
            for step, pieces in dealt:
                offset = 0
                for doc, start, ids in pieces:
                    yield doc, start, ids, self.next_sequence, offset, context, self.next_step + step, cost[step]
                    offset += len(ids)
                self.next_sequence += 1
            self.next_step += steps


def _run(tokenizer_json: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(tokenizer_json).encode
        packer = Packer(first_id=TaskContext.get().partitionId() << 32)

        def rows() -> Iterator[pa.RecordBatch]:
            out = [(d[0], start, len(ids), zlib.crc32(ids.tobytes()), d[1], seq, at, context, step, cost, *([ids] if with_ids else [])) for d, start, ids, seq, at, context, step, cost in packer.flush()]
            for i in range(0, len(out), 10_000):
                cols = list(zip(*out[i : i + 10_000]))
                kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64(), pa.int64()]
                names = [x.split()[0] for x in OUT.split(", ")]
                arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
                if with_ids:
                    arrays, names = [*arrays, pa.array([list(map(int, x)) for x in cols[10]], pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

        held = 0
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                doc = [doc_id, 0]
                rest = np.zeros(0, "<u4")
                parts = slices(text.as_py() or "")
                for part in parts:
                    rest = np.concatenate([rest, encode(part)])
                    whole = len(rest) // packer.top * packer.top
                    for at in range(0, whole, packer.top):
                        packer.add((doc, doc[1] + at, rest[at : at + packer.top]))
                    doc[1] += whole
                    held += whole
                    rest = rest[whole:]
                rest = np.append(rest, np.array([END_ID], "<u4"))
                packer.add((doc, doc[1], rest))
                doc[1] += len(rest)
                held += len(rest)
                if held >= GROUP_TOKENS:
                    packer.pack(packer.top)
                    yield from rows()
                    held = packer.tokens
        packer.pack(0)
        yield from rows()

    return run


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack(documents: DataFrame, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and
    the sequence's context, step group and that group's attention cost; with ``with_ids`` the
    piece's ids too. ``tokenizer`` is the path of a tokenizers file on the driver."""
    model = Path(tokenizer or tokenizer_path()).read_text(encoding="utf-8")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_run(model, with_ids), OUT + (", ids array<int>" if with_ids else ""))
