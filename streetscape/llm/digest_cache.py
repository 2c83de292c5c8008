"""Token counts through a digest cache: only texts that no run has seen are encoded.

The cache is an append-only Parquet table (tokenizer, digest, n_tokens), partitioned by the tokenizer's digest. A
text's digest is the SHA-256 of its normalised content, a tokenizer's that of its file and of the way it is called;
a new version of a tokenizer therefore starts with an empty share of the cache. A run

1. counts its rows by content digest (a partial aggregate of 32-byte keys) and anti-joins them with the stored ones;
2. fetches one text of each digest that is missing (copies are dropped in the tasks that read them, before the
   shuffle), encodes it and appends its count to the cache;
3. joins its rows with the stored counts.

Normalised content is the text with null as the empty text: a byte-level vocabulary counts every other difference,
so nothing else can be folded without changing a count.

Digests that hold more than a ``HOT_SHARE`` of the rows (so fewer than 1 / HOT_SHARE of them) get their counts by
broadcast; their rows are dealt over all tasks of the join under keys that match nothing. Two runs that append the same
digest at once leave two equal entries, of which the join reads one. A run that dies leaves no entry or all of them,
by Spark's commit of the write.

Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated rows each get a row; a row without doc_id is
counted like any other; special strings inside a text count as the library's default has them (one token each); a
very long text is encoded in slices, cut where no token can cross (see ``slices``); an empty table gives no rows and
leaves the cache as it was. Other columns of documents are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streetscape.operators.sizing import is_small
from streetscape.session import checkpoint_root

#: A digest with more than this share of all rows is hot.
HOT_SHARE, HOT_ROWS = 1 / 1000, 100
#: Texts longer than this are encoded in slices; texts are handed to the library in lists of about this many characters.
SLICE_CHARS = 1 << 19
TOKEN_LIMIT = 1024
CACHE_DDL = "tokenizer string, digest binary, n_tokens long"

_EDGE = re.compile(r"(?<=\w) (?=\w)")
#: Words that a worker keeps the counts of, and their greatest length.
KNOWN_WORDS, KNOWN_CHARS = 400_000, 48
_TWO_SPACES = re.compile(r"\s\s").search


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def version_of(model: bytes, kind: str) -> str:
    """Digest of a tokenizer: its file, its library and how it is called here."""
    return hashlib.sha256(f"{kind}: no added special tokens, no truncation, no padding\n".encode() + model).hexdigest()


def sliceable(model: bytes, kind: str) -> bool:
    """Whether no token crosses a single space between two word characters: so with a byte-level pattern that takes
    a space only in front of what follows it, unless a normaliser or a special token with spaces changes that."""
    if kind != "json":
        return False
    told = json.loads(model)
    pre = told.get("pre_tokenizer") or {}
    plain = all(not t.get("lstrip") and not t.get("rstrip") and " " not in t["content"] for t in told.get("added_tokens") or [])
    return pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not told.get("normalizer") and plain


def slices(text: str, size: int = SLICE_CHARS) -> Iterator[str]:
    """The text in parts of at least ``size`` characters, each starting with a space that stands alone between two word
    characters. A text without such places stays whole."""
    at = 0
    while len(text) - at > size:
        edge = _EDGE.search(text, at + size)
        if edge is None:
            break
        yield text[at : edge.start()]
        at = edge.start()
    yield text[at:]


def words(text: str) -> list[str]:
    """The text cut before every space and line break, or whole if two white-space characters meet anywhere. With a pattern
    that ``sliceable`` accepts, no token crosses such a cut: a single space goes with what follows it, a single line break
    stands alone."""
    if "\0" in text or _TWO_SPACES(text):
        return list(slices(text, 1))
    return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")


_COUNTERS: dict[str, object] = {}


def counter(model: bytes, kind: str):
    """A function from texts to their numbers of tokens, one for each tokenizer and worker process."""
    key = version_of(model, kind)
    if key not in _COUNTERS:
        if kind == "json":
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_str(model.decode())
            tokenizer.no_truncation()
            tokenizer.no_padding()
            whole = lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        else:
            import sentencepiece

            pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
            whole = lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]
        _COUNTERS[key] = by_words(whole) if sliceable(model, kind) else whole
    return _COUNTERS[key]


def by_words(whole):
    """The same counts, each new word of a list of texts encoded once."""
    known: dict[str, int] = {}

    def count(texts: list[str]) -> list[int]:
        split = list(map(words, texts))
        new = list(set().union(*split).difference(known))
        known.update(zip(new, whole(new)))
        out = [sum(map(known.__getitem__, w)) for w in split]
        room = KNOWN_WORDS - (len(known) - len(new))
        for k, w in enumerate(new):
            if k >= room or len(w) > KNOWN_CHARS:
                del known[w]
        return out

    return count


def _encode(model: bytes, kind: str):
    cut = sliceable(model, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(model, kind)
        for b in batches:
            totals = [0] * b.num_rows
            owners: list[int] = []
            parts: list[str] = []
            held = 0

            def flush() -> None:
                for k, n in zip(owners, count(parts)):
                    totals[k] += n
                owners.clear()
                parts.clear()

            for k, text in enumerate(b.column("text")):
                for part in slices(text.as_py()) if cut else [text.as_py()]:
                    owners.append(k)
                    parts.append(part)
                    held += len(part)
                    if held >= SLICE_CHARS:
                        flush()
                        held = 0
            flush()
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(totals, pa.int64())], names=["digest", "n_tokens"])

    return run


def content(text: str | Column) -> Column:
    """The normalised content of a text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def stored(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(digest, n_tokens) of one tokenizer's entries, each digest once; no rows where there is no cache yet."""
    try:
        rows = spark.read.schema(CACHE_DDL).parquet(cache)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], CACHE_DDL)
    return rows.where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def fresh_cache(spark: SparkSession) -> str:
    """A cache of its own in the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/llm/token-cache-{uuid.uuid4().hex}"


def fill(documents: DataFrame, cache: str, tokenizer: str | None = None) -> DataFrame:
    """Encode what the cache lacks of the texts and append it; returns (digest, n) with the rows of each digest."""
    spark = documents.sparkSession
    model, kind, version = _tokenizer(tokenizer)
    texts = documents.select(content("text").alias("text")).select(digest(F.col("text")).alias("digest"), "text")
    root = f"{checkpoint_root(spark).rstrip('/')}/llm/token-rows-{uuid.uuid4().hex}"
    texts.groupBy("digest").agg(F.count("*").alias("n")).write.parquet(root)
    rows = spark.read.schema("digest binary, n long").parquet(root)

    known = stored(spark, cache, version)
    if not known.isEmpty():
        missing = rows.select("digest").join(known, "digest", "left_anti")
        if is_small(missing):  # a run with few new texts: the others don't leave the tasks that read them
            missing = F.broadcast(missing)
        texts = texts.join(missing, "digest", "left_semi")
    fresh = texts.groupBy("digest").agg(F.first("text").alias("text")).select("digest", "text").mapInArrow(_encode(model, kind), "digest binary, n_tokens long")
    fresh.select(F.lit(version).alias("tokenizer"), "digest", "n_tokens").write.mode("append").partitionBy("tokenizer").parquet(cache)
    return rows


def _tokenizer(path: str | None) -> tuple[bytes, str, str]:
    file = Path(path or tokenizer_path())
    model, kind = file.read_bytes(), "model" if file.suffix == ".model" else "json"
    return model, kind, version_of(model, kind)


def token_counts(documents: DataFrame, cache: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """doc_id, digest, n_bytes and n_tokens of every row, by way of the cache in folder ``cache`` (a new one in the
    shared folder if none is given). ``tokenizer`` is a file on the driver, ``.json`` or ``.model``."""
    spark = documents.sparkSession
    cache = cache or fresh_cache(spark)
    rows = fill(documents, cache, tokenizer)
    counts = stored(spark, cache, _tokenizer(tokenizer)[2])

    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # fewer than 1 / HOT_SHARE digests can have more than that share of the rows
    hot = rows.where(F.col("n") > max(HOT_ROWS, total * HOT_SHARE)).join(counts, "digest").select("digest", F.col("n_tokens").alias("hot_tokens"))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), content("text").alias("text"))
    keyed = docs.select("doc_id", F.octet_length(F.encode("text", "UTF-8")).cast("long").alias("n_bytes"), digest(F.col("text")).alias("digest"))
    keyed = keyed.join(F.broadcast(hot), "digest", "left")
    apart = F.encode(F.monotonically_increasing_id().cast("string"), "UTF-8")  # shorter than any digest
    keyed = keyed.withColumn("at", F.when(F.col("hot_tokens").isNull(), F.col("digest")).otherwise(apart))
    joined = keyed.join(counts.withColumnRenamed("digest", "at"), "at", "left")
    return joined.select("doc_id", "digest", "n_bytes", F.coalesce("hot_tokens", "n_tokens").alias("n_tokens"))
