"""What the operators share: input rows, tables in the shared folder, the encoder's word cache."""

from __future__ import annotations

import ctypes
import functools
import os
import re
import struct
import tempfile
import uuid
import zipfile
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    return public_tokenizers.path(name)


# ---------------------------------------------------------------- tables


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Only a local master, whose executors are the driver, gets a folder of its own where none is named.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="tallymart-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if folder is None:
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a table that several branches read, and read it back: a lost executor re-reads files."""
    path = path or fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def rows_of(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (null: empty) of any table that has them; other columns are left behind unless named."""
    ship_package(docs.sparkSession)
    batch_whole_texts(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more
    )


def text_bytes(docs: DataFrame, each: int = 0) -> int:
    """UTF-8 bytes of all texts, and ``each`` more a row: one number, from which block and group counts follow."""
    return docs.agg(F.sum(F.octet_length("text") + F.lit(each).cast("long"))).first()[0] or 0


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


READER_ROWS = "spark.sql.parquet.columnarReaderBatchSize"


def batch_whole_texts(spark: SparkSession) -> None:
    """Rows here hold whole texts: where the session has Spark's own batch sizes, a small part of them."""
    for setting, own, less in ((BATCH_ROWS, "10000", "500"), (READER_ROWS, "4096", "512")):
        if spark.conf.get(setting) == own:
            spark.conf.set(setting, less)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors once a session, wherever they run."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tallymart-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as into:
        for file in sorted(package.rglob("*.py")):
            into.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


# ---------------------------------------------------------------- library encoding


@functools.cache
def tokenizer(path: str):
    """The library's tokenizer, once a process, without the file's truncation and padding."""
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@functools.cache
def _special(path: str) -> re.Pattern:
    """The added tokens' strings; the library cuts texts at them before anything else."""
    words = sorted((t.content for t in tokenizer(path).get_added_tokens_decoder().values()), key=len, reverse=True)
    return re.compile("|".join(map(re.escape, words)) or r"(?!)")


@functools.cache
def _odd_space(path: str) -> re.Pattern:
    """Characters at which str.split cuts and the library does not."""
    own = tokenizer(path)
    plain = own.encode("a b", add_special_tokens=False).ids
    spaces = [c for c in map(chr, range(0x3001)) if c.isspace()]
    odd = [c for c in spaces if own.encode(f"a{c}b", add_special_tokens=False).ids != plain]
    return re.compile(f"[{re.escape(''.join(odd))}]" if odd else r"(?!)")


def pieces(path: str, text: str) -> list[str] | None:
    """A text's parts between white space, if the word tokenizer's ids are those of the parts in turn; else None.

    Latin-1 texts are lower-cased first, as the tokenizer does itself: they have no composed forms to mend.
    """
    if _special(path).search(text) or _odd_space(path).search(text):
        return None
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text.split()
    return text.lower().split()


# A word of these characters alone is cut by the word tokenizer into runs of letters, digits and runs of signs, and has
# no other normal form. Apostrophes may open contractions and stay out.
PLAIN_WORD = re.compile(r"[a-z0-9ß-öø-ÿ!-&(-/:-@\[-`{-~]+")
PLAIN_TEXT = re.compile(r"[a-z0-9ß-öø-ÿ!-&(-/:-@\[-`{-~ \t\r\n]*")
PLAIN_RUN = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+")


def byte_characters() -> list[str]:
    """The printable character of each byte in a byte-level vocabulary, from the published rule.

    Printable Latin-1 bytes stand for themselves, the others for the characters from 256 on, in order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class TwoGenerations(dict):
    """A cache of two generations of at most ``size`` entries; those of the older one that are met again move up.

    What has left is made again by ``make``, so the size bounds memory and not results.
    """

    def __init__(self, size: int):
        super().__init__()
        self.size, self.older = size, {}

    def __missing__(self, key: str):
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found


class RunCache(TwoGenerations):
    """Ids of runs as packed 16-bit numbers, by the library's own model."""

    def __init__(self, path: str, size: int = 300_000):
        super().__init__(size)
        self.tokens = tokenizer(path).model.tokenize
        self.letters = dict(enumerate(byte_characters()))

    def make(self, run: str) -> bytes:
        if not run.isascii():
            run = run.encode().decode("latin-1").translate(self.letters)
        ids = [token.id for token in self.tokens(run)]
        return struct.pack(f"<{len(ids)}H", *ids)


class WordCache(TwoGenerations):
    """Ids of words as packed 16-bit numbers: those of the runs of a plain word, by the library's encoder for others."""

    def __init__(self, path: str, size: int = 100_000):
        super().__init__(size)
        self.path, self.runs = path, RunCache(path)

    def make(self, word: str) -> bytes:
        if PLAIN_WORD.fullmatch(word):
            return b"".join(map(self.runs.__getitem__, PLAIN_RUN.findall(word)))
        ids = tokenizer(self.path).encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}H", *ids)


@functools.cache
def word_cache(path: str) -> WordCache:
    return WordCache(path)


def leave_encoder() -> None:
    """Called by tasks that encode nothing: Python workers outlive stages, and so would an earlier stage's caches."""
    import pyarrow as pa

    if word_cache.cache_info().currsize or tokenizer.cache_info().currsize:
        word_cache.cache_clear()
        tokenizer.cache_clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only where the C library has it
    if trim is not None:
        trim(0)


def plain_runs(path: str, text: str) -> list[str] | None:
    """The runs of a text that holds plain words alone: its ids are theirs in turn; else None."""
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return None
    if _special(path).search(text):
        return None
    lower = text.lower()
    return PLAIN_RUN.findall(lower) if PLAIN_TEXT.fullmatch(lower) else None


def ids_of_texts(path: str, texts: list[str]) -> list[bytes]:
    """The library's ids of each text under the word tokenizer, as packed 16-bit numbers."""
    import numpy as np

    cache, out = word_cache(path), []
    for text in texts:
        runs = plain_runs(path, text)
        if runs is not None:
            out.append(b"".join(map(cache.runs.__getitem__, runs)))
            continue
        parts = pieces(path, text)
        if parts is None:
            ids = tokenizer(path).encode(text, add_special_tokens=False).ids
            out.append(np.array(ids, dtype="<u2").tobytes())
        else:
            out.append(b"".join(map(cache.__getitem__, parts)))
    return out


# ---------------------------------------------------------------- labelled rows


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """doc_id, text and label of at most ``per_class`` labelled documents of each class (0 and 1).

    The rows with the smallest hash of their id are taken, so the choice does not change between runs; the chosen ids,
    at most ``2 * per_class``, are what is broadcast. An id with several rows gives the least of its texts.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = [
        known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        for value in (0, 1)
    ]
    rows = rows_of(docs).join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
