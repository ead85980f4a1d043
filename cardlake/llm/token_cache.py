"""Token counts through a digest cache.

The cache is a table of (tokenizer digest, content digest, n_tokens). Documents join it by
the SHA-256 of their normalised text and the SHA-256 of the tokenizer file. Only distinct
texts without an entry are encoded, and their counts are appended. A new tokenizer file has
a new digest, so its counts never mix with old ones.

Some tokenizers drop white space and never join across it (``counts_by_word``). For these, normalisation
collapses runs of ASCII blanks to one space, which cannot change a count, and a text's count is the sum over
its blank-separated words, so a worker encodes each distinct word once. For all others the text
itself is digested and encoded whole. Counts are the library's own.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm.common import SPACES, blocks, col, materialise, shuffle_partitions, utf8

KNOWN_WORDS = 300_000   # words whose counts a worker keeps, and as many of their cores; beyond, those of the last texts stay
BLOCK_BYTES = 4 << 20   # of texts that are split and counted at a time
_TOKENIZERS: dict[str, object] = {}
_WORDS: dict[str, dict[bytes, int]] = {}   # by tokenizer version
_CORES: dict[str, dict[str, int]] = {}
MARKS = ".,;:!?"
CACHE = "tokenizer string, digest binary, n_tokens long"


def tokenizer_text(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def counts_by_word(definition: str) -> bool:
    """Whether the definition drops white space before its words (the Split rule keeps matches
    only, and no match holds a blank), so that words can be counted one by one."""
    steps = json.loads(definition).get("pre_tokenizer") or {}
    first = (steps.get("pretokenizers") or [steps])[0]
    pattern = (first.get("pattern") or {}).get("Regex", "")
    return first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert")) \
        and r"[^\s" in pattern and " " not in pattern


def _tokenizer(version: str, definition: str):
    if version not in _TOKENIZERS:
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(definition)
        t.no_truncation()
        t.no_padding()
        _TOKENIZERS[version] = t
    return _TOKENIZERS[version]


def punctuation_apart(definition: str) -> bool:
    """Whether the definition splits a word of letters from the ``MARKS`` behind it and lower-cases, so that the letters
    of a word (ASCII ones lower-cased) and its marks can be counted one by one."""
    parts = json.loads(definition)
    first = (parts["pre_tokenizer"].get("pretokenizers") or [parts["pre_tokenizer"]])[0]["pattern"]["Regex"].split("|")
    rules = (parts.get("normalizer") or {}).get("normalizers") or [parts.get("normalizer") or {}]
    special = "".join(t["content"] for t in parts.get("added_tokens") or [])
    return (first[-3:] == [r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+"] and all(alternative[0] == "'" for alternative in first[:-3])
            and any(r.get("type") == "Lowercase" for r in rules) and {r.get("type") for r in rules} <= {"NFC", "Lowercase", "Replace"}
            and all(r["pattern"] == {"Regex": r"\s+"} for r in rules if r.get("type") == "Replace") and not set(special) & set(MARKS))


def _encode(version: str, definition: str, texts: list[str]) -> list[int]:
    out: list[int] = []
    for a in range(0, len(texts), 1000):
        out += map(len, _tokenizer(version, definition).encode_batch_fast(texts[a:a + 1000], add_special_tokens=False))
    return out


def _count_words(words: list[bytes], version: str, definition: str, apart: bool) -> list[int]:
    """Tokens of distinct words. Words that differ in case or in the marks behind them share a core."""
    plain = [w.decode("utf-8", "replace") for w in words]
    if not apart:
        return _encode(version, definition, plain)
    cores, parts = _CORES.setdefault(version, {}), []
    for w in plain:
        letters = w.rstrip(MARKS)
        if letters.isalpha():
            parts.append((letters.lower() if letters.isascii() else letters, w[len(letters):]))
        else:
            parts.append((w, ""))
    if len(cores) > KNOWN_WORDS:
        cores.clear()
    cores[""] = 0
    new = list({c for pair in parts for c in pair if c not in cores})
    cores.update(zip(new, _encode(version, definition, new)))
    return [cores[a] + cores[b] for a, b in parts]


def count_tokens(texts: list[bytes], version: str, definition: str, by_word: bool) -> list[int]:
    """Tokens of each text, without added special tokens."""
    if not by_word:
        return [n for t in texts for n in _encode(version, definition, [t.decode("utf-8", "replace")])]
    known, out = _WORDS.setdefault(version, {}), []
    apart = punctuation_apart(definition)
    for a, b in blocks(texts, BLOCK_BYTES):
        split = [t.split() for t in texts[a:b]]
        used = set().union(*split)
        new = list(used.difference(known))
        known.update(zip(new, _count_words(new, version, definition, apart)))
        out += [sum(map(known.__getitem__, words)) for words in split]
        if len(known) > KNOWN_WORDS:    # for the next texts
            known = _WORDS[version] = {w: known[w] for w in used}
    return out


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """digest, n_tokens of the tokenizer version; an entry appended twice counts once."""
    try:
        table = spark.read.schema(CACHE).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        table = spark.createDataFrame([], CACHE)
    return table.where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _once(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blank the text of rows whose digest this task has passed already."""
    seen: set[bytes] = set()
    for batch in rows:
        drop = []
        for digest in batch.column("digest").to_pylist():
            drop.append(digest in seen)
            seen.add(digest)
        at = batch.schema.get_field_index("bytes")
        yield batch.set_column(at, "bytes", pc.if_else(pa.array(drop, pa.bool_()), pa.scalar(None, batch.column(at).type), batch.column(at)))


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str, text_col: str = "text",
                 id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens of every row; the cache at ``cache_path`` (a shared
    folder, made if missing) has an entry for each text afterwards.

    Null text counts as empty (0 bytes, 0 tokens), null and repeated ids pass through. An
    empty table leaves the cache as it is. Texts are read and digested once and move once, and a text that many
    rows share at most once per task; rows without a text move anywhere, so no partition gathers copies.
    """
    spark = docs.sparkSession
    definition = tokenizer_text(tokenizer_path)
    version = hashlib.sha256(definition.encode()).hexdigest()
    by_word = counts_by_word(definition)
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    text = (F.regexp_replace(text, SPACES, " ") if by_word else text).cast("binary")
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), F.length(utf8(text_col)).cast("long").alias("n_bytes"),
                       F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("bytes"))
    known = read_cache(spark, cache_path, version)
    if not known.isEmpty():
        rows = rows.join(known.select("digest", F.lit(True).alias("counted")), "digest", "left").select(
            "doc_id", "n_bytes", "digest", F.when(F.col("counted").isNull(), F.col("bytes")).alias("bytes"))
    # a row with a text goes to its digest's partition, another to any
    place = F.when(F.col("bytes").isNotNull(), F.xxhash64("digest")).otherwise(F.monotonically_increasing_id())
    rows = rows.mapInArrow(_once, "doc_id long, n_bytes long, digest binary, bytes binary").withColumn("place", place).repartition(shuffle_partitions(spark), "place").drop("place")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _once(batches):
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                here = part.column("bytes").is_valid()
                n = iter(count_tokens(part.column("bytes").filter(here).to_pylist(), version, definition, by_word))
                counts = pa.array([next(n) if x else None for x in here.to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in ("doc_id", "n_bytes", "digest")], counts], ["doc_id", "n_bytes", "digest", "n_tokens"])

    counted = materialise(rows.mapInArrow(encode, "doc_id long, n_bytes long, digest binary, n_tokens long"), "token-counts")
    counted.where("n_tokens is not null").select(F.lit(version).alias("tokenizer"), "digest", "n_tokens").write.mode("append") \
        .option("compression", "zstd").parquet(cache_path)
    # most rows have their count: only the others need the cache
    rest = counted.where("n_tokens is null").drop("n_tokens").join(read_cache(spark, cache_path, version), "digest")
    return counted.where("n_tokens is not null").select("doc_id", "n_bytes", "n_tokens").unionByName(rest.select("doc_id", "n_bytes", "n_tokens"))
