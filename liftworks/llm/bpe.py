"""Operator 10: BPE encoding and decoding through a distinct-word table.

Texts are split into words by the tokenizer's own pattern. Every distinct word is encoded once in
the whole corpus (``blocks.answer``), its ids go back to the positions of the word, and ids turn
into text again through the vocabulary's id-to-piece table. The table has as many rows as the
vocabulary (about 50,000), so every task can hold it.

Null texts are empty; an empty text has no ids. Special tokens in a text are ids of their own, as
the library encodes them. Extra columns are ignored; equal rows give equal results each.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from liftworks.llm.blocks import answer, shelves_for, write_blocks
from liftworks.llm.text import pack_ints, unpack_ints

#: Fixed value: the pattern by which byte-level BPE vocabularies split text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Characters whose letter, number and space classes no Unicode version has changed lately. Texts
#: with others are split by the library itself, whose Unicode version decides.
_SETTLED = re.compile(
    "[^\x00-\u0557\u0590-\u05ef\u0620-\u085f\u1e00-\u1fff\u2000-\u2070\u20a0-\u218b"
    "\u2190-\u2bff\u3041-\u3096\u30a0-\u30ff\u4e00-\u9fef\uac00-\ud7a3\uff01-\uffee]"
)


def special_tokens(path: str) -> list[str]:
    with open(path, encoding="utf-8") as f:
        return [t["content"] for t in json.load(f)["added_tokens"]]


def splitter(special: list[str]) -> Callable[[bytes], list[str]]:
    """Words of a text; special tokens are words."""
    from tokenizers import pre_tokenizers

    pattern = regex.compile(PATTERN)
    library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)

    def cut(text: str) -> list[str]:
        if _SETTLED.search(text):
            return [text[a:b] for _, (a, b) in library.pre_tokenize_str(text)]
        return pattern.findall(text)

    marks = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True))))

    def split(text: bytes) -> list[str]:
        text = text.decode("utf-8", "replace")
        if not special or not marks.search(text):
            return cut(text)
        out, at = [], 0
        for m in marks.finditer(text):
            out += cut(text[at : m.start()])
            out.append(m[0])
            at = m.end()
        return out + cut(text[at:])

    return split


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary: itself if it is visible Latin-1, else
    the next letter from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


def pieces(path: str) -> list[bytes]:
    """Bytes of each id of the vocabulary."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    letters, out = byte_letters(), {}
    for piece, i in model["model"]["vocab"].items():
        out[i] = bytes(letters[c] for c in piece)
    for token in model["added_tokens"]:
        out[token["id"]] = token["content"].encode()
    return [out.get(i, b"") for i in range(max(out) + 1)]


def encoder(path: str):
    """Function from distinct words to their ids, for use inside a task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()

    def encode(words: list[bytes]) -> list[list[int]]:
        texts = [w.decode() for w in words]
        return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]

    return encode


def _reply(path: str):
    def reply(items):
        known: dict[bytes, list[int]] = {}
        encode = encoder(path)
        for words, _ in items():
            new = [w for w in words if w not in known]
            known.update(zip(new, encode(new)))
            ids = [known[w] for w in words]
            lengths = pack_ints(np.fromiter(map(len, ids), np.uint32, len(ids)))
            flat = pack_ints(np.array([i for x in ids for i in x], dtype=np.uint32))
            yield len(lengths).to_bytes(4, "little") + lengths + flat

    return reply


def encode_blocks(docs: DataFrame, path: str):
    """Blocks of ``docs`` and the ids of their distinct words."""
    shelves = shelves_for(docs)
    blocks = write_blocks(docs, splitter(special_tokens(path)), lambda _: False, shelves)
    return blocks, answer(blocks, shelves, _reply(path))


def _word_ids(answers: pd.DataFrame) -> list[np.ndarray]:
    """Ids of each local word number of a block."""
    found: dict[int, np.ndarray] = {}
    for numbers, blob in zip(answers["numbers"], answers["answers"]):
        n = int.from_bytes(blob[:4], "little")
        ends = np.cumsum(unpack_ints(blob[4 : 4 + n]), dtype=np.int64)
        found.update(zip(unpack_ints(numbers).tolist(), np.split(unpack_ints(blob[4 + n :]), ends)))
    return [found[i] for i in range(len(found))]


def _per_document(docs: DataFrame, path: str, schema: str, make) -> DataFrame:
    """``make(pieces)`` gives a function from a block's word ids to one from a document's local
    word numbers to its output values."""
    blocks, answers = encode_blocks(docs, path)
    chunks = blocks.filter("shelf is null").select("block", "doc_ids", "lengths", "words")

    def run(chunk: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        document = make(pieces(path))(_word_ids(replies))
        rows = []
        for ids, lengths, words in zip(chunk["doc_ids"], chunk["lengths"], chunk["words"]):
            words, ends = unpack_ints(words).tolist(), np.cumsum(unpack_ints(lengths)).tolist()
            rows += [
                (i, *document(words[a:b])) for i, a, b in zip(ids, [0, *ends], ends)
            ]
        names = [f.split()[0] for f in ("doc_id long, " + schema).split(", ")]
        out = pd.DataFrame(rows, columns=names)
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    return chunks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        run, "doc_id long, " + schema
    )


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Number of ids, digest of the ids and of the decoded text of every document."""

    def make(table):
        def block(word_ids):
            names = [b",".join(b"%d" % i for i in x) for x in map(np.ndarray.tolist, word_ids)]
            texts = [b"".join([table[i] for i in x]) for x in map(np.ndarray.tolist, word_ids)]
            sizes = np.fromiter(map(len, word_ids), np.int64, len(word_ids))

            def document(words):
                ids = b",".join([names[w] for w in words])
                text = b"".join([texts[w] for w in words])
                return (
                    int(sizes[words].sum()) if words else 0,
                    hashlib.sha256(ids).hexdigest(),
                    hashlib.sha256(text).hexdigest(),
                )

            return document

        return block

    return _per_document(docs, path, "n_tokens long, ids_sha256 string, decoded_sha256 string", make)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every document."""

    def make(_):
        def block(word_ids):
            lists = [x.tolist() for x in word_ids]
            return lambda words: ([i for w in words for i in lists[w]],)

        return block

    return _per_document(docs, path, "ids array<int>", make)


def piece_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.createDataFrame(pd.DataFrame(enumerate(pieces(path)), columns=["id", "piece"]))


def decode(encoded: DataFrame, path: str, ids: Column | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, ids): a join of ids with pieces, put together by position.

    Rows are told apart by position in ``encoded``, so repeated doc_ids stay apart. Ids outside the
    vocabulary give nothing, null or empty ids give an empty text.
    """
    spark = encoded.sparkSession
    table = F.broadcast(piece_table(spark, path))  # as many rows as the vocabulary
    rows = encoded.select("doc_id", (F.col("ids") if ids is None else ids).alias("ids")).withColumn(
        "row", F.monotonically_increasing_id()
    )
    single = rows.select("doc_id", "row", F.posexplode_outer("ids").alias("pos", "id"))
    parts = F.array_sort(F.collect_list(F.struct("pos", "piece")))
    whole = F.aggregate(parts, F.lit("").cast("binary"), lambda a, p: F.concat(a, p["piece"]))
    return (
        single.join(table, "id", "left")
        .groupBy("row")
        .agg(F.first("doc_id").alias("doc_id"), whole.cast("string").alias("text"))
        .select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    )
