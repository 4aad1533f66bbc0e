"""Word tables of document blocks.

A corpus-wide word table must not be broadcast, and a row per word occurrence is too much to
shuffle. Here a task turns its documents into *blocks*: the documents as compressed local word
numbers, and the block's distinct words once, split by word hash into *shelves*. Only the shelves
travel: a shelf task sees each word of every block, answers once per distinct word, and sends the
answers back to the blocks in the order of the words.

Blocks are written once to the shared folder, bucketed by block, so that the answers come to them
and they are not shuffled. A lost executor rereads the written blocks, never renumbers words.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from liftworks.sources import fresh_dir

from liftworks.llm.text import binaries, pack_bytes, pack_ints, unpack_bytes, unpack_ints

#: Bytes of text after which a block ends (a longer document is a block of its own).
BLOCK_BYTES = 24 << 20
#: Bytes of text whose documents form one row of a block.
CHUNK_BYTES = 4 << 20

_SCHEMA = "block long, shelf int, doc_ids array<long>, flags binary, lengths binary, words binary, counts binary"


class Numbers(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word):
        number = self[word] = len(self)
        return number


def write_blocks(
    docs: DataFrame,
    split: Callable[[bytes], list],
    flag: Callable[[int | None], bool],
    shelves: int,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Blocks of ``docs`` (doc_id, text), written to the shared folder.

    Rows with a null shelf hold documents (``doc_ids``, ``flags``, ``lengths``, ``words`` as local
    word numbers); others hold the block's distinct words of one shelf in number order
    (``words``), and how often each occurs in flagged documents (``counts``).
    """
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, turn = TaskContext.get().partitionId(), 0
        numbers, counts, size = Numbers(), [], 0
        ids, flags, lengths, words, chunk_size = [], [], [], [], 0
        rows: list[tuple] = []

        def chunk():
            nonlocal ids, flags, lengths, words, chunk_size
            if ids:
                flat = np.concatenate(words) if words else np.zeros(0, np.uint32)
                marked = np.repeat(np.array(flags), np.array(lengths))
                counts.append(np.bincount(flat[marked], minlength=len(numbers)))
                rows.append((
                    (task << 32) | turn, None, ids,
                    np.array(flags, np.uint8).tobytes(), pack_ints(np.array(lengths)),
                    pack_ints(flat), None,
                ))
            ids, flags, lengths, words, chunk_size = [], [], [], [], 0

        def end():
            nonlocal numbers, counts, size, turn
            chunk()
            total = np.zeros(len(numbers), np.int64)
            for c in counts:
                total[: len(c)] += c
            names = [w if isinstance(w, bytes) else w.encode() for w in numbers]
            shelf = np.fromiter(map(zlib.crc32, names), np.uint32, len(names)) % shelves
            order = np.argsort(shelf, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(shelf[order])) + 1):
                if len(at):
                    rows.append((
                        (task << 32) | turn, int(shelf[at[0]]), None, None, pack_ints(at),
                        pack_bytes([names[i] for i in at.tolist()]), pack_ints(total[at]),
                    ))
            numbers, counts, size, turn = Numbers(), [], 0, turn + 1

        def out():
            nonlocal rows
            columns = list(zip(*rows))
            kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), *[pa.binary()] * 4]
            names = ["block", "shelf", "doc_ids", "flags", "lengths", "words", "counts"]
            rows = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), binaries(batch.column(1))):
                pieces = split(text)
                words.append(
                    np.fromiter(map(numbers.__getitem__, pieces), np.uint32, len(pieces))
                )
                ids.append(doc_id)
                flags.append(flag(doc_id))
                lengths.append(len(pieces))
                size += len(text)
                chunk_size += len(text)
                if chunk_size >= CHUNK_BYTES:
                    chunk()
                if size >= block_bytes:
                    end()
                    yield out()
        if ids or numbers:
            end()
            yield out()

    blocks = docs.select("doc_id", "text").mapInArrow(run, _SCHEMA)
    name = f"liftworks_blocks_{uuid.uuid4().hex}"
    (
        blocks.write.bucketBy(max(2, min(shelves, 4096)), "block")
        .option("path", fresh_dir(spark, "blocks"))
        .saveAsTable(name)
    )
    table = spark.table(name)
    table.count()  # resolves the files, so the name is needed no more
    spark.sql(f"DROP TABLE {name}")  # the catalog's entry; the files are the shared folder's
    return table


def answer(
    blocks: DataFrame,
    shelves: int,
    reply: Callable[[Iterator[tuple[list[bytes], np.ndarray]]], Iterator[bytes]],
) -> DataFrame:
    """(block, numbers, answers) for each block and shelf.

    ``reply`` gets an iterator factory over (words, counts) of all blocks of a shelf task and
    yields one blob per item, in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]  # compressed words, some bytes each

        def items():
            for b in held:
                for words, counts in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                    yield unpack_bytes(words), unpack_ints(counts).astype(np.int64)

        replies = reply(items)
        for b in held:
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    pa.array([next(replies) for _ in range(b.num_rows)], pa.binary()),
                ],
                names=["block", "numbers", "answers"],
            )

    return (
        blocks.filter("shelf is not null")
        .select("shelf", "block", F.col("lengths").alias("numbers"), "words", "counts")
        .repartition(shelves, "shelf")
        .drop("shelf")
        .mapInArrow(run, "block long, numbers binary, answers binary")
    )


def shelves_for(docs: DataFrame, bytes_per_shelf: int = BLOCK_BYTES) -> int:
    """Shelf tasks for an input: one for so many bytes of text."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(2, size // bytes_per_shelf + 1)
