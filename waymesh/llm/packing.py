"""Packing by power-of-two decomposition.

A document of n ids is cut into pieces of at most ``longest`` ids (a power of two): as many
of that length as fit, then one for every binary digit of the rest, longest first. Every
piece is a sequence of its own, so no sequence crosses documents, and none needs padding.
Sequences of one length are numbered together, shortest length first: those of a length
are one bucket, and a batch is drawn from one bucket.

Numbers come without a shuffle of ids: each task counts its own pieces by length while it
writes them; the totals by task and length, a few rows for each task, give each task the
number it starts from.

Defined cases: a null or empty text is one sequence of the end id alone. A null id is kept.
Repeated rows are packed again. Extra columns are ignored. Texts are encoded whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymesh.llm.encoding import encoder
from waymesh.plans.durable import written

LONGEST, END_ID = 1024, 0
#: Documents whose pieces make one batch; rows of totals up to which they are broadcast.
BATCH_DOCS, BROADCAST_ROWS = 256, 200_000


def piece_lengths(n: int, longest: int = LONGEST) -> list[int]:
    """Lengths of the pieces of n ids, in order."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def cut(docs: DataFrame, vocabulary: str, text: str = "text", longest: int = LONGEST, end_id: int = END_ID) -> DataFrame:
    """Rows (doc_id, start, length, ids, doc_tokens, part, number): a piece, its ids as
    little-endian unsigned 32-bit bytes, and its number among its task's pieces of the length."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, numbers = encoder(vocabulary).encode, TaskContext.get().partitionId(), {}
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_DOCS):
                batch = whole.slice(at, BATCH_DOCS)
                row, start, length, ids, total, number = [], [], [], [], [], []
                for k, t in enumerate(batch.column(1).to_pylist()):
                    made, first = encode(t) + end, 0
                    n = len(made) // 4
                    for size in piece_lengths(n, longest):
                        row.append(k)
                        start.append(first)
                        length.append(size)
                        ids.append(made[4 * first : 4 * (first + size)])
                        total.append(n)
                        number.append(numbers.get(size, 0))
                        numbers[size] = number[-1] + 1
                        first += size
                longs = [pa.array(x, pa.int64()) for x in (start, length, total, number)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row, pa.int64())), longs[0], longs[1], pa.array(ids, pa.binary()), longs[2], pa.array([part] * len(row), pa.int64()), longs[3]],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "part", "number"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col(text).alias("t")).mapInArrow(pieces, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, part long, number long")


def pack(docs: DataFrame, vocabulary: str, text: str = "text", longest: int = LONGEST, end_id: int = END_ID) -> DataFrame:
    """The packed sequences, a written table: doc_id, start, length, ids, doc_tokens,
    sequence_id, offset. ``length`` is the bucket."""
    pieces = written(cut(docs, vocabulary, text, longest, end_id), "packed")
    totals = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    # a row for each task and length, nothing of the pieces
    before = Window.orderBy("length", "part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    rows = docs.rdd.getNumPartitions() * (longest.bit_length() + 1)
    firsts = F.broadcast(firsts) if rows <= BROADCAST_ROWS else firsts
    return pieces.join(firsts, ["length", "part"]).select("doc_id", "start", "length", "ids", "doc_tokens", (F.col("first") + F.col("number")).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def op1_packing(docs: DataFrame, vocabulary: str) -> DataFrame:
    return pack(docs, vocabulary).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


