"""Token ids in a content-addressed store.

A store is a folder of three tables:

* ``chunks``: sha256 of a chunk's bytes, number of ids, the ids, each chunk once. Ids take
  two bytes where the vocabulary allows it, else four, little-endian.
* ``recipes``: per document, in ascending order of its id, the place of its first id, the
  number of ids, its chunks' hashes and where each ends, and the document's root, the
  sha256 of all these.
* ``manifest``: per shard (a range of documents) their number and its root, the sha256 of
  the documents' roots in order; and in a row of its own, shard -1, the number of all
  documents and the store's root, the sha256 of the shards' numbers and roots in order.

A hash over the last 16 ids that rolls along the stream cuts where its low bits are zero,
so that equal passages of different documents give equal chunks wherever they begin.

Reading verifies: a chunk's bytes give its hash and length; id, place, length, ends and hashes
give the document's root, roots the shard's, and those the store's; every chunk is there and as
long as its ends say. What doesn't fit raises. A document's crc32 is put together
from its chunks' crc32s, each moved by the bytes after it, so checking a store moves hashes
and not ids.

Defined cases: a null or empty text is the end id alone. A null id comes first. Repeated
ids and rows are stored again as recipes, their chunks once. Extra columns are ignored.
Texts are encoded whole.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymesh.llm.encoding import encoder
from waymesh.plans.durable import checkpointed, remove, table_path
from waymesh.plans.hot import counted_left_join
from waymesh.plans.prefix import running_totals

END_ID = 2
#: Least, mean beyond the least, and most ids of a chunk; ids under the rolling hash.
LEAST, MEAN, MOST, WINDOW = 256, 512, 4096, 16
#: Documents in one batch; hashes of chunks already written that a task remembers.
BATCH_DOCS, REMEMBERED = 256, 200_000
POLYNOMIAL = 0xEDB88320  # of crc32, lowest power at the highest bit


def marks(ids: np.ndarray) -> np.ndarray:
    """Places after which the rolling hash allows a cut. Streams set end to end can be
    marked at once: no cut is as near to a stream's start as the window is long."""
    mixed = ((ids.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)) >> np.uint32(4)
    rolled = np.zeros(len(ids), dtype=np.uint32)
    for k in range(min(WINDOW, len(ids))):
        rolled[k:] += mixed[: len(ids) - k] << np.uint32(k)
    # the high bits have seen the whole window
    return np.flatnonzero(rolled >> np.uint32(32 - (MEAN.bit_length() - 1)) == 0) + 1


def cuts(n: int, marked: np.ndarray) -> list[int]:
    """Ends of the chunks of a stream of n ids with the given marks."""
    ends, at = [], 0
    while n - at > LEAST:
        k = int(np.searchsorted(marked, at + LEAST))
        at = min(int(marked[k]) if k < len(marked) else n, at + MOST, n)
        ends.append(at)
    if at < n:
        ends.append(n)
    return ends


def staged(docs: DataFrame, vocabulary: str, width: int, text: str = "text", end_id: int = END_ID) -> DataFrame:
    """Per document its id, number of ids, chunk hashes and ends, the bytes of the chunks
    that its task hasn't met yet, and task and row as a tie-break."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, row, met = encoder(vocabulary).encode, TaskContext.get().partitionId(), 0, set()
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_DOCS):
                batch = whole.slice(at, BATCH_DOCS)
                n, hashes, ends, fresh, from_ = [], [], [], [], 0
                streams = [encode(t) + end for t in batch.column(1).to_pylist()]
                together = np.frombuffer(b"".join(streams), dtype="<u4")
                marked, small = marks(together), together.astype(f"<u{width}")
                for stream in streams:
                    ids = small[from_ : (upto := from_ + len(stream) // 4)]
                    mine = marked[np.searchsorted(marked, from_, side="right") : np.searchsorted(marked, upto, side="right")] - from_
                    data, places, first, h, f = ids.tobytes(), cuts(len(ids), mine), 0, [], []
                    from_ = upto
                    for last in places:
                        piece = data[width * first : width * last]
                        h.append(key := hashlib.sha256(piece).digest())
                        if key not in met:
                            if len(met) >= REMEMBERED:
                                met.clear()
                            met.add(key)
                            f.append({"hash": key, "n": last - first, "ids": piece})
                        first = last
                    n.append(len(ids))
                    hashes.append(h)
                    ends.append(places)
                    fresh.append(f)
                count = len(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array(n, pa.int64()), pa.array(hashes, pa.list_(pa.binary())), pa.array(ends, pa.list_(pa.int64())),
                        pa.array(fresh, pa.list_(pa.struct([("hash", pa.binary()), ("n", pa.int64()), ("ids", pa.binary())]))),
                        pa.array([part] * count, pa.int64()), pa.array(range(row, row + count), pa.int64()),
                    ],
                    names=["doc_id", "n_tokens", "hashes", "ends", "fresh", "part", "row"],
                )
                row += count

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col(text).alias("t")).mapInArrow(chunked, f"doc_id {kind}, n_tokens long, hashes array<binary>, ends array<long>, fresh array<struct<hash:binary,n:long,ids:binary>>, part long, row long")


def root(hashes: Column) -> Column:
    """sha256 over hashes set end to end."""
    return F.unhex(F.sha2(F.unhex(F.array_join(F.transform(hashes, F.hex), "")), 256))


def document_root() -> Column:
    """sha256 over all that a recipe says, as text; a null id is told apart from any other."""
    said = F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("start").cast("string"), F.col("n_tokens").cast("string"), F.array_join(F.col("ends").cast("array<string>"), ","), F.array_join(F.transform("hashes", F.hex), ","))
    return F.unhex(F.sha2(said.cast("binary"), 256))


def shard_roots(recipes: DataFrame) -> DataFrame:
    """(shard, n_docs, root): a shard is one range of documents, as large as a task."""
    ordered = F.sort_array(F.collect_list(F.struct("start", "root")))
    return recipes.groupBy("shard").agg(F.count("*").alias("n_docs"), ordered.alias("r")).select("shard", "n_docs", root(F.col("r.root")).alias("root"))


def store_root(shards: DataFrame) -> DataFrame:
    """The same for the whole store, as shard -1; some 50 bytes a shard meet in one task."""
    said = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("shard", "n_docs", F.hex("root").alias("root")))), lambda x: F.concat_ws(" ", x["shard"].cast("string"), x["n_docs"].cast("string"), x["root"])), ",")
    return shards.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"), F.unhex(F.sha2(said.cast("binary"), 256)).alias("root")).select(F.lit(-1).alias("shard"), "n_docs", "root")


def write_store(docs: DataFrame, path: str, vocabulary: str, text: str = "text", end_id: int = END_ID) -> None:
    """Encode, cut and write a store below ``path``, a folder that all executors share."""
    spark = docs.sparkSession
    width = 2 if encoder(vocabulary).tokenizer.get_vocab_size() <= 1 << 16 else 4
    stage = f"{path}/staged"
    staged(docs, vocabulary, width, text, end_id).write.option("compression", "zstd").parquet(stage)
    made = spark.read.parquet(stage)
    chunks = made.select(F.explode("fresh").alias("c")).select("c.*")
    chunks.groupBy("hash").agg(F.first("n").alias("n"), F.first("ids").alias("ids")).write.option("compression", "zstd").parquet(f"{path}/chunks")
    placed = running_totals(made.select("doc_id", "part", "row", "n_tokens", "hashes", "ends"), ["doc_id", "part", "row"], ["n_tokens"])
    recipes = placed.select("shard", "doc_id", F.col("n_tokens_before").alias("start"), "n_tokens", "hashes", "ends").withColumn("root", document_root())
    # running totals leave each shard in order and in one task
    recipes.write.option("compression", "zstd").parquet(f"{path}/recipes")
    shards = checkpointed(shard_roots(spark.read.parquet(f"{path}/recipes")))
    shards.unionByName(store_root(shards)).write.parquet(f"{path}/manifest")
    remove(spark, stage)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of polynomials over GF(2) modulo crc32's, element by element."""
    product, b = np.zeros_like(b), b.copy()
    for k in range(31, -1, -1):
        product ^= np.where(a >> np.uint32(k) & np.uint32(1), b, np.uint32(0))
        b = np.where(b & np.uint32(1), b >> np.uint32(1) ^ np.uint32(POLYNOMIAL), b >> np.uint32(1))
    return product


def moved(crc: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The part of a whole's crc32 that comes from a piece with ``after`` bytes behind it."""
    power, square, bits = np.full(len(crc), 1 << 31, dtype=np.uint32), np.array([1 << 30], dtype=np.uint32), after.astype(np.int64) * 8
    while bits.any():
        odd = (bits & 1).astype(bool)
        power[odd] = times(np.full(int(odd.sum()), square[0], dtype=np.uint32), power[odd])
        square, bits = times(square, square), bits >> 1
    return times(power, crc.astype(np.uint32))


def moved_crc(crc: Column | str, after: Column | str) -> Column:
    @F.pandas_udf("long")
    def made(crcs: pd.Series, afters: pd.Series) -> pd.Series:
        return pd.Series(moved(crcs.to_numpy().astype(np.uint32), afters.to_numpy()).astype(np.int64))

    return made(crc, after)


def checked_chunks(chunks: DataFrame) -> DataFrame:
    """(hash, n, crc) of each chunk, the crc over four bytes an id; raises where a chunk's
    bytes don't give its hash or length."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, crcs = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for key, n, data in zip(keys, sizes, batch.column(2).to_pylist(), strict=True):
                if hashlib.sha256(data).digest() != key or len(data) not in (2 * n, 4 * n):
                    raise ValueError(f"chunk {key.hex()} is damaged")
                crcs.append(zlib.crc32(np.frombuffer(data, dtype=f"<u{len(data) // n}").astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(crcs, pa.int64())], names=["hash", "n", "crc"])

    return chunks.select("hash", "n", "ids").mapInArrow(check, "hash binary, n long, crc long")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files and verified."""
    recipes, manifest = spark.read.parquet(f"{path}/recipes"), spark.read.parquet(f"{path}/manifest")
    found = checkpointed(shard_roots(recipes.withColumn("root", document_root())))
    found = found.unionByName(store_root(found))
    wrong = found.alias("a").join(manifest.alias("b"), "shard", "full").where("NOT (a.root <=> b.root AND a.n_docs <=> b.n_docs)")
    if not wrong.isEmpty():
        raise ValueError(f"{path}: the recipes don't match the manifest")
    pieces = F.zip_with("hashes", F.transform("ends", lambda e, k: F.struct(e.alias("end"), F.when(k == 0, F.lit(0)).otherwise(F.get("ends", k - 1)).alias("begin"))), lambda h, e: F.struct(h.alias("hash"), e["begin"].alias("begin"), e["end"].alias("end")))
    entries = recipes.select("doc_id", "start", "n_tokens", F.explode(pieces).alias("e")).select("doc_id", "start", "n_tokens", "e.hash", (F.col("e.end") - F.col("e.begin")).alias("n"), ((F.col("n_tokens") - F.col("e.end")) * 4).alias("after"))
    known = checkpointed(checked_chunks(spark.read.parquet(f"{path}/chunks")).withColumnRenamed("n", "n_"))
    # the few chunks that very many documents have (the end id alone) are broadcast
    joined = counted_left_join(entries, known, "hash")
    fits = F.when(F.col("n_") == F.col("n"), F.col("crc")).otherwise(F.raise_error(F.concat(F.lit("a chunk is missing or of another length at "), F.col("start").cast("string"))).cast("long"))
    parts = joined.select("doc_id", "start", "n_tokens", "n", moved_crc(fits, F.col("after")).alias("crc"))
    whole = parts.groupBy("start", "doc_id", "n_tokens").agg(F.bit_xor("crc").alias("ids_crc32"), F.sum("n").alias("n"))
    fits = F.when(F.col("n") == F.col("n_tokens"), F.col("n_tokens")).otherwise(F.raise_error(F.concat(F.lit("chunks are missing at "), F.col("start").cast("string"))).cast("long"))
    return whole.select("doc_id", "start", fits.alias("n_tokens"), "ids_crc32")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) with ids as little-endian unsigned 32-bit bytes; a
    document is put together in one task."""
    recipes = spark.read.parquet(f"{path}/recipes")
    entries = recipes.select("doc_id", "start", "n_tokens", F.posexplode("hashes").alias("k", "hash"))

    @F.pandas_udf("binary")
    def whole(ids: pd.Series, n: pd.Series) -> pd.Series:
        if any(x is None for p in ids for x in p):
            raise ValueError("a chunk is missing")
        return pd.Series([np.frombuffer(b"".join(p), dtype=f"<u{sum(map(len, p)) // k}").astype("<u4").tobytes() for p, k in zip(ids, n, strict=True)])

    joined = entries.join(spark.read.parquet(f"{path}/chunks").select("hash", "ids"), "hash", "left").groupBy("doc_id", "start", "n_tokens").agg(F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("p"))
    return joined.select("doc_id", "start", "n_tokens", whole(F.col("p.ids"), "n_tokens").alias("ids"))


def op2_token_store(docs: DataFrame, vocabulary: str) -> DataFrame:
    path = table_path(docs.sparkSession, "store")
    write_store(docs, path, vocabulary)
    return read_digests(docs.sparkSession, path)
