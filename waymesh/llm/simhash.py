"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits, a bit being set if it is set in over half of the hashes of the
text's word shingles. Fingerprints within distance 2 link. Cut in two segments of 32 bits,
such a pair differs in at most one bit of the lower or in none of the upper one. So the
table of distinct fingerprints is looked up by the upper segment as it is, and by the Hamming
ball of radius 1 around the lower one; complete distances verify what is found. Of two
values that differ in one bit only the one without the bit looks for the other.

A table entry that over ``most_in_entry`` distinct fingerprints share (large groups of near
copies) would give pairs without bound. The fingerprints that meet such an entry go another
exact way: each is listed under the 65 values within distance 1 of it. All that are under
one value are within distance 2 of each other, at most 65 of them are there, and any two
within distance 2 meet under some value; a bit mask per value, combined before the shuffle,
is all that is kept. They are linked to one of them, not to each other.

Defined cases: a null, empty or blank text has fingerprint 0 and links like any other.
Repeated rows are one vertex and all returned. A null id never represents a group; a group
of null ids only has a null component. Texts are read whole, hashes in bounded chunks.
"""

from __future__ import annotations

from functools import partial
from itertools import islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymesh.llm.common import fresh
from waymesh.operators.components import connected_components
from waymesh.plans.durable import checkpointed, written
from waymesh.plans.hot import unique_join

SEED, CHUNK, LOW = 42, 1 << 16, 0xFFFFFFFF
#: Ids (with a fingerprint each, 16 bytes) up to which those that go are broadcast.
BROADCAST_IDS = 500_000


def fingerprint_of(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit fingerprint of a text."""
    # lower() and split() of bytes touch A-Z and the six blanks of ASCII only
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        shingles, total = iter([b" ".join(words)]), 1
    else:
        shingles, total = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False)), len(words) - shingle + 1
    digest, ones = partial(xxhash.xxh64_intdigest, seed=SEED), np.zeros(64, dtype=np.int64)
    while len(part := np.fromiter(map(digest, islice(shingles, CHUNK)), dtype="<u8")):
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprint(text: Column | str, shingle: int = 3) -> Column:
    @F.pandas_udf("long")
    def made(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    return made(text)


def _lower() -> Column:
    return F.col("fp").bitwiseAND(F.lit(LOW))


def _upper() -> Column:
    return F.shiftrightunsigned("fp", 32) + F.lit(1 << 32)


def _bits(count: int) -> Column:
    """Array of the long powers of two, 2^0 first."""
    return F.array(*[F.lit((1 << k) - (1 << 64 if k == 63 else 0)).cast("long") for k in range(count)])


def links(prints: DataFrame, most_in_entry: int = 64) -> DataFrame:
    """Edges (source, target) that join the distinct fingerprints ``fp`` of ``prints`` as
    all pairs within distance 2 would: those pairs, or chains of such pairs."""
    table = prints.select("fp", F.explode(F.array(_lower(), _upper())).alias("entry"))
    sizes = table.groupBy("entry").count()
    crowded = sizes.where(F.col("count") > most_in_entry).select("entry", F.lit(True).alias("full"))
    entries = table.join(sizes.where(F.col("count") <= most_in_entry).select("entry"), "entry").select("entry", F.col("fp").alias("other"), F.lit(False).alias("full"))
    entries = entries.unionByName(crowded.withColumn("other", F.lit(None).cast("long")))
    clear = F.filter(_bits(32), lambda b: F.col("fp").bitwiseAND(b) == 0)
    ball = F.transform(clear, lambda b: _lower() + b)
    probes = prints.select("fp", F.explode(F.concat(F.array(_lower(), _upper()), ball)).alias("entry"))
    near = F.col("full") | ((F.col("fp") != F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= 2))
    met = checkpointed(probes.join(entries, "entry").where(near).select("fp", "other", "full").distinct())
    found = met.where("not full").select(F.col("fp").alias("source"), F.col("other").alias("target"))
    # a crowded entry's own fingerprints look it up too, so this has both sides of any pair
    listed = met.where("full").select("fp", F.posexplode(F.concat(_bits(64), F.array(F.lit(0).cast("long")))).alias("k", "bit"))
    under = listed.select(F.col("fp").bitwiseXOR(F.col("bit")).alias("value"), "bit", (F.col("bit") == 0).alias("itself"))
    shared = under.groupBy("value").agg(F.bit_or("bit").alias("mask"), F.max("itself").alias("itself")).where(F.bit_count("mask") + F.col("itself").cast("int") > 1)
    members = F.transform(F.filter(_bits(64), lambda b: F.col("mask").bitwiseAND(b) != 0), lambda b: F.col("value").bitwiseXOR(b))
    members = F.when(F.col("itself"), F.concat(F.array("value"), members)).otherwise(members)
    stars = shared.select(members.alias("m")).select(F.col("m")[0].alias("source"), F.explode(F.slice("m", 2, 65)).alias("target"))
    return found.unionByName(stars)


def components(prints: DataFrame, most_in_entry: int = 64) -> DataFrame:
    """(fp, component_id, copies) from rows (doc_id, fp): the least id reachable by links and
    the number of rows."""
    distinct = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies")))
    joined = checkpointed(connected_components(links(distinct, most_in_entry)).withColumnRenamed("node", "fp"))
    tied = joined.join(distinct, "fp").select("fp", "component", "first_id")
    least = checkpointed(tied.groupBy("component").agg(F.min("first_id").alias("component_id"), F.count("*").alias("uses")))
    tied = unique_join(tied.select("fp", "component"), least, "component", "uses").select("fp", "component_id")
    return checkpointed(distinct.join(tied, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id"), "copies"))


def op6_simhash_dedup(docs: DataFrame) -> DataFrame:
    prints = checkpointed(docs.select("doc_id", fingerprint("text").alias("fp")))
    made = unique_join(prints, components(prints), "fp", "copies")
    return made.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the least id, with its columns. Documents
    with a null id stay only where no other is in the group.

    Documents are written once with their fingerprints; then only ids and fingerprints are
    moved, and the ids of what goes are broadcast if they are at most ``BROADCAST_IDS``."""
    fp = fresh(docs, "fp")
    marked = written(docs.withColumn(fp, fingerprint("text")), "fingerprints")
    prints = marked.select("doc_id", F.col(fp).alias("fp"))
    placed = unique_join(prints, components(prints), "fp", "copies")
    dropped = checkpointed(placed.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "fp").distinct())
    lost = dropped.select(F.col("doc_id").alias("lost_id"), F.col("fp").alias("lost_fp"))
    lost = F.broadcast(lost) if dropped.count() <= BROADCAST_IDS else lost
    kept = marked.join(lost, marked["doc_id"].eqNullSafe(lost["lost_id"]) & (marked[fp] == lost["lost_fp"]), "left_anti")
    if not prints.groupBy("doc_id", "fp").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", fp])  # rows given twice
    return kept.drop(fp)
