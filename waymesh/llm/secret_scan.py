"""Secret scanning with corpus-wide ownership frequency, DataFrame operations only.

Patterns give candidate spans. The values of base spans and others that look live (long,
mixed, no placeholder words) are hashed, and the hashes are counted over the corpus by
distinct owners and repositories: a value that many owners have is an example that was
copied; one that belongs to few is a credential of its owner. The base spans always stay;
a value of few owners that looks live adds a span of kind ``live`` over the value itself.

Texts never leave the scan: what is aggregated, joined and kept are spans and hashes. A
value that a third of all rows hold is counted after (value, owner) pairs were combined
on the map side; the counts of the few values that are so common are broadcast to their
spans, and only the others are shuffled.

Defined cases: a null or empty text has no spans. A null owner counts as one owner.
Repeated rows are each returned with the same spans; extra columns are ignored. Texts
are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymesh.llm.common import fresh, let, sums_before
from waymesh.plans.hot import unique_join
from waymesh.plans.durable import checkpointed

#: Fixed patterns of the base kinds, in their order.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = r"AKIA[A-Z0-9]+", r"[0-9a-f]+"
KINDS, LIVE = ("assign", "access", "hex"), "live"
#: Runs that may hold a credential of another form.
RUN = r"[A-Za-z0-9+/_-]{32,}"
PLACEHOLDER = r"(?i)example|sample|change_?me|placeholder|dummy|xxxx|your_|test"
MAYBE = r"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{24}|[A-Za-z0-9+/_-]{32}"
OPEN, CLOSE = "\x02", "\x03"
FOUND = "array<struct<start:int,end:int,match:string>>"


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with their code points, end exclusive. They are set
    in marks that no pattern matches; where the text has such marks itself, others stand in."""
    marked = F.regexp_replace(F.replace(F.replace(text, F.lit(OPEN), F.lit("\x04")), F.lit(CLOSE), F.lit("\x04")), pattern, f"{OPEN}$0{CLOSE}")

    def placed(pieces: Column) -> Column:
        rest = F.slice(pieces, 2, F.size(pieces))
        first = F.length(F.get(pieces, F.lit(0)))
        starts = sums_before(F.transform(rest, lambda p: F.length(p) - 1))

        def one(piece: Column, before: Column) -> Column:
            size = F.locate(CLOSE, piece) - 1
            at = (first + before).cast("int")
            return F.struct(at.alias("start"), (at + size).alias("end"), F.substring(piece, F.lit(1), size).alias("match"))

        return F.zip_with(rest, starts, one)

    return let(F.split(marked, OPEN), placed).cast(FOUND)


def looks_live(value: Column) -> Column:
    """Long enough, many different characters, letters and digits, no placeholder word."""
    different = F.size(F.array_distinct(F.split(value, "")))
    return (F.length(value) >= 16) & (different >= 8) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & ~value.rlike(PLACEHOLDER)


def scan(docs: DataFrame, text: str = "text", owner: str = "source", repository: str | None = None) -> DataFrame:
    """(doc_id, owner, repository, text_hash, spans) per row; a span has kind, rank, start,
    end, and for base values and others that look live their place, sha256 and whether they do."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select("doc_id", F.col(owner).alias("owner"), F.col(repository or owner).alias("repository"), t.alias("t"))
    value = lambda m: F.regexp_extract(m["match"], f"^{ASSIGN}$", 2)

    def spans(kind: str, found: Column, inner: object = None) -> Column:
        def span(m: Column) -> Column:
            v = inner(m) if inner else m["match"]
            hashed = F.struct((m["end"] - F.length(v)).alias("start"), m["end"].alias("end"), F.sha2(v.cast("binary"), 256).alias("sha256"), looks_live(v).alias("looks"))
            return F.struct(
                F.lit(kind).alias("kind"), F.lit([*KINDS, LIVE].index(kind)).alias("rank"), m["start"].alias("start"), m["end"].alias("end"),
                (F.when(looks_live(v), hashed) if kind == LIVE else hashed).alias("value"),
            )

        return F.transform(found, span)

    all_spans = F.concat(
        spans("assign", F.filter(matches(F.col("t"), ASSIGN), lambda m: F.length(value(m)) >= 6), value),
        spans("access", F.filter(matches(F.col("t"), ACCESS), lambda m: F.length(m["match"]) >= 20)),
        spans("hex", matches(F.col("t"), f"{HEX[:-1]}{{24,}}")),  # runs are maximal, so the short ones can be passed over
        spans(LIVE, matches(F.col("t"), RUN)),
    )
    made = rows.withColumn("spans", F.when(F.col("t").rlike(MAYBE), all_spans))
    empty = F.filter(all_spans, lambda x: F.lit(False))
    return made.select("doc_id", "owner", "repository", F.xxhash64("t").alias("text_hash"), F.coalesce("spans", F.when(F.lit(False), empty)).alias("spans"))


def ownership(found: DataFrame) -> DataFrame:
    """(sha256, owners, repositories, uses) of every hashed value."""
    values = found.select("owner", "repository", F.explode("spans.value").alias("v")).where("v is not null")
    values = values.select(F.col("v.sha256").alias("sha256"), F.coalesce("owner", F.lit("")).alias("owner"), F.coalesce("repository", F.lit("")).alias("repository"))
    # distinct owners from the distinct pairs: owner first, then value, so no set is held in memory
    by_both = values.groupBy("sha256", "owner", "repository").agg(F.count("*").alias("uses"))
    by_owner = by_both.groupBy("sha256", "owner").agg(F.count("*").alias("n"), F.sum("uses").alias("uses"))
    return by_owner.groupBy("sha256").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"), F.sum("uses").alias("uses"))


def judged(found: DataFrame, most_owners: int = 2, most_repositories: int = 4) -> DataFrame:
    """(doc_id, text_hash, start, end, looks, live) for the hashed values; ``live`` if few
    own them."""
    values = found.select("doc_id", "text_hash", F.explode("spans.value").alias("v")).where("v is not null").select("doc_id", "text_hash", "v.*")
    live = (F.col("owners") <= most_owners) & (F.col("repositories") <= most_repositories)
    made = unique_join(values, checkpointed(ownership(found)), "sha256", "uses")
    return made.select("doc_id", "text_hash", "start", "end", "looks", live.alias("live")).distinct()


def _said(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _joined(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on doc_id and text_hash, a null id being an id like others."""
    right = right.withColumnsRenamed({"doc_id": "id_", "text_hash": "hash_"})
    return left.join(right, left["doc_id"].eqNullSafe(right["id_"]) & (left["text_hash"] == right["hash_"]), "left").drop("id_", "hash_")


def op10_secret_scan(docs: DataFrame) -> DataFrame:
    found = checkpointed(scan(docs))
    added = judged(found).where("live AND looks").groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", F.lit(3).alias("rank"), F.lit(LIVE).alias("kind"), "end")).alias("added"))
    plain = F.transform(F.filter("spans", lambda s: s["rank"] < 3), lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")))
    base = found.select("doc_id", "text_hash", F.sort_array(F.coalesce(plain, F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>"))).alias("base"))
    both = _joined(base, added).withColumn("spans", F.sort_array(F.concat("base", F.coalesce("added", F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")))))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return both.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(_said(F.col("base")).cast("binary"), 256).alias("base_sha256"), _said(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with ``mark`` in place of every base span's value and every live value, but
    for values that many owners share: those are examples and stay. ``n_chars`` follows,
    where there is such a column."""
    found = checkpointed(scan(docs, text).where(F.size("spans") > 0))
    own, verdicts = fresh(docs, "redactions"), judged(found)
    spans = found.select("doc_id", "text_hash", F.explode("spans").alias("s")).select("doc_id", "text_hash", F.col("s.rank").alias("rank"), F.coalesce("s.value.start", "s.start").alias("start"), F.coalesce("s.value.end", "s.end").alias("end")).distinct()
    spans = spans.join(verdicts.withColumnsRenamed({"doc_id": "id_", "text_hash": "hash_", "start": "start_", "end": "end_"}), F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("text_hash") == F.col("hash_")) & (F.col("start") == F.col("start_")) & (F.col("end") == F.col("end_")), "left")
    spans = spans.where(F.coalesce("live", F.col("rank") < 3)).groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias(own))
    kept, touched = docs.where(~F.coalesce(F.col(text).rlike(MAYBE), F.lit(False))), docs.where(F.col(text).rlike(MAYBE))
    key = fresh(docs, "text_hash")
    spans = spans.withColumnsRenamed({"doc_id": "id_of_span", "text_hash": "hash_of_span"})
    named = touched.withColumn(key, F.xxhash64(text))
    joined = named.join(spans, named["doc_id"].eqNullSafe(spans["id_of_span"]) & (named[key] == spans["hash_of_span"]), "left")
    old = F.col(text)

    def cut(a: Column, s: Column) -> Column:
        piece = F.when(s["start"] >= a["at"], F.concat(F.substring(old, a["at"] + 1, s["start"] - a["at"]), F.lit(mark))).otherwise(F.lit(""))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.concat(a["made"], piece).alias("made"))

    new = F.aggregate(F.col(own), F.struct(F.lit(0).alias("at"), F.lit("").alias("made")), cut, lambda a: F.concat(a["made"], F.substring(old, a["at"] + 1, F.length(old))))
    changed = {text: F.when(F.size(own) > 0, new).otherwise(old)}
    made = joined.withColumns(changed)
    if "n_chars" in docs.columns:
        made = made.withColumn("n_chars", F.when(F.size(own) > 0, F.length(text)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return kept.unionByName(made.select(*docs.columns))
