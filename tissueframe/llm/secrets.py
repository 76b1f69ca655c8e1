"""Secrets in texts, judged by who else holds them. DataFrame operations only.

Base spans come from three patterns. On top, any long token of mixed letters and
digits is a candidate. Candidate values are hashed and counted over the whole
corpus by repository (a document) and owner (its source). A value that several
owners hold is a copied example, unless one of them holds at least ``MAIN_SHARE`` percent of its
repositories: then the others copied it from there, and it stays that owner's. A value of one
owner looks live. The live candidates beside the base spans become spans of kind ``owned``.

Positions come from the pieces between matches: a match begins where the
lengths of all pieces and matches before it end, which is a running sum over the
matches of a text. Hot values are summed in three steps, each with partial
aggregation, and joined back over salted partitions.

Defined cases: a null or empty text has no span; rows alike in id and text get
the same result; owners that are null count as one owner; copies of one document
under one owner stay owner-specific however many there are; positions count code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tissueframe.plans.lineage import store
from tissueframe.plans.skew import attach

# Fixed values of the contract: kind, pattern, group that holds the value, least length of that group.
ASSIGN = "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
#: Long tokens; those with a letter and a digit are candidates. They begin at a token's start only.
TOKEN = "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"

KINDS = (("assign", ASSIGN, 2, 8), ("access", ACCESS, 0, 16), ("hex", HEX, 0, 32), ("owned", TOKEN, 0, 20))
#: Texts without a match of this have no span of the kind; cheaper than taking all short matches apart.
_PRESENT = {"hex": "[0-9a-f]{32}"}
BASE = 3

#: Owners from which on a value is a copied example.
COPIED_OWNERS = 2
#: Percent of a value's repositories from which on they make it their owner's.
MAIN_SHARE = 90

_LAST = (1 << 63) - 1
_ROW = ["_doc", "_hash"]


def _hits(kind: int) -> Column:
    """Matches of one kind in order: gap before, size, whether it counts, and the hash of its value."""
    name, pattern, group, least = KINDS[kind]
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all("text", F.lit(pattern), F.lit(group)) if group else found
    gaps = F.split("text", pattern, -1)

    def good(v: Column) -> Column:
        return (F.length(v) >= least) if kind < BASE else v.rlike("[0-9]") & v.rlike("[A-Za-z]")

    # ``gaps`` has one more piece, after the last match.
    joined = F.zip_with(F.zip_with(found, values, lambda a, b: F.struct(a.alias("m"), b.alias("v"))), gaps, lambda x, g: F.struct(
        F.lit(kind).alias("kind"), F.length(g).alias("gap"), F.length(x["m"]).alias("size"),
        good(x["v"]).alias("good"), F.when(good(x["v"]), F.sha2(x["v"].cast("binary"), 256)).alias("value"),
    ))
    return F.when(F.col("text").rlike(_PRESENT.get(name, pattern)), joined).otherwise(F.array().cast("array<struct<kind:int,gap:int,size:int,good:boolean,value:string>>"))


def _spans(rows: DataFrame) -> DataFrame:
    """``(_doc, _hash, owner, kind, start, end, value)`` of all candidate spans."""
    hits = rows.select(*_ROW, "owner", "_row", F.posexplode("hits").alias("_at", "_hit")).select(*_ROW, "owner", "_row", "_at", "_hit.*")
    order = Window.partitionBy("_row", "kind").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    ends = F.sum(F.coalesce("gap", F.lit(0)) + F.coalesce("size", F.lit(0))).over(order)
    return hits.withColumn("end", ends).where("good").select(*_ROW, "owner", "kind", (F.col("end") - F.col("size")).alias("start"), "end", "value")


def find_secrets(docs: DataFrame, copied_owners: int = COPIED_OWNERS, owner: str = "source", main_share: int = MAIN_SHARE) -> DataFrame:
    """One row per document: counts by kind, digests of the base spans, all spans, and how many values are live or copied.

    ``spans`` lists ``kind:start:end`` by start and then kind, comma-joined, code points with
    the end exclusive; ``repositories`` and ``owners`` list how many hold the values of these spans.
    ``n_live`` and ``n_copied`` count the base and added spans by the verdict on their value.
    """
    text = F.coalesce("text", F.lit(""))
    own = F.col(owner).cast("string") if owner in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id"), own.alias("owner"), text.alias("text"))
    rows = rows.select(
        "doc_id", "owner", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("_doc"), F.xxhash64("text").alias("_hash"),
        F.concat(*[_hits(k) for k in range(len(KINDS))]).alias("hits"),
    )
    rows = store(rows.withColumn("_row", F.monotonically_increasing_id()), "secret-hits")
    spans = store(_spans(rows).distinct(), "secret-spans")
    # Repositories by owner, then by value; every step adds up before it shuffles.
    held = spans.select("value", "owner", *_ROW).distinct().groupBy("value", "owner").agg(F.count("*").alias("_docs"))
    held = held.groupBy("value").agg(F.sum("_docs").alias("repositories"), F.count("*").alias("owners"), F.max("_docs").alias("_most"))
    copied = (F.col("owners") >= copied_owners) & (100 * F.col("_most") < main_share * F.col("repositories"))
    held = held.withColumn("copied", copied).drop("_most")
    known = attach(spans.drop("owner").distinct(), store(held, "secret-owners"), ["value"], spread=_ROW)
    # A candidate counts where no base span overlaps it: none that began before reaches in, none begins inside.
    by = Window.partitionBy(*_ROW)
    base = F.col("kind") < BASE
    reach = F.max(F.when(base, F.col("end"))).over(by.orderBy("start").rangeBetween(Window.unboundedPreceding, 0))
    following = F.min(F.when(base, F.col("start"))).over(by.orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, 0))
    free = (F.coalesce(reach, F.lit(-1)) <= F.col("start")) & (F.coalesce(following, F.lit(_LAST)) >= F.col("end"))
    judged = known.withColumn("_free", free).where(base | (F.col("_free") & ~F.col("copied")))
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    span = F.struct("start", "kind", F.concat_ws(":", F.get(names, F.col("kind")), "start", "end").alias("text"), "repositories", "owners")
    listed = judged.groupBy(*_ROW).agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{KINDS[k][0]}") for k in range(len(KINDS))],
        F.array_sort(F.collect_list(F.when(base, span))).alias("_base"), F.array_sort(F.collect_list(span)).alias("_all"),
        F.count(F.when(~F.col("copied"), 1)).alias("n_live"), F.count(F.when(F.col("copied"), 1)).alias("n_copied"),
    )

    def text_of(name: str, field: str = "text") -> Column:
        return F.coalesce(F.array_join(F.transform(name, lambda s: s[field].cast("string")), ","), F.lit(""))

    out = rows.select("doc_id", *_ROW).join(listed, _ROW, "left")
    counts = [f"n_{k[0]}" for k in KINDS] + ["n_live", "n_copied"]
    return out.select(
        "doc_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.sha2(text_of("_base").cast("binary"), 256).alias("base_sha256"), text_of("_all").alias("spans"),
        text_of("_all", "repositories").alias("repositories"), text_of("_all", "owners").alias("owners"),
    )
