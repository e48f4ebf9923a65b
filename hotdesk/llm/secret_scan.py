"""Secrets: pattern hits, and opaque values that one owner alone uses.

Every value that looks like a credential is hashed; the corpus tells by how many distinct
owners and repositories a hash is used. A value of many owners is an example that people
copied; one of a single owner looks live, in however many of its repositories, documents or
copies it stands. Base kinds (assign, access, hex) are reported
whatever the corpus says; opaque values are added when they are live and touch no base span.

Values are aggregated per (hash, owner, repository) before they are counted, so a value in a
third of all rows costs one row per task. DataFrame functions only.

Defined results: NULL text counts as empty; a NULL owner is an owner of its own; repeated
rows are scanned each on its own, and count once as owner and repository; a text of any length
is scanned whole, in time that grows with its length and the sorting of its hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hotdesk.llm.spans import Kind, joined, labelled, with_apart, with_hits
from hotdesk.llm.tables import stored

_ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)"""
)
BASE = (
    Kind("assign", _ASSIGN, lambda s: F.length(_assigned(s["value"])) >= 6),
    Kind("access", r"AKIA[A-Z0-9]{16,}+", hint=lambda t: t.contains("AKIA")),
    Kind("hex", r"(?<![0-9a-f])[0-9a-f]{24,}+"),
)
#: Opaque values: long runs that mix digits and letters; words and numbers alone do not pass. The
#: sign of an assignment is no part of them, so a value has one hash with and without its key word.
OPAQUE = Kind(
    "live",
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}",
    lambda s: (F.regexp_count(s["value"], F.lit("[0-9]")) >= 4)
    & (F.regexp_count(s["value"], F.lit("[A-Za-z]")) >= 4)
    & (F.size(F.array_distinct(F.split(s["value"], ""))) >= 10),
    lambda t: t.rlike(r"[A-Za-z0-9+/_-]{20}"),
)
MAX_OWNERS = 1


def _assigned(value: Column) -> Column:
    return F.regexp_extract(value, _ASSIGN, 1)


def candidates(docs: DataFrame, text: str, owner: str, repository: str, keep: tuple[str, ...]) -> DataFrame:
    """One row per document: its ``keep`` columns as ``doc``, base spans and hashed values. Lazy."""
    rows = docs.select(
        F.struct(*keep).alias("doc"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"),
        F.monotonically_increasing_id().alias("row"),
    )
    for kind in (*BASE, OPAQUE):
        rows = with_hits(rows, "text", kind, f"hits_{kind.name}")

    def hashed(hits: Column, name: str, value=lambda s: s["value"]) -> Column:
        return F.transform(
            hits,
            lambda s: F.struct(
                s["start"].alias("start"), s["end"].alias("end"), F.lit(name).alias("kind"),
                F.sha2(value(s), 256).alias("hash"),
            ),
        )

    values = F.concat(
        hashed(F.col("hits_assign"), "assign", lambda s: _assigned(s["value"])),
        *(hashed(F.col(f"hits_{name}"), name) for name in ("access", "hex", "live")),
    )
    base = F.concat(*(labelled(F.col(f"hits_{k.name}"), k.name, i) for i, k in enumerate(BASE)))
    return rows.select("row", "doc", "owner", "repository", base.alias("base"), values.alias("values"))


def ownership(used: DataFrame) -> DataFrame:
    """Rows (hash, owner, repository) to hash, owners, repositories and whether the value looks live.

    Owners alone decide: the number of repositories grows with the table.
    """
    once = used.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    per_owner = once.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    return (
        per_owner.groupBy("hash")
        .agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
        .withColumn("live", F.col("owners") <= MAX_OWNERS)
    )


def scan(
    docs: DataFrame,
    text: str = "text",
    owner: str = "source",
    repository: str = "doc_id",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """One row per document: ``doc``, ``base`` spans, ``added`` (live) spans and counts of its values.

    A document of ``documents`` stands for a repository, its source for the owner. The hits
    are written once to the shared folder, without the texts.
    """
    found = stored(candidates(docs, text, owner, repository, keep), "secrets")
    used = found.select("row", "owner", "repository", F.explode("values").alias("value")).select(
        "row", "owner", "repository", "value.*"
    )
    known = ownership(used)
    judged = (
        used.join(known, "hash")
        .groupBy("row")
        .agg(
            F.collect_set(
                F.when(
                    F.col("live") & (F.col("kind") == OPAQUE.name),
                    F.struct("start", F.lit(len(BASE)).alias("rank"), "kind", "end"),
                )
            ).alias("live"),
            F.countDistinct(F.when(F.col("live"), F.col("hash"))).alias("live_values"),
            F.countDistinct(F.when(~F.col("live"), F.col("hash"))).alias("example_values"),
        )
    )
    rows = found.select("row", "doc", "base").join(judged, "row", "left")
    none = F.array().cast(found.schema["base"].dataType)
    rows = with_apart(rows.withColumn("live", F.coalesce("live", none)), "live", "base", "added")
    return rows.select(
        "doc",
        "base",
        "added",
        F.coalesce("live_values", F.lit(0)).alias("live_values"),
        F.coalesce("example_values", F.lit(0)).alias("example_values"),
    )


def _named(name: str):
    return lambda s: s["kind"] == name


def digest(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds and all spans as text, one row per document."""
    rows = scan(docs)
    return rows.select(
        "doc.doc_id",
        *(F.size(F.filter("base", _named(k.name))).cast("long").alias(f"n_{k.name}") for k in BASE),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "added")).alias("spans"),
        "live_values",
        "example_values",
    )
