"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Three fixed kinds of spans are found by pattern, long mixed tokens besides. Hashes of all values are counted over
distinct owners and distinct repositories of an owner: a value that several owners hold is an example copied from a
manual, one that a single owner holds looks like a live credential, however often that owner repeats it. Nothing is
left out for it; the two classes are told apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from folioworks.llm.common import no_null, staged


@dataclass(frozen=True)
class Kind:
    """A pattern, the group that holds the value, and the fewest characters of the value.

    Where shorter runs can neither match otherwise nor hide a match, the pattern itself asks for the length.
    """

    name: str
    pattern: str
    group: int = 0
    least: int = 0


BASE = (
    Kind("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Kind("access", r"AKIA[A-Z0-9]{16,}+"),
    Kind("hex", r"[0-9a-f]{24,}+"),
)
TOKEN = Kind("token", r"[A-Za-z0-9+/_-]{20,}+")


@dataclass(frozen=True)
class Ownership:
    """A value held by at most ``live_owners`` owners is owner-specific. Tokens have that many distinct characters."""

    live_owners: int = 1
    distinct_characters: int = 12


def _found(text: Column, number: int, kind: Kind, mixed_from: int) -> Column:
    """Matches of one kind in a text: number, characters since the match before, length, value hash, good."""
    pattern = F.lit(kind.pattern)
    gaps = F.split(text, kind.pattern, -1)
    values = F.regexp_extract_all(text, pattern, F.lit(kind.group))

    def described(match: Column, i: Column) -> Column:
        value = F.get(values, i)
        good = F.length(value) >= kind.least
        if kind is TOKEN:
            good = (
                match.rlike("[A-Z]") & match.rlike("[a-z]") & match.rlike("[0-9]")
                & (F.size(F.array_distinct(F.split(match, ""))) >= mixed_from)
            )
        return F.struct(
            F.lit(number).alias("kind"),
            F.length(F.get(gaps, i)).alias("gap"),
            F.length(match).alias("chars"),
            F.xxhash64(value).alias("value"),
            good.alias("good"),
        )

    matches = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), described)
    return F.when(text.rlike(kind.pattern), matches).otherwise(
        F.array().cast("array<struct<kind:int,gap:int,chars:int,value:bigint,good:boolean>>"))


def secret_spans(docs: DataFrame, ownership: Ownership = Ownership(), id_column: str = "doc_id",
                 text_column: str = "text", owner_column: str = "source",
                 repo_column: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, spans): every row of ``docs`` with a row number, and one row per span kept.

    documents: row, doc_id. spans: row, kind (place in BASE, then token), start, end (code points, end exclusive), owners, repos,
    live. Base spans all stay, and so does every token that meets no base span. Without ``repo_column`` each distinct
    text is a repository, so copies of a text are one. A null owner is one owner, a null repository one repository. Null text is empty; repeated rows are scanned each.
    Other columns are not read.

    Positions are running sums over the matches of one text, so no text is too long. A value that most rows hold is
    counted per owner and repository before it meets in one task.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    kinds = (*BASE, TOKEN)
    scanned = staged(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_column).alias("doc_id"),
            no_null(F.col(owner_column)).alias("owner"),
            (no_null(F.col(repo_column)) if repo_column else F.xxhash64(text).cast("string")).alias("repo"),
            text.alias("_text"),
        ).select(
            "row", "doc_id", "owner", "repo",
            F.concat(*(_found(F.col("_text"), n, k, ownership.distinct_characters) for n, k in enumerate(kinds)))
            .alias("found"),
        )
    )
    matches = scanned.filter(F.size("found") > 0).select("row", "owner", "repo", F.posexplode("found").alias("at", "m"))
    so_far = Window.partitionBy("row", F.col("m.kind")).orderBy("at")
    spans = (
        matches.withColumn("end", F.sum(F.col("m.gap") + F.col("m.chars")).over(so_far))
        .filter("m.good")
        .select("row", "owner", "repo", F.col("m.kind").alias("kind"), (F.col("end") - F.col("m.chars")).alias("start"),
                "end", F.col("m.value").alias("value"))
    )
    seen = (
        spans.groupBy("value", "owner", "repo").agg(F.lit(1).alias("_one"))
        .groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repos"))
        .groupBy("value").agg(F.sum("repos").alias("repos"), F.count(F.lit(1)).alias("owners"))
    )
    base = F.col("kind") < len(BASE)
    order = Window.partitionBy("row").orderBy("start", "kind")
    left = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    right = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    kept = (
        spans.join(seen, "value")
        .withColumn("live", F.col("owners") <= ownership.live_owners)
        .withColumn("_meets", (F.coalesce(left, F.lit(0)) > F.col("start"))
                    | (F.coalesce(right, F.col("end")) < F.col("end")))
        .filter(base | ~F.col("_meets"))
        .select("row", "kind", "start", "end", "owners", "repos", "live")
    )
    return scanned.select("row", "doc_id"), kept


def secret_report(docs: DataFrame, ownership: Ownership = Ownership(), **columns: str) -> DataFrame:
    """One row per row of ``docs``: counts of the kinds, how many spans are held by one owner (``n_live``) or by several
    (``n_shared``), the digest of the base spans, all spans, and those of them that are live.

    A document without text or spans has zero counts, the digest of the empty string and empty lists.
    """
    documents, spans = secret_spans(docs, ownership, **columns)
    names = F.array(*(F.lit(k.name) for k in (*BASE, TOKEN)))

    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    per_row = spans.groupBy("row").agg(
        *(F.count_if(F.col("kind") == n).alias(f"n_{k.name}") for n, k in enumerate((*BASE, TOKEN))),
        F.count_if("live").alias("n_live"),
        F.count_if(~F.col("live")).alias("n_shared"),
        F.array_sort(F.collect_list(F.struct("start", "kind", "end", "live"))).alias("_spans"),
    )
    counts = [*(f"n_{k.name}" for k in (*BASE, TOKEN)), "n_live", "n_shared"]
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,live:boolean>>")
    return (
        documents.join(per_row, "row", "left")
        .withColumn("_spans", F.coalesce("_spans", empty))
        .select(
            "doc_id",
            *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts),
            F.sha2(listed(F.filter("_spans", lambda s: s["kind"] < len(BASE))).cast("binary"), 256)
            .alias("base_sha256"),
            listed(F.col("_spans")).alias("spans"),
            listed(F.filter("_spans", lambda s: s["live"])).alias("live_spans"),
        )
    )
