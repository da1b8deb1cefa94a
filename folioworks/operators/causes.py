"""Certificate failures behind wrapped errors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from folioworks.session import cut_lineage

# ---- fixed value --------------------------------------------------------------------------------------------
_CERTIFICATE_ERROR = "SSLCertVerificationError"

# Levels between two merges of the reached nodes into one table.
_MERGE_EVERY = 8


def _contracted(certificates: DataFrame, edges: DataFrame) -> DataFrame:
    """``from_id, to_id, hit`` for nodes that wrap exactly one error: where their chain leads, and whether a certificate
    error stands on the way, the node itself included and the end not.

    Every round doubles the length of the way that a pointer covers, so chains take rounds by the logarithm of their
    length. Chains end at a node that wraps none or several. Those that run into a circle never do; they are done once
    a round changes neither the hits nor the number of chains that are still open.
    """
    single = (
        edges.groupBy("from_id").agg(F.min("to_id").alias("to_id"), F.max("to_id").alias("_other"))
        .filter(F.col("to_id") == F.col("_other")).drop("_other")
    )
    own = certificates.select(F.col("error_id").alias("from_id"), F.lit(True).alias("hit"))
    pointers = cut_lineage(single.join(own, "from_id", "left").withColumn("hit", F.coalesce("hit", F.lit(False))))
    before = None
    while True:
        ahead = pointers.select(F.col("from_id").alias("_at"), F.col("to_id").alias("_to"), F.col("hit").alias("_hit"))
        doubled = cut_lineage(
            pointers.join(ahead, F.col("to_id") == F.col("_at"), "left").select(
                "from_id", F.coalesce("_to", "to_id").alias("to_id"),
                (F.col("hit") | F.coalesce("_hit", F.lit(False))).alias("hit"), F.col("_at").isNotNull().alias("_open")))
        now = tuple(doubled.agg(F.count_if("_open"), F.count_if("hit")).first())
        pointers = doubled.drop("_open")
        if now[0] == 0 or now == before:
            return pointers
        before = now


def cert_causes(nodes: DataFrame, edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Add ``is_certificate`` to ``roots(error_id)``: is a certificate error reachable over ``edges``?

    Chains of errors that wrap one other are contracted first. The walk then goes backwards from the certificate errors
    and the chains that hold one, level by level, and keeps each node once. So it costs one join per level of errors
    that wrap several, cycles end by themselves, and no root-node pairs are ever built. An edge is read no more once its
    source is reached: what is left of the edges is written anew every few levels.
    """
    certificates = cut_lineage(
        nodes.filter(F.col("error_class") == _CERTIFICATE_ERROR).select("error_id").distinct()
    )
    wrapped = edges.select("from_id", "to_id").filter("from_id != to_id")
    chains = _contracted(certificates, wrapped)
    # An error on a chain is reached with it or not at all; others keep their edges.
    branching = wrapped.join(chains.select("from_id"), "from_id", "left_anti")
    left = cut_lineage(branching.unionByName(chains.filter(~F.col("hit")).select("from_id", "to_id")))
    hit = chains.filter("hit").select(F.col("from_id").alias("error_id"))
    frontier = cut_lineage(certificates.union(hit).distinct())
    reached = frontier
    level = 0
    while not frontier.isEmpty():
        left = left.join(frontier, left["from_id"] == frontier["error_id"], "left_anti")
        if level % _MERGE_EVERY == 0:
            left = cut_lineage(left)
        callers = left.join(frontier, left["to_id"] == frontier["error_id"], "left_semi")
        # What is reached has lost its edges, so callers are new.
        frontier = cut_lineage(callers.select(F.col("from_id").alias("error_id")).distinct())
        reached = reached.union(frontier)
        level += 1
        if level % _MERGE_EVERY == 0:
            reached = cut_lineage(reached)
    marked = reached.select("error_id", F.lit(True).alias("is_certificate"))
    return roots.join(marked, "error_id", "left").withColumn(
        "is_certificate", F.coalesce("is_certificate", F.lit(False))
    )
