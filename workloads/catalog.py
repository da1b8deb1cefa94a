"""One query per job, over inputs derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from folioworks.config import DEFAULT_REST, METADATA_FIELDS, ApiTemplates, DomSearch, Step
from folioworks.operators import (
    attempts as attempt_jobs,
    causes,
    documents as document_jobs,
    dom,
    manifest,
    options,
    output,
    resolve,
    rest,
    rollup,
    urls,
)
from folioworks.plans.batch import ArchiveRun, HtmlLanding, Landing, Report, RestLanding
from folioworks.session import tune, work_folder
from folioworks.sources.landing import bucketed_copy, write_manifest, write_table
from folioworks.sources.url_lists import read_url_lines
from workloads import derived

WRITTEN_AT = "2024-01-02 03:04:05"
API = ApiTemplates("https://api.example.org/", "doc?q=PID:{}&rows=10000", 'pages?q="{}"&rows=4000')
LINKS = DomSearch("a", "href", "^/(.+)$", {})
HEADLINE = {"headline": (Step("article"), Step("h1"))}
EXPLICIT = ("uuid:a1", "uuid:b2", "uuid:c3")

Query = Callable[[SparkSession, str], DataFrame]


def _joined(column: str, separator: str = "|"):
    return F.array_join(column, separator).alias(column)


def _pages_exploded(lists: DataFrame, column: str) -> DataFrame:
    exploded = lists.select("document_id", F.posexplode_outer(column).alias("_pos", "page_id"))
    return exploded.filter(F.col("_pos").isNotNull()).select(
        "document_id", (F.col("_pos") + 1).alias("page_index"), "page_id"
    )


def url_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_manifest(derived.url_lines(spark, sf_dir))


def url_manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The URLs of all pages from lists in several files, given in an order of their own."""
    return urls.url_manifest(read_url_lines(spark, derived.url_files(spark, sf_dir)))


def assign_library(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = urls.assign_library(url_manifest(spark, sf_dir), derived.PAGE_LIBRARIES)
    return assigned.drop("page_detail_url")


def assign_library_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry of thousands of prefixes, some of them within others."""
    assigned = urls.assign_library(derived.doc_urls(spark, sf_dir), derived.many_prefixes())
    return assigned.select("pos", "library_pos", "library_name", "base_url")


def document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.document_ids(derived.doc_urls(spark, sf_dir), api=API)


def _ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urls.document_ids(derived.doc_urls(spark, sf_dir)).filter(F.col("document_id").isNotNull())
    return found.select("document_id").distinct()


def admit_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    admitted = rest.admit_responses(
        _ids(spark, sf_dir),
        rest.rest_metadata(derived.document_responses(spark, sf_dir)),
        rest.rest_page_lists(derived.page_responses(spark, sf_dir)),
    )
    return admitted.select("document_id", "rest_status")


def admit_responses_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where failed attempts were landed before the deciding ones."""
    documents = rest.decided_facts(derived.with_retries(derived.document_responses(spark, sf_dir)), rest.rest_metadata)
    pages = rest.decided_facts(derived.with_retries(derived.page_responses(spark, sf_dir)), rest.rest_page_lists)
    return rest.admit_responses(_ids(spark, sf_dir), documents, pages).select("document_id", "rest_status")


def admit_responses_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from landed tables that were bucketed by document when they were written."""
    documents, pages = (
        bucketed_copy(side, "document_id", int(spark.conf.get("spark.sql.shuffle.partitions")))
        for side in (derived.document_responses(spark, sf_dir), derived.page_responses(spark, sf_dir)))
    admitted = rest.admit_responses(
        _ids(spark, sf_dir), rest.rest_metadata(documents), rest.rest_page_lists(pages))
    return admitted.select("document_id", "rest_status")


def rest_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rest.rest_metadata(derived.document_responses(spark, sf_dir)).drop("doc_parsed")


def rest_page_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    search = replace(DEFAULT_REST, page_limit=4)
    return rest.rest_page_lists(derived.page_responses(spark, sf_dir), search).select(
        "document_id", "rest_pages_kind", F.size("rest_pages").cast("bigint").alias("pages"), "maybe_truncated"
    )


def rest_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rest.rest_pages(rest.rest_page_lists(derived.page_responses(spark, sf_dir)))
    return rows.select("document_id", F.col("page_number").cast("int").alias("page_number"), "page_index", "page_id")


def rest_pages_large_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page numbers around 2^53, where neighbours share one double."""
    lists = rest.rest_page_lists(derived.page_responses(spark, sf_dir, first_number=2**53 - 3))
    rows = rest.rest_pages(lists)
    return rows.select("document_id", F.col("page_number").cast("bigint").alias("page_number"), "page_index", "page_id")


def dom_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages_exploded(dom.dom_pages(derived.web_pages(spark, sf_dir), LINKS), "dom_pages")


def dom_pages_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages with comment marks in scripts and scripts in comments."""
    return _pages_exploded(dom.dom_pages(derived.pages_with_scripts(spark, sf_dir), LINKS), "dom_pages")


def dom_page_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages_exploded(dom.dom_pages(derived.html_pages(spark, sf_dir)), "dom_pages")


def dom_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dom.dom_pages(derived.html_pages(spark, sf_dir)).select("document_id", "dom_kind")


def dom_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dom.dom_text(derived.web_pages(spark, sf_dir), HEADLINE)


def dom_text_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headlines behind nesting that grows with the row."""
    return dom.dom_text(derived.deep_pages(spark, sf_dir), HEADLINE)


def dom_text_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headlines of pages with up to thousands of articles, and what their articles hold besides paragraphs."""
    bare = {"bare": (Step("article", outside=("p",)),)}
    return dom.dom_text(derived.wide_pages(spark, sf_dir), HEADLINE | bare)


def dom_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = dom.dom_facts(derived.html_pages(spark, sf_dir))
    return facts.select("document_id", *(f"dom_{name}" for name in METADATA_FIELDS))


def _run(spark: SparkSession, sf_dir: str, urls_of=derived.doc_urls_with_copies, sites=(0, 1), explicit=None, more=()):
    """The whole job over the derived inputs, its intermediate tables in a new work folder."""
    landed = derived.gathered_orders(spark, sf_dir)
    landing = Landing(
        url_lines=urls_of(spark, sf_dir).withColumnRenamed("url", "line"),
        sources=[
            RestLanding(derived.document_responses(spark, sf_dir), derived.page_responses(spark, sf_dir, landed=landed)),
            HtmlLanding(derived.html_pages(spark, sf_dir, derived.ever_landed(landed, spark, sf_dir))),
            *more,
        ],
        existing_dirs=derived.existing_dirs(spark, sf_dir),
    )
    return ArchiveRun(
        landing,
        derived.order_libraries(sites),
        derived.OPTIONS,
        WRITTEN_AT,
        explicit_pages=explicit,
        work_dir=work_folder(spark),
    )


def _resolution(spark: SparkSession, sf_dir: str, explicit=None, more=()) -> ArchiveRun:
    """Every site registered, no URL twice."""
    return _run(spark, sf_dir, derived.doc_urls, (0, 1, 2), explicit, more)


def resolve_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolution(spark, sf_dir).resolved.select(
        "document_id", "pages_source", "failure_class", F.col("page_count").cast("bigint").alias("page_count")
    )


def resolve_three_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third source, asked where both landed ones failed."""
    landed = derived.gathered_orders(spark, sf_dir)
    lists = rest.rest_page_lists(derived.page_responses(spark, sf_dir, landed=landed)).drop("rest_pages")
    admitted = rest.admit_responses(
        _ids(spark, sf_dir), rest.rest_metadata(derived.document_responses(spark, sf_dir)), lists)
    pages = dom.dom_pages(derived.html_pages(spark, sf_dir, derived.ever_landed(landed, spark, sf_dir))).drop("dom_pages")
    asked = admitted.join(pages, "document_id", "left").join(derived.third_source(spark, sf_dir), "document_id")
    source, failure = resolve.first_answer([
        ("rest", F.when(F.col("rest_status") == "ok", F.col("rest_pages_kind")).otherwise(F.col("rest_status"))),
        ("dom", F.coalesce("dom_kind", F.lit("error"))),
        ("third", F.col("third_kind")),
    ])
    return asked.select("document_id", source.alias("pages_source"), failure.alias("failure_class"))


def resolve_pages_explicit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolution(spark, sf_dir, EXPLICIT).resolved.select(
        "document_id", "pages_source", "failure_class", F.col("page_count").cast("bigint").alias("page_count"), "title"
    )


def resolved_page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _resolution(spark, sf_dir)
    settled = run.resolved.filter(F.col("pages_source").isNotNull()).select("document_id", "pages_source")
    return _pages_exploded(run.with_page_lists(settled), "page_ids")


def resolve_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final texts of the documents that have pages; the others never get as far."""
    settled = _resolution(spark, sf_dir).resolved.filter(F.col("pages_source").isNotNull())
    return settled.select("document_id", *METADATA_FIELDS, "title_source", "part_subtitle_source")


def _three_sources(spark: SparkSession, sf_dir: str) -> ArchiveRun:
    """With the same pages fetched by plain requests as a third source, whose failures show."""
    plain = HtmlLanding(derived.plain_pages(spark, sf_dir), name="plain", reports_failures=True)
    return _resolution(spark, sf_dir, more=(plain,))


def resolve_metadata_three_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and texts of every document from three sources, with the one each came from."""
    return _three_sources(spark, sf_dir).resolved.select(
        "document_id", "pages_source", "failure_class", F.col("page_count").cast("bigint").alias("page_count"),
        *(F.when(F.col("pages_source").isNotNull(), F.col(c)).alias(c)
          for name in METADATA_FIELDS for c in (name, f"{name}_source")))


def three_source_page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of the documents that settled on the third source."""
    run = _three_sources(spark, sf_dir)
    settled = run.resolved.filter("pages_source = 'plain'").select("document_id", "pages_source")
    return _pages_exploded(run.with_page_lists(settled), "page_ids")


def assemble_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).documents.select(
        "doc_key",
        "source_url",
        "library_name",
        "document_id",
        "pages_source",
        F.col("page_count").cast("bigint").alias("page_count"),
        *METADATA_FIELDS,
    )


def preprocess_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).failures


def _lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All accepted documents, copies included, with their page lists."""
    run = _run(spark, sf_dir)
    accepted = document_jobs.accepted(run.labelled)
    return run.with_page_lists(accepted)


def page_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_jobs.page_table(_lists(spark, sf_dir)).drop("library_name")


def landed_page_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From landed page lists straight to numbered pages with file names."""
    lists = rest.rest_page_lists(derived.page_responses(spark, sf_dir))
    keys = derived.landed_orders(spark, sf_dir).select(
        F.col("doc").alias("doc_key"),
        derived.document_id(F.col("doc")).alias("document_id"),
        F.lit("https://lib0.example.org/view/").alias("source_url"),
        F.lit("https://img0.example.org/").alias("page_detail_url"),
    )
    documents = keys.join(
        lists.filter(F.col("rest_pages_kind") == "ok").select(
            "document_id", F.transform("rest_pages", lambda page: page["page_id"]).alias("page_ids")
        ),
        "document_id",
    )
    return document_jobs.page_table(documents).drop("page_url", "download_url")


def output_dirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).documents.select("doc_key", "document_id", "output_dir")


def output_dirs_part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder names from part names with characters a file system refuses."""
    name = F.col("p_name")
    parts = derived.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("doc_key"),
        F.concat(F.lit("part:"), F.col("p_partkey").cast("string")).alias("document_id"),
        F.concat(
            name,
            F.lit(" <"),
            (F.col("p_partkey") % 7).cast("string"),
            F.lit('>/ "'),
            name,
            F.lit('": ?*|'),
        ).alias("title"),
        F.lit("Lib_").alias("library_name"),
    )
    return output.output_dirs(parts).select("doc_key", "output_dir")


def dir_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).documents.select("doc_key", "output_dir", "dir_granted")


def _with_options(spark: SparkSession, sf_dir: str, layers) -> DataFrame:
    # All three sites are registered here, so that one of them has no layer of its own.
    assigned = urls.assign_library(derived.doc_urls(spark, sf_dir), derived.order_libraries((0, 1, 2)))
    chosen = options.effective_options(assigned, layers)
    return chosen.select(
        "pos", _joined("args", " "), "allow_insecure", "subfolder", "insecure", "contradiction"
    )


def effective_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_options(spark, sf_dir, derived.OPTIONS)


def effective_options_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_options(spark, sf_dir, derived.RUN_OPTIONS)


def effective_options_clashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_options(spark, sf_dir, derived.CLASHING_OPTIONS)


def option_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warnings of the clashing layers, with the documents each is about."""
    assigned = urls.assign_library(derived.doc_urls(spark, sf_dir), derived.order_libraries((0, 1, 2)))
    warned = options.option_warnings(spark, derived.CLASHING_OPTIONS)
    # A document stands in two scopes: everything, and its library.
    scopes = F.array(F.lit(None).cast("string"), F.col("library_name"))
    counted = assigned.select(F.explode(scopes).alias("of")).groupBy("of").agg(F.count(F.lit(1)).alias("documents"))
    return warned.join(counted, F.col("scope").eqNullSafe(F.col("of"))).drop("of")


def work_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _run(spark, sf_dir).orders
    return orders.select("doc_key", "page_index", "page_url", _joined("command", " "))


def attempt_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = attempt_jobs.attempt_outcomes(derived.attempts(spark, sf_dir))
    return judged.select("doc_key", "page_index", "event_id", "outcome", "reason")


def cert_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attempt_jobs.cert_logs(derived.error_logs(spark, sf_dir)).drop("stderr")


def cert_causes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return causes.cert_causes(*derived.error_graph(spark, sf_dir))


def cert_causes_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains of hundreds of wrapped errors, circles and branches."""
    return causes.cert_causes(*derived.long_error_graph(spark, sf_dir))


def page_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.page_lists(_lists(spark, sf_dir)).select("doc_key", _joined("page_ids"), "page_count")


def document_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _run(spark, sf_dir).manifest
    return rows.withColumn("pages", F.array_join("pages", "|")).drop("tool_path", "written_at")


def manifest_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest as read back from its sink, written twice over."""
    run, folder = _run(spark, sf_dir), work_folder(spark)
    for _ in range(2):
        write_manifest(run.manifest_rows, folder, manifest.with_text)
    rows = spark.read.parquet(folder)
    return rows.select("library_name", "doc_key", "document_uuid", "title", "page_count",
                       F.array_join("pages", "|").alias("pages"))


def document_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes per user; the judged log is written once, since its rows are read for stops and for counts."""
    judged = attempt_jobs.attempt_outcomes(derived.attempts(spark, sf_dir)).select("doc_key", "page_index", "outcome")
    return rollup.document_outcomes(write_table(judged, work_folder(spark)))


def _reported(spark: SparkSession, sf_dir: str) -> Report:
    run = _run(spark, sf_dir)
    return run.report(derived.run_attempts(run.pages))


def failed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reported(spark, sf_dir).failed


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reported(spark, sf_dir).verdict


def library_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reported(spark, sf_dir).libraries


_QUERIES = (
    url_manifest,
    url_manifest_files,
    assign_library,
    assign_library_many,
    document_ids,
    admit_responses,
    admit_responses_retries,
    admit_responses_bucketed,
    rest_metadata,
    rest_page_kinds,
    rest_pages,
    rest_pages_large_numbers,
    dom_pages,
    dom_pages_scripts,
    dom_page_elements,
    dom_kinds,
    dom_text,
    dom_text_deep,
    dom_text_wide,
    dom_metadata,
    resolve_pages,
    resolve_three_sources,
    resolve_pages_explicit,
    resolved_page_rows,
    resolve_metadata,
    resolve_metadata_three_sources,
    three_source_page_rows,
    assemble_documents,
    preprocess_failures,
    page_table,
    landed_page_table,
    output_dirs,
    output_dirs_part_names,
    dir_conflicts,
    effective_options,
    effective_options_run,
    effective_options_clashing,
    option_warnings,
    work_orders,
    attempt_outcomes,
    page_lists,
    document_manifest,
    manifest_written,
    cert_logs,
    cert_causes,
    cert_causes_long,
    document_outcomes,
    failed_documents,
    run_summary,
    library_documents,
)


def _tuned(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(tune(spark), sf_dir)

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


QUERIES: dict[str, Query] = {query.__name__: _tuned(query) for query in _QUERIES}
