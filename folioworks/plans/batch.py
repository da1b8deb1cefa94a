"""The whole way from a URL list and landed tables to download orders, and from the attempt log to a verdict."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from folioworks.config import DEFAULT_DOM, DEFAULT_REST, DomSearch, Library, Options, RestSearch
from folioworks.operators.documents import accepted, assemble_documents, page_table, preprocess_failures
from folioworks.operators.dom import dom_facts
from folioworks.operators.manifest import manifest_rows, with_text
from folioworks.operators.attempts import attempt_outcomes
from folioworks.operators.options import effective_options, work_orders
from folioworks.operators.output import dir_conflicts, output_dirs
from folioworks.operators.resolve import resolved_page_lists
from folioworks.operators.rest import decided_facts, likely_of, rest_metadata, rest_page_lists
from folioworks.operators.rollup import (
    document_outcomes,
    failed_documents,
    library_documents,
    library_order,
    run_summary,
)
from folioworks.operators.sources import Source, html_answers, resolve_sources, rest_answers, unsettled
from folioworks.operators.urls import assign_library, document_ids, request_urls, url_manifest
from folioworks.session import drop_folder, work_folder
from folioworks.sources.landing import write_table


@dataclass(frozen=True)
class RestLanding:
    """Landed answers of a catalogue."""

    document_responses: DataFrame
    page_responses: DataFrame
    search: RestSearch = DEFAULT_REST
    name: str = "rest"


@dataclass(frozen=True)
class HtmlLanding:
    """Landed pages. What a browser could not load is an empty page to it; a plain request ``reports_failures``."""

    pages: DataFrame
    search: DomSearch = DEFAULT_DOM
    name: str = "dom"
    reports_failures: bool = False


@dataclass(frozen=True)
class Landing:
    """Input tables of a run; the shapes are in ``folioworks.sources.landing``.

    ``sources`` are asked in their order. Without any these are the catalogue's responses, then the pages a browser
    got, with the searches of the run.
    """

    url_lines: DataFrame
    document_responses: DataFrame | None = None
    page_responses: DataFrame | None = None
    html_pages: DataFrame | None = None
    existing_dirs: DataFrame | None = None
    sources: Sequence[RestLanding | HtmlLanding] = ()


@dataclass(frozen=True)
class Facts:
    """What one source has on the documents that need it."""

    source: Source
    pages: DataFrame | None


@dataclass(frozen=True)
class Report:
    """Results of looking at the attempt log of a run."""

    outcomes: DataFrame
    failed: DataFrame
    libraries: DataFrame
    verdict: DataFrame


class ArchiveRun:
    """From URL lines and landed responses to documents, pages, download orders and the manifest.

    Every step is a property. The steps other steps build on are written to ``work_dir`` when first asked for, a folder
    all executors share: bodies are parsed once however often their facts are read, joins further on know real sizes,
    and a lost executor costs no replay. Without ``work_dir`` it is a new folder in the one that
    ``spark.checkpoint.dir`` names. ``close`` removes it. At most ``broadcast_bytes`` of document ids are broadcast.
    """

    def __init__(
        self,
        landing: Landing,
        libraries: Sequence[Library],
        options: Options,
        written_at: str,
        explicit_pages: Sequence[str] | None = None,
        rest: RestSearch = DEFAULT_REST,
        dom: DomSearch = DEFAULT_DOM,
        work_dir: str | None = None,
        broadcast_bytes: int = 1 << 24,
    ):
        self.landing = landing
        self.registry = libraries
        self.options = options
        self.written_at = written_at
        self.explicit_pages = explicit_pages
        self.work_dir = work_dir or work_folder(landing.url_lines.sparkSession)
        self.broadcast_bytes = broadcast_bytes
        self.sources = tuple(landing.sources) or (
            RestLanding(landing.document_responses, landing.page_responses, rest), HtmlLanding(landing.html_pages, dom))

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        return write_table(df, f"{self.work_dir}/{name}")

    @cached_property
    def urls(self) -> DataFrame:
        # Request addresses follow from the id: they are not written, and made only where they are asked for.
        found = document_ids(assign_library(url_manifest(self.landing.url_lines), self.registry))
        return request_urls(self._stage(found.drop("document_request_url", "pages_request_url"), "urls"))

    @cached_property
    def ids(self) -> DataFrame:
        known = F.col("library_name").isNotNull() & F.col("document_id").isNotNull()
        return self.urls.filter(known).select("document_id").distinct()

    def _read(self, responses: DataFrame, ids: DataFrame, read: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """What ``read`` finds in the deciding responses of the given documents, a written table. Where these are few
        nothing else is read. Many would have to be dealt out together with the bodies: a filter of their hashes is
        broadcast instead, and some other documents are read too. Their facts meet no document in any later join."""
        weight, count = ids.agg(F.sum(F.octet_length("document_id") + 16), F.count("document_id")).first()
        if (weight or 0) <= self.broadcast_bytes:
            return decided_facts(responses, read, ids, few=True)
        return decided_facts(likely_of(responses, ids, count), read)

    @cached_property
    def _wanted(self) -> DataFrame:
        # As a table the ids have a known size.
        return self._stage(self.ids, "ids")

    @cached_property
    def facts(self) -> list[Facts]:
        """Source by source; each is only read for documents that those before it leave something open of."""
        found: list[Facts] = []
        for k, landed in enumerate(self.sources):
            wanted = self._wanted
            known = [facts.source for facts in found]
            if any(source.said is not None for source in known):
                open_ = unsettled(self._wanted, known, self.explicit_pages is not None)
                wanted = self._stage(open_, f"wanted_{k}")
            read = self._rest_facts if isinstance(landed, RestLanding) else self._html_facts
            found.append(read(landed, wanted, f"_{k}" if k else ""))
        return found

    def _rest_facts(self, landed: RestLanding, wanted: DataFrame, suffix: str) -> Facts:
        if self.explicit_pages is not None:
            # Answers are only fetched with the page list, so there are none.
            return Facts(Source(landed.name, None), None)
        documents = self._read(landed.document_responses, wanted, lambda rows: rest_metadata(rows, landed.search))
        pages = self._read(landed.page_responses, wanted, lambda rows: rest_page_lists(rows, landed.search))
        listed = pages.withColumn("rest_page_count", F.coalesce(F.size("rest_pages"), F.lit(0))).withColumn(
            "page_ids", F.col("rest_pages")["page_id"]).drop("rest_pages")
        documents = self._stage(documents, f"document_facts{suffix}")
        pages = self._stage(listed, f"page_facts{suffix}")
        # What is said is read for the questions left open and for those settled; of the lists only the ids are used.
        said = self._stage(rest_answers(wanted, documents, pages.drop("page_ids")), f"answers{suffix}")
        return Facts(
            Source(landed.name, said, absent="error", complete=wanted is self._wanted),
            pages.select("document_id", "page_ids"))

    def _html_facts(self, landed: HtmlLanding, wanted: DataFrame, suffix: str) -> Facts:
        found = self._read(landed.pages, wanted, lambda rows: dom_facts(rows, landed.search))
        counted = found.withColumn("dom_page_count", F.coalesce(F.size("dom_pages"), F.lit(0)))
        facts = self._stage(counted, f"html_facts{suffix}")
        lists = facts.select("document_id", F.col("dom_pages").alias("page_ids"))
        return Facts(Source(landed.name, html_answers(facts.drop("dom_pages"), landed.reports_failures)), lists)

    @cached_property
    def resolved(self) -> DataFrame:
        return resolve_sources(self._wanted, [facts.source for facts in self.facts], self.explicit_pages)

    def with_page_lists(self, documents: DataFrame) -> DataFrame:
        """Documents with the page list of the source each settled on."""
        if self.explicit_pages is not None:
            return resolved_page_lists(documents, {}, self.explicit_pages)
        return resolved_page_lists(documents, {facts.source.name: facts.pages for facts in self.facts})

    @cached_property
    def labelled(self) -> DataFrame:
        return self._stage(assemble_documents(self.urls, self.resolved), "labelled")

    @property
    def failures(self) -> DataFrame:
        return preprocess_failures(self.labelled)

    @cached_property
    def documents(self) -> DataFrame:
        planned = output_dirs(effective_options(accepted(self.labelled), self.options), self.options.output)
        return self._stage(dir_conflicts(planned, self.landing.existing_dirs), "documents")

    @cached_property
    def granted(self) -> DataFrame:
        """Documents that got their folder, with their page lists."""
        return self.with_page_lists(self.documents.filter("dir_granted"))

    @property
    def pages(self) -> DataFrame:
        return page_table(self.granted)

    @property
    def orders(self) -> DataFrame:
        return work_orders(self.pages, self.options.tool_path)

    @property
    def manifest(self) -> DataFrame:
        return with_text(self.manifest_rows)

    @property
    def manifest_rows(self) -> DataFrame:
        """The manifest before its text is made, for a sink that adds it where the files are written."""
        return manifest_rows(self.granted, self.options.tool_path, self.written_at)

    def close(self) -> None:
        """Remove the tables of the run. Its results must have been written before."""
        drop_folder(self.landing.url_lines.sparkSession, self.work_dir)

    def report(self, attempts: DataFrame) -> Report:
        """From the attempt log to the failure list and the verdict."""
        judged = self._stage(attempt_outcomes(attempts).select("doc_key", "page_index", "outcome"), "judged")
        counts = self.documents.filter("dir_granted").select("doc_key", "page_count")
        outcomes = document_outcomes(judged, counts)
        order = library_order(self.urls)
        failed = failed_documents(self.failures, self.documents, outcomes, order)
        return Report(
            outcomes=outcomes,
            failed=failed,
            libraries=library_documents(self.documents, order),
            verdict=run_summary(self.urls, failed),
        )
