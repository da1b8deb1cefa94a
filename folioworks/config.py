"""Parameters of the jobs: library registry, places to look in responses, templates, option layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

# A step of a JSON path: a string is an object key (dots allowed), an int an array position.
JsonPath = Sequence[str | int]

METADATA_FIELDS = ("title", "subtitle", "part_title", "part_subtitle")


@dataclass(frozen=True)
class Library:
    """A site family. Registry order, then prefix order, decides which library owns a URL."""

    name: str
    prefixes: tuple[str, ...]
    page_detail_url: str


@dataclass(frozen=True)
class Step:
    """One element on the way to a text.

    Its tag; optionally a piece of its class attribute, its place among the outermost elements of that tag, and
    tags whose elements are taken out first, so that only what stands outside them counts.
    """

    tag: str
    class_part: str | None = None
    nth: int | None = None
    outside: tuple[str, ...] = ()


@dataclass(frozen=True)
class RestSearch:
    """Where page lists and metadata sit in the two landed JSON responses."""

    page_items: JsonPath
    page_id_key: str
    page_number_key: str
    page_number_item: int
    metadata: Mapping[str, JsonPath]
    page_limit: int = 4000  # the catalogue answers one page-list call with at most this many entries


@dataclass(frozen=True)
class DomSearch:
    """Where page ids and metadata sit in landed HTML; ``page_pattern`` keeps the id in group 1."""

    page_tag: str
    page_attribute: str
    page_pattern: str
    metadata: Mapping[str, Sequence[Step]]


@dataclass(frozen=True)
class ApiTemplates:
    """Request addresses for whoever fills the landing tables; ``{}`` takes the identifier."""

    base: str
    document: str
    pages: str


@dataclass(frozen=True)
class OptionLayer:
    """One layer of download options; ``None`` means the layer says nothing about that option."""

    args: Sequence[str] | None = None
    allow_insecure: bool | None = None
    subfolder: str | None = None


@dataclass(frozen=True)
class Options:
    """Option layers, from strongest to weakest: run, library, shared; the defaults close the list."""

    run: OptionLayer = field(default_factory=OptionLayer)
    libraries: Mapping[str, OptionLayer] = field(default_factory=dict)
    shared: OptionLayer = field(default_factory=OptionLayer)
    tool_path: str = "dezoomify-rs"
    output: str = "output"


# ---- fixed values -------------------------------------------------------------------------------------------

DOCUMENT_ID_PATTERN = r"(uuid:[a-f0-9-]+)"

ACCEPT_INVALID_CERTS = "--accept-invalid-certs"

DEFAULT_LIBRARIES = (
    Library(
        name="Library_DSMO",
        prefixes=("https://www.digitalniknihovna.cz/dsmo/", "https://digitalnistudovna.army.cz/"),
        page_detail_url="https://digitalnistudovna.army.cz/",
    ),
)

DEFAULT_API = ApiTemplates(
    base="https://digitalnistudovna.mo.gov.cz/search/api/v5.0/",
    document=(
        "search?fl=PID,dostupnost,fedora.model,dc.title,datum_str,dc.creator,rels_ext_index,details,dnnt-labels"
        "&q=PID:{}&sort=datum_str asc,fedora.model asc,dc.title asc&rows=10000&start=0"
    ),
    pages=(
        "search?fl=PID,dostupnost,fedora.model,dc.title,dnnt-labels,details,rels_ext_index,model_path"
        '&q=parent_pid:"{}"&rows=4000&start=0'
    ),
)

DEFAULT_REST = RestSearch(
    page_items=("response", "docs"),
    page_id_key="PID",
    page_number_key="rels_ext_index",
    page_number_item=0,
    metadata={
        "title": ("response", "docs", 0, "dc.title"),
        "subtitle": ("response", "docs", 0, "details", 0),
        "part_title": ("response", "docs", 0, "dc.title"),
        "part_subtitle": ("response", "docs", 0, "details", 0),
    },
)

_WRAPPER = (Step("app-root"), Step("main", "app-wrapper"), Step("app-book"), Step("div", "app-book-wrapper"))
_CONTENT = (*_WRAPPER, Step("app-metadata", "app-book-metadata"), Step("div"), Step("div", "app-metadata-content"))
_PART = (
    Step("app-root"),
    Step("main"),
    Step("app-book"),
    Step("div"),
    Step("app-metadata"),
    Step("div"),
    Step("div", nth=2),
    Step("div", nth=2),
    Step("div", nth=1),
    Step("app-metadata"),
    Step("div"),
    Step("div"),
)
_OUTSIDE = ("div", "app-metadata")

DEFAULT_DOM = DomSearch(
    page_tag="div",
    page_attribute="id",
    page_pattern=r"page-id-(uuid:[a-f0-9-]+)",
    metadata={
        "title": (*_CONTENT, Step("h1", outside=_OUTSIDE)),
        "subtitle": (*_CONTENT, Step("h2", outside=_OUTSIDE)),
        "part_title": (*_PART, Step("h1", outside=_OUTSIDE)),
        "part_subtitle": (*_PART, Step("h2", outside=_OUTSIDE)),
    },
)
