"""Inputs of the jobs derived by Spark from the given tables.

Everything grows with the tables and reads them whole. No builder gathers an open-ended group: the lines of an order
are ranked and cut into blocks, and each block is a landed document of its own. The first has the order's own key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from folioworks.config import Library, OptionLayer, Options
from folioworks.functions.numbering import number_by_ranges, number_in_groups
from folioworks.session import work_folder
from folioworks.sources.landing import write_table

PAGE_LIBRARIES = (
    Library("Lib_WWW", ("https://www.", "http://www."), "https://img.www.example.org/"),
    Library("Lib_BLOG", ("https://blog.",), "https://img.blog.example.org/"),
    Library("Lib_HTTPS", ("https://",), "https://img.example.org/"),
    Library("Lib_BLOGHTTP", ("http://blog.",), "http://img.blog.example.org/"),
)



def order_libraries(sites: Sequence[int]) -> tuple[Library, ...]:
    """Registry of the given sites of the order URLs."""
    return tuple(
        Library(f"lib{i}", (f"https://lib{i}.example.org/",), f"https://img{i}.example.org/") for i in sites
    )


OPTIONS = Options(
    libraries={
        "lib0": OptionLayer(args=("--accept-invalid-certs",), allow_insecure=True),
        "lib1": OptionLayer(args=(), subfolder="scans"),
    },
    shared=OptionLayer(args=("--largest",), allow_insecure=False, subfolder="images"),
)

RUN_OPTIONS = Options(
    run=OptionLayer(args=("--max-width", "4000"), allow_insecure=False),
    libraries=OPTIONS.libraries,
    shared=OPTIONS.shared,
)

# Layers that contradict themselves, for everything and for one library.
CLASHING_OPTIONS = Options(
    libraries={
        "lib0": OptionLayer(allow_insecure=True),
        "lib1": OptionLayer(args=("--accept-invalid-certs", "--largest"), allow_insecure=False),
        "lib2": OptionLayer(subfolder="scans"),
    },
    shared=OptionLayer(args=("--accept-invalid-certs",), allow_insecure=False),
)

_PAGE_KEY = ("l_partkey", "l_suppkey", "l_linenumber")

# Positions of repeated URLs start here.
COPY_OFFSET = 1_000_000_000

# Lines in one landed body, and how far apart the keys of an order's blocks are.
BLOCK = 1000
BLOCK_OFFSET = 1_000_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _md5(column: Column) -> Column:
    return F.md5(column.cast("string").cast("binary"))


def document_id(column: Column) -> Column:
    """Document identifier of an order key."""
    return F.concat(F.lit("uuid:"), _md5(column))


def many_prefixes() -> tuple[Library, ...]:
    """A registry of 97 libraries with 8,192 prefixes, and in the middle one whose 32 shorter prefixes cover them all."""
    view = "https://lib{}.example.org/view/uuid:{}"
    shelves = [
        Library(f"shelf{k}", tuple(view.format(site, f"{n:03x}") for site in (0, 1) for n in range(k, 4096, 97)), f"https://img{k}.example.org/")
        for k in range(97)
    ]
    rest = Library("rest", tuple(view.format(site, f"{n:x}") for site in (0, 1) for n in range(16)), "https://img.example.org/")
    return (*shelves[:48], rest, *shelves[48:])


def url_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a URL file: URLs, comments, blanks, padded URLs."""
    pages = table(spark, sf_dir, "pages")
    kind = F.col("page_id") % 8
    return pages.select(
        F.col("page_id").alias("pos"),
        F.when(kind == 3, F.concat(F.lit("# "), "url"))
        .when(kind == 5, "   ")
        .when(kind == 6, F.concat(F.lit("  "), "url", F.lit("  ")))
        .otherwise(F.col("url"))
        .alias("line"),
    )


def url_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """The lines of the URL file in three folders by their number, each in files that follow one another."""
    lines = url_lines(spark, sf_dir)
    paths = []
    for part in (2, 0, 1):
        folder = work_folder(spark)
        own = lines.filter(F.col("pos") % 3 == part)
        own.repartitionByRange(4, "pos").sortWithinPartitions("pos").select("line").write.text(folder)
        paths.append(folder)
    return paths


def doc_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document URL per order; some without an id, some with a misleading one in the query."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("pos"),
        F.concat(
            F.lit("https://lib"),
            (F.col("o_custkey") % 3).cast("string"),
            F.lit(".example.org/view/"),
            F.when(F.col("o_orderkey") % 13 == 0, "none").otherwise(document_id(F.col("o_orderkey"))),
            F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("?page="), document_id(F.col("o_custkey")))).otherwise(
                ""
            ),
        ).alias("url"),
    )


def doc_urls_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document URLs plus every 50th once more, far behind."""
    urls = doc_urls(spark, sf_dir)
    copies = urls.filter(F.col("pos") % 50 == 0).select((F.col("pos") + COPY_OFFSET).alias("pos"), "url")
    return urls.unionByName(copies)


def document_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed document responses: all kinds of titles and details, failed requests, certificate failures."""
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    key = F.col("o_orderkey")
    kind = key % 7
    title = (
        F.when(kind == 0, "")
        .when(kind == 1, ',"dc.title":null')
        .when(kind == 2, ',"dc.title":42')
        .otherwise(F.concat(F.lit(',"dc.title":"'), "c_name", F.lit('"')))
    )
    details = F.when(kind == 3, ',"details":[]').otherwise(
        F.concat(F.lit(',"details":["'), "o_orderpriority", F.lit('"]'))
    )
    item = F.concat(F.lit('{"PID":"'), document_id(key), F.lit('"'), title, details, F.lit("}"))
    return orders.select(
        document_id(key).alias("document_id"),
        F.when(key % 11 == 0, 404).when(key % 11 == 1, 500).otherwise(200).alias("status"),
        F.when(key % 17 == 0, "cert").alias("error_class"),
        F.concat(F.lit('{"response":{"docs":['), F.when(kind == 4, "").otherwise(item), F.lit("]}}")).alias("body"),
    )


def _order_of_line() -> Column:
    # All that bodies are made of; lines that are equal in it are interchangeable.
    return F.struct(*_PAGE_KEY)


def landed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with ``doc`` (a key) and ``_lines`` per block of at most ``BLOCK`` of their lines; no lines, one block.

    Only orders of more than one block have their lines ranked; the lines of the others are gathered as they are. Which
    these are is written first: where there are none, lines are moved once and nothing is planned for ranking.
    """
    order = list(_PAGE_KEY)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *order).filter(F.col("l_orderkey").isNotNull())
    long = write_table(
        lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_count")).filter(F.col("_count") > BLOCK)
        .select(F.col("l_orderkey").alias("_long")), work_folder(spark))
    gathered = F.sort_array(F.collect_list(_order_of_line())).alias("_lines")
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    # Spread by order before the joins, which need it anyway: bodies are then built and parsed by all cores.
    spread = orders.repartition("o_orderkey")
    own = F.col("o_orderkey") == F.col("l_orderkey")
    first = F.lit(0).cast("bigint")
    if long.isEmpty():
        whole = lines.groupBy("l_orderkey").agg(gathered)
        return spread.join(whole, own, "left").withColumn("_block", first).withColumn("doc", F.col("o_orderkey"))
    whole = lines.join(long, F.col("l_orderkey") == F.col("_long"), "left_anti").groupBy("l_orderkey").agg(gathered)
    ranked = number_in_groups(
        lines.join(long, F.col("l_orderkey") == F.col("_long"), "left_semi"), ["l_orderkey"], order,
        F.floor(F.col("l_partkey") / 256), "_rank")
    blocks = ranked.groupBy("l_orderkey", F.floor((F.col("_rank") - 1) / BLOCK).alias("_block")).agg(gathered)
    short = spread.join(long, F.col("o_orderkey") == F.col("_long"), "left_anti").join(whole, own, "left")
    joined = short.withColumn("_block", first).unionByName(spread.join(blocks, own))
    return joined.withColumn("doc", F.col("o_orderkey") + F.col("_block") * BLOCK_OFFSET)


def gathered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What bodies are made of, written once for those who make several kinds of them."""
    landed = landed_orders(spark, sf_dir)
    return write_table(landed.select("o_orderkey", "_block", "doc", "_lines", "c_name", "o_orderpriority"), work_folder(spark))


def page_responses(
    spark: SparkSession, sf_dir: str, first_number: int = 0, landed: DataFrame | None = None
) -> DataFrame:
    """Landed page lists per order; repeated page numbers, lists without numbers, and several ways to be broken."""
    joined = landed_orders(spark, sf_dir) if landed is None else landed
    key = F.col("doc")

    def entry(line, pos):
        page = document_id(F.concat_ws("-", *(line[c].cast("string") for c in _PAGE_KEY)))
        identifier = F.when((key % 31 == 0) & (pos == 0), "7").otherwise(F.concat(F.lit('"'), page, F.lit('"')))
        number = F.when(key % 41 == 0, "").otherwise(
            F.concat(F.lit(',"rels_ext_index":['), (line["l_linenumber"].cast("bigint") + first_number).cast("string"), F.lit("]"))
        )
        return F.concat(F.lit('{"PID":'), identifier, number, F.lit("}"))

    items = F.coalesce(F.array_join(F.transform("_lines", entry), ","), F.lit(""))
    body = F.concat(
        F.lit('{"response":{"docs":'),
        F.when(key % 37 == 0, "{}").otherwise(F.concat(F.lit("["), items, F.lit("]"))),
        F.when(key % 29 == 0, "}").otherwise("}}"),
    )
    return joined.select(
        document_id(key).alias("document_id"),
        F.when(key % 19 == 0, 503).otherwise(200).alias("status"),
        F.when(key % 23 == 0, "cert").alias("error_class"),
        body.alias("body"),
    )


def html_pages(spark: SparkSession, sf_dir: str, landed: DataFrame | None = None) -> DataFrame:
    """Landed HTML per order: page elements with repeated ids, metadata, failed pages."""
    joined = landed_orders(spark, sf_dir) if landed is None else landed
    key = F.col("doc")
    divs = F.coalesce(
        F.array_join(
            F.transform(
                "_lines",
                lambda line: F.concat(
                    F.lit('<div id="page-id-uuid:'), _md5(line["l_partkey"] % 50), F.lit('"></div>')
                ),
            ),
            "",
        ),
        F.lit(""),
    )
    part_text = F.when(
        key % 2 == 0,
        F.concat(
            F.lit("<app-metadata><div><div><h1>part "), key.cast("string"), F.lit("</h1></div></div></app-metadata>")
        ),
    ).otherwise("")
    book = F.concat(
        F.lit('<app-metadata class="x app-book-metadata"><div><div></div><div class="app-metadata-content"><h1>'),
        "c_name",
        F.lit(" &amp; <b>more</b></h1><h2>"),
        "o_orderpriority",
        F.lit("</h2><div></div><div><div>"),
        part_text,
        F.lit("</div></div></div></div></app-metadata>"),
    )
    html = F.concat(
        F.lit('<html><body><app-root><main class="app-wrapper"><app-book><div class="app-book-wrapper">'),
        book,
        F.when(key % 3 == 0, "").otherwise(divs),
        F.lit('<div id="non-page-id"></div></div></app-book></main></app-root></body></html>'),
    )
    return joined.select(
        document_id(key).alias("document_id"),
        F.when(key % 47 == 0, 404).otherwise(200).alias("status"),
        F.when(key % 43 == 0, "cert").when(key % 53 == 0, "tls").alias("error_class"),
        html.alias("html"),
    )


def third_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a further source says about each order."""
    key = F.col("o_orderkey")
    kind = F.when(key % 4 == 0, "ok").when(key % 4 == 1, "empty").when(key % 4 == 2, "cert").otherwise("error")
    return table(spark, sf_dir, "orders").select(document_id(key).alias("document_id"), kind.alias("third_kind"))


def plain_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents fetched once more by plain requests: good ones, empty ones, and both kinds of failures."""
    key = F.col("o_orderkey")
    page = lambda n: F.concat(F.lit('<div id="page-id-'), document_id(F.concat_ws("-", key.cast("string"), F.lit(n))), F.lit('"></div>'))
    html = F.concat(
        F.lit('<html><body><app-root><main class="app-wrapper"><app-book><div class="app-book-wrapper">'
              '<app-metadata class="app-book-metadata"><div><div class="app-metadata-content"><h1>plain '),
        key.cast("string"), F.lit("</h1>"),
        F.when(key % 3 == 0, F.concat(F.lit("<h2>"), F.col("o_orderpriority"), F.lit("</h2>"))).otherwise(""),
        F.lit("</div></div></app-metadata>"), page("1"), page("2"), page("1"), F.lit("</div></app-book></main></app-root></body></html>"))
    return table(spark, sf_dir, "orders").select(
        document_id(key).alias("document_id"),
        F.when(key % 8 == 5, 404).otherwise(200).alias("status"),
        F.when(key % 4 == 2, "cert").when(key % 4 == 3, "refused").alias("error_class"),
        F.when(key % 8 != 1, html).otherwise("<p>nothing here</p>").alias("html"),
    )


def ever_landed(landed: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """``gathered_orders`` without those of some orders, whose HTML was never fetched.

    They are told by their keys, before bodies are made. A first block has the key of its order; those behind it, if
    there are any, are held against the orders, since an order may have the same key.
    """
    never = F.col("o_orderkey") % 5 == 2
    first = landed.filter("_block = 0").filter(~F.coalesce(never, F.lit(False)))
    later = landed.filter("_block > 0")
    if later.isEmpty():
        return first
    missing = table(spark, sf_dir, "orders").filter(never).select(F.col("o_orderkey").alias("_missing"))
    return first.unionByName(later.join(missing, F.col("doc") == F.col("_missing"), "left_anti"))


def with_retries(responses: DataFrame) -> DataFrame:
    """``responses`` with attempt numbers, and failed attempts before those of about every third document."""
    again = F.substring("document_id", -1, 1).isin("0", "3", "6", "9", "c")
    good = responses.withColumn("attempt", F.when(again, 3).otherwise(1))
    broken = {c: F.lit(None).cast(t) for c, t in responses.dtypes if c not in ("document_id", "status")}
    failed = responses.filter(again).select("document_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("attempt"))
    failed = failed.withColumns(broken | {"status": F.when(F.col("attempt") == 1, 500)})
    failed = failed.withColumn("error_class", F.when(F.col("attempt") == 2, "cert"))
    return good.unionByName(failed.select(good.columns))


def pages_with_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given web pages with scripts that hold comment marks, and comments that hold script tags."""
    script = F.lit("<script>var a = '<!--', b = '<a href=\"/x\">';</script>")
    comment = F.lit("<!-- <script> <a href='/y'> -->")
    pages = web_pages(spark, sf_dir)
    return pages.withColumn("html", F.concat(script, comment, F.replace("html", F.lit("</p>"), F.concat(comment, script, F.lit("</p>")))))


def deep_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles whose headline lies behind as many nested elements as the row number, up to hundreds."""
    depth = (F.col("document_id") % 400).cast("int")
    inner = F.concat(F.repeat(F.lit("<article>x"), depth), F.repeat(F.lit("</article>"), depth))
    return web_pages(spark, sf_dir).withColumn(
        "html", F.concat(F.lit("<article>"), inner, F.lit("<h1>deep "), F.col("document_id").cast("string"),
                         F.lit("</h1></article><h1>outside</h1>")))


def wide_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many articles side by side as the row number, to thousands, their headlines behind a paragraph."""
    # Rows become hundreds of times larger here, so they are dealt out before.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pages = web_pages(spark, sf_dir).repartition(4 * tasks, "document_id")
    count = (F.col("document_id") % 3000).cast("int")
    articles = F.transform(F.sequence(F.lit(0), count), lambda i: F.concat(
        F.lit("<article><p>x</p>"), F.when(i % 7 == 0, F.concat(F.lit("<h1>"), i.cast("string"), F.lit("</h1>"))).otherwise(""),
        F.lit("</article>")))
    return pages.withColumn("html", F.concat(F.lit("<h1>outside</h1>"), F.array_join(articles, "\n")))


def web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given web pages as landed HTML."""
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("document_id"),
        F.lit(200).alias("status"),
        F.lit(None).cast("string").alias("error_class"),
        "html",
    )


def existing_dirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders left from an earlier run: those of every 97th order, below the first library."""
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 97 == 0)
    return orders.select(
        F.concat(F.lit("output/lib0/uuid_"), _md5(F.col("o_orderkey"))).alias("output_dir")
    )


def _error_text() -> Column:
    """Error text of a failed event: a mismatch, and by event a certificate failure or another failure."""
    certificate = (
        " - tiles: error sending request for url (https://scans.test/1): "
        "error:140:SSL routines:certificate verify failed:unable to get issuer\n"
    )
    refused = " - plain: error sending request for url (https://scans.test/2): connection refused\n"
    return F.concat(
        F.lit("[ERROR] Dezoomer error: discovery failed: no discovery candidate accepted the input\n"),
        F.lit(" - manifest: not a manifest file\n"),
        F.when(F.col("event_id") % 3 == 0, certificate).otherwise(""),
        F.when(F.col("event_id") % 5 == 0, refused).otherwise(""),
    )


def error_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error text per event, empty where nothing failed."""
    text = F.when(F.col("event_type") == "error", _error_text()).otherwise("")
    return table(spark, sf_dir, "events").select("event_id", text.alias("stderr"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page downloads: a user is a document, the n-th event its n-th page."""
    key = F.col("event_id")
    kind = F.col("event_type")
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.col("user_id").alias("doc_key"),
        (key % 97 != 0).alias("tool_found"),
        ((kind == "error") & (key % 5 == 1)).alias("timed_out"),
        F.when(kind == "error", 1).when((kind == "purchase") & (key % 9 == 0), 2).otherwise(0).alias("returncode"),
        F.when(key % 6 == 0, "partial").when(key % 6 == 1, "\n").otherwise("").alias("stdout"),
        F.when(kind == "error", _error_text()).otherwise("").alias("stderr"),
        ((kind == "error") & (key % 40 == 0)).alias("exception"),
    )
    return number_by_ranges(events, ["doc_key"], ["ts", "event_id"], "page_index").drop("ts")


def run_attempts(pages: DataFrame) -> DataFrame:
    """Attempt log of a run over its page table: mostly good, every kind of failure, a few pages never logged."""
    key = F.col("doc_key") * 31 + F.col("page_index")
    return pages.filter(key % 301 != 0).select(
        "doc_key",
        F.col("page_index").cast("bigint").alias("page_index"),
        (key % 397 != 0).alias("tool_found"),
        (key % 53 == 0).alias("timed_out"),
        F.when(key % 29 == 0, 1).otherwise(0).alias("returncode"),
        F.lit("").alias("stdout"),
        F.lit("").alias("stderr"),
        (key % 111 == 0).alias("exception"),
    )


def long_error_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Wrapped errors in chains of 512 events, every second one a circle; every hundredth event wraps another besides."""
    events = table(spark, sf_dir, "events").select("event_id")
    key = F.col("event_id")
    nodes = events.select(
        key.alias("error_id"), F.when(key % 1901 == 7, "SSLCertVerificationError").otherwise("timeout").alias("error_class"))
    target = F.when(key % 512 != 511, key + 1).when(key % 1024 == 1023, key - 511)
    along = events.select(key.alias("from_id"), target.alias("to_id")).filter(F.col("to_id").isNotNull())
    aside = events.filter(key % 100 == 50).select(key.alias("from_id"), (key + 700).alias("to_id"))
    return nodes, along.union(aside), events.filter(key % 64 == 3).select(key.alias("error_id"))


def error_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes, edges and roots of wrapped errors; chains of eight events, some closed to a cycle."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    key = F.col("event_id")
    nodes = events.select(
        key.alias("error_id"),
        F.when(key % 23 == 0, "SSLCertVerificationError").otherwise(F.col("event_type")).alias("error_class"),
    )
    target = F.when(key % 8 != 7, key + 1).when(key % 16 == 15, key - 7)
    edges = events.select(key.alias("from_id"), target.alias("to_id")).filter(F.col("to_id").isNotNull())
    roots = events.filter(key % 8 == 0).select(key.alias("error_id"))
    return nodes, edges, roots
