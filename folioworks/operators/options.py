"""Layered download options and the download orders built with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from folioworks.config import ACCEPT_INVALID_CERTS, OptionLayer, Options

_TYPES = {"args": "array<string>", "allow_insecure": "boolean", "subfolder": "string"}


def _literal(name: str, value) -> Column:
    if name == "args" and value is not None:
        return F.array(*(F.lit(item) for item in value)).cast(_TYPES[name])
    return F.lit(value).cast(_TYPES[name])


def _effective(name: str, options: Options, default) -> Column:
    run = getattr(options.run, name)
    if run is not None:
        return _literal(name, run)
    shared = getattr(options.shared, name)
    fallback = _literal(name, default if shared is None else shared)
    entries = [
        part
        for library, layer in options.libraries.items()
        if getattr(layer, name) is not None
        for part in (F.lit(library), _literal(name, getattr(layer, name)))
    ]
    if not entries:
        return fallback
    return F.coalesce(F.try_element_at(F.create_map(*entries), F.col("library_name")), fallback)


def effective_options(documents: DataFrame, options: Options) -> DataFrame:
    """Add ``args, allow_insecure, subfolder`` and the warning flags ``insecure, contradiction``.

    A value given for the run beats the library's, that beats the shared one, that the default; lists replace each
    other whole, and an explicit false or empty list is a value. The layers are configuration with at most one
    entry per library, so they become constants of the projection: no join.
    """
    args = _effective("args", options, ())
    chosen = documents.select(
        "*",
        args.alias("args"),
        _effective("allow_insecure", options, False).alias("allow_insecure"),
        _effective("subfolder", options, None).alias("subfolder"),
    )
    return chosen.select(
        "*",
        F.col("allow_insecure").alias("insecure"),
        (~F.col("allow_insecure") & F.array_contains("args", ACCEPT_INVALID_CERTS)).alias("contradiction"),
    )


def option_warnings(spark: SparkSession, options: Options) -> DataFrame:
    """``scope, insecure, contradiction``: what to warn about, once for everything and once per library.

    The scope is null for what holds everywhere. A library has a row of its own only if its layer says something about
    arguments or certificates. Rows without a warning are left out.
    """
    scopes: list[tuple[str | None, OptionLayer]] = [(None, OptionLayer())]
    scopes += [(name, layer) for name, layer in options.libraries.items()
               if layer.args is not None or layer.allow_insecure is not None]
    rows = []
    for scope, library in scopes:
        named = [options.run, library, options.shared]
        args = next((layer.args for layer in named if layer.args is not None), ())
        allow = next((layer.allow_insecure for layer in named if layer.allow_insecure is not None), False)
        contradiction = not allow and ACCEPT_INVALID_CERTS in args
        if allow or contradiction:
            rows.append((scope, allow, contradiction))
    return spark.createDataFrame(rows, "scope string, insecure boolean, contradiction boolean")


def work_orders(pages: DataFrame, tool_path: str = Options.tool_path) -> DataFrame:
    """One download order per page: ``command`` (tool, arguments, source, target) and ``page_url``.

    Reads pages with ``args, allow_insecure, download_url, output_base``. The certificate switch is appended once.
    """
    add_switch = F.col("allow_insecure") & ~F.array_contains("args", ACCEPT_INVALID_CERTS)
    args = F.when(add_switch, F.array_append("args", ACCEPT_INVALID_CERTS)).otherwise(F.col("args"))
    return pages.select(
        "doc_key",
        "page_index",
        F.concat(F.array(F.lit(tool_path)), args, F.array("download_url", "output_base")).alias("command"),
        "page_url",
    )


def option_layers(rows) -> Options:
    """Options from ``(layer, library_name, args, allow_insecure, subfolder)`` rows of a layer table."""
    layers = {"run": OptionLayer(), "global": OptionLayer()}
    libraries = {}
    for layer, library, args, allow_insecure, subfolder in rows:
        value = OptionLayer(args, allow_insecure, subfolder)
        if layer == "library":
            libraries[library] = value
        else:
            layers[layer] = value
    return Options(run=layers["run"], libraries=libraries, shared=layers["global"])
