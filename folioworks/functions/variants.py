"""Typed reads from VARIANT columns: what is there, and is it a string?"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from folioworks.config import JsonPath


def variant_path(path: JsonPath) -> str:
    """Variant path for a list of keys and positions."""
    steps = []
    for step in path:
        if isinstance(step, int):
            steps.append(f"[{step}]")
        elif "'" in step:
            raise ValueError(f"a key must not hold a single quote: {step!r}")
        else:
            steps.append(f"['{step}']")
    return "$" + "".join(steps)


def type_of(value: Column) -> Column:
    """Type name of a variant: VOID for JSON null, NULL when there is nothing."""
    return F.schema_of_variant(value)


def text_at(root: Column, is_object: Column, path: JsonPath) -> tuple[Column, Column]:
    """Kind (``string``, ``missing`` or ``invalid``) and text found at ``path``.

    A position applied to a string takes its character there, so a bare string counts like a list of letters.
    """
    leaf = F.variant_get(root, variant_path(path), "variant")
    text = F.try_variant_get(root, variant_path(path), "string")
    letter = F.lit(None).cast("string")
    if isinstance(path[-1], int):
        parent = F.variant_get(root, variant_path(path[:-1]), "variant")
        whole = F.try_variant_get(root, variant_path(path[:-1]), "string")
        letter = F.when(type_of(parent) == "STRING", F.nullif(F.substring(whole, path[-1] + 1, 1), F.lit("")))
    kind = (
        F.when(F.is_variant_null(root), "missing")
        .when(~is_object, "invalid")
        .when(leaf.isNull(), F.when(letter.isNotNull(), "string").otherwise("missing"))
        .when(F.is_variant_null(leaf), "missing")
        .when(type_of(leaf) == "STRING", "string")
        .otherwise("invalid")
    )
    return kind, F.coalesce(F.when(leaf.isNull(), letter).otherwise(text), F.lit(""))
