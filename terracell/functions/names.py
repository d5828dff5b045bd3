"""URLs, file names and month texts."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .binding import let


def pad_month(month: Column) -> Column:
    """Two-digit month text; longer texts are left alone (lpad would cut them)."""
    text = month.cast("string")
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


def _missing(key: Column) -> Column:
    return F.raise_error(F.concat(F.lit("url_template has no value for: "), key)).cast("string")


def render_template(template: str | Column, values: dict[str, Column]) -> Column:
    """Fill ``{key}`` placeholders from ``values`` in a single pass.

    A NULL value stops the job, an unknown key too: a half-filled URL must never
    reach a plan. A template known up front becomes a plain concatenation; a
    template column is filled row by row.
    """
    if isinstance(template, str):
        parts = re.split("[{}]", template)  # even parts are text, odd parts are keys
        unknown = sorted({k for k in parts[1::2] if k not in values})
        if unknown:
            raise KeyError(f"url_template has no value for: {', '.join(unknown)}")
        filled = [
            F.lit(p) if i % 2 == 0 else F.coalesce(values[p].cast("string"), _missing(F.lit(p)))
            for i, p in enumerate(parts) if i % 2 or p
        ]
        return F.concat(*filled)
    context = F.create_map(*[p for k, v in values.items() for p in (F.lit(k), v.cast("string"))])

    def fill_all(known):
        fill = lambda part, i: F.when(i % 2 == 0, part).otherwise(
            F.coalesce(F.try_element_at(known, part), _missing(part))
        )
        return F.array_join(F.transform(F.split(template, "[{}]"), fill), "")

    return let(context, fill_all)


def file_name(url: Column) -> Column:
    return F.substring_index(F.rtrim(url, F.lit("/")), "/", -1)


def stem(name: Column) -> Column:
    """File name without its last ending."""
    ending = F.length(F.substring_index(name, ".", -1)) + 1
    return F.when(F.contains(name, F.lit(".")), F.substr(name, F.lit(1), F.length(name) - ending)).otherwise(name)


def aoi_name(name: Column) -> Column:
    """Name of the clipped copy of a raster file."""
    return F.replace(name, F.lit(".tif"), F.lit("_AOI.tif"))


def plain_path(path: Column) -> Column:
    """Path without ``./`` steps, doubled and trailing separators."""
    dots = F.regexp_replace(F.regexp_replace(path, "/+", "/"), r"(?<=^|/)(?:\./)+", "")
    plain = F.regexp_replace(dots, "(?<=.)/+$", "")
    # most listed paths are plain already, which takes less to see than to replace nothing three times
    return F.when(F.contains(path, F.lit("//")) | F.contains(path, F.lit("./")) | F.rlike(path, F.lit("/$")), plain).otherwise(path)


def relative_path(path: Column, root: str = "") -> Column:
    """Path below ``root``, either with or without a scheme (file:, hdfs://host, s3a://bucket) in front."""
    bare = lambda c: _without_end(plain_path(F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?(?=/)", "")))
    inside, top = bare(path), bare(F.lit(root))
    below = F.concat(top, F.lit("/"))
    return F.when(F.startswith(inside, below), F.substr(inside, F.length(below) + 1)).otherwise(inside) if root else inside


def _without_end(path: Column) -> Column:
    return F.when(F.rlike(path, F.lit("/$")), F.regexp_replace(path, "/$", "")).otherwise(path)


# What a glob consists of: any folders, anything, part of a name, one character, a class, a literal.
_GLOB_PARTS = r"\*\*/|\*\*|\*|\?|\[!?\]?[^\]/]*\]|."


def glob_regex(glob: Column) -> Column:
    """Regular expression for a path glob: ``*``, ``?`` and ``[…]`` stay inside one folder level.

    Classes hold characters and ranges, ``!`` in front negates; an opening
    bracket without its closing one is a literal.
    """
    def piece(part):
        negated = F.startswith(part, F.lit("[!"))
        inner = F.substr(part, F.when(negated, 3).otherwise(2), F.length(part) - F.when(negated, 3).otherwise(2))
        inner = F.regexp_replace(inner, r"([\[\]\\^&])", r"\\$1")
        literal = F.regexp_replace(part, r"([.+^$(){}|\[\]\\*?])", r"\\$1")
        return (
            F.when(part == "**/", "(?:.*/)?").when(part == "**", ".*").when(part == "*", "[^/]*").when(part == "?", "[^/]")
            .when((F.length(part) > 2) & F.startswith(part, F.lit("[")), F.concat(
                F.lit("(?!/)["), F.when(negated, "^").otherwise(""), inner, F.lit("]")))
            .otherwise(literal)
        )

    parts = F.regexp_extract_all(plain_path(glob), F.lit(_GLOB_PARTS), F.lit(0))
    return F.concat(F.lit("^"), F.array_join(F.transform(parts, piece), ""), F.lit("$"))


def glob_folder(glob: Column) -> Column:
    """Deepest folder named before the first wildcard ('' when there is none)."""
    fixed = F.regexp_extract(plain_path(glob), r"^([^*?\[]*)", 1)
    return F.regexp_extract(fixed, r"^(.*)/[^/]*$", 1)


def folder_depth(path: Column) -> Column:
    """Number of folders above the file."""
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def folder_at(path: str, depth: str) -> Column:
    """The ancestor folder ``depth`` levels below the root ('' for 0)."""
    return F.call_function("substring_index", F.col(path), F.lit("/"), F.col(depth))
