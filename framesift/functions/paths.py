"""Path expressions."""

from __future__ import annotations

import posixpath

from pyspark.sql import Column
from pyspark.sql import functions as F

from framesift.schema import IMAGE_EXTENSIONS, VIDEO_EXTENSIONS


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """Base name without its last extension; a leading dot stays."""
    return F.regexp_replace(basename(path), r"^(.+)\.[^.]*$", "$1")


def extension(path: Column) -> Column:
    """Lower-cased extension without the dot, or an empty string."""
    return F.lower(F.regexp_extract(basename(path), r"\.([^.]+)$", 1))


def dirname(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def has_extension(path: Column, extensions: list[str]) -> Column:
    """The path ends with one of the extensions, case ignored."""
    return F.lower(path).rlike(r"\.(" + "|".join(extensions) + ")$")


def is_image(path: Column) -> Column:
    return has_extension(path, IMAGE_EXTENSIONS)


def media_type(path: Column, on_unknown: str = "error") -> Column:
    """'image' or 'video' by extension; anything else raises or reads 'unknown'."""
    if on_unknown == "error":
        other = F.raise_error(F.concat(F.lit("unsupported media type: "), path))
    else:
        other = F.lit("unknown")
    ext = extension(path)
    return (
        F.when(ext.isin(VIDEO_EXTENSIONS), F.lit("video"))
        .when(ext.isin(IMAGE_EXTENSIONS), F.lit("image"))
        .otherwise(other)
    )


def abspath(path: Column, root: str) -> Column:
    """Join below ``root``; an absolute path wins."""
    base = root if root.endswith("/") or root == "" else root + "/"
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(base), path))


def normalised_parts(path: Column) -> Column:
    """Path segments with '.', '' and resolvable '..' removed."""
    return F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part.isin("", "."), done)
        .when(
            (part == "..") & (F.size(done) > 0) & (F.coalesce(F.get(done, F.size(done) - 1), F.lit("")) != ".."),
            F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))),
        )
        .otherwise(F.concat(done, F.array(part))),
    )


def relpath(path: Column, root: str, cwd: str = "/") -> Column:
    """POSIX relative path from ``root``; steps out with '../' where needed.

    A relative path or root is taken from ``cwd``.
    """
    start = [p for p in posixpath.normpath(posixpath.join(cwd, root)).split("/") if p]
    anchored = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(cwd.rstrip("/") + "/"), path))
    parts = normalised_parts(anchored)
    if not start:
        return F.coalesce(F.nullif(F.array_join(parts, "/"), F.lit("")), F.lit("."))
    # Number of leading segments shared with the root.
    shared = F.lit(0)
    prefix = F.lit(True)
    for i, name in enumerate(start):
        prefix = prefix & (F.coalesce(F.get(parts, F.lit(i)), F.lit("\0")) == F.lit(name))
        shared = shared + F.when(prefix, 1).otherwise(0)
    ups = F.array_repeat(F.lit(".."), F.lit(len(start)) - shared)
    rest = F.slice(parts, shared + 1, F.greatest(F.size(parts) - shared, F.lit(0)))
    joined = F.array_join(F.concat(ups, rest), "/")
    return F.when(path.isNotNull(), F.when(joined == "", F.lit(".")).otherwise(joined))


def replace_text(path: Column, old: str, new: str) -> Column:
    """Literal replacement of every occurrence."""
    return F.replace(path, F.lit(old), F.lit(new))


# What counts as a URL (scheme, then domain, localhost or IPv4, port, path).
URL_PATTERN = (
    r"(?i)^(?:http|ftp)s?://"
    r"(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\.)+(?:[A-Z]{2,6}\.?|[A-Z0-9-]{2,}\.?)|"
    r"localhost|"
    r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})"
    r"(?::\d+)?"
    r"(?:/?|[/?]\S+)$"
)


def is_url(value: Column) -> Column:
    return value.rlike(URL_PATTERN)


def sample_path(directory: str, index: Column, name: str = "sample", copy: Column | None = None) -> Column:
    """``directory/name_0007`` with ``-k`` when several samples are drawn per prompt."""
    out = F.concat(F.lit(f"{directory.rstrip('/')}/{name}_"), F.format_string("%04d", index))
    return out if copy is None else F.concat(out, F.lit("-"), copy.cast("string"))


def prompt_sample_path(directory: str, prompt: Column, copy: Column | None = None) -> Column:
    """The prompt itself names the sample."""
    out = F.concat(F.lit(f"{directory.rstrip('/')}/"), prompt)
    return out if copy is None else F.concat(out, F.lit("-"), copy.cast("string"))
