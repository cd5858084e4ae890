"""Path, identity and hashing expressions (operators S1-S7, AGG8).

All are native column expressions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import WS_CHARS, let, py_strip

# Fixed values that must equal the reference's.
# UUID namespace for URLs (RFC 4122), used for the file uid (UUIDv5 of "<hash>:<path>").
NAMESPACE_URL_HEX = "6ba7b8119dad11d180b400c04fd430c8"
# File types accepted at registration, Office types with a temp-file form, and the temp prefix.
SUPPORTED_FILE_TYPES = ("pdf", "docx", "xlsx", "pptx", "txt", "md", "markdown")
OFFICE_FILE_TYPES = ("docx", "xlsx", "pptx")
OFFICE_TEMP_PREFIX = "~$"


def _trailing_dot_parts(p: Column) -> Column:
    """Drop trailing ``/`` and ``/.`` components, which a pure path ignores."""
    return F.regexp_replace(p, r"(/+\.)*/*\z", "")


def path_name(p: Column) -> Column:
    """``PurePosixPath(p).name``: the last component, '' for '', '.' and '/'."""
    last = F.element_at(F.split(_trailing_dot_parts(p), "/"), -1)
    return F.when(last == ".", F.lit("")).otherwise(last)


def name_suffix(name: Column) -> Column:
    """``PurePosixPath(name).suffix`` of a single name: from the last dot, when it is neither first nor last."""
    return F.regexp_extract(name, r"(?s)^.+(\.[^.]+)\z", 1)


def name_stem(name: Column) -> Column:
    """``PurePosixPath(name).stem``."""
    return F.substring(name, F.lit(1), F.length(name) - F.length(name_suffix(name)))


def file_ext(p: Column) -> Column:
    """Lower-case extension without the dot (``PurePosixPath(p).suffix.lower().lstrip('.')``)."""
    return F.lower(F.regexp_extract(_trailing_dot_parts(p), r"[^/]\.([^/.]+)\z", 1))


def is_office_temp(p: Column, ext: Column) -> Column:
    """FLT2: an Office type whose base name (cut at '/' only) starts with the temp prefix."""
    return ext.isin(*OFFICE_FILE_TYPES) & path_name(p).startswith(OFFICE_TEMP_PREFIX)


def normalize_path(p: Column, strip: bool = True) -> Column:
    """Strip, backslashes to slashes, then ``posixpath.normpath``.

    One pass over the '/'-separated parts: leading empty parts count the leading slashes (two are kept, three or
    more collapse to one), '' and '.' parts vanish, '..' pops where it can, is kept at the front of a relative path
    and dropped at the root of an absolute one. An empty result is '.'.
    """
    parts = F.split(F.replace(py_strip(p), F.lit("\\"), F.lit("/")), "/") if strip else F.split(p, "/")
    init = F.struct(
        F.array().cast("array<string>").alias("stack"), F.lit(0).alias("lead"), F.lit(False).alias("seen"),
        F.lit(0).alias("n"),
    )

    def step(acc, x):
        stack, lead, seen = acc["stack"], acc["lead"], acc["seen"]
        leading = (~seen) & (x == "")
        keep_dotdot = (lead == 0) & ((F.size(stack) == 0) | (F.element_at(stack, -1) == ".."))
        new_stack = (
            F.when(leading | (x == "") | (x == "."), stack)
            .when((x != "..") | keep_dotdot, F.concat(stack, F.array(x)))
            .when(F.size(stack) > 0, F.slice(stack, 1, F.size(stack) - 1))
            .otherwise(stack)
        )
        return F.struct(
            new_stack.alias("stack"), F.when(leading, lead + 1).otherwise(lead).alias("lead"),
            (seen | (x != "")).alias("seen"), (acc["n"] + 1).alias("n"),
        )

    def finish(acc):
        slashes = F.when(acc["seen"], acc["lead"]).otherwise(acc["n"] - 1)
        lead = F.when(slashes == 2, F.lit("//")).when(slashes >= 1, F.lit("/")).otherwise(F.lit(""))
        joined = F.concat(lead, F.array_join(acc["stack"], "/"))
        return F.when(joined == "", F.lit(".")).otherwise(joined)

    return F.aggregate(parts, init, step, finish)


def ordered_distinct(values: Column) -> Column:
    """AGG8: keep the first occurrence of each non-empty value, in order."""
    return F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (x != "")))


def path_candidates(p: Column) -> Column:
    """S3: ordered candidate locations of a catalogue path.

    The normalised path; when its first part starts with 'volume' and more parts follow, the rest as an absolute
    and as a relative path; when absolute, the path without leading slashes.
    """

    def build(norm):
        parts = F.filter(F.split(norm, "/"), lambda x: x != "")
        rest = F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1))), "/")
        volume = F.element_at(parts, 1).startswith("volume") & (F.size(parts) > 1)
        return ordered_distinct(
            F.array(
                norm,
                F.when(volume, F.concat(F.lit("/"), rest)),
                F.when(volume, rest),
                F.when(norm.startswith("/"), F.ltrim(norm, F.lit("/"))),
            )
        )

    return let(normalize_path(p), build)


def content_hash(content: Column) -> Column:
    """SHA-256 hex of the file bytes."""
    return F.sha2(content, 256)


def file_uid(file_hash: Column, original_path: Column) -> Column:
    """``uuid5(NAMESPACE_URL, f'{hash}:{path}').hex`` from SHA-1, version and variant digits set."""
    name = F.encode(F.concat(file_hash, F.lit(":"), original_path), "UTF-8")
    h = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE_URL_HEX)), name))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat(F.substring(h, 1, 12), F.lit("5"), F.substring(h, 14, 3), variant, F.substring(h, 18, 15))


def safe_local_name(file_name: Column, file_id: Column) -> Column:
    """Local file name: illegal characters to '_', blanks and dots trimmed, empty stem -> ``file_<id>``."""
    name = path_name(file_name)
    suffix = name_suffix(name)
    stem = F.substring(name, F.lit(1), F.length(name) - F.length(suffix))
    fallback = F.concat(F.lit("file_"), file_id.cast("string"))
    safe = F.btrim(F.regexp_replace(stem, r'[<>:"/\\|?*\x00-\x1f]', "_"), F.lit(" ."))
    safe = F.when((stem == "") | (safe == ""), fallback).otherwise(safe)
    return F.concat(safe, suffix)


def base_name(p: Column) -> Column:
    """Base name without directories."""
    return path_name(p)


__all__ = [
    "SUPPORTED_FILE_TYPES", "OFFICE_FILE_TYPES", "OFFICE_TEMP_PREFIX", "WS_CHARS", "path_name", "name_suffix",
    "name_stem", "file_ext", "is_office_temp", "normalize_path", "ordered_distinct", "path_candidates",
    "content_hash", "file_uid", "safe_local_name", "base_name",
]
