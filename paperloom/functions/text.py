"""Scalar text functions: names, tokens, previews."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom import constants as C

_BLANKS = f"{C.SPACE_CLASS}+"


def words(text: Column) -> Column:
    """White-space separated words, as Python's ``str.split()`` gives them."""
    plain = F.translate(text, C.SPACES, " " * len(C.SPACES))
    return F.array_remove(F.split(plain, " "), "")


def token_count(text: Column) -> Column:
    """Rough token count: the number of white-space separated words."""
    return F.size(words(text))


def strip(text: Column) -> Column:
    """Remove white space at both ends, Unicode spaces included."""
    return F.regexp_replace(text, rf"\A{_BLANKS}|{_BLANKS}\z", "")


def _stem(path: Column) -> Column:
    """Last path segment without its last suffix; a leading dot is not a suffix."""
    trimmed = F.regexp_replace(path, r"(?:(?:^|/)\.?)+$", "")
    segment = F.substring_index(trimmed, "/", -1)
    return F.regexp_replace(segment, r"(?s)^(.+)\.[^.]+$", "$1")


def url_path(url: Column) -> Column:
    """Path part of a URL: no host, query, fragment or ``;parameters`` of the last segment."""
    cleaned = F.regexp_replace(url, r"[\t\r\n]", "")
    path = F.regexp_extract(cleaned, r"^https?://[^/?#]*([^?#]*)", 1)
    return F.regexp_replace(path, r";[^/]*$", "")


def safe_filename(source: Column) -> Column:
    """File-system safe name for a path or URL.

    A URL whose last segment is empty, short or generic is named by a digest of
    the whole URL, so two such documents do not share a name.
    """
    is_url = source.startswith("http://") | source.startswith("https://")
    stem = F.when(is_url, _stem(url_path(source))).otherwise(_stem(source))
    vague = (
        (F.length(stem) < C.MIN_NAME_CHARS) | F.lower(stem).isin(*C.UNHELPFUL_NAMES)
    )
    digest = F.concat(F.lit("doc_"), F.substring(F.md5(source), 1, C.NAME_DIGEST_CHARS))
    return F.regexp_replace(
        F.when(is_url & vague, digest).otherwise(stem), r"[^A-Za-z0-9._-]", "_"
    )


def dataset_name(path: Column) -> Column:
    """Base name without extension; anything but letters, digits, ``_`` and ``-`` becomes ``_``."""
    base = F.substring_index(path, "/", -1)
    root = F.regexp_replace(base, r"(?s)^(\.*[^.].*)\.[^.]*$", "$1")
    return F.regexp_replace(root, r"[^\p{L}\p{N}_-]", "_")


def join_location(base: Column, name: Column) -> Column:
    """``base/name`` with exactly one slash between them."""
    return F.concat(
        F.regexp_replace(base, r"/+$", ""), F.lit("/"), F.regexp_replace(name, r"^/+", "")
    )


def with_instruction(
    text: Column, instruction: str = "", default: str | None = C.DEFAULT_INSTRUCTION
) -> Column:
    """``instruction: text``; an empty instruction falls back to the encoder's default."""
    chosen = instruction or default
    if not chosen:
        raise ValueError("an instruction is needed: none was given and the encoder has no default")
    return F.concat(F.lit(f"{chosen}: "), text)


def preview(text: Column, chars: int = C.CHUNK_PREVIEW_CHARS) -> Column:
    """The first ``chars`` characters, with dots only when something was cut."""
    return F.when(
        F.length(text) > chars, F.concat(F.substring(text, 1, chars), F.lit("..."))
    ).otherwise(text)


def hit_preview(text: Column) -> Column:
    """One-line preview of a search hit, always closed with dots."""
    return F.concat(
        F.translate(F.substring(text, 1, C.HIT_PREVIEW_CHARS), "\n", " "), F.lit("...")
    )


def hit_source(source: Column) -> Column:
    """Last segment of a source, cut for display and closed with dots."""
    return F.concat(
        F.substring(F.substring_index(source, "/", -1), 1, C.HIT_SOURCE_CHARS), F.lit("...")
    )
