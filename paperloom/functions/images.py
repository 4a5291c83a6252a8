"""How a picture appears in exported Markdown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom import constants as C


def check_image_mode(mode: str) -> str:
    if mode not in C.IMAGE_MODES:
        raise ValueError(f"unknown image mode {mode!r}; choose from {list(C.IMAGE_MODES)}")
    return mode


def picture_markdown(
    mode: str,
    uri: Column,
    content: Column | None = None,
    mime: str = "image/png",
) -> Column:
    """Markdown for a picture.

    ``embedded`` writes the bytes in place (a picture without bytes keeps its
    link), ``referenced`` links to the file, ``placeholder`` only marks the spot.
    """
    check_image_mode(mode)
    link = F.concat(F.lit("![Image]("), uri, F.lit(")"))
    if mode == "placeholder":
        return F.lit("<!-- image -->")
    if mode == "referenced" or content is None:
        return link
    return F.coalesce(F.concat(F.lit("![Image]("), data_address(content, mime), F.lit(")")), link)


def data_address(content: Column, mime: str = "image/png") -> Column:
    """The bytes as an address that holds them; null without bytes."""
    return F.concat(F.lit(f"data:{mime};base64,"), F.translate(F.base64(content), "\r\n", ""))
