"""HTML text to an array of labelled items, as one column expression.

A page is one row before and after, so reading order, numbering and everything
derived from them need neither a shuffle nor a window.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

ITEM_TYPE = "array<struct<label:string,level:int,text:string>>"

# Control characters that mark where an item starts and where its tag name ends.
_ITEM, _NAME = "\x1e", "\x1f"

# One pass from the left: whatever starts first hides what is inside it.
_BOILERPLATE = (
    r"(?is)<(?:!--.*?--|script\b.*?</script\s*|style\b.*?</style\s*|nav\b.*?</nav\s*"
    r'|footer\b.*?</footer\s*|head\b.*?</head\s*|div class="ad">.*?</div\s*)>'
)
_BLOCK = r"(?i)<(/?(?:h[1-6]|p|li|tr|pre))\b[^>]*>"
_CELL = r"(?i)<t[dh]\b[^>]*>"
_IMAGE = r"""(?i)<img\b[^>]*?\bsrc\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))[^>]*>"""
# A bracket opens a tag only before a letter, a slash or a mark of a declaration.
_TAG = "<[A-Za-z/!?][^>]*>"
_SPACES = r"[ \t\n\r\x{0b}\x{0c}\x{85}\x{a0}]+"
_REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]*);"

#: Characters by the names that HTML 4 gives them, and the apostrophe.
NAMED_CHARACTERS = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"}
_UNKNOWN = "\ufffd"
# The ampersand comes last, so that what it begins is not resolved again.
_USUAL = (("&nbsp;", "\xa0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"))
_UNUSUAL = "&(?!(?:" + "|".join(name[1:-1] for name, _ in _USUAL) + ");)(?:#|[A-Za-z][A-Za-z0-9]*;)"


def _numbered(code: Column) -> Column:
    """The character of a code point; control characters and numbers that are none give a replacement character."""
    whole = code.between(32, 0xD7FF) | code.between(0xE000, 0x10FFFF) | code.isin(9, 10, 13)
    bytes_ = F.unhex(F.lpad(F.hex(F.when(whole, code)), 8, "0"))
    return F.coalesce(F.decode(bytes_, "UTF-32"), F.lit(_UNKNOWN))


def _resolved(segment: Column) -> Column:
    """Text that followed an ampersand, with its reference resolved; what is no reference stays."""
    name = F.regexp_extract(segment, _REFERENCE, 1)
    named = F.create_map(*[F.lit(x) for pair in NAMED_CHARACTERS.items() for x in pair])
    code = F.when(F.lower(F.substring(name, 1, 2)) == "#x", F.conv(F.substring(name, 3, 6), 16, 10)).when(
        F.substring(name, 1, 1) == "#", F.substring(name, 2, 7)
    )
    character = F.when(code.isNotNull(), _numbered(code.cast("long"))).otherwise(F.try_element_at(named, name))
    rest = F.substring(segment, F.length(name) + 2, F.length(segment))
    return F.coalesce(F.concat(character, rest), F.concat(F.lit("&"), segment))


def resolve_references(text: Column) -> Column:
    """Named and numeric character references, each resolved once: ``&amp;lt;`` becomes ``&lt;``.

    Texts that hold the usual ones alone, as nearly all do, take a chain of plain replacements.
    """

    def one(text: Column) -> Column:
        usual = text
        for reference, character in _USUAL:
            usual = F.replace(usual, F.lit(reference), F.lit(character))
        parts = F.split(text, "&")
        resolved = F.concat(F.slice(parts, 1, 1), F.transform(F.slice(parts, 2, F.size(parts)), _resolved))
        return F.when(text.rlike(_UNUSUAL), F.array_join(resolved, "")).otherwise(usual)

    # A transform of one element, so that what gives the text is computed once.
    return F.transform(F.array(text), one)[0]


def marked_text(html: Column) -> Column:
    """Page text with a mark and a tag name before every item and no other markup.

    What follows the end of a block is an item too, named by the closing tag.
    """
    text = F.replace(F.replace(html, F.lit(_ITEM), F.lit("")), F.lit(_NAME), F.lit(""))
    text = F.regexp_replace(text, _BOILERPLATE, "")
    text = F.regexp_replace(text, _IMAGE, f"{_ITEM}img{_NAME}$1$2$3{_ITEM}{_NAME}")
    text = F.regexp_replace(text, _CELL, " | ")
    text = F.regexp_replace(text, _BLOCK, f"{_ITEM}$1{_NAME}")
    text = resolve_references(F.regexp_replace(text, _TAG, " "))
    return F.concat(F.lit(_ITEM + _NAME), F.regexp_replace(text, _SPACES, " "))


def _tagged(segment: Column) -> Column:
    return F.struct(
        F.lower(F.substring_index(segment, _NAME, 1)).alias("tag"),
        F.trim(F.substring_index(segment, _NAME, -1)).alias("text"),
    )


def _item(found: Column) -> Column:
    tag, text = found["tag"], found["text"]
    heading = tag.rlike("^h[1-6]$")
    label = (
        F.when(tag == "h1", "title")
        .when(tag == "li", "list_item")
        .when(tag == "tr", "table_row")
        .when(tag == "pre", "code")
        .when(tag == "img", "picture")
        .when(heading, "section_header")
        .otherwise("text")
    )
    level = F.when(heading, F.substring(tag, 2, 1).try_cast("int")).otherwise(F.lit(0))
    row = F.regexp_replace(text, r"^\| ", "")
    return F.struct(
        label.alias("label"),
        level.alias("level"),
        F.when(tag == "tr", row).otherwise(text).alias("text"),
    )


def html_items(html: Column) -> Column:
    """Items of a page in reading order; items without text are dropped."""
    segments = F.transform(F.array_remove(F.split(marked_text(html), _ITEM), ""), _tagged)
    return F.transform(F.filter(segments, lambda found: found["text"] != ""), _item)
