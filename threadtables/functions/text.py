"""Text expressions: handles, labels, stitched blocks, quote stripping, links, slugs, excerpts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadtables.functions import content as C
from threadtables.functions import fields as FL

# Every line boundary of a text, and white space in the widest sense (Unicode plus the separators 1c-1f).
_LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
_SPACE = r"[\s\x1c-\x1f]"
_QUOTED = rf"(?U)^{_SPACE}*>"
_ENDS = rf"(?U)^{_SPACE}+|{_SPACE}+\z"
_RIGHT_END = rf"(?U){_SPACE}+\z"


def first_signature(signatures: Column) -> Column:
    return F.coalesce(F.get(signatures, 0), F.lit(""))


def handle(signature: Column) -> Column:
    """Last path segment with blanks for underscores."""
    return F.replace(F.substring_index(signature, "/", -1), F.lit("_"), F.lit(" "))


def pretty_label(key: Column) -> Column:
    """Title case that starts anew after every non-letter, so `a1b_c-d` gives `A1B C-D`."""
    runs = F.regexp_extract_all(F.replace(key, F.lit("_"), F.lit(" ")), F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, _ENDS, "")


def _labelled(parsed: Column, fields: list[str]) -> Column:
    return C.truthy_blocks(parsed, {f: FL.label(f) + ":\n" for f in fields}, FL.BLOCK_SEPARATOR)


def review_text(parsed: Column, fields: list[str] = FL.REVIEW_TEXT_FIELDS) -> Column:
    return _labelled(parsed, fields)


def meta_review_text(parsed: Column, fields: list[str] = FL.META_TEXT_FIELDS) -> Column:
    return _labelled(parsed, fields)


def strip_quoted_text(text: Column) -> Column:
    """Drop lines that start with `>`, collapse blank runs to one blank line, strip the ends."""
    own = F.filter(F.split(text, _LINE_BREAK, -1), lambda line: ~line.rlike(_QUOTED))
    return strip(F.regexp_replace(F.array_join(own, "\n"), r"\n{3,}", "\n\n"))


def reply_text(parsed: Column, fields: list[str] = FL.REPLY_TEXT_FIELDS) -> Column:
    return strip_quoted_text(C.truthy_blocks(parsed, {f: "" for f in fields}, FL.BLOCK_SEPARATOR))


def forum_url(forum: Column, site: str) -> Column:
    return F.concat(F.lit(f"{site}/forum?id="), forum)


def profile_url(profile_id: Column, site: str) -> Column:
    return F.concat(F.lit(f"{site}/profile?id="), profile_id)


def format_authors(names: Column, ids: Column, site: str) -> Column:
    """`name (link)` for `~` ids, the plain name otherwise; the longer list is cut to the shorter."""
    n = F.least(F.size(names), F.size(ids))
    shown = F.zip_with(
        F.slice(names, F.lit(1), n),
        F.slice(ids, F.lit(1), n),
        lambda name, i: F.when(
            i.startswith("~"), F.concat(name, F.lit(" ("), profile_url(i, site), F.lit(")"))
        ).otherwise(name),
    )
    return F.array_join(shown, "; ")


def author_ids(ids: Column) -> Column:
    return F.filter(ids, lambda i: i.startswith("~"))


def split_author_cell(cell: Column) -> Column:
    """Authors of a written cell: split at `;`, stripped, blanks dropped."""
    return F.filter(F.transform(F.split(cell, ";"), strip), lambda a: a != "")


def venue_slug(venue_id: Column) -> Column:
    return F.replace(F.replace(venue_id, F.lit(".cc/"), F.lit("_")), F.lit("/"), F.lit("_"))


def bucket_slug(bucket: Column) -> Column:
    """File-name token of a bucket; `Unknown` when nothing is left."""
    token = F.btrim(F.regexp_replace(bucket, "[^0-9A-Za-z]+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(token, F.lit("")), F.lit("Unknown"))


def excerpt(text: Column, length: int, marker: str = " ...", empty: str = "_(empty)_") -> Column:
    """Stripped text, cut to `length` characters and marked when longer."""
    t = strip(text)
    cut = F.concat(F.regexp_replace(F.left(t, F.lit(length)), _RIGHT_END, ""), F.lit(marker))
    return (
        F.when(F.coalesce(text, F.lit("")) == "", F.lit(empty))
        .when(F.char_length(t) > length, cut)
        .otherwise(t)
    )


def shortened(text: Column, length: int, marker: str = "...") -> Column:
    """First `length` characters as they are, marked when longer."""
    return F.when(F.char_length(text) > length, F.concat(F.left(text, F.lit(length)), F.lit(marker))).otherwise(text)


def cell(c: Column) -> Column:
    """Output cell: text, '' for NULL."""
    return F.coalesce(c.cast("string"), F.lit(""))
