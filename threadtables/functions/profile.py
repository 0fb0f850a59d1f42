"""Profile expressions: name, links, expertise, career history."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadtables.functions import fields as FL


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def preferred_name(names: Column) -> Column:
    """First name flagged preferred, else the first one; '' when that entry has no full name."""
    chosen = F.coalesce(F.get(F.filter(names, lambda n: n["preferred"]), 0), F.get(names, 0))
    return _text(chosen["fullname"])


def personal_links(content: Column, labels: dict[str, str] = FL.LINK_LABELS) -> Column:
    """`Label (url)` of every link that is set, in fixed order."""
    shown = [
        F.when(content[k] != "", F.concat(F.lit(f"{name} ("), content[k], F.lit(")")))
        for k, name in labels.items()
    ]
    return F.concat_ws("; ", *shown)


def expertise(entries: Column) -> Column:
    """Keywords of all entries, each once, in the order first seen."""
    none = F.array().cast("array<string>")
    keywords = F.transform(entries, lambda e: F.coalesce(e["keywords"], none))
    return _text(F.array_join(F.array_distinct(F.flatten(keywords)), "; "))


def location(institution: Column) -> Column:
    """`name (domain) [country]`, with whatever parts are there."""
    name, domain, country = (_text(institution[k]) for k in ("name", "domain", "country"))
    in_brackets = F.when(country != "", F.when((name != "") | (domain != ""), F.concat(F.lit("["), country, F.lit("]")))
                         .otherwise(country))
    in_parens = F.when(domain != "", F.when(name != "", F.concat(F.lit("("), domain, F.lit(")"))).otherwise(domain))
    return F.concat_ws(" ", F.nullif(name, F.lit("")), in_parens, in_brackets)


def history_entries(history: Column) -> Column:
    """array<struct<title,location,start,end>> of text, in the given order. Years are shown as they are, be they numbers
    or text; only a missing end is `Present`."""
    return F.transform(
        history,
        lambda h: F.struct(
            _text(h["position"]).alias("title"),
            location(h["institution"]).alias("location"),
            _text(h["start"]).alias("start"),
            F.coalesce(h["end"], F.lit("Present")).alias("end"),
        ),
    )
