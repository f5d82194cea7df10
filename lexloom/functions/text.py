"""Text normalisation, page classes and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import let

# Thresholds, garbage ranges and identifier lengths of the source format.
EMPTY_CHARS, GARBAGE_RATIO = 30, 0.02
GARBAGE = r"[\uFFFD\p{Co}\u4E00-\u9FFF\u3040-\u30FF\uFF00-\uFFEF]"
SLUG_CHARS, DOC_SLUG_CHARS, ID_WORDS = 60, 24, 5


def strip(c: Column) -> Column:
    """Without white space, Unicode's included, at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def canonical(c: Column) -> Column:
    """What the page layout put in is taken out: soft hyphens, the line break
    after a hyphen, and runs of white space."""
    joined = F.regexp_replace(F.replace(c, F.lit("\u00ad"), F.lit("")), r"(?U)-\s*\n\s*", "-")
    return strip(F.regexp_replace(joined, r"(?U)\s+", " "))


def words(c: Column) -> Column:
    """The words between white space."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


def page_class(c: Column) -> Column:
    """struct(classification, garbage_ratio) of a page's text; a null is empty."""

    def of(s: Column) -> Column:
        n = F.length(s)
        ratio = F.regexp_count(s, F.lit(GARBAGE)) / F.greatest(n, F.lit(1))
        label = F.when(n < EMPTY_CHARS, "empty").when(ratio > GARBAGE_RATIO, "corrupted").otherwise("clean")
        return F.struct(label.alias("classification"), F.when(n < EMPTY_CHARS, F.lit(0.0)).otherwise(F.round(ratio, 4)).alias("garbage_ratio"))

    return let(strip(F.coalesce(c, F.lit(""))), of)


def file_slug(c: Column) -> Column:
    """Every character but letters and digits becomes an underscore."""
    return F.regexp_replace(c, r"(?U)[^\p{IsAlphabetic}\p{N}]", "_")


def _underscored(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_")


def slug(c: Column) -> Column:
    """Identifier of a label: at most 60 characters of a-z, 0-9 and underscore."""
    return F.substring(F.btrim(_underscored(canonical(c)), F.lit("_")), 1, SLUG_CHARS)


def citation_slug(doc_id: Column, citation: Column) -> Column:
    """Identifier of a place: shortened document, two underscores, citation."""
    doc = F.btrim(F.substring(_underscored(doc_id), 1, DOC_SLUG_CHARS), F.lit("_"))
    return F.concat(doc, F.lit("__"), F.btrim(_underscored(citation), F.lit("_")))


def instrument_rank(doc_id: Column) -> Column:
    """national, perwal or perda, by the document's name."""
    return F.when(doc_id.rlike("(?i)^(UU|PP)_"), "national").when(doc_id.rlike("(?i)perwal|perwali|peraturan_wali"), "perwal").otherwise("perda")


def term_like(label: Column) -> Column:
    """Short enough to be its own identifier."""
    return F.size(words(canonical(label))) <= ID_WORDS


def percent(c: Column, digits: int = 0) -> Column:
    """A fraction as a percentage, for reports."""
    return F.format_string(f"%.{digits}f%%", c * 100)
