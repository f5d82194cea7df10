"""All matches of a pattern with their offsets, natively.

Matches are wrapped in two sentinels by one ``regexp_replace``; the pieces
between the first sentinels then give text and offsets of each match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import let, rows_of

_OPEN, _CLOSE = "\x01", "\x02"
#: Element of a list of matches; offsets are half-open, in code points.
MATCH = "struct<start:int,end:int,text:string>"
#: Elements that are summed in one go, at least: each appends to a copy of the sums before it.
_BLOCK = 16


def _summed(sizes: Column, start: Column) -> Column:
    """``start`` plus the running sums of a short array."""
    zero = F.array().cast("array<int>")
    return F.aggregate(sizes, zero, lambda acc, n: F.array_append(acc, F.coalesce(F.element_at(F.when(F.size(acc) > 0, acc), -1), start) + n))


def running_sums(sizes: Column) -> Column:
    """Running sums of an array, in blocks of the square root of its size, so
    that the work does not grow with its square."""

    def of(all_sizes: Column) -> Column:
        width = F.greatest(F.lit(_BLOCK), F.ceil(F.sqrt(F.size(all_sizes))).cast("int"))
        return F.when(F.size(all_sizes) <= _BLOCK, _summed(all_sizes, F.lit(0))).otherwise(let(width, lambda w: blockwise(all_sizes, w)))

    def blockwise(all_sizes: Column, width: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.greatest(F.size(all_sizes), F.lit(1)) - 1) / width).cast("int"))
        part = lambda b: F.slice(all_sizes, b * width + 1, width)
        totals = F.transform(blocks, lambda b: F.aggregate(part(b), F.lit(0), lambda acc, n: acc + n))
        before = lambda t, b: F.coalesce(F.get(t, b - 1), F.lit(0))
        return let(_summed(totals, F.lit(0)), lambda t: F.flatten(F.transform(blocks, lambda b: _summed(part(b), before(t, b)))))

    return let(sizes, of)


def sentinels(text: Column) -> Column:
    """Whether a text holds what matches are wrapped in."""
    return text.contains(_OPEN) | text.contains(_CLOSE)


def _without_sentinels(text: Column) -> Column:
    # replace compares at every byte and translate goes letter by letter; hardly any text has one
    return F.when(sentinels(text), F.replace(F.replace(text, F.lit(_OPEN), F.lit("\ufffd")), F.lit(_CLOSE), F.lit("\ufffd"))).otherwise(text)


def _matches(text: Column, pattern: str, rest: bool, groups: tuple[str, ...] = ()) -> Column:
    clean = _without_sentinels(text)
    names = ("text", *groups, *(("rest",) if rest else ()))
    marked = F.regexp_replace(clean, pattern, _OPEN + _CLOSE.join(["$0", *(f"${k + 1}" for k in range(len(groups))), ""]))

    def match(fields: Column, start: Column) -> Column:
        return F.struct(start.alias("start"), (start + F.length(fields[0])).alias("end"), *(fields[k].alias(name) for k, name in enumerate(names)))

    def of(parts: Column) -> Column:
        fields = F.transform(F.slice(parts, F.lit(2), F.size(parts) - 1), lambda part: F.split(part, _CLOSE))
        return let(F.struct(F.length(parts[0]).alias("first"), fields.alias("fields")), read)

    def read(known: Column) -> Column:
        # of most texts there is one match, whose start needs no sums
        size = lambda f: F.length(f[0]) + F.length(f[len(groups) + 1])
        sums = running_sums(F.concat(F.array(known["first"]), F.transform(known["fields"], size)))
        several = let(sums, lambda ends: F.transform(known["fields"], lambda f, i: match(f, ends[i])))
        return F.when(F.size(known["fields"]) == 1, F.transform(known["fields"], lambda f: match(f, known["first"]))).otherwise(several)

    none = F.array().cast(f"array<{MATCH[:-1]}{''.join(f',{name}:string' for name in names[1:])}>>")
    found = let(F.split(marked, _OPEN), of)
    return F.when(clean.rlike(pattern), found).when(text.isNotNull(), none)


def find_all(text: Column, pattern: str, *groups: str) -> Column:
    """array<struct<start, end, text>> of the matches, in order; the pattern's
    groups, empty where they take no part, come along by the names given."""
    return _matches(text, pattern, False, groups)


def find_with_rest(text: Column, pattern: str, *groups: str) -> Column:
    """The same with ``rest``: what follows each match up to the next, which
    costs nothing more than the split that finds them."""
    return _matches(text, pattern, True, groups)


def rows_of_all(df: DataFrame, text: Column, pattern: str, *columns: str) -> DataFrame:
    """``rows_of`` the matches of ``find_all``, by one run of the pattern.

    In columns, which Spark compiles: a text with one match, or none, gets to no lambda.
    """
    clean = df.select(*columns, _without_sentinels(text).alias("__text"))
    split = clean.select(*columns, "__text", F.split(F.regexp_replace("__text", pattern, f"{_OPEN}$0{_CLOSE}"), _OPEN).alias("__parts"))
    parts = F.col("__parts")
    start, only = F.length(parts[0]), F.substring_index(F.get(parts, F.lit(1)), _CLOSE, 1)
    one = F.array(F.struct(start.alias("start"), (start + F.length(only)).alias("end"), only.alias("text")))
    none = F.array().cast(f"array<{MATCH}>")
    return rows_of(split, F.when(F.size(parts) == 2, one).when(F.size(parts) > 2, find_all(F.col("__text"), pattern)).otherwise(none), *columns)


def first_start(text: Column, pattern: str) -> Column:
    """Offset of the first match, null without one."""
    clean = _without_sentinels(text)
    at = F.when(clean.rlike(pattern), F.instr(F.regexp_replace(clean, pattern, f"{_OPEN}$0"), _OPEN))
    return F.when(at > 0, at - 1)


def cut(text: Column, start: Column, end: Column) -> Column:
    """text[start:end] by half-open offsets."""
    return F.substring(text, start + 1, end - start)
