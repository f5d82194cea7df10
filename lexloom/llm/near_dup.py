"""N-gram Jaccard self-join of documents by a grouped prefix join.

Two documents link when their sets of word shingles have a Jaccard similarity
of at least ``percent`` hundredths.  In any one order of all shingles, linked
sets share a member among the first n - ceil(percent n / 100) + 1 of each, so

1. all shingles are counted, and the order puts frequent ones last; those that
   one document alone holds can be shared with nothing and are let go of;
2. documents of one size and prefix are one group, equal sets one variant;
3. groups that share a prefix shingle form a list; pairs of groups in a list are
   filtered by their sizes and by the places of the shingle in both;
4. the pairs that are left are expanded to the variants of both groups, and
   those that no chain of links joins yet are verified on all they can share;
5. components of the verified links give the classes.

Counts never meet on one machine (see ``exchange``): each block of documents asks
for the counts of its own shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .exchange import range_bits, text_bytes, with_counts
from .runtime import keyed_text, slices, stored
from .shingles import mix, narrow, shingle_sets

#: For each round in which a list's groups, and a group's variants, are compared
#: with a few of them only: how many those are.
CENTRES = (16, 64)
BATCH = 2 << 20


def _block_sets(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sets of a block's texts, end to end, and their sizes."""
    made = [shingle_sets(texts[a:b], width) for a, b in slices([len(t) for t in texts], BATCH)]
    return (np.concatenate([m[k] for m in made]) if made else np.zeros(0, np.uint64 if k == 0 else np.int64) for k in (0, 1))


def with_prefixes(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, n, d1, d2, g, prefix, spots, live) of every document.

    n: set size; d1, d2: digest of the set; g: digest of its prefix; prefix and
    live: the members of the prefix, and of the set, that some other document
    may hold, both empty if none of the prefix is; spots: the places in the
    ordered set of those in the prefix.  A member of the prefix is a number that
    sorts as the order does, which goes by the power of two of a shingle's count,
    then by its hash.  A block asks with 32 bits of a hash beside those of its
    range: two shingles that share them count as one, which can only make a
    member look shared.
    """
    size = text_bytes(docs, "text")
    drop = np.uint64(32 - range_bits(size))
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    names = ["doc_id", "n", "d1", "d2", "g", "prefix", "spots", "live"]

    def grams(block: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
        values, _ = _block_sets(block.column("text").to_pylist(), width)
        ids, n = np.unique(values >> drop << drop, return_counts=True)
        return [(ids, n.astype(np.int64))]

    def order(block: pa.Table, counts: list[np.ndarray]) -> pa.Table:
        texts = block.column("text").to_pylist()
        values, n = _block_sets(texts, width)
        power = counts[0][np.unique(values >> drop << drop, return_inverse=True)[1]] if len(values) else np.zeros(0, np.uint8)
        owner = np.repeat(np.arange(len(texts)), n)
        ranked = np.argsort(power, kind="stable")  # within a text, values ascend already
        ranked = ranked[np.argsort(narrow(owner, len(texts))[ranked], kind="stable")]
        begin = np.cumsum(n) - n
        length = np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)
        spot = np.arange(len(values)) - begin[owner]
        ahead = spot < length[owner]
        ordered, shared = values[ranked], power[ranked] > 0
        d1, d2, g = (np.zeros(len(texts), np.uint64) for _ in range(3))
        np.add.at(d1, owner, mix(values + np.uint64(1)))
        np.add.at(d2, owner, mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
        np.add.at(g, owner[ahead], mix(ordered[ahead] + np.uint64(3)))
        lists = []
        links = np.bincount(owner[ahead & shared], minlength=len(texts)) > 0  # without a shared shingle in its prefix, a set links with none
        shared &= links[owner]
        keys = (power[ranked].astype(np.uint64) << np.uint64(57) | ordered >> np.uint64(7)).view(np.int64)
        for some, what, kind in ((ahead & shared, keys, longs), (ahead & shared, spot.astype(np.int32), ints), (shared, ordered.view(np.int64), longs)):
            upto = np.concatenate([[0], np.cumsum(np.bincount(owner[some], minlength=len(texts)))])
            lists.append(pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(what[some])).cast(kind))
        return pa.table([block.column("doc_id").combine_chunks(), pa.array(n, pa.int64()), *(pa.array(x.view(np.int64)) for x in (d1, d2, g)), *lists], names)

    return with_counts(docs, "text", grams, lambda n: np.log2(np.maximum(n, 1)).astype(np.uint8), order, "doc_id long, n long, d1 long, d2 long, g long, prefix array<long>, spots array<int>, live array<long>", size)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b), each given once, whose whole sets are similar enough.

    Nothing after the joins needs its rows together, so adaptive execution can
    split a set that many pairs name.
    """
    one = sets.select(F.col("vid").alias("a"), F.col("n").alias("na"), F.col("live").alias("sa")).hint("merge")
    two = sets.select(F.col("vid").alias("b"), F.col("n").alias("nb"), F.col("live").alias("sb")).hint("merge")
    joined = pairs.join(one, "a").join(two, "b").withColumn("i", F.size(F.array_intersect("sa", "sb")))
    return joined.where(100 * F.col("i") >= percent * (F.col("na") + F.col("nb") - F.col("i"))).select("a", "b")


def _group_lists(variants: DataFrame) -> DataFrame:
    """(list, gid, n, spot): groups that share a prefix shingle, with its place
    in their sets.

    Of lists with the same groups the first in the order stays: it holds the
    first shingle that any two of its groups share.
    """
    groups = variants.groupBy("gid", "n").agg(F.first(F.arrays_zip("prefix", "spots")).alias("prefix"))
    shared = groups.select("gid", "n", F.inline("prefix").alias("h", "spot"))
    lists = shared.groupBy("h").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("gid")).alias("x"), F.bit_xor(F.xxhash64("gid", F.lit(7))).alias("y"))
    kept = lists.where("c > 1").groupBy("c", "x", "y").agg(F.min("h").alias("h")).select("h")
    return shared.join(kept.hint("merge"), "h").select(F.col("h").alias("list"), "gid", "n", "spot")


def _may_link(a: str, b: str, percent: int) -> Column:
    """Whether groups can hold sets that are similar enough, by their sizes and
    by the places of their first shared shingle: what is left from there on
    bounds what they share."""
    most = F.least(F.col(f"{a}n") - F.col(f"{a}spot"), F.col(f"{b}n") - F.col(f"{b}spot"))
    return (100 + percent) * most >= percent * (F.col(f"{a}n") + F.col(f"{b}n"))


def _some_group_pairs(lists: DataFrame, home: DataFrame, step: int, percent: int) -> DataFrame:
    """(ga, gb): every group with a few groups of its longest list."""
    rank = F.xxhash64("gid", F.lit(step))
    member = F.struct("gid", "n", "spot")
    centres = stored(lists.groupBy("list", F.pmod(rank, F.lit(CENTRES[step])).alias("part")).agg(F.min_by(member, rank).alias("b")).select("list", "b"), "centres")
    met = home.select("list", member.alias("a")).join(centres.hint("merge"), "list")
    return met.where((F.col("a.gid") != F.col("b.gid")) & _may_link("a.", "b.", percent)).select(F.col("a.gid").alias("ga"), F.col("b.gid").alias("gb")).distinct()


def _open_group_pairs(lists: DataFrame, spans: DataFrame, percent: int) -> DataFrame:
    """(ga, gb): all pairs of groups that pass the filter and that aren't wholly
    in one component.  spans: (gid, low, high), the components of each group.

    Groups of a list meet only with those of the same or the next band of sizes,
    so sizes that can't be similar enough form no pairs.
    """
    known = stored(lists.join(spans.hint("merge"), "gid"), "list-components")
    still = stored(known.groupBy("list").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high").select("list"), "open-lists")
    here = known.join(still.hint("merge"), "list", "left_semi")
    band = F.floor(F.log2("n") / max(1.01 * np.log2(100 / percent), 1e-6))
    member = F.struct("gid", "n", "spot", "low", "high")
    one = here.select("list", band.alias("band"), member.alias("a"))
    two = here.select("list", F.explode(F.array(band, band - 1)).alias("band"), member.alias("b"))
    ordered = (F.col("a.n") < F.col("b.n")) | (F.col("a.n") == F.col("b.n")) & (F.col("a.gid") < F.col("b.gid"))
    apart = (F.least("a.low", "b.low") != F.greatest("a.high", "b.high"))
    met = one.join(two.hint("merge"), ["list", "band"]).where(ordered & apart & _may_link("a.", "b.", percent))
    return met.select(F.col("a.gid").alias("ga"), F.col("b.gid").alias("gb")).distinct()


def _links(lists: DataFrame, variants: DataFrame, percent: int) -> DataFrame:
    """(node, root) of all variants that have a link.  variants: vid, gid, n, live.

    A pair is verified unless its members are known to be in one component
    already.  The first rounds pair every group with a few others, and every
    variant with one of such a group and a few of its own, which joins up large
    groups of copies at a cost that follows the number of variants; the last
    takes every pair of groups that passes the filter and of its variants every
    pair that is still apart, so none is left out.
    """
    size = stored(lists.groupBy("list").agg(F.count("*").alias("c")), "list-sizes")
    longest = F.max_by(F.struct("list", "n", "spot"), F.struct("c", "list")).alias("m")
    home = stored(lists.join(size.hint("merge"), "list").groupBy("gid").agg(longest).select("gid", "m.*"), "longest-lists")
    many = stored(variants.groupBy("gid").agg(F.count("*").alias("c")).where("c > 1").select("gid"), "groups")
    sets = variants.select("vid", "n", "live")
    roots = tested = None
    for step in range(len(CENTRES) + 1):
        named = variants.select("vid", "gid", F.col("vid").alias("root"))
        if roots is not None:
            found = roots.select(F.col("node").alias("vid"), "root").hint("merge")
            named = stored(variants.select("vid", "gid").join(found, "vid", "left").withColumn("root", F.coalesce("root", "vid")), "variant-roots")
        member = F.struct("vid", "root")
        one = named.select(F.col("gid").alias("ga"), member.alias("a"))
        own = named.join(many.hint("merge"), "gid", "left_semi")
        if step < len(CENTRES):
            rank = F.xxhash64("vid", F.lit(step))
            # stored, so that a join with them is of two plain shuffles, which can be split where a centre is met often
            first = stored(named.groupBy(F.col("gid").alias("gb")).agg(F.min_by(member, rank).alias("b")), "first-variants")
            cross = _some_group_pairs(lists, home, step, percent).join(one.hint("merge"), "ga").join(first.hint("merge"), "gb")
            few = stored(own.groupBy("gid", F.pmod(rank, F.lit(CENTRES[step])).alias("part")).agg(F.min_by(member, rank).alias("b")).select("gid", "b"), "few-variants")
            inside = own.select("gid", member.alias("a")).join(few.hint("merge"), "gid")
        else:
            spans = stored(named.groupBy("gid").agg(F.min("root").alias("low"), F.max("root").alias("high")), "group-components")
            two = named.select(F.col("gid").alias("gb"), member.alias("b"))
            apart = stored(_open_group_pairs(lists, spans, percent), "group-pairs")
            cross = apart.join(one.hint("merge"), "ga").join(two.hint("merge"), "gb")
            split = own.join(spans.where("low <> high").select("gid").hint("merge"), "gid", "left_semi").select("gid", member.alias("a"))
            inside = split.join(split.withColumnRenamed("a", "b").hint("merge"), "gid").where("a.vid < b.vid")
        met = cross.select("a", "b").unionByName(inside.select("a", "b")).where("a.root <> b.root")
        pairs = met.select(F.least("a.vid", "b.vid").alias("a"), F.greatest("a.vid", "b.vid").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested.hint("merge"), ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = verified(pairs, sets, percent)
        if roots is not None:
            found = found.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        roots = components(found)
    return roots


def classes(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every document.

    component_id is the smallest doc_id that links reach, its own included.
    A null or empty text, or one without words, has no shingles and no links.
    Repeated rows give repeated rows, and rows of one doc_id count as one
    document; a row without doc_id has no class of its own but takes part in
    that of equal texts.  Sets are compared by 64-bit hashes of the shingles.
    """
    whole = stored(with_prefixes(keyed_text(docs), width, percent), "prefixes")
    sized = whole.where(F.size("prefix") > 0)
    alike = sized.groupBy("n", "g", "d1", "d2").agg(F.min("doc_id").alias("vid"), F.first("prefix").alias("prefix"), F.first("spots").alias("spots"), F.first("live").alias("live"))
    variants = stored(alike.where(F.col("vid").isNotNull()).withColumn("gid", F.xxhash64("n", "g")), "variants")
    lists = stored(_group_lists(variants), "lists")
    roots = _links(lists, variants.select("vid", "gid", "n", "live"), percent)
    named = variants.join(roots.hint("merge"), F.col("vid") == F.col("node"), "left").select("n", "d1", "d2", F.coalesce("root", "vid").alias("component_id"))
    rows = whole.select("doc_id", "n", "d1", "d2").join(named.hint("merge"), ["n", "d1", "d2"], "left")
    own = F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those that link, directly or not, to one of
    smaller doc_id; of repeated rows with one doc_id and text, one.  Different
    texts of one doc_id that link to no smaller one all stay.

    All columns pass as they are.  Rows without a doc_id stay.
    """
    found = classes(docs, width, percent)
    gone = stored(found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct(), "copies")
    kept = docs.join(gone, docs["doc_id"].cast("long") == gone["gone"], "left_anti")
    again = stored(kept.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("again")), "repeated")
    if again.isEmpty():
        return kept
    single = kept.join(again, kept["doc_id"] == again["again"], "left_anti")
    return single.unionByName(kept.join(again, kept["doc_id"] == again["again"], "left_semi").dropDuplicates(["doc_id", "text"]))
