"""Conflicts between instruments.

Bounds on one rate are intervals: a category's rules of both instruments agree
if and only if the largest lower bound lies below the smallest upper one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import percent
from ..plans.storage import kept


def closure(categories: DataFrame) -> DataFrame:
    """(id, ancestor, depth): every category with itself and what it is under.

    Parents that aren't categories end a chain; a cycle ends where it closes.
    Each round doubles the reach, so there are as many as the logarithm of the
    deepest chain.
    """
    parent = categories.select("id", F.col("parent").alias("ancestor")).where(F.col("parent").isNotNull())
    step = kept(parent.join(categories.select(F.col("id").alias("ancestor")).distinct(), "ancestor", "left_semi").select("id", "ancestor").distinct())
    out = kept(categories.select("id", F.col("id").alias("ancestor"), F.lit(0).alias("depth")).distinct())
    n, reach = out.count(), 1
    while True:
        # what lies beyond the ancestor that is ``reach`` steps up
        beyond = step.withColumnRenamed("ancestor", "via").join(out.withColumnRenamed("id", "via"), "via").select("id", "ancestor", (F.col("depth") + reach).alias("depth"))
        out = kept(out.unionByName(beyond).groupBy("id", "ancestor").agg(F.min("depth").alias("depth")))
        more = out.count()
        if more == n:
            return out
        step = kept(step.withColumnRenamed("ancestor", "via").join(step.withColumnRenamed("id", "via"), "via").select("id", "ancestor").distinct())
        n, reach = more, 2 * reach


#: Parts that the categories which an instrument's residual rules reach are dealt into.
_SALTS = 32


def applicable(wanted: DataFrame, norms: DataFrame, ancestors: DataFrame, instruments: list[str]) -> DataFrame:
    """(category, instrument, norm, via_residual): the rate rules that hold.

    wanted: category; norms: instrument, norm, norm_type, applies_to (array),
    is_residual; instruments: those that are asked for.  Residual rules hold
    only where no rule names the category or one of its ancestors; they are
    joined to the categories of an instrument part by part.
    """
    rates = norms.where((F.col("norm_type") == "rate_constraint") & F.col("instrument").isin(*instruments))
    named = rates.where(~((F.size("applies_to") == 1) & (F.col("applies_to")[0] == "*"))).select("instrument", "norm", F.explode("applies_to").alias("ancestor")).distinct()
    direct = wanted.join(ancestors.withColumnRenamed("id", "category"), "category").join(named, "ancestor").select("category", "instrument", "norm").distinct()
    asked = wanted.select("category", F.explode(F.array(*map(F.lit, instruments))).alias("instrument"))
    open_ = asked.join(direct.select("category", "instrument").distinct(), ["category", "instrument"], "left_anti").withColumn("salt", F.pmod(F.hash("category"), F.lit(_SALTS)))
    rest = rates.where(F.coalesce("is_residual", F.lit(False))).select("instrument", "norm", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    residual = open_.join(rest, ["instrument", "salt"]).select("category", "instrument", "norm")
    return direct.withColumn("via_residual", F.lit(False)).unionByName(residual.withColumn("via_residual", F.lit(True)))


def interval(bounds: DataFrame, keys: list[str]) -> DataFrame:
    """keys, low, low_open, high, high_open, low_norm, high_norm, sat, witness.

    bounds: keys, norm, ord, op, value.  Every rate also lies between 0 and 1.
    Of equal bounds the open one counts, then the one of smallest ord.
    """
    lower, upper = F.col("op").isin(">", ">=", "=="), F.col("op").isin("<", "<=", "==")
    low = F.min_by(F.struct("value", (F.col("op") == ">").alias("open"), "norm"), F.when(lower, F.struct(-F.col("value"), F.col("op") != ">", "ord")))
    high = F.min_by(F.struct("value", (F.col("op") == "<").alias("open"), "norm"), F.when(upper, F.struct(F.col("value"), F.col("op") != "<", "ord")))
    each = bounds.groupBy(*keys).agg(low.alias("l"), high.alias("h"))
    below, above = F.coalesce(F.col("l.value") >= 0, F.lit(False)), F.coalesce(F.col("h.value") <= 1, F.lit(False))
    got = each.select(
        *keys,
        F.when(below, F.col("l.value")).otherwise(0.0).alias("low"), F.when(below, F.col("l.open")).otherwise(False).alias("low_open"), F.when(below, F.col("l.norm")).alias("low_norm"),
        F.when(above, F.col("h.value")).otherwise(1.0).alias("high"), F.when(above, F.col("h.open")).otherwise(False).alias("high_open"), F.when(above, F.col("h.norm")).alias("high_norm"),
    )
    sat = (F.col("low") < F.col("high")) | ((F.col("low") == F.col("high")) & ~F.col("low_open") & ~F.col("high_open"))
    witness = F.when(F.col("low_open"), (F.col("low") + F.col("high")) / 2).otherwise(F.col("low"))
    return got.withColumn("sat", sat).withColumn("witness", F.when(sat, witness))


def verdicts(norms: DataFrame, bounds: DataFrame, categories: DataFrame, open_terms: DataFrame, higher: str, lower: str) -> DataFrame:
    """One row for each category that the lower instrument names.

    (category, label, verdict, low, high, witness, core, resolution,
    authorised_by, national_via_residual, abstained_on, caveat).  CONFLICT with the
    clashing rules, COMPLIANT with a rate that satisfies all, ABSTAIN where an
    open-textured rule of the lower instrument reaches a category that it does
    not name, NO_PAIR where an instrument has no rule.  Where such a rule names
    the category, its terms are a caveat only.
    """
    own = norms.where(F.col("instrument") == lower)
    wanted = own.where(F.col("norm_type") == "rate_constraint").select(F.explode("applies_to").alias("category")).where("category <> '*'").distinct()
    rules = applicable(wanted, norms, closure(categories), [higher, lower])
    sides = wanted.join(rules, "category", "left").groupBy("category").agg(
        F.count_if(F.col("instrument") == higher).alias("n_high"), F.count_if(F.col("instrument") == lower).alias("n_low"),
        F.bool_or((F.col("instrument") == higher) & F.col("via_residual")).alias("national_via_residual"),
        F.collect_set(F.when(F.col("instrument") == higher, F.col("norm"))).alias("national"),
    )
    held = interval(rules.select("category", "norm").join(bounds, "norm"), ["category"])
    rank = norms.select("norm", "rank")
    low, high = (rank.select(F.col("norm").alias(f"{x}_norm"), F.col("rank").alias(f"{x}_rank")) for x in ("low", "high"))
    out = sides.join(held, "category", "left").join(low, "low_norm", "left").join(high, "high_norm", "left")
    delegations = norms.where(F.col("norm_type") == "delegation").select(F.col("norm").alias("by"), "ord", F.explode("delegated_scope").alias("norm"))
    allowed = rules.where(F.col("instrument") == higher).join(delegations, "norm").groupBy("category").agg(F.min_by("by", "ord").alias("by"))
    vague = rules.where(F.col("instrument") == lower).join(own.select("norm", "applies_to", F.explode("open_textured_terms").alias("term")), "norm").join(open_terms.select(F.col("id").alias("term")), "term", "left_semi")
    names = F.array_contains("applies_to", F.col("category"))
    terms = lambda test: F.nullif(F.array_sort(F.collect_set(F.when(test, F.col("term")))), F.array().cast("array<string>"))
    tail = vague.groupBy("category").agg(terms(~names).alias("abstained_on"), terms(names).alias("named_with"))
    out = out.join(allowed, "category", "left").join(tail, "category", "left").join(categories.select(F.col("id").alias("category"), "label"), "category", "left")
    none = (F.col("n_high") == 0) | (F.col("n_low") == 0)
    verdict = F.when(none, "NO_PAIR").when(F.col("abstained_on").isNotNull(), "ABSTAIN").when(F.col("sat"), "COMPLIANT").otherwise("CONFLICT")
    clash = ~none & ~F.col("sat")
    core = F.when(clash, F.array_compact(F.array("low_norm", "high_norm")))
    return out.select(
        "category", "label", verdict.alias("verdict"), "low", "high", F.when(~none, F.col("witness")).alias("witness"), core.alias("core"),
        F.when(clash & (F.col("low_rank") != F.col("high_rank")), "lex_superior").alias("resolution"), F.when(F.col("sat") & ~none, F.col("by")).alias("authorised_by"),
        F.coalesce("national_via_residual", F.lit(False)).alias("national_via_residual"), "abstained_on", F.when(F.col("abstained_on").isNull(), F.col("named_with")).alias("caveat"),
    )


def tally(found: DataFrame, open_terms: DataFrame) -> DataFrame:
    """(verdict, n); every open-textured term is one more abstention."""
    gaps = open_terms.select(F.lit("ABSTAIN").alias("verdict"))
    return found.select("verdict").unionByName(gaps).groupBy("verdict").agg(F.count("*").alias("n"))


def outliers(rates: DataFrame, least: int = 3) -> DataFrame:
    """(provision, instrument, value, usual, n): instruments whose value differs
    from the one most others have for the same provision."""
    n = rates.groupBy("provision", "value").agg(F.count("*").alias("k"))
    usual = n.groupBy("provision").agg(F.min_by("value", F.struct(-F.col("k"), "value")).alias("usual"), F.sum("k").alias("n")).where(F.col("n") >= least)
    return rates.join(usual, "provision").where(F.col("value") != F.col("usual")).select("provision", "instrument", "value", "usual", "n")


def core_lines(found: DataFrame, norms: DataFrame, bounds: DataFrame) -> DataFrame:
    """(category, norm, line, rank): the clashing rules of each conflict, as a
    report words them.  norms: norm, title, citation, rank."""
    each = found.where("verdict = 'CONFLICT'").select("category", F.explode("core").alias("norm")).distinct()
    said = F.concat_ws(" ", F.substring_index("title", " tentang", 1), "citation", F.lit("tarif"), "op", percent(F.col("value")))
    return each.join(norms.select("norm", "title", "citation", "rank"), "norm").join(bounds.select("norm", "op", "value"), "norm").select("category", "norm", said.alias("line"), "rank")
