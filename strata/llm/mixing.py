"""Temperature mixing of sources to a token budget, in DataFrame operations only.

Source token shares p are raised to an exponent a and normalised: w ~ p**a. The exponent is
bisected until the entropy of w meets a target, or until the most repeated source is repeated
no more than a limit. The weights are then realised as a token budget: each source gets
``weight * budget`` tokens, as whole passes over its documents and a last, partial pass. Every
pass is a permutation of blocks of documents and of the documents in each block by keyed
hashes. The cut of the partial pass is found from sums per block, and exactly within one
block, so that no source meets in one task, and texts are never shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, stored

#: Blocks of documents per source and pass.
BLOCKS = 4096


def n_words(c: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


@dataclass
class Mix:
    """The exponent that was found, and per source: tokens, weight, full passes and the key
    (block, order) up to which the last pass goes."""

    exponent: float
    sources: DataFrame


def _measure(sources: DataFrame, budget: float, exponents: list[float]) -> list[tuple[float, float]]:
    """(entropy of the weights in nats, most repetitions of a source) at each exponent; one
    aggregate over the table of sources, which stays distributed."""
    total = sources.agg(F.sum("tokens").cast("double")).first()[0]
    out = []
    for a in exponents:
        x = F.pow(F.col("tokens") / F.lit(total), F.lit(a))
        out += [F.sum(x), F.sum(x * F.log(x)), F.max(x / F.col("tokens"))]
    row = sources.agg(*[c.alias(f"c{i}") for i, c in enumerate(out)]).first()
    res = []
    for i in range(len(exponents)):
        z, xlogx, rep = row[3 * i : 3 * i + 3]
        res.append((math.log(z) - xlogx / z, budget * rep / z))
    return res


def find_exponent(
    sources: DataFrame, budget: float, target_entropy: float | None, max_repeats: float, steps: int = 24
) -> float:
    """The largest exponent in [0, 1] whose weights reach ``target_entropy`` (a fraction of
    the highest possible, log of the number of sources) while no source is repeated more than
    ``max_repeats`` times; where the two conflict, the limit wins. Entropy and repetition fall as
    the exponent grows, whatever the budget, so both bounds are bisected; 15 points a job make
    four bisections in one pass over the sources. At an exponent of 1 every source is repeated
    ``budget`` / corpus times, the least that can be; ``plan_mix`` refuses budgets beyond it."""
    n = sources.count()
    if n < 2:
        return 1.0

    def bisect(good_low):
        lo, hi = 0.0, 1.0
        for _ in range(steps // 4):
            xs = [lo + (hi - lo) * i / 16 for i in range(1, 16)]
            ok = [good_low(m) for m in _measure(sources, budget, xs)]
            k = next((i for i, o in enumerate(ok) if not o), 15)  # the first point that fails
            lo, hi = ([lo, *xs][k], [*xs, hi][k])
        return lo, hi

    best = 1.0
    if target_entropy is not None:
        goal = target_entropy * math.log(n)
        if _measure(sources, budget, [1.0])[0][0] < goal:
            best = bisect(lambda m: m[0] >= goal)[0]
    if _measure(sources, budget, [best])[0][1] > max_repeats:
        best = max(best, bisect(lambda m: m[1] > max_repeats)[1])  # repeats fall with the exponent
    return best


def plan_mix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    budget: int | None = None,
    target_entropy: float | None = 0.9,
    max_repeats: float = 4.0,
    seed: int = 17,
) -> Mix:
    """Weights of all sources and where their passes end. ``budget``: tokens (words) of the
    mixture, by default as many as the corpus has; one that no mixture can fill without
    repeating some source more than ``max_repeats`` times is an error (ValueError). An empty
    corpus fills none and gives no rows."""
    rows = stored(df.select(*[c.alias(k) for k, c in _columns(df, id_col, text_col, source_col, seed).items()]), "mix-rows")
    blocks = stored(rows.groupBy("source", "block").agg(F.sum("tokens").alias("tokens")), "mix-blocks")
    sources = stored(blocks.groupBy("source").agg(F.sum("tokens").alias("tokens")).filter("tokens > 0"), "mix-sources")
    total = sources.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    budget = total if budget is None else budget
    if total and budget > max_repeats * total:
        raise ValueError(f"a budget of {budget} tokens repeats a corpus of {total} more than {max_repeats:g} times")
    total = max(total, 1)
    a = find_exponent(sources, float(budget), target_entropy, max_repeats)
    z = sources.agg(F.sum(F.pow(F.col("tokens") / F.lit(float(total)), F.lit(a)))).first()[0] or 1.0
    weight = F.pow(F.col("tokens") / F.lit(float(total)), F.lit(a)) / F.lit(z)
    s = sources.withColumn("weight", weight).withColumn("quota", F.col("weight") * F.lit(float(budget)))
    # The share of a source is a whole number of passes and a rest, to a token.
    s = s.withColumn("passes", F.floor(F.col("quota") / F.col("tokens") + F.lit(1e-9)))
    s = s.withColumn("rest", F.greatest(F.lit(0.0), F.col("quota") - F.col("passes") * F.col("tokens")))
    s = stored(s, "mix-weights")
    # The block in which the last pass ends, from sums per block ...
    run = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = blocks.join(s.select(F.col("source").alias("s_source"), "rest"), F.col("source").eqNullSafe(F.col("s_source"))).drop("s_source")
    ahead = ahead.withColumn("before", F.coalesce(F.sum("tokens").over(run), F.lit(0)))
    cut = ahead.filter((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("tokens") > F.col("rest")))
    cut = cut.select(F.col("source").alias("c_source"), F.col("block").alias("cut_block"), F.col("rest") - F.col("before"))
    cut = stored(cut.toDF("c_source", "cut_block", "room"), "mix-cut")
    # ... and the last document of it that still fits.
    inside = Window.partitionBy("source").orderBy("order").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = rows.join(cut, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("block") == F.col("cut_block")))
    last = last.withColumn("upto", F.sum("tokens").over(inside)).filter(F.col("upto") <= F.col("room"))
    last = last.groupBy("source").agg(F.max("order").alias("cut_order")).withColumnRenamed("source", "l_source")
    s = s.join(cut.drop("room"), F.col("source").eqNullSafe(F.col("c_source")), "left").drop("c_source")
    s = s.join(last, F.col("source").eqNullSafe(F.col("l_source")), "left").drop("l_source")
    least = F.lit(-(1 << 63)).cast("long")
    s = s.select("source", "tokens", "weight", "quota", "passes", F.coalesce("cut_block", F.lit(BLOCKS)).alias("cut_block"), F.coalesce("cut_order", least).alias("cut_order"))
    # A rest of no tokens ends before the first block.
    s = s.withColumn("cut_block", F.when(F.col("quota") - F.col("passes") * F.col("tokens") < 0.5, F.lit(-1)).otherwise(F.col("cut_block")))
    return Mix(a, stored(s, "mix-plan"))


def _columns(df: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> dict[str, Column]:
    """Source, tokens, and block and order in the partial pass's permutation, of each row."""
    key = F.xxhash64(F.lit(seed), F.coalesce(df[id_col].cast("string"), F.lit("-")), F.coalesce(df[text_col], F.lit("")))
    return {
        "source": df[source_col],
        "tokens": n_words(df[text_col]),
        "block": F.pmod(F.shiftright(key, 40), F.lit(BLOCKS)).cast("long"),
        "order": F.xxhash64(key, F.lit(1)),
    }


#: Columns that ``mix`` adds.
MADE = ("mix_pass", "mix_block", "mix_order", "mix_tokens", "mix_weight")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, **how) -> DataFrame:
    """All columns of ``df``, a row for each copy that the mixture holds, and ``mix_pass``
    (0: first copy), ``mix_block`` and ``mix_order`` (sort by pass, block, order for
    the mixture's order), ``mix_tokens`` and ``mix_weight`` (the source's).

    A null source is a source of its own. Rows without words are kept once and cost nothing.
    Rows that are equal in id and text stand or fall together in the partial pass. An empty
    table gives no rows. A column of ``df`` that bears one of the new names is replaced.
    """
    df = df.drop(*[c for c in MADE if c not in (id_col, text_col, source_col)])
    plan = plan_mix(df, id_col, text_col, source_col, seed=seed, **how)
    own = _columns(df, id_col, text_col, source_col, seed)
    d = df.select(F.struct(*[df[c] for c in df.columns]).alias("__row"), *[c.alias(f"__{k}") for k, c in own.items()])
    p = plan.sources.select(F.col("source").alias("__p"), F.col("weight").alias("__weight"), "passes", "cut_block", "cut_order")
    d = d.join(p, F.col("__source").eqNullSafe(F.col("__p")), "left")
    in_last = (F.col("__block") < F.col("cut_block")) | ((F.col("__block") == F.col("cut_block")) & (F.col("__order") <= F.col("cut_order")))
    copies = F.when(F.col("__tokens") == 0, F.lit(1)).otherwise(F.coalesce(F.col("passes") + in_last.cast("long"), F.lit(0)))
    d = d.withColumn("__copies", copies.cast("int")).filter("__copies > 0")
    d = d.withColumn("__pass", F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)))
    again = F.xxhash64(F.col("__order"), F.col("__pass"))  # whole passes are permuted anew
    is_last = F.col("__pass") == F.coalesce(F.col("passes"), F.lit(0))
    return d.select(
        "__row.*",
        F.col("__pass").alias("mix_pass"),
        F.when(is_last, F.col("__block")).otherwise(F.pmod(again, F.lit(BLOCKS))).cast("long").alias("mix_block"),
        F.when(is_last, F.col("__order")).otherwise(F.xxhash64(again)).alias("mix_order"),
        F.col("__tokens").alias("mix_tokens"),
        F.coalesce("__weight", F.lit(0.0)).alias("mix_weight"),
    )
