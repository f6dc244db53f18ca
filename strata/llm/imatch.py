"""I-Match document fingerprints, in DataFrame operations only.

A lexicon is chosen from the whole collection: terms whose document frequency lies in a band
of inverse document frequency. A document keeps its distinct terms of the lexicon, sorts them
and hashes those that fall in each of several randomised subsets of the lexicon; the list of
hashes is the fingerprint. Two documents are alike in so far as their hashes agree.

Terms are counted and looked up by their 64-bit hashes, so frequencies are those of single terms.
The lexicon is bounded: a term of it is in ``FEWEST`` of the documents at least, so it holds at
most (distinct terms a document, on average) / ``FEWEST`` terms, whatever the vocabulary. It enters
the plan as a constant array of small groups. Subsets come in levels: those of level l
divide a sample of 4**-l of the lexicon, so that both a short and a very long document have
subsets that hold about one of its terms; there, agreement estimates the share of common terms.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import SPACE, shuffle_partitions

LEVELS, CELLS = 6, 16
#: A term is in the lexicon if this share of the documents holds it: between the two. At most
#: (terms a document) / FEWEST terms can be: the list that comes to the driver is bounded.
FEWEST, MOST = 1e-3, 0.2
RANGE_BYTES = 64 << 20  # text of a range of ids


def terms(text: Column) -> Column:
    """Hashes of the distinct words of a text, lower case, without punctuation around them."""
    w = F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE)
    return F.array_distinct(F.transform(w, lambda x: F.xxhash64(F.btrim(x, F.lit(".,;:!?\"'()[]")))))


def lexicon(df: DataFrame, text_col: str = "text", fewest: float = FEWEST, most: float = MOST) -> list[list[int]]:
    """Hashes of the terms of the lexicon: group g holds those that leave g modulo the number of
    groups. Frequencies cover all rows of ``df``; a lexicon of an empty table is empty."""
    n = df.count()
    df_of = df.select(F.explode(terms(df[text_col])).alias("term")).groupBy("term").count()
    inside = df_of.filter((F.col("count") >= F.lit(fewest * n)) & (F.col("count") <= F.lit(max(1.0, most * n))))
    listed = [r[0] for r in inside.select("term").toLocalIterator()]
    groups: list[list[int]] = [[] for _ in range(max(1, len(listed)))]
    for h in listed:
        groups[h % len(groups)].append(h)
    return groups


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), use)[0]


def fingerprint(text: Column, lex: list[list[int]]) -> Column:
    """Array of ``LEVELS * CELLS`` hashes (0: the document has no term in the subset). A text
    without any term of the lexicon is hashed by all its terms, so equal texts always agree."""
    known = F.from_json(F.lit(json.dumps(lex, separators=(",", ":"))), "array<array<bigint>>")  # folded once

    def listed(h):
        return F.array_contains(F.get(known, F.pmod(h, F.lit(len(lex))).cast("int")), h)

    def chosen(found):
        return _let(F.filter(found, listed), lambda kept: F.when(F.size(kept) > 0, kept).otherwise(found))

    def subsets(some):
        return F.transform(
            F.sequence(F.lit(0), F.lit(CELLS - 1)),
            lambda c: _signature(F.filter(some, lambda h: F.pmod(F.shiftright(h, 24), F.lit(CELLS)) == c)),
        )

    def from_level(some, level):
        own = subsets(some)
        if level == LEVELS - 1:
            return own
        fewer = F.filter(some, lambda h: F.shiftright(h, 2 * level).bitwiseAND(3) == 0)
        return F.concat(own, _let(fewer, lambda x: from_level(x, level + 1)))

    rehashed = F.array_sort(F.transform(_let(terms(text), chosen), lambda h: F.xxhash64(h, F.lit(7))))
    return _let(rehashed, lambda x: from_level(x, 0))


def _signature(sorted_terms: Column) -> Column:
    return F.when(F.size(sorted_terms) > 0, F.xxhash64(sorted_terms)).otherwise(F.lit(0).cast("long"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among subsets in which either document has a term, from the
    first level on at which some subset is empty in both (all levels if there is none)."""

    def share(pairs):
        some = F.filter(pairs, lambda v: v >= 0)
        return _let(some, lambda x: F.when(F.size(x) > 0, F.size(F.filter(x, lambda v: v == 1)) / F.size(x)))

    def from_sparse(pairs):  # -1: empty in both, 1: equal, 0: not
        first = F.greatest(F.array_position(pairs, -1), F.lit(1))
        start = F.floor((first - 1) / CELLS) * CELLS + 1
        return F.coalesce(share(F.slice(pairs, start.cast("int"), F.lit(LEVELS * CELLS))), share(pairs), F.lit(1.0))

    empty = lambda x, y: (x == 0) & (y == 0)
    pairs = F.zip_with(a, b, lambda x, y: F.when(empty(x, y), F.lit(-1)).otherwise((x == y).cast("int")))
    return _let(pairs, from_sparse)


def as_text(fp: Column) -> Column:
    """Fingerprint as hex text, eight digits a subset."""
    return F.array_join(F.transform(fp, lambda h: F.lpad(F.lower(F.hex(h.bitwiseAND(0xFFFFFFFF))), 8, "0")), "")


def with_next(d: DataFrame, fp, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``d`` (doc_id, text) with ``fp``, a function of the text, and ``next_text`` and ``next_fp`` of
    the row that follows in order of id, then text; after the last comes the first. Rows are dealt
    into ranges of ids, as many as the texts' bytes ask for; only the first row of each range is
    moved besides."""
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, shuffle_partitions(d.sparkSession), math.ceil(size / range_bytes))
    bounds = None
    if parts > 1:
        bounds = d.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 100 * parts)).first()[0]
    cuts = F.array(*[F.lit(b).cast("long") for b in sorted(set(bounds or [0]))])
    d = d.withColumn("range", F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(F.size(F.filter(cuts, lambda b: b <= F.col("doc_id")))))
    order = Window.partitionBy("range").orderBy("doc_id", "text")
    dealt = d.withColumn("fp", fp(F.col("text"))).repartition(parts, "range")
    inside = dealt.withColumns({"own_next": F.lead("text").over(order), "own_next_fp": F.lead("fp").over(order)})
    heads = d.groupBy("range").agg(F.min(F.struct("doc_id", "text")).alias("head"))  # a row for each range
    heads = heads.select("range", F.struct("head.text", fp(F.col("head.text")).alias("fp")).alias("head"))
    everyone = Window.orderBy("range")
    first = F.first("head").over(everyone)
    follow = heads.select(F.col("range").alias("of_range"), F.coalesce(F.lead("head").over(everyone), first).alias("head"))
    out = inside.join(follow, F.col("range") == F.col("of_range"), "left")
    return out.select("doc_id", "text", "fp", F.coalesce("own_next", "head.text").alias("next_text"), F.coalesce("own_next_fp", "head.fp").alias("next_fp"))


def edited(text: Column, next_text: Column) -> Column:
    """The last quarter of the code points replaced by as many of the next text's first."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - quarter), F.substring(next_text, F.lit(1), quarter))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **band) -> DataFrame:
    """A row for each row of ``df``: its fingerprint, that of its edited text, and how alike
    they and the next document's are.

    A null text counts as empty; null ids come first in order; rows that are equal in id and
    text follow each other; other columns are ignored. An empty table gives no rows.
    """
    lex = lexicon(df, text_col, **band)
    d = df.select(df[id_col].alias("doc_id"), F.coalesce(df[text_col], F.lit("")).alias("text"))
    d = with_next(d, lambda text: fingerprint(text, lex))
    d = d.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    d = d.withColumn("edited_fp", fingerprint(F.col("edited"), lex))
    return d.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
