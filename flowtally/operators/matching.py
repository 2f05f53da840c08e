"""Names that meet nothing in a dimension, with proposals ranked by likeness.

Names are compared in a folded form: accents off, small letters, everything but letters and
digits a blank. Their likeness is the Dice coefficient of their sets of character trigrams,
2 * shared / (all of one + all of the other); equal likeness goes by edit distance.

Only distinct names are compared, and only those that can be alike: trigrams are sorted from
rare to common, and two sets whose likeness reaches the threshold share one among the first
few of each, so a pair meets on a rare trigram, never on one that all names have. Nothing is
lost by that. Edit distances are worked out for the pairs that are left.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import as_col
from ..session import staged
from .columns import quoted
from .joins import join_on

GRAM = 3
LEAST = 0.5
MOST = 3


def _accents() -> tuple[str, str]:
    """Latin letters with marks, and the same letters without."""
    marked, bare = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = "".join(c for c in unicodedata.normalize("NFD", chr(code)) if not unicodedata.combining(c))
        if len(base) == 1 and base != chr(code) and base.isascii():
            marked.append(chr(code))
            bare.append(base)
    return "".join(marked) + "ØøĐđŁłĦħı", "".join(bare) + "OoDdLlHhi"


_MARKED, _BARE = _accents()
_DOUBLE = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "TH"}


def folded(c: Column | str) -> Column:
    """A name without accents, case, punctuation and superfluous blanks."""
    text = F.translate(as_col(c), _MARKED, _BARE)
    for sign, letters in _DOUBLE.items():
        text = F.replace(text, F.lit(sign), F.lit(letters))
    text = F.regexp_replace(F.lower(text), r"\p{M}+", "")
    return F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))


def grams(c: Column, size: int = GRAM) -> Column:
    """Distinct character n-grams of a text between two blanks; none of an empty one."""
    padded = F.concat(F.lit(" "), c, F.lit(" "))
    cut = F.transform(F.sequence(F.lit(1), F.length(padded) - (size - 1)), lambda k: F.substring(padded, k, F.lit(size)))
    return F.when((c != "") & (F.length(padded) >= size), F.array_distinct(cut)).otherwise(F.array().cast("array<string>"))


def _first_grams(names: DataFrame, frequency: DataFrame, least: float) -> DataFrame:
    """name, gram: the rarest trigrams of each name, as many as any pair that is alike enough must share one of."""
    spread = names.select("name", F.size("grams").alias("size"), F.explode("grams").alias("gram")).join(frequency, "gram")
    rare = Window.partitionBy("name").orderBy("times", "gram")  # at most a name's length in rows
    needed = F.col("size") - F.ceil(F.col("size") * (least / (2 - least)) - 1e-9) + 1
    return spread.withColumn("at", F.row_number().over(rare)).where(F.col("at") <= needed).select("name", "gram")


def alike_names(left: DataFrame, right: DataFrame, least: float = LEAST) -> DataFrame:
    """name, proposal, likeness, distance: all pairs of a left and a right name alike enough.

    Both tables have distinct names in a column `name`; `least` is above 0.
    """
    left, right = (staged(t.select("name", folded("name").alias("folded")).withColumn("grams", grams(F.col("folded"))), "names") for t in (left, right))
    both = left.select("grams").union(right.select("grams"))
    frequency = staged(both.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("times")), "grams")
    a = _first_grams(left, frequency, least)
    b = _first_grams(right, frequency, least).withColumnRenamed("name", "proposal")
    pairs = a.join(b, "gram").select("name", "proposal").distinct()
    pairs = join_on(pairs, left.withColumnsRenamed({"folded": "f1", "grams": "g1"}), "name", null_safe=False)
    pairs = join_on(pairs, right.withColumnsRenamed({"name": "proposal", "folded": "f2", "grams": "g2"}), "proposal", null_safe=False)
    likeness = 2.0 * F.size(F.array_intersect("g1", "g2")) / (F.size("g1") + F.size("g2"))
    pairs = pairs.withColumn("likeness", likeness).where(F.col("likeness") >= least)
    return pairs.select("name", "proposal", "likeness", F.levenshtein("f1", "f2").alias("distance"))


def unmatched_names(
    df: DataFrame, key: str, dimension: DataFrame, dim_key: str, least: float = LEAST, most: int = MOST
) -> DataFrame:
    """name, n_rows, rank, proposal, likeness, distance: names of `df` that the dimension lacks.

    Each with its number of rows and its best proposals from the dimension, `most` of them;
    a name without any has one row with NULL proposals. Missing names are no names.
    """
    counted = df.where(quoted(key).isNotNull()).groupBy(quoted(key).alias("name")).agg(F.count(F.lit(1)).alias("n_rows"))
    known = dimension.where(quoted(dim_key).isNotNull()).select(quoted(dim_key).alias("name")).distinct()
    missing = staged(join_on(counted, known, "name", "left_anti", null_safe=False), "unmatched")
    best = Window.partitionBy("name").orderBy(F.desc("likeness"), "distance", "proposal")
    ranked = alike_names(missing, known, least).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)
    out = join_on(missing, ranked, "name", null_safe=False)
    return out.select("name", "n_rows", "rank", "proposal", "likeness", "distance")
