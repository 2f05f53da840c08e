"""URL filter: rules first, then the likelihood ratio of two character language models.

Rules name a host (and all below it) and a path prefix; the longest fitting rule decides.
Other URLs are judged by two smoothed variable-order Markov models over their characters,
one for accepted and one for rejected URLs. Models read whole URLs, with scheme, query and
fragment. Both learn from the URLs that the rules decide.
A model interpolates all contexts of up to `order` characters: each has the weight that
its continuations earn (n over n + distinct continuations), and hands the rest to the
context without its first character, down to a uniform base; contexts it has not met hand
on all. A URL's score is the difference of the two log likelihoods over its length. The
threshold is calibrated on a fifth of the labelled URLs, which the models have not seen: it
is the score that gives the best mean of both classes' recalls, and 0 where a class is
missing. All of it is native: no Python runs in the tasks.

Windows of characters that URLs share are counted before any shuffle, and all work on
models is by distinct windows. Back at the URLs, windows are dealt with a salt, so the
windows that every URL has do not meet in one task.

Defined results: a NULL URL or one without `://` has an empty host and path and fits no
rule; a NULL one has the model score of an empty text; repeated rows each give a row; an
empty table gives an empty one; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtally.session import staged

from .common import column

ORDER = 4
ALPHABET = 128  # characters of the uniform base
SALTS = 16
STEP = 0.01
REACH = 10.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host behind the first ://, and the path up to ? or #; empty without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def fitting(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """Struct (rule, allow) of the longest fitting rule; among equally long ones the last in order. NULL without one."""
    chosen = F.lit(None).cast("struct<rule:string,allow:boolean>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        inside = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        chosen = F.when(inside, F.struct(F.lit(r.text).alias("rule"), F.lit(r.allow).alias("allow"))).otherwise(chosen)
    return chosen


def with_windows(rows: DataFrame, order: int) -> DataFrame:
    """A row per run of order + 1 characters of `text` between boundary marks, as `window`.

    The characters are an array column of their own, so a long text costs no more per run;
    an outer generator keeps Spark from repeating the expression in a filter.
    """
    marked = F.concat(F.lit("\x02" * order), F.col("text"), F.lit("\x03"))
    rows = rows.withColumn("__chars", F.split(marked, ""))
    starts = F.sequence(F.lit(0), F.size("__chars") - order - 1)
    run = [lambda i, j=j: F.get("__chars", i + j) for j in range(order + 1)]
    return rows.withColumn("window", F.explode_outer(F.transform(starts, lambda i: F.concat(*[at(i) for at in run])))).drop("__chars")


def window_scores(windows: DataFrame, order: int) -> DataFrame:
    """(window, ratio): log of accepted over rejected probability of a window's last character.

    windows: distinct `window` with `yes` and `no`, its counts in accepted and rejected URLs.
    """
    levels = F.explode(F.sequence(F.lit(1), F.lit(order + 1))).alias("length")
    each = windows.select("window", "yes", "no", levels)
    each = each.select("window", "length", "yes", "no", F.substring("window", F.lit(order + 2) - F.col("length"), F.col("length")).alias("gram"))
    grams = each.groupBy("length", "gram").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    context = Window.partitionBy("length", F.substring("gram", F.lit(1), F.col("length") - 1))
    parts = {}
    for side in ("yes", "no"):
        total, kinds = F.sum(side).over(context), F.count_if(F.col(side) > 0).over(context)
        parts[f"{side}_own"] = F.when(total > 0, F.col(side) / (total + kinds)).otherwise(0.0)
        parts[f"{side}_back"] = F.when(total > 0, kinds / (total + kinds)).otherwise(1.0)
    table = grams.select("length", "gram", *[c.alias(n) for n, c in parts.items()])
    found = each.select("window", F.col("length").alias("l"), F.col("gram").alias("g")).join(
        table, (F.col("l") == F.col("length")) & (F.col("g") == F.col("gram"))
    )
    steps = found.groupBy("window").agg(F.sort_array(F.collect_list(F.struct("length", *parts))).alias("steps"))

    def probability(side: str) -> Column:
        return F.aggregate("steps", F.lit(1.0 / ALPHABET), lambda p, s: s[f"{side}_own"] + s[f"{side}_back"] * p)

    return steps.select("window", (F.ln(probability("yes")) - F.ln(probability("no"))).alias("ratio"))


def threshold(scored: DataFrame) -> float:
    """The score that separates `allow` best; one row per score step leaves the tasks."""
    step = F.round(F.greatest(F.least("score", F.lit(REACH)), F.lit(-REACH)) / STEP).cast("int")
    counts = scored.groupBy(step.alias("step")).agg(F.count_if("allow").alias("yes"), F.count_if(~F.col("allow")).alias("no"))
    below = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)  # at most 2 * REACH / STEP + 1 rows
    whole = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    recall = (F.sum("yes").over(whole) - F.coalesce(F.sum("yes").over(below), F.lit(0))) / F.sum("yes").over(whole)
    reject = F.coalesce(F.sum("no").over(below), F.lit(0)) / F.sum("no").over(whole)
    complete = (F.sum("yes").over(whole) > 0) & (F.sum("no").over(whole) > 0)
    rated = counts.select("step", F.when(complete, F.round(recall + reject, 12)).alias("rate")).where("rate IS NOT NULL")
    best = rated.orderBy(F.desc("rate"), F.abs("step"), "step").limit(1).collect()
    return (best[0]["step"] - 0.5) * STEP if best else 0.0


def judged(
    pages: DataFrame,
    rules: Sequence[Rule],
    id_column: str = "page_id",
    url_column: str = "url",
    order: int = ORDER,
    salts: int = SALTS,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score (log ratio per character)."""
    host, path = host_and_path(column(url_column))
    text = F.translate(F.coalesce(column(url_column), F.lit("")), "123456789", "000000000")
    rows = pages.select(column(id_column).cast("long").alias("page_id"), host.alias("host"), path.alias("path"), text.alias("text"))
    rows = rows.withColumn("fit", fitting(rules, F.col("host"), F.col("path")))
    # equal texts are judged once; a fifth of the labelled ones calibrates
    texts = rows.groupBy("text").agg(F.max("fit.allow").alias("allow"), F.count(F.lit(1)).alias("n"))
    drawn = F.conv(F.substring(F.md5("text"), 1, 7), 16, 10).cast("long")
    texts = staged(texts.withColumn("held", drawn % 5 == 0), "urls")

    each = with_windows(texts, order).select("n", "allow", "held", "window")
    learn = F.col("allow").isNotNull() & ~F.col("held")
    counted = each.groupBy("window").agg(
        F.sum(F.when(learn & F.col("allow"), F.col("n")).otherwise(0)).alias("yes"),
        F.sum(F.when(learn & ~F.col("allow"), F.col("n")).otherwise(0)).alias("no"),
    )
    ratios = window_scores(staged(counted, "windows"), order)
    salted = ratios.select("window", "ratio", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    asked = with_windows(texts.select("text"), order).select("text", F.col("window").alias("w"), F.pmod(F.xxhash64("text"), F.lit(salts)).cast("int").alias("s"))
    summed = asked.join(salted, (F.col("w") == F.col("window")) & (F.col("s") == F.col("salt"))).groupBy("text").agg(
        (F.sum("ratio") / F.count(F.lit(1))).alias("score")
    )
    scored = staged(summed.join(texts, "text").select("text", "score", "allow", "held"), "url-scores")
    limit = threshold(scored.where("held AND allow IS NOT NULL").select("score", "allow"))
    verdicts = scored.select(F.col("text").alias("t"), "score", (F.col("score") >= limit).alias("good"))
    return rows.join(verdicts, F.col("text") == F.col("t")).select(
        "page_id",
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.when(F.coalesce("fit.allow", "good"), "allow").otherwise("block").alias("verdict"),
        "score",
    )
