"""License notices in texts: MinHash bands retrieve templates, shingle containment verifies.

Texts and templates are lower-cased and cut into words of letters and digits; each run of
five words is a shingle. Windows overlap by half: for templates of n shingles (n rounded
up to a power of two, their size class) they are 2n shingles long and start every n, so any
passage as long as the template lies whole inside a window. A window keeps only shingles
that some template of its size class has: no others can help a match, and without them the
Jaccard likeness of a window and a template is the template's containment in the window,
also where a short notice is part of a long text.

A window's MinHash signature has bands of one value. A window that contains the share s of a
template's shingles, and nothing of other templates of the class, agrees in one band with
probability s; with 32 bands the chance to miss it at s = 0.8 is 0.2**32. Where it also
holds as many shingles of others, the chance at likeness 0.4 is 0.6**32, below 1e-7; in a
window that is full of them (likeness 0.19 at least) it is 0.81**32, about 1e-3.
A retrieved template is verified on the shingle texts themselves.

All of it is native: no Python runs in the tasks. Templates are a parameter and small by
nature; of a text only runs of words and hashes leave the scan, and only where it holds a
template's shingle. Rows are kept apart by a number of their own, not by their ids.

Defined results: a NULL or empty text, or one of less than five words, matches nothing;
rows with the same id, or without one, are documents of their own, and repeated rows give
repeated results; a template of less than five words is refused; an empty table, or no
template, gives an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column

WORDS = 5
BANDS = 32
LEAST = 0.8



def read_templates(path: str) -> dict[str, str]:
    """Templates of a text file: a line "== name" starts one, a line of "#" ahead of them is a remark."""
    out: dict[str, list[str]] = {}
    with open(path, encoding="utf-8") as file:
        for line in file.read().splitlines():
            if line.startswith("== "):
                lines = out.setdefault(line[3:].strip(), [])
            elif out:
                lines.append(line)
    return {name: " ".join(lines).strip() for name, lines in out.items()}


#: Texts of public licenses, their notices for files, and usual short notices.
TEMPLATES = read_templates(str(Path(__file__).with_name("license_texts.txt")))


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def with_shingles(rows: DataFrame, width: int, listed: list[int] | None = None) -> DataFrame:
    """One row per run of `width` of the `words`: `at` and `hash`, built from the words' hashes.

    With `listed`, only runs with these hashes. The word hashes are a column of their own and
    the rows come from an outer generator, so that Spark neither works them out once per run
    nor repeats the whole expression in a filter below; rows without a run are dropped after.
    """
    rows = rows.withColumn("__hashes", F.transform("words", lambda w: F.xxhash64(w)))
    places = F.when(F.size("words") >= width, F.sequence(F.lit(0), F.size("words") - width)).otherwise(F.array().cast("array<int>"))
    run = [lambda i, j=j: F.get("__hashes", i + j) for j in range(width)]
    found = F.transform(places, lambda i: F.struct(i.alias("at"), F.xxhash64(*[at(i) for at in run]).alias("hash")))
    if listed is not None:
        found = F.filter(found, lambda x: x["hash"].isin(listed)) if listed else F.filter(found, lambda x: F.lit(False))
    rows = rows.withColumn("__run", F.explode_outer(found)).where("__run.hash IS NOT NULL")
    return rows.select("*", F.col("__run.at").alias("at"), F.col("__run.hash").alias("hash")).drop("__hashes", "__run")


def _bands(hashes: Column, bands: int) -> Column:
    """(band, least value of its hash function) of a set of shingle hashes."""
    return F.array(
        *[
            F.struct(F.lit(b).alias("band"), F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(b)))).alias("least"))
            for b in range(bands)
        ]
    )


def template_shingles(spark: SparkSession, templates: Mapping[str, str], width: int = WORDS) -> DataFrame:
    """(template, hash, shingle, shingles, span): distinct shingles; span, the size class of windows."""
    rows = spark.createDataFrame(sorted(templates.items()), "template string, text string")
    cut = rows.select("template", words_of(F.col("text")).alias("words"))
    if short := [r["template"] for r in cut.where(F.size("words") < width).collect()]:
        raise ValueError(f"templates of less than {width} words: {short}")
    each = with_shingles(cut, width).select("template", "hash", F.array_join(F.slice("words", F.col("at") + 1, F.lit(width)), " ").alias("shingle")).distinct()
    sizes = each.groupBy("template").agg(F.count(F.lit(1)).alias("shingles"))
    span = F.pow(F.lit(2), F.ceil(F.log2("shingles"))).cast("int")
    return each.join(sizes.withColumn("span", span), "template")


def scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = WORDS,
    bands: int = BANDS,
    least: float = LEAST,
) -> DataFrame:
    """One row per document and template: doc_id, template, containment, first_word, last_word, windows.

    containment is the best over the document's windows; the words, counted from 0, are
    those of the earliest such window's matching shingles; windows counts the ones that
    reach `least`.
    """
    spark = docs.sparkSession
    known = template_shingles(spark, templates, width).collect() if templates else []  # the parameter itself
    listed = sorted({r["hash"] for r in known})
    schema = "template string, hash long, shingle string, shingles long, span int"
    fixed = spark.createDataFrame([(r["template"], r["hash"], r["shingle"], r["shingles"], r["span"]) for r in known], schema)

    # shingles of the texts that some template has
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), column(id_column).cast("long").alias("doc_id"), words_of(column(text_column)).alias("words")
    )
    hits = with_shingles(rows, width, listed)
    hits = hits.select("row", "doc_id", "at", "hash", F.array_join(F.slice("words", F.col("at") + 1, F.lit(width)), " ").alias("shingle"))

    # overlapping windows of each size class
    spans = sorted({r["span"] for r in known})
    of_span = {s: sorted({r["hash"] for r in known if r["span"] == s}) for s in spans}
    places = [
        F.when(F.col("hash").isin(of_span[s]), F.struct(F.lit(s).alias("span"), (F.floor(F.col("at") / s) - back).cast("long").alias("window")))
        for s in spans
        for back in (0, 1)
    ]
    empty = F.array().cast("array<struct<span:int,window:bigint>>")
    inside = hits.select("row", "doc_id", "at", "hash", "shingle", F.explode(F.array_compact(F.array(*places)) if places else empty).alias("w")).select(
        "row", "doc_id", "w.span", "w.window", "at", "hash", "shingle"
    )
    inside = inside.where("window >= 0 OR at < span")
    windows = inside.groupBy("row", "doc_id", "span", "window").agg(F.collect_set("hash").alias("hashes"), F.collect_set(F.struct("at", "shingle")).alias("found"))

    # bands of windows against bands of templates
    signed = windows.select("row", "doc_id", "span", "window", "found", F.explode(_bands(F.col("hashes"), bands)).alias("b"))
    signed = signed.select("row", "doc_id", "span", "window", "found", "b.band", "b.least")
    sets = fixed.groupBy("template", "span", "shingles").agg(F.collect_set("hash").alias("hashes"), F.collect_set("shingle").alias("texts"))
    bands_of = sets.select("template", F.col("span").alias("t_span"), "shingles", "texts", F.explode(_bands(F.col("hashes"), bands)).alias("b"))
    bands_of = bands_of.select("template", "t_span", "shingles", "texts", F.col("b.band").alias("t_band"), F.col("b.least").alias("t_least"))
    retrieved = signed.join(
        bands_of, (F.col("span") == F.col("t_span")) & (F.col("band") == F.col("t_band")) & (F.col("least") == F.col("t_least"))
    )

    # exact containment; a window is retrieved by several bands
    matching = F.filter("found", lambda x: F.array_contains(F.col("texts"), x["shingle"]))
    checked = retrieved.select("row", "doc_id", "span", "window", "template", "shingles", matching.alias("m"))
    checked = checked.select(
        "row",
        "doc_id",
        "span",
        "window",
        "template",
        (F.size(F.array_distinct(F.transform("m", lambda x: x["shingle"]))) / F.col("shingles")).alias("containment"),
        F.array_min(F.transform("m", lambda x: x["at"])).alias("first_word"),
        (F.array_max(F.transform("m", lambda x: x["at"])) + width - 1).alias("last_word"),
    ).where(F.col("containment") >= least)
    best = F.struct(-F.col("containment"), F.col("first_word"), F.col("last_word"))
    return (
        checked.groupBy("row", "doc_id", "template")
        .agg(F.min(best).alias("best"), F.count_distinct("window").alias("windows"))
        .select(
            "doc_id",
            "template",
            (-F.col("best.col1")).alias("containment"),
            F.col("best.first_word").cast("long").alias("first_word"),
            F.col("best.last_word").cast("long").alias("last_word"),
            "windows",
        )
    )
