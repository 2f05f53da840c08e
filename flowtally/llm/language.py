"""Language identification, words first.

A word that the model knows scores by its log frequency in each language. An unseen word
falls back to its longest character n-grams: the mean log frequency of those of length 5
that are known, without any the ones of length 4, and so on to single letters. A text's
score for a language is the mean over its words; the prediction is the best language and
its share of the likelihood.

Frequencies are interpolated with those over all languages together: with n of N in a
language that has T distinct entries, and the share p over all, (n + T * p) / (N + T). So an
entry that a language lacks is rarer there than over all, however few labels it has, and a
language with few labels does not win by knowing little. What is known nowhere speaks for
no language. Written as a sum, log p is the same for all languages and left out, log of
T / (N + T) belongs to the language, and only languages that have the entry add to that: the
model keeps one number for each entry and language that has it, and grows with the labels,
not with entries times languages.

The model is fitted on a bounded sample: in expectation `sample` labelled rows of each
language, drawn by a hash of the row, and of these at most `words` words and `grams` n-grams
of each length for a language, those above a frequency cut. So it has at most
languages * (words + 5 * grams) numbers and may be sent to all tasks. Every labelled
language takes part. Prediction reads every row and whole texts, and shuffles nothing.

Defined results: NULL texts and texts without a letter are `und` with score 0, as is every
text where no row is labelled; ties go to the first language in code-point order; repeated
rows each give a row; an empty table gives an empty one. `identified` leaves other columns
out, `keep_identified` returns the input's own columns whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtally.session import staged

from .common import column, fold

UNKNOWN = "und"
LONGEST = 5
LONGEST_WORD = 64  # longer ones take no part in fitting; texts are scored with all their words
_WORDS = regex.compile(r"[\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")
_CACHE = 300_000
_STEP = 0x9E3779B97F4A7C15
_NOTHING = -100.0  # a language without a single entry of a level


@dataclass
class Level:
    """Entries of one length: entry i has numbers `gains[starts[i]:starts[i + 1]]` for those `langs`."""

    starts: np.ndarray
    langs: np.ndarray
    gains: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def of(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in `entries`, language and number, for all numbers of the given entries."""
        sizes = self.starts[entries + 1] - self.starts[entries]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[entries] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
        return np.repeat(np.arange(len(entries)), sizes), self.langs[at], self.gains[at]


@dataclass
class Model:
    """languages; `base`: a row of log T / (N + T) per level, and a last one for what is unknown.

    Level 0 holds words, by their place in `words`; level n the n-grams, in the order of `gram_keys[n - 1]`.
    """

    languages: list[str]
    words: dict[str, int]
    levels: list[Level]
    gram_keys: list[np.ndarray]
    base: np.ndarray


def gram_hashes(points: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit key for each run of `length` code points."""
    key = np.full(max(0, len(points) - length + 1), length, np.uint64)
    for i in range(length):
        key = (key ^ points[i : i + len(key)]) * np.uint64(_STEP)
        key ^= key >> np.uint64(29)
    return key


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)


def _sampled(rows: DataFrame, sizes: DataFrame, sample: int) -> DataFrame:
    """About `sample` rows of each language, by a hash of the row."""
    drawn = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 32)).cast("double") / (1 << 32)
    return rows.join(sizes, "lang").where(drawn * F.col("rows") < sample).drop("rows")


def gram_counts(rows: DataFrame) -> DataFrame:
    """(lang, level, gram, n): word counts at level 0, n-gram counts at the levels 1 to 5."""
    words = rows.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}\p{M}]+")).alias("gram"))
    words = words.where((F.col("gram") != "") & (F.length("gram") <= LONGEST_WORD))
    words = words.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n"))
    padded = F.concat(F.lit(" "), F.col("gram"), F.lit(" "))
    runs = words.select("lang", "n", padded.alias("padded"), F.explode(F.sequence(F.lit(1), F.lit(LONGEST))).alias("level"))
    starts = F.sequence(F.lit(1), F.length("padded") - F.col("level") + 1)
    runs = runs.where(F.length("padded") >= F.col("level")).select("lang", "level", "n", "padded", F.explode(starts).alias("at"))
    grams = runs.select("lang", "level", F.substring("padded", F.col("at"), F.col("level")).alias("gram"), "n")
    grams = grams.groupBy("lang", "level", "gram").agg(F.sum("n").alias("n"))
    return words.select("lang", F.lit(0).alias("level"), "gram", "n").unionByName(grams)


def fit(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    sample: int = 2000,
    words: int = 20_000,
    grams: int = 20_000,
) -> Model:
    """Fit on the rows with a language outside fold 2 of 4."""
    rows = docs.where((fold(id_column, 4) != 2) & column(lang_column).isNotNull()).select(
        column(id_column).cast("long").alias("id"),
        F.coalesce(column(text_column), F.lit("")).alias("text"),
        column(lang_column).cast("string").alias("lang"),
    )
    sizes = staged(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "languages")
    names = sorted(r["lang"] for r in sizes.select("lang").collect())
    counts = staged(gram_counts(_sampled(rows, sizes, sample)), "grams")
    # frequency cuts from the histogram of counts
    shape = counts.groupBy("lang", "level", "n").count().collect()
    totals, kinds, cuts = {}, {}, {}
    for r in sorted(shape, key=lambda r: (r["lang"], r["level"], -r["n"])):
        key = (r["lang"], r["level"])
        totals[key] = totals.get(key, 0) + r["n"] * r["count"]
        kinds[key] = kinds.get(key, 0) + r["count"]
        if kinds[key] <= (grams if r["level"] else words):
            cuts[key] = r["n"]
    if not cuts:
        return Model(names, {}, [], [], np.zeros((0, len(names))))
    spark = docs.sparkSession
    cut = spark.createDataFrame([(*k, v) for k, v in cuts.items()], "c_lang string, c_level int, cut long")
    kept = counts.join(cut, (F.col("lang") == F.col("c_lang")) & (F.col("level") == F.col("c_level")))
    kept = kept.where("n >= cut").select("lang", "level", "gram", "n").toArrow()
    return _model(names, kept, totals, kinds)


def _model(names: list[str], kept: pa.Table, totals: dict, kinds: dict) -> Model:
    at = {n: i for i, n in enumerate(names)}
    number = np.array([[totals.get((n, k), 0) for n in names] for k in range(LONGEST + 1)], float)
    distinct = np.array([[kinds.get((n, k), 0) for n in names] for k in range(LONGEST + 1)], float)
    base = np.full((LONGEST + 2, len(names)), _NOTHING)
    known = number > 0
    base[:-1][known] = np.log(distinct[known] / (number[known] + distinct[known]))
    base[-1] = 0.0
    level_of = kept.column("level").to_numpy()
    langs = np.array([at[n] for n in kept.column("lang").to_pylist()], np.int64)
    listed = kept.column("gram").to_pylist()
    times = kept.column("n").to_numpy().astype(float)
    levels, keys, words = [], [], {}
    for level in range(LONGEST + 1):
        rows = np.flatnonzero(level_of == level)
        if level:
            hashed = np.array([int(gram_hashes(_points(listed[i]), level)[0]) for i in rows], np.uint64)
            own, entry = np.unique(hashed, return_inverse=True)
            keys.append(own)
        else:
            entry = np.array([words.setdefault(listed[i], len(words)) for i in rows], np.int64)
        order = np.lexsort((langs[rows], entry))
        rows, entry = rows[order], entry[order]
        count = int(entry.max()) + 1 if len(entry) else 0
        share = np.bincount(entry, times[rows], count) / max(number[level].sum(), 1.0)
        gains = np.log1p(times[rows] / (distinct[level][langs[rows]] * share[entry]))
        starts = np.concatenate([[0], np.cumsum(np.bincount(entry, minlength=count))]).astype(np.int64)
        levels.append(Level(starts, langs[rows], gains))
    return Model(names, words, levels, keys, base)


def backed_off(words: list[str], model: Model) -> tuple[np.ndarray, Level]:
    """Level and numbers of unseen words: the longest n-grams that are known decide, with their mean."""
    size = len(model.languages)
    decided = np.full(len(words), LONGEST + 1, np.int64)
    codes, values = [np.zeros(0, np.int64)], [np.zeros(0)]
    padded = [f" {w} " for w in words]
    points = _points("".join(padded))
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(points))
    for level in range(LONGEST, 0, -1):
        keys = model.gram_keys[level - 1]
        at = np.flatnonzero((decided[owner] > LONGEST) & (place + level <= ends[owner]))
        if not len(keys) or not len(at):
            continue
        hashed = gram_hashes(points, level)[at]
        found = np.minimum(np.searchsorted(keys, hashed), len(keys) - 1)
        known = keys[found] == hashed
        at, found = owner[at[known]], found[known]
        hits = np.bincount(at, minlength=len(words))
        gram, langs, gains = model.levels[level].of(found)
        codes.append(at[gram] * size + langs)
        values.append(gains / hits[at[gram]])
        decided[hits > 0] = level
    code, inverse = np.unique(np.concatenate(codes), return_inverse=True)
    sums = np.bincount(inverse, np.concatenate(values), len(code))
    starts = np.searchsorted(code, np.arange(len(words) + 1) * size)
    return decided, Level(starts, code % size, sums)


class Scorer:
    """Scores of texts, with the numbers of words met before kept up to a bound."""

    def __init__(self, model: Model):
        self.model = model
        self._reset()

    def _reset(self) -> None:
        self.index = dict(self.model.words)
        self.known = self.model.levels[0] if self.model.levels else Level(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0))
        self.level = np.zeros(len(self.known), np.int64)

    def _learn(self, fresh: list[str]) -> None:
        for i in range(0, len(fresh), 20_000):
            level, found = backed_off(fresh[i : i + 20_000], self.model)
            old = self.known
            starts = np.concatenate([old.starts, old.starts[-1] + found.starts[1:]])
            self.known = Level(starts, np.concatenate([old.langs, found.langs]), np.concatenate([old.gains, found.gains]))
            self.level = np.concatenate([self.level, level])

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        model, size = self.model, len(self.model.languages)
        if not model.levels:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        if len(self.index) > len(model.words) + _CACHE:
            self._reset()
        index, place = self.index, self.index.setdefault
        found, before = [], len(index)
        for text in texts:
            words = _WORDS.findall(text.lower()) if text is not None and _LETTER.search(text) else []
            found.append([place(w, len(index)) for w in words])
        if len(index) > before:
            self._learn(list(islice(reversed(index), len(index) - before))[::-1])
        counts = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.int64, int(counts.sum()))
        doc = np.repeat(np.arange(len(found)), counts)
        depth = len(model.base)
        at_level = np.bincount(doc * depth + self.level[ids], minlength=len(found) * depth).reshape(len(found), depth)
        word, langs, gains = self.known.of(ids)
        sums = np.bincount(doc[word] * size + langs, gains, len(found) * size).reshape(len(found), size)
        means = (at_level @ model.base + sums) / np.maximum(counts, 1)[:, None]
        best = means.argmax(axis=1)
        shares = 1 / np.exp(means - means.max(axis=1, keepdims=True)).sum(axis=1)
        some = counts > 0
        names = [model.languages[b] if s else UNKNOWN for b, s in zip(best.tolist(), some.tolist())]
        return names, np.where(some, shares, 0.0).tolist()


def _predicted(batches: Iterator[pa.RecordBatch], model: Model, at: int) -> Iterator[tuple[pa.RecordBatch, list, list]]:
    scorer = Scorer(model)
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            yield part, *scorer.predict(part.column(at).to_pylist())


def identified(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, held_out (fold 2 of 4), lang_pred, score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(column(id_column).cast("long").alias("doc_id"), (fold(id_column, 4) == 2).alias("held_out"), column(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, names, shares in _predicted(batches, shared.value, 2):
            arrays = [part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(shares, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, text_column: str = "text", lift: float = 1.0) -> DataFrame:
    """The rows whose language is found, with all columns.

    The score must reach `lift` times the share that chance would give, one over the number
    of languages; a model of one language finds it wherever there is a letter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_column)
    least = lift / len(model.languages) if len(model.languages) > 1 else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, names, shares in _predicted(batches, shared.value, at):
            keep = pa.array([n != UNKNOWN and s >= least for n, s in zip(names, shares)], pa.bool_())
            yield part.filter(keep)

    return docs.mapInArrow(run, docs.schema)
