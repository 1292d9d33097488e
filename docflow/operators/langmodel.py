"""A trained language model: naive Bayes over character n-grams, with a calibrated reject class.

Training counts the n-grams (1 to 3 characters) of labelled texts, keeps each language's most frequent ones, and weighs a kept n-gram in
a language by 1000 times the logarithm of its smoothed share, as a whole number; so sums are exact, and the same in any
order and engine. A text's score in a language is the sum of the weights of its n-grams, one that isn't kept counting as the rarest; its
language is the one with the highest score, at a tie the one that comes first by name. The reject class is
calibrated on the training texts: a text whose mean weight per n-gram is below that of all but REJECT of a language's own texts, has no
language.

The model is a table of a row for each kept n-gram (languages * PROFILE at most) and language, and one of a row for each
language; every task holds both, and a text is scored where it is, without a shuffle. It knows the languages that its
training rows have.

Defined results: texts are lower-cased, white space runs are one blank; a null text, an empty one, and one without any kept
n-gram have no language; rows without a label or text don't train; no training rows give a model that rejects all;
repeated ids are scored a row each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROFILE = 300
BLOCK_CHARS = 1 << 18
REJECT_THOUSANDTHS = 5


def plain(text: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")))


def gram_numbers(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, gram): all 1- to 3-grams of texts, numbered by their code points, 21 bits each, so that shorter ones come first and
    those of one length are in order of code points."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    rows, out = [row], [codes]
    for k in (1, 2):
        same = row[k:] == row[:-k] if len(row) > k else np.empty(0, bool)
        rows.append(row[k:][same])
        out.append((out[-1][: len(same)] << 21 | codes[k:])[same] if k == 1 else (codes[: len(same)] << 42 | codes[1 : 1 + len(same)] << 21 | codes[k:])[same])
    return np.concatenate(rows), np.concatenate(out)


def _blocks(texts: DataFrame, key: list[str], work: Callable, more: str) -> DataFrame:
    """work(key columns of the block, texts) of blocks of texts (key, text) of about BLOCK_CHARS, with columns key and more."""
    own = texts.select(*key, plain(F.col("text")).alias("_t")).filter("_t <> ''")
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in own.schema.fields[:-1]) + more

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            size = np.cumsum([0, *pc.utf8_length(batch.column(last)).to_pylist()])
            i = 0
            while i < batch.num_rows:  # texts of so many characters, or one that is longer
                j = max(i + 1, int(np.searchsorted(size, size[i] + BLOCK_CHARS, "right")) - 1)
                part, i = batch.slice(i, j - i), j
                yield from work(part.columns[:-1], part.column(last).to_pylist())

    return own.mapInArrow(run, schema)


def counted(texts: DataFrame) -> DataFrame:
    """(lang, gram, n) of texts (lang, text): n-grams are counted by language in each block, then summed."""

    def work(key: list[pa.Array], found: list[str]) -> Iterator[pa.RecordBatch]:
        langs = key[0].dictionary_encode()
        of = langs.indices.to_numpy()
        row, gram = gram_numbers(found)
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            names, n = np.unique(gram[of[row] == k], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(names), pa.string()), pa.array(names), pa.array(n, pa.int64())], ["lang", "gram", "n"])

    return _blocks(texts, ["lang"], work, "gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class _Scorer:
    """The model's table in memory: kept n-grams in order, their weights by language, and in the last row that of all others."""

    def __init__(self, weights: list, floors: list):
        self.langs = sorted(r["lang"] for r in floors)
        place = {lang: i for i, lang in enumerate(self.langs)}
        self.grams = np.unique(np.array([r["gram"] for r in weights], np.int64))
        self.weights = np.zeros((len(self.grams) + 1, len(self.langs)), np.int64)
        self.least = np.zeros(len(self.langs), np.int64)
        for r in floors:
            self.weights[-1, place[r["lang"]]] = r["floor"]
            self.least[place[r["lang"]]] = r["least"] or 0
        if weights:
            self.weights[np.searchsorted(self.grams, [r["gram"] for r in weights]), [place[r["lang"]] for r in weights]] = [r["w"] for r in weights]

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows with a kept n-gram, their scores by language, their numbers of n-grams)."""
        row, gram = gram_numbers(texts)
        if not len(self.grams):
            return np.empty(0, np.int64), np.empty((0, len(self.langs)), np.int64), np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
        hit = self.grams[at] == gram
        at[~hit] = len(self.grams)
        sums = [np.bincount(row, self.weights[at, k], len(texts)) for k in range(len(self.langs))]  # whole numbers below 2**53
        some = np.flatnonzero(np.bincount(row[hit], minlength=len(texts)))
        return some, np.column_stack(sums).astype(np.int64)[some], np.bincount(row, minlength=len(texts))[some]


@dataclass
class LanguageModel:
    """weights (gram, lang, w) of the n-grams of any language's profile in every language, and floors (lang, floor, least): the weight of an n-gram
    that isn't kept, and the mean weight in thousandths below which a text is rejected."""

    weights: DataFrame
    floors: DataFrame

    def _held(self):
        """The model's two small tables in the memory of every task."""
        return self.weights.sparkSession.sparkContext.broadcast(_Scorer(self.weights.collect(), self.floors.collect()))

    def scores(self, texts: DataFrame, key: list[str]) -> DataFrame:
        """(key, lang, score, n): the score of each text (key, text) in each language, and its number of n-grams."""
        held = self._held()

        def work(own: list[pa.Array], found: list[str]) -> Iterator[pa.RecordBatch]:
            some, score, n = held.value.scores(found)
            for k, lang in enumerate(held.value.langs):
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(some)) for c in own), pa.array([lang] * len(some), pa.string()), pa.array(score[:, k]), pa.array(n, pa.int64())], [*key, "lang", "score", "n"])

        return _blocks(texts, key, work, "lang string, score long, n long")

    def classified(self, texts: DataFrame, key: list[str]) -> DataFrame:
        """(key, lang, score, n): the language of each text that has kept n-grams, null where it is rejected. Nothing is shuffled."""
        held = self._held()

        def work(own: list[pa.Array], found: list[str]) -> Iterator[pa.RecordBatch]:
            some, score, n = held.value.scores(found)
            best = score.argmax(1) if len(some) else np.empty(0, np.int64)  # the first by name of equal ones
            top = score[np.arange(len(some)), best] if len(some) else np.empty(0, np.int64)
            sure = top * 1000 >= held.value.least[best] * n
            lang = [held.value.langs[k] if ok else None for k, ok in zip(best, sure)]
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(some)) for c in own), pa.array(lang, pa.string()), pa.array(top, pa.int64()), pa.array(n, pa.int64())], [*key, "lang", "score", "n"])

        return _blocks(texts, key, work, "lang string, score long, n long")


def trained(texts: DataFrame, store, profile: int = PROFILE, reject_thousandths: int = REJECT_THOUSANDTHS) -> LanguageModel:
    """The model of labelled texts (id, lang, text). store writes a table and reads it again."""
    from pyspark.sql import Window

    texts = texts.filter("lang is not null and text is not null").select("id", "lang", "text")
    count = store(counted(texts))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    kept = store(count.withColumn("_r", rank).filter(F.col("_r") <= profile).select("gram").distinct())
    of_kept = count.join(F.broadcast(kept), "gram")
    totals = sorted((r["lang"], r["total"]) for r in count.groupBy("lang").agg(F.sum("n").alias("total")).collect())  # a row for each language
    number = kept.count()
    log = lambda n, total: F.round(1000 * F.log((n + 0.5) / (total + 0.5 * (number + 1)))).cast("long")
    total = texts.sparkSession.createDataFrame(totals, "lang string, total long")
    langs = F.array(*(F.struct(F.lit(lang).alias("lang"), F.lit(n).cast("long").alias("total")) for lang, n in totals)) if totals else F.array().cast("array<struct<lang:string,total:bigint>>")
    pairs = kept.select("gram", F.explode(langs).alias("x")).select("gram", "x.lang", "x.total")
    weights = pairs.join(of_kept.select("gram", "lang", "n"), ["gram", "lang"], "left").select("gram", "lang", log(F.coalesce("n", F.lit(0)), F.col("total")).alias("w"))
    weights = store(weights)
    floors = store(total.select("lang", log(F.lit(0), F.col("total")).alias("floor"), F.lit(None).cast("long").alias("least")))
    own = LanguageModel(weights, floors).scores(texts.select("id", F.col("lang").alias("own"), "text"), ["id", "own"]).filter("lang = own")
    means = own.groupBy("lang", F.floor(F.col("score") * 1000 / F.col("n")).cast("long").alias("mean")).agg(F.count(F.lit(1)).alias("c"))  # few different ones
    so_far = F.sum("c").over(Window.partitionBy("lang").orderBy("mean"))
    ranked = means.withColumns({"so_far": so_far, "all": F.sum("c").over(Window.partitionBy("lang"))})
    least = ranked.filter(F.col("so_far") > F.floor(F.col("all") * reject_thousandths / 1000)).groupBy("lang").agg(F.min("mean").alias("least"))
    return LanguageModel(weights, store(floors.drop("least").join(least, "lang")))
