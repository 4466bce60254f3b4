"""Language identification: known words by log frequency, character n-grams of falling length for the rest."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.llm.common import hold, require
from corvane.session import text_batches

#: Documents of a language that teach, about: a bounded sample by a seeded hash of doc_id, as whole texts.
SAMPLE_PER_LANGUAGE = 4000
#: Entries of the model for a language: words, and n-grams of each length.
MOST_WORDS, MOST_GRAMS = 20_000, 10_000
ORDERS = (5, 4, 3, 2, 1)
#: Words that make a full-strength decision; longer texts don't count as surer than these.
SURE_WORDS = 25
#: Vectors of unseen words that a Python worker keeps.
CACHE = 100_000
UNKNOWN = "und"
_WORDS = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column, modulus: int = 4, rest: int = 2) -> Column:
    """Whether a document stays out of training; null doc_id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus)) == rest


def _top(counts: DataFrame, by: list[str], name: str, most: int) -> DataFrame:
    order = W.partitionBy(*by).orderBy(F.desc("n"), name)
    return counts.withColumn("r", F.row_number().over(order)).where(F.col("r") <= most).drop("r")


def _vectors(entries: dict[str, dict[str, float]], languages: list[str], totals: dict[str, float], floor: float) -> dict[str, list[float]]:
    """Log frequency by language, less its log-sum over the languages."""
    found = {}
    for key, by in entries.items():
        logs = [math.log((by.get(x, 0.0) + floor) / (totals.get(x, 0.0) + floor * len(entries))) for x in languages]
        top = max(logs)
        norm = top + math.log(sum(math.exp(v - top) for v in logs))
        found[key] = [v - norm for v in logs]
    return found


class Model:
    """Vectors by word and by n-gram, one number for each language. Bounded by the parameters above."""

    def __init__(self, languages: list[str], words: list[str], table: np.ndarray, grams: list[str], gram_table: np.ndarray) -> None:
        self.languages, n = languages, len(languages)
        self.words, self.grams = {w: i for i, w in enumerate(words)}, {g: i for i, g in enumerate(grams)}
        self.table = np.asarray(table, np.float32).reshape(len(words), n)
        self.gram_table = np.asarray(gram_table, np.float32).reshape(len(grams), n)

    @classmethod
    def of(cls, languages: list[str], words: dict[str, list[float]], grams: dict[str, list[float]]) -> Model:
        return cls(languages, list(words), np.array(list(words.values())), list(grams), np.array(list(grams.values())))

    def packed(self) -> tuple:
        """The model as a few strings and arrays; entries hold letters and the marks of word ends only."""
        return self.languages, "\n".join(self.words), self.table, "\n".join(self.grams), self.gram_table

    @classmethod
    def unpacked(cls, languages: list[str], words: str, table: np.ndarray, grams: str, gram_table: np.ndarray) -> Model:
        return cls(languages, words.split("\n") if words else [], table, grams.split("\n") if grams else [], gram_table)

    def prepared(self) -> Model:
        self.known = len(self.words)
        self.table = np.vstack([self.table, np.zeros((CACHE, len(self.languages)), np.float32)])
        return self

    def unseen(self, word: str) -> np.ndarray:
        """The mean vector of the word's known n-grams, at the greatest length that has any."""
        padded = f"^{word}$"
        for n in ORDERS:
            rows = [r for i in range(len(padded) - n + 1) if (r := self.grams.get(padded[i : i + n])) is not None]
            if rows:
                return self.gram_table[rows].mean(axis=0)
        return np.zeros(len(self.languages), np.float32)

    def predict(self, text: str | None) -> tuple[str, float]:
        words = _WORDS.findall(text.lower()) if text else []
        if not self.languages or not any(c.isalpha() for w in words for c in w):
            return UNKNOWN, 0.0
        rows = list(map(self.words.get, words))
        total = np.zeros(len(self.languages))
        if None in rows:
            if len(self.words) + rows.count(None) > len(self.table):
                self.words = dict(list(self.words.items())[: self.known])
                rows = list(map(self.words.get, words))
            for i, row in enumerate(rows):
                if row is None:
                    row = self.words.get(words[i])
                    if row is None and len(self.words) < len(self.table):
                        row = self.words[words[i]] = len(self.words)
                        self.table[row] = self.unseen(words[i])
                    elif row is None:  # a text with more new words than the cache holds
                        total += self.unseen(words[i])
                    rows[i] = row
            rows = [r for r in rows if r is not None]
        total += self.table[rows].sum(axis=0, dtype=np.float64)
        total *= min(1.0, SURE_WORDS / len(words))
        best = int(total.argmax())
        return self.languages[best], float(1.0 / np.exp(total - total[best]).sum())


def train(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, seed: int = 3) -> Model:
    """A model from labelled documents (doc_id, text, lang), null texts and langs left aside.

    Each language's sample is those of a seeded hash under a threshold that its count sets; counting runs
    in Spark, and what reaches the driver is bounded by the model's own limits for each language.
    """
    rows = labelled.where("text is not null and lang is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return Model.of([], {}, {})
    limits = F.create_map(*[F.lit(x) for k in languages for x in (k, int(min(1.0, per_language / counts[k]) * (1 << 30)))])
    chosen = rows.where(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) < limits[F.col("lang")])
    words = chosen.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1)).alias("key"))
    words = words.groupBy("lang", "key").agg(F.count("*").alias("n")).persist()
    padded = F.concat(F.lit("^"), "key", F.lit("$"))
    cuts = F.flatten(F.array(*[
        F.when(F.length(padded) >= n, F.transform(F.sequence(F.lit(1), F.length(padded) - (n - 1)), lambda i, n=n: F.substring(padded, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
        for n in ORDERS
    ]))
    grams = words.select("lang", F.explode(cuts).alias("key"), "n").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    grams = grams.withColumn("order", F.length("key"))
    found: list[dict[str, dict[str, float]]] = [{}, {}]
    sums: list[dict[str, float]] = [{}, {}]
    kept = (_top(words.where("n > 1"), ["lang"], "key", MOST_WORDS), _top(grams, ["lang", "order"], "key", MOST_GRAMS))
    for into, total, top in zip(found, sums, kept, strict=True):
        table = top.select("lang", "key", "n").toArrow()
        for lang, key, n in zip(*(table.column(c).to_pylist() for c in ("lang", "key", "n")), strict=True):
            into.setdefault(key, {})[lang] = n
            total[lang] = total.get(lang, 0.0) + n
    words.unpersist()
    return Model.of(languages, _vectors(found[0], languages, sums[0], 0.5), _vectors(found[1], languages, sums[1], 0.5))


def share(documents: DataFrame, model: Model):
    """The model as a broadcast; its number tells models of one session apart."""
    return documents.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, model.packed()))


def ready(shared) -> Model:
    """The broadcast model, set up once in a Python worker."""
    return hold(shared.value[0], lambda: Model.unpacked(*shared.value[1]).prepared())


def _predict(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    model = ready(shared)
    for batch in batches:
        out = [model.predict(t.as_py()) for t in batch.column("text")]
        kept = [batch.column(i) for i in range(batch.num_columns)]
        new = [pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.float64())]
        yield pa.RecordBatch.from_arrays([*kept, *new], names=[*batch.schema.names, "lang_pred", "score"])


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """documents (text, any other columns) with lang_pred and score; the text alone decides.

    Words of letters, lower-cased, from the whole text. A word of the model adds its vector; another one the
    mean of its n-grams, the longest known. `und` and 0 if the text is null or has no letter, or the model
    knows no language. Ties: the first language by code point. No documents: no rows. Narrow, no shuffle;
    the model is broadcast and bounded by its parameters. Columns named lang_pred or score are replaced.
    """
    text_batches(documents.sparkSession)
    base = documents.drop("lang_pred", "score")
    shared = share(base, model)
    schema = T.StructType([*base.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return base.mapInArrow(lambda it: _predict(it, shared), schema)


def learn_and_identify(documents: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from those not held out, predicted for all."""
    rows = require(documents, "doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    model = train(rows.where("not held_out"), **options)
    return identify(rows.select("doc_id", "text", "held_out"), model).drop("text")


def keep_identified(documents: DataFrame, model: Model, least: float = 0.4) -> DataFrame:
    """documents whose language `model` tells with a score of at least `least`; all columns stay as they are.

    Rejected: texts without a letter, null texts, and texts that no language of the model explains. If the
    model knows no language, nothing can be told and nothing is rejected.
    """
    if not model.languages:
        return documents
    text_batches(documents.sparkSession)
    shared = share(documents, model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            model = ready(shared)
            told = [model.predict(t.as_py()) for t in batch.column("text")]
            yield batch.filter(pa.array([x != UNKNOWN and score >= least for x, score in told], pa.bool_()))

    return documents.mapInArrow(keep, documents.schema)
