"""Language-model scores of whole texts by context mixing, beside a smoothed word-frequency baseline."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm import context_mixing as cm
from corvane.llm import word_codes as wc
from corvane.llm.common import parts, require, spread
from corvane.llm.wordhash import Words, blocks
from corvane.session import cut

#: Words that get a leaf of the code: the bound of what is broadcast of them, 60 bytes each. A word that training text holds once gets none.
MOST_LEAVES = 1 << 20
#: Bytes of text that one learner reads in order: as many as give each core one, within these bounds.
LEAST_TASK_TEXT, MOST_TASK_TEXT = 8_000_000, 512_000_000
#: Bytes of text that move a model together, about: few at first, later a share of those read so far, up to a bound.
FIRST_STEP, STEP_SHARE, STEP_TEXT = 1 << 15, 4, 1 << 20
#: Tokens whose distinct words are counted together.
COUNT_TOKENS = 2_000_000
SMOOTHING = 0.1


def held_out(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(10)) == 0


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the texts' words with their counts, summed over runs of texts."""
    hashes: list[np.ndarray] = []

    def counted() -> pa.RecordBatch:
        distinct, count = np.unique(np.concatenate(hashes), return_counts=True)
        hashes.clear()
        return pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(count.astype(np.int64))], names=["h", "c"])

    for batch in batches:
        for _, _, words in blocks(batch.column("text")):
            hashes.append(words.hashes)
            if sum(map(len, hashes)) >= COUNT_TOKENS:
                yield counted()
    if hashes:
        yield counted()


class Sent:
    """What is broadcast to make a model of: a worker makes it once, and then holds only the model."""

    def __init__(self, make: Callable[..., Any], *parts: Any) -> None:
        self.make, self.parts, self.made = make, parts, None

    def get(self) -> Any:
        if self.parts:
            self.made, self.parts = self.make(*self.parts), ()
        return self.made


def _word_model(codes: wc.Codes, bits: tuple[int, ...], rows: list[tuple]) -> tuple[wc.Codes, wc.WordModel]:
    of = lambda kind, name: [(s, d) for k, n, s, d in rows if (k, n) == (kind, name)]
    counts = [cm.Counts.assembled(b, of("counts", i)) for i, b in enumerate(bits[:3])]
    expected = [cm.Expected.assembled(b, of("expected", i)) for i, b in enumerate(bits[3:])]
    shapes = ((wc.TREE_GATES, wc.TREE_PREDICTORS), (wc.WORD_GATES, wc.WORD_PREDICTORS))
    mixers = [cm.Mixer.assembled(*shape, [d for _, d in of("mixer", i)]) for i, shape in enumerate(shapes)]
    return codes, wc.WordModel(counts, expected, mixers)


def _spelling_model(bits: tuple[int, ...], rows: list[tuple]) -> wc.SpellingModel:
    tables = [cm.Counts.assembled(b, [(s, d) for k, n, s, d in rows if (k, n) == ("counts", i)]) for i, b in enumerate(bits)]
    return wc.SpellingModel(tables, cm.Mixer.assembled(wc.SPELLING_GATES, len(bits), [d for k, _, _, d in rows if k == "mixer"]))


def _rare_column(words: Words, tokens: wc.Stream, first: int, last: int) -> pa.Array:
    """For each text the words without a leaf: hash, bytes and signal word."""
    at = np.flatnonzero((tokens.leaf == wc.RARE) & (tokens.word >= 0))
    word = tokens.word[at]
    starts, sizes = words.starts[word], words.ends[word] - words.starts[word]
    offsets = np.zeros(len(at) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    data = words.data[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])]
    text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())]).cast(pa.binary())
    kinds = pa.StructArray.from_arrays([pa.array(words.hashes[word].view(np.int64)), text, pa.array(tokens.signal[at].astype(np.int32))], names=["h", "word", "signal"])
    rows = np.zeros(last - first + 1, np.int32)
    np.cumsum(np.bincount(tokens.row[at], minlength=last - first), out=rows[1:])
    return pa.ListArray.from_arrays(pa.array(rows), kinds)


def _learn_words(shared: Broadcast, bits: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, model, part, read = shared.value, wc.WordModel.empty(bits), 0, 0
        for batch in batches:
            part = batch.column("part")[0].as_py()
            text = batch.column("text")
            while len(text):
                last, words = next((last, words) for _, last, words in blocks(text, min(max(FIRST_STEP, read // STEP_SHARE), STEP_TEXT)))
                wc.learn_words(codes, model, words)
                text, read = text.slice(last), read + len(words.data)
        if model.mixers[0].mass.any():
            yield from cm.part_rows(part, model.counts, model.expected, model.mixers)

    return run


def _score_words(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, words_model = shared.value.get()
        logs = np.log10(codes.counts.astype(np.float64) + SMOOTHING)
        for batch in batches:
            taught = ~batch.column("held_out").to_numpy(zero_copy_only=False)
            for first, last, words in blocks(batch.column("text"), STEP_TEXT):
                tokens, score = wc.score_words(codes, words_model, words, taught[first:last])
                n, row = last - first, tokens.row
                known = tokens.leaf != wc.RARE
                sums = [np.bincount(row, minlength=n), np.bincount(row[~known], minlength=n), np.bincount(row[known], codes.counts[tokens.leaf[known]] > 0, n).astype(np.int64)]
                sums += [np.bincount(row[known], logs[tokens.leaf[known]], n), np.bincount(row, score, n)]
                kept = [batch.column(c).slice(first, n) for c in ("doc_id", "held_out", "k1", "k2", "n_bytes")]
                columns = [*kept, *(pa.array(x) for x in sums), _rare_column(words, tokens, first, last)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "k1", "k2", "n_bytes", "n_tokens", "n_rare", "n_known", "base", "score", "rare"])

    return run


def _learn_spelling(bits: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, part = wc.SpellingModel.empty(bits), 0
        for batch in batches:
            part = batch.column("part")[0].as_py()
            wc.learn_spelling(model, batch.column("word").to_pylist(), batch.column("signal").to_numpy())
        if model.mixer.mass.any():
            yield from cm.part_rows(part, model.counts, [], [model.mixer])

    return run


def _score_spelling(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spelling = shared.value.get()
            score = wc.score_spelling(spelling, batch.column("word").to_pylist(), batch.column("signal").to_numpy(), batch.column("taught").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("h", "signal", "taught")), pa.array(score)], names=["h", "signal", "taught", "spelling"])

    return run


def _learned(rows: DataFrame, learner, tasks: int) -> list[tuple[str, int, int, bytes]]:
    """What `tasks` learners that each read their rows in order have learned, added up."""
    spark = rows.sparkSession
    found = rows.coalesce(tasks).withColumn("part", F.spark_partition_id()).mapInArrow(learner, cm.PARTS)
    while tasks > 1:  # a task adds up FAN_IN parts of one segment
        found = found.groupBy("kind", "name", "segment", F.floor(F.col("part") / cm.FAN_IN)).applyInArrow(cm.merge_parts, cm.PARTS)
        tasks = parts(tasks, cm.FAN_IN)
    return [tuple(r) for r in found.select("kind", "name", "segment", "data").toLocalIterator()]


def vocabulary(words: DataFrame, totals: Any, most_leaves: int = MOST_LEAVES) -> wc.Codes:
    """The code of the words (h, c) that occur at least twice and are among the about `most_leaves` most frequent ones.

    totals: `tokens`, the training tokens, and `ends`, the training texts. Only what gets a leaf comes to the driver.
    """
    least = [F.count_if(F.col("c") >= 1 << k).alias(f"n{k}") for k in range(1, 48)]
    held = words.agg(*least).first()
    k = next((k for k in range(1, 48) if held[f"n{k}"] <= most_leaves), 48)
    found = words.where(F.col("c") >= 1 << k).select("h", "c").toArrow()
    hashes, counts = found.column("h").to_numpy().view(np.uint64), found.column("c").to_numpy()
    return wc.huffman(hashes, counts, int(totals["tokens"] - counts.sum()), int(totals["ends"]))


def score(documents: DataFrame, most_leaves: int = MOST_LEAVES) -> DataFrame:
    """log10 probabilities of documents (doc_id, text), learned from those that aren't held out.

    Tokens are the words, A-Z lower-cased, and one end mark. All counts cover all training documents. The model
    codes a text in order, token by token (`word_codes`): decisions in a Huffman tree of the words that training
    text holds at least twice, predicted from the tree's counts, the last signal word, the word before, and the words that
    followed the last two and the last four words; any other word is spelled. Probabilities of all texts
    add up to 1 at most. Learners read their share of the texts once, online, and their counts are added up;
    with another split of the input the mixing weights differ slightly. A training text is scored without the counts
    that it gave itself, so that its score is comparable with those of held-out texts.

    Texts are never shuffled, only counts of distinct words, parts of tables, and words without a leaf. Tables
    grow with the training tokens up to a bound (`word_bits`, `spelling_bits`: at most about 250 MB a worker with the code); past that more
    contexts share a slot. Exact counts of words grow without a bound.

    Null or empty text: the end mark alone. Null doc_id: as an empty id in the choice of held-out rows.
    Repeated rows are scored (and learned from) each. No training rows: all counts 0, every decision even.
    Extra columns are left aside. No documents: no rows.
    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.
    """
    spark = documents.sparkSession
    text, id_ = F.coalesce("text", F.lit("")), F.col("doc_id").cast("long")
    docs = require(documents, "doc_id", "text").select(id_.alias("doc_id"), text.alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    taught_bytes = F.when(~F.col("held_out"), F.octet_length("text").cast("long"))
    size = docs.agg(F.count_if(~F.col("held_out")).alias("ends"), *[F.coalesce(F.sum(x), F.lit(0)).alias(n) for n, x in (("bytes", taught_bytes), ("all", F.octet_length("text").cast("long")))]).first()
    docs = spread(docs, size["all"])
    taught = docs.where("not held_out").select("text")
    words = cut(taught.mapInArrow(_count_words, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")))
    sums = words.agg(F.count("*").alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("tokens")).first()
    ends = size["ends"]
    n, v = sums["tokens"] + ends, sums["v"] + (ends > 0)
    codes = vocabulary(words, {"tokens": sums["tokens"], "ends": ends}, most_leaves)
    task_text = min(max(parts(size["bytes"], spark.sparkContext.defaultParallelism), LEAST_TASK_TEXT), MOST_TASK_TEXT)
    bits = wc.word_bits(n)
    shared = spark.sparkContext.broadcast(codes)
    learned = _learned(taught, _learn_words(shared, bits), parts(size["bytes"], task_text))
    shared.unpersist()
    shared = spark.sparkContext.broadcast(Sent(_word_model, codes, bits, learned))
    # Rows with the same key have the same doc_id and text, and so the same score.
    keyed = docs.select("doc_id", "held_out", F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(7), "text", "doc_id").alias("k2"),
                        F.octet_length("text").cast("long").alias("n_bytes"), "text")
    schema = "doc_id long, held_out boolean, k1 long, k2 long, n_bytes long, n_tokens long, n_rare long, n_known long, base double, score double, rare array<struct<h:long,word:binary,signal:int>>"
    rows = cut(keyed.mapInArrow(_score_words(shared), schema))
    shared.unpersist()
    rare = rows.select("k1", "k2", (~F.col("held_out")).alias("taught"), F.explode("rare").alias("r")).select("k1", "k2", "taught", "r.*")
    spelled = rows.where("not held_out").select(F.explode("rare").alias("r")).select("r.word", "r.signal")
    known_bytes = rows.where("not held_out").agg(F.coalesce(F.sum(F.aggregate("rare", F.lit(0).cast("long"), lambda a, r: a + F.octet_length(r["word"]) + 1)), F.lit(0))).first()[0]
    spelling_bits = wc.spelling_bits(known_bytes)
    learned = _learned(spelled, _learn_spelling(spelling_bits), parts(known_bytes, max(LEAST_TASK_TEXT // 8, task_text // 8)))
    shared = spark.sparkContext.broadcast(Sent(_spelling_model, spelling_bits, learned))
    distinct = rare.groupBy("h", "signal", "taught").agg(F.min("word").alias("word"))
    priced = distinct.mapInArrow(_score_spelling(shared), "h long, signal int, taught boolean, spelling double")
    priced = priced.join(words, "h", "left").select("h", "signal", "taught", "spelling", F.coalesce("c", F.lit(0)).alias("c"))
    of_rows = rare.join(priced, ["h", "signal", "taught"]).groupBy("k1", "k2").agg(
        F.count("*").alias("found"), F.count_if(F.col("c") > 0).alias("seen"), F.sum("spelling").alias("spelling"), F.sum(F.log10(F.col("c") + SMOOTHING)).alias("logs")
    )
    out = rows.drop("rare").join(of_rows, ["k1", "k2"], "left")
    share = F.col("n_rare") / F.col("found")  # of a row among those with its key
    total = lambda own, found: F.col(own) + F.coalesce(F.col(found) * share, F.lit(0.0))
    base = total("base", "logs") - F.col("n_tokens") * float(np.log10(n + SMOOTHING * (v + 1)))
    score_ = total("score", "spelling")
    return out.select(
        "doc_id", "held_out", "n_tokens", F.round(total("n_known", "seen")).cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        base.alias("base_score"), score_.alias("score"), F.try_divide(-score_ * float(np.log2(10)), F.col("n_bytes") + 1).alias("bits_per_byte"),
    )
