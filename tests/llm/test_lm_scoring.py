"""Language-model scores against counting, a decision-by-decision scorer, and the laws of probability."""

import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corvane.llm import context_mixing as cm
from corvane.llm import lm_scoring
from corvane.llm import word_codes as wc
from corvane.llm.wordhash import blocks
from test_text_operators import SYLLABLES, corpus, frame, words


def test_base_scores(spark):
    again = (500, "the same text twice, with a word like qqqzz", "en", "s")
    rows = [*corpus(80), again, again, (501, "  ", "en", "s"), (502, "", None, None), (None, "no id", "en", "s"), (503, None, None, None)]
    found = lm_scoring.score(frame(spark, rows).withColumn("score", F.lit(0)).withColumn("k1", F.lit("x"))).collect()
    tokens = collections.defaultdict(list)
    for i, t, *_ in rows:
        tokens[i].append([*words(t), "\n"])
    out = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i in tokens}
    counts = collections.Counter(w for i, texts in tokens.items() if not out[i] for ws in texts for w in ws)
    n, v = sum(counts.values()), len(counts)
    assert len(found) == len(rows)
    for r in found:
        ws = tokens[r["doc_id"]][0]
        want = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out[r["doc_id"]], len(ws), sum(counts[w] > 0 for w in ws), n)
        assert math.isclose(r["base_score"], want, rel_tol=1e-9) and r["score"] < 0 and r["bits_per_byte"] > 0
    twice = [r for r in found if r["doc_id"] == 500]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_order_and_gain(spark):
    """Held-out texts are likelier than under the baseline; the same words in another order are not as likely as a copy."""
    rng = random.Random(8)
    lexicon = {k: ["".join(rng.choice(s) for _ in range(rng.randint(2, 4))) for _ in range(80)] for k, s in SYLLABLES.items()}
    rows = [(i, " ".join(rng.choices(lexicon[k], k=150)), k, "s") for i in range(300) for k in [rng.choice(sorted(lexicon))]]
    held = [i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    copied = rows[0][1] if zlib.crc32(b"0") % 10 else rows[1][1]
    mixed = copied.split()
    rng.shuffle(mixed)
    rows += [(held[0], copied, "en", "s"), (held[1], " ".join(mixed), "en", "s"), (999, "wx" * 150_000 + " " + "long text " * 30_000, "en", "s")]
    found = {r["doc_id"]: r for r in lm_scoring.score(frame(spark, rows)).collect()}
    assert len(found) == len(rows) and found[999]["score"] < 0
    inside = [r for i, r in found.items() if r["held_out"] and i < 300]
    assert sum(r["score"] for r in inside) > sum(r["base_score"] for r in inside) + 0.1 * sum(r["n_tokens"] for r in inside)
    copy, other = found[held[0]], found[held[1]]
    assert math.isclose(copy["base_score"], other["base_score"], rel_tol=1e-9) and copy["score"] > other["score"] + 50


def taught(texts, most_leaves=1 << 20):
    block = [w for _, _, w in blocks(pa.array(texts))]
    hashes, counts = np.unique(np.concatenate([w.hashes for w in block]), return_counts=True)
    leaf = counts >= 2
    codes = wc.huffman(hashes[leaf], counts[leaf], int(counts[~leaf].sum()), len(texts))
    model = wc.WordModel.empty(wc.word_bits(int(counts.sum()) + len(texts)))
    for w in block * 3:
        wc.learn_words(codes, model, w)
    for mixer in model.mixers:
        mixer.ready()
    return codes, model


def tokens_of(codes, model, texts, left_out=False):
    """For each text the log10 probabilities of its tokens."""
    out = []
    for _, _, w in blocks(pa.array(texts)):
        tokens, score = wc.score_words(codes, model, w, np.full(len(w.rows) - 1, left_out))
        out += [score[tokens.row == r] for r in range(len(w.rows) - 1)]
    return out


def prose_of(rng, lexicon, n):
    return [" ".join(rng.choices(lexicon, weights=range(len(lexicon), 0, -1), k=rng.randint(5, 60))) for _ in range(n)]


def test_probabilities_sum_to_at_most_one():
    """After any words, all words, the end and the unseen words' leaf together; and what is expected loses nothing else."""
    rng = random.Random(3)
    lexicon = sorted({"".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4))) for _ in range(60)})
    texts = prose_of(rng, lexicon, 80) + ["x y z w v"] * 30
    codes, model = taught(texts)
    every = [w for w in {w for t in texts for w in t.split()}]
    for start in ("", lexicon[0], f"{lexicon[3]} {lexicon[4]}", "x y z w", texts[2]):
        place = len(start.split())
        follow = tokens_of(codes, model, [f"{start} {w}" for w in [*every, "neverseen"]] + [start])
        total = sum(10 ** t[place] for t in follow)
        assert 0.9 < total <= 1 + 1e-6 or start == "x y z w" and total <= 1 + 1e-6
    assert 10 ** tokens_of(codes, model, ["x y z w v"])[0][4] > 0.8


def test_against_single_decisions():
    """Scores of whole blocks equal those of a scorer that follows each token's path alone."""
    rng = random.Random(4)
    lexicon = sorted({"".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 3))) for _ in range(50)})
    texts = prose_of(rng, lexicon, 60) + ["p q r s t u"] * 5
    codes, model = taught(texts)
    held = [*prose_of(rng, lexicon, 10), "p q r s t u", "", "new words p q r"]
    one = lambda x: np.array([x])
    for left_out in (0, 1):
        for text, got in zip(held, tokens_of(codes, model, held, bool(left_out)), strict=True):
            (_, _, w), = blocks(pa.array([text]))
            t = wc.stream(w, codes)
            for i in range(len(t.leaf)):
                want, settled, failed = 0.0, False, None
                right = 0
                for back in (1, 2):
                    # Whether the expectations at the tokens before have held.
                    if i - back < 0 or not any(tab.seen(tab.places(one(c[i - back])), one(t.leaf[i - back]), left_out)[0][0] == t.leaf[i - back] for tab, c in zip(model.expected, t.contexts[1:], strict=True)):
                        break
                    right += 1
                for which in (1, 0):
                    table, context = model.expected[which], t.contexts[1 + which]
                    symbol, hits, misses = (x[0] for x in table.seen(table.places(one(context[i])), one(t.leaf[i]), left_out))
                    if settled or symbol < 0 or symbol == failed:
                        continue
                    settled, failed = symbol == t.leaf[i], symbol
                    turn = 1 if settled else -1
                    keys = [((which * 3 + right) * 16 + min(hits, 15)) * 16 + min(misses, 15) + 1, ((int(symbol) * 2 + which) * 3 + right) | 1 << 40]
                    logits = [turn * math.log((hits + 0.4) / (misses + 0.4))]
                    for key in keys:
                        slot = wc.slots_of(wc.mix(np.array([key], np.uint64)), np.uint64(which + 1), model.counts[2].bits)[0]
                        pair = model.counts[2].data[2 * slot : 2 * slot + 2].astype(float)
                        pair[int(settled)] = max(pair[int(settled)] - left_out, 0)
                        logits.append(turn * math.log((pair[1] + 0.4) / (pair[0] + 0.4)))
                    gate = (which * 3 + right) * 3 + (hits >= 2) + (hits >= 5)
                    want += model.mixers[1].log10(np.array(logits, np.float32)[:, None], np.array([gate], np.uint8))[0]
                node = int(t.leaf[i])
                while not settled and node != len(codes.up) - 1:
                    parent, side = codes.up[node] >> 1, codes.up[node] & 1
                    logits, gate = [codes.rate[2 * node + left_out]], 0
                    for k, (table, key) in enumerate(zip(model.counts, (wc.mix(np.array([t.signal[i] + 1], np.uint64)), one(t.contexts[0][i])), strict=False)):
                        slot = wc.slots_of(key, np.array([parent + 1], np.uint64), table.bits)[0]
                        pair = table.data[2 * slot : 2 * slot + 2].astype(float)
                        pair[side] = max(pair[side] - left_out, 0)
                        logits.append(math.log((pair[side] + 0.4) / (pair[1 - side] + 0.4)))
                        gate = gate * 3 + sum(pair.sum() >= x for x in ((8, 64), (1, 8))[k])
                    want += model.mixers[0].log10(np.array(logits, np.float32)[:, None], np.array([gate], np.uint8))[0]
                    node = int(parent)
                assert math.isclose(got[i], want, rel_tol=1e-4, abs_tol=1e-5), (text, i)


def test_spellings_sum_to_at_most_one():
    rng = random.Random(5)
    seen = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 4))).encode() for _ in range(4000)]
    model = wc.SpellingModel.empty(wc.spelling_bits(20_000))
    wc.learn_spelling(model, seen, np.zeros(len(seen), int))
    model.mixer.ready()
    short = [bytes(x) for x in ([a] for a in b"abcdefghi")] + [bytes([a, b]) for a in b"abcde" for b in b"abcde"] + [bytes([a, b, c]) for a in b"abc" for b in b"abc" for c in b"abc"]
    score = wc.score_spelling(model, short, np.zeros(len(short), int), np.zeros(len(short), bool))
    assert 0.5 < (10**score).sum() <= 1 + 1e-6
    # Runs cut words without changing them.
    long = [b"abc" * 200_000, b"ab", b"cab" * 50_000]
    together = wc.score_spelling(model, long, np.zeros(3, int), np.zeros(3, bool))
    alone = [wc.score_spelling(model, [w], np.zeros(1, int), np.zeros(1, bool))[0] for w in long]
    assert np.allclose(together, alone, rtol=1e-6)


def test_parts_add_up():
    """Tables of several learners, merged and read again, hold their counts together."""
    rng = random.Random(6)
    texts = prose_of(rng, ["aa", "bb", "cc", "dd", "ee"], 60)
    halves = [texts[:30], texts[30:]]
    block = [next(blocks(pa.array(t)))[2] for t in halves]
    hashes, counts = np.unique(np.concatenate([w.hashes for w in block]), return_counts=True)
    codes, bits = wc.huffman(hashes, counts, 0, 60), (18, 18, 12, 18, 18)
    models = [wc.WordModel.empty(bits) for _ in (0, 1)]
    for model, w in zip(models, block, strict=True):
        wc.learn_words(codes, model, w)
    rows = pa.concat_tables([pa.Table.from_batches(list(cm.part_rows(k, m.counts, m.expected, m.mixers))) for k, m in enumerate(models)])
    for name in (0, 1):
        parts = [r for r in rows.to_pylist() if (r["kind"], r["name"]) == ("counts", name)]
        by = collections.defaultdict(list)
        for r in parts:
            by[r["segment"]].append(r)
        merged = [cm.merge_parts(pa.Table.from_pylist(x, schema=rows.schema)).to_pylist()[0] for x in by.values()]
        table = cm.Counts.assembled(18, [(r["segment"], r["data"]) for r in merged])
        assert np.array_equal(table.data.astype(np.float32), models[0].counts[name].data + models[1].counts[name].data) and table.data.any()
    hits = [cm.restored(cm.Expected.merged([cm.shrunk(m.expected[0].data[: cm.SEGMENT]) for m in models]), cm.Expected.KIND)["hits"]]
    assert hits[0].sum() > 0


def test_tables_grow_with_the_corpus():
    assert all(a < b for a, b in zip(wc.word_bits(1_000_000), wc.word_bits(20_000_000), strict=True))


def test_code_lengths():
    """No prefix code is shorter: lengths equal those of joining the two least weights by definition."""
    rng = random.Random(7)
    counts = np.array([rng.randint(1, 1000) for _ in range(200)])
    codes = wc.huffman(np.arange(200, dtype=np.uint64) << np.uint64(50), counts, 5, 9)
    weights, cost = sorted([5, 9, *counts.tolist()]), 0
    while len(weights) > 1:
        a, b, *weights = weights
        weights = sorted([*weights, a + b])
        cost += a + b
    assert (codes.counts * codes.length).sum() == cost and codes.counts.tolist()[:2] == [5, 9]
    assert (codes.find(np.arange(200, dtype=np.uint64) << np.uint64(50)) > 1).all() and codes.find(np.array([3], np.uint64))[0] == wc.RARE
