"""Words as binary decisions: a prefix code over the training words, and the spelling of all others.

A token is first coded by whether it is the word that followed the last four words before, then the last two. If it is
neither, it is coded by the decisions on its path through a Huffman tree over the frequent training words, an end mark and
one leaf for all other words. The others are spelled byte by byte, eight decisions a byte, up to a space. So a text is a
sequence of decisions, each of which context mixing predicts from what stands before it in the text.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

from corvane.llm.context_mixing import Counts, Expected, Mixer, logit, slots_of, turned
from corvane.llm.wordhash import Words, mix

#: Leaves of the tree that aren't words.
RARE, END = 0, 1
#: The most frequent words: the last of them before a token tells what kind of text it is in.
SIGNAL_WORDS = 64
#: Words before a token that each of the three contexts of words takes; the last two expect one word.
WORDS_BACK = (1, 2, 4)
#: Predictors of a decision in the tree: the node alone, behind the signal word, behind the word before. Levels of the last two choose the weights.
TREE_PREDICTORS, TREE_GATES = 3, 3 * 3
#: Predictors of whether the expected word comes: its record, others with such a record, the word itself. After four or
#: two words, how long expectations have held, and hits choose the weights.
WORD_PREDICTORS, WORD_GATES = 3, 2 * 3 * 3
#: Bytes before that each spelling context takes, and which of them are told apart by the signal word.
SPELLED_BACK, SIGNALLED = (1, 2, 3, 5), (1, 3)
#: The contexts whose counts choose the weights.
SPELLING_LEVELS, SPELLING_GATES = (2, 3), 4 * 4
#: Bytes of words that are worked on at once when words are spelled.
CHUNK_BYTES = 1 << 17

_END_HASH, _START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x2545F4914F6CDD1D)
_ODD = np.array([0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], np.uint64)


class Codes(NamedTuple):
    hashes: np.ndarray  # of the words with a leaf, ascending
    leaves: np.ndarray  # their leaves
    starts: np.ndarray  # place of the first hash with given highest bits, or of the next one
    counts: np.ndarray  # of each leaf in training text
    up: np.ndarray  # of each node twice its parent, and which child of it the node is
    rate: np.ndarray  # logit of each node against its sibling by training counts, and with one occurrence of its own left out
    length: np.ndarray  # decisions on the path to each leaf

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The words' leaves."""
        out = np.full(len(hashes), RARE, np.int32)
        if not len(self.hashes):
            return out
        top = (hashes >> np.uint64(64 - (len(self.starts) - 1).bit_length() + 1)).view(np.int64)
        at, end, which = self.starts.take(top), self.starts.take(top + 1), np.arange(len(hashes))
        while len(which):
            on = at < end
            at, end, which = at[on], end[on], which[on]
            same = self.hashes.take(at) == hashes.take(which)
            out[which[same]] = self.leaves.take(at[same])
            at, end, which = at[~same] + 1, end[~same], which[~same]
        return out


def huffman(hashes: np.ndarray, counts: np.ndarray, rare: int, ends: int) -> Codes:
    """The code of words by their training counts, of the end mark and of rare words together.

    Leaves after the first two are words by falling count, ties by hash. The least two nodes are joined until one
    is left; leaves and joined nodes each come in order, so that the next least is at the front of one of two queues.
    """
    order = np.lexsort((hashes, -counts))
    weight = np.concatenate([[rare, ends], counts[order]]).astype(np.int64)
    n = len(weight)
    rising = array("i", np.argsort(weight, kind="stable").astype(np.int32).tobytes())
    total = array("q", np.concatenate([weight, np.zeros(n - 1, np.int64)]).tobytes())
    parent, side = array("i", bytes(4 * (2 * n - 1))), array("b", bytes(2 * n - 1))
    leaf, joined = 0, n
    for node in range(n, 2 * n - 1):
        for which in (0, 1):
            if leaf < n and (joined >= node or total[rising[leaf]] <= total[joined]):
                child, leaf = rising[leaf], leaf + 1
            else:
                child, joined = joined, joined + 1
            parent[child], side[child] = node, which
            total[node] += total[child]
    total, parent, side = np.array(total, np.float32), np.array(parent, np.int32), np.array(side, np.int32)
    root = 2 * n - 2
    sibling = np.full(2 * n - 1, root, np.int32)
    pairs = np.argsort(parent[:root], kind="stable").reshape(-1, 2)
    sibling[pairs[:, 0]], sibling[pairs[:, 1]] = pairs[:, 1], pairs[:, 0]
    rate = np.stack([logit(np.maximum(total - own, 0), total[sibling]) for own in (0, 1)], axis=1)
    length, at = np.zeros(n, np.uint8), np.arange(n)
    while (climbing := at != root).any():
        length += climbing
        at = np.where(climbing, parent[at], root)
    own, leaves = hashes[order], np.arange(2, n, dtype=np.int32)
    rising = np.argsort(own)
    own = own[rising]
    bits = max(n.bit_length(), 8)
    starts = np.searchsorted(own, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    return Codes(own, leaves[rising], np.append(starts, len(own)).astype(np.int32), total[:n], 2 * parent + side, rate.reshape(-1), length)


class Stream(NamedTuple):
    """The tokens of some texts, one after another; each text ends with the end mark."""

    leaf: np.ndarray
    signal: np.ndarray  # 0, or which of the signal words came last
    contexts: tuple[np.ndarray, ...]  # hashes of the words before
    row: np.ndarray  # of each token
    place: np.ndarray  # tokens before it in its row
    word: np.ndarray  # index among the texts' words; -1 for end marks


def stream(words: Words, codes: Codes) -> Stream:
    sizes = np.diff(words.rows)
    rows = len(sizes)
    row = np.repeat(np.arange(rows), sizes + 1)
    starts = words.rows[:-1] - words.rows[0] + np.arange(rows)
    n = len(row)
    word = np.arange(n) - row
    word[starts + sizes] = -1
    of_words, hashes = word >= 0, np.full(n, _END_HASH)
    hashes[of_words] = words.hashes
    leaf = np.full(n, END, np.int32)
    leaf[of_words] = codes.find(words.hashes)
    at = np.arange(n)
    place = at - starts[row]
    context, contexts = np.zeros(n, np.uint64), []
    for back in range(1, max(WORDS_BACK) + 1):
        before = np.full(n, _START)
        before[back:] = hashes[: max(n - back, 0)]
        before[place < back] = _START
        context = mix(context * _ODD[0] + before)
        if back in WORDS_BACK:
            contexts.append(context)
    signalling = (leaf > END) & (leaf <= END + SIGNAL_WORDS)
    last = np.zeros(n, np.int64)
    np.maximum.accumulate(np.where(signalling[:-1], at[:-1], -1), out=last[1:])
    signal = np.where((place > 0) & (last >= at - place) & signalling[last], leaf[last] - END, 0) if n else last
    return Stream(leaf, signal, tuple(contexts), row, place, word)


class WordModel(NamedTuple):
    counts: list[Counts]  # behind the signal word, behind the word before, records of expectations and expected words
    expected: list[Expected]  # after two words, after four
    mixers: list[Mixer]  # of decisions in the tree, of expectations

    @staticmethod
    def empty(bits: tuple[int, ...]) -> WordModel:
        return WordModel([Counts(b) for b in bits[:3]], [Expected(b) for b in bits[3:]], [Mixer(TREE_GATES, TREE_PREDICTORS), Mixer(WORD_GATES, WORD_PREDICTORS)])


def word_bits(tokens: int, most: tuple[int, ...] = (22, 22, 18, 22, 22)) -> tuple[int, ...]:
    """Table sizes for so many training tokens: they grow with them up to `most`, which bounds what is broadcast."""
    return tuple(min(max(16, (tokens // share).bit_length()), m) for share, m in zip((8, 16, 64, 32, 32), most, strict=True))


def _level(counts: np.ndarray, low: int, high: int) -> np.ndarray:
    return (counts >= low).astype(np.uint8) + (counts >= high)


class Decisions(NamedTuple):
    """Decisions of one kind: the token of each, its logits and gate, the tables' slots and what was decided."""

    token: np.ndarray
    logits: np.ndarray
    gate: np.ndarray
    slots: tuple[tuple[Counts, np.ndarray], ...]
    taken: np.ndarray


def _expectations(model: WordModel, tokens: Stream, left_out: np.ndarray) -> tuple[list[Decisions], np.ndarray]:
    """Whether the word expected after four words comes, then, if not, the one after two; and which tokens are left for the tree."""
    found = [t.seen(t.places(c), tokens.leaf, left_out) for t, c in zip(model.expected, tokens.contexts[1:], strict=True)]
    holds = np.zeros(len(tokens.leaf), np.uint8)
    for symbol, _, _ in found:
        holds |= symbol == tokens.leaf
    held = np.zeros(len(holds), np.uint8)  # expectations that have held on end, up to two
    held[1:] = holds[:-1]
    held[2:] += holds[1:-1] & holds[:-2]
    held = np.minimum(held, np.minimum(tokens.place, 2)).astype(np.uint8)
    open_, out, table = np.ones(len(holds), bool), [], model.counts[2]
    for which in (1, 0):
        symbol, hits, misses = found[which]
        asked = open_ & (symbol >= 0)
        if which == 0:  # what has just failed isn't expected again
            asked &= symbol != found[1][0]
        at = np.flatnonzero(asked)
        symbol, hits, misses, run = symbol[at], hits[at], misses[at], held[at]
        taken = (symbol == tokens.leaf[at]).astype(np.int64)
        record = (((which * 3 + run.astype(np.uint64)) * np.uint64(16) + np.minimum(hits, 15).astype(np.uint64)) * np.uint64(16) + np.minimum(misses, 15).astype(np.uint64)) + np.uint64(1)
        named = ((symbol.astype(np.uint64) * np.uint64(2) + np.uint64(which)) * np.uint64(3) + run.astype(np.uint64)) | np.uint64(1 << 40)
        slots = [slots_of(mix(key), np.uint64(which + 1), table.bits) for key in (record, named)]
        logits = np.empty((WORD_PREDICTORS, len(at)), np.float32)
        turn, minus = turned(taken, left_out[at])
        logits[0] = turn * logit(hits.astype(np.float32), misses.astype(np.float32))
        for k, slot in enumerate(slots):
            logits[1 + k], _ = table.seen(slot, turn, minus)
        gate = (np.uint8(which * 3) + run) * np.uint8(3) + _level(hits, 2, 5)
        out.append(Decisions(at, logits, gate, tuple((table, slot) for slot in slots), taken))
        open_[at[taken == 1]] = False
    return out, np.flatnonzero(open_)


def _tree_decisions(codes: Codes, model: WordModel, tokens: Stream, at: np.ndarray, left_out: np.ndarray, in_tables: bool) -> Iterator[Decisions]:
    """From the leaves of the given tokens up, a level at a time.

    left_out: occurrences of each token that don't count, 0 or 1; in_tables: nor do they in the model's tables.
    """
    length = codes.length.take(tokens.leaf[at])
    # The longest paths first: those that go on are always at the front. Equal words stand together.
    at = at[np.argsort((255 - length.astype(np.uint32)) << np.uint32(23) | tokens.leaf[at].astype(np.uint32), kind="stable")]
    # How many paths are longer than each level.
    longer = len(at) - np.cumsum(np.bincount(length, minlength=256))
    node, out = tokens.leaf[at], left_out[at].astype(np.int32)
    contexts = (mix(tokens.signal[at].astype(np.uint64) + np.uint64(1)), tokens.contexts[0][at])
    for level in range(int(length.max(initial=0))):
        n = longer[level]
        node = node[:n]
        up = codes.up.take(node)
        side, parent = (up & 1).astype(np.int64), up >> 1
        wide = parent.astype(np.uint64) + np.uint64(1)
        logits, gate, slots = np.empty((TREE_PREDICTORS, n), np.float32), np.zeros(n, np.uint8), []
        turn, minus = turned(side, out[:n] if in_tables else None)
        codes.rate.take(2 * node + out[:n], out=logits[0], mode="clip")
        for k, (table, context) in enumerate(zip(model.counts, contexts, strict=False)):
            slot = slots_of(context[:n], wide, table.bits)
            logits[1 + k], seen = table.seen(slot, turn, minus)
            gate = gate * np.uint8(3) + _level(seen, *((8, 64), (1, 8))[k])
            slots.append((table, slot))
        yield Decisions(at[:n], logits, gate, tuple(slots), side)
        node = parent


def learn_words(codes: Codes, model: WordModel, words: Words) -> None:
    """One online step: the block's decisions move the mixers, then the tables."""
    tokens = stream(words, codes)
    ones = np.ones(len(tokens.leaf), np.int32)
    first, rest = _expectations(model, tokens, np.zeros_like(ones))
    for k, decisions in ((0, _tree_decisions(codes, model, tokens, rest, ones, False)), (1, first)):
        for d in decisions:
            model.mixers[k].learn(d.logits, d.gate)
            for table, slot in d.slots:
                table.add(slot, d.taken)
    for table, context in zip(model.expected, tokens.contexts[1:], strict=True):
        table.add(table.places(context), tokens.leaf)


def score_words(codes: Codes, model: WordModel, words: Words, taught: np.ndarray) -> tuple[Stream, np.ndarray]:
    """The block's tokens and log10 of their probabilities but for spellings; training texts (`taught`) are predicted without themselves."""
    tokens = stream(words, codes)
    total = np.zeros(len(tokens.leaf))
    left_out = taught[tokens.row].astype(np.int32)
    first, rest = _expectations(model, tokens, left_out)
    # A level's tokens are the first of those of the level below, so that sums are kept in their order.
    order, sums = rest[:0], np.zeros(len(rest))
    for d in _tree_decisions(codes, model, tokens, rest, left_out, True):
        order = order if len(order) else d.token
        sums[: len(d.token)] += model.mixers[0].log10(d.logits, d.gate)
    total[order] = sums[: len(order)]
    for d in first:
        total[d.token] += model.mixers[1].log10(d.logits, d.gate)
    return tokens, total


def spelling_bits(spelled_bytes: int, most: tuple[int, ...] = (20, 20, 22, 22)) -> tuple[int, ...]:
    """Table sizes for so many bytes of spelled training words, up to `most`."""
    return tuple(min(max(12, (2 * spelled_bytes).bit_length()), m) for m in most)


class SpellingModel(NamedTuple):
    counts: list[Counts]
    mixer: Mixer

    @staticmethod
    def empty(bits: tuple[int, ...]) -> SpellingModel:
        return SpellingModel([Counts(b) for b in bits], Mixer(SPELLING_GATES, len(SPELLED_BACK)))


def spelled(words: list[bytes], signals: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """In runs of CHUNK_BYTES, which may cut a word: bytes with a space after each word, the word of each, and its contexts."""
    flat = np.frombuffer(b" ".join([*words, b""]), np.uint8)
    sizes = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
    ends = np.cumsum(sizes)
    for a in range(0, len(flat), CHUNK_BYTES):
        b = min(a + CHUNK_BYTES, len(flat))
        word = np.searchsorted(ends, np.arange(a, b), "right")
        place = np.arange(a, b) - (ends - sizes)[word]
        kind = mix(signals[word].astype(np.uint64) + np.uint64(1))
        wide = flat[max(a - max(SPELLED_BACK), 0) : b].astype(np.uint64) + np.uint64(1)
        wide = np.concatenate([np.zeros(max(SPELLED_BACK) - (len(wide) - (b - a)), np.uint64), wide])
        context, contexts = np.zeros(b - a, np.uint64), []
        for back in range(1, max(SPELLED_BACK) + 1):
            before = wide[max(SPELLED_BACK) - back :][: b - a]
            context = context * _ODD[1] + np.where(place < back, np.uint64(0), before)
            if back in SPELLED_BACK:
                contexts.append(mix(context * _ODD[2] + (kind if back in SIGNALLED else np.uint64(0))))
        yield flat[a:b], word, np.stack(contexts)


def _spelling_decisions(model: SpellingModel, byte: np.ndarray, contexts: np.ndarray, left_out: np.ndarray | None):
    for bit in range(8):
        node = (np.uint64(1) << np.uint64(bit)) | (byte.astype(np.uint64) >> np.uint64(8 - bit))
        side = ((byte >> (7 - bit)) & 1).astype(np.int64)
        logits, slots, levels = np.empty((len(model.counts), len(byte)), np.float32), [], []
        turn, minus = turned(side, left_out)
        for k, (table, context) in enumerate(zip(model.counts, contexts, strict=True)):
            slot = slots_of(context, node, table.bits)
            logits[k], seen = table.seen(slot, turn, minus)
            slots.append(slot)
            if k in SPELLING_LEVELS:
                levels.append(_level(seen, 2, 16) + (seen >= 128))
        yield slots, side, logits, levels[0] * np.uint8(4) + levels[1]


def learn_spelling(model: SpellingModel, words: list[bytes], signals: np.ndarray) -> None:
    """Online steps over runs of words, each with the signal word before it."""
    for byte, _, contexts in spelled(words, signals):
        for slots, side, logits, gate in _spelling_decisions(model, byte, contexts, None):
            model.mixer.learn(logits, gate)
            for table, slot in zip(model.counts, slots, strict=True):
                table.add(slot, side)


def score_spelling(model: SpellingModel, words: list[bytes], signals: np.ndarray, taught: np.ndarray) -> np.ndarray:
    """log10 probability of each word's spelling; `taught`: one occurrence of the word itself doesn't count."""
    out = np.zeros(len(words))
    for byte, word, contexts in spelled(words, signals):
        total = np.zeros(len(byte))
        for _, _, logits, gate in _spelling_decisions(model, byte, contexts, taught[word].astype(np.int32)):
            total += model.mixer.log10(logits, gate)
        first = word[0]
        own = np.bincount(word - first, total)
        out[first : first + len(own)] += own
    return out
