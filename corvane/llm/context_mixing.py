"""Online logistic context mixing over binary decisions: hashed-context predictors, gated weights, adaptive refinement.

A stream of decisions is given with the slots of its contexts. Every predictor turns what its slot has seen into a
logit; a set of weights, chosen by how sure the predictors are, adds them up; a curve that is learned beside
it refines the sum. Learning is one pass: each run of decisions is predicted first, then it moves
weights, curve and counts. All logits are turned towards the decision that was taken, so p(0) + p(1) = 1 holds by symmetry.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Nodes of the refinement's scale, its reach in logits, its share of the result, and how often an even start counts.
BINS, REACH, REFINED, EVEN_REFINED = 33, 8.0, 0.5, 8.0
#: Curvature that the start weights count for.
FIRM = 30.0
#: What a count of zero counts for.
PRIOR = 0.4
#: Probabilities of a decision stay this far from 0 and 1.
LEAST = 1e-6
#: Counts of expectations stay there; a run of texts that is learned at once must not hold so many more of one context.
LARGE = 30000
#: Slots of a table that travel as one row.
SEGMENT = 1 << 16
#: Parts of one segment that a task adds up.
FAN_IN = 64

_NODE, _SPREAD = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def shrunk(values: np.ndarray) -> bytes:
    """An array of whole numbers or records, compressed."""
    if values.dtype == np.float32:
        values = values.astype(np.uint8 if values.max(initial=0) < 256 else np.uint32 if values.max() < 1 << 24 else np.float32)
    return values.dtype.char.encode() + values.nbytes.to_bytes(8, "little") + pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def restored(data: bytes, kind: np.dtype | None = None) -> np.ndarray:
    size = int.from_bytes(data[1:9], "little")
    return np.frombuffer(pa.decompress(memoryview(data)[9:], size, codec="zstd"), kind or np.dtype(data[:1].decode()))


def slots_of(context: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    """The slots of decisions at `node` under `context` in a table of 2 ** bits."""
    with np.errstate(over="ignore"):  # of single nodes
        return (((context ^ (node * _NODE)) * _SPREAD) >> np.uint64(64 - bits)).view(np.int64)


def logit(taken: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.log((taken + np.float32(PRIOR)) / (other + np.float32(PRIOR)))


class Counts:
    """How often each slot has seen a 0 and a 1."""

    def __init__(self, bits: int, data: np.ndarray | None = None) -> None:
        self.bits = bits
        self.data = np.zeros(2 << bits, np.float32) if data is None else data

    def seen(self, slot: np.ndarray, turn: np.ndarray, left_out: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The logit of a 1 times `turn` (1 or -1, for the decision taken), and how much the slot has seen.

        left_out: for each decision how many zeros and how many ones don't count.
        """
        # Both counts are read as one number.
        pair = self.data.view(np.complex64 if self.data.dtype == np.float32 else np.uint32).take(slot, mode="clip")
        pair = pair.view(self.data.dtype).astype(np.float32, copy=False)
        if left_out is not None:
            pair -= left_out
            np.maximum(pair, 0, out=pair)
        zeros, ones = pair[::2], pair[1::2]
        seen = zeros + ones
        pair += np.float32(PRIOR)
        return np.log(ones / zeros) * turn, seen

    def add(self, slot: np.ndarray, decision: np.ndarray) -> None:
        np.add.at(self.data, 2 * slot + decision, np.float32(1))

    def segments(self) -> Iterator[tuple[int, bytes]]:
        for at in range(0, len(self.data), 2 * SEGMENT):
            if (part := self.data[at : at + 2 * SEGMENT]).any():
                yield at // (2 * SEGMENT), shrunk(part)

    @staticmethod
    def merged(parts: list[bytes]) -> bytes:
        total = restored(parts[0]).astype(np.float64)
        for part in parts[1:]:
            total += restored(part)
        return shrunk(total.astype(np.float32))

    @staticmethod
    def assembled(bits: int, segments: list[tuple[int, bytes]]) -> Counts:
        """A table for reading, in 16 bits; pairs too large for them are scaled down together."""
        data = np.zeros(2 << bits, np.uint16)
        for number, part in segments:
            pairs = restored(part).astype(np.float32).reshape(-1, 2)
            pairs = np.ceil(pairs / np.maximum(1.0, pairs.max(axis=1, keepdims=True) / 65000.0))
            data[number * 2 * SEGMENT :][: pairs.size] = pairs.reshape(-1)
        return Counts(bits, data)


def turned(decision: np.ndarray, left_out: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """What `Counts.seen` takes of decisions, and of how many of each don't count."""
    if left_out is None:
        return (2 * decision - 1).astype(np.float32), None
    out = np.empty(2 * len(decision), np.float32)
    np.multiply(left_out, decision, out=out[1::2], casting="unsafe")
    np.subtract(left_out, out[1::2], out=out[::2], casting="unsafe")
    return (2 * decision - 1).astype(np.float32), out


class Expected:
    """What followed each context: a slot holds one symbol, and how often it came and how often another."""

    #: Bits of a stored symbol; those above tell contexts of a slot apart.
    SYMBOL_BITS = 21
    CHECK = (1 << (31 - SYMBOL_BITS)) - 1
    KIND = np.dtype([("symbol", np.int32), ("hits", np.uint16), ("misses", np.uint16)])

    def __init__(self, bits: int, data: np.ndarray | None = None) -> None:
        self.bits = bits
        self.data = np.zeros(1 << bits, self.KIND) if data is None else data

    def places(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slots, and the marks of their contexts."""
        return (context >> np.uint64(64 - self.bits)).view(np.int64), (context & np.uint64(self.CHECK)).astype(np.int32) << self.SYMBOL_BITS

    def seen(self, place: tuple[np.ndarray, np.ndarray], symbol: np.ndarray, left_out: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The symbol expected (-1: none), its hits and its misses; `left_out` occurrences of `symbol` don't count."""
        slot, mark = place
        found = self.data.take(slot)
        stored, hits, misses = found["symbol"], found["hits"].astype(np.int32), found["misses"].astype(np.int32)
        expected = np.where((stored & ~np.int32((1 << self.SYMBOL_BITS) - 1)) == mark, stored & np.int32((1 << self.SYMBOL_BITS) - 1), -1)
        own = expected == symbol
        hits, misses = hits - own * left_out, np.maximum(misses - ~own * left_out, 0)
        return np.where(hits > 0, expected, -1), np.maximum(hits, 0), misses

    def add(self, place: tuple[np.ndarray, np.ndarray], symbol: np.ndarray) -> None:
        slot, mark = place
        coded = symbol.astype(np.int32) | mark
        stored, hits, misses = (self.data[k] for k in self.KIND.names)
        found = self.data.take(slot)
        same, empty = found["symbol"] == coded, np.flatnonzero(found["hits"] == 0)
        taken, new = slot[empty], coded[empty]
        stored[taken] = new
        same[empty] = stored[taken] == new
        for counts, at in ((hits, slot[same]), (misses, slot[~same])):
            np.add.at(counts, at, np.uint16(1))
            if (now := counts[at]).max(initial=0) > LARGE:
                counts[at] = np.minimum(now, LARGE)
        # A symbol that fails more often than it comes gives its slot up.
        given_up = slot[~same]
        given_up = given_up[misses[given_up] > hits[given_up]]
        hits[given_up] = misses[given_up] = 0

    def segments(self) -> Iterator[tuple[int, bytes]]:
        for at in range(0, len(self.data), SEGMENT):
            if (part := self.data[at : at + SEGMENT])["hits"].any():
                yield at // SEGMENT, shrunk(part)

    @staticmethod
    def merged(parts: list[bytes]) -> bytes:
        """Where parts hold different symbols the one with more hits stays, the other's hits are its misses."""
        total = None
        for data in sorted(parts):
            new = restored(data, Expected.KIND)
            if total is None:
                total = {k: new[k].astype(np.int64) for k in Expected.KIND.names}
                continue
            symbol, hits, misses = (new[k].astype(np.int64) for k in Expected.KIND.names)
            same = total["symbol"] == symbol
            better = ~same & (hits > total["hits"])
            lost = np.where(better, total["hits"], hits)
            total["misses"] += misses + np.where(same, 0, lost)
            total["hits"] = np.where(same, total["hits"] + hits, np.where(better, hits, total["hits"]))
            total["symbol"] = np.where(better, symbol, total["symbol"])
        out = np.zeros(len(total["hits"]), Expected.KIND)
        for k in Expected.KIND.names:
            out[k] = total[k] if k == "symbol" else np.minimum(total[k], LARGE)
        return shrunk(out)

    @staticmethod
    def assembled(bits: int, segments: list[tuple[int, bytes]]) -> Expected:
        data = np.zeros(1 << bits, Expected.KIND)
        for number, part in segments:
            part = restored(part, Expected.KIND)
            data[number * SEGMENT :][: len(part)] = part
        return Expected(bits, data)


def _nodes(mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The refinement's node below each sum, and how far it lies towards the next."""
    scaled = (np.clip(mixed, -REACH, REACH) + REACH) * ((BINS - 1) / (2 * REACH))
    low = np.minimum(scaled.astype(np.int32), BINS - 2)
    return low, scaled - low


class Mixer:
    """Weights of the predictors for each gate, and the refinement's curve of each gate."""

    def __init__(self, gates: int, predictors: int) -> None:
        self.weights = np.full((gates, predictors), 1.5 / predictors)
        self.curvature = np.repeat(np.eye(predictors)[None] * FIRM, gates, axis=0)
        self.mass = np.zeros(gates)
        self.curve = np.zeros((gates, BINS))

    def mixed(self, logits: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """Sums of the logits (predictors by decisions) under their gates' weights."""
        out = np.zeros(logits.shape[1], np.float32)
        for values, weights in zip(logits, self.weights.T.astype(np.float32), strict=True):
            out += values * weights.take(gate, mode="clip")
        return out

    def learn(self, logits: np.ndarray, gate: np.ndarray) -> None:
        """An online Newton step for each gate from decisions that the weights so far predict, and the curve's counts."""
        order = np.argsort(gate, kind="stable")
        seen = np.bincount(gate, minlength=len(self.mass))
        turned = logits.take(order, axis=1)
        at = 0
        for g in np.flatnonzero(seen).tolist():
            own = turned[:, at : at + seen[g]]
            at += seen[g]
            sums = self.weights[g].astype(np.float32) @ own
            low, share = _nodes(sums)
            self.curve[g] += np.bincount(low + (share >= 0.5), minlength=BINS)
            missed = 1 / (1 + np.exp(np.clip(sums, -30, 30)))
            # p (1 - p) + (1 - p) ** 2 is 1 - p.
            self.curvature[g] += (own * missed) @ own.T
            self.weights[g] += np.linalg.solve(self.curvature[g], own @ missed)
            self.mass[g] += seen[g]

    def ready(self) -> Mixer:
        """Lays the curve out: the probability of a decision whose sum is at a node."""
        rate = self.curve + EVEN_REFINED / (1 + np.exp(-np.linspace(-REACH, REACH, BINS)))
        self.rate = (rate / (rate + rate[:, ::-1])).astype(np.float32)
        return self

    def log10(self, logits: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """log10 probabilities of the decisions taken."""
        mixed = self.mixed(logits, gate)
        low, share = _nodes(mixed)
        low += gate.astype(np.int32) * BINS
        flat = self.rate.reshape(-1)
        refined = (1 - share) * flat.take(low) + share * flat.take(low + 1)
        plain = 1 / (1 + np.exp(-np.clip(mixed, -30, 30)))
        # The natural logarithm is the one that NumPy computes many at a time.
        return np.log(np.clip(REFINED * refined + (1 - REFINED) * plain, LEAST, 1 - LEAST)) * np.float32(1 / np.log(10))

    def packed(self) -> bytes:
        return np.concatenate([self.weights * self.mass[:, None], self.mass[:, None], self.curve], axis=1).tobytes()

    @staticmethod
    def merged(parts: list[bytes]) -> bytes:
        """Sums: weights by how often each gate was seen, and curves."""
        return np.sum([np.frombuffer(p) for p in parts], axis=0).tobytes()

    @staticmethod
    def assembled(gates: int, predictors: int, parts: list[bytes]) -> Mixer:
        out = Mixer(gates, predictors)
        for part in parts:
            part = np.frombuffer(part).reshape(gates, -1)
            out.mass, out.curve = part[:, predictors], part[:, predictors + 1 :]
            seen = out.mass[:, None] > 0
            out.weights = np.where(seen, part[:, :predictors] / np.where(seen, out.mass[:, None], 1), out.weights)
        return out.ready()


#: How the parts of a model of each kind add up.
MERGED = {"counts": Counts.merged, "expected": Expected.merged, "mixer": Mixer.merged}
PARTS = "part int, kind string, name int, segment int, data binary"


def part_rows(part: int, counts: list[Counts], expected: list[Expected], mixers: list[Mixer]) -> Iterator[pa.RecordBatch]:
    """What a task has learned, as rows of PARTS."""

    def rows() -> Iterator[tuple[str, int, int, bytes]]:
        for kind, tables in (("counts", counts), ("expected", expected)):
            for name, table in enumerate(tables):
                for segment, data in table.segments():
                    yield kind, name, segment, data
        for name, mixer in enumerate(mixers):
            yield "mixer", name, 0, mixer.packed()

    for kind, name, segment, data in rows():
        columns = [pa.array([part], pa.int32()), pa.array([kind]), pa.array([name], pa.int32()), pa.array([segment], pa.int32()), pa.array([data], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "kind", "name", "segment", "data"])


def merge_parts(table: pa.Table) -> pa.Table:
    """One row for the parts of one segment."""
    kind = table.column("kind")[0].as_py()
    first = table.slice(0, 1)
    part = pa.array([table.column("part")[0].as_py() // FAN_IN], pa.int32())
    return pa.table([part, *(first.column(c) for c in ("kind", "name", "segment")), pa.array([MERGED[kind](table.column("data").to_pylist())], pa.binary())], names=table.schema.names)
