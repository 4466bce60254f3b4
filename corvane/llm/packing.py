"""Packing token pieces into sequences: first-fit decreasing on a tournament tree, per randomised group."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import hold, parts, require

CAPACITY = 2048
END_ID = 1
#: Pieces that one task packs together; a group's memory is a few integers for each.
GROUP_PIECES = 16384
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def first_fit_decreasing(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int]]:
    """Bin and offset of each length.

    The tree's leaves are bins with their free room, inner nodes the largest room below; a descent to the
    left-most child with enough room finds the first bin that fits. Unopened bins are leaves of full room.
    """
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    width = 1 << max(0, len(lengths) - 1).bit_length()
    room = [capacity] * (2 * width)
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    for i in order:
        need = lengths[i]
        if not 0 < need <= capacity:
            raise ValueError(f"a length of {need} does not fit a capacity of {capacity}")
        node = 1
        while node < width:
            node *= 2
            if room[node] < need:
                node += 1
        bins[i], offsets[i] = node - width, capacity - room[node]
        room[node] -= need
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
    return bins, offsets


class Encoder:
    """Ids of byte_bpe_50k.json without special tokens added, and END_ID after them.

    The rank file of the same vocabulary gives the same ids several times faster. The one special string
    that the tokenizer recognises inside a text is split off first, as the tokenizer does.
    """

    def __init__(self, name: str = "byte_bpe_50k") -> None:
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        added = Tokenizer.from_file(public_tokenizers.path(f"{name}.json")).get_added_tokens_decoder()
        self.special = {str(token): i for i, token in added.items()}
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        ids: list[int] = []
        rest = text
        while rest:
            found = min(((at, s) for s in self.special if (at := rest.find(s)) >= 0), default=None)
            head = rest if found is None else rest[: found[0]]
            ids += self.encoding.encode_ordinary(head)
            if found is None:
                break
            ids.append(self.special[found[1]])
            rest = rest[found[0] + len(found[1]) :]
        ids.append(END_ID)
        return np.array(ids, dtype="<u4")


def tokenize_pieces(batches: Iterator[pa.RecordBatch], capacity: int = CAPACITY) -> Iterator[pa.RecordBatch]:
    """Pieces of whole texts, each at most `capacity` ids; `turn` counts equal pieces within a task."""
    encode, seen = hold("packing", Encoder), {}
    for batch in batches:
        out: list[tuple] = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids = encode(text.as_py() or "")
            n = len(ids)
            for start in range(0, n, capacity):
                piece = ids[start : start + capacity]
                crc = zlib.crc32(piece.tobytes())
                turn = seen[doc_id, start, crc] = seen.get((doc_id, start, crc), -1) + 1
                out.append((doc_id, start, len(piece), crc, n, turn))
        columns = list(zip(*out, strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "turn"],
        )


def _pack_group(capacity: int):
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([(n, "ascending") for n in ("length", "doc_id", "start", "ids_crc32", "turn")])
        bins, offsets = first_fit_decreasing(table.column("length").to_pylist(), capacity)
        return table.append_column("bin", pa.array(bins, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    return pack


def pack(documents: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, seed: int = 7) -> DataFrame:
    """Pack every document (doc_id, text) into sequences of at most `capacity` ids.

    A document's ids end with END_ID and are cut every `capacity` ids. Each piece joins a group chosen by a
    seeded hash, and each group is packed by first-fit decreasing in one task of at most about `group_pieces`
    pieces, however long the documents are. Only integers are shuffled, never texts.

    Null or empty text: the single id END_ID. Null doc_id: packed like any other. Repeated rows: each row
    is packed; equal pieces differ in `turn` for the grouping, so a doc_id that many rows share does not
    fill one group. Extra columns are left aside. No documents: no rows.
    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    """
    docs = require(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # An id stands for a byte at least, so there are no more pieces than this.
    most = F.count("*") + F.coalesce(F.sum(F.floor(F.octet_length("text") / capacity)), F.lit(0))
    groups = parts(int(docs.agg(most).first()[0]), group_pieces)
    pieces = docs.mapInArrow(lambda it: tokenize_pieces(it, capacity), PIECES + ", turn long")
    key = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "start", "ids_crc32", "turn"), F.lit(groups))
    return (
        pieces.withColumn("grp", key)
        .groupBy("grp")
        .applyInArrow(_pack_group(capacity), PIECES + ", turn long, grp long, bin long, offset long")
        .withColumn("sequence_id", F.col("grp") * F.lit(1 << 24) + F.col("bin"))
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    )
