"""Best-fit packing of token sequences, in bulk-synchronous sweeps.

Documents are cut into pieces of at most `capacity` tokens (only the first piece of a longer document is shorter).
Pieces and gaps are ordered by size; pieces of one length are alike for best fit, and so are gaps of one size, so a
sweep works on runs: a run of equal pieces, longest first, takes the runs of its successor gap (the least that is
large enough), each gap as many as it holds; conflicts within a run go by rank; the gaps that remain are runs again.
The ranks are made by a distributed range sort of all pieces, and every piece finds its place from its rank. The result
is that of sequential best-fit decreasing.

Bound of what the driver sweeps: a length adds at most four runs, and a run that is taken loses over half its gap, so
there are at most 4 x capacity x (log2(capacity) + 1) moves (45,056 at 1024), however many documents there are.

Null text counts as empty: one piece that holds the end id alone. Repeated rows and equal ids are packed one by one.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import global_rank, stage, text_batches, thrifty


def cut_pieces(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document: its ids, then end_id, cut into pieces."""
    import pandas as pd

    text_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    names = [x.split(" ")[0] for x in schema.split(", ")]

    def run(batches):
        enc, tail = bpe.encoder(path, True), np.array([end_id], "<u4").tobytes()

        def work(pdf):
            rows = []
            for doc, text in zip(pdf["doc_id"].array, pdf["text"]):
                ids = enc.encode(text) + tail
                size = len(ids) // 4
                first = (size - 1) % capacity + 1
                for k in range((size - first) // capacity + 1):
                    start = 0 if k == 0 else first + (k - 1) * capacity
                    length = first if k == 0 else capacity
                    part = ids[4 * start : 4 * (start + length)]
                    rows.append((doc, k, start, length, zlib.crc32(part)) + ((part,) if keep_ids else ()))
            yield pd.DataFrame(rows, columns=names)

        return thrifty(batches, work)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(run, schema)


def sweep(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Moves (first rank, pieces per sequence, first sequence, offset, length) over runs of equal pieces, and the number of sequences.

    Ranks count pieces from the longest. The move of a rank is the last one whose first rank isn't above it.
    """
    moves, gaps, sequences, rank = [], [deque() for _ in range(capacity + 1)], 0, 0

    def fill(start: int, bins: int, gap: int, length: int, left: int) -> int:
        """Puts pieces into a run of gaps; what it doesn't need goes back. Returns the number of pieces left."""
        nonlocal rank
        each = gap // length
        whole = min(bins, left // each)
        if whole:
            moves.append((rank, each, start, capacity - gap, length))
            rank += whole * each
            left -= whole * each
            gaps[gap - each * length].append((start, whole))
        if left and whole < bins:
            moves.append((rank, each, start + whole, capacity - gap, length))
            rank += left
            gaps[gap - left * length].append((start + whole, 1))
            whole, left = whole + 1, 0
        if whole < bins:
            gaps[gap].appendleft((start + whole, bins - whole))
        return left

    for length in sorted(counts, reverse=True):
        left = counts[length]
        for gap in range(length, capacity + 1):
            while left and gaps[gap]:
                left = fill(*gaps[gap].popleft(), gap, length, left)
            if not left:
                break
        if left:
            bins = -(-left // (capacity // length))
            fill(sequences, bins, capacity, length, left)
            sequences += bins
    return moves, sequences


def pack(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with sequence_id and offset; within a sequence offsets are gapless from 0."""
    import pandas as pd

    pieces = stage(cut_pieces(docs, path, capacity, end_id, id_col, text_col, keep_ids), "pieces")
    ranked = global_rank(pieces.select("doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])), [F.col("length").desc(), F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], "place")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    moves = np.array(sweep(counts, capacity)[0] or [(0, 1, 0, 0, 1)], dtype=np.int64)

    def place(batches):
        for pdf in batches:
            at = pdf.pop("place").to_numpy()
            move = moves[np.searchsorted(moves[:, 0], at, side="right") - 1]
            nth = at - move[:, 0]
            yield pdf.assign(sequence_id=move[:, 2] + nth // move[:, 1], offset=move[:, 3] + nth % move[:, 1] * move[:, 4])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "place")
    return ranked.mapInPandas(place, f"{fields}, sequence_id long, offset long")
