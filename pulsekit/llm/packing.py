"""Packing documents into sequences by Karmarkar-Karp differencing.

Each document is tokenised, cut into pieces of which full windows stand alone, and the rest is packed in batches of
bounded size: multiway differencing starts from one partial partition per piece and merges the two partitions with the
largest imbalance, largest window against smallest, until one partition is left. Its windows are nearly equal. What a window
holds beyond the capacity moves over the cut between a piece and its neighbour in the document, if that lies in a window
with room; if a window still exceeds the capacity, the window count rises by one and differencing starts again. A batch fills
a whole number of windows but for a little slack, and the pieces beyond wait for the next one. Nothing is shuffled: a batch
is a run of pieces of one scan task, and a sequence id holds the task's number.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator, Mapping
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
# The rest of a document is cut into equal pieces of at most this length: enough pieces per window to balance it well.
PIECE = 256
# Pieces packed together, and tokens that a batch leaves free per window, so that near-equal windows fit.
BATCH = 512
SLACK = 4
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_tokens long"
)
_END = 1
_GAPS = r"\s\s"
# The vocabulary's own pattern without its look-ahead, which only matters where white space stands in runs.
_PLAIN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"


def vocabulary_path() -> str:
    """The public byte-level vocabulary as ranks; its ids are those of byte_bpe_50k.json."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens() -> dict[str, int]:
    """The vocabulary's added tokens, which the tokenizers library by default cuts out of a text before all else."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        listed = json.load(file)["added_tokens"]
    for t in listed:
        if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
            raise ValueError(f"added token {t['content']!r} takes more than its own characters")
    return {t["content"]: t["id"] for t in listed}


def encoder(path: str, added: Mapping[str, int] | None = None):
    """A function from text to ids, the same ids the tokenizers library gives with byte_bpe_50k.json (see tests).

    With `added` tokens, as `added_tokens` lists them, this is the library's default; without, they are plain text.
    """
    import public_tokenizers
    import regex
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    make = lambda name, pattern: tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    full, plain = make("full", public_tokenizers.PATTERN), make("plain", _PLAIN)
    gaps = regex.compile(_GAPS)
    part = lambda text: (full if gaps.search(text) or text[-1:].isspace() else plain).encode_ordinary(text)
    if not added:
        return part
    cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True)) + ")")

    def whole(text: str) -> list[int]:
        parts = cut.split(text)
        if len(parts) == 1:
            return part(text)
        return [i for k, p in enumerate(parts) for i in ((added[p],) if k % 2 else part(p))]

    return whole


def difference(lengths: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: item numbers per window, window sums nearly equal.

    A partition holds its non-empty windows as sums in falling order, each with a node of a tree that joins its items.
    """
    left, right = list(range(len(lengths))), [-1] * len(lengths)
    heap = [(-n, i, np.array([n], np.int64), np.array([i])) for i, n in enumerate(lengths)]
    heapify(heap)
    tie = len(lengths)
    while len(heap) > 1:
        _, _, a, a_nodes = heappop(heap)
        _, _, b, b_nodes = heappop(heap)
        # windows not held count as sums of 0: largest meets smallest
        total = min(windows, len(a) + len(b))
        sums, nodes = np.zeros(total, np.int64), np.full(total, -1)
        sums[: len(a)], nodes[: len(a)] = a, a_nodes
        spot = total - 1 - np.arange(len(b))
        sums[spot] += b
        for k in np.flatnonzero(spot < len(a)).tolist():
            left.append(int(nodes[spot[k]]))
            right.append(int(b_nodes[k]))
            b_nodes[k] = len(left) - 1
        nodes[spot] = b_nodes
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        least = sums[-1] if total == windows else 0
        heappush(heap, (-int(sums[0] - least), tie, sums, nodes[order]))
        tie += 1
    made = []
    for node in heap[0][3].tolist() if heap else []:
        items, open_nodes = [], [node]
        while open_nodes:
            at = open_nodes.pop()
            if right[at] < 0:
                items.append(at)
            else:
                open_nodes += [left[at], right[at]]
        made.append(items)
    return made


def _even_out(lengths: list[int], starts: list[int], joined: list[bool], windows: list[list[int]], capacity: int) -> bool:
    """Move cuts between neighbouring pieces, in place, until no window exceeds the capacity; False if one still does.

    `joined[i]` says that piece i goes on in piece i + 1. No piece becomes empty.
    """
    owner, sums = [0] * len(lengths), []
    for w, window in enumerate(windows):
        sums.append(sum(lengths[i] for i in window))
        for i in window:
            owner[i] = w
    for w, window in enumerate(windows):
        for i in window:
            for j in (i + 1, i - 1):
                if sums[w] <= capacity:
                    break
                if j < 0 or not joined[min(i, j)]:
                    continue
                moved = min(sums[w] - capacity, capacity - sums[owner[j]], lengths[i] - 1)
                if moved > 0 and owner[j] != w:
                    lengths[i] -= moved
                    lengths[j] += moved
                    sums[w] -= moved
                    sums[owner[j]] += moved
                    starts[max(i, j)] += moved if j < i else -moved
    return max(sums, default=0) <= capacity


def windows_of(lengths: list[int], capacity: int = CAPACITY, starts: list[int] | None = None, joined: list[bool] | None = None) -> list[list[int]]:
    """Item numbers per window, no window above the capacity; each length is at most the capacity.

    Where items are `joined` to the next one, `lengths` and `starts` may change, see :func:`_even_out`.
    """
    starts, joined = starts or [0] * len(lengths), joined or [False] * len(lengths)
    count = -(-sum(lengths) // capacity)
    while True:
        made = difference(lengths, count)
        if _even_out(lengths, starts, joined, made, capacity):
            return made
        count += 1


def cuts(total: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full windows, then equal pieces of at most `piece`."""
    whole, rest = divmod(total, capacity)
    made = [(k * capacity, capacity) for k in range(whole)]
    n = -(-rest // piece)
    at = [whole * capacity + rest * k // n for k in range(n)] + [total] if n else []
    return made + [(i, j - i) for i, j in zip(at, at[1:])]


def _pack(
    batches: Iterator[pa.RecordBatch], path: str, added: Mapping[str, int], capacity: int, piece: int, batch: int
) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    sequence = TaskContext.get().partitionId() << 40
    encode = encoder(path, added)
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    out: list[tuple] = []
    waiting: list[tuple] = []

    def settle(last: bool = False) -> None:
        """Pack what waits: all of it at the end, else as many pieces as fill a whole number of windows."""
        nonlocal sequence
        sizes = [w[2] for w in waiting]
        upto = np.cumsum(sizes)
        windows = 0 if last or not sizes else int(upto[-1]) // capacity
        n = max(1, int(np.searchsorted(upto, windows * (capacity - SLACK), "right"))) if windows else len(sizes)
        starts, lengths = [w[1] for w in waiting[:n]], sizes[:n]
        joined = [a[3] is b[3] and a[1] + a[2] == b[1] for a, b in zip(waiting[:n], waiting[1:n])] + [False]
        for window in windows_of(lengths, capacity, starts, joined):
            tokens, offset = sum(lengths[i] for i in window), 0
            for i in window:
                (doc_id, _, _, rest, total), start, length = waiting[i], starts[i], lengths[i]
                at = start - (total - len(rest))
                crc = zlib.crc32(rest[at : at + length].tobytes())
                out.append((doc_id, start, length, crc, total, sequence, offset, tokens))
                offset += length
            sequence += 1
        del waiting[:n]

    def emit() -> pa.RecordBatch:
        columns = [pa.array(c, pa.int64()) for c in zip(*out)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    for rows in batches:
        for doc_id, text in zip(rows.column(0), rows.column(1)):
            ids = np.array([*encode(text.as_py() or ""), _END], "<u4")
            rest = ids[len(ids) // capacity * capacity :].copy()  # what of a document may have to wait
            for start, length in cuts(len(ids), capacity, piece):
                if length == capacity:
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    out.append((doc_id.as_py(), start, length, crc, len(ids), sequence, 0, capacity))
                    sequence += 1
                else:
                    waiting.append((doc_id.as_py(), start, length, rest, len(ids)))
            if len(waiting) >= batch:
                settle()
            if len(out) >= 50_000:
                yield emit()
    settle(last=True)
    if out:
        yield emit()


def pack(
    docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, piece: int = PIECE, batch: int = BATCH
) -> DataFrame:
    """Rows of `SCHEMA`, one per piece: where it lies in its document and in its sequence, and the sequence's tokens.

    Every document ends with id 1, so a NULL or empty text is the one id 1. Repeated rows are packed each. Extra columns
    are not read. `vocabulary` is the path of the ranks on every executor. An added token in a text is its one id.
    """
    path, added = vocabulary or vocabulary_path(), added_tokens()
    return docs.select("doc_id", "text").mapInArrow(lambda b: _pack(b, path, added, capacity, piece, batch), SCHEMA)
