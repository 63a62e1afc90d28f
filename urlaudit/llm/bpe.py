"""Byte-level BPE as a monoid: encodings of neighbouring strings are joined in a tree.

A text is cut into halves down to leaves of ``LEAF_TEXT`` characters. A leaf is split into pieces by the pattern as if it stood alone, and two
neighbours are joined by splitting anew a window around their boundary: pieces on the left that end within ``LOOK`` characters of it might
have gone on, and the window grows to the right until one of its pieces ends where one of the right side begins. From there the same text
lies ahead, so nothing beyond can change.

A piece is encoded the same way. A list of tokens is the encoding of its bytes exactly when every two neighbours are the encoding of their
joined bytes: a merge across a boundary would also happen between the two alone. So two encodings join by encoding anew a window around the
boundary and widening it until both of its outer neighbours agree with it. Pieces of more than ``LEAF`` bytes are cut into halves and joined
upwards, decoding concatenates up a tree of equal shape.

Rows are encoded where they are read, without a shuffle. The vocabulary has a fixed size and is read from its file by each worker;
a bounded table of recent pieces saves repeated work and does not change results.

Defined cases: a null or empty text has no tokens, and both digests are those of the empty string. Rows are independent: repeated
rows have equal results, an empty table gives an empty one, and columns other than ``id`` and ``text`` are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import cache
from itertools import chain, pairwise

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlaudit.llm.common import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LEAF = 16  # bytes of a piece that are merged directly
LEAF_TEXT = 256  # characters that are split directly
LOOK = 2  # characters behind a piece that the pattern looks at: "'" may become "'re"
SHORT = 48  # bytes of a piece that is remembered
RECENT = 300_000  # pieces whose tokens a worker remembers
BLOCK = 1 << 20  # characters of a text whose pieces are held at once; tokens that are decoded at once


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pieces = regex.compile(pattern)
        self.token = {rank: token for token, rank in ranks.items()}
        self.text = {rank: str(rank) for rank in self.token}
        self.agreed: dict[tuple[int, int], bool] = {}
        codec = self

        class Recent(dict):
            def __missing__(self, piece: str) -> list[int]:
                ids = codec.encode_bytes(piece.encode())
                if len(piece) <= SHORT:
                    if len(self) >= RECENT:
                        self.clear()
                    self[piece] = ids
                return ids

        self.recent = Recent()

    def merge(self, data: bytes) -> list[int]:
        """Repeatedly join the neighbours of lowest rank, the leftmost of equals."""
        n, ranks = len(data), self.ranks
        if n < 2:
            return [ranks[data]] if n else []
        if n <= SHORT:
            none, find = len(ranks), ranks.get
            cuts = list(range(n + 1))
            pairs = [find(data[i : i + 2], none) for i in range(n - 1)]
            while pairs and (best := min(pairs)) < none:
                at = pairs.index(best)
                del pairs[at], cuts[at + 1]
                if at:
                    pairs[at - 1] = find(data[cuts[at - 1] : cuts[at + 1]], none)
                if at < len(pairs):
                    pairs[at] = find(data[cuts[at] : cuts[at + 2]], none)
            return [ranks[data[a:b]] for a, b in pairwise(cuts)]
        # The same by a heap of pairs; ends[i] is where the part that starts at i ends, 0 once it has been joined.
        ends, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(start: int) -> None:
            middle = ends[start]
            if middle < n and (rank := ranks.get(data[start : ends[middle]])) is not None:
                heapq.heappush(heap, (rank, start, ends[middle]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, start, end = heapq.heappop(heap)
            middle = ends[start]
            if not middle or middle >= n or ends[middle] != end:
                continue  # one of its parts has changed since
            ends[start], ends[middle] = end, 0
            if end < n:
                before[end] = start
            offer(start)
            if before[start] >= 0:
                offer(before[start])
        out, at = [], 0
        while at < n:
            out.append(ranks[data[at : ends[at]]])
            at = ends[at]
        return out

    def agree(self, left: int, right: int) -> bool:
        """Whether two tokens stay as they are side by side."""
        known = self.agreed.get((left, right))
        if known is None:
            if len(self.agreed) >= RECENT:
                self.agreed.clear()
            known = self.agreed[left, right] = self.merge(self.token[left] + self.token[right]) == [left, right]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of both lists together."""
        if not left or not right:
            return left or right
        a = b = 1
        while True:
            start, end = max(0, len(left) - a), min(len(right), b)
            window = self.merge(self.decode(left[start:] + right[:end]))
            left_holds = start == 0 or self.agree(left[start - 1], window[0])
            right_holds = end == len(right) or self.agree(window[-1], right[end])
            if left_holds and right_holds:
                return left[:start] + window + right[end:]
            a, b = a * (1 if left_holds else 2), b * (1 if right_holds else 2)

    def tree(self, data: bytes) -> list[int]:
        if len(data) <= LEAF:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def encode_bytes(self, piece: bytes) -> list[int]:
        """Tokens of one match of the pattern; a piece that is a token itself needs no merges."""
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.tree(piece)

    def join_pieces(self, text: str, left: list[str], middle: int, right: list[str], end: int) -> list[str]:
        """Pieces of a stretch of the text up to ``end``, from those of its parts up to and from ``middle``."""
        at = middle
        while left and at > middle - LOOK:
            at -= len(left.pop())
        skipped, start = 0, middle
        while at < end:
            while start < at:
                start += len(right[skipped])
                skipped += 1
            if start == at:
                break
            left.append(self.pieces.match(text, at, end).group())
            at += len(left[-1])
        left += right[skipped:] if at < end else []
        return left

    def split(self, text: str, start: int, end: int) -> list[str]:
        """Pieces of a stretch of the text as if it stood alone."""
        if end - start <= LEAF_TEXT:
            return self.pieces.findall(text, start, end)
        middle = (start + end) // 2
        return self.join_pieces(text, self.split(text, start, middle), middle, self.split(text, middle, end), end)

    def blocks(self, text: str) -> Iterator[list[int]]:
        """Tokens of a text, in blocks of bounded length; what may still go on at the end of a block is left to the next."""
        start, size = 0, BLOCK
        while start < len(text):
            end = min(start + size, len(text))
            pieces, last = self.split(text, start, end), end
            while pieces and end < len(text) and last > end - LOOK:
                last -= len(pieces.pop())
            size = BLOCK if pieces else 2 * size  # one piece longer than a block
            if pieces:
                yield list(chain.from_iterable(map(self.recent.__getitem__, pieces)))
                start = last

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.blocks(text)))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= BLOCK:
            return b"".join(map(self.token.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """Number of tokens, SHA-256 of their decimal numbers joined by commas, SHA-256 of the decoded bytes."""
        n, written, decoded = 0, hashlib.sha256(), hashlib.sha256()
        for ids in self.blocks(text or ""):
            written.update(((",") * (n > 0) + ",".join(map(self.text.__getitem__, ids))).encode())
            decoded.update(self.decode(ids))
            n += len(ids)
        return n, written.hexdigest(), decoded.hexdigest()


@cache
def codec(path: str, pattern: str = public_tokenizers.PATTERN) -> Codec:
    """The codec of a file of ranks; each worker reads a file once."""
    with open(path, "rb") as lines:
        return Codec({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}, pattern)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and the token ids of each text. The path names a file that every executor has."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            ids = [codec(path).encode(text or "") for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], [id_col, "ids"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id`` and the bytes that token ids stand for; null ids give no bytes."""
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = [codec(path).decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], [id_col, "bytes"])

    return rows.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, bytes binary")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each text in one pass; only the digests leave."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = [codec(path).digests(text.as_py()) for text in batch.column(1)]
            n, ids, decoded = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query op9: every document encoded and decoded."""
    return round_trip(table(spark, sf_dir, "documents").select("doc_id", F.col("text")), public_tokenizers.path(VOCABULARY))
