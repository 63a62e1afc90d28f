"""Alignment of two tokenizers over a corpus: how often each pair of their tokens overlaps, by external spill counting.

Every text is cut by both tokenizers. Byte offsets where tokens of both end cut it into groups; inside, two tokens are linked if their
byte ranges overlap. Each place between two neighbouring ends belongs to one token of either side, so links are found by merging the
two lists of ends.

Texts are worked on in blocks of bounded bytes. A block writes its pair-document records as compressed runs: for each radix partition of the
second side's token its pairs in order, second side first, with the number of their links, and beside them the documents' records, which say which
of these pairs a document holds and how often. The runs of a partition are merged through a heap, piece by piece, which adds up each pair;
since all pairs of a second-side token stand together, its greatest count is known as soon as they have passed. Counts and maxima stream
back to every run in its own order, and there into the documents' records.

A partition of more than ``fan`` runs is merged over several levels, so no task holds more than that many runs, and answers come down the same
tree. A pair is one entry of a run however many of the block's documents hold it, so a token of a third of all rows is no larger than any
other. What is shuffled is compressed: the runs, the answers, and the documents' records once.

Long texts are given to the tokenizers in stretches cut at a space between two word characters, where neither has a token that spans
the cut: the first splits its input there, the second has no token with a space behind another character (checked when it is loaded).

Defined cases: texts that are null or empty, or that one of the tokenizers does not give back byte by byte, have no tokens, zeros in all numbers
and '' as digest. Repeated rows count each. An empty table gives an empty result. Rows without an id are documents like all others.
Columns other than ``id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlaudit.llm.common import table
from urlaudit.session import materialize

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
_ID = 20  # bits of a token id
_CUT = re.compile(r"(?<=\w) (?=\w)")


@dataclass(frozen=True)
class Limits:
    """Sizes of the work that is held at once; none changes a result."""

    stretch: int = 1 << 16  # characters that are given to a tokenizer
    part: int = 1 << 20  # bytes whose tokens are compared
    block: int = 8 << 20  # bytes of text whose pairs are counted together
    chunk: int = 1 << 14  # pairs of a run that are unpacked
    fan: int = 256  # runs that are merged in one task
    shard: int = 32 << 20  # bytes of text for each radix partition
    most_shards: int = 1024


class Side:
    """A tokenizer with the bytes of its tokens."""

    def __init__(self, token_bytes: list[bytes], encode):
        self.bytes, self.encode = token_bytes, encode
        self.size = np.array([len(b) for b in token_bytes], np.int64)
        if len(token_bytes) >= 1 << _ID:
            raise ValueError("too many tokens")
        width = len(str(len(token_bytes)))
        written = np.array([str(i).encode() for i in range(len(token_bytes))], f"S{width + 1}")
        self.digits = written.view(np.uint8).reshape(len(token_bytes), width + 1)


def byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(c): b for c, b in [*((b, b) for b in printable), *((256 + k, b) for k, b in enumerate(others))]}


@cache
def first_side(path: str, pattern: str = public_tokenizers.PATTERN) -> Side:
    """A byte-level vocabulary whose ids are in the order of its merges, encoded with a space before the text."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    letters = byte_letters()
    ranks = {bytes(letters[c] for c in entry): number for entry, number in vocabulary.items()}
    encoding = tiktoken.Encoding("first side", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    token_bytes = [b""] * (max(ranks.values()) + 1)
    for entry, number in ranks.items():
        token_bytes[number] = entry
    return Side(token_bytes, lambda texts: [encoding.encode_ordinary(" " + text) for text in texts])


@cache
def second_side(path: str) -> Side:
    """A vocabulary of pieces with U+2581 for a space and <0xHH> for a byte; it puts a space before the text itself."""
    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [pieces.id_to_piece(number) for number in range(pieces.get_piece_size())]
    if any("▁" in name.lstrip("▁") for name in names):
        raise ValueError("a piece has a space behind another character")
    byte = re.compile(r"<0x([0-9A-F]{2})>")
    token_bytes = [bytes([int(m[1], 16)]) if (m := byte.fullmatch(name)) else name.replace("▁", " ").encode() for name in names]
    return Side(token_bytes, lambda texts: pieces.encode(texts, num_threads=1))


def stretches(text: str, most: int = Limits.stretch) -> Iterator[str]:
    """A text in stretches; the space at which it is cut belongs to neither, both tokenizers put one before a stretch."""
    start = 0
    while len(text) - start > most and (cut := _CUT.search(text, start + most)):
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:] if start else text


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of their bytes."""
    planes = np.ascontiguousarray(values.astype(np.int64).view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.int64).ravel()


def run_of(keys: np.ndarray, counts: np.ndarray, chunk: int = Limits.chunk) -> list[bytes]:
    """A sorted run in chunks of steps between keys and of counts, each readable by itself."""
    out = []
    for at in range(0, len(keys), chunk):
        out += [packed(np.diff(keys[at : at + chunk], prepend=0)), packed(counts[at : at + chunk])]
    return out


def chunks_of(run: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for at in range(0, len(run), 2):
        yield np.cumsum(unpacked(run[at])), unpacked(run[at + 1])


def merged(runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of all runs in order with their counts added up, piece by piece: of each run only one chunk is unpacked at a time."""
    readers = [chunks_of(run) for run in runs]
    heap: list[tuple[int, int]] = []  # the last key of each run's chunk
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def advance(number: int) -> None:
        chunk = next(readers[number], None)
        if chunk is None:
            held.pop(number, None)
        else:
            held[number] = chunk
            heapq.heappush(heap, (int(chunk[0][-1]), number))

    for number in range(len(runs)):
        advance(number)
    while heap:
        bound = heap[0][0]
        pieces = []
        for number, (keys, counts) in held.items():
            upto = np.searchsorted(keys, bound, "right")
            if upto:
                pieces.append((keys[:upto], counts[:upto]))
                held[number] = (keys[upto:], counts[upto:])
        keys, place = np.unique(np.concatenate([k for k, _ in pieces]), return_inverse=True)
        yield keys, np.bincount(place, np.concatenate([c for _, c in pieces])).astype(np.int64)
        while heap and heap[0][0] == bound:
            advance(heapq.heappop(heap)[1])


def totals(runs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a partition with their counts."""
    parts = list(merged(runs))
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])


def radix(second: np.ndarray, shards: int) -> np.ndarray:
    """The partition of a token of the second side."""
    mixed = second.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)


def links_of(a: np.ndarray, b: np.ndarray, first: Side, second: Side) -> dict[str, np.ndarray]:
    """Links and groups of two token lists over the same bytes: ``cut`` their ends, ``a`` and ``b`` places of the linked tokens."""
    ends_a, ends_b = np.cumsum(first.size[a]), np.cumsum(second.size[b])
    n = int(ends_a[-1]) + 1
    ends_here, ends_there = np.zeros(n, bool), np.zeros(n, bool)
    ends_here[ends_a] = ends_there[ends_b] = True
    cut = np.flatnonzero(ends_here | ends_there)
    shared = np.flatnonzero(ends_here & ends_there)
    before = lambda flags: (np.cumsum(flags, dtype=np.int32) - flags)[cut]
    return {"cut": cut, "shared": shared, "a": before(ends_here), "b": before(ends_there), "ends_a": ends_a, "ends_b": ends_b}


def written_groups(a: np.ndarray, b: np.ndarray, found: dict, first: Side, second: Side) -> tuple[bytes, np.ndarray]:
    """All groups as text, ``a1,a2|b1;``, and how many bytes of it stand before each group and at the end."""
    group_a = np.searchsorted(found["shared"], found["ends_a"])
    group_b = np.searchsorted(found["shared"], found["ends_b"])
    n_groups = len(found["shared"])
    count_a, count_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
    before_a, before_b = np.concatenate([[0], np.cumsum(count_a)]), np.concatenate([[0], np.cumsum(count_b)])
    width = max(first.digits.shape[1], second.digits.shape[1])
    rows = np.zeros((len(a) + len(b), width), np.uint8)
    for side, ids, group, place, inner, last in (
        (first, a, group_a, np.arange(len(a)) + before_b[group_a], b",", b"|"),
        (second, b, group_b, np.arange(len(b)) + before_a[group_b + 1], b",", b";"),
    ):
        wide = side.digits.shape[1]
        text = side.digits[ids]
        ends = np.ones(len(ids), bool)
        ends[:-1] = group[1:] != group[:-1]
        text[np.arange(len(ids)), (text != 0).sum(1)] = np.where(ends, last[0], inner[0])
        rows[place, :wide] = text
    used = (rows != 0).sum(1)
    upto = np.concatenate([[0], np.cumsum(used)])
    return rows[rows != 0].tobytes(), upto[before_a + before_b]


class Block:
    """Documents of a block with their numbers, and their pair records until the runs are written."""

    def __init__(self, first: Side, second: Side, shards: int, limits: Limits):
        self.first, self.second, self.shards, self.limits = first, second, shards, limits
        self.clear()

    def clear(self) -> None:
        self.ids: list = []
        self.rows: list[list] = []  # n_a, n_b, n_groups, n_links, digest
        self.records: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = self.waiting = 0
        self.parts: list[tuple[int, np.ndarray, np.ndarray]] = []

    def add(self, texts: list[str | None], ids: list) -> Iterator[None]:
        """Add documents; yields whenever the block is full."""
        start = size = 0
        for end in range(1, len(texts) + 1):
            size += len(texts[end - 1] or "")
            if size >= self.limits.part or end == len(texts):
                yield from self._add(texts[start:end], ids[start:end])
                start, size = end, 0

    def _add(self, texts: list[str | None], ids: list) -> Iterator[None]:
        pieces = [list(stretches(text, self.limits.stretch)) if text else [] for text in texts]
        flat = [piece for parts in pieces for piece in parts]
        a = [np.array(tokens, np.int64) for tokens in self.first.encode(flat)]
        b = [np.array(tokens, np.int64) for tokens in self.second.encode(flat)]
        at = 0
        for doc_id, parts in zip(ids, pieces, strict=True):
            upto = at + len(parts)
            whole = True
            for k in range(at, upto):
                wanted = (" " + flat[k]).encode()
                whole = whole and self._joined(self.first, a[k]) == wanted and self._joined(self.second, b[k]) == wanted
            number = len(self.ids)
            self.ids.append(doc_id)
            self.rows.append([0, 0, 0, 0, hashlib.sha256() if whole and parts else None])
            if whole:
                for k in range(at, upto):
                    self.parts.append((number, a[k], b[k]))
                    size = int(self.first.size[a[k]].sum())
                    self.size, self.waiting = self.size + size, self.waiting + size
                    if self.waiting >= self.limits.part:
                        self._compare()
            at = upto
            if self.size >= self.limits.block or len(self.ids) >= 1 << 18:
                yield

    @staticmethod
    def _joined(side: Side, ids: np.ndarray) -> bytes:
        return b"".join(map(side.bytes.__getitem__, ids.tolist()))

    def _compare(self) -> None:
        parts, self.parts, self.waiting = self.parts, [], 0
        if not parts:
            return
        a, b = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
        found = links_of(a, b, self.first, self.second)
        ends = np.cumsum([int(self.first.size[p[1]].sum()) for p in parts])
        text, offsets = written_groups(a, b, found, self.first, self.second)
        groups_to = np.searchsorted(found["shared"], ends, "right")
        links_to = np.searchsorted(found["cut"], ends, "right")
        owners = np.repeat([p[0] for p in parts], np.diff(links_to, prepend=0))
        groups = links = 0
        for (number, own_a, own_b), g, k in zip(parts, groups_to.tolist(), links_to.tolist(), strict=True):
            row = self.rows[number]
            if row[0]:
                row[4].update(b";")
            row[4].update(text[offsets[groups] : offsets[g] - 1])
            row[0], row[1], row[2], row[3] = row[0] + len(own_a), row[1] + len(own_b), row[2] + g - groups, row[3] + k - links
            groups, links = g, k
        keys = (b[found["b"]] << _ID) | a[found["a"]]
        held, times = np.unique((owners << 2 * _ID) | keys, return_counts=True)
        self.records.append((held, times))

    def rows_out(self, block: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        """One row of document records and one run a partition; the block is empty afterwards."""
        self._compare()
        held = np.concatenate([r[0] for r in self.records] or [np.empty(0, np.int64)])
        times = np.concatenate([r[1] for r in self.records] or [np.empty(0, np.int64)])
        keys = held & ((1 << 2 * _ID) - 1)
        pairs, place = np.unique(keys, return_inverse=True)
        counts = np.bincount(place, times, len(pairs)).astype(np.int64)
        shard = radix(pairs >> _ID, self.shards)
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(self.shards + 1))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        # The documents' records name pairs by their place in all runs of the block, one partition after the other.
        owner, place = held >> 2 * _ID, rank[place]
        sorting = np.lexsort((place, owner))
        owner, place, times = owner[sorting], place[sorting], times[sorting]
        own = [packed(np.diff(owner, prepend=0)), packed(np.diff(place, prepend=0)), packed(times)]
        digests = [row[4].hexdigest() if row[4] is not None else "" for row in self.rows]
        numbers = [pa.array([[row[k] for row in self.rows]], pa.list_(pa.int64())) for k in range(4)]
        none = lambda kind, n: pa.nulls(n, kind)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([-1], pa.int32()), none(pa.list_(pa.binary()), 1), pa.array([own], pa.list_(pa.binary())),
             pa.array([self.ids], pa.list_(kind)), *numbers, pa.array([digests], pa.list_(pa.string()))],
            NAMES,
        )
        full = [k for k in range(self.shards) if bounds[k + 1] > bounds[k]]
        runs = [run_of(pairs[order[bounds[k] : bounds[k + 1]]], counts[order[bounds[k] : bounds[k + 1]]], self.limits.chunk) for k in full]
        n = len(full)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * n, pa.int64()), pa.array(full, pa.int32()), pa.array(runs, pa.list_(pa.binary())), none(pa.list_(pa.binary()), n),
                 none(pa.list_(kind), n), *[none(pa.list_(pa.int64()), n)] * 4, none(pa.list_(pa.string()), n)],
                NAMES,
            )
        self.clear()


NAMES = ["block", "shard", "run", "own", "id", "n_a", "n_b", "n_groups", "n_links", "digest"]
NUMBERED = "n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, digest array<string>"


def spilled(docs: DataFrame, first: str, second: str, shards: int, limits: Limits, id_col: str, text_col: str) -> DataFrame:
    """One row for each block's documents, shard -1, and one for each of its runs."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        block, kind = Block(first_side(first), second_side(second), shards, limits), None
        for batch in batches:
            kind = batch.schema.field(0).type
            for _ in block.add(batch.column(1).to_pylist(), batch.column(0).to_pylist()):
                yield from block.rows_out((task << 32) + number, kind)
                number += 1
        if block.ids:
            yield from block.rows_out((task << 32) + number, kind)

    return docs.select(id_col, text_col).mapInArrow(
        run, f"block long, shard int, run array<binary>, own array<binary>, id array<{kind}>, {NUMBERED}"
    )


def _column(table: pa.Table, name: str) -> list:
    return table.column(name).to_pylist()


def _combined(key, table):
    """The runs of a node as one."""
    run = run_of(*totals(_column(table, "run")))
    return pa.table({"block": [key[1].as_py()], "shard": pa.array([key[0].as_py()], pa.int32()), "run": pa.array([run], pa.list_(pa.binary()))})


def _answers(blocks: list[int], shard: int, runs: list[list[bytes]], keys: np.ndarray, values: np.ndarray) -> pa.Table:
    found = [[packed(values[np.searchsorted(keys, own)]) for own, _ in chunks_of(run)] for run in runs]
    return pa.table({"block": pa.array(blocks, pa.int64()), "shard": pa.array([shard] * len(blocks), pa.int32()), "answer": pa.array(found, pa.list_(pa.binary()))})


def _counted(key, table):
    """For each run of a partition its pairs' counts over all runs, times two, plus one if none of the second token's is greater."""
    runs = _column(table, "run")
    keys, counts = totals(runs)
    values = counts
    if len(keys):
        second = keys >> _ID
        begins = np.flatnonzero(np.diff(second, prepend=-1))
        most = np.repeat(np.maximum.reduceat(counts, begins), np.diff(begins, append=len(keys)))
        values = 2 * counts + (counts == most)
    return _answers(_column(table, "block"), key[0].as_py(), runs, keys, values)


def _handed_down(key, runs, above):
    """A node's answer, brought into the order of each of its runs."""
    below = _column(runs, "run")
    keys, _ = totals(below)
    values = np.concatenate([unpacked(part) for part in _column(above, "answer")[0]])
    return _answers(_column(runs, "block"), key[0].as_py(), below, keys, values)


def _finished(key, own, answers):
    """The documents of a block with what their links count."""
    order = np.argsort(np.array(_column(answers, "shard"), np.int64))
    parts = _column(answers, "answer")
    values = np.concatenate([np.empty(0, np.int64), *(unpacked(part) for at in order for part in parts[at])])
    owner, place, times = (unpacked(part) for part in _column(own, "own")[0])
    owner, place = np.cumsum(owner), np.cumsum(place)
    found = values[place]
    ids = own.column("id").combine_chunks().flatten()
    n = len(ids)
    best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
    np.add.at(best, owner, times * (found & 1))
    np.add.at(total, owner, times * (found >> 1))
    same = {name: own.column(name).combine_chunks().flatten() for name in ("n_a", "n_b", "n_groups", "n_links")}
    return pa.table({"id": ids, **same, "n_best": best, "count_sum": total, "groups_sha256": own.column("digest").combine_chunks().flatten()})


def align(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """``id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256`` of each document.

    ``first`` and ``second`` are files that every executor has."""
    kind = docs.schema[id_col].dataType.simpleString()
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    shards = min(max(16, size // limits.shard + 1), limits.most_shards)
    rows = materialize(spilled(docs, first, second, shards, limits, id_col, text_col), "runs")
    own = rows.where("shard = -1").select("block", "own", "id", "n_a", "n_b", "n_groups", "n_links", "digest")
    runs = rows.where("shard >= 0").select("block", "shard", "run")
    # Blocks are numbered one after the other, for nodes of equal size. Their list is one number a block.
    # Nodes of the first level take blocks by hash, those above take a range of the nodes below.
    levels, blocks = [(runs, F.lit(0))], own.count()
    while blocks > limits.fan:
        lower = levels[-1][0]
        blocks = -(-blocks // limits.fan)
        node = F.pmod(F.xxhash64("block"), F.lit(blocks)) if lower is runs else F.floor(F.col("block") / limits.fan).cast("long")
        levels[-1] = (lower, node)
        upper = lower.groupBy("shard", node.alias("node")).applyInArrow(_combined, "block long, shard int, run array<binary>")
        levels.append((materialize(upper, "merged"), F.lit(0)))
    answered = "block long, shard int, answer array<binary>"
    answers = levels[-1][0].groupBy("shard").applyInArrow(_counted, answered)
    for lower, node in reversed(levels[:-1]):
        above = answers.groupBy("shard", F.col("block").alias("node"))
        answers = lower.groupBy("shard", node.alias("node")).cogroup(above).applyInArrow(_handed_down, answered)
    layout = f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    done = own.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_finished, layout)
    return done.withColumnRenamed("id", id_col)


def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query op12: all documents, between two public vocabularies."""
    return align(table(spark, sf_dir, "documents"), public_tokenizers.path(FIRST), public_tokenizers.path(SECOND))
