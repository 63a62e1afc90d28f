"""Language-model scores by deleted interpolation of words.

Maximum-likelihood estimates of a word after its predecessor, of the word alone, and a uniform one are mixed. The weights depend on
how often the predecessor was seen, in buckets of doublings, and are learned by expectation-maximisation on held-out counts: one in
eight training documents is the held-out part, and for it the estimates come from the counts without it. Scores use the counts of
all training documents.

Documents are dealt to blocks by a hash of their id and text, so many that a block is bounded in rows and in bytes. A block asks for the counts of its distinct words and pairs, as sorted arrays
of hashes cut at fixed bounds into shards, and says how often its own training documents have them; a shard adds up what all blocks
say and answers each in its order. So each block of documents meets the counts it needs and nothing else, no word is gathered row by
row, frequent words meet once for each block, and blocks and shards are of bounded size while their number grows with the table.
Words are known by 64-bit hashes.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, followed by one end mark that is counted as a word. Defined cases: a null or
empty text has the end mark alone; without a training row all counts are 0, V is 0 and words are as likely as the uniform
estimate says; repeated rows count and are scored each; rows without an id are no training rows. A very long text is a block
by itself, give or take a few others. An empty table gives an empty
result. Columns other than ``id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlaudit.llm.common import table, training
from urlaudit.llm.hashing import blocks, mix, word_hashes
from urlaudit.session import materialize

HELD_OUT = (7, 2)
FOLDS = 8  # one of so many training documents is held out for the weights
BLOCK_ROWS = 2000  # documents of a block, or
BLOCK_BYTES = 6 << 20  # bytes of text, whichever makes more blocks
SHARD_KEYS = 1_500_000
USUAL_KEYS = 300  # distinct words and pairs a document asks for, to choose the number of shards
CELLS = 8  # of a decade, in the table the weights are learned from
LEVELS = 40  # buckets of the predecessor's count: 0, 1, 2-3, 4-7, ...
LEAST = -12  # decades
ROUNDS = 200

_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
_EVEN = np.uint64(0xFFFFFFFFFFFFFFFE)
START, END = np.uint64(0x2545F4914F6CDD1E), np.uint64(0x9E6C63D0676A9A98)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of every token and of its pair with the one before, and where each text's begin. Words are even, pairs odd."""
    words, first = word_hashes(texts)
    counts = np.diff(first)
    bounds = np.concatenate([[0], np.cumsum(counts + 1)])
    own = np.full(bounds[-1], END)
    places = np.ones(bounds[-1], bool)
    places[bounds[1:] - 1] = False
    own[places] = words & _EVEN
    before = np.concatenate([[START], own[:-1]])
    before[bounds[:-1]] = START
    return own, mix(before * _PAIR + own) | np.uint64(1), bounds


def context_keys(own: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    before = np.concatenate([[START], own[:-1]])
    before[bounds[:-1]] = START
    return before


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of their bytes; small ones take little room."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as the steps between them."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


def asked(rows: pa.Table) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of the documents of a block, in an order that does not depend on how they arrive."""
    ids = rows.column("id").to_pylist()
    texts = [value.as_buffer().to_pybytes() if value.is_valid else b"" for value in rows.column("text").combine_chunks()]
    own, pair, bounds = [], [], [0]
    for start, end in blocks(texts):
        a, b, c = tokens(texts[start:end])
        own.append(a)
        pair.append(b)
        bounds += (bounds[-1] + c[1:]).tolist()
    empty = [np.empty(0, np.uint64)]
    return ids, np.concatenate(own or empty), np.concatenate(pair or empty), np.array(bounds), rows.column("learns").to_numpy(zero_copy_only=False).astype(bool)


def requests(shift: int):
    """For each shard, the block's distinct keys and how often its training documents have them."""

    def run(rows: pa.Table) -> pa.Table:
        _, own, pair, bounds, learns = asked(rows)
        lengths = np.diff(bounds)
        weight = np.repeat(learns, lengths).astype(np.float64)
        keys = np.concatenate([own, pair, [START]])
        keys, at = np.unique(keys, return_inverse=True)
        counts = np.bincount(at, np.concatenate([weight, weight, [learns.sum()]]), len(keys)).astype(np.int32)
        shard = (keys >> np.uint64(shift)).astype(np.int64) if shift < 64 else np.zeros(len(keys), np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(keys)]])
        pieces = list(zip(cuts[:-1], cuts[1:], strict=True))
        block = rows.column("block")[0].as_py()
        return pa.table(
            {
                "block": pa.array([block] * len(pieces), pa.int64()),
                "shard": pa.array([int(shard[a]) for a, _ in pieces], pa.int64()),
                "keys": pa.array([packed_keys(keys[a:b]) for a, b in pieces], pa.binary()),
                "counts": pa.array([packed(counts[a:b]) for a, b in pieces], pa.binary()),
            }
        )

    return run


def answers(rows: pa.Table) -> pa.Table:
    """The sums over all blocks, and over those of the held-out part, in the order each block asked; the row of block -1 has N, V,
    the held-out N and the number of training documents of the shard."""
    block = rows.column("block").to_numpy()
    keys = [unpacked_keys(x) for x in rows.column("keys").to_pylist()]
    counts = [unpacked(x, np.int32) for x in rows.column("counts").to_pylist()]
    every, at = np.unique(np.concatenate(keys), return_inverse=True)
    all_counts = np.concatenate(counts)
    total = np.bincount(at, all_counts, len(every)).astype(np.int64)
    held = np.bincount(at, all_counts * np.repeat(block % 2, [len(k) for k in keys]), len(every)).astype(np.int64)
    cuts = np.cumsum([0] + [len(k) for k in keys])
    words = ((every & np.uint64(1)) == 0) & (every != START)
    sums = np.array([total[words].sum(), (total[words] > 0).sum(), held[words].sum(), total[every == START].sum()], np.int64)
    held_answers = [packed(held[at[a:b]]) if odd else b"" for a, b, odd in zip(cuts[:-1], cuts[1:], block % 2, strict=True)]
    return pa.table(
        {
            "block": pa.array([*block.tolist(), -1], pa.int64()),
            "shard": pa.array([*rows.column("shard").to_pylist(), -1], pa.int64()),
            "total": pa.array([*(packed(total[at[a:b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)), packed(sums)], pa.binary()),
            "held": pa.array([*held_answers, b""], pa.binary()),
        }
    )


def looked_up(rows: pa.Table, replies: pa.Table, part: str) -> tuple:
    """For every token of a block the counts of its pair, its predecessor and itself."""
    ids, own, pair, bounds, learns = asked(rows)
    context = context_keys(own, bounds)
    keys = np.unique(np.concatenate([own, pair, [START]]))
    order = np.argsort(replies.column("shard").to_numpy(), kind="stable")
    parts = replies.column(part).to_pylist()
    counts = np.concatenate([unpacked(parts[k], np.int64) for k in order])
    return ids, bounds, learns, *(counts[np.searchsorted(keys, wanted)] for wanted in (pair, context, own))


def level(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(count.astype(np.float64))[1], LEVELS - 1)


def held_out_cells(n: int, held_n: int):
    """How many tokens of the held-out part fall in each cell of bucket and estimates, the estimates without that part."""

    def run(rows: pa.Table, replies: pa.Table) -> pa.Table:
        if not rows.num_rows or not replies.num_rows:
            return pa.table({"cell": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        _, _, _, *total = looked_up(rows, replies, "total")
        _, _, _, *held = looked_up(rows, replies, "held")
        pair, context, own = (a - b for a, b in zip(total, held, strict=True))
        with np.errstate(divide="ignore"):
            high = np.log10(pair / np.maximum(context, 1))
            low = np.log10(own / max(1, n - held_n))
        # Cell 0 is an estimate of 0; others count eighths of a decade from LEAST up.
        high, low = (np.where(np.isfinite(x), np.clip(np.rint((x - LEAST) * CELLS), 1, None), 0).astype(np.int64) for x in (high, low))
        cells, counts = np.unique((level(context).astype(np.int64) << 16) | (high << 8) | low, return_counts=True)
        return pa.table({"cell": pa.array(cells, pa.int64()), "n": pa.array(counts, pa.int64())})

    return run


def learned_weights(cells: np.ndarray, n: np.ndarray, uniform: float) -> np.ndarray:
    """Weights of the pair, word and uniform estimates in each bucket, by expectation-maximisation."""
    value = lambda c: np.where(c > 0, 10.0 ** (c / CELLS + LEAST), 0.0)
    bucket, p = cells >> 16, np.stack([value((cells >> 8) & 255), value(cells & 255), np.full(len(cells), uniform)], axis=1)
    every = np.array([0.0, 0.6, 0.4])
    out = np.tile(every, (LEVELS, 1))
    for k in range(LEVELS):
        here = bucket == k
        weights = np.array([0.5, 0.4, 0.1]) if k else every.copy()
        if here.any():
            for _ in range(ROUNDS):
                share = weights * p[here]
                share *= (n[here] / share.sum(axis=1))[:, None]
                new = share.sum(axis=0) / n[here].sum()
                new = np.maximum(new, [0.0, 1e-6, 1e-6])  # what the held-out part lacks stays possible
                new /= new.sum()
                if np.abs(new - weights).max() < 1e-9:
                    break
                weights = new
        out[k] = weights
    return out


def scored(weights: np.ndarray, n: int, v: int):
    def run(rows: pa.Table, replies: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), **{name: pa.array([], kind) for name, kind in NAMES.items()}})
        ids, bounds, _, pair, context, own = looked_up(rows, replies, "total")
        each = weights[level(context)]
        p = each[:, 0] * (pair / np.maximum(context, 1)) + each[:, 1] * (own / max(1, n)) + each[:, 2] / (v + 1)
        starts = bounds[:-1]
        sums = lambda x: np.add.reduceat(x, starts)
        base = np.log10(own + 1) - (math.log10(n + (v + 1)))
        values = {"n_tokens": np.diff(bounds), "n_known": sums((own > 0).astype(np.int64)), "base_score": sums(base), "score": sums(np.log10(p))}
        return pa.table({"id": pa.array(ids, pa.int64()), **{name: pa.array(values[name], kind) for name, kind in NAMES.items()}})

    return run


NAMES = {"n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}


def dealt(docs: DataFrame, id_col: str, text_col: str, n_blocks: int) -> DataFrame:
    """The documents with their block; odd blocks are the held-out part. Blocks and parts are dealt by a hash of id and text, so rows that
    share an id, or have none, are spread like all others; only rows equal in both share a block."""
    id_, text = F.col(id_col).cast("long"), F.col(text_col).cast("binary")
    learns = F.coalesce(training(id_, *HELD_OUT), F.lit(False))
    fold = F.when(learns & (F.pmod(F.xxhash64(F.lit("fold"), id_, text), F.lit(FOLDS)) == 0), F.lit(1)).otherwise(F.lit(0))
    block = F.pmod(F.xxhash64(F.lit("block"), id_, text), F.lit(n_blocks)) * 2 + fold
    return docs.select(id_.alias("id"), text.alias("text"), learns.alias("learns"), block.alias("block"))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of each document."""
    size = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("bytes")).first()
    n_docs = size["n"]
    n_blocks = max(n_docs // BLOCK_ROWS, size["bytes"] // BLOCK_BYTES) + 1
    bits = max(0, math.ceil(math.log2(max(1, n_docs * USUAL_KEYS / SHARD_KEYS))))
    rows = dealt(docs, id_col, text_col, n_blocks)

    sent = rows.groupBy("block").applyInArrow(requests(64 - bits), "block long, shard long, keys binary, counts binary")
    replies = materialize(sent.groupBy("shard").applyInArrow(answers, "block long, shard long, total binary, held binary"), "replies")
    sums = [unpacked(row["total"], np.int64) for row in replies.where("block = -1").select("total").toLocalIterator()]  # four numbers a shard
    n, v, held_n, _ = (int(x) for x in sum(sums, np.zeros(4, np.int64)))

    by_block = lambda frame: frame.groupBy("block")
    replies = replies.where("block >= 0")
    held = by_block(rows.where("block % 2 = 1")).cogroup(by_block(replies.where("block % 2 = 1")))
    cells = held.applyInArrow(held_out_cells(n, held_n), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()  # of bounded size
    weights = learned_weights(np.array([r["cell"] for r in cells], np.int64), np.array([r["n"] for r in cells], np.float64), 1 / (v + 1))

    out = by_block(rows).cogroup(by_block(replies.drop("held"))).applyInArrow(scored(weights, n, v), "id long, n_tokens long, n_known long, base_score double, score double")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce(~training(F.col("id"), *HELD_OUT), F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query op5: scores of every document."""
    return score(table(spark, sf_dir, "documents"))
