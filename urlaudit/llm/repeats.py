"""Removal of long repeated byte strings by column-wise construction of a collection's Burrows-Wheeler order.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else. Each such window is known by its anchor, the
place of the least hash of ``GRAM`` bytes inside it; equal windows have equal anchors at the same offset, so only windows of one
anchor hash need to meet. Neighbouring windows with the same anchor are one context string, at most ``2 * LENGTH`` bytes long.

Contexts that occur twice as a whole are settled by their hashes. The different contexts of an anchor that others share form a
collection of short strings, aligned on the anchor. It is built column by column from the right: each round puts one symbol before
every string, the new order is the stable sort of the last by the new symbol (the Burrows-Wheeler step), and the common prefix of
neighbours grows by one where symbols agree, else starts anew. Suffixes in different columns are never equal windows, so a round
merges with its own column only and takes time in proportion to the number of strings. The columns lie in an external file that is
written once and read sequentially. Where a common prefix reaches ``LENGTH``, both neighbours' windows are repeated.

Work moves by anchor, so a passage that many documents share spreads over its anchors; equal contexts are combined before they
move. Anchors with more than ``HOT`` different contexts are cut once more, by the hash of each window, which is exact and bounded.

Rows are told apart by 80 bits: a hash of id and text, and a checksum of the text. Only rows that repeat an id and its text share
them, and what goes from one of these goes from all; what was found for them is kept once.

Texts are whole UTF-8 byte strings; a null one is empty. Matches never cross documents. Repeated rows are documents of their own,
also if they share an id or have none. Texts of less than ``LENGTH`` bytes lose nothing, an empty table gives an empty result. Columns other than
``id`` and ``text`` are ignored.
"""

from __future__ import annotations

import tempfile
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urlaudit.llm.common import table
from urlaudit.llm.hashing import _power_tables, blocks, mix
from urlaudit.session import materialize, scratch_tables

LENGTH = 200
GRAM = 32
HOT = 50_000
TASK_CONTEXTS = 20_000
BLOCK = 1 << 20  # bytes that are hashed together
PIECE = 1 << 24  # a longer text is hashed in pieces that share LENGTH bytes
NONE = 256  # a column where a string has no byte


def bytes_of(column) -> list[bytes]:
    return [value.as_buffer().to_pybytes() if value.is_valid else b"" for value in column]


def tag(text: bytes) -> int:
    """Sixteen bits that tell apart texts under one key."""
    return zlib.crc32(text) & 0xFFFF


def tag_of_place() -> Column:
    return F.col("place").bitwiseAND(0xFFFF).cast("int")


def same_text() -> Column:
    """Joins documents with what was found for their key and tag, which here comes from the same checksum."""
    return (F.col("key") == F.col("_key")) & (F.crc32("bytes").bitwiseAND(0xFFFF).cast("int") == F.col("_tag"))


def running_hash(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = _power_tables(len(data))
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return total, down


def between(total: np.ndarray, down: np.ndarray, starts: np.ndarray, lengths) -> np.ndarray:
    """Hashes of the byte strings that begin at ``starts``."""
    return mix((total[starts + lengths] - total[starts]) * down[starts])


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring values, by doubling."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[: len(values) - span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def contexts(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """The contexts of texts: number of the text, first window, number of windows, offset and hash of the anchor, hash of the whole.

    Bytes of all texts lie side by side; windows that would cross from one to the next are left out."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    if not (sizes >= length).any():
        return tuple(np.empty(0, kind) for kind in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    total, down = running_hash(data)
    hashes = between(total, down, np.arange(len(data) - gram + 1), gram)
    # Least by the upper bits of the hash, then by place: what a window's anchor is depends on the window's bytes alone.
    place = np.uint64((1 << 25) - 1)
    least = window_minima((hashes & ~place) | np.arange(len(hashes), dtype=np.uint64), length - gram + 1)
    own = np.ones(len(least), bool)
    for end in begins[1:-1].tolist():
        own[max(0, end - length + 1) : end] = False
    windows = np.flatnonzero(own)
    anchors = (least[windows] & place).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (windows[1:] != windows[:-1] + 1)]))
    count = np.diff(np.append(first, len(windows)))
    start, anchor = windows[first], anchors[first]
    offset = anchor - start
    text = np.searchsorted(begins, start, side="right") - 1
    whole = between(total, down, start, count - 1 + length)
    whole = mix(whole + (offset.astype(np.uint64) << np.uint64(20)) + count.astype(np.uint64))
    return text, start - begins[text], count, offset, hashes[anchor], whole


def pieces(texts: list[bytes], length: int) -> tuple[list[int], list[int], list[bytes]]:
    """Texts cut to at most ``PIECE`` bytes, with all windows: number and place of each piece, and the piece."""
    number, place, out = [], [], []
    for k, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), PIECE - length):
            number.append(k)
            place.append(at)
            out.append(text[at : at + PIECE - 1])
    return number, place, out


def packed(start, count, offset, text):
    """Place of a context in a long: 31 bits of its start, 8 of its windows, 8 of its anchor, 16 of its text's hash."""
    return (start << 32) | ((count - 1) << 24) | (offset << 16) | text


def all_contexts(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``key``, ``place``, ``anchor`` and ``whole`` of each context of ``key`` and ``bytes``."""

    def run(batches):
        for batch in batches:
            texts = bytes_of(batch.column(1))
            tags = np.array([tag(t) for t in texts], np.int64)
            number, at, cut = pieces(texts, length)
            number, at = np.array(number, np.int64), np.array(at, np.int64)
            for a, b in blocks(cut, BLOCK):
                text, start, count, offset, anchor, whole = contexts(cut[a:b], length, gram)
                if len(text):
                    owner = number[a:b][text]
                    place = packed(start + at[a:b][text], count, offset, tags[owner])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(owner)), pa.array(place), pa.array(anchor.view(np.int64)), pa.array(whole.view(np.int64))], ["key", "place", "anchor", "whole"]
                    )

    return docs.select("key", "bytes").mapInArrow(run, "key long, place long, anchor long, whole long")


def column_file(strings: list[bytes], offsets: np.ndarray, length: int, gram: int):
    """An external file with the strings' symbols column by column, the last first; a string's anchor is in a fixed column, and
    where it has no byte there is a mark of its own."""
    left = length - gram
    symbols = np.full((len(strings), left + length), NONE, np.uint16)
    for k, (string, offset) in enumerate(zip(strings, offsets.tolist(), strict=True)):
        symbols[k, left - offset : left - offset + len(string)] = np.frombuffer(string, np.uint8)
    out = tempfile.TemporaryFile()
    for column in range(left + length - 1, -1, -1):
        out.write(np.ascontiguousarray(symbols[:, column]).tobytes())
    out.seek(0)
    return out


def repeated_windows(strings: list[bytes], offsets: np.ndarray, length: int, gram: int) -> np.ndarray:
    """For each string and each column a window may start in, whether another string has the same window there."""
    n, left = len(strings), length - gram
    found = np.zeros((n, left + 1), bool)
    order, prefix = np.arange(n), np.zeros(n + 1, np.int32)  # prefix[k]: of the strings k - 1 and k of the order
    with column_file(strings, offsets, length, gram) as columns:
        for column in range(left + length - 1, -1, -1):
            symbols = np.frombuffer(columns.read(2 * n), np.uint16)[order]
            sort = np.argsort(symbols, kind="stable")
            # Two neighbours of the new order with the same symbol share one more than the least between them in the old order.
            between_ = np.minimum.reduceat(prefix, sort + 1)
            order, symbols = order[sort], symbols[sort]
            prefix = np.zeros(n + 1, np.int32)
            same = (symbols[1:] == symbols[:-1]) & (symbols[1:] != NONE)
            prefix[1:n][same] = between_[:-1][same] + 1
            if column <= left:
                equal = np.flatnonzero(prefix[1:n] >= length)
                found[order[equal], column] = found[order[equal + 1], column] = True
    return found


def compared(length: int, gram: int):
    """Runs of repeated windows of the contexts that occur once, among the contexts of their anchors."""

    def run(rows: pa.Table) -> pa.Table:
        place = rows.column("place").to_numpy()
        strings = bytes_of(rows.column("string").combine_chunks())
        offset, single = (place >> 16) & 255, rows.column("n").to_numpy() == 1
        found = repeated_windows(strings, offset, length, gram)
        count = ((place >> 24) & 255) + 1
        column = np.arange(found.shape[1])[None, :] - (length - gram - offset)[:, None]
        found &= (column >= 0) & (column < count[:, None]) & single[:, None]
        edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        (row, begin), end = np.nonzero(edge == 1), np.nonzero(edge == -1)[1]
        start = (place[row] >> 32) + begin - (length - gram - offset[row])
        return pa.table(
            {"key": rows.column("key").take(pa.array(row)), "tag": pa.array((place[row] & 0xFFFF).astype(np.int32)), "start": pa.array(start), "windows": pa.array((end - begin).astype(np.int64))}
        )

    return run


def single_windows(length: int, gram: int):
    """One row for each window of a context: its place and a hash of its anchor, column and bytes."""

    def run(batches):
        for batch in batches:
            keys, places, anchors, strings = (batch.column(k) for k in range(4))
            for k, string in enumerate(bytes_of(strings)):
                total, down = running_hash(np.frombuffer(string, np.uint8))
                place, windows = places[k].as_py(), np.arange(len(string) - length + 1)
                window = mix(between(total, down, windows, length) + np.uint64(anchors[k].as_py() % (1 << 64)) + (windows - ((place >> 16) & 255)).astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([keys[k].as_py()] * len(windows), pa.int64()),
                        pa.array([place & 0xFFFF] * len(windows), pa.int32()),
                        pa.array((place >> 32) + windows),
                        pa.array(window.view(np.int64)),
                    ],
                    ["key", "tag", "start", "window"],
                )

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Runs of repeated windows of ``key`` and ``bytes``: ``key``, ``tag`` of the text, ``start`` and number of ``windows``."""
    with scratch_tables(docs.sparkSession) as lasting:
        with scratch_tables(docs.sparkSession) as wider:
            found = materialize(all_contexts(docs, length, gram), "contexts")
            kinds = found.groupBy("anchor", "whole").agg(F.count("*").alias("n"), F.min("key").alias("key"), F.min("place").alias("place"))
            kinds = materialize(kinds, "kinds")  # key and place are of one context where n is 1
            settled = lasting(found.join(kinds.where("n > 1").select("anchor", "whole"), ["anchor", "whole"], "left_semi"), "settled")

            shared = kinds.groupBy("anchor").agg(F.count("*").alias("contexts")).where("contexts > 1")
            once = kinds.where("n = 1").select("anchor", "key", "place", F.lit(1).alias("n")).join(shared, "anchor")
            # One occurrence of each context that is settled; combined before the join, so that an anchor in a third of the documents
            # brings one row for each of its contexts.
            often = settled.groupBy("anchor", "whole").agg(F.min(F.struct("key", "place")).alias("least"))
            often = often.select("anchor", "least.key", "least.place", F.lit(2).alias("n")).join(shared, "anchor")
            open_ = wider(once.unionByName(often), "open")

        # A list holds contexts of one text.
        wanted = open_.groupBy(F.col("key").alias("_key"), tag_of_place().alias("_tag")).agg(F.collect_list(F.struct("anchor", "place", "n", "contexts")).alias("wanted"))
        strings = lasting(docs.join(wanted, same_text(), "inner").select("key", "bytes", "wanted").mapInArrow(cut_out(length), STRINGS), "strings")
    tasks = strings.where(F.col("contexts") <= HOT).count() // TASK_CONTEXTS + 1
    few = strings.where(F.col("contexts") <= HOT).withColumn("task", F.pmod(F.xxhash64("anchor"), F.lit(tasks)))
    runs = "key long, tag int, start long, windows long"
    partly = few.groupBy("task").applyInArrow(compared(length, gram), runs)
    many = strings.where(F.col("contexts") > HOT).select("key", "place", "anchor", "string").mapInArrow(single_windows(length, gram), "key long, tag int, start long, window long")
    twice = many.groupBy("window").agg(F.count("*").alias("n")).where("n > 1")
    partly = partly.unionByName(many.join(twice, "window", "left_semi").select("key", "tag", "start", F.lit(1).cast("long").alias("windows")))
    place = F.col("place")
    wholly = settled.select(
        "key",
        tag_of_place().alias("tag"),
        F.shiftright(place, 32).alias("start"),
        (F.shiftright(place, 24).bitwiseAND(255) + 1).alias("windows"),
    )
    return partly.unionByName(wholly)


def listed(spans: DataFrame) -> DataFrame:
    """Runs of each key and tag, each run once, so that rows that repeat an id and its text do not add up."""
    return spans.groupBy(F.col("key").alias("_key"), F.col("tag").alias("_tag")).agg(F.collect_set(F.struct("start", "windows")).alias("runs"))


STRINGS = "key long, place long, anchor long, n int, contexts long, string binary"


def cut_out(length: int):
    """The strings of the contexts that are wanted of each document; of rows that repeat an id and its text, of one in a task."""

    def run(batches):
        seen = set()
        for batch in batches:
            for key, text, rows in zip(batch.column(0).to_pylist(), bytes_of(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                if (key, tag(text)) in seen:
                    continue
                seen.add((key, tag(text)))
                ends = [(w["place"] >> 32, (w["place"] >> 32) + ((w["place"] >> 24) & 255) + length) for w in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key] * len(rows), pa.int64()),
                        pa.array([w["place"] for w in rows], pa.int64()),
                        pa.array([w["anchor"] for w in rows], pa.int64()),
                        pa.array([w["n"] for w in rows], pa.int32()),
                        pa.array([w["contexts"] for w in rows], pa.int64()),
                        pa.array([text[a:b] for a, b in ends], pa.binary()),
                    ],
                    ["key", "place", "anchor", "n", "contexts", "string"],
                )

    return run


def without(text: bytes, runs: list[dict], length: int, whole_characters: bool) -> tuple[bytes, list[dict]]:
    """The bytes that stay and the maximal runs that go."""
    if not runs:
        return text, []
    starts = np.array([r["start"] for r in runs], np.int64)
    ends = starts + np.array([r["windows"] for r in runs], np.int64) - 1 + length
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate([[True], starts[1:] > ends[:-1]])
    begins, stops = starts[first].tolist(), ends[np.append(first[1:], True)].tolist()
    if whole_characters:  # bytes of a character that is cut stay
        inside = lambda at: at < len(text) and text[at] & 0xC0 == 0x80
        for k in range(len(begins)):
            while inside(begins[k]):
                begins[k] += 1
            while inside(stops[k]):
                stops[k] -= 1
    kept, at = [], 0
    for begin, stop in zip(begins, stops, strict=True):
        kept.append(text[at:begin])
        at = max(at, stop)
    kept.append(text[at:])
    return b"".join(kept), [{"start": a, "end": b} for a, b in zip(begins, stops, strict=True)]


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, whole_characters: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``id``, ``n_bytes``, the bytes ``kept`` and the ``spans`` that were removed of each document, and its columns ``keep``.

    ``whole_characters`` lets bytes stay whose character is only partly covered."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("bytes"), *[F.col(name).alias(f"_keep_{name}") for name in keep]
    )
    rows = rows.withColumn("key", F.xxhash64("doc_id", "bytes"))
    runs = listed(repeated_spans(rows.select("key", "bytes"), length, gram))

    def run(batches):
        for batch in batches:
            texts = bytes_of(batch.column(1))
            out = [without(t, found or [], length, whole_characters) for t, found in zip(texts, batch.column(2).to_pylist(), strict=True)]
            spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([kept for kept, _ in out], pa.binary()), pa.array([s for _, s in out], spans), *batch.columns[3:]],
                [id_col, "n_bytes", "kept", "spans", *keep],
            )

    joined = rows.join(runs, same_text(), "left").select("doc_id", "bytes", "runs", *[f"_keep_{name}" for name in keep])
    kinds = "".join(f", `{name}` {docs.schema[name].dataType.simpleString()}" for name in keep)
    return joined.mapInArrow(run, f"`{id_col}` long, n_bytes long, kept binary, spans array<struct<start:bigint,end:bigint>>{kinds}")


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query op1: what is left of every document."""
    span = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    rows = remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", span.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
