"""Importance resampling towards a target distribution over hashed n-grams, with text counted once for each distinct line.

Features are runs of one to three words, hashed into buckets. Newlines never lie inside a word, so a text falls into lines, and its
features are those inside its lines and those that cross a line's end. Lines are gathered over the whole corpus with the number of
their occurrences; features of a distinct line are computed once and multiplied by that number. Runs that cross lines need at most
the two words beside each line's end, and are added separately. A line of more than ``SEGMENT`` bytes is cut further between words,
which moves runs from the first kind to the second and changes no sum. Weights of documents are found the same way, by the distinct
lines of a block.

The CRC-32 of a run comes from those of its words: appending bytes is linear in the checksum before them, so runs are joined by
table look-ups over whole arrays and their bytes are never put together.

What is shuffled: distinct lines (combined before the shuffle) and at most ``BUCKETS`` counts a task; then one narrow row a document
for the ranking, which is cut into ranges. The bucket gains, a table of fixed size, go to every task.

Defined cases: a null or empty text has no words, no features and weight 0; it is ranked if ``min_words`` is 0. A document without an
id draws its noise from an empty id and comes last among equal scores. Repeated rows count each and are drawn each; rows equal in
all that is returned but the rank share the ranks among them. An empty table gives an empty result, an empty target makes every
count of it 0. Columns other than ``id`` and ``text`` are ignored. A text is worked on in blocks, whatever its length.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlaudit.llm.common import table
from urlaudit.operators.skew import ordered_run
from urlaudit.session import materialize

BUCKETS = 10_000
LONGEST_RUN = 3
SEGMENT = 1 << 16  # bytes of a line beyond which it is cut between words
BLOCK = 1 << 20  # bytes of text that are worked on together
SHARE, MIN_WORDS, SEED = 5, 20, 42  # percent to draw, words a document must have, noise

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")


def _one_byte() -> np.ndarray:
    """CRC-32 of each byte value, the table of the checksum."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320), np.uint32(0)) ^ (table >> np.uint32(1))
    return table


_TABLE = _one_byte()
_SPACE = np.uint32(zlib.crc32(b" "))
_NEAR = 64


def _look_up(tables: np.ndarray, base, crc: np.ndarray) -> np.ndarray:
    low, high = crc & np.uint32(255), crc >> np.uint32(24)
    second, third = (crc >> np.uint32(8)) & np.uint32(255), (crc >> np.uint32(16)) & np.uint32(255)
    return tables[base + low] ^ tables[base + 256 + second] ^ tables[base + 512 + third] ^ tables[base + 768 + high]


@cache
def _near_tables() -> np.ndarray:
    """What appending 0 to 63 bytes makes of each byte of a checksum, 1024 entries a number of bytes."""
    state = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).ravel()
    out = []
    for _ in range(_NEAR):
        out.append(state)
        state = _TABLE[state & np.uint32(255)] ^ (state >> np.uint32(8))
    return np.concatenate(out)


@cache
def _far_table(bit: int) -> np.ndarray:
    """The same for 64 times 2 to the ``bit`` bytes."""
    if bit == 0:
        last = _near_tables()[-1024:]
        return _TABLE[last & np.uint32(255)] ^ (last >> np.uint32(8))
    half = _far_table(bit - 1)
    return _look_up(half, 0, half)


def shifted(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The part of a checksum that comes from the bytes before, once ``size`` more have been appended."""
    crc = _look_up(_near_tables(), (size % _NEAR) * 1024, crc)
    rest = size // _NEAR
    if len(rest):
        for bit in range(int(rest.max()).bit_length()):
            at = np.flatnonzero((rest >> bit) & 1)
            crc[at] = _look_up(_far_table(bit), 0, crc[at])
    return crc


def words_of(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC-32 and bytes of the words of lower-case segments, and where each segment's words begin (one more entry)."""
    joined = b"\n".join([b"", *segments, b""])
    data = np.frombuffer(joined, np.uint8)
    inside = _WORD[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, size = edges[0::2], edges[1::2] - edges[0::2]
    bounds = np.cumsum([1, *(len(segment) + 1 for segment in segments)])
    crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    live = np.flatnonzero(size <= _NEAR)
    for k in range(_NEAR):
        live = live[size[live] > k]
        if not len(live):
            break
        now = crc[live]
        crc[live] = _TABLE[(now ^ data[starts[live] + k]) & np.uint32(255)] ^ (now >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for word in np.flatnonzero(size > _NEAR):
        crc[word] = zlib.crc32(joined[starts[word] : starts[word] + size[word]])
    return crc, size, np.searchsorted(starts, bounds)


def runs(crc: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """CRC-32 of every one, two and three neighbouring words joined by spaces; entry i is the run that ends at word i (+ 0, 1, 2)."""
    out, spaced = [crc], shifted(np.full(len(crc), _SPACE), size) ^ crc
    for width in range(1, LONGEST_RUN):
        out.append(shifted(out[-1][:-1], size[width:] + 1) ^ spaced[width:] if len(crc) > width else np.empty(0, np.uint32))
    return out


def segments_of(text: bytes) -> Iterator[bytes]:
    """The lower-case lines of a text, long ones cut between words."""
    for line in text.translate(_LOWER).split(b"\n"):
        start = 0
        while len(line) - start > SEGMENT and (gap := _GAP.search(line, start + SEGMENT)):
            yield line[start : gap.start()]
            start = gap.start()
        yield line[start:] if start else line


def segment_blocks(texts: list[str | None]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Segments of many texts with the number of their text, in blocks of about ``BLOCK`` bytes."""
    segments: list[bytes] = []
    owners: list[int] = []
    size = 0
    for number, text in enumerate(texts):
        for segment in segments_of((text or "").encode("utf-8", "surrogatepass")):
            if size and size + len(segment) > BLOCK:
                yield segments, np.array(owners)
                segments, owners, size = [], [], 0
            segments.append(segment)
            owners.append(number)
            size += len(segment) + 1
    if segments:
        yield segments, np.array(owners)


def distinct(segments: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    seen: dict[bytes, int] = {}
    places = np.fromiter((seen.setdefault(segment, len(seen)) for segment in segments), np.int64, len(segments))
    return list(seen), places


def inner_runs(crc: np.ndarray, size: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and segments of the runs that lie inside a segment."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for width, values in enumerate(runs(crc, size)):
        whole = owner[width:] == owner[: len(owner) - width] if width else slice(None)
        yield (values[whole] % BUCKETS).astype(np.int64), owner[width:][whole]


class Crossing:
    """Runs over the ends of segments, carried from block to block by the last two words seen."""

    def __init__(self):
        self.crc, self.size, self.text = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def runs(self, words: tuple, places: np.ndarray, owners: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Buckets and texts of the runs of a block that cross segments. ``places`` are its segments among the distinct ones."""
        crc, size, first = words
        count = np.diff(first)[places]
        near = np.minimum(count, 2 * (LONGEST_RUN - 1))  # the words beside the ends; of short segments all
        held = np.repeat(np.arange(len(places)), near)
        nth = np.arange(len(held)) - np.repeat(np.cumsum(near) - near, near)
        from_end = (nth >= LONGEST_RUN - 1) & (count[held] > near[held])
        at = first[places][held] + np.where(from_end, count[held] - near[held] + nth, nth)
        crc, size = np.concatenate([self.crc, crc[at]]), np.concatenate([self.size, size[at]])
        segment = np.concatenate([np.full(len(self.crc), -1), held])
        text = np.concatenate([self.text, owners[held]])
        for width, values in enumerate(runs(crc, size)):
            if width:
                back = len(crc) - width
                crosses = (segment[width:] != segment[: max(back, 0)]) & (text[width:] == text[: max(back, 0)])
                yield (values[crosses] % BUCKETS).astype(np.int64), text[width:][crosses]
        self.crc, self.size, self.text = crc[1 - LONGEST_RUN :], size[1 - LONGEST_RUN :], text[1 - LONGEST_RUN :]


def _counted(total: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])


def _distinct_lines(batches):
    """Lines of a block with the number of their occurrences."""
    for batch in batches:
        for segments, _ in segment_blocks(batch.column(0).to_pylist()):
            lines, places = distinct(segments)
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary()), pa.array(np.bincount(places), pa.int64())], ["line", "n"])


def _line_counts(batches):
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        lines, times = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        start = size = 0
        for end in range(1, len(lines) + 1):
            size += len(lines[end - 1]) + 1
            if size >= BLOCK or end == len(lines):
                for bucket, owner in inner_runs(*words_of(lines[start:end])):
                    total += np.bincount(bucket, times[start:end][owner], BUCKETS).astype(np.int64)
                start, size = end, 0
    yield _counted(total)


def _crossing_counts(batches):
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        crossing = Crossing()
        for segments, owners in segment_blocks(batch.column(0).to_pylist()):
            lines, places = distinct(segments)
            for bucket, _ in crossing.runs(words_of(lines), places, owners):
                total += np.bincount(bucket, minlength=BUCKETS)
    yield _counted(total)


def bucket_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``bucket`` and ``n``: how often the features of all texts fall into each bucket; buckets without any are left out."""
    texts = docs.select(text_col)
    lines = texts.mapInArrow(_distinct_lines, "line binary, n long").groupBy("line").agg(F.sum("n").alias("n"))
    inside = lines.mapInArrow(_line_counts, "bucket int, n long")
    across = texts.mapInArrow(_crossing_counts, "bucket int, n long")
    return inside.unionByName(across).groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: DataFrame, target: DataFrame) -> np.ndarray:
    """Of every bucket, a thousand times the logarithm of how much likelier the target makes it, one added to each count, rounded down.

    Both tables hold at most ``BUCKETS`` rows, and so does what comes to the driver."""
    both = raw.withColumnRenamed("n", "s").join(target.withColumnRenamed("n", "t"), "bucket", "full").fillna(0, ["s", "t"])
    rows = both.toArrow()
    bucket, s, t = (rows.column(name).to_numpy() for name in ("bucket", "s", "t"))
    own, wanted = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    own[bucket], wanted[bucket] = s, t
    total, total_wanted = float(own.sum()), float(wanted.sum())
    ratio = (wanted + 1.0) * (total + BUCKETS) / ((own + 1.0) * (total_wanted + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n_words``, ``n_features`` and ``weight``, the sum of the gains of all features of a text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            n_words, weight, crossing = np.zeros(n, np.int64), np.zeros(n, np.int64), Crossing()
            for segments, owners in segment_blocks(batch.column(1).to_pylist()):
                lines, places = distinct(segments)
                words = words_of(lines)
                n_words += np.bincount(owners, np.diff(words[2])[places], n).astype(np.int64)
                of_line = np.zeros(len(lines), np.int64)
                for bucket, owner in inner_runs(*words):
                    of_line += np.bincount(owner, gains[bucket], len(lines)).astype(np.int64)
                weight += np.bincount(owners, of_line[places], n).astype(np.int64)
                for bucket, text in crossing.runs(words, places, owners):
                    weight += np.bincount(text, gains[bucket], n).astype(np.int64)
            n_features = sum(np.maximum(n_words - width, 0) for width in range(LONGEST_RUN))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(a, pa.int64()) for a in (n_words, n_features, weight))], [id_col, "n_words", "n_features", "weight"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_words long, n_features long, weight long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    share: int = SHARE,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id``, ``n_features``, ``weight``, ``score`` and ``rank``: of the documents with enough words, ``share`` percent are drawn without
    replacement, in proportion to their importance, by the greatest of weight and Gumbel noise; the others have no rank."""
    gains = bucket_gains(bucket_counts(docs, text_col), bucket_counts(target, text_col))
    noise_key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    noise = (F.conv(F.substring(noise_key, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    score = F.col("weight") + F.floor(-1000.0 * F.log(-F.log(noise))).cast("long")
    weighed = weigh(docs, gains, id_col, text_col).withColumn("score", score).withColumn("_enough", F.col("n_words") >= min_words)
    weighed = materialize(weighed, "weighed")
    drawn = weighed.where("_enough").count() * share // 100
    order = [F.desc("_enough"), F.desc("score"), F.asc_nulls_last(id_col), F.asc("n_words"), F.asc("weight")]
    numbered = ordered_run(weighed, [], order, number="rank")
    taken = F.col("_enough") & (F.col("rank") <= drawn)
    return numbered.select(id_col, "n_features", "weight", "score", F.when(taken, F.col("rank")).alias("rank"), "n_words")


def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query op13: all documents resampled towards the texts of the benchmark."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The checksum is computed by half bytes; a distinct feature once.
ORACLE = r"""
WITH nibbles AS (
  SELECT list(c ORDER BY v) AS tab FROM (
    SELECT v, list_reduce(list_prepend(v, [0, 0, 0, 0]), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(16))::BIGINT AS v))
), texts AS (
  SELECT doc_id, FALSE AS wanted, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT NULL, TRUE, coalesce(text, '') FROM benchmark
), parts AS (
  SELECT row_number() OVER () AS nr, doc_id, wanted,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts
), runs AS (
  SELECT nr, array_to_string(w[i:i + n - 1], ' ') AS feature
  FROM parts, unnest(range(1, 4)) AS a(n), unnest(range(1, len(w) - n + 2)) AS t(i)
), features AS (
  SELECT nr, feature, count(*) AS times FROM runs GROUP BY nr, feature
), hashed AS (
  SELECT feature, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(feature) * 2), lambda k:
      strpos('0123456789ABCDEF', substr(code, (k + 1 - 2 * (k % 2) + 1)::INT, 1)) - 1)),
    lambda c, x: xor(c >> 4, tab[(xor(c, x) & 15) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT feature, hex(encode(feature)) AS code FROM (SELECT DISTINCT feature FROM features)), nibbles
), counted AS (
  SELECT bucket, coalesce(sum(times) FILTER (NOT wanted), 0)::DOUBLE AS s, coalesce(sum(times) FILTER (wanted), 0)::DOUBLE AS t
  FROM features JOIN hashed USING (feature) JOIN parts USING (nr) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM counted) + 10000) / ((s + 1) * ((SELECT sum(t) FROM counted) + 10000))))::BIGINT AS gain
  FROM counted
), weights AS (
  SELECT nr, sum(times * gain)::BIGINT AS weight FROM features JOIN hashed USING (feature) JOIN gains USING (bucket) GROUP BY nr
), scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, (greatest(len(w), 0) + greatest(len(w) - 1, 0) + greatest(len(w) - 2, 0))::BIGINT AS n_features,
    coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM parts LEFT JOIN weights USING (nr) WHERE NOT wanted
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS able FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * able // 100 THEN place END AS rank, n_words FROM placed
"""
