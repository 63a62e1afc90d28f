"""Near-duplicate texts by a MinHash LSH forest over word n-grams, with exact verification.

Every text has a label of several minimum hashes in each of a number of prefix tries. Two texts meet in a trie if their labels
agree on a prefix; the prefix is shortened from full depth until texts of the threshold's similarity meet in some trie with the
target probability. Texts that meet are first compared by one byte of each minimum hash, far below the threshold; what remains is
joined into clusters, and inside a cluster all pairs are compared by their whole sets of n-grams.

Copies, that is texts of equal words, are one class and compared once. Prefixes that one class alone has are dropped before
signatures are joined, and only texts in clusters are read again. Large prefix groups and clusters are cut into blocks and each two
blocks are a unit of work, so pairs are never gathered: tasks return the links of each class and a forest of links.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; a text of fewer words than an n-gram has one n-gram of all its words.
Rows are numbered once, in a written table, and classes are known by the least number of their rows; ids are only reported beside
it, so rows without an id and different texts under one id are compared like all others.

Defined cases: a null or empty text, or one without a word, links with nothing and is kept. Repeated rows are copies of each other.
Of a component the rows with its smallest id are ``kept``; a row without an id is not, as in SQL. ``first`` is one row of each
component, of the smallest id if any row has one. Classes and components without an id have none to report. An empty table gives an empty result. Columns other than ``id`` and ``text`` are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlaudit.llm.common import table
from urlaudit.llm.components import Links, blocks_of, components, segments
from urlaudit.llm.hashing import digests, mix, read_in_blocks, shingles, word_hashes
from urlaudit.session import materialize, scratch_tables

WORDS = 5  # of an n-gram
THRESHOLD = 0.8
TRIES = 24
DEPTH = 8  # minimum hashes of a full label
TARGET = 0.9995  # probability that a pair at the threshold meets
SLACK = 6.0  # standard deviations below the threshold at which signatures still let a pair pass
BLOCK = 512  # classes of a group that are compared at once with as many others
TASK_ROWS = 2_000
TASK_BYTES = 4 << 20


def recall(depth: int, tries: int, similarity: float) -> float:
    """The probability that two texts agree on a prefix of this depth in some trie."""
    return 1 - (1 - similarity**depth) ** tries


def matched_depth(depth: int, tries: int, similarity: float, target: float) -> int:
    """The longest prefix that reaches the target recall, found by shortening the full label."""
    while depth > 1 and recall(depth, tries, similarity) < target:
        depth -= 1
    return depth


def signature(hashes: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """``n`` minimum hashes of each non-empty set."""
    random = np.random.default_rng(20_011)
    odd, shift = random.integers(0, 2**32, n, dtype=np.uint32) | np.uint32(1), random.integers(0, 2**32, n, dtype=np.uint32)
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((n, len(bounds) - 1), np.uint32)
    for k in range(n):
        value = low * odd[k]
        value += shift[k]
        value ^= value >> np.uint32(15)
        out[k] = np.minimum.reduceat(value, bounds[:-1])
    return out.T


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """The rows with a unique number each, written so that a number stays with its row."""
    return materialize(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")


def signed(docs: DataFrame, width: int, tries: int, depth: int) -> DataFrame:
    """``row``, ``doc_id``, ``key`` of the word sequence, ``prefixes`` (one hash for each trie) and ``sketch`` (a byte of each minimum hash)."""

    def run(batches):
        for rows, some in (found for batch in batches for found in read_in_blocks(batch, 2)):
            keys = digests(*word_hashes(some))
            hashes, bounds = shingles(some, width)
            have = np.flatnonzero(np.diff(bounds))
            prefixes, sketches = [None] * len(some), [None] * len(some)
            if len(have):
                least = signature(hashes, np.append(bounds[have], bounds[-1]), tries * depth)
                label = np.zeros((len(have), tries), np.uint64)
                for level in range(depth):
                    label = mix(label + least[:, level::depth].astype(np.uint64) + np.uint64(1))
                for at, label_row, sketch_row in zip(have.tolist(), label.view(np.int64), least.astype(np.uint8), strict=True):
                    prefixes[at], sketches[at] = label_row, sketch_row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(keys, pa.binary()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                ["row", "doc_id", "key", "prefixes", "sketch"],
            )

    rows = docs.select("row", "doc_id", F.col("text").cast("binary"))
    return rows.mapInArrow(run, "row long, doc_id long, key binary, prefixes array<long>, sketch binary")


def _columns(rows: pa.Table, *names: str) -> list[np.ndarray]:
    return [rows.column(name).combine_chunks().to_numpy(zero_copy_only=False) for name in names]


def alike(least: int):
    """Forests of classes in the same prefix group whose sketches agree in at least ``least`` bytes."""

    def run(rows: pa.Table) -> pa.Table:
        ids, trie, prefix, i, j, block = _columns(rows, "class_id", "trie", "prefix", "i", "j", "block")
        sketch = np.stack([np.frombuffer(x, np.uint8) for x in rows.column("sketch").to_pylist()])
        links = Links(ids, np.ones(len(ids), np.int64))
        order, bounds = segments(trie, prefix, i, j)
        found_a, found_b, held = [], [], 0
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            at = order[start:end]
            for k in range(len(at) - 1):
                some = at[k + 1 :][(i[at[0]] == j[at[0]]) | (block[at[k + 1 :]] != block[at[k]])]
                same = some[(sketch[some] == sketch[at[k]]).sum(axis=1) >= least]
                if len(same):
                    found_a.append(np.full(len(same), at[k]))
                    found_b.append(same)
                    held += len(same)
            if held > 1 << 18:
                links.add(np.concatenate(found_a), np.concatenate(found_b))
                found_a, found_b, held = [], [], 0
        if held:
            links.add(np.concatenate(found_a), np.concatenate(found_b))
        found = links.rows()
        return pa.table({"class_id": found[0], "root": found[2]})

    return run


def common_counts(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """How many members every two sets share."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = n[at] > 1
    owner, number = owner[shared], (np.cumsum(n > 1) - 1)[at[shared]]
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    cuts = np.searchsorted(number, np.arange(0, (number[-1] + 1 if len(number) else 0) + columns, columns))
    for k, (start, end) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if end > start:
            has = np.zeros((len(sets), columns), np.float32)
            has[owner[start:end], number[start:end] - k * columns] = 1
            out += has @ has.T
    return np.rint(out).astype(np.int64)


def verified(threshold: float):
    """Links by exact Jaccard similarity among the classes of a cluster."""

    def run(rows: pa.Table) -> pa.Table:
        ids, n, cluster, i, j, block = _columns(rows, "class_id", "n", "cluster", "i", "j", "block")
        sets = [np.frombuffer(x, np.uint64) for x in rows.column("grams").to_pylist()]
        size = np.array([len(s) for s in sets], np.int64)
        links = Links(ids, n)
        order, bounds = segments(cluster, i, j)
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            at = order[start:end]
            if len(at) < 2:
                continue
            common = common_counts([sets[k] for k in at])
            union = size[at][:, None] + size[at][None, :] - common
            a, b = np.nonzero(np.triu(common >= threshold * union - 1e-9, 1))
            a, b = at[a], at[b]
            across = (i[a] == j[a]) | (block[a] != block[b])
            links.add(a[across], b[across])
        found = links.rows()
        return pa.table({"class_id": found[0], "links": found[1], "root": found[2]})

    return run


def grams(rows: DataFrame, width: int, keep: list[str]) -> DataFrame:
    """The sorted set of n-gram hashes of each text, as bytes, beside the columns ``keep``."""

    def run(batches):
        for some, texts in (found for batch in batches for found in read_in_blocks(batch, batch.num_columns - 1)):
            hashes, bounds = shingles(texts, width)
            out = [np.unique(hashes[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*some.columns[:-1], pa.array(out, pa.binary())], [*keep, "grams"])

    kinds = ", ".join(f"{name} {rows.schema[name].dataType.simpleString()}" for name in keep)
    return rows.select(*keep, F.col("text").cast("binary")).mapInArrow(run, f"{kinds}, grams binary")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WORDS,
    threshold: float = THRESHOLD,
    tries: int = TRIES,
    depth: int = DEPTH,
    target: float = TARGET,
    row_col: str | None = None,
) -> DataFrame:
    """Each row's ``id``, class, number of copies, links to other documents, component, and whether it is the one to keep.

    With ``row_col``, the unique number of each row of a written table, also that column and ``first``."""
    depth = matched_depth(depth, tries, threshold, target)
    hashes = tries * depth
    least = int(hashes * (threshold - SLACK * (threshold * (1 - threshold) / hashes) ** 0.5))

    texts = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")]
    docs = docs.select(F.col(row_col).alias("row"), *texts) if row_col else numbered(docs.select(*texts), "row")
    marked = materialize(signed(docs, width, tries, depth), "signed")
    sound = marked.where("key IS NOT NULL")
    least_row = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row")).alias("head")  # of the smallest id, if any
    classes = materialize(sound.groupBy("key").agg(F.min("row").alias("class_id"), least_row, F.count("*").alias("n")), "classes")
    with scratch_tables(docs.sparkSession) as lasting:
        first = sound.join(classes, "key").where("row = class_id").select("class_id", "n", "prefixes", "sketch")
        first = materialize(first, "first")

        met = first.select("class_id", F.posexplode("prefixes").alias("trie", "prefix"))
        sizes = met.groupBy("trie", "prefix").agg(F.count("*").alias("size")).where("size > 1")
        met = materialize(blocks_of(met.join(sizes, ["trie", "prefix"]), "size", "class_id", BLOCK).drop("size"), "met")
        tasks = met.count() // TASK_ROWS + 1
        met = met.join(first.select("class_id", "sketch"), "class_id").withColumn("task", F.pmod(F.xxhash64("trie", "prefix", "i", "j"), F.lit(tasks)))
        near = materialize(met.groupBy("task").applyInArrow(alike(least), "class_id long, root long"), "near")
        clusters = components(near.where("class_id <> root"), "class_id", "root")

        members = clusters.select(F.col("id").alias("class_id"), F.col("component").alias("cluster")).join(first.select("class_id", "n"), "class_id")
        sets = members.join(docs.select(F.col("row").alias("class_id"), "text"), "class_id")
        sets = materialize(grams(sets, width, ["class_id", "cluster", "n"]), "grams")
        sizes = members.groupBy("cluster").agg(F.count("*").alias("size"))
        sets = blocks_of(sets.join(sizes, "cluster"), "size", "class_id", BLOCK)
        weight = sets.agg(F.sum(F.length("grams"))).first()[0] or 0
        tasks = weight // TASK_BYTES + 1
        sets = sets.withColumn("task", F.pmod(F.xxhash64("cluster", "i", "j"), F.lit(tasks)))
        found = lasting(sets.groupBy("task").applyInArrow(verified(threshold), "class_id long, links long, root long"), "found")

    joined = components(found.where("class_id <> root"), "class_id", "root").withColumnRenamed("id", "class_id")
    links = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    classes = classes.join(links, "class_id", "left").join(joined, "class_id", "left").withColumn("component", F.coalesce("component", "class_id"))
    heads = classes.groupBy("component").agg(F.min("head").alias("whole"))
    classes = classes.join(heads, "component").select("key", "n", "links", F.col("head.doc_id").alias("class_id"), F.col("whole.doc_id").alias("component_id"), F.col("whole.row").alias("first"))
    out = marked.select("row", "doc_id", "key").join(classes, "key", "left")
    own = lambda name: F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col(name))
    return out.select(
        *([F.col("row").alias(row_col), (F.coalesce("first", "row") == F.col("row")).alias("first")] if row_col else []),
        F.col("doc_id").alias(id_col),
        own("class_id").alias("class_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("n_copies"),
        (F.coalesce("n", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
        own("component_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == own("component_id"), F.lit(False)).alias("kept"),
    )


def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query op2: links and components of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), keyed AS (
  SELECT doc_id, w, array_to_string(w, ' ') AS key FROM worded
), classes AS (
  SELECT key, min(doc_id) AS class_id, count(*) AS n, any_value(w) AS w FROM keyed WHERE len(w) > 0 GROUP BY key
), grams AS (
  SELECT DISTINCT class_id, array_to_string(w[i:i + 4], ' ') AS g FROM classes, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i)
), sized AS (
  SELECT class_id, count(*) AS s FROM grams GROUP BY class_id
), common AS (
  SELECT a.class_id AS a, b.class_id AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.class_id <> b.class_id GROUP BY 1, 2
), linked AS (
  SELECT a, b FROM common JOIN sized x ON x.class_id = a JOIN sized y ON y.class_id = b WHERE c >= 0.8 * (x.s + y.s - c) - 1e-9
), reached AS (
  SELECT class_id AS a, class_id AS b FROM classes
  UNION
  SELECT reached.a, linked.b FROM reached JOIN linked ON reached.b = linked.a
), component AS (
  SELECT a, min(b) AS component_id FROM reached GROUP BY a
), links AS (
  SELECT a, sum(n) AS links FROM linked JOIN classes ON class_id = b GROUP BY a
)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n, 1)::BIGINT AS n_copies, (coalesce(n, 1) - 1 + coalesce(links, 0))::BIGINT AS n_links,
       coalesce(component_id, doc_id) AS component_id, doc_id = coalesce(component_id, doc_id) AS kept
FROM keyed LEFT JOIN classes USING (key) LEFT JOIN component ON component.a = class_id LEFT JOIN links ON links.a = class_id
"""
