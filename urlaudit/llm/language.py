"""Language identification by interpolated Kneser-Ney models of characters, one for each language.

Models are fitted on a bounded sample of labelled documents: at most ``SAMPLE`` for each language, those with the least hash of
id and text among the texts of at most ``LONGEST`` characters, whole, and at most ``CHARACTERS`` characters in all. Where a language has fewer of these, longer texts follow in the
same order, with their first ``LONGEST`` characters; only fitting reads such passages, predictions read whole texts. Every fourth is kept out of the counts to calibrate. The
models live in sorted arrays of hashed character n-grams that all languages share, with one row of log probabilities for each
n-gram and one of back-off weights for each context; a lookup is a binary search. The language of least cross-entropy for each
character wins. Its posterior, at a temperature that suits the calibration texts, is the score; a text is accepted if its score is
at least one half and its cross-entropy is not far above what calibration texts of that length have.

Texts are read as lower-case letters with every run of other characters as one space, whole and each by itself, where they are
stored; only the models, of bounded size, go to the tasks.

Defined cases: a null text or one without a letter is ``und`` with score 0 and not accepted, and so is every text if there is no
labelled row to learn from. Ties go to the language that sorts first. Repeated rows have equal results and count once in the sample,
rows that share an id are different rows if their texts differ; a row without an id is in no held-out part and is not learned from where
there is one. An empty table gives an empty result. Columns other than ``id`` and ``text``, and ``lang`` for the sample, are ignored; a prediction uses the text alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urlaudit.llm.common import table, training

ORDER = 4
SAMPLE = 600  # documents of a language to learn from
LONGEST = 50_000  # characters of a document to learn from
CHARACTERS = 16_000_000  # of the whole sample; each language has an equal share
BLOCK = 1 << 19  # characters that are looked up together, of one long text or of several
HELD_OUT = (4, 2)

_POWERS = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in range(ORDER)]
_MIX = np.uint64(0xD6E8FEB86659FD93)


@cache
def _letters() -> np.ndarray:
    """The lower-case letter of each code point, 32 for all that is no letter."""
    out = np.full(0x110000, 32, np.uint32)
    for point in range(0x110000):
        if not 0xD800 <= point < 0xE000 and (letter := chr(point)).isalpha():
            low = letter.lower()
            out[point] = ord(low) if len(low) == 1 else point
    return out


def letters(text: str | None) -> np.ndarray:
    """Letters and single spaces of a text, led by ``ORDER - 1`` spaces; empty without a letter."""
    points = _letters()[np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)]
    if not (points != 32).any():
        return np.empty(0, np.uint32)
    blank = points == 32
    points = points[~blank | ~np.concatenate([[True], blank[:-1]])]
    return np.concatenate([np.full(ORDER - 1, 32, np.uint32), points])


def grams(points: np.ndarray) -> list[np.ndarray]:
    """For n from 0 to ORDER, a hash of the n characters that end at each place from ORDER - 1 on."""
    size = len(points) - (ORDER - 1)
    out, total = [np.zeros(size, np.uint64)], np.zeros(size, np.uint64)
    for back in range(ORDER):
        total = total + (points[ORDER - 1 - back : ORDER - 1 - back + size].astype(np.uint64) + np.uint64(1)) * _POWERS[back]
        out.append(total * _MIX + np.uint64(back))
    return out


def contexts(points: np.ndarray) -> list[np.ndarray]:
    """For n from 0 to ORDER - 1, a hash of the n characters before each place from ORDER - 1 on."""
    before = np.concatenate([[32], points[:-1]]).astype(np.uint32)
    return grams(before)[:ORDER]


def find(sorted_hashes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted hash stands, -1 if nowhere."""
    if not len(sorted_hashes):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(sorted_hashes, wanted), len(sorted_hashes) - 1)
    return np.where(sorted_hashes[at] == wanted, at, -1)


@dataclass
class Models:
    languages: list[str] = field(default_factory=list)
    grams: list[np.ndarray] = field(default_factory=list)  # by order, from 1
    log_p: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    log_backoff: list[np.ndarray] = field(default_factory=list)
    log_unseen: np.ndarray | None = None
    temperature: float = 1.0
    usual: float = 0.0  # cross-entropy of calibration texts
    spread: float = 1.0  # how far above it they get, times the root of their length

    def costs(self, points: np.ndarray) -> np.ndarray:
        """Minus the log probability of each character in each language; the first ORDER - 1 places are context only."""
        own, before = grams(points), contexts(points)
        out = np.zeros((len(own[0]), len(self.languages)), np.float32)
        left = np.arange(len(out))
        for n in range(ORDER, 0, -1):
            at = find(self.grams[n - 1], own[n][left])
            hit = at >= 0
            out[left[hit]] -= self.log_p[n - 1][at[hit]]
            left = left[~hit]
            if not len(left):
                return out
            at = find(self.contexts[n - 1], before[n - 1][left])
            seen = at >= 0
            out[left[seen]] -= self.log_backoff[n - 1][at[seen]]
        out[left] -= self.log_unseen
        return out

    def entropies(self, texts: list[np.ndarray]) -> np.ndarray:
        """Cross-entropy for each character of texts, none of them empty, in each language."""
        if len(texts) == 1 and len(texts[0]) > BLOCK:
            # A long text by itself: its parts share the ORDER - 1 characters that are context of the next part.
            own = len(texts[0]) - (ORDER - 1)
            total = sum(self.costs(texts[0][at : at + BLOCK + ORDER - 1]).sum(axis=0, dtype=np.float64) for at in range(0, own, BLOCK))
            return (total / own)[None, :]
        joined = np.concatenate(texts)
        sizes = np.array([len(t) for t in texts])
        costs = self.costs(joined)
        # A text's own places begin ORDER - 1 after its start; in ``costs`` all places have moved by as many.
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        own = np.ones(len(joined), bool)
        for k in range(ORDER - 1):
            own[starts + k] = False
        costs *= own[ORDER - 1 :, None]
        total = np.add.reduceat(costs, np.minimum(starts, len(costs) - 1), axis=0, dtype=np.float64)
        return total / (sizes - (ORDER - 1))[:, None]

    def posterior(self, entropy: np.ndarray, length: np.ndarray) -> np.ndarray:
        z = -(entropy - entropy.min(axis=1, keepdims=True)) * length[:, None] * self.temperature
        p = np.exp(np.maximum(z, -700))
        return p / p.sum(axis=1, keepdims=True)

    def limit(self, length: np.ndarray) -> np.ndarray:
        return self.usual + 0.5 + 2 * self.spread / np.sqrt(length)

    def predict(self, texts: Iterable[str | None]) -> Iterator[tuple[str, float, bool, float | None, int]]:
        """Language, score, acceptance, cross-entropy and length of each text. Texts are read a block at a time."""
        some, size = [], 0
        for text in texts:
            read = letters(text)
            if some and size + len(read) > BLOCK:
                yield from self._judged(some)
                some, size = [], 0
            some.append(read)
            size += len(read)
        yield from self._judged(some)

    def _judged(self, read: list[np.ndarray]) -> Iterator[tuple[str, float, bool, float | None, int]]:
        some = [r for r in read if len(r)]
        rows = iter(())
        if some and self.languages:
            entropy, length = self.entropies(some), np.array([len(r) - (ORDER - 1) for r in some])
            best = entropy.argmin(axis=1)
            least, score = entropy.min(axis=1), self.posterior(entropy, length).max(axis=1)
            accepted = (score >= 0.5) & (least <= self.limit(length))
            rows = zip((self.languages[k] for k in best), score.tolist(), accepted.tolist(), least.tolist(), length.tolist(), strict=True)
        for r in read:
            yield next(rows) if len(r) and self.languages else ("und", 0.0, False, None, max(0, len(r) - (ORDER - 1)))


def kneser_ney(texts: list[np.ndarray]) -> list[dict[str, np.ndarray]]:
    """For each order the n-grams of one language with what they add to the probability, their contexts and shorter n-grams, and
    the back-off weights of the contexts. The highest order counts n-grams, lower ones the different characters before them."""
    own = [np.concatenate(parts) for parts in zip(*(grams(t) for t in texts), strict=True)]
    before = [np.concatenate(parts) for parts in zip(*(contexts(t) for t in texts), strict=True)]
    orders = []
    for n in range(1, ORDER + 1):
        places = np.unique(own[n + 1], return_index=True)[1] if n < ORDER else np.arange(len(own[n]))
        gram, first, count = np.unique(own[n][places], return_index=True, return_counts=True)
        context, shorter = before[n - 1][places][first], own[n - 1][places][first]
        ones, twos = int((count == 1).sum()), int((count == 2).sum())
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        each, at = np.unique(context, return_inverse=True)
        total = np.bincount(at, count)
        orders.append({"gram": gram, "part": (count - discount) / total[at], "context": context, "shorter": shorter, "each": each, "backoff": discount * np.bincount(at) / total})
    return orders


def fit(sample: list[tuple[str, str]]) -> Models:
    """Models of the languages of (language, text) rows."""
    by: dict[str, list[np.ndarray]] = {}
    for language, text in sorted(sample):
        if len(read := letters(text)):
            by.setdefault(language, []).append(read)
    models = Models(sorted(by))
    if not by:
        return models
    held = {language: texts[3::4] or texts for language, texts in by.items()}
    learned = {language: [t for k, t in enumerate(texts) if k % 4 != 3] for language, texts in by.items()}
    tables = [kneser_ney(learned[language]) for language in models.languages]
    characters = len(np.unique(np.concatenate([t for texts in learned.values() for t in texts]))) + 1
    several = len(models.languages)
    unseen = np.full(several, 1.0 / characters)
    below = unseen[None, :]  # probabilities of the next lower order
    for n in range(ORDER):
        gram = np.unique(np.concatenate([orders[n]["gram"] for orders in tables]))
        each = np.unique(np.concatenate([orders[n]["each"] for orders in tables]))
        p, backoff = np.zeros((len(gram), several)), np.ones((len(each), several))
        context, shorter = np.zeros(len(gram), np.uint64), np.zeros(len(gram), np.uint64)
        for k, orders in enumerate(tables):
            backoff[find(each, orders[n]["each"]), k] = orders[n]["backoff"]
            at = find(gram, orders[n]["gram"])
            p[at, k] = orders[n]["part"]
            context[at], shorter[at] = orders[n]["context"], orders[n]["shorter"]
        p += backoff[find(each, context)] * (below[find(models.grams[-1], shorter)] if n else below)
        models.grams.append(gram)
        models.log_p.append(np.log(p).astype(np.float32))
        models.contexts.append(each)
        models.log_backoff.append(np.log(backoff).astype(np.float32))
        below = p
    models.log_unseen = np.log(unseen).astype(np.float32)
    calibrate(models, held)
    return models


def calibrate(models: Models, held: dict[str, list[np.ndarray]]) -> None:
    texts = [t for language in models.languages for t in held[language]]
    truth = np.repeat(np.arange(len(models.languages)), [len(held[language]) for language in models.languages])
    entropy = np.concatenate([models.entropies([t]) for t in texts])
    length = np.array([len(t) - (ORDER - 1) for t in texts])
    best = np.inf
    for temperature in np.geomspace(0.002, 1, 40):
        models.temperature = float(temperature)
        loss = -np.log(np.maximum(models.posterior(entropy, length)[np.arange(len(texts)), truth], 1e-12)).mean() + 0.002 * temperature
        if loss < best:
            best, chosen = loss, float(temperature)
    models.temperature = chosen
    least = entropy.min(axis=1)
    models.usual = float(np.median(least))
    models.spread = float(max(1e-3, ((least - models.usual) * np.sqrt(length)).max()))


def sampled(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", size: int = SAMPLE, held_out: tuple[int, int] | None = HELD_OUT
) -> list[tuple[str, str]]:
    """Language and text, or first ``LONGEST`` characters, of the labelled training documents to learn from; without ``held_out`` all
    documents are training documents.

    Rows are told apart by a hash of id and text. Of each language at least one and at most ``size`` different ones are taken, those of at
    most ``LONGEST`` characters first, and of all languages together no more than ``CHARACTERS`` characters."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("language"), F.col(text_col).alias("text")).where("language IS NOT NULL AND text IS NOT NULL")
    if held_out is not None:
        rows = rows.where(training(F.col("id"), *held_out))
    rows = rows.withColumn("key", F.xxhash64("id", "text"))
    # Rows in order of their hash. Of many of a language only those with small hashes, about twice the sample, are ranked.
    span = 1 << 30
    rank = F.pmod("key", F.lit(span))
    labelled = rows.select("key", "language", F.length("text").alias("size"), (F.length("text") > LONGEST).alias("long")).distinct()
    many = labelled.groupBy("language", "long").agg(F.count("*").alias("documents"))
    least = labelled.join(many, ["language", "long"]).where(rank * F.col("documents") <= F.lit((2 * size + 40) * span))
    languages = many.select("language").distinct().count()
    share = CHARACTERS // max(1, languages)
    by = Window.partitionBy("language").orderBy("long", rank, "key")
    used = F.sum(F.least("size", F.lit(min(LONGEST, share)))).over(by.rowsBetween(Window.unboundedPreceding, 0))
    placed = least.withColumn("place", F.row_number().over(by)).withColumn("used", used)
    chosen = placed.where((F.col("place") <= size) & ((F.col("place") == 1) | (F.col("used") <= share))).select("language", "key")
    # Of bounded size: ``size`` rows for each language, and ``CHARACTERS`` in all. Equal rows are taken once.
    found = rows.join(F.broadcast(chosen), ["language", "key"], "left_semi").select("language", "key", F.substring("text", 1, min(LONGEST, share)).alias("text"))
    return [(row["language"], row["text"]) for row in found.dropDuplicates(["language", "key"]).collect()]


def identify(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``lang_pred``, ``score``, ``accepted``, ``cross_entropy`` (nats for each character) and ``n_letters`` of each text."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["lang_pred", "score", "accepted", "cross_entropy", "n_letters"]
    types = [pa.string(), pa.float64(), pa.bool_(), pa.float64(), pa.int64()]

    def run(batches):
        for batch in batches:
            found = list(zip(*models.predict(value.as_py() for value in batch.column(1)), strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(values, kind) for values, kind in zip(found, types, strict=True))], [id_col, *names])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double, accepted boolean, cross_entropy double, n_letters long")


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query op8: the language of every document."""
    docs = table(spark, sf_dir, "documents")
    rows = identify(docs, fit(sampled(docs)))
    return rows.select("doc_id", F.coalesce(~training(F.col("doc_id"), *HELD_OUT), F.lit(False)).alias("held_out"), "lang_pred", "score", "accepted", "cross_entropy", "n_letters")
