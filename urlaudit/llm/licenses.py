"""License scans as an exact set-similarity join of text blocks with license templates.

A block is a run of consecutive words, whatever line ends lie between them, as wide as the template has different words and ``SLACK`` more. A
template is the word set of a license statement. They join where the block contains at least ``threshold`` of the template's words, and with them
every word of the license's name; a block that has, or stands beside, a word by which a longer name goes on is none of this license's (GPL and
LGPL, CC BY and CC BY-NC). The words of all templates are ordered by how often the whole corpus has them, rarest first. A block can only reach
the overlap a template needs if it has a word of the template's prefix (prefix filter), has enough words (length filter), and enough words
remain on both sides after each common word (positional filter); what passes is counted. So only blocks around words of a prefix are looked at.

Templates are a fixed list, so their index goes to each task as a closure; documents are read twice, once for the word counts,
of which only those of template words are kept, and never shuffled.

Defined cases: a null or empty text has no words, labels or matches. Rows are independent, so repeated rows have equal results and
an empty table gives an empty one. Columns other than ``id`` and ``text`` are ignored. A text that matches several templates gets
the labels of all. Overlapping blocks that match the same template are one match, the best of them and of equals the first.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlaudit.llm.common import table

#: Phrases of the base result and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Labels, license statements, and the words of the name that tell the license from others.
TEMPLATES = [
    ("mit", "licensed under the mit license", "mit license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "distributed under the terms of the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "free charge software documentation"),
    ("apache-2", "licensed under the apache license version 2.0", "apache license 2"),
    ("apache-2", "released under the apache license 2.0", "apache license 2"),
    ("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license 2"),
    ("gpl-2", "under the terms of the gnu general public license version 2 as published by the free software foundation", "gnu general public license 2"),
    ("gpl-2", "released under the gnu gpl v2", "gpl v2"),
    ("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license 3"),
    ("gpl-3", "under the terms of the gnu general public license version 3 as published by the free software foundation", "gnu general public license 3"),
    ("gpl-3", "released under the gnu gpl v3", "gpl v3"),
    ("lgpl-2.1", "licensed under the gnu lesser general public license version 2.1", "gnu lesser general public license 2 1"),
    ("lgpl-3", "licensed under the gnu lesser general public license version 3", "gnu lesser general public license 3"),
    ("agpl-3", "licensed under the gnu affero general public license version 3", "gnu affero general public license 3"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2.0", "mozilla public license 2"),
    ("mpl-2", "licensed under the mozilla public license version 2.0", "mozilla public license 2"),
    ("epl-2", "licensed under the eclipse public license version 2.0", "eclipse public license 2"),
    ("eupl-1.2", "licensed under the european union public licence version 1.2", "european union public licence 1 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution source binary forms modification"),
    ("bsd-2", "licensed under the bsd 2 clause license", "bsd 2 clause"),
    ("bsd-3", "licensed under the bsd 3 clause license", "bsd 3 clause"),
    ("isc", "licensed under the isc license", "isc license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "copy modify distribute software fee"),
    ("zlib", "licensed under the zlib license", "zlib license"),
    ("boost-1", "distributed under the boost software license version 1.0", "boost software license 1"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software public domain"),
    ("cc0-1", "licensed under cc0 1.0 universal", "cc0 1"),
    ("cc-by", "licensed under cc by 4.0", "cc by"),
    ("cc-by", "licensed under a creative commons attribution 4.0 international license", "creative commons attribution"),
    ("cc-by-sa", "licensed under cc by sa 4.0", "cc by sa"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4.0 international license", "creative commons attribution sharealike"),
    ("cc-by-nc", "licensed under cc by nc 4.0", "cc by nc"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4.0 international license", "creative commons attribution noncommercial"),
    ("cc-by-nd", "licensed under cc by nd 4.0", "cc by nd"),
    ("cc-by-nd", "licensed under a creative commons attribution noderivatives 4.0 international license", "creative commons attribution noderivatives"),
    ("cc-by-nc-sa", "licensed under cc by nc sa 4.0", "cc by nc sa"),
    ("cc-by-nc-sa", "licensed under a creative commons attribution noncommercial sharealike 4.0 international license", "creative commons attribution noncommercial sharealike"),
    ("cc-by-nc-nd", "licensed under cc by nc nd 4.0", "cc by nc nd"),
    ("cc-by-nc-nd", "licensed under a creative commons attribution noncommercial noderivatives 4.0 international license", "creative commons attribution noncommercial noderivatives"),
]
THRESHOLD = 0.85
SLACK = 3  # words of a block beyond the template's own
BESIDE = 2  # words on either side of a block that must not go on with a longer name

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 10 if b == 10 else 32 for b in range(256))


def folded(text: str | None) -> bytes:
    """A-Z in lower case; all that is no word is a space, but line ends stay."""
    return (text or "").encode().translate(_FOLD)


def names_that_go_on(templates: list[tuple[str, str, str]]) -> list[set[bytes]]:
    """For each template the words by which names of other labels go on from its own; numbers only where nothing else tells them apart."""
    names = [set(folded(name).split()) for *_, name in templates]
    out = []
    for (label, *_), name in zip(templates, names, strict=True):
        more: set[bytes] = set()
        for (other, *_), longer in zip(templates, names, strict=True):
            if other != label and name < longer:
                rest = longer - name
                more |= {word for word in rest if not word.isdigit()} or rest
        out.append(more)
    return out


class Index:
    """Templates by the words of their prefixes."""

    def __init__(self, templates: list[tuple[str, str, str]], threshold: float, frequency: dict[bytes, int]):
        sets = [set(folded(text).split()) for _, text, _ in templates]
        vocabulary = set().union(*sets) if sets else set()
        order = sorted(vocabulary, key=lambda word: (frequency.get(word, 0), word))
        self.rank = {word: at for at, word in enumerate(order)}
        self.labels = [label for label, *_ in templates]
        self.names = [set(folded(name).split()) for *_, name in templates]
        self.others = names_that_go_on(templates)
        self.templates = [sorted(self.rank[word] for word in words) for words in sets]
        self.needed = [math.ceil(threshold * len(words) - 1e-9) for words in self.templates]
        self.width = [len(words) + SLACK for words in self.templates]
        self.prefix: dict[bytes, list[int]] = {}
        for number, words in enumerate(self.templates):
            for word in words[: len(words) - self.needed[number] + 1]:
                self.prefix.setdefault(order[word], []).append(number)

    def overlap(self, number: int, block: set[bytes]) -> int:
        """How many words of a template the block contains, 0 if not enough."""
        needed, template = self.needed[number], self.templates[number]
        if len(block) < needed:
            return 0
        common = sorted(self.rank[word] for word in block if word in self.rank)
        met = i = 0
        for j, word in enumerate(common):
            while i < len(template) and template[i] < word:
                i += 1
            if met + min(len(template) - i, len(common) - j) < needed:
                return 0
            if i < len(template) and template[i] == word:
                met += 1
        return met if met >= needed else 0

    def matches(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(first word, template, containment) of the best block of each run of overlapping blocks that match a template."""
        starts: dict[int, set[int]] = {}
        for at, word in enumerate(words):
            for number in self.prefix.get(word, ()):
                starts.setdefault(number, set()).update(range(max(0, at - self.width[number] + 1), at + 1))
        found = []
        for number, places in starts.items():
            width, last = self.width[number], -1
            best: tuple[int, int] | None = None
            for start in sorted(places):
                block = set(words[start : start + width])
                met = self.overlap(number, block) if self.names[number] <= block else 0
                if met and not self.others[number].isdisjoint(words[max(0, start - BESIDE) : start + width + BESIDE]):
                    met = 0
                if not met:
                    continue
                if best and start >= last + width:
                    found.append((best[1], number, best[0] / len(self.templates[number])))
                    best = None
                if best is None or met > best[0]:
                    best = (met, start)
                last = start
            if best:
                found.append((best[1], number, best[0] / len(self.templates[number])))
        return sorted(found)


def word_counts(docs: DataFrame, templates: list[tuple[str, str, str]], text_col: str = "text") -> dict[bytes, int]:
    """How often the corpus has each template word: one row a word and task, one a word on the driver."""
    vocabulary = frozenset(b" ".join(folded(text) for _, text, _ in templates).split())

    def run(batches):
        total: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                found = Counter(folded(text.as_py()).split())
                for word in vocabulary & found.keys():
                    total[word] += found[word]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    rows = docs.select(text_col).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {bytes(row["word"]): row["n"] for row in rows}


SCHEMA = "n_words long, places array<struct<label:string,word:long>>, matches array<struct<word:long,template:int,label:string,containment:double>>"


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each document its number of words, the places of the phrases, and the blocks that match a template by their first words."""
    index = Index(templates, threshold, word_counts(docs, templates, text_col))
    phrases = [(b" " + folded(phrase) + b" ", label) for phrase, label in phrases.items()]
    kind = docs.schema[id_col].dataType.simpleString()

    def places(words: list[bytes]) -> list[dict]:
        line, found = b" " + b" ".join(words) + b" ", []
        for phrase, label in phrases:
            at = line.find(phrase)
            while at >= 0:
                found.append({"label": label, "word": line.count(b" ", 0, at)})
                at = line.find(phrase, at + 1)
        return found

    def run(batches):
        for batch in batches:
            n, placed, matched = [], [], []
            for value in batch.column(1):
                words = folded(value.as_py()).split()
                n.append(len(words))
                placed.append(places(words))
                found = [] if index.prefix.keys().isdisjoint(words) else index.matches(words)
                matched.append([{"word": at, "template": t, "label": index.labels[t], "containment": c} for at, t, c in found])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(placed, pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))),
                    pa.array(matched, pa.list_(pa.struct([("word", pa.int64()), ("template", pa.int32()), ("label", pa.string()), ("containment", pa.float64())]))),
                ],
                [id_col, "n_words", "places", "matches"],
            )

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {SCHEMA}")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query op3: base phrases, labels of matched templates, and the best containment."""
    rows = scan(table(spark, sf_dir, "documents"))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return rows.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.word").alias("first_word"),
        F.array_max("places.word").alias("last_word"),
        joined(F.col("places.label")).alias("base_labels"),
        joined(F.concat("places.label", "matches.label")).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("matches.containment"), F.lit(0.0))).alias("score"),
    )


def _listed(values) -> str:
    return "[" + ", ".join(f"'{word.decode()}'" for word in sorted(values)) + "]::VARCHAR[]"


_VALUES = ", ".join(
    f"('{label}', {_listed(set(folded(text).split()))}, {_listed(set(folded(name).split()))}, {_listed(others)})"
    for (label, text, name), others in zip(TEMPLATES, names_that_go_on(TEMPLATES), strict=True)
)
_PHRASES = ", ".join(f"('{label}', '{phrase}')" for phrase, label in PHRASES.items())
ORACLE = rf"""
WITH worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), phrases AS (
  SELECT label, string_split(phrase, ' ') AS p FROM (VALUES {_PHRASES}) AS v(label, phrase)
), places AS (
  SELECT doc_id, label, i - 1 AS word FROM worded, phrases, unnest(range(1, len(words) - len(p) + 2)) AS t(i) WHERE words[i:i + len(p) - 1] = p
), templates AS (
  SELECT *, len(w) + {SLACK} AS width, ceil({THRESHOLD} * len(w) - 1e-9) AS needed FROM (VALUES {_VALUES}) AS v(label, w, name, others)
), candidates AS (
  SELECT d.doc_id, d.words, t.* FROM (SELECT *, list_distinct(words) AS own FROM worded) d, templates t
  WHERE list_has_all(own, name) AND len(list_intersect(own, w)) >= needed
), matches AS (
  SELECT doc_id, label, len(list_intersect(words[i:i + width - 1], w))::DOUBLE / len(w) AS containment
  FROM candidates, unnest(range(1, len(words) + 1)) AS t(i)
  WHERE list_has_all(words[i:i + width - 1], name) AND len(list_intersect(words[i:i + width - 1], w)) >= needed
    AND NOT list_has_any(words[greatest(i - {BESIDE}, 1):i + width - 1 + {BESIDE}], others)
), base AS (
  SELECT doc_id, count(*) AS n, min(word) AS a, max(word) AS z, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY doc_id
), every AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM places UNION ALL SELECT doc_id, label FROM matches) GROUP BY doc_id
), best AS (SELECT doc_id, max(containment) AS c FROM matches GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, z::BIGINT AS last_word,
       coalesce(base.labels, '') AS base_labels, coalesce(every.labels, '') AS labels,
       CASE WHEN n > 0 THEN 1.0 ELSE coalesce(c, 0.0) END::DOUBLE AS score
FROM worded w LEFT JOIN base USING (doc_id) LEFT JOIN every USING (doc_id) LEFT JOIN best USING (doc_id)
"""
