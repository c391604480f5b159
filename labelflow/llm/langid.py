"""Language identification by word-first backoff.

A known word scores its log frequency in each language. An unseen word is padded with
boundary marks and falls back to its longest known character n-grams: the mean log
frequency of those of one length, trying shorter ones until any is known.

Training reads a sample of about ``docs_per_language`` labelled rows of each language, chosen
by a hash of the id; that is the only bound. Every whole text is scored.

A null text, and one without letters, is ``und`` with score 0; so is every text if there
is nothing to learn from. A text of which nothing is known goes to the most frequent language.
Ties go to the language that sorts first. Repeated rows are scored one by one; other columns
are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelflow.llm.common import field, id_text, materialise, parts

UNDETERMINED = "und"
LONGEST = 5
SMOOTHING = 0.1
#: A text's score counts as many words of evidence at most.
EVIDENCE_WORDS = 24
_WORDS = re.compile(r"[^\W\d_]+")
_CACHE = 100_000


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


def grams(word: str, n: int) -> list[str]:
    padded = f" {word} " if n > 1 else word
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


def sample_per_group(rows: DataFrame, group: str, key: Column, target: int) -> DataFrame:
    """About ``target`` rows of each group, chosen by a hash of ``key``; all rows of a smaller group. Moves no rows.

    The groups are the classes of a model; their counts come to the driver as the model itself does.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(group).count().collect()}
    small = [g for g, n in counts.items() if n <= target]
    keep = F.col(group).isin(small)
    part = F.pmod(F.xxhash64(key), F.lit(1 << 30)) / float(1 << 30)
    for g, n in counts.items():
        if n > target:
            keep = keep | ((F.col(group) == g) & (part < target / n))
    return rows.where(keep)


class Model:
    """Log frequencies by language: ``words`` and ``grams`` map a string to its row of ``table``."""

    def __init__(self, languages: list[str], counts: dict[tuple[int, str], np.ndarray]):
        self.languages = languages
        self.prior = int(np.argmax(counts.pop((-1, ""), np.zeros(max(1, len(languages))))))
        totals: dict[int, np.ndarray] = {}
        sizes: Counter = Counter()
        for (n, _), c in counts.items():
            totals[n] = totals.get(n, 0) + c
            sizes[n] += 1
        self.table = np.zeros((len(counts), len(languages)), dtype=np.float32)
        self.words: dict[str, int] = {}
        self.grams: dict[str, int] = {}
        for row, ((n, s), c) in enumerate(counts.items()):
            self.table[row] = np.log((c + SMOOTHING) / (totals[n] + SMOOTHING * sizes[n]))
            (self.grams if n else self.words)[s] = row
        self.unseen: dict[str, np.ndarray | None] = {}

    def _backoff(self, word: str) -> np.ndarray | None:
        if word not in self.unseen:
            if len(self.unseen) >= _CACHE:
                self.unseen.clear()
            found = None
            for n in range(LONGEST, 0, -1):
                rows = [r for g in grams(word, n) if (r := self.grams.get(g)) is not None]
                if rows:
                    found = self.table[rows].mean(axis=0)
                    break
            self.unseen[word] = found
        return self.unseen[word]

    def predict(self, text: str | None) -> tuple[str, float]:
        count = Counter(words_of(text))
        if not count or not self.languages:
            return UNDETERMINED, 0.0
        known, times, total, seen = [], [], np.zeros(len(self.languages)), 0
        for word, n in count.items():
            row = self.words.get(word)
            if row is not None:
                known.append(row)
                times.append(n)
            elif (v := self._backoff(word)) is not None:
                total += n * v
                seen += n
        if known:
            t = np.array(times, dtype=np.float32)
            total += t @ self.table[known]
            seen += int(t.sum())
        if not seen:
            return self.languages[self.prior], 1.0 / len(self.languages)
        best = int(np.argmax(total))
        share = np.exp((total - total[best]) * min(1.0, EVIDENCE_WORDS / seen))
        return self.languages[best], float(1.0 / share.sum())


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          docs_per_language: int = 2000, min_count: int = 3) -> Model:
    """Model of the labelled rows; the caller has already left out what is held out.

    Rows with a null text or label are not learned from. Words and n-grams seen fewer than
    ``min_count`` times in the sample are left to shorter n-grams.
    """
    rows = labelled.select(labelled[id_col].alias("id"), labelled[text_col].cast("string").alias("text"),
                           labelled[lang_col].cast("string").alias("lang")).where("text is not null and lang is not null")
    texts = sample_per_group(rows, "lang", F.col("id").cast("string"), docs_per_language).select("lang", "text")

    def count_words(batches):
        for langs, bodies in parts(batches):
            by: dict[str, Counter] = {}
            for lang, text in zip(langs, bodies, strict=True):
                by.setdefault(lang, Counter()).update(words_of(text))
            yield pa.RecordBatch.from_pylist(
                [{"lang": lang, "word": w, "n": n} for lang, c in by.items() for w, n in c.items()],
                schema=pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]))

    words = materialise(texts.mapInArrow(count_words, "lang string, word string, n bigint")
                        .groupBy("lang", "word").agg(F.sum("n").alias("n")), "langid-words")

    def count_grams(batches):
        for langs, ws, ns in parts(batches, 4096):
            total: Counter = Counter()
            for lang, w, n in zip(langs, ws, ns, strict=True):
                for size in range(1, LONGEST + 1):
                    for g in grams(w, size):
                        total[lang, size, g] += n
            yield pa.RecordBatch.from_pylist(
                [{"lang": lang, "size": s, "word": g, "n": n} for (lang, s, g), n in total.items()],
                schema=pa.schema([("lang", pa.string()), ("size", pa.int32()), ("word", pa.string()), ("n", pa.int64())]))

    pieces = (words.mapInArrow(count_grams, "lang string, size int, word string, n bigint")
              .groupBy("lang", "size", "word").agg(F.sum("n").alias("n"))
              .unionByName(words.select("lang", F.lit(0).alias("size"), "word", "n")))
    enough = (pieces.groupBy("size", "word").agg(F.sum("n").alias("all"), F.collect_list(F.struct("lang", "n")).alias("by"))
              .where(F.col("all") >= min_count).select("size", "word", "by"))
    languages = sorted(r[0] for r in words.select("lang").distinct().collect())
    at = {x: i for i, x in enumerate(languages)}
    counts: dict[tuple[int, str], np.ndarray] = {}
    priors = np.zeros(len(languages))
    table = enough.toArrow()
    for size, word, by in zip(*(c.to_pylist() for c in table.columns), strict=True):
        c = counts[size, word] = np.zeros(len(languages))
        for x in by:
            c[at[x["lang"]]] = x["n"]
        if size == 0:
            priors += c
    if languages:
        counts[-1, ""] = priors
    return Model(languages, counts)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, lang_pred, score per row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = id_text(docs, id_col, text_col)

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(rows.schema["id"].dataType)

    def run(batches):
        m = shared.value
        for ids, texts in parts(batches):
            out = [m.predict(t) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(ids, key_type), pa.array([x[0] for x in out], pa.string()),
                                              pa.array([x[1] for x in out], pa.float64())], ["id", "lang_pred", "score"])

    return (rows.mapInArrow(run, f"{field('id', rows, 'id')}, lang_pred string, score double")
            .withColumnRenamed("id", id_col))


def select_rows(docs: DataFrame, model: Model, text_col: str = "text", min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text is in a learned language with at least ``min_score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        m = shared.value
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                piece = batch.slice(s, 256)
                out = map(m.predict, piece.column(at).cast(pa.string()).to_pylist())
                yield piece.filter(pa.array([lang != UNDETERMINED and score >= x for (lang, score), x in zip(out, repeat(min_score))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
