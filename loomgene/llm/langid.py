"""Language identification: multinomial naive Bayes over hashed character bigrams and trigrams.

Training counts grams of every labelled row in its task, and Spark adds up the counts of
each language; the model is a matrix of languages by BUCKETS log probabilities (plus the
log priors), broadcast to score texts in batches. Characters up to U+FFFF are lower-cased
one by one; a text is bounded by a space on both sides. Long texts are walked in parts of
PART characters that overlap by a gram, so a text of 100 MB costs little more than itself.

The language is the one of the greatest posterior; ties go to the name that sorts first.
Its score is a posterior, too, but of EVIDENCE grams of average weight where a text has
more: neighbouring grams depend on each other, and the plain product over a line of text
would call every guess certain. One more hypothesis, with the weight NO_LANGUAGE, has all
buckets equally likely: a text whose grams no language knows scores near 0.

The model has BUCKETS numbers a language. It learns the MOST_LANGUAGES labels of the most rows (ties:
the name that sorts first), so a column of labels that has gone wrong can't make it grow; which
labels these are is a matter of the labelled rows alone.

Null texts, and texts without any letter, are `und` with score 0, as are all if nothing is
labelled. Rows with a null or repeated doc_id are judged one by one. Empty tables give no rows, and a
model without languages. Columns with the names of the new ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgene.llm import blocks, store

BUCKETS = 1 << 16
MOST_LANGUAGES = 256
UNDETERMINED = "und"
EVIDENCE, NO_LANGUAGE = 32, 0.01
PART = 1 << 20
_CHUNK = 1024
_SMOOTH = 0.5
_U = np.uint64
_TOP = 1 << 16


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case and being a letter, of characters below _TOP."""
    low = np.arange(_TOP, dtype=np.uint32)
    for c in range(_TOP):
        if len(s := chr(c).lower()) == 1:
            low[c] = ord(s)
    return low, np.array([chr(c).isalpha() for c in range(_TOP)])


class Grams:
    """Hashed grams of some pieces of texts: parts (buckets of the bigrams, of the trigrams), each with its piece in owners; letters: which pieces have one."""

    def __init__(self, pieces: list[str], final: list[bool], tables):
        low, alpha = tables
        sizes = np.array([len(t) for t in pieces], np.int64)
        cp = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), np.uint32)
        known = cp < _TOP
        small = np.where(known, cp, 0)
        edge = np.append(0, np.cumsum(sizes))
        doc = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
        self.letters = blocks.sums_by(edge, alpha[small] & known) > 0
        if not known.all():
            for i in np.flatnonzero(~self.letters & (blocks.sums_by(edge, ~known) > 0)).tolist():
                self.letters[i] = any(map(str.isalpha, pieces[i]))
        cp = np.where(known, low[small], cp).astype(_U)
        two = cp[:-1] * _U(0x9E3779B1) + cp[1:]
        three = two[:-1] * _U(0x85EBCA77) + cp[2:] + _U(1)
        self.parts, self.owners = [], []
        for g, k in ((two, 2), (three, 3)):
            keep = doc[: len(g)] == doc[k - 1 :]
            if k == 2:  # the last bigram of a piece that goes on is the first of the next one
                keep[edge[1:][~np.array(final, bool)] - 2] = False
            self.parts.append(((g[keep] * _U(0x9E3779B97F4A7C15)) >> _U(48)).astype(np.int32))
            self.owners.append(doc[: len(g)][keep])


def walk(arr: pa.Array, tables) -> Iterator[tuple[np.ndarray, Grams]]:
    """The grams of all rows in parts of about PART characters, each with the rows of its pieces."""
    rows, pieces, final, room = [], [], [], PART
    for i, text in enumerate(arr.to_pylist()):
        n = len(text or "") + 2
        for a in range(0, n - 2 if n > 2 else 1, PART):
            last = a + PART >= n - 2
            piece = (text or "")[max(a - 1, 0) : a + PART + 1]
            pieces.append((" " if a == 0 else "") + piece + (" " if last else ""))
            rows.append(i)
            final.append(last)
            room -= len(piece) + 2
            if room <= 0:
                yield np.array(rows), Grams(pieces, final, tables)
                rows, pieces, final, room = [], [], [], PART
    if rows:
        yield np.array(rows), Grams(pieces, final, tables)


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables, counts, task = _tables(), {}, TaskContext.get().partitionId()
    for b in blocks.slices(batches):
        langs = np.array(b.column(1).to_pylist(), object)
        for name in set(langs.tolist()):  # the last number counts the rows
            counts.setdefault(name, np.zeros(BUCKETS + 1, np.int64))[BUCKETS] += int((langs == name).sum())
        for rows, g in walk(b.column(0), tables):
            for name in set(langs[rows].tolist()):
                own = langs[rows] == name
                for part, owner in zip(g.parts, g.owners, strict=True):
                    counts[name][:BUCKETS] += np.bincount(part[own[owner]], minlength=BUCKETS)
    for name, c in counts.items():
        for k in range(0, BUCKETS, _CHUNK):
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([k], pa.int32()), pa.array([task], pa.int32()), pa.array([c[k : k + _CHUNK + (k + _CHUNK == BUCKETS)].tobytes()], pa.binary())], names=["lang", "chunk", "task", "counts"])


class Model:
    def __init__(self, langs: list[str], rows: np.ndarray, counts: np.ndarray):
        self.langs = langs
        self.prior = np.log(rows / rows.sum()) if langs else np.zeros(0)
        self.logs = (np.log(counts + _SMOOTH) - np.log(counts.sum(1, keepdims=True) + _SMOOTH * BUCKETS)).astype(np.float32)


def train(rows: DataFrame) -> Model:
    """Learns from the columns text and lang of all rows that have one of the MOST_LANGUAGES most frequent labels."""
    store.import_path(rows.sparkSession)
    labels = [r[0] for r in rows.where("lang is not null").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()]
    parts = rows.where(F.col("lang").isin(labels)).select("text", "lang").mapInArrow(_learn, "lang string, chunk int, task int, counts binary")
    got = store.summed(parts, ["lang", "chunk"], np.int64).toArrow()  # of the size of the model
    langs = sorted(set(got.column("lang").to_pylist()))
    counts = np.zeros((len(langs), BUCKETS + 1), np.int64)
    for name, k, raw in zip(*(got.column(c).to_pylist() for c in ("lang", "chunk", "counts")), strict=True):
        own = np.frombuffer(raw, np.int64)
        counts[langs.index(name), k : k + len(own)] = own
    return Model(langs, counts[:, BUCKETS].astype(float), counts[:, :BUCKETS])


def score(m: Model, arr: pa.Array, tables) -> tuple[list[str], np.ndarray]:
    """Predicted language and its score, of each row."""
    if not m.langs:
        return [UNDETERMINED] * len(arr), np.zeros(len(arr))
    total, grams, letters = np.zeros((len(m.langs), len(arr))), np.zeros(len(arr)), np.zeros(len(arr), bool)
    for rows, g in walk(arr, tables):
        np.logical_or.at(letters, rows, g.letters)
        for part, owner in zip(g.parts, g.owners, strict=True):
            first = np.searchsorted(owner, np.arange(len(rows) + 1))
            sizes = np.diff(first)
            np.add.at(grams, rows, sizes)
            full = np.flatnonzero(sizes)
            if len(full):
                for i in range(len(m.langs)):
                    np.add.at(total[i], rows[full], np.add.reduceat(m.logs[i][part].astype(np.float64), first[full]))
    best = (total + m.prior[:, None]).argmax(0)
    total = np.vstack([total, grams * -np.log(BUCKETS)])
    evidence = total * np.minimum(1, EVIDENCE / np.maximum(grams, 1)) + np.append(m.prior, np.log(NO_LANGUAGE))[:, None]
    post = np.exp(evidence[best, np.arange(len(arr))] - np.logaddexp.reduce(evidence, axis=0))
    return [m.langs[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), letters.tolist(), strict=True)], np.where(letters, np.minimum(post, 1.0), 0.0)


def _predict(batches: Iterator[pa.RecordBatch], model, text: str, names: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    tables = _tables()
    for b in blocks.slices(batches, text):
        langs, post = score(model.value, b.column(b.schema.get_field_index(text)), tables)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(post)], names=[*b.schema.names, *names])


def predict(docs: DataFrame, model: Model, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """docs with two more columns, the predicted language and its posterior probability; columns of their names are replaced."""
    store.import_path(docs.sparkSession)
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in {n.lower() for n in names} or c == text))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(lambda it: _predict(it, shared, text, names), f"{schema}, `{names[0]}` string, `{names[1]}` double")


def part_of(doc_id: str = "doc_id", parts: int = 4):
    """CRC-32 of the id as text modulo parts; of a null id: null."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(parts))


def keep_identified(docs: DataFrame, least: float = 0.6, languages: tuple[str, ...] | None = None) -> DataFrame:
    """docs without those that have no letter, no language of at least that score, or (if languages are given) another language.

    Learns from the rows with a lang whose part_of() is not 2; where no row has one, there is no language and nothing is kept.
    """
    names = ("__lang_pred", "__lang_score")
    model = train(docs.where(F.coalesce(part_of() != 2, F.lit(True))))
    kept = (F.col(names[0]) != UNDETERMINED) & (F.col(names[1]) >= least)
    if languages is not None:
        kept = kept & F.col(names[0]).isin(*languages)
    return predict(docs, model, names=names).where(kept).select(*(f"`{c}`" for c in docs.columns))
