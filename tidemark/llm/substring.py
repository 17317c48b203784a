"""Substring dedup with difference-cover anchors.

A window is ``WINDOW`` consecutive words. Anchors of ``ANCHOR`` words are hashed only at positions
that lie in a difference cover modulo ``PERIOD``: for any two positions some shift below the period
puts both on the cover, so two equal windows always share an anchor at the same offset. That leaves
6 of 31 positions to shuffle.

An anchor is extended in two steps, both without pairs of documents:

* Its neighbourhood (30 words to either side) is hashed too. Anchors whose neighbourhoods are equal
  form a class; all but those of the class's smallest document are covered by it outright.
* Where one anchor has several classes, each class's smallest document lays out its windows around
  the anchor. Equal windows meet by a 128-bit hash and all but the smallest document's are marked.

Both meet in sorted runs that are read as a stream: a passage of any number of documents needs the
memory of one batch. A run holds one row for each time its words occur, at most a few hundredths of
all rows even if a third of all documents share the passage, as each of the passage's anchors and
windows has a run of its own. Rows that repeat an id and its text are told apart from others by a
64-bit hash of the text, pass through the runs as often as they come, and leave one mark there, so
n copies cost n times the words of one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, cut, table

WINDOW = 50
#: The perfect difference set modulo 31 of six residues.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
ANCHOR = WINDOW - PERIOD + 1
REACH = WINDOW - ANCHOR
#: Odd bases of the two rolling hashes, and their inverses modulo 2 ** 64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
INVERSES = tuple(pow(b, -1, 1 << 64) for b in BASES)
#: Distinct words whose hashes a task remembers before it starts afresh.
REMEMBERED = 1 << 20
NO_ID = (1 << 63) - 1


class _Words(dict):
    """Word -> row of ``hashes``; unknown words are hashed when they are met."""

    def __init__(self) -> None:
        self.hashes: list[int] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self.hashes)
        self.hashes.append(xxhash.xxh3_128_intdigest(word))
        return at


class Roller:
    """Hashes of word sequences of one document after another."""

    def __init__(self) -> None:
        self.words = _Words()
        self.powers = [np.ones(1, np.uint64)] * 4

    def load(self, words: list[bytes]) -> None:
        n = len(words)
        if len(self.words) > REMEMBERED:
            self.words = _Words()
        while len(self.powers[0]) <= n:
            size = 2 * max(len(self.powers[0]), 4096)
            self.powers = [
                np.cumprod(np.r_[np.uint64(1), np.full(size, b, np.uint64)], dtype=np.uint64) for b in BASES + INVERSES
            ]
        at = np.fromiter(map(self.words.__getitem__, words), np.int64, n)
        known, first = np.unique(at, return_inverse=True)
        full = [self.words.hashes[i] for i in known]
        self.sums = []
        for k in range(2):
            own = np.array([(x >> 64 * k) & 0xFFFFFFFFFFFFFFFF for x in full], np.uint64)
            self.sums.append(np.r_[np.uint64(0), np.cumsum(own[first] * self.powers[k][:n], dtype=np.uint64)])

    def span(self, k: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The k-th hash of words start..end-1, mixed so that all bits depend on all words."""
        x = (self.sums[k][end] - self.sums[k][start]) * self.powers[2 + k][start]
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


def split_words(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8: what lies between ASCII white space, unchanged."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    roller = Roller()
    on_cover = np.zeros(PERIOD, bool)
    on_cover[list(COVER)] = True
    for batch in batches:
        found: list[list[np.ndarray]] = []
        for key, mark, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = split_words(text)
            n = len(words)
            if n < WINDOW:
                continue
            roller.load(words)
            p = np.arange(n - ANCHOR + 1)
            p = p[on_cover[p % PERIOD]]
            left, right = np.maximum(p - REACH, 0), np.minimum(p + ANCHOR + REACH, n)
            shape = ((p - left) * 128 + (right - p)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            near = roller.span(1, left, right) ^ shape
            found.append([roller.span(0, p, p + ANCHOR), near, np.full(len(p), key), np.full(len(p), mark), p])
            if sum(len(x[0]) for x in found) > 200_000:
                yield _batch(found, _ANCHOR)
                found = []
        if found:
            yield _batch(found, _ANCHOR)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    roller = Roller()
    for batch in batches:
        found: list[list[np.ndarray]] = []
        for key, mark, text, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = split_words(text)
            n = len(words)
            roller.load(words)
            edge = np.zeros(n + 2, np.int64)
            np.add.at(edge, np.maximum(np.array(at) - REACH, 0), 1)
            np.add.at(edge, np.minimum(np.array(at), n - WINDOW) + 1, -1)
            s = np.flatnonzero(np.cumsum(edge)[: n - WINDOW + 1] > 0)
            found.append([*(roller.span(k, s, s + WINDOW) for k in range(2)), np.full(len(s), key), np.full(len(s), mark), s])
            if sum(len(x[0]) for x in found) > 200_000:
                yield _batch(found, _WINDOW)
                found = []
        if found:
            yield _batch(found, _WINDOW)


_ANCHOR = ["anchor", "near", "key", "mark", "at"]
_WINDOW = ["w1", "w2", "key", "mark", "at"]
#: Rows of one class that a task keeps back; beyond that they lay out their windows, needed or not.
HELD = 1 << 20


def _batch(found: list[list[np.ndarray]], names: list[str]) -> pa.RecordBatch:
    columns = [np.concatenate(x) for x in zip(*found, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], names)


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield [c.to_numpy(zero_copy_only=False) for c in batch.columns]


def _marks(columns: list[np.ndarray], sure: np.ndarray) -> pa.RecordBatch:
    """(key, mark, at, sure); of rows that repeat the one before, as copies of a document do in a sorted run, only the first."""
    new = np.ones(len(sure), bool)
    if len(sure) > 1:
        new[1:] = np.any([c[1:] != c[:-1] for c in (*columns, sure)], axis=0)
    return pa.RecordBatch.from_arrays([pa.array(c[new]) for c in (*columns, sure)], ["key", "mark", "at", "sure"])


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by all columns -> those that a smaller document covers (sure), or that must lay out windows."""
    anchor0 = near0 = least0 = None
    several = False
    held: list[np.ndarray] = []
    for anchor, near, key, mark, at in _arrays(batches):
        n = len(anchor)
        new_anchor = np.r_[anchor0 is None or anchor[0] != anchor0, anchor[1:] != anchor[:-1]]
        new_class = new_anchor | np.r_[near0 is None or near[0] != near0, near[1:] != near[:-1]]
        start = np.maximum.accumulate(np.where(new_class, np.arange(n), -1))
        least = np.where(start < 0, least0 if least0 is not None else 0, key[start])
        group = np.cumsum(new_anchor)  # 0: goes on from the batch before
        extra = np.bincount(group[new_class & ~new_anchor], minlength=group[-1] + 1) > 0
        if several:
            extra[0] = True
        sure = key != least
        own = ~sure
        out = sure | (own & extra[group])
        if held and (extra[0] or sum(h.shape[1] for h in held) > HELD):
            h = np.concatenate(held, axis=1)
            yield _marks([*h], np.zeros(h.shape[1], bool))
            held = []
        if group[-1] > 0:
            held = []
        last = np.flatnonzero(own & (group == group[-1]) & ~extra[-1])
        if len(last):
            rows = np.stack([key[last], mark[last], at[last]])
            new = np.r_[True, (rows[:, 1:] != rows[:, :-1]).any(0)]
            if held and (held[-1][:, -1] == rows[:, 0]).all():
                new[0] = False
            if new.any():
                held.append(rows[:, new])
        several = bool(extra[-1])
        yield _marks([key[out], mark[out], at[out]], sure[out])
        anchor0, near0, least0 = anchor[-1], near[-1], least[-1]


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by all columns -> those of all but the window's smallest document."""
    before, least0 = None, 0
    for w1, w2, key, mark, at in _arrays(batches):
        goes_on = before is not None and (w1[0], w2[0]) == before
        new = np.r_[not goes_on, (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])]
        start = np.maximum.accumulate(np.where(new, np.arange(len(w1)), -1))
        least = np.where(start < 0, least0, key[start])
        out = key != least
        yield _marks([key[out], mark[out], at[out]], np.ones(out.sum(), bool))
        before, least0 = (w1[-1], w2[-1]), least[-1]


def _positions(marks: DataFrame, name: str) -> DataFrame:
    """One row for each id and text: the set of its positions, which its own length bounds, however many rows repeat it."""
    return marks.groupBy(F.col("key").alias("_key"), F.col("mark").alias("_mark")).agg(F.collect_set(F.col("at").cast("int")).alias(name))


def covered(n: int, anchors: list[int] | None, windows: list[int] | None) -> np.ndarray:
    """Mask of the words of one document that are removed."""
    edge = np.zeros(n + 1, np.int64)
    for starts, before, after in ((anchors, REACH, ANCHOR + REACH), (windows, 0, WINDOW)):
        if starts is not None and len(starts):
            at = np.asarray(starts, np.int64)
            np.add.at(edge, np.maximum(at - before, 0), 1)
            np.add.at(edge, np.minimum(at + after, n), -1)
    return np.cumsum(edge)[:n] > 0


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["n_words", "n_removed", "kept_sha256", "kept"]
    for batch in batches:
        rows = []
        for text, anchors, windows in zip(*(batch.column(c).to_pylist() for c in ("_text", "_sure", "_repeat")), strict=True):
            words = split_words(text)
            gone = covered(len(words), anchors, windows)
            kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if gone.any() else words)
            whole = None if gone.any() else text
            rows.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass") if whole is None else whole))
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)] if rows else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.string(), pa.string())]
        own = [c for c in batch.schema.names if not c.startswith("_")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *columns], [*own, *("_" + x for x in names)])


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with _n_words, _n_removed, _kept_sha256 and _kept.

    Each word that is covered by a window which also starts in a document with a smaller doc_id is
    removed; windows are judged on the input. A document's words are in memory once, with its marks:
    a text of many megabytes needs a multiple of its own length. ``_kept`` is the kept words joined by one space, or
    the text as it was if nothing is removed (null stays null). Null and empty texts have no
    words. A null doc_id counts as larger than all others. Rows that repeat a doc_id, with this
    text or another, never remove each other's words. No rows give no rows. ``docs`` needs doc_id
    and text; other columns pass through, whatever their names, but for those with a leading "_".
    """
    bound_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    keys = [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_key"),
        F.xxhash64(text).alias("_mark"),
    ]
    keyed = docs.select(*keys, text.alias("_text"))
    anchors = keyed.mapInArrow(_anchors, "anchor long, near long, key long, mark long, at long")
    marks = cut(
        anchors.repartition("anchor").sortWithinPartitions(*_ANCHOR)
        .mapInArrow(_classes, "key long, mark long, at long, sure boolean"),
        "anchors",
    )
    whole = docs.select(*keys, "*")
    open_ = _positions(marks.where("NOT sure"), "_open")
    windows = whole.join(open_, ["_key", "_mark"]).select("_key", "_mark", text.alias("_text"), "_open")
    repeats = (
        windows.mapInArrow(_windows, "w1 long, w2 long, key long, mark long, at long")
        .repartition("w1").sortWithinPartitions(*_WINDOW)
        .mapInArrow(_repeats, "key long, mark long, at long, sure boolean")
    )
    gone = _positions(marks.where("sure"), "_sure").join(_positions(repeats, "_repeat"), ["_key", "_mark"], "full")
    own = [c for c in docs.columns if not c.startswith("_")]
    stripped = whole.join(gone, ["_key", "_mark"], "left").select(*own, text.alias("_text"), "_sure", "_repeat")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stripped.schema if not f.name.startswith("_"))
    return stripped.mapInArrow(_strip, kinds + ", _n_words long, _n_removed long, _kept_sha256 string, _kept string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, the text being what substring dedup leaves; n_chars, if there, is its length."""
    found = dedup_substrings(docs).withColumn("text", F.col("_kept"))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(docs.columns)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What substring dedup leaves of every document."""
    found = dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *(F.col("_" + c).alias(c) for c in ("n_words", "n_removed", "kept_sha256")))


OP1_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, words, unnest(range(1, greatest(len(words) - 48, 1))) AS i FROM w
), h AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(words, i, i + 49), ' ')) AS k FROM s
), r AS (
  SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY k) AS least FROM h) WHERE doc_id > least
), g AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM r
), t AS (
  SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM w
), k AS (
  SELECT t.doc_id, t.p, t.words[t.p] AS word, g.p IS NOT NULL AS gone
  FROM t LEFT JOIN g ON t.doc_id = g.doc_id AND t.p = g.p
), a AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
         string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS kept
  FROM k GROUP BY doc_id
)
SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN a ON w.doc_id = a.doc_id
"""
