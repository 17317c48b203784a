"""Phrase collocations: exact counts of all frequent phrases of up to five words, and how much their parts belong together.

Counting every phrase of a corpus would shuffle several times its size. Instead sketches say which
phrases may be frequent: each phrase is hashed to one of many cells, and a cell's count is an upper
bound for each phrase in it.

* Words and pairs of words are sketched over the texts. A text is then cut into stretches: words whose
  neighbours in the piece form pairs that may be frequent stay together. No frequent phrase crosses a
  cut, words and pairs that are rare are dropped, and equal stretches are one row with a count: tasks
  count what they meet and send it packed by shard, and shards merge.
* Longer phrases are sketched over the stretches. A candidate is a phrase that may be frequent, and so
  may all phrases within it.
* Each shard compiles the candidates that it meets, and single words, into Aho-Corasick automata, a
  bounded portion of stretches at a time, and scans them. Patterns and stretches are guarded: a blank on
  either side of each word and a line end after each stretch, so a match is whole words of one piece. All
  matches count, overlapping ones too.

The shards' counts are summed; they are exact, and thresholds are applied to nothing else. The texts are
read three times, by maps. A task sends no more of a sketch than it has met, and a finished sketch is
one bit a cell, at most ``MAX_CELLS`` bits. Where a corpus is so large that so many cells no longer tell
frequent phrases from others (some 2 ** 35 words), stretches get longer and candidates more; the result
is the same.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, cut, table

LEAST, LONGEST, TOP = 100, 5, 2000
#: Bytes of text for a cell of a sketch, and bounds of the cells.
BYTES_A_CELL, MIN_CELLS, MAX_CELLS = 8, 1 << 16, 1 << 29
#: Cells of a sketch that are summed together.
PART = 1 << 16
#: Bytes of texts for a shard of stretches, shards at least, and bytes that are scanned with one automaton.
SHARD_BYTES, LEAST_SHARDS, PORTION = 32 << 20, 16, 1 << 19
#: Bytes of text that are hashed at a time, occurrences that are counted at a time, and stretches that a task counts before it sends them.
SLICE, PENDING, HELD = 1 << 19, 1 << 20, 1 << 18
#: What parts pieces, and what parts words.
DELIMITERS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"

_CLASS = np.zeros(256, np.uint8)
_CLASS[list(BLANKS)], _CLASS[list(DELIMITERS)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GUARDED = bytes(10 if _CLASS[b] == 2 else 32 if _CLASS[b] == 1 else int(_LOWER[b]) for b in range(256))
#: Odd bases of the rolling hashes: the first tells words apart, the second confirms it.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class _Powers:
    """Powers of the rolling hashes' bases and of their inverses, as many as were asked for."""

    known: list[tuple[np.ndarray, np.ndarray]] = [(np.ones(1, np.uint64), np.ones(1, np.uint64))] * len(_BASES)

    @classmethod
    def upto(cls, n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.known[0][0]) < n:
            size = max(n + n // 4, SLICE + 1)
            power = lambda b: np.cumprod(np.r_[np.uint64(1), np.full(size, b, np.uint64)], dtype=np.uint64)
            cls.known = [(power(b), power(pow(b, -1, 1 << 64))) for b in _BASES]
        return cls.known[base]


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = 0) -> np.ndarray:
    """Hashes of the sequences of ``values`` from each start to its end."""
    up, down = _Powers.upto(len(values) + 1, base)
    sums = np.r_[np.uint64(0), np.cumsum(values * up[: len(values)], dtype=np.uint64)]
    return _mixed((sums[ends] - sums[starts]) * down[starts])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class _Words:
    """The words of a stretch of bytes: where they start and end, their piece, their text's number and their hash."""

    def __init__(self, data: np.ndarray, texts: np.ndarray) -> None:
        """``texts`` are the places where a text begins; the first is 0."""
        kind = _CLASS[data]
        begins = np.zeros(len(data) + 1, bool)
        begins[texts] = True
        word = kind == 0
        before, after = np.r_[False, word[:-1]], np.r_[word[1:], False]
        self.start = np.flatnonzero(word & (~before | begins[:-1]))
        self.end = np.flatnonzero(word & (~after | begins[1:])) + 1
        self.piece = np.cumsum((kind == 2) | begins[:-1])[self.start]
        self.text = np.searchsorted(texts, self.start, "right") - 1
        self.lower = _LOWER[data]
        self.hash = self.hashed(0)

    def hashed(self, base: int) -> np.ndarray:
        return _spans(self.lower.astype(np.uint64) + np.uint64(1), self.start, self.end, base)

    def phrases(self, languages: np.ndarray) -> list[np.ndarray]:
        """Hashes of the phrases of 1 to ``LONGEST`` words that begin at each word, with their language."""
        found = [_mixed(self.hash ^ languages[self.text])]
        for k in range(1, LONGEST):
            found.append(_mixed(found[-1][: max(0, len(self.hash) - k)] * np.uint64(_BASES[0]) + self.hash[k:]))
        return found

    def within(self, k: int) -> np.ndarray:
        """Whether the k words from each word on are of one piece."""
        return self.piece[: max(0, len(self.piece) - k + 1)] == self.piece[k - 1 :]

    def phrase(self, i: int, k: int) -> bytes:
        return b" ".join(self.lower[self.start[j] : self.end[j]].tobytes() for j in range(i, i + k))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Words, np.ndarray, pa.RecordBatch]]:
    """Batches of (lang, text as binary, ...) -> words of about ``SLICE`` bytes at a time, their texts' languages as hashes, and their rows.

    A slice ends where a text or a piece does.
    """
    hashes: dict[str, int] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        names, column = batch.column(0).to_pylist(), batch.column(1)
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        starts = ends[:-1] - ends[0]
        keys = np.array([hashes.setdefault(x, xxhash.xxh3_64_intdigest(x)) if x not in hashes else hashes[x] for x in names], np.uint64)
        at = 0
        while at < len(data):
            size, end = SLICE, len(data)
            while at + size < len(data):
                breaks = np.flatnonzero(_CLASS[data[at : at + size]] == 2)
                last = max(starts[np.searchsorted(starts, at + size, "right") - 1], at + breaks[-1] + 1 if len(breaks) else 0)
                if last > at:
                    end = int(last)
                    break
                size *= 2
            first, stop = np.searchsorted(starts, at, "right") - 1, np.searchsorted(starts, end, "left")
            yield _Words(data[at:end], np.maximum(starts[first:stop] - at, 0)), keys[first:stop], batch.slice(first, stop - first)
            at = end


def _cells(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _met(sketch: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (sketch[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 > 0


def _linked(words: _Words, hashes: list[np.ndarray], pairs: np.ndarray, bits: int) -> np.ndarray:
    """Whether each word and the next are a pair that may be frequent."""
    return words.within(2) & _met(pairs, _cells(hashes[1], bits))


def _possible(words: _Words, hashes: list[np.ndarray], pairs: np.ndarray, longer: np.ndarray | None, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(k, the words where a phrase of k > 2 words may be frequent): by its pairs, and with ``longer`` by all phrases within it."""
    may = _linked(words, hashes, pairs, bits)
    for k in range(3, LONGEST + 1):
        may = may[:-1] & may[1:]  # both phrases of one word less; a piece that holds both holds this one
        if longer is not None:
            at = np.flatnonzero(may)
            may[at] = _met(longer, _cells(hashes[k - 1][at], bits))
        yield k, np.flatnonzero(may)


_SKETCH = ["part", "cells", "counts"]


def _sketch(batches: Iterator[pa.RecordBatch], bits: int, least: int, pairs: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """(lang, text, n) -> (part, cells, counts): the counts of phrases by cell, none above ``least``.

    Of words and pairs, or with ``pairs`` of longer phrases; each counts n times.
    """
    kind = np.uint8 if least < 256 else np.uint32
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        every, weights = (np.concatenate(x) for x in zip(*waiting, strict=True))
        waiting.clear()
        if not len(every):
            return
        order = np.argsort(every)
        every = every[order]
        heads = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
        cells, counts = every[heads], np.add.reduceat(weights[order], heads)
        part = cells // PART
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        rows = list(zip(starts.tolist(), [*starts[1:].tolist(), len(cells)], strict=True))
        small, capped = (cells % PART).astype(np.uint16), np.minimum(counts, least).astype(kind)
        for at in range(0, len(rows), 256):
            some = rows[at : at + 256]
            columns = [pa.array([int(part[a]) for a, _ in some], pa.int32())]
            columns += [pa.array([x[a:b].tobytes() for a, b in some], pa.binary()) for x in (small, capped)]
            yield pa.RecordBatch.from_arrays(columns, _SKETCH)

    for words, languages, rows in _slices(batches):
        hashes, weight = words.phrases(languages), np.minimum(rows.column(2).to_numpy(), least)[words.text]
        if pairs is None:
            two = np.flatnonzero(words.within(2))
            waiting += [(_cells(hashes[0], bits), weight), (_cells(hashes[1][two], bits), weight[two])]
        else:
            waiting += [(_cells(hashes[k - 1][at], bits), weight[at]) for k, at in _possible(words, hashes, pairs, None, bits)]
        if sum(len(x) for x, _ in waiting) > PENDING:
            yield from flush()
    if waiting:
        yield from flush()


def _summed(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Rows (part, cells, counts) by part -> (part, bits): the cells whose sum reaches ``least``."""
    kind = np.uint8 if least < 256 else np.uint32
    current, sums = None, np.zeros(PART, np.int64)
    for batch in batches:
        for part, cells, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if part != current:
                if current is not None and (sums >= least).any():
                    yield _bits(current, sums >= least)
                current, sums = part, np.zeros(PART, np.int64)
            sums[np.frombuffer(cells, np.uint16)] += np.frombuffer(counts, kind)
    if current is not None and (sums >= least).any():
        yield _bits(current, sums >= least)


def _bits(part: int, heavy: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(heavy, bitorder="little").tobytes()], pa.binary())], ["part", "bits"])


def sketch(texts: DataFrame, bits: int, least: int, pairs: np.ndarray | None = None) -> np.ndarray:
    """One bit for each of 2 ** ``bits`` cells: whether the phrases hashed to it occur ``least`` times or more, together.

    ``texts`` has lang, text (binary) and n, how often the text counts. Without ``pairs`` the phrases are
    words and pairs of words, with it those of three words or more whose pairs are all in it. The result
    is at most ``MAX_CELLS`` bits.
    """
    known = None if pairs is None else texts.sparkSession.sparkContext.broadcast(pairs)
    met = texts.mapInArrow(lambda b: _sketch(b, bits, least, known and known.value), "part int, cells binary, counts binary")
    rows = met.repartition("part").sortWithinPartitions("part").mapInArrow(lambda b: _summed(b, least), "part int, bits binary").collect()
    out = np.zeros((1 << bits) // 8, np.uint8)
    for part, heavy in rows:
        out[part * PART // 8 : (part + 1) * PART // 8] = np.frombuffer(heavy, np.uint8)
    return out


class _Held:
    """Counts of texts by language until they are sent."""

    def __init__(self) -> None:
        self.counts: dict[str, dict[bytes, int]] = {}

    def add(self, lang: str, text: bytes, n: int) -> None:
        own = self.counts.setdefault(lang, {})
        own[text] = own.get(text, 0) + n

    def batches(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        """All that is held, if there are more than ``least`` texts."""
        if sum(map(len, self.counts.values())) > least:
            while self.counts:
                lang, own = self.counts.popitem()
                columns = [pa.array([lang] * len(own), pa.string()), pa.array(own.keys(), pa.binary()), pa.array(own.values(), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "text", "n"])

    def packed(self, shards: int, least: int = 0) -> Iterator[pa.RecordBatch]:
        """The same as one row for each language and shard: (shard, lang, texts, counts). No text has a line end."""
        for batch in self.batches(least):
            lang, texts, counts = batch.column(0)[0].as_py(), batch.column(1).to_pylist(), batch.column(2).to_numpy()
            shard = np.fromiter((zlib.crc32(t) % shards for t in texts), np.int32, len(texts))
            order = np.argsort(shard, kind="stable")
            cuts = np.flatnonzero(np.diff(shard[order])) + 1
            parts = np.split(order, cuts)
            columns = [
                pa.array([int(shard[p[0]]) for p in parts], pa.int32()), pa.array([lang] * len(parts), pa.string()),
                pa.array([b"\n".join([texts[i] for i in p.tolist()]) for p in parts], pa.binary()), pa.array([counts[p].tobytes() for p in parts], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, _PACKED)


_PACKED = ["shard", "lang", "texts", "counts"]


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed rows by shard and language -> (lang, text, n), each text once: a shard holds all that there is of it."""
    key: tuple[int, str] | None = None
    held = _Held()
    for batch in batches:
        for shard, lang, texts, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (shard, lang) != key:
                yield from held.batches()
                key = shard, lang
            for text, n in zip(texts.split(b"\n"), np.frombuffer(counts, np.int64).tolist(), strict=True):
                held.add(lang, text, n)
    yield from held.batches()


def _stretches(batches: Iterator[pa.RecordBatch], bits: int, pairs: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    """(lang, text, n) -> the stretches of the texts with their counts, packed by shard, and with an empty text the number of words."""
    held = _Held()
    for words, languages, rows in _slices(batches):
        names, n = rows.column(0).to_pylist(), len(words.start)
        for text, own in zip(*np.unique(words.text, return_counts=True), strict=True):
            held.add(names[text], b"", int(own))
        if not n:
            continue
        hashes = words.phrases(languages)
        linked = _linked(words, hashes, pairs, bits)
        start = np.flatnonzero(np.r_[True, ~linked])
        end = np.r_[start[1:], n]
        keep = (end - start > 1) | _met(pairs, _cells(hashes[0][start], bits))
        start, end = start[keep], end[keep]
        language = languages[words.text[start]]
        mark, sure = (_spans(h, start, end, base) ^ language for base, h in enumerate((words.hash, words.hashed(1))))
        _, first, own, counts = np.unique(mark, return_index=True, return_inverse=True, return_counts=True)
        if (sure[first][own] != sure).any():  # two stretches of one hash: each by itself
            first, counts = np.arange(len(start)), np.ones(len(start), np.int64)
        for i, k, lang, times in zip(start[first].tolist(), (end - start)[first].tolist(), words.text[start[first]].tolist(), counts.tolist(), strict=True):
            held.add(names[lang], words.phrase(i, k), times)
        yield from held.packed(shards, HELD)
    yield from held.packed(shards)


def guarded(text: bytes) -> str:
    """A text in lower case with one blank on either side of each word and of each line end that parts pieces; a byte is a character."""
    out = b" " + text.translate(_GUARDED).replace(b"\n", b" \n ") + b" "
    while b"  " in out:
        out = out.replace(b"  ", b" ")
    return out.decode("latin-1")


def _matches(lang: str, stretches: list[bytes], counts: list[int], bits: int, pairs: np.ndarray, longer: np.ndarray) -> Iterator[tuple[bytes, int]]:
    """(phrase, n) of the candidates, and of the words, of one portion of stretches."""
    data = np.frombuffer(b"\n".join(stretches), np.uint8)
    words = _Words(data, np.zeros(1, np.int64))
    hashes = words.phrases(np.array([xxhash.xxh3_64_intdigest(lang)], np.uint64))
    patterns: list[bytes] = []
    for k, at in [(1, np.arange(len(words.start))), (2, np.flatnonzero(_linked(words, hashes, pairs, bits))), *_possible(words, hashes, pairs, longer, bits)]:
        first = np.unique(hashes[k - 1][at], return_index=True)[1]
        patterns += [words.phrase(i, k) for i in at[first].tolist()]
    built = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, phrase in enumerate(patterns):
        built.add_word(f" {phrase.decode('latin-1')} ", i)
    built.make_automaton()
    text = guarded(data.tobytes())
    hits = np.fromiter(built.iter(text), [("end", np.int64), ("pattern", np.int64)])
    ends = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 10)
    totals = np.zeros(len(patterns), np.int64)
    np.add.at(totals, hits["pattern"], np.array(counts, np.int64)[np.searchsorted(ends, hits["end"])])
    return zip(patterns, totals.tolist(), strict=True)


def _scan(batches: Iterator[pa.RecordBatch], bits: int, pairs: np.ndarray, longer: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A shard's stretches (lang, text, n), by language -> (lang, text, n) of the phrases matched, a portion at a time."""
    current: str | None = None
    stretches: list[bytes] = []
    counts: list[int] = []
    size = 0
    held = _Held()

    def add() -> None:
        for phrase, n in _matches(current, stretches, counts, bits, pairs, longer):
            held.add(current, phrase, n)
        stretches.clear()
        counts.clear()

    for batch in batches:
        for lang, text, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if stretches and (lang != current or size > PORTION):
                add()
                size = 0
            current = lang
            stretches.append(text)
            counts.append(n)
            size += len(text) + 1
        yield from held.batches(HELD)
    if stretches:
        add()
    yield from held.batches()


def frequencies(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, n): exact counts of the phrases and words that occur ``least`` times, of some others, and of all words (empty phrase).

    See ``collocations`` for what a phrase is.
    """
    bound_batches(docs.sparkSession)
    context, text = docs.sparkSession.sparkContext, F.col("text").cast("string")
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    texts = docs.where(text.isNotNull()).select(lang, text.cast("binary").alias("text"), F.lit(1).cast("long").alias("n"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max(size // BYTES_A_CELL, MIN_CELLS), MAX_CELLS).bit_length() - 1
    shards = max(LEAST_SHARDS, -(-size // SHARD_BYTES))
    pairs = context.broadcast(sketch(texts, bits, least))

    def stretched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _stretches(batches, bits, pairs.value, shards)

    packed = texts.mapInArrow(stretched, "shard int, lang string, texts binary, counts binary").repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "lang")
    found = cut(packed.mapInArrow(_merged, "lang string, text binary, n long"), "stretches")
    stretches = found.where(F.octet_length("text") > 0)
    longer = context.broadcast(sketch(stretches, bits, least, pairs.value))
    dealt = stretches.repartition(shards, "lang", "text").sortWithinPartitions("lang")

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _scan(batches, bits, pairs.value, longer.value)

    met = dealt.mapInArrow(scanned, "lang string, text binary, n long")
    met = met.union(found.where(F.octet_length("text") == 0))
    return cut(met.groupBy("lang", F.col("text").cast("string").alias("phrase")).agg(F.sum("n").alias("n")), "counts")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = 100) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the ``top`` phrases of each language.

    ``docs`` needs lang and text. Texts are lower-cased (A-Z), split into pieces at ``DELIMITERS`` and
    into words at blanks; null texts and pieces without words count nothing, a null lang is ``und``,
    repeated rows count as often as they come, and other columns are ignored. Phrases of 2 to 5 words
    with ``a`` >= ``least`` occurrences, overlapping ones included, are scored by the worst of their cuts
    into two parts that occur ``l`` and ``r`` times among ``n`` words: 1000 * a * n / (l * r), rounded
    down; equal cuts go to the shorter first part. A phrase goes if a longer one that holds it has at
    least ``share`` percent of its occurrences. Ranks go by score and a, descending, then by phrase. No
    rows give no rows. A text's own length bounds the memory, of which the scan needs a few times.
    """
    known = frequencies(docs, least)
    totals = known.where("phrase = ''").groupBy("lang").agg(F.sum("n").alias("n"))
    phrases = known.where(f"phrase <> '' AND n >= {int(least)}").select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    phrases = cut(phrases, "phrases")
    found = phrases.where("size(words) > 1")
    cuts = found.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.expr("slice(words, 1, k)"), " ").alias("first"), F.array_join(F.expr("slice(words, k + 1, size(words) - k)"), " ").alias("rest"))
    part = lambda name, count: phrases.select("lang", F.col("phrase").alias(name), F.col("a").alias(count))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "n")}
    exact = cuts.withColumns({f"_{c}": w for c, w in wide.items()})
    scored = exact.withColumn("score", F.expr("CAST((_a * _n * CAST(1000 AS DECIMAL(4,0))) div (_l * _r) AS BIGINT)"))
    worst = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r", "n")).alias("_w"))
    spans = [(start, k) for k in range(2, LONGEST) for start in range(1, LONGEST - k + 2)]
    inner = F.array(*[F.when(F.size("words") >= start + k - 1, F.when(F.size("words") > k, F.array_join(F.slice("words", start, k), " "))) for start, k in spans])
    holders = found.where("size(words) > 2").select("lang", F.explode(F.array_distinct(F.array_compact(inner))).alias("phrase"), F.col("a").alias("_top"))
    holders = holders.groupBy("lang", "phrase").agg(F.max("_top").alias("_top"))
    kept = worst.join(holders, ["lang", "phrase"], "left").where(F.col("_top").isNull() | (F.col("_top") * 100 < F.col("a") * share))
    kept = kept.select("lang", "phrase", "a", "_w.l", "_w.r", "_w.n", "_w.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first collocations of each language."""
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


OP12_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p
), i AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w
), g AS (
  SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase FROM i, range(1, 6) AS t(k) WHERE i + k - 1 <= len(words)
), f AS (
  SELECT lang, CAST(k AS INTEGER) AS k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100
), n AS (
  SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang
), c AS (
  SELECT lang, phrase, a, k, string_split(phrase, ' ') AS words FROM f WHERE k > 1
), s AS (
  SELECT c.lang, c.phrase, c.a, m.m, l.a AS l, r.a AS r, n.n, CAST((1000 * CAST(c.a AS HUGEINT) * n.n) // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
  FROM c JOIN range(1, 5) AS m(m) ON m.m < c.k JOIN f AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:m.m], ' ')
  JOIN f AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[m.m + 1:], ' ') JOIN n ON n.lang = c.lang
), b AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, m) = 1
), h AS (
  SELECT DISTINCT x.lang, array_to_string(x.words[i.i:i.i + j.j - 1], ' ') AS phrase, x.a FROM c AS x, range(1, 5) AS i(i), range(2, 5) AS j(j) WHERE j.j < x.k AND i.i + j.j - 1 <= x.k
), o AS (
  SELECT lang, phrase, max(a) AS top FROM h GROUP BY ALL
)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rank, b.phrase, b.a, b.l, b.r, b.n, b.score
FROM b LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase WHERE o.top IS NULL OR 100 * o.top < 100 * b.a QUALIFY rank <= 2000
"""
