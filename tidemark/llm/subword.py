"""A text classifier over hashed subword embeddings.

A document is the mean of the vectors of its words and word pairs; the vector of a word is the mean
of those of its hash and of its character n-grams. A linear softmax reads the mean. All vectors are
learned by stochastic gradient descent in numpy on a bounded sample, in one task, and every document is scored by
Spark tasks that hold the model, whose size is fixed by its parameters.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, cut

GRAMS = (3, 4, 5)
#: Words that a task remembers before it starts afresh; the table of their vectors has this many rows from the start.
REMEMBERED = 1 << 16
#: Characters of words that are turned into features at a time, and characters of texts that are split at a time.
WORD_CHARS, TEXT_CHARS = 1 << 15, 1 << 18
_PRIME = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of a saved model in a row.
MODEL_BYTES = 1 << 20
_SPACE = re.compile(r"\s").search


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 17
    dim: int = 16
    #: Passes over the sample, and the least number of steps; a small sample gets more passes.
    epochs: int = 6
    steps: int = 12_000
    rate: float = 0.6
    #: Bound on the training documents of a class: a sample by hash of doc_id.
    per_class: int = 1000
    seed: int = 7


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def _gram_ids(codes: np.ndarray, owner: np.ndarray, ends: np.ndarray, buckets: int, before: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, owners) of the character n-grams that start at ``before`` or earlier and end within their word."""
    at, ids, owners = np.arange(min(before, len(codes))), [], []
    for n in GRAMS:
        i = at[at + n <= ends[owner[: len(at)]]]
        h = np.full(len(i), np.uint64(n))
        for k in range(n):
            h = h * _PRIME + codes[i + k]
        ids.append((_mixed(h) % np.uint64(buckets)).astype(np.int64))
        owners.append(owner[i])
    return np.concatenate(ids), np.concatenate(owners)


def _codes(joined: str) -> np.ndarray:
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)


def _long_word(word: str, buckets: int) -> Iterator[tuple[np.uint64 | None, np.ndarray]]:
    """(None, ids of n-grams) for a portion of a long word after the other, at last (hash of the word, its id)."""
    marked, whole, power, most = f"<{word}>", 0, 1, max(GRAMS)
    for first in range(0, len(marked), WORD_CHARS):
        codes = _codes(marked[first : first + WORD_CHARS + most])
        own = codes[:WORD_CHARS]
        powers = np.cumprod(np.full(len(own), _PRIME), dtype=np.uint64) * np.uint64(power)
        whole += int((own * powers).sum(dtype=np.uint64))
        power = power * pow(int(_PRIME), len(own), 1 << 64) % (1 << 64)
        yield None, _gram_ids(codes, np.zeros(len(codes), np.int64), np.array([len(codes)]), buckets, WORD_CHARS)[0]
    hashed = _mixed(np.array([whole % (1 << 64)], np.uint64))
    yield hashed[0], (hashed % np.uint64(buckets)).astype(np.int64)


def word_features(words: list[str], buckets: int, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Portions (feature ids, index of the word that each belongs to), of bounded size whatever the words.

    Every word has a feature for itself and one for each of its character n-grams; ``hashes`` gets the words' hashes.
    """
    first = 0
    while first < len(words):
        last, chars = first, 0
        while last < len(words) and (chars := chars + len(words[last]) + 2) <= WORD_CHARS:
            last += 1
        if last == first:
            for whole, ids in _long_word(words[first], buckets):
                hashes[first] = 0 if whole is None else whole
                yield ids, np.full(len(ids), first)
            first += 1
            continue
        part = words[first:last]
        codes = _codes("".join(f"<{w}>" for w in part))
        sizes = np.fromiter(map(len, part), np.int64, len(part)) + 2
        ends = np.cumsum(sizes)
        starts, owner = ends - sizes, np.repeat(np.arange(len(part)), sizes)
        powers = np.cumprod(np.full(int(sizes.max()), _PRIME), dtype=np.uint64)
        whole = _mixed(np.add.reduceat(codes * powers[np.arange(len(codes)) - starts[owner]], starts))
        hashes[first:last] = whole
        ids, owners = _gram_ids(codes, owner, ends, buckets, len(codes))
        yield np.concatenate([(whole % np.uint64(buckets)).astype(np.int64), ids]), np.concatenate([np.arange(first, last), owners + first])
        first = last


def pair_features(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Ids of the pairs of neighbouring words; all pairs of a word with itself have one id."""
    pairs = np.where(hashes[:-1] == hashes[1:], _MIX, _mixed(hashes[:-1] * _PRIME + hashes[1:]))
    return (pairs % np.uint64(buckets)).astype(np.int64)


def word_slices(text: str | None) -> Iterator[list[str]]:
    """The words of a text, between white space, in slices of about ``TEXT_CHARS`` characters."""
    at, size = 0, len(text) if text else 0
    while at < size:
        found = _SPACE(text, at + TEXT_CHARS) if at + TEXT_CHARS < size else None
        end = found.start() if found else size
        if words := text[at:end].split():
            yield words
        at = end


def document_features(text: str | None, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Sparse features of one document: ids and weights that sum to 1; none for a text without words.

    The features of a word share the weight of one, as often as the word occurs, and each pair of
    neighbouring words has the weight of one. Memory is that of a slice of the text and of its distinct words.
    """
    total, words, last = np.zeros(buckets), 0, np.zeros(0, np.uint64)
    for part in word_slices(text):
        distinct, place = np.unique(np.array(part, object), return_inverse=True)
        counts, hashes, grams = np.bincount(place), np.zeros(len(distinct), np.uint64), np.zeros(len(distinct))
        portions = list(word_features(list(distinct), buckets, hashes))
        for _, owner in portions:
            grams += np.bincount(owner, minlength=len(grams))
        for ids, owner in portions:
            total += np.bincount(ids, (counts / grams)[owner], minlength=buckets)
        run = np.concatenate([last, hashes[place]])
        total += np.bincount(pair_features(run, buckets), minlength=buckets)
        words, last = words + len(part), run[-1:]
    unique = np.flatnonzero(total)
    return unique, (total[unique] / max(1, 2 * words - 1)).astype(np.float32)


@dataclass
class Model:
    """``labels`` are the classes; ``shift`` is added to the logits (to restore the classes' shares)."""

    settings: Settings
    labels: list
    vectors: np.ndarray
    weights: np.ndarray
    shift: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, means: np.ndarray) -> np.ndarray:
        logits = (means @ self.weights[:, :-1].T + self.weights[:, -1] + self.shift) / self.temperature
        e = np.exp(logits - logits.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], labels: list, settings: Settings) -> Model:
    """Stochastic gradient descent over rows (index of the label, feature ids, weights)."""
    rng = np.random.default_rng(settings.seed)
    vectors = rng.uniform(-1 / settings.dim, 1 / settings.dim, (settings.buckets, settings.dim)).astype(np.float32)
    weights = np.zeros((len(labels), settings.dim + 1), np.float32)
    epochs = max(settings.epochs, -(-settings.steps // max(1, len(rows))))
    steps, done = epochs * max(1, len(rows)), 0
    for _ in range(epochs if rows else 0):
        for n in rng.permutation(len(rows)):
            label, ids, share = rows[n]
            rate = settings.rate * (1 - done / steps)
            done += 1
            mean = np.append(share @ vectors[ids], np.float32(1))
            logits = weights @ mean
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = p @ weights[:, :-1]
            weights -= rate * np.outer(p, mean)
            vectors[ids] -= (rate * 4) * np.outer(share, back)
    return Model(settings, labels, vectors, weights, np.zeros(len(labels), np.float32))


def means(model: Model, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> np.ndarray:
    return np.array([share @ model.vectors[ids] for _, ids, share in rows], np.float32).reshape(len(rows), -1)


def calibrate(model: Model, rows: list[tuple[int, np.ndarray, np.ndarray]], lost: float = 0.001) -> Model:
    """Fit the temperature on rows not trained on, and the score below which a prediction is rejected.

    The threshold loses the share ``lost`` of the rows that are predicted rightly, and is at most 0.5.
    """
    if not rows:
        return model
    truth, mean = np.array([r[0] for r in rows]), means(model, rows)

    def loss(t: float) -> float:
        model.temperature = t
        return -np.log(model.probabilities(mean)[np.arange(len(truth)), truth] + 1e-12).mean()

    model.temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)
    p = model.probabilities(mean)
    right = p.max(1)[p.argmax(1) == truth]
    model.threshold = float(min(0.5, np.quantile(right, lost))) if len(right) else 0.0
    return model


def _sample(docs: DataFrame, labelled: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, label, ids, share): the features of at most ``per_class`` documents of each label.

    ``labelled`` has doc_id and label, without nulls. The sample takes the least hashes of doc_id. Only
    hashes below a threshold compete for it, set by the number of a class's ids so that about twice
    the bound pass; so few rows meet in one task at every size of the corpus. Repeated rows count
    once; if an id has several texts, that of the least hash is learned. The sample's ids, bounded by the parameter, are sent to the tasks that read the texts. If
    ``docs`` has the column label too, a text is learned with its own label only, else with each
    that its doc_id has.
    """
    bound_batches(docs.sparkSession)
    place = F.xxhash64("doc_id")
    ids = labelled.groupBy("label").agg(F.approx_count_distinct("doc_id").alias("_ids"))  # one row a class, as the model has
    portion = F.lit(2.0 * settings.per_class + 100) / F.col("_ids")
    few = labelled.select("doc_id", "label").join(F.broadcast(ids), "label").where(place / F.lit(2.0**63) < 2 * portion - 1)
    nth = F.row_number().over(Window.partitionBy("label").orderBy(place, "doc_id"))
    chosen = few.select("doc_id", "label").distinct().withColumn("nth", nth).where(F.col("nth") <= settings.per_class).drop("nth")
    keys = ["doc_id", *[c for c in docs.columns if c == "label"]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [document_features(t, settings.buckets) for t in batch.column(2).to_pylist()]
            columns = [pa.array([x[k].astype(t).tobytes() for x in found], pa.binary()) for k, t in ((0, "<i4"), (1, "<f4"))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "label", "ids", "share"])

    texts = docs.select(*keys, F.col("text").cast("string")).join(F.broadcast(chosen), keys)
    # One text of an id and label, so repeated ids do not break the bound; a hot one is combined before the shuffle.
    texts = texts.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text"))
    label = labelled.schema["label"].dataType.simpleString()
    return cut(texts.mapInArrow(run, f"doc_id long, label {label}, ids binary, share binary"), "features")


def _in_order(found: Iterable[tuple]) -> tuple[list, list[tuple[int, np.ndarray, np.ndarray]]]:
    """Labels in order and rows (index of the label, feature ids, weights) in an order of their own."""
    rows = [(doc_id, label, np.frombuffer(ids, "<i4"), np.frombuffer(share, "<f4")) for doc_id, label, ids, share in found]
    rows.sort(key=lambda r: (r[0], r[1], len(r[2]), float(r[3].sum())))
    labels = sorted({r[1] for r in rows})
    return labels, [(labels.index(r[1]), r[2], r[3]) for r in rows]


def sample_features(docs: DataFrame, labelled: DataFrame, settings: Settings) -> tuple[list, list[tuple[int, np.ndarray, np.ndarray]]]:
    """Labels in order and the features of at most ``per_class`` documents of each label, as ``_sample`` takes them."""
    # Read a part at a time: the driver's JVM never holds the whole sample.
    return _in_order(_sample(docs, labelled, settings).toLocalIterator())


def learned(docs: DataFrame, labelled: DataFrame, settings: Settings, fit: Callable[[list, list], Model]) -> Model:
    """``fit`` of what ``sample_features`` gives, run in a task: the driver gets the model and never the sample.

    The sample is bounded by ``per_class``, and so is that task. No rows are fitted as no labels and no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = fit(*_in_order(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)))
        whole = pickle.dumps(model, pickle.HIGHEST_PROTOCOL)
        for n, at in enumerate(range(0, len(whole), MODEL_BYTES)):
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([whole[at : at + MODEL_BYTES]], pa.binary())], ["n", "part"])

    found = _sample(docs, labelled, settings)
    parts = cut(found.coalesce(1).mapInArrow(run, "n int, part binary"), "model")
    whole = b"".join(r["part"] for r in sorted(parts.toLocalIterator(), key=lambda r: r["n"]))
    return pickle.loads(whole) if whole else fit([], [])


class Scorer:
    """Means of whole documents for one task; remembers the vectors of words in a table of fixed size."""

    def __init__(self, model: Model) -> None:
        self.model, self.known = model, {}
        self.vectors = np.zeros((REMEMBERED, model.settings.dim), np.float32)
        self.hashes = np.zeros(REMEMBERED, np.uint64)

    def learn(self, words: set[str]) -> None:
        """Vectors of the words that are not known yet; all of ``words`` are known afterwards."""
        new = words.difference(self.known)
        if len(self.known) + len(new) > len(self.vectors):
            self.known, new = {}, words
        if len(new) > len(self.vectors):  # a slice of text with more distinct words than the table has rows
            self.vectors, self.hashes = np.zeros((len(new), self.vectors.shape[1]), np.float32), np.zeros(len(new), np.uint64)
        new, buckets = sorted(new), self.model.settings.buckets
        for at in range(0, len(new), 2000):
            part, row = new[at : at + 2000], len(self.known)
            sums, grams = self.vectors[row : row + len(part)], np.zeros(len(part), np.float32)
            sums[:] = 0
            for ids, owner in word_features(part, buckets, self.hashes[row : row + len(part)]):
                order = np.argsort(owner, kind="stable")
                own, starts = np.unique(owner[order], return_index=True)
                sums[own] += np.add.reduceat(self.model.vectors[ids[order]], starts, axis=0)
                grams += np.bincount(owner, minlength=len(part)).astype(np.float32)
            sums /= grams[:, None]
            self.known.update(zip(part, range(row, row + len(part)), strict=True))

    def means(self, texts: list[str | None]) -> np.ndarray:
        """The mean vector of each text, read in slices; zero for one without words."""
        totals, sizes = np.zeros((len(texts), self.model.settings.dim)), np.zeros(len(texts), np.int64)
        last: list[np.ndarray] = [self.hashes[:0]] * len(texts)
        waiting: list[tuple[int, list[str]]] = []
        room = 0
        for n, text in enumerate(texts):
            for words in word_slices(text):
                waiting.append((n, words))
                room += len(words)
                if room > TEXT_CHARS // 4:
                    self._add(waiting, totals, sizes, last)
                    waiting, room = [], 0
        self._add(waiting, totals, sizes, last)
        return (totals / np.maximum(1, 2 * sizes - 1)[:, None]).astype(np.float32)

    def _add(self, waiting: list[tuple[int, list[str]]], totals: np.ndarray, sizes: np.ndarray, last: list[np.ndarray]) -> None:
        self.learn(set().union(*(words for _, words in waiting)))
        for n, words in waiting:
            at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            run = np.concatenate([last[n], self.hashes[at]])
            totals[n] += self.vectors[at].sum(0, dtype=np.float64)
            totals[n] += self.model.vectors[pair_features(run, self.model.settings.buckets)].sum(0, dtype=np.float64)
            sizes[n] += len(words)
            last[n] = run[-1:].copy()


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (doc_id if none are named) with _has_letter and _p, the probabilities.

    ``_p`` is in the order of ``model.labels``. A null or empty text, or one without words, gets what
    the classes' shares alone give.
    """
    bound_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    keep = ["doc_id"] if keep is None else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        letter, scorer = regex.compile(r"\p{L}").search, Scorer(sent.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                texts = batch.column(batch.num_columns - 1).to_pylist()
                p = scorer.model.probabilities(scorer.means(texts)).astype(np.float64)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * p.shape[1]), pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array([bool(t and letter(t)) for t in texts], pa.bool_()), flat], [*keep, "_has_letter", "_p"]
                )

    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, kinds + "_has_letter boolean, _p array<double>")
