"""Byte-level BPE encoding and decoding with DuckDB queries in each partition.

A text is split by the pattern of the vocabulary. Each distinct piece is encoded once: a recursive
query holds one row for each token and position, joins neighbours to the merge table, contracts the
leftmost pair of least rank of every piece, and ends when no piece has such a pair. Decoding joins
the ids to the vocabulary and concatenates the bytes by an aggregation ordered by position.

Contracting one pair of a piece in each step takes as many steps as a piece has merges, which is
right for words: thousands of pieces advance together. For pieces above ``LONG_PIECE`` bytes (runs
of one kind of character) a second recursive query contracts the leftmost pairs of the least rank
together in one step, up to the first whose contraction gives rise to a pair of lower rank; that is
the order of one at a time. A query stops after so many steps that its rows stay below ``QUERY_ROWS``,
or after one, and goes on from where it stopped; so its memory does not depend on the number of steps.

Texts are read in slices of pieces and decoded in slices of tokens. The memory for a text is that of
the text, of its ids and of one slice; a single piece of millions of bytes takes DuckDB the memory of
its rows, which it may spill to the worker's own temporary folder.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, table

LONG_PIECE = 512
#: Rows that one recursive query may add up, pieces of a slice, and tokens that one decoding query takes.
QUERY_ROWS = 500_000
SLICE_PIECES = 200_000
DECODE_TOKENS = 200_000
#: Pieces, and their bytes, that a Python worker remembers before it starts afresh.
REMEMBERED, REMEMBERED_BYTES = 1 << 19, 1 << 24

#: ``place`` numbers the positions of all pieces: piece * _SPOTS + position. A pair is head * _TOKENS + tail.
_SPOTS, _TOKENS = 2 * LONG_PIECE, 1 << 24
_ENCODE = f"""
WITH RECURSIVE t(step, place, tok) AS (
  SELECT 0, place, tok FROM start
  UNION ALL
  SELECT t.step + 1, CASE WHEN t.place > b.spot THEN t.place - 1 ELSE t.place END,
         CASE WHEN t.place = b.spot THEN b.merged ELSE t.tok END
  FROM t JOIN (
    SELECT piece, best % {_SPOTS} + piece * {_SPOTS} AS spot, best // {_SPOTS} AS merged
    FROM (
      SELECT l.place // {_SPOTS} AS piece, min(m.merged * {_SPOTS} + l.place % {_SPOTS}) AS best
      FROM t AS l JOIN t AS r ON r.place = l.place + 1 JOIN merges AS m ON m.pair = l.tok * {_TOKENS} + r.tok
      GROUP BY ALL
    ) AS q
  ) AS b ON t.place // {_SPOTS} = b.piece
  WHERE t.place <> b.spot + 1
), last AS (SELECT place // {_SPOTS} AS piece, max(step) AS step FROM t GROUP BY ALL)
SELECT t.place, t.tok FROM t JOIN last ON t.place // {_SPOTS} = last.piece AND t.step = last.step ORDER BY t.place
"""
#: For one long piece. ``n`` counts tokens; of pairs of least rank in a row every other is taken; ``low`` has the pairs
#: that rank below one of their own parts, the only ones that a contraction can give rise to before its rank is done.
_ENCODE_LONG = f"""
WITH RECURSIVE t(step, n, tok) AS (
  SELECT 0, n, tok FROM start
  UNION ALL
  SELECT step + 1, row_number() OVER (ORDER BY n), CASE WHEN taken THEN merged ELSE tok END
  FROM (
    SELECT *, coalesce(lag(taken) OVER (ORDER BY n), false) AS gone
    FROM (
      SELECT * EXCLUDE taken, taken AND n <= coalesce(min(CASE WHEN risk THEN n END) OVER (), n) AS taken
      FROM (
        SELECT p.*, taken AND (before.merged < p.merged OR after.merged < p.merged) AS risk
        FROM (
          SELECT *, CASE WHEN taken THEN (CASE WHEN lag(taken, 2) OVER (ORDER BY n) THEN merged ELSE lag(tok) OVER (ORDER BY n) END) * {_TOKENS} + merged END AS left_pair,
                 CASE WHEN taken THEN merged * {_TOKENS} + lead(tok, 2) OVER (ORDER BY n) END AS right_pair
          FROM (
            SELECT *, best AND (row_number() OVER (PARTITION BY run ORDER BY n) - CASE WHEN run = 0 THEN 0 ELSE 1 END) % 2 = 1 AS taken
            FROM (
              SELECT *, n - sum(CAST(best AS INT)) OVER (ORDER BY n) AS run
              FROM (
                SELECT q.*, m.merged, coalesce(m.merged = min(m.merged) OVER (), false) AS best, count(m.merged) OVER () AS pairs
                FROM (SELECT *, tok * {_TOKENS} + lead(tok) OVER (ORDER BY n) AS pair FROM t) AS q LEFT JOIN merges AS m ON m.pair = q.pair
              ) WHERE pairs > 0
            )
          )
        ) AS p LEFT JOIN low AS before ON before.pair = p.left_pair LEFT JOIN low AS after ON after.pair = p.right_pair
      )
    )
  )
  WHERE NOT gone AND step < $steps
)
SELECT tok, step FROM t WHERE step = (SELECT max(step) FROM t) ORDER BY n
"""
_DECODE = """
SELECT doc, string_agg(bytes, '' ORDER BY pos) AS bytes
FROM tokens JOIN vocabulary ON tokens.id = vocabulary.id GROUP BY doc ORDER BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: token bytes in base64 and rank, a line each."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def _connect():
    import duckdb

    return duckdb.connect(":memory:", config={"threads": "1", "memory_limit": "400MB", "temp_directory": tempfile.gettempdir() + "/duckdb-spill"})


class Encoder:
    """Encodes pieces of text by a vocabulary; ``known`` has the ids of a piece as unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks, self.known, self.db = ranks, {}, _connect()
        self.single, self.size = np.array([ranks[bytes([b])] for b in range(256)], np.int64), 0
        merges = [
            (ranks[token[:i]] * _TOKENS + ranks[token[i:]], rank)
            for token, rank in ranks.items() for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks
        ]
        self._load("merges", _columns(merges, 2), ["pair", "merged"])
        parts = [(p, m) for p, m in merges if m < max(p >> 24 if p >> 24 not in self.single else -1, p % _TOKENS if p % _TOKENS not in self.single else -1)]
        self._load("low", _columns(parts, 2), ["pair", "merged"])

    def _load(self, name: str, columns: list[pa.Array], names: list[str]) -> None:
        self.db.register("incoming", pa.table(columns, names))
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def learn(self, pieces: set[str]) -> None:
        """Encode the pieces that are not known yet; all of ``pieces`` are known afterwards."""
        if len(self.known) > REMEMBERED or self.size > REMEMBERED_BYTES:
            self.known, self.size = {}, 0
        waiting = []
        for piece in pieces.difference(self.known):
            data = piece.encode("utf-8")
            self.size += len(data)
            if data in self.ranks:
                self.known[piece] = self.ranks[data].to_bytes(4, "little")
            elif len(data) > LONG_PIECE:
                self.known[piece] = self._long(data)
            else:
                waiting.append((len(data), piece, data))
        waiting.sort()
        portion, rows = [], 0
        for length, piece, data in waiting:
            if portion and rows + length * length // 2 > QUERY_ROWS:
                self._query(portion)
                portion, rows = [], 0
            portion.append((piece, data))
            rows += length * length // 2
        if portion:
            self._query(portion)

    def _query(self, portion: list[tuple[str, bytes]]) -> None:
        lengths = np.array([len(data) for _, data in portion])
        first = np.cumsum(lengths) - lengths
        piece = np.repeat(np.arange(len(portion)), lengths)
        place = piece * _SPOTS + np.arange(lengths.sum()) - first[piece]
        tok = self.single[np.frombuffer(b"".join(data for _, data in portion), np.uint8)]
        self._load("start", [pa.array(place), pa.array(tok)], ["place", "tok"])
        found = self.db.execute(_ENCODE).fetchnumpy()
        ids, ends = found["tok"].astype("<u4").tobytes(), (4 * np.searchsorted(found["place"], (np.arange(len(portion)) + 1) * _SPOTS)).tolist()
        for (name, _), start, end in zip(portion, [0, *ends], ends, strict=False):
            self.known[name] = ids[start:end]

    def _long(self, data: bytes) -> bytes:
        """The ids of one long piece, by as many recursive queries as its rows need."""
        tok = self.single[np.frombuffer(data, np.uint8)]
        while True:
            steps = max(1, QUERY_ROWS // len(tok))
            self._load("start", [pa.array(np.arange(1, len(tok) + 1)), pa.array(tok)], ["n", "tok"])
            found = self.db.execute(_ENCODE_LONG, {"steps": steps}).fetchnumpy()
            tok = found["tok"]
            if not len(tok) or found["step"][0] < steps:
                return tok.astype("<u4").tobytes()


def _columns(rows: list[tuple], n: int) -> list[pa.Array]:
    return [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * n


#: The encoder of this Python worker by the digest of its vocabulary; it outlives a task and can be rebuilt at any time.
_ENCODERS: dict[str, Encoder] = {}


def worker_encoder(digest: str, ranks: Callable[[], dict[bytes, int]]) -> Encoder:
    if digest not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[digest] = Encoder(ranks())
    return _ENCODERS[digest]


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
_ENCODED, _DECODED = "doc_id long, ids array<int>, ids_sha256 string", "doc_id long, ids array<int>, ids_sha256 string, decoded binary"


def _sent_ranks(spark: SparkSession, ranks_path: str) -> tuple[str, Broadcast]:
    """The vocabulary, of a fixed size: read once by the driver and sent along with the tasks."""
    ranks = read_ranks(ranks_path)
    return hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest(), spark.sparkContext.broadcast(ranks)


def _slices(found: Iterator[str], size: int) -> Iterator[list[str]]:
    while part := list(itertools.islice(found, size)):
        yield part


def _encode_texts(texts: list[str | None], pattern, encoder: Encoder) -> list[bytes]:
    """The ids of each text as little-endian integers; pieces are learned and looked up by slices."""
    out: list[list[bytes]] = [[] for _ in texts]
    waiting: list[tuple[int, list[str]]] = []
    room = 0

    def look_up() -> None:
        encoder.learn(set().union(*(part for _, part in waiting)))
        for n, part in waiting:
            out[n].append(b"".join(map(encoder.known.__getitem__, part)))

    for n, text in enumerate(texts):
        for part in _slices((m.group() for m in pattern.finditer(text)), SLICE_PIECES) if text and len(text) > SLICE_PIECES else [pattern.findall(text)] if text else []:
            waiting.append((n, part))
            room += len(part)
            if room >= SLICE_PIECES:
                look_up()
                waiting, room = [], 0
    look_up()
    return [b"".join(parts) for parts in out]


def _encode_run(digest: str, sent: Broadcast, pattern: str) -> Run:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        compiled, encoder = regex.compile(pattern), worker_encoder(digest, lambda: sent.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                ids = _encode_texts(batch.column(1).to_pylist(), compiled, encoder)
                offsets = np.cumsum([0, *[len(x) // 4 for x in ids]], dtype=np.int32)
                flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), flat), pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string())],
                    ["doc_id", "ids", "ids_sha256"],
                )

    return run


class Decoder:
    """Decodes ids by a vocabulary, in queries of at most ``DECODE_TOKENS`` tokens."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.db = _connect()
        words = sorted((rank, token.hex()) for token, rank in ranks.items())
        self.db.register("incoming", pa.table([pa.array([r for r, _ in words], pa.int32()), pa.array([t for _, t in words])], ["id", "bytes"]))
        self.db.execute("CREATE TEMP TABLE vocabulary AS SELECT * FROM incoming")
        self.listed = np.zeros(max(ranks.values(), default=0) + 1, bool)
        self.listed[list(ranks.values())] = True

    def parts(self, lists: pa.ListArray) -> Iterator[tuple[int, bytes]]:
        """(row, bytes) in order; a row of many tokens comes in several parts, one without tokens in none."""
        counts = np.array([len(x) if x is not None else 0 for x in lists.to_pylist()] if lists.null_count else np.diff(lists.offsets.to_numpy()), np.int64)
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        if not ((flat >= 0) & (flat < len(self.listed))).all() or not self.listed[flat].all():
            raise ValueError("an id is not in the vocabulary")
        row = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        for at in range(0, len(flat), DECODE_TOKENS):
            end = min(len(flat), at + DECODE_TOKENS)
            tokens = pa.table([pa.array(row[at:end]), pa.array(np.arange(end - at)), pa.array(flat[at:end])], ["doc", "pos", "id"])
            self.db.register("tokens", tokens)
            for n, data in self.db.execute(_DECODE).fetchall():
                yield n, bytes.fromhex(data)
            self.db.unregister("tokens")


def _decode_run(sent: Broadcast) -> Run:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(sent.value)
        for batch in batches:
            out: list[list[bytes]] = [[] for _ in range(batch.num_rows)]
            for n, data in decoder.parts(batch.column(batch.schema.get_field_index("ids"))):
                out[n].append(data)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([b"".join(x) for x in out], pa.binary())], [*batch.schema.names, "decoded"])

    return run


def _texts(docs: DataFrame) -> DataFrame:
    bound_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, ids_sha256) of every row of ``docs`` (doc_id, text).

    ``ids`` are as by the tiktoken library without special tokens, ``ids_sha256`` is the digest of
    the ids as little-endian unsigned 32-bit integers. A null text is empty and has no ids. Repeated
    rows and null ids are encoded like others, other columns ignored; no rows give no rows.
    """
    digest, sent = _sent_ranks(docs.sparkSession, ranks_path)
    return _texts(docs).mapInArrow(_encode_run(digest, sent, pattern), _ENCODED)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` (doc_id, ids, ids_sha256) with ``decoded``, the bytes that the ids stand for.

    Null or empty ids give no bytes; an id outside the vocabulary raises ValueError.
    """
    return encoded.mapInArrow(_decode_run(_sent_ranks(encoded.sparkSession, ranks_path)[1]), _DECODED)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256): every document encoded, and the ids decoded again.

    Both steps run in one Python worker, so the ids pass through it once and the decoded bytes stay
    there, a slice at a time; without ``with_ids`` the ids stay there too. Null and empty texts, repeated rows, null ids and other columns are as in ``encode``.
    """
    digest, sent = _sent_ranks(docs.sparkSession, ranks_path)
    encode_ = _encode_run(digest, sent, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(sent.value)
        for batch in encode_(batches):
            digests = [hashlib.sha256() for _ in range(batch.num_rows)]
            for n, data in decoder.parts(batch.column(1)):
                digests[n].update(data)
            columns = [batch.column(0), pa.array(np.diff(batch.column(1).offsets.to_numpy()).astype(np.int64)), batch.column(1), batch.column(2), pa.array([d.hexdigest() for d in digests], pa.string())]
            names = ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
            keep = [i for i in range(5) if with_ids or names[i] != "ids"]
            yield pa.RecordBatch.from_arrays([columns[i] for i in keep], [names[i] for i in keep])

    return _texts(docs).mapInArrow(run, f"doc_id long, n_tokens long, {'ids array<int>, ' if with_ids else ''}ids_sha256 string, decoded_sha256 string")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding and decoding of every document by the public 50k vocabulary."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False)
