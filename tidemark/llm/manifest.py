"""Merkle manifest of a dataset: digests of rows, of groups of rows and of the whole, with proofs for each row.

The rows of a group, in order, are leaves numbered from 0; ``FANOUT`` consecutive nodes make a node
of the next level until one is left, and the groups' roots make a tree of the same kind. Nothing is
padded: a last run may be short.

The numbered leaves lie in range partitions, and each partition builds a mountain range: a stack with
a run of pending nodes for each level. A leaf is pushed at level 0; a run that is full, or that is the
group's last, is carried into one node of the next level. As the leaves' numbers are known, a
partition tells which of its runs began in it. Runs that did not are left open, as are those that the
partition's end cuts off; the nodes of an open run meet by their parent's number, level by level, in
a distributed merge of at most ``FANOUT`` nodes each. A partition leaves at most two open runs a level.

Every node is recorded once. A proof is read from these records: the upper levels are joined from the
root down, where a parent has at most ``FANOUT`` children, and the lowest levels meet in blocks of
``FANOUT ** BLOCK_LEVELS`` leaves. No group, however large, meets in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, cut, table

FANOUT = 8
#: Levels of a tree that are proved together in one block of leaves.
BLOCK_LEVELS = 4
#: Levels that a count of leaves may need; 8 ** 21 is beyond a long.
MOST_LEVELS = 21
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(values: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the encoded values, one after the other."""
    return F.sha2(F.concat(*[encoded(v) for v in values]).cast("binary"), 256)


def group_key(group: Column) -> Column:
    """A text that orders like ``group`` as text, null first, and is never null."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def _joined(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode("ascii")).hexdigest()


def numbered(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """``leaves`` (_g, leaf, ...) with at (from 0 within _g, by ``order``), total (leaves of _g) and top (levels of its tree).

    Rows are range-partitioned, written, and numbered by what the partitions before hold of their
    group, so a group may fill any number of partitions. Ties in ``order`` go by leaf, and rows that
    are equal in that too are the same leaf twice.
    """
    ranged = leaves.repartitionByRange("_g", *order, "leaf").sortWithinPartitions("_g", *order, "leaf")
    place = F.monotonically_increasing_id()
    held = cut(ranged.select("*", F.shiftright(place, 33).alias("_part"), place.alias("_place")), "leaves")
    runs = held.groupBy("_g", "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "_g", "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(Window.partitionBy("_g")).alias("total")
    )
    top = reduce(lambda a, b: a + b, [(F.col("total") > FANOUT**k).cast("int") for k in range(MOST_LEVELS)])
    return held.join(runs, ["_g", "_part"]).select(*leaves.columns, (F.col("_place") + F.col("_shift")).alias("at"), "total", top.alias("top"))


_NODE = "_g string, total long, top int, level int, at long, digest string, open boolean"


def _mountains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves (_g, total, top, at, leaf) in order -> node records; leaves are recorded only if their run is open or they are roots."""
    names = ["_g", "total", "top", "level", "at", "digest", "open"]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.bool_()]
    rows: list[tuple] = []
    pending: list[list[str]] = []  # the stack: of each level the nodes of one run that have come
    first: list[int] = []  # and the number of the first
    counts: list[int] = []  # nodes of each level of the group's tree
    group: tuple | None = None
    expected = 0

    def record(level: int, is_open: bool) -> None:
        if level or is_open:
            rows.extend((*group, level, first[level] + i, d, is_open) for i, d in enumerate(pending[level]))

    def close() -> None:
        for level, nodes in enumerate(pending):
            if nodes:
                record(level, True)
                pending[level] = []

    def push(level: int, at: int, node: str) -> None:
        while True:
            if counts[level] == 1:
                rows.append((*group, level, 0, node, False))
                return
            if not pending[level]:
                first[level] = at
            pending[level].append(node)
            if at % FANOUT != FANOUT - 1 and at != counts[level] - 1:
                return
            whole = first[level] % FANOUT == 0
            record(level, not whole)
            node = _joined(pending[level]) if whole else ""
            pending[level] = []
            if not whole:
                return
            level, at = level + 1, at // FANOUT

    def batch() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
        rows.clear()
        return out

    for given in batches:
        for g, total, top, at, leaf in zip(*(c.to_pylist() for c in given.columns), strict=True):
            if group is None or g != group[0] or at != expected:
                if group is not None:
                    close()
                group = (g, total, top)
                counts = [total]
                while counts[-1] > 1:
                    counts.append(-(-counts[-1] // FANOUT))
                pending, first = [[] for _ in counts], [0] * len(counts)
            push(0, at, leaf)
            expected = at + 1
        if rows:
            yield batch()
    if group is not None:
        close()
    if rows:
        yield batch()


def forest(leaves: DataFrame) -> DataFrame:
    """Node records (_g, total, top, level, at, digest) of the trees over numbered ``leaves``; level 0 holds what the merge needs and lone leaves.

    A group's root is its node of level ``top``. No leaves give no nodes.
    """
    ranged = leaves.select("_g", "total", "top", "at", "leaf").repartitionByRange("_g", "at").sortWithinPartitions("_g", "at")
    found = cut(ranged.mapInArrow(_mountains, _NODE), "nodes")
    levels = found.agg(F.max("top")).first()[0] or 0
    own = ["_g", "total", "top", "level", "at", "digest"]
    edges = cut(found.where("open").select(*own), "edges")
    every, merged = found.select(*own), None
    for level in range(levels):
        kids = edges.where(F.col("level") == level)
        kids = kids if merged is None else kids.union(merged)
        run = F.transform(F.array_sort(F.collect_list(F.struct("at", "digest"))), lambda x: x["digest"])
        parents = kids.where(F.col("top") > level).groupBy("_g", "total", "top", F.floor(F.col("at") / FANOUT).alias("at")).agg(F.sha2(F.array_join(run, "").cast("binary"), 256).alias("digest"))
        merged = cut(parents.select("_g", "total", "top", F.lit(level + 1).alias("level"), "at", "digest"), "merged")
        every = every.union(merged)
    return every


def roots(nodes: DataFrame) -> DataFrame:
    """(_g, root, top): the root of each tree."""
    return nodes.where("level = top").select("_g", F.col("digest").alias("root"), "top")


def paths(nodes: DataFrame, base: DataFrame, lowest: int, levels: int) -> DataFrame:
    """(_g, at, path) for every node of level ``lowest``, or for the root of a tree that is not so high.

    ``path`` is an array of texts: before and after, the digests of a node's siblings to its left and
    right, for each level up to the root, then the array ``path`` that ``base`` (_g, top, path) has
    for the tree. Parents are joined to their children from the top down.
    """
    found = base.where(F.col("top") >= levels).select("_g", F.lit(0).cast("long").alias("at"), "path")
    for level in range(levels - 1, lowest - 1, -1):
        runs = nodes.where((F.col("level") == level) & (F.col("top") > level)).groupBy("_g", F.floor(F.col("at") / FANOUT).alias("parent"))
        runs = runs.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "digest"))), lambda x: x["digest"]).alias("run"))
        up = runs.join(found.select("_g", F.col("at").alias("parent"), F.col("path").alias("up")), ["_g", "parent"])
        one = up.select("_g", "parent", "run", "up", F.posexplode("run").alias("slot", "_d"))
        sides = F.array(F.array_join(F.expr("slice(run, 1, slot)"), ""), F.array_join(F.expr(f"slice(run, slot + 2, {FANOUT})"), ""))
        down = one.select("_g", (F.col("parent") * FANOUT + F.col("slot")).alias("at"), F.concat(sides, "up").alias("path"))
        found = down.union(base.where(F.col("top") == level).select("_g", F.lit(0).cast("long").alias("at"), "path"))
    return found.union(base.where(F.col("top") < min(lowest, levels)).select("_g", F.lit(0).cast("long").alias("at"), "path"))


def _fold(node: str, path: Sequence[str]) -> str:
    for i in range(0, len(path), 2):
        node = _joined((path[i], node, path[i + 1]))
    return node


def _prove(batches: Iterator[pa.RecordBatch], own: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Rows (_g, block, level, at, digest, changed, path, group_root, root, own...) by block, level from the header (-1), inner nodes and leaves 0.

    A block's rows are its header, its inner nodes from the top level down, and its leaves.
    """
    key = None
    inner: dict[tuple[int, int], str] = {}
    path: list[str] = []
    ends: tuple = ()
    waiting: list[tuple] = []  # the leaves of one run of level 0
    run = None
    schema = None
    out: list[tuple] = []

    def above(parent: int) -> list[str]:
        """Siblings from level 1 to the block's top, for the children of a node of level 1."""
        found, at, level = [], parent, 1
        while (level, at) in inner:
            start = at - at % FANOUT
            kin = [inner.get((level, start + i)) for i in range(FANOUT)]
            found += ["".join(d for d in kin[: at - start] if d), "".join(d for d in kin[at - start + 1 :] if d)]
            at, level = at // FANOUT, level + 1
        return found

    def flush() -> None:
        if not waiting:
            return
        alone = ends[2] == 0  # the leaf is its group's root
        rest = [*([] if alone else above(run)), *path]
        kin = [w[0] for w in waiting]
        for i, (leaf, changed, carried) in enumerate(waiting):
            full = rest if alone else ["".join(kin[:i]), "".join(kin[i + 1 :]), *rest]
            out.append((*carried, leaf, ends[0], ends[1], _joined(full), _fold(changed if changed is not None else leaf, full)))
        waiting.clear()

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        n = len(own)
        arrays = [pa.array(c, schema.field(name).type) for name, c in zip(own, columns[:n], strict=True)] + [pa.array(c, pa.string()) for c in columns[n:]]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, [*own, "leaf", "subroot", "root", "proof_sha256", "folded_root"])

    for given in batches:
        schema = given.schema
        for row in zip(*(c.to_pylist() for c in given.columns), strict=True):
            g, block, step, level, at, node, changed, given_path, group_root, root, top = row[:11]
            if (g, block) != key:
                flush()
                key, inner, path, ends, run = (g, block), {}, [], (), None
            if step == 0:
                path, ends = given_path, (group_root, root, top)
            elif step == 1:
                inner[level, at] = node
            else:
                if at // FANOUT != run:
                    flush()
                    run = at // FANOUT
                waiting.append((node, changed, row[11:]))
        if len(out) > 1000:
            yield batch()
    flush()
    if out:
        yield batch()


def prove(leaves: DataFrame, nodes: DataFrame, own: Sequence[str]) -> DataFrame:
    """(own..., leaf, subroot, root, proof_sha256, folded_root) for every numbered leaf of ``leaves`` (_g, at, total, top, leaf, changed, own...).

    ``nodes`` is the forest over the leaves. The groups' roots are the leaves of a further tree, in
    the order of _g. ``folded_root`` folds ``changed``, or the leaf where that is null, with the
    siblings of the proof.
    """
    groups = roots(nodes)
    upper = numbered(groups.select(F.lit("").alias("_g"), F.col("_g").alias("name"), F.col("root").alias("leaf"), F.col("top").alias("levels")), ["name"])
    upper = cut(upper, "groups")
    upper_nodes = forest(upper)
    upper_levels = upper.agg(F.max("top")).first()[0] or 0
    empty = F.array().cast("array<string>")
    lone = upper_nodes.where("level > 0").unionByName(upper.select("_g", "total", "top", F.lit(0).alias("level"), "at", F.col("leaf").alias("digest")))
    tops = paths(lone, roots(upper_nodes).select("_g", "top", empty.alias("path")), 0, upper_levels).select("at", "path")
    whole = roots(upper_nodes).first()
    root = F.lit(whole and whole["root"]).cast("string")
    base = upper.join(tops, "at").select(F.col("name").alias("_g"), F.col("levels").alias("top"), "path", F.col("leaf").alias("group_root"), root.alias("root"))
    base = cut(base, "groups")
    levels = base.agg(F.max("top")).first()[0] or 0
    heads = paths(nodes, base, BLOCK_LEVELS, levels).join(base.drop("path"), "_g")
    size = lambda level: FANOUT ** (BLOCK_LEVELS - level)
    head = heads.select("_g", F.col("at").alias("block"), F.lit(0).alias("step"), F.lit(-1).alias("level"), F.lit(0).cast("long").alias("at"), "path", "group_root", "root", "top")
    inside = nodes.where((F.col("level") > 0) & (F.col("level") < BLOCK_LEVELS) & (F.col("level") < F.col("top")))
    block = reduce(lambda w, k: w.when(F.col("level") == k, F.floor(F.col("at") / size(k))), range(2, BLOCK_LEVELS), F.when(F.col("level") == 1, F.floor(F.col("at") / size(1))))
    inside = inside.select("_g", block.alias("block"), F.lit(1).alias("step"), "level", "at", F.col("digest").alias("node"))
    bottom = leaves.select("_g", F.floor(F.col("at") / size(0)).alias("block"), F.lit(2).alias("step"), F.lit(0).alias("level"), "at", F.col("leaf").alias("node"), "changed", *[F.col(f"`{c}`") for c in own])
    rows = bottom.unionByName(head, allowMissingColumns=True).unionByName(inside, allowMissingColumns=True)
    rows = rows.select("_g", "block", "step", "level", "at", "node", "changed", "path", "group_root", "root", "top", *[F.col(f"`{c}`").alias("_" + c) for c in own])
    dealt = rows.repartition("_g", "block").sortWithinPartitions("_g", "block", "step", "level", "at")
    kinds = dict(leaves.dtypes)
    names = ["_" + c for c in own]
    schema = ", ".join(f"`_{c}` {kinds[c]}" for c in own) + ", leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    proved = dealt.mapInArrow(lambda b: _prove(b, names), schema)
    return proved.select(*[F.col(f"`_{c}`").alias(c) for c in own], "leaf", "subroot", "root", "proof_sha256", "folded_root")


def manifest(rows: DataFrame, columns: Sequence[str], group: str, key: str, changed: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(leaves, nodes): a numbered leaf for each row, and the records of all inner nodes.

    A leaf is the digest of ``columns``; the leaves of a ``group`` ascend by ``key``, null first, and
    by digest where keys are equal. Null groups are one group, the first. ``changed`` is a digest to
    be proved in place of a row's own, null for none. Repeated rows are leaves like others; texts of
    any length are hashed in the JVM; columns that are not named are ignored. No rows give no leaves
    and no nodes.
    """
    bound_batches(rows.sparkSession)
    own = rows.select(
        group_key(F.col(group)).alias("_g"), F.col(key).alias("_key"), digest([F.col(c) for c in columns]).alias("leaf"), (F.lit(None).cast("string") if changed is None else changed).alias("changed")
    )
    leaves = numbered(cut(own, "digests"), ["_key"])
    return leaves, forest(leaves)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and what the proof says of a row whose text may have been tampered with.

    Where the checksum of doc_id asks for it the text is lower-cased; a null id or text stays as it is.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = digest([*[F.col(c) for c in columns[:-1]], F.translate("text", UPPER, LOWER)])
    leaves, nodes = manifest(docs, columns, "lang", "doc_id", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, lowered))
    proved = prove(leaves.withColumnRenamed("_key", "doc_id"), nodes, ["doc_id"])
    return proved.select("*", (F.col("folded_root") == F.col("root")).alias("verified"))


OP13_SQL = r"""
WITH RECURSIVE e AS (
  SELECT doc_id, lang, text,
    CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
    || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END AS head,
    xor(4294967295::UBIGINT, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS UBIGINT)), lambda crc, b:
      list_reduce(range(8), lambda v, k: xor(v >> 1, 3988292384::UBIGINT * (v & 1)), xor(crc, b)), 4294967295::UBIGINT)) % 3 = 0 AS tampered
  FROM documents
), d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
    CASE WHEN tampered AND text IS NOT NULL THEN sha256(head || strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) END AS changed FROM e
), l AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM d
), t(g, level, pos, h, n) AS (
  SELECT g, 0, pos, leaf, n FROM l UNION ALL SELECT g, level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM t WHERE n > 1 GROUP BY g, level, pos // 8, n
), s AS (
  SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n, level AS levels FROM t WHERE n = 1
), u(level, pos, h, n) AS (
  SELECT 0, pos, subroot, n FROM s UNION ALL SELECT level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM u WHERE n > 1 GROUP BY level, pos // 8, n
), w AS (
  SELECT l.doc_id, l.leaf, l.changed, l.g, l.pos, s.pos AS place, s.levels, s.subroot, (SELECT h FROM u WHERE n = 1) AS root FROM l JOIN s ON l.g = s.g
), p AS (
  SELECT w.g, w.pos, t.level, coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (WHERE t.pos < w.pos // CAST(8 ** t.level AS BIGINT)), '') AS a, coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (WHERE t.pos > w.pos // CAST(8 ** t.level AS BIGINT)), '') AS b
  FROM w JOIN t ON t.g = w.g AND t.n > 1 AND t.pos // 8 = w.pos // CAST(8 ** (t.level + 1) AS BIGINT) GROUP BY w.g, w.pos, t.level
  UNION ALL
  SELECT w.g, w.pos, w.levels + u.level, coalesce(string_agg(u.h, '' ORDER BY u.pos) FILTER (WHERE u.pos < w.place // CAST(8 ** u.level AS BIGINT)), ''), coalesce(string_agg(u.h, '' ORDER BY u.pos) FILTER (WHERE u.pos > w.place // CAST(8 ** u.level AS BIGINT)), '')
  FROM w JOIN u ON u.n > 1 AND u.pos // 8 = w.place // CAST(8 ** (u.level + 1) AS BIGINT) GROUP BY w.g, w.pos, w.levels, u.level
), q AS (
  SELECT g, pos, sha256(string_agg(a || b, '' ORDER BY level)) AS proof_sha256 FROM p GROUP BY g, pos
), f(g, pos, level, h) AS (
  SELECT g, pos, 0, coalesce(changed, leaf) FROM w UNION ALL SELECT f.g, f.pos, f.level + 1, sha256(p.a || f.h || p.b) FROM f JOIN p ON p.g = f.g AND p.pos = f.pos AND p.level = f.level
), z AS (
  SELECT g, pos, arg_max(h, level) AS folded_root FROM f GROUP BY g, pos
)
SELECT w.doc_id, w.leaf, w.subroot, w.root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256, z.folded_root, z.folded_root = w.root AS verified
FROM w JOIN z ON z.g = w.g AND z.pos = w.pos LEFT JOIN q ON q.g = w.g AND q.pos = w.pos
"""
