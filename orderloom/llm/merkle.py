"""Merkle manifest of a dataset: leaf coordinates from bitmap ranks, slot arrays that reduce levels."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.operators.lookup import broadcast_if_small
from orderloom.operators.numbering import numbered
from orderloom.sources.tables import written

# A slot array reduces so many levels at once.
LEVELS = 12
SLOTS = 1 << LEVELS

# A bitmap holds 2^15 ids, the size of Spark's bitmap functions; its popcount directory
# has an entry for every 64 bytes. Bitmaps are counted in groups of 2^12 first.
_IDS_BITS, _WORD_BYTES, _GROUP_BITS = 15, 64, 12
_WORDS = (1 << _IDS_BITS) // 8 // _WORD_BYTES

# The bucket of rows without an id, before all others.
_NO_ID = -(1 << 62)

_TOP = ""
_BLOCK = "tree string, block long, count long, nodes array<string>, ids array<long>, others array<string>, top string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def coded(column: Column) -> Column:
    """``-`` for NULL, else the UTF-8 length, a colon and the value."""
    text = column.cast("string")
    length = F.octet_length(text).cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(length, F.lit(":"), text))


def leaf(columns: list[Column]) -> Column:
    """SHA-256 of all columns, each with its length in front, so that no two rows run into the same bytes."""
    return F.sha2(F.concat(*[coded(c) for c in columns]), 256)


@dataclass(frozen=True)
class Manifest:
    """The written blocks of all levels (leaves first), those over the groups, the groups' roots and the root."""

    levels: list[DataFrame]
    top_levels: list[DataFrame]
    tops: DataFrame
    root: str | None


def build(rows: DataFrame, folder: str) -> Manifest:
    """The tree over ``rows`` of ``id long, grp string, leaf string, other string``, written to ``folder``.

    Within a group leaves ascend by id, rows without an id first, and rows of one id by their leaf.
    ``other`` is a second digest carried beside the leaf, or NULL. Two nodes, or the last one alone,
    become the SHA-256 of their hex digests; so do the groups' roots, by group, NULL first, in byte order.
    Rows that repeat are leaves of their own. An empty table has no root.
    """
    keyed = rows.select("id", F.col("grp").alias("name"), coded(F.col("grp")).alias("tree"), "leaf", "other")
    leaves = written(keyed, f"{folder}/leaves")
    placed = _placed(leaves, folder)
    block = F.shiftright("rank", LEVELS)
    slot = F.col("rank").bitwiseAND(F.lit(SLOTS - 1)).cast("int")
    nodes = placed.select("tree", block.alias("block"), slot.alias("slot"), "count", F.col("leaf").alias("node"), "id", "other")
    levels = _reduced(nodes, f"{folder}/levels")
    names = leaves.groupBy("tree", "name").agg(F.count("*").alias("count"))
    subroots = _roots(levels).join(names.select("tree", "name"), "tree")
    order = [F.col("name").asc_nulls_first()]
    ranked = numbered(subroots.select("tree", "name", "top"), order, f"{folder}/groups", "place")
    count = int(ranked.count())
    over = ranked.select(
        F.lit(_TOP).alias("tree"),
        F.shiftright("place", LEVELS).alias("block"),
        F.col("place").bitwiseAND(F.lit(SLOTS - 1)).cast("int").alias("slot"),
        F.lit(count).cast("long").alias("count"),
        F.col("top").alias("node"),
        F.lit(None).cast("long").alias("id"),
        F.lit(None).cast("string").alias("other"),
    )
    top_levels = _reduced(over, f"{folder}/top")
    root = _roots(top_levels).first()
    return Manifest(levels, top_levels, ranked, root["top"] if root else None)


def _placed(leaves: DataFrame, folder: str) -> DataFrame:
    """``leaves`` with their ``rank`` in their tree, and the tree's ``count``.

    The ids of each tree are bits of bitmaps, merged by aggregation; a leaf's rank is what the
    directory counts before its bitmap and before its word, and the bits before its own in
    the word. Nothing is sorted, except in bitmaps with more rows than bits: where ids repeat (or are
    missing) several times, the bitmap's rows are numbered in order over many tasks.
    """
    bucket = F.coalesce(F.shiftright("id", _IDS_BITS), F.lit(_NO_ID))
    bit = F.coalesce(F.col("id").bitwiseAND(F.lit((1 << _IDS_BITS) - 1)), F.lit(0))
    marked = leaves.withColumns({"bucket": bucket, "bit": bit})
    directory = _directory(marked, folder)
    joined = marked.join(broadcast_if_small(directory), ["tree", "bucket"])
    in_word = "substring(bits, (bit >> 9) * 64 + 1, CAST((bit >> 3) - (bit >> 9) * 64 AS INT))"
    in_byte = "CAST(conv(hex(substring(bits, (bit >> 3) + 1, 1)), 16, 10) AS INT) & (shiftleft(1, CAST(bit & 7 AS INT)) - 1)"
    before = F.expr(f"before + words[CAST(bit >> 9 AS INT)] + bitmap_count({in_word}) + bit_count({in_byte})")
    columns = ["tree", "count", "id", "leaf", "other"]
    single = joined.filter("NOT crowded").withColumn("bit", F.col("bit").cast("int"))
    found = single.select(*columns, before.alias("rank"))
    if directory.filter("crowded").isEmpty():
        return found
    many = joined.filter("crowded").select(*columns, "bucket", "before", F.monotonically_increasing_id().alias("row"))
    order = ["tree", "bucket", F.col("id").asc_nulls_first(), "leaf", "other", "row"]
    sorted_rows = numbered(many, order, f"{folder}/repeated", "place")
    firsts = sorted_rows.groupBy("tree", "bucket").agg(F.min("place").alias("first"))
    ranked = sorted_rows.join(firsts, ["tree", "bucket"])
    return found.unionByName(ranked.select(*columns, (F.col("before") + F.col("place") - F.col("first")).alias("rank")))


def _directory(marked: DataFrame, folder: str) -> DataFrame:
    """``tree, bucket, bits, words, crowded, before, count``: every bitmap, and what it stands behind."""
    merged = marked.groupBy("tree", "bucket").agg(
        F.bitmap_construct_agg("bit").alias("bits"), F.count("*").alias("rows")
    )
    bitmaps = written(merged.withColumn("group", F.shiftright("bucket", _GROUP_BITS)), f"{folder}/bitmaps")

    def earlier(*keys: str):
        return Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)

    none = F.lit(0).cast("long")
    groups = bitmaps.groupBy("tree", "group").agg(F.sum("rows").alias("rows"))
    before = F.coalesce(F.sum("rows").over(earlier("tree").orderBy("group")), none)
    groups = groups.select("tree", "group", before.alias("groups_before"))
    totals = bitmaps.groupBy("tree").agg(F.sum("rows").alias("count"))
    inside = F.coalesce(F.sum("rows").over(earlier("tree", "group").orderBy("bucket")), none)
    words = F.transform(F.sequence(F.lit(0), F.lit(_WORDS - 1)), lambda i: F.bitmap_count(F.substring("bits", F.lit(1), i * _WORD_BYTES)))
    counted = bitmaps.withColumn("inside", inside).join(groups, ["tree", "group"]).join(totals, "tree")
    return written(
        counted.select(
            "tree",
            "bucket",
            "bits",
            words.alias("words"),
            (F.col("rows") > F.bitmap_count("bits")).alias("crowded"),
            (F.col("groups_before") + F.col("inside")).alias("before"),
            "count",
        ),
        f"{folder}/directory",
    )


def _height(count: int) -> int:
    """Levels that a slot array of a level of ``count`` nodes reduces."""
    return min(LEVELS, (count - 1).bit_length())


def _levels(nodes: list[str], height: int) -> list[list[str]]:
    levels = [nodes]
    for _ in range(height):
        below = levels[-1]
        levels.append([digest("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return levels


def _slot_array(group: pa.Table) -> pa.Table:
    """Nodes at the slots they are keyed by, and what is left of them."""
    slots = group["slot"].to_numpy()
    at = np.empty(len(slots), np.int64)
    at[slots] = np.arange(len(slots))
    nodes = group["node"].take(at).to_pylist()
    count = group["count"][0].as_py()
    found = {
        "tree": [group["tree"][0].as_py()],
        "block": [group["block"][0].as_py()],
        "count": [count],
        "nodes": [nodes],
        "ids": [group["id"].take(at).to_pylist()],
        "others": [group["other"].take(at).to_pylist()],
        "top": [_levels(nodes, _height(count))[-1][0]],
    }
    strings, longs = pa.list_(pa.string()), pa.list_(pa.int64())
    kinds = [pa.string(), pa.int64(), pa.int64(), strings, longs, strings, pa.string()]
    return pa.table([pa.array(v, k) for v, k in zip(found.values(), kinds, strict=True)], names=list(found))


def _reduced(nodes: DataFrame, folder: str) -> list[DataFrame]:
    """The written slot arrays of every twelfth level, until each tree has come down to one node."""
    levels = []
    while True:
        packed = nodes.groupBy("tree", "block").applyInArrow(_slot_array, _BLOCK)
        levels.append(written(packed, f"{folder}/{len(levels)}"))
        rest = levels[-1].filter(F.col("count") > SLOTS)
        if rest.isEmpty():
            return levels
        nodes = rest.select(
            "tree",
            F.shiftright("block", LEVELS).alias("block"),
            F.col("block").bitwiseAND(F.lit(SLOTS - 1)).cast("int").alias("slot"),
            F.ceil(F.col("count") / SLOTS).alias("count"),
            F.col("top").alias("node"),
            F.lit(None).cast("long").alias("id"),
            F.lit(None).cast("string").alias("other"),
        )


def _roots(levels: list[DataFrame]) -> DataFrame:
    found = [level.filter(F.col("count") <= SLOTS).select("tree", "top") for level in levels]
    roots = found[0]
    for more in found[1:]:
        roots = roots.unionAll(more)
    return roots


def _steps(levels: list[list[str]], slot: int) -> list[str]:
    """The siblings of a slot, level by level, after ``L`` or ``R`` for their side; ``-`` where it has none."""
    found = []
    for nodes in levels[:-1]:
        sibling = slot ^ 1
        side = "L" if slot & 1 else "R"
        found.append(side + nodes[sibling] if sibling < len(nodes) else "-")
        slot >>= 1
    return found


def fold(node: str, proof: list[str]) -> str:
    """The root that a node and the steps of its proof lead to."""
    for step in proof:
        node = digest(step[1:] + node if step[0] == "L" else node + step[1:])
    return node


def _split(path: str) -> list[str]:
    return path.split(",") if path else []


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(len(batch)):
            yield batch.slice(k, 1).to_pylist()[0]


def _below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The path above every node of a block, as the path above the block of that number one level below."""
    for row in _rows(batches):
        levels, above = _levels(row["nodes"], _height(row["count"])), _split(row["path"])
        paths = [",".join(_steps(levels, k) + above) for k in range(len(row["nodes"]))]
        blocks = np.arange(len(paths)) + row["block"] * SLOTS
        yield pa.RecordBatch.from_arrays(
            [pa.array([row["tree"]] * len(paths)), pa.array(blocks), pa.array(paths, pa.string())],
            names=["tree", "block", "path"],
        )


def _descended(levels: list[DataFrame], paths: DataFrame) -> list[DataFrame]:
    """For every level the paths ``tree, block, path`` above its blocks, from the paths ``tree, path`` above the trees."""
    above: list[DataFrame] = []
    for k in reversed(range(len(levels))):
        ended = levels[k].filter(F.col("count") <= SLOTS).select("tree", "block")
        here = ended.join(paths, "tree").select("tree", "block", "path")
        if above:
            upper = levels[k + 1].join(broadcast_if_small(above[0]), ["tree", "block"])
            here = here.unionAll(upper.mapInArrow(_below, "tree string, block long, path string"))
        above.insert(0, here)
    return above


def proofs(manifest: Manifest, folder: str) -> DataFrame:
    """Of every leaf ``id, leaf, other, subroot, root, proof, folded``.

    ``proof`` has a step for each level: the sibling's digest after ``L`` or ``R`` for its side, or ``-``.
    ``folded`` is the root that ``other``, or the leaf where that is NULL, and the proof lead to.
    Paths above the blocks are written to ``folder``, a row for up to 4,096 leaves.
    """
    spark = manifest.tops.sparkSession
    whole = spark.createDataFrame([(_TOP, "")], "tree string, path string")
    over = _descended(manifest.top_levels, whole)
    tops = manifest.top_levels[0].join(over[0], ["tree", "block"])
    by_place = tops.mapInArrow(_below, "tree string, block long, path string")
    named = manifest.tops.join(by_place.select(F.col("block").alias("place"), "path"), "place")
    trees = written(named.select("tree", "path", F.col("top").alias("subroot")), f"{folder}/trees")
    above = _descended(manifest.levels, trees.select("tree", "path"))[0]
    paths = written(above.join(trees.select("tree", "subroot"), "tree"), f"{folder}/paths")
    blocks = manifest.levels[0].join(broadcast_if_small(paths), ["tree", "block"])
    schema = "id long, leaf string, other string, subroot string, proof array<string>, folded string"
    root = F.lit(manifest.root).cast("string").alias("root")
    found = blocks.mapInArrow(_proven, schema)
    return found.select("id", "leaf", "other", "subroot", root, "proof", "folded")


def _proven(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        levels, above = _levels(row["nodes"], _height(row["count"])), _split(row["path"])
        steps = [_steps(levels, k) + above for k in range(len(row["nodes"]))]
        starts = [other or node for node, other in zip(row["nodes"], row["others"], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(row["ids"], pa.int64()),
                pa.array(row["nodes"], pa.string()),
                pa.array(row["others"], pa.string()),
                pa.array([row["subroot"]] * len(steps), pa.string()),
                pa.array(steps, pa.list_(pa.string())),
                pa.array([fold(node, proof) for node, proof in zip(starts, steps, strict=True)], pa.string()),
            ],
            names=["id", "leaf", "other", "subroot", "proof", "folded"],
        )


def document_rows(docs: DataFrame) -> DataFrame:
    """Documents as rows of :func:`build`; ``other`` is the leaf of a tampered row, with 1 more in ``n_chars``.

    Tampered are rows whose id, in decimal, has a CRC-32 that 7 divides. Any column may be NULL.
    """
    taken = ["doc_id", "source", "lang", "n_chars", "text"]
    plain = docs.select(*[F.col(f"`{c}`") for c in taken])
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    fields = [F.col(c) for c in taken]
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    tampered = leaf([more if c == "n_chars" else F.col(c) for c in taken])
    return plain.select(
        F.col("doc_id").cast("long").alias("id"),
        F.col("lang").cast("string").alias("grp"),
        leaf(fields).alias("leaf"),
        F.when(chosen, tampered).alias("other"),
    )


def _sql_coded(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR) END"


def _sql_leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_sql_coded(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


# CRC-32 by its bits, as DuckDB has no function for it: 3988292384 is the reflected polynomial.
_SQL_CRC = (
    "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),"
    " lambda c: ord(c)::BIGINT)), lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0,0,0,0,0,0,0,0]::BIGINT[]),"
    " lambda x, bit: xor(x >> 1, (x & 1) * 3988292384))))"
)

ORACLE_SQL = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, {_sql_coded("lang")} AS tree, lang, {_sql_leaf("n_chars")} AS leaf,
        CASE WHEN {_SQL_CRC} % 7 = 0 THEN {_sql_leaf("(n_chars + 1)")} ELSE {_sql_leaf("n_chars")} END AS start
    FROM documents
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
        count(*) OVER (PARTITION BY tree) AS n
    FROM leaves
), nodes AS (
    SELECT tree, 0 AS level, rank AS place, n, leaf AS node FROM ranked
    UNION ALL
    SELECT tree, level + 1, place // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY place))
    FROM nodes WHERE n > 1 GROUP BY tree, level, n, place // 2
), subroots AS (
    SELECT tree, node AS subroot, level AS height FROM nodes WHERE n = 1
), groups AS (
    SELECT tree, subroot, height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n
    FROM subroots JOIN (SELECT DISTINCT tree, lang FROM leaves) USING (tree)
), tops AS (
    SELECT 0 AS level, place, n, subroot AS node FROM groups
    UNION ALL
    SELECT level + 1, place // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY place))
    FROM tops WHERE n > 1 GROUP BY level, n, place // 2
), steps AS (
    SELECT r.doc_id, r.tree, r.rank, s.level, (r.rank >> s.level) % 2 AS odd, n.node
    FROM ranked r JOIN (SELECT DISTINCT tree, level FROM nodes WHERE n > 1) s ON s.tree = r.tree
    LEFT JOIN nodes n ON n.tree = r.tree AND n.level = s.level AND n.place = xor(r.rank >> s.level, 1)
    UNION ALL
    SELECT r.doc_id, r.tree, r.rank, g.height + s.level, (g.place >> s.level) % 2, n.node
    FROM ranked r JOIN groups g ON g.tree = r.tree JOIN (SELECT DISTINCT level FROM tops WHERE n > 1) s ON true
    LEFT JOIN tops n ON n.level = s.level AND n.place = xor(g.place >> s.level, 1)
), folds AS (
    SELECT tree, rank, 0 AS level, start AS node FROM ranked
    UNION ALL
    SELECT f.tree, f.rank, f.level + 1,
        sha256(CASE WHEN s.odd = 1 THEN coalesce(s.node, '') || f.node ELSE f.node || coalesce(s.node, '') END)
    FROM folds f JOIN steps s ON s.tree = f.tree AND s.rank = f.rank AND s.level = f.level
), proven AS (
    SELECT tree, rank, sha256(coalesce(string_agg(node, '' ORDER BY level), '')) AS proof FROM steps GROUP BY tree, rank
), folded AS (
    SELECT tree, rank, arg_max(node, level) AS folded_root FROM folds GROUP BY tree, rank
)
SELECT r.doc_id, r.leaf, g.subroot, t.node AS root, coalesce(p.proof, sha256('')) AS proof_sha256, f.folded_root,
    f.folded_root = t.node AS verified
FROM ranked r JOIN groups g USING (tree) JOIN (SELECT node FROM tops WHERE n = 1) t ON true
LEFT JOIN proven p USING (tree, rank) JOIN folded f USING (tree, rank)
"""
