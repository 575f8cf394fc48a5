"""Near-duplicate documents: BagMinHash signatures, bands, verified bag overlap, connected groups."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm import bagminhash, shingles
from orderloom.llm.common import list_array, text_of, visit
from orderloom.llm.components import components
from orderloom.llm.words import string_slices
from orderloom.llm.worker import give_back, release
from orderloom.operators.lookup import BROADCAST_LIMIT, broadcast_if_small
from orderloom.session import shared_dir
from orderloom.sources.tables import written

# A pair of similarity 0.8 agrees in no band of 30 with a chance of 1 in 150,000.
BANDS, ROWS = 30, 5
SIMILARITY = 0.8

# Bytes of text that are signed or compared together.
PART_BYTES = 1 << 20

# Members, and bytes of their texts, that one block of a bucket holds on average; blocks are paired.
BLOCK_MEMBERS, BLOCK_BYTES = 512, 2 << 20


def _content_keys(texts: pa.Array) -> pa.Array:
    """MD5 of the words of every text, joined by one space; NULL without words."""
    # Of bytes, split() cuts at just the blanks that end a word.
    found = (b" ".join(text.encode().split()) for text in texts.to_pylist())
    return pa.array([hashlib.md5(words).digest() if words else None for words in found], pa.binary())


def content_key(text: Column) -> Column:
    """16 bytes that texts with the same words in the same order share; NULL without words."""

    def keys(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        for batch in batches:
            found = [_content_keys(part) for (part,) in _parts(batch, most=len(batch))]
            yield pa.concat_arrays(found) if found else pa.array([], pa.binary())
            give_back()

    return visit(keys, "binary")(text)


def _parts(first: pa.Array, *others: pa.Array, most: int) -> Iterator[list[pa.Array]]:
    """Slices of columns of one length, cut by the bytes and the number of the first column's texts."""
    for i, j in string_slices(first, PART_BYTES):
        for k in range(i, j, most):
            yield [column.slice(k, min(most, j - k)) for column in (first, *others)]


def _signed(bands: int, rows: int):
    """The content key of every text, and a hash for each band of its signature."""

    def signed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        for batch in batches:
            nodes, keys = [pa.array([], pa.binary())], [np.zeros((0, bands), np.uint64)]
            for (part,) in _parts(batch, most=shingles.MOST_TEXTS):
                nodes.append(_content_keys(part))
                signature = bagminhash.signatures(*shingles.shingle_bags(part), len(part), bands * rows)
                keys.append(bagminhash.band_keys(signature, rows))
            flat = np.concatenate(keys).view(np.int64).ravel()
            lists = list_array(np.full(len(batch), bands), flat, pa.int64())
            yield pa.StructArray.from_arrays([pa.concat_arrays(nodes), lists], names=["node", "bands"])
            give_back()

    return visit(signed, "struct<node:binary,bands:array<long>>")


def _similarities(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    release()
    for left, right in batches:
        parts = _parts(left, right, most=shingles.MOST_TEXTS // 2)
        found = [shingles.similarities(a, b) for a, b in parts]
        yield pa.array(np.concatenate([np.zeros(0), *found]))
        give_back()


def buckets(nodes: DataFrame) -> DataFrame:
    """``band, node, bytes, n``: the bands of ``nodes`` (``node, bands, bytes``) that several nodes have, ``n`` of them."""
    members = nodes.select("node", "bytes", F.explode("bands").alias("band"))
    crowded = members.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    return members.join(crowded, "band")


def candidates(shared: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of nodes in one bucket, with the number of buckets, ``shared``.

    In every bucket the members are paired with two of them only, the first and
    the last in an order of the bucket's own, so that no bucket gives more than
    two pairs per member; groups form over the many buckets that near copies
    share. Buckets are combined before they are dealt, and joins to their
    members split hot ones at run time. What two partners may miss in buckets
    of more than three members, :func:`block_links` finds.
    """
    ranked = F.struct(F.xxhash64("band", "node").alias("place"), "node")
    ends = shared.groupBy("band").agg(F.min(ranked).alias("first"), F.max(ranked).alias("last"))
    paired = shared.select("band", "node").join(ends, "band").select(
        "node", F.explode(F.array("first.node", "last.node")).alias("other")
    )
    pairs = paired.filter("node != other").select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
    return pairs.groupBy("a", "b").agg(F.count("*").alias("shared"))


def mixed_buckets(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """Members of buckets that hold several groups: ``band, node, root, block, inner, outer``.

    The members are dealt to blocks by hash: those of the bucket's largest group
    to the first ``inner`` ones, all others to the next ``outer``. A bucket that
    fits one block is one outer block. Members combine by group before a bucket's
    groups meet. Of buckets with the same members one stands for all.
    """
    placed = shared.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = placed.groupBy("band", "root").agg(
        F.count("*").alias("members"),
        F.sum("bytes").alias("bytes"),
        *[F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"mark_{k}") for k in range(2)],
    )
    largest = sizes.groupBy("band").agg(
        F.max(F.struct("members", "root", "bytes")).alias("main"),
        F.sum("members").alias("members"),
        F.sum("bytes").alias("bytes"),
        *[F.bit_xor(f"mark_{k}").alias(f"mark_{k}") for k in range(2)],
    )
    several = largest.filter("members > main.members")
    once = several.groupBy("members", "mark_0", "mark_1").agg(F.min(F.struct("band", "main", "bytes")).alias("of"))

    def blocks(members: Column, size: Column) -> Column:
        return F.greatest(F.ceil(members / BLOCK_MEMBERS), F.ceil(size / BLOCK_BYTES), F.lit(1))

    main = F.col("of.main")
    whole = blocks(F.col("members"), F.col("of.bytes")) == 1
    inner = F.when(whole, 0).otherwise(blocks(main.members, main.bytes))
    outer = blocks(F.col("members") - main.members, F.col("of.bytes") - main.bytes)
    dealt = once.select(
        F.col("of.band").alias("band"),
        main.root.alias("main"),
        inner.cast("int").alias("inner"),
        F.when(whole, 1).otherwise(outer).cast("int").alias("outer"),
    )
    place = F.xxhash64("node", "band")
    first = (F.col("inner") > 0) & (F.col("root") == F.col("main"))
    block = F.when(first, F.pmod(place, F.col("inner"))).otherwise(F.col("inner") + F.pmod(place, F.col("outer")))
    members = placed.select("band", "node", "root").join(dealt, "band")
    return members.select("band", "node", "root", block.cast("int").alias("block"), "inner", "outer")


def block_links(mixed: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links ``a, b`` that connect all members of different groups in one bucket with that similarity or more.

    Every pair of blocks is one group of rows, with the texts of its members, so
    all pairs of a bucket are compared and no task holds a hot bucket. Pairs of
    two blocks of the largest group have nothing to link. No pair becomes a row:
    of the links in two blocks those are returned that connect the same members.
    """
    last = F.col("inner") + F.col("outer") - 1
    inside = F.col("block") < F.col("inner")
    before = F.when(~inside, F.transform(F.sequence(F.lit(0), "block"), lambda i: F.struct(i.alias("i"), F.col("block").alias("j"))))
    start = F.greatest("inner", F.col("block") + 1)
    after = F.when(
        start <= last, F.transform(F.sequence(start, last), lambda j: F.struct(F.col("block").alias("i"), j.alias("j")))
    )
    none = F.array().cast("array<struct<i:int,j:int>>")
    met = mixed.select(
        "band", "node", "root", "block", F.explode(F.concat(F.coalesce(before, none), F.coalesce(after, none))).alias("met")
    )
    rows = met.select("band", "met.i", "met.j", "node", "root", F.col("block") == F.col("met.i"), F.col("block") == F.col("met.j"))
    rows = rows.toDF("band", "i", "j", "node", "root", "left", "right").join(texts, "node")

    def linked(group: pa.Table) -> pa.Table:
        return _block_links(group, similarity)

    return rows.groupBy("band", "i", "j").applyInArrow(linked, "a binary, b binary").distinct()


def _block_links(group: pa.Table, similarity: float) -> pa.Table:
    release()
    nodes, roots = group.column("node").to_pylist(), group.column("root").to_pylist()
    numbers: dict[bytes, int] = {}
    root = np.array([numbers.setdefault(r, len(numbers)) for r in roots], np.int64)
    left, right = (np.flatnonzero(group.column(c).to_numpy()) for c in ("left", "right"))
    found: list[tuple[bytes, bytes]] = []
    if len(numbers) > 1:
        texts = group.column("text").combine_chunks()
        bags, done = [], 0
        for (part,) in _parts(texts, most=shingles.MOST_TEXTS):
            owners, values, times = shingles.shingle_bags(part)
            bags.append((owners + done, values, times))
            done += len(part)
        alike = shingles.cross_similarities(*map(np.concatenate, zip(*bags, strict=True)), left, right) >= similarity
        x, y = np.nonzero(alike & (root[left][:, None] != root[right][None, :]))
        # One link of two groups is as good as all.
        _, some = np.unique(root[left[x]] * len(numbers) + root[right[y]], return_index=True)
        top = list(range(len(numbers)))
        for a, b in zip(left[x[some]].tolist(), right[y[some]].tolist(), strict=True):
            p, q = _top(top, int(root[a])), _top(top, int(root[b]))
            if p != q:
                top[p] = q
                found.append((min(nodes[a], nodes[b]), max(nodes[a], nodes[b])))
    return pa.table({name: pa.array([pair[k] for pair in found], pa.binary()) for k, name in enumerate("ab")})


def _top(parents: list[int], at: int) -> int:
    while parents[at] != at:
        parents[at] = at = parents[parents[at]]
    return at


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose texts (``node, text``) have that similarity or more."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("right"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    measured = both.select("a", "b", visit(_similarities, "double")("left", "right").alias("similarity"))
    return measured.filter(F.col("similarity") >= similarity).select("a", "b")


def near_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    limit_bytes: int = BROADCAST_LIMIT,
) -> DataFrame:
    """``node, class_id, class_size`` for every content that has copies or near copies.

    ``node`` is :func:`content_key` of the text, ``class_id`` the smallest key in
    the group and ``class_size`` its rows. Two contents are linked when their bags of five-word shingles
    have a weighted Jaccard similarity of ``similarity`` or more; groups are
    connected by links. Texts of equal words are one content from the start, so
    thousands of copies are signed as such and meet as one row. Texts without
    words belong to no group, and rows without a key have no say in ``class_id``.

    First each content is held against its likeliest partner, then all candidates
    that still join different groups are verified on the whole texts. In buckets
    that then hold several groups (texts that share much, but less than
    ``similarity``) all pairs across groups are compared, block by block. So every
    pair that shares a band is either in one group by then or compared; the work
    grows with the square of a family of texts that are alike, but not alike enough.
    """
    spark = docs.sparkSession
    root = shared_dir(spark, "near-dedup")
    read = docs.select(F.col(f"`{key}`").cast("long").alias("id"), text_of(text).alias("text"))
    signed = read.select(
        "id", F.octet_length("text").cast("long").alias("bytes"), _signed(bands, rows)("text").alias("signed")
    ).select("id", "bytes", "signed.*")
    signed = signed.filter("node IS NOT NULL")
    nodes = signed.groupBy("node").agg(
        F.first("bands").alias("bands"), F.max("bytes").alias("bytes"), F.min("id").alias("least"), F.count("*").alias("n")
    )
    nodes = written(nodes, f"{root}/nodes")
    shared = written(buckets(nodes), f"{root}/buckets")
    pairs = written(candidates(shared), f"{root}/pairs")

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    few = broadcast_if_small(wanted, limit_bytes)
    keyed = read.select(content_key(F.col("text")).alias("node"), "text")
    texts = keyed.join(few, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    texts = written(texts, f"{root}/texts")

    likely = pairs.groupBy("b").agg(F.max(F.struct("shared", "a")).alias("best")).select("best.a", "b")
    links = written(verified(likely, texts, similarity), f"{root}/links")
    groups = written(components(links), f"{root}/groups")
    # Pairs within one group add nothing; all others are verified.
    left = _apart(pairs.select("a", "b").join(likely, ["a", "b"], "left_anti"), groups)
    groups = _linked(groups, written(verified(left, texts, similarity), f"{root}/more-links"), f"{root}/more-groups")

    # Two partners may miss links in buckets of more than three members that still hold several groups.
    mixed = written(mixed_buckets(shared.filter("n > 3"), groups), f"{root}/mixed")
    if not mixed.isEmpty():
        links = written(block_links(mixed, texts, similarity), f"{root}/block-links")
        groups = _linked(groups, links, f"{root}/all-groups")

    placed = nodes.select("node", "least", "n").join(groups, "node", "left")
    placed = placed.withColumn("root", F.coalesce("root", "node"))
    classes = placed.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("n").alias("class_size"))
    classes = classes.filter("class_size > 1")
    return placed.join(classes, "root").select("node", "class_id", "class_size")


def _apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs whose nodes are in different groups."""
    at_a = groups.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    at_b = groups.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    apart = F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
    return pairs.join(at_a, "a", "left").join(at_b, "b", "left").filter(apart).select("a", "b")


def _linked(groups: DataFrame, links: DataFrame, path: str) -> DataFrame:
    """The groups after more links. Groups are stars around their roots, so their own links need not be gone through again."""
    if links.isEmpty():
        return groups
    stars = groups.filter("node != root").select(F.col("root").alias("a"), F.col("node").alias("b"))
    return written(components(stars.unionAll(links)), path)


def find_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: ``doc_id, class_id, class_size, kept``.

    Documents of one group have the same ``class_id``, the smallest key in it,
    and the document of that key is ``kept``. A document that is like no other is
    a class of its own. Repeated rows are copies of each other.
    """
    groups = _readable(near_groups(docs, key, text, **options), **_limit(options))
    read = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), content_key(text_of(text)).alias("node"))
    found = read.join(groups, "node", "left")
    class_id = F.coalesce("class_id", "doc_id")
    return found.select(
        "doc_id",
        class_id.alias("class_id"),
        F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
        F.col("doc_id").eqNullSafe(class_id).alias("kept"),
    )


def remove_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of every group, the one with the smallest key; same columns.

    Texts without words are in no group and stay. Of repeated rows, and of rows
    with the same key in one group, one stays. In a group without any key one
    row stays as well.
    """
    groups = _readable(near_groups(docs, key, text, **options), **_limit(options))
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    left = left.withColumn("node", content_key(F.coalesce(F.col("row").getField(text).cast("string"), F.lit(""))))
    found = left.join(groups, "node", "left")
    alone = found.filter("class_id IS NULL AND class_size IS NULL").select("row.*")
    chosen = found.filter("class_size IS NOT NULL")
    chosen = chosen.filter(F.col("row").getField(key).cast("long").eqNullSafe(F.col("class_id")))
    # Only rows of groups are dealt again, one for every group in the end.
    single = chosen.groupBy("class_id", F.when(F.col("class_id").isNull(), F.col("node")).alias("keyless")).agg(
        F.first("row").alias("row")
    )
    return alone.unionAll(single.select("row.*"))


def _limit(options: dict) -> dict:
    return {k: v for k, v in options.items() if k == "limit_bytes"}


def _readable(groups: DataFrame, limit_bytes: int = BROADCAST_LIMIT) -> DataFrame:
    stored = written(groups, shared_dir(groups.sparkSession, "near-groups"))
    return broadcast_if_small(stored, limit_bytes)
