"""Near-duplicate classes of whole texts by BagMinHash, banding and exact bag overlap.

Texts that share a band are first compared with one hub of that bucket, the text that meets
most others (a star, not all pairs). Connected components of the verified links leave few buckets with texts of several
components; those are compared in blocks, inside a task: signatures first, and texts only in block
pairs where signatures agree, so that no link between different texts of a bucket is lost and no pair
that fails is ever emitted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm import bagminhash as bag
from demandloom.llm.common import SLICE_BYTES, discard, materialise, maybe_broadcast, packed, slices, table
from demandloom.llm.components import connected_components

THRESHOLD = 0.8
#: Texts and shingles of a block, about; members of a hub that meet it in one place.
BLOCK, BLOCK_SHINGLES, HUB_MEMBERS = 256, 250_000, 2_000
BROADCAST_ROWS = 200_000
#: Matching components below which two bags of similarity 0.8 or more are found by chance under 1e-8.
_SURE = 6.0
_BLOCK = pa.schema([("band", pa.int32()), ("h", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("block", pa.int32()), ("key", pa.binary()), ("label", pa.binary()), ("n_shingles", pa.int64()), ("signature", pa.binary())])


def _text_key(text_col: str):
    return F.unhex(F.md5(F.col(text_col).cast("binary")))


def text_bands(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(key, n_shingles, bands, signature) of every text that has words; a task skips texts it has just seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in slices(batches, "text"):
            keys, bags = [], []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                if key in seen:
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(key)
                if len(found := bag.shingle_hashes(text.as_py())):
                    keys.append(key)
                    bags.append(found)
            signed = bag.signatures(bags) if bags else np.zeros((0, bag.COMPONENTS), np.uint32)
            offsets = pa.array(np.arange(len(keys) + 1) * bag.BANDS, pa.int32())
            columns = [pa.array(keys, pa.binary()), pa.array([len(b) for b in bags], pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(bag.bands(signed).reshape(-1))), pa.array([x.astype("<u4").tobytes() for x in signed], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n_shingles", "bands", "signature"])

    return docs.filter(F.col(text_col).isNotNull()).select(_text_key(text_col).alias("key"), F.col(text_col).alias("text")).mapInArrow(run, "key binary, n_shingles long, bands array<long>, signature binary")


def verified(pairs: DataFrame, threshold: float) -> DataFrame:
    """(key, hub) of the rows (key, hub, text, hub_text) whose bags overlap enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in slices(slices(batches, "text"), "hub_text", 4 * SLICE_BYTES):
            keep = []
            for hub, text, hub_text in zip(batch.column("hub").to_pylist(), batch.column("text"), batch.column("hub_text"), strict=True):
                if hub != last:
                    last, held = hub, bag.shingle_hashes(hub_text.as_py())
                keep.append(bag.similarity(bag.shingle_hashes(text.as_py()), held) >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("hub")], names=["key", "hub"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("key", "hub", "text", "hub_text").mapInArrow(run, "key binary, hub binary")


def star_links(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The verified of rows (key, hub). A hub of many members is dealt out, with its text, by salts."""
    many = materialise(pairs.groupBy("hub").agg(F.count("*").alias("n")).filter(F.col("n") > HUB_MEMBERS).select("hub", F.ceil(F.col("n") / HUB_MEMBERS).cast("int").alias("salts")), "hubs")
    few = maybe_broadcast(many, many.count(), BROADCAST_ROWS)
    members = pairs.join(few, "hub", "left").select("key", "hub", F.pmod(F.xxhash64("key"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt"))
    asked = pairs.select("hub").distinct().join(few, "hub", "left").select("hub", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
    hubs = asked.join(texts.select(F.col("key").alias("hub"), F.col("text").alias("hub_text")), "hub")
    return verified(members.join(texts, "key").join(hubs, ["hub", "salt"]), threshold)


def _by_block(batches: Iterator[pa.RecordBatch], size_of: str, held_as: dict) -> Iterator[dict[str, list]]:
    """Rows of one block pair of a bucket after another, by key, of batches that are sorted by block pair."""
    held: dict[str, list] = {}
    group = None

    def ordered() -> dict[str, list]:
        order = sorted(range(len(held["key"])), key=held["key"].__getitem__)
        return {c: [v[k] for k in order] for c, v in held.items()}

    for batch in slices(batches, size_of):
        rows = batch.to_pydict()
        for k, now in enumerate(zip(rows["band"], rows["h"], rows["lo"], rows["hi"], strict=True)):
            if now != group:
                if held:
                    yield ordered()
                group, held = now, {c: [] for c in rows}
            for c, values in rows.items():
                held[c].append(held_as[c](values[k]) if c in held_as else values[k])
    if held:
        yield ordered()


def _fitting_pairs(rows: dict[str, list], threshold: float) -> np.ndarray:
    """[pairs, 2] places of rows with different labels whose sizes and signatures allow for the threshold, in the first band they share."""
    sizes, blocks = np.array(rows["n_shingles"]), np.array(rows["block"])
    lo, hi, band = rows["lo"][0], rows["hi"][0], rows["band"][0]
    least = bag.COMPONENTS * threshold - _SURE * np.sqrt(bag.COMPONENTS * threshold * (1 - threshold))
    signature = np.stack([np.frombuffer(x, "<u4") for x in rows["signature"]])
    keys = bag.bands(signature)
    numbers = np.unique(rows["label"], return_inverse=True)[1]
    pairs = [np.zeros((0, 2), np.int64)]
    for i in range(len(sizes) - 1):
        other = np.arange(i + 1, len(sizes))
        fits = (np.minimum(sizes[other], sizes[i]) >= threshold * np.maximum(sizes[other], sizes[i])) & (numbers[other] != numbers[i])
        if lo != hi:
            fits &= blocks[other] != blocks[i]
        other = other[fits]
        other = other[(signature[other] == signature[i]).sum(axis=1) >= least]
        if band and len(other):
            other = other[~(keys[other, :band] == keys[i, :band]).any(axis=1)]
        pairs.append(np.stack([np.full(len(other), i), other], axis=1))
    return np.concatenate(pairs)


def _candidates(threshold: float):
    """A function over rows sorted by block pair of a bucket: those that have a fitting partner there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_block(batches, "signature", {}):
            keep = np.unique(_fitting_pairs(rows, threshold)) if len(rows["key"]) > 1 else ()
            out = {c: [rows[c][k] for k in keep] for c in rows}
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in _BLOCK], schema=_BLOCK)

    return run


def _cross_links(threshold: float):
    """A function over rows sorted by block pair of a bucket: links between different labels, at most one a label."""

    def links(rows: dict[str, list]) -> list[tuple[bytes, bytes]]:
        labels, sizes = rows["label"], np.array(rows["n_shingles"])
        root = {x: x for x in labels}

        def find(x: bytes) -> bytes:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        pairs = _fitting_pairs(rows, threshold)
        out = []
        if len(pairs):
            who, place = np.unique(pairs, return_inverse=True)
            shared = bag.overlaps([rows["text"][k] for k in who])
            a, b = place.reshape(-1, 2).T
            both = shared[a, b]
            for i, j in pairs[both >= threshold * (sizes[pairs[:, 0]] + sizes[pairs[:, 1]] - both) - 1e-9]:
                x, y = find(labels[i]), find(labels[j])
                if x != y:
                    root[y] = x
                    out.append((rows["key"][i], rows["key"][j]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_block(batches, "text", {"text": bag.shingle_hashes}):
            found = links(rows) if len(rows["key"]) > 1 else []
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.binary()), pa.array([b for _, b in found], pa.binary())], names=["key", "hub"])

    return run


def near_classes(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(key, label) of the texts that are linked to a different text; label is one text's key a class."""
    signed = materialise(text_bands(docs, text_col), "bands")
    bands = signed.select("key", F.posexplode("bands").alias("band", "h"))
    bucket = ["band", "h"]
    buckets = bands.groupBy(*bucket).agg(F.min("key").alias("_first"), F.max("key").alias("_last"), F.count("*").alias("n")).filter("_first <> _last").select(*bucket, "n")
    shared = materialise(bands.join(buckets, bucket).select(*bucket, "key", "n").distinct(), "shared-bands")
    # a bucket's hub is the text that meets most others over all its bands: an original rather than one of its copies
    popular = shared.groupBy("key").agg(F.sum("n").alias("met"))
    hubs = shared.join(popular, "key").groupBy(*bucket).agg(F.max(F.struct("met", "key")).alias("_top")).select(*bucket, F.col("_top.key").alias("hub"))
    members = materialise(shared.select(*bucket, "key").join(hubs, bucket), "band-members")
    discard(shared)
    pairs = members.filter("key <> hub").select("key", "hub").distinct()
    asked = materialise(members.select("key").distinct(), "near-keys")
    keyed = docs.filter(F.col(text_col).isNotNull()).select(_text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    only = maybe_broadcast(asked, asked.count(), BROADCAST_ROWS)
    texts = materialise(keyed.join(only, "key", "left_semi").dropDuplicates(["key"]), "near-texts")
    signs = materialise(signed.join(only, "key", "left_semi").select("key", "n_shingles", "signature").dropDuplicates(["key"]), "near-signatures")
    discard(signed, asked)
    links = materialise(star_links(pairs, texts, threshold), "near-links")
    labels = materialise(connected_components(links, "key", "hub"), "near-labels")

    named = members.select(*bucket, "key").join(labels.select(F.col("node").alias("key"), "label"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    named = materialise(named.join(signs.select("key", "n_shingles"), "key"), "band-labels")
    discard(members)
    # buckets of the same texts, known by count, extremes and a combined hash of their keys, are compared once, in their first band
    open_ = named.groupBy(*bucket).agg(F.count("*").alias("n"), F.sum("n_shingles").alias("_s"), F.min("label").alias("_a"), F.max("label").alias("_z"), F.bit_xor(F.xxhash64("key")).alias("_x"), F.min("key").alias("_k")).filter("_a <> _z and n > 2")
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("_s") / BLOCK_SHINGLES)).cast("int")
    open_ = open_.groupBy("n", "_s", "_a", "_z", "_x", "_k").agg(F.min(F.struct(*bucket)).alias("_b")).select("_b.*", blocks.alias("blocks"))
    spread = named.join(open_, bucket).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")).withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = [*bucket, "lo", "hi"]
    placed = spread.select(*bucket, "key", "label", "n_shingles", "block", F.least("block", "_with").alias("lo"), F.greatest("block", "_with").alias("hi")).join(signs.select("key", "signature"), "key")
    # only signatures go to every block pair; texts follow where two of them agree enough
    fitting = materialise(placed.select(*_BLOCK.names).repartition(*pair).sortWithinPartitions(*pair).mapInArrow(_candidates(threshold), "band int, h long, lo int, hi int, block int, key binary, label binary, n_shingles long, signature binary"), "block-candidates")
    more = materialise(fitting.join(texts, "key").repartition(*pair).sortWithinPartitions(*pair).mapInArrow(_cross_links(threshold), "key binary, hub binary"), "near-more")
    discard(named, signs, fitting, texts)
    if more.isEmpty():
        return labels.select(F.col("node").alias("key"), "label")
    everything = connected_components(links.unionByName(more), "key", "hub")
    return everything.select(F.col("node").alias("key"), "label")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(key, label, class, class_rows) of texts with copies or near copies: class is their smallest id, class_rows the rows that have it."""
    near = materialise(near_classes(docs, text_col, threshold), "near-classes")
    per_text = docs.filter(F.col(text_col).isNotNull()).select(_text_key(text_col).alias("key"), F.col(id_col).alias("doc")).groupBy("key", "doc").agg(F.count("*").alias("n"))
    per_text = per_text.groupBy("key").agg(F.sum("n").alias("n"), F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", (-F.col("n")).alias("rows"))).alias("least"))
    labelled = per_text.join(near, "key", "left").withColumn("label", F.coalesce("label", "key"))
    per_class = labelled.groupBy("label").agg(F.sum("n").alias("_n"), F.min("least").alias("_least")).filter("_n > 1")
    return labelled.select("key", "label").join(per_class, "label").select("key", "label", F.col("_least.doc").alias("class"), (-F.col("_least.rows")).alias("class_rows"))


def _classed(docs: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """The rows of ``docs`` as structs, each with its id, its text's class and that class's rows (null without copies)."""
    found = materialise(classes(docs, id_col, text_col, threshold), "classes")
    text = F.col("row").getField(text_col)
    keyed = packed(docs).select("row", F.col("row").getField(id_col).alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("key"))
    return keyed.join(maybe_broadcast(found, found.count(), BROADCAST_ROWS), "key", "left")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with class_id: the smallest id of the documents that are linked, over others, to this one.

    Two texts are linked if they are equal or the weighted Jaccard similarity of their bags of
    five-word shingles is at least ``threshold``. A null text is linked to nothing; empty texts
    are equal; very long texts are compared whole; a null id sorts last; repeated rows are copies; an
    empty table gives an empty one. A column called class_id is replaced, all others stay, whatever
    their names.
    """
    # without a match the class is the document itself
    named = F.when(F.col("class_rows").isNull(), F.col("id")).otherwise(F.col("class"))
    kept = [c for c in docs.columns if c.lower() != "class_id"]
    return _classed(docs, id_col, text_col, threshold).select(*(F.col("row").getField(c).alias(c) for c in kept), named.alias("class_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class: a row of its smallest id. Columns are those of ``docs``, whatever their names.

    Null texts all stay, empty ones are one class; of rows that share id and class one stays; a class
    without any id keeps one row; an empty table gives an empty one.
    """
    named = _classed(docs, id_col, text_col, threshold)
    alone, only = F.col("class_rows").isNull(), F.col("id").eqNullSafe(F.col("class"))
    sure = named.filter(alone | (only & (F.col("class_rows") == 1))).select("row")
    again = named.filter(only & (F.col("class_rows") > 1)).dropDuplicates(["label"]).select("row")
    return sure.unionByName(again).select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def op9_bagminhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "class_id")
