"""N-gram Jaccard join: documents whose sets of word shingles are alike.

The documents by shingles incidence matrix is multiplied with its transpose in
blocks. Three size-derived bounds keep the product small, and none loses a link:

1. A document of n shingles links only where at least ``threshold`` n of them occur in
   a second document. Shingles are counted in hash ranges (sorted, packed arrays, a
   few bytes for each entry), and documents with too few repeated ones are done.
2. Of the rest, equal sets become one row of the matrix. A link needs a shared shingle
   among the n - ceil(threshold n) + 1 rarest of both; documents joined through such
   shingles form candidate groups. Groups are found from one star per shingle.
3. A group is cut into blocks of rows by size. Blocks whose sizes differ too much are
   skipped; each other pair of blocks is one task, which multiplies slab by slab of
   columns, adds up the overlaps and drops pairs that can no longer reach the bound.

A block pair returns the number of links of each row and a spanning forest of them, so
a group of many alike documents never comes out as all its pairs.

Defined results: text null, empty or blank: no shingles, linked with nothing. Fewer
words than a shingle: the whole sequence is the one shingle. ``doc_id`` null: the row
is returned with its set size, links with nothing, component null. Rows that repeat
a doc_id count as one document with the links of each. An empty table gives no rows.
Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Forest, U, Words, components, query, sliced, stored, table, written

SHINGLE = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Text bytes for each hash range, and shingles at which a map task packs what it has.
RANGE_BYTES = 4 << 20
PACK_SHINGLES = 4_000_000
PACK_DOCS = 1 << 16
#: A block of rows ends at about this many entries; each row also counts as ROW_WEIGHT.
BLOCK_ENTRIES = 1 << 18
ROW_WEIGHT = 512
SLAB = 4096

PACKED = "bucket long, block long, packed binary"
ROWS = "doc_id long, n_shingles long, set_a long, set_b long, repeated long"


def distinct_sets(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    words = Words(batch.column(batch.schema.get_field_index("text")))
    for shingles in words.shingles(size):
        yield np.unique(shingles)


def fingerprint(grams: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share."""
    return int(np.add.reduce(grams * U(0x9FB21C651E98DF25)).view(np.int64)), int(
        np.bitwise_xor.reduce(grams * (grams >> U(7) | U(1))).view(np.int64)
    )


# --- bound 1: repeated shingles, counted in hash ranges -----------------------------


def _planes(values: np.ndarray, width: int) -> bytes:
    """Byte planes, so that leading zeros lie together and compress."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unplaned(raw: np.ndarray, count: int, width: int) -> np.ndarray:
    out = np.zeros((count, 8), np.uint8)
    out[:, :width] = raw.reshape(width, count).T
    return out.view("<u8").ravel()


def _pack(ranges: int, bits: int, size: int):
    """Packs of (hash of ``bits`` bits, place of the document in its pack), dealt out by hash range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, packs, squeeze = TaskContext.get().partitionId(), 0, zstandard.ZstdCompressor(level=1)
        names: list[tuple] = []
        keys: list[np.ndarray] = []
        held = 0

        def flush():
            block = task << 24 | packs
            entries = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
            hashes, docs = entries >> U(16), entries & U(0xFFFF)
            bucket = (hashes * U(ranges)) >> U(bits)
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            out = {"bucket": [], "block": [], "packed": []}
            for a, b in zip([0, *cuts], [*cuts, len(entries)]):
                if a < b:
                    gaps = np.diff(hashes[a:b], prepend=U(0))
                    out["bucket"].append(int(bucket[a]))
                    out["packed"].append(squeeze.compress(_planes(gaps, 6) + _planes(docs[a:b], 2)))
            out["bucket"].append(-1 - block % ranges)
            out["packed"].append(
                np.array([(i or 0, i is None, n, x, y) for i, n, x, y in names], dtype="<i8").tobytes()
            )
            out["block"] = [block] * len(out["bucket"])
            return pa.RecordBatch.from_pydict(out, schema=schema)

        schema = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("packed", pa.binary())])
        for batch in batches:
            for part in sliced(batch, "text"):
                ids = part.column(part.schema.get_field_index("doc_id")).to_pylist()
                for doc_id, grams in zip(ids, distinct_sets(part, size)):
                    keys.append((grams >> U(64 - bits)) << U(16) | U(len(names)))
                    names.append((doc_id, len(grams), *fingerprint(grams)))
                    held += len(grams)
                    if held >= PACK_SHINGLES or len(names) >= PACK_DOCS:
                        yield flush()
                        packs, names, keys, held = packs + 1, [], [], 0
        if names:
            yield flush()

    return run


def _count_repeated(group: pd.DataFrame) -> pd.DataFrame:
    """Of one hash range: for each pack, how many shingles of each document occur twice or more."""
    if group["bucket"].iloc[0] < 0:
        return group.assign(named=True)[["block", "named", "packed"]]
    unpacked = []
    for block, packed in zip(group["block"], group["packed"]):
        raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
        count = len(raw) // 8
        unpacked.append((block, np.cumsum(_unplaned(raw[: 6 * count], count, 6)), _unplaned(raw[6 * count :], count, 2)))
    merged = np.sort(np.concatenate([hashes for _, hashes, _ in unpacked]))
    twice = np.unique(merged[1:][merged[1:] == merged[:-1]])
    out = []
    for block, hashes, docs in unpacked:
        if len(twice):
            at = np.minimum(np.searchsorted(twice, hashes), len(twice) - 1)
            counts = np.bincount(docs[twice[at] == hashes].astype(np.int64))
            which = np.flatnonzero(counts)
            if len(which):
                out.append((block, False, np.stack([which, counts[which]]).astype("<u4").tobytes()))
    return pd.DataFrame(out, columns=["block", "named", "packed"])


def _name_counts(group: pd.DataFrame) -> pd.DataFrame:
    """Of one pack: its documents with the counts of all hash ranges added up."""
    names = np.frombuffer(group.loc[group["named"], "packed"].iloc[0], "<i8").reshape(-1, 5)
    repeated = np.zeros(len(names), np.int64)
    for packed in group.loc[~group["named"], "packed"]:
        which, counts = np.frombuffer(packed, "<u4").reshape(2, -1)
        repeated[which] += counts
    ids = pd.Series(names[:, 0], dtype="Int64").mask(names[:, 1].astype(bool))
    return pd.DataFrame(
        {"doc_id": ids, "n_shingles": names[:, 2], "set_a": names[:, 3], "set_b": names[:, 4], "repeated": repeated}
    )


def set_rows(documents: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Per document: size and fingerprint of its shingle set, and how many shingles are repeated elsewhere."""
    documents = documents.select("doc_id", "text")
    text_size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # About 400 values for each shingle, whatever the size: chance repeats stay rare, and
    # only let a document through to the exact steps.
    bits = min(48, 16 + (text_size >> 10).bit_length())
    packed = documents.mapInArrow(_pack(1 + text_size // RANGE_BYTES, bits, size), PACKED)
    counted = packed.groupBy("bucket").applyInPandas(_count_repeated, "block long, named boolean, packed binary")
    return counted.groupBy("block").applyInPandas(_name_counts, ROWS)


# --- bounds 2 and 3 -------------------------------------------------------------------


def _least_overlap(n: str, percent: int) -> F.Column:
    """ceil(percent n / 100) in whole numbers."""
    return F.expr(f"({percent} * {n} + 99) div 100")


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text"):
                grams = list(distinct_sets(part, size))
                marks = [fingerprint(g) for g in grams]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(part.schema.get_field_index("doc_id")),
                        pa.array([len(g) for g in grams], pa.int64()),
                        pa.array([a for a, _ in marks], pa.int64()),
                        pa.array([b for _, b in marks], pa.int64()),
                        pa.array([g.view(np.int64) for g in grams], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "grams"],
                )

    return run


def candidate_groups(sets: DataFrame, percent: int) -> DataFrame:
    """(id, component): matrix rows joined through a shared shingle among their rarest."""
    entries = sets.select("doc_id", "n_shingles", F.explode("grams").alias("gram"))
    repeated = entries.groupBy("gram").agg(F.count("*").alias("in_rows")).where("in_rows > 1")
    own = Window.partitionBy("doc_id")
    ranked = (
        entries.join(repeated, "gram")
        .withColumn("rank", F.row_number().over(own.orderBy("in_rows", "gram")))
        .withColumn("n_repeated", F.count("*").over(own))
        .where(F.col("rank") <= F.col("n_repeated") - _least_overlap("n_shingles", percent) + 1)
    )
    prefix = stored(ranked.select("gram", "doc_id"))
    centres = prefix.groupBy("gram").agg(F.min("doc_id").alias("centre"), F.count("*").alias("held")).where("held > 1")
    stars = prefix.join(centres, "gram").where("doc_id > centre").select(F.col("centre").alias("a"), F.col("doc_id").alias("b"))
    return components(stars.distinct())


def overlaps(left: list[np.ndarray], right: list[np.ndarray], percent: int, same: bool) -> np.ndarray:
    """Which rows of two blocks link: the sparse product, slab by slab of shared columns."""
    n_left, n_right = (np.array([len(g) for g in side], np.int64) for side in (left, right))
    # 100 k >= percent (n + m - k)  <=>  k >= percent (n + m) / (100 + percent)
    need = -(-percent * (n_left[:, None] + n_right[None, :]) // (100 + percent))
    live = (np.minimum(n_left[:, None], n_right[None, :]) >= need) & (need > 0)
    if same:
        live &= np.tri(len(left), k=-1, dtype=bool).T
    column, code = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    row = np.concatenate([np.repeat(np.arange(len(left)), n_left), np.repeat(len(left) + np.arange(len(right)), n_right)])
    on_left = np.bincount(code[: n_left.sum()], minlength=len(column)) > 0
    on_right = np.bincount(code[n_left.sum() :], minlength=len(column)) > 0
    shared = (on_left & on_right)[code]
    code, row = np.unique(code[shared], return_inverse=True)[1], row[shared]
    order = np.argsort(code, kind="stable")
    code, row = code[order], row[order]
    rest = np.bincount(row, minlength=len(left) + len(right))
    found = np.zeros((len(left), len(right)), np.int64)
    width = int(code[-1]) + 1 if len(code) else 0
    for base in range(0, width, SLAB):
        possible = found + np.minimum(rest[: len(left), None], rest[None, len(left) :])
        live &= possible >= need
        if not live.any():
            break
        a, b = np.searchsorted(code, (base, base + SLAB))
        slab = np.zeros((len(left) + len(right), min(SLAB, width - base)), np.float32)
        slab[row[a:b], code[a:b] - base] = 1
        rest = rest - np.bincount(row[a:b], minlength=len(rest))
        rows, columns = live.any(axis=1), live.any(axis=0)
        found[np.ix_(rows, columns)] += (slab[: len(left)][rows] @ slab[len(left) :][columns].T).astype(np.int64)
    return live & (found >= need)


def _multiply(percent: int):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        _, low, high = key
        group = group.sort_values("doc_id")
        first = group[group["block"] == low]
        second = group[group["block"] == high]
        left, right = ([np.asarray(g).view(np.uint64) for g in side["grams"]] for side in (first, second))
        links = overlaps(left, right, percent, low == high)
        a, b = (side["doc_id"].to_numpy() for side in (first, second))
        n_a, n_b = (links @ second["copies"].to_numpy(np.int64), first["copies"].to_numpy(np.int64) @ links)
        out = [(x, None, n) for x, n in zip([*a, *b], [*n_a, *n_b]) if n]
        forest = Forest()
        for i, j in zip(*np.nonzero(links)):
            forest.join(int(a[i]), int(b[j]))
        out += [(x, y, 0) for x, y in forest.stars()]
        return pd.DataFrame(out, columns=["a", "b", "links"]).astype({"b": "Int64"})

    return run


def block_links(groups: DataFrame, percent: int) -> DataFrame:
    """(a, b, links): spanning links (b not null) and numbers of linked documents (b null)."""
    line = Window.partitionBy("component").orderBy("n_shingles", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    places = groups.select("component", "doc_id", "n_shingles").withColumn(
        "block", F.floor((F.sum(F.col("n_shingles") + ROW_WEIGHT).over(line) - 1) / BLOCK_ENTRIES)
    )
    blocks = places.groupBy("component", "block").agg(
        F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most")
    )
    low, high = (blocks.select("component", *(F.col(c).alias(f"{c}_{side}") for c in ("block", "least", "most"))) for side in ("low", "high"))
    pairs = low.join(high, "component").where(
        (F.col("block_low") <= F.col("block_high")) & (100 * F.col("most_low") >= percent * F.col("least_high"))
    )
    # Each block goes to the pairs it is part of; a pair is one task.
    tasks = pairs.select(
        "component", "block_low", "block_high",
        F.explode(F.array_distinct(F.array("block_low", "block_high"))).alias("block"),
    )
    return (
        places.join(tasks, ["component", "block"])
        .join(groups.select("doc_id", "copies", "grams"), "doc_id")
        .groupBy("component", "block_low", "block_high")
        .applyInPandas(_multiply(percent), "a long, b long, links long")
    )


def ngram_jaccard_join(documents: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row of ``documents``: doc_id, n_shingles, component_id, n_links.

    component_id is the smallest doc_id that links reach, n_links the number of
    other documents that the document itself links with, equal ones included.
    """
    rows = stored(set_rows(documents, size))
    able = rows.where("doc_id is not null and n_shingles > 0").where(F.col("repeated") >= _least_overlap("n_shingles", percent))
    same_set = ["n_shingles", "set_a", "set_b"]
    classes = stored(able.groupBy(*same_set).agg(F.min("doc_id").alias("head"), F.countDistinct("doc_id").alias("copies")))
    members = able.join(classes, same_set).select("doc_id", "head", "copies").distinct()

    # Counted again among one document of each class, copies no longer vouch for each other.
    texts = documents.select("doc_id", "text")
    heads = texts.join(classes.select(F.col("head").alias("doc_id")).distinct(), "doc_id", "left_semi")
    alike = set_rows(heads, size).where(F.col("repeated") >= _least_overlap("n_shingles", percent)).select("doc_id").distinct()
    sets = texts.join(written(alike), "doc_id", "left_semi").mapInArrow(_sets(size), "doc_id long, n_shingles long, set_a long, set_b long, grams array<long>")
    sets = (
        sets.join(classes.withColumnRenamed("head", "doc_id"), ["doc_id", *same_set]).dropDuplicates(["doc_id", *same_set])
        .select(F.xxhash64("doc_id", *same_set).alias("row_id"), "doc_id", "n_shingles", "copies", "grams")
    )
    # A matrix row is a set; its id is its smallest document, or a hash where that document has several sets.
    several = Window.partitionBy("doc_id")
    sets = sets.withColumn("row_id", F.when(F.count("*").over(several) == 1, F.col("doc_id")).otherwise(F.col("row_id")))
    sets = stored(sets)
    named = (sets.select("row_id", "doc_id", "n_shingles", "copies"))
    matrix = sets.select(F.col("row_id").alias("doc_id"), "n_shingles", "copies", "grams")
    groups = matrix.join(candidate_groups(matrix, percent).withColumnRenamed("id", "doc_id"), "doc_id")
    linked = stored(block_links(groups, percent))

    names = named.select(F.col("row_id"), F.col("doc_id").alias("name"))
    spanning = linked.where("b is not null").select("a", "b")
    for end in ("a", "b"):
        spanning = spanning.join(names.withColumnRenamed("row_id", end), end).drop(end).withColumnRenamed("name", end)
    edges = spanning.select("a", "b").union(members.where("doc_id <> head").select("head", "doc_id"))
    found = components(edges)

    near = linked.where("b is null").join(names.withColumnRenamed("row_id", "a"), "a").groupBy("name").agg(F.sum("links").alias("near"))
    counts = (
        members.join(near.withColumnRenamed("name", "head"), "head", "left")
        .groupBy("doc_id").agg(F.sum(F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    return (
        rows.select("doc_id", "n_shingles")
        .join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .join(counts, "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component", "doc_id").alias("component_id"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        )
    )


@query("op3_ngram_join")
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents"))


# --- stage of the pipeline --------------------------------------------------------------


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest doc_id.

    Rows without a doc_id stay; of rows that repeat a doc_id, all stay if it leads its group.
    """
    losers = ngram_jaccard_join(docs).where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(losers, "doc_id", "left_anti").select(*docs.columns)
