"""Line dedup by a log-template tree of fixed depth.

A line descends by its number of tokens and its first ``LEAD`` tokens; tokens with a digit
count as variable fields there and everywhere. In the leaf, a token stays part of the
template where it recurs at its place in enough documents; other places become
variable fields. A template is boilerplate, and all its lines go, if

- it occurs in enough unlike documents, and
- at least ``LEAST_FIXED`` of its tokens without digits are fixed, and these are at least
  ``LEAST_PLAIN`` of all.

A line also goes if it recurs word for word, digits included, in enough unlike documents.

Enough are ``LEAST_BODIES`` for few tokens, fewer for more (``EVIDENCE`` tokens in all documents
together), but never less than ``LEAST_LONG``: a quotation that two texts share stays. For a
template that is the number of its fixed tokens. For a token at a place, all tokens of the
line count; as few documents can make a value of a variable field look fixed, each line also gets
the template of the tokens that recur in ``LEAST_BODIES``, and goes if either is boilerplate.

Copies and near copies count as one document, so lines that recur because a whole text recurs
are left to document dedup. Texts are near copies if most of ``SKETCH`` least hashes of their
word shingles agree, or by a chain of such; each text is compared with the first text that shares
two of them. A passage alone makes texts alike only if it is most of what they hold.

Texts are split into words twice: once for the hashes of all lines and the sketch of each text, which are stored,
and once for the tokens of the lines in leaves that enough documents reach. Every
step is an aggregation with a part on the map side or a join. No leaf, template
or document is gathered in one place: fixed tokens follow from counts by (leaf, place,
token), and whether a line goes depends on its template alone.

Defined results: text null or empty: no lines, returned as it is. Blank lines stay. Equal
rows get equal results; rows with null or repeated doc_id are treated like all others.
A text whose last line with a word goes keeps its blank rest; the pipeline stage drops the
row. An empty table gives no rows. Other columns, whatever their names, are passed on and not read; a column
``lines_dropped`` is replaced by the operator's, and passed on by the stage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U, Words, components, mixed, query, scratch_tables, sliced, table, written

LEAD = 2
LEAST_BODIES = 10
LEAST_LONG = 3
EVIDENCE = 100
LEAST_FIXED = 0.6
LEAST_PLAIN = 0.4
SHINGLE = 5
#: Least hashes of a text, looked up in pairs.
SKETCH = 24

KEY = ["__a", "__b"]
PARTS = "__a long, __b long, line_no int, n int, leaf long, line long, exact long, bands array<long>, sketch binary"
TOKENS = "__a long, leaf long, line long, exact long, tokens array<long>"
#: Bytes of text that a task works on at a time.
SLICE_BYTES = 1 << 20
VARIABLE = U(0x5DEECE66D1CE4E5B)
PLACE = U(0x9E3779B97F4A7C15)
FACTORS = mixed(np.arange(1, SKETCH + 1, dtype=np.uint64)) | U(1)


def enough(tokens: Column) -> Column:
    """Documents in which so many fixed tokens have to recur."""
    return F.greatest(F.lit(LEAST_LONG), F.least(F.lit(LEAST_BODIES), F.ceil(EVIDENCE / tokens))).cast("int")


def keyed(documents: DataFrame) -> DataFrame:
    """Adds 128 bits that equal texts share."""
    return documents.withColumns({"__a": F.xxhash64("text"), "__b": F.xxhash64(F.lit(1), "text")})


class _Lines:
    """Lines with a word, of a run of texts: place in the text, number of tokens, leaf, and hashes of the tokens."""

    def __init__(self, texts: pa.Array):
        self.words = words = Words(texts, lower=False)
        self.whole = words.hashes()
        token = self.whole.copy()
        digit = np.concatenate([[0], np.cumsum((words.data >= 48) & (words.data <= 57), dtype=np.int32)])
        token[digit[words.end] > digit[words.start]] = VARIABLE
        breaks = np.flatnonzero(words.data == 10)
        row = np.repeat(np.arange(len(texts)), np.diff(words.first))
        line_no = np.searchsorted(breaks, words.start) - np.searchsorted(breaks, words.bounds[:-1])[row]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (line_no[1:] != line_no[:-1])
        self.first = first = np.flatnonzero(new)
        self.bounds = np.append(first, len(row))
        self.count = count = np.diff(self.bounds)
        self.row, self.line_no = row[first], line_no[first]
        leaf = mixed(count.astype(np.uint64) + PLACE)
        for k in range(LEAD):
            deep = count > k
            leaf[deep] = mixed(leaf[deep] ^ token[first[deep] + k])
        steps = (np.arange(len(row)) - np.repeat(first, count)).astype(np.uint64) * PLACE
        # Without digits in the line, ``exact`` is the same as ``line``.
        self.line, self.exact = (mixed(np.add.reduceat(mixed(t + steps), first) ^ leaf) for t in (token, self.whole))
        self.leaf, self.token = leaf, token


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each line; that of a text's first line has the sketch of the text as well."""
    pair = np.arange(SKETCH // 2, dtype=np.uint64)
    for batch in batches:
        for part in sliced(batch, "text", SLICE_BYTES):
            lines = _Lines(part.column("text"))
            if not len(lines.first):
                continue
            shingles = [s for s in lines.words.shingles(SHINGLE, lines.whole) if len(s)]
            starts = np.cumsum([0, *map(len, shingles[:-1])])
            shingles = np.concatenate(shingles)
            least = np.stack([np.minimum.reduceat(shingles * f, starts) for f in FACTORS], axis=1)
            keys = mixed(mixed(least[:, ::2] + pair) ^ least[:, 1::2]).view(np.int64)
            # The low bits: the high ones of a least hash are mostly zero.
            sketches = (mixed(least) & U(0xFFFF)).astype("<u2")
            heads = np.flatnonzero(np.diff(lines.row, prepend=-1))  # one for each text with a word
            at = np.full(len(lines.row), -1)
            at[heads] = np.arange(len(heads))
            of, at = pa.array(lines.row), pa.array(at, mask=at < 0)
            bands = pa.ListArray.from_arrays(np.arange(len(heads) + 1, dtype=np.int32) * len(pair), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("__a").take(of), part.column("__b").take(of), pa.array(lines.line_no, pa.int32()),
                    pa.array(lines.count, pa.int32()), *(pa.array(x.view(np.int64)) for x in (lines.leaf, lines.line, lines.exact)),
                    bands.take(at), pa.array([s.tobytes() for s in sketches], pa.binary()).take(at),
                ],
                names=[c.split()[0] for c in PARTS.split(", ")],
            )


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each line with its tokens."""
    for batch in batches:
        for part in sliced(batch, "text", SLICE_BYTES):
            lines = _Lines(part.column("text"))
            if len(lines.first):
                tokens = pa.ListArray.from_arrays(pa.array(lines.bounds, pa.int32()), pa.array(lines.token.view(np.int64)))
                hashes = (pa.array(x.view(np.int64)) for x in (lines.leaf, lines.line, lines.exact))
                yield pa.RecordBatch.from_arrays(
                    [part.column("__a").take(pa.array(lines.row)), *hashes, tokens], names=[c.split()[0] for c in TOKENS.split(", ")]
                )


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if len(batch):
            one, other = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u2").reshape(-1, SKETCH) for k in (2, 3))
            alike = 2 * (one == other).sum(axis=1) > SKETCH
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(alike))


def near_copies(parts: DataFrame) -> DataFrame:
    """(__a, of): texts that are near copies of others, and one text for each such group."""
    sketches = parts.where("sketch is not null").select("__a", "bands", "sketch").dropDuplicates(["__a"])
    bands = written(sketches.select("__a", F.explode("bands").alias("band"), "sketch"))
    first = bands.groupBy("band").agg(F.min(F.struct("__a", "sketch")).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = written(first.select("band", F.col("first.__a").alias("b"), F.col("first.sketch").alias("other")))
    pairs = bands.join(first, "band").where("__a <> b").select("__a", "b", "sketch", "other")
    groups = components(pairs.mapInArrow(_alike, "a long, b long").distinct())
    return groups.where("id <> component").select(F.col("id").alias("__a"), F.col("component").alias("of"))


def boilerplate_lines(texts: DataFrame, parts: DataFrame) -> DataFrame:
    """(line): hashes of the lines, with or without their digits, that are boilerplate."""
    holders = parts.select("leaf", "n", "__a").distinct()
    busy = holders.groupBy("leaf", "n").count().where(F.col("count") >= enough(F.col("n"))).select("leaf")
    lines = texts.mapInArrow(_tokens, TOKENS).join(written(busy), "leaf")
    lines = lines.groupBy("leaf", "line", "exact", "__a").agg(F.first("tokens").alias("tokens")).join(written(near_copies(parts)), "__a", "left")
    lines = lines.select("leaf", "line", "exact", F.coalesce("of", "__a").alias("body"), "tokens")
    lines = written(lines.groupBy("leaf", "line", "exact", "body").agg(F.first("tokens").alias("tokens")))

    # All lines of a leaf have the same number of tokens, n.
    n, places, variable = F.size("tokens"), ["leaf", "n", "place", "token"], F.lit(int(VARIABLE.view(np.int64)))
    whole = lines.where("line <> exact").select("exact", n.alias("n"), "body").distinct().groupBy("exact", "n").count()
    whole = whole.where(F.col("count") >= enough(F.col("n"))).select(F.col("exact").alias("line"))
    lines = lines.groupBy("leaf", "line", "body").agg(F.first("tokens").alias("tokens"))
    # A line may have M variable places; if all of the first M + 1 behind the lead are, it is
    # out, and the rest of its tokens need not be counted.
    plain = F.size(F.filter("tokens", lambda t: t != variable))
    spare = n - F.greatest(F.ceil(LEAST_FIXED * plain - 1e-9), F.ceil(LEAST_PLAIN * n - 1e-9)).cast("int")
    ahead = lines.where(n - LEAD > spare).select(
        "leaf", "line", "body", n.alias("n"), F.posexplode(F.slice("tokens", LEAD + 1, spare + 1)).alias("place", "token")
    )
    ahead = ahead.where(F.col("token") != variable)
    many = F.col("count") >= enough(F.col("n"))
    recurring = ahead.select("body", *places).distinct().groupBy(*places).count().where(many)
    able = ahead.select("line", *places).distinct().join(recurring, places).select("leaf", "line")
    able = able.union(lines.where(n - LEAD <= spare).select("leaf", "line")).distinct()
    # A common line has a row for each document; as a table beside it, ``able`` lets AQE split such a key.
    lines = written(lines.join(written(able), ["leaf", "line"]))

    placed = lines.select("body", "leaf", n.alias("n"), F.posexplode("tokens").alias("place", "token")).distinct()
    fixed = placed.groupBy(*places).count().where(many)
    kinds = lines.groupBy("leaf", "line").agg(F.first("tokens").alias("tokens"))

    def template(least: int | Column) -> Column:
        kept = F.when((F.col("count") >= least) & (F.col("token") != variable), F.col("token"))
        of_places = F.sum(F.xxhash64("place", kept).cast("decimal(38,0)"))
        return F.struct(F.xxhash64("leaf", of_places).alias("template"), F.count(kept).alias("fixed"))

    templates = (
        kinds.select("leaf", "line", n.alias("n"), F.posexplode("tokens").alias("place", "token"))
        .join(fixed, places, "left")
        .groupBy("leaf", "line", "n")
        .agg(
            F.array_distinct(F.array(template(1), template(LEAST_BODIES))).alias("found"),
            F.count(F.when(F.col("token") != variable, 1)).alias("plain"),
        )
        .select("leaf", "line", "n", "plain", F.inline("found"))
        .where((F.col("fixed") >= LEAST_FIXED * F.col("plain") - 1e-9) & (F.col("fixed") >= LEAST_PLAIN * F.col("n") - 1e-9))
        .select("leaf", "line", F.xxhash64("template", "fixed").alias("template"), enough(F.col("fixed")).alias("least"))
    )
    templates = written(templates)
    found = lines.join(templates, ["leaf", "line"]).select("template", "least", "body").distinct()
    boilerplate = found.groupBy("template", "least").count().where(F.col("count") >= F.col("least"))
    return templates.join(boilerplate, "template").select("line").union(whole).distinct()


def _cleaned(documents: DataFrame) -> DataFrame:
    """(row, text, gone): the other columns, the texts without boilerplate lines, and how many lines these were."""
    others = [F.col(name) for name in documents.columns if name != "text"]
    source = keyed(documents.select(F.struct(F.lit(0).alias("text"), *others).alias("row"), "text"))
    texts = source.select("text", *KEY)
    with scratch_tables(documents.sparkSession):
        parts = written(texts.mapInArrow(_parts, PARTS))
        lines = parts.select(*KEY, "line_no", F.explode(F.array_distinct(F.array("line", "exact"))).alias("line"))
        found = lines.join(written(boilerplate_lines(texts, parts)), "line")
        dropped = written(found.groupBy(*KEY).agg(F.collect_set("line_no").alias("gone")), lasting=True)
    joined = source.join(dropped, KEY, "left")
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("gone", i)), "\n")
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(left)
    return joined.select("row", text.alias("text"), F.coalesce(F.size("gone"), F.lit(0)).alias("gone"))


def _columns(documents: DataFrame, changed: dict[str, Column]) -> list[Column]:
    return [changed.get(name, F.col("row").getField(name)).alias(name) for name in documents.columns]


def dedup_lines(documents: DataFrame) -> DataFrame:
    """All rows and columns, with ``text`` without its boilerplate lines and ``lines_dropped``."""
    columns = [c for c, name in zip(_columns(documents, {"text": F.col("text")}), documents.columns) if name != "lines_dropped"]
    return _cleaned(documents).select(*columns, F.col("gone").alias("lines_dropped"))


@query("op7_line_templates")
def op7_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(documents).select("doc_id", "lines_dropped", "text")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage of the pipeline: texts without boilerplate lines; rows of which nothing is left go."""
    rows = _cleaned(docs)
    empty = (F.col("gone") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("gone") > 0, length).otherwise(F.col("row").getField("n_chars"))
    return rows.where(~F.coalesce(empty, F.lit(False))).select(*_columns(docs, changed))
