"""N-gram Jaccard join with a MinHash LSH forest.

Every distinct set of 5-word shingles has a signature of ``TREES`` x ``DEPTH`` minimum hashes. A
tree is a trie over one row of the signature; sets that share a prefix of it are candidates. The
prefix is shortened from the full depth until the chance that two sets of the wanted similarity
share it in some tree reaches the target recall. Candidates are verified by their exact Jaccard
similarity.

Pairs are never written out. A prefix group is cut into blocks of members, and a task takes two
blocks, finds the similar pairs between them with one matrix product, and returns for each member
the number of its links and one neighbour of its connected part. A pair that meets in several
trees counts in the first of them only; groups with the same members in several trees are one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm import batches as B
from tickweave.llm.frames import NO_ID, arrow_schema, fresh, keyed_texts, materialize

SHINGLE = 5
THRESHOLD = 0.8
TREES = 24
DEPTH = 8
TARGET_RECALL = 0.9999     # of pairs exactly at the threshold; above it recall is higher
BLOCK_MEMBERS = 256
BLOCK_SHINGLES = 250_000
U64 = np.uint64

MULTIPLIERS = B.random_odd(TREES * DEPTH, 31)


def prefix_length(threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> int:
    """The longest prefix at which the forest reaches the recall, shortening it step by step."""
    for length in range(DEPTH, 1, -1):
        if 1 - (1 - threshold ** length) ** TREES >= recall:
            return length
    return 1


# ------------------------------------------------------------------------------ sets, signatures
def shingle_sets(piece: B.Slice):
    """Distinct shingle hashes of each row, sorted, and their borders.

    Words are maximal runs of ASCII letters and digits and non-ASCII characters, A-Z lowered. A
    text of fewer than five words is one shingle; one without words has none.
    """
    words = B.find_words(piece.data, piece.offsets, B.ALPHANUMERIC, lower=True)
    count = words.counts
    roll = B.Rolling(words.code)
    starts, row = B.window_starts(words.first, SHINGLE)
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    row = np.concatenate([row, short])
    low = np.concatenate([starts, words.first[short]])
    high = np.concatenate([starts + SHINGLE, words.first[short + 1]])
    codes = roll.ranges(low, high)
    order = np.lexsort((codes, row))
    row, codes = row[order], codes[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (codes[1:] != codes[:-1])
    row, codes = row[fresh], codes[fresh]
    return codes, np.searchsorted(row, np.arange(len(count) + 1))


def per_row(ufunc, values: np.ndarray, borders: np.ndarray, empty) -> np.ndarray:
    """Reduce the values of each row; rows without values get ``empty``."""
    out = np.full(len(borders) - 1, empty, values.dtype)
    filled = borders[:-1] < borders[1:]
    if filled.any():
        out[filled] = ufunc.reduceat(values, borders[:-1][filled])
    return out


def prefixes(codes: np.ndarray, borders: np.ndarray, length: int) -> np.ndarray:
    """Hash of the first ``length`` signature entries of every tree, rows x trees."""
    rows = len(borders) - 1
    out = np.zeros((rows, TREES), U64)
    for tree in range(TREES):
        total = np.full(rows, tree, U64)
        for level in range(length):
            least = per_row(np.minimum, codes * MULTIPLIERS[tree * DEPTH + level], borders, 0)
            total = total * U64(0x9E3779B97F4A7C15) + least
        out[:, tree] = B.mix(total)
    return out


def signatures(docs: DataFrame, length: int) -> DataFrame:
    """Per row: set hashes ``c1, c2`` (null without shingles), set size, prefix of every tree."""
    ddl = "_id long, _h long, c1 long, c2 long, n_shingles int, prefixes array<long>"
    schema = arrow_schema(ddl)

    def run(stream):
        for piece in B.text_slices(stream):
            codes, borders = shingle_sets(piece)
            sizes = np.diff(borders)
            missing = sizes == 0
            c1 = per_row(np.add, codes, borders, 0)
            c2 = per_row(np.add, B.mix(codes ^ U64(0x5851F42D4C957F2D)), borders, 0)
            rows = prefixes(codes, borders, length)
            listed = pa.ListArray.from_arrays(
                pa.array(np.arange(len(sizes) + 1) * TREES, pa.int32()),
                pa.array(B.longs(rows.ravel())))
            yield B.batch_of(schema, piece.rows.column(0), piece.rows.column(1),
                             pa.array(B.longs(c1), mask=missing), pa.array(B.longs(c2), mask=missing),
                             sizes, listed)

    return docs.mapInArrow(run, ddl)


# ------------------------------------------------------------------------------ verification
def similar_pairs(codes_a, borders_a, codes_b, borders_b, threshold):
    """Index pairs of two lists of sets whose Jaccard similarity reaches the threshold."""
    size_a, size_b = np.diff(borders_a), np.diff(borders_b)
    if len(size_a) == 1 and len(size_b) == 1:
        shared = np.array([[len(np.intersect1d(codes_a, codes_b, assume_unique=True))]])
    else:
        both = np.intersect1d(np.unique(codes_a), np.unique(codes_b), assume_unique=True)
        left = incidence(codes_a, borders_a, both)
        right = incidence(codes_b, borders_b, both)
        shared = np.zeros((len(size_a), len(size_b)), np.float64)
        for at in range(0, len(both), 8192):  # bounded matrices
            width = min(8192, len(both) - at)
            shared += dense(left, at, len(size_a), width) @ dense(right, at, len(size_b), width).T
    # j >= t for the ratio as computed in double precision
    union = size_a[:, None] + size_b[None] - shared
    return np.nonzero(shared / np.maximum(union, 1) >= threshold)


def incidence(codes, borders, vocabulary):
    at = np.minimum(np.searchsorted(vocabulary, codes), max(0, len(vocabulary) - 1))
    known = vocabulary[at] == codes if len(vocabulary) else np.zeros(len(codes), bool)
    member = np.repeat(np.arange(len(borders) - 1), np.diff(borders))
    order = np.argsort(at[known], kind="stable")
    return at[known][order], member[known][order]


def dense(listed, first: int, rows: int, width: int) -> np.ndarray:
    at, member = listed
    low, high = np.searchsorted(at, [first, first + width])
    out = np.zeros((rows, width), np.float32)
    out[member[low:high], at[low:high] - first] = 1
    return out


def link_blocks(threshold: float):
    """For each task group of one or two blocks: links per member and edges that span its parts."""
    schema = arrow_schema("member long, links long, other long")

    def run(stream):
        for table in B.sorted_groups(stream, ["bucket", "left", "right"], 512):
            starts = B.group_starts(table, ["bucket", "left", "right"])
            column = {n: table.column(n).to_numpy() for n in ("left", "right", "own", "member", "tree")}
            codes, borders = flat_longs(table.column("codes"))
            marks, _ = flat_longs(table.column("prefixes"))
            marks = marks.reshape(-1, TREES)
            out = []
            for low, high in zip(starts, np.append(starts[1:], table.num_rows)):
                rows = np.arange(low, high)
                same = column["left"][low] == column["right"][low]
                one = rows if same else rows[column["own"][low:high] == column["left"][low]]
                two = rows if same else rows[column["own"][low:high] == column["right"][low]]
                if not len(one) or not len(two):
                    continue
                i, j = similar_pairs(*pick(codes, borders, one), *pick(codes, borders, two),
                                     threshold)
                i, j = one[i], two[j]
                if same:
                    i, j = i[i < j], j[i < j]
                first = (marks[i] == marks[j]).argmax(axis=1)   # the first tree where they meet
                here = first == column["tree"][low]
                out.append((i[here], j[here]))
            if not out:
                continue
            i, j = (np.concatenate(x) for x in zip(*out))
            yield from summed(column["member"], i, j, schema)

    return run


def summed(member, i, j, schema):
    """Links of each member, and for each a smallest member it is connected to in this batch."""
    if not len(i):
        return
    low, high = np.minimum(member[i], member[j]), np.maximum(member[i], member[j])
    ids, spot = np.unique(np.concatenate([low, high]), return_inverse=True)
    a, b = spot[:len(low)], spot[len(low):]
    label = np.arange(len(ids))
    while True:                      # smallest label along the links
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    yield B.batch_of(schema, ids, np.bincount(spot, minlength=len(ids)), ids[label])


def flat_longs(column) -> tuple[np.ndarray, np.ndarray]:
    array = column.combine_chunks()
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks)
    borders = np.concatenate([[0], np.cumsum(array.value_lengths().to_numpy())]).astype(np.int64)
    return array.flatten().to_numpy(), borders


def pick(codes, borders, rows):
    sizes = (borders[1:] - borders[:-1])[rows]
    return codes[B.ragged(borders[:-1][rows], sizes)], np.concatenate([[0], np.cumsum(sizes)])


# ------------------------------------------------------------------------------ components
def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``member, part``: the smallest member that edges (``member, other``) connect each node to.

    Labels travel along the edges and then jump to the label of the label, so the number of rounds
    is about the logarithm of the longest chain. Every round is a written table.
    """
    both = edges.select("member", "other").filter("member <> other").distinct()
    both = materialize(both.unionByName(both.select(
        F.col("other").alias("member"), F.col("member").alias("other"))).distinct())
    labels = materialize(nodes.select("member", F.col("member").alias("part")))
    while True:
        near = both.join(labels.withColumnRenamed("member", "other"), "other").groupBy(
            "member").agg(F.min("part").alias("near"))
        met = materialize(labels.join(near, "member", "left").select(
            "member", "part", F.least("part", F.coalesce("near", "part")).alias("now")))
        jumped = met.alias("a").join(
            met.select(F.col("member").alias("now"), F.col("now").alias("far")), "now", "left")
        after = materialize(jumped.select(
            "member", "part", F.least("now", F.coalesce("far", "now")).alias("now")))
        if not after.filter("now < part").take(1):
            return labels
        labels = after.select("member", F.col("now").alias("part"))


# ------------------------------------------------------------------------------ the operator
def linked_rows(docs: DataFrame, id_col: str, text_col: str, threshold: float, recall: float,
                block_members: int) -> DataFrame:
    """Per row: keys, set, class and links; ``stays`` marks the row that stands for its class."""
    length = prefix_length(threshold, recall)
    source = keyed_texts(docs, id_col, text_col)
    signed = materialize(signatures(source, length))

    # one row per distinct set; copies are gathered before anything is compared
    ident = F.when(F.col("_id") != NO_ID, F.col("_id"))
    sets = materialize(signed.filter("c1 is not null").groupBy("c1", "c2").agg(
        F.min(ident).alias("name"), F.min(F.struct("_id", "_h")).alias("sample"),
        F.first("prefixes").alias("prefixes"), F.first("n_shingles").alias("n_shingles"))
        .withColumn("member", F.xxhash64("c1", "c2")))

    # groups of sets that share a prefix; the same group of several trees is kept once
    met = sets.select("member", "n_shingles", F.posexplode("prefixes").alias("tree", "prefix"))
    groups = met.groupBy("tree", "prefix").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n_shingles").alias("shingles"),
        F.sum(F.xxhash64("member", F.lit(1)).cast("decimal(38,0)")).alias("mark")).filter("size > 1")
    groups = groups.groupBy("size", "mark").agg(F.min(F.struct("tree", "prefix")).alias("at"),
                                                F.first("shingles").alias("shingles"))
    blocks = F.ceil(F.greatest(F.col("size") / block_members,
                               F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    groups = groups.select("at.tree", "at.prefix", blocks.alias("blocks"))
    joined = materialize(met.join(groups, ["tree", "prefix"]).select(
        "member", "tree", "prefix", "blocks",
        F.pmod(F.xxhash64("member", F.lit(2)), F.col("blocks")).cast("int").alias("own")))

    # each member goes to every pair of blocks that its own block is part of
    dealt = joined.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "member", "tree", F.xxhash64("tree", "prefix").alias("bucket"), "own",
        F.least("own", "with").alias("left"), F.greatest("own", "with").alias("right"))
    codes = set_codes(source, sets.join(joined.select("member").distinct(), "member", "left_semi"))
    tasks = dealt.join(codes, "member").repartition("bucket", "left", "right")
    links = materialize(tasks.sortWithinPartitions("bucket", "left", "right").select(
        "bucket", "left", "right", "own", "member", "tree", "prefixes", "codes").mapInArrow(
        link_blocks(threshold), "member long, links long, other long"))

    counted = links.groupBy("member").agg(F.sum("links").alias("n_links"))
    parts = components(links.select("member").distinct(), links)
    named = sets.select("member", "name", "sample", "c1", "c2").join(
        counted, "member", "left").join(parts, "member", "left").withColumn(
        "part", F.coalesce("part", "member"))
    classes = named.groupBy("part").agg(F.min("name").alias("class_id"),
                                        F.min("sample").alias("stays"))
    found = named.join(classes, "part").select("c1", "c2", "name", "class_id", "stays", "n_links")
    rows = signed.select("_id", "_h", ident.alias("doc_id"), "c1", "c2", "n_shingles")
    return rows.join(found, ["c1", "c2"], "left").select(
        "_id", "_h", "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("name", "doc_id").alias("same_set_id"), "n_shingles",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.col("stays") == F.struct("_id", "_h"), F.lit(True)).alias("stays"))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD, recall: float = TARGET_RECALL,
                 block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """Per row: ``doc_id``, ``class_id``, ``same_set_id``, ``n_shingles`` and ``n_links``.

    ``same_set_id`` is the smallest id with the same set of shingles (copies, and texts that differ
    in case, punctuation or order only), ``n_links`` the number of *other* such sets whose Jaccard
    similarity is ``threshold`` or more, and ``class_id`` the smallest id connected through links.
    Null and empty texts have no shingles: they link to nothing and are their own class. Rows with a
    null id take part and appear with null; they lend no name to a class.
    """
    return linked_rows(docs, id_col, text_col, threshold, recall, block_members).select(
        "doc_id", "class_id", "same_set_id", "n_shingles", "n_links")


def one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that link to a row of smaller id, directly or through others.

    Of equal ids the smaller text hash stays, a null id counts as the smallest. Rows that agree in
    id and text are one document and stay or go together. Texts without words stay.
    """
    linked = linked_rows(docs, id_col, text_col, THRESHOLD, TARGET_RECALL, BLOCK_MEMBERS)
    key_id, key_h = fresh(docs.columns, "_id", "_h")
    gone = linked.filter(~F.col("stays")).select(
        F.col("_id").alias(key_id), F.col("_h").alias(key_h)).distinct()
    text = F.col(f"`{text_col}`").cast("string")
    ident = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID))
    return docs.join(gone, (ident == F.col(key_id)) & (F.xxhash64(text) == F.col(key_h)),
                     "left_anti")


def set_codes(source: DataFrame, sets: DataFrame) -> DataFrame:
    """Shingle hashes of the sets that met another one, from one of their texts each."""
    schema = arrow_schema("_id long, _h long, codes array<long>")

    def run(stream):
        for piece in B.text_slices(stream):
            codes, borders = shingle_sets(piece)
            yield B.batch_of(schema, piece.rows.column(0), piece.rows.column(1),
                             pa.ListArray.from_arrays(pa.array(borders, pa.int32()),
                                                      pa.array(B.longs(codes))))

    wanted = sets.select("sample._id", "sample._h", "member", "prefixes")
    texts = source.select("_id", "_h", "text").join(
        wanted.select("_id", "_h"), ["_id", "_h"], "left_semi").dropDuplicates(["_id", "_h"])
    coded = texts.mapInArrow(run, "_id long, _h long, codes array<long>")
    return coded.join(wanted, ["_id", "_h"]).select("member", "prefixes", "codes")
