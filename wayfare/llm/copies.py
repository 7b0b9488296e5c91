"""Exact copies by distributed MSD radix partitioning: texts are split by their bytes from the left, without digests.

A group holds texts of one length that agree in all bytes read so far. Each level splits every group by its next
bytes (the digit); a text that is alone leaves, and a group whose bytes are used up is a class of equal texts.

1. Inside a slice of a task's rows the same recursion runs over arrays (`radix_leaders`). Equal texts of a slice get
   one leader, and only leaders travel on, so a group with a third of all rows sends one text per slice. The members,
   their leaders and what the leaders' texts hold beyond the first digit are written once.
2. Level 0 splits the leaders by length and first `HEAD` bytes: one aggregate over short keys. Most texts are
   alone after it and are never moved.
3. The texts of the groups that are left are split by digits of `DIGIT` bytes, `GROWTH` times wider at every
   level, until their length is used up: the number of levels grows with the logarithm of the longest text, and
   a byte is moved at most once per level that its text is still undecided. The label of a group is the least
   row number in it, found by an aggregate that combines before the shuffle; rows get it by a join on (group,
   digit), whose larger side AQE may split.

Row numbers are made while step 1 is written and read back from there, so a repeated task can't change them.

Edge cases: a null text counts as an empty one; all empty texts are copies of each other; rows with equal id and
text are copies, of which one stays; a null id is below all others; an empty table gives an empty result; texts
may hold any bytes, also zeros; other columns are not read (`drop_copies` hands them on).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.graph import keep
from wayfare.llm.words import ragged, slices

HEAD = 32
SLICE = 1 << 23        # bytes of text that are compared in a task at once
DIGIT, GROWTH = 2048, 16
LOCAL_CELLS = 1 << 24  # bytes of a local digit matrix
PARTITION_BITS = 34    # row numbers of a task


def radix_leaders(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text of a slice the first text equal to it."""
    size, leader = np.diff(offsets), np.arange(len(offsets) - 1)
    rows = leader
    _, group = np.unique(size, return_inverse=True)
    done, width = 0, 8
    while True:
        rows_of = np.bincount(group)
        busy = rows_of[group] > 1
        rows, group = rows[busy], group[busy]
        ended = size[rows] <= done
        if ended.any():
            first = np.full(len(rows_of), len(leader))
            np.minimum.at(first, group[ended], rows[ended])
            leader[rows[ended]] = first[group[ended]]
            rows, group = rows[~ended], group[~ended]
        if not len(rows):
            return leader
        width = max(8, min(width, LOCAL_CELLS // len(rows)))
        digit = np.zeros((len(rows), 8 + width), np.uint8)
        digit[:, :8] = group.astype(">u8").view(np.uint8).reshape(-1, 8)
        take = np.minimum(size[rows] - done, width)
        cells = ragged(np.arange(len(rows)) * (8 + width) + 8, take)
        digit.ravel()[cells] = buf[ragged(offsets[rows] + done, take)]
        _, group = np.unique(digit.view(f"V{8 + width}").ravel(), return_inverse=True)
        done, width = done + width, width * 2


def _members(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """One row per document: row number, id, its leader in the slice, the leader's number of rows and last row
    with its id, and for leaders also length, first digit, the other bytes and the SHA-256 of the text."""
    kind = docs.schema[id_column].dataType.simpleString()
    fields = (f"row long, id {kind}, lead long, n long, top_id {kind}, top_row long, n_bytes long, head binary, "
              "rest binary, sha binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << PARTITION_BITS
        for batch in batches:
            for first, buf, offsets in slices(batch.column(1), most=SLICE):
                n = len(offsets) - 1
                ids = batch.column(0).slice(first, n)
                rank = pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="first").to_numpy()
                leader = radix_leaders(buf, offsets)
                own = leader == np.arange(n)
                count = np.bincount(leader, minlength=n)
                by_rank = np.argsort(rank)
                top = np.zeros(n, np.int64)
                top[leader[by_rank]] = by_rank  # the last one written has the highest rank
                top = top[leader]
                raw, edge = memoryview(buf), offsets.tolist()
                shas = [hashlib.sha256(raw[edge[i]:edge[i + 1]]).digest() if o else b"" for i, o in enumerate(own.tolist())]
                cut = [min(edge[i] + HEAD, edge[i + 1]) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(n)), ids, pa.array(row + leader), pa.array(count[leader]), ids.take(pa.array(top)),
                     pa.array(row + top), pa.array(np.diff(offsets), mask=~own),
                     pa.array([bytes(raw[edge[i]:cut[i]]) if o else None for i, o in enumerate(own.tolist())], pa.binary()),
                     pa.array([bytes(raw[cut[i]:edge[i + 1]]) if o else None for i, o in enumerate(own.tolist())], pa.binary()),
                     pa.array([shas[i] for i in leader.tolist()], pa.binary())],
                    names=[f.split()[0] for f in fields.split(", ")])
                row += n

    return docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")) \
        .mapInArrow(run, fields)


def _split(rows: DataFrame, keys: list[str]) -> DataFrame:
    """`rows` whose keys occur twice or more, with the least row number of these as `label`."""
    label = rows.groupBy(*keys).agg(F.min("row").alias("label"), F.count("*").alias("n")).where("n > 1").drop("n")
    return rows.join(label, keys)


def _classes(spark: SparkSession, members: DataFrame) -> DataFrame:
    """row and root: leaders equal to a leader of another slice, with the least row of their class."""
    leaders = members.where(F.col("head").isNotNull())
    found = keep(spark, _split(leaders.select("row", "n_bytes", "head"), ["n_bytes", "head"])
                 .select("row", "n_bytes", "label"), "copies-head")
    final = found.where(F.col("n_bytes") <= HEAD).select("row", F.col("label").alias("root"))
    open_ = found.where(F.col("n_bytes") > HEAD)
    left, width = HEAD, DIGIT
    # merged at every size, as the undecided rows grow with the corpus
    texts = leaders.where(F.col("n_bytes") > HEAD).select("row", "rest").hint("merge")
    level = keep(spark, texts.join(open_.select("row", "n_bytes", F.col("label").alias("grp")), "row"), "copies-level")
    while not level.isEmpty():
        digit = level.select("row", "n_bytes", "grp", F.substring("rest", 1, width).alias("digit"),
                             F.expr(f"substring(rest, {width + 1})").alias("rest"))
        split = keep(spark, _split(digit, ["grp", "digit"]).select("row", "n_bytes", F.col("label").alias("grp"), "rest"), "copies-level")
        left += width
        final = final.unionByName(split.where(F.col("n_bytes") <= left).select("row", F.col("grp").alias("root")))
        level, width = split.where(F.col("n_bytes") > left), width * GROWTH
    return final


def equal_texts(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, keep_id (the largest id among its equals), group_size, kept and text_sha256.

    Exactly one row of a group is kept, also where its id occurs twice."""
    members = keep(spark, _members(docs, id_column, text_column), "copies")
    roots = keep(spark, _classes(spark, members), "copies-roots")
    leads = members.where(F.col("head").isNotNull()).select("row", "n", "top_id", "top_row")
    top = F.max(F.struct("top_id", "top_row"))
    groups = roots.join(leads, "row").groupBy("root").agg(F.sum("n").alias("size"), top.alias("top"))
    # a leader's class is joined to its members by the leader's row: no key has more rows than a slice
    classes = roots.join(groups, "root").select(F.col("row").alias("lead"), "size", "top")
    out = members.select("row", "id", "lead", "n", "top_id", "top_row", "sha").join(classes, "lead", "left")
    met = F.col("size").isNotNull()
    return out.select(
        F.col("id").alias(id_column), F.when(met, F.col("top.top_id")).otherwise(F.col("top_id")).alias("keep_id"),
        F.coalesce("size", "n").alias("group_size"),
        (F.when(met, F.col("top.top_row")).otherwise(F.col("top_row")) == F.col("row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; of rows with equal id and text any one stays."""
    digest = "digest"
    while digest in docs.columns:
        digest += "_"
    stay = equal_texts(spark, docs, id_column, text_column).where("kept").select(
        F.col(id_column).alias("stay_id"), F.unhex("text_sha256").alias("stay_sha"))
    stay = stay.select(F.struct("stay_id", "stay_sha").alias("stay"))
    sha = F.unhex(F.sha2(F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary"), 256))
    one = docs.withColumn(digest, F.struct(F.col(id_column).alias("stay_id"), sha.alias("stay_sha"))).dropDuplicates([digest])
    return one.join(stay, one[digest].eqNullSafe(stay["stay"]), "left_semi").drop(digest)
