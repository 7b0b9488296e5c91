"""Spelling variants: words one edit apart, found by walking a trie of all words level by level with joins.

The trie is a table of edges, built and used one level at a time. Paths without a branch are one edge, so the
number of levels is that of the branching points on a path (some 10 to 20 for natural words), not the longest
word. A node is named by its smallest word; its depth is the number of code points above it.

* A state is (word, position, node, edits). Every word starts without an edit, below the first code points that
  no edit may touch (see below).
* The edges of a level are an aggregate of the states without an edit: those at a node are grouped by their
  next code point; the smallest and largest word of a group give the common prefix, thus the child's depth.
* The states are joined with the edges of their node. Without an edit, the edge of the own next code point leads on
  without one, and every other edge is taken with the edit at this very point: replaced, inserted (the edge
  has one more code point) or deleted (the word has). With an edit, only the edge that the word spells out is taken.
* A state with one edit that ends at the end of a word is a neighbour. So is a word without its last code point.

An edit is always made at the first difference of the two words, so every pair is found once from each side. Near
the root almost every edge exists and edited states would live on; so the words and the reversed words make a trie
each, and only the half of a word away from the root is edited: pairs that agree in the first half are found in
the one, the others, which agree in the last half, in the other. There a node has few edges and states die at once.
Levels are shuffled by node; the states of a node that very many words share are the larger side of the join, which
AQE may split, and the aggregate combines before its shuffle. Every level is written to the shared folder.

Words are counted with a partial aggregate in each task, so a frequent word sends one row per task.

Edge cases: a null text has no words; a null id counts as an empty text in the checksum; one-word texts of any
length are one long edge; repeated rows count again; a table without words gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.graph import keep

LETTERS = r"A-Za-zÀ-ÿ"  # the class of the contract
LEAST_LETTERS, LEAST_COUNT, FACTOR, DAMAGE = 7, 2, 10, 31
STEPS = [1 << k for k in range(30, -1, -1)]


def count_words(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", damage: int | None = None) -> DataFrame:
    """word and n: runs of letters with A to Z lower-cased, of `LEAST_LETTERS` code points and `LEAST_COUNT`
    occurrences at least. With `damage`, a run whose CRC-32 of `<id>:<run>` it divides loses one code point."""
    runs = F.expr(rf"regexp_extract_all({'`' + text_column + '`'}, r'[{LETTERS}]{{{LEAST_LETTERS},}}', 0)")
    lower = F.translate(F.col("run"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = docs.select(F.col(id_column).alias("id"), F.explode(runs).alias("run")).select("id", lower.alias("word"))
    if damage:
        h = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
        at = (F.col("h") % F.length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.expr("substring(word, cast(h % length(word) as int) + 2)"))
        words = words.withColumn("h", h).select(F.when(F.col("h") % damage == 0, cut).otherwise(F.col("word")).alias("word"))
        words = words.where(F.length("word") >= LEAST_LETTERS)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _common(a: str, b: str) -> Column:
    """Length of the common prefix of two strings, by bisection."""
    return F.aggregate(F.array(*[F.lit(s) for s in STEPS]), F.lit(0), lambda have, step: F.when(
        (step <= F.least(F.length(a), F.length(b)) - have)
        & F.substring(a, have + 1, step).eqNullSafe(F.substring(b, have + 1, step)), have + step).otherwise(have))


def _edges(states: DataFrame) -> DataFrame:
    """back, at (node), letter, label, child, depth (of the child), end_n (n of the word that ends there, else null)
    and alone (only one word is below)."""
    own = states.where("edits = 0 and node is not null and length(word) > pos")
    first = F.min(F.struct("word", "n"))
    grouped = own.groupBy("back", "node", F.substring("word", F.col("pos") + 1, F.lit(1)).alias("letter")).agg(
        first.alias("low"), F.max("word").alias("high"), F.min("pos").alias("above"))
    low = grouped.select("back", "node", "letter", "above", F.col("low.word").alias("child"), F.col("low.n").alias("n"), "high")
    low = low.withColumn("depth", F.when(F.col("child") == F.col("high"), F.length("child")).otherwise(_common("child", "high")))
    label = F.substring("child", F.col("above") + 1, F.col("depth") - F.col("above"))
    return low.select("back", F.col("node").alias("at"), "letter", label.alias("label"), "child", "depth",
                      F.when(F.length("child") == F.col("depth"), F.col("n")).alias("end_n"),
                      (F.col("child") == F.col("high")).alias("alone"))


def _spelt(at: Column, label: Column) -> Column:
    """Whether the word goes on like `label` after its first `at` code points."""
    return F.substring("word", at + 1, F.length(label)) == label


def _arrive(rows: DataFrame, edits: int, pos: Column) -> DataFrame:
    """States at the edge's end, with the neighbour that they have reached there."""
    rows = rows.withColumn("to", pos)
    # without an edit so far, the word without its last code point ends here
    done = F.col("end_n").isNotNull() & (F.length("word") == F.col("to") + (1 - edits))
    return rows.select("back", "word", "n", F.col("to").alias("pos"), F.when(~F.col("alone"), F.col("child")).alias("node"),
                       F.lit(edits).alias("edits"), F.when(done, F.col("child")).alias("near"),
                       F.when(done, F.col("end_n")).alias("near_n")) \
        .where("near is not null or node is not null")


def _fixed(word: str) -> Column:
    """How many code points from the root are not edited: half of them, the middle one only in the word's own trie."""
    return F.when(F.col("back"), F.ceil(F.length(word) / 2)).otherwise(F.floor(F.length(word) / 2)).cast("int")


def _step(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states after one edge each."""
    pos, letter, label = F.col("pos"), F.substring("word", F.col("pos") + 1, F.lit(1)), F.col("label")
    rest, more = F.expr("substring(label, 2)"), F.length("word") > F.col("pos")
    live = states.where("node is not null").select("back", "word", "n", "pos", "node", "edits", letter.alias("next"))
    edges = edges.withColumnRenamed("back", "way")
    node = (F.col("back") == F.col("way")) & (F.col("node") == F.col("at"))
    own = live.where(more).join(edges, node & (F.col("next") == F.col("letter")))
    straight = _arrive(own.where("edits = 0"), 0, F.col("depth"))
    behind = _arrive(own.where("edits = 1").where(_spelt(pos, label)), 1, pos + F.length(label))
    aside = live.where("edits = 0").where(pos >= _fixed("word")).join(edges, node & (F.col("next") != F.col("letter")))
    moves = [(more & _spelt(pos + 1, rest), pos + F.length(label)),        # replaced
             (_spelt(pos, rest), pos + F.length(label) - 1),               # inserted
             (more & _spelt(pos + 1, label), pos + F.length(label) + 1)]   # deleted
    ends = F.array_compact(F.array(*[F.when(ok, end) for ok, end in moves]))
    edited = aside.withColumn("end", F.explode(ends))
    return straight.unionByName(behind).unionByName(_arrive(edited, 1, F.col("end")))


def neighbours(spark: SparkSession, words: DataFrame) -> DataFrame:
    """word, near and near_n (n of near) for all pairs of words exactly one edit apart, from both sides.

    `words` has distinct, non-empty words with their n."""
    words = words.where("word is not null and word <> ''").select("word", "n")
    shared = (words.agg(F.min(F.length("word"))).first()[0] or 0) // 2  # code points that no edit touches in any word
    both = words.select(F.lit(False).alias("back"), "word", "n").unionByName(
        words.select(F.lit(True).alias("back"), F.reverse("word").alias("word"), "n"))
    states = keep(spark, both.select("back", "word", "n", F.lit(shared).alias("pos"), F.substring("word", 1, shared).alias("node"),
                                     F.lit(0).alias("edits"), F.lit(None).cast("string").alias("near"),
                                     F.lit(None).cast("long").alias("near_n")), "trie-states")
    found = []
    while not states.where("edits = 0 and node is not null").isEmpty():
        edges = keep(spark, _edges(states), "trie-edges")
        states = keep(spark, _step(states, edges), "trie-states")
        found.append(states.where("near is not null").select("back", "word", "near", "near_n"))
    empty = spark.createDataFrame([], "back boolean, word string, near string, near_n long")
    every = reduce(DataFrame.unionByName, found, empty)
    turned = every.select("back", *[F.when(F.col("back"), F.reverse(c)).otherwise(F.col(c)).alias(c) for c in ("word", "near")], "near_n")
    half = F.floor(F.length("word") / 2).cast("int")
    again = F.substring("word", F.lit(1), half) == F.substring("near", F.lit(1), half)  # the other trie has this pair
    return turned.where(~F.col("back") | ~again).select("word", "near", "near_n")


def group_variants(spark: SparkSession, words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """word, form, root, n, n_near, form_n of counted words.

    `form` is the most frequent neighbour (ties: the first in code-point order) if it is `factor` times as
    frequent, `root` the end of the chain of forms. A chain has at most log(total) / log(factor) links, and every
    round below doubles what is known of it."""
    if factor < 2:
        raise ValueError("a form must be more frequent than its word")
    words = keep(spark, words, "words")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near"))
    near = neighbours(spark, words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("b"))
    out = words.join(near, "word", "left")
    form_n = -F.col("b.m")
    out = keep(spark, out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                 F.when(form_n >= factor * F.col("n"), F.col("b.near")).alias("form"),
                                 F.when(form_n >= factor * F.col("n"), form_n).alias("form_n")), "forms")
    roots = out.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        on = roots.select(F.col("word").alias("link"), F.col("root").alias("end"))
        step = keep(spark, roots.join(on, F.col("root") == F.col("link"), "left")
                    .select("word", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("moved")), "roots")
        roots = step.select("word", "root")
        if step.where("moved").isEmpty():
            break
    roots = roots.select("word", F.col("root").alias("last"))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("last", "word").alias("root"), "n", "n_near", "form_n")
