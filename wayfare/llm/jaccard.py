"""Exact similarity join of word 5-shingle sets by vertical partitioning.

The global order of all n-grams (their 64-bit hashes) is cut into fragments, one per shuffle partition.
Texts with the same set are one class from the start, and a class meets a fragment only through its own
segment there.

1. Each fragment counts how many classes hold each of its n-grams. Those in one class only cannot overlap
   with anything and are dropped. A class with fewer than 75 % of its n-grams left has no link and is
   dropped too; both are exact.
2. The rest is ordered by (number of classes, hash). Two classes can only link if they share an n-gram
   among the first n - ceil(0.75 n) + 1 of both. For each such n-gram its holders are compared with one
   of them, the pivot, not with each other.
3. Overlaps are counted separately in each of `FRAGMENTS` fragments of the hash order and summed per pair;
   pairs with 100 * overlap >= 75 * union are links.
4. Components of these links are found. Where an n-gram of step 2 still joins several components, steps 2
   and 3 are done once more with other pivots, if that saves pairs. Then all pairs of holders from different components are
   compared as in step 3, but for those that cannot link by their sizes, by the place of the n-gram in
   both orders or by the number of bits in which bitmaps of the sets differ, which are exact bounds. So no
   link between different components is lost, while copies of one text cost a few comparisons each.

Edge cases: ASCII letters are lower-cased; a text with one to four words is one n-gram, the whole
sequence; a null, empty or blank text has an empty set and links with nothing; repeated rows are copies;
other columns are not read. Sets are compared by 64-bit hashes of their n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.graph import components, keep
from wayfare.llm.words import U64, Words, mix, ragged, slices, windows

N_GRAM = 5
PERCENT = 75
FRAGMENTS = 4
BITS = 512
BROADCAST_NAMES = 200_000  # 8 bytes each
#: When pivots give way to all remaining pairs: few of these per row, or after so many rounds. Either way every
#: link is found; the numbers only share the work between the two.
PIVOTS, PAIRS_PER_ROW, ROUNDS = 4, 8, 2
FLUSH = 1 << 20
COUNT_TOP = np.iinfo(np.uint16).max


class Sets:
    """n-gram sets of the texts of a slice: `owner` and `gram`, sorted and distinct, `n` and `name` per text."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, k: int = N_GRAM):
        words = Words(buf, offsets)
        owners, h = words.owners(), words.hashes(lower=True)
        at, gram = windows(h, owners, k)
        owner = owners[at]
        for size in range(1, k):
            short = np.flatnonzero(words.counts == size)
            if len(short):
                whole = np.full(len(short), size, U64)
                for i in range(size):
                    whole = mix(whole * U64(0x9E3779B97F4A7C15) + h[words.bounds[short] + i])
                owner, gram = np.append(owner, short), np.append(gram, whole)
        order = np.argsort(gram)
        order = order[np.argsort(owner[order].astype(np.uint32), kind="stable")]
        owner, gram = owner[order], gram[order]
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
        self.owner, self.gram = owner[new], gram[new]
        self.bounds = np.searchsorted(self.owner, np.arange(len(offsets)))
        self.n = np.diff(self.bounds)
        total = np.zeros(len(self.gram) + 1, U64)
        np.cumsum(mix(self.gram + U64(0x51ED270B)), dtype=U64, out=total[1:])
        sums = total[self.bounds[1:]] - total[self.bounds[:-1]]
        self.name = mix(sums + self.n.astype(U64) * U64(0xD1342543DE82EF95)).view(np.int64)


def _planes(h: np.ndarray) -> bytes:
    """Bytes of the numbers, most significant ones together, so that the shuffle can compress them."""
    return np.ascontiguousarray(h.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplanes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(U64).ravel()


def classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_shingles and name of the set of every row; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, buf, offsets in slices(batch.column(1)):
                sets = Sets(buf, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(offsets) - 1), pa.array(sets.n.astype(np.int64)), pa.array(sets.name)],
                    names=[id_column, "n_shingles", "name"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column), F.col(text_column).cast("string")).mapInArrow(
        run, f"`{id_column}` {kind}, n_shingles long, name long")


SEGMENTS = "part int, names binary, sizes binary, counts binary, grams binary"


def _dealt(part: np.ndarray, name: np.ndarray, size: np.ndarray, owner: np.ndarray, gram: np.ndarray,
           df: np.ndarray | None = None) -> Iterator[list]:
    """One row per part; entries are sorted by part and, within it, by owner (an index of name and size)."""
    edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, int)
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(part)]):
        own = owner[a:b]
        head = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        ids = own[head]
        row = [int(part[a]), name[ids].tobytes(), size[ids].astype(np.int32).tobytes(),
               np.diff(np.append(head, b - a)).astype(np.uint32).tobytes(), _planes(gram[a:b])]
        yield row if df is None else [*row, df[a:b].tobytes()]


def _batch(rows: list[list], schema: str) -> pa.RecordBatch:
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.int32()] + [pa.binary()] * (len(names) - 1)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _segments(docs: DataFrame, text_column: str, parts: int) -> DataFrame:
    """Segments of each class of a run of texts, packed into one row per fragment."""

    def flush(held: list[Sets]) -> pa.RecordBatch:
        name = np.concatenate([s.name for s in held])
        n = np.concatenate([s.n for s in held])
        base = np.cumsum([0, *(len(s.n) for s in held)])
        owner = np.concatenate([s.owner + b for s, b in zip(held, base)])
        gram = np.concatenate([s.gram for s in held])
        one = np.zeros(len(name), bool)
        one[np.unique(name, return_index=True)[1]] = True
        wanted = one[owner]
        owner, gram = owner[wanted], gram[wanted]
        part = ((gram >> U64(32)) * U64(parts) >> U64(32)).astype(np.uint32)
        order = np.argsort(part.astype(np.uint16) if parts < 65536 else part, kind="stable")
        return _batch(list(_dealt(part[order], name, n, owner[order], gram[order])), SEGMENTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, buf, offsets in slices(batch.column(0)):
                sets = Sets(buf, offsets)
                if len(sets.gram):
                    held.append(sets)
                    size += len(sets.gram)
                if size >= FLUSH:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return docs.select(F.col(text_column).cast("string")).mapInArrow(run, SEGMENTS)


def _gathered(batches: Iterator[pa.RecordBatch], columns: dict[str, type]) -> dict[str, np.ndarray] | None:
    got = {c: [] for c in columns}
    for batch in batches:
        for c, kind in columns.items():
            for raw in batch.column(c).to_pylist():
                got[c].append(_unplanes(raw) if c == "grams" else np.frombuffer(raw, kind))
    if not got["names"]:
        return None
    return {c: np.concatenate(got.pop(c)) for c in columns}


def _shared(segments: DataFrame, parts: int) -> DataFrame:
    """Entries whose n-gram is in two classes or more, packed into one row per bucket of classes."""
    schema = SEGMENTS + ", dfs binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = _gathered(batches, {"names": np.int64, "sizes": np.int32, "counts": np.uint32, "grams": U64})
        if got is None:
            return
        name, size, counts, gram = got["names"], got["sizes"], got["counts"].astype(np.int64), got["grams"]
        bucket = (mix(name.view(U64)) >> U64(32)) * U64(parts) >> U64(32)
        # classes by bucket; of one class that came several times the first is taken
        first = np.unique(name, return_index=True)[1]
        first = first[np.argsort(bucket[first], kind="stable")]
        starts = np.cumsum(counts) - counts
        gram = gram[ragged(starts[first], counts[first])]
        owner = np.repeat(np.arange(len(first)), counts[first])
        name, size, bucket = name[first], size[first], bucket[first].astype(np.int64)
        order = np.argsort(gram)
        ordered = gram[order]
        head = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        run_length = np.diff(np.append(head, len(ordered)))
        df = np.empty(len(gram), np.uint16)
        df[order] = np.repeat(np.minimum(run_length, COUNT_TOP).astype(np.uint16), run_length)
        kept = np.flatnonzero(df > 1)
        owner, gram, df = owner[kept], gram[kept], df[kept]
        rows = list(_dealt(bucket[owner], name, size, owner, gram, df))
        if rows:
            yield _batch(rows, schema)

    return segments.repartitionById(parts, F.col("part")).mapInArrow(run, schema)


def _survivors(shared: DataFrame, parts: int) -> DataFrame:
    """name, n, number of shared n-grams, those to be looked up in global order, all shared ones, and a bitmap
    of them, of each class that shares 75 % of its n-grams or more."""
    schema = "name long, n int, shared int, heads binary, grams binary, bits array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = _gathered(batches, {"names": np.int64, "sizes": np.int32, "counts": np.uint32, "grams": U64, "dfs": np.uint16})
        if got is None:
            return
        counts = got["counts"].astype(np.int64)
        name, where, owner = np.unique(got["names"], return_index=True, return_inverse=True)
        n = got["sizes"][where].astype(np.int64)
        total = np.bincount(owner, weights=counts, minlength=len(name)).astype(np.int64)
        enough = 100 * total >= PERCENT * n
        entry = np.repeat(owner, counts)
        kept = np.flatnonzero(enough[entry])
        entry, gram, df = entry[kept], got["grams"][kept], got["dfs"][kept]
        order = np.lexsort((gram, df, entry))
        entry, gram = entry[order], gram[order]
        chosen = np.flatnonzero(enough)
        least = -(-PERCENT * n[chosen] // 100)
        edge = np.searchsorted(entry, chosen)
        for a in range(0, len(chosen), 2000):
            rows = slice(a, a + 2000)
            size = total[chosen[rows]]
            packed = [gram[i:i + t].tobytes() for i, t in zip(edge[rows].tolist(), size.tolist())]
            heads = [x[:8 * k] for x, k in zip(packed, (size - least[rows] + 1).tolist())]
            bits = _bitmaps(gram[ragged(edge[rows], size)], size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(name[chosen[rows]]), pa.array(n[chosen[rows]].astype(np.int32)), pa.array(size.astype(np.int32)),
                 pa.array(heads, pa.binary()), pa.array(packed, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * bits.shape[1]), pa.array(bits.ravel()))],
                names=["name", "n", "shared", "heads", "grams", "bits"])

    return shared.repartitionById(parts, F.col("part")).mapInArrow(run, schema)


def _bitmaps(gram: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(sets, BITS / 64) parity bitmaps: each n-gram flips one bit, so two bitmaps differ in no more bits than
    the sets differ in n-grams."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    bit = (mix(gram + U64(0xA5A5A5A5)) >> U64(64 - (BITS - 1).bit_length())).astype(np.int64)
    odd = np.bincount(owner * BITS + bit, minlength=len(sizes) * BITS).reshape(len(sizes), BITS) % 2
    return np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)


def _posts(survivors: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """gram, name, n, shared, left (shared n-grams from this one on) and root of a class, for each n-gram that
    it is looked up by. The root of a class without links is itself."""
    columns = survivors.select("name", "n", "shared", "heads")
    if roots is not None:
        columns = columns.join(roots.withColumnRenamed("node", "name"), "name", "left")
    root = F.col("name") if roots is None else F.coalesce("root", "name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = batch.column(4).to_pylist()
            size = np.array([len(h) // 8 for h in heads], np.int64)
            owner = np.repeat(np.arange(len(heads)), size)
            left = batch.column(2).to_numpy()[owner] - ragged(np.zeros(len(size), np.int64), size)
            of = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(b"".join(heads), np.int64)), *(batch.column(i).take(of) for i in (0, 1, 2)),
                 pa.array(left.astype(np.int32)), batch.column(3).take(of)],
                names=["gram", "name", "n", "shared", "left", "root"])

    return columns.select("name", "n", "shared", root.alias("root"), "heads").mapInArrow(
        run, "gram long, name long, n int, shared int, left int, root long")


def _fragments(survivors: DataFrame) -> DataFrame:
    """name and its n-grams in each fragment of the order, as an array of `FRAGMENTS` arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.frombuffer(g, U64) for g in batch.column(1).to_pylist()]
            gram = np.concatenate([*lists, np.zeros(0, U64)])
            owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            cell = owner * FRAGMENTS + ((gram >> U64(32)) * U64(FRAGMENTS) >> U64(32)).astype(np.int64)
            order = np.argsort(cell, kind="stable")
            edge = np.searchsorted(cell[order], np.arange(len(lists) * FRAGMENTS + 1))
            inner = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(gram[order].view(np.int64)))
            outer = pa.ListArray.from_arrays(pa.array(np.arange(len(lists) + 1, dtype=np.int32) * FRAGMENTS), inner)
            yield pa.RecordBatch.from_arrays([batch.column(0), outer], names=["name", "grams"])

    return survivors.select("name", "grams").mapInArrow(run, "name long, grams array<array<long>>")


def _fit(na: str, nb: str, sa: str, sb: str) -> str:
    """Whether sets of these sizes, with these many n-grams that they could have in common, can link."""
    return f"100 * least({na}, {nb}) >= {PERCENT} * greatest({na}, {nb}) and " \
           f"{100 + PERCENT} * least({sa}, {sb}) >= {PERCENT} * ({na} + {nb})"


def _close(na: str, nb: str, sa: str, sb: str, a: str, b: str) -> str:
    """Whether the n-grams that are not shared and the bitmaps a and b of those that are leave a link possible:
    (100 - P) / (100 + P) of all n-grams may differ."""
    differ = " + ".join(f"bit_count({a}[{i}] ^ {b}[{i}])" for i in range(BITS // 64))
    return f"{100 + PERCENT} * ({na} - {sa} + {nb} - {sb} + {differ}) <= {100 - PERCENT} * ({na} + {nb})"


def _links(spark: SparkSession, pairs: DataFrame, survivors: DataFrame) -> DataFrame:
    """The pairs (a, b, na, nb) that link: overlaps counted per fragment and summed. Written tables.

    Bitmaps go first, as they are small. Only classes of a pair are moved, if their names are few enough to be
    sent to every task.
    """
    pairs = keep(spark, pairs, "pairs")
    cells = survivors
    if 2 * pairs.count() <= BROADCAST_NAMES:
        names = pairs.select(F.col("a").alias("name")).unionAll(pairs.select("b")).distinct()
        cells = cells.join(F.broadcast(names), "name", "left_semi")
    for side in "ab":
        pairs = pairs.join(cells.select(F.col("name").alias(side), F.col("shared").alias(f"s{side}"), F.col("bits").alias(f"bits{side}")), side)
    pairs = pairs.where(_close("na", "nb", "sa", "sb", "bitsa", "bitsb")).select("a", "b", "na", "nb")
    cells = _fragments(cells)
    left = cells.select(F.col("name").alias("a"), F.col("grams").alias("x"))
    right = cells.select(F.col("name").alias("b"), F.col("grams").alias("y"))
    partial = [F.size(F.array_intersect(F.col("x")[f], F.col("y")[f])) for f in range(FRAGMENTS)]
    counted = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", sum(partial[1:], partial[0]).alias("overlap"))
    return keep(spark, counted.where(f"100 * overlap >= {PERCENT} * (na + nb - overlap)").select("a", "b"), "links")


def _stars(posts: DataFrame, turn: int) -> DataFrame:
    """Pairs of each class with the pivots of its n-grams, as far as sizes allow a link: one pivot at first,
    which all n-grams choose alike, then `PIVOTS` of each n-gram's own."""
    ranks = [F.struct("name")] if turn == 0 else \
        [F.struct(F.xxhash64("name", "gram", F.lit(PIVOTS * turn + i)), "name") for i in range(PIVOTS)]
    chosen = F.array(*[F.min_by(F.struct("name", "n", "shared", "root"), r) for r in ranks])
    pivots = posts.groupBy("gram").agg(chosen.alias("p"), F.count("*").alias("c")).where("c > 1").select("gram", F.explode(F.array_distinct("p")).alias("p")) \
        .select("gram", F.col("p.name").alias("b"), F.col("p.n").alias("nb"), F.col("p.shared").alias("sb"), F.col("p.root").alias("rb"))
    return posts.join(pivots, "gram").where("root <> rb").where(_fit("n", "nb", "shared", "sb")) \
        .select(F.col("name").alias("a"), "b", F.col("n").alias("na"), "nb").distinct()


def linked_classes(spark: SparkSession, docs: DataFrame, text_column: str = "text") -> DataFrame:
    """node and root for every class of texts that links with another class."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    survivors = keep(spark, _survivors(_shared(_segments(docs, text_column, parts), parts), parts), "sets")
    open_, roots, links, turn = _posts(survivors), None, None, 0
    none = spark.createDataFrame([], "node long, root long")
    while True:
        new = _links(spark, _stars(open_, turn), survivors)
        found = new.count()
        if found:
            links = new if links is None else links.unionByName(new)
            roots = components(spark, links)
        if turn == 0 or found:
            labelled = _posts(survivors, roots)
        split = labelled.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
        open_ = labelled = keep(spark, labelled.join(split.select("gram"), "gram"), "open")
        rows, pairs = open_.groupBy("gram", "root").agg(F.count("*").alias("k")).groupBy("gram") \
            .agg(F.sum("k").alias("n"), F.sum(F.col("k") * F.col("k")).alias("squares")) \
            .agg(F.sum("n"), F.sum(F.expr("(n * n - squares) / 2"))).head()
        turn += 1
        if not rows:
            return none if roots is None else roots
        if pairs <= PAIRS_PER_ROW * rows or turn == ROUNDS:
            break
    more = _links(spark, _rest(open_, survivors), survivors)
    if more.isEmpty():
        return none if roots is None else roots
    return components(spark, more if links is None else links.unionByName(more))


def _rest(open_: DataFrame, survivors: DataFrame) -> DataFrame:
    """All pairs of holders of one n-gram from different components that sizes, positions and bitmaps leave."""
    open_ = open_.join(survivors.select("name", "bits"), "name")
    one, two = (open_.select("gram", *(F.col(c).alias(c + x) for c in ("name", "n", "shared", "left", "root", "bits"))) for x in "12")
    return one.join(two, "gram").where("root1 > root2").where(_fit("n1", "n2", "left1", "left2")) \
        .where(_close("n1", "n2", "shared1", "shared2", "bits1", "bits2")) \
        .select(F.col("name1").alias("a"), F.col("name2").alias("b"), F.col("n1").alias("na"), F.col("n2").alias("nb")).distinct()


def near_copies(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_shingles and component_id (smallest id reachable by links) of every row."""
    roots = linked_classes(spark, docs, text_column)
    named = keep(spark, classes(docs, id_column, text_column), "classes")
    groups = named.where("n_shingles > 0").groupBy("name").agg(F.min(id_column).alias("low"))
    groups = groups.join(roots.withColumnRenamed("node", "name"), "name", "left") \
        .withColumn("root", F.coalesce("root", "name"))
    lowest = groups.groupBy("root").agg(F.min("low").alias("component_id"))
    groups = groups.join(lowest, "root").select("name", "component_id")
    return named.join(groups, "name", "left").select(
        F.col(id_column), "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col(id_column)).alias("component_id"))


def one_of_each(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs` whose id is the smallest of their group; of repeated rows one.

    Rows without an id stay if no row of their group has one.
    """
    found = near_copies(spark, docs, id_column, text_column)
    chosen = found.where(F.col(id_column).eqNullSafe(F.col("component_id"))).select(F.col(id_column).alias("_id")).distinct()
    return docs.join(chosen, docs[id_column].eqNullSafe(chosen["_id"]), "left_semi") \
        .dropDuplicates([id_column, text_column])
