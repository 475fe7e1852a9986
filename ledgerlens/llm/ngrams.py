"""N-gram Jaccard join as a blocked sparse matrix product.

Documents are rows and word n-grams columns of a 0/1 matrix A; A times its transpose holds the overlaps. Equal rows are
one node. Of each row only its ``SKETCH`` columns of smallest hash take part in the product at first. Two rows with Jaccard similarity J share each of the
first ``SKETCH`` columns of their union with probability J, so with J at least 3/4 fewer than ``COMMON`` shared ones have a probability below 1e-15
per pair, the same order as a collision of the 64-bit hashes; rows of up to ``SKETCH`` columns take part whole and their bound is exact.

1. Columns of one row only are dropped. 2. Columns of up to ``LIGHT`` rows are multiplied out as a join; overlap counts are
accumulated per pair, and pairs of too different size or with too small an overlap are discarded. 3. A pair that is not seen there has all its
shared columns among the crowded ones, so only rows with ``COMMON`` crowded columns go on. Of their whole sets the rarest quarter of the columns and one more is
kept, by one order for all rows: two similar rows share one of those. So a passage that many otherwise different documents have connects nothing.
Columns that few rows keep are multiplied out again, bounded by their places in the order. Those that many keep connect families, groups of near copies: every
row is first compared with one leader of the column. Then only rows outside the family's main component are multiplied, chunk by chunk, with the
rows of the family, over all columns, and only edges that connect something leave a task. 4. Pairs are decided on the whole rows.

Words are runs of anything but ASCII white space, with A-Z lower-cased. Defined cases: a null, empty or blank text has no shingles and is linked
with nothing; a text with fewer than k words is one shingle; a null doc_id takes part but never names a component unless all
ids of it are null; rows with equal ids are separate documents; an empty table gives an empty table; extra columns change nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm import text as T
from ledgerlens.llm.components import components
from ledgerlens.llm.frames import fields, kept, numbered, packed, small_batches, unpacked, with_text

K = 5
SIMILAR = (3, 4)  # intersection / union of at least 3/4
SKETCH = 48
COMMON = 10
LIGHT = 32
CHUNK = 1024


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    out = []
    for a, b in T.chunks(column):
        data, bounds = T.raw(column.slice(a, b - a))
        data = T.LOWER[data]
        starts, ends, at = T.word_spans(data, bounds)
        words = T.word_hashes(data, starts, ends)
        grams = T.windows_hash(words, k)
        for i in range(b - a):
            n = at[i + 1] - at[i]
            if n >= k:
                out.append(np.unique(grams[at[i]:at[i + 1] - k + 1]))
            elif n:
                out.append(T.spans_hash(words, at[i:i + 1], at[i + 1:i + 2]))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def sketches(docs: DataFrame, k: int = K) -> DataFrame:
    """_row, doc_id, size of the set, a 128-bit signature of it and its columns of smallest hash."""
    def run(batches):
        for batch in batches:
            sets = shingle_sets(batch.column("text"), k)
            signs = [np.array([len(s) + T.mix(s).sum(dtype=np.uint64), T.mix(~s).sum(dtype=np.uint64)], np.uint64).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(signs, pa.binary()),
                 pa.array([s[:SKETCH].view(np.int64) for s in sets], pa.list_(pa.int64()))],
                names=["_row", "doc_id", "n", "sign", "columns"])

    return small_batches(docs.select("_row", "doc_id", "text")).mapInArrow(
        run, fields(docs, ["_row", "doc_id"], "n bigint, sign binary, columns array<bigint>"))


def _least_common(smaller: Column, larger: Column) -> Column:
    """Columns that the sketches of two similar rows of these sizes share at least.

    Up to SKETCH columns a row is whole, and the union has at most a third more: what is not shared is at most a quarter of it.
    """
    return F.when(larger <= SKETCH, F.least(larger - F.floor(larger / 4), F.lit(SKETCH - SKETCH // 3))).otherwise(F.lit(COMMON))


def _alike(a: str, b: str) -> Column:
    """Sizes that allow the similarity at all."""
    return (SIMILAR[1] * F.least(a, b) >= SIMILAR[0] * F.greatest(a, b))


def prefixes(crowd: DataFrame, texts: DataFrame, k: int = K) -> DataFrame:
    """Of the rows ``node`` of ``crowd`` the columns that decide: node, n, weight, col, its place ``pos`` in the row and how many rows keep it (``held``).

    Similar rows share three quarters of the larger one at least. In an order of all columns, here from the rarest among these rows to the commonest, the first
    shared column is therefore within the first quarter of either row or is the next one. Columns of one row take up places, but are left out then.
    """
    def run(batches):
        for batch in batches:
            sets = [s.view(np.int64) for s in shingle_sets(unpacked(batch.column("packed")), k)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "columns"])

    rows = texts.withColumnRenamed("_row", "node").join(crowd.select("node").hint("merge"), "node", "left_semi").select("node", "packed")
    entries = kept(small_batches(rows).mapInArrow(run, "node bigint, columns array<bigint>"), "ngram-sets").select("node", F.explode("columns").alias("col"))
    common = entries.groupBy("col").agg(F.count("*").alias("df"))
    ordered = entries.join(common.hint("merge"), "col").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("df", "col"))).alias("all"), F.sum("df").alias("weight")).withColumn("n", F.size("all").cast("bigint"))
    first = kept(ordered.select("node", "n", "weight", F.posexplode(F.slice("all", F.lit(1), (F.floor(F.col("n") / 4) + 1).cast("int"))).alias("pos", "_c")).where(
        "_c.df > 1").select("node", "n", "weight", "pos", F.col("_c.col").alias("col")), "ngram-first")
    held = first.groupBy("col").agg(F.count("*").alias("held")).where("held > 1")
    return kept(first.join(held.hint("merge"), "col"), "ngram-prefixes")


def _met_early(prefix: DataFrame) -> DataFrame:
    """Pairs (a, b) that share a column of ``prefix`` early enough: from their first shared one on, the shorter rest holds all that they share."""
    x, y = (prefix.select("col", F.col("node").alias(name), F.col("n").alias(f"n{name}"), (F.col("n") - F.col("pos")).alias(f"rest_{name}")) for name in ("a", "b"))
    return x.join(y.hint("merge"), "col").where(
        (F.col("a") > F.col("b")) & (sum(SIMILAR) * F.least("rest_a", "rest_b") >= SIMILAR[0] * (F.col("na") + F.col("nb")))).select("a", "b").distinct()


def overlaps(pairs: DataFrame, texts: DataFrame, k: int = K) -> DataFrame:
    """The pairs (a, b) of rows that are similar as whole sets, with their overlap. ``texts`` has _row and packed texts."""
    def count(batches):
        for batch in batches:
            both = []
            for x, y in zip(*(shingle_sets(unpacked(batch.column(c)), k) for c in ("x", "y"))):
                one = np.intersect1d(x, y, assume_unique=True).size
                both.append(one if SIMILAR[1] * one >= SIMILAR[0] * (len(x) + len(y) - one) else None)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(both, pa.int64())],
                                             names=["a", "b", "overlap"])

    left = texts.select(F.col("_row").alias("a"), F.col("packed").alias("x"))
    right = texts.select(F.col("_row").alias("b"), F.col("packed").alias("y"))
    rows = pairs.select("a", "b").hint("merge").join(left, "a").hint("merge").join(right, "b").select("a", "b", "x", "y")
    return small_batches(rows).mapInArrow(count, "a bigint, b bigint, overlap bigint").where("overlap is not null")


class _Forest:
    """Which labels are already connected."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[x] = y
        return x != y


def block_product(few: list[np.ndarray], many: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Overlap counts of two lists of sets, accumulated over blocks of columns that occur on both sides."""
    out = np.zeros((len(few), len(many)), np.float32)
    sides = []
    for sets in (few, many):
        sides.append((np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])))
    names = np.intersect1d(*(columns for columns, _ in sides))
    placed = []
    for columns, rows in sides:
        at = np.searchsorted(names, columns)
        good = at < len(names)
        good[good] = names[at[good]] == columns[good]
        order = np.argsort(at[good], kind="stable")
        placed.append((at[good][order], rows[good][order]))
    for first in range(0, len(names), width):
        blocks = []
        for (at, rows), sets in zip(placed, (few, many)):
            lo, hi = np.searchsorted(at, (first, first + width))
            block = np.zeros((len(sets), min(width, len(names) - first)), np.float32)
            block[rows[lo:hi], at[lo:hi] - first] = 1
            blocks.append(block)
        out += blocks[0] @ blocks[1].T
    return out


def _crowded_edges(rows: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """Similar pairs across components within families: each row outside a family's main component against all rows of the family.

    ``rows`` has node, root and family. Both sides are dealt into chunks, one task multiplies two chunks, and only edges
    that connect components not yet connected by earlier ones leave it.
    """
    shares = rows.groupBy("family", "root").agg(F.count("*").alias("c"))
    blocks = shares.groupBy("family").agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.sum("c").alias("all"),
                                          F.max("c").alias("most"), F.count("*").alias("roots")).where("roots > 1")
    placed = rows.join(blocks, "family").join(texts.withColumnRenamed("_row", "node"), "node").withColumns({
        "parts": F.ceil(F.col("all") / CHUNK).cast("int"), "few_parts": F.ceil((F.col("all") - F.col("most")) / CHUNK).cast("int")})

    def dealt(df: DataFrame, own: str, own_parts: str, other: str, other_parts: str, minor: bool) -> DataFrame:
        return df.select("family", "node", "root", "packed", F.lit(minor).alias("minor"),
                         F.pmod(F.xxhash64("node"), F.col(own_parts)).cast("int").alias(own),
                         F.explode(F.sequence(F.lit(0), F.col(other_parts) - 1)).alias(other))

    every = dealt(placed, "part", "parts", "few_part", "few_parts", False)
    minor = dealt(placed.where("root <> main"), "few_part", "few_parts", "part", "parts", True)

    def run(batches):
        key, few, many = None, [], []

        def flush():
            a, b = [], []
            if few and many:
                sets = [shingle_sets(unpacked(pa.array([r[2] for r in side], pa.binary())), k) for side in (few, many)]
                sizes = [np.array([len(s) for s in side], np.float32) for side in sets]
                both = block_product(*sets)
                similar = SIMILAR[1] * both >= SIMILAR[0] * (sizes[0][:, None] + sizes[1] - both)
                forest = _Forest()
                for i, j in zip(*(index.tolist() for index in np.nonzero(similar))):
                    if forest.join(few[i][1], many[j][1]):
                        a.append(max(few[i][0], many[j][0]))
                        b.append(min(few[i][0], many[j][0]))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            data = [batch.column(c).to_pylist() for c in ("family", "part", "few_part", "node", "root", "packed", "minor")]
            for family, part, few_part, node, root, text, is_minor in zip(*data):
                if (family, part, few_part) != key:
                    if key is not None:
                        yield flush()
                    key, few, many = (family, part, few_part), [], []
                (few if is_minor else many).append((node, root, text))
        if key is not None:
            yield flush()

    columns = ["family", "part", "few_part", "node", "root", "packed", "minor"]
    grouped = every.select(*columns).unionByName(minor.select(*columns)).repartition("family", "part", "few_part")
    return small_batches(grouped.sortWithinPartitions("family", "part", "few_part")).mapInArrow(run, "a bigint, b bigint").distinct()


def similar_groups(docs: DataFrame, k: int = K) -> DataFrame:
    """_row, doc_id, n_shingles, ``component_id`` (smallest doc_id of the component) and ``head``, the row that stands for it."""
    return _similar_rows(numbered(docs, "doc_id", "text"), k)


def _similar_rows(texts: DataFrame, k: int) -> DataFrame:
    """``similar_groups`` of a stored table of numbered rows."""
    sketched = kept(sketches(texts, k), "sketches")
    full = sketched.where("n > 0")
    nodes = kept(full.groupBy("sign", "n").agg(
        F.min("_row").alias("node"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("_row"))).alias("low")), "ngram-nodes")

    # Columns of the nodes' rows, and how many nodes have each.
    # Both sides of the joins below grow with the corpus, so they are merged at every size.
    entries = full.join(nodes.select(F.col("node").alias("_row")).hint("merge"), "_row", "left_semi").select(
        F.col("_row").alias("node"), "n", F.explode("columns").alias("col"))
    shared = kept(entries.groupBy("col").agg(F.count("*").alias("df")).where("df > 1"), "ngram-columns")
    entries = kept(entries.join(shared.hint("merge"), "col"), "ngram-entries")

    light = entries.where(F.col("df") <= LIGHT)
    x, y = (light.select("col", F.col("node").alias(name), F.col("n").alias(f"n{name}")) for name in ("a", "b"))
    met = x.join(y.hint("merge"), "col").where((F.col("a") > F.col("b")) & _alike("na", "nb")).groupBy("a", "b", "na", "nb").agg(
        F.count("*").alias("both"))
    crowded = entries.where(F.col("df") > LIGHT)
    load = crowded.groupBy("node", "n").agg(F.count("*").alias("h"))
    met = met.join(load.select(F.col("node").alias("a"), F.col("h").alias("ha")), "a", "left").join(
        load.select(F.col("node").alias("b"), F.col("h").alias("hb")), "b", "left")
    unseen = F.least(F.coalesce("ha", F.lit(0)), F.coalesce("hb", F.lit(0)))
    light_pairs = kept(met.where(F.col("both") + unseen >= _least_common(F.least("na", "nb"), F.greatest("na", "nb"))).select("a", "b"), "ngram-pairs")

    # Rows that can be linked through crowded columns alone. Only texts of these or of a candidate pair go on, compressed.
    crowd = kept(load.where(F.col("h") >= F.least(F.col("n") - F.floor(F.col("n") / 4), F.lit(COMMON))).select("node"), "ngram-crowd")
    wanted = light_pairs.select(F.explode(F.array("a", "b")).alias("_row")).unionByName(crowd.select(F.col("node").alias("_row"))).distinct()
    chosen = kept(packed(texts, "_row").join(wanted.hint("merge"), "_row", "left_semi"), "ngram-texts")
    prefix = prefixes(crowd, chosen, k)
    # A family is connected by crowded columns of the prefixes. The leader is the row whose columns are the most crowded: the one the others were made from, if there is one.
    blocks = prefix.where(F.col("held") > LIGHT)
    leaders = blocks.groupBy("col").agg(F.max(F.struct("weight", "node", "n")).alias("lead"))
    led = kept(blocks.join(leaders.hint("merge"), "col").where("node <> lead.node").select(
        F.greatest("node", "lead.node").alias("a"), F.least("node", "lead.node").alias("b"),
        _alike("n", "lead.n").alias("alike")).distinct(), "ngram-led")
    pairs = light_pairs.unionByName(_met_early(prefix.where(F.col("held") <= LIGHT))).unionByName(led.where("alike").select("a", "b")).distinct()
    edges = kept(overlaps(pairs, chosen, k).select("a", "b"), "ngram-edges")
    roots = kept(components(edges), "ngram-roots")
    families = components(led).withColumnRenamed("root", "family")
    members = families.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    late = kept(_crowded_edges(members, chosen, k), "ngram-late")
    if not late.isEmpty():
        roots = kept(components(edges.unionByName(late)), "ngram-roots")

    labelled = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lows = labelled.groupBy("root").agg(F.min("low").alias("least"))
    named = labelled.join(lows.hint("merge"), "root").select("sign", "n", F.col("least.doc_id").alias("component_id"), F.col("least._row").alias("head"))
    linked = full.join(named.hint("merge"), ["sign", "n"]).select("_row", "doc_id", F.col("n").alias("n_shingles"), "component_id", "head")
    alone = sketched.where("n = 0").select(
        "_row", "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("_row").alias("head"))
    return linked.unionByName(alone)


def one_of_each(docs: DataFrame, k: int = K) -> DataFrame:
    """The documents with their own columns, of each group of similar ones the one with the smallest doc_id."""
    others = F.struct(*[F.col(f"`{name}`") for name in docs.columns if name != "text"])
    rows = numbered(docs.select(others.alias("_doc"), "doc_id", "text"), "_doc", "doc_id", "text")
    heads = _similar_rows(rows, k).where("_row = head").select("_row")
    left = with_text(packed(rows, "_row", "_doc").join(heads, "_row", "left_semi"), "_doc")
    return left.select(*[F.col("text") if name == "text" else F.col(f"_doc.`{name}`") for name in docs.columns])
