"""Near-duplicate documents from bottom-k sketches of one hash function.

1. A document is the set of its distinct word shingles (64-bit hashes).  Its
   sketch is the ``k`` smallest of them.  Documents with equal sets are one
   class from here on, known by its smallest doc_id.
2. Inverted lists: a retained value -> the classes that retain it.  Two sets
   that are similar enough share at least t of their retained values, so they
   share one of the len - t + 1 rarest; only those are listed.  (For sets of at
   most threshold * k shingles t is exact; above, t lies six standard
   deviations under the expected overlap.)
3. Each list proposes its first member with every other one and neighbours by
   size; the union sketch's estimate filters these pairs (five deviations under
   the threshold), and the Jaccard similarity of the full sets decides.
4. Lists whose members aren't in one component by then are compared in blocks
   of ``BLOCK`` classes: every pair of two components, on the full sets, with a
   few links to show for each block.  So no list is cut short and no link
   between different components is lost, yet no pair rows are made.
5. Components by alternating large and small stars, a written table a round.

Defined results: texts without words are empty sets and linked with nothing;
a null doc_id is linked with nothing, its component is null and it is kept;
rows that repeat a doc_id share its component; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import U64, Scratch, WordHashes, few, lower_words, mix, release, row_count_at_most, shingle_set, short_batches, signed, table
from .idfilter import hits, id_filter

K = 64
#: Shingles in one block, where each class counts BLOCK_ROW more than it has.
BLOCK = 600_000
BLOCK_ROW = 2000
WIDTH = 5
THRESHOLD = 80  # per cent
#: Ids that may be broadcast.
BROADCAST_IDS = 500_000


def sketches(docs: DataFrame, width: int, k: int = K) -> DataFrame:
    """doc_id, n_shingles, the set's key (two longs) and its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows = batch.num_rows
            n, a, b, kept = np.zeros(rows, np.int64), np.zeros(rows, U64), np.zeros(rows, U64), []
            for i, text in enumerate(batch.column(1).to_pylist()):
                found = shingle_set(hashes.of(lower_words(text)), width)
                n[i] = len(found)
                a[i], b[i] = mix(found).sum(dtype=U64), mix(found * U64(0x9E3779B97F4A7C15) + U64(1)).sum(dtype=U64)
                kept.append(found[:k])
            ends = np.cumsum([0, *map(len, kept)]).astype(np.int32)
            values = signed(np.concatenate(kept)) if kept else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(signed(a)), pa.array(signed(b)), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], names=["doc_id", "n_shingles", "key_a", "key_b", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, key_a long, key_b long, sketch array<long>")


def full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """rep and its whole shingle set (unsigned longs, ascending) for the doc_ids in ``ids`` (column rep)."""

    bits = id_filter(ids, "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            batch = batch.filter(pa.array(hits(bits, batch.column(0))))
            if batch.num_rows:
                found = [shingle_set(hashes.of(lower_words(t)), width).tobytes() for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["rep", "shingles"])

    some = docs.select("doc_id", "text").mapInArrow(run, "rep long, shingles binary")
    return some.join(ids.select("rep").distinct(), "rep", "left_semi").dropDuplicates(["rep"])


def least_overlap(k: int, threshold: int) -> tuple[int, int]:
    """t for sketches of large sets, and up to which size a set's partners are all kept whole."""
    s = threshold / 100
    return max(1, int(k * s - 6 * (k * s * (1 - s)) ** 0.5)), k * threshold // 100


def inverted_lists(reps: DataFrame, k: int, threshold: int) -> DataFrame:
    """value, rep, n: the rarest retained values of each class that another class retains too."""
    t, small = least_overlap(k, threshold)
    values = reps.select("rep", F.col("n_shingles").alias("n"), F.size("sketch").alias("kept"), F.explode("sketch").alias("value"))
    often = values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = values.join(often, "value")
    overlap = F.when(F.col("n") <= small, F.floor((F.col("n") * threshold + 99) / 100)).otherwise(t)
    mine = Window.partitionBy("rep")
    ranked = shared.withColumn("place", F.row_number().over(mine.orderBy("df", "value"))).withColumn("shared", F.count("*").over(mine))
    # values that no other class has come first in the order; they are in the prefix, but list nobody
    return ranked.where(F.col("place") <= F.col("kept") - overlap + 1 - (F.col("kept") - F.col("shared"))).select("value", "rep", "n")


def proposals(lists: DataFrame) -> DataFrame:
    """a < b: of each list the first member with every other one, and each with the next."""
    order = Window.partitionBy("value").orderBy("n", "rep")
    pairs = lists.select("rep", F.first("rep").over(order).alias("first"), F.lag("rep").over(order).alias("before"))
    pairs = pairs.select("rep", F.explode(F.array_distinct(F.array("first", "before"))).alias("other")).where("other is not null and other != rep")
    return pairs.select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct()


def estimated(pairs: DataFrame, reps: DataFrame, k: int, threshold: int) -> DataFrame:
    """The pairs whose union sketch doesn't rule the threshold out."""
    s = threshold / 100
    least = s - 5 * (s * (1 - s) / k) ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y, n, m in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
                if 100 * min(n, m) < threshold * max(n, m):
                    keep.append(False)
                    continue
                x, y = np.array(x, dtype=np.int64).view(U64), np.array(y, dtype=np.int64).view(U64)
                both = np.concatenate((x, y))
                both.sort()
                first = np.append(True, both[1:] != both[:-1])
                if n <= k and m <= k:
                    union = int(first.sum())
                    keep.append(100 * (len(both) - union) >= threshold * union)
                    continue
                union = both[first][:k]
                twice = both[1:][~first[1:]]
                keep.append(np.searchsorted(twice, union[-1], side="right") >= least * len(union))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    of = lambda c: reps.select(F.col("rep").alias(c), F.col("sketch").alias(f"s_{c}"), F.col("n_shingles").alias(f"n_{c}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "s_a", "s_b", "n_a", "n_b")
    return both.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                both = np.concatenate((x, y))
                both.sort()
                same = int((both[1:] == both[:-1]).sum())
                keep.append(100 * same >= threshold * (len(both) - same))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    of = lambda c: sets.select(F.col("rep").alias(c), F.col("shingles").alias(f"s_{c}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``links``: a, b.  rep, component: the smallest of its component, for all that have a link."""
    edges = scratch.stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), f"{name}0")
    before, turn = None, 0
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before and turn % 2 == 0:
            break
        before = state if turn % 2 == 0 else before
        if turn % 2 == 0:  # large star: neighbours above me go to the smallest around me
            both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:  # small star: I and my neighbours below me go to the smallest of them
            least = edges.groupBy("u").agg(F.min("v").alias("m"))
            out = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        turn += 1
        edges = scratch.stage(out.where("u != v").distinct(), f"{name}{turn}")
        scratch.drop(f"{name}{turn - 1}")
    return edges.select(F.col("u").alias("rep"), F.col("v").alias("component"))


def residual_blocks(lists: DataFrame, found: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """(grp, i, j, rep, component): the blocks to compare, as members of block pairs; and the reps in them.

    Lists of like size with the same member of smallest hash hold mostly the same members (a
    min-hash of lists), so they are compared as one: a large group of near copies has dozens.
    """
    members = lists.join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    about = members.groupBy("value").agg(F.count("*").alias("size"), F.min("component").alias("low"), F.max("component").alias("high"), F.min_by("rep", F.xxhash64("rep")).alias("who"))
    # of three members every pair has been proposed
    open_ = about.where("size > 3 and low < high").select("value", (F.col("who") * 64 + F.floor(F.log2("size"))).alias("grp"))
    members = members.join(open_, "value").select("grp", "rep", "n", "component").distinct()
    order = Window.partitionBy("grp").orderBy("component", "n", "rep")
    weight = F.sum(F.col("n") + BLOCK_ROW).over(order.rowsBetween(Window.unboundedPreceding, 0))
    members = members.withColumn("i", F.floor(weight / BLOCK))
    blocks = members.groupBy("grp", "i").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("n").alias("least"), F.max("n").alias("most"))
    other = blocks.select("grp", F.col("i").alias("j"), *(F.col(c).alias(f"{c}_j") for c in ("low", "high", "least", "most")))
    pairs = blocks.join(other, "grp").where("i <= j and not (low = high and low_j = high_j and low = low_j)")
    pairs = pairs.where((100 * F.col("most") >= threshold * F.col("least_j")) & (100 * F.col("most_j") >= threshold * F.col("least"))).select("grp", "i", "j")
    side = members.select("grp", F.col("i").alias("at"), "rep", "component")
    in_pairs = pairs.select("grp", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("at")).join(side, ["grp", "at"])
    return in_pairs.select("grp", "i", "j", "rep", "component"), members.select("rep").distinct()


def _links_of_block(sets: list[np.ndarray], component: list[int], threshold: int) -> list[tuple[int, int]]:
    """Links that join the components of a block: every two sets of different components are compared."""
    sizes = np.array([len(s) for s in sets])
    letters, at = np.unique(np.concatenate(sets), return_inverse=True)
    often = np.bincount(at) > 1
    column = np.cumsum(often) - 1
    row = np.repeat(np.arange(len(sets)), sizes)
    use = often[at]
    row, at = row[use], column[at[use]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    same = np.zeros((len(sets), len(sets)), dtype=np.float64)
    step = 8192
    for low in range(0, int(often.sum()), step):
        a, b = np.searchsorted(at, (low, low + step))
        some = np.zeros((len(sets), min(step, int(often.sum()) - low)), dtype=np.float32)
        some[row[a:b], at[a:b] - low] = 1
        same += some @ some.T
    linked = 100 * same >= threshold * (sizes[:, None] + sizes[None, :] - same)
    own = np.array(component)
    linked &= own[:, None] != own[None, :]
    root: dict[int, int] = {}

    def top(c: int) -> int:
        while root.get(c, c) != c:
            c = root[c]
        return c

    out = []
    for x, y in np.argwhere(np.triu(linked)):
        p, q = top(component[x]), top(component[y])
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((int(x), int(y)))
    return out


def block_links(blocks: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    def run(block: pa.Table) -> pa.Table:
        reps, own = block["rep"].to_pylist(), block["component"].to_pylist()
        found = _links_of_block([np.frombuffer(x.as_buffer(), U64) for x in block["shingles"]], own, threshold)
        return pa.table({"a": pa.array([reps[x] for x, _ in found], pa.int64()), "b": pa.array([reps[y] for _, y in found], pa.int64())})

    return blocks.join(sets, "rep").groupBy("grp", "i", "j").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD, k: int = K) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs``; links need ``threshold`` per cent."""
    spark = docs.sparkSession
    short_batches(spark)
    scratch = Scratch(spark, "near")
    all_ = scratch.stage(sketches(docs, width, k), "sketches")
    keyed = all_.where("doc_id is not null and n_shingles > 0")
    classes = scratch.stage(keyed.groupBy("key_a", "key_b", "n_shingles").agg(F.min("doc_id").alias("rep")), "classes")
    reps = keyed.join(classes.select(F.col("rep").alias("doc_id"), "key_a", "key_b"), ["doc_id", "key_a", "key_b"]).select(F.col("doc_id").alias("rep"), "n_shingles", "sketch").dropDuplicates(["rep"])
    reps = scratch.stage(reps, "reps")
    lists = scratch.stage(inverted_lists(reps, k, threshold), "lists")
    pairs = scratch.stage(estimated(proposals(lists), reps, k, threshold), "pairs")
    first_sets = scratch.stage(full_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("rep")), width), "sets0")
    links = scratch.stage(verified(pairs, first_sets, threshold), "links0")
    scratch.drop("pairs", "sets0", "reps")
    release(spark)
    found = components(links, scratch, "first")
    blocks, members = residual_blocks(lists, found, threshold)
    blocks = scratch.stage(blocks, "blocks")
    if not blocks.isEmpty():
        sets = scratch.stage(full_sets(docs, members, width), "sets1")
        more = scratch.stage(block_links(blocks, sets, threshold), "links1")
        scratch.drop("sets1")
        if not more.isEmpty():
            found = components(links.unionByName(more), scratch, "second")
    scratch.drop("blocks", "lists")
    of_class = classes.join(found, "rep", "left").select("key_a", "key_b", "n_shingles", F.coalesce("component", "rep").alias("class_component"))
    out = all_.select("doc_id", "key_a", "key_b", "n_shingles").join(of_class, ["key_a", "key_b", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the row with the smallest doc_id stays.

    Of rows that repeat a doc_id the one with the smallest text (null first) stays; rows with a
    null doc_id all stay.  The ids that go are broadcast if they are at most ``BROADCAST_IDS``,
    so the texts aren't shuffled; more are joined.
    """
    scratch = Scratch(docs.sparkSession, "one")
    found = near_duplicates(docs, width, threshold).where("doc_id is not null")
    found = found.groupBy("doc_id").agg(F.min("kept").alias("kept"), F.count("*").alias("rows")).where("not kept or rows > 1")
    found = scratch.stage(found, "found")
    names = docs.columns
    checked = lambda ids: F.broadcast(ids) if row_count_at_most(ids, BROADCAST_IDS) else ids
    out = docs.join(checked(found.where("not kept").select("doc_id")), "doc_id", "left_anti").select(*names)
    twice = found.where("kept").select("doc_id")
    if twice.isEmpty():
        return out
    nr = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    several = out.join(checked(twice), "doc_id", "left_semi").withColumn("__nr", nr).where("__nr = 1").select(*names)
    return out.join(checked(twice), "doc_id", "left_anti").select(*names).unionByName(several)


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return few(near_duplicates(table(spark, sf_dir, "documents"), width=4))
