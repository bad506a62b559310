"""Near duplicates by a chosen-path set similarity join (operator 9).

A document is the set of its word shingles. Documents with the same set form a
class, and one row per class goes on. Each of several independent trees branches
the classes: at a node, the node's path chooses one of the minwise tokens, and
members with the same token go to the same child. Classes that overlap by the
threshold stay together on a path of k tokens with probability ``similarity ** k``,
so the number of trees sets the recall of the search: a pair at the threshold is
missed by all 16 trees of three tokens with probability 1.6e-4 (1e-5 if the trees
were independent; they draw on the same 64 tokens).

Classes that share a node with another get a sketch of 1,024 bits. Nodes of up to
``limit`` classes are compared exhaustively on the sketches inside the join. The
members of a larger node are first compared with two of them (pivots), by key,
whatever its size. What these links leave apart in it is compared further: its few
classes outside its largest component with all others or, if they are many, with
those that share a shingle of a prefix of the set, long enough that no pair at the
threshold is lost. So neither a bound on a node nor its size drops a pair.

Every candidate pair is confirmed on the full sets of both texts. Links between
classes, not between all copies, go to the connected components.

A document without words has the empty set and is linked with nothing. Null text
counts as no words. A row with a null id is judged alone (component null, kept).
Rows that repeat an id are judged each by their own words: the search goes by classes,
and where one id stands for several of them all but one get a number behind the largest id.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.llm.components import components
from recordmill.llm.shared import DOCUMENT, hashed_words, hinted, kept_by, mixed, pick, settle, shingle_hashes, slices

#: Minwise tokens per document, of 32 bits, to branch on.
TOKENS = 64
#: Bits of the sketch of a document that shares a node with another: the last bit of as many other minwise values.
BITS = 1024
_SKETCH = [f"s{i}" for i in range(BITS // 64)]
_SETS = "doc_id long, text_hash long, n_shingles long, f1 long, f2 long, tokens binary"
_SKETCHES = ", ".join(["doc_id long", *[f"{s} long" for s in _SKETCH]])
#: Shingles are counted by their first bits, to tell rare ones from common ones.
_BUCKET_BITS = 20
_PREFIXES = "shingle long, doc_id long, root long, out boolean, n long, at long"


@functools.lru_cache
def _factors(n: int, seed: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03) + np.uint64(seed)) | np.uint64(1)


def shingled(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of texts lower-cased in A-Z, with boundaries."""
    kept_by("near_duplicates")
    words, starts = hashed_words(texts, lower=True)
    return shingle_hashes(words, starts, size)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _sets(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, limit=2 << 20):
        hashes, starts = shingled(batch.column(1), size)
        n = batch.num_rows
        counts, f1, f2 = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        for i in range(n):
            own = np.unique(hashes[starts[i] : starts[i + 1]])
            counts[i], f1[i] = len(own), own.sum(dtype=np.uint64)
            f2[i] = mixed(own).sum(dtype=np.uint64)
        tokens = np.zeros((n, TOKENS), np.uint32)
        full = np.flatnonzero(counts)
        for k, factor in enumerate(_factors(TOKENS, 1) if len(full) else ()):
            tokens[full, k] = np.minimum.reduceat(hashes * factor, starts[full]) >> np.uint64(32)
        raw = pa.array([row.tobytes() for row in tokens], pa.binary())
        columns = [batch.column(0), batch.column(2), pa.array(counts), *map(_signed, (f1, f2)), raw]
        yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _SETS.split(", ")])


def _sketches(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, limit=2 << 20):
        hashes, starts = shingled(batch.column(1), size)
        full = np.flatnonzero(np.diff(starts))
        sketch = [np.zeros(batch.num_rows, np.uint64) for _ in _SKETCH]
        for k, factor in enumerate(_factors(BITS, 2) if len(full) else ()):
            low = np.minimum.reduceat(hashes * factor, starts[full]) >> np.uint64(32)
            sketch[k % len(sketch)][full] |= (low & np.uint64(1)) << np.uint64(k // len(sketch))
        yield pa.RecordBatch.from_arrays([batch.column(0), *map(_signed, sketch)], ["doc_id", *_SKETCH])


def _walk(path: np.ndarray, tokens: np.ndarray, steps: int) -> np.ndarray:
    """The node each member reaches: in each step the path chooses a token, its value the child."""
    for _ in range(steps):
        chosen = (mixed(path + np.uint64(0x632BE59BD9B4E019)) % np.uint64(TOKENS)).astype(np.int64)
        value = tokens[np.arange(len(path)), chosen].astype(np.uint64)
        path = mixed(path * np.uint64(0x9E3779B97F4A7C15) + (chosen.astype(np.uint64) << np.uint64(32)) + value)
    return path


def _token_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), TOKENS)


def _plant(batches: Iterable[pa.RecordBatch], trees: int, first: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        tokens = _token_rows(batch.column("tokens"))
        for tree in range(trees):
            path = _walk(mixed(np.full(batch.num_rows, tree + 1, np.uint64)), tokens, first)
            yield pa.RecordBatch.from_arrays([_signed(path), batch.column("doc_id")], ["path", "doc_id"])


def _alike(similarity: float) -> Column:
    """Sketches of rows ``a`` and ``b`` that a pair at the similarity has but for 4.5 deviations."""
    p = (1 + similarity) / 2
    most = int(BITS * (1 - p) + 4.5 * (BITS * p * (1 - p)) ** 0.5)
    differing = None
    for s in _SKETCH:
        n = F.bit_count(F.col(f"a.{s}").bitwiseXOR(F.col(f"b.{s}")))
        differing = n if differing is None else differing + n
    return differing <= most


def _sized(rows: DataFrame) -> DataFrame:
    """Nodes of two members or more: size and two pivots, by combined aggregates."""
    sizes = rows.groupBy("path").agg(
        F.count(F.lit(1)).alias("members"),
        F.min("doc_id").alias("pivot"),
        F.expr("min_by(doc_id, xxhash64(doc_id))").alias("other"),
    )
    return settle(rows.join(settle(sizes.where("members > 1")), "path"))


def _parted(rows: DataFrame) -> DataFrame:
    """Nodes of two components or more: size, largest component (``main``) and members ``outside`` it."""
    parts = rows.groupBy("path", "root").agg(F.count(F.lit(1)).alias("n"))
    sizes = parts.groupBy("path").agg(
        F.sum("n").alias("members"), F.max_by("root", "n").alias("main"), (F.sum("n") - F.max("n")).alias("outside")
    )
    return settle(rows.join(settle(sizes.where("outside > 0")), "path"))


def _pairs_in(small: DataFrame, alike: Column) -> DataFrame:
    """All pairs of each node."""
    on = (F.col("a.path") == F.col("b.path")) & (F.col("a.doc_id") < F.col("b.doc_id")) & alike
    return small.alias("a").join(small.alias("b"), on).select(
        F.col("a.doc_id").alias("a"), F.col("b.doc_id").alias("b")
    )


def _pairs_with_pivots(large: DataFrame, alike: Column) -> DataFrame:
    """Each member of a large node with the node's pivots."""
    keys = ["path", "doc_id", *_SKETCH]
    pivots = settle(large.where("doc_id = pivot or doc_id = other").select(*keys))
    on = (F.col("a.path") == F.col("b.path")) & (F.col("a.doc_id") != F.col("b.doc_id")) & alike
    pairs = large.select(*keys).alias("a").join(pivots.alias("b"), on)
    return pairs.select(F.least("a.doc_id", "b.doc_id").alias("a"), F.greatest("a.doc_id", "b.doc_id").alias("b"))


def _confirm(batches: Iterable[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text_b", 2 << 20):
        (left, at), (right, bt) = shingled(batch.column("text_a"), size), shingled(batch.column("text_b"), size)
        good, known, one = np.zeros(batch.num_rows, bool), None, None
        ids = batch.column("a").to_numpy()
        for i in range(batch.num_rows):
            if known != ids[i]:
                known, one = ids[i], np.unique(left[at[i] : at[i + 1]])
            two = np.unique(right[bt[i] : bt[i + 1]])
            shared = len(np.intersect1d(one, two, assume_unique=True))
            good[i] = 100 * shared >= percent * (len(one) + len(two) - shared)
        mask = pa.array(good)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full sets overlap by the threshold; texts of other documents don't move."""
    ids = settle(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    needed = settle(texts.join(hinted(ids), "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    one = needed.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    two = needed.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
    return settle(both.mapInArrow(lambda batches: _confirm(batches, size, percent), "a long, b long"))


def classes(sets: DataFrame) -> DataFrame:
    """``n_shingles, f1, f2, rep, text_hash``: the smallest id of the documents with one set, and a text of that id."""
    first = F.min(F.struct("doc_id", "text_hash")).alias("first")
    found = sets.where("n_shingles > 0 and doc_id is not null").groupBy("n_shingles", "f1", "f2").agg(first)
    return found.select("n_shingles", "f1", "f2", F.col("first.doc_id").alias("rep"), "first.text_hash")


def named_apart(known: DataFrame, sets: DataFrame) -> DataFrame | None:
    """Classes with a ``node`` each where an id stands for several; None where none does."""
    several = settle(known.groupBy("rep").agg(F.count(F.lit(1)).alias("n"), F.min("text_hash").alias("least")).where("n > 1"))
    if several.isEmpty():
        return None
    behind = sets.agg(F.max("doc_id")).first()[0] + 1
    own = F.col("least").isNull() | (F.col("text_hash") == F.col("least"))
    node = F.when(own, F.col("rep")).otherwise(F.monotonically_increasing_id() + F.lit(behind))
    return settle(known.join(several.drop("n"), "rep", "left").withColumn("node", node).drop("least"))


def near_duplicates(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    trees: int = 16,
    first: int = 3,
    limit: int = 32,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document.

    ``size``: words of a shingle; ``percent``: least intersection of a link in
    hundredths of the union; ``trees`` independent trees branch on ``first``
    tokens before nodes are compared; nodes over ``limit`` classes are compared
    by pivots first.
    """
    texts = pick(docs, "doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    sets = settle(texts.mapInArrow(lambda batches: _sets(batches, size), _SETS))
    known = settle(classes(sets))
    apart = named_apart(known, sets)
    if apart is None:
        members = sets.join(hinted(known.select(F.col("rep").alias("doc_id"))), "doc_id", "left_semi")
        texts = texts.drop("text_hash")
    else:  # one row of each class, under the class's own number
        known = apart
        number = known.select(F.col("rep").alias("doc_id"), "text_hash", "node")
        members, texts = (
            rows.join(number, ["doc_id", "text_hash"]).drop("doc_id", "text_hash").withColumnRenamed("node", "doc_id")
            for rows in (sets, texts)
        )
        texts = settle(texts.select("doc_id", "text"))
    members = settle(members.dropDuplicates(["doc_id"]).select("doc_id", "tokens"))
    alike = _alike(percent / 100)
    rows = settle(members.mapInArrow(lambda batches: _plant(batches, trees, first), "path long, doc_id long"))
    shared = _sized(rows)
    ids = settle(shared.select("doc_id").distinct())
    near = texts.join(hinted(ids), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    sketches = settle(near.mapInArrow(lambda batches: _sketches(batches, size), _SKETCHES))
    nodes = settle(shared.join(sketches, "doc_id"))
    large = nodes.where(F.col("members") > limit)
    pairs = _pairs_in(nodes.where(F.col("members") <= limit), alike)
    any_large = not large.isEmpty()
    if any_large:
        pairs = pairs.union(_pairs_with_pivots(large, alike))
    pairs = settle(pairs.distinct())
    links = confirmed(pairs, texts, size, percent)
    roots = settle(components(links))
    if any_large:
        more = _apart(large, roots, texts, sketches, alike, limit, size, percent)
        more = settle(more.distinct().join(pairs, ["a", "b"], "left_anti"))
        if not more.isEmpty():
            links = links.union(confirmed(more, texts, size, percent))
            roots = settle(components(links))
    if apart is not None:  # back from numbers to ids: the smallest of a component's classes
        nodes_of = known.select("rep", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        least = nodes_of.groupBy("root").agg(F.min("rep").alias("least"))
        roots = settle(nodes_of.join(least, "root").select("node", F.col("least").alias("root")))
        known = known.drop("rep").withColumnRenamed("node", "rep")
    placed = (
        sets.select("doc_id", "n_shingles", "f1", "f2")
        .join(known.drop("text_hash"), ["n_shingles", "f1", "f2"], "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    )
    component = F.coalesce("root", "rep", "doc_id")
    return placed.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """The documents that stay, in the columns of documents: of a group the one of the smallest id.

    An id goes if none of its rows stays. Of rows that repeat a staying id, the
    one with the smallest text stays. Rows with a null id stay.
    """
    found = near_duplicates(docs, **options).where("doc_id is not null")
    ids = settle(found.groupBy("doc_id").agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("rows")))
    gone = settle(ids.where("not stays").select("doc_id"))
    again = settle(ids.where("stays and rows > 1").select("doc_id"))
    rows = pick(docs, *DOCUMENT)
    kept = rows.join(hinted(gone), "doc_id", "left_anti")
    if again.isEmpty():
        return kept
    rest = [c for c in DOCUMENT if c != "doc_id"]
    rest.sort(key=lambda c: c != "text")
    one = kept.join(hinted(again), "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("row"))
    once = one.select("doc_id", "row.*").select(*DOCUMENT)
    return kept.join(hinted(again), "doc_id", "left_anti").select(*DOCUMENT).union(once)


def _apart(
    large: DataFrame, roots: DataFrame, texts: DataFrame, sketches: DataFrame, alike: Column, limit: int, size: int, percent: int
) -> DataFrame:
    """Candidate pairs of different components inside the large nodes.

    Where at most ``limit`` members of a node are outside its largest component,
    these are compared with all others, which is linear in the node. The members
    of all other nodes are joined by prefixes of their full sets.
    """
    own = large.select("path", "doc_id").join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    now = _parted(settle(own.withColumn("root", F.coalesce("root", "doc_id"))))
    few = settle(now.where(F.col("outside") <= limit).join(sketches, "doc_id"))
    found = _pairs_across(few.where("root <> main"), few, alike)
    rest = now.where(F.col("outside") > limit)
    if rest.isEmpty():
        return found
    members = settle(rest.groupBy("doc_id").agg(F.min("root").alias("root"), F.max(F.expr("root <> main")).alias("out")))
    return found.union(_pairs_by_prefix(members, texts, sketches, alike, size, percent))


def _own_sets(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in slices(batches, limit=2 << 20):
        hashes, starts = shingled(batch.column(batch.schema.get_field_index("text")), size)
        yield batch, [np.unique(hashes[a:b]) for a, b in zip(starts, starts[1:], strict=False)]


def _counted(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """How many sets hold a shingle of each bucket."""
    total = np.zeros(1 << _BUCKET_BITS, np.int64)
    for _, sets in _own_sets(batches, size):
        held = np.concatenate(sets) >> np.uint64(64 - _BUCKET_BITS)
        total += np.bincount(held.astype(np.int64), minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])


def _prefixes(batches: Iterable[pa.RecordBatch], size: int, percent: int, ranks: bytes) -> Iterator[pa.RecordBatch]:
    """The rarest shingles of each set, as many as a set that overlaps by the threshold can't all miss."""
    rank = np.frombuffer(ranks, np.uint8)
    for batch, sets in _own_sets(batches, size):
        parts = []
        for own in sets:
            order = np.lexsort((own, rank[(own >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)]))
            parts.append(own[order[: len(own) + 1 + -percent * len(own) // 100]])
        lengths = np.array([len(x) for x in parts], np.int64)
        place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        rows = pa.array(np.repeat(np.arange(len(parts)), lengths))
        columns = [
            _signed(np.concatenate(parts)),
            batch.column("doc_id").take(rows),
            batch.column("root").take(rows),
            batch.column("out").take(rows),
            pa.array(np.repeat([len(s) for s in sets], lengths).astype(np.int64)),
            pa.array(place),
        ]
        yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _PREFIXES.split(", ")])


def _pairs_by_prefix(
    members: DataFrame, texts: DataFrame, sketches: DataFrame, alike: Column, size: int, percent: int
) -> DataFrame:
    """Members that are ``out`` with all of another component, by an exact join on prefixes of the sets.

    Shingles are put in one order, rare ones first. Of two sets that overlap by the
    threshold the first common shingle is in the prefix of both, and behind it both
    are long enough for the overlap. The order is by counts of a fixed number of
    buckets, so it is one small table; any order gives the same pairs.
    """
    held = settle(texts.join(hinted(members), "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "text", "root", "out"))
    counts = held.mapInArrow(lambda batches: _counted(batches, size), "bucket long, n long")
    counts = settle(counts.groupBy("bucket").agg(F.sum("n").alias("n"))).toArrow()  # 2 ** _BUCKET_BITS rows at most
    rank = np.zeros(1 << _BUCKET_BITS, np.uint8)
    rank[counts.column("bucket").to_numpy()] = 8 * np.log2(counts.column("n").to_numpy())
    ranks = rank.tobytes()
    rows = settle(held.mapInArrow(lambda batches: _prefixes(batches, size, percent, ranks), _PREFIXES))
    overlap = F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at")) * (100 + percent)
    on = (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.root") != F.col("b.root"))
    on = on & (overlap >= (F.col("a.n") + F.col("b.n")) * percent)
    joined = rows.where("out").alias("a").join(rows.alias("b"), on)
    pairs = joined.select(F.least("a.doc_id", "b.doc_id").alias("one"), F.greatest("a.doc_id", "b.doc_id").alias("two"))
    pairs = settle(pairs.distinct())
    near = pairs.join(sketches.alias("a"), F.col("one") == F.col("a.doc_id"))
    near = near.join(sketches.alias("b"), F.col("two") == F.col("b.doc_id")).where(alike)
    return near.select(F.col("one").alias("a"), F.col("two").alias("b"))


def _pairs_across(outside: DataFrame, members: DataFrame, alike: Column) -> DataFrame:
    """Members outside the main component of their node with all of another component."""
    on = (F.col("a.path") == F.col("b.path")) & (F.col("a.root") != F.col("b.root")) & alike
    return outside.alias("a").join(members.alias("b"), on).select(
        F.least("a.doc_id", "b.doc_id").alias("a"), F.greatest("a.doc_id", "b.doc_id").alias("b")
    )
