"""N-gram Jaccard join by chosen paths.

The sets are the five-word shingles of the texts. In every run a set chooses a few of its tokens by
a hash that all sets share, and goes to the bucket of each; alike sets choose alike. A bucket that
is large is split: its sets choose further tokens by a hash of the path so far, and go to the buckets
of the longer paths. Sets that only share a common passage part ways there, as its tokens are few
among theirs; where a split would not lessen the work, as among many near copies, the bucket is
worked off whole, in blocks. Small buckets compare all their sets exactly. The number of runs
follows from the target recall for a pair right at the threshold, with the sample that all runs and
splits share and with a split on every level; closer pairs are safer.

Equal sets are one class with a weight from the start. Choices are made from a sample of each set,
so texts move once, and only to bring the sets of shared buckets together. Buckets with the same
members are compared once, but a large one is split by the hash of each of its paths: the paths are
the repeats that the recall counts on. A link found in several buckets counts in the first of them only; tasks
return counts and local components, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import arrived, shipped, whole, written
from tillwright.llm.components import components
from tillwright.llm.shingles import WORDS, Shingler, mix

SIMILARITY = 0.8
RECALL = 0.9999
#: Tokens of a set that paths are chosen from, and tokens chosen in a run and in a split.
SAMPLE = 64
CHOSEN, CHOSEN_DEEPER = 2, 8
#: Sets and tokens of one block of a bucket; a bucket of more sets is split if that lessens work.
BLOCK, BLOCK_TOKENS = 4096, 1 << 22
#: Pairs that a token adds up to which they are counted one by one; beyond, by a matrix product.
DENSE = 1 << 16
#: A split must bring the compared pairs below this share. Levels of paths at most.
GAIN, DEPTH = 0.5, 4

_SETS = "id long, hi long, lo long, size long, paths array<long>, sample array<long>"


def _apart(shared: int, size: int, runs: int, chosen: int, splits: int) -> float:
    """Chance that no path of two sets stays common, if they share `shared` of `size` sample tokens."""
    first, deeper = 1 - (1 - min(1.0, chosen / size)) ** runs, min(1.0, CHOSEN_DEEPER / size)
    lost = 0.0
    for _ in range(splits):
        lost = (1 - deeper * (1 - lost)) ** shared
    return (1 - first * (1 - lost)) ** shared


def missed(
    runs: int, similarity: float = SIMILARITY, chosen: int = CHOSEN, splits: int = DEPTH - 1
) -> float:
    """Chance that a pair at the threshold is never compared, if all its buckets are split `splits` times.

    All runs and splits choose from one sample. At worst one set holds the other: then a large pair shares
    a Poisson number of sample tokens, `similarity * SAMPLE` on average, and a pair of small sets all
    its common ones.
    """
    mean = similarity * SAMPLE
    large = sum(
        math.exp(shared * math.log(mean) - mean - math.lgamma(shared + 1))
        * _apart(shared, SAMPLE, runs, chosen, splits)
        for shared in range(math.ceil(mean + 12 * math.sqrt(mean)) + 12)
    )
    small = (
        _apart(math.ceil(similarity * size - 1e-9), size, runs, chosen, splits) for size in range(1, SAMPLE + 1)
    )
    return max(large, *small)


def runs_for(recall: float = RECALL, similarity: float = SIMILARITY, chosen: int = CHOSEN) -> int:
    """The least number of runs that misses a pair at the threshold with a chance of at most 1 - recall."""
    for runs in range(1, 1000):
        if missed(runs, similarity, chosen) <= 1 - recall:
            return runs
    raise ValueError(f"{SAMPLE} sampled tokens cannot give a recall of {recall} at a similarity of {similarity}")


def _below(values: np.ndarray, share: float) -> np.ndarray:
    return (values >> np.uint64(11)) < np.uint64(min(1.0, share) * (1 << 53))


def set_key(tokens: np.ndarray) -> tuple[int, int]:
    """Two independent sums that name a set."""
    high, low = mix(tokens + np.uint64(1)).sum(dtype=np.uint64), mix(tokens ^ np.uint64(0xABCD)).sum(dtype=np.uint64)
    return int(high.astype(np.int64)), int(low.astype(np.int64))


def choose(tokens: np.ndarray, runs: int) -> tuple[np.ndarray, np.ndarray]:
    """First-level paths over all runs, and the sample that deeper paths come from."""
    if not len(tokens):
        return tokens.astype(np.int64), tokens.astype(np.int64)
    few = min(SAMPLE, len(tokens))
    sample = tokens[_below(mix(tokens ^ np.uint64(0x5EED)), SAMPLE / len(tokens))]
    paths = [
        mix(sample[_below(mix(sample + np.uint64(0x1000 + run)), CHOSEN / few)] + np.uint64(run))
        for run in range(runs)
    ]
    return np.unique(np.concatenate(paths)).astype(np.int64), sample.astype(np.int64)


def _sets(shingler, runs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = arrived(shingler)
        for batch in batches:
            rows: list[tuple] = []
            for text in batch.column(1):
                tokens = code.shingles(text.as_py())
                paths, sample = choose(tokens, runs)
                rows.append((*set_key(tokens), len(tokens), paths, sample))
            if not rows:
                continue
            high, low, size, paths, sample = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(high, pa.int64()), pa.array(low, pa.int64()),
                pa.array(size, pa.int64()), pa.array(paths, pa.list_(pa.int64())),
                pa.array(sample, pa.list_(pa.int64())),
            ], names=["id", "hi", "lo", "size", "paths", "sample"])

    return run


def _deeper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Longer paths of the members of large buckets."""
    for batch in batches:
        out: list[tuple] = []
        for parent, identity, size, sample in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            tokens = np.array(sample, np.int64).astype(np.uint64)
            start = mix(np.array([parent], np.int64).astype(np.uint64))
            few = min(SAMPLE, size)
            chosen = tokens[_below(mix(tokens ^ start), CHOSEN_DEEPER / few)]
            out += [(parent, identity, size, p) for p in mix(chosen * np.uint64(3) + start).astype(np.int64).tolist()]
        if out:
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["parent", "id", "size", "path"]
            )


def _buckets(members: DataFrame, block: int) -> DataFrame:
    """`path, n, tokens, same` of buckets of two or more; of small ones, one for each set of members.

    Large ones all stay, as each may be split in its own way; `same` is equal for equal members.
    """
    mark = F.xxhash64("id")
    found = members.groupBy("path").agg(
        F.count("*").alias("n"), F.sum("size").alias("tokens"), F.sum(mark % (1 << 40)).alias("s"),
        F.bit_xor(mark).alias("x"),
    ).where("n > 1")
    apart = F.when(F.col("n") > block, F.col("path"))
    return found.groupBy("n", "tokens", "s", "x", apart.alias("apart")).agg(F.min("path").alias("path")).select(
        "path", "n", "tokens", F.xxhash64("n", "tokens", "s", "x").alias("same")
    )


def leaf_buckets(
    sets: DataFrame, owner: DataFrame, block: int = BLOCK, depth: int = DEPTH
) -> DataFrame:
    """`path, id, blocks`: the members of all buckets to be compared, one of each class of sets."""
    narrow = sets.select("id", "hi", "lo", "size", "paths").join(
        owner.select("id", "hi", "lo"), ["id", "hi", "lo"], "left_semi"
    )
    # Rows that repeat id and set choose the same paths.
    members = narrow.select(F.explode("paths").alias("path"), "id", "size").distinct()
    leaves, level = None, 1
    while True:
        members = written(_shared_members(members, block), "members")
        part, large, split = members.where(F.col("n") <= block), members.where(F.col("n") > block), None
        if not large.isEmpty():
            whole, split = _split(large, sets, level < depth)
            part = part.unionByName(large.join(whole, "path", "left_semi"))
        part = part.select("path", "id", F.greatest(
            F.ceil(F.col("n") / block), F.ceil(F.col("tokens") / BLOCK_TOKENS)
        ).cast("int").alias("blocks"))
        leaves = part if leaves is None else leaves.unionByName(part)
        if split is None:
            return leaves
        inner = _children(large.join(split, "path", "left_semi"), sets)
        members = inner.select("path", "id", "size").distinct()
        level += 1


def _shared_members(members: DataFrame, block: int) -> DataFrame:
    """`path, id, size, n, tokens, same` of the buckets of two or more that add pairs.

    Small buckets of the same members are one. If all members of a bucket have the same largest bucket,
    of one block at most, and that is another one, all its pairs are there.
    """
    buckets = _buckets(members, block)
    shared = members.join(buckets, "path")
    rank = F.struct(F.col("n"), (-F.col("path")).alias("order"), F.col("path"))
    small = shared.where(F.col("n") <= block)
    largest = small.groupBy("id").agg(F.max(rank)["path"].alias("largest"))
    within = small.join(largest, "id").groupBy("path").agg(
        F.min("largest").alias("low"), F.max("largest").alias("high")
    )
    spare = within.where("low = high and low <> path").select("path")
    return shared.join(spare, "path", "left_anti")


def _children(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows of longer paths; rows that repeat id and set give the same ones."""
    rows = members.select(F.col("path").alias("parent"), "id", "size").join(
        sets.select("id", F.col("size").alias("own_size"), "sample"), "id"
    ).where("size = own_size").select("parent", "id", "size", "sample")
    return rows.mapInArrow(_deeper, "parent long, id long, size long, path long")


def _split(large: DataFrame, sets: DataFrame, deeper: bool) -> tuple[DataFrame, DataFrame | None]:
    """Paths of the large buckets to compare whole, and of those to split (None if there are none).

    A bucket is split if that lessens the pairs to compare, and no bucket of the same members is
    compared whole; of those that are, one is.
    """
    sizes = large.groupBy("path").agg(F.max("n").alias("n"), F.max("same").alias("same"))
    if deeper:
        inner = _children(large, sets).groupBy("parent", "path").agg(F.count("*").alias("m"))
        cost = inner.where("m > 1").groupBy("parent").agg(F.sum(F.col("m") * F.col("m")).alias("cost"))
        less = F.coalesce("cost", F.lit(0)) < F.lit(GAIN) * F.col("n") * F.col("n")
        sizes = sizes.join(cost, F.col("path") == F.col("parent"), "left")
    else:
        less = F.lit(False)
    judged = written(sizes.select("path", "same", less.alias("less")), "split-buckets")
    whole = judged.where(~F.col("less")).groupBy("same").agg(F.min("path").alias("path"))
    split = judged.where("less").join(whole.select("same"), "same", "left_anti").select("path")
    return whole.select("path"), None if split.isEmpty() else split


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of two lists.

    Rare tokens add their pairs one by one, so the many that few sets share cost little; tokens of
    many sets go through a matrix product.
    """
    total = np.zeros((len(left), len(right)), np.float32)
    tokens = np.concatenate(left + right)
    if not len(tokens):
        return total
    names, column = np.unique(tokens, return_inverse=True)
    sides = []
    at = 0
    for sets in (left, right):
        sizes = np.array([len(s) for s in sets])
        own = column[at : at + sizes.sum()]
        at += sizes.sum()
        order = own.argsort(kind="stable")
        count = np.bincount(own, minlength=len(names))
        sides.append((np.repeat(np.arange(len(sets)), sizes)[order], count, np.cumsum(count) - count))
    (rows_a, count_a, start_a), (rows_b, count_b, start_b) = sides
    pairs = count_a * count_b
    rare = np.flatnonzero((pairs > 0) & (pairs <= DENSE))
    flat = total.ravel()
    cuts = np.flatnonzero(np.diff(np.cumsum(pairs[rare]) // (1 << 21), prepend=-1))
    for start, stop in zip(cuts.tolist(), [*cuts.tolist(), len(rare)][1:], strict=True):
        own = rare[start:stop]
        sizes = pairs[own]
        owner = np.repeat(own, sizes)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        i = rows_a[start_a[owner] + within // count_b[owner]]
        j = rows_b[start_b[owner] + within % count_b[owner]]
        np.add.at(flat, i * len(right) + j, np.float32(1))
    often = np.flatnonzero(pairs > DENSE)
    for start in range(0, len(often), 512):
        own = often[start : start + 512]
        one, two = np.zeros((len(left), len(own)), np.float32), np.zeros((len(own), len(right)), np.float32)
        for k, c in enumerate(own.tolist()):
            one[rows_a[start_a[c] : start_a[c] + count_a[c]], k] = 1
            two[k, rows_b[start_b[c] : start_b[c] + count_b[c]]] = 1
        total += one @ two
    return total


def _by_parts(rows: int, use) -> np.ndarray:
    """`use(slice)` for parts of the rows, so that wide intermediates stay small."""
    return np.concatenate([use(slice(k, k + 256)) for k in range(0, rows, 256)])


def compare_block(
    path: int, ids: np.ndarray, weights: np.ndarray, sets: list[np.ndarray],
    leaves: list[np.ndarray], side: np.ndarray, same: bool, similarity: float,
):
    """Arrays (id, least id reached here, links) of the sets that link within one pair of blocks.

    A link whose two sets also share an earlier bucket is counted there.
    """
    a = np.arange(len(ids)) if same else np.flatnonzero(side == 0)
    b = a if same else np.flatnonzero(side == 1)
    if not len(a) or not len(b):
        return None
    shared = _shared([sets[i] for i in a], [sets[i] for i in b])
    size = np.array([len(s) for s in sets], np.float64)
    linked = _by_parts(len(a), lambda part: (
        shared[part] >= similarity * (size[a[part]][:, None] + size[b][None, :] - shared[part]) - 1e-9
    ))
    if same:
        np.fill_diagonal(linked, False)
    if not linked.any():
        return None
    first = [own[own < path] for own in leaves]
    here = linked
    if any(len(own) for own in first):
        here = linked & (_shared([first[i] for i in a], [first[i] for i in b]) == 0)
    links = np.zeros(len(ids), np.int64)
    links[a] += _by_parts(len(a), lambda part: here[part] @ weights[b])
    if not same:
        links[b] += _by_parts(len(b), lambda part: here.T[part] @ weights[a])
    least = ids.copy()
    big = np.iinfo(np.int64).max
    while True:
        before = least.copy()
        low = _by_parts(len(a), lambda part: np.where(linked[part], least[b][None, :], big).min(axis=1))
        least[a] = np.minimum(least[a], low)
        if not same:
            low = _by_parts(len(b), lambda part: np.where(linked.T[part], least[a][None, :], big).min(axis=1))
            least[b] = np.minimum(least[b], low)
        if (least == before).all():
            break
    out = np.flatnonzero((links > 0) | (least != ids))
    return ids[out], least[out], links[out]


def _compare(similarity: float):
    def work(key, rows: list[tuple]):
        path, first, second = key
        ids, order = np.unique(np.array([r[0] for r in rows], np.int64), return_index=True)
        return compare_block(
            path, ids, np.array([r[1] for r in rows], np.int64)[order],
            [_unpacked(rows[i][4]) for i in order],
            [np.sort(np.array(rows[i][3], np.int64)) for i in order],
            np.array([int(r[2] != first) for r in rows])[order], first == second, similarity,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, found, held = None, [], [], 0
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
            heads = [batch.column(i).to_pylist() for i in range(3, 7)]
            data = batch.column(7)
            for i, key in enumerate(keys):
                if key != now:
                    if rows:
                        found.append(work(now, rows))
                        held += len(rows)
                    now, rows = key, []
                rows.append((heads[0][i], heads[1][i], heads[2][i], heads[3][i], data[i].as_buffer()))
            if held > 20_000:
                yield from _result(found)
                found, held = [], 0
        if rows:
            found.append(work(now, rows))
        yield from _result(found)

    return run


def _result(found: list) -> Iterator[pa.RecordBatch]:
    found = [f for f in found if f is not None]
    if found:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c), pa.int64()) for c in zip(*found, strict=True)],
            names=["a", "b", "links"],
        )


def _packed(tokens: np.ndarray) -> bytes:
    """The upper six bytes of each token: they differ for all tokens of two sets but once in 10^9."""
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def _unpacked(data) -> np.ndarray:
    six = np.frombuffer(data, np.uint8).reshape(-1, 6)
    wide = np.zeros((len(six), 8), np.uint8)
    wide[:, :6] = six
    return wide.view("<u8").ravel()


def _full_sets(shingler):
    """Rows of a candidate with its whole set, if the text is the one of its class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = arrived(shingler)
        for batch in batches:
            keep, sets = [], []
            for i, (text, high, low) in enumerate(zip(
                batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True
            )):
                tokens = code.shingles(text.as_py())
                if set_key(tokens) == (high, low):
                    keep.append(i)
                    sets.append(_packed(tokens))
            rows = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [rows.column(3), rows.column(4), rows.column(5), pa.array(sets, pa.binary())],
                names=["id", "weight", "buckets", "tokens"],
            )

    return run


def near_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
    recall: float = RECALL, words: int = WORDS, block: int = BLOCK,
) -> DataFrame:
    """One row per row: id, n_links, class_id, kept.

    Words are runs of letters and digits, lower case; a set holds the different shingles of `words`
    words, or one of all words where there are fewer. `n_links` counts the other rows with a Jaccard
    similarity of at least `similarity`; `class_id` is the smallest id reachable by links, itself
    included, and that row is kept. Null counts as empty; texts without a word link with nothing, nor do
    rows without an id (their class is null; they are kept). Rows that share id and set link like any
    copies; rows that share an id alone are one node. Other columns are not read. An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    shingler = shipped(spark, Shingler(words))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), whole(text_col).alias("text"))
    sets = written(texts.mapInArrow(_sets(shingler, runs_for(recall, similarity)), _SETS), "shingle-sets")
    usable = sets.where("size > 0 and id is not null")
    owner = usable.groupBy("hi", "lo", "size").agg(F.min("id").alias("id"), F.count("*").alias("weight"))
    owner = written(owner, "set-classes")
    leaves = written(leaf_buckets(usable, owner, block), "leaf-buckets")
    found = _linked(texts, owner, leaves, shingler, similarity)
    found = written(found, "text-links")
    links = found.groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    joined = components(found.select("a", "b")).select(F.col("node").alias("class"), "component")
    per_class = owner.withColumnRenamed("id", "class").join(links, "class", "left").join(joined, "class", "left")
    return (
        sets.select("id", "hi", "lo", "size").join(per_class.drop("size"), ["hi", "lo"], "left")
        .select(
            F.col("id").alias(id_col), "size", "class",
            F.when((F.col("size") > 0) & F.col("id").isNotNull(),
                   F.coalesce("links", F.lit(0)) + F.col("weight") - 1).otherwise(F.lit(0)).alias("n_links"),
            F.when((F.col("size") > 0) & F.col("id").isNotNull(), F.coalesce("component", "class"))
            .otherwise(F.col("id")).alias("class_id"),
        )
        .select(id_col, F.col("n_links").cast("long").alias("n_links"), "class_id",
                F.col(id_col).eqNullSafe(F.col("class_id")).alias("kept"))
    )


def _linked(texts, owner, leaves, shingler, similarity: float) -> DataFrame:
    """`a, b, links`: per class and bucket its links and a smaller class it reaches.

    Rows that repeat id and set give the same set more than once; a task takes one.
    """
    own = leaves.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("path", "blocks"))).alias("buckets"))
    wanted = own.join(owner.select("id", "hi", "lo", "weight"), "id")
    sets = texts.where("id is not null").join(wanted, "id").select(
        "text", "hi", "lo", "id", "weight", "buckets"
    ).mapInArrow(
        _full_sets(shingler),
        "id long, weight long, buckets array<struct<path: long, blocks: int>>, tokens binary",
    )
    rows = sets.withColumn("bucket", F.explode("buckets"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("bucket.blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("bucket.blocks") - 1)))
    pairs = rows.select(
        F.col("bucket.path").alias("path"), F.least("own", "other").alias("first"),
        F.greatest("own", "other").alias("second"), "id", "weight", "own",
        F.col("buckets.path").alias("leaves"), "tokens",
    )
    dealt = pairs.repartition("path", "first", "second").sortWithinPartitions("path", "first", "second")
    return dealt.mapInArrow(_compare(similarity), "a long, b long, links long")


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """The rows of `docs` that :func:`near_texts` keeps, with their columns, whatever the names of those.

    Null and empty texts, and rows without an id, stay; so do all rows that share an id that stays. Texts of
    any length are compared whole. An empty table stays empty.
    """
    kept = near_texts(docs, id_col, text_col, similarity).where("kept")
    ids = kept.select(F.col(id_col).alias("_kept_id")).distinct()
    boxed = docs.select(F.struct("*").alias("_row"), F.col(id_col).cast("long").alias("_id"))
    return boxed.join(ids, F.col("_id").eqNullSafe(F.col("_kept_id")), "left_semi").select("_row.*")
