"""Near-duplicate classes by Order MinHash, verified by banded alignment.

Words are lower-cased pieces without punctuation; a k-mer is five of them (all
words of a shorter text), labelled by its occurrence within the text. For each of
``sketches`` hash functions the ``length`` least k-mers are taken and put back in
text order: their hash is a bucket key, so texts meet when they share the same
rare k-mers in the same order, which edit similarity makes likely. At similarity
0.8 a pair shares one sketch of three k-mers with probability about 0.5, so it
misses all 20 sketches about once in a million pairs.

Equal texts are one node, by a digest. In each bucket every node is aligned with
the bucket's leader, the node that shares most buckets with others. Two are linked if
the alignment of their k-mer sequences within a diagonal band matches L of them
with L / (n1 + n2 - L) >= ``threshold``. Links join nodes to components by label
propagation. A bucket whose nodes are one component is done. The nodes of all
other buckets then take their rarest k-mers as keys, as many as a pair at
``threshold`` must share one of (a prefix filter, exact whatever the order of
k-mers; sizes and the keys' places bound what a pair can share), and the pairs that
meet there are aligned unless one component holds both by then. So no pair of a
bucket is lost, and texts that only have a passage in common are never aligned
with each other. Each text meets growing shares of the others, as early links spare
later pairs.

Defined results: a null text is a class of its own; equal texts, empty ones
too, share a class; a text without words is linked to equal texts only; rows that
share an id are judged by their own texts; a class's id is its least id (null if it
has none); an empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

WORDS = 5
#: Texts, picked by their digest, whose repeated k-mers set the order of k-mers; any order gives the same pairs.
ORDER_TEXTS, ORDER_KMERS = 4096, 200_000
#: Texts that meet in the prefix filter at once; if there are more, each text meets growing shares of the others.
ROUND_TEXTS = 1000
SHARES = (1 / 64, 1 / 8, 1.0)
#: Most rows of nodes or keys that are broadcast; a larger table is joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Partners that one copy of a leader's text serves.
SERVED = 256
#: Bytes of text that one step of sketching or aligning holds as arrays.
SKETCH_BYTES = 2 << 20
MEMO = 100_000
LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


class WordHasher:
    """64-bit hashes of normalised words, 0 for pieces without a letter or digit; a bounded memo per worker."""

    def __init__(self):
        self.memo: dict[str, int] = {}

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of all texts and each text's offsets into them."""
        values, offsets = common.list_parts(pc.utf8_split_whitespace(texts))
        coded = values.dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        if len(self.memo) > MEMO:
            self.memo.clear()
        found = list(map(self.memo.get, pieces))
        for i, h in enumerate(found):
            if h is None:
                word = "".join(filter(str.isalnum, pieces[i].lower()))
                found[i] = self.memo[pieces[i]] = (xxhash.xxh3_64_intdigest(word.encode()) | 1) if word else 0
        hashes = np.array(found, dtype=np.uint64)[coded.indices.to_numpy(zero_copy_only=False)]
        kept = hashes != 0
        return hashes[kept], np.concatenate([[0], np.cumsum(kept)])[offsets]


def worker_hasher() -> WordHasher:
    return common.held(WordHasher)


def kmers(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' k-mers and offsets; a text of fewer than WORDS words has one, of all its words."""
    sizes = np.diff(offsets)
    counts = np.where(sizes > 0, np.maximum(sizes - WORDS + 1, 1), 0)
    out = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(sizes)), counts)
    first = np.arange(out[-1]) - out[owner] + offsets[owner]
    end = offsets[1:][owner]
    padded = np.concatenate([words, np.zeros(WORDS, dtype=np.uint64)])
    key = np.zeros(len(first), dtype=np.uint64)
    for k in range(WORDS):
        key = common.mix64(key * np.uint64(0x100000001B3) + np.where(first + k < end, padded[first + k], np.uint64(0)))
    return key, out


def label_occurrences(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Keys made distinct within a text: the n-th occurrence of a k-mer gets a key of its own."""
    mixed = keys ^ common.mix64(owner.astype(np.uint64) + np.uint64(1))
    order = np.argsort(mixed, kind="stable")
    same = np.concatenate([[False], mixed[order][1:] == mixed[order][:-1]])
    if not same.any():
        return keys
    at = np.arange(len(keys))
    nth = at - np.maximum.accumulate(np.where(same, 0, at))
    out = keys.copy()
    later = order[nth > 0]
    out[later] = common.mix64(keys[later] + nth[nth > 0].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out


def order_sketches(keys: np.ndarray, offsets: np.ndarray, sketches: int, length: int) -> np.ndarray:
    """(texts x sketches) hashes of the ``length`` least k-mers in text order; texts without k-mers get zeros."""
    sizes = np.diff(offsets)
    full = np.flatnonzero(sizes)
    out = np.zeros((len(sizes), sketches), dtype=np.uint64)
    if not len(full):
        return out
    starts = offsets[:-1][full]
    owner = np.repeat(np.arange(len(full)), sizes[full])
    labelled = label_occurrences(keys, owner)
    for s in range(sketches):
        values = common.mix64(labelled ^ common.mix64(np.array([s + 1], dtype=np.uint64)))
        places = np.full((len(full), length), -1, dtype=np.int64)
        for k in range(length):
            least = np.minimum.reduceat(values, starts)
            hits = np.flatnonzero(values == least[owner])
            hits = hits[least[owner[hits]] != LAST]
            places[owner[hits], k] = hits
            values[hits] = LAST
        places.sort(axis=1)
        key = np.full(len(full), s + 1, dtype=np.uint64)
        for k in range(length):
            key = common.mix64(key * np.uint64(0x100000001B3) + np.where(places[:, k] >= 0, labelled[places[:, k]], np.uint64(0)))
        out[full, s] = key
    return out


def digest(text) -> Column:
    """128 bits that equal texts share; null for null."""
    return F.unhex(F.md5(F.col(text).cast("binary")))


def sketch(documents: DataFrame, sketches: int, length: int) -> DataFrame:
    """(id, node, n, sketches): the text's digest, the number of k-mers, and sketches (empty if no word)."""
    kind = documents.schema["id"].dataType.simpleString()

    def sketched(batches):
        hasher = worker_hasher()
        for batch in common.text_slices(batches, limit=SKETCH_BYTES):
            words, ends = hasher.flat(pc.fill_null(common.column(batch, "text"), ""))
            keys, offsets = kmers(words, ends)
            rows = order_sketches(keys, offsets, sketches, length).view(np.int64)
            n = np.diff(offsets)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum((n > 0) * sketches)]).astype(np.int32)), pa.array(rows[n > 0].ravel()))
            yield pa.RecordBatch.from_arrays([common.column(batch, "id"), common.column(batch, "node"), pa.array(n), lists], ["id", "node", "n", "sketches"])

    return documents.select("id", digest("text").alias("node"), "text").mapInArrow(sketched, f"id {kind}, node binary, n long, sketches array<long>")


def least_matches(n1: int, n2: int, threshold: float) -> int:
    """Least L with L / (n1 + n2 - L) >= threshold."""
    return -int((1e-9 - threshold * (n1 + n2) / (1 + threshold)) // 1)


def matches(left: np.ndarray, right: np.ndarray, floor: float) -> int:
    """L of the best alignment of two k-mer sequences, or -1 where it can't reach ``floor``; cells beyond the band can't."""
    n1, n2 = len(left), len(right)
    needed = least_matches(n1, n2, floor)
    if min(n1, n2) < needed or not n1 or not n2:
        return -1
    short = min(n1, n2)
    differ = np.flatnonzero(left[:short] != right[:short])
    head = int(differ[0]) if len(differ) else short
    rest = short - head
    differ = np.flatnonzero(left[n1 - rest :][::-1] != right[n2 - rest :][::-1]) if rest else np.zeros(0)
    tail = int(differ[0]) if len(differ) else rest
    matched = head + tail
    left, right = left[head : n1 - tail], right[head : n2 - tail]
    shared = np.isin(right, left)
    if matched + shared.sum() < needed:
        return -1
    places: dict[int, int] = defaultdict(int)
    for i, key in enumerate(left.tolist()):
        places[key] |= 1 << i
    band = max(n1, n2) - needed
    full = (1 << len(left)) - 1
    state = full  # bit-parallel rows of the alignment matrix: zero bits count matches
    for j in np.flatnonzero(shared).tolist():
        low = max(0, j - band)
        match = places[int(right[j])] >> low << low & ((1 << (j + band + 1)) - 1)
        kept = state & match
        state = (state + kept | state - kept) & full
    matched += len(left) - state.bit_count()
    return matched if matched >= needed else -1


def verify(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(node, leader) of the pairs that are linked; a leader's text is sent once for SERVED partners."""

    def compared(batches):
        hasher = worker_hasher()
        current, head = None, None
        for batch in common.text_slices(batches, limit=SKETCH_BYTES):
            keys, offsets = kmers(*hasher.flat(common.column(batch, "text")))
            nodes, leaders = [], []
            for i, (node, leader) in enumerate(zip(common.column(batch, "node").to_pylist(), common.column(batch, "leader").to_pylist(), strict=True)):
                own = keys[offsets[i] : offsets[i + 1]]
                if node is None:
                    current, head = leader, own.copy()
                elif leader != current:
                    raise ValueError("a leader's text is missing")
                elif matches(head, own, threshold) >= least_matches(len(head), len(own), threshold):
                    nodes.append(node)
                    leaders.append(leader)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(leaders, pa.binary())], ["node", "leader"])

    groups = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / SERVED).alias("salts"))
    salted = pairs.join(groups, "leader").select("node", "leader", F.pmod(F.xxhash64("node"), "salts").alias("salt"))
    heads = salted.select("leader", "salt").distinct().join(texts.withColumnRenamed("node", "leader"), "leader")
    rows = salted.join(texts, "node").select("leader", "salt", "node", "text").union(heads.select("leader", "salt", F.lit(None).cast("binary"), "text"))
    dealt = rows.repartition("leader", "salt").sortWithinPartitions("leader", "salt", "node")  # a leader's own row has a null node and comes first
    return dealt.mapInArrow(compared, "node binary, leader binary")


def prefix_keys(texts: DataFrame, threshold: float) -> DataFrame:
    """(node, n, key, place): keys of each text's rarest k-mers; texts linked at ``threshold`` share one at least."""

    def labelled(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        keys, offsets = kmers(*worker_hasher().flat(text))
        return label_occurrences(keys, np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))), offsets

    def all_keys(batches):
        for batch in common.text_slices(batches, limit=SKETCH_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array(labelled(common.column(batch, "text"))[0].view(np.int64))], ["key"])

    share = ORDER_TEXTS / max(texts.count(), 1)
    sample = texts.where(F.pmod(F.xxhash64("node", F.lit(11)), F.lit(1 << 20)) < int(share * (1 << 20)))
    counted = sample.mapInArrow(all_keys, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").orderBy(F.desc("c"), "key").limit(ORDER_KMERS).toArrow()
    known = counted["key"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(known)
    known, often = known[order], counted["c"].to_numpy()[order]

    def prefixes(batches):
        for batch in common.text_slices(batches, limit=SKETCH_BYTES):
            keys, offsets = labelled(common.column(batch, "text"))
            sizes = np.diff(offsets)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            times = np.zeros(len(keys), dtype=np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                times = np.where(known[at] == keys, often[at], 0)
            rank = np.lexsort((keys, times, owner))
            length = sizes - np.ceil(threshold * sizes - 1e-9).astype(np.int64) + 1
            place = np.arange(len(keys)) - offsets[:-1][owner]
            first = place < length[owner]
            taken = rank[first]
            nodes = common.column(batch, "node").take(pa.array(owner[taken]))
            yield pa.RecordBatch.from_arrays([nodes, pa.array(sizes[owner[taken]]), pa.array(keys[taken].view(np.int64)), pa.array(place[first])], ["node", "n", "key", "place"])

    return texts.mapInArrow(prefixes, "node binary, n long, key long, place long")


def least_shared(n1: str, n2: str, threshold: float) -> Column:
    """What a linked pair of such sizes has in common at least."""
    return F.lit(threshold / (1 + threshold)) * (F.col(n1) + F.col(n2)) - F.lit(1e-6)


def prefix_pairs(keys: DataFrame, labels: DataFrame, threshold: float, low: float, high: float) -> DataFrame:
    """(node, leader) of different components that share a key; rows of a key's most frequent component only meet those of others.

    One side is the share from ``low`` to ``high`` of all nodes, by a hash.
    """
    rows = labelled(keys, labels)
    counted = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"))
    main = counted.groupBy("key").agg(F.max(F.struct("c", "label")).alias("m"), F.count(F.lit(1)).alias("labels")).where("labels > 1").select("key", F.col("m.label").alias("main"))
    rows = rows.join(main, "key")
    minor = rows.where("label <> main").select("key", *[F.col(c).alias(f"{c}1") for c in ("node", "n", "place", "label")])
    part = F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1 << 20)) / (1 << 20)
    met = rows.where((part >= low) & (part < high)).join(minor, "key").where("label <> label1")
    met = met.where(F.least(F.col("n") - F.col("place"), F.col("n1") - F.col("place1")) >= least_shared("n", "n1", threshold)).where(F.least("n", "n1") >= least_shared("n", "n1", threshold))
    # the text outside the main component leads, as it has many partners
    swap = (F.col("label") != F.col("main")) & (F.col("node") > F.col("node1"))
    return met.select(F.when(swap, F.col("node1")).otherwise(F.col("node")).alias("node"), F.when(swap, F.col("node")).otherwise(F.col("node1")).alias("leader")).distinct()


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (node, ...) with the label of the node's component, which is the node itself where it has no link."""
    return rows.join(bounded(labels), "node", "left").withColumn("label", F.coalesce("label", "node"))


def bounded(rows: DataFrame) -> DataFrame:
    """A written table with a broadcast hint if it is small."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def components(links: DataFrame, scratch: common.Scratch) -> DataFrame:
    """(node, label): least node of each connected component of links (node, leader)."""
    edges = scratch.table(links.select("node", F.col("leader").alias("other")).union(links.select("leader", "node")).distinct())
    labels = scratch.table(edges.groupBy("node").agg(F.min("other").alias("label")).select("node", F.least("node", "label").alias("label")))
    while True:
        near = edges.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("near"))
        stepped = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = scratch.table(stepped.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label")))
        scratch.drop(labels)
        labels = moved.select("node", "label")
        if moved.where("label < old").isEmpty():
            scratch.drop(edges)
            return moved.select("node", "label")
        labels = moved.drop("old")


def linked_nodes(rows: DataFrame, sketched: DataFrame, threshold: float, scratch: common.Scratch) -> DataFrame:
    """(node, label) of the nodes that have a link."""
    nodes = sketched.where("n > 0").groupBy("node").agg(F.max("n").alias("n"), F.first("sketches").alias("sketches"))
    # a bucket row is a node, a size and a key, which depends on its sketch's number
    buckets = nodes.select("node", "n", F.explode("sketches").alias("key"))
    several = scratch.table(buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    live = scratch.table(buckets.join(bounded(several), "key"))
    met = live.groupBy("node").agg(F.max("n").alias("n"), F.sum("size").alias("meets"))
    met = scratch.table(met)
    texts = rows.select(digest("text").alias("node"), "text").join(bounded(met).select("node"), "node", "left_semi")
    texts = scratch.table(texts.groupBy("node").agg(F.first("text").alias("text")))
    ranked = live.join(bounded(met).drop("n"), "node")
    leaders = ranked.groupBy("key").agg(F.max(F.struct("meets", "node", "n")).alias("l")).select("key", F.col("l.node").alias("leader"), F.col("l.n").alias("n1"))
    first = live.join(leaders, "key").where("node <> leader").where(F.least("n", "n1") >= least_shared("n", "n1", threshold))
    first = scratch.table(first.select("node", "leader").distinct())
    links = scratch.table(verify(first, texts, threshold))
    labels = components(links, scratch)

    marked = labelled(live, labels)
    open_keys = marked.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most").select("key")
    crowd = scratch.table(live.join(open_keys, "key", "left_semi").select("node").distinct())
    if crowd.isEmpty():
        return labels
    keys = prefix_keys(scratch.table(texts.join(bounded(crowd), "node", "left_semi")), threshold)
    keys = scratch.table(keys)
    known = first.select("node", "leader").union(first.select("leader", "node"))
    done = 0.0
    for share in SHARES if crowd.count() > ROUND_TEXTS else SHARES[-1:]:  # a pair of one component by then has no more to find
        turn = prefix_pairs(keys, labels, threshold, done, share).join(known, ["node", "leader"], "left_anti")
        links = scratch.table(links.union(verify(scratch.table(turn), texts, threshold)))
        labels = components(links, scratch)
        done = share
    return labels


def judged(documents: DataFrame, threshold: float, sketches: int, length: int, id_column: str, scratch: common.Scratch) -> DataFrame:
    """(id, node, class_id, chosen) of every row; chosen marks rows of the text that stands for the class."""
    rows = common.plain_names(documents, id_column, "text").toDF("id", "text")
    sketched = scratch.table(sketch(rows, sketches, length), keep=True)
    labels = linked_nodes(rows, sketched, threshold, scratch)
    copies = sketched.where("node is not null").groupBy("node").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("c"))
    grouped = copies.join(labels, "node", "left").where("c > 1 or label is not null").withColumn("label", F.coalesce("label", "node"))
    best = grouped.groupBy("label").agg(F.min("first").alias("class_id"), F.min(F.when(F.col("first").isNotNull(), F.struct("first", "node"))).alias("best"))
    classed = scratch.table(grouped.join(best, "label").select("node", "class_id", F.coalesce(F.col("best.node") == F.col("node"), F.lit(False)).alias("stands")), keep=True)
    scratch.close()
    joined = sketched.select("id", "node").join(bounded(classed), "node", "left")
    alone = F.col("stands").isNull()
    return joined.select("id", "node", F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"), (alone | (F.col("stands") & F.col("id").eqNullSafe(F.col("class_id")))).alias("chosen"))


def classes(documents: DataFrame, threshold: float = 0.8, sketches: int = 20, length: int = 3, id_column: str = "doc_id") -> DataFrame:
    """(id, class_id): class_id is the least id of the row's near-duplicate class."""
    with common.Scratch(documents.sparkSession) as scratch:
        found = judged(documents, threshold, sketches, length, id_column, scratch)
    return found.select(F.col("id").alias(id_column), "class_id")


def keep_one(documents: DataFrame, threshold: float = 0.8, id_column: str = "doc_id") -> DataFrame:
    """One row of each class: that of its least id (of rows that repeat id and text, one)."""
    with common.Scratch(documents.sparkSession) as scratch:
        found = judged(documents, threshold, 20, 3, id_column, scratch)
        name = F.col(f"`{id_column}`")
        gone = scratch.table(found.where("not chosen").select("id", "node").distinct(), keep=True)
        twice = scratch.table(found.where("chosen and node is not null").groupBy("id", "node").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("id", "node"), keep=True)

    def same(rows: DataFrame) -> Column:
        return name.eqNullSafe(rows["id"]) & digest("text").eqNullSafe(rows["node"])

    dropped = bounded(gone)
    kept = documents.join(dropped, same(dropped), "left_anti")
    if twice.isEmpty():
        return kept
    repeated = bounded(twice)
    others = [F.col(f"`{c}`") for c in documents.columns if c not in (id_column, "text")]
    one = kept.join(repeated, same(repeated), "left_semi").groupBy(name, "text").agg(F.min(F.struct(F.lit(0), *others)).alias("__least"))
    one = one.select(*[F.col(f"`{c}`") if c in (id_column, "text") else F.col("__least")[c].alias(c) for c in documents.columns])
    return kept.join(repeated, same(repeated), "left_anti").union(one)
