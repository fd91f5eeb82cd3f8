"""N-gram Jaccard join by a MinHash LSH forest with exact verification."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_columns, materialize, mix64, shingle_hashes, tidy, word_hashes


def shortest_prefix(similarity: float, trees: int, recall: float, longest: int) -> int:
    """The greatest depth up to ``longest`` at which a pair of that very similarity meets in some tree with chance ``recall``.

    Prefixes never need to be shorter, whatever the data hold.
    """
    for depth in range(longest, 1, -1):
        if 1 - (1 - similarity**depth) ** trees >= recall:
            return depth
    return 1


def shingles(text: str | None, width: int) -> np.ndarray:
    """The distinct shingles of a whole text as sorted hashes; a text of fewer words is one shingle, one of none has none."""
    return np.unique(shingle_hashes(word_hashes(text), width))


class Forest:
    """Signatures: for each of ``trees`` trees a path of ``longest`` steps, each step two bytes of a min-hash.

    Steps are stored with the high byte first, so that paths sorted as bytes are a trie. Min-hashes are of 32 bits; in
    sets of many millions of shingles they collide more often, which only costs verification.
    """

    def __init__(self, trees: int, longest: int, seed: int):
        rng = np.random.default_rng(seed)
        self.trees, self.longest = trees, longest
        self.a = rng.integers(0, 2**31, trees * longest, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = rng.integers(0, 2**32, trees * longest, dtype=np.uint32)

    def signature(self, sets: np.ndarray) -> np.ndarray:
        low, x = np.full(len(self.a), np.iinfo(np.uint32).max, np.uint32), (sets ^ (sets >> np.uint64(32))).astype(np.uint32)
        for at in range(0, len(x), 1024):
            h = x[at : at + 1024, None] * self.a
            h += self.b
            np.minimum(low, h.min(0), out=low)
        return (mix64(low) >> np.uint64(48)).astype(">u2").reshape(self.trees, self.longest)

    def read(self, signatures: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(signatures), ">u2").astype(np.uint16).reshape(-1, self.trees, self.longest)


def nodes(paths: np.ndarray, depth: int) -> np.ndarray:
    """For each member and tree, the node at ``depth`` that its path goes through, as a hash."""
    label = np.zeros(paths.shape[:2], np.uint64)
    for k in range(depth):
        label = mix64(label ^ paths[:, :, k])
    return label


def coded(labels: np.ndarray) -> np.ndarray:
    """Labels, a row for each tree; of many members, as places among the tree's distinct ones, in narrow integers, which
    compare faster."""
    if len(labels) < 128:
        return labels.T
    small = np.uint16 if len(labels) < 1 << 16 else np.uint32
    return np.stack([np.unique(c, return_inverse=True)[1].astype(small) for c in labels.T])


def sides(block: np.ndarray, cross: bool) -> tuple[np.ndarray, np.ndarray]:
    """The members whose pairs a unit looks at: those of one block with those of the other, or all with all."""
    every = np.arange(len(block))
    return (every[block == block.min()], every[block != block.min()]) if cross else (every, every)


def new_pairs(paths: np.ndarray, block: np.ndarray, tree: int, depth: int, cross: bool) -> np.ndarray:
    """Which pairs (of the two ``sides``; upper triangle if they are the same) meet in this unit first: no longer prefix
    and no earlier tree brings them together."""
    left, right = sides(block, cross)
    here = coded(nodes(paths, depth))
    new = here[tree][left, None] == here[tree][None, right]
    if not cross:
        new = np.triu(new, 1)
    apart = list(here[:tree])
    if depth < paths.shape[2]:
        apart += list(coded(nodes(paths, depth + 1)))
    for p in apart:
        if not new.any():
            break
        new &= p[left, None] != p[None, right]
    return new


def met(paths: np.ndarray, block: np.ndarray, tree: int, depth: int, cross: bool) -> np.ndarray:
    """The pairs of ``new_pairs`` as places of members, a row for each."""
    left, right = sides(block, cross)
    i, j = np.nonzero(new_pairs(paths, block, tree, depth, cross))
    return np.stack([left[i], right[j]], 1)


#: Steps in which similarities between the threshold and 1 are counted.
BINS = 40


def similarity_counts(paths: np.ndarray, pairs: np.ndarray, similarity: float) -> np.ndarray:
    """How many of the pairs seem to be links, by similarity from the threshold (bin 0) to 1.

    A pair's similarity is the share of equal steps less its standard error. Pairs up to two standard errors below the
    threshold count as being at it.
    """
    flat, counts = paths.reshape(len(paths), -1), np.zeros(BINS + 1, np.int64)
    for at in range(0, len(pairs), 8192):
        i, j = pairs[at : at + 8192].T
        s = (flat[i] == flat[j]).mean(1)
        s = s - np.sqrt(s * (1 - s) / flat.shape[1])
        s = s[s >= similarity - 3 * np.sqrt(similarity * (1 - similarity) / flat.shape[1])]
        counts += np.bincount(np.maximum((s - similarity) / (1 - similarity) * BINS, 0).astype(int), minlength=BINS + 1)
    return counts


def expected_recall(counts: np.ndarray, depth: int, similarity: float, trees: int) -> float:
    """The share of the links that prefixes of at least ``depth`` hashes have met, going by those met: links of
    similarity s meet with chance p = 1 - (1 - s^depth)^trees, so that each stands for 1 / p. 0 if none has been met."""
    s = similarity + (1 - similarity) * np.arange(BINS + 1) / BINS
    return float(counts.sum() / max((counts / (1 - (1 - s**depth) ** trees)).sum(), 1))


def common_counts(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the given pairs."""
    if len(pairs) <= 4 * len(sets) + 64:
        return np.array([len(a) + len(b) - len(np.unique(np.concatenate([a, b]))) for a, b in ((sets[i], sets[j]) for i, j in pairs)], np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, term, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner, term = owner[df[term] > 1], term[df[term] > 1]  # a shingle of one set is in no intersection
    _, term = np.unique(term, return_inverse=True)
    by = np.argsort(term, kind="stable")
    owner, term, step = owner[by], term[by], max(1024, 4_000_000 // len(sets))
    total = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(term.max(initial=-1)) + 1, step):
        a, b = np.searchsorted(term, (at, at + step))
        x = np.zeros((len(sets), step), np.float32)
        x[owner[a:b], term[a:b] - at] = 1
        total += x @ x.T
    return total[pairs[:, 0], pairs[:, 1]].astype(np.int64)


def verify(texts: list[str], paths: np.ndarray, block: np.ndarray, tree: int, depth: int, cross: bool, weight: np.ndarray, width: int, similarity: float):
    """(linked, links, root): members with links here, the documents each is linked to, and the member its links lead to."""
    sets = [shingles(t, width) for t in texts]
    size = np.array([len(s) for s in sets])
    pairs = met(paths, block, tree, depth, cross)
    small, large = np.minimum(size[pairs[:, 0]], size[pairs[:, 1]]), np.maximum(size[pairs[:, 0]], size[pairs[:, 1]])
    pairs = pairs[small >= similarity * large - 1e-9]
    if not len(pairs):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, int)
    both = common_counts(sets, pairs)
    pairs = pairs[both >= similarity * (size[pairs].sum(1) - both) - 1e-9]
    i, j = pairs.T
    links = np.bincount(i, weight[j], len(sets)) + np.bincount(j, weight[i], len(sets))
    root = np.arange(len(sets))
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            break
        root = low
    linked = np.flatnonzero(links)
    return linked, links[linked].astype(np.int64), root[linked]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b): the same root for connected nodes.

    Every node moves to the least of itself and its neighbours and edges follow, until none is left. Nodes are digests,
    so that their order is random and rounds are few (logarithmic in expectation). Each round's tables are written to
    the shared folder.
    """
    edges = materialize(edges.where("a <> b").select("a", "b").distinct(), "edges")
    moves = []
    while not edges.isEmpty():
        ways = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        move = materialize(ways.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("to")), "moves")
        moves.append(move)
        ends = edges.join(move.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").join(move.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        edges = materialize(ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = moves[0].select("node", F.col("to").alias("root"))
    for move in moves[1:]:
        found = found.join(move.select(F.col("node").alias("root"), "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return found


def near_copies(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = 5, similarity: float = 0.8, recall: float = 0.9999,
    trees: int = 20, longest: int = 8, block: int = 512, block_bytes: int = 16 << 20, seed: int = 10,
) -> DataFrame:
    """One row for each document: key, copy_id, class_id and n_links (and digests of its text, fp, and of its class, root).

    Two documents are linked if the Jaccard similarity of their sets of ``width``-word shingles is ``similarity`` or
    more; class_id is the least key among all that links connect, copy_id the least key with the same text, and n_links
    the number of other documents linked to this one (copies included).

    Equal texts form one copy class, and only classes go on. Each has a path of ``longest`` min-hashes in each of
    ``trees`` tries, which are the sorted paths. Matched prefixes begin at ``longest`` hashes: members of one trie node of
    that depth are candidates. Then they are shortened by one hash at a time, and the members of a node that come from
    different children are candidates too, until the candidates' signatures say that ``recall`` of the links has been met
    (``expected_recall``), or a depth is reached at which even pairs at the threshold meet with that chance.

    The members of a node are compared in units of at most two blocks of about ``block`` members and
    ``block_bytes`` bytes of text, so that no task gathers a large node and no node is cut off. A pair is a candidate at its longest shared prefix and in the first tree
    with it only, and is verified exactly: units first drop members without such pairs, then texts are joined to what is
    left. Units return counts of links and a spanning forest, never pairs.

    Texts of any length are taken whole. Null and empty ones, and ones without words, have no shingles: they are linked to nothing, not even to each other,
    and are classes of their own with n_links 0. Texts of fewer than ``width`` words have one shingle, the whole. Null
    keys are kept and count as documents, but name a class only if no other key does. Repeated rows are copies. An empty
    table gives an empty result; extra columns are ignored.
    """
    docs = tidy(docs, [key, text]).select(key, text).withColumn("fp", F.unhex(F.md5(text))).withColumn("bytes", F.octet_length(text).cast("long"))
    forest, least = Forest(trees, longest, seed), shortest_prefix(similarity, trees, recall, longest)

    def sign(texts):
        known: dict[str, bytes | None] = {}
        for t in texts:
            if t not in known:
                s = shingles(t, width)
                known[t] = forest.signature(s).tobytes() if len(s) else None
        return [[known[t] for t in texts]]

    signed = materialize(map_columns(docs, [key, "fp", "bytes"], [text], "signature binary", sign), "signatures")
    classes = signed.where("signature is not null").groupBy("fp").agg(F.min(key).alias("copy_id"), F.count(F.lit(1)).alias("n"), F.min("signature").alias("signature"), F.min("bytes").alias("bytes"))
    classes = materialize(classes, "copy-classes")

    step, depths = 2, range(longest, least - 1, -1)
    paths = classes.select("fp", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "signature", "bytes")
    paths = paths.select("fp", "tree", "bytes", F.expr(f"substring(signature, tree * {step * longest} + 1, {step * longest})").alias("path"))

    def prefix(depth):
        return F.expr(f"substring(path, 1, {step * depth})")

    tries = paths.withColumn("low", prefix(least)).withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("tree", "low"))).where("m > 1")
    for d in depths:
        node = Window.partitionBy("tree", "low", prefix(d))
        n = F.count(F.lit(1)).over(node)
        blocks = F.greatest(F.ceil(n / block), F.ceil(F.sum("bytes").over(node) / block_bytes))
        # without a second child, a node brings no new pairs together
        fresh = n > 1 if d == longest else F.min(prefix(d + 1)).over(node) < F.max(prefix(d + 1)).over(node)
        tries = tries.withColumn(f"blocks{d}", F.when(fresh, blocks))
    tries = materialize(tries.drop("low", "m", "bytes").join(classes.select("fp", "signature"), "fp"), "tries")

    def prune(tree, depth, i, j, members):
        kept, similar = [], []
        for t, d, a, b, m in zip(tree, depth, i, j, members):
            some, counts = [], None
            if len(m) > 1:
                signatures = forest.read([x["signature"] for x in m])
                pairs = met(signatures, np.array([x["at"] for x in m]), t, d, a != b)
                counts = similarity_counts(signatures, pairs, similarity).tolist()
                some = [{"fp": m[x]["fp"], "at": m[x]["at"]} for x in np.unique(pairs)]
            kept.append(some)
            similar.append(counts)
        return [kept, similar]

    unit, levels, counted = ["depth", "tree", "node", "i", "j"], [], np.zeros(BINS + 1)
    for d in depths:
        members = tries.where(f"blocks{d} > 0").select("fp", "signature", "tree", prefix(d).alias("node"), F.col(f"blocks{d}").alias("blocks"), F.lit(d).alias("depth"))
        members = members.withColumn("at", F.pmod(F.xxhash64("fp"), F.col("blocks")))
        members = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        units = members.groupBy("depth", "tree", "node", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j")).agg(
            F.collect_list(F.struct("fp", "at", "signature")).alias("members"))
        level = map_columns(units, unit, ["tree", "depth", "i", "j", "members"], "kept array<struct<fp:binary,at:bigint>>, similar array<bigint>", prune)
        levels.append(materialize(level.where("size(kept) > 0"), "units"))
        for r in levels[-1].select(F.posexplode("similar").alias("bin", "n")).groupBy("bin").agg(F.sum("n").alias("n")).collect():  # a row for each bin
            counted[r["bin"]] += r["n"]
        if expected_recall(counted, d, similarity, trees) >= recall:
            break
    pruned = functools.reduce(DataFrame.unionByName, levels)
    pruned = pruned.select(*unit, F.explode("kept").alias("k")).select(*unit, "k.*")

    needed = pruned.select("fp").distinct().join(classes, "fp").select("fp", F.col("copy_id").alias("_id"), "n", "signature")
    found = docs.join(needed, (docs["fp"] == needed["fp"]) & docs[key].eqNullSafe(needed["_id"])).select(needed["fp"], text, "n", "signature")
    rows = pruned.join(found.dropDuplicates(["fp"]), "fp").select(*unit, "fp", "at", "n", "signature", text)
    rows = rows.repartition(*unit).sortWithinPartitions(*unit, "fp")
    schema = T.StructType([T.StructField("fp", T.BinaryType()), T.StructField("links", T.LongType()), T.StructField("root", T.BinaryType())])

    def check(batches):
        def close(group):
            if len(group) < 2:
                return None
            signatures, one = forest.read([r["signature"] for r in group]), group[0]
            at, n = np.array([r["at"] for r in group]), np.array([r["n"] for r in group])
            who, links, root = verify([r[text] for r in group], signatures, at, one["tree"], one["depth"], one["i"] != one["j"], n, width, similarity)
            if not len(who):
                return None
            return pa.RecordBatch.from_arrays(
                [pa.array([group[x]["fp"] for x in who], pa.binary()), pa.array(links, pa.int64()), pa.array([group[x]["fp"] for x in root], pa.binary())], names=schema.names)

        group, last = [], None
        for b in batches:
            for r in b.to_pylist():
                this = tuple(r[c] for c in unit)
                if this != last:
                    if (out := close(group)) is not None:
                        yield out
                    group, last = [], this
                group.append(r)
        if (out := close(group)) is not None:
            yield out

    linked = materialize(rows.mapInArrow(check, schema), "links")
    links = linked.groupBy("fp").agg(F.sum("links").alias("links"))
    roots = components(linked.select(F.col("fp").alias("a"), F.col("root").alias("b")))
    whole = classes.select("fp", "copy_id", "n").join(links, "fp", "left").join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    whole = materialize(whole.withColumn("root", F.coalesce("root", "fp")), "class-links")
    least = whole.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    whole = whole.join(least, "root").select("fp", "root", "copy_id", "class_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    alone = signed.where("signature is null").select(key, "fp", F.lit(None).cast("binary").alias("root"), F.col(key).alias("copy_id"), F.col(key).alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return signed.where("signature is not null").select(key, "fp").join(whole, "fp").select(key, "fp", "root", "copy_id", "class_id", "n_links").unionByName(alone)


def keep_documents(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each class of ``near_copies``: the one with the class's least key (of rows that repeat it, one).

    Documents without words are classes of their own and all stay.
    """
    docs = tidy(docs, [key, text], ["_fp", "_first", "_class", "_key"])
    found = near_copies(docs, key=key, text=text, **options)
    first = F.min(F.when(F.col(key).eqNullSafe(F.col("class_id")), F.struct(F.col(key).alias("key"), "fp"))).alias("first")
    chosen = found.where("root is not null").groupBy("root").agg(first).select(F.col("first.key").alias("_key"), F.col("first.fp").alias("_class"))
    rows = docs.withColumn("_fp", F.unhex(F.md5(text)))
    worded = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = rows.where(worded).join(chosen, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_fp") == F.col("_class")), "left_semi")
    one = Window.partitionBy(key, "_fp").orderBy(F.lit(1))
    kept = kept.withColumn("_first", F.row_number().over(one)).where("_first = 1").drop("_fp", "_first")
    return kept.unionByName(docs.where(~worded))
