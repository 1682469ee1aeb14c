"""Problem 4: near-duplicate texts of a collection too large to compare every pair.

Method: chosen-path join. Every text is the set of its word shingles, embedded as TOKENS min-wise tokens. A recursion
splits the sets: a node of the tree chooses two tokens' places by a hash of its path, and each set goes on to the two
children named by its tokens there, so sets meet in a leaf if they share all tokens chosen on the way. A leaf of at most
`limit` sets is brute-forced. In a larger one each set is compared with the leaf's average by sketches: a set near it
(NEAR of the threshold) is brute-forced against the leaf and taken out, as no split would part it from the others; the
rest is split further. So a family of near-identical sets is compared where it first stands together. The tree is grown from as many other roots as `repeats_for` a
pair at the threshold need to share a node of the deepest level with probability RECALL. All trees share one embedding,
so the estimate averages over how many of its tokens such a pair has in common. Pairs above it are found more often.
Candidates pass one-bit sketches, then the embedded sets, and last an exact check of the sets themselves.

Equal sets are one class throughout: only its least id is in the tree; pairs of copies are made at the end.
"""

from __future__ import annotations

import re
from html import unescape
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrand.llm.pages import key
from lodestrand.session import materialise, ship

TAG = re.compile(r"<!--.*?-->|</?[A-Za-z!][^<>]*>", re.S)
WORD = re.compile(r"[^\W_]+")
TOKENS = 128
RECALL, FIRST_DEPTH, STEP, MAX_DEPTH, LIMIT = 0.998, 2, 3, 13, 16
NEAR = 0.9  # a set whose mean similarity to its leaf is this share of the threshold is brute-forced against it
PATHS = 1 << 17  # paths that one slice of a batch grows to at most
SALT_ROWS = 1000  # rows of a leaf, or copies of a class, that one task pairs with the whole of it
MOST_REPEATS = 64  # for thresholds so low that no number of trees would reach the target
MEMO = 500_000
_rng = np.random.default_rng(20240607)
MULT = _rng.integers(1, 2**63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _rng.integers(0, 2**63, TOKENS, dtype=np.uint64)
BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)
DIGEST = "doc bigint, h1 bigint, h2 bigint, n int, sig binary, s1 bigint, s2 bigint"


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit words."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def recall(threshold: float, repeats: int, depth: int = MAX_DEPTH) -> float:
    """The probability that two sets of just this similarity share a node `depth` levels down in one of the trees."""
    miss = 0.0
    for same in range(TOKENS + 1):
        none = (TOKENS - same) * (TOKENS - same - 1) / (TOKENS * (TOKENS - 1))
        both = same * (same - 1) / (TOKENS * (TOKENS - 1))
        lost = 0.0  # from one node on: none of its two tokens agrees, or all that follows is lost
        for _ in range(depth):
            lost = none + (1 - none - both) * lost + both * lost * lost
        miss += comb(TOKENS, same) * threshold**same * (1 - threshold) ** (TOKENS - same) * lost**repeats
    return 1 - miss


def repeats_for(threshold: float, target: float = RECALL) -> int:
    """The fewest trees that reach the target recall at the threshold."""
    repeats = 1
    while recall(threshold, repeats) < target and repeats < MOST_REPEATS:
        repeats += 1
    return repeats


class Shingles:
    """Hashes of the word shingles of a text, sorted and distinct."""

    def __init__(self, size: int, min_words: int) -> None:
        self.size, self.min_words, self.memo = size, min_words, {}

    def of(self, text: str) -> np.ndarray | None:
        words = WORD.findall(unescape(TAG.sub(" ", text)).lower())
        if len(words) < max(self.min_words, self.size):
            return None
        memo, ids = self.memo, []
        if len(memo) > MEMO:
            memo.clear()
        for w in words:
            h = memo.get(w)
            if h is None:
                h = memo[w] = key(w) & (2**64 - 1)
            ids.append(h)
        x = np.array(ids, np.uint64)
        out = x[: len(x) - self.size + 1].copy()
        with np.errstate(over="ignore"):
            for i in range(1, self.size):
                out = mix(out) * np.uint64(3) + x[i : len(x) - self.size + 1 + i]
        return np.unique(mix(out))


def embed(shingles: np.ndarray) -> np.ndarray:
    """The min-wise tokens of a set, 32 bits each."""
    with np.errstate(over="ignore"):
        return ((shingles[None, :] * MULT[:, None] + ADD[:, None]) >> np.uint64(32)).min(1).astype(np.uint32)


def sketch(sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One bit of each token as two words, for a matrix of embedded sets."""
    bits = (mix(sig.astype(np.uint64) + np.arange(TOKENS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(63)).astype(np.uint64)
    return (bits[:, :64] * BITS).sum(1, dtype=np.uint64), (bits[:, 64:] * BITS).sum(1, dtype=np.uint64)


def children(sig: np.ndarray, row: np.ndarray, node: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """The nodes `levels` below: (row, node) of every path of the sets sig[row] from `node` on."""
    for _ in range(levels):
        a = mix(node ^ np.uint64(0xA5A5A5A5A5A5A5A5))
        first = (a % np.uint64(TOKENS)).astype(np.int64)
        second = (first + 1 + ((a >> np.uint64(32)) % np.uint64(TOKENS - 1)).astype(np.int64)) % TOKENS
        with np.errstate(over="ignore"):
            go = [mix(node * np.uint64(0x9E3779B97F4A7C15) + (sig[row, c].astype(np.uint64) << np.uint64(8)) + c.astype(np.uint64) + np.uint64(1)) for c in (first, second)]
        row, node = np.concatenate([row, row]), np.concatenate(go)
    return row, node


def _digest(size: int, min_words: int):
    def run(batches):
        make = Shingles(size, min_words)
        for batch in batches:
            docs, h1, h2, n, sigs = [], [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = make.of(text)
                if s is None:
                    continue
                d = xxhash.xxh3_128_digest(s.tobytes())
                docs.append(doc)
                h1.append(int.from_bytes(d[:8], "little", signed=True))
                h2.append(int.from_bytes(d[8:], "little", signed=True))
                n.append(len(s))
                sigs.append(embed(s))
            m = np.array(sigs, np.uint32).reshape(-1, TOKENS)
            s1, s2 = sketch(m)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(n, pa.int32()), pa.array([r.tobytes() for r in m], pa.binary()), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64))],
                ["doc", "h1", "h2", "n", "sig", "s1", "s2"],
            )

    return run


def _grow(repeats: int | None, levels: int):
    """repeats: start that many trees; None: go on from the nodes that the rows bring."""

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(n, TOKENS)
            if repeats is not None:
                row = np.repeat(np.arange(n), repeats)
                node = np.tile(mix(np.arange(1, repeats + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)), n)
            else:
                lists = batch.column(4)
                node = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                row = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
            step = max(1, PATHS >> levels)
            for at in range(0, len(row), step):
                r, below = children(sig, row[at : at + step], node[at : at + step], levels)
                take = pa.array(r)
                yield pa.RecordBatch.from_arrays([pa.array(below.view(np.int64)), *(batch.column(i).take(take) for i in (0, 2, 3))], ["leaf", "doc", "s1", "s2"])

    return run


def _sets(size: int, min_words: int):
    def run(batches):
        make = Shingles(size, min_words)
        for batch in batches:
            docs, sets = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = make.of(text)
                if s is not None:
                    docs.append(doc)
                    sets.append(s.view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]) if sets else np.zeros(1)
            flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64()))], ["doc", "shingles"])

    return run


def _agree(batches):
    """How many embedded tokens two sets share: (a, b, sig_a, sig_b) -> (a, b, same)."""
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(-1, TOKENS) for i in (2, 3))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array((a == b).sum(1).astype(np.int32))], ["a", "b", "same"])


def _bit(j: int) -> Column:
    return F.shiftrightunsigned("s1", j).bitwiseAND(F.lit(1))


class Join:
    """A chosen-path self-join. `classes`: (doc, rep, n) of every text that takes part; `links`: (a, b, jaccard), a < b, between representatives."""

    def __init__(self, docs: DataFrame, *, threshold: float, shingle: int, min_words: int, repeats: int, limit: int) -> None:
        """docs: (doc, text), ids unique. Texts that are NULL or have fewer than min_words words take no part."""
        self.spark, self.threshold, self.limit, self.repeats = docs.sparkSession, threshold, limit, repeats
        ship(self.spark)
        docs = docs.filter("text IS NOT NULL")
        digests = materialise(docs.mapInArrow(_digest(shingle, min_words), DIGEST), "p4-digests")
        rep = digests.groupBy("h1", "h2").agg(F.min("doc").alias("rep"))
        self.classes = digests.select("doc", "h1", "h2", "n").join(rep, ["h1", "h2"]).select("doc", "rep", "n")
        self.sets = digests.join(rep.select(F.col("rep").alias("doc")), "doc", "left_semi")
        self.links = materialise(self._verify(self._candidates(), docs, shingle, min_words), "p4-links")

    def _leaves(self) -> DataFrame:
        """(leaf, doc, s1, s2, probe, size) of the sets that share a leaf with another. Rows with probe are to be compared
        with all rows of the leaf: all rows of a small leaf or one of the deepest level, and in larger ones the sets near
        the average."""
        sets = materialise(self.sets.select("doc", "sig", "s1", "s2"), "p4-sets")
        schema = "leaf bigint, doc bigint, s1 bigint, s2 bigint"
        rows, depth, done = sets.mapInArrow(_grow(self.repeats, FIRST_DEPTH), schema), FIRST_DEPTH, []
        out_of = lambda df, probe: df.select("leaf", "doc", "s1", "s2", probe.alias("probe"), "size")
        every = F.lit(True)
        while True:
            sized = materialise(self._sized(rows), f"p4-leaves-{depth}", partition_by=["large"])
            done.append(out_of(sized.filter("NOT large"), every))
            large = sized.filter("large").drop("large")
            if large.isEmpty():
                break
            if depth >= MAX_DEPTH:
                done.append(out_of(large, every))
                break
            dense, rest = materialise(self._dense(large), f"p4-dense-{depth}"), large.select("leaf", "doc", "s1", "s2")
            if not dense.isEmpty():
                judged = materialise(self._judged(large, dense), f"p4-near-{depth}", partition_by=["near"])
                held = judged.filter("near").select("leaf").distinct()
                done.append(out_of(judged.join(held, "leaf", "left_semi"), F.col("near")))
                # What is left of a leaf is another one; where it is small by now it is not split further.
                left = judged.filter("NOT near").select(F.xxhash64("leaf", F.lit(depth)).alias("leaf"), "doc", "s1", "s2")
                left = materialise(self._sized(left), f"p4-rest-{depth}", partition_by=["large"])
                done.append(out_of(left.filter("NOT large"), every))
                rest = rest.join(dense.select("leaf"), "leaf", "left_anti").unionByName(left.filter("large").select(*rest.columns))
            step = min(STEP, MAX_DEPTH - depth)
            again = rest.groupBy("doc").agg(F.collect_list("leaf").alias("leaves"))  # bounded: repeats * 2 ** depth
            rows, depth = sets.join(again, "doc").select("doc", "sig", "s1", "s2", "leaves").mapInArrow(_grow(None, step), schema), depth + step
        out = done[0]
        for d in done[1:]:
            out = out.unionByName(d)
        return out

    def _sized(self, rows: DataFrame) -> DataFrame:
        """rows with the size of their leaf and whether it is large; those alone in a leaf are left out."""
        rows = rows.repartition("leaf")  # one shuffle for the sizes and the join, as the rows have to go there anyway
        sizes = rows.groupBy("leaf").agg(F.count("*").alias("size")).filter("size > 1")
        return rows.join(sizes, "leaf").withColumn("large", F.col("size") > self.limit)

    def _dense(self, large: DataFrame) -> DataFrame:
        """(leaf, c0 .. c63) of the leaves whose mean similarity is such that sets near their average make up a good part
        of them: a share f of near-identical sets gives f ** 2. The c are the leaf's counts of each bit of the sketches,
        which combine before they shuffle; of n sets c ** 2 + (n - c) ** 2 ordered pairs agree in a bit."""
        ones = large.groupBy("leaf").agg(F.max("size").alias("n"), *(F.sum(_bit(j)).alias(f"c{j}") for j in range(64)))
        n = F.col("n").cast("double")
        agree = sum((F.col(f"c{j}") * F.col(f"c{j}").cast("double") + (n - F.col(f"c{j}")) * (n - F.col(f"c{j}")) for j in range(64)), F.lit(0.0))
        mean = 2 * (agree - 64 * n) / (64 * n * (n - 1)) - 1
        return ones.filter(mean >= (NEAR * self.threshold) ** 2).drop("n")

    def _judged(self, large: DataFrame, dense: DataFrame) -> DataFrame:
        """The rows of dense leaves with `near`: whether a set's mean similarity to the others of its leaf is NEAR of the
        threshold; two sets' bits agree by (1 + J) / 2."""
        n = F.col("size")
        same = sum((F.when(_bit(j) == 1, F.col(f"c{j}")).otherwise(n - F.col(f"c{j}")) for j in range(64)), F.lit(0))
        mean = 2 * ((same - 64) / (64 * (n - 1))) - 1  # without the set itself
        return large.join(dense, "leaf").select("leaf", "doc", "s1", "s2", "size", (mean >= NEAR * self.threshold).alias("near"))

    def _candidates(self) -> DataFrame:
        """(a, b, same): distinct pairs of a leaf that pass the sketches, with their shared tokens."""
        rows = self._leaves()
        # A leaf of many rows is spread: its probes go to several tasks, and all its rows to each of these.
        rows, parts = rows.withColumn("parts", F.ceil(F.col("size") / SALT_ROWS).cast("int")), F.col("parts")
        probes = rows.filter("probe").select("leaf", F.pmod(F.xxhash64("doc"), parts).cast("int").alias("salt"), F.col("doc").alias("a"), "s1", "s2")
        other = rows.select("leaf", F.explode(F.sequence(F.lit(0), parts - 1)).alias("salt"), F.col("doc").alias("b"), F.col("s1").alias("t1"), F.col("s2").alias("t2"), F.col("probe").alias("back"))
        # A bit agrees with probability (1 + J) / 2; four standard deviations are allowed below that.
        p = (1 + self.threshold) / 2
        most = int(TOKENS * (1 - p) + 4 * (TOKENS * p * (1 - p)) ** 0.5)
        differ = F.bit_count(F.col("s1").bitwiseXOR(F.col("t1"))) + F.bit_count(F.col("s2").bitwiseXOR(F.col("t2")))
        once = F.when(F.col("back"), F.col("a") < F.col("b")).otherwise(F.col("a") != F.col("b"))  # of two probes one asks
        met = probes.join(other, ["leaf", "salt"]).filter(once & (differ <= most))
        pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        sig = self.sets.select("doc", "sig")
        both = pairs.join(sig.select(F.col("doc").alias("a"), F.col("sig").alias("sig_a")), "a").join(sig.select(F.col("doc").alias("b"), F.col("sig").alias("sig_b")), "b")
        same = both.select("a", "b", "sig_a", "sig_b").mapInArrow(_agree, "a bigint, b bigint, same int")
        least = int(TOKENS * self.threshold - 4.5 * (TOKENS * self.threshold * (1 - self.threshold)) ** 0.5)
        return materialise(same.filter(F.col("same") >= least).select("a", "b"), "p4-candidates")

    def _verify(self, pairs: DataFrame, docs: DataFrame, shingle: int, min_words: int) -> DataFrame:
        """The exact check, on the sets of the texts that are in a candidate pair."""
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
        sets = materialise(docs.join(wanted, "doc", "left_semi").mapInArrow(_sets(shingle, min_words), "doc bigint, shingles array<bigint>"), "p4-shingles")
        side = lambda name: sets.select(F.col("doc").alias(name), F.col("shingles").alias(f"set_{name}"))
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        inter = F.size(F.array_intersect("set_a", "set_b"))
        union = F.size("set_a") + F.size("set_b") - inter
        # A fraction of whole numbers: compared without rounding.
        return both.select("a", "b", inter.alias("i"), union.alias("u")).filter(F.col("i") >= F.lit(self.threshold) * F.col("u") - 1e-9).select("a", "b", (F.col("i") / F.col("u")).alias("jaccard"))

    def pairs(self) -> DataFrame:
        """(a, b), a < b, of all texts, copies included. Its size is that of the answer: quadratic in a class of copies."""
        members = self.classes.select("doc", "rep")
        sizes = members.groupBy("rep").agg(F.ceil(F.count("*") / SALT_ROWS).cast("int").alias("parts"), F.count("*").alias("n")).filter("n > 1").select(F.col("rep").alias("r"), "parts")
        left = members.select(F.col("doc").alias("x"), F.col("rep").alias("a"))
        right = members.select(F.col("doc").alias("y"), F.col("rep").alias("b"))
        across = self.links.join(left, "a").join(right, "b").select("x", "y")
        salted = left.withColumnRenamed("a", "r").join(sizes, "r").withColumn("salt", F.pmod(F.xxhash64("x"), F.col("parts")).cast("int"))
        copied = right.withColumnRenamed("b", "r").join(sizes, "r").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        within = salted.join(copied.select("r", "salt", "y"), ["r", "salt"]).filter("x < y").select("x", "y")
        return across.unionByName(within).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))

    def groups(self) -> DataFrame:
        """(doc, rep, group_id, links): a row for each text that takes part: its class of equal sets, its group (the least
        id that a chain of links reaches) and the number of classes its class is linked to."""
        edges = materialise(self.links.select("a", "b").unionByName(self.links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "p4-edges")
        label = materialise(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("g")).select(F.col("a").alias("doc"), "g"), "p4-labels")
        while True:  # each round a label jumps over a neighbour and then to its own label's label
            near = edges.join(label.select(F.col("doc").alias("b"), "g"), "b").groupBy(F.col("a").alias("doc")).agg(F.min("g").alias("m"))
            step = label.join(near, "doc").select("doc", "g", F.least("g", "m").alias("m"))
            jump = step.join(label.select(F.col("doc").alias("m"), F.col("g").alias("gg")), "m", "left").select("doc", "g", F.least("m", F.coalesce("gg", "m")).alias("m"))
            new = materialise(jump, "p4-labels")
            changed = not new.filter("m < g").isEmpty()
            label = new.select("doc", F.col("m").alias("g"))
            if not changed:
                break
        degree = edges.groupBy("a").agg(F.count("*").alias("links"))
        known = self.classes.join(label.withColumnRenamed("doc", "rep"), "rep", "left").join(degree.withColumnRenamed("a", "rep"), "rep", "left")
        return known.select("doc", "rep", F.coalesce("g", "rep").alias("group_id"), F.coalesce("links", F.lit(0)).cast("bigint").alias("links"))


def join_texts(
    items: DataFrame, *, threshold: float = 0.6, shingle: int = 3, min_words: int = 200, repeats: int | None = None, limit: int = LIMIT, item: str = "item_id", text: str = "content_text"
) -> Join:
    """The join over a table with unique ids. NULL ids or texts take no part; other columns are ignored; an empty table
    gives empty results. Words are runs of letters and digits of the lower-cased text without tags, references resolved. repeats: the number of trees, by default what RECALL needs."""
    docs = items.select(F.col(item).cast("bigint").alias("doc"), F.col(text).cast("string").alias("text")).filter("doc IS NOT NULL")
    return Join(docs, threshold=threshold, shingle=shingle, min_words=min_words, repeats=repeats or repeats_for(threshold), limit=limit)
