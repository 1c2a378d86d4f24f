"""MinHash near-duplicates with sequential Bayesian verification.

Documents with equal shingle sets form a class, told by 128 bits of the set; all further work is on one text per class.
Each class has ``BANDS`` bands of ``ROWS`` minimum hashes, and a sketch: its shingles fall into ``BINS`` bins, of which each
keeps a byte of the smallest. Classes that share a band are candidates. Their sketches are compared in batches of bins;
with m equal of n non-empty bins and a uniform prior, the chance of a similarity of ``t`` or more is that of at most m
hits in n + 1 trials of chance t, and a pair is dropped as soon as it is below ``MISS``. Also, every bin that differs
holds a shingle that only one of the sets has, so the differing bins bound the similarity from above; for short texts
this bound is nearly exact. What survives is verified on the full shingle sets, and links are joined to components.

A pair is compared in the first band it shares only. The members of a bucket are compared in blocks, a pair of blocks
at a time, so a bucket of any size is spread over tasks, and only survivors become rows. They do so in two rounds. In the
first, every block meets one block of its bucket, and a unit of work gives a forest of its most similar survivors: work
and rows follow the members. Their verified links join most of a group. The second round is complete: it takes all
survivors between different components, so every pair that could join two of them is verified. Members of a bucket's
largest component do not meet each other there, so a large group of mutually similar texts costs work by its size, not
by its square. Exact verification works in blocks as well, bounded by classes and by shingles: a set is sent once
per pair of blocks, not once per pair, and a unit returns a spanning forest of its links.

Texts are read four times: for the sets' hashes, for bands and sketches of one text per class, and in each round for the
sets of survivors; all but the first are told by a filter of fixed size. Nothing about single documents reaches the driver.

Defined results: texts without words and null texts have an empty set and no link; a text of fewer than five words has
one shingle, all its words; rows with one id are one node, whose links are those of all its texts; a null id counts as
the smallest. Shingles are told by 64 bits.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phonolake.llm import filters, words
from phonolake.llm.columns import pack, unpack
from phonolake.llm.registry import bound_batches, query, table
from phonolake.session import materialise

SHINGLE = 5
PERCENT = 85
BANDS, ROWS = 24, 5
BINS, BATCH = 1024, 128
MISS = 1e-5
BLOCK = 512
SET_BLOCK = 256
SET_SHINGLES = 1 << 20
PAIRS = 1 << 14
NO_ID = -(2**63)

_draw = np.random.default_rng(77)
_factors = _draw.integers(0, 2**62, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_shifts = _draw.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


class Sets:
    """Distinct shingles of each text, sorted: text ``docs[i]`` has ``hashes[first[i]:first[i + 1]]``."""

    def __init__(self, column: pa.Array) -> None:
        found = words.Words(*words.raw(column), words.LOWER)
        counts = found.counts()
        hashes, at = found.windows(SHINGLE)
        owner = found.owners()[at]
        few = [np.flatnonzero(counts == n) for n in range(1, SHINGLE)]
        parts = [words.sequence_hashes(found.hashes, found.first[:-1][rows], n + 1) for n, rows in enumerate(few)]
        hashes, owner = np.concatenate([hashes, *parts]), np.concatenate([owner, *few])
        order = np.argsort(hashes)
        order = order[np.argsort(owner[order].astype(np.uint16 if len(counts) < 1 << 16 else np.int64), kind="stable")]
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        self.hashes, self.owner = hashes[new], owner[new]
        self.sizes = np.bincount(self.owner, minlength=len(counts))
        self.docs = np.flatnonzero(self.sizes)
        self.first = (np.cumsum(self.sizes) - self.sizes)[self.docs]

    def identity(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent 64-bit hashes of each text's set, 0 for the empty set."""
        out = []
        for salt in (0x1234567, 0xFEDCBA9):
            sums = np.zeros(len(self.sizes), np.uint64)
            if len(self.docs):
                sums[self.docs] = np.add.reduceat(words.mix(self.hashes ^ np.uint64(salt)), self.first)
            out.append(words.signed(words.mix(sums)))
        return out[0], out[1]

    def keep(self, chosen: np.ndarray) -> None:
        """Forget the sets of texts that are not chosen (flags by text)."""
        stay = chosen[self.owner]
        self.hashes, self.owner = self.hashes[stay], self.owner[stay]
        self.sizes = np.where(chosen, self.sizes, 0)
        self.docs = np.flatnonzero(self.sizes)
        self.first = (np.cumsum(self.sizes) - self.sizes)[self.docs]

    def bands(self) -> np.ndarray:
        """Band hashes, a row per filled text."""
        out = np.zeros((len(self.docs), BANDS), np.uint64)
        for k in range(BANDS * ROWS):
            lowest = np.minimum.reduceat((self.hashes * _factors[k] + _shifts[k]) >> np.uint64(32), self.first)
            out[:, k // ROWS] = words.mix(out[:, k // ROWS] * words.BASE + lowest + np.uint64(1))
        return out

    def sketches(self) -> np.ndarray:
        """A byte per bin, 0 for an empty bin, a row per filled text."""
        place = np.repeat(np.arange(len(self.docs)), self.sizes[self.docs])
        out = np.zeros(len(self.docs) * BINS, np.uint8)
        at = place * BINS + (self.hashes & np.uint64(BINS - 1)).astype(np.int64)
        value = (words.mix(self.hashes) % np.uint64(255)).astype(np.uint8) + np.uint8(1)
        out[at[::-1]] = value[::-1]  # hashes rise, so the smallest of a bin is written last
        return out.reshape(-1, BINS)


@functools.cache
def least_equal(percent: int = PERCENT, miss: float = MISS) -> np.ndarray:
    """Per number n of bins the fewest equal ones that a pair may have and stay."""
    t = percent / 100
    out = np.zeros(BINS + 1, np.int64)
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, BINS + 2)))])
    for n in range(BINS + 1):
        m = np.arange(n + 2)
        chance = np.exp(logs[n + 1] - logs[m] - logs[n + 1 - m] + m * np.log(t) + (n + 1 - m) * np.log1p(-t))
        out[n] = np.searchsorted(np.cumsum(chance), miss)
    return out


def survivors(
    left: np.ndarray, right: np.ndarray, sketches: np.ndarray, sizes: np.ndarray, percent: int = PERCENT
) -> tuple[np.ndarray, np.ndarray]:
    """Which of the pairs of rows pass all batches, and the share of their bins that are equal.

    With s shingles in both sets together and d in only one, the similarity is (s - d) / (s + d).
    """
    need = least_equal(percent)
    alive = np.arange(len(left))
    equal, filled = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
    total = sizes[left] + sizes[right]
    most = total * (100 - percent) // (100 + percent)
    alive = alive[np.abs(sizes[left] - sizes[right]) <= most]
    for start in range(0, BINS, BATCH):
        a = sketches[left[alive], start : start + BATCH]
        b = sketches[right[alive], start : start + BATCH]
        some = (a | b) > 0
        equal[alive] += ((a == b) & some).sum(1)
        filled[alive] += some.sum(1)
        alive = alive[equal[alive] >= need[filled[alive]]]
        alive = alive[filled[alive] - equal[alive] <= most[alive]]
    return alive, equal[alive] / np.maximum(filled[alive], 1)


def row_key(c1, doc_id):
    """64 bits of a set and its id, the same in numpy and in Spark; as even as the set's hash."""
    if isinstance(c1, np.ndarray):
        return c1 ^ (doc_id << np.int64(20)) ^ doc_id
    return c1.bitwiseXOR(F.shiftleft(doc_id, 20)).bitwiseXOR(doc_id)


def _sets_of(batches):
    for batch in words.slices(batches, "text"):
        sets = Sets(batch.column("text"))
        c1, c2 = sets.identity()
        columns = [batch["doc_id"], batch["copy"], pa.array(sets.sizes, pa.int64()), pa.array(c1), pa.array(c2)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "copy", "n_shingles", "c1", "c2"])


def _chosen(batch: pa.RecordBatch, wanted: np.ndarray) -> tuple[Sets, np.ndarray, np.ndarray]:
    """Sets of the rows that the filter may hold, with the ids and keys of all rows."""
    sets = Sets(batch.column("text"))
    ids = batch["doc_id"].to_numpy(zero_copy_only=False)
    keys = row_key(sets.identity()[0], ids)
    sets.keep(filters.contains(wanted, keys.view(np.uint64)))
    return sets, ids, keys


def _signatures(shared):
    def run(batches):
        for batch in words.slices(batches, "text"):
            sets, ids, keys = _chosen(batch, shared.value)
            if len(sets.docs):
                bands = sets.bands()
                at = np.arange(len(bands) + 1, dtype=np.int32) * BANDS
                listed = pa.ListArray.from_arrays(pa.array(at), pa.array(words.signed(bands.ravel())))
                sketch = words.binary_array(sets.sketches().ravel(), np.full(len(bands), BINS))
                sizes = pa.array(sets.sizes[sets.docs], pa.int64())
                columns = [pa.array(ids[sets.docs]), pa.array(keys[sets.docs]), sizes, listed, sketch]
                yield pa.RecordBatch.from_arrays(columns, ["cls", "key", "size", "bands", "sketch"])

    return run


def _full_sets(shared):
    def run(batches):
        for batch in words.slices(batches, "text"):
            sets, ids, keys = _chosen(batch, shared.value)
            body = words.binary_array(sets.hashes, sets.sizes[sets.docs])
            columns = [pa.array(ids[sets.docs]), pa.array(keys[sets.docs]), body]
            yield pa.RecordBatch.from_arrays(columns, ["cls", "key", "body"])

    return run


def _groups(batches, names: list[str]):
    """Rows of one group at a time, as tables; the rows come sorted by the columns ``names``."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.stack([batch[n].to_numpy(zero_copy_only=False).astype(np.int64) for n in names], 1)
        cuts = np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1
        for start, stop in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            mark = tuple(marks[start])
            if held and mark != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
            last = mark
    if held:
        yield pa.Table.from_batches(held)
    del held
    words.release()


def _fixed(column: pa.ChunkedArray, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


class Forest:
    """Union-find over small numbers."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _compare(percent: int, sparse: bool):
    """Survivors between components among the members of each unit (band, bucket, low block, high block).

    ``sparse`` takes a forest of each unit only, the most similar pairs first.
    """

    def run(batches):
        pairs: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
        for unit in _groups(batches, ["band", "bucket", "low", "high"]):
            ids, parts, sizes = (unit[c].to_numpy() for c in ("cls", "component", "size"))
            sketches = _fixed(unit["sketch"], np.uint8, BINS)
            bands = np.array(unit["bands"].combine_chunks().flatten()).reshape(-1, BANDS)
            band = int(unit["band"][0].as_py())
            if unit["low"][0].as_py() == unit["high"][0].as_py():
                a, b = np.triu_indices(len(ids), 1)
            else:
                side = unit["side"].to_numpy()
                a, b = (x.ravel() for x in np.meshgrid(np.flatnonzero(side == 0), np.flatnonzero(side == 1)))
            found, scores = [np.zeros((0, 2), np.int64)], [np.zeros(0)]
            for start in range(0, len(a), PAIRS):
                left, right = a[start : start + PAIRS], b[start : start + PAIRS]
                apart = parts[left] != parts[right]
                left, right = left[apart], right[apart]
                stay, share = survivors(left, right, sketches, sizes, percent)
                left, right = left[stay], right[stay]
                stay = ~(bands[left, :band] == bands[right, :band]).any(1) & (ids[left] != ids[right])
                found.append(np.stack([left[stay], right[stay]], 1))
                scores.append(share[stay])
            chosen = np.concatenate(found)
            if sparse and len(chosen) >= len(ids):
                forest = Forest(len(ids))
                order = np.argsort(-np.concatenate(scores), kind="stable")
                chosen = np.array([p for p in chosen[order].tolist() if forest.join(*p)])
            pairs.append(np.sort(ids[chosen], 1))
        found = np.concatenate(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], ["a", "b"])

    return run


def _verify(percent: int):
    """The links of each unit, joined within it: every linked id with the smallest one (a, b).

    The rows of a unit are sets (a, body) and pairs (a, b).
    """

    def run(batches):
        links: list[tuple[int, int]] = []
        for unit in _groups(batches, ["unit"]):
            is_set = unit["b"].is_null().to_numpy()
            holders = unit.filter(pa.array(is_set))
            ids = holders["a"].to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in holders["body"].to_pylist()]
            if not sets:
                continue
            sizes = np.array([len(s) for s in sets])
            first = np.cumsum(sizes) - sizes
            # Shingles by number, so that one set is marked and many are counted against it.
            _, number = np.unique(np.concatenate(sets), return_inverse=True)
            mark = np.zeros(number.max() + 1, bool)
            rows_of: dict[int, list[int]] = {}
            for i, x in enumerate(ids.tolist()):
                rows_of.setdefault(x, []).append(i)
            pairs = unit.filter(pa.array(~is_set))
            partners: dict[int, list[int]] = {}
            for x, y in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist(), strict=True):
                partners.setdefault(x, []).append(y)
            forest = Forest(len(ids))
            for x, others in partners.items():
                for i in rows_of.get(x, ()):
                    own = number[first[i] : first[i] + sizes[i]]
                    mark[own] = True
                    for y in others:
                        for j in rows_of.get(y, ()):
                            if forest.root(i) != forest.root(j):
                                common = int(mark[number[first[j] : first[j] + sizes[j]]].sum())
                                if 100 * common >= percent * (sizes[i] + sizes[j] - common):
                                    forest.join(i, j)
                    mark[own] = False
            roots = np.array([forest.root(i) for i in range(len(ids))])
            least = np.full(len(ids), np.iinfo(np.int64).max)
            np.minimum.at(least, roots, ids)
            moved = ids != least[roots]
            links += zip(ids[moved].tolist(), least[roots][moved].tolist(), strict=True)
        columns = list(zip(*links, strict=True)) or [[], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    return run


def _candidates(signatures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of buckets with others (cls, band, bucket, members, hub), and per class an approximate group."""
    each = signatures.select("cls", F.posexplode("bands").alias("band", "bucket"))
    same = ["band", "bucket"]
    buckets = each.groupBy(*same).agg(
        F.count("*").alias("members"), F.min("cls").alias("hub"), F.bit_xor(F.xxhash64("cls")).alias("content")
    )
    buckets = buckets.where("members > 1")
    # Bands that hold the same members need one comparison; the first band has it.
    firsts = buckets.groupBy("members", "hub", "content").agg(F.min(F.struct(*same)).alias("first"))
    kept = firsts.select("first.band", "first.bucket", "members", "hub")
    members = materialise(each.join(kept, same))
    groups = members.groupBy("cls").agg(F.min("hub").alias("hub"))
    return members, groups


def _units(rows: DataFrame, own, others, *more: str) -> DataFrame:
    """Each member in a unit of work for its block ``own`` and each of ``others``."""
    rows = rows.withColumn("own", own).withColumn("other", F.explode(others))
    return rows.select(
        "cls", *more, "band", "bucket",
        F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
    )


def _few(members: DataFrame) -> DataFrame:
    """Units of the first round: every block of a bucket meets the first block only, so work follows the members."""
    rows = members.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    own = F.expr("pmod(xxhash64(cls, 3), blocks)").cast("int")
    return _units(rows, own, F.expr("if(own = 0, sequence(0, blocks - 1), array(0))"))


def _between(members: DataFrame) -> DataFrame:
    """Units of the second round, members with their ``component``: all pairs between different components.

    Members of a bucket's largest component have blocks of their own, which meet the blocks of the others but not each
    other. Buckets within one component have no units.
    """
    same = ["band", "bucket"]
    sizes = members.groupBy(*same, "component").agg(F.count("*").alias("n"))
    found = sizes.groupBy(*same).agg(
        F.max_by("component", F.struct("n", "component")).alias("major"), F.max("n").alias("most"),
        F.sum("n").alias("all"), F.count("*").alias("different"),
    )
    # Written, so that the join deals both sides itself and Spark can split a large bucket.
    found = materialise(found.where("different > 1").drop("different"))
    rows = members.join(found, same)
    rows = rows.withColumn("apart", (F.col("component") == F.col("major")) & (F.col("all") > BLOCK))
    others = F.when(F.col("all") > BLOCK, F.col("all") - F.col("most")).otherwise(F.col("all"))
    rows = rows.withColumns({
        "rest": F.ceil(others / BLOCK).cast("int"),
        "own_blocks": F.when(F.col("all") > BLOCK, F.ceil(F.col("most") / BLOCK)).otherwise(0).cast("int"),
    })
    own = F.expr("cast(if(apart, rest + pmod(xxhash64(cls, 3), own_blocks), pmod(xxhash64(cls, 3), rest)) as int)")
    return _units(rows, own, F.expr("sequence(0, rest - 1 + if(apart, 0, own_blocks))"), "component")


def similar_pairs(members: DataFrame, signatures: DataFrame, percent: int, joined: DataFrame | None) -> DataFrame:
    """Pairs of classes that the sketches do not rule out (a, b), between the components ``joined`` (node, component).

    Without components each class is its own, a bucket's members meet a block of them only, and a unit's pairs are
    thinned to a forest.
    """
    wide = signatures.select("cls", "size", "bands", "sketch")
    if joined is None:
        work, wide = _few(members), wide.withColumn("component", F.col("cls"))
    else:
        parts = joined.select(F.col("node").alias("cls"), "component")
        work = members.join(parts, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        work = _between(work)
    unit = ["band", "bucket", "low", "high"]
    work = work.join(wide, "cls").repartition(*unit).sortWithinPartitions(*unit)
    return materialise(work.mapInArrow(_compare(percent, joined is None), "a long, b long").distinct())


def _blocks(groups: DataFrame, signatures: DataFrame) -> DataFrame:
    """Per class its block for verification: so many classes, and so many shingles or one class."""
    sized = groups.join(signatures.select("cls", "size"), "cls")
    most = F.greatest(F.count("*") / SET_BLOCK, F.sum("size") / SET_SHINGLES)
    sizes = materialise(sized.groupBy("hub").agg(F.ceil(most).alias("blocks")))
    block = F.xxhash64("hub", F.expr("pmod(xxhash64(cls, 5), blocks)"))
    return groups.join(sizes, "hub").select("cls", block.alias("block"))


def links(texts: DataFrame, pairs: DataFrame, blocks: DataFrame, keys: DataFrame, percent: int) -> DataFrame:
    """Verified links (a, b) that join all similar classes; ``keys`` has cls and key."""
    spark = texts.sparkSession
    sides = [blocks.select(F.col("cls").alias(c), F.col("block").alias(f"block_{c}")) for c in ("a", "b")]
    placed = pairs.join(sides[0], "a").join(sides[1], "b")
    unit = F.xxhash64(F.least("block_a", "block_b"), F.greatest("block_a", "block_b"))
    placed = materialise(placed.select(unit.alias("unit"), "a", "b"))
    needed = placed.select("unit", F.explode(F.array("a", "b")).alias("cls")).distinct()
    ends = keys.join(needed.select("cls").distinct(), "cls", "left_semi")
    wanted = spark.sparkContext.broadcast(filters.build(ends, "key"))
    bodies = texts.mapInArrow(_full_sets(wanted), "cls long, key long, body binary")
    bodies = bodies.join(ends, ["cls", "key"], "left_semi").select("cls", "body")
    holders = needed.join(bodies, "cls").select("unit", F.col("cls").alias("a"), F.lit(None).cast("long").alias("b"), "body")
    rows = holders.unionByName(placed.withColumn("body", F.lit(None).cast("binary")))
    rows = rows.repartition("unit").sortWithinPartitions("unit")
    return rows.mapInArrow(_verify(percent), "a long, b long")


def components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """Smallest reachable id of every node of ``edges`` (a, b): (node, component).

    After a limited number of rounds it is a smaller id of the same component.

    Large-star and small-star in turn: each step hangs nodes onto the smallest neighbour by equi joins and minima, until
    every edge leads to its component's smallest node. Steps are written, so a lost executor repeats one step only.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = materialise(edges)
    checksum = (F.count("*"), F.bit_xor(F.xxhash64("u", "v")))
    seen = edges.agg(*checksum).first()
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = materialise(small.where("u <> v").distinct())
        state = edges.agg(*checksum).first()
        rounds = None if rounds is None else rounds - 1
        if state == seen or rounds == 0:
            break
        seen = state
    found = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    if rounds == 0:
        return found
    return found.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row of (doc_id, text): doc_id, copy (hash of its text), n_shingles, component_id."""
    spark = docs.sparkSession
    bound_batches(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    texts = docs.select(doc_id.alias("doc_id"), F.xxhash64(text).alias("copy"), text.alias("text"))
    rows = materialise(texts.mapInArrow(_sets_of, "doc_id long, copy long, n_shingles long, c1 long, c2 long"))
    filled = rows.where("n_shingles > 0")
    held = filled.groupBy("c1", "c2", "doc_id").agg(F.count("*").alias("times"))
    classes = materialise(held.groupBy("c1", "c2").agg(F.min("doc_id").alias("cls"), F.max("times").alias("times")))
    keys = classes.select("cls", row_key(F.col("c1"), F.col("cls")).alias("key"))
    wanted = spark.sparkContext.broadcast(filters.build(keys, "key"))
    schema = "cls long, key long, size long, bands array<long>, sketch binary"
    signatures = texts.mapInArrow(_signatures(wanted), schema).join(keys, ["cls", "key"], "left_semi")
    if not classes.where("times > 1").isEmpty():  # rows that repeat id and text
        signatures = signatures.dropDuplicates(["cls", "key"])
    signatures = materialise(signatures)
    members, groups = _candidates(signatures)
    blocks = materialise(_blocks(groups, signatures))
    pairs = similar_pairs(members, signatures, percent, None)
    edges = materialise(links(texts, pairs, blocks, keys, percent))
    rest = similar_pairs(members, signatures, percent, components(edges, 3)).join(pairs, ["a", "b"], "left_anti")
    edges = edges.unionByName(links(texts, rest, blocks, keys, percent))
    # A row's id hangs on its class, so ids that several classes share join them.
    shared = held.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("a"))
    if not shared.isEmpty():
        own = held.join(classes, ["c1", "c2"]).select(F.col("doc_id").alias("a"), F.col("cls").alias("b"))
        edges = edges.unionByName(own.join(shared, "a", "left_semi"))
    found = components(edges)
    joined = rows.join(classes.select("c1", "c2", "cls"), ["c1", "c2"], "left")
    joined = joined.join(found, F.coalesce("cls", "doc_id") == F.col("node"), "left")
    component = F.coalesce("component", "cls", "doc_id")
    return joined.select(
        F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"),
        "copy",
        "n_shingles",
        F.nullif(component, F.lit(NO_ID)).alias("component_id"),
    )


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` (doc_id, text and others) with one row of each component: that of its smallest id.

    Of rows that repeat this id, the text of the smallest hash stays, and one of equal rows.
    """
    found = near_duplicates(docs.select("doc_id", "text"), percent)
    found = materialise(found.withColumn("row", _row_hash("doc_id", "copy")))
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    held = found.groupBy("doc_id", "copy", "row").agg(F.max(stays.cast("int")).alias("stays"), F.count("*").alias("times"))
    best = held.groupBy("doc_id").agg(F.min("copy").alias("best"))
    best = best.select(F.col("doc_id").alias("_id"), "best")
    held = materialise(held.join(best, F.col("doc_id").eqNullSafe(F.col("_id"))))
    stays = (F.col("stays") == 1) & (F.col("copy") == F.col("best"))
    copy = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    packed = pack(docs, row=_row_hash(F.col("doc_id").cast("long"), copy), copy=copy)
    kept = filters.without(packed, held.where(~stays), "row", "copy")
    repeated = held.where(stays & (F.col("times") > 1))
    if not repeated.isEmpty():
        again = kept.join(repeated.select("row", "copy"), ["row", "copy"], "left_semi").dropDuplicates(["row", "copy"])
        kept = filters.without(kept, repeated, "row", "copy").unionByName(again.select(*kept.columns))
    return unpack(kept, docs.columns)


def _row_hash(doc_id, copy):
    return F.xxhash64(doc_id, copy)


@query("op6_bayes_minhash")
def op6_bayes_minhash(spark, sf_dir):
    """Components of documents linked by a similarity of 0.85 or more."""
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))
