"""Near-duplicate documents by BagMinHash over 5-word shingles, verified.

The bag of a text holds each window of five words with its count; a text of one
to four words has one shingle of all its words.  Two texts are linked if their
weighted Jaccard similarity, sum of minima over sum of maxima of the counts, is
0.8 or more.  A class is a connected component of links.

1. Texts with the same words in the same order are one node, named by their digest.
2. BagMinHash: over the strip (0, weight] of each shingle runs a Poisson process
   in time, made of independent processes over the levels (0,1], (1,2], (2,4],
   (4,8] ...; a level that the weight cuts is halved down to whole weights by the
   bits of the point's hash, and points above the weight are thinned out.  Each
   point falls into one of ``m`` registers, which keep their earliest point.  Two
   bags agree in a register with probability equal to their weighted Jaccard
   similarity.  Processes stop once they are later than the text's latest
   register, so a text costs about (shingles + m log m) steps, not their product.
3. ``BANDS`` bands of ``ROWS`` registers make buckets.  With 32 bands of 5 a pair
   at 0.8 misses all buckets with probability (1 - 0.8**5)**32 = 3e-6.
4. Hubs.  All members of a bucket are compared with one of them, the member with the most
   company in all of its buckets, which in a group of edited copies is what they were
   copied from.  Verified links give labels: the smallest node within a few links.
5. Mixed buckets, which still hold more than one label, are gone through pair by pair, but
   only over members of unlike labels and only in sketches: at similarity t, bags of x and
   y shingles differ in at most (x + y) (1 - t) / (1 + t) of them, and the bits in which
   their ``PARITY`` sketches (each shingle flips one bit) differ are no more than that.
   First the most promising pair of every two labels is verified, and labels grow
   together; then all pairs that the sketches leave open are.  So no pair that shares a
   bucket is left out.  A pair is looked at in the first band in which its keys agree, so
   once however many buckets it shares; buckets with the same members are one, of the
   first of their bands.  A large bucket is dealt out as pairs of blocks of ``BLOCK`` members.
6. Components of all links are the classes.

A node is a run of words, whatever rows hold it.  A document without words (null, empty
or blank text) is a class of its own.  All texts of one doc_id are linked to each other.
Rows without doc_id are left out of the result, since a class cannot name them, but
their texts link others.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.components import components
from ledgerlark.llm.texts import batches_of, mix, windows, word_hashes
from ledgerlark.session import landed

WIDTH = 5
THRESHOLD = 0.8
BANDS = 32
ROWS = 5
PARITY = 16  # words of 64 bits
BLOCK = 1024  # members of a bucket that meet in one task
SPREAD = 3  # links that labels travel in one go

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, repeats included, and the position of each one's text."""
    hashes, places = word_hashes(texts)
    full, full_owner = windows(hashes, places, width)
    counts = np.diff(places)
    short = np.flatnonzero((counts > 0) & (counts < width))
    rest = np.zeros(len(short), np.uint64)
    for i in range(width - 1):
        has = counts[short] > i
        rest[has] = mix(rest[has] * _GOLD + hashes[places[:-1][short[has]] + i])
    return np.concatenate([full, rest]), np.concatenate([full_owner, short])


def bags(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: (hash, position of the text, count)."""
    hashes, owner = shingles(texts, width)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return hashes[at], owner[at], np.diff(np.append(at, len(hashes)))


def signatures(hashes: np.ndarray, owner: np.ndarray, weight: np.ndarray, n_texts: int, m: int) -> np.ndarray:
    """BagMinHash registers (n_texts, m): the times of the earliest points; infinite for an empty bag."""
    registers = np.full(n_texts * m, np.inf)
    # One process for each shingle and level (low, high] with low < weight.
    levels = [(hashes, owner, weight, 0, 1)]
    low = 1
    while (more := weight > low).any():
        levels.append((hashes[more], owner[more], weight[more], low, 2 * low))
        low *= 2
    seed = np.concatenate([mix(h + np.array([lo + 1], np.uint64) * _GOLD) for h, _, _, lo, _ in levels])
    text = np.concatenate([o for _, o, _, _, _ in levels])
    bound = np.concatenate([w - lo for _, _, w, lo, _ in levels])
    width = np.concatenate([np.full(len(h), hi - lo) for h, _, _, lo, hi in levels])
    time = np.zeros(len(seed))
    while len(seed):
        seed = mix(seed + _GOLD)
        time = time - np.log(((seed >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / width
        place = mix(seed ^ np.uint64(0xD1B54A32D192ED03))
        register = text * m + (place % np.uint64(m)).astype(np.int64)
        # Halving a level of 2**k weights k times: the top bits name the whole weight that the point lies at.
        height = ((place >> np.uint64(32)) * width.astype(np.uint64)) >> np.uint64(32)
        inside = height < bound.astype(np.uint64)
        np.minimum.at(registers, register[inside], time[inside])
        latest = registers.reshape(n_texts, m).max(axis=1)
        on = time < latest[text]
        seed, text, bound, width, time = seed[on], text[on], bound[on], width[on], time[on]
    return registers.reshape(n_texts, m)


def band_keys(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """64-bit bucket keys (n_texts, bands)."""
    raw = registers.view(np.uint64).reshape(len(registers), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _GOLD, raw.shape[:2]).copy()
    for i in range(rows):
        key = mix(key * _GOLD + raw[:, :, i])
    return key


def parities(hashes: np.ndarray, owner: np.ndarray, weight: np.ndarray, n_texts: int) -> np.ndarray:
    """Sketches (n_texts, PARITY): each shingle of a bag flips one bit."""
    odd = weight % 2 == 1
    bit = mix(hashes[odd] ^ _GOLD) % np.uint64(64 * PARITY)
    out = np.zeros(n_texts * PARITY, np.uint64)
    at = owner[odd] * PARITY + (bit // np.uint64(64)).astype(np.int64)
    np.bitwise_xor.at(out, at, np.uint64(1) << (bit % np.uint64(64)))
    return out.reshape(n_texts, PARITY)


def may_link(size: np.ndarray, parity: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Which of the pairs (i, j) can be at the threshold, and the share in which they differ at least.  True for all that are."""
    x, y = size[i], size[j]
    ok = np.minimum(x, y) >= (threshold - 1e-9) * np.maximum(x, y)
    share = np.ones(len(i))
    at = np.flatnonzero(ok)
    for k in range(0, len(at), 1 << 16):
        some = at[k : k + (1 << 16)]
        differ = np.bitwise_count(parity[i[some]] ^ parity[j[some]]).sum(axis=1, dtype=np.int64)
        share[some] = differ / (x[some] + y[some])
    return ok & (share <= (1 - threshold) / (1 + threshold) + 1e-9), share


def _sign(bands: int, rows: int, width: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in batches_of(batch):
                words = [t.split() for t in texts]
                digests = [xxhash.xxh3_128_digest(b" ".join(w)) if w else None for w in words]
                # Copies inside this block are signed once.
                first = {d: i for i, d in reversed(list(enumerate(digests))) if d is not None}
                at = sorted(first.values())
                chosen = [texts[i] for i in at]
                bag = bags(chosen, width)
                keys = band_keys(signatures(*bag, len(chosen), bands * rows), bands, rows)
                sizes = np.bincount(bag[1], bag[2], len(chosen)).astype(np.int64).tolist()
                sketches = parities(*bag, len(chosen))
                signed = {digests[i]: (keys[k].tobytes(), sizes[k], sketches[k].tobytes()) for k, i in enumerate(at)}
                of = [signed.get(d, (None, None, None)) for d in digests]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(part.schema.get_field_index("doc_id")),
                        pa.array(digests, pa.binary()),
                        pa.array([s[0] for s in of], pa.binary()),
                        pa.array([s[1] for s in of], pa.int64()),
                        pa.array([s[2] for s in of], pa.binary()),
                    ],
                    names=["doc_id", "digest", "keys", "size", "parity"],
                )

    return sign


def _bag_rows(width: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in batches_of(batch):
                # Copies inside this block are packed once.
                texts = [t for t in {b" ".join(t.split()) for t in texts} if t]
                hashes, owner = shingles(texts, width)
                order = np.lexsort((hashes, owner))
                cuts = np.searchsorted(owner[order], np.arange(len(texts) + 1))
                hashes = hashes[order]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([xxhash.xxh3_128_digest(t) for t in texts], pa.binary()),
                        pa.array([hashes[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
                    ],
                    names=["node", "bag"],
                )

    return rows


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays of hashes, repeats included."""
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    both = int(np.minimum(ca[ia], cb[ib]).sum())
    return both / max(1, len(a) + len(b) - both)


def _verify(threshold: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda n, b=batch: b.column(b.schema.get_field_index(n))
            similar = []
            for x, y in zip(get("bag_a"), get("bag_b"), strict=True):
                a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                near = min(len(a), len(b)) >= threshold * max(len(a), len(b))
                similar.append(weighted_jaccard(a, b) if near else 0.0)
            keep = pa.array(np.array(similar) >= threshold, pa.bool_())
            yield pa.RecordBatch.from_arrays([get("a"), get("b")], names=["a", "b"]).filter(keep)

    return verify


def _runs(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """The groups of rows that are sorted by ``by``; one group is in memory."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        keys = [table.column(c).to_numpy() for c in by]
        cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        starts = np.concatenate([[0], cuts]).tolist()
        for first, last in zip(starts, starts[1:], strict=False):
            yield table.slice(first, last - first)
        held = table.slice(starts[-1])
    if held is not None and held.num_rows:
        yield held


def _open_pairs(threshold: float, best_only: bool):
    """Pairs of unlike labels that the sketches leave open, of groups (key, i, j): of the blocks i and j of a bucket."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, ["key", "i", "j"]):
            node, label = group.column("node").to_pylist(), group.column("label").to_pylist()
            numbers = np.unique(np.array(label, dtype=object), return_inverse=True)[1].ravel()
            size, block = group.column("size").to_numpy(), group.column("block").to_numpy()
            parity = np.frombuffer(b"".join(group.column("parity").to_pylist()), np.uint64).reshape(-1, PARITY)
            keys = np.frombuffer(b"".join(group.column("keys").to_pylist()), np.uint64).reshape(len(node), -1)
            band = group.column("band")[0].as_py()
            within = group.column("i")[0].as_py() == group.column("j")[0].as_py()
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for first in range(0, len(node), 128):
                rows = np.arange(first, min(len(node), first + 128))
                unlike = numbers[rows][:, None] != numbers
                unlike &= (rows[:, None] < np.arange(len(node))) if within else (block[rows][:, None] < block)
                a, b = np.nonzero(unlike)
                a = rows[a]
                ok, share = may_link(size, parity, a, b, threshold)
                a, b, share = a[ok], b[ok], share[ok]
                here = (keys[a] == keys[b]).argmax(axis=1) == band
                found.append((a[here], b[here], share[here]))
                if best_only:
                    a, b, share = map(np.concatenate, zip(*found, strict=True))
                    low, high = np.minimum(numbers[a], numbers[b]), np.maximum(numbers[a], numbers[b])
                    order = np.lexsort((share, high, low))
                    new = np.ones(len(order), bool)
                    new[1:] = (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])
                    found = [(a[order][new], b[order][new], share[order][new])]
            a, b = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            if len(a):
                ends = [(min(node[p], node[q]), max(node[p], node[q])) for p, q in zip(a, b, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([e[k] for e in ends], pa.binary()) for k in (0, 1)], names=["a", "b"]
                )

    return pairs


def _labels(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node within ``SPREAD`` links, which is of the same component."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a")).distinct()
    labels = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label"))
    for _ in range(SPREAD - 1):
        near = both.join(labels.select(F.col("u").alias("v"), F.col("label").alias("l")), "v")
        near = near.groupBy("u").agg(F.min("l").alias("m"))
        labels = near.join(labels, "u").select("u", F.least("m", "label").alias("label"))
    return labels.select(F.col("u").alias("node"), "label")


def _dealt(members: DataFrame, labels: DataFrame, sketches: DataFrame) -> DataFrame:
    """Members of mixed buckets with label and sketch, sorted into the groups (key, i, j) in which their blocks meet."""
    now = members.join(labels, "node", "left").select("key", "band", "node", F.coalesce("label", "node").alias("label"))
    mixed = now.groupBy("key").agg(F.min("label").alias("p"), F.max("label").alias("q"), F.count("*").alias("n"))
    mixed = mixed.filter("p <> q").select(F.col("key").alias("mixed"), "n")
    now = now.join(mixed, F.col("key") == F.col("mixed")).drop("mixed")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    now = now.select("key", "band", "node", "label", blocks.alias("k")).withColumn("block", F.pmod(F.hash("node"), "k"))
    other = F.explode(F.expr("sequence(0, k - 1)")).alias("o")
    now = now.select("key", "band", "node", "label", "block", other)
    now = now.select("*", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j")).drop("o")
    dealt = now.join(sketches, "node")
    return dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")


def near_classes(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    width: int = WIDTH,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(doc_id, class_id, class_size): one row for each doc_id; the class is named by its smallest one."""
    docs = docs.select("doc_id", "text")
    signed = landed(
        docs.mapInArrow(_sign(bands, rows, width), "doc_id bigint, digest binary, keys binary, size bigint, parity binary"),
        "signed",
    )
    nodes = signed.filter("digest IS NOT NULL").groupBy(F.col("digest").alias("node"))
    nodes = nodes.agg(F.min("doc_id").alias("id"), F.min(F.struct("keys", "size", "parity")).alias("s"))
    nodes = landed(nodes.select("node", "id", "s.*"), "nodes")
    key = F.expr(f"transform(sequence(0, {bands - 1}), i -> hex(substring(keys, 8 * i + 1, 8)))")
    members = nodes.select("node", F.posexplode(key).alias("band", "k")).select("node", "band", F.xxhash64("band", "k").alias("key"))
    # Buckets with the same members, told by two order-free hashes of 64 bits, are one: that of the first band.
    same = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"x{i}") for i in range(2)]
    shared = members.groupBy("band", "key").agg(F.count("*").alias("n"), *same).filter("n > 1")
    shared = shared.groupBy("n", "x0", "x1").agg(F.min(F.struct("band", "key")).alias("b")).select("b.*", "n")
    members = landed(members.join(shared, ["band", "key"]), "buckets")
    company = members.groupBy("node").agg(F.sum("n").alias("company"))
    members = landed(members.select("key", "band", "node").join(company, "node"), "members")

    # One row of each node: of its smallest id, or of the rows without id.
    wanted = nodes.join(company.select("node"), "node", "left_semi").select(F.col("id").alias("doc_id"))
    named = docs.join(wanted.filter("doc_id IS NOT NULL").distinct(), "doc_id", "left_semi")
    texts = named.select("text").union(docs.filter("doc_id IS NULL").select("text"))
    bags_ = landed(texts.mapInArrow(_bag_rows(width), "node binary, bag binary").dropDuplicates(["node"]), "bags")
    bag_of = lambda name: bags_.select(F.col("node").alias(name), F.col("bag").alias(f"bag_{name}"))

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        pairs = landed(pairs.distinct(), f"{name}-pairs")
        with_bags = pairs.join(bag_of("a"), "a").join(bag_of("b"), "b")
        return landed(with_bags.mapInArrow(_verify(threshold), "a binary, b binary"), f"{name}-links")

    hubs = members.groupBy("key").agg(F.max(F.struct("company", "node")).alias("h")).select("key", F.col("h.node").alias("hub"))
    pairs = members.join(hubs, "key").filter("node <> hub")
    links = verified(pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")), "hub")

    members, sketches = members.select("key", "band", "node"), nodes.select("node", "keys", "size", "parity")
    for name, best_only in (("best", True), ("open", False)):
        labels = landed(_labels(links), f"{name}-labels")
        dealt = _dealt(members, labels, sketches)
        links = links.union(verified(dealt.mapInArrow(_open_pairs(threshold, best_only), "a binary, b binary"), name))

    # All texts of one id are linked; components join the labels, of which there are few.
    texts_of = signed.filter("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
    several = texts_of.agg(F.min("digest").alias("a"), F.max("digest").alias("z")).filter("a <> z").select("doc_id", "a")
    same_id = signed.join(several, "doc_id").filter("digest IS NOT NULL").select("a", F.col("digest").alias("b"))
    links = links.union(same_id.filter("a <> b").distinct())
    ends = lambda name: labels.select(F.col("node").alias(name), F.col("label").alias(f"l_{name}"))
    by_label = links.join(ends("a"), "a", "left").join(ends("b"), "b", "left")
    by_label = by_label.select(F.coalesce("l_a", "a").alias("a"), F.coalesce("l_b", "b").alias("b"))
    joined = components(by_label.filter("a <> b").distinct()).withColumnRenamed("id", "label")

    found = nodes.select("node", "id").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    found = found.join(joined, "label", "left").select("node", "id", F.coalesce("component", "label").alias("c"))
    found = landed(found, "found")
    names = found.groupBy("c").agg(F.min("id").alias("class_id"))
    of_digest = found.select(F.col("node").alias("digest"), "c").join(names, "c").select("digest", "class_id")
    one = signed.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("digest").alias("digest"))
    classed = one.join(of_digest, "digest", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
    classed = landed(classed, "classes")
    sizes = classed.groupBy("class_id").agg(F.count("*").alias("class_size"))
    return classed.join(sizes, "class_id").select("doc_id", "class_id", "class_size")
