"""SimHash fingerprints of texts and their near-duplicates by anchor-point covering.

Fingerprints link if they differ in at most three of 64 bits. Of three differing bits at most one lies in one of the two
32-bit halves, so it is enough to find, for either half, the pairs whose halves differ by at most one bit and to compare
the whole fingerprints there. The anchors of a half are a covering code: the codewords of the perfect Hamming code on
31 bits with a free 32nd bit. Every half lies within radius 1 of exactly one anchor, its home; a half that differs by one
bit from it lies within radius 2 of that anchor. Each fingerprint is replicated to every anchor within covering radius plus
threshold (17 at most per half, 34 in all), and at each anchor fingerprints are compared in full. The result is exact.

One code over all 64 bits would need thousands of replicas (radius 1) or leave a thousand anchors for any number of
documents (radius 20); two halves keep 2 ** 28 anchors at 34 replicas.

Equal fingerprints are collapsed before they are replicated. At an anchor with many fingerprints a search that starts from one
and compares with those not reached yet gives a spanning forest: no more links than fingerprints, whatever the number of pairs.

`copies`, which the pipeline uses, goes by the Jaccard similarity of sets of five-word shingles instead: the sets are cut into parts, of
which similar sets have one in common for sure (`Signatures`), and an exact check of the sets follows. That is exact too.

Null and empty texts have fingerprint zero and link like any other; fewer than `width` words make one shingle. Rows that
repeat are each labelled; a null doc_id never becomes a component's id unless it is alone. Empty tables give empty
results. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluvial.llm.bits import different, mixed
from fluvial.llm.common import materialize, partitions, ragged, settled, sorted_groups, text_slices, trimmed
from fluvial.llm.components import connected_components
from fluvial.llm.decontaminate import shingle_hashes

SEED = 42
WIDTH = 3
MOST_BITS = 3
#: Fingerprints at one anchor up to which all pairs are compared at once.
SMALL = 8
#: Shingles whose hashes a worker holds at once.
BLOCK = 1 << 16
#: Bits of the map that picks the texts whose shingles are compared: 8 MB.
MAP_BITS = 26


def fingerprint(text: bytes | None, width: int = WIDTH) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included: a bit is set if it is in over half of the hashes."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, ones, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(starts)
    for at in range(0, n, BLOCK):
        s, e = starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist()
        hashes = np.array([digest(line[i:j], SEED) for i, j in zip(s, e, strict=True)], ">u8")
        ones += _bit_counts(hashes)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the big-endian 64-bit hashes have each bit, highest first."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    total = np.zeros(64, np.int64)
    for at in range(0, len(bits), 255):  # sums of up to 255 fit into a byte
        total += np.add.reduce(bits[at : at + 255], axis=0, dtype=np.uint8)
    return total


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a long) of every row of docs(doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_slices(batch):
                fp = np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(texts)), pa.array(fp)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(trimmed(run), "doc_id long, fp long")


def _masks() -> list[list[int]]:
    """By syndrome: what to flip in a 32-bit half to get to each anchor within radius 2; the home anchor comes first.

    The Hamming code's check matrix has the numbers 1 to 31 as columns: flipping bit i - 1 changes the syndrome by i.
    """
    table = []
    for s in range(32):
        home = 1 << (s - 1) if s else 0
        pairs = [(1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, 32) if s and i < i ^ s and i != s]
        table.append([home, home | 1 << 31, *pairs])
    return table


def anchors(fp: Column) -> Column:
    """The keys of all anchors of a fingerprint, an array of structs (anchor, home)."""
    table = F.expr("array(" + ", ".join("array(" + ", ".join(f"{m}L" for m in row) + ")" for row in _masks()) + ")")
    keys = []
    for half in (0, 1):
        value = F.shiftrightunsigned(fp, 32) if half else fp.bitwiseAND(F.lit(0xFFFFFFFF))
        syndrome = F.lit(0)
        for k in range(5):
            checked = sum(1 << (i - 1) for i in range(1, 32) if i >> k & 1)
            syndrome = syndrome + (F.bit_count(value.bitwiseAND(F.lit(checked))) % 2) * (1 << k)
        masks = F.element_at(table, (syndrome + 1).cast("int"))
        keys.append(F.transform(masks, _flip(value, half << 32)))
    return F.concat(*keys)


def _flip(value: Column, tag: int):
    return lambda mask, place: F.struct((value.bitwiseXOR(mask) + F.lit(tag)).alias("anchor"), (place == 0).alias("home"))


def close_pairs(fps: np.ndarray, starts: np.ndarray, sizes: np.ndarray, most: int = MOST_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links among the values of each group (starts, sizes) of fps: all of small groups, a spanning forest of the others."""
    left, right = [], []
    small = sizes <= SMALL
    if small.any():
        s, n = starts[small], sizes[small]
        row = ragged(s, n)
        group_start, group_size = np.repeat(s, n), np.repeat(n, n)
        after = group_start + group_size - row - 1  # each row with those after it in its group
        i, j = np.repeat(row, after), ragged(row + 1, after)
        near = (np.bitwise_count(fps[i] ^ fps[j]) <= most) & (fps[i] != fps[j])
        left.append(fps[i[near]])
        right.append(fps[j[near]])
    for s, n in zip(starts[~small].tolist(), sizes[~small].tolist(), strict=True):
        a, b = _forest(np.unique(fps[s : s + n]), most)
        left.append(a)
        right.append(b)
    empty = np.zeros(0, fps.dtype)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def _forest(values: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, least reached first) of each group of values connected by links; each value is compared only with those not reached yet."""
    rest, member, head = values, [], []
    while len(rest):
        first, queue, rest = rest[0], [rest[0]], rest[1:]
        while queue and len(rest):
            near = np.bitwise_count(rest ^ queue.pop()) <= most
            if near.any():
                found = rest[near]
                rest = rest[~near]
                queue.extend(found)
                member.append(found)
                head.append(np.full(len(found), first, values.dtype))
    empty = np.zeros(0, values.dtype)
    return np.concatenate([empty, *member]), np.concatenate([empty, *head])


def links(distinct: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """(a, b): links between fingerprints of distinct(fp) that connect all that differ by at most three bits."""
    if not 0 <= most <= 3:
        raise ValueError("two halves find fingerprints of up to three differing bits")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, starts, sizes in sorted_groups(batches, "anchor"):
            homes = np.add.reduceat(batch.column("home").to_numpy(zero_copy_only=False).astype(np.int64), starts)
            use = (sizes > 1) & (homes > 0)
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)  # bitwise_count takes signed numbers by their amount
            a, b = close_pairs(fps, starts[use], sizes[use], most)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    spread = distinct.select("fp", F.explode(anchors(F.col("fp"))).alias("x")).select("fp", "x.anchor", "x.home")
    spread = spread.repartition(partitions(distinct.sparkSession), "anchor").sortWithinPartitions("anchor")
    return spread.mapInArrow(trimmed(compare), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = WIDTH, most: int = MOST_BITS) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable over links) of every row of docs(doc_id, text)."""
    light = materialize(fingerprints(docs, width), "fingerprints")
    distinct = materialize(light.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = connected_components(links(distinct, most), "a", "b")
    grown = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    grown = materialize(grown, "roots")
    ids = materialize(grown.groupBy("root").agg(F.min("least").alias("component_id")), "component-ids")
    label = materialize(grown.join(ids, "root").select("fp", "component_id"), "labels")
    return light.join(label, "fp").select("doc_id", "fp", "component_id")


def as_hex(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


#: Copies: words of a shingle, and Jaccard similarity of the sets of shingles.
COPY_WIDTH, SIMILARITY = 5, 0.8
#: A signature of a text in a part, its class, and 96 bits of the digest of the text's words.
ENTRY = np.dtype([("key", "<u4"), ("level", "u1"), ("a", "<u8"), ("b", "<u4")])
ENDS, DIGEST = np.dtype([("a", "<u8"), ("b", "<u4")]), 12
#: Bits of a signature that say its class.
LEVEL_BITS, LEVEL = np.uint64(7), np.uint64(127)
#: Texts of a signature over which they are first linked to one of them, and all pairs laid out only for those that are then still apart.
CROWD = 16
#: Pairs laid out at once.
PAIRS = 1 << 20


def words_digest(text: bytes | None) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join((text or b"").lower().split()))[:DIGEST]


def shingle_sets(texts: list[bytes | None], width: int = COPY_WIDTH) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Digest of each text's words; the different hashes of its shingles, text after text, and how many each has."""
    words = [(t or b"").lower().split() for t in texts]
    flat = [w for ws in words for w in ws]
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, flat), np.uint64, len(flat))
    found, n = shingle_hashes(hashes, np.fromiter(map(len, words), np.int64, len(words)), width)
    return [xxhash.xxh3_128_digest(b" ".join(ws))[:DIGEST] for ws in words], *different(found, n)


class Signatures:
    """Signatures of sets, of which any two sets with Jaccard similarity `least` have `needed` in common.

    Sizes fall into classes so that similar sets are of one class or of neighbours; they meet in the larger's. Two sets there differ in at most k elements, in
    both together. Each is dealt into m parts by its elements' hashes, so m - k parts or more are alike in both; a part's signature is the sum of its
    elements' hashes, and the class. Parts of few elements are alike in many sets that are not: of each set the `dropped` parts of fewest elements, in an order
    that alike parts have in common, give none. The strongest m - k - dropped of the alike parts have so many weaker ones in either set, so they stay in both.
    """

    def __init__(self, least: float):
        self.least, self.lows, self.most = least, [1], []

    def _classes(self, largest: int) -> None:
        while self.lows[-1] <= largest / self.least + 1:
            high = int(self.lows[-1] / self.least + 1e-9)
            self.most.append(int((1 - self.least) / (1 + self.least) * 2 * high + 1e-9))
            self.lows.append(high + 1)

    def needed(self, levels: np.ndarray) -> np.ndarray:
        """How many signatures of a class similar sets have in common at least."""
        while len(self.most) <= levels.max(initial=0):
            self._classes(self.lows[-1])
        return 1 + np.array(self.most, np.int64)[levels] // 8

    def of(self, hashes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(set, signature) of sets of n different hashes each, one after the other; a signature's last bits are its class."""
        self._classes(int(n.max(initial=0)))
        lows, most = np.array(self.lows), np.array(self.most, np.int64)
        dropped = 2 + most // 4
        own = np.searchsorted(lows, n, "right") - 1
        reach = np.searchsorted(lows, np.floor(n / self.least + 1e-9), "right") - 1
        first, sets, keys = np.cumsum(n) - n, [], []
        for up in (0, 1):
            row = np.flatnonzero((n > 0) & (own + up <= reach))
            if not len(row):
                continue
            size = own[row] + up
            parts = most[size] + self.needed(size) + dropped[size]
            begin = np.cumsum(parts) - parts
            h = mixed(hashes[ragged(first[row], n[row])], 0)
            slot = np.repeat(begin, n[row]) + (mixed(h, 1) % np.repeat(parts, n[row]).astype(np.uint64)).astype(np.int64)
            total = int(parts.sum())
            held = np.bincount(slot, minlength=total)
            # Sums of 32 bits are exact as doubles.
            low, high = (np.bincount(slot, x.astype(np.float64), total).astype(np.uint64) for x in (h & np.uint64(0xFFFFFFFF), h >> np.uint64(32)))
            level = np.repeat(size, parts).astype(np.uint64)
            place = level << np.uint64(40) | ragged(np.zeros(len(row), np.int64), parts).astype(np.uint64)
            key = mixed((low + (high << np.uint64(32))) ^ mixed(place, 2), 3)
            weakest = np.repeat(np.arange(len(row), dtype=np.uint64), parts) << np.uint64(40) | held.clip(max=255).astype(np.uint64) << np.uint64(32) | key >> np.uint64(32)
            use = np.ones(total, bool)
            use[np.argsort(weakest, kind="stable")[ragged(begin, dropped[size])]] = False
            sets.append(np.repeat(row, parts)[use])
            keys.append((key >> LEVEL_BITS << LEVEL_BITS | level)[use])
        return np.concatenate([np.zeros(0, np.int64), *sets]), np.concatenate([np.zeros(0, np.uint64), *keys])


def _ends(entries: np.ndarray) -> np.ndarray:
    """The digests of entries."""
    held = np.empty(len(entries), ENDS)
    held["a"], held["b"] = entries["a"], entries["b"]
    return held


def _digests(entries: np.ndarray) -> pa.Array:
    held = _ends(entries)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(DIGEST), len(held), [None, pa.py_buffer(held.tobytes())]).cast(pa.binary())


def _all_pairs(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j), i < j, of all pairs inside each group, some PAIRS at once."""
    row = ragged(starts, sizes)
    after = np.repeat(starts + sizes, sizes) - row - 1
    ends, at = np.cumsum(after), 0
    while at < len(row):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
        yield np.repeat(row[at:stop], after[at:stop]), ragged(row[at:stop] + 1, after[at:stop])
        at = stop


def copy_meetings(texts: DataFrame, width: int = COPY_WIDTH, least: float = SIMILARITY) -> DataFrame:
    """(key, a, b, n, needed) of rows of texts(text) with a signature in common: their pairs where few have one, with a null key; of a crowd, each with the first, with its key.

    A pair has n signatures in common, here and in other rows of the same `needed`; similar texts have so many, or are in a crowd together. The signatures go to their parts as packed arrays, straight from the texts: they are never laid down as a table.
    """
    spark = texts.sparkSession
    parts = partitions(spark)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signatures = Signatures(least)
        for batch in batches:
            for _, some in text_slices(batch):
                digests, hashes, n = shingle_sets(some, width)
                row, keys = signatures.of(hashes, n)
                ends = np.frombuffer(b"".join(digests), ENDS)
                part = mixed(keys, 4) % np.uint64(parts)
                order = np.argsort(part, kind="stable")
                part, row, out = part[order].astype(np.int32), row[order], np.empty(len(keys), ENTRY)
                out["key"], out["level"] = keys[order] >> LEVEL_BITS & np.uint64(0xFFFFFFFF), keys[order] & LEVEL
                out["a"], out["b"] = ends["a"][row], ends["b"][row]
                cuts = np.flatnonzero(np.diff(part, prepend=-1))
                if len(cuts):
                    yield pa.RecordBatch.from_arrays([pa.array(part[cuts]), pa.array([x.tobytes() for x in np.split(out, cuts[1:])], pa.binary())], ["part", "entries"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signatures, names = Signatures(least), ["key", "a", "b", "n", "needed"]
        for batch, starts, sizes in sorted_groups(batches, "part"):
            for s, n in zip(starts.tolist(), sizes.tolist(), strict=True):
                entries = np.frombuffer(b"".join(batch.column("entries").slice(s, n).to_pylist()), ENTRY)
                keys = entries["key"].astype(np.uint64) << np.uint64(8) | entries["level"]
                order = np.argsort(keys)
                same = np.diff(keys[order]) == 0
                entries = entries[order[np.append(same, False) | np.insert(same, 0, False)]]
                entries = entries[np.lexsort((entries["b"], entries["a"], entries["level"], entries["key"]))]
                new = np.ones(len(entries), bool)
                new[1:] = entries[1:] != entries[:-1]
                entries = entries[new]
                if not len(entries):
                    continue
                keys = entries["key"].astype(np.int64) << 8 | entries["level"] | batch.column("part")[s].as_py() << 40
                begins = np.concatenate(([0], np.flatnonzero(np.diff(keys)) + 1))
                count = np.diff(np.append(begins, len(entries)))
                few = (count > 1) & (count <= CROWD)
                needed = signatures.needed(entries["level"].astype(np.int64)).astype(np.int32)
                for i, j in _all_pairs(begins[few], count[few]):
                    order = np.lexsort((needed[i], entries["a"][j], entries["a"][i]))
                    left, right, own = _ends(entries[i[order]]), _ends(entries[j[order]]), needed[i[order]]
                    new = np.ones(len(left), bool)
                    new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1]) | (own[1:] != own[:-1])
                    n = np.diff(np.append(np.flatnonzero(new), len(left))).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.nulls(len(n), pa.int64()), _digests(left[new]), _digests(right[new]), pa.array(n), pa.array(own[new])], names)
                many = count > CROWD
                if many.any():
                    row, head = ragged(begins[many], count[many]), np.repeat(begins[many], count[many])
                    yield pa.RecordBatch.from_arrays([pa.array(keys[row]), _digests(entries[row]), _digests(entries[head]), pa.array(np.ones(len(row), np.int32)), pa.array(needed[row])], names)

    dealt = texts.select("text").mapInArrow(trimmed(pack), "part int, entries binary").repartition(partitions(spark), "part").sortWithinPartitions("part")
    return dealt.mapInArrow(trimmed(meet), "key long, a binary, b binary, n int, needed int")


def _laid_out(crowds: DataFrame) -> DataFrame:
    """(a, b): all pairs of crowds(key, a, of) that share a key and are of different groups."""

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, starts, sizes in sorted_groups(batches, "key"):
            a, of = batch.column("a"), batch.column("of").dictionary_encode().indices.to_numpy()
            for i, j in _all_pairs(starts, sizes):
                apart = of[i] != of[j]
                if apart.any():
                    yield pa.RecordBatch.from_arrays([a.take(pa.array(i[apart])), a.take(pa.array(j[apart]))], ["a", "b"])

    dealt = crowds.select("key", "a", "of").repartition(partitions(crowds.sparkSession), "key").sortWithinPartitions("key")
    found = dealt.mapInArrow(trimmed(lay), "a binary, b binary")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def settled_crowds(met: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, a, b) of the rows of crowds of met that are looked at, and (a, needed, n): how many crowds each text is in.

    Similar texts whose signatures in common are all of crowds have `needed` of them, so one is among all but the needed - 1 largest of either text.
    """
    crowds = met.where("key IS NOT NULL").select("key", "a", "b", "needed")
    crowds = crowds.join(crowds.groupBy("key").agg(F.count("*").alias("size")), "key")
    own = Window.partitionBy("a", "needed")
    crowds = crowds.select("*", F.count("*").over(own).alias("n"), F.row_number().over(own.orderBy("size", "key")).alias("place"))
    crowds = materialize(crowds.select("key", "a", "b", "needed", "n", "place"), "copy-all-crowds")
    return crowds.where("place <= n - needed + 1").select("key", "a", "b"), crowds.where("place = 1").select("a", "needed", "n")


def copies(docs: DataFrame, width: int = COPY_WIDTH, least: float = SIMILARITY) -> DataFrame:
    """doc_id, component_id (the smallest doc_id of its group) of every row of docs(doc_id, text): texts link if their sets of shingles have Jaccard similarity `least`.

    Candidates come from `Signatures`, so none is missed; each is verified on the whole sets. Texts of the same words, but for case and white space, are one from the start.
    A crowd at a signature is first linked to one of its texts, then those still apart to the first of each signature, then all pairs of those still apart are verified.
    """

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, some in text_slices(batch):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(some)), pa.array(map(words_digest, some), pa.binary())], ["doc_id", "digest"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            for _, texts in text_slices(batch):
                digests, hashes, n = shingle_sets(texts, width)
                slot = np.frombuffer(b"".join(digests), ">u4")[:: DIGEST // 4] >> 32 - MAP_BITS
                use = np.flatnonzero((wanted[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)
                ends = np.cumsum(n)
                rows = [hashes[ends[i] - n[i] : ends[i]].view(np.int64) for i in use.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array([digests[i] for i in use.tolist()], pa.binary()), pa.array(rows, pa.list_(pa.int64()))], ["digest", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    light = materialize(texts.mapInArrow(trimmed(known), "doc_id long, digest binary"), "copy-digests")
    met = materialize(copy_meetings(texts, width, least), "copy-meetings")
    crowds, counted = settled_crowds(met)
    pairs = met.where("key IS NULL").groupBy("a", "b", "needed").agg(F.sum("n").alias("n"))
    of = lambda x: counted.select(F.col("a").alias(x), "needed", F.col("n").alias(f"n{x}"))
    often = pairs.where("n >= needed").select("a", "b")
    often = often.union(pairs.where("n < needed").join(of("a"), ["a", "needed"]).join(of("b"), ["b", "needed"]).where("n + least(na, nb) >= needed").select("a", "b"))
    firsts = crowds.groupBy("a").agg(F.min("b").alias("b")).where("a <> b")
    pairs = materialize(often.union(firsts.select(F.least("a", "b"), F.greatest("a", "b"))).distinct(), "copy-pairs")
    wanted = materialize(pairs.select(F.col("a").alias("digest")).union(pairs.select("b")).union(crowds.select("a")).distinct(), "copy-wanted")
    slot = F.shiftright(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), 32 - MAP_BITS)
    found = wanted.select(slot.alias("slot")).groupBy(F.shiftright("slot", 3).alias("byte")).agg(F.bit_or(F.expr("shiftleft(1, cast(slot & 7 as int))")).alias("bits")).toArrow()
    flags = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    flags[found.column("byte").to_numpy()] = found.column("bits").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(flags)
    held = texts.mapInArrow(trimmed(sets), "digest binary, shingles array<long>").groupBy("digest").agg(F.first("shingles").alias("shingles")).join(wanted, "digest", "left_semi")
    held = materialize(held, "copy-shingles")
    of = lambda x: held.select(F.col("digest").alias(x), F.col("shingles").alias(f"s{x}"))
    common = F.size(F.array_intersect("sa", "sb"))
    close = F.least(F.size("sa"), F.size("sb")) >= least * F.greatest(F.size("sa"), F.size("sb")) - 1e-9

    def verified(pairs: DataFrame, label: str) -> DataFrame:
        both = pairs.join(of("a"), "a").join(of("b"), "b").where(close)
        return materialize(both.where(common >= least * (F.size("sa") + F.size("sb") - common) - 1e-9).select("a", "b"), label)

    def apart(roots: DataFrame) -> DataFrame:
        """The crowds of which not all are in one group."""
        grouped = crowds.join(roots, crowds["a"] == roots["node"], "left").select("key", "a", "b", F.coalesce("root", "a").alias("of"))
        mixed_keys = grouped.groupBy("key").agg(F.min("of").alias("one"), F.max("of").alias("other")).where("one <> other").select("key")
        return materialize(grouped.join(mixed_keys, "key"), "copy-crowds")

    linked = verified(pairs, "copy-links")
    roots = connected_components(linked, "a", "b")
    if not crowds.isEmpty():
        still = apart(roots)
        heads = still.join(roots.select(F.col("node").alias("b"), "root"), "b", "left").where(F.col("of") != F.coalesce("root", "b"))
        linked = linked.union(verified(heads.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "copy-links"))
        roots = connected_components(linked, "a", "b")
        linked = linked.union(verified(_laid_out(apart(roots)), "copy-links"))
        roots = connected_components(linked, "a", "b")
    distinct = light.groupBy("digest").agg(F.min("doc_id").alias("least"))
    grown = materialize(distinct.join(roots, distinct["digest"] == roots["node"], "left").select("digest", "least", F.coalesce("root", "digest").alias("root")), "copy-roots")
    label = materialize(grown.join(grown.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("digest", "component_id"), "copy-labels")
    return light.select("doc_id", "digest").join(label, "digest").select("doc_id", "component_id")


def keep_one(docs: DataFrame, width: int = COPY_WIDTH, least: float = SIMILARITY) -> DataFrame:
    """The rows of docs whose doc_id is the smallest of its group of copies; rows that share an id are one document and stay together."""

    def others() -> DataFrame:
        found = copies(docs, width, least)
        first = F.bool_or(F.col("doc_id").eqNullSafe(F.col("component_id")))
        return found.groupBy("doc_id").agg(first.alias("first")).where("NOT first").select(F.col("doc_id").alias("nd_id"))

    # Those that go are few as a rule, so the texts need not be dealt out to be joined.
    gone = settled(others, "copies-gone")
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["nd_id"]), "left_anti")
