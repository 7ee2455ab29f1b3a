"""Near-duplicate groups: MinHash bands, odd sketches, exact Jaccard, components.

1. Each text gives its distinct word shingles, 128 MinHash samples of them, 25
   band keys of five samples each, and an odd sketch: 512 bits, each the parity
   of the samples that hash to it. Texts with equal sets become one node.
2. Nodes that share a band key are candidates. Each node of such a bucket is first
   compared with the least node of the bucket only, so a bucket of ``n`` gives ``n`` pairs.
3. The XOR of two odd sketches counts the samples in which they differ; pairs far
   below the threshold go. A second bitmap, the parity of the full set, does the
   same without the error of sampling, for sets that do not saturate it.
   The others are confirmed on the full sets of shingles.
4. Components of the confirmed links. Buckets that lie within one component are
   done: further links in them would join nothing. Members of the others are
   compared with another node of the bucket, two times more.
5. The rest, buckets that meet several components, are compared in full, but for
   pairs within a component: in blocks of about 128 nodes, two blocks to a row,
   by their sketches; what passes is confirmed as before. So no link between
   nodes that share a band is lost, whatever the size of the bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cohortloom.llm.components import connected_components
from cohortloom.llm.words import HashedWords, as_bytes, mix64, shingle_set
from cohortloom.llm.workspace import Workspace
from cohortloom.session import ship_package

SAMPLES, BANDS, BAND_ROWS = 128, 25, 5
SKETCH_BITS = 512
_WORDS_OF_SKETCH = SKETCH_BITS // 64
#: How far below the threshold the estimate of a true link may lie. By exact sums a pair at 85 % is cut
#: with a probability of 6e-10, at 80 % of 2.2e-8: far below what the bands miss.
_SLACK = 0.25
_BLOCK = 128
#: Rounds in which buckets of several components are compared with another of their members.
_STARS = 2
_SEED = np.arange(1, SAMPLES + 1, dtype=np.uint64)
_FACTOR = mix64(_SEED * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_SHIFT = mix64(_SEED * np.uint64(0xD6E8FEB86659FD93))
#: Bits of the parity bitmap of a full set, which follows the samples' in the sketch column.
FULL_BITS = 2048
_FULL_WORDS = FULL_BITS // 64
#: Standard deviations that the bitmaps of full sets may be above their mean.
_SIGMAS = 5.0
_SIGNATURE = "doc_id long, text_hash long, n_shingles long, digest binary, bands array<long>, sketch array<long>"


def minhash(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of the hash functions over a non-empty set."""
    low = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):
        part = shingles[i : i + 2048]
        low = np.minimum(low, (part[None, :] * _FACTOR[:, None] + _SHIFT[:, None]).min(axis=1))
    return low


def band_keys(samples: np.ndarray) -> np.ndarray:
    rows = samples[: BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for i in range(BAND_ROWS):
        key = mix64(key + rows[:, i])
    return key.view(np.int64)


def _parity(hashes: np.ndarray, bits: int) -> np.ndarray:
    odd = (np.bincount((hashes % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<i8")


def odd_sketch(samples: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """Parity bitmaps, as 64-bit integers: of the (function, sample) pairs, then of the full set."""
    return np.concatenate([_parity(mix64(samples + _SEED), SKETCH_BITS), _parity(shingles, FULL_BITS)])


def most_differing_bits(percent: int) -> int:
    """Set bits of the XOR of two sketches above which their sets are no candidates."""
    differing = 2 * SAMPLES * (1 - max(0.0, percent / 100 - _SLACK))
    return int(SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** differing)) + 1


def most_full_bits(sizes: np.ndarray | Column, percent: int) -> np.ndarray | Column:
    """Set bits of the XOR of two full bitmaps above which sets of ``sizes`` shingles in all are no candidates.

    Sets at the threshold differ in ``n`` shingles. So many bits differ at most;
    as ``n`` nears the size of the bitmap, flips meet and fewer differ, by the
    mean and variance of ``n`` balls in as many boxes.
    """
    exp, sqrt, least = (F.exp, F.sqrt, F.least) if isinstance(sizes, Column) else (np.exp, np.sqrt, np.minimum)
    n = sizes * ((100 - percent) / (100 + percent)) + 1e-6
    mean = (1 - exp(n * (-2 / FULL_BITS))) * (FULL_BITS / 2)
    lone = exp(n * (-4 / FULL_BITS))
    return least(n, mean + sqrt((1 - lone) * (FULL_BITS / 4) - n * lone + 1) * _SIGMAS + 1)


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else np.empty(0), kind))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row a hash of its text, size and digest of its shingle set, band keys and sketch; empty sets have none."""
    ship_package(docs.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = HashedWords()
        none = np.empty(0, np.int64)
        for batch in batches:
            sizes, digests, bands, sketches = [], [], [], []
            for text in as_bytes(batch.column(2)):
                s = shingle_set(text, words)
                sizes.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                samples = minhash(s) if len(s) else None
                bands.append(none if samples is None else band_keys(samples))
                sketches.append(none if samples is None else odd_sketch(samples, s))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    _lists(bands, pa.int64()),
                    _lists(sketches, pa.int64()),
                ],
                ["doc_id", "text_hash", "n_shingles", "digest", "bands", "sketch"],
            )

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.mapInArrow(task, _SIGNATURE)


def _full_sets(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``node, shingles`` of some nodes, from the texts of the rows that stand for them."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = HashedWords()
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                found = []
                for node, digest, text in zip(
                    part.column(0).to_pylist(), part.column(1).to_pylist(), as_bytes(part.column(2))
                ):
                    s = shingle_set(text, words)
                    if xxhash.xxh3_128_digest(s.tobytes()) == digest:
                        found.append((node, s.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n for n, _ in found], pa.int64()), _lists([s for _, s in found], pa.int64())],
                    ["node", "shingles"],
                )

    texts = nodes.select("node", "digest", "rep").join(
        docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).cast("string").alias("text")), "rep"
    )
    return (
        texts.select("node", "digest", "text").mapInArrow(task, "node long, shingles array<long>").dropDuplicates(["node"])
    )


def _differing(x: Column, y: Column, words: range) -> Column:
    return sum((F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in words), F.lit(0))


_SAMPLE_PART, _FULL_PART = range(_WORDS_OF_SKETCH), range(_WORDS_OF_SKETCH, _WORDS_OF_SKETCH + _FULL_WORDS)


def _close(nodes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Of the pairs ``a, b`` those whose sketches allow the similarity."""
    side = lambda name, n, out: nodes.select(F.col("node").alias(name), F.col("n_shingles").alias(n), F.col("sketch").alias(out))
    return (
        pairs.join(side("b", "nb", "sb"), "b")
        .join(side("a", "na", "sa"), "a")
        .filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        .filter(_differing(F.col("sa"), F.col("sb"), _SAMPLE_PART) <= most_differing_bits(percent))
        .filter(_differing(F.col("sa"), F.col("sb"), _FULL_PART) <= most_full_bits(F.col("na") + F.col("nb"), percent))
        .select("a", "b")
    )


def _confirm(
    work: Workspace, docs: DataFrame, nodes: DataFrame, pairs: DataFrame, percent: int, id_col: str, text_col: str
) -> tuple[DataFrame, int]:
    """Of the pairs ``a, b`` those whose full sets are similar enough, and their number."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = work.cut(_full_sets(docs, nodes.join(wanted, "node", "left_semi"), id_col, text_col))
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    links, n = _counted_cut(work, pairs.join(two, "b").join(one, "a").filter(100 * common >= percent * union).select("a", "b"))
    work.forget(sets)
    return links, n


def _counted_cut(work: Workspace, df: DataFrame) -> tuple[DataFrame, int]:
    """A written cut and its rows, counted by the write itself."""
    seen = Observation()
    return work.cut(df.observe(seen, F.count(F.lit(1)).alias("n"))), seen.get["n"]


def _block_pairs(blocks: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of different components whose sketches are close, from two blocks a row."""
    words = _WORDS_OF_SKETCH + _FULL_WORDS

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = most_differing_bits(percent)
        for batch in batches:
            for i in range(batch.num_rows):
                side = []
                for c in (0, 1):
                    members = batch.column(c)[i].values
                    sketch = members.field("sketch").flatten().to_numpy(zero_copy_only=False)
                    flat = [members.field(f).to_numpy(zero_copy_only=False) for f in ("node", "root", "n_shingles")]
                    side.append((*flat, sketch.view(np.uint64).reshape(len(members), words)))
                (na, ra, ka, sa), (nb, rb, kb, sb) = side
                sample, full = (np.zeros((len(na), len(nb)), np.uint16) for _ in range(2))
                for w in range(words):
                    bits = sample if w < _WORDS_OF_SKETCH else full
                    bits += np.bitwise_count(sa[:, w, None] ^ sb[None, :, w])
                fits = (sample <= most) & (full <= most_full_bits(ka[:, None] + kb[None, :], percent))
                fits &= 100 * np.minimum(ka[:, None], kb[None, :]) >= percent * np.maximum(ka[:, None], kb[None, :])
                x, y = np.nonzero(fits & (ra[:, None] != rb[None, :]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(na[x], nb[y])), pa.array(np.maximum(na[x], nb[y]))], ["a", "b"]
                )

    return blocks.mapInArrow(task, "a long, b long").distinct()


def _several_roots(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``key, node, root`` of the buckets that meet more than one component."""
    rooted = members.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    several = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    return rooted.join(several.select("key"), "key", "left_semi")


def _star_pairs(members: DataFrame, salt: int) -> DataFrame:
    """Per bucket the pairs of its members with one of them, of other components than its own."""
    turn = F.xxhash64("node", "key", F.lit(salt))
    center = members.groupBy("key").agg(F.min(F.struct(turn.alias("turn"), "node", "root")).alias("c"))
    return (
        members.join(center, "key")
        .filter(F.col("root") != F.col("c.root"))
        .select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b"))
        .distinct()
    )


def _rest_pairs(rooted: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Close pairs of different components within buckets that meet several."""
    per_root = rooted.groupBy("key", "root").agg(F.count("*").alias("n_root"))
    small = F.col("n_root") <= _BLOCK // 2
    mixed = per_root.groupBy("key").agg(F.sum(F.when(small, F.col("n_root")).otherwise(0)).alias("n_mixed"))
    deal = lambda n: F.pmod(F.xxhash64("node"), F.ceil(n / _BLOCK))
    block = F.when(small, deal(F.col("n_mixed"))).otherwise(F.xxhash64("root", deal(F.col("n_root"))))
    blocks = (
        rooted.join(per_root, ["key", "root"])
        .join(mixed, "key")
        .join(nodes.select("node", "n_shingles", "sketch"), "node")
        .groupBy("key", block.alias("block"))
        .agg(
            F.collect_list(F.struct("node", "root", "n_shingles", "sketch")).alias("members"),
            F.min("root").alias("low"),
            F.max("root").alias("high"),
        )
    )
    x, y = blocks.alias("x"), blocks.alias("y")
    one_component = (
        (F.col("x.low") == F.col("x.high")) & (F.col("y.low") == F.col("y.high")) & (F.col("x.low") == F.col("y.low"))
    )
    two = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.block") <= F.col("y.block"))).filter(~one_component)
    return _block_pairs(two.select(F.col("x.members").alias("one"), F.col("y.members").alias("two")), percent)


def near_duplicates(
    work: Workspace, docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Rows are linked if 100 times the intersection of their sets of five-word
    shingles is at least ``percent`` times their union. ``component_id`` is the
    smallest id reachable over links, ``kept`` whether it is the row's own. A text
    of fewer than five words is one shingle; one without words, or null, has none
    and is linked with nothing. Equal texts are always linked. Rows that repeat
    an id each get the component of their own text; rows with a null id are
    linked with nothing and kept. Other columns of ``docs`` are not read.

    A pair at 85 % misses all bands with a probability of 4e-7, at 80 % of 5e-5,
    and the odd sketch of its samples with 6e-10 and 2.2e-8, by exact sums over
    differing samples and parities; components make that rarer still.
    """
    return work.result(_judged(work, docs, percent, id_col, text_col).drop("text_hash", "root"))


def _judged(work: Workspace, docs: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    """What ``near_duplicates`` returns, with the hash of each row's text and what stands for its group."""
    rows = work.cut(signatures(docs, id_col, text_col))
    usable = rows.filter("doc_id IS NOT NULL AND n_shingles > 0")
    nodes = work.cut(
        usable.groupBy("digest")
        .agg(
            F.min("doc_id").alias("rep"),
            F.max("n_shingles").alias("n_shingles"),
            F.any_value("bands").alias("bands"),
            F.any_value("sketch").alias("sketch"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("center"), F.count("*").alias("n")).filter("n > 1")
    members = work.cut(keyed.join(shared, "key").select("key", "node", "center"))
    stars = members.filter("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    tested = work.cut(_close(nodes, stars, percent))
    links, _ = _confirm(work, docs, nodes, tested, percent, id_col, text_col)
    roots = connected_components(work, links)
    for turn in range(_STARS + 1):
        rooted = work.cut(_several_roots(members, roots))
        if turn < _STARS:
            pairs = _close(nodes, _star_pairs(rooted, turn), percent)
        else:
            pairs = _rest_pairs(rooted, nodes, percent)
        fresh, n_fresh = _counted_cut(work, pairs.join(tested, ["a", "b"], "left_anti"))
        if not n_fresh:
            continue
        tested = tested.unionByName(fresh)
        links, n_links = _confirm(work, docs, nodes, fresh, percent, id_col, text_col)
        if not n_links:
            continue
        known = roots.select(F.col("root").alias("a"), F.col("node").alias("b"))
        roots = connected_components(work, links.unionByName(known))
    rooted = nodes.join(roots, "node", "left").select("digest", "rep", F.coalesce("root", "node").alias("root"))
    named = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = work.cut(rooted.join(named, "root").select("digest", "component_id", "root"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (
        rows.select("doc_id", "text_hash", "n_shingles", "digest")
        .join(classes, "digest", "left")
        .select(
            "doc_id",
            "text_hash",
            "root",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        )
    )


def keep_one_per_group(
    work: Workspace, docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of ``docs`` per group, all columns: that with the smallest id.

    Of several rows of the group with that id one stays, of the text with the least hash;
    an id that stands on texts of different groups is judged in each. Texts without
    words are in no group: of those equal in id and text one stays. Rows with a null id stay.
    """
    judged = work.result(_judged(work, docs, percent, id_col, text_col).filter("doc_id IS NOT NULL AND kept"))
    group = F.when(F.col("n_shingles") == 0, F.col("text_hash")).otherwise(F.col("root"))
    chosen = judged.groupBy("doc_id", F.col("n_shingles") == 0, group).agg(F.min("text_hash").alias("text_hash"))
    named = docs.filter(F.col(id_col).isNotNull())
    same = (named[id_col].cast("long") == chosen["doc_id"]) & (F.xxhash64(named[text_col].cast("string")) == chosen["text_hash"])
    kept = named.join(chosen.select("doc_id", "text_hash"), same, "left_semi")
    return kept.dropDuplicates([id_col, text_col]).unionByName(docs.filter(F.col(id_col).isNull()))
