"""SimHash near-duplicates: fingerprints at a few differing bits, joined into components.

Meet in the middle with radius 3: one fingerprint of a pair flips two bits, the other
one, and they meet on a common variant.  Two facts keep the balls small and lossless:

* Fingerprints at distance 1 or 3 have different parity, so only even ones need to
  flip two bits, and odd ones flip one.
* Of any three differing bits two lie in the same half of the word, so even ones flip
  two bits of one half only: 2 * C(32, 2) = 992 pairs and not 2016.

So an even fingerprint emits itself, 992 pairs and 64 single flips, an odd one 64 single
flips.  Pairs at distance 2 meet as well: odd ones on a single flip of each; even ones
either on one of them (both bits in one half) or on a single flip of each.

Distinct fingerprints only are expanded, and a variant is met by at most the 2081
fingerprints in its ball, so no group of variants grows with the input.  In a group,
every member whose flips make all its meetings true (a *hub*: an odd one, the variant
itself, or any single flip of even ones) lies within 3 bits of every other member, so
linking all members to the smallest hub loses no connection; groups without a hub are
pairs of two-flip ends whose true links meet at other variants.  Every link is verified.

Variants are shuffled by some of their bits (their bucket): a fingerprint is sent to each
bucket one of its variants lies in and expanded there, so that a few numbers travel and
not its thousand variants.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.llm.components import components, written
from entityloom.llm.words import LOWER, free_name, results, text_bytes
from entityloom.llm.workers import map_batches

MAX_BITS = 3
BUCKET_ROWS = 512
TASK_ROWS = 4096
CHUNK = 1 << 15
SPREAD = [(i // 2) + 32 * (i % 2) for i in range(64)]
ONE = np.uint64(1)


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of one text: the bits set in over half the hashes of its shingles."""
    plain = b" ".join(text.split())
    if not plain:
        return 0
    spaces = np.flatnonzero(np.frombuffer(plain, np.uint8) == 0x20)
    if len(spaces) < shingle:
        return xxhash.xxh64_intdigest(plain, 42)
    starts = np.concatenate([[0], spaces[: len(spaces) - shingle + 2] + 1]).tolist()
    ends = [*spaces[shingle - 1 :].tolist(), len(plain)]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(ends), CHUNK):
        pairs = zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=False)
        hashes = np.array([digest(plain[s:e], 42) for s, e in pairs], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in range(64) if 2 * counts[i] > len(ends))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3):
    """``key, fp``: the fingerprint of each whole text as a signed long.

    A-Z are lower-cased; words are split at ASCII white space; shingles count as often as
    they occur; fewer words than a shingle make one shingle; none (or null) give zero.
    """

    def make():
        def run(texts: pa.Array) -> list[pa.Array]:
            data, at = text_bytes(texts)
            low = LOWER[data].tobytes()
            values = [
                fingerprint(low[a:b], shingle) for a, b in zip(at[:-1], at[1:], strict=True)
            ]
            return [pa.array(np.array(values, np.uint64).view(np.int64))]

        return run

    return results(docs, key, text, make, "fp long")


def bucket_bits(count: int) -> list[int]:
    """The bits that name a bucket: so many that about ``BUCKET_ROWS`` fingerprints call
    each their home, taken from both halves in turn."""
    m = max(0, int(np.ceil(np.log2(max(1, count) / BUCKET_ROWS))))
    return SPREAD[: min(m, 40)]


def reached(fps: np.ndarray, bits: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints beside the buckets their variants lie in."""
    home = np.zeros(len(fps), np.int64)
    for i, bit in enumerate(bits):
        home |= ((fps >> np.uint64(bit)) & ONE).astype(np.int64) << i
    even = np.bitwise_count(fps) % 2 == 0
    buckets, kept = [home], [fps]
    for i, a in enumerate(bits):
        buckets.append(home ^ (1 << i))
        kept.append(fps)
        for j in range(i):
            if (a < 32) == (bits[j] < 32):
                buckets.append(home[even] ^ (1 << i) ^ (1 << j))
                kept.append(fps[even])
    return np.concatenate(buckets), np.concatenate(kept)


def masks(pairs: bool) -> np.ndarray:
    one = ONE << np.arange(64, dtype=np.uint64)
    if not pairs:
        return one
    i, j = np.triu_indices(64, 1)
    same = (i < 32) == (j < 32)
    return one[i[same]] | one[j[same]]


def met(fps: np.ndarray, bucket: int, bits: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Links (larger, smaller) found on the variants that lie in one bucket."""
    home = np.zeros(len(fps), np.int64)
    for i, bit in enumerate(bits):
        home |= ((fps >> np.uint64(bit)) & ONE).astype(np.int64) << i
    off = home ^ bucket  # the bucket bits that a variant has to flip
    even = np.bitwise_count(fps) % 2 == 0

    def flips(mask: np.ndarray) -> np.ndarray:
        out = np.zeros(len(mask), np.int64)
        for i, bit in enumerate(bits):
            out |= ((mask >> np.uint64(bit)) & ONE).astype(np.int64) << i
        return out

    single, double = masks(False), masks(True)
    variants, who, hub = [], [], []
    for mask, chosen, true in (
        (np.zeros(1, np.uint64), even, True),
        (single, np.ones(len(fps), bool), True),
        (double, even, False),
    ):
        need = flips(mask)
        for value in np.unique(off[chosen]):
            use, at = mask[need == value], np.flatnonzero(chosen & (off == value))
            if len(use) and len(at):
                variants.append((fps[at][:, None] ^ use[None, :]).ravel())
                who.append(np.repeat(at, len(use)).astype(np.int32))
                hub.append(np.full(len(at) * len(use), true))
    none = np.zeros(0, np.uint64)
    if not variants:
        return none, none
    variants, who, hub = np.concatenate(variants), np.concatenate(who), np.concatenate(hub)
    order = np.argsort(variants)
    new = np.ones(len(order), bool)
    v = variants[order]
    new[1:] = v[1:] != v[:-1]
    again = ~new
    again[:-1] |= ~new[1:]  # only variants that several fingerprints emit
    order, new = order[again], new[again]
    if not len(order):
        return none, none
    group = np.cumsum(new) - 1
    member, is_hub = fps[who[order]], hub[order]
    centre = np.full(group[-1] + 1, 2**64 - 1, np.uint64)
    has = np.zeros(group[-1] + 1, bool)
    np.minimum.at(centre, group[is_hub], member[is_hub])
    has[group[is_hub]] = True
    other = centre[group]
    real = has[group] & (member != other) & (np.bitwise_count(member ^ other) <= MAX_BITS)
    links = np.unique(np.stack([member[real], other[real]], 1), axis=0)
    return links[:, 0], links[:, 1]


def links(distinct: DataFrame, count: int) -> DataFrame:
    """``a, b``: links that connect what is within ``MAX_BITS`` bits; distinct: ``fp``."""
    bits = bucket_bits(count)

    def send(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            buckets, kept = reached(fps, bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets), pa.array(kept.view(np.int64))], ["bucket", "fp"]
            )

    def meet(key, table):
        fps = table.column("fp").combine_chunks().to_numpy().view(np.uint64)
        # A crowded bucket is expanded in slices by further bits, so memory stays bounded.
        more = max(0, int(np.ceil(np.log2(max(1, len(fps)) / TASK_ROWS))))
        finer = bits + [b for b in SPREAD if b not in bits][:more]
        found = [
            met(fps, key[0].as_py() | (i << len(bits)), finer)
            for i in range(1 << (len(finer) - len(bits)))
        ]
        a, b = (np.concatenate(x).view(np.int64) for x in zip(*found, strict=True))
        return pa.table({"a": a, "b": b})

    sent = map_batches(distinct, send, "bucket long, fp long")
    return sent.groupBy("bucket").applyInArrow(meet, "a long, b long")


def simhash_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``key, fingerprint, component_id``: one row per row of ``docs``.

    Fingerprints link at ``max_bits`` (3) or fewer differing bits; the component of a row
    is the smallest key reachable, its own included (null if all keys there are null).
    Texts without words have fingerprint zero and link like any other.  Rows with equal
    fingerprints, however many, are one node of the graph.
    """
    if max_bits != MAX_BITS:
        raise ValueError(f"the variants emitted are those for {MAX_BITS} bits")
    rows = written(fingerprints(docs, key, text, shingle), "simhash")
    nodes = written(rows.groupBy("fp").agg(F.min(key).alias("least")), "simhash-nodes")
    label = components(links(nodes.select("fp"), nodes.count()))
    joined = nodes.join(label.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("part")
    )
    lowest = joined.groupBy("part").agg(F.min("least").alias("component_id"))
    named = joined.join(lowest, "part").select("fp", "component_id")
    return rows.join(named, "fp", "left").select(
        key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_first(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest key; all columns stay.

    Of several rows with that key one stays.  Rows without a key are not compared and stay.
    """
    groups = simhash_groups(docs.where(F.col(key).isNotNull()), key, text, shingle, max_bits)
    groups = written(groups, "simhash-groups")
    name = free_name("least", docs.columns)
    first = groups.where(F.col(key) == F.col("component_id")).groupBy(F.col(key).alias(name))
    first = first.agg(F.count(F.lit(1)).alias("n"))
    lone, several = (first.where(condition).select(name) for condition in ("n = 1", "n > 1"))
    left = docs.join(lone, docs[key] == F.col(name), "left_semi")
    left = left.unionByName(docs.where(F.col(key).isNull()))
    if several.isEmpty():
        return left
    copies = docs.join(several, docs[key] == F.col(name), "left_semi")
    return left.unionByName(copies.dropDuplicates([key]))
