"""Near-duplicate vectors: inverted lists, product-quantised residuals, exact rerank.

Vectors are scaled to length one, so a cosine of at least ``c`` is a distance of at most
``r = sqrt(2 - 2c)``.  Each vector lies in the list of its nearest coarse centre, with its
residual coded by one centre in each subspace and the length ``e`` of what the code leaves.

What is compared:

* A neighbour of q lies in list c only if q is within ``r`` of the plane between c and q's own
  centre.  In high dimensions these are most lists, and sending q to all of them makes the
  shuffle grow with the square of the table.  So of them q probes its nearest ones, as many as
  prove sufficient: ``JUDGES`` vectors are held against all rows, in blocks, and the rank of the
  list in which each of their links would be found is counted.  Twice the number that finds
  ``FOUND`` of these links, ``LEAST_PROBED`` at least, is probed.  ``probed=None`` probes all lists within reach and loses
  no link whatever the data.
* Lists near each other form a group; q is sent to a group once, and finds there which of its
  lists to compare with.
* Probing is mutual: of two groups only one sends its vectors to the other, and a link found
  counts at both its ends.
* The table-lookup distance of q to a coded vector is off by at most ``e``, so what it puts
  farther than ``r + e`` is no neighbour.  The rest is reranked by the exact cosine, so
  every link found is one.

Centres are trained on at most ``SAMPLE`` vectors; all vectors are indexed and are queries.

Equal vectors are one class with a count.  A group's members and the queries that probe it are
dealt into chunks of about ``CHUNK`` and ``ASKED * CHUNK``, and each pair of chunks is one task's work, so a list
with a third of all vectors is spread too.  Vectors travel in single precision where that
loses nothing.  A task returns sums of links and a forest of them
(one row a vector at most), never its pairs.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.llm.components import components, written
from entityloom.llm.samples import lowest
from entityloom.llm.workers import map_batches

COSINE = 0.95
SAMPLE = 20_000
MOST_LISTS = 4096
JUDGES = 1000
FOUND = 0.999
LEAST_PROBED = 64
MEASURED = "measured"
SUBSPACE = 8
CODES = 64
TOGETHER = 8  # lists of a group
CHUNK = 4096
ASKED = 4
BLOCK = 512
SLACK = 1e-6
ROUNDING = 1e-4  # of squared distances in single precision


class Index(NamedTuple):
    centres: np.ndarray
    spaces: list[np.ndarray]  # the dimensions of each subspace
    books: list[np.ndarray]  # the centres of each subspace
    group: np.ndarray  # the group of each list
    asks: np.ndarray  # whether the vectors of one group are sent to another


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; large and tiny numbers do not overflow."""
    scaled = vectors.astype(np.float64)
    scaled /= np.abs(scaled).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * rows @ centres.T).argmin(axis=1)


def kmeans(rows: np.ndarray, k: int, rng: np.random.Generator, turns: int = 8) -> np.ndarray:
    """Centres of at most ``k`` clusters; an empty one moves to a random row."""
    k = min(k, len(rows))
    centres = rows[rng.choice(len(rows), k, replace=False)].copy()
    for _ in range(turns):
        mine = np.concatenate(
            [nearest(rows[i : i + 8192], centres) for i in range(0, len(rows), 8192)]
        )
        count = np.bincount(mine, minlength=k)
        for d in range(rows.shape[1]):
            centres[:, d] = np.bincount(mine, rows[:, d], k) / np.maximum(count, 1)
        for i in np.flatnonzero(count == 0):
            centres[i] = rows[rng.integers(len(rows))]
    return centres


def train(sample: np.ndarray, lists: int, seed: int = 13) -> Index:
    rng = np.random.default_rng(seed)
    centres = kmeans(sample, lists, rng)
    rest = sample - centres[nearest(sample, centres)]
    spaces = np.array_split(np.arange(sample.shape[1]), -(-sample.shape[1] // SUBSPACE))
    books = [kmeans(rest[:, s], CODES, rng) for s in spaces]
    group = nearest(centres, kmeans(centres, -(-len(centres) // TOGETHER), rng))
    a, b = np.indices((group.max() + 1,) * 2)
    asks = (a == b) | ((a < b) == ((a + b) % 2 == 0))
    return Index(centres, spaces, books, group, asks)


def encode(rows: np.ndarray, home: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Codes, and the length of what the codes leave, of each row of the list ``home``."""
    rest = rows - index.centres[home]
    codes = np.stack(
        [nearest(rest[:, s], b) for s, b in zip(index.spaces, index.books, strict=True)], axis=1
    )
    for i, (s, b) in enumerate(zip(index.spaces, index.books, strict=True)):
        rest[:, s] -= b[codes[:, i]]
    return codes.astype(np.uint8), np.sqrt((rest**2).sum(axis=1))


def probes(rows: np.ndarray, home: np.ndarray, index: Index, cells: np.ndarray, radius: float):
    """Which of the lists ``cells`` may hold a neighbour of which row: a table of flags."""
    c, out = index.centres[cells], np.empty((len(rows), len(cells)), bool)
    for at in range(0, len(rows), 2048):
        some, own = rows[at : at + 2048], index.centres[home[at : at + 2048]]
        square = (c**2).sum(axis=1) - 2 * some @ c.T
        mine = (own**2).sum(axis=1) - 2 * (some * own).sum(axis=1)
        apart = (own**2).sum(axis=1)[:, None] + (c**2).sum(axis=1) - 2 * own @ c.T
        apart = np.sqrt(np.maximum(apart, 0))
        out[at : at + 2048] = square - mine[:, None] <= 2 * radius * apart + SLACK
    return out


def nearest_lists(rows: np.ndarray, cells: np.ndarray, index: Index, most: int) -> np.ndarray:
    """Which of the lists ``cells`` are among the ``most`` nearest of each row: a table of flags."""
    c, out = index.centres[cells], np.zeros((len(rows), len(cells)), bool)
    for at in range(0, len(rows), 2048):
        far = (c**2).sum(axis=1) - 2 * rows[at : at + 2048] @ c.T
        few = np.argpartition(far, min(most, len(cells)) - 1, axis=1)[:, :most]
        np.put_along_axis(out[at : at + 2048], few, True, axis=1)
    return out


def asked_groups(
    rows: np.ndarray, home: np.ndarray, index: Index, radius: float, most: int | None = None
):
    """Pairs of a row and a group it is sent to: one with a list it probes, and of those, with
    ``most``, one that holds any of the row's nearest lists."""
    order = np.argsort(index.group, kind="stable")
    near = probes(rows, home, index, order, radius)
    if most is not None:
        near &= nearest_lists(rows, order, index, most)
    first = np.unique(index.group[order], return_index=True)
    asked = np.zeros((len(rows), len(index.asks)), bool)
    asked[:, first[0]] = np.logical_or.reduceat(near, first[1], axis=1)
    return np.nonzero(asked & index.asks[index.group[home]])


def packed(rows: np.ndarray) -> list[bytes]:
    """Each row's bytes, in single precision where that loses nothing."""
    with np.errstate(over="ignore"):
        single = rows.astype(np.float32)
        same = (single.astype(np.float64) == rows).all()
    return [row.tobytes() for row in (single if same else rows)]


def unpacked(raw: list[bytes], width: int) -> np.ndarray:
    """The rows that ``packed`` made bytes of, in double precision."""
    kinds = {4 * width: np.float32, 8 * width: np.float64}
    if len({len(x) for x in raw}) == 1:
        one = np.frombuffer(b"".join(raw), kinds[len(raw[0])])
        return one.reshape(len(raw), width).astype(np.float64)
    return np.stack([np.frombuffer(x, kinds[len(x)]).astype(np.float64) for x in raw])


def products(query: np.ndarray, index: Index) -> np.ndarray:
    """Products of queries with every subspace's centres, (subspace, code, query)."""
    out = np.empty((len(index.spaces), max(map(len, index.books)), len(query)), np.float32)
    for i, (s, b) in enumerate(zip(index.spaces, index.books, strict=True)):
        out[i, : len(b)] = b @ query[:, s].T
    return out


def linked(query, member, codes, left, tables, index: Index, cell: int, cosine: float):
    """Which members of one list link to which queries: a table of flags.

    A query's squared distance to a coded member is that to the list's centre, a constant of
    the member, and twice the looked-up products off.
    """
    centre = index.centres[cell]
    constant = np.zeros(len(member))
    total = np.zeros((len(member), len(query)), np.float32)
    for i, (s, b) in enumerate(zip(index.spaces, index.books, strict=True)):
        constant += (2 * b @ centre[s] + (b**2).sum(axis=1))[codes[:, i]]
        total += tables[i][codes[:, i]]
    most = (np.sqrt(2 - 2 * cosine) + left + SLACK) ** 2 + ROUNDING
    far = ((query - centre) ** 2).sum(axis=1)
    least = ((constant - most)[:, None] + far).astype(np.float32)
    near = 2 * total >= least
    if near.mean() > 0.01:
        return near & (member @ query.T >= cosine)
    i, j = np.nonzero(near)
    near[i, j] = np.einsum("ij,ij->i", member[i], query[j]) >= cosine
    return near


def forest(left: np.ndarray, right: np.ndarray):
    """For each node with a link, the smallest node that these links reach."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = at[: len(left)], at[len(left) :]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def ranks(rows: np.ndarray, group: np.ndarray, index: Index) -> np.ndarray:
    """How many of its nearest lists each row has to probe to be sent to the group."""
    c = index.centres
    far = (c**2).sum(axis=1) - 2 * rows @ c.T
    goal = np.where(index.group == group[:, None], far, np.inf).min(axis=1)
    return (far < goal[:, None]).sum(axis=1) + 1


def links_by_rank(classes: DataFrame, judges: np.ndarray, index, cosine: float) -> DataFrame:
    """``rank, links``: links of the judges to all rows, by the lists that must be probed to
    find them; 0 where both ends lie in one group.  The judges meet every row, in blocks."""

    def run(batches):
        own = nearest(judges, index.value.centres)
        groups, asks = index.value.group, index.value.asks
        total = np.zeros(len(index.value.centres) + 1, np.int64)
        for batch in batches:
            column = batch.column("embedding")
            every = column.flatten().to_numpy().reshape(len(column), -1)
            for at in range(0, len(every), BLOCK * 4):
                rows = unit(every[at : at + BLOCK * 4])
                same = judges @ rows.T
                i, j = np.nonzero((same >= cosine) & (same < 1 - 1e-12))
                if not len(i):
                    continue
                home = nearest(rows[j], index.value.centres)
                from_group, to_group = groups[own[i]], groups[home]
                asked = asks[from_group, to_group]
                rank = np.zeros(len(i), np.int64)
                there, here = np.flatnonzero(asked), np.flatnonzero(~asked)
                rank[there] = ranks(judges[i[there]], to_group[there], index.value)
                rank[here] = ranks(rows[j[here]], from_group[here], index.value)
                rank[from_group == to_group] = 0
                total += np.bincount(rank, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"rank": at, "links": total[at]})

    met = map_batches(classes.select("embedding"), run, "rank long, links long")
    return met.groupBy("rank").agg(F.sum("links").alias("links"))


def sufficient(links: list[tuple[int, int]]) -> int:
    """Lists to probe, from the links found at each rank."""
    links = sorted(links)
    counts = np.cumsum([n for _, n in links])
    if not len(counts):
        return LEAST_PROBED
    need = links[int(np.searchsorted(counts, FOUND * counts[-1] - 1e-9))][0]
    return max(LEAST_PROBED, 2 * need)


ROW = (
    "group int, mine int, theirs int, member boolean, node long, copies long, home int,"
    " vector binary"
)


def near_links(
    classes: DataFrame, count: int, cosine: float, margin: float, probed: int | str | None
) -> tuple[DataFrame, DataFrame]:
    """Sums of linked copies by node, and links that connect the same components.

    classes: ``node, copies, embedding`` of one dimension, distinct and non-zero.
    """
    spark = classes.sparkSession
    hashed = classes.select("node", "embedding", F.xxhash64("node").alias("at"))
    some = lowest(hashed, "at", SAMPLE, count)
    got = some.toArrow().sort_by("node")["embedding"].combine_chunks()
    sample = unit(got.flatten().to_numpy().reshape(len(got), -1))
    lists = int(np.clip(np.sqrt(count), 1, MOST_LISTS))
    index = spark.sparkContext.broadcast(train(sample, lists))
    radius = margin * np.sqrt(2 - 2 * cosine)  # how near a plane is probed
    most = probed
    if probed == MEASURED:
        # Few lists are all probed anyway.
        judges = sample[:: -(-len(sample) // JUDGES)]
        found = links_by_rank(classes, judges, index, cosine) if lists > LEAST_PROBED else None
        most = sufficient([tuple(r) for r in found.collect()]) if found is not None else None

    def given(batch):
        column = batch.column("embedding")
        return column.flatten().to_numpy().reshape(len(column), -1)

    def sizes(batches):
        for batch in batches:
            if batch.num_rows:
                rows = unit(given(batch))
                home = nearest(rows, index.value.centres)
                _, asked = asked_groups(rows, home, index.value, radius, most)
                n = len(index.value.asks)
                yield pa.RecordBatch.from_pydict(
                    {
                        "group": np.arange(n),
                        "members": np.bincount(index.value.group[home], minlength=n),
                        "queries": np.bincount(asked, minlength=n),
                    }
                )

    counted = map_batches(classes, sizes, "group long, members long, queries long")
    found = counted.groupBy("group").agg(F.sum("members").alias("m"), F.sum("queries").alias("q"))
    parts = np.ones((2, MOST_LISTS), np.int64)
    for r in found.collect():  # one row a group
        parts[:, r["group"]] = max(1, -(-r.m // CHUNK)), max(1, -(-r.q // (ASKED * CHUNK)))

    def deal(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = unit(given(batch))
            node = batch.column("node").to_numpy()
            home = nearest(rows, index.value.centres)
            who, asked = asked_groups(rows, home, index.value, radius, most)
            members = np.arange(len(rows)), index.value.group[home]
            spot = (node * 0x9E3779B1 + (node >> 17)) & 0x7FFFFFFF
            raw = packed(given(batch))
            for member, row, cell in ((True, *members), (False, who, asked)):
                own, other = (0, 1) if member else (1, 0)
                times = parts[other][cell]
                ends = np.cumsum(times)
                copy = np.arange(ends[-1]) - np.repeat(ends - times, times)
                row, cell = np.repeat(row, times), np.repeat(cell, times)
                mine = spot[row] % parts[own][cell]
                a, b = (mine, copy) if member else (copy, mine)
                for at in range(0, len(row), 8192):
                    cut = slice(at, at + 8192)
                    part = row[cut]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(cell[cut], pa.int32()),
                            pa.array(a[cut], pa.int32()),
                            pa.array(b[cut], pa.int32()),
                            pa.array(np.full(len(part), member)),
                            pa.array(node[part], pa.int64()),
                            batch.column("copies").take(pa.array(part)),
                            pa.array(home[part], pa.int32()),
                            pa.array([raw[i] for i in part.tolist()], pa.binary()),
                        ],
                        ["group", "mine", "theirs", "member", "node", "copies", "home", "vector"],
                    )

    def compare(key, table):
        member = table.column("member").combine_chunks().to_numpy(zero_copy_only=False)
        node = table.column("node").combine_chunks().to_numpy()
        copies = table.column("copies").combine_chunks().to_numpy()
        raw = table.column("vector").to_pylist()
        rows = unit(unpacked(raw, index.value.centres.shape[1]))
        home = table.column("home").combine_chunks().to_numpy()
        m, q = np.flatnonzero(member), np.flatnonzero(~member)
        cells = np.unique(home[m])
        near = probes(rows[q], home[q], index.value, cells, radius)
        same = index.value.group[home[q]] == key[0].as_py()
        links, sums = [(node[:0], node[:0])], np.zeros(len(node))
        lists = [m[home[m] == cell] for cell in cells]
        coded = [encode(rows[b], home[b], index.value) for b in lists]
        for at in range(0, len(q), BLOCK):
            tables = products(rows[q[at : at + BLOCK]], index.value)
            for number, cell in enumerate(cells.tolist()):
                b, (codes, left) = lists[number], coded[number]
                some = np.flatnonzero(near[at : at + BLOCK, number])
                a = q[at + some]
                few = tables[:, :, some]
                flags = linked(rows[a], rows[b], codes, left, few, index.value, cell, cosine)
                # A pair of one group meets twice, a vector itself; other pairs meet once.
                flags &= ~same[at + some] | (node[a] < node[b][:, None])
                j, i = np.nonzero(flags)
                if len(i):
                    links.append(forest(node[a[i]], node[b[j]]))
                    sums += np.bincount(a[i], copies[b[j]], len(node))
                    sums += np.bincount(b[j], copies[a[i]], len(node))
        nodes, low = forest(*(np.concatenate(x) for x in zip(*links, strict=True)))
        total, has = np.zeros(len(nodes), np.int64), np.flatnonzero(sums)
        np.add.at(total, np.searchsorted(nodes, node[has]), sums[has].astype(np.int64))
        return pa.table({"node": nodes, "low": low, "links": total})

    dealt = map_batches(classes, deal, ROW).groupBy("group", "mine", "theirs")
    met = written(dealt.applyInArrow(compare, "node long, low long, links long"), "vector-links")
    sums = met.groupBy("node").agg(F.sum("links").alias("links"))
    return sums, met.where("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b"))


def vector_groups(
    vectors: DataFrame,
    key: str = "vec_id",
    embedding: str = "embedding",
    cosine: float = COSINE,
    margin: float = 1.0,
    probed: int | str | None = MEASURED,
) -> DataFrame:
    """``key, n_links, component_id, kept``: one row per row of ``vectors``.

    Two rows link if the cosine of their vectors is at least ``cosine`` (above 0), in double
    precision.  Lists within ``margin`` times the linking distance are probed; 1 loses no
    link, and less is refused.  Of these a vector probes as many of the nearest as prove
    sufficient, or ``probed`` of them, or with None all: see above; the README has the recall
    against all pairs.  ``component_id`` is the smallest key reachable, its own included.  Vectors that
    are null, empty or zero or hold null or non-finite numbers link with nothing, and vectors
    of different dimension never link.  Repeated rows link as rows.  A null key is never the
    smallest and its row is not kept.
    """
    if not margin >= 1:
        raise ValueError("a margin below 1 loses links")
    rows = vectors.select(
        F.col(key).alias("key"), F.col(embedding).cast("array<double>").alias("embedding")
    )

    def bad(x):
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    usable = (
        F.col("embedding").isNotNull()
        & ~F.coalesce(F.exists("embedding", bad), F.lit(True))
        & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    )
    classes = (
        rows.where(usable)
        .groupBy("embedding")
        .agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.monotonically_increasing_id())
        .withColumn("size", F.size("embedding"))
    )
    classes = written(classes, "vector-classes")
    sizes = classes.groupBy("size").count().collect()  # one row a dimension
    sums = links = None
    for size in sorted(sizes, key=lambda r: r["size"]):
        part = classes.where(F.col("size") == size["size"])
        more, pairs = near_links(part, size["count"], cosine, margin, probed)
        sums = more if sums is None else sums.unionByName(more)
        links = pairs if links is None else links.unionByName(pairs)
    if sums is None:
        named = classes.select(
            "embedding", "copies", F.lit(0).alias("links"), F.col("least").alias("component")
        )
    else:
        label = components(links)
        joined = (
            classes.join(sums, "node", "left")
            .join(label, "node", "left")
            .withColumn("part", F.coalesce("component", "node"))
        )
        low = joined.groupBy("part").agg(F.min("least").alias("low"))
        named = joined.join(low, "part").select(
            "embedding",
            "copies",
            F.coalesce("links", F.lit(0)).alias("links"),
            F.col("low").alias("component"),
        )
    done = rows.withColumn("usable", usable).join(
        named.withColumn("usable", F.lit(True)), ["embedding", "usable"], "left"
    )
    component = F.when(F.col("copies").isNull(), F.col("key")).otherwise(F.col("component"))
    return done.select(
        F.col("key").alias(key),
        F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"),
    )
