"""Exact copies by block naming.

A text, without its white space, is cut into blocks of a fixed number of code points.  The
distinct blocks of all texts are sorted, and each gets an integer, its name.  Then every two
adjacent names of a document form a pair, the distinct pairs are sorted and named in turn, and
so on until each document has one name left: equal names on the same level mean equal texts,
with nothing left to chance.

A block travels by a 64-bit hash.  Distinct blocks are compared by content; were two different
ones to share a hash, they get names by their order, and their documents are told apart by
content.  So the text is shuffled once, each task's repeated blocks as one, and every later
step moves numbers only: a pair stands for ``2 * BLOCK`` code points, then twice that, so the
levels together move about as many rows as there are blocks.

Edge cases: null counts as empty; empty texts (and those of white space alone) are one group;
a text of any length has as many levels as the logarithm of its blocks; equal rows are copies
of each other, of which one stays; a null id is kept as it is and loses every tie; an empty
table gives no rows; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from entityloom.llm.components import written

WHITE_SPACE = r"[\x20\x09-\x0D]+"
BLOCK = 4096
BUCKET_BITS = 20  # names are sorted in 2^20 buckets, wherever Spark puts them
NOTHING = -1  # the second name of a pair whose document has an odd number of them


def without_space(text: Column) -> Column:
    """The text without ``[\\x20\\x09-\\x0D]``; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WHITE_SPACE, "")


def blocks_of(text: Column, block: int) -> Column:
    """The text in blocks of ``block`` code points, the last one shorter; one empty block if empty."""
    # Possessive: the other forms recurse where characters of one and two units alternate.
    return F.when(text == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block}}}+"), F.lit(0))
    )


def numbered(distinct: DataFrame, by: list[str]) -> DataFrame:
    """``distinct`` rows with an integer ``name`` each: their place in the sorted order of a bucket."""
    bucket = F.pmod(F.xxhash64(by[0] if len(by) == 1 else F.struct(*by)), F.lit(1 << BUCKET_BITS))
    place = F.row_number().over(W.partitionBy("bucket").orderBy(*by)).cast("bigint") - 1
    return (
        distinct.withColumn("bucket", bucket)
        .withColumn("name", F.shiftleft(place, BUCKET_BITS).bitwiseOR(F.col("bucket")))
        .drop("bucket")
    )


def block_routes(texts: DataFrame, block: int, route) -> DataFrame:
    """``route, block`` of the distinct blocks of all texts ``t``."""
    cut = texts.select(F.explode(blocks_of(F.col("t"), block)).alias("block"))
    return cut.select(route(F.col("block")).alias("route"), "block").distinct()


def name_blocks(seen: DataFrame, routes: DataFrame) -> DataFrame:
    """``row, size, at, name`` of each block, where each route stands for one block."""
    places = seen.select("row", "size", F.posexplode("routes").alias("at", "route"))
    names = numbered(routes.select("route"), ["route"])
    return places.join(names, "route").select("row", "size", "at", "name")


def name_clashing(texts: DataFrame, seen: DataFrame, different: DataFrame, clash: DataFrame, block: int) -> DataFrame:
    """The same of blocks that share their route with another: named by content, below zero.

    ``texts`` must be a written table, so that its ``row`` is that of ``seen``.
    """
    told = numbered(different.join(clash, "route").select("block"), ["block"])
    told = told.select("block", (NOTHING - 1 - F.col("name")).alias("name"))
    places = texts.select("row", F.posexplode(blocks_of(F.col("t"), block)).alias("at", "block"))
    found = places.join(told, "block").join(seen.select("row", "size"), "row")
    return found.select("row", "size", "at", "name")


def name_pairs(names: DataFrame) -> DataFrame:
    """The next level: a name for every two adjacent names of a document."""
    half = F.shiftright("at", 1).alias("half")
    left = F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("left")
    right = F.max(F.when(F.col("at") % 2 == 1, F.col("name")))
    pairs = written(
        names.groupBy("row", "size", half).agg(left, F.coalesce(right, F.lit(NOTHING)).alias("right")),
        "pairs",
    )
    found = numbered(pairs.select("left", "right").distinct(), ["left", "right"])
    size = F.shiftright(F.col("size") + 1, 1).alias("size")
    return pairs.join(found, ["left", "right"]).select("row", size, F.col("half").alias("at"), "name")


def identities(names: DataFrame, blocks: int) -> DataFrame:
    """``row, level, name``: the same level and name exactly for equal texts.

    names: those of the blocks, of which no document has more than ``blocks``.
    """
    done, level = [], 0
    while True:
        done.append(names.where("size = 1").select("row", F.lit(level).alias("level"), "name"))
        if blocks <= 1:
            break
        names = written(name_pairs(names.where("size > 1")), "names")
        blocks, level = (blocks + 1) // 2, level + 1
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole


def exact_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    block: int = BLOCK,
    route=F.xxhash64,
) -> DataFrame:
    """``key, keep_id, group_size, kept, text_sha256, n_chars`` of each row of ``docs``.

    Texts equal without white space form a group.  The row with the most code points in the
    original text stays, then that of the smallest id (null last); of rows equal in both, one.
    ``route`` is the 64-bit hash by which blocks travel (tests use a poor one).
    """
    full = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), F.length(full).alias("chars"), without_space(full).alias("t"))
    rows = rows.select("*", F.monotonically_increasing_id().alias("row"))
    shared = block_routes(rows, block, route).groupBy("route").agg(F.count("*").alias("blocks"))
    shared = written(shared, "block-routes")
    clash = shared.where("blocks > 1").select("route")
    clashing = not clash.isEmpty()
    if clashing:  # next to never: the texts are read again then, so their rows must stay the same
        rows = written(rows, "documents-whole")
    routes = F.transform(blocks_of(F.col("t"), block), lambda b: route(b)).alias("routes")
    digest = F.sha2(F.encode("t", "UTF-8"), 256).alias("sha")
    seen = written(rows.select("row", "key", "chars", digest, routes), "documents-seen")
    seen = seen.withColumn("size", F.size("routes"))
    names = name_blocks(seen, shared.where("blocks = 1"))
    if clashing:
        different = block_routes(rows, block, route)
        names = names.unionByName(name_clashing(rows, seen, different, clash, block))
    whole = identities(written(names, "names"), seen.agg(F.max("size")).first()[0] or 1)
    members = seen.select("row", "key", "chars", "sha").join(whole, "row")
    first = F.struct(
        (-F.col("chars")).alias("order"), F.col("key").isNull().alias("unnamed"), "key", "row"
    )
    groups = members.groupBy("level", "name").agg(
        F.min(first).alias("first"), F.count("*").alias("group_size")
    )
    # Written, so that the join has a plain shuffle on either side and Spark can split a group
    # with very many rows at run time.
    groups = written(groups, "exact-groups")
    return members.join(groups, ["level", "name"]).select(
        F.col("key").alias(key),
        F.col("first.key").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
        F.col("chars").cast("bigint").alias("n_chars"),
    )


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged.

    Rows are found again by id, length and digest; of rows equal in these any one stays.
    """
    stays = exact_groups(docs, key, text).where("kept")
    stays = stays.select(F.struct(key, "n_chars", "text_sha256").alias("mark")).distinct()
    full = F.coalesce(docs[text].cast("string"), F.lit(""))
    mark = F.struct(
        docs[key].alias(key),
        F.length(full).cast("bigint").alias("n_chars"),
        F.sha2(F.encode(without_space(full), "UTF-8"), 256).alias("text_sha256"),
    )
    marked = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("whole"), mark.alias("mark"))
    one = marked.dropDuplicates(["mark"])
    found = one.join(stays, one["mark"].eqNullSafe(stays["mark"]), "left_semi")
    return found.select("whole.*")
