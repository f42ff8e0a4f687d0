"""Words that differ by one code point, and the common spelling of each.

Every word is a path in a trie and, read backwards, in a second one.  All nodes are numbered,
so a prefix and a suffix are two integers.  A word of length L gives L *skips*, the pairs
(prefix before i, suffix after i), and L + 1 *gaps*, the pairs (prefix before i, suffix from i).
Words with a skip in common differ at that place alone; a word whose gap is another's skip
lacks that code point.  The pairs are exact, so nothing is verified afterwards.

Under one pair meet the skips of words that differ in one code point, at most one for each
letter of the alphabet, and at most one gap: the word that prefix and suffix make up.  So a
pair's members are few whatever the data, and they are counted and ranked without writing out
who is near whom.  Deleting any of several equal neighbours gives the same word; only the
first of them counts (``fresh``), so no two words meet twice.

Edge cases: null and empty texts have no words; a text is read in pieces and a word of any
length costs its length; a null key counts as empty where it is used; repeated rows
count as often as they stand; an empty table gives no rows; other columns, whatever their
names, are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.llm.components import written
from entityloom.llm.tries import trie_nodes
from entityloom.llm.words import pieces
from entityloom.llm.workers import map_batches

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 5
LEAST_COUNT = 3
CHUNK = 1 << 20
MOST_HELD = 200_000  # distinct words a task holds before it passes its counts on

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def letter_runs(text: str) -> Iterator[list[str]]:
    """The maximal runs of letters of a text, A-Z lower-cased, a piece of the text at a time."""
    run, other = re.compile(f"[{LETTERS}]+"), re.compile(f"[^{LETTERS}]")
    start = 0
    while start < len(text):
        stop = other.search(text, start + CHUNK) if len(text) - start > CHUNK else None
        end = stop.start() if stop else len(text)
        yield run.findall(text[start:end].encode().translate(_LOWER).decode())
        start = end


def thinned(run: str, code: int, every: int) -> str:
    """The run without one code point if ``every`` divides its code, else as it is."""
    if code % every:
        return run
    at = code % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    damage: int | None = None,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """``word, n`` of the words of all texts that are long and common enough.

    With ``damage`` every run whose CRC-32 together with its document's key is divisible by it
    loses one code point first, so that there are misspellings to find.
    """

    def run(batches):
        held: Counter[str] = Counter()

        def batch():
            names = ["word", "n"]
            columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names)

        for rows in batches:
            for piece in pieces(rows, 1):
                for k, t in zip(piece.column(0), piece.column(1), strict=True):
                    before = crc32(f"{k.as_py() or ''}:".encode())
                    for runs in letter_runs(t.as_py() or ""):
                        found = Counter(runs)
                        if damage:
                            for one in list(found):
                                code = crc32(one.encode(), before)
                                if code % damage == 0:
                                    n = found.pop(one)
                                    held[thinned(one, code, damage)] += n
                        held.update(found)
                    if len(held) > MOST_HELD:
                        yield batch()
                        held.clear()
        if held:
            yield batch()

    rows = docs.select(F.col(key).cast("string").alias("k"), F.col(text).cast("string").alias("t"))
    counted = map_batches(rows, run, "word string, n bigint")
    long = counted.where(F.length("word") >= least_length)
    return long.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _members(words: DataFrame) -> DataFrame:
    """``prefix, suffix, place, less, fresh`` of all skips and gaps; ``fresh`` is null for gaps.

    words: ``word, place, n, ahead, back``, the nodes of the word read forwards and backwards.
    ``less`` is the negated count: members in the order of (less, place) are the best first.
    """
    size = F.size("ahead") - 1
    letters = F.slice(F.split("word", ""), 1, size)
    shifted = F.concat(F.array(F.lit("")), F.slice(letters, 1, size - 1))
    skips = F.arrays_zip(
        F.slice("ahead", 1, size).alias("prefix"),
        F.reverse(F.slice("back", 1, size)).alias("suffix"),
        F.zip_with(letters, shifted, lambda a, b: a != b).alias("fresh"),
    )
    gaps = F.arrays_zip(
        F.col("ahead").alias("prefix"),
        F.reverse("back").alias("suffix"),
        F.transform("ahead", lambda _: F.lit(None).cast("boolean")).alias("fresh"),
    )
    member = F.explode(F.concat(skips, gaps)).alias("m")
    rows = words.select("place", (-F.col("n")).alias("less"), member)
    return rows.select("m.prefix", "m.suffix", "place", "less", "m.fresh")


def near_words(words: DataFrame) -> DataFrame:
    """``place, n_near, best`` of the words that have a near one; ``best`` is (less, place).

    A near word differs by one inserted, deleted or replaced code point; the best is the one
    of the largest count, then the first in code-point order.
    """
    member = F.struct("less", "place")
    skip = F.col("fresh").isNotNull()
    pairs = _members(words).groupBy("prefix", "suffix").agg(
        # Bounded by the alphabet: members differ in one code point.
        F.array_sort(F.collect_list(F.when(skip, F.struct("less", "place", "fresh")))).alias("skips"),
        F.max(F.when(~skip, member)).alias("gap"),
    )
    pairs = pairs.where((F.size("skips") > 1) | ((F.size("skips") == 1) & F.col("gap").isNotNull()))

    def bare(s: Column) -> Column:
        return F.struct(s["less"].alias("less"), s["place"].alias("place"))

    def found(place: Column, n_near: Column, best: Column) -> Column:
        return F.struct(place.alias("place"), n_near.cast("bigint").alias("n_near"), best.alias("best"))

    def of_skip(s: Column) -> Column:
        met = s["fresh"] & F.col("gap").isNotNull()
        first = F.col("skips")[0]
        other = F.when(first["place"] != s["place"], bare(first)).otherwise(bare(F.get("skips", F.lit(1))))
        other = F.when(F.size("skips") > 1, other)
        return found(s["place"], F.size("skips") - 1 + met.cast("int"), F.least(other, F.when(met, F.col("gap"))))

    fresh = F.filter("skips", lambda s: s["fresh"])
    of_gap = F.when(
        F.col("gap").isNotNull() & (F.size(fresh) > 0),
        F.array(found(F.col("gap.place"), F.size(fresh), bare(F.get(fresh, F.lit(0))))),
    ).otherwise(F.array())
    each = pairs.select(F.explode(F.concat(F.transform("skips", of_skip), of_gap)).alias("f"))
    each = each.where("f.n_near > 0").select("f.place", "f.n_near", "f.best")
    return each.groupBy("place").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """``place, root``: where each chain of ``place, to`` ends.  Pointers double each round."""
    now = links.select("place", F.col("to").alias("root"))
    while True:
        ahead = now.select(F.col("place").alias("root"), F.col("root").alias("beyond"))
        step = now.join(ahead, "root", "left").select(
            "place", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")
        )
        step = written(step, "roots")
        now = step.select("place", "root")
        if step.where("moved").isEmpty():
            return now


def spelling_variants(words: DataFrame, factor: int = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each of ``words`` (``word, n``, distinct).

    A word's form is its near word of the largest count, if that is ``factor`` (2 or more) times
    its own at least; forms only get more frequent, so following them ends, at the root.
    """
    if factor < 2:
        raise ValueError("a factor below 2 allows forms in a circle")
    words = written(words.where("word <> ''").select("word", "n"), "words")
    ahead = trie_nodes(words)
    back = trie_nodes(words.select(F.reverse("word").alias("word"), "n"))
    back = back.select(F.reverse("word").alias("word"), F.col("nodes").alias("back"))
    both = ahead.select("word", "place", "n", F.col("nodes").alias("ahead")).join(back, "word")
    near = near_words(both)
    known = ahead.select("word", "place", "n").join(near, "place", "left")
    close = -F.col("best.less") >= F.col("n") * factor
    known = written(
        known.select(
            "word",
            "place",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(close, F.col("best.place")).alias("to"),
            F.when(close, -F.col("best.less")).alias("form_n"),
        ),
        "near-words",
    )
    ends = roots(known.where("to is not null").select("place", "to"))
    named = known.select(F.col("place").alias("at"), F.col("word").alias("name"))
    forms = named.select(F.col("at").alias("to"), F.col("name").alias("form"))
    tops = named.select(F.col("at").alias("root"), F.col("name").alias("top"))
    rows = known.join(forms, "to", "left").join(ends, "place", "left").join(tops, "root", "left")
    return rows.select(
        "word", "form", F.coalesce("top", "word").alias("root"), "n", "n_near", "form_n"
    )
