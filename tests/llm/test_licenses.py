"""License scans against all windows of all templates."""

import random

import pyarrow as pa
import pytest

from entityloom.llm import licenses
from tests.llm import brute


def templates():
    """Name, words, shingle length and distinct shingles of every text."""
    for name, texts in licenses.catalogue_texts().items():
        for text in texts:
            words = brute.alnum_words(text)
            k = min(5, len(words))
            yield name, len(words), k, {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def share_of(words, start, end, k, want):
    have = {tuple(words[i : i + k]) for i in range(start, min(end, len(words)) - k + 1)}
    return len(have & want) / len(want)


def broken_texts(rng, count):
    bodies = [t for texts in licenses.catalogue_texts().values() for t in texts]
    for _ in range(count):
        parts = []
        for _ in range(rng.randint(1, 4)):
            body = rng.choice(bodies).split()
            if rng.random() < 0.5:
                body[rng.randrange(len(body))] = "other"
            parts += body + [rng.choice(["the", "of", "x"]) for _ in range(rng.randint(0, 40))]
        yield " ".join(parts)


def test_equals_all_windows_at_every_word():
    """Each place holds what it says; places of a license are apart; a window of a template's
    length, at any word, that holds enough of it meets a place of that license."""
    rng, catalogues = random.Random(5), licenses.prepare()
    texts = [None, "", "Licensed under CC BY 4.0", "licensed under", "License " * 5000]
    texts += broken_texts(rng, 250)
    got = {}
    for owner, name, start, n, share in licenses.scan(pa.array(texts, pa.string()), catalogues):
        got.setdefault((owner, name), []).append((start, start + n, share))
    every = list(templates())
    met = 0
    for i, text in enumerate(texts):
        words = brute.alnum_words(text)
        for name, n, k, want in every:
            places = got.get((i, name), [])
            for start in range(max(1, len(words) - n + 1)):
                if share_of(words, start, start + n, k, want) >= 0.8:
                    met += 1
                    assert any(a < start + n and start < b for a, b, _ in places), (name, text)
        for name in {x[0] for x in every}:
            places = sorted(got.get((i, name), []))
            assert all(a[1] <= b[0] for a, b in zip(places, places[1:]))
            for a, b, share in places:
                shares = [share_of(words, a, b, k, want) for x, _, k, want in every if x == name]
                assert share >= 0.8 and max(shares) >= share - 1e-9
    assert met > 500


def test_every_copy_has_a_place():
    grant = licenses.TEMPLATES["MIT-grant"].split()
    header = grant[:30] + ["page"] * 20 + grant[30:]
    texts = [grant * 2, ["a"] + grant + ["b"] + grant, grant * 40, header, header * 3, grant[:30]]
    catalogues = licenses.prepare({"MIT": " ".join(grant)})
    found = licenses.scan(pa.array([" ".join(t) for t in texts]), catalogues)
    counts = [sum(r[0] == i for r in found) for i in range(len(texts))]
    assert counts == [2, 2, 40, 1, 3, 0]


@pytest.mark.parametrize(
    ("text", "name"),
    [
        ("This project is licensed under the MIT License", "MIT"),
        ("// SPDX-License-Identifier: MIT", "SPDX:MIT"),
        ("The MIT License (MIT)", "MIT"),
        (
            "Permission to use, copy, modify, and/or distribute this software for any purpose"
            " with or without fee is hereby granted, provided that the above copyright notice"
            " and this permission notice appear in all copies.",
            "ISC",
        ),
        ("under the GNU Lesser General Public License", "LGPL"),
    ],
)
def test_usual_notices_have_a_row(text, name):
    assert name in {r[1] for r in licenses.scan(pa.array([text]), licenses.prepare())}


def test_copies_on_both_sides_of_a_piece_and_repeated_rows(spark):
    long = "word " * 500_000 + licenses.TEMPLATES["ISC"][0] + " word" * 10
    rows = [(1, long), (1, long), (2, licenses.TEMPLATES["Zlib"])]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.license, r.start_word) for r in got) == [
        (1, "ISC", 500_000), (1, "ISC", 500_000), (2, "Zlib", 0)
    ]


def test_rows(spark):
    frame = spark.createDataFrame(
        [(1, "x Licensed under the Apache License, Version 2.0. y"), (2, None), (None, "a")],
        "doc_id long, text string",
    ).selectExpr("*", "1 as key", "2 as license")
    rows = licenses.scan_licenses(frame).collect()
    assert [(r.doc_id, r.license, r.containment) for r in rows] == [(1, "Apache-2.0", 1.0)]
    assert licenses.scan_licenses(frame.where("false")).count() == 0
