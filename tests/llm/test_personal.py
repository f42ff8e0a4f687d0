"""Personal data against the plain patterns."""

import random
import time

from entityloom.llm import personal
from tests.llm import brute


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(3)
    for i in range(20_000):
        letters = "0123456789 -." if i % 3 == 0 else "aZ09.@+- ()%é4123"
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        found = personal.spans(text)
        assert {k: [x[:2] for x in found[k]] for k in personal.BASE} == brute.personal(text), text


def test_checksums_and_context():
    assert personal.mod97("GB82WEST12345698765432") and not personal.mod97("GB83WEST12345698765432")
    found = personal.spans("Bank: GB82 WEST 1234 5698 7654 32, or GB83 WEST 1234 5698 7654 32.")
    assert [x[:2] for x in found["iban"]] == [(6, 33)]
    assert personal.spans("call 555-123-4567")["local_phone"]
    assert not personal.spans("order 555-123-4567")["local_phone"]
    near = personal.spans("visa 4111 1111 1111 1111")["card"][0][2]
    assert near > personal.spans("4111 1111 1111 1111")["card"][0][2]


def test_long_runs_take_linear_time():
    start = time.perf_counter()
    for text in ("1" * 200_000, "a" * 200_000, "a.b@" * 50_000, "+1 " * 50_000, "A" * 200_000):
        personal.spans(text)
    assert time.perf_counter() - start < 20


def test_digest_and_mask(spark):
    docs = [
        (1, "é mail a.b@c.de or +1 (555) 555-1234", 36),
        (2, None, None),
        (3, "", 0),
        (4, "1.2.3.4", 7),
        (4, "1.2.3.4", 7),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string, masked int")
    rows = {r.doc_id: r for r in personal.personal_digest(frame).collect()}
    assert rows[1].spans == "email:7:15,phone:19:36"
    assert (rows[1].n_email, rows[1].n_phone, rows[4].n_ip) == (1, 1, 1)
    assert rows[2].base_sha256 == rows[3].base_sha256 and rows[2].spans == ""
    masked = personal.mask_personal(frame, length="masked").collect()
    assert sorted(map(tuple, masked), key=repr) == sorted(
        [
            (1, "é mail <EMAIL> or <PHONE>", 25),
            (2, None, None),
            (3, "", 0),
            (4, "<IP>", 4),
            (4, "<IP>", 4),
        ],
        key=repr,
    )
    assert personal.personal_digest(frame.where("false")).count() == 0


def test_ibans_next_to_each_other():
    one, two = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"
    for text in (f"{one} {two}", f"AB12 {two}", f"DE88{one[4:]} {two}", f"x {two} {one} {one}"):
        found = [text[a:b] for a, b in personal.ibans(text)]
        want = sorted((text.find(x, i), x) for x in (one, two) for i in range(len(text)) if text.startswith(x, i))
        assert found == [x for _, x in want] and found


def test_time_follows_the_number_of_spans():
    def seconds(n):
        text = " ".join(f"a{i}@b.org call 555-{i % 900 + 100}-{i % 9000 + 1000}" for i in range(n))
        start = time.perf_counter()
        found = personal.spans(text)
        assert len(found["email"]) == n
        return time.perf_counter() - start

    seconds(500)
    assert seconds(16_000) < 4 * max(seconds(8_000), 0.1)


def test_overlaps_are_found_as_by_comparing_all():
    rng = random.Random(1)
    for _ in range(300):
        some = [(a, a + rng.randint(1, 6)) for a in (rng.randrange(60) for _ in range(rng.randrange(8)))]
        ranges = personal.merged(some)
        starts = [a for a, _ in ranges]
        for a in range(60):
            b = a + rng.randint(1, 5)
            want = any(a < y and x < b for x, y in some)
            assert personal.meets(ranges, starts, a, b) == want
