"""Personal data against plain Python: the base by the contract's patterns, the method by its own arithmetic, and what it should find."""

import random

import brute_pii
import pytest

from tagloom.llm import pii as P
from tagloom.llm.common import release_scratch

SCHEMA = "doc_id bigint, text string, kind string, _row string, start string, private string"
COLUMNS = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_more"]
CARD = "4539 1488 0343 6467"
ODD = [
    (1, "a@b.c@d.e and a@b.c_x@d.e.f, x%y+z@q-r.s.t. @a.b a@b a@.c a@b..c"), (2, None), (3, ""), (3, "same id, +49 (30) 1234-5678 here"), (None, "j@k.lm"), (None, "j@k.lm"),
    (4, "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3 .1.2.3.4. 10.0.0.1"), (5, f"{CARD} {CARD.replace(' ', '-')} {CARD.replace(' ', '')}0 4539  1488"),
    (6, "4539148803436467" * 3), (7, "+1 (482) 555-7163 +1 +12345678 +1234567 +1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6 ++49 30 123456 +4 5 6 7 8 9 0 1 ."),
    (8, "😀 née j.d@x.org 日本 1.1.1.1 é +33 1 23 45 67 89"), *[(i + 9, t * 60) for i, t in enumerate(["x", "1", "1.", "a@", "+1 2", "a@b.c", "1 ", "Aa ", "DE12"])],
    (20, "+1" + " 2" * 60), (21, "a@b" + ".c" * 60), (22, "DE" + "12" * 50),
]


@pytest.fixture(autouse=True)
def scratch(spark):
    yield
    release_scratch(spark)


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "k", "r", "s", "p") for i, t in docs], SCHEMA).repartition(4)


def check(spark, docs):
    got = P.pii(frame(spark, docs))
    assert got.columns == COLUMNS
    rows, want = (sorted(map(tuple, x), key=str) for x in (got.collect(), brute_pii.judged(docs)))
    for a, b in zip(rows, want, strict=True):
        assert a == b, (a[0], str(a)[:400], str(b)[:400])


def prose(rnd, n):
    return " ".join(rnd.choice("the boat left harbour at dawn and crew sang of home while wind rose over grey water".split()) for _ in range(n))


def planted(seed=1, n=300):
    rnd = random.Random(seed)
    given, family = ["Anna", "Peter", "Maria", "José", "Sophie", "Klaus"], ["Miller", "Berger", "Dupont", "Moreno", "Ostrow"]
    docs = []
    for i in range(n):
        name = f"{rnd.choice(given)} {rnd.choice(family)}"
        line = [
            f"contact {name.split()[0].lower()}.{i}@gmail.com today", f"login from 81.{i % 200}.7.9 seen", f"paid by card {CARD} then",
            f"call +49 30 12345{i:03d} soon", f"born {1 + i % 28}.0{1 + i % 9}.19{50 + i % 40} in", f"letter of Mr {name} about", f"signed by {name} and",
            f"lives at {1 + i % 90} Harbour Hill Street since", "account DE89 3704 0044 0532 0130 00 held", f"ssn 123-45-{6000 + i} on file",
            f"phone ({200 + i % 700}) 555-{1000 + i} please", f"version 1.2.3.{i % 250} of", f"figure 123-45-{6000 + i} shows", f"The Boat and Our {rnd.choice(family)} went",
            f"order {i % 28 + 1}.0{1 + i % 9}.2019 page", "Grey Water rose", prose(rnd, 3)][i % 17]
        docs.append((i, f"{prose(rnd, rnd.randrange(4, 30))} {line} {prose(rnd, rnd.randrange(4, 30))}."))
    return docs


def test_odd_texts(spark):
    check(spark, ODD)


def test_very_long_texts_take_linear_time(spark):
    long = {"x" * 300_000: "", "1" * 300_000: "", "1." * 100_000: None, "a@" * 100_000: "", "+1" + " 2" * 100_000: "", "a@b" + ".c" * 100_000: "email:0:200003",
            "1 " * 100_000: "", "A" * 100_000 + " " + "Aa " * 50_000: "", "DE" + "12" * 100_000: "", "x" * 200_000 + "@y.z": "email:0:200004"}
    docs = list(enumerate(long))
    got = {r.doc_id: r.spans for r in P.pii(frame(spark, docs)).collect()}
    wrong = [(i, want, got[i][:80]) for i, want in enumerate(long.values()) if want is not None and got[i] != want]
    assert not wrong
    assert got[2].startswith("ip:0:7,ip:8:15,")


def test_method_by_its_own_arithmetic(spark):
    check(spark, planted() + ODD[:9])


def test_planted_data_is_found_and_clean_documents_are_left_alone(spark):
    rows = {r.doc_id: r for r in P.pii(frame(spark, planted(2, 680))).collect()}
    added = {i: sum(rows[j].n_more > 0 for j in range(i, 680, 17)) / 40 for i in range(17)}
    for i in (4, 5, 6, 7, 8, 9, 10):  # born, Mr, signed by, lives at, account, ssn, phone
        assert added[i] >= 0.9, (i, added)
    for i in (0, 1, 2, 3, 11, 12, 13, 14, 15, 16):
        assert added[i] <= 0.05, (i, added)


def test_redact_replaces_spans_in_place(spark):
    docs = [(1, "mail a@b.cd now"), (2, None), (3, "nothing"), (1, "mail a@b.cd now"), (None, f"😀 {CARD}!")]
    got = sorted(map(tuple, P.redact(frame(spark, docs)).select("doc_id", "text").collect()), key=str)
    assert got == sorted([(1, "mail <email> now"), (2, None), (3, "nothing"), (1, "mail <email> now"), (None, "😀 <card>!")], key=str)


def test_empty_table(spark):
    assert P.pii(frame(spark, [(1, "a")]).where("false")).count() == 0


def test_estimate_recovers_how_labelers_vote():
    rnd = random.Random(3)
    counts = {}
    for _ in range(20_000):
        y = rnd.random() < 0.3
        chances = [((0.05, 0.1, 0.85), (0.7, 0.2, 0.1)), ((0.1, 0.3, 0.6), (0.3, 0.6, 0.1)), ((0.1, 0.5, 0.4), (0.2, 0.7, 0.1)), ((0.0, 1.0, 0.0),) * 2, ((0.0, 1.0, 0.0),) * 2]
        v = tuple(rnd.choices((-1, 0, 1), c[0] if y else c[1])[0] for c in chances)
        counts.setdefault(v, [0, 0])[y] += 1
    post = P.estimate([(0, v, sum(n)) for v, n in counts.items()])
    right = sum(n[1] if post[0, v] > P.ONE / 2 else n[0] for v, n in counts.items())
    best = sum(max(n) if 1 in v else n[0] for v, n in counts.items())  # what nobody can beat who sees the votes alone
    assert right >= best - 0.04 * 20_000
    assert all(post[0, v] == 0 for v in counts if 1 not in v)
