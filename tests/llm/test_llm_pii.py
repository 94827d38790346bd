"""Personal data: base spans against Python patterns, the selection against brute force, the model on held-out spans."""

import hashlib
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerlift.llm import pii
from ledgerlift.llm.common import documents, table
from ledgerlift.llm.pii import KINDS, personal_data, personal_data_digest, redacted

LARGER = Path("/root/testdata/sf0.01")
mounted = pytest.mark.skipif(not LARGER.exists(), reason="test tables not mounted")
DDL = "doc_id bigint, text string, base string, k int, span0 double, m string, start int"
# The base patterns in Python's notation.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def frame(spark, rows):
    """Extra columns with names that the operator uses inside."""
    return spark.createDataFrame([(i, t, None, 1, 0.5, "x", 2) for i, t in rows], DDL)


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]
            if good():
                out.append((kind, m.start(), m.end()))
    return out


def digest(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


def same_base(df, rows, known=None):
    got = sorted((tuple(r)[:6] for r in df.collect()), key=str)
    wanted = []
    for i, text in rows:
        spans = known[i] if known else base_spans(text)
        counts = [sum(k == kind for k, _, _ in spans) for kind in KINDS]
        wanted.append((i, *counts, hashlib.sha256(digest(spans).encode()).hexdigest()))
    assert got == sorted(wanted, key=str)


def card(seed, groups=" "):
    pick = random.Random(seed)
    digits = "4" + "".join(str(pick.randrange(10)) for _ in range(14))
    digits += next(d for d in "0123456789" if luhn(digits + d))
    return groups.join(digits[i : i + 4] for i in range(0, 16, 4))


def people(n):
    """Texts with personal data in base form, so that there is something to learn from."""
    pick = random.Random(7)
    for i in range(n):
        ip = ".".join(str(pick.randrange(1, 255)) for _ in range(4))
        phone = f"+1 ({pick.randrange(200, 999)}) 555-{pick.randrange(1000, 9999)}"
        yield i, f"mail jo.{i}@site{i % 9}.example.org now, host {ip} up. pay {card(i)} or call {phone} soon"


HARD = [
    "a@b.c_d@e.f", "a@b.c@d.e@f.g.h", "x@y @z.w a@.b a@b. a.@b.c-", "%+@a.b a@b.c..d", "é.x@host.example ünï@ñ.com",
    "1.2.3.4.5.6.7.8", "1.2.3.4 256.1.1.1 001.02.3.0255 0000000000.0.0.0", "12345.1.2.3.4", "1.2.3 .4.5.6.7",
    "4111 1111 1111 1111", "4111-1111-1111-1111 4111 1111 1111 1111", "4111  1111 1111 1111", "4111111111111112", "0000000000000", "-4111111111111111-",
    "+1 (017) 555-7713", "+1", "+12", "+1 2", "+49 (0) 30 / 123456", "++1 234 567 890", "+1 234 567 890 ) . 12 3", "+(1 234 567 890", "+1234567890123456",
    "😀 a@b.c 😀 1.2.3.4 日本 +1 (017) 555-7713", "a@b.c\nd@e.f\r\n+1 234 567\t890",
]


def test_base_spans_match_python(spark):
    pick = random.Random(11)
    alphabet = ["1", "23", "456", "0", "9", ".", " ", "-", "+", "(", ")", "@", "a", "b_", "%", "é", "😀", "\n", "4111111111111111", "1.2.3.4", "x@y.z"]
    rows = list(enumerate(HARD)) + [(100 + i, "".join(pick.choice(alphabet) for _ in range(60))) for i in range(400)]
    same_base(personal_data_digest(frame(spark, rows)), rows)


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "a@b.c"), (None, None), (3, "a@b.c 1.2.3.4"), (3, "a@b.c 1.2.3.4"), (3, "other")] + list(people(20))
    same_base(personal_data_digest(frame(spark, rows)), rows)
    empty = personal_data_digest(frame(spark, []))
    assert empty.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"] and empty.collect() == []


def test_very_long_texts(spark):
    # Python's own search is quadratic on such texts, so what they hold is written down
    rows = [(1, "a" * 3_000_000), (2, "7" * 3_000_000), (3, "x@" * 500_000), (4, "1." * 40_000), (6, "+" + "(" * 1_000_000), (7, "a" * 400_000 + "@b.c")]
    known = {i: [] for i, _ in rows} | {4: [("ip", 8 * i, 8 * i + 7) for i in range(10_000)], 7: [("email", 0, 400_004)]}
    many = "1.2.3.4 a@b.c, "
    rows.append((5, many * 4_000))
    known[5] = [(k, a + i * len(many), b + i * len(many)) for i in range(4_000) for k, a, b in base_spans(many)]
    same_base(personal_data_digest(frame(spark, rows)), rows, known)


def test_the_method_adds_other_formats_and_keeps_clean_texts(spark):
    dotted, slashed = card(901, "."), card(902, "/")
    planted = {
        500: f"thanks, {card(900, '')} {card(903, '')} here", 501: f"pay with {dotted} please", 502: f"my card {slashed} ok",
        503: "write to jo.3 [at] site4.example.org today", 504: "the host 23[.]45[.]67[.]89 is down",
    }
    clean = {
        600: "on 2019-05-17 the price rose 12.5 percent to 1,250,000 units", 601: "version 4.0.1 of 1999.999.1.1 and 4111 1111 1111 1112", 602: "look at this dot or that",
        603: "@handle said a @ b", 604: "ids 1234567890123456 and 20190517123000 in row 77",
    }
    rows = list(people(150)) + list(planted.items()) + list(clean.items())
    got = {r.doc_id: r.spans for r in personal_data_digest(frame(spark, rows)).collect()}
    found = {i: [tuple(s.split(":")) for s in got[i].split(",") if s] for i in got}
    assert [k for k, _, _ in found[500]] == ["card", "card"]
    for i, kind in ((501, "card"), (502, "card"), (503, "email"), (504, "ip")):
        assert any(k == kind for k, _, _ in found[i]), (i, found[i])
    assert all(found[i] == [] for i in clean), [found[i] for i in clean]
    assert all(len(found[i]) >= 4 for i in range(150))


def test_added_spans_touch_nothing(spark):
    pick = random.Random(3)
    rows = []
    for i in range(60):
        base = [(a := pick.randrange(600), a + pick.randrange(1, 12)) for _ in range(pick.randrange(8))]
        accepted = [(a := pick.randrange(600), -pick.random(), a + pick.randrange(1, 30), pick.randrange(4)) for _ in range(pick.randrange(40))]
        rows.append((i, [(0, a, b) for a, b in base], accepted))
    df = spark.createDataFrame(rows, f"i int, base array<struct<k:int,start:bigint,stop:bigint>>, accepted array<{pii.MARK}>")
    pii.CHUNK, held = 8, pii.CHUNK
    try:
        got = pii.with_added(df).select("i", F.col("added").alias("a")).collect()
    finally:
        pii.CHUNK = held
    for (i, base, accepted), r in zip(rows, sorted(got)):
        added = [tuple(x) for x in r.a]
        assert set(added) <= set(accepted) and added == sorted(added)
        assert all(b <= c for (_, _, b, _), (c, _, _, _) in zip(added, added[1:]))
        assert all(b <= x or y <= a for a, _, b, _ in added for _, x, y in base)
        for a, rank, b, k in set(accepted) - set(added):  # whoever is out met a base span or another proposal
            others = [(x, y) for _, x, y in base] + [(x, y) for x, _, y, _ in accepted if (x, y) != (a, b)]
            assert any(x < b and a < y for x, y in others) or accepted.count((a, rank, b, k)) > 1, (i, a, b)


def test_redacted_text(spark):
    rows = [*people(150), (500, None), (501, ""), (502, "nothing here"), (503, "a@b.c" + ", 1.2.3.4" * 2_000 + " 日本"), (504, "+1 234 567 890.12@x.org 😀")]
    spans = {r.doc_id: sorted((s.start, s.stop, s.k) for s in [*r.base, *r.added]) for r in personal_data(frame(spark, rows)).collect()}
    for r in redacted(frame(spark, rows)).collect():
        text, out, at = dict(rows)[r.doc_id] or "", [], 0
        merged = []
        for a, b, k in spans[r.doc_id]:
            if merged and a < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b, k])
        for a, b, k in merged:
            out += [text[at:a], f"[{KINDS[k]}]"]
            at = b
        assert r.text == "".join(out) + text[at:]


@mounted
def test_held_out_precision_and_recall(spark):
    found = pii.found_spans(documents(table(spark, str(LARGER), "documents")), ["doc_id"])
    lessons = pii.lessons(found)
    trees = pii.fit(lessons.filter("NOT held"))
    floors = pii.thresholds(lessons, trees)
    score = pii._by_kind({k: pii.score_sql(t) for k, t in trees.items()})
    rows = lessons.filter("held").selectExpr("k", "label", "n", f"floor(1000 / (1 + exp(-({score})))) / 1000D AS p").collect()
    assert set(trees) == {0, 1, 2, 3}
    for k in trees:
        taken = [r for r in rows if r.k == k and r.p >= floors[k]]
        right = sum(r.n for r in taken if r.label)
        assert right >= 0.98 * sum(r.n for r in taken)
        assert right >= 0.6 * sum(r.n for r in rows if r.k == k and r.label), KINDS[k]


def test_no_python_in_the_plan(spark):
    df = personal_data_digest(frame(spark, list(people(30))))
    plan = df._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
