import hashlib
import re
import time

import pytest

from cadenza.llm import pii

from .edge import ROWS, edge, none


def luhn(digits):
    doubled = [int(d) if k % 2 == 0 else sum(map(int, str(2 * int(d)))) for k, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def brute(text):
    found = []
    for k, (kind, pattern) in enumerate([
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ]):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            fits = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else 0,
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if fits:
                found.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(found)]


TRICKY = [
    "a@b.c_d@e.f g@h @i.j k@l. m@n.o@p.q x..y@z-1.com,", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 1.2.3 9999999.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1111 411111111111111 5 4111 1111 1111 1112", "+1 (555) 123-4567 ++49 30 123456 +12 +1.2 +1234567890123456",
    "1" * 5000 + " " + "a" * 5000 + "@" + "b." * 50, "é1@2.3é 4012888888881881é+44 20 7946 0958.", "0 " * 40 + "+0 " * 30,
]


@pytest.mark.parametrize("text", TRICKY)
def test_base_spans(text):
    assert [f"{k}:{s}:{e}" for s, e, k in pii.identifiers(text)] == brute(text)


@pytest.mark.parametrize("text, span", [
    ("write john.doe [at] example [dot] com now", "email:john.doe [at] example [dot] com"),
    ("write john.doe(at)example.com now", "email:john.doe(at)example.com"),
    ("mail max at host dot example dot org please", "email:max at host dot example dot org"),
    ("jane＠example．com", "email:jane＠example．com"),
    ("jаne@exаmple.com", "email:jаne@exаmple.com"),
    ("call +１ ５５５ １２３ ４５６７ now", "phone:+１ ５５５ １２３ ４５６７"),
    ("call plus one five five five one two three four five six seven", "phone:plus one five five five one two three four five six seven"),
    ("ip one nine two dot 168 dot 1 dot 17", "ip:one nine two dot 168 dot 1 dot 17"),
    ("pay four one one one 1111 1111 1111", "card:four one one one 1111 1111 1111"),
    ("mail john dot doe (at) mail.example dot org", "email:john dot doe (at) mail.example dot org"),
    ("john at example.com", None),
    ("pay 4111​1111​1111​1111 now", "card:4111​1111​1111​1111"),
])
def test_disguises_map_back_to_the_source(text, span):
    base = pii.identifiers(text)
    more = [f"{k}:{text[s:e]}" for s, e, k in pii.disguised(text, base)]
    assert more == ([span] if span else [])


@pytest.mark.parametrize("text", [
    "look at the dot on the map", "un un un un un un un un un un un un un un", "meet at noon. the point is at hand",
    "he was at home at last point", "one two three go", "почта и телефон", "a@b.com is a plain one",
])
def test_plain_text_gets_no_spans(text):
    assert pii.disguised(text, pii.identifiers(text)) == []


def test_base_spans_stay_when_disguises_touch_them():
    text = "x [dot] a@b.com"
    base = pii.identifiers(text)
    assert base and pii.disguised(text, base) == []


def test_table_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(10_000 + k, t) for k, t in enumerate(TRICKY)], "doc_id bigint, text string")
    docs = docs.select("doc_id", "text").union(extra)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in pii.find_pii(docs).collect():
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k) for x in want) for k in pii.KINDS]
        assert set(want) <= set(filter(None, r.spans.split(",")))


def test_edge_rows_and_empty_table(spark):
    rows = pii.find_pii(edge(spark)).collect()
    assert len(rows) == len(ROWS) and {r.spans for r in rows} == {""}
    assert pii.find_pii(none(spark)).count() == 0


@pytest.mark.parametrize("text, span", [
    ("call plus 49 170 1234567 now", "phone:plus 49 170 1234567"),
    ("pay four one one one one one one one one one one one one one one one now", "card:four" + " one" * 15),
    ("call plus 1 " + " ".join(["five"] * 10), "phone:plus 1 " + " ".join(["five"] * 10)),
    ("oh " * 16, None), ("plus " + "one " * 12, None), ("two plus 2 is four", None),
])
def test_hint_and_spelled_digits_cover_the_passes(text, span):
    assert [f"{k}:{text[s:e]}" for s, e, k in pii.disguised(text, pii.identifiers(text))] == ([span] if span else [])


def test_time_grows_with_the_identifiers_of_one_text():
    def seconds(n):
        text = " ".join(f"name{k}@example{k}.com" for k in range(n)) + " eve [at] example.com"
        start = time.process_time()
        found = pii.disguised(text, pii.identifiers(text))
        assert len(found) == 1
        return time.process_time() - start

    seconds(100)
    assert seconds(16_000) < 8 * max(0.05, seconds(4_000))
